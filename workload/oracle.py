"""The registered queries stated independently, as SQL for a second engine."""

from offerlens.operators.bootstrap import poisson_bounds

_RAW = """
b as (
  select l_orderkey*7 + l_linenumber*3 + l_partkey as h, p_name, p_brand, p_size, l_quantity, l_shipdate,
         cast(floor(l_extendedprice) as bigint)
           * (case when (l_orderkey*7 + l_linenumber*3 + l_partkey) % 37 = 0 then 12 else 1 end) as px
  from lineitem join part on l_partkey = p_partkey),
r as (
  select h,
    case when h%29=0 then 'unknown' else concat(' ', p_name, ' ') end as model,
    case when h%23=0 or h%101=0 then 'unknown'
         when px >= 1000 then concat(cast(px//1000 as varchar), ',', lpad(cast(px%1000 as varchar), 3, '0'), '.')
         else concat(cast(px as varchar), '.') end as price_USD,
    case when h%31=0 or h%101=0 or h%103=0 then 'unknown' else p_brand end as brand,
    case when h%11=0 or h%101=0 or h%103=0 then 'unknown'
         when h%5=0 then concat(cast(p_size*512 as varchar), ' MB')
         else concat(cast(p_size as varchar), ' GB') end as ram_GB,
    case when h%7=0 or h%101=0 or h%103=0 then 'unknown'
         when h%41=0 then concat(cast(cast(l_quantity*5000 as bigint) as varchar), ' MHz')
         when h%3=0 then concat(cast(l_quantity/10 as varchar), ' GHz')
         else concat(cast(cast(l_quantity*100 as bigint) as varchar), ' MHz') end as gpu_clock_speed_MHz,
    cast(l_shipdate as date) as date
  from b),
offers_raw as materialized (
  select model, price_USD, brand, ram_GB, gpu_clock_speed_MHz, date from r
  union all
  select model, price_USD, brand, ram_GB, gpu_clock_speed_MHz, date from r where h%10=0)"""

_PRICE = "try_cast(replace(replace({c}, '.', ''), ',', '') as double)"
_RAM = """case when lower({c}) like '%mb%' then try_cast(trim(replace(lower({c}), 'mb', '')) as double) * 0.001::double
  when lower({c}) like '%gb%' then try_cast(trim(replace(lower({c}), 'gb', '')) as double)
  else try_cast(trim(lower({c})) as double) end"""
_CLOCK = """case when lower({c}) like '%ghz%' then try_cast(trim(replace(lower({c}), 'ghz', '')) as double) * 1000::double
  when lower({c}) like '%mhz%' then try_cast(trim(replace(lower({c}), 'mhz', '')) as double)
  else try_cast(trim(lower({c})) as double) end"""


def _clean_columns(prefix: str = "") -> str:
    price, ram, clock = (
        text.format(c=prefix + name)
        for text, name in [(_PRICE, "price_USD"), (_RAM, "ram_GB"), (_CLOCK, "gpu_clock_speed_MHz")]
    )
    return (
        f"trim({prefix}model) as model, {price} as price_USD, trim({prefix}brand) as brand, "
        f"{ram} as ram_GB, {clock} as gpu_clock_speed_MHz, {prefix}date as date"
    )


_SIX = "model, price_USD, brand, ram_GB, gpu_clock_speed_MHz, date"

_CLEAN = f"{_RAW},\noffers as materialized (select {_clean_columns()} from offers_raw)"

_STEPS = """
missing as (
  select nullif(model, 'unknown') as model, price_USD, nullif(brand, 'unknown') as brand, ram_GB, gpu_clock_speed_MHz, date
  from offers),
f1 as materialized (select * from missing where model is not null),
f2 as materialized (
  select * from f1
  where (case when price_USD is null then 0 else 1 end) + (case when brand is null then 0 else 1 end)
      + (case when ram_GB is null then 0 else 1 end) + (case when gpu_clock_speed_MHz is null then 0 else 1 end)
      + (case when date is null then 0 else 1 end) + 1 >= 3),
f3 as materialized (
  select * from f2 where brand in
    (select brand from f2 where brand is not null group by brand order by count(*) desc, brand limit 10)),
f4 as materialized (
  select * from f3 where model in (select model from f3 group by model order by count(*) desc, model limit 15)),
pq as materialized (select quantile_cont(price_USD, 0.25) as q1, quantile_cont(price_USD, 0.75) as q3 from f4),
f5 as materialized (
  select f4.* from f4, pq where price_USD < q3 + (q3-q1)*1.5 and price_USD > q1 - (q3-q1)*1.5),
cq as materialized (
  select quantile_cont(gpu_clock_speed_MHz, 0.25) as q1, quantile_cont(gpu_clock_speed_MHz, 0.75) as q3 from f5),
df as materialized (
  select f5.* from f5, cq where gpu_clock_speed_MHz < q3 + (q3-q1)*1.5 and gpu_clock_speed_MHz > q1 - (q3-q1)*1.5),
du as materialized (select distinct * from df)"""

_FUNNEL = f"{_CLEAN},{_STEPS}"

_CATEGORY = f"""{_FUNNEL},
span as (select min(gpu_clock_speed_MHz) as lo, max(gpu_clock_speed_MHz) as hi, (max(gpu_clock_speed_MHz) - min(gpu_clock_speed_MHz))/4 as w from df),
cat as materialized (
  select du.*, case when lo = hi or gpu_clock_speed_MHz <= lo then null
    when gpu_clock_speed_MHz <= 1*w+lo then 0 when gpu_clock_speed_MHz <= 2*w+lo then 1
    when gpu_clock_speed_MHz <= 3*w+lo then 2 when gpu_clock_speed_MHz <= hi then 3 end::int as category_no
  from du, span),
labels4 as (select * from (values (0, 'very low'), (1, 'low'), (2, 'moderate'), (3, 'high')) t(category_no, category))"""

_SPECS = f"""{_FUNNEL},
specs as (
  select model, avg(price_USD) as price, avg(ram_GB) as ram, avg(gpu_clock_speed_MHz) as clock from du group by model)"""

_FUNNEL_COUNTS = """
select step::int as step, stage, n::bigint as n from (
  select 0 as step, 'raw' as stage, count(*) as n from offers
  union all select 1, 'model_present', count(*) from f1
  union all select 2, 'min_present', count(*) from f2
  union all select 3, 'top_brands', count(*) from f3
  union all select 4, 'top_models', count(*) from f4
  union all select 5, 'price_present', count(price_USD) from f4
  union all select 6, 'price_fence', count(*) from f5
  union all select 7, 'clock_present', count(gpu_clock_speed_MHz) from f5
  union all select 8, 'clock_fence', count(*) from df
  union all select 9, 'distinct', count(*) from du)"""

def _poisson(mean: int) -> str:
    """Poisson(mean) from ``uv``: the bounds as one CASE per value, halved to keep it flat."""
    first, bounds = poisson_bounds(mean)

    def search(low: int, high: int) -> str:
        if low == high:
            return str(first + low)
        middle = (low + high) // 2
        return f"case when uv < {bounds[middle]} then {search(low, middle)} else {search(middle + 1, high)} end"

    return search(0, len(bounds))


def _resampled(key: str) -> str:
    """Weights of 1000 replicates for the rows of ``cells(..., n)``."""
    fifth = "((({x})*({x})%2147483647)*(({x})*({x})%2147483647)%2147483647)*({x})%2147483647"
    return f"""
units as (
  select *, 0 as level, unnest(range(1, n % 16 + 1)) as copy from cells
  union all select *, 1, unnest(range(1, n // 16 % 16 + 1)) from cells
  union all select *, 2, unnest(range(1, n // 256 + 1)) from cells),
seeds as (
  select *, ('0x' || substr(d, 1, 15))::bigint % 2147483647 as k1, ('0x' || substr(d, 16, 15))::bigint % 2147483647 as k2
  from (select *, md5(concat_ws('|', {key}, level::varchar, copy::varchar)) as d from units)),
shifted as (
  select seeds.*, g.i as replicate, (k1 + g.i*1640531527) % 2147483647 as s1, (k2 + g.i*1640531527) % 2147483647 as s2
  from seeds, range(1, 1001) g(i)),
mixed as (select *, ({fifth.format(x="s1")}) * 2147483647 + {fifth.format(x="s2")} as uv from shifted),
drawn as (
  select *, case level when 0 then {_poisson(1)} when 1 then {_poisson(16)} else {_poisson(256)} end as w from mixed)"""


_NAV_PAGES = """
nav_pages as (
  select date '2023-01-01' + cast(page_id // 40 as int) as run_date, cast(page_id % 40 + 1 as int) as page_no,
    case when page_id % 41 = 40 then 403 when page_id % 59 = 58 then 304 else 200 end as status,
    case when page_id % 67 = 66 then 'timeout' end as error, html
  from pages)"""

_PARTS_OF = """
parts as (
  select *, date '2020-01-01' + cast(p_partkey // 40 as int) as run_date, cast(p_partkey % 40 + 1 as int) as page_no
  from part),
part_pages as (
  select p_partkey, run_date, page_no,
    case when p_partkey % 97 = 96 then 403 when p_partkey % 79 = 78 then 304 else 200 end as status,
    case when p_partkey % 83 = 82 then 'timeout' end as error,
    p_partkey % 89 = 88 as no_grid
  from parts where page_no between {first} and {last}),
page_event as (
  select *, case when error is not null then 'timeout_error' when status = 403 then 'request_error'
                 when status = 200 and no_grid then 'no_grid' end as event
  from part_pages),
stops as (select run_date, min(page_no) as stop_page from page_event where event is not null group by run_date),
admitted as (
  select p.* from page_event p left join stops s on p.run_date = s.run_date
  where (stop_page is null or page_no < stop_page) and status = 200 and error is null),
part_links as (
  select p_partkey, run_date, page_no, no_grid, pos,
    'https://amazon.com/dp/' || (p_partkey // 40) || '-' || page_no || '?pos='
      || (case when p_partkey % 53 = 52 and pos = 1 then 0 else pos end) || '&s=1' as url
  from (select *, unnest(range(0, p_partkey % 5 + 1)) as pos from page_event) where pos <> 3),
part_offers as (
  select run_date, page_no, pos, url, h,
    case when h % 23 = 0 then 403 when h % 29 = 0 then 500 else 200 end as status,
    case when h % 31 = 0 then 'timeout' end as error,
    case when h % 13 = 0 or h % 7 = 0 then 'unknown' else ' ' || p_name || ' & ' || pos || ' ' end as model,
    case when h % 17 = 0 then 'unknown'
         when px >= 1000 then (px // 1000) || ',' || lpad((px % 1000)::varchar, 3, '0') || '.' else px || '.' end as price_USD,
    case when (h+1) % 13 = 0 or (h+1) % 7 = 0 then 'unknown' else p_brand end as brand,
    case when (h+2) % 13 = 0 or (h+2) % 7 = 0 then 'unknown' when h % 2 = 0 then (p_size*512) || ' MB'
         else p_size || chr(160) || 'GB' end as ram_GB,
    case when (h+3) % 13 = 0 or (h+3) % 7 = 0 then 'unknown' when h % 1201 = 1200 then '1,800 MHz'
         when h % 3 = 0 then (p_size/10) || ' GHz' else (p_size*100) || ' MHz' end as gpu_clock_speed_MHz
  from (select l.*, p_name, p_brand, p_size, l.p_partkey*5 + pos as h, cast(floor(p_retailprice) as bigint) + pos*10 as px
        from part_links l join part on l.p_partkey = part.p_partkey)),
visited as (
  select o.* from part_offers o join admitted a on o.run_date = a.run_date and o.page_no = a.page_no),
blocks as (
  select run_date, page_no, min(pos) as block_pos from visited where error is null and status = 403 group by all),
kept as (
  select v.* from visited v left join blocks b on v.run_date = b.run_date and v.page_no = b.page_no
  where (block_pos is null or pos < block_pos) and status = 200 and error is null and h % 19 <> 0)"""

_PARTS = _PARTS_OF.format(first=1, last=40)

# One row for each attribute that a kept offer lacks.
_LACKING = """
lacking as (
  select run_date, page_no, pos, url, 'missing_' || unnest(names) as event
  from (select *, list_filter([
      case when model = 'unknown' then 'model' end, case when price_USD = 'unknown' then 'price_USD' end,
      case when brand = 'unknown' then 'brand' end, case when ram_GB = 'unknown' then 'ram_GB' end,
      case when gpu_clock_speed_MHz = 'unknown' then 'gpu_clock_speed_MHz' end], lambda x: x is not null) as names from kept))"""

# The crawled runs whose cells can all be parsed, cleaned; a no-break space is white space.
_CRAWLED = f"""{_PARTS},
loaded as (
  select model, price_USD, brand, replace(ram_GB, chr(160), ' ') as ram_GB, gpu_clock_speed_MHz, run_date as date
  from kept where run_date not in (select run_date from kept where gpu_clock_speed_MHz = '1,800 MHz')),
offers as materialized (select {_clean_columns()} from loaded),{_STEPS}"""

_DIRTY = f"""{_RAW},
dirty as materialized (
  select model, case when q and h%1013=0 then '$1,299.' else price_USD end as price_USD, brand,
    case when q and h%1009=0 then '8 GB GDDR6' else ram_GB end as ram_GB,
    case when q and h%997=0 then '1,800 MHz' else gpu_clock_speed_MHz end as gpu_clock_speed_MHz,
    cast(date_trunc('month', date) as date) as date
  from (select *, month(date) in (3, 6, 9, 12) as q from r)),
verdicts as (
  select date, count(*)::bigint as n_rows, count_if(price_USD = '$1,299.')::bigint as bad_price,
    count_if(ram_GB = '8 GB GDDR6')::bigint as bad_ram, count_if(gpu_clock_speed_MHz = '1,800 MHz')::bigint as bad_clock
  from dirty group by date)"""

_LINKS = """unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) as href,
    generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)">', 1), 1) - 1 as pos"""


def _with(ctes: str, select: str) -> str:
    return f"with {ctes.strip()}\n{select}"


def all_oracles() -> dict[str, str]:
    found = {
        "listing_window": _with(_NAV_PAGES, """
            select run_date, page_no, 'https://shop.example/s?k=cards&page=' || page_no as url
            from nav_pages where page_no >= 3 and page_no < 23"""),
        "crawl_prefix": _with(_NAV_PAGES, """
            select run_date, page_no, status from nav_pages p
            where error is null and status = 200 and not exists (
              select 1 from nav_pages q where q.run_date = p.run_date and q.page_no <= p.page_no
                and (q.error is not null or q.status = 403))"""),
        "crawl_prefix_grid": _with(_PARTS, "select run_date, page_no, status from admitted"),
        "offer_links": f"""
            select page_id, cast(pos as int) as pos, 'https://amazon.com' || href as url
            from (select page_id, {_LINKS} from pages)""",
        "grid_offer_links": _with(_PARTS, """
            select l.run_date, l.page_no, cast(pos as int) as pos, url from part_links l join part_pages p using (p_partkey)
            where not p.no_grid"""),
        "offer_admission": _with(_NAV_PAGES, f""",
            offers as (
              select *, (dayofyear(run_date)*7 + page_no*31 + pos) % 17 as kind
              from (select run_date, page_no, {_LINKS} from nav_pages))
            select run_date, page_no, cast(pos as int) as pos, 'https://amazon.com' || href as url from offers o
            where kind > 2 and not exists (
              select 1 from offers b
              where b.run_date = o.run_date and b.page_no = o.page_no and b.pos <= o.pos and b.kind = 0)"""),
        "offer_extract": _with(_PARTS, """
            select url, model, price_USD, brand, ram_GB, gpu_clock_speed_MHz from part_offers where h % 19 <> 0"""),
        "crawl_window_offers": _with(_PARTS_OF.format(first=3, last=22), """
            select model, price_USD, brand, ram_GB, gpu_clock_speed_MHz, run_date as date from kept"""),
        "crawl_raw_offers": _with(_PARTS, """
            select model, price_USD, brand, ram_GB, gpu_clock_speed_MHz, run_date as date from kept"""),
        "scan_project": _with(_CLEAN, f"select {_SIX} from offers"),
        "clean_price": _with(_RAW, f"select price_USD as text, {_PRICE.format(c='price_USD')} as price_USD from offers_raw"),
        "clean_clock": _with(_RAW, f"""
            select gpu_clock_speed_MHz as text, {_CLOCK.format(c='gpu_clock_speed_MHz')} as gpu_clock_speed_MHz
            from offers_raw"""),
        "clean_ram": _with(_RAW, f"select ram_GB as text, {_RAM.format(c='ram_GB')} as ram_GB from offers_raw"),
        "sentinel_to_null": _with(_RAW, """
            select case when model <> 'unknown' then model end as model,
              case when price_USD <> 'unknown' then price_USD end as price_USD,
              case when brand <> 'unknown' then brand end as brand, case when ram_GB <> 'unknown' then ram_GB end as ram_GB,
              case when gpu_clock_speed_MHz <> 'unknown' then gpu_clock_speed_MHz end as gpu_clock_speed_MHz
            from offers_raw"""),
        "trim_strings": _with(_RAW, "select trim(model) as model, trim(brand) as brand from offers_raw"),
        "clean_offers": _with(_CLEAN, f"select {_SIX} from offers"),
        "usd_per_gb": _with(_SPECS, "select model, round(price / nullif(ram, 0), 6) as usd_per_gb from specs"),
        "usd_per_100mhz": _with(_SPECS, "select model, round(price / nullif(clock, 0) * 100, 6) as usd_per_100mhz from specs"),
        "clock_category": _with(_CATEGORY, f"""
            select {_SIX}, category_no, category from cat left join labels4 using (category_no)"""),
        "drop_null_model": _with(_FUNNEL, f"select {_SIX} from f1"),
        "min_nonnull": _with(_FUNNEL, f"select {_SIX} from f2"),
        "top_brands_semi": _with(_FUNNEL, f"select {_SIX} from f3"),
        "top_models_semi": _with(_FUNNEL, f"select {_SIX} from f4"),
        "iqr_price": _with(_FUNNEL, f"select {_SIX} from f5"),
        "iqr_clock": _with(_FUNNEL, f"select {_SIX} from df"),
        "iqr_events": """
            with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
            select event_id, value from events, q where value < q3 + (q3-q1)*1.5 and value > q1 - (q3-q1)*1.5""",
        "brand_counts": _with(_FUNNEL, "select brand, count(*)::bigint as n from f2 where brand is not null group by brand"),
        "model_counts": _with(_FUNNEL, "select model, count(*)::bigint as n from f3 group by model"),
        "quartiles": _with(_FUNNEL, "select 'price' as name, q1, q3 from pq union all select 'clock', q1, q3 from cq"),
        "price_by_model": _with(_FUNNEL, "select model, round(avg(price_USD), 6) as price from du group by model"),
        "price_by_brand": _with(_FUNNEL, """
            select brand, round(avg(p), 6) as price
            from (select brand, model, avg(price_USD) as p from du group by brand, model) group by brand"""),
        "spec_means_by_model": _with(_SPECS, """
            select model, round(price, 6) as price, round(ram, 6) as ram, round(clock, 6) as clock from specs"""),
        "dedup_offers": _with(_FUNNEL, f"select {_SIX} from du"),
        "brand_share": _with(_FUNNEL, """
            select brand, count(*)::bigint as n, round(count(*) * 100.0::double / (select count(*) from df), 1) as percent
            from df group by brand"""),
        "price_clock_fit": _with(_FUNNEL, """
            select regr_count(price_USD, gpu_clock_speed_MHz)::bigint as n,
              round(regr_slope(price_USD, gpu_clock_speed_MHz), 6) as slope,
              round(regr_intercept(price_USD, gpu_clock_speed_MHz), 6) as intercept,
              round(regr_r2(price_USD, gpu_clock_speed_MHz), 6) as r2
            from du"""),
        "extended_price_quantiles": " union all ".join(
            f"select {p}::double as p, round(quantile_cont(l_extendedprice::double, {p}), 6) as value from lineitem"
            for p in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)),
        "quartiles_radix": _with(_FUNNEL, """
            select 'price' as name, quantile_cont(price_USD, 0.25) as q1, quantile_cont(price_USD, 0.75) as q3 from offers
            union all select 'clock', quantile_cont(gpu_clock_speed_MHz, 0.25), quantile_cont(gpu_clock_speed_MHz, 0.75) from offers"""),
        "top_brands_heavy": _with(_FUNNEL, """
            select brand, count(*)::bigint as n from f2 where brand is not null group by brand order by n desc, brand limit 10"""),
        "top_models_heavy": _with(_FUNNEL, """
            select model, count(*)::bigint as n from f3 group by model order by n desc, model limit 15"""),
        "top_parts_heavy": """
            select l_partkey::bigint as l_partkey, count(*)::bigint as n from lineitem
            group by all order by n desc, l_partkey limit 100""",
        # Prices are whole dollars, so the second engine's sums are exact too and nothing is rounded.
        "price_by_model_exact": _with(_FUNNEL, "select model, avg(price_USD) as price from du group by model"),
        "price_clock_band": _with(f"""{_FUNNEL},
            cells as materialized (
              select gpu_clock_speed_MHz as x, price_USD as y, count(*) as n from du group by all),
            {_resampled("format('{:.6f}', x), format('{:.6f}', y)").strip()},
            sums as (
              select replicate, sum(w) as n, sum(w*x) as sx, sum(w*y) as sy, sum(w*x*x) as sxx, sum(w*x*y) as sxy
              from drawn where w > 0 group by replicate),
            lines as (
              select replicate, slope, (sy - slope*sx)/n as base
              from (select *, (n*sxy - sx*sy) / (n*sxx - sx*sx) as slope from sums)),
            fitted as (
              select regr_slope(price_USD, gpu_clock_speed_MHz) as slope, regr_intercept(price_USD, gpu_clock_speed_MHz) as base,
                min(gpu_clock_speed_MHz) as lo, max(gpu_clock_speed_MHz) as hi
              from du),
            grid as (select i as point, lo + i*(hi-lo)/99 as clock, f.base + f.slope*(lo + i*(hi-lo)/99) as fit from fitted f, range(0, 100) g(i))""", """
            select cast(point as int) as point, round(clock, 4) as clock, round(any_value(fit), 4) as fit,
              round(quantile_cont(base + slope*clock, 0.025), 4) as low, round(quantile_cont(base + slope*clock, 0.975), 4) as high
            from grid, lines group by point, clock"""),
        "price_by_category": _with(_CATEGORY, """
            select l.category_no, l.category, count(price_USD)::bigint as n, round(avg(price_USD), 6) as price
            from labels4 l left join cat using (category_no) group by all"""),
        "price_by_category_ci": _with(f"""{_CATEGORY},
            cells as materialized (
              select category_no as c, price_USD as y, count(*) as n from cat where category_no is not null group by all),
            {_resampled("c::varchar, format('{:.6f}', y)").strip()},
            means as (select c, replicate, sum(w*y)/sum(w) as m from drawn where w > 0 group by c, replicate),
            bounds as (
              select c as category_no, quantile_cont(m, 0.025) as low, quantile_cont(m, 0.975) as high from means group by c)""", """
            select l.category_no, l.category, count(price_USD)::bigint as n, round(avg(price_USD), 4) as price,
              round(any_value(low), 4) as low, round(any_value(high), 4) as high
            from labels4 l left join cat using (category_no) left join bounds using (category_no)
            group by l.category_no, l.category"""),
        "value_mean_ci": _with(f"""
            cells as materialized (
              select l_returnflag as c, l_quantity as y, count(*) as n from lineitem
              where l_returnflag is not null and l_quantity is not null group by all),
            {_resampled("c, format('{:.6f}', y::double)").strip()},
            means as (select c, replicate, sum(w*y::double)/sum(w) as m from drawn where w > 0 group by c, replicate),
            bounds as (select c, quantile_cont(m, 0.025) as low, quantile_cont(m, 0.975) as high from means group by c)""", """
            select l_returnflag, count(*)::bigint as n, round(avg(l_quantity), 6) as mean, round(any_value(low), 6) as low,
              round(any_value(high), 6) as high
            from lineitem join bounds on l_returnflag = c where l_quantity is not null group by l_returnflag"""),
        "events_box_outliers": """
            with q as (select quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3 from events)
            select value, count(*)::bigint as n from events, q
            where value < q1 - 1.5*(q3-q1) or value > q3 + 1.5*(q3-q1) group by value""",
        "price_box": _with(f"""{_FUNNEL},
            q as (
              select quantile_cont(price_USD, 0.25) as q1, quantile_cont(price_USD, 0.5) as med, quantile_cont(price_USD, 0.75) as q3
              from df)""", """
            select count(*)::bigint as n, q1, med as median, q3,
              least(q1, min(price_USD) filter (price_USD >= q1 - 1.5*(q3-q1))) as whisker_low,
              greatest(q3, max(price_USD) filter (price_USD <= q3 + 1.5*(q3-q1))) as whisker_high,
              count_if(price_USD < q1 - 1.5*(q3-q1) or price_USD > q3 + 1.5*(q3-q1))::bigint as n_outliers
            from df, q group by q1, med, q3"""),
        "price_box_outliers": _with(f"""{_FUNNEL},
            q as (select quantile_cont(price_USD, 0.25) as q1, quantile_cont(price_USD, 0.75) as q3 from df)""", """
            select price_USD, count(*)::bigint as n from df, q
            where price_USD < q1 - 1.5*(q3-q1) or price_USD > q3 + 1.5*(q3-q1) group by price_USD"""),
        "price_histogram": _with(f"""{_FUNNEL},
            s as (select min(price_USD) as lo, max(price_USD) as hi from df),
            bins as (
              select i as bin, i*((hi-lo)/7)+lo as a, case when i = 6 then hi else (i+1)*((hi-lo)/7)+lo end as z
              from s, range(0, 7) g(i))""", """
            select cast(bin as int) as bin, round(a, 6) as bin_low, round(z, 6) as bin_high, count(price_USD)::bigint as n
            from bins left join df on price_USD >= a and (price_USD < z or (bin = 6 and price_USD = z)) group by all"""),
        "price_kde": _with(f"""{_FUNNEL},
            s as (
              select min(price_USD) as lo, max(price_USD) as hi, count(*)::double as n,
                stddev_samp(price_USD) * pow(count(*), -0.2) as bw
              from df),
            grid as (select i as point, case when i = 199 then hi else i*((hi-lo)/199)+lo end as x from s, range(0, 200) g(i)),
            prices as (select price_USD as p, count(*) as c from df group by price_USD),
            curve as (
              select point, x, sum(c * exp(-0.5*pow((x-p)/bw, 2))) / (any_value(n)*any_value(bw)*sqrt(2*pi())) as d,
                any_value(n)*(any_value(hi)-any_value(lo))/7 as scale
              from grid, prices, s group by point, x)""", """
            select cast(point as int) as point, round(x, 6) as x, round(d, 12) as density, round(d*scale, 6) as count_scaled
            from curve"""),
        "extended_price_kde": _with("""
            s as (
              select min(v) as lo, max(v) as hi, count(*)::double as n, stddev_samp(v) * pow(count(*), -0.2) as bw
              from (select l_extendedprice::double as v from lineitem)),
            grid as (select i as point, case when i = 199 then hi else i*((hi-lo)/199)+lo end as x from s, range(0, 200) g(i)),
            prices as (select l_extendedprice::double as p, count(*) as c from lineitem group by 1),
            curve as (
              select point, x, sum(c * exp(-0.5*pow((x-p)/bw, 2))) / (any_value(n)*any_value(bw)*sqrt(2*pi())) as d,
                any_value(n)*(any_value(hi)-any_value(lo))/7 as scale
              from grid, prices, s group by point, x)""", """
            select cast(point as int) as point, round(x, 6) as x, round(d, 12) as density, round(d*scale, 3) as count_scaled
            from curve"""),
        "funnel_counts": _with(_FUNNEL, _FUNNEL_COUNTS),
        "load_clean_count": _with(_CLEAN, """
            select cast(date_trunc('month', date) as date) as date, count(*)::bigint as n, sum(price_USD) as price_sum
            from offers group by 1"""),
        "append_batches": _with(_CLEAN, """
            select run.d as date, count(*)::bigint as n, sum(price_USD) as price_sum
            from offers, (values (date '2023-01-01'), (date '2023-02-01'), (date '2023-02-01')) run(d) group by run.d"""),
        "load_csv_fallback": _with(_CLEAN, f"select {_SIX} from offers"),
        "load_csv_raw": _with(_RAW, f"""
            select ' "' || coalesce(model, '') || '",' || chr(10) || ' ' as model, {", ".join(_SIX.split(", ")[1:])}
            from offers_raw"""),
        "empty_batch": _with(_PARTS, """
            select distinct run_date, 'clean' as stage, 'no_data' as event, 1::bigint as n, null::int as page_no from part_pages"""),
        "run_report_csv": _with(f"""{_PARTS},
            runs as (
              select p.run_date, count(k.h) as n_rows, count_if(k.gpu_clock_speed_MHz = '1,800 MHz') as bad
              from (select distinct run_date from part_pages) p left join kept k on k.run_date = p.run_date group by p.run_date)""", """
            select run_date, stage, event, n::bigint as n, null::int as page_no from (
              select run_date, 'clean' as stage, 'no_data' as event, 1 as n from runs where n_rows = 0
              union all select run_date, 'clean', 'failed', 1 from runs where bad > 0
              union all select run_date, 'load', 'rows_to_csv', n_rows from runs where n_rows > 0)"""),
        "pipeline_to_dashboard": _with(_CRAWLED, """
            select brand, round(avg(p), 6) as price
            from (select brand, model, avg(price_USD) as p from du group by brand, model) group by brand"""),
        "batch_verdict": _with(_DIRTY, """
            select date, n_rows, bad_price, bad_ram, bad_clock, bad_price + bad_ram + bad_clock = 0 as is_clean from verdicts"""),
        "load_routing": _with(_DIRTY, """
            select case when bad_price + bad_ram + bad_clock = 0 then 'table' else 'quarantine' end as target,
              sum(n_rows)::bigint as n_rows, count(*)::bigint as n_batches
            from verdicts group by 1"""),
        "publish_after_failures": _with(_DIRTY, """
            select date, case when month(date) % 6 = 5 then 'csv'
                when bad_price + bad_ram + bad_clock = 0 then 'table' else 'quarantine' end as target, n_rows
            from verdicts"""),
        "summary_funnel_counts": _with(_FUNNEL, f"{_FUNNEL_COUNTS} where step < 9"),
        "crawl_to_price_by_model": _with(_CRAWLED, "select model, round(avg(price_USD), 6) as price from du group by model"),
        "crawl_to_funnel_counts": _with(_CRAWLED, _FUNNEL_COUNTS),
        "run_report": _with(f"""{_PARTS},{_LACKING},
            runs as (
              select p.run_date, count(k.h) as n_rows, count_if(k.gpu_clock_speed_MHz = '1,800 MHz') as bad
              from (select distinct run_date from part_pages) p left join kept k on k.run_date = p.run_date group by p.run_date)""", """
            select run_date, stage, event, n::bigint as n, page_no::int as page_no from (
              select e.run_date, 'page' as stage, event, 1 as n, e.page_no
              from page_event e join stops s on e.run_date = s.run_date and e.page_no = s.stop_page
              union all
              select run_date, 'offer', case when error is not null then 'timeout_error' else 'blocked_403' end, count(*), null
              from visited v left join blocks b using (run_date, page_no)
              where (block_pos is null or pos <= block_pos) and (error is not null or status = 403) group by 1, 2, 3
              union all select run_date, 'offer', 'missing_link', count(*), null from admitted where p_partkey % 5 >= 3 group by 1
              union all select run_date, 'offer', event, count(*), null from lacking group by run_date, event
              union all select run_date, 'clean', 'no_data', 1, null from runs where n_rows = 0
              union all select run_date, 'load', 'rows_loaded', n_rows, null from runs where n_rows > 0 and bad = 0
              union all select run_date, 'clean', 'failed', 1, null from runs where bad > 0
              union all select run_date, 'load', 'rows_quarantined', n_rows, null from runs where bad > 0)"""),
        "failed_offers": _with(f"{_PARTS},{_LACKING}", """
            select run_date, page_no::int as page_no, pos::int as pos, url,
              case when error is not null then 'timeout_error' else 'blocked_403' end as event
            from visited v left join blocks b using (run_date, page_no)
            where (block_pos is null or pos <= block_pos) and (error is not null or status = 403)
            union all select run_date, page_no, 3, null, 'missing_link' from admitted where p_partkey % 5 >= 3
            union all select run_date, page_no, pos, url, event from lacking"""),
    }
    # The counts of loads add up to those of the table.
    found |= {f"summary_{name}": found[name] for name in ("brand_share", "price_box", "price_histogram")}
    # Nor do the places of rows in the table.
    found["iqr_clock_arranged"] = found["iqr_clock"]
    # Nor does the order of sums change means and fits, at six digits.
    found |= {f"{name}_exact": found[name] for name in ("price_by_brand", "spec_means_by_model", "price_clock_fit")}
    # Tags of any length change nothing.
    return found | {f"{name}_long_tags": found[name] for name in ("grid_offer_links", "offer_extract")}
