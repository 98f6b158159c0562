"""The registered queries: one per operator, over the whole given tables."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions import parse
from offerlens.operators import bootstrap, crawl, distribution, exact, extract, funnel, metrics
from offerlens.operators.clean import batch_verdict, clean_offers, stamp_date
from offerlens.operators.funnel import TOP_BRANDS, TOP_MODELS, Funnel
from offerlens.operators.heavy import heavy_keys
from offerlens.operators.summary import SummaryFunnel
from offerlens.operators.quantiles import exact_quantiles, value_counts
from offerlens.operators.radix import radix_quantiles
from offerlens.plans import etl
from offerlens.schema import BRAND, CLOCK, DATE, MODEL, OFFER, OFFER_COLUMNS, PRICE, RAM, RAW_OFFER
from offerlens.sources.ledger import LedgerTarget
from offerlens.sources.offers import read_offers
from offerlens.sources.sinks import QUARANTINE_SUFFIX, ParquetTarget, append_csv, append_offers
from offerlens.staging import new_stage_path, stage
from workload import fixtures

Query = Callable[[SparkSession, str], DataFrame]
_registered: dict[str, Query] = {}


def _query(build: Query) -> Query:
    _registered[build.__name__.removesuffix("_query")] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_registered)


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_offers(fixtures.offers_raw(spark, sf_dir))


def _stored_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis reads the offers from the table they were loaded into."""
    return stage(_offers(spark, sf_dir), "offers")


def _funnel(spark: SparkSession, sf_dir: str) -> Funnel:
    return Funnel(_stored_offers(spark, sf_dir))


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of stored offers: the filter would else parse every text by itself, once for each scan."""
    return funnel.min_present(funnel.drop_null_model(funnel.null_missing(_stored_offers(spark, sf_dir))))


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


# Sources


@_query
def listing_window(spark, sf_dir):
    pages = fixtures.nav_pages(spark, sf_dir).drop("html")
    return crawl.listing_window(pages, "https://shop.example/s?k=cards", start=3, count=20).select(
        "run_date", "page_no", "url"
    )


@_query
def crawl_prefix(spark, sf_dir):
    pages = fixtures.nav_pages(spark, sf_dir)
    stops = stage(crawl.run_stops(pages, fixtures.NAV), "run-stops")
    return crawl.admit_pages(pages, stops).select("run_date", "page_no", "status")


@_query
def crawl_prefix_grid(spark, sf_dir):
    pages = fixtures.part_pages(spark, sf_dir)
    return crawl.admit_pages(pages, stage(crawl.run_stops(pages), "run-stops")).select("run_date", "page_no", "status")


@_query
def offer_links(spark, sf_dir):
    pages = fixtures.table(spark, sf_dir, "pages")
    return extract.offer_links(pages, ["page_id"], fixtures.NAV, fixtures.NAV_ITEM)


@_query
def grid_offer_links(spark, sf_dir):
    pages = fixtures.part_pages(spark, sf_dir)
    return extract.offer_links(pages, crawl.RUN + ["page_no"])


@_query
def offer_admission(spark, sf_dir):
    pages = fixtures.nav_pages(spark, sf_dir)
    links = extract.offer_links(pages, crawl.RUN + ["page_no"], fixtures.NAV, fixtures.NAV_ITEM)
    offers = stage(fixtures.nav_offers(links), "nav-offers")
    return crawl.admit_offers(offers).select("run_date", "page_no", "pos", "url")


@_query
def offer_extract(spark, sf_dir):
    return extract.offer_attributes(fixtures.part_offers(spark, sf_dir), ["url"])


@_query
def grid_offer_links_long_tags(spark, sf_dir):
    pages = fixtures.with_long_tags(fixtures.part_pages(spark, sf_dir))
    return extract.offer_links(pages, crawl.RUN + ["page_no"])


@_query
def offer_extract_long_tags(spark, sf_dir):
    return extract.offer_attributes(fixtures.with_long_tags(fixtures.part_offers(spark, sf_dir)), ["url"])


@_query
def crawl_raw_offers(spark, sf_dir):
    return etl.Crawl.read(fixtures.part_pages(spark, sf_dir), fixtures.part_offers(spark, sf_dir)).raw_offers()


@_query
def crawl_window_offers(spark, sf_dir):
    """All runs, but of each only the pages 3 to 22."""
    pages = crawl.in_window(fixtures.part_pages(spark, sf_dir), 3, 20)
    return etl.Crawl.read(pages, fixtures.part_offers(spark, sf_dir)).raw_offers()


@_query
def scan_project(spark, sf_dir):
    path = new_stage_path(spark, "offers")
    _offers(spark, sf_dir).withColumn("extra", F.lit(1)).write.parquet(path)
    return read_offers(spark, path)


# Scalar expressions


@_query
def clean_price(spark, sf_dir):
    return fixtures.offers_raw(spark, sf_dir).select(
        F.col(PRICE).alias("text"), parse.price_usd(F.col(PRICE)).alias(PRICE)
    )


@_query
def clean_clock(spark, sf_dir):
    return fixtures.offers_raw(spark, sf_dir).select(
        F.col(CLOCK).alias("text"), parse.clock_mhz(F.col(CLOCK)).alias(CLOCK)
    )


@_query
def clean_ram(spark, sf_dir):
    return fixtures.offers_raw(spark, sf_dir).select(F.col(RAM).alias("text"), parse.ram_gb(F.col(RAM)).alias(RAM))


@_query
def sentinel_to_null(spark, sf_dir):
    raw = fixtures.offers_raw(spark, sf_dir)
    return raw.select(*[parse.sentinel_to_null(F.col(c)).alias(c) for c in OFFER_COLUMNS if c != DATE])


@_query
def trim_strings(spark, sf_dir):
    return fixtures.offers_raw(spark, sf_dir).select(*[parse.trim(F.col(c)).alias(c) for c in (MODEL, BRAND)])


@_query
def clean_offers_query(spark, sf_dir):
    return _offers(spark, sf_dir)


@_query
def usd_per_gb(spark, sf_dir):
    return _rounded(metrics.usd_per_gb(_funnel(spark, sf_dir).unique()), 6, "usd_per_gb")


@_query
def usd_per_100mhz(spark, sf_dir):
    return _rounded(metrics.usd_per_100mhz(_funnel(spark, sf_dir).unique()), 6, "usd_per_100mhz")


def _categorised(made: Funnel) -> DataFrame:
    return distribution.with_clock_category(made.unique(), distribution.value_range(made.weighted(), CLOCK))


@_query
def clock_category(spark, sf_dir):
    return _categorised(_funnel(spark, sf_dir)).select(*OFFER_COLUMNS, "category_no", "category")


# Filters and semi-joins


@_query
def drop_null_model(spark, sf_dir):
    return funnel.drop_null_model(funnel.null_missing(_stored_offers(spark, sf_dir)))


@_query
def min_nonnull(spark, sf_dir):
    return _eligible(spark, sf_dir)


@_query
def top_brands_semi(spark, sf_dir):
    return _funnel(spark, sf_dir).of_top_brands()


@_query
def top_models_semi(spark, sf_dir):
    return _funnel(spark, sf_dir).of_top_models()


@_query
def iqr_price(spark, sf_dir):
    return _funnel(spark, sf_dir).inside_price()


@_query
def iqr_clock(spark, sf_dir):
    return _funnel(spark, sf_dir).rows()


@_query
def iqr_clock_arranged(spark, sf_dir):
    """The funnel over a table stored along the curve of price and clock."""
    target = ParquetTarget(new_stage_path(spark, "arranged"), arranged=True)
    target.append(_offers(spark, sf_dir), clean=True, one_date=False)
    return Funnel(target.read(spark)).rows()


@_query
def iqr_events(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events", "event_id", "value")
    return events.where(funnel.Fence(*exact_quantiles(events, "value", [0.25, 0.75])).holds("value"))


# Aggregations


@_query
def brand_counts(spark, sf_dir):
    return funnel.key_counts(_eligible(spark, sf_dir), BRAND)


@_query
def model_counts(spark, sf_dir):
    return funnel.key_counts(_funnel(spark, sf_dir).of_top_brands(), MODEL)


@_query
def quartiles(spark, sf_dir):
    made = _funnel(spark, sf_dir)
    fences = [("price", made.price_fence), ("clock", made.clock_fence)]
    return spark.createDataFrame([(name, f.q1, f.q3) for name, f in fences], "name string, q1 double, q3 double")


_PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@_query
def extended_price_quantiles(spark, sf_dir):
    """Radix selection over the rows of a table with many distinct values."""
    lines = fixtures.table(spark, sf_dir, "lineitem").withColumn("value", F.col("l_extendedprice").cast("double"))
    found = radix_quantiles(lines, "value", _PROBABILITIES)
    return _rounded(spark.createDataFrame(list(zip(_PROBABILITIES, found, strict=True)), "p double, value double"), 6, "value")


@_query
def quartiles_radix(spark, sf_dir):
    """Of clean prices and clocks before the funnel, by radix selection."""
    offers = _stored_offers(spark, sf_dir)
    rows = [(name, *radix_quantiles(offers, column, [0.25, 0.75])) for name, column in (("price", PRICE), ("clock", CLOCK))]
    return spark.createDataFrame(rows, "name string, q1 double, q3 double")


def _ranked(spark: SparkSession, found: list, key: str) -> DataFrame:
    return spark.createDataFrame(found, f"{key}, n long")


@_query
def top_brands_heavy(spark, sf_dir):
    """The top brands, and below those among their offers the top models, from bucket counts and candidates."""
    return _ranked(spark, heavy_keys(_eligible(spark, sf_dir), BRAND, TOP_BRANDS), f"{BRAND} string")


@_query
def top_models_heavy(spark, sf_dir):
    eligible = _eligible(spark, sf_dir)
    brands = [brand for brand, _ in heavy_keys(eligible, BRAND, TOP_BRANDS)]
    return _ranked(spark, heavy_keys(eligible.where(F.col(BRAND).isin(brands)), MODEL, TOP_MODELS), f"{MODEL} string")


@_query
def top_parts_heavy(spark, sf_dir):
    """Keys of about equal frequency with many ties."""
    return _ranked(spark, heavy_keys(fixtures.table(spark, sf_dir, "lineitem"), "l_partkey", 100), "l_partkey long")


@_query
def price_by_model(spark, sf_dir):
    return _rounded(metrics.mean_price_by_model(_funnel(spark, sf_dir).unique()), 6, "price")


@_query
def price_by_brand(spark, sf_dir):
    return _rounded(metrics.mean_price_by_brand(_funnel(spark, sf_dir).unique()), 6, "price")


@_query
def spec_means_by_model(spark, sf_dir):
    return _rounded(metrics.spec_means_by_model(_funnel(spark, sf_dir).unique()), 6, "price", "ram", "clock")


@_query
def dedup_offers(spark, sf_dir):
    return _funnel(spark, sf_dir).unique()


@_query
def brand_share(spark, sf_dir):
    return _rounded(metrics.brand_share(_funnel(spark, sf_dir).weighted()), 1, "percent")


@_query
def price_clock_fit(spark, sf_dir):
    fit = distribution.price_clock_fit(_funnel(spark, sf_dir).unique())
    return _rounded(fit, 6, "slope", "intercept", "r2")


@_query
def price_by_model_exact(spark, sf_dir):
    """Sums that no order of rows changes: equal to the last bit."""
    return exact.mean_price_by_model(_funnel(spark, sf_dir).unique())


@_query
def price_by_brand_exact(spark, sf_dir):
    return _rounded(exact.mean_price_by_brand(_funnel(spark, sf_dir).unique()), 6, "price")


@_query
def spec_means_by_model_exact(spark, sf_dir):
    return _rounded(exact.spec_means_by_model(_funnel(spark, sf_dir).unique()), 6, "price", "ram", "clock")


@_query
def price_clock_fit_exact(spark, sf_dir):
    unique = stage(_funnel(spark, sf_dir).unique(), "unique")
    return _rounded(exact.price_clock_fit(unique), 6, "slope", "intercept", "r2")


@_query
def price_clock_band(spark, sf_dir):
    band = bootstrap.price_clock_band(_funnel(spark, sf_dir).unique())
    return _rounded(band, 4, "clock", "fit", "low", "high")


@_query
def price_clock_band_multinomial(spark, sf_dir):
    """The band with exactly n of n rows drawn."""
    band = bootstrap.price_clock_band(_funnel(spark, sf_dir).unique(), draws="multinomial")
    return _rounded(band, 4, "clock", "fit", "low", "high")


@_query
def price_by_category(spark, sf_dir):
    return _rounded(distribution.mean_price_by_category(_categorised(_funnel(spark, sf_dir))), 6, "price")


@_query
def price_by_category_ci(spark, sf_dir):
    means = bootstrap.price_by_category_ci(_categorised(_funnel(spark, sf_dir)))
    return _rounded(means, 4, "price", "low", "high")


@_query
def price_by_category_ci_multinomial(spark, sf_dir):
    means = bootstrap.price_by_category_ci(_categorised(_funnel(spark, sf_dir)), draws="multinomial")
    return _rounded(means, 4, "price", "low", "high")


@_query
def price_box(spark, sf_dir):
    return distribution.box_stats(_funnel(spark, sf_dir).weighted())


@_query
def price_box_outliers(spark, sf_dir):
    return distribution.box_outliers(_funnel(spark, sf_dir).weighted())


@_query
def events_box_outliers(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events", "value")
    return distribution.box_outliers(stage(value_counts(events, "value"), "event-values"), "value")


@_query
def value_mean_ci(spark, sf_dir):
    """Large cells: some hundred rows and more share each quantity."""
    items = fixtures.table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity")
    values = items.withColumn("l_quantity", F.col("l_quantity").cast("double"))
    return _rounded(bootstrap.group_mean_ci(values, "l_returnflag", "l_quantity"), 6, "mean", "low", "high")


@_query
def value_mean_ci_multinomial(spark, sf_dir):
    items = fixtures.table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity")
    values = items.withColumn("l_quantity", F.col("l_quantity").cast("double"))
    found = bootstrap.group_mean_ci(values, "l_returnflag", "l_quantity", draws="multinomial")
    return _rounded(found, 6, "mean", "low", "high")


@_query
def price_histogram(spark, sf_dir):
    return _rounded(distribution.histogram(_funnel(spark, sf_dir).weighted()), 6, "bin_low", "bin_high")


@_query
def price_kde(spark, sf_dir):
    curve = distribution.density(_funnel(spark, sf_dir).weighted())
    return _rounded(_rounded(curve, 6, "x", "count_scaled"), 12, "density")


@_query
def extended_price_kde(spark, sf_dir):
    """Many distinct values: they meet the grid in cells."""
    items = fixtures.table(spark, sf_dir, "lineitem", "l_extendedprice")
    prices = items.select(F.col("l_extendedprice").cast("double").alias(PRICE), F.lit(1).cast("long").alias("n"))
    curve = distribution.density(prices)
    return _rounded(_rounded(_rounded(curve, 6, "x"), 3, "count_scaled"), 12, "density")


@_query
def funnel_counts(spark, sf_dir):
    return _funnel(spark, sf_dir).counts()


# Loading, routing and reporting


def _by_date(offers: DataFrame) -> DataFrame:
    return offers.groupBy(DATE).agg(F.count(F.lit(1)).alias("n"), F.sum(PRICE).alias("price_sum"))


@_query
def load_clean_count(spark, sf_dir):
    path = new_stage_path(spark, "offers")
    append_offers(clean_offers(fixtures.monthly_offers(fixtures.offers_raw(spark, sf_dir))), path)
    return _by_date(read_offers(spark, path))


@_query
def append_batches(spark, sf_dir):
    """Two appended batches accumulate, also where they hold equal rows."""
    path = new_stage_path(spark, "offers")
    for run_date in ("2023-01-01", "2023-02-01", "2023-02-01"):
        append_offers(stamp_date(_offers(spark, sf_dir), run_date), path, one_date=True)
    return _by_date(read_offers(spark, path))


@_query
def load_csv_fallback(spark, sf_dir):
    path = new_stage_path(spark, "offers-csv")
    append_csv(_offers(spark, sf_dir), path)
    return read_offers(spark, path, "csv")


def _no_table(spark: SparkSession) -> ParquetTarget:
    """A target whose table cannot be written: its parent is a file."""
    file = stage(spark.range(1), "no-folder").inputFiles()[0]
    return ParquetTarget(f"{file}/offers", new_stage_path(spark, "fallback"))


@_query
def load_csv_raw(spark, sf_dir):
    """Raw texts with padding, quotes and line breaks through a load that fails."""
    model = F.concat(F.lit(' "'), F.coalesce(MODEL, F.lit("")), F.lit('",\n '))
    raw = fixtures.offers_raw(spark, sf_dir).withColumn(MODEL, model)
    spoiled = raw.unionByName(raw.limit(1).withColumn(PRICE, F.lit("$1")))
    target = _no_table(spark)
    etl.load_batch(stage(spoiled, "raw-texts"), target)
    return read_offers(spark, target.csv_folder(False), "csv", RAW_OFFER).where(~F.col(PRICE).eqNullSafe("$1"))


@_query
def batch_verdict_query(spark, sf_dir):
    return batch_verdict(fixtures.offers_dirty(spark, sf_dir), [DATE])


@_query
def load_routing(spark, sf_dir):
    """Rows that reach the offer table and the quarantine table."""
    path = new_stage_path(spark, "offers")
    etl.load_runs(fixtures.offers_dirty(spark, sf_dir), path)
    targets = [("table", path, OFFER), ("quarantine", f"{path}{QUARANTINE_SUFFIX}", RAW_OFFER)]
    counted = [
        read_offers(spark, where, schema=schema).agg(
            F.lit(name).alias("target"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct(DATE).alias("n_batches")
        )
        for name, where, schema in targets
    ]
    return counted[0].unionByName(counted[1])


#: Where the loads of ``publish_after_failures`` break off; "csv" has no table to write to.
BREAKS = ["rows", "table", "quarantine", "entry", "answer", "csv"]


@_query
def publish_after_failures(spark, sf_dir):
    """Every run once, in one target: a load for each step that can fail, tried until it ends."""
    raw = stage(fixtures.offers_dirty(spark, sf_dir), "raw-offers")
    path = new_stage_path(spark, "ledger")
    for number, step in enumerate(BREAKS):
        batch = raw.where(F.month(DATE) % len(BREAKS) == number)
        target = fixtures.BreakingTarget(path, step)
        if step == "csv":
            no_table = stage(spark.range(1), "no-folder").inputFiles()[0]
            target = LedgerTarget(f"{no_table}/offers", f"{path}/fallback", f"{path}/ledger")
        for _ in range(3):  # the last one finds all its runs in the ledger
            try:
                etl.publish_runs(batch, target)
            except ConnectionError:
                continue
    whole = LedgerTarget(path, f"{path}/fallback")
    kinds = [("table", True), ("quarantine", False), ("csv", True), ("csv", False)]
    shown = [whole.read(spark, kind, clean).select(F.lit(kind).alias("target"), DATE) for kind, clean in kinds]
    return reduce(DataFrame.unionByName, shown).groupBy(DATE, "target").agg(F.count(F.lit(1)).alias("n_rows"))


def _summary_funnel(spark: SparkSession, sf_dir: str) -> SummaryFunnel:
    """The funnel from the counts of loads that came in three parts, the latest months first."""
    raw = stage(fixtures.monthly_offers(fixtures.offers_raw(spark, sf_dir)), "raw-offers")
    target = LedgerTarget(new_stage_path(spark, "ledger"))
    for part in (2, 0, 1):
        fallen = etl.publish_runs(raw.where(F.month(DATE) % 3 == part), target).where("target = 'csv'").count()
        if fallen:
            raise RuntimeError(f"the table did not take {fallen} runs, so the counts lack them")
    return SummaryFunnel(*target.counts(spark))


@_query
def summary_funnel_counts(spark, sf_dir):
    return _summary_funnel(spark, sf_dir).counts()


@_query
def summary_brand_share(spark, sf_dir):
    return _rounded(metrics.brand_share(_summary_funnel(spark, sf_dir).weighted()), 1, "percent")


@_query
def summary_price_box(spark, sf_dir):
    return distribution.box_stats(_summary_funnel(spark, sf_dir).weighted())


@_query
def summary_price_histogram(spark, sf_dir):
    return _rounded(distribution.histogram(_summary_funnel(spark, sf_dir).weighted()), 6, "bin_low", "bin_high")


def _part_crawl(spark, sf_dir):
    pages = fixtures.part_pages(spark, sf_dir)
    return etl.Crawl.read(pages, fixtures.part_offers(spark, sf_dir)), pages.select(*crawl.RUN).distinct()


@_query
def run_report(spark, sf_dir):
    made, runs = _part_crawl(spark, sf_dir)
    return etl.crawl_report(made, runs, etl.load_runs(made.raw_offers(), new_stage_path(spark, "offers")))


@_query
def failed_offers(spark, sf_dir):
    """The offers behind the counts of the report."""
    return _part_crawl(spark, sf_dir)[0].failures()


@_query
def run_report_csv(spark, sf_dir):
    """Cleaning and loading where no table takes the rows."""
    made, runs = _part_crawl(spark, sf_dir)
    return crawl.load_events(runs, etl.load_runs(made.raw_offers(), _no_table(spark)))


@_query
def empty_batch(spark, sf_dir):
    """All offers are blocked: nothing is written, and every run reports it."""
    pages = fixtures.part_pages(spark, sf_dir)
    blocked = fixtures.part_offers(spark, sf_dir).withColumns({"status": F.lit(403), "error": F.lit(None).cast("string")})
    raw = etl.Crawl.read(pages, blocked).raw_offers()
    return crawl.load_events(pages.select(*crawl.RUN).distinct(), etl.load_runs(raw, new_stage_path(spark, "offers")))


def _crawled_funnel(spark: SparkSession, sf_dir: str) -> Funnel:
    """Stored pages to the offer table, and the analysis of what was loaded."""
    path = new_stage_path(spark, "offers")
    crawled = etl.Crawl.read(fixtures.part_pages(spark, sf_dir), fixtures.part_offers(spark, sf_dir))
    etl.load_runs(crawled.raw_offers(), path)
    return Funnel(read_offers(spark, path))


@_query
def crawl_to_price_by_model(spark, sf_dir):
    return _rounded(metrics.mean_price_by_model(_crawled_funnel(spark, sf_dir).unique()), 6, "price")


@_query
def crawl_to_funnel_counts(spark, sf_dir):
    return _crawled_funnel(spark, sf_dir).counts()


@_query
def pipeline_to_dashboard(spark, sf_dir):
    """Stored pages to the offer table, and a series of the dashboard over it."""
    return _rounded(metrics.mean_price_by_brand(_crawled_funnel(spark, sf_dir).unique()), 6, "price")
