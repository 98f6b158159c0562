"""Offers and crawl pages derived from the given tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.functions.html import Selector
from offerlens.operators.extract import GRID, GRID_ITEM, LINK_HOST, SPEC_ROWS, SPEC_TABLE
from offerlens.sources.ledger import LedgerTarget
from offerlens.sources.sinks import append_offers
from offerlens.schema import BRAND, CLOCK, DATE, MODEL, OFFER_COLUMNS, PRICE, RAM, SENTINEL

# Where the links of the ``pages`` table are.
NAV = Selector("nav")
NAV_ITEM = Selector("li")


def fill_cores(scan: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than there are cores, by row content.

    A small file of one row group is one task, whatever the work behind it. A
    large table has many splits and is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, F.xxhash64(*scan.columns))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns, or all, of a given table."""
    scan = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return fill_cores(scan.select(*columns) if columns else scan)


def _every(key: Column, *periods: int) -> Column:
    hit = key % periods[0] == 0
    for period in periods[1:]:
        hit = hit | (key % period == 0)
    return hit


def _with_comma(dollars: Column) -> Column:
    text = dollars.cast("string")
    grouped = F.concat(
        F.floor(dollars / 1000).cast("string"), F.lit(","), F.lpad((dollars % 1000).cast("string"), 3, "0")
    )
    return F.when(dollars >= 1000, grouped).otherwise(text)


def _keyed_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_size")
    sold = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "h", F.expr("l_orderkey * 7 + l_linenumber * 3 + l_partkey")
    )
    h, quantity, size = F.col("h"), F.col("l_quantity"), F.col("p_size")
    dollars = F.floor("l_extendedprice") * F.when(_every(h, 37), 12).otherwise(1)
    unknown = F.lit(SENTINEL)
    return sold.select(
        "h",
        F.when(_every(h, 29), unknown).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias(MODEL),
        F.when(_every(h, 23, 101), unknown).otherwise(F.concat(_with_comma(dollars), F.lit("."))).alias(PRICE),
        F.when(_every(h, 31, 101, 103), unknown).otherwise(F.col("p_brand")).alias(BRAND),
        F.when(_every(h, 11, 101, 103), unknown)
        .when(_every(h, 5), F.concat((size * 512).cast("string"), F.lit(" MB")))
        .otherwise(F.concat(size.cast("string"), F.lit(" GB")))
        .alias(RAM),
        F.when(_every(h, 7, 101, 103), unknown)
        .when(_every(h, 41), F.concat((quantity * 5000).cast("long").cast("string"), F.lit(" MHz")))
        .when(_every(h, 3), F.concat((quantity / 10).cast("string"), F.lit(" GHz")))
        .otherwise(F.concat((quantity * 100).cast("long").cast("string"), F.lit(" MHz")))
        .alias(CLOCK),
        F.col("l_shipdate").cast("date").alias(DATE),
    )


def offers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw offers; every tenth key occurs twice."""
    copies = F.when(_every(F.col("h"), 10), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return _keyed_offers(spark, sf_dir).withColumn("copy", F.explode(copies)).select(*OFFER_COLUMNS)


def _month(date: Column) -> Column:
    return F.trunc(date, "month")


def monthly_offers(raw: DataFrame) -> DataFrame:
    """The offers as batches of monthly runs."""
    return raw.withColumn(DATE, _month(F.col(DATE)))


def offers_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly batches; in the last month of a quarter a few cells cannot be parsed."""
    quarter_end = F.month(DATE) % 3 == 0

    def broken(period: int, text: str, name: str) -> Column:
        return F.when(quarter_end & _every(F.col("h"), period), F.lit(text)).otherwise(F.col(name)).alias(name)

    return _keyed_offers(spark, sf_dir).select(
        MODEL,
        broken(1013, "$1,299.", PRICE),
        BRAND,
        broken(1009, "8 GB GDDR6", RAM),
        broken(997, "1,800 MHz", CLOCK),
        _month(F.col(DATE)).alias(DATE),
    )


def nav_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as the listing pages of runs of 40; some fail."""
    page = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        F.date_add(F.lit("2023-01-01").cast("date"), F.floor(page / 40).cast("int")).alias("run_date"),
        (page % 40 + 1).cast("int").alias("page_no"),
        F.when(page % 41 == 40, 403).when(page % 59 == 58, 304).otherwise(200).alias("status"),
        F.when(page % 67 == 66, F.lit("timeout")).alias("error"),
        "html",
    )


def nav_offers(links: DataFrame) -> DataFrame:
    """The links of ``nav_pages`` as fetched offers; some are blocked or fail."""
    kind = (F.dayofyear("run_date") * 7 + F.col("page_no") * 31 + F.col("pos")) % 17
    return links.select(
        "run_date", "page_no", "pos", "url",
        F.when(kind == 0, 403).when(kind == 1, 500).otherwise(200).alias("status"),
        F.when(kind == 2, F.lit("connection")).alias("error"),
    )


def _tag(selector: Selector, inner: Column, quote: str = '"') -> Column:
    opening = f"<{selector.tag} class={quote}{selector.classes}{quote}>"
    return F.concat(F.lit(opening), inner, F.lit(f"</{selector.tag}>"))


def _href(run: Column, page: Column, pos: Column) -> Column:
    """On some pages the second offer has the address of the first."""
    shown = F.when((F.col("p_partkey") % 53 == 52) & (pos == 1), 0).otherwise(pos)
    return F.concat(F.lit("/dp/"), run.cast("string"), F.lit("-"), page.cast("string"), F.lit("?pos="), shown.cast("string"))


def _crawled_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part is a listing page; runs have 40 pages and pages one to five offers."""
    part = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    return part.select(
        "*",
        F.floor(F.col("p_partkey") / 40).cast("int").alias("run_no"),
        (F.col("p_partkey") % 40 + 1).cast("int").alias("page_no"),
        (F.col("p_partkey") % 5).cast("int").alias("last_pos"),
    ).withColumn("run_date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("run_no")))


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages in the real layout; the fourth offer of a page has no link."""
    key = F.col("p_partkey")

    def item(pos: Column) -> Column:
        link = F.concat(F.lit("<h2><a class=t title=\"RAM > 8 GB\" href='"), _href(F.col("run_no"), F.col("page_no"), pos), F.lit("&amp;s=1'>x</a></h2>"))
        body = F.concat(F.lit("<div><div>"), F.when(pos == 3, F.lit("sold out")).otherwise(link), F.lit("</div><a href='/help'>?</a></div>"))
        return _tag(GRID_ITEM, F.when(pos == 3, F.lit("<div>sold out</div>")).otherwise(body))

    items = F.array_join(F.transform(F.sequence(F.lit(0), F.col("last_pos")), item), "\n")
    grid = _tag(GRID, F.concat(F.lit("<!-- <div> -->"), items, F.lit("<div><a href='/next'>next</a></div>")))
    outside = _tag(GRID_ITEM, F.lit("<a href='/outside'>x</a>"))
    body = F.when(key % 89 == 88, F.lit("<p>robot check</p>")).otherwise(grid)
    return _crawled_parts(spark, sf_dir).select(
        "run_date",
        "page_no",
        F.when(key % 97 == 96, 403).when(key % 79 == 78, 304).otherwise(200).alias("status"),
        F.when(key % 83 == 82, F.lit("timeout")).alias("error"),
        F.concat(F.lit("<html><body><div class='nav'><a href='/'>home</a></div>"), body, outside, F.lit("</body></html>")).alias("html"),
    )


def part_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetched offer page of every link of ``part_pages``."""
    offers = _crawled_parts(spark, sf_dir).withColumn(
        "pos", F.explode(F.sequence(F.lit(0), F.col("last_pos")))
    ).withColumn("h", F.col("p_partkey") * 5 + F.col("pos"))
    h, pos, size = F.col("h"), F.col("pos"), F.col("p_size")
    dollars = F.floor("p_retailprice") + pos * 10
    price = F.concat(F.lit("<span class='a-price a-price-whole'>"), _with_comma(dollars), F.lit("<span class=d>.</span></span><span>99</span>"))
    values = {
        MODEL: F.concat(F.lit("<span title='a > b'> "), "p_name", F.lit(" &#0000000038; "), pos.cast("string"), F.lit(" </span>")),
        BRAND: F.col("p_brand"),
        RAM: F.when(h % 2 == 0, F.concat((size * 512).cast("string"), F.lit(" MB"))).otherwise(F.concat(size.cast("string"), F.lit("&nbsp;GB"))),
        CLOCK: F.when(h % 1201 == 1200, F.lit("1,800 MHz"))
        .when(h % 3 == 0, F.concat((size / 10).cast("string"), F.lit(" GHz")))
        .otherwise(F.concat((size * 100).cast("string"), F.lit(" MHz"))),
    }
    rows = [_spec_row(name, value, h) for name, value in values.items()]
    table_html = _tag(SPEC_TABLE, F.concat(F.lit("<tr class='x'><td>Brand</td><td>none</td></tr>"), *rows))
    decoy = F.lit("<!-- <table class='a-normal a-spacing-micro'></table> --><table class='a-normal'><tr></tr></table>")
    html = F.concat(
        F.lit("<html><body>"),
        F.when(h % 17 == 0, F.lit("")).otherwise(price),
        decoy,
        F.when(h % 19 == 0, F.lit("")).otherwise(table_html),
        F.lit("</body></html>"),
    )
    return offers.where(pos != 3).select(
        "run_date",
        "page_no",
        "pos",
        F.concat(F.lit(LINK_HOST), _href(F.col("run_no"), F.col("page_no"), pos), F.lit("&s=1")).alias("url"),
        F.when(h % 23 == 0, 403).when(h % 29 == 0, 500).otherwise(200).alias("status"),
        F.when(h % 31 == 0, F.lit("timeout")).alias("error"),
        html.alias("html"),
    )


def _spec_row(name: str, value: Column, h: Column) -> Column:
    row, label = SPEC_ROWS[name]
    shift = list(SPEC_ROWS).index(name)
    shown = F.when((h + shift) % 13 == 0, F.lit("Other")).otherwise(F.lit(label))
    ends = F.when(h % 2 == 0, F.lit("</td>")).otherwise(F.lit("\n"))
    cells = F.concat(F.lit("<td><b> "), shown, F.lit(" </b>"), ends, F.lit("<td>"), value, F.lit("</td>"))
    return F.when((h + shift) % 7 == 0, F.lit("")).otherwise(_tag(row, cells, "'"))


def with_long_tags(pages: DataFrame) -> DataFrame:
    """The pages of every tenth number with tags of some hundred thousand characters, as no browser minds."""
    attributes = F.concat(F.repeat(F.lit(" data-a='b>c' hidden"), 6000), F.lit(" title="), F.repeat(F.lit("x"), 100_000))
    # The short text first: each of the others is searched in what the one before has made.
    body = F.concat(F.lit("<body><div onclick="), F.repeat(F.lit("f(1)"), 5000), F.lit(">x</div>"))
    html = F.replace(F.col("html"), F.lit("<body>"), body)
    for selector in (GRID, SPEC_TABLE):
        opening = f"<{selector.tag} class="
        html = F.replace(html, F.lit(f"{opening}\"{selector.classes}"), F.concat(
            F.lit(f"<{selector.tag}"), attributes, F.lit(f" class=\"{selector.classes}")
        ))
    return pages.withColumn("html", F.when(F.col("page_no") % 10 == 0, html).otherwise(F.col("html")))


class BreakingTarget(LedgerTarget):
    """A ledger whose loads break off at one step, the first time that they get there."""

    def __init__(self, path: str, step: str):
        super().__init__(path)
        object.__setattr__(self, "steps", [step])

    def _break_at(self, step: str) -> None:
        if step in self.steps:
            self.steps.remove(step)
            raise ConnectionError(step)

    def write(self, batch, is_clean, load):
        if "table" in self.steps:  # not even half of the rows may show
            append_offers(batch.sample(0.5, 1), self.folder("table", load))
            self._break_at("table")
        self._break_at("quarantine" if not is_clean else "rows")
        return super().write(batch, is_clean, load)

    def publish(self, runs, version):
        self._break_at("entry")
        done = super().publish(runs, version)
        self._break_at("answer")
        return done
