"""One run of the pipeline: stored crawl pages to loaded offers and a report."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.operators.clean import batch_verdict, clean_offers
from offerlens.operators.crawl import (
    RUN,
    admit_offers,
    answered,
    before_stop,
    failed_offers,
    first_stops,
    in_window,
    lack_events,
    load_events,
    missing_cells,
    offer_events,
    page_events,
    read_listing,
    unlinked_offers,
)
from offerlens.operators.extract import read_offer_pages
from offerlens.plans.dashboard import dashboard, save_dashboard
from offerlens.schema import DATE, OFFER_COLUMNS, RUN_REPORT
from offerlens.sources.ledger import LedgerTarget, fresh, new_load
from offerlens.sources.sinks import Target, append_csv, target_of
from offerlens.staging import drop_stage, stage, stage_scope


def visited_offers(listing: DataFrame, stops: DataFrame, fetched: DataFrame) -> DataFrame:
    """The offers behind the links of the admitted listing pages, already read.

    Links and attributes are extracted where the pages lie, so that the joins move
    a few short columns per offer and no page.
    """
    page = [*RUN, "page_no"]
    places = listing.where("links is not null").select(*page, F.posexplode("links").alias("pos", "url"))
    links = before_stop(places.where("url is not null"), stops)
    body = F.when(answered(), F.col("html")).alias("html")
    answers = fetched.select(*page, "pos", "status", "error", body)
    offers = read_offer_pages(answers, [*page, "pos", "status", "error"])
    return links.join(offers, [*page, "pos"])


@dataclass(frozen=True)
class Crawl:
    """A stored crawl with its frames that more than one step reads, staged."""

    stops: DataFrame
    visited: DataFrame
    unlinked: DataFrame

    @classmethod
    def read(cls, pages: DataFrame, fetched: DataFrame) -> "Crawl":
        """Every listing page and every offer page is read once."""
        listing = stage(read_listing(pages), "listing")
        stops = stage(first_stops(listing), "run-stops")
        visited = stage(visited_offers(listing, stops, fetched), "visited")
        crawl = cls(stops, visited, stage(unlinked_offers(listing, stops), "unlinked"))
        drop_stage(listing)
        return crawl

    def raw_offers(self) -> DataFrame:
        """The raw offers of all runs, each stamped with its run date."""
        offers = admit_offers(self.visited).where("has_specs")
        return offers.withColumnRenamed("run_date", DATE).select(*OFFER_COLUMNS)

    def lacking(self) -> DataFrame:
        """What is missing of single offers: links, and attributes of pages that were read."""
        cells = missing_cells(admit_offers(self.visited))
        return cells.unionByName(self.unlinked, allowMissingColumns=True)

    def events(self) -> DataFrame:
        """Events of pages and offers, as ``RUN_REPORT``."""
        offers = offer_events(self.visited).unionByName(lack_events(self.lacking()))
        return page_events(self.stops).unionByName(offers)

    def failures(self) -> DataFrame:
        """The single offers behind the counts of ``events``, with their page, place and address."""
        return failed_offers(self.visited).unionByName(self.lacking())


def crawl_report(crawl: Crawl, runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Events of every run from its pages, offers, cleaning and loading."""
    return crawl.events().unionByName(load_events(runs, outcomes))


@dataclass(frozen=True)
class LoadResult:
    """Where a batch went: ``table``, ``quarantine``, ``csv``, ``nothing``, or ``ledger`` if it was there before."""

    target: str
    rows: int
    error: str = ""
    is_clean: bool = True


def load_batch(raw: DataFrame, where: str | Target | LedgerTarget) -> LoadResult:
    """Clean and append one batch, whole or not at all.

    One cell that cannot be parsed sends the raw batch to the quarantine table. A
    batch that cannot be written to its table goes to the CSV fallback. ``raw`` is
    read twice, so pass a stored or staged frame. With a ledger a batch of one date is
    loaded once, however often it is tried.
    """
    if isinstance(where, LedgerTarget):
        row = publish_runs(raw, where).first()  # a batch has one date
        if row is None:
            return LoadResult("nothing" if raw.isEmpty() else "ledger", 0)
        return LoadResult(row["target"], row["n_rows"], is_clean=row["is_clean"])
    verdict = batch_verdict(raw).first()
    rows, clean = verdict["n_rows"], verdict["is_clean"]
    if rows == 0:
        return LoadResult("nothing", 0)
    error = _append(clean_offers(raw) if clean else raw, target_of(where), clean, one_date=True)
    return LoadResult("csv" if error else "table" if clean else "quarantine", rows, error, clean)


def load_runs(raw: DataFrame, where: str | Target) -> DataFrame:
    """Append many runs at once, each judged as its own batch by its date.

    Returns what became of every run with rows: ``run_date, n_rows, is_clean, target``.
    """
    target = target_of(where)
    raw = stage(raw, "raw-runs")
    verdicts = stage(batch_verdict(raw, [DATE]).withColumnRenamed(DATE, "batch"), "verdicts")
    judged = raw.join(verdicts.select("batch", "is_clean"), F.col(DATE).eqNullSafe(F.col("batch")))
    took = {}
    for clean in (row["is_clean"] for row in verdicts.select("is_clean").distinct().collect()):  # two rows at most
        batch = judged.where(F.col("is_clean") == clean)
        error = _append(clean_offers(batch) if clean else batch, target, clean, one_date=False)
        took[clean] = "csv" if error else "table" if clean else "quarantine"
    drop_stage(raw)
    place = F.when(F.col("is_clean"), F.lit(took.get(True))).otherwise(F.lit(took.get(False)))
    return verdicts.select(F.col("batch").alias("run_date"), "n_rows", "is_clean", place.cast("string").alias("target"))


def publish_runs(raw: DataFrame, target: LedgerTarget, accumulate: bool = False) -> DataFrame:
    """Load many runs at once through a ledger: all become visible together, or none.

    Runs that the ledger names are left out, unless they shall ``accumulate``. Returns what
    became of the runs of this load: ``run_date, n_rows, is_clean, target``.
    """
    spark = raw.sparkSession
    raw = stage(raw, "raw-runs")
    while True:
        version, load = target.version(spark), new_load()
        ours = raw if accumulate else fresh(raw, target.published(spark, version))
        verdicts = stage(batch_verdict(ours, [DATE]).withColumnRenamed(DATE, "run_date"), "verdicts")
        judged = ours.join(verdicts.select("run_date", "is_clean"), F.col(DATE).eqNullSafe(F.col("run_date")))
        place = F.lit(None).cast("string")
        for clean in (row["is_clean"] for row in verdicts.select("is_clean").distinct().collect()):  # two rows at most
            batch = judged.where(F.col("is_clean") == clean)
            kind = target.write(clean_offers(batch) if clean else batch.select(*OFFER_COLUMNS), clean, load)
            place = F.when(F.col("is_clean") == clean, F.lit(kind)).otherwise(place)
        runs = verdicts.select("run_date", "n_rows", "is_clean", place.alias("target"), F.lit(load).alias("load"))
        # Another load may have been published meanwhile; then its runs are looked at again.
        if runs.isEmpty() or target.publish(runs, version + 1):
            drop_stage(raw)
            return runs.drop("load")


def _append(batch: DataFrame, target: Target, clean: bool, one_date: bool) -> str:
    """Append to the table or to quarantine; to the CSV fallback, with the error, if that fails."""
    try:
        target.append(batch, clean, one_date)
    except Exception as failure:  # whatever keeps the table from taking the batch
        append_csv(batch, target.csv_folder(clean))
        return str(failure)
    return ""


def run_report(result: LoadResult, run_date: str, spark: SparkSession) -> DataFrame:
    """The load part of the report of a single run."""
    events = {
        "nothing": [("clean", "no_data", 1)],
        "table": [("load", "rows_loaded", result.rows)],
        "quarantine": [("load", "rows_quarantined", result.rows)],
        "csv": [("load", "rows_to_csv", result.rows)],
        "ledger": [("load", "loaded_before", 1)],
    }[result.target]
    if not result.is_clean:
        events.insert(0, ("clean", "failed", 1))
    frame = spark.createDataFrame(events, "stage string, event string, n long")
    named = frame.select(F.lit(run_date).cast("date").alias("run_date"), "stage", "event", "n")
    return named.withColumn("page_no", F.lit(None).cast("int")).to(RUN_REPORT)


def run_etl(
    pages: DataFrame, fetched: DataFrame, where: str | Target | LedgerTarget, run_date: str, start: int = 1, count: int = 40
) -> tuple[LoadResult, DataFrame]:
    """Extract, clean and load one run of a store of crawls, its listing pages from ``start`` on.

    Returns where the run went and its report.
    """
    mine = F.col("run_date") == F.lit(run_date).cast("date")
    crawl = Crawl.read(in_window(pages.where(mine), start, count), fetched.where(mine))
    raw = stage(crawl.raw_offers(), "raw-offers")
    result = load_batch(raw, where)
    drop_stage(raw)
    return result, crawl.events().unionByName(run_report(result, run_date, raw.sparkSession))


def run_all(
    pages: DataFrame, fetched: DataFrame, where: str | Target | LedgerTarget, run_date: str, folder: str, start: int = 1, count: int = 40
) -> LoadResult:
    """Load one run, then save its report and the dashboard of the whole table below ``folder``."""
    spark = pages.sparkSession
    with stage_scope(spark):
        result, report = run_etl(pages, fetched, where, run_date, start, count)
        report.write.mode("append").parquet(f"{folder}/report")
        target = where if isinstance(where, LedgerTarget) else target_of(where)
        save_dashboard(dashboard(target.read(spark)), folder)
    return result
