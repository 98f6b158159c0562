"""Which stored pages and offers of a crawl count, and what the run report says.

A run reads its listing pages in order and stops at the first bad one. On a page
it reads the offers in order and leaves the page when the site blocks it.
Both stops are a minimum per group followed by a join, so no group of pages or
offers is ever gathered or sorted in one task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.elements import has_element
from offerlens.functions.html import Selector
from offerlens.operators.extract import GRID, grid_links

RUN = ["run_date"]
# The kinds of failed request, as stored in ``error``.
FETCH_ERRORS = ["connection", "timeout", "request"]
BLOCKED = [401, 403]


def _no_page() -> Column:
    return F.lit(None).cast("int").alias("page_no")


def in_window(pages: DataFrame, start: int = 1, count: int = 40) -> DataFrame:
    """The pages ``start`` to ``start + count - 1``."""
    return pages.where(F.col("page_no").between(start, start + count - 1))


def listing_window(pages: DataFrame, base_url: str, start: int = 1, count: int = 40) -> DataFrame:
    """The pages ``start`` to ``start + count - 1`` with their listing address."""
    chosen = in_window(pages, start, count)
    return chosen.withColumn("url", F.concat(F.lit(f"{base_url}&page="), F.col("page_no").cast("string")))


def answered() -> Column:
    """Response codes between 101 and 299."""
    return (F.col("status") > 100) & (F.col("status") < 300) & F.col("error").isNull()


def _fetch_error() -> Column:
    kind = F.when(F.col("error").isin(FETCH_ERRORS), F.col("error")).otherwise("request")
    return F.when(F.col("error").isNotNull(), F.concat(kind, F.lit("_error")))


def _stop_event(grid_found: Column) -> Column:
    refused = F.col("error").isNull() & (F.col("status") >= 400) & (F.col("status") < 600)
    return F.coalesce(
        _fetch_error(),
        F.when(refused, "request_error").when(answered() & ~grid_found, "no_grid"),
    )


def page_stop_event(grid: Selector = GRID) -> Column:
    """The event that ends a run at this page, NULL for a page that does not."""
    return _stop_event(has_element(F.col("html"), grid))


def read_listing(pages: DataFrame) -> DataFrame:
    """What a run needs of its listing pages: ``event`` and, of answered ones, the ``links``.

    Every page is cut once; the pages themselves go no further.
    """
    linked = grid_links(pages, [*RUN, "page_no", "status", "error"], F.when(answered(), F.col("html")))
    return linked.select(*RUN, "page_no", _stop_event(F.col("links").isNotNull()).alias("event"), "links")


def run_stops(pages: DataFrame, grid: Selector = GRID) -> DataFrame:
    """The page and event at which each run stopped; runs without a bad page are absent."""
    return first_stops(pages.select(*RUN, "page_no", page_stop_event(grid).alias("event")))


def first_stops(events: DataFrame) -> DataFrame:
    bad = events.where(F.col("event").isNotNull())
    first = bad.groupBy(*RUN).agg(F.min(F.struct("page_no", "event")).alias("stop"))
    return first.select(*RUN, F.col("stop.page_no").alias("stop_page"), F.col("stop.event").alias("event"))


def admit_pages(pages: DataFrame, stops: DataFrame) -> DataFrame:
    """The answered pages before the stop of their run, if it has one."""
    return before_stop(pages.where(answered()), stops)


def before_stop(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """The rows whose ``page_no`` lies before the stop of their run."""
    joined = rows.join(stops.select(*RUN, "stop_page"), RUN, "left")
    return joined.where(F.col("stop_page").isNull() | (F.col("page_no") < F.col("stop_page"))).drop("stop_page")


def page_blocks(offers: DataFrame) -> DataFrame:
    """The first blocked position of each page that has one."""
    blocked = offers.where(F.col("error").isNull() & F.col("status").isin(BLOCKED))
    return blocked.groupBy(*RUN, "page_no").agg(F.min("pos").alias("block_pos"))


def admit_offers(offers: DataFrame) -> DataFrame:
    """The answered offers in front of the first block of their page."""
    reached = offers.join(page_blocks(offers), [*RUN, "page_no"], "left")
    ahead = reached.where(F.col("block_pos").isNull() | (F.col("pos") < F.col("block_pos")))
    return ahead.drop("block_pos").where(answered())


def page_events(stops: DataFrame) -> DataFrame:
    """How the stopped runs ended, and at which page."""
    return stops.select(
        *RUN, F.lit("page").alias("stage"), "event", F.lit(1).cast("long").alias("n"), F.col("stop_page").alias("page_no")
    )


def failed_offers(offers: DataFrame) -> DataFrame:
    """Failed and blocked requests among the offers that were reached: ``page_no, pos, url, event``."""
    reached = offers.join(page_blocks(offers), [*RUN, "page_no"], "left").where(
        F.col("block_pos").isNull() | (F.col("pos") <= F.col("block_pos"))
    )
    blocked = F.when(F.col("status").isin(BLOCKED), F.concat(F.lit("blocked_"), F.col("status").cast("string")))
    event = F.coalesce(_fetch_error(), blocked)
    return reached.select(*RUN, "page_no", "pos", "url", event.alias("event")).where(F.col("event").isNotNull())


def missing_cells(admitted: DataFrame) -> DataFrame:
    """A row for each attribute that an admitted offer lacks: ``page_no, pos, url, event``."""
    lacking = admitted.where("has_specs").select(*RUN, "page_no", "pos", "url", F.explode("missing").alias("name"))
    return lacking.select(*RUN, "page_no", "pos", "url", F.concat(F.lit("missing_"), "name").alias("event"))


def offer_events(offers: DataFrame) -> DataFrame:
    """The failed and blocked requests of each run, counted."""
    return _counted(failed_offers(offers), "offer")


def unlinked_offers(listing: DataFrame, stops: DataFrame) -> DataFrame:
    """Offers of the admitted pages that have no link: ``page_no, pos, event``."""
    places = listing.where("links is not null").select(*RUN, "page_no", F.posexplode("links").alias("pos", "url"))
    return before_stop(places.where("url is null"), stops).select(
        *RUN, "page_no", "pos", F.lit("missing_link").alias("event")
    )


def lack_events(lacking: DataFrame) -> DataFrame:
    """The links and attributes that the offers of each run lack, counted."""
    return _counted(lacking, "offer")


def _counted(events: DataFrame, stage: str) -> DataFrame:
    return events.groupBy(*RUN, "event").agg(F.count(F.lit(1)).alias("n")).select(
        *RUN, F.lit(stage).alias("stage"), "event", "n", _no_page()
    )


def load_events(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """What cleaning and loading reported for every run.

    ``outcomes`` holds one row per run with data: ``n_rows``, ``is_clean`` and the ``target``
    that took the rows (``table``, ``quarantine`` or ``csv``).
    """
    joined = runs.join(outcomes, RUN, "left")
    one = F.lit(1).cast("long")

    def event(stage: str, name: str, n: Column) -> Column:
        return F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("event"), n.alias("n"))

    cleaned = F.when(F.col("n_rows").isNull(), event("clean", "no_data", one)).when(
        ~F.col("is_clean"), event("clean", "failed", one)
    )
    loaded = F.coalesce(*[
        F.when(F.col("target") == target, event("load", name, F.col("n_rows")))
        for target, name in (("table", "rows_loaded"), ("quarantine", "rows_quarantined"), ("csv", "rows_to_csv"))
    ])
    return joined.select(*RUN, F.inline(F.array_compact(F.array(cleaned, loaded))), _no_page())
