from datetime import date

from pyspark.sql import functions as F

from offerlens.operators import crawl
from offerlens.operators.extract import GRID
from offerlens.schema import CRAWL_PAGE

DAY, NEXT = date(2023, 1, 1), date(2023, 2, 1)
OK = f'<div class="{GRID.classes}"></div>'
OFFERS = "run_date date, page_no int, pos int, url string, status int, error string"


def pages(spark, rows, day=DAY):
    return spark.createDataFrame([(day, n, s, e, h) for n, s, e, h in rows], CRAWL_PAGE)


def admitted(frame):
    rows = crawl.admit_pages(frame, crawl.run_stops(frame)).orderBy("run_date", "page_no").collect()
    return [r["page_no"] for r in rows]


def test_run_stops_at_the_first_bad_page(spark):
    for bad, event in [
        ((3, 403, None, OK), "request_error"),
        ((3, 500, None, OK), "request_error"),
        ((3, None, "timeout", None), "timeout_error"),
        ((3, None, "connection", None), "connection_error"),
        ((3, None, "ssl", None), "request_error"),
        ((3, 200, None, "<p>robot check</p>"), "no_grid"),
        ((3, 200, None, None), "no_grid"),
    ]:
        frame = pages(spark, [(1, 200, None, OK), (2, 200, None, OK), bad, (4, 200, None, OK), (5, 500, None, OK)])
        assert admitted(frame) == [1, 2]
        stop = crawl.run_stops(frame).first()
        assert (stop["stop_page"], stop["event"]) == (3, event)


def test_other_answers_are_skipped_without_a_stop(spark):
    frame = pages(spark, [(1, 304, None, OK), (2, 100, None, ""), (3, 200, None, OK), (4, 600, None, "")])
    assert admitted(frame) == [3]
    assert crawl.run_stops(frame).count() == 0


def test_runs_do_not_stop_each_other(spark):
    frame = pages(spark, [(1, 403, None, OK), (2, 200, None, OK)]).unionByName(pages(spark, [(1, 200, None, OK)], NEXT))
    rows = crawl.admit_pages(frame, crawl.run_stops(frame)).collect()
    assert [(r["run_date"], r["page_no"]) for r in rows] == [(NEXT, 1)]


def test_listing_window_and_address(spark):
    frame = pages(spark, [(n, 200, None, OK) for n in range(1, 8)])
    rows = crawl.listing_window(frame, "https://shop.example/s?k=1", start=2, count=3).orderBy("page_no").collect()
    assert [r["url"] for r in rows] == [f"https://shop.example/s?k=1&page={n}" for n in (2, 3, 4)]


def offer_rows(spark, rows):
    return spark.createDataFrame([(DAY, p, i, f"/{p}/{i}", s, e) for p, i, s, e in rows], OFFERS)


def test_a_block_drops_the_rest_of_its_page_only(spark):
    frame = offer_rows(spark, [
        (1, 0, 200, None), (1, 1, 500, None), (1, 2, 200, None), (1, 3, 403, None), (1, 4, 200, None), (1, 5, None, "timeout"),
        (2, 0, 401, None), (2, 1, 200, None),
        (3, 0, None, "connection"), (3, 1, 304, None), (3, 2, 204, None),
    ])
    kept = crawl.admit_offers(frame).orderBy("page_no", "pos").collect()
    assert [(r["page_no"], r["pos"]) for r in kept] == [(1, 0), (1, 2), (3, 2)]
    events = {(r["stage"], r["event"]): r["n"] for r in crawl.offer_events(frame).collect()}
    # what lies behind a block was never fetched; an error status alone is not reported
    assert events == {("offer", "blocked_403"): 1, ("offer", "blocked_401"): 1, ("offer", "connection_error"): 1}


def test_load_events(spark):
    days = [date(2023, 1, d) for d in (1, 2, 3)]
    runs = spark.createDataFrame([(d,) for d in days], "run_date date")
    outcomes = spark.createDataFrame(
        [(days[0], 5, True, "table"), (days[1], 4, False, "quarantine")],
        "run_date date, n_rows long, is_clean boolean, target string",
    )
    events = crawl.load_events(runs, outcomes).select(F.dayofmonth("run_date"), "stage", "event", "n").collect()
    assert sorted(tuple(e) for e in events) == [
        (1, "load", "rows_loaded", 5),
        (2, "clean", "failed", 1),
        (2, "load", "rows_quarantined", 4),
        (3, "clean", "no_data", 1),
    ]
