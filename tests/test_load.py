from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from offerlens.operators.clean import batch_verdict, clean_offers, stamp_date
from offerlens.operators.extract import GRID, GRID_ITEM, LINK_HOST, SPEC_ROWS, SPEC_TABLE
from offerlens.plans import etl
from offerlens.plans.dashboard import dashboard, save_dashboard
from offerlens.schema import BRAND, CLOCK, CRAWL_PAGE, DATE, FETCHED_OFFER, MODEL, OFFER_COLUMNS, RAM, RAW_OFFER
from offerlens.sources.offers import read_offers
from offerlens.sources.sinks import MOST_FOLDERS, ParquetTarget, append_csv, append_offers
from offerlens.staging import drop_stages, stage, stage_root

GOOD = [("A ", "1,299.", " b", "8 GB", "1.8 GHz"), ("unknown", "unknown", "unknown", "unknown", "unknown")]
BAD = ("A", "10.", "b", "8 GB", "1,800 MHz")
CLEANED = [("A", 1299.0, "b", 8.0, 1800.0), ("unknown", None, "unknown", None, None)]


def rows(frame):
    return sorted(frame.select(OFFER_COLUMNS[:-1]).collect(), key=str)


def expected(values):
    return sorted(values, key=str)


def test_cleaning_keeps_the_sentinel_in_texts(raw_offers):
    assert rows(clean_offers(raw_offers(GOOD))) == expected(CLEANED)


def test_clean_batch_goes_to_the_table(spark, raw_offers, tmp_path):
    path = str(tmp_path / "offers")
    assert etl.load_batch(raw_offers(GOOD), path) == etl.LoadResult("table", 2)
    assert rows(read_offers(spark, path)) == expected(CLEANED)
    assert etl.load_batch(raw_offers(GOOD), path).target == "table"
    assert read_offers(spark, path).count() == 4  # a repeated run accumulates


def test_one_bad_cell_quarantines_the_whole_raw_batch(spark, raw_offers, tmp_path):
    path = str(tmp_path / "offers")
    assert etl.load_batch(raw_offers([*GOOD, BAD]), path) == etl.LoadResult("quarantine", 3, is_clean=False)
    assert rows(spark.read.parquet(f"{path}_uncleaned")) == expected([*GOOD, BAD])
    assert not Path(path).exists()


def test_empty_batch_is_only_reported(spark, raw_offers, tmp_path):
    path = str(tmp_path / "offers")
    result = etl.load_batch(raw_offers([]), path)
    assert result == etl.LoadResult("nothing", 0) and list(tmp_path.iterdir()) == []
    report = etl.run_report(result, "2023-01-01", spark).collect()
    assert [tuple(r)[1:4] for r in report] == [("clean", "no_data", 1)]


def test_failed_load_falls_back_to_csv(spark, raw_offers, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    target = ParquetTarget(str(blocked / "offers"), str(tmp_path / "fallback"))
    for _ in range(2):
        result = etl.load_batch(raw_offers(GOOD), target)
    assert result.target == "csv" and result.rows == 2 and result.error
    assert rows(read_offers(spark, target.csv_folder(True), "csv")) == expected(CLEANED * 2)


def test_csv_missing_text_and_headers(spark, raw_offers, tmp_path):
    path = tmp_path / "offers.csv"
    append_csv(clean_offers(raw_offers(GOOD)).coalesce(1), str(path))
    lines = next(path.glob("*.csv")).read_text().splitlines()
    assert lines[0] == ",".join(OFFER_COLUMNS)
    assert "unknown,NaN,unknown,NaN,NaN,2023-01-01" in lines


def test_verdict_counts_cells_per_batch(raw_offers):
    verdict = batch_verdict(raw_offers([*GOOD, BAD, ("A", "$1", "b", "8 GB X", "1 MHz")])).first()
    assert verdict.asDict() == {"n_rows": 4, "bad_price": 1, "bad_ram": 1, "bad_clock": 1, "is_clean": False}


def test_runs_are_judged_one_by_one(spark, raw_offers, tmp_path):
    batches = raw_offers([(*GOOD[0], date(2023, 1, 1)), (*GOOD[0], date(2023, 2, 1)), (*BAD, date(2023, 2, 1))])
    path = str(tmp_path / "offers")
    etl.load_runs(batches, path)
    assert [r[DATE] for r in read_offers(spark, path).collect()] == [date(2023, 1, 1)]
    assert {r[DATE] for r in spark.read.parquet(f"{path}_uncleaned").collect()} == {date(2023, 2, 1)}


def test_rows_without_a_date_are_kept(spark, raw_offers, tmp_path):
    path = str(tmp_path / "offers")
    etl.load_runs(raw_offers([(*GOOD[0], None), (*GOOD[0], date(2023, 1, 1))]), path)
    assert {r[DATE] for r in read_offers(spark, path).collect()} == {None, date(2023, 1, 1)}


def test_table_is_partitioned_by_date(raw_offers, tmp_path):
    path = tmp_path / "offers"
    append_offers(stamp_date(clean_offers(raw_offers(GOOD)), "2023-05-01"), str(path))
    assert [p.name for p in path.glob("date=*")] == ["date=2023-05-01"]


def staged_tables(spark):
    root = Path(stage_root(spark).removeprefix("file:"))
    return sorted(p.name for p in root.iterdir()) if root.exists() else []


def crawl(spark, day=date(2023, 1, 1), clock="1.8 GHz"):
    def item(inner):
        return f'<div class="{GRID_ITEM.classes}">{inner}</div>'

    def page(links):
        return f'<div class="{GRID.classes}">{"".join(item(f"<a href={link}>x</a>") for link in links)}</div>'

    values = {MODEL: "A", BRAND: "b", RAM: "8 GB", CLOCK: clock}
    spec = "".join(
        f'<tr class="{row.classes}"><td>{label}</td><td>{values[name]}</td></tr>' for name, (row, label) in SPEC_ROWS.items()
    )
    offer = f'<span class="a-price-whole">99.</span><table class="{SPEC_TABLE.classes}">{spec}</table>'
    pages = [(day, 1, 200, None, page(["/1", "/2", "/3", "/4"])), (day, 2, 200, None, "<p>"), (day, 3, 200, None, page(["/9"]))]
    fetched = [
        ("/1", 200, None, offer), ("/2", None, "timeout", None), ("/3", 403, None, None), ("/4", 200, None, offer), ("/9", 200, None, offer)
    ]
    return (
        spark.createDataFrame(pages, CRAWL_PAGE),
        spark.createDataFrame(
            [(day, 3 if u == "/9" else 1, 0 if u == "/9" else int(u[1]) - 1, LINK_HOST + u, s, e, h) for u, s, e, h in fetched],
            FETCHED_OFFER,
        ),
    )


def test_whole_run(spark, tmp_path):
    path = str(tmp_path / "offers")
    result, report = etl.run_etl(*crawl(spark), path, "2023-01-01")
    assert result == etl.LoadResult("table", 1)
    assert [tuple(r) for r in read_offers(spark, path).collect()] == [("A", 99.0, "b", 8.0, 1800.0, date(2023, 1, 1))]
    assert sorted(tuple(r)[1:] for r in report.collect()) == [
        ("load", "rows_loaded", 1, None), ("offer", "blocked_403", 1, None), ("offer", "timeout_error", 1, None),
        ("page", "no_grid", 1, 2),
    ]


def test_whole_run_with_a_bad_cell(spark, tmp_path):
    path = str(tmp_path / "offers")
    result, report = etl.run_etl(*crawl(spark, clock="fast"), path, "2023-01-01")
    assert result.target == "quarantine"
    assert {("clean", "failed", 1), ("load", "rows_quarantined", 1)} <= {tuple(r)[1:4] for r in report.collect()}


def test_runs_in_one_store_are_loaded_one_by_one(spark, tmp_path):
    pages, fetched = crawl(spark)
    later, later_fetched = crawl(spark, date(2023, 2, 1), clock="2 GHz")
    path = str(tmp_path / "offers")
    for day in ("2023-01-01", "2023-02-01"):
        result, report = etl.run_etl(pages.union(later), fetched.union(later_fetched), path, day)
        assert result == etl.LoadResult("table", 1)
        assert {str(r["run_date"]) for r in report.collect()} == {day}
    loaded = {(r[DATE], r[CLOCK]) for r in read_offers(spark, path).collect()}
    assert loaded == {(date(2023, 1, 1), 1800.0), (date(2023, 2, 1), 2000.0)}


def test_page_window_of_a_run(spark, tmp_path):
    path = str(tmp_path / "offers")
    assert etl.run_etl(*crawl(spark), path, "2023-01-01", start=3)[0] == etl.LoadResult("table", 1)
    assert etl.run_etl(*crawl(spark), path, "2023-01-01", start=4)[0] == etl.LoadResult("nothing", 0)


def test_one_address_listed_twice_gives_two_offers(spark, tmp_path):
    pages, fetched = crawl(spark)
    html = F.replace("html", F.lit("href=/4"), F.lit("href=/1"))
    doubled = pages.withColumn("html", F.when(F.col("page_no") == 1, html).otherwise(F.col("html")))
    ahead = fetched.where("status = 200 and page_no = 1")
    result, _ = etl.run_etl(doubled, ahead, str(tmp_path / "offers"), "2023-01-01")
    assert result.rows == 2


def test_csv_keeps_raw_texts(spark, raw_offers, tmp_path):
    odd = [(' A\n "RTX" ', " 1,299.", "b,c", "8 GB ", "\t1.8 GHz"), ("", "unknown", '"', "unknown", "unknown")]
    append_csv(raw_offers(odd), str(tmp_path / "raw.csv"))
    assert rows(read_offers(spark, str(tmp_path / "raw.csv"), "csv", RAW_OFFER)) == expected(odd)


def test_dirty_batch_in_csv_reports_both(spark, raw_offers, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("not a folder")
    target = ParquetTarget(str(blocked / "offers"), str(tmp_path / "fallback"))
    result = etl.load_batch(raw_offers([BAD]), target)
    events = {tuple(r)[1:4] for r in etl.run_report(result, "2023-01-01", spark).collect()}
    assert events == {("clean", "failed", 1), ("load", "rows_to_csv", 1)}
    assert rows(read_offers(spark, target.csv_folder(False), "csv", RAW_OFFER)) == expected([BAD])
    outcome = etl.load_runs(raw_offers([BAD]), target).first()
    assert (outcome["n_rows"], outcome["is_clean"], outcome["target"]) == (1, False, "csv")


def test_no_rows_write_nothing(raw_offers, tmp_path):
    assert etl.load_runs(raw_offers([]), str(tmp_path / "offers")).count() == 0
    assert list(tmp_path.iterdir()) == []


def test_one_job_loads_and_draws(spark, tmp_path):
    before = staged_tables(spark)
    result = etl.run_all(*crawl(spark), str(tmp_path / "offers"), "2023-01-01", str(tmp_path / "out"))
    assert result.target == "table"
    assert spark.read.parquet(str(tmp_path / "out" / "report")).count() == 4
    assert spark.read.parquet(str(tmp_path / "out" / "price_by_category")).count() == 4
    assert staged_tables(spark) == before


def test_dashboard_is_saved(spark, tmp_path):
    from workload.queries import _stored_offers

    series = dashboard(_stored_offers(spark, "/root/testdata/sf0.001"), replicates=50)
    save_dashboard(series, str(tmp_path))
    saved = {name: spark.read.parquet(str(tmp_path / name)).count() for name in series}
    assert saved["price_by_model"] == 15 and saved["price_by_category"] == 4 and saved["price_density"] == 200
    assert saved["price_clock_band"] == 100 and saved["price_histogram"] == 7


def test_staged_frame_survives_and_can_be_dropped(spark):
    frame = stage(spark.range(5).withColumn("x", F.rand()), "probe")
    assert frame.collect() == frame.collect()
    assert stage_root(spark).endswith(spark.sparkContext.applicationId)
    drop_stages(spark)
    with pytest.raises(Exception):
        frame.collect()


def test_a_load_of_many_dates_makes_no_folder_for_each(spark, raw_offers, tmp_path):
    days = [date(2023, 1, 1) + timedelta(n) for n in range(MOST_FOLDERS + 1)]
    path = str(tmp_path / "offers")
    etl.load_runs(raw_offers([*[(*GOOD[0], day) for day in days], (*GOOD[0], None)]), path)
    assert not list(Path(path).glob("date=*"))
    append_offers(stamp_date(clean_offers(raw_offers(GOOD)), "2022-05-01"), path, one_date=True)
    assert sorted(str(r[DATE]) for r in read_offers(spark, path).collect()) == sorted(
        [*map(str, days), "None", "2022-05-01", "2022-05-01"]
    )
    assert not list(Path(path).glob("date=*"))


def test_a_table_keeps_its_folders(spark, raw_offers, tmp_path):
    days = [date(2023, 1, 1) + timedelta(n) for n in range(MOST_FOLDERS + 1)]
    path = str(tmp_path / "offers")
    for batch in ([(*GOOD[0], days[0])], [(*GOOD[0], day) for day in days]):
        etl.load_runs(raw_offers(batch), path)
    assert len(list(Path(path).glob("date=*"))) == len(days)
    assert read_offers(spark, path).count() == len(days) + 1
