import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from offerlens.schema import BRAND, CLOCK, MODEL, OFFER, PRICE
from offerlens.sources import layout
from offerlens.sources.sinks import ParquetTarget, append_offers
from offerlens.staging import new_stage_path

DAYS = [date(2023, 1, 1), date(2023, 2, 1)]


@pytest.fixture(scope="module")
def batch(spark):
    rng = random.Random(4)
    rows = [
        (f"model {2 * rng.randint(0, 400):04d}", round(rng.uniform(100, 2000), 2), f"brand {rng.randint(0, 30)}", 8.0,
         float(rng.randint(1000, 3000)), rng.choice(DAYS))
        for _ in range(40_000)
    ]
    rows += [("hot", 500.0, "brand 1", 8.0, 1500.0, DAYS[0])] * 20_000  # a third are copies of one offer
    rows += [(None, None, None, None, None, DAYS[1]), ("m", float("nan"), "b", 1.0, None, DAYS[1])]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, OFFER).repartition(6)


@pytest.fixture(scope="module")
def tables(spark, batch):
    arranged, plain = new_stage_path(spark, "arranged"), new_stage_path(spark, "plain")
    layout.append_arranged(batch, arranged, row_group_bytes=64 << 10)
    append_offers(batch, plain)
    return arranged, plain


def rows_read(spark, path, keep):
    """(rows that leave the scan, rows that the filter keeps)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = spark.read.parquet(path).where(keep).select(MODEL)
        kept = found._jdf.queryExecution().executedPlan().executeCollect()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return scan.metrics().get("numOutputRows").get().value(), len(kept)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_same_rows(spark, batch, tables):
    for path in tables:
        stored = spark.read.schema(OFFER).parquet(path)
        assert stored.exceptAll(batch).count() == 0 and batch.exceptAll(stored).count() == 0


@pytest.mark.parametrize("column, low, high", [(PRICE, 900, 1000), (CLOCK, 2000, 2100)])
def test_fences_skip(spark, tables, column, low, high):
    keep = (F.col(column) > low) & (F.col(column) < high)
    (arranged, kept), (plain, same) = (rows_read(spark, path, keep) for path in tables)
    assert kept == same > 0
    assert arranged < plain / 2


def test_bloom_filters_skip_absent_models(spark, offers):
    """So many models that a row group's dictionary, which could exclude one too, is given up."""
    rng = random.Random(9)
    many = offers([(rng.randbytes(25).hex(), 5.0, "b", 1.0, 2.0) for _ in range(40_000)]).coalesce(1)
    arranged, plain = new_stage_path(spark, "arranged"), new_stage_path(spark, "plain")
    layout.append_arranged(many, arranged)
    append_offers(many, plain)
    absent = F.col(MODEL) == "8" * 50
    assert rows_read(spark, plain, absent) == (40_000, 0)
    assert rows_read(spark, arranged, absent) == (0, 0)


def test_copies_are_split_over_tasks(spark, batch):
    placed = batch.withColumns({"p": layout.curve_place(layout.slice_bounds(batch)), "f": F.spark_partition_id()})
    parts = placed.repartitionByRange(8, "date", "p", "f").groupBy(F.spark_partition_id()).count()
    assert parts.agg(F.max("count")).first()[0] < 20_000


def test_place_interleaves_slices(spark):
    bounds = {"a": [1.0, 2.0, 3.0], "b": [1.0, 2.0, 3.0]}
    rows = [(a + 0.5, b + 0.5) for a in range(4) for b in range(4)] + [(None, None)]
    found = spark.createDataFrame(rows, "a double, b double").select("a", "b", layout.curve_place(bounds, 2).alias("p")).collect()
    z = [0, 1, 4, 5, 2, 3, 6, 7, 8, 9, 12, 13, 10, 11, 14, 15]
    assert [r["p"] for r in found] == [*z, 0]


def test_empty_and_missing(spark, offers):
    target = ParquetTarget(new_stage_path(spark, "arranged"), arranged=True)
    target.append(offers([("m", None, None, None, None)]), clean=True, one_date=True)
    target.append(offers([]), clean=True, one_date=True)
    assert [tuple(r)[:2] for r in target.read(spark).collect()] == [("m", None)]
