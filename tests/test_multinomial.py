"""Exact n-of-n draws."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.operators import bootstrap, multinomial
from workload.queries import all_queries


def sums(cells, replicates=200, **options):
    terms = {"v": F.col("v"), "vv": F.col("v") * F.col("v")}
    found = multinomial.resampled_sums(cells, terms, replicates, **options)
    return sorted(map(tuple, found.collect()), key=str)


def test_split_gives_all_draws_and_binomial_margins():
    generator = np.random.Generator(np.random.Philox(1))
    counts = np.array([1, 0, 5, 10**9, 3, 1, 10**9, 7])
    draws = np.full(4000, counts.sum())
    found = np.stack([d for _, d in sorted(multinomial.split(counts, draws, generator), key=lambda x: x[0])])
    assert (found.sum(axis=0) == counts.sum()).all() and (found[1] == 0).all()
    share = counts / counts.sum()
    mean, spread = counts, np.sqrt(counts * (1 - share))
    assert (abs(found.mean(axis=1) - mean) <= 5 * spread / np.sqrt(4000) + 1e-9).all()
    kept = counts > 0
    assert (abs(found.var(axis=1)[kept] / spread[kept] ** 2 - 1) < 0.2).all()


def test_weights_of_every_replicate_add_up(spark):
    cells = spark.createDataFrame([("a", float(i), 10 ** (i % 8)) for i in range(300)] + [("b", 1.0, 3), (None, 2.0, 1)], "g string, v double, n long")
    totals = {r["g"]: r["n"] for r in cells.groupBy("g").agg(F.sum("n").alias("n")).collect()}
    found = multinomial.resampled_sums(cells, {"v": F.col("v")}, 100, "g").collect()
    assert len(found) == 300 and all(r["n"] == totals[r["g"]] for r in found)
    assert all(r["v"] == 3.0 for r in found if r["g"] == "b")


def test_partitions_change_nothing(spark):
    cells = spark.createDataFrame([(float(i % 97) + i / 1000, 1 + i % 5) for i in range(1000)], "v double, n long")
    first = sums(cells.repartition(1))
    again = sums(cells.orderBy(F.desc("v")).repartition(7))
    assert [r[:2] for r in first] == [r[:2] for r in again]
    assert np.allclose(np.array(first, dtype=float), np.array(again, dtype=float), rtol=1e-12)


def test_a_huge_cell_is_one_leaf(spark):
    big = spark.createDataFrame([(1.0, 10**12), (2.0, 10**12)], "v double, n long")
    found = sums(big)
    assert all(n == 2 * 10**12 for _, n, *_ in found)
    spread = np.std([v for *_, v, _ in found])
    assert 0.8 < spread / np.sqrt(2 * 10**12 / 4) < 1.2


def test_intervals_agree_with_plain_resampling(spark):
    draw = np.random.default_rng(3)
    values = np.round(draw.lognormal(3, 1, 400), 1)
    frame = spark.createDataFrame([("x", float(v)) for v in values], "g string, v double")
    row = bootstrap.group_mean_ci(frame, "g", "v", 2000, "multinomial").first()
    means = [draw.choice(values, len(values)).mean() for _ in range(20_000)]
    low, high = np.quantile(means, [0.025, 0.975])
    assert (row["n"], row["mean"]) == (400, pytest.approx(values.mean()))
    assert row["low"] == pytest.approx(low, rel=0.02) and row["high"] == pytest.approx(high, rel=0.02)


@pytest.mark.parametrize("name", ["price_clock_band", "price_by_category_ci", "value_mean_ci"])
def test_queries_agree_with_poisson_weights(spark, name):
    folder = "/root/testdata/sf0.001"
    exact = {r[0]: r for r in all_queries()[f"{name}_multinomial"](spark, folder).collect()}
    poisson = {r[0]: r for r in all_queries()[name](spark, folder).collect()}
    assert exact.keys() == poisson.keys()
    for key, row in exact.items():
        other = poisson[key]
        for same in {"fit", "mean", "price", "n", "clock"} & set(row.asDict()):
            assert row[same] == other[same]
        if row["low"] is not None:
            width = other["high"] - other["low"]
            assert abs(row["low"] - other["low"]) < 0.15 * width and abs(row["high"] - other["high"]) < 0.15 * width


def test_no_rows_and_wrong_draws(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert bootstrap.group_mean_ci(empty, "g", "v", 10, "multinomial").count() == 0
    with pytest.raises(ValueError):
        bootstrap.group_mean_ci(empty, "g", "v", 10, "other")
