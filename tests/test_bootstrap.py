import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.operators import bootstrap as bt
from offerlens.operators import distribution as ds
from offerlens.schema import CLOCK, PRICE


def cells(spark, values):
    return spark.createDataFrame([(float(v), int(n)) for v, n in values], f"{PRICE} double, n long")


def replicate_means(spark, values, **options):
    drawn = bt.resample(cells(spark, values), **options)
    rows = drawn.groupBy("replicate").agg((F.sum(F.col("weight") * F.col(PRICE)) / F.sum("weight")).alias("m"))
    return np.array([r["m"] for r in rows.collect()])


def test_weights_look_like_poisson_one(spark):
    drawn = bt.resample(cells(spark, [(v, 1) for v in range(400)]), 500)
    row = drawn.agg(F.avg("weight").alias("m"), F.var_samp("weight").alias("v"), F.count("weight").alias("n")).first()
    assert row["n"] == 200_000
    assert row["m"] == pytest.approx(1, abs=0.02) and row["v"] == pytest.approx(1, abs=0.03)


@pytest.mark.parametrize("n", [1, 7, 16, 40, 300, 5000])
def test_totals_have_mean_and_variance_of_their_copies(spark, n):
    drawn = bt.resample(cells(spark, [(v, n) for v in range(40)]), 250)
    totals = drawn.groupBy(PRICE, "replicate").agg(F.sum("weight").alias("w"))
    row = totals.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v"), F.count("w").alias("n")).first()
    assert row["n"] == 10_000
    assert row["m"] == pytest.approx(n, abs=5 * (n / 10_000) ** 0.5) and row["v"] == pytest.approx(n, rel=0.08)


def test_bounds_are_the_distribution_function():
    from math import exp, lgamma, log

    for mean in bt.MEANS:
        first, bounds = bt.poisson_bounds(mean)
        total = sum(exp(k * log(mean) - mean - lgamma(k + 1)) for k in range(first + 1))
        for k, bound in enumerate(bounds, start=first):
            assert bound / bt.P**2 == pytest.approx(total, abs=1e-12)
            total += exp((k + 1) * log(mean) - mean - lgamma(k + 2))
        assert bounds == sorted(bounds) and bounds[-1] >= bt.P**2 - 2 and all(b > 0 for b in bounds)


def test_copies_and_cells_give_the_same_interval(spark):
    """n equal rows are one cell, whether they arrive as rows or spread over files."""
    rows = spark.range(3000).selectExpr("'g' as g", "cast(id % 5 as double) as v")
    once = bt.group_mean_ci(rows.coalesce(1), "g", "v", 100).collect()
    assert once == bt.group_mean_ci(rows.repartition(9), "g", "v", 100).collect()


def test_replicates_are_not_correlated(spark):
    drawn = bt.resample(cells(spark, [(v, 1) for v in range(300)]), 200).collect()
    weights = np.zeros((300, 201))
    for r in drawn:
        weights[int(r[PRICE]), r["replicate"]] += r["weight"]
    by_replicate = np.corrcoef(weights[:, 1:].T) - np.eye(200)
    by_row = np.corrcoef(weights[:, 1:]) - np.eye(300)
    assert abs(by_replicate).mean() < 2 / np.sqrt(300) and abs(by_replicate.mean()) < 0.01
    assert abs(by_row).mean() < 2 / np.sqrt(200) and abs(by_row.mean()) < 0.01


@pytest.mark.parametrize("low,high", [(1, 3), (50, 60), (900, 1100)])
def test_spread_of_means_is_the_standard_error(spark, low, high):
    """For copies of one, two and three digits."""
    rng = random.Random(3)
    values = [(v, rng.randint(low, high)) for v in range(30)]
    expanded = np.array([v for v, n in values for _ in range(n)])
    means = replicate_means(spark, values, replicates=1500)
    error = expanded.std() / np.sqrt(len(expanded))
    assert means.mean() == pytest.approx(expanded.mean(), abs=4 * error / np.sqrt(1500))
    assert means.std() == pytest.approx(error, rel=0.08)


def test_partitioning_does_not_matter(spark):
    frame = cells(spark, [(v, 1 + v % 3) for v in range(100)])
    first = bt.resample(frame.coalesce(1), 50).groupBy("replicate").agg(F.sum("weight")).orderBy("replicate").collect()
    again = bt.resample(frame.repartition(7), 50).groupBy("replicate").agg(F.sum("weight")).orderBy("replicate").collect()
    assert first == again


def pairs(spark, n=400):
    rng = random.Random(11)
    rows = []
    for _ in range(n):
        x = float(rng.randint(10, 30) * 100)
        rows.append((x, 0.5 * x + rng.gauss(0, 100)))
    return rows, spark.createDataFrame(rows + [(None, 1.0), (5.0, None)], f"{CLOCK} double, {PRICE} double")


def test_band_agrees_with_row_resampling(spark):
    rows, frame = pairs(spark)
    x, y = np.array(rows).T
    band = bt.price_clock_band(frame).collect()
    slope, intercept = np.polyfit(x, y, 1)
    grid = np.linspace(x.min(), x.max(), 100)
    assert [r["clock"] for r in band] == list(grid)
    assert [r["fit"] for r in band] == pytest.approx(list(intercept + slope * grid), rel=1e-9)
    rng, lines = np.random.default_rng(0), []
    for _ in range(1000):
        chosen = rng.integers(0, len(x), len(x))
        lines.append(np.polyval(np.polyfit(x[chosen], y[chosen], 1), grid))
    low, high = np.percentile(lines, [2.5, 97.5], axis=0)
    ours = np.array([r["high"] - r["low"] for r in band])
    assert np.mean(ours / (high - low)) == pytest.approx(1, abs=0.08)
    assert all(r["low"] < r["fit"] < r["high"] for r in band)


def test_category_intervals(spark):
    _, frame = pairs(spark)
    complete = frame.na.drop()
    found = bt.price_by_category_ci(ds.with_clock_category(complete, ds.value_range(complete, CLOCK)), 400).collect()
    means = ds.mean_price_by_category(ds.with_clock_category(complete, ds.value_range(complete, CLOCK))).collect()
    assert [(r["category"], r["n"]) for r in found] == [(r["category"], r["n"]) for r in means]
    assert [r["price"] for r in found] == pytest.approx([r["price"] for r in means])
    assert all(r["low"] < r["price"] < r["high"] for r in found)


def test_nothing_to_resample(spark):
    _, frame = pairs(spark, 0)
    assert bt.price_clock_band(frame).count() == 0
    empty = bt.price_by_category_ci(ds.with_clock_category(frame.na.drop(), None), 10).collect()
    assert [(r["n"], r["low"]) for r in empty] == [(0, None)] * 4


def test_equal_clocks_have_no_slope(spark):
    frame = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0)], f"{CLOCK} double, {PRICE} double")
    assert {r["fit"] for r in bt.price_clock_band(frame, 20).collect()} == {None}
