import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.operators import distribution as ds
from offerlens.operators import metrics
from offerlens.operators.quantiles import exact_quantiles
from offerlens.schema import BRAND, CLOCK, MODEL, PRICE

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.975, 1.0]


def weighted(spark, values, brand="b"):
    rows = [(brand, float(v), int(n)) for v, n in values]
    return spark.createDataFrame(rows, f"{BRAND} string, {PRICE} double, n long")


@pytest.mark.parametrize("seed", range(3))
def test_quantiles_agree_with_numpy(spark, seed):
    rng = random.Random(seed)
    values = [(rng.choice([rng.random() * 100, rng.randint(0, 9)]), rng.randint(1, 4)) for _ in range(rng.randint(1, 300))]
    values.append((5, 1000))  # most rows hold one value
    expanded = [v for v, n in values for _ in range(n)]
    found = exact_quantiles(weighted(spark, values).repartition(5), PRICE, PROBABILITIES, F.col("n"))
    assert found == pytest.approx(list(np.quantile(expanded, PROBABILITIES)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(weighted(spark, []), PRICE, [0.25, 0.5], F.col("n")) == [None, None]


def test_quantiles_skip_missing_values(spark):
    frame = spark.createDataFrame([(None,), (1.0,), (2.0,), (None,)], f"{PRICE} double")
    assert exact_quantiles(frame, PRICE, [0.5]) == [1.5]


def clocks(spark, values):
    return spark.createDataFrame([("m", float(v), 10.0 * v) for v in values], f"{MODEL} string, {CLOCK} double, {PRICE} double")


def test_lowest_clock_has_no_category(spark):
    frame = clocks(spark, [0, 1, 2, 2.5, 4, 5, 8])
    limits = ds.value_range(frame, CLOCK)
    found = ds.with_clock_category(frame, limits).orderBy(CLOCK).collect()
    assert [r["category"] for r in found] == [None, "very low", "very low", "low", "low", "moderate", "high"]
    lowest = ds.with_clock_category(frame, limits, include_lowest=True).orderBy(CLOCK).first()
    assert lowest["category"] == "very low"
    means = ds.mean_price_by_category(ds.with_clock_category(frame, limits)).collect()
    assert [(r["category"], r["n"], r["price"]) for r in means] == [
        ("very low", 2, 15.0), ("low", 2, 32.5), ("moderate", 1, 50.0), ("high", 1, 80.0)
    ]
    assert sum(r["n"] for r in means) + 1 == frame.count()


def test_equal_clocks_have_no_categories(spark):
    frame = clocks(spark, [3, 3])
    found = ds.mean_price_by_category(ds.with_clock_category(frame, ds.value_range(frame, CLOCK))).collect()
    assert [(r["n"], r["price"]) for r in found] == [(0, None)] * 4


@pytest.mark.parametrize("seed", range(3))
def test_histogram_agrees_with_numpy(spark, seed):
    rng = random.Random(seed)
    values = [(rng.randint(1, 50) / 7, rng.randint(1, 5)) for _ in range(200)]
    rows = ds.histogram(weighted(spark, values)).collect()
    expanded = [v for v, n in values for _ in range(n)]
    expected, edges = np.histogram(expanded, bins=np.histogram_bin_edges(expanded, 7))
    assert [r["n"] for r in rows] == list(expected)
    assert [r["bin_low"] for r in rows] + [rows[-1]["bin_high"]] == list(edges)


def test_histogram_of_one_value_and_of_nothing(spark):
    assert [r["n"] for r in ds.histogram(weighted(spark, [(4, 3)])).collect()] == [0, 0, 0, 3, 0, 0, 0]
    assert ds.histogram(weighted(spark, [])).count() == 0


def test_density_agrees_with_the_formula(spark):
    rng = random.Random(5)
    values = [(rng.randint(1, 400), rng.randint(1, 3)) for _ in range(150)]
    expanded = np.array([v for v, n in values for _ in range(n)], float)
    width = expanded.std(ddof=1) * len(expanded) ** -0.2
    grid = np.linspace(expanded.min(), expanded.max(), 200)
    expected = np.exp(-0.5 * ((grid[:, None] - expanded) / width) ** 2).sum(1) / (len(expanded) * width * np.sqrt(2 * np.pi))
    rows = ds.density(weighted(spark, values)).collect()
    assert [r["x"] for r in rows] == list(grid)
    assert [r["density"] for r in rows] == pytest.approx(list(expected), rel=1e-9)
    scale = len(expanded) * (expanded.max() - expanded.min()) / 7
    assert [r["count_scaled"] for r in rows] == pytest.approx(list(expected * scale), rel=1e-9)
    assert ds.density(weighted(spark, [(4, 9)])).count() == 0


def test_box(spark):
    frame = weighted(spark, [(1, 1), (10, 2), (11, 2), (12, 2), (40, 3)])
    expanded = [1, 10, 10, 11, 11, 12, 12, 40, 40, 40]
    q1, median, q3 = np.quantile(expanded, [0.25, 0.5, 0.75])
    row = ds.box_stats(frame).first()
    assert (row["n"], row["q1"], row["median"], row["q3"]) == (10, q1, median, q3)
    assert (row["whisker_low"], row["whisker_high"], row["n_outliers"]) == (1.0, 40.0, 0)
    tight = ds.box_stats(frame, whisker=0.0).first()
    assert (tight["whisker_low"], tight["whisker_high"]) == (q1, q3)
    spread = weighted(spark, [(10, 50), (11, 50), (99, 2)])
    assert [(r[PRICE], r["n"]) for r in ds.box_outliers(spread).collect()] == [(99.0, 2)]
    assert ds.box_stats(spread).first()["n_outliers"] == 2


def test_fit_skips_incomplete_pairs(spark):
    rows = [("m", 1.0, 10.0), ("m", 2.0, 14.0), ("m", 3.0, 18.5), ("m", None, 7.0), ("m", 9.0, None)]
    fit = ds.price_clock_fit(spark.createDataFrame(rows, f"{MODEL} string, {CLOCK} double, {PRICE} double")).first()
    slope, intercept = np.polyfit([1, 2, 3], [10, 14, 18.5], 1)
    assert fit["n"] == 3
    assert (fit["slope"], fit["intercept"]) == pytest.approx((slope, intercept))


def test_order_and_ratios(spark, offers):
    frame = offers([
        ("a", 10.0, "x", 2.0, 100.0), ("a", 30.0, "x", 2.0, 300.0), ("b", 90.0, "x", 0.0, 0.0), ("c", 1.0, "y", None, None)
    ])
    assert [r[MODEL] for r in metrics.mean_price_by_model(frame).collect()] == ["b", "a", "c"]
    by_brand = metrics.mean_price_by_brand(frame).collect()
    assert [(r[BRAND], r["price"]) for r in by_brand] == [("y", 1.0), ("x", 55.0)]
    assert [tuple(r) for r in metrics.usd_per_gb(frame).collect()] == [("a", 10.0), ("b", None), ("c", None)]
    assert [tuple(r) for r in metrics.usd_per_100mhz(frame).collect()] == [("a", 10.0), ("b", None), ("c", None)]


def test_brand_share(spark):
    frame = weighted(spark, [(1, 3)], "x").union(weighted(spark, [(1, 1)], "y")).union(weighted(spark, [(1, 9)], None))
    assert [tuple(r) for r in metrics.brand_share(frame).collect()] == [("x", 3, 75.0), ("y", 1, 25.0)]


def test_density_of_many_values_agrees_with_the_direct_sum(spark):
    draw = np.random.default_rng(11)
    values = np.concatenate([draw.lognormal(5, 1.5, 20_000), draw.normal(9000, 3, 5000)])
    frame = spark.createDataFrame([(float(v), 1) for v in values], "price_USD double, n long")
    rows = ds.density(frame).collect()
    width = values.std(ddof=1) * len(values) ** -0.2
    x = np.array([r["x"] for r in rows])
    direct = np.array([np.exp(-0.5 * ((p - values) / width) ** 2).sum() for p in x]) / (len(values) * width * np.sqrt(2 * np.pi))
    found = np.array([r["density"] for r in rows])
    assert abs(found - direct).max() <= 1e-12 * direct.max()
    cells = ds._cell_moments(frame, "price_USD", values.min(), width)
    assert cells.count() < 25_000 / 20
