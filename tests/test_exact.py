import math
import random
import struct
from fractions import Fraction
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.functions.doubles import exponent, mantissa, of_order_key, order_key
from offerlens.operators import exact
from offerlens.schema import CLOCK, PRICE

EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 2.0**-1021, 1.0, math.nextafter(1, 0), math.nextafter(1, 2),
         2.0**53 - 1, 2.0**29, math.nextafter(2.0**29, 0), 1e308, -1e308, 1.7976931348623157e308, 2.0**1023, 0.1, -0.1, 1 / 3]


def anything(rng, n):
    """Doubles of all sizes, by their bits."""
    drawn = (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(n))
    return [x for x in drawn if math.isfinite(x)]


def frame(spark, values, n=3):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double").repartition(n)


def test_parts_of_doubles(spark):
    rng = random.Random(1)
    values = EDGES + anything(rng, 300) + [2.0**k for k in range(-1074, 1024, 7)] + [math.nextafter(2.0**k, 0) for k in range(-1073, 1024, 11)]
    power = exponent(F.col("v"))
    for row in frame(spark, values).select("v", power.alias("e"), mantissa(F.col("v"), power).alias("m")).collect():
        assert Fraction(abs(row["v"])) == row["m"] * Fraction(2) ** (row["e"] - 52)
        assert row["m"] >= 1 << 52 or row["e"] == -1022


def test_order_keys_are_in_order_and_come_back(spark):
    values = sorted(EDGES + anything(random.Random(2), 300) + [float("inf"), -float("inf")])
    rows = frame(spark, values).select("v", order_key(F.col("v")).alias("k")).collect()
    assert all(of_order_key(r["k"]) == r["v"] for r in rows)
    rows.sort(key=lambda r: r["k"])
    assert [r["v"] for r in rows] == values
    assert frame(spark, [None, float("nan")]).select(order_key(F.col("v")).alias("k")).distinct().collect() == [(None,)]


@pytest.mark.parametrize("seed", range(3))
def test_sums_are_rounded_once(spark, seed):
    rng = random.Random(seed)
    groups = {
        "mixed": [rng.choice([1, -1]) * 10.0 ** rng.randint(-20, 20) * rng.random() for _ in range(200)],
        "all sizes": [x / 2**12 for x in anything(rng, 100)],
        "cancel": [1e16, 1.0, -1e16, 1e-16] * 5,
        "zero": [0.1, -0.1],
        "half": [2.0**53, 1.0, 2.0**-1074],
        "tiny": [5e-324] * 7,
        "subnormal": [2.0**-1022, -5e-324],
        "minus": [-rng.random() for _ in range(50)],
    }
    rows = [(name, x) for name, values in groups.items() for x in values]
    rng.shuffle(rows)
    found = exact.exact_sums(spark.createDataFrame(rows, "g string, v double").repartition(3), ["g"], {"s": F.col("v")}).collect()
    assert {r["g"]: (r["s"], r["n_s"]) for r in found} == {name: (math.fsum(v), len(v)) for name, v in groups.items()}


def test_missing_and_not_finite(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("none", None), ("inf", inf), ("inf", 1.0), ("minus", -inf), ("both", inf), ("both", -inf), ("nan", nan), ("nan", 1.0),
            ("some", None), ("some", 2.5), (None, 4.0)]
    found = {r["g"]: r for r in exact.exact_sums(spark.createDataFrame(rows, "g string, v double"), ["g"], {"s": F.col("v")}).collect()}
    assert {k: (r["s"], r["n_s"]) for k, r in found.items() if k not in ("both", "nan")} == {
        "none": (None, 0), "inf": (inf, 2), "minus": (-inf, 1), "some": (2.5, 1), None: (4.0, 1)}
    assert math.isnan(found["both"]["s"]) and math.isnan(found["nan"]["s"])


def test_nothing(spark):
    empty = frame(spark, [])
    assert [tuple(r) for r in exact.exact_sums(empty, [], {"s": F.col("v")}).collect()] == [(None, 0)]
    assert exact.exact_means(empty.withColumn("g", F.lit("a")), ["g"], {"s": F.col("v")}).count() == 0


def test_weights_stand_for_copies(spark):
    rows = [(0.1, 3), (1e17, 2), (-7.3, 10**9), (2.5, 0)]
    found = exact.exact_sums(spark.createDataFrame(rows, "v double, n long"), [], {"s": F.col("v")}, F.col("n")).first()
    assert found["s"] == float(sum(Fraction(v) * n for v, n in rows)) and found["n_s"] == 10**9 + 5


def test_bit_equal_under_any_partitioning(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice([1e9, 1.0, 1e-6]) * rng.gauss(0, 1), rng.gauss(1000, 300)) for _ in range(600)]
    data = spark.createDataFrame(rows, f"g string, {PRICE} double, {CLOCK} double")
    runs = reduce(DataFrame.union, [data.repartition(n, F.rand(n)).withColumn("run", F.lit(n)) for n in range(1, 11)])
    means = exact.exact_means(runs, ["run", "g"], {"p": F.col(PRICE)}).collect()
    assert len(means) == 30 and len({(r["g"], r["p"]) for r in means}) == 3
    fits = {tuple(exact.price_clock_fit(data.repartition(n, F.rand(n))).first()) for n in (1, 7)}
    assert len(fits) == 1 and fits.pop()[0] == 600


def test_fit_agrees_with_fractions_and_edge_cases(spark):
    rng = random.Random(6)
    rows = [(float(x), 3.0 * x + 1e8 + rng.random()) for x in range(1000, 1050)]
    found = exact.line_fit(spark.createDataFrame(rows + [(None, 1.0), (1.0, None)], "x double, y double"), "x", "y").first()
    xs, ys = [Fraction(x) for x, _ in rows], [Fraction(y) for _, y in rows]
    mx, my = sum(xs) / 50, sum(ys) / 50
    xy, xx = sum((x - mx) * (y - my) for x, y in zip(xs, ys)), sum((x - mx) ** 2 for x in xs)
    assert found["n"] == 50 and found["slope"] == pytest.approx(float(xy / xx), rel=1e-9)
    assert found["intercept"] == pytest.approx(float(my - xy / xx * mx), rel=1e-12)

    def fit(rows):
        return tuple(exact.line_fit(spark.createDataFrame(rows, "x double, y double"), "x", "y").first())

    assert fit([(1.0, 2.0), (1.0, 3.0)]) == (2, None, None, None)
    assert fit([(1.0, 2.0), (2.0, 2.0)]) == (2, 0.0, 2.0, 1.0)
    assert fit([]) == (0, None, None, None)
