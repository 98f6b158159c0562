"""Radix selection and the most frequent keys."""

import random
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.operators import heavy, radix
from offerlens.operators.heavy import heavy_keys
from offerlens.operators.radix import radix_quantiles
from offerlens.staging import stage

P = [0.0, 0.1, 0.25, 0.5, 0.75, 0.975, 1.0]


def numbers(spark, values):
    return spark.createDataFrame([(v, 1) for v in values], "v double, n long").repartition(3)


@pytest.mark.parametrize("seed", range(2))
def test_quantiles_agree_with_numpy(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1e-3), rng.gauss(0, 1e6), float(rng.randint(-5, 5))]) for _ in range(500)]
    values += [values[0]] * 300 + [1.0, np.nextafter(1, 2), np.nextafter(1, 0)] * 40
    found = radix_quantiles(numbers(spark, [float(v) for v in values] + [None, float("nan")]), "v", P)
    assert found == pytest.approx(list(np.quantile(values, P)), rel=1e-12)


def test_ranks_of_neighbouring_doubles(spark):
    low = struct.unpack("<q", struct.pack("<d", 0.1))[0]
    values = [struct.unpack("<d", struct.pack("<q", low + i))[0] for i in range(64)]
    assert radix_quantiles(numbers(spark, values), "v", [i / 63 for i in (0, 17, 63)]) == [values[0], values[17], values[63]]


def test_weights_signs_and_infinities(spark):
    frame = spark.createDataFrame([(-1.5, 10**12), (0.0, 1), (-0.0, 1), (float("inf"), 10**12), (7.0, 0)], "v double, n long")
    assert radix_quantiles(frame, "v", [0.0, 0.25, 0.5, 0.75], F.col("n")) == [-1.5, -1.5, 0.0, float("inf")]
    assert radix_quantiles(frame.where("v = 7"), "v", [0.5], F.col("n")) == [None]


def test_passes_are_few_and_bounded(spark, monkeypatch):
    sizes, inner = [], radix._counted

    def counted(values, open_ranges, drop):
        sizes.append(inner(values, open_ranges, drop))
        return sizes[-1]

    monkeypatch.setattr(radix, "_counted", counted)
    rng = random.Random(3)
    radix_quantiles(numbers(spark, [rng.random() for _ in range(3000)]), "v", P)
    assert len(sizes) <= 5 and max(map(len, sizes)) <= 1 << radix.COUNTERS
    sizes.clear()
    radix_quantiles(numbers(spark, [0.3] * 500), "v", P)
    assert len(sizes) == 1


def test_later_passes_filter_in_the_scan(spark):
    stored = stage(numbers(spark, [0.25, 0.5]), "numbers")
    part = radix._Open(0, 0, (), 0.25, 0.5)
    seen = stored.select(F.col("v").alias("value"), "n").where(F.col("value").between(part.low, part.high))
    assert "GreaterThanOrEqual(v,0.25)" in seen._jdf.queryExecution().executedPlan().toString()


def expected(keys, k):
    return sorted(Counter(keys).items(), key=lambda pair: (-pair[1], pair[0]))[:k]


def keyed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k string").repartition(3)


@pytest.mark.parametrize("buckets", [1, 64, heavy.BUCKETS])
def test_heavy_keys_agree_with_full_counts(spark, buckets):
    rng = random.Random(buckets)
    keys = [f"hot{i}" for i in range(5) for _ in range(200 + 10 * (i // 2))] + [f"k{rng.randint(0, 400)}" for _ in range(1500)]
    frame = keyed(spark, keys + [None] * 900)
    for k in (1, 5, 12):
        assert heavy_keys(frame, "k", k, buckets=buckets) == expected(keys, k)


def test_ties_and_few_keys(spark):
    keys = [f"{i:03d}" for i in range(300)] * 2
    assert heavy_keys(keyed(spark, keys), "k", 3) == [("000", 2), ("001", 2), ("002", 2)]
    assert heavy_keys(keyed(spark, ["a", "b", "b"]), "k", 10) == [("b", 2), ("a", 1)]
    assert heavy_keys(keyed(spark, []), "k", 10) == []
    assert heavy_keys(keyed(spark, ["a"]), "k", 0) == []


def test_weighted_keys(spark):
    frame = spark.createDataFrame([("a", 10**12), ("b", 5), ("b", 10**12), ("c", 0)], "k string, n long")
    assert heavy_keys(frame, "k", 5, F.col("n")) == [("b", 10**12 + 5), ("a", 10**12)]


def test_rare_keys_are_not_counted(spark, monkeypatch):
    chosen, inner = [], heavy._counted
    monkeypatch.setattr(heavy, "_counted", lambda rows, buckets, k: chosen.extend(buckets) or inner(rows, buckets, k))
    keys = [f"hot{i}" for i in range(3) for _ in range(400)] + [f"rare{i}" for i in range(2000)]
    assert [k for k, _ in heavy_keys(keyed(spark, keys), "k", 3)] == ["hot0", "hot1", "hot2"]
    assert len(chosen) <= heavy.EAGER * 3 + 3


def test_eligible_offers_are_filtered_by_stored_numbers(spark):
    """A filter over texts would parse them in it, once for each scan, in a method too long to be compiled."""
    from workload.queries import _eligible

    plan = _eligible(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "regexp" not in plan and "relation" in plan
