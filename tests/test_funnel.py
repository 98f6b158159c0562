import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from offerlens.operators import funnel as fn
from offerlens.operators.funnel import Funnel
from offerlens.schema import BRAND, CLOCK, MODEL, OFFER_COLUMNS, PRICE
from offerlens.staging import stage

EXPECTED = {
    "sf0.001": [6631, 6400, 6347, 3074, 1647, 1555, 1509, 1300, 1264, 1141],
    "sf0.01": [66136, 63786, 63142, 27219, 8764, 8338, 8145, 6980, 6798, 6148],
}


def counts(funnel):
    return [row["n"] for row in funnel.counts().orderBy("step").collect()]


@pytest.mark.parametrize("scale", EXPECTED)
def test_known_counts(spark, scale):
    from workload.queries import _funnel

    assert counts(_funnel(spark, f"/root/testdata/{scale}")) == EXPECTED[scale]


def random_offers(seed, n=600):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["unknown", None] + [f"m{i}" for i in range(20)] * 2),
            rng.choice([None, float(rng.randint(100, 900)), 9000.0]),
            rng.choice(["unknown"] + [f"b{min(i, rng.randint(0, 12))}" for i in range(13)]),
            rng.choice([None, 4.0, 8.0]),
            rng.choice([None, float(rng.randint(10, 20) * 100), 90000.0]),
        )
        for _ in range(n)
    ]


def top(series, k):
    """The k most frequent values; ties by value."""
    counted = series.value_counts().rename_axis("key").reset_index(name="n")
    return counted.sort_values(["n", "key"], ascending=[False, True])["key"][:k]


def in_pandas(rows):
    frame = pd.DataFrame(rows, columns=OFFER_COLUMNS[:-1]).assign(date="2023-01-01").replace({"unknown": None})
    frame = frame.dropna(subset=[MODEL]).dropna(thresh=3)
    frame = frame[frame[BRAND].isin(top(frame[BRAND], 10))]
    frame = frame[frame[MODEL].isin(top(frame[MODEL], 15))]
    for column in (PRICE, CLOCK):
        low, high = frame[column].quantile(0.25), frame[column].quantile(0.75)
        reach = (high - low) * 1.5
        frame = frame[(frame[column] < high + reach) & (frame[column] > low - reach)]
    return frame


def as_set(rows):
    return sorted((tuple(None if pd.isna(v) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_pandas(spark, offers, seed):
    rows = random_offers(seed)
    funnel, expected = Funnel(offers(rows)), in_pandas(rows)
    columns = OFFER_COLUMNS[:-1]
    assert as_set(funnel.rows().select(columns).collect()) == as_set(expected[columns].values.tolist())
    assert as_set(funnel.unique().select(columns).collect()) == as_set(expected[columns].drop_duplicates().values.tolist())


def test_partitioning_does_not_matter(spark, offers):
    rows = random_offers(7)
    frame = offers(rows)
    assert counts(Funnel(frame.coalesce(1))) == counts(Funnel(frame.repartition(9, PRICE)))


def test_ties_break_by_key(spark, offers):
    frame = offers([(m, 1.0, b, 1.0, 1.0) for m, b in [("y", "b"), ("x", "a"), ("z", "c")]])
    funnel = Funnel(frame, top_brands=2, top_models=1)
    assert funnel.brands == ["a", "b"]
    assert funnel.models == ["x"]
    listed = fn.key_counts(frame, MODEL).collect()
    assert [(r[MODEL], r["n"]) for r in listed] == [("x", 1), ("y", 1), ("z", 1)]


def test_three_of_six_missing_is_kept_and_four_is_dropped(spark, offers):
    frame = offers([("m", 1.0, None, None, None), ("m", None, None, None, None), ("m", float("nan"), "b", None, None)])
    kept = fn.min_present(fn.drop_null_model(fn.null_missing(frame))).collect()
    assert [(r[PRICE], r[BRAND]) for r in kept] == [(1.0, None), (None, "b")]


def test_constant_price_removes_every_row(spark, offers):
    funnel = Funnel(offers([("m", 5.0, "b", 1.0, float(c)) for c in range(100)]))
    assert funnel.price_fence.low == funnel.price_fence.high == 5.0
    assert counts(funnel)[6:] == [0, 0, 0, 0]


def test_empty_input(spark, offers):
    funnel = Funnel(offers([]))
    assert counts(funnel) == [0] * 10
    assert funnel.rows().count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=0, max_value=10**6))
def test_steps_never_grow(spark, offers, seed):
    left = counts(Funnel(offers(random_offers(seed, 80))))
    assert left == sorted(left, reverse=True)


def test_filters_reach_the_scan(spark, offers):
    funnel = Funnel(stage(offers(random_offers(1)), "offers"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = funnel.rows()._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("ReadSchema")[0]
    assert "In(brand" in pushed and "LessThan(price_USD" in pushed and "GreaterThan(gpu_clock_speed_MHz" in pushed
    assert "Exchange" not in plan
