"""Exact, linearly interpolated quantiles of weighted values."""

import math
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from offerlens.staging import drop_stage, stage


def value_counts(df: DataFrame, value: str, weight: Column | None = None) -> DataFrame:
    """Distinct non-missing values with their number of rows."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(n.cast("long").alias("n"))


def exact_quantiles(
    df: DataFrame, value: str, probabilities: list[float], weight: Column | None = None
) -> list[float | None]:
    """The quantiles of ``value``, each row counted ``weight`` times; None without rows.

    Copies of a value are counted before anything is gathered, so a value that
    holds most rows costs no more than another. The counts are range-partitioned:
    the totals of the partitions locate the wanted ranks.
    """
    counts = value_counts(df, value, weight)
    slices = stage(
        counts.repartitionByRange(F.col(value)).withColumn("slice", F.spark_partition_id()), "value-counts"
    )
    # One row per range partition: bounded by the number of partitions.
    totals = slices.groupBy("slice").agg(F.sum("n").alias("n")).orderBy("slice").collect()
    if not totals:
        drop_stage(slices)
        return [None] * len(probabilities)
    ends = list(accumulate(row["n"] for row in totals))
    total = ends[-1]
    positions = [p * (total - 1) for p in probabilities]
    ranks = sorted({f(x) for x in positions for f in (math.floor, math.ceil)})

    # Where each rank lies: its slice, and how many rows of the slice come before it.
    places = {}
    for rank in ranks:
        at = next(i for i, end in enumerate(ends) if rank < end)
        places[rank] = (totals[at]["slice"], rank - (ends[at] - totals[at]["n"]))
    # Only the slices that hold a wanted rank are sorted, each in its own task.
    running = Window.partitionBy("slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    sorted_slices = slices.where(F.col("slice").isin([s for s, _ in places.values()])).withColumn(
        "end", F.sum("n").over(running)
    )
    hit = reduce(
        lambda a, b: a | b,
        [(F.col("slice") == s) & (F.col("end") > k) & (F.col("end") - F.col("n") <= k) for s, k in places.values()],
    )
    # At most one row per rank.
    hits = sorted_slices.where(hit).collect()
    drop_stage(slices)
    found = {
        rank: next(h[value] for h in hits if h["slice"] == s and h["end"] - h["n"] <= k < h["end"])
        for rank, (s, k) in places.items()
    }

    return [between_ranks(found, x) for x in positions]


def between_ranks(found: dict[int, float], position: float) -> float:
    """The value at a position between two ranks, on the line between their values."""
    low, high = math.floor(position), math.ceil(position)
    if low == high or found[low] == found[high]:
        return float(found[low])
    return (high - position) * found[low] + (position - low) * found[high]
