"""Exact quantiles by radix selection: no value is shuffled, sorted or stored.

Every double has a 64-bit key in the order of the values. A pass counts rows by the leading bits
of their keys, 2^16 counters at most, and finds the counters in which the wanted ranks lie. The next
pass reads only rows between the least and the largest value of those, a filter that reaches the
scan, and counts by the bits that follow. A counter that holds a single value ends its ranks, so a value with
most of the rows costs no further pass. Up to 16 ranks take five passes at most, whatever the data.

Each pass scans the rows again; where the distinct values are few or staged already,
``quantiles.exact_quantiles`` is the cheaper way.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.functions.doubles import of_order_key, order_key
from offerlens.operators.quantiles import between_ranks

#: Counters of a pass, as a power of two.
COUNTERS = 16


@dataclass(frozen=True)
class _Open:
    """A range of keys that begin with the bits of ``prefix``; ``before`` rows lie below it."""

    prefix: int
    before: int
    ranks: tuple[int, ...]
    low: float
    high: float


def _counted(values: DataFrame, open_ranges: list[_Open], drop: int) -> list:
    """(prefix, n, low, high) of the rows in the ranges, by the key without its last ``drop`` bits."""
    inside = F.lit(False)
    for part in open_ranges:
        inside = inside | F.col("value").between(part.low, part.high)
    prefix = F.shiftright(order_key(F.col("value")), drop).alias("prefix")
    counts = values.where(inside).groupBy(prefix).agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    return sorted(counts.collect(), key=lambda row: row["prefix"])  # 2^COUNTERS rows at most


def _placed(counts: list, before: int, ranks: tuple[int, ...]) -> tuple[dict[int, float], list[_Open]]:
    """Values of the ranks whose counter holds one value, and the ranges of the others."""
    found, rest = {}, []
    for row in counts:
        mine = tuple(r for r in ranks if before <= r < before + row["n"])
        if mine and row["low"] == row["high"]:
            found |= dict.fromkeys(mine, row["low"] + 0.0)
        elif mine:
            rest.append(_Open(row["prefix"], before, mine, row["low"], row["high"]))
        before += row["n"]
    return found, rest


def radix_quantiles(
    df: DataFrame, value: str, probabilities: list[float], weight: Column | None = None
) -> list[float | None]:
    """The linearly interpolated quantiles of a column of doubles, each row counted ``weight`` times.

    NULL and NaN are left out; without rows every quantile is None. Zeros of both signs are one value.
    """
    number = F.col(value).cast("double")
    times = F.lit(1).cast("long") if weight is None else weight.cast("long")
    values = df.select(number.alias("value"), times.alias("n")).where("value is not null and not isnan(value) and n > 0")
    infinite = float("inf")
    drop = 64 - COUNTERS
    counts = _counted(values, [_Open(0, 0, (), -infinite, infinite)], drop)
    total = sum(row["n"] for row in counts)
    if not total:
        return [None] * len(probabilities)
    positions = [p * (total - 1) for p in probabilities]
    ranks = tuple(sorted({f(x) for x in positions for f in (math.floor, math.ceil)}))
    found, rest = _placed(counts, 0, ranks)
    while rest:
        # The ranges share the counters of a pass.
        step = min(drop, max(1, COUNTERS - (len(rest) - 1).bit_length()))
        counts, drop, narrower = _counted(values, rest, drop - step), drop - step, []
        for part in rest:
            mine = [row for row in counts if row["prefix"] >> step == part.prefix]
            values_found, open_ranges = _placed(mine, part.before, part.ranks)
            found |= values_found
            narrower += open_ranges
        if not drop:
            found |= {r: of_order_key(part.prefix) for part in narrower for r in part.ranks}
            narrower = []
        rest = narrower
    return [between_ranks(found, x) for x in positions]
