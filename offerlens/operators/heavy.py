"""The most frequent keys, counted exactly without counting all keys.

Counts of hash buckets add up and are at most ``BUCKETS``; no key is more frequent than its bucket.
The keys of the largest buckets are counted exactly. The k-th of them is a bound that the true k-th
key reaches too, so only buckets of at least that many rows can hold other keys of the top, or ties
with them, and their keys are counted as well. All other buckets are below the k-th count, which is
checked at the end: that proves the result complete. Rare keys are neither shuffled nor stored.

If all keys are about equally frequent, no bucket can be left out, and all keys are counted.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.staging import drop_stage, stage

BUCKETS = 1 << 16
#: Buckets counted first, for each wanted key.
EAGER = 4


def heavy_keys(df: DataFrame, key: str, k: int, weight: Column | None = None, buckets: int = BUCKETS) -> list[tuple[object, int]]:
    """The ``k`` most frequent keys with their rows, each counted ``weight`` times, ties by key; missing keys left out."""
    times = F.lit(1).cast("long") if weight is None else weight.cast("long")
    rows = df.select(
        F.col(key).alias("key"), times.alias("n"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    ).where("key is not null and n > 0")
    sizes = rows.groupBy("bucket").agg(F.sum("n").alias("size"))
    left = sorted(((r["size"], r["bucket"]) for r in sizes.collect()), reverse=True)  # BUCKETS rows at most
    best, bound, share = [], 0, max(EAGER * k, 1)
    while left and k > 0:
        # The first time the largest buckets, then all that may hold a key of the top.
        chosen = left[:share] if not best else [b for b in left if b[0] >= bound]
        if not chosen:
            break
        best = _top(best + _counted(rows, [bucket for _, bucket in chosen], k), k)
        bound = best[-1][1] if len(best) == k else 0
        left = left[len(chosen) :]
    if k > 0 and any(size >= bound for size, _ in left):
        raise AssertionError("a bucket that may hold a frequent key was not counted")
    return best


def _top(counts: list[tuple[object, int]], k: int) -> list[tuple[object, int]]:
    return sorted(sorted(counts), key=lambda pair: -pair[1])[:k]


def _counted(rows: DataFrame, chosen: list[int], k: int) -> list[tuple[object, int]]:
    """The ``k`` most frequent keys of some buckets."""
    # At most BUCKETS numbers.
    wanted = stage(rows.sparkSession.createDataFrame([(b,) for b in chosen], "bucket int"), "heavy-buckets")
    mine = rows.join(F.broadcast(wanted), "bucket", "left_semi")
    found = mine.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(k).collect()
    drop_stage(wanted)
    return [(row["key"], row["n"]) for row in found]
