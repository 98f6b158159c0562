"""Drawing n of n rows with replacement, when equal rows are counted and spread over many tasks.

The counts of a draw are multinomial: they add up to n in every replicate. They are drawn from the
top down. A replicate's n draws are split among ``BUCKETS`` hash ranges, and a bucket's draws among its
cells, halving the cells each time: how many of k draws fall into the left half is binomial
with the share of rows there. So the work follows distinct cells, not rows: a cell of a billion
copies is one leaf like any other. Every bucket draws from a generator of its own, seeded by its
name, over cells in the order of their content, so draws depend neither on partitions nor on
retries. The binomial sampler is numpy's; nothing else of the analysis runs in Python.
"""

import sys
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.staging import stage

# Workers need not be able to import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hash ranges of a group; part of what determines the draws.
BUCKETS = 256


def _generator(*names) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(int.from_bytes(md5(repr(names).encode()).digest())))


def split(counts: np.ndarray, draws: np.ndarray, generator: np.random.Generator) -> Iterator[tuple[int, np.ndarray]]:
    """(place, draws of it) for every count, by halving; ``draws`` has one number a replicate.

    One vector is kept for each level of the halving.
    """
    before = np.concatenate(([0], np.cumsum(counts)))
    todo = [(0, len(counts), draws)]
    while todo:
        low, high, drawn = todo.pop()
        if high - low == 1:
            yield low, drawn
            continue
        middle = (low + high) // 2
        share = (before[middle] - before[low]) / max(before[high] - before[low], 1)
        left = generator.binomial(drawn, min(share, 1.0))
        todo += [(middle, high, drawn - left), (low, middle, left)]


def resampled_sums(
    cells: DataFrame, terms: dict[str, Column], replicates: int, group: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Sums of ``terms`` over drawn rows, and ``n``, for each group and replicate from 1 on.

    ``cells`` hold distinct rows and their count ``n``. A group of n rows draws n of them.
    """
    keys, names = [c for c in cells.columns if c != "n"], list(terms)
    name = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    kept = [F.col(group)] if group else []
    placed = stage(cells.select(
        *kept, name.alias("__group"), "n", F.xxhash64(*keys).alias("__key"), *[t.cast("double").alias(k) for k, t in terms.items()]
    ).withColumn("__bucket", F.pmod(F.col("__key"), F.lit(buckets)).cast("int")), "resampled-cells")

    def of_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A group's draws for its buckets: at most ``buckets`` vectors of a number a replicate."""
        for batch in batches:
            for group_name, rows in zip(batch["__group"], batch["rows"], strict=True):
                rows = sorted((r["bucket"], r["n"]) for r in rows)
                counts = np.array([n for _, n in rows])
                whole = np.full(replicates, counts.sum())
                found = dict(split(counts, whole, _generator("buckets", group_name)))
                yield pd.DataFrame({
                    "__group": group_name, "__bucket": [b for b, _ in rows], "draws": [found[i] for i in range(len(rows))],
                })

    totals = placed.groupBy("__group", "__bucket").agg(F.sum("n").alias("n"))
    listed = totals.groupBy("__group").agg(F.collect_list(F.struct(F.col("__bucket").alias("bucket"), "n")).alias("rows"))
    drawn = listed.mapInPandas(of_buckets, "__group string, __bucket int, draws array<long>")

    def of_cells(key: tuple, cells: pd.DataFrame, drawn: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["__key", *names], ignore_index=True)
        values = {k: cells[k].to_numpy() for k in names}
        sums = {"n": np.zeros(replicates, dtype=np.int64)} | {k: np.zeros(replicates) for k in names}
        draws = np.asarray(drawn["draws"].iloc[0], dtype=np.int64)
        for place, weight in split(cells["n"].to_numpy(), draws, _generator("cells", *map(str, key))):
            sums["n"] += weight
            for k, value in values.items():
                sums[k] += weight * value[place]
        return pd.DataFrame({"__group": key[0], "replicate": np.arange(1, replicates + 1), **sums})

    numbers = ", ".join(["n long", *[f"{k} double" for k in terms]])
    parts = placed.groupBy("__group", "__bucket").cogroup(drawn.groupBy("__group", "__bucket")).applyInPandas(
        of_cells, f"__group string, replicate long, {numbers}"
    )
    sums = parts.groupBy("__group", "replicate").agg(*[F.sum(k).alias(k) for k in ("n", *terms)])
    if not group:
        return sums.drop("__group")
    return sums.join(placed.select("__group", group).distinct(), "__group").drop("__group")
