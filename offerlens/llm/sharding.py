"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Groups are documents of equal text, and a group stays in one shard. Small ones are dealt to
``CELLS`` cells by a hash of their text; one that is larger than a cell is packed by itself. Only a
group of more than ``WHOLE`` of a shard's share of all bytes is cut, into pieces of up to that
size, or no law could keep shards near equal. There are at most ``3 * CELLS`` groups, pieces and
cells to pack, whatever the input: their vectors (bytes, tokens, rows) are packed one by one,
largest first, each where the dot product with the shard's residual capacity is highest.
That small table is all the driver sees.

Slots count up within a shard: cells follow one another, and rows are numbered within
parts of a cell, so no task sorts a shard.

Defined results: a missing text is an empty one (size 1, as every size has one byte for
the separator); repeated rows get slots of their own; an empty table gives an empty one; texts of
any length are one row's bytes, never cut; of shards with equal room the lower one is taken.
Input columns that share a name with a column made here are replaced.
"""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm import words as W
from offerlens.staging import stage

SHARDS, CELLS = 16, 2048
#: Of a shard's share of all bytes: the most that a group may have and stay whole in any case.
WHOLE = 0.5
#: Of bytes, tokens and rows in the dot product: bytes come first.
WEIGHTS = (16.0, 1.0, 1.0)
#: Rows of a part of a cell, within which rows are numbered by one task.
PART_ROWS = 50_000
MADE = ("size", "tokens", "text_crc32", "law", "shard", "slot")


def pack(vectors: np.ndarray, shards: int = SHARDS, weights=WEIGHTS) -> np.ndarray:
    """The shard of every row of ``vectors`` (cells by resources).

    Resources are scaled to a total of one per shard, times their weight. A cell goes where
    its dot product with what the shards have left is highest; the lower shard wins a tie.
    """
    totals = vectors.sum(axis=0).astype(float)
    scaled = vectors / np.where(totals > 0, totals, 1.0) * shards * np.sqrt(weights)
    left = np.ones((shards, vectors.shape[1])) * np.sqrt(weights)
    placed = np.empty(len(vectors), dtype=np.int64)
    for cell in np.argsort(-scaled.max(axis=1), kind="stable"):
        shard = int(np.argmax(left @ scaled[cell]))
        placed[cell] = shard
        left[shard] -= scaled[cell]
    return placed


def shard(docs: DataFrame, shards: int = SHARDS, cells: int = CELLS, text: str = "text",
          carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` plus ``size`` (bytes), ``tokens`` (words), ``text_crc32``, ``shard``, ``slot``."""
    whole = W.text_of(F.col(text))
    carry = tuple(dict.fromkeys((*carry, "doc_id")))
    sized = stage(
        docs.select(
            *[c for c in docs.columns if c in carry and c not in MADE],
            (F.octet_length(whole) + 1).cast("long").alias("size"),
            W.count_words(whole).alias("tokens"), F.crc32(whole.cast("binary")).alias("text_crc32"),
            F.xxhash64(whole).alias("__group"), F.monotonically_increasing_id().alias("__row"),
        ), "shard-sizes",
    )
    spark = docs.sparkSession
    totals = sized.agg(F.sum("size").alias("size")).first()
    cell_bytes = max(1, -(-(totals.size or 0) // cells))
    most = max(1, int(WHOLE * (totals.size or 0) / shards))
    # A large group has more bytes than a cell, so there are fewer of them than cells.
    large = sized.groupBy("__group").agg(F.sum("size").alias("group_bytes")).where(F.col("group_bytes") > cell_bytes)
    large = stage(large.select("__group", F.ceil(F.col("group_bytes") / most).alias("__pieces")), "shard-large")
    # Repeated rows of a group that is cut are dealt like others: each by itself.
    piece = F.pmod(F.xxhash64("doc_id", "__group", "__row"), F.col("__pieces"))
    in_cell = F.pmod(F.col("__group"), F.lit(cells))
    celled = sized.join(large, "__group", "left").withColumn(
        "__cell", F.when(F.col("__pieces").isNotNull(), F.struct(F.col("__group").alias("g"), piece.alias("p")))
        .otherwise(F.struct(in_cell.alias("g"), F.lit(-1).cast("long").alias("p")))
    ).drop("__pieces")
    celled = stage(celled.select(*sized.columns, "__cell.g", "__cell.p"), "shard-cells")
    # One row per cell and part: at most 3 * cells of them; parts are as many as rows ask for.
    table = (
        celled.groupBy("g", "p").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("size"), "g", "p").collect()
    )
    placed = pack(np.array([[r.size, r.tokens, r.rows] for r in table], dtype=float).reshape(-1, 3), shards)
    starts = np.zeros(shards, dtype=np.int64)
    plan = []
    for row, to in zip(table, placed, strict=True):
        plan.append((row.g, row.p, int(to), int(starts[to]), int(-(-row.rows // PART_ROWS))))
        starts[to] += row.rows
    plan = spark.createDataFrame(plan, "g long, p long, shard int, __start long, __parts long")
    part = F.pmod(F.xxhash64("doc_id", "__row"), F.col("__parts"))
    dealt = celled.join(plan, ["g", "p"]).withColumn("__part", part)
    return _slots(dealt).select(*sized.columns, "shard", "slot").drop("__group", "__row")


def _slots(dealt: DataFrame) -> DataFrame:
    """Adds ``slot``: the start of the cell, plus the parts before, plus the row within its part."""
    cell = Window.partitionBy("g", "p")
    rows = dealt.groupBy("g", "p", "__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(cell.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = rows.select("g", "p", "__part", before.alias("__before"))
    within = F.row_number().over(Window.partitionBy("g", "p", "__part").orderBy("doc_id", "__group")) - 1
    return (
        dealt.withColumn("__within", within).join(offsets, ["g", "p", "__part"])
        .withColumn("slot", (F.col("__start") + F.col("__before") + F.col("__within")).cast("long"))
    )
