"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Every source gets a target: a share of the budget by its weight, at most twice its own
   words; the excess goes to the others by weight.
2. Sources get whole blocks of ``block`` words by the highest quotients target / (2k - 1),
   and the documents of a source, dealt to shards by a seeded hash, get theirs the same
   way: each shard has an integer quota. What the blocks leave of a target (less than a
   block per source and shard) is settled in words.
3. A shard lines its documents up in seeded order and cuts the line into blocks. Whole
   passes over the shard come first, the rest of its quota from blocks in seeded order.
   A document takes the words of the chosen blocks that lie on it.

The number of shards of a source grows with the square root of its words, so a hot source
is split into many tasks while quotas stay a small table. Everything is native and depends
only on the rows and the seed. Nothing is collected. The table of sources, one row each, is
ranked by one task: sources are the parts of a mixture, not hosts or authors.

Defined results: a missing text has size 0 and takes nothing; a missing source is a source
of its own; repeated rows are separate documents; ties of quotients go to the smaller
source or shard; an empty table gives an empty one. Input columns that share a name with a
column made here are replaced.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm import words as W
from offerlens.staging import stage

#: Weights of the sources in code point order (missing last), repeating.
WEIGHTS = (3.0, 1.0, 2.0)
BUDGET_SHARE, MAX_REPEATS = 1.5, 2
#: Words of a block; shards of a source: the root of its words over this.
BLOCK, SHARD_ROOT = 1024, 64.0
SEED = 17

MADE = ("size", "source_size", "target", "taken", "passes", "parts")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=BUDGET_SHARE, most=MAX_REPEATS) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources sorted by size over weight fill up in that order: after the first k have
    reached their cap, the others share what is left by weight; the target is the first
    level at which no source is above its cap.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    table = F.array(*[F.lit(float(w)) for w in weights])
    cap = F.col("source_size") * F.lit(float(most))
    order = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(share) * F.sum("source_size").over(Window.partitionBy())
    level = (F.col("budget") - F.col("capped")) / F.col("open_weight")
    first_open = F.min(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("rank"))).over(
        Window.partitionBy()
    )
    final = F.max(F.when(F.col("rank") == F.col("first_open"), F.col("level"))).over(Window.partitionBy())
    return (
        sizes.withColumn("weight", F.element_at(table, F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1))
        .withColumns({
            "cap": cap,
            "rank": F.row_number().over(order),
            "budget": budget,
            "capped": F.coalesce(F.sum(cap).over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(from_here),
        })
        .withColumn("level", level)
        .withColumn("first_open", first_open)
        .withColumn("final", F.coalesce(final, F.lit(float("inf"))))
        .select("source", "source_size", F.least("cap", F.col("final") * F.col("weight")).alias("target"))
    )


def sainte_lague(parties: DataFrame, within: list[str], keys: list[str], weight: str, seats: str) -> DataFrame:
    """``parties`` plus ``won``: the seats of each under the highest quotients weight / (2k - 1).

    ``seats`` is the number to give out in each group ``within``; ``keys`` break ties.
    Rounding weight * seats / total gives all but some n seats right, n being the number of
    parties: the last seats of each are ranked again, as many as its share of n can move.
    """
    group = Window.partitionBy(*within)
    share = F.when(F.col("__total") > 0, F.col(weight) / F.col("__total")).otherwise(0.0)
    near = F.ceil(F.col("__share") * (F.abs(F.col("__excess")) + F.col("__n"))) + 2
    rounded = (
        parties.withColumns({"__total": F.sum(weight).over(group), "__n": F.count(F.lit(1)).over(group)})
        .withColumn("__share", share)
        .withColumn("__round", F.floor(F.col("__share") * F.col(seats) + 0.5))
        .withColumn("__excess", F.sum("__round").over(group) - F.col(seats))
        .withColumn("__sure", F.greatest(F.lit(0), F.col("__round") - near))
        .withColumn("__to_win", F.col(seats) - F.sum("__sure").over(group))
        .withColumn("__last", F.col("__round") + near)
    )
    contested = rounded.withColumn("__k", F.explode(F.sequence(F.col("__sure") + 1, F.col("__last"))))
    best = group.orderBy((F.col(weight) / (2 * F.col("__k") - 1)).desc(), *keys)
    ranked = contested.withColumn("__won", F.row_number().over(best) <= F.col("__to_win"))
    ours = [c for c in parties.columns]
    return (
        ranked.groupBy(*ours, "__sure")
        .agg(F.sum(F.when(F.col("__won") & (F.col(weight) > 0), 1).otherwise(0)).alias("__more"))
        .select(*ours, (F.col("__sure") + F.col("__more")).cast("long").alias("won"))
    )


def _settled(shards: DataFrame, block: int, most: int) -> DataFrame:
    """Quotas in words: blocks, at most ``most`` passes, and the rest of the target by word."""
    source = Window.partitionBy("source")
    line = source.orderBy(F.col("shard_size").desc(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("shard_size") * most
    room = F.when(F.col("open") >= 0, cap - F.col("words")).otherwise(F.col("words"))
    moved = F.greatest(F.lit(0), F.least("room", F.abs("open") - F.coalesce(F.sum("room").over(line), F.lit(0))))
    return (
        shards.withColumn("words", F.least(F.col("won") * block, cap))
        .withColumn("open", F.round("target").cast("long") - F.sum("words").over(source))
        .withColumn("room", room)
        .withColumn("moved", moved)
        .withColumn("quota", F.col("words") + F.signum("open").cast("long") * F.col("moved"))
        .select("source", "shard", "shard_size", "quota")
    )


def _chosen_blocks(shards: DataFrame, block: int, seed: int) -> DataFrame:
    """(source, shard, block_no, words): what each block gives beyond the whole passes."""
    rest = shards.where("shard_size > 0").withColumn("rest", F.col("quota") % F.col("shard_size")).where("rest > 0")
    last = F.floor((F.col("shard_size") - 1) / block)
    blocks = rest.withColumn("block_no", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn(
        "length", F.least(F.lit(block), F.col("shard_size") - F.col("block_no") * block)
    )
    order = Window.partitionBy("source", "shard").orderBy(
        F.xxhash64(F.lit(seed), "source", "shard", "block_no"), "block_no"
    )
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        blocks.withColumn("words", F.least("length", F.col("rest") - before))
        .where("words > 0")
        .select("source", "shard", "block_no", "words")
    )


def mix(
    docs: DataFrame, weights=WEIGHTS, share=BUDGET_SHARE, most=MAX_REPEATS, block=BLOCK, seed=SEED,
    text: str = "text", carry: tuple[str, ...] = ("doc_id", "source"),
) -> DataFrame:
    """The columns ``carry`` of every row of ``docs`` plus:

    ``size`` in words, ``source_size``, ``target`` of the source in words, ``taken`` words,
    ``passes`` (whole copies) and ``parts`` (array of (start, length) in words, the slices
    taken beyond the whole copies).
    """
    whole = W.text_of(F.col(text))
    carry = tuple(dict.fromkeys((*carry, "doc_id", "source")))
    sized = stage(
        docs.select(
            *[c for c in docs.columns if c in carry and c not in MADE],
            W.count_words(whole).alias("size"), F.xxhash64(F.lit(seed), whole).alias("__order"),
        ), "mix-sizes",
    )
    sizes = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = source_targets(sizes, weights, share, most)
    seats = F.round(F.sum("target").over(Window.partitionBy()) / block)
    by_source = sainte_lague(
        targets.withColumn("seats", seats), [], ["source"], "target", "seats"
    ).withColumnRenamed("won", "source_seats").withColumn(
        "n_shards", F.ceil(F.sqrt("source_size") / SHARD_ROOT)
    )
    by_source = stage(by_source.drop("seats"), "mix-targets")

    shard = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "__order"), F.greatest("n_shards", F.lit(1)))
    dealt = W.join_same(sized, by_source, ["source"]).withColumn("shard", shard).drop("n_shards")
    line = Window.partitionBy("source", "shard").orderBy("__order", "doc_id")
    end = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    lined = stage(
        dealt.withColumn("end", end).withColumn("place", F.row_number().over(line)), "mix-lines"
    )
    shards = lined.groupBy("source", "shard", "target", "source_seats").agg(F.sum("size").alias("shard_size"))
    quotas = stage(
        _settled(
            sainte_lague(shards, ["source"], ["shard"], "shard_size", "source_seats"), block, most
        ), "mix-quotas",
    )
    chosen = _chosen_blocks(quotas, block, seed)

    start = F.col("end") - F.col("size")
    touched = F.sequence(F.floor(start / block), F.floor((F.col("end") - 1) / block))
    pieces = lined.where("size > 0").select(
        "source", "shard", "place", start.alias("start"), "end", F.explode(touched).alias("block_no")
    )
    cut_from = F.greatest(F.col("start"), F.col("block_no") * block)
    cut_to = F.least(F.col("end"), F.col("block_no") * block + F.col("words"))
    parts = (
        W.join_same(pieces, chosen, ["source", "shard", "block_no"])
        .select("source", "shard", "place", (cut_from - F.col("start")).alias("start"), (cut_to - cut_from).alias("length"))
        .where("length > 0")
        .groupBy("source", "shard", "place")
        .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("parts"))
    )
    passes = F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.greatest("shard_size", F.lit(1)))).otherwise(0)
    lines = W.join_same(lined, quotas, ["source", "shard"]).withColumn("passes", passes.cast("long"))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    joined = W.join_same(lines.drop("shard_size", "quota"), parts, ["source", "shard", "place"], "left").withColumn(
        "parts", F.coalesce("parts", none)
    )
    in_parts = F.aggregate("parts", F.lit(0).cast("long"), lambda total, p: total + p["length"])
    return joined.withColumn("taken", F.col("passes") * F.col("size") + in_parts).drop(
        "__order", "shard", "source_seats", "end", "place"
    )


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per copy of a mixed document, with the words the mix takes as its text.

    Whole passes keep the text as it is; a last row holds the slices taken beyond them,
    with the white space behind each word.
    """
    pieces = F.regexp_extract_all(F.col(text), F.lit(W.WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    slices = F.transform(
        "parts", lambda p: F.array_join(F.slice(F.col("__pieces"), (p["start"] + 1).cast("int"), p["length"].cast("int")), "")
    )
    rest = [c for c in mixed.columns if c != text]
    copies = F.array_repeat(F.col(text), F.col("passes").cast("int"))
    partial = F.when(F.size("parts") > 0, F.array(F.array_join(slices, ""))).otherwise(F.array().cast("array<string>"))
    return (
        mixed.withColumn("__pieces", F.when(F.size("parts") > 0, pieces).otherwise(F.array().cast("array<string>")))
        .select(*rest, F.explode(F.concat(copies, partial)).alias(text))
    )
