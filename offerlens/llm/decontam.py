"""Benchmark decontamination as a prefix-filtered set join of word shingles.

An item is cut into windows of 13 consecutive words (a shorter item is one window). A
window is the set of its placed shingles of five words; a document contains it only if it
contains all of them, so any one is a necessary prefix. Shingles are ordered by how often
the documents have them and every window is looked up by its rarest one only. A match of
that shingle fixes where the window would have to start; starts before the first word or
ends behind the last are discarded (positional and length bound), the others are verified
word by word.

One scan of the documents hashes their shingles and joins them with those of the
benchmark; what matches carries the words around it, so nothing is read twice to verify.
Documents never leave their rows otherwise: the hashes of the benchmark's shingles are
broadcast in blocks of at most ``BLOCK_SHINGLES`` (16 MB), one scan for each block, as a
shuffle would move every word of every document. Windows of equal words are one window,
however many items repeat them.

Defined results: a missing text has no words; a missing benchmark text or one without
words has no windows; a window found in an item without an id counts as hit but lists no
item; repeated documents are judged alike; an empty benchmark hits nothing. Input columns
that share a name with a column made here are replaced.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm import words as W
from offerlens.staging import drop_stage, stage

WINDOW, SHINGLE = 13, 5
#: Words are runs of lower-case ASCII letters, digits and non-ASCII characters.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Shingle hashes broadcast at a time.
BLOCK_SHINGLES = 1_000_000
#: A document is contaminated if at least one word in so many is hit.
HIT_SHARE = 20

MADE = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def with_words(df: DataFrame, text: str) -> DataFrame:
    pieces = F.split(W.lower_ascii(W.text_of(F.col(text))), BREAKS)
    return df.withColumn("__pieces", pieces).withColumn("words", W.without_empty_ends(F.col("__pieces"))).drop("__pieces")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words): the windows of every item."""
    items = with_words(benchmark.select("item_id", F.col("text").alias("__text")), "__text").where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return items.select("item_id", F.explode(starts).alias("start"), "words").select(
        F.col("item_id").cast("string").alias("item_id"), F.slice("words", F.col("start"), F.lit(window)).alias("words")
    ).distinct()


def _shingles(words: DataFrame, width: int) -> DataFrame:
    """Adds ``grams``, the hashes of every ``width`` words."""
    hashed = words.withColumn("__hash", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("grams", W.window_hashes(F.col("__hash"), width)).drop("__hash")


def _matches(docs: DataFrame, wanted: DataFrame, width: int, window: int) -> DataFrame:
    """(doc_id, text_key, width, gram, pos, near, near_from): where documents have a shingle of ``wanted``."""
    reach = window - width
    # An outer generator gets no filter on its input, which would evaluate the hashes twice.
    placed = _shingles(with_words(docs, "__text"), width).select(
        "doc_id", F.xxhash64("__text").alias("text_key"), "words", F.posexplode_outer("grams").alias("pos", "gram")
    )
    first = F.greatest(F.col("pos") - reach, F.lit(0))
    return placed.join(F.broadcast(wanted.select("gram")), "gram").select(
        "doc_id", "text_key", F.lit(width).alias("width"), "gram", "pos",
        F.slice("words", first + 1, F.col("pos") + window - first).alias("near"), first.alias("near_from"),
    )


def _covered(hits: Column) -> Column:
    """Number of words below the sorted (start, length) pairs ``hits``."""
    return F.aggregate(
        hits,
        F.struct(F.lit(0).alias("covered"), F.lit(0).alias("end")),
        lambda acc, hit: F.struct(
            (acc["covered"] + F.greatest(F.lit(0), hit["start"] + hit["len"] - F.greatest(hit["start"], acc["end"]))).alias("covered"),
            F.greatest(acc["end"], hit["start"] + hit["len"]).alias("end"),
        ),
        lambda acc: acc["covered"],
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, text: str = "text",
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, item_ids, n_items, contaminated), one row per document.

    ``text_key`` is a hash of the text: with ``doc_id`` it names the rows of ``docs`` that
    the verdict belongs to, should a ``doc_id`` repeat.
    """
    items = stage(item_windows(benchmark, window).withColumn("n", F.size("words")), "bench-windows")
    windows = items.select("words", "n", F.least("n", F.lit(shingle)).alias("width")).distinct()
    widths = [r.width for r in windows.select("width").distinct().collect()]  # at most ``shingle`` rows
    per_width = [
        _shingles(windows.where(F.col("width") == width), width).select(
            "words", "n", "width", F.posexplode_outer("grams").alias("offset", "gram")
        )
        for width in widths
    ] or [windows.selectExpr("words", "n", "width", "0 as offset", "cast(0 as bigint) as gram")]
    shingles = per_width[0]
    for more in per_width[1:]:
        shingles = shingles.unionAll(more)

    texts = docs.select(_doc_id(docs), W.text_of(F.col(text)).alias("__text"))
    wanted = stage(shingles.select("width", "gram").distinct(), "bench-grams")
    blocks = max(1, -(-wanted.count() // BLOCK_SHINGLES))
    block = F.pmod("gram", F.lit(blocks))
    found = [
        _matches(texts, wanted.where((F.col("width") == width) & (block == k)), width, window)
        for width in widths or [shingle] for k in range(blocks)
    ]
    matches = found[0]
    for more in found[1:]:
        matches = matches.unionAll(more)
    matches = stage(matches, "bench-matches")

    # Order the shingles by rarity; a window with a shingle that no document has cannot occur.
    often = matches.groupBy("width", "gram").agg(F.count(F.lit(1)).alias("often"))
    rarest = F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "gram", "offset")).alias("prefix")
    prefixes = shingles.join(often, ["width", "gram"], "left").groupBy("words", "n", "width").agg(rarest).where(
        "prefix.often > 0"
    ).select("words", "n", "width", "prefix.gram", "prefix.offset")
    start = F.col("pos") - F.col("offset")
    in_near = F.slice("near", start - F.col("near_from") + 1, F.col("n"))
    hits = stage(
        matches.join(prefixes, ["width", "gram"])
        .where(start >= F.col("near_from")).where(in_near == F.col("words"))
        .select("doc_id", "text_key", start.alias("start"), F.col("n").alias("len"), "words").distinct(), "bench-hits",
    )
    drop_stage(matches)

    places = hits.groupBy("doc_id", "text_key").agg(
        _covered(F.sort_array(F.collect_set(F.struct("start", "len")))).cast("long").alias("n_hit")
    )
    ids = (
        hits.select("doc_id", "text_key", "words").distinct().join(items.select("item_id", "words"), "words")
        .groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    )
    verdicts = W.join_same(places, ids, ["doc_id", "text_key"], "left")
    counted = with_words(texts, "__text").select(
        "doc_id", F.xxhash64("__text").alias("text_key"), F.size("words").cast("long").alias("n_words")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return W.join_same(counted, verdicts, ["doc_id", "text_key"], "left").select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce(F.size(F.when(F.col("item_ids").isNotNull(), F.col("item_ids"))), F.lit(0)).cast("long").alias("n_items"),
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _doc_id(docs: DataFrame) -> Column:
    return F.col("doc_id") if "doc_id" in docs.columns else F.lit(None).cast("long").alias("doc_id")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    bad = (
        contamination(docs, benchmark, text=text).where("contaminated").select("doc_id", "text_key").distinct()
    )
    keyed = docs.withColumn("__text_key", F.xxhash64(W.text_of(F.col(text))))
    bad = stage(bad, "bench-contaminated").withColumnsRenamed({"doc_id": "__bad_id", "text_key": "__bad_key"})
    same = F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (F.col("__text_key") == F.col("__bad_key"))
    return keyed.join(bad, same, "left_anti").drop("__text_key")
