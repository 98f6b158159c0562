"""Near copies by an n-gram Jaccard join with a universe partition.

Two shingle sets of sizes r and s with similarity of at least 0.8 differ in at most
H = (r + s) / 9 shingles. The universe of hashes is cut into m segments, m depending on
the size band; H differences touch at most H segments, so the sets agree exactly in the
others (pigeonhole). What is indexed:

* sets of 64 shingles and more: the subsets of the first segments in which the set has
  shingles at all, H + 1 and a reserve R that a size band shares. m is so large that there are
  as many. Of the first H + 1 + R segments of one set at most H differ in a similar one, and the
  others are among the first of that set as well, so the two have R + 1 keys in common;
* smaller sets: also the one-deletion neighbourhood of each segment subset, which finds
  segments that differ by one shingle. Such a segment counts twice, so a few are enough.

A size band spans a factor of two. A set is indexed in its own band, and in the next one if
a similar set could be in it.

Cost-based allocation: a key that no other set has costs nothing and counts towards the
bound. A set whose shared keys are no more than it can spare has no partner and leaves the
index (``PEELINGS`` times, as keys lose members). A set that stays drops the keys with most
members (threshold -1) while the others still outnumber H, and looks its partners up under
the rest; it stays indexed under all.

Links are found in rounds. At first the sets of a key are compared with the smallest one of
them only; verified pairs give components. Then those outside the largest component of a key
are compared with one member of it, another one for each key and round. Last, what is still
apart is looked up exhaustively: of two components the smaller one asks. Pairs under keys of
few sets are listed; sets under keys of many are compared block by block, without a row for
each pair. A family of thousands of near copies thus costs a few comparisons per copy, and no
link between components is lost. Every candidate is verified on its whole sets, a listed pair
in the first round that names it only.

Sets are first reduced to classes of equal sets, so exact copies never enter the join.
Components are found by label hooking on the links, staged in the shared folder.

Defined results: a text without words is linked with nothing and is its own component;
repeated rows are equal sets; a missing doc_id is a member but never names a component,
unless no member has an id; an empty table gives an empty one. All columns but ``doc_id``
and ``text`` are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm import words as W
from offerlens.llm.shingles import mix64, shingle_sets
from offerlens.staging import drop_stage, stage

#: Similar sets share at least this percentage of their union.
PERCENT = 80
#: Times that sets without a partner are taken out before candidates are made.
PEELINGS = 1
#: Rows of a key held at a time.
HELD = 32
#: Rounds of comparisons with single members of the largest component.
STAR_ROUNDS = 1
#: Sets of a key beyond which they are compared in blocks, and sets of a block.
LISTED, BLOCK = 32, 256
#: Bits of a key that are kept; keys that agree in them by chance add candidates and lose none.
KEY_BITS = 48
#: Most bits of the filter of rows whose sets are needed.
BITMAP = 1 << 27
#: Smaller bands also index one-deletion neighbourhoods.
DELETIONS_BELOW = 64

_U = np.uint64
EXACT, DELETION = 0, 1


def band_of(size: int) -> int:
    return size.bit_length() - 1


def segments(band: int) -> int:
    """Segments of the universe for sets of 2^band to 2^(band + 1) shingles."""
    top = 2 << band
    if top <= 32:
        return 64
    share = 0.75 if top <= 128 else 0.5 if top <= 256 else 0.4 if top <= 512 else 0.32 if top <= 1024 else 0.28
    return int(top * share)


def needed(size: int, largest: int) -> int:
    """Matching segments to look for so that no partner of up to ``largest`` shingles is lost."""
    return (size + largest) * (100 - PERCENT) // (100 + PERCENT) + 1


def reserve(band: int) -> int:
    """Segments that sets of a band index beyond those they need, to spare hot ones; the same for all of them."""
    return max(8, (2 << band) // 32)


def bands(size: int) -> list[tuple[int, int]]:
    """(band, segments needed) of a set; none if only an equal set is similar to it."""
    largest = size * 100 // PERCENT
    if largest == size:
        return []
    own, top = band_of(size), (2 << band_of(size)) - 1
    found = [(own, needed(size, min(largest, top)))]
    if largest > top:
        found.append((own + 1, needed(size, largest)))
    return found


def subset_keys(found: np.ndarray, mixed: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the segment subsets, keys of their one-deletions, sizes of the subsets).

    Hashes are sorted and segments are ranges of hashes, so a subset is a slice. A key is a
    hash of band, segment and the sum of the members' mixed hashes.
    """
    segment = ((found >> _U(32)) * _U(segments(band))) >> _U(32)
    first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    sums = np.add.reduceat(mixed, first)
    sizes = np.diff(np.append(first, len(found)))
    place = (segment[first] + _U(1)) * _U(0xA24BAED4963EE407) ^ mix64(np.full(1, band + 1, dtype=np.uint64))
    keys = mix64(mix64(sums) ^ place)
    if (1 << band) >= DELETIONS_BELOW:
        return keys, keys[:0], sizes
    several = np.repeat(sizes > 1, sizes)
    without = (np.repeat(sums, sizes) - mixed)[several]
    return keys, mix64(mix64(without) ^ np.repeat(place, sizes)[several]), sizes


def set_class(found: np.ndarray) -> int:
    """A 64-bit name of a set."""
    parts = np.array([mix64(found).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(found ^ _U(0x5851F42D4C957F2D)))])
    return int(mix64(parts[:1] ^ mix64(parts[1:] + _U(len(found)))).view(np.int64)[0])


_MEMBERS = "doc_id long, text_key long, n_shingles long, set_class long"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and class of the set of every document."""
    for batch in batches:
        sizes, classes = [], []
        for _, found in shingle_sets(batch.column(1)):
            sizes.append(len(found))
            classes.append(set_class(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64())],
            names=["doc_id", "text_key", "n_shingles", "set_class"],
        )


#: ``band`` packs three numbers: 1 for the next band, 2 if subsets count twice, 4 times what can be spared.
_KEYS = "key long, kind int, band int, set_class long"


def _index_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of every set, once per task and class."""
    seen: set[int] = set()
    for batch in batches:
        keys, kinds, packed, classes, rows = [], [], [], [], 0
        for _, found in shingle_sets(batch.column(1)):
            if len(found) < 2 or (name := set_class(found)) in seen:
                continue
            seen.add(name)
            mixed = mix64(found)
            for step, (band, need) in enumerate(bands(len(found))):
                exact, deleted, sizes = subset_keys(found, mixed, band)
                twice = (1 << band) < DELETIONS_BELOW
                if not twice:
                    exact = exact[: need + reserve(band)]
                spare = len(exact) + (int((sizes > 1).sum()) if twice else 0) - need
                if spare < 0:
                    raise ValueError(f"{len(found)} shingles fall into {len(exact)} segments; change segments()")
                for kind, some in ((EXACT, exact), (DELETION, deleted)):
                    keys.append(some)
                    kinds.append(np.full(len(some), kind, np.int32))
                    packed.append(np.full(len(some), step + 2 * twice + 4 * spare, np.int32))
                    classes.append(np.full(len(some), name, np.int64))
                    rows += len(some)
            if rows > 200_000:
                yield _key_batch(keys, kinds, packed, classes)
                keys, kinds, packed, classes, rows = [], [], [], [], 0
        if rows:
            yield _key_batch(keys, kinds, packed, classes)


def _key_batch(keys, kinds, packed, classes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array((np.concatenate(keys) >> _U(64 - KEY_BITS)).view(np.int64)), pa.array(np.concatenate(kinds)),
         pa.array(np.concatenate(packed)), pa.array(np.concatenate(classes))],
        names=["key", "kind", "band", "set_class"],
    )


_SHARED = _KEYS


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that two or more sets share, from rows sorted by key, kind and class.

    A key that a batch leaves open waits for the next one, unless it has more than ``HELD``
    rows: then they are handed on, and so are all that follow, without being held.
    """
    held = np.empty((0, 4), np.int64)
    large = None
    for batch in batches:
        rows = np.stack([batch.column(i).cast(pa.int64()).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
        rows = np.concatenate([held, rows])
        held = rows[:0]
        rows = rows[np.concatenate(([True], (rows[1:] != rows[:-1])[:, [0, 1, 3]].any(axis=1)))]
        if large is not None:
            run = rows[:, 0] == large
            yield _shared_batch(rows[run])
            rows = rows[~run]
            if not len(rows):
                continue
            large = None
        first = np.flatnonzero(np.concatenate(([True], rows[1:, 0] != rows[:-1, 0])))
        sizes = np.diff(np.append(first, len(rows)))
        if sizes[-1] > HELD:
            large = rows[-1, 0]
        else:
            held, rows, first, sizes = rows[first[-1] :], rows[: first[-1]], first[:-1], sizes[:-1]
        yield _shared(rows, first, sizes)
    if len(held):
        yield _shared(held, np.zeros(1, np.int64), np.array([len(held)]))


def _shared(rows: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    # Deletions alone differ by two shingles; they need a subset to match with.
    return _shared_batch(rows[np.repeat((sizes > 1) & (rows[first, 1] == EXACT), sizes)])


def _shared_batch(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[:, 0]), pa.array(rows[:, 1].astype(np.int32)), pa.array(rows[:, 2].astype(np.int32)),
         pa.array(rows[:, 3])],
        names=["key", "kind", "band", "set_class"],
    )


#: Shifts of a 64-bit name that give a row's places in the filter.
_PROBES = (0, 18, 37)
_SETS = "set_class long, repeated boolean, shingles array<long>"


def _survivors(kept: DataFrame, texts: DataFrame, known: DataFrame) -> DataFrame:
    """(set_class, shingles) of all sets in ``kept``, built once from the texts, staged.

    Each class is built from one row, its first. A Bloom filter of those rows, of a size
    bounded by ``BITMAP``, tells the scan which; a row that only looks like one adds a set
    that no pair asks for, or a class twice, and neither changes a link. Of rows that
    repeat, with one id and text, every task keeps one, and one of those is kept here.
    Sets are shuffled for no other reason, unless there are too many classes for the filter
    to tell rows apart: then a join keeps those that are wanted.
    """
    classes = stage(
        kept.select("set_class").distinct().join(
            known.select("set_class", "doc_id", "text_key", "repeats"), "set_class"
        ), "jaccard-survivors",
    )
    n_classes = classes.count()
    bits = min(BITMAP, 1 << max(16, (16 * n_classes).bit_length()))
    name = F.col("set_class").bitwiseXOR(F.xxhash64("doc_id", "text_key"))
    places = F.array(*[F.shiftrightunsigned(name, shift).bitwiseAND(F.lit(bits - 1)) for shift in _PROBES])
    placed = classes.select("repeats", F.explode(places).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = placed.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(bit).alias("wanted"), F.bit_or(F.when(F.col("repeats") > 1, bit).otherwise(0)).alias("repeated")
    ).toArrow()
    bitmaps = np.zeros((2, bits // 64), dtype=np.int64)
    for bitmap, column in zip(bitmaps, ("wanted", "repeated"), strict=True):
        bitmap[words.column("word").to_numpy()] = words.column(column).to_numpy()
    shared_bitmaps = kept.sparkSession.sparkContext.broadcast(bitmaps.view(np.uint64))

    def holds(bitmap: np.ndarray, name: int) -> bool:
        places = ((name >> shift) & (bits - 1) for shift in _PROBES)
        return all(int(bitmap[place >> 6]) >> (place & 63) & 1 for place in places)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, repeated = shared_bitmaps.value
        seen: set[int] = set()
        for batch in batches:
            names, repeats, found_sets, size = [], [], [], 0
            for row, found in shingle_sets(batch.column(1)):
                if not len(found):
                    continue
                name = set_class(found)
                place = (name ^ batch.column(2)[row].as_py()) & (2**64 - 1)
                if not holds(wanted, place) or name in seen:
                    continue
                seen.add(name)
                names.append(name)
                repeats.append(holds(repeated, place))
                found_sets.append(found.view(np.int64))
                size += len(found)
                if size > 500_000:
                    yield _set_batch(names, repeats, found_sets)
                    names, repeats, found_sets, size = [], [], [], 0
            if names:
                yield _set_batch(names, repeats, found_sets)

    rows = texts.select("doc_id", "text", F.xxhash64("doc_id", "text_key").alias("row_key"))
    made = rows.mapInArrow(sets, _SETS)
    if bits < 8 * n_classes:
        made = made.join(classes.select("set_class"), "set_class", "left_semi")
    made = stage(made, "jaccard-sets")
    once = stage(made.where("repeated").dropDuplicates(["set_class"]), "jaccard-sets")
    result = made.where("not repeated").union(once).select("set_class", "shingles")
    shared_bitmaps.unpersist()
    return result


def _set_batch(names: list[int], repeats: list[bool], sets: list[np.ndarray]) -> pa.RecordBatch:
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(sets)))
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(repeats), lists], names=["set_class", "repeated", "shingles"]
    )


def _verified(pairs: DataFrame, sets: DataFrame, known: DataFrame, judged: list[DataFrame]) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar, staged. Sizes rule out most others first.

    Pairs in ``judged`` were compared in earlier rounds and are left out; those compared now are added to it.
    """
    sizes = known.select("set_class", "n_shingles")
    a, b = (sizes.withColumnsRenamed({"set_class": name, "n_shingles": f"n_{name}"}) for name in "ab")
    for before in judged:
        pairs = pairs.join(before, ["a", "b"], "left_anti")
    sized = stage(
        pairs.join(a, "a").join(b, "b").where(100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b"))
        .select("a", "b"), "jaccard-pairs",
    )
    judged.append(sized)
    with_b = sized.join(sets.withColumnsRenamed({"set_class": "b", "shingles": "of_b"}), "b")
    both = with_b.join(sets.withColumnsRenamed({"set_class": "a", "shingles": "of_a"}), "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    # The sets travel with the row no further than this generator; see words.computed_once.
    compared = both.select("a", "b", F.inline(F.array(F.struct(common.alias("common"), union.alias("whole")))))
    return stage(compared.where(100 * F.col("common") >= PERCENT * F.col("whole")).select("a", "b"), "jaccard-links")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b), for every node in a link.

    Each round hooks a node and its parent to the smallest grandparent among the neighbours
    and shortens the paths; rounds are few, as paths halve. Every round is staged.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(both.where("a != b").distinct(), "components-edges")
    nodes = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent")), "components")
    while True:
        up = nodes.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        grand = stage(nodes.join(up, "parent").select("node", "parent", "grand"), "components-grand")
        around = edges.join(grand.select(F.col("node").alias("b"), "grand"), "b").groupBy("a").agg(F.min("grand").alias("least"))
        near = grand.join(around.withColumnRenamed("a", "node"), "node")
        offers = (
            near.select("node", F.least("grand", "least").alias("parent"))
            .union(near.select("parent", F.least("grand", "least")))
            .union(near.select("grand", "least"))
        )
        hooked = stage(offers.groupBy("node").agg(F.min("parent").alias("parent")), "components")
        hooked = hooked.select("node", F.least("node", "parent").alias("parent"))
        changed = hooked.join(nodes.withColumnRenamed("parent", "was"), "node").where("parent != was").limit(1).count()
        drop_stage(grand)
        drop_stage(nodes)
        nodes = hooked
        if not changed:
            drop_stage(edges)
            return nodes.withColumnRenamed("parent", "component")


def near_copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id), one row per row of ``docs``.

    ``text_key`` is a hash of the text; with ``doc_id`` it names the row.
    """
    texts = docs.select(F.col("doc_id").cast("long"), W.text_of(F.col(text)).alias("text"))
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    members = stage(
        keyed.select("doc_id", "text", "text_key").mapInArrow(_members, _MEMBERS), "jaccard-members"
    )
    named = members.where("set_class is not null")
    rows = named.groupBy("set_class", "doc_id", "text_key").agg(
        F.first("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("repeats")
    )
    known = stage(
        rows.groupBy("set_class").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "repeats")).alias("first"),
            F.first("n_shingles").alias("n_shingles"),
        ).select("set_class", "n_shingles", "first.doc_id", "first.text_key", "first.repeats"), "jaccard-classes",
    )
    index = texts.mapInArrow(_index_keys, _KEYS).repartition(F.col("key")).sortWithinPartitions("key", "kind", "set_class")
    shared = stage(index.mapInArrow(_shared_keys, _SHARED), "jaccard-shared")

    kept = _allocated(shared)
    drop_stage(shared)

    sets = _survivors(kept, keyed, known)
    judged: list[DataFrame] = []
    links = _verified(_ordered(_stars(kept)), sets, known, judged)
    found = components(links)
    for number in range(STAR_ROUNDS):
        open_keys = _open_keys(kept, found)
        more = _verified(_ordered(_stars(open_keys, number)), sets, known, judged)
        if not more.limit(1).count():
            break
        links = links.union(more)
        found = components(links)
    rest = _open_keys(kept, found)
    listed, large = _by_members(rest)
    more = _verified(_ordered(_lookups(listed)), sets, known, judged).union(_links_of_blocks(large, sets))
    if more.limit(1).count():
        found = components(links.union(more))
    for frame in (kept, *judged):
        drop_stage(frame)

    # Staged sides let the planner split a class or component that holds many rows.
    labelled = stage(known.select("set_class").join(found.withColumnRenamed("node", "set_class"), "set_class").select(
        "set_class", "component"
    ), "jaccard-labelled")
    linked = named.select("doc_id", "text_key", "n_shingles", "set_class").join(labelled, "set_class", "left").withColumn(
        "component", F.coalesce("component", "set_class")
    )
    names = stage(linked.groupBy("component").agg(F.min("doc_id").alias("component_id")), "jaccard-names")
    lone = members.where("set_class is null").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.join(names, "component").select("doc_id", "text_key", "n_shingles", "component_id").union(lone)


def _allocated(shared: DataFrame) -> DataFrame:
    """(key, kind, set_class, asks) of the sets that can have a partner.

    ``asks`` is false for the keys with most members, as many as the set can spare.
    """
    # In a band with deletions a subset counts twice.
    units = F.when((F.col("kind") == EXACT) & (F.col("band").bitwiseAND(2) > 0), 2).otherwise(1)
    rows = shared.select(
        "key", "kind", F.col("band").bitwiseAND(1).alias("next"), "set_class", units.alias("units"),
        F.shiftright("band", 2).alias("spare"),
    )
    for number in range(PEELINGS):
        total = F.sum("units").over(Window.partitionBy("set_class", "next"))
        left = rows.withColumn("total", total).where("total > spare").drop("total")
        sizes = left.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("kind").alias("least")).where(
            f"members > 1 and least = {EXACT}"
        ).select("key", "members")
        peeled = stage(left.drop("members").join(sizes, "key"), "jaccard-peeled")
        if number:
            drop_stage(rows)
        rows = peeled
    hottest = Window.partitionBy("set_class", "next").orderBy(F.desc("members"), "key")
    dropped = F.sum("units").over(hottest.rowsBetween(Window.unboundedPreceding, 0))
    kept = stage(
        rows.withColumn("dropped", dropped).select("key", "kind", "set_class", (F.col("dropped") > F.col("spare")).alias("asks")),
        "jaccard-kept",
    )
    drop_stage(rows)
    return kept


def _open_keys(kept: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of keys whose sets are in several components, with ``component`` and its ``size``."""
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    sized = stage(found.join(sizes, "component").withColumnRenamed("node", "set_class"), "jaccard-sizes")
    rows = kept.join(sized, "set_class", "left").select(
        "key", "kind", "set_class", "asks",
        F.coalesce("component", "set_class").alias("component"), F.coalesce("size", F.lit(1)).alias("size"),
    )
    unresolved = rows.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low != high and n > 2").select("key")
    unresolved = stage(unresolved, "jaccard-unresolved")
    return stage(rows.join(unresolved, "key"), "jaccard-open")


def _stars(rows: DataFrame, number: int | None = None) -> DataFrame:
    """(a, b): each set of a key with the key's leader, one row per set and key.

    At first the leader is the smallest class; in round ``number`` it is a member of the
    largest component, by a hash of class, key and round, for the sets outside.
    """
    if number is None:
        order, apart = F.struct(F.lit(0), F.lit(0), -F.col("set_class"), "set_class"), F.col("set_class") != F.col("a")
        rows = rows.withColumn("component", F.col("set_class"))
    else:
        order = F.struct("size", "component", F.xxhash64("set_class", "key", F.lit(number)), "set_class")
        apart = F.col("component") != F.col("lead")
    best = F.max(F.when(F.col("kind") == EXACT, F.struct(order.alias("o"), "component"))).alias("best")
    leaders = rows.groupBy("key").agg(best).where("best is not null").select(
        "key", F.col("best.o.set_class").alias("a"), F.col("best.component").alias("lead")
    )
    leaders = stage(leaders, "jaccard-leaders")
    return rows.join(leaders, "key").where(apart).select("a", F.col("set_class").alias("b"))


def _by_members(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` of keys with few and with many sets, the latter with the largest component of
    their key as ``family``."""
    keys = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct("size", "component")).getField("component").alias("family")
    )
    rows = rows.join(stage(keys, "jaccard-key-sizes"), "key")
    return rows.where(f"n <= {LISTED}"), rows.where(f"n > {LISTED}")


def _links_of_blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of the sets that ask under keys of many sets, staged.

    Whoever shares such a key belongs to the key's family. In each family the sets that ask
    are compared with all others, cut into blocks of some ``BLOCK`` sets by a hash.
    """
    others = stage(rows.select("family", "set_class", "component").distinct(), "jaccard-family")
    askers = stage(
        rows.where("asks and component != family").select("family", "set_class", "component").distinct(), "jaccard-askers"
    )
    def blocks_of(sides: DataFrame, name: str) -> DataFrame:
        return sides.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))

    cuts = blocks_of(askers, "nx").join(blocks_of(others, "ny"), "family")

    def side(sets_of: DataFrame, asks: bool, own: str, other: str) -> DataFrame:
        cut = sets_of.join(cuts, "family").join(sets, "set_class")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
        return cut.select(
            "family", F.lit(asks).alias("asks"), "set_class", "component", "shingles",
            F.pmod(F.xxhash64("set_class"), F.col(own)).alias(own), every.alias(other),
        ).select("family", "nx", "ny", "asks", "set_class", "component", "shingles")

    both = side(askers, True, "nx", "ny").unionByName(side(others, False, "ny", "nx"))
    links = both.groupBy("family", "nx", "ny").applyInPandas(_compare_block, "a long, b long")
    return stage(_ordered(links), "jaccard-links")


def _compare_block(block: pd.DataFrame) -> pd.DataFrame:
    """Similar sets of different components, one of them asking: (a, b)."""
    x, y = block[block.asks], block[~block.asks]
    if not len(x) or not len(y):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    sizes_x, sizes_y = (np.array([len(s) for s in side.shingles]) for side in (x, y))
    of_x, of_y = np.concatenate(list(x.shingles)), np.concatenate(list(y.shingles))
    shared = np.intersect1d(of_x, of_y)
    common = np.zeros((len(x), len(y)), dtype=np.float32)
    # Shared shingles, some thousands at a time, as columns of two 0/1 matrices.
    places = []
    for values, sizes in ((of_x, sizes_x), (of_y, sizes_y)):
        at = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        there = shared[at] == values if len(shared) else np.zeros(len(values), dtype=bool)
        places.append((np.repeat(np.arange(len(sizes)), sizes)[there], at[there]))
    for start in range(0, len(shared), 4096):
        parts = []
        for (row, column), side in zip(places, (x, y), strict=True):
            mine = (column >= start) & (column < start + 4096)
            part = np.zeros((len(side), 4096), dtype=np.float32)
            part[row[mine], column[mine] - start] = 1
            parts.append(part)
        common += parts[0] @ parts[1].T
    union = sizes_x[:, None] + sizes_y[None, :] - common
    similar = (100 * common >= PERCENT * union) & (x.component.to_numpy()[:, None] != y.component.to_numpy()[None, :])
    i, j = np.nonzero(similar)
    return pd.DataFrame({"a": x.set_class.to_numpy()[i], "b": y.set_class.to_numpy()[j]})


def _lookups(rows: DataFrame) -> DataFrame:
    """(a, b): pairs of a key across components; the set in the smaller component asks."""
    x, y = rows.where("asks").alias("x"), rows.alias("y")
    smaller = "(x.size < y.size or x.size = y.size and x.component < y.component)"
    return x.join(y, F.expr(f"x.key = y.key and {smaller} and (x.kind = 0 or y.kind = 0)")).select(
        F.col("x.set_class").alias("a"), F.col("y.set_class").alias("b")
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
