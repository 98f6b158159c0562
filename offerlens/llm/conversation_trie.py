"""The trie of conversation prefixes, from range minima over sorted common prefixes.

Distinct sequences of turns are sorted over the whole cluster; ``shared[i]`` is how many turns
the ``i``-th has in common with the one before. A prefix of ``d`` turns that first appears at
``i`` is a node, and its members are the run of neighbours around ``i`` with at least ``d`` turns
in common. A sparse table of minima over ``shared`` gives both ends of that run by binary
search, each node and each parent for itself, without a stack or an order among nodes. What a
node reports is then a difference of running sums, a range minimum (the smallest member), or a
count of the borders in its run at which exactly ``d`` turns are shared (its children).

The sorted sequences are cut into blocks of ``BLOCK``, each a group of its own that also sees the
sequence before and the one behind it. A run that ends inside its block is finished there.
Runs that cross a border are those of prefixes which both sides share: every block gives its
part, and as all figures add up (see ``_Block.nodes`` for the saved tokens), the parts are grouped
by prefix. Equal conversations are one sequence with a count before anything is sorted.

Defined results: a missing role or text counts as empty; rows without a conversation id belong to
no conversation; a missing turn comes first, rows of one turn stand by role and text (see
``turns``), and repeated rows are turns of their own. A table without conversations has no root.
Turns are compared by a 128-bit digest of role and text, texts of any length are read whole, and
other columns are ignored. A conversation is one row with 24 bytes a turn, whatever its texts.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.llm.turns import ORDER, plain, with_order
from offerlens.staging import stage

#: Bytes that stand for a turn.
KEY = 16
#: Sorted sequences that are one group.
BLOCK = 2048
#: Bytes of a sequence that choose its range: 1,024 turns; sequences that agree in them share a task.
RANGE_BYTES = 1024 * KEY

NOTHING = hashlib.sha256().hexdigest()


def rebuild(conversations: DataFrame) -> DataFrame:
    """(conv_id, keys, chars): every conversation behind the first turns of its hundred's first one.

    ``keys`` are the digests of its turns, ``chars`` their code points. The checksum of the
    id modulo 6 says how many turns are borrowed, and left out of its own.
    """
    rows = with_order(conversations.select(*plain(conversations, ""))).where("conv_id is not null")
    turn = F.struct(*ORDER, F.char_length("text").cast("long").alias("n_chars"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("__sorted")).select(
        "conv_id", F.transform("__sorted", lambda x: F.struct(x["key"].alias("key"), x["n_chars"].alias("n_chars"))).alias("turns")
    )
    heads = whole.where(F.col("conv_id") % 100 == 0).select(F.col("conv_id").alias("__base"), F.slice("turns", 1, 5).alias("__head"))
    taken = (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 6).cast("int")
    joined = whole.withColumns({"__base": F.col("conv_id") - F.col("conv_id") % 100, "__taken": taken}).join(heads, "__base", "left")
    borrowed = F.slice(F.coalesce("__head", F.slice("turns", 1, 0)), F.lit(1), F.col("__taken"))
    own = F.slice("turns", F.col("__taken") + 1, F.size("turns"))
    rebuilt = joined.select("conv_id", F.concat(borrowed, own).alias("turns"))
    return rebuilt.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x["key"])), "")).alias("keys"),
        F.transform("turns", lambda x: x["n_chars"]).alias("chars"),
    )


def member_digests(members: DataFrame) -> DataFrame:
    """(class, ends_sha256) of (class, conv_id): ids in order, comma-joined, never in memory together."""
    placed = members.repartition("class").sortWithinPartitions("class", "conv_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, name = None, None
        for batch in batches:
            made = []
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is not None and key == name:
                    state.update(f",{conv}".encode())
                    continue
                if state is not None:
                    made.append((name, state.hexdigest()))
                state, name = hashlib.sha256(str(conv).encode()), key
            yield _digests(made)
        yield _digests([] if state is None else [(name, state.hexdigest())])

    return placed.select("class", "conv_id").mapInArrow(hashed, "class binary, ends_sha256 string")


def _digests(made: list[tuple]) -> pa.RecordBatch:
    names, hashes = zip(*made, strict=True) if made else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], names=["class", "ends_sha256"])


def _common(first: bytes, second: bytes) -> int:
    """Turns that two sequences have in common at their start."""
    n = min(len(first), len(second)) // KEY
    same = (np.frombuffer(first, "<u8", 2 * n) == np.frombuffer(second, "<u8", 2 * n)).reshape(n, 2).all(axis=1)
    return n if same.all() else int(same.argmin())


class Minima:
    """Range minima in constant time: the least of every run whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            half, last = 2 ** (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The minimum from ``left`` to ``right``, both included."""
        level = np.frexp(right - left + 1)[1] - 1
        found = np.empty(len(left), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            found[at] = np.minimum(self.levels[k][left[at]], self.levels[k][right[at] + 1 - 2**k])
        return found

    def reach_right(self, start: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The last place such that all values behind ``start`` up to it are at least ``floor``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = at + 2**k < len(self.levels[0])
            fits[fits] = level[at[fits] + 1] >= floor[fits]
            at[fits] += 2**k
        return at

    def reach_left(self, start: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The first place such that all values behind it up to ``start`` are at least ``floor``."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            fits = at >= 2**k
            fits[fits] = level[at[fits] + 1 - 2**k] >= floor[fits]
            at[fits] -= 2**k
        return at


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(values, dtype=np.int64)))


class _Block:
    """Sorted sequences with what is shared at every border, both outer ones included; -1 where no neighbour is."""

    def __init__(self, table: pa.Table, before: bytes | None, behind: bytes | None):
        self.keys = table["keys"].to_pylist()
        self.copies = table["n"].to_numpy()
        self.smallest = Minima(table["least"].to_numpy())
        self.ends = table["ends_sha256"].to_pylist()
        self.lengths = np.array([len(k) // KEY for k in self.keys])
        inner = [_common(a, b) for a, b in zip(self.keys, self.keys[1:], strict=False)]
        self.shared = np.array([-1 if before is None else _common(before, self.keys[0]), *inner])
        self.last = -1 if behind is None else _common(self.keys[-1], behind)
        self.minima = Minima(self.shared)
        chars = table["chars"].combine_chunks()
        self.chars, self.offsets = _running(chars.flatten().to_numpy()), np.concatenate(([0], np.cumsum(self.lengths)))

    def upto(self, i: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Code points of the first ``depth`` turns of the ``i``-th sequence."""
        return self.chars[self.offsets[i] + np.maximum(depth, 0)] - self.chars[self.offsets[i]]

    def prefix(self, i: int, depth: int) -> bytes:
        return hashlib.md5(self.keys[i][: depth * KEY]).digest()

    def runs(self, i: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first member, last member, whether the run crosses the block's border) of prefixes."""
        left, right = self.minima.reach_left(i, depth), self.minima.reach_right(i, depth)
        crosses = (left == 0) & (self.shared[0] >= depth) | (right == len(self.keys) - 1) & (self.last >= depth)
        return left, right, crosses

    def nodes(self) -> pa.RecordBatch:
        """A row for every prefix that first appears here, or is carried on from the block before.

        Saved tokens are (members - 1) times code points, summed over a subtree. That is the
        code points of all members' turns from the node's on, less each distinct turn of
        the subtree once; a turn is distinct where its prefix first appears. Both add up
        over blocks.
        """
        m = len(self.keys)
        everyone = np.arange(m)
        new = np.maximum(self.lengths - self.shared, 0)
        carried = self.shared[0] + 1
        i = np.concatenate((np.zeros(carried, dtype=np.int64), np.repeat(everyone, new)))
        within = np.arange(new.sum()) - np.repeat(np.cumsum(new) - new, new)
        depth = np.concatenate((np.arange(carried), within + np.repeat(self.shared + 1, new)))
        left, right, crosses = self.runs(i, depth)

        members = _running(self.copies)
        n_convs = members[right + 1] - members[left]
        total = self.upto(everyone, self.lengths)
        of_all = _running(self.copies * total)
        first_seen = _running(total - self.upto(everyone, self.shared))
        saved = (
            of_all[right + 1] - of_all[left] - n_convs * self.upto(left, depth - 1)
            - (total[left] - self.upto(left, np.maximum(depth - 1, self.shared[left])))
            - (first_seen[right + 1] - first_seen[left + 1])
        )
        leaves = _running(self.lengths > np.append(self.shared[1:], self.last))
        by_depth = np.sort(self.shared[1:] * (m + 1) + everyone[1:])

        def branches(upto: np.ndarray) -> np.ndarray:
            return np.searchsorted(by_depth, depth * (m + 1) + upto, "right")

        n_children = branches(right) - branches(left) + ((self.lengths[left] > depth) & (self.shared[left] <= depth))
        up_left, up_right, up_crosses = self.runs(i, np.maximum(depth - 1, 0))
        parent = self.smallest.least(up_left, up_right)
        is_root = depth == 0
        own_end = (self.shared[i] < depth) & (self.lengths[i] == depth)
        keyed = [self.prefix(a, d) if c else None for a, d, c in zip(i.tolist(), depth.tolist(), crosses.tolist(), strict=True)]
        above = [
            self.prefix(a, d - 1) if c and d else None
            for a, d, c in zip(i.tolist(), depth.tolist(), up_crosses.tolist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays([
            pa.array(depth, pa.int64()), pa.array(keyed, pa.binary()), pa.array(above, pa.binary()),
            pa.array(self.smallest.least(left, right), pa.int64()), pa.array(parent, pa.int64(), mask=is_root | up_crosses),
            pa.array(n_convs, pa.int64()), pa.array(n_children, pa.int64()),
            pa.array(leaves[right + 1] - leaves[left], pa.int64()), pa.array(saved, pa.int64()),
            pa.array([self.ends[a] if e else None for a, e in zip(i.tolist(), own_end.tolist(), strict=True)], pa.string()),
        ], names=[name for name, _ in _FIELDS])


_FIELDS = [
    ("depth", "long"), ("prefix", "binary"), ("above", "binary"), ("conv_id", "long"), ("parent_conv_id", "long"), ("n_convs", "long"),
    ("n_children", "long"), ("n_leaves", "long"), ("saved_tokens", "long"), ("ends_sha256", "string"),
]


def _block_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one block; rows with an ``at`` of -1 and -2 are its neighbours."""
    table = table.sort_by("at")
    own = table.filter(pa.compute.greater_equal(table["at"], 0))
    beside = dict(zip(table["at"].to_pylist()[:2], table["keys"].to_pylist()[:2], strict=True)) if len(table) > len(own) else {}
    return pa.Table.from_batches([_Block(own, beside.get(-1), beside.get(-2)).nodes()])


def _sorted_classes(sequences: DataFrame) -> DataFrame:
    """Distinct sequences in order (``at``) with their number, smallest id and digest of ids; staged."""
    members = sequences.select(F.unhex(F.md5("keys")).alias("class"), "conv_id")
    classes = sequences.groupBy("keys").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.first("chars").alias("chars")
    ).withColumn("class", F.unhex(F.md5("keys")))
    whole = classes.join(member_digests(members), "class").drop("class").withColumn("__start", F.substring("keys", 1, RANGE_BYTES))
    placed = whole.repartitionByRange("__start").sortWithinPartitions("__start", "keys").drop("__start")
    return stage(placed.withColumn("at", F.monotonically_increasing_id()), "trie-classes")


def _with_neighbours(placed: DataFrame) -> DataFrame:
    """All rows with their ``block``, and for each block the sequences before and behind it as rows -1 and -2."""
    row = F.col("at").bitwiseAND((1 << 33) - 1)
    blocked = placed.withColumn("block", F.col("at") - row % BLOCK)
    # Two short rows a block: the only place where all blocks meet in one task.
    edges = stage(blocked.groupBy("block").agg(F.min_by("keys", "at").alias("first"), F.max_by("keys", "at").alias("last")), "trie-edges")
    line = Window.orderBy("block")
    beside = edges.select("block", F.lag("last").over(line).alias("before"), F.lead("first").over(line).alias("behind"))
    rows = beside.select(
        "block", F.inline(F.array(F.struct(F.lit(-1).cast("long").alias("at"), F.col("before").alias("keys")),
                                  F.struct(F.lit(-2).cast("long").alias("at"), F.col("behind").alias("keys"))))
    ).where("keys is not null")
    return blocked.unionByName(rows, allowMissingColumns=True)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row for each distinct prefix of ``sequences`` (conv_id, keys, chars): its place in the trie and its figures."""
    fields = ", ".join(f"{name} {kind}" for name, kind in _FIELDS)
    blocked = _with_neighbours(_sorted_classes(sequences)).select("block", "at", "keys", "chars", "n", "least", "ends_sha256")
    parts = stage(blocked.groupBy("block").applyInArrow(_block_nodes, fields), "trie-parts")
    inside = parts.where("prefix is null")
    crossing = stage(parts.where("prefix is not null").groupBy("depth", "prefix").agg(
        F.first("above").alias("above"), F.min("conv_id").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    ), "trie-crossing")
    parents = crossing.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"), F.col("conv_id").alias("__parent"))
    return inside.unionByName(crossing).join(parents, ["depth", "above"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "__parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


