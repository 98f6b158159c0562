"""Repair of damaged conversations by a square-root checkpointed dynamic program.

A conversation is whole if its role initials read ``(s?(ua)+)?``, an automaton of four states.
Edits keep a row, give it another role, delete it or insert an empty one, each at a cost; the
cheapest sequence of edits is wanted, of equal ones the least in ASCII. The program runs backward:
``V[i][q]`` is the least cost to finish from row ``i`` in state ``q``. Walking forward, the least
letter whose cost makes up the difference is right, so only those vectors are needed, and they
are stored at every square-root-of-n-th row alone: the walk recomputes the stretch between two
checkpoints when it gets there.

Rows are sorted over the whole cluster without their texts and cut into blocks of at most
``BLOCK`` rows of one conversation, so that a conversation of any length is many tasks' work:

1. each block becomes a 4 x 4 table of least costs from state to state;
2. the tables of a conversation, one row per block, give the vector behind every block;
3. each block walks forward from every state that it can be entered in;
4. the walks of a conversation are chained, which gives its audit.

The repaired texts follow in one shuffle: the rows of a conversation are streamed behind its
audit, with one batch of rows in memory. A conversation's SHA-256 is a single chain of bytes by
definition, so this last step is one task per conversation.

Defined results: a missing role or text counts as one space; a row without a conversation id
belongs to the conversation without an id; a missing turn comes first and is left out of ``gaps``;
rows of one turn stand by role and text (see ``turns``); repeated rows are duplicates of the
first; an empty role has no legal initial. A conversation without rows has zeros, an empty audit
and the digest of an empty text; an empty table gives an empty table. Texts of any length are
read whole; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator
from itertools import pairwise
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm import words as W
from offerlens.llm.turns import ORDER, plain, with_order
from offerlens.staging import stage

#: Costs of the edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Rows of a conversation that one task walks through.
BLOCK = 1 << 16
#: More than any conversation costs.
NEVER = 1 << 50

#: States: nothing yet, behind a system row, behind a user row, behind an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: State behind a row with the initial of the key.
STEP = {
    START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER},
}
#: The role that may come next, other than system; what is inserted or given there.
NEXT = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
WHOLE = (START, ASSISTANT)

#: A row is a letter: its initial (other, s, u, a), then its fault by fours.
INITIALS, FAULTS = "?sua", ("none", "truncated", "blank", "duplicate")
LETTERS = "abcdefghijklmnop"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows that lack nothing, and in ``copies`` how often each still stands; 0 for a dropped row.

    The checksum of ``conv_id:turn`` (a missing part being one space) modulo 20 decides.
    """
    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    draw = F.crc32(F.encode(F.concat(named("conv_id"), F.lit(":"), named("turn")), "UTF-8")) % 20
    rows = conversations.select(*plain(conversations, " ")).withColumn("__draw", draw)
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("__draw") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("__draw") == 1, "").when(F.col("__draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("__draw") == 0, 0).when(F.col("__draw") == 3, 2).otherwise(1).alias("copies"),
    )


def _edits(letter: str, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, state behind it) of the edits that use up a row, in ASCII order."""
    code = LETTERS.index(letter)
    initial, fault = INITIALS[code % 4], FAULTS[code // 4]
    yield "D", DELETE, state
    if fault in ("blank", "duplicate"):
        return
    more = TRUNCATED if fault == "truncated" else 0
    if initial in STEP[state]:
        yield "K", more, STEP[state][initial]
    yield "R", REROLE + more, STEP[state][NEXT[state][0]]


def _inserted(state: int) -> int:
    return STEP[state][NEXT[state][0]]


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs by state, when rows may be inserted first."""
    best = costs.copy()
    for _ in range(3):  # the longest way through inserted rows that does not come back
        for state in STEP:
            best[state] = np.minimum(best[state], INSERT + best[_inserted(state)])
    return best


def _row_table(letter: str) -> np.ndarray:
    """Least costs of one row from state to state, with rows inserted before it."""
    table = np.full((4, 4), NEVER, dtype=np.int64)
    for state in STEP:
        for _, cost, after in _edits(letter, state):
            table[state, after] = min(table[state, after], cost)
    return _with_inserts(table)


TABLES = {letter: _row_table(letter) for letter in LETTERS}
#: Cost to end in each state.
ENDING = _with_inserts(np.array([0 if s in WHOLE else NEVER for s in STEP], dtype=np.int64))


def chained(tables: np.ndarray) -> np.ndarray:
    """Least costs through a run of tables (n, 4, 4), neighbours being joined in turn."""
    while len(tables) > 1:
        odd = tables[-1:] if len(tables) % 2 else tables[:0]
        left, right = tables[: len(tables) - len(odd) : 2], tables[1::2]
        joined = (left[:, :, :, None] + right[:, None, :, :]).min(axis=2)
        tables = np.concatenate([np.minimum(joined, NEVER), odd])
    return tables[0]


def _before(letter: str, costs: np.ndarray) -> np.ndarray:
    return np.minimum((TABLES[letter] + costs).min(axis=1), NEVER)


def walks(letters: str, behind: np.ndarray, entries: list[int]) -> list[tuple[str, int]]:
    """(edits, state behind them) of the cheapest way through ``letters`` from each of ``entries``.

    ``behind`` are the costs by state behind the last row. Vectors are stored at every
    square-root-th row; those between are computed again.
    """
    n = len(letters)
    step = isqrt(n) + 1
    stored: dict[int, np.ndarray] = {}
    costs = behind
    for i in range(n, -1, -1):
        if i < n:
            costs = _before(letters[i], costs)
        if i % step == 0 or i == n:
            stored[i] = costs
    found = [([], entry) for entry in entries]
    for start in range(0, n, step):
        end = min(start + step, n)
        stretch = [stored[end]]
        for i in range(end - 1, start - 1, -1):
            stretch.append(_before(letters[i], stretch[-1]))
        stretch = [v.tolist() for v in reversed(stretch)]
        found = [_forward(letters[start:end], stretch, edits, state) for edits, state in found]
    return [("".join(edits), state) for edits, state in found]


def _forward(letters: str, costs: list[list[int]], edits: list[str], state: int) -> tuple[list[str], int]:
    """Append the least tight edits of a stretch; ``costs`` has the vectors before and behind every row."""
    for i, letter in enumerate(letters):
        while True:
            left = costs[i][state]
            tight = {edit: after for edit, cost, after in _edits(letter, state) if cost + costs[i + 1][after] == left}
            if INSERT + costs[i][_inserted(state)] == left:
                tight["I"] = None
            edit = min(tight)
            edits.append(edit)
            if edit != "I":
                state = tight[edit]
                break
            state = _inserted(state)
    return edits, state


def ending(state: int) -> str:
    """The rows to insert behind the last one."""
    edits = ""
    while state not in WHOLE:
        edits, state = edits + "I", _inserted(state)
    return edits


def _letters(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, at, letter), a row for each copy, ``at`` in the order of the conversation; staged."""
    text = F.rtrim(F.col("text"), F.lit("".join(W.SPACES)))
    initial = F.substring("role", 1, 1)
    short = rows.where("copies > 0").withColumns({
        "__fault": F.when(text == "", 2).when(F.substring(text, -1, 1).isin(".", "!", "?"), 0).otherwise(1),
        "__initial": F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0),
        "__row": F.monotonically_increasing_id(),
    }).select("conv_id", *ORDER, "__row", "__fault", "__initial", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("__copy"))
    keys = ["conv_id", *ORDER, "__row", "__copy"]  # copies of one row need not meet in one task
    placed = short.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = stage(
        placed.select("conv_id", "turn", "key", "__fault", "__initial", F.monotonically_increasing_id().alias("at")), "repair-rows"
    )
    first = placed.where("__fault < 2").groupBy("conv_id", "key").agg(F.min("at").alias("__first"))
    judged = W.join_same(placed, first, ["conv_id", "key"], "left")
    fault = F.when((F.col("__fault") < 2) & (F.col("at") > F.col("__first")), 3).otherwise(F.col("__fault"))
    letter = F.substring(F.lit(LETTERS), 1 + F.col("__initial") + 4 * fault, F.lit(1))
    return judged.select("conv_id", "turn", "at", letter.alias("letter"))


def _blocks(letters: DataFrame) -> DataFrame:
    """(conv_id, start, letters): runs of up to ``BLOCK`` rows of one conversation."""
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    block = letters.groupBy("conv_id", part.alias("__part"), F.floor(place / BLOCK).alias("__block"))
    run = F.sort_array(F.collect_list(F.struct("at", "letter")))
    return block.agg(run.alias("__run")).select(
        "conv_id", F.get("__run", 0)["at"].alias("start"),
        F.array_join(F.transform("__run", lambda x: x["letter"]), "").alias("letters"),
    )


def _illegal(first: str, second: str) -> bool:
    return INITIALS[LETTERS.index(first) % 4] + INITIALS[LETTERS.index(second) % 4] not in ("su", "ua", "au")


def _costs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each block's table and counts."""
    for batch in batches:
        found = []
        for letters in batch["letters"]:
            faults = [LETTERS.index(x) // 4 for x in letters]
            found.append((
                chained(np.stack([TABLES[x] for x in letters])).ravel().tolist(), len(letters), faults.count(2), faults.count(3),
                faults.count(1), sum(_illegal(a, b) for a, b in pairwise(letters)),
            ))
        made = pd.DataFrame(found, columns=["costs", "n_rows", "blank", "duplicate", "truncated", "illegal"])
        yield pd.concat([batch.reset_index(drop=True), made], axis=1)


def _behind(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For every block of a conversation: the costs behind it, and what the conversation costs."""
    for batch in batches:
        found = []
        for blocks in batch["blocks"]:
            costs, last = ENDING, len(blocks) - 1
            rows = []
            for i in range(last, -1, -1):
                block = blocks[i]
                before = chained(np.stack([np.array(block["costs"]).reshape(4, 4), np.tile(costs, (4, 1)).T]))[:, 0]
                across = i < last and _illegal(block["tail"], blocks[i + 1]["head"])
                rows.append([block["start"], costs.tolist(), i == 0, i == last, int(across)])
                costs = before
            found += [[*row, int(costs[START])] for row in rows]
        yield pd.DataFrame(found, columns=["start", "behind", "is_first", "is_last", "across", "cost"])


def _walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each block's edits and the state behind them, by the state before; a first block has one entry."""
    for batch in batches:
        edits, exits = [], []
        for letters, behind, first, last in zip(batch["letters"], batch["behind"], batch["is_first"], batch["is_last"], strict=True):
            found = walks(letters, np.array(behind), [START] if first else list(STEP))
            edits.append([e + ending(state) if last else e for e, state in found])
            exits.append([state for _, state in found])
        yield batch.assign(edits=edits, exits=exits)[["conv_id", "start", "edits", "exits", *COUNTS, "cost"]]


COUNTS = ["n_rows", "blank", "duplicate", "truncated", "illegal"]


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The audit of every conversation: its blocks' edits, each from the state that the one before ends in."""
    for batch in batches:
        audits = []
        for blocks in batch["blocks"]:
            state, audit = START, []
            for block in blocks:
                audit.append(block["edits"][state])
                state = block["exits"][state]
            audits.append("".join(audit))
        yield batch.assign(audit=audits).drop(columns="blocks")


def audits(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, counts of faults, cost, audit) of conversations that have rows; ``rows`` as ``damage`` gives them."""
    letters = _letters(with_order(rows))
    longs = ", ".join(f"{name} long" for name in COUNTS)
    blocks = stage(
        _blocks(letters).mapInPandas(_costs, f"conv_id long, start long, letters string, costs array<long>, {longs}"), "repair-blocks"
    )
    ends = [F.substring("letters", 1, 1).alias("head"), F.substring("letters", -1, 1).alias("tail")]
    listed = blocks.select("conv_id", F.struct("start", "costs", *ends).alias("block"))
    behind = listed.groupBy("conv_id").agg(F.sort_array(F.collect_list("block")).alias("blocks")).select("blocks").mapInPandas(
        _behind, "start long, behind array<long>, is_first boolean, is_last boolean, across long, cost long"
    )
    told = blocks.join(behind, "start").withColumn("illegal", F.col("illegal") + F.col("across"))
    walked = told.mapInPandas(
        _walked, f"conv_id long, start long, edits array<string>, exits array<int>, {longs}, cost long"
    )
    found = walked.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "edits", "exits"))).alias("blocks"),
        *[F.sum(name).alias(name) for name in COUNTS], F.max("cost").alias("cost"),
    ).mapInPandas(_joined, f"conv_id long, {longs}, cost long, audit string")
    turns = letters.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    return W.join_same(found, turns, ["conv_id"])


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text): the repaired rows, in order within their partition.

    All rows of a conversation are in one partition; ``found`` is what ``audits`` gives.
    """
    texts = with_order(rows).where("copies > 0").select("conv_id", F.lit(1).alias("__kind"), *ORDER, "role", "text", "copies", F.lit(None).cast("string").alias("audit"))
    heads = found.select("conv_id", F.lit(0).alias("__kind"), "audit")
    keys = ["conv_id", "__kind", *ORDER]
    whole = texts.unionByName(heads, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions(*keys)

    def mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit: Iterator[str] = iter("")
        conv, state, place = None, START, 0

        def rest() -> list[tuple]:
            """Rows that the audit inserts from here up to its next other edit; none is left behind the last."""
            nonlocal state, place, edit
            made = []
            while (edit := next(audit, "")) == "I":
                made.append((conv, place, NEXT[state], ""))
                state, place = _inserted(state), place + 1
            return made

        edit = ""
        for batch in batches:
            made: list[tuple] = []
            for row in batch.to_pylist():
                if row["__kind"] == 0:
                    made += rest()
                    audit, conv, state, place = iter(row["audit"]), row["conv_id"], START, 0
                    continue
                for _ in range(row["copies"]):
                    made += rest()
                    if edit != "D":
                        role = row["role"] if edit == "K" else NEXT[state]
                        made.append((conv, place, role, row["text"]))
                        state, place = STEP[state][role[0]], place + 1
            yield _turns(made)
        yield _turns(rest())

    return whole.select("conv_id", "__kind", "role", "text", "copies", "audit").mapInArrow(
        mended, "conv_id long, place long, role string, text string"
    )


def _turns(made: list[tuple]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "place": pa.int64(), "role": pa.string(), "text": pa.string()}
    columns = zip(*made, strict=True) if made else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the lines ``role:text`` of what ``repaired`` gives."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv = None, None

        def done() -> list[tuple]:
            return [] if state is None else [(conv, state.hexdigest())]

        for batch in batches:
            made = []
            for row in batch.to_pylist():
                if row["place"] == 0:
                    made += done()
                    state, conv = hashlib.sha256(), row["conv_id"]
                line = f"{row['role']}:{row['text']}"
                state.update(("\n" * (row["place"] > 0) + line).encode())
            yield _hashes(made)
        yield _hashes(done())

    return turns.mapInArrow(hashed, "conv_id long, repaired_sha256 string")


def _hashes(made: list[tuple]) -> pa.RecordBatch:
    ids, hashes = zip(*made, strict=True) if made else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], names=["conv_id", "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, cost, audit, the digest of the repaired rows, and ``n_rows``."""
    found = stage(audits(rows), "repair-audits")
    hashes = digests(repaired(rows, found))
    numbers = ["gaps", *COUNTS, "cost"]
    every = rows.select("conv_id").distinct()
    told = W.join_same(W.join_same(every, found, ["conv_id"], "left"), hashes, ["conv_id"], "left")
    return told.select(
        "conv_id", *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
