"""Repair and prefix trie of conversations against brute force."""

import hashlib
import heapq
import random
import re
from collections import defaultdict
from itertools import pairwise
from zlib import crc32

import numpy as np
import pytest

from offerlens.llm import conversation_repair as repair
from offerlens.llm import conversation_trie as trie

SPACES = " \t\n\x0b\x0c\r"
STEPS = {"": "su", "s": "u", "u": "a", "a": "u"}
REPAIRED = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_turn(row):
    turn, role, text = row
    return turn is not None, turn or 0, role.encode(), text.encode()


def damaged(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv]
        role, text = (" " if x is None else x for x in (role, text))
        draw = crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            found[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return found


def cheapest(rows, faults):
    """Least (cost, audit, repaired lines) over all edits, by a search that carries whole audits."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i > len(rows):
            return cost, audit, lines
        if (i, state) in done:
            continue
        done.add((i, state))
        given = [r for r in ("user", "assistant") if r[0] in STEPS[state]]
        if i == len(rows) and state in ("", "a"):
            heapq.heappush(heap, (cost, audit, i + 1, state, lines))
        for role in given:
            heapq.heappush(heap, (cost + 5, audit + "I", i, role[0], (*lines, f"{role}:")))
        if i == len(rows):
            continue
        _, own, text = rows[i]
        heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = 5 if faults[i] == "truncated" else 0
        if own and own[0] in STEPS[state]:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, own[0], (*lines, f"{own}:{text}")))
        for role in given:
            heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, role[0], (*lines, f"{role}:{text}")))


def repaired_brute_force(rows):
    for conv, found in damaged(rows).items():
        found.sort(key=by_turn)
        turns = [t for t, _, _ in found if t is not None]
        seen, faults = set(), []
        for _, role, text in found:
            shown = text.rstrip(SPACES)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(found))
        cost, audit, lines = cheapest(found, faults)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        yield conv, gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(lines))


def trie_brute_force(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn, role or "", text or ""))
    for found in convs.values():
        found.sort(key=by_turn)
    members, whole = defaultdict(list), {}
    for conv, own in list(convs.items()):
        taken = crc32(str(conv).encode()) % 6
        whole[conv] = tuple(x[1:] for x in convs.get(conv - conv % 100, [])[:taken] + own[taken:])
        for depth in range(len(whole[conv]) + 1):
            members[whole[conv][:depth]].append(conv)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] = sum(leaves[c] for c in children[prefix]) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1]) if prefix else 0
        saved[prefix] = own + sum(saved[c] for c in children[prefix])
    for prefix, found in members.items():
        ends = ",".join(map(str, sorted(c for c in found if whole[c] == prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        yield min(found), len(prefix), parent, len(found), len(children[prefix]), leaves[prefix], saved[prefix], sha(ends)


def drawn_conversations(seed, n):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "underling"]
    texts = ["Yes.", "No", "Well? ", "", " \n", None, "Same text!", "é.\t", "End", "..."]
    rows = []
    for conv in draw.sample(range(400), n):
        for turn in range(draw.choice([0, 1, 2, 3, 5, 8, 30])):
            given = None if draw.random() < 0.05 else turn - draw.randint(0, 1)
            rows.append((conv, given, draw.choice(roles), draw.choice(texts) if draw.random() < 0.7 else f"Turn {draw.randint(0, 9)}."))
    return rows + rows[:: 17] + [(None, 1, "user", "Hi."), (None, None, None, None), (7, 2**40, "user", "Far.")]


EXTRA = ["1 as n", "'x' as key", "2 as copies", "3 as cost", "4 as chars", "5 as keys", "6 as audit", "7 as block", "8 as at"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", *EXTRA).repartition(5)


def ordered(rows, names):
    return sorted(repr(tuple(r[n] for n in names)) for r in rows)


def expected(rows):
    return sorted(map(repr, rows))


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return table, [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]


def test_repair_of_given_conversations(run, given):
    table, rows = given
    assert ordered(run("op12_conversation_repair", conversations=table), REPAIRED) == expected(repaired_brute_force(rows))


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_repair_of_odd_conversations_in_blocks(run, spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = drawn_conversations(block, 60)
    assert ordered(run("op12_conversation_repair", conversations=frame(spark, rows)), REPAIRED) == expected(repaired_brute_force(rows))


def test_repaired_rows_are_whole_conversations(spark):
    rows = repair.damage(frame(spark, drawn_conversations(9, 80)))
    found = defaultdict(list)
    for r in repair.repaired(rows, repair.audits(rows)).collect():
        found[r.conv_id].append((r.place, r.role, r.text))
    for turns in found.values():
        assert [place for place, _, _ in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in turns))


def test_checkpoints_give_the_walk_that_all_vectors_give():
    draw = random.Random(3)
    for n in (0, 1, 2, 5, 40, 173):
        letters = "".join(draw.choices(repair.LETTERS, k=n))
        stretch = [repair.ENDING]
        for letter in reversed(letters):
            stretch.append(repair._before(letter, stretch[-1]))
        stretch = [v.tolist() for v in reversed(stretch)]
        for entry, (edits, state) in zip(repair.STEP, repair.walks(letters, repair.ENDING, list(repair.STEP)), strict=True):
            plainly, end = repair._forward(letters, stretch, [], entry)
            assert (edits, state) == ("".join(plainly), end)
        if n:
            table = repair.chained(np.stack([repair.TABLES[x] for x in letters]))
            assert np.minimum((table + repair.ENDING).min(axis=1), repair.NEVER).tolist() == stretch[0]


def test_trie_of_given_conversations(run, given):
    table, rows = given
    assert ordered(run("op13_conversation_trie", conversations=table), NODE) == expected(trie_brute_force(rows))


@pytest.mark.parametrize("block", [1, 4, 2048])
def test_trie_of_odd_conversations_in_blocks(run, spark, monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    rows = drawn_conversations(block, 150)
    assert ordered(run("op13_conversation_trie", conversations=frame(spark, rows)), NODE) == expected(trie_brute_force(rows))


def test_trie_of_many_copies(run, spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 8)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}." if c % 3 else f"Own {t} of {c}.") for c in range(150) for t in range(7)]
    assert ordered(run("op13_conversation_trie", conversations=frame(spark, rows)), NODE) == expected(trie_brute_force(rows))


def test_minima_against_loops():
    draw = random.Random(8)
    for n in (1, 2, 7, 64, 100):
        values = [draw.randint(0, 5) for _ in range(n)]
        minima = trie.Minima(np.array(values))
        for _ in range(50):
            a, floor = draw.randrange(n), draw.randint(0, 6)
            b = draw.randrange(a, n)
            assert minima.least(np.array([a]), np.array([b])) == min(values[a : b + 1])
            right = a
            while right + 1 < n and values[right + 1] >= floor:
                right += 1
            left = a
            while left > 0 and values[left] >= floor:
                left -= 1
            assert minima.reach_right(np.array([a]), np.array([floor])) == right
            assert minima.reach_left(np.array([a]), np.array([floor])) == left


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_conversation_trie"])
def test_empty_table(run, spark, name):
    assert run(name, conversations=frame(spark, []).where("false")) == []


def test_one_long_conversation_with_long_texts(run, spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 64)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t} " + "long " * (40_000 if t == 3 else 3) + ".") for t in range(700)]
    table = frame(spark, rows)
    assert ordered(run("op12_conversation_repair", conversations=table), REPAIRED) == expected(repaired_brute_force(rows))
    assert ordered(run("op13_conversation_trie", conversations=table), NODE) == expected(trie_brute_force(rows))
