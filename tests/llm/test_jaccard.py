"""The n-gram Jaccard join against brute force, on families, chains and odd rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from offerlens.llm import jaccard
from offerlens.llm.shingles import shingle_sets

from .conftest import LOWER, WORD


def sets_of(rows):
    out = []
    for doc_id, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        out.append((doc_id, grams))
    return out


def classes(rows):
    """(doc_id, n_shingles, component_id) of every row by comparing all pairs that share a shingle."""
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, (_, grams) in enumerate(sets):
        common = Counter(j for g in grams for j in holders[g])
        for j, n in common.items():
            if 100 * n >= 80 * (len(grams) + len(sets[j][1]) - n):
                parent[find(i)] = find(j)
        for g in grams:
            holders[g].append(i)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return Counter((d, len(g), least.get(find(i))) for i, (d, g) in enumerate(sets))


def found(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(words, draw, edits, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0:
            words[at] = draw.choice(vocabulary)
        elif kind == 1:
            words.insert(at, draw.choice(vocabulary))
        elif len(words) > 1:
            del words[at]
    return words


@pytest.fixture(scope="module")
def families():
    """Families of near copies of many sizes, with edits up to and over the threshold, and shared passages."""
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [draw.choice(vocabulary) for _ in range(25)]
    rows = []
    for size in (4, 5, 6, 8, 9, 11, 14, 20, 35, 67, 68, 70, 130, 300, 700):
        base = [draw.choice(vocabulary) for _ in range(size)]
        for k in range(14):
            words = edited(base, draw, draw.randint(0, max(1, size // 25)) if k % 2 else draw.randint(0, 2), vocabulary)
            rows.append(" ".join(words + (passage if k % 5 == 4 else [])))
    chain = [draw.choice(vocabulary) for _ in range(60)]
    for _ in range(25):
        chain = edited(chain, draw, 1, vocabulary)
        rows.append(" ".join(chain))
    center = [draw.choice(vocabulary) for _ in range(100)]
    rows += [" ".join(edited(center, draw, draw.randint(1, 6), vocabulary)) for _ in range(90)]
    draw.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


def test_families(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert found(jaccard.near_copies(docs)) == classes(families)


def test_families_in_small_blocks(spark, families, monkeypatch):
    monkeypatch.setattr(jaccard, "LISTED", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    monkeypatch.setattr(jaccard, "STAR_ROUNDS", 0)
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert found(jaccard.near_copies(docs)) == classes(families)


def test_odd_rows(run, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    result = run("op5_jaccard_join", documents=odd_documents)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in result) == classes(rows)
    assert run("op5_jaccard_join", documents=no_documents) == []


def test_every_pair_in_reach_shares_a_key():
    """Pigeonhole: two similar sets always share a subset, or a subset and a one-deletion."""
    draw = np.random.default_rng(0)
    for _ in range(1500):
        size = int(draw.integers(2, 220))
        universe = draw.integers(0, 2**63, 2 * size + 4, dtype=np.int64).view(np.uint64)
        keep = int(draw.integers(max(1, int(0.75 * size)), size + 1))
        a = np.unique(universe[:size])
        b = np.unique(np.concatenate([universe[size - keep : size], universe[size : size + int(draw.integers(0, size - keep + 2))]]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common) or np.array_equal(a, b):
            continue
        keys = []
        for s in (a, b):
            exact, deleted = set(), set()
            for band, _ in jaccard.bands(len(s)):
                e, d, _ = jaccard.subset_keys(s, jaccard.mix64(s), band)
                exact |= set(e.tolist())
                deleted |= set(d.tolist())
            keys.append((exact, deleted))
        (ea, da), (eb, db) = keys
        assert ea & eb or ea & db or da & eb


def test_shingle_sets_are_sets_of_runs():
    texts = ["", None, "a", "a b c d", "A B c D e f", "x " * 20, "é ü\x0bß\t\n a  b", "one two three four five six one two three four five"]
    sizes = [len(s) for _, s in shingle_sets(pa.array(texts))]
    assert sizes == [len(g) for _, g in sets_of(enumerate(texts))]
    sets = [set(s.tolist()) for _, s in shingle_sets(pa.array(["a b c d e", "A  B\tC D E", "a b c d f"]))]
    assert sets[0] == sets[1] and not sets[0] & sets[2]


def test_components_of_a_long_path(spark):
    n = 300
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = jaccard.components(links.union(spark.createDataFrame([(1000, 1001)], "a long, b long"))).collect()
    assert {r.node: r.component for r in rows} == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_no_pair_is_compared_twice(spark, families, monkeypatch):
    """Sets travel for a pair in one round only."""
    pairs = []

    def recorded(frame, label, stage=jaccard.stage):
        made = stage(frame, label)
        if label == "jaccard-pairs":
            pairs.extend((r.a, r.b) for r in made.collect())
        return made

    monkeypatch.setattr(jaccard, "stage", recorded)
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert found(jaccard.near_copies(docs)) == classes(families)
    assert pairs and len(pairs) == len(set(pairs))


def test_chance_agreement_of_keys_loses_no_link(spark, families, monkeypatch):
    monkeypatch.setattr(jaccard, "KEY_BITS", 12)
    docs = spark.createDataFrame(families, "doc_id long, text string")
    assert found(jaccard.near_copies(docs)) == classes(families)
