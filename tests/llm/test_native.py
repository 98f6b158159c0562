"""Quality rules, mixing, decontamination and sharding against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.llm import decontam, mixing, quality, sharding
from offerlens.llm.queries import LLM_QUERIES

from .conftest import LOWER, WORD

PYTHON_NODES = ("EvalPython", "MapInPandas", "MapInArrow", "PythonMapInArrow", "FlatMapGroups", "CartesianProduct",
                "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", ["op1_source_mixing", "op2_quality_rules", "op10_decontaminate"])
def test_native_plans(spark, sf_dir, name):
    plan = LLM_QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in PYTHON_NODES if node in plan]


# Quality rules


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(run, odd_documents):
    rows = run("op2_quality_rules", documents=odd_documents)
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    expected = Counter()
    for r in odd_documents.select("doc_id", "text").collect():
        c = counts(r.text)
        expected[(r.doc_id, *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert found == expected
    assert all(not r.kept for r in rows if r.base_failed)


def test_quality_empty_and_rules(run, spark, no_documents):
    assert run("op2_quality_rules", documents=no_documents) == []
    docs = spark.createDataFrame([(1, "w*** " * 5 + "the of and a b c d e f g h")], "doc_id long, text string")
    judged = quality.judge(docs).first()
    assert judged.broken_rules == ["symbols_per_word"] and not judged.kept
    assert quality.judge(docs, ()).first().kept


def test_quality_keeps_good_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    judged = LLM_QUERIES["op2_quality_rules"](spark, sf_dir).join(labels, "doc_id")
    assert judged.where("not kept and not base_failed").count() == 0


# Mixing


def water_fill(sizes, weights, share=1.5, most=2):
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    budget, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[n] for n in open_)
        full = [n for n in open_ if budget * weight[n] / total > most * sizes[n]]
        if not full:
            target |= {n: budget * weight[n] / total for n in open_}
            break
        for n in full:
            target[n] = most * sizes[n]
            open_.discard(n)
        budget -= sum(most * sizes[n] for n in full)
    return target


@pytest.mark.parametrize("odd", [True, False])
def test_mixing_reaches_targets(run, spark, odd_documents, sf_dir, odd):
    docs = odd_documents if odd else spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = run("op1_source_mixing", documents=docs)
    expected = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.select("doc_id", "source", "text").collect())
    assert Counter((r.doc_id, r.source, r.size) for r in rows) == expected
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    target = water_fill(sizes, mixing.WEIGHTS)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for source, words in taken.items():
        assert abs(words - target[source]) <= 1
    again = run("op1_source_mixing", documents=docs.repartition(7))
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mixing_empty(run, no_documents):
    assert run("op1_source_mixing", documents=no_documents) == []


def test_sainte_lague_matches_one_by_one(spark):
    draw = np.random.default_rng(3)
    for seats in (0, 1, 7, 100, 1003):
        weights = [int(x) for x in draw.integers(0, 1000, 12)]
        parties = spark.createDataFrame([("g", i, float(w), seats) for i, w in enumerate(weights)],
                                        "g string, k long, w double, seats long")
        won = {r.k: r.won for r in mixing.sainte_lague(parties, ["g"], ["k"], "w", "seats").collect()}
        expected = [0] * len(weights)
        for _ in range(seats):
            best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * expected[i] + 1), -i))
            expected[best] += 1
        assert won == dict(enumerate(expected))


def test_mixed_texts_hold_the_taken_words(spark, odd_documents):
    docs = odd_documents.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text")).where("doc_id >= 100")
    mixed = mixing.mix(docs, carry=("doc_id", "source")).join(docs.select("doc_id", "text"), "doc_id")
    texts = mixing.mixed_texts(mixed).select("doc_id", "text").collect()
    words = Counter()
    for r in texts:
        words[r.doc_id] += len(WORD.findall(r.text))
    assert {k: v for k, v in words.items() if v} == {r.doc_id: r.taken for r in mixed.collect() if r.taken}


# Decontamination

WORD10 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows_hit(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = WORD10.findall((text or "").translate(LOWER))
        for s in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[s : s + 13])].add(item)
    out = Counter()
    for doc, text in docs:
        words = WORD10.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(w) for w in windows}:
            for s in range(len(words) - n + 1):
                if tuple(words[s : s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= {str(i) for i in windows[tuple(words[s : s + n])] if i is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[(doc, len(words), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(words))] += 1
    return out


def rows_of(found):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found)


def test_contamination(run, spark, odd_documents):
    base = next(r.text for r in odd_documents.where("doc_id = 100").collect())
    items = [(0, " ".join(base.split()[:30])), (1, base.upper()), (2, "b c"), (3, "é" * 50), (4, None), (5, " ,."),
             (10, "The quick brown fox!"), (None, "two words"), (7, " ".join(base.split()[:30])), (0, "x x x x x x x x x x x x x x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert rows_of(run("op10_decontaminate", documents=odd_documents, benchmark=bench)) == windows_hit(docs, items)


def test_contamination_in_blocks(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_SHINGLES", 300)
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = windows_hit([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert rows_of(LLM_QUERIES["op10_decontaminate"](spark, sf_dir).collect()) == expected


def test_contamination_of_nothing(run, spark, no_documents, odd_documents):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert run("op10_decontaminate", documents=no_documents, benchmark=bench) == []
    rows = run("op10_decontaminate", documents=odd_documents, benchmark=bench.where("false"))
    assert len(rows) == odd_documents.count() and not any(r.n_hit or r.contaminated for r in rows)


# Sharding


def test_pack_balances():
    draw = np.random.default_rng(1)
    vectors = draw.pareto(2.0, (3000, 3)) + 0.01
    placed = sharding.pack(vectors, 16)
    sums = np.array([np.bincount(placed, vectors[:, k], 16) for k in range(3)])
    assert (sums[0] / sums[0].mean()).max() < 1.02 and (sums[1] / sums[1].mean()).max() < 1.15


def test_sharding(run, spark, sf_dir, odd_documents):
    for docs in (odd_documents, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = run("op9_vector_sharding", documents=docs)
        texts = docs.select("doc_id", "text").collect()
        expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, crc32((r.text or "").encode())) for r in texts)
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
        assert {r.law for r in rows} == {"bytes"} and all(r.grown_shard is None for r in rows)
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) <= 1.05 * sum(sizes.values()) / 16 + max(r.size for r in rows)


def test_sharding_splits_a_hot_group(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) as text")
    rows = sharding.shard(docs).groupBy("shard").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    assert max(r.size for r in rows) <= 1.02 * min(r.size for r in rows)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_sharding_keeps_groups_whole(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet").withColumn("group", F.coalesce("text", F.lit("")))
    rows = sharding.shard(docs, carry=("doc_id", "group")).collect()
    shards, sizes = defaultdict(set), defaultdict(int)
    for r in rows:
        shards[r.group].add(r.shard)
        sizes[r.group] += r.size
    most = sharding.WHOLE * sum(sizes.values()) / sharding.SHARDS
    assert any(n > 1 for n in Counter(r.group for r in rows).values())
    assert all(len(shards[g]) == 1 for g in shards if sizes[g] <= most)


def test_sharding_spreads_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "the same text")], "doc_id long, text string").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20_000))))
    found = sharding.shard(docs.repartition(8)).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots")).collect()
    assert len(found) == 16 and all(r.n == r.slots and 1000 < r.n < 1500 for r in found)


def test_packing_against_loops():
    draw = random.Random(12)
    vectors = [[draw.randint(1, 10**draw.randint(1, 5)) for _ in range(3)] for _ in range(200)]
    totals = [sum(v[k] for v in vectors) for k in range(3)]
    left = [list(sharding.WEIGHTS) for _ in range(5)]
    scaled = [[v[k] / totals[k] * 5 for k in range(3)] for v in vectors]
    order = sorted(range(200), key=lambda i: -max(scaled[i][k] * sharding.WEIGHTS[k] ** 0.5 for k in range(3)))
    expected = {}
    for i in order:
        fits = [sum(left[s][k] * scaled[i][k] for k in range(3)) for s in range(5)]
        expected[i] = fits.index(max(fits))
        for k in range(3):
            left[expected[i]][k] -= scaled[i][k] * sharding.WEIGHTS[k]
    assert sharding.pack(np.array(vectors), 5).tolist() == [expected[i] for i in range(200)]


def test_sharding_empty(run, no_documents):
    assert run("op9_vector_sharding", documents=no_documents) == []
