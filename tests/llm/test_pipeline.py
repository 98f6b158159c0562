"""The corpus pipeline, stage by stage against brute force, and its columns and odd inputs."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from offerlens.llm import mixing
from offerlens.staging import stage

from .conftest import WORD
from .test_jaccard import classes
from .test_native import counts, water_fill, windows_hit

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """(name, input rows, output frame) of every stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in corpus_pipeline.STAGES:
        result = stage(step(spark, docs, sf_dir), f"test-{name}")
        out.append((name, docs.collect(), result))
        docs = result
    return out


def test_registered_with_every_operator():
    names = contract.queries()
    assert "pipeline" in names
    assert {name.split("_")[0] for name in names if name.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_copies", "decontamination", "source_mixing", "vector_sharding",
    ]


def test_columns(steps):
    for _, _, result in steps[:-1]:
        assert result.columns == COLUMNS
    assert steps[-1][2].columns[:5] == COLUMNS and {"shard", "slot"} <= set(steps[-1][2].columns)


def test_quality_stage(steps, spark, sf_dir):
    _, before, after = steps[0]
    kept = {r.doc_id for r in after.collect()}
    failed = set()
    for r in before:
        c = counts(r.text)
        if c[0] < 10 or 100 * c[4] > 20 * c[0]:
            failed.add(r.doc_id)
    assert not kept & failed
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()}
    assert (good & {r.doc_id for r in before}) - failed <= kept


def test_near_copy_stage(steps):
    _, before, after = steps[1]
    groups = classes([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in groups})


def test_decontamination_stage(steps, spark, sf_dir):
    _, before, after = steps[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r[0] for r in windows_hit([(r.doc_id, r.text) for r in before], items) if not r[-1]]
    assert sorted(r.doc_id for r in after.collect()) == sorted(clean)


def test_mixing_stage(steps):
    _, before, after = steps[3]
    sizes, taken, texts = defaultdict(int), defaultdict(int), {r.doc_id: r.text for r in before}
    for r in before:
        sizes[r.source] += len(WORD.findall(r.text))
    for r in after.collect():
        words = WORD.findall(r.text)
        taken[r.source] += len(words)
        assert r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or not Counter(words) - Counter(WORD.findall(texts[r.doc_id]))
    target = water_fill(sizes, mixing.WEIGHTS)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_sharding_stage(steps):
    _, before, after = steps[4]
    rows = after.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in before)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_last_stage(steps, spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    key = ["doc_id", F.xxhash64("text"), "shard", "slot"]
    assert Counter(rows.select(*key).collect()) == Counter(steps[-1][2].select(*key).collect())


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_documents(spark, sf_dir, odd_documents, empty):
    docs = odd_documents.where("false") if empty else odd_documents
    for name, step in corpus_pipeline.STAGES:
        result = step(spark, docs, sf_dir)
        if name != "vector_sharding":
            assert result.columns == docs.columns, name
        n = result.count()
        assert n == 0 if empty else n > 0
        if name in ("decontamination", "vector_sharding"):
            assert empty or n <= docs.count()


def test_repeated_rows(spark, sf_dir):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "en", "s", 21)] * 3 + [(2, "", "en", "s", 0)] * 2,
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()) == [1, 2, 2]
    mixed = corpus_pipeline.mix_sources(spark, docs, sf_dir).collect()
    assert sum(len(r.text.split()) for r in mixed) == round(1.5 * 33)
    placed = corpus_pipeline.pack_shards(spark, docs, sf_dir).collect()
    assert len(placed) == 5 and len({(r.shard, r.slot) for r in placed}) == 5
