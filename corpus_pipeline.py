"""From raw documents to shards: quality, near copies, benchmark passages, mixture, shards.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. ``run``
writes what each stage returns to the shared folder and reads it again for the next one.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm import decontam, jaccard, mixing, quality, sharding
from offerlens.llm import words as W
from offerlens.staging import drop_stage, new_stage_path, stage, stage_scope


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and every quality rule."""
    judged = quality.judge(docs.select(F.struct(*docs.columns).alias("__row"), F.col("text")))
    return judged.where("kept").select("__row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one whose id names the group, once."""
    found = jaccard.near_copies(docs)
    stay = stage(
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_key", "n_shingles"),
        "pipeline-stay",
    )
    # Texts without words are linked with nothing: each of their rows stays. So does an id
    # that repeats with texts of different groups.
    keyed = docs.withColumn("__text_key", F.xxhash64(W.text_of(F.col("text"))))
    wanted = stay.groupBy("doc_id", "text_key").agg(F.max("n_shingles").alias("__n")).withColumnsRenamed(
        {"doc_id": "__id", "text_key": "__key"}
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    kept = keyed.join(wanted, same)
    first = F.row_number().over(Window.partitionBy("__id", "__text_key").orderBy(F.lit(1)))
    return kept.withColumn("__no", first).where("__no = 1 or __n = 0").select(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy that the mixture takes, the last of a document with a part of its words."""
    keyed = docs.withColumn("__key", W.row_key())
    mixed = mixing.mix(keyed, carry=("doc_id", "source", "__key"))
    taken = W.attach(keyed, mixed.where("taken > 0"), ["passes", "parts"]).where(F.col("passes").isNotNull())
    copies = mixing.mixed_texts(taken)
    if "n_chars" in docs.columns:
        copies = copies.withColumn("n_chars", F.char_length("text").cast("long"))
    return copies.select(*docs.columns)


def pack_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with the shard and the slot in it where they are stored."""
    keyed = docs.withColumn("__key", W.row_key())
    placed = sharding.shard(keyed, carry=("doc_id", "__key"))
    return W.attach(keyed, placed, ["size", "text_crc32", "shard", "slot"])


STAGES = [
    ("quality_rules", reject_low_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", remove_contaminated),
    ("source_mixing", mix_sources),
    ("vector_sharding", pack_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, step) in enumerate(STAGES):
        path = new_stage_path(spark, f"pipeline-{name}")
        with stage_scope(spark):  # what the operators stage goes when their result is stored
            step(spark, docs, sf_dir).write.parquet(path)
        if number:
            drop_stage(docs)
        docs = spark.read.parquet(path)
    return docs


#: Block selection, near-copy classes and packing have no SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None
