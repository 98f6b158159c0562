"""The registered queries of this subpackage: each operator over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm import (
    bpe, conversation_repair, conversation_trie, decontam, jaccard, lm_score, main_text, mixing, pii, quality, secret_scan,
    sharding, token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark, sf_dir):
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "passes", F.size("parts").alias("n_parts"))


def op2_quality_rules(spark, sf_dir):
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words",
    )


def op3_personal_data(spark, sf_dir):
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op4_main_text(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    texts = main_text.extract(pages, main_text.fit_on(pages))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_jaccard_join(spark, sf_dir):
    return jaccard.near_copies(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_token_counts(spark, sf_dir):
    """Tokens of every sentence of every document."""
    counts = token_counts.section_counts(_table(spark, sf_dir, "documents"))
    return counts.withColumn("n_tokens", F.col("n_tokens").cast("long"))


def op7_secret_scan(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit_on(docs))


def op8_context_mixing(spark, sf_dir):
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op9_vector_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def op10_decontaminate(spark, sf_dir):
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def op11_bpe_codec(spark, sf_dir):
    """Digests of every text's tokens, and of what they decode to."""
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id", F.expr("length(tokens) div 4").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_conversation_repair(spark, sf_dir):
    damaged = conversation_repair.damage(_table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(damaged).drop("n_rows")


def op13_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_trie(conversation_trie.rebuild(_table(spark, sf_dir, "conversations")))


LLM_QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_source_mixing, op2_quality_rules, op3_personal_data, op4_main_text, op5_jaccard_join, op6_token_counts,
        op7_secret_scan, op8_context_mixing, op9_vector_sharding, op10_decontaminate, op11_bpe_codec,
        op12_conversation_repair, op13_conversation_trie,
    )
}
