"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    embedding_join,
    merkle,
    mixing,
    packing,
    phrases,
    pii,
    quality_rules,
    sharding,
    simhash,
    spelling,
    token_count,
    url_templates,
)
from .common import table

SHARD_BYTES = 2 << 20

#: Target shares of tokens.
MIX = {"high": 0.9, "low": 0.1, "toxic": 0.0}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = mixing.label_domains(table(spark, sf_dir, "labels"))
    mixed = mixing.mixed_rates(table(spark, sf_dir, "documents"), labels, MIX, keep=["doc_id"])
    m, p = F.col("mix"), F.col("mix")["posterior"]
    return mixed.select(
        "doc_id", m["tokens"].alias("n_tokens"), m["domain"].alias("domain"),
        *[F.coalesce(p[d], F.lit(0.0)).alias(f"p_{d}") for d in MIX],
        m["rate"].alias("rate"), m["copies"].alias("copies"),
        m["target"].alias("domain_target"), m["reached"].alias("domain_reached"),
    )


def op4_disguised_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, spans = F.col("pii")["base"], F.col("pii")["spans"]
    counts = [pii.count_of(spans, kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(spans).alias("spans")
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    q = F.col("quality")
    judged = quality_rules.assess(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[(q["lines"]["dup"] if f == "n_dup_lines" else q[f]).alias(f) for f in fields])


def op6_packed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packed(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def packed(docs: DataFrame) -> DataFrame:
    """The ids are those of byte_bpe_50k.json; the rank file of the same vocabulary gives them several times faster."""
    import public_tokenizers

    files = [tokenizer_file(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    return packing.pack(docs, *files, public_tokenizers.PATTERN, {"<|endoftext|>": 50_256})


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge_urls(table(spark, sf_dir, "pages")).drop("purity")


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op10_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = phrases.deduplicate(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_simhash_near_dedup,
        op3_soft_mixing,
        op4_disguised_pii,
        op5_quality_rules,
        op6_packed_windows,
        op7_embedding_near_dedup,
        op8_url_templates,
        op9_extendible_shards,
        op10_repeated_phrases,
        op11_spelling_variants,
        op12_merkle_manifest,
        op13_benchmark_decontamination,
    )
}
