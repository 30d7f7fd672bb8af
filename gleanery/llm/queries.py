"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    chat,
    clustering,
    conversation_repair,
    decontaminate,
    host_rules,
    html_density,
    mixing,
    packing,
    quality_knn,
    simhash,
    template_lines,
    token_blocks,
    toxicity,
)
from gleanery.llm.common import fold
from gleanery.llm.oracles import ORACLES  # noqa: F401
from gleanery.session import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.contamination(documents, benchmark))


def _verdicts(scored: DataFrame, held_out, least: float) -> DataFrame:
    predicted = (F.col("score") >= least).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_knn.score(documents, quality_knn.fit(documents, _table(spark, sf_dir, "labels")))
    return _verdicts(scored, fold(F.col("doc_id"), quality_knn.FOLDS) == quality_knn.HELD_OUT, 0.5)


def op5_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = template_lines.drop_recurring_lines(_table(spark, sf_dir, "documents"))
    return lines.select("row.doc_id", "n_lines", "n_dropped", "text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity.fit(documents, _table(spark, sf_dir, "labels")))
    return _verdicts(scored, fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT, 0.3)


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    rows = " union all ".join(f"select -7L as conv_id, {i}L as turn, '{role}' as role, r'{said}' as text" for i, role in enumerate(("user", "assistant")))
    added = spark.sql(rows)
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat.digests(materialise(chat.format_windows(turns)))


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_blocks.read_documents(materialise(token_blocks.encode_segments(_table(spark, sf_dir, "documents"), path, specials=True)))


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(_table(spark, sf_dir, "documents"))


def op10_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.main_texts(_table(spark, sf_dir, "pages"))


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.digests(clustering.cluster(_table(spark, sf_dir, "embeddings")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.digests(conversation_repair.damage(turns))
    every = turns.select(F.struct("conv_id").alias("conv")).distinct().join(found, "conv", "left")  # some lose all their turns
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return every.select("conv.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.Mix(_table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_knn": op4_quality_knn,
    "op5_template_lines": op5_template_lines,
    "op6_toxicity": op6_toxicity,
    "op7_chat_windows": op7_chat_windows,
    "op8_token_blocks": op8_token_blocks,
    "op9_host_rules": op9_host_rules,
    "op10_html_density": op10_html_density,
    "op11_clustering": op11_clustering,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_mixing": op13_mixing,
}
