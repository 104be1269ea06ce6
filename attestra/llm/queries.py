"""The queries ``opN_<name>`` and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm import chat_format, decontaminate, exact_dedup, language_id, line_dedup, near_dedup, pii, sentencepiece_np, substring_dedup, token_alignment, toxicity, upsert, url_filter
from attestra.llm.common import table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast(convs.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(convs.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat_format.PROBE).alias("text"),
    )
    out = chat_format.digests(chat_format.format_conversations(convs.unionByName(probe)))
    return out.drop("n_tokens", "n_loss_tokens")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), passage=substring_dedup.PASSAGE)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_shared_words")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_pii(table(spark, sf_dir, "documents")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", language_id.held_out("doc_id", 5, 0).alias("held_out"))
    model = language_id.learn(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, keep=("doc_id", "held_out"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = language_id.held_out("doc_id", 4, 2)
    labels = table(spark, sf_dir, "labels").where(~held)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "evidence")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_np.digest(sentencepiece_np.encode_documents(table(spark, sf_dir, "documents")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"))


def op12_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = table(spark, sf_dir, "clients")
    files, folder = upsert.upsert_clients(spark, clients, table(spark, sf_dir, "client_changes"))
    return upsert.digest(spark, files, folder, clients.schema)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_pii": op4_pii,
    "op5_language_id": op5_language_id,
    "op6_toxicity": op6_toxicity,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_decontaminate": op8_decontaminate,
    "op9_near_dedup": op9_near_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_upsert": op12_upsert,
    "op13_url_filter": op13_url_filter,
}

ORACLES = {
    "op1_chat_format": chat_format.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op13_url_filter": url_filter.ORACLE,
}
