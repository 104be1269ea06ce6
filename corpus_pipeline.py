"""The corpus pipeline: filter, deduplicate, decontaminate, tokenise.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last
have the columns of ``documents``, and any further ones, whatever their names.
Null and empty texts pass every stage but as said; ids may be null or repeat,
rows may repeat; an empty table gives an empty one. Ties go as the operators'
docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.llm.common import stage, table
from attestra.llm.decontaminate import decontaminate
from attestra.llm.language_id import held_out
from attestra.llm.line_dedup import line_dedup
from attestra.llm.near_dedup import keep_one
from attestra.llm.sentencepiece_np import encode_documents
from attestra.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go. Texts without a word have the rate of labelled ones without, under the threshold in any usual corpus; repeated rows go or stay together."""
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2))
    return reject_toxic(docs, labels)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs and of long lines go, and documents of which nothing is left by that; n_chars follows the text.

    The first copy is that with the smallest id, then line. Null texts have no
    lines and stay. Rows equal in id and text are one here and stay or go
    together. The columns n_lines, n_removed and n_runs of ``docs``, if any, are kept.
    """
    clash = {c: f"__own_{c}" for c in ("n_lines", "n_removed", "n_runs") if c in docs.columns}
    out = line_dedup(docs.withColumnsRenamed(clash), lone=True).where("n_removed = 0 or n_removed < n_lines")
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    out = out.withColumn("n_chars", length).drop("n_lines", "n_removed", "n_runs") if clash else out.withColumn("n_chars", length)
    return out.withColumnsRenamed({v: k for k, v in clash.items()}).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id, and one row of those that repeat. Texts without words and rows with a null id stay."""
    return keep_one(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; of rows that share an id only those whose text does."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, input_ids, n_tokens and round_trip of each row; null and empty texts have no ids."""
    return encode_documents(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_dedup", near), ("decontamination", benchmarks), ("sentencepiece", tokens)]

#: Nearest neighbours and tokenisation have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
