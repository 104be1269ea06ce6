"""Exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import stage

#: Characters that do not count when texts are compared.
BLANKS = " \t\n\x0b\x0c\r"


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int = 64, fan_in: int = 4) -> DataFrame:
    """One row per input row with the row that stands for its text.

    Rows are dealt into ``runs`` runs. Each run keeps one entry per digest: the
    count and the best row, which has the most code points and then the
    smallest id. Rounds merge ``fan_in`` neighbouring runs at a time until one
    is left, so that a text held by a third of all rows arrives as one entry
    per run. Entries are verified: they merge only if the SHA-256, a second
    independent 64-bit digest and the normalised length agree. Winners return
    to the rows by (digest, run), which spreads a hot text over all runs.

    Returns ``id_col``, keep_id, group_size, kept, text_sha256. Only these two
    input columns are read; others may have any name. Null text counts as
    empty; all blank texts are equal. A null id sorts before others, and a row
    is kept if its id is null-safe equal to keep_id, so exact repeats of a kept
    row, id included, stay marked as kept. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, BLANKS, "")
    leaf = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(text).alias("n"),
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.struct(F.xxhash64(norm).alias("h"), F.length(norm).alias("l")).alias("check"),
    ).withColumn("run", F.pmod(F.xxhash64("doc_id", "n"), F.lit(runs)).cast("int"))
    leaf = stage(leaf, "exact-leaf")

    level = leaf.groupBy("digest", "check", "run").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("n")).alias("minus"), "doc_id")).alias("best"),
        F.first(F.array("run")).alias("leaves"),
    )
    width = runs
    while width > 1:
        width = -(-width // fan_in)
        level = (
            level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .groupBy("digest", "check", "run")
            .agg(F.sum("group_size").alias("group_size"), F.min("best").alias("best"), F.flatten(F.collect_list("leaves")).alias("leaves"))
        )
    won = level.where("group_size > 1").select("digest", "check", F.explode("leaves").alias("run"), F.col("best.doc_id").alias("keep_id"), "group_size", F.lit(True).alias("found"))
    out = leaf.join(won, ["digest", "check", "run"], "left")
    keep = F.when(F.col("found"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select(
        F.col("doc_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY length(t) DESC, doc_id) AS k,
             count(*) OVER (PARTITION BY h) AS c FROM n),
w AS (SELECT h, doc_id AS keep_id FROM r WHERE k = 1)
SELECT r.doc_id, w.keep_id, r.c AS group_size, r.doc_id = w.keep_id AS kept, r.h AS text_sha256
FROM r JOIN w ON r.h = w.h
"""
