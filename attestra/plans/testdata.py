"""Bindings of the driver's tables to evidence, candidates, names and probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.config import SOURCES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified linked events, bound to the ``events`` table."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    i = F.col("event_id")
    day = F.to_date("ts")
    t1 = day >= F.lit("2024-01-21").cast("date")
    src = _pick(list(SOURCES), i % 5)
    return e.select(
        F.col("user_id").alias("candidate_record_id"),
        F.when(t1, "T1").otherwise("T0").alias("phase"),
        F.when(t1 & (i % 29 == 0), "").otherwise(src).alias("source_domain"),
        F.when(t1 & (i % 29 == 0), "external").otherwise(src).alias("src"),
        i.alias("source_record_id"),
        F.when(i % 17 != 0, day).alias("event_dt"),
        F.when(t1, F.date_add(day, (i % 45).cast("int"))).alias("observed_dt"),
        F.when(F.floor(i / 11) % 3 != 0, F.date_add(day, (i % 60).cast("int"))).alias("end_dt"),
        F.when(F.col("event_type").isin("purchase", "signup"), "DE").when(F.col("event_type") == "click", F.when(i % 2 == 0, "PA").otherwise("MD")).when(F.col("event_type") == "view", "NJ").otherwise("").alias("state"),
        F.when(i % 31 != 0, F.get(F.array(*[F.lit(x) for x in (0.995, 0.975, 0.955, 0.935, 0.885)]), (i % 7 % 5).cast("int"))).alias("link_confidence"),
        _pick(["A", "A", "A", "B", "C"], i % 7 % 5).alias("link_tier"),
        F.when(src == "title", _pick(["title_record", "ownership_change", "record_update"], F.floor(i / 5) % 3)).otherwise("").alias("event_type"),
        F.when(t1, _pick(["new_record", "status_update", "record_correction"], F.floor(i / 3) % 3)).otherwise("").alias("record_action"),
        F.when(src == "license", _pick(["active", "active", "expired", "superseded", ""], F.floor(i / 7) % 5)).otherwise("").alias("credential_status"),
        F.when(src == "external", _pick(["limited", "standard"], F.floor(i / 5) % 2)).otherwise("").alias("evidence_quality"),
        F.when((src == "title") & (i % 13 != 0), F.concat(F.lit("V"), (i % 40).cast("string"))).otherwise("").alias("vehicle_ref"),
    )


#: The same binding for DuckDB.
EVIDENCE_SQL = """
ev AS (
  SELECT user_id AS candidate_record_id, CASE WHEN t1 THEN 'T1' ELSE 'T0' END AS phase,
    CASE WHEN t1 AND event_id % 29 = 0 THEN '' ELSE s END AS source_domain,
    CASE WHEN t1 AND event_id % 29 = 0 THEN 'external' ELSE s END AS src,
    event_id AS source_record_id, CASE WHEN event_id % 17 <> 0 THEN day END AS event_dt,
    CASE WHEN t1 THEN day + CAST(event_id % 45 AS INTEGER) END AS observed_dt,
    CASE WHEN (event_id // 11) % 3 <> 0 THEN day + CAST(event_id % 60 AS INTEGER) END AS end_dt,
    CASE WHEN et IN ('purchase', 'signup') THEN 'DE' WHEN et = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'PA' ELSE 'MD' END
         WHEN et = 'view' THEN 'NJ' ELSE '' END AS state,
    CASE WHEN event_id % 31 <> 0 THEN [0.995::DOUBLE, 0.975, 0.955, 0.935, 0.885][1 + event_id % 7 % 5] END AS link_confidence,
    ['A', 'A', 'A', 'B', 'C'][1 + event_id % 7 % 5] AS link_tier,
    CASE WHEN s = 'title' THEN ['title_record', 'ownership_change', 'record_update'][1 + (event_id // 5) % 3] ELSE '' END AS event_type,
    CASE WHEN t1 THEN ['new_record', 'status_update', 'record_correction'][1 + (event_id // 3) % 3] ELSE '' END AS record_action,
    CASE WHEN s = 'license' THEN ['active', 'active', 'expired', 'superseded', ''][1 + (event_id // 7) % 5] ELSE '' END AS credential_status,
    CASE WHEN s = 'external' THEN ['limited', 'standard'][1 + (event_id // 5) % 2] ELSE '' END AS evidence_quality,
    CASE WHEN s = 'title' AND event_id % 13 <> 0 THEN 'V' || (event_id % 40) ELSE '' END AS vehicle_ref
  FROM (SELECT event_id, user_id, event_type AS et, ts::DATE AS day, ts::DATE >= DATE '2024-01-21' AS t1,
               ['address', 'license', 'title', 'external', 'work'][1 + event_id % 5] AS s FROM events)
),
cand AS (
  SELECT c_custkey AS candidate_record_id, DATE '2024-01-10' + CAST(c_custkey % 15 AS INTEGER) AS candidate_dt,
    ['DE', 'PA', ''][1 + c_nationkey % 3] AS observed_state
  FROM customer
),
t1cut AS (SELECT max(observed_dt) AS as_of FROM ev WHERE phase = 'T1')
"""


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("candidate_record_id"),
        F.date_add(F.lit("2024-01-10").cast("date"), (F.col("c_custkey") % 15).cast("int")).alias("candidate_dt"),
        _pick(["DE", "PA", ""], F.col("c_nationkey") % 3).alias("observed_state"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled probabilities: (id, y, p0, p1, p2, q0, q1, q2) from documents' labels and digests of their ids."""
    d = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 1).otherwise(2).alias("y"))
    raw = lambda k: 1 + F.conv(F.substring(F.md5(F.col("id").cast("string")), 1 + 4 * k, 4), 16, 10).cast("long") % 97
    d = d.select("id", "y", *[(raw(k) + F.when(F.col("y") == k % 3, 60).otherwise(0)).cast("double").alias(f"r{k}") for k in range(6)])
    return d.select(
        "id", "y",
        *[(F.col(f"r{k}") / (F.col("r0") + F.col("r1") + F.col("r2"))).alias(f"p{k}") for k in range(3)],
        *[(F.col(f"r{k + 3}") / (F.col("r3") + F.col("r4") + F.col("r5"))).alias(f"q{k}") for k in range(3)],
    )


PREDICTIONS_SQL = """
pr0 AS (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 1 ELSE 2 END AS y, md5(CAST(doc_id AS VARCHAR)) AS h FROM labels),
pr1 AS (SELECT id, y, """ + ", ".join(
    f"(1 + CAST('0x' || substr(h, {1 + 4 * k}, 4) AS BIGINT) % 97 + CASE WHEN y = {k % 3} THEN 60 ELSE 0 END)::DOUBLE AS r{k}" for k in range(6)
) + """ FROM pr0),
pr AS (SELECT id, y, """ + ", ".join([*(f"r{k} / (r0 + r1 + r2) AS p{k}" for k in range(3)), *(f"r{k + 3} / (r3 + r4 + r5) AS q{k}" for k in range(3))]) + """ FROM pr1)
"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for linkage, bound to ``part``: two-word names, dates and addresses from keys."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("candidate_record_id"), F.split("p_name", " ")[0].alias("first_name"), F.split("p_name", " ")[1].alias("last_name"),
        F.date_format(F.date_add(F.lit("1950-01-01").cast("date"), (k % 900).cast("int")), "yyyy-MM-dd").alias("date_of_birth"),
        F.concat((k % 700).cast("string"), F.lit(" North Main Street Apt "), (k % 3).cast("string")).alias("observed_street_address"),
    )


PEOPLE_SQL = """
pe AS (SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS f, split_part(p_name, ' ', 2) AS l,
  strftime(DATE '1950-01-01' + CAST(p_partkey % 900 AS INTEGER), '%Y-%m-%d') AS d, (p_partkey % 700) || ' North Main Street Apt ' || (p_partkey % 3) AS a FROM part),
dm AS (SELECT id, id AS source_record_id,
  CASE id % 7 WHEN 1 THEN left(f, length(f) - 1) WHEN 2 THEN 'SYNGIV-' || f WHEN 3 THEN replace(f, 'e', 'é') WHEN 4 THEN l WHEN 5 THEN '' ELSE ' ' || f || ' ' END AS first_name,
  CASE WHEN id % 7 = 4 THEN f WHEN id % 11 = 3 THEN left(l, 2) || substr(l, 4) ELSE l END AS last_name,
  CASE WHEN id % 5 = 0 THEN '' WHEN id % 5 = 1 THEN 'SYNDOB-' || replace(d, '-', '/') WHEN id % 13 = 2 THEN '2024-02-31' WHEN id % 10 = 3 THEN 'born ' || replace(d, '-', '') WHEN id % 35 = 8 THEN '1980/1/2' ELSE d END AS date_of_birth,
  CASE WHEN id % 6 = 0 THEN '' ELSE upper(replace(a, 'Street', 'St.')) END AS street_address,
  CASE WHEN id % 19 = 0 THEN ' nan' WHEN id % 17 = 0 THEN ' V' || (id + 1) ELSE 'V' || id END AS vehicle_ref,
  CASE WHEN id % 23 = 0 THEN 'V' || (id + 1) ELSE 'V' || id END AS update_ref,
  ['address', 'license', 'title', 'external', 'work'][1 + id % 5] AS source_domain, ['new_record', 'status_update', 'record_correction'][1 + id % 3] AS record_action,
  strftime(DATE '2024-01-01' + CAST(id % 50 AS INTEGER), '%Y-%m-%d') AS event_date, ['DE', 'PA', ''][1 + id % 3] AS state FROM pe)
"""


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same people as another source has them: shortened, accented, prefixed, swapped, with gaps."""
    p, k, f, n = people(spark, sf_dir), F.col("candidate_record_id"), F.col("first_name"), F.col("last_name")
    d, a = F.col("date_of_birth"), F.col("observed_street_address")
    first = F.when(k % 7 == 1, F.left(f, F.length(f) - 1)).when(k % 7 == 2, F.concat(F.lit("SYNGIV-"), f)).when(k % 7 == 3, F.replace(f, F.lit("e"), F.lit("é"))).when(k % 7 == 4, n).when(k % 7 == 5, "").otherwise(F.concat(F.lit(" "), f, F.lit(" ")))
    last = F.when(k % 7 == 4, f).when(k % 11 == 3, F.concat(F.left(n, F.lit(2)), F.substring(n, 4, 100))).otherwise(n)
    return p.select(
        k.alias("source_record_id"), first.alias("first_name"), last.alias("last_name"),
        F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(F.lit("SYNDOB-"), F.replace(d, F.lit("-"), F.lit("/")))).when(k % 13 == 2, "2024-02-31")
        .when(k % 10 == 3, F.concat(F.lit("born "), F.replace(d, F.lit("-"), F.lit("")))).when(k % 35 == 8, "1980/1/2").otherwise(d).alias("date_of_birth"),
        F.when(k % 6 == 0, "").otherwise(F.upper(F.replace(a, F.lit("Street"), F.lit("St.")))).alias("street_address"),
        F.when(k % 19 == 0, " nan").when(k % 17 == 0, F.concat(F.lit(" V"), (k + 1).cast("string"))).otherwise(F.concat(F.lit("V"), k.cast("string"))).alias("vehicle_ref"),
        F.concat(F.lit("V"), (k + F.when(k % 23 == 0, 1).otherwise(0)).cast("string")).alias("update_ref"),
        _pick(list(SOURCES), k % 5).alias("source_domain"), _pick(["new_record", "status_update", "record_correction"], k % 3).alias("record_action"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (k % 50).cast("int")), "yyyy-MM-dd").alias("event_date"), _pick(["DE", "PA", ""], k % 3).alias("state"),
    )


def linkage_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six sources of a run, with their own column names. Titles have each vehicle twice, under a damaged and under the plain name."""
    d, p = damaged(spark, sf_dir), people(spark, sf_dir)
    names = ["source_record_id", "first_name", "last_name"]
    titles = d.select((2 * F.col("source_record_id")).alias("source_record_id"), "first_name", "last_name", "vehicle_ref", "event_date", "state")
    k = F.col("candidate_record_id")
    plain = p.where(k % 2 == 0).select((2 * k + 1).alias("source_record_id"), "first_name", "last_name", F.concat(F.lit("V"), k.cast("string")).alias("vehicle_ref"), F.lit("2023-12-31").alias("event_date"), F.lit("DE").alias("state"))
    return {
        "address_history": d.select(*names, "street_address", "state", F.col("event_date").alias("effective_start_date"), F.lit("").alias("effective_end_date")),
        "license_id_events": d.select(*names, "date_of_birth", "event_date", F.col("state").alias("credential_state"), F.lit("active").alias("credential_status")),
        "external_context_signals": d.select(*names, F.col("event_date").alias("effective_date"), F.col("state").alias("signal_state"), F.lit("limited").alias("evidence_quality")),
        "vehicle_title_events": titles.unionByName(plain).select("source_record_id", F.col("first_name").alias("owner_first_name"), F.col("last_name").alias("owner_last_name"), "vehicle_ref", "event_date", F.col("state").alias("event_state")),
        "work_location_signals": d.select(*names, F.col("event_date").alias("observed_date"), F.col("state").alias("work_state")),
        "evidence_update_stream": d.select(*names, "source_domain", "record_action", F.col("update_ref").alias("vehicle_ref"), F.col("event_date").alias("effective_date"), F.col("event_date").alias("observed_date"), "state"),
    }
