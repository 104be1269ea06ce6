"""Queries over streams that keep state, each fed in several drops on one checkpoint."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.plans.common import Registry
from attestra.plans.evidence_queries import GROUPS, doubles
from attestra.plans.evidence_sql import K, features, with_
from attestra.plans.testdata import candidates, evidence, table
from attestra.streaming import features as kept
from attestra.streaming import state

R = Registry()
#: How far behind the newest event of earlier drops a click is late.
LATE_SECONDS = 3600


def _stream(spark, folder, schema):
    return spark.readStream.schema(schema).parquet(folder)


@R.add(
    "stream_review_state",
    """WITH c AS (SELECT user_id AS key, epoch_us(ts) AS micros, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'status' WHEN 'signup' THEN 'status' WHEN 'error' THEN 'untag' ELSE 'tag' END AS action,
  CASE event_type WHEN 'purchase' THEN 'cleared' WHEN 'signup' THEN 'in_review' ELSE 't' || (event_id % 4) END AS value FROM events),
s AS (SELECT key, arg_max(value, micros * 1000000::HUGEINT + seq) AS status FROM c WHERE action = 'status' GROUP BY 1),
t AS (SELECT key, value, arg_max(action, micros * 1000000::HUGEINT + seq) AS last FROM c WHERE action <> 'status' GROUP BY 1, 2),
g AS (SELECT key, string_agg(value, ',' ORDER BY value) AS tags FROM t WHERE last = 'tag' GROUP BY 1)
SELECT k.key AS user_id, coalesce(status, 'unreviewed') AS reviewer_status, coalesce(tags, '') AS reviewer_tags FROM (SELECT DISTINCT key FROM c) k LEFT JOIN s USING (key) LEFT JOIN g USING (key)""",
)
def stream_review_state(spark, sf_dir):
    """Events as review commands, in three drops by day; the state store goes on from its checkpoint after each."""
    e, kind = table(spark, sf_dir, "events"), F.col("event_type")
    commands = e.select(
        F.col("user_id").alias("key"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.col("event_id").alias("seq"), F.when(kind.isin("purchase", "signup"), "status").when(kind == "error", "untag").otherwise("tag").alias("action"),
        F.when(kind == "purchase", "cleared").when(kind == "signup", "in_review").otherwise(F.concat(F.lit("t"), (F.col("event_id") % 4).cast("string"))).alias("value"),
    )
    third = F.least(F.floor((F.dayofmonth(F.timestamp_micros("at")) - 1) / 10), F.lit(2))
    base = state.in_drops(commands, third, "review-state", lambda folder, base: state.review_states(_stream(spark, folder, commands.schema), base))
    out = state.newest_states(spark, base, f"key {dict(commands.dtypes)['key']}, reviewer_status string, reviewer_tags array<string>, batch int")
    return out.select(F.col("key").alias("user_id"), "reviewer_status", F.array_join("reviewer_tags", ",").alias("reviewer_tags"))


@R.add(
    "stream_lags",
    f"""WITH c AS (SELECT date_trunc('month', arrived_at) AS m, epoch(date_trunc('second', ts))::BIGINT AS t, epoch(date_trunc('second', arrived_at))::BIGINT AS o FROM clicks),
w AS (SELECT m, max(max(t)) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM c GROUP BY m)
SELECT count(*) AS rows, avg((o - t)::DOUBLE) AS mean_seconds, max(o - t) AS longest_seconds, count(*) FILTER (o - t > 30 * 86400) AS over_30_days, count(*) FILTER (t < top - {LATE_SECONDS}) AS late_rows FROM c JOIN w ON c.m IS NOT DISTINCT FROM w.m""",
    "mean_seconds",
)
def stream_lags(spark, sf_dir):
    """Delays of clicks that arrive month by month; those behind earlier months' newest click are counted and kept."""
    c = table(spark, sf_dir, "clicks")
    base = state.in_drops(c, F.date_trunc("month", "arrived_at"), "lags", lambda folder, base: state.lags(_stream(spark, folder, c.schema), "ts", "arrived_at", LATE_SECONDS, base))
    return state.lag_metrics(spark, base)


@R.add(
    "stream_merge",
    """WITH l AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY seq DESC, change_id DESC) AS k FROM client_changes)
SELECT client_id, change_id, seq, source, segment, city, balance FROM l WHERE k = 1 AND op <> 'D'""",
    "balance",
)
def stream_merge(spark, sf_dir):
    """Corrections of clients in drops by month, the last drop sent twice: the last change of each client that it left in place."""
    c = table(spark, sf_dir, "client_changes")
    apply = lambda folder, base: state.merge(_stream(spark, folder, c.schema), base, "client_id", ["seq", "change_id"], F.col("op") == "D")
    month = c.withColumn("_month", F.month("valid_at"))
    again = month.unionByName(month.where("_month >= 4").withColumn("_month", F.lit(13)))
    base = state.in_drops(again, F.col("_month"), "merge", apply)
    return state.reload(spark, base, c.schema).select("client_id", "change_id", "seq", "source", "segment", "city", "balance")


#: What cells of counts hold; other features need the order of records.
CURRENT = ["as_of_date", *" ".join(GROUPS[g] for g in ("evidence_counts", "recency_windows", "recency_latest", "decay_weights", "latest_source_conflict", "per_source_pivot", "per_source_latest", "link_quality", "update_lag")).split()]


@R.add("stream_features", f"{with_(features('T1'))} SELECT {K}, {', '.join(CURRENT)} FROM f_t1", doubles(CURRENT))
def stream_features(spark, sf_dir):
    """The first snapshot, then updates week by week: the features of all candidates after the last drop, from cells that each drop added to."""
    e = evidence(spark, sf_dir)
    drop = F.when(F.col("phase") == "T1", F.weekofyear("observed_dt")).otherwise(0)
    base = state.in_drops(e, drop, "features", lambda folder, base: kept.keep_cells(_stream(spark, folder, e.schema), base))
    return kept.features(candidates(spark, sf_dir), kept.newest_cells(spark, base, e)).select(K, *CURRENT)


QUERIES, ORACLES = R.queries, R.oracles
