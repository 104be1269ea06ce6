"""Queries of the review layer, generic tables, models and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.config import CLASSES, SOURCES
from attestra.functions.text import clean_text, register_functions
from attestra.functions.values import anchor_weight, canonical_source, entropy, evidence_group, priority_band, relative_age
from attestra.operators import behaviour, models, review
from attestra.operators import evidence as ev
from attestra.operators import submission as sb
from attestra.plans.common import Registry, settled
from attestra.plans.evidence_sql import DELTA, K, UPDATES, features, with_
from attestra.plans.metric_queries import _bundle_ctes
from attestra.plans.testdata import EVIDENCE_SQL, PREDICTIONS_SQL, candidates, evidence, predictions, table
from attestra.sources import catalog, files
from attestra.sources.stages import own_folder
from attestra.streaming import updates

R = Registry()
W, N, I = CLASSES  # noqa: E741


def _probabilities(df, key):
    raw = lambda k: 1 + F.conv(F.substring(F.md5(F.col(key).cast("string")), 1 + 4 * k, 4), 16, 10).cast("long") % 97
    df = df.select("*", *[raw(k).cast("double").alias(f"_r{k}") for k in range(6)])
    out = [(F.col(f"_r{k}") / (F.col("_r0") + F.col("_r1") + F.col("_r2"))).alias(f"p{k}") for k in range(3)] + [(F.col(f"_r{k + 3}") / (F.col("_r3") + F.col("_r4") + F.col("_r5"))).alias(f"q{k}") for k in range(3)]
    return df.select(*[c for c in df.columns if not c.startswith("_r")], *out)


def _cases(spark, sf_dir):
    c = _probabilities(candidates(spark, sf_dir).select(K), K)
    c = review.with_prediction(review.with_prediction(c, ("p0", "p1", "p2"), "t0"), ("q0", "q1", "q2"), "t1")
    return review.evidence_profile(c.select(K, *[f"{p}_{x}" for p in ("t0", "t1") for x in ("class", "confidence", "priority")]), evidence(spark, sf_dir))


def _cls(p):
    return f"CASE WHEN {p}0 >= greatest({p}1, {p}2) THEN '{W}' WHEN {p}1 >= {p}2 THEN '{N}' ELSE '{I}' END"


BAND = "CASE WHEN {0} >= 0.85 THEN 'critical' WHEN {0} >= 0.7 THEN 'high' WHEN {0} >= 0.4 THEN 'medium' ELSE 'low' END"
CASES = f"""
cp0 AS (SELECT {K}, {", ".join(f"(1 + CAST('0x' || substr(md5(CAST({K} AS VARCHAR)), {1 + 4 * k}, 4) AS BIGINT) % 97)::DOUBLE AS r{k}" for k in range(6))} FROM cand),
cp AS (SELECT {K}, {", ".join([*(f"r{k} / (r0 + r1 + r2) AS p{k}" for k in range(3)), *(f"r{k + 3} / (r3 + r4 + r5) AS q{k}" for k in range(3))])} FROM cp0),
eu AS (SELECT * REPLACE (CASE WHEN trim(coalesce(state, '')) = '' THEN 'UNK' ELSE state END AS state) FROM ev),
pr AS (SELECT {K}, count(*) AS n, avg(coalesce(link_confidence, 0.0)) AS ac, max(coalesce(event_dt, observed_dt)) AS latest, count(*) FILTER (phase = 'T1') AS recent, count(*) FILTER (src = 'license' AND state = 'DE') AS dec,
  count(*) FILTER (src = 'address' AND state <> 'DE') AS oa, list(DISTINCT state) FILTER (src = 'title') AS ts, list(DISTINCT state) FILTER (src = 'address') AS ast, count(DISTINCT state) AS ns, {", ".join(f"count(*) FILTER (src = '{x}') AS n_{x}" for x in SOURCES)} FROM eu GROUP BY 1),
tp AS (SELECT {K}, arg_min(state, printf('%010d', 1000000000 - n) || state) AS st FROM (SELECT {K}, state, count(*) AS n FROM eu WHERE state <> 'UNK' GROUP BY 1, 2) GROUP BY 1),
os AS (SELECT {K}, arg_min(state, printf('%010d', 1000000000 - n) || state) AS st FROM (SELECT {K}, state, count(*) AS n FROM eu WHERE src = 'address' AND state <> 'DE' GROUP BY 1, 2) GROUP BY 1),
cs AS (SELECT cp.{K}, {_cls('p')} AS t0_class, greatest(p0, p1, p2) AS t0_confidence, p0 AS t0_priority, {_cls('q')} AS t1_class, greatest(q0, q1, q2) AS t1_confidence, q0 AS t1_priority,
  coalesce(n, 0) AS total_records, {", ".join(f"coalesce(n_{x}, 0) AS n_{x}" for x in SOURCES)}, CASE WHEN coalesce(n, 0) * 0.5 + coalesce(ac, 0) * 5 >= 12 THEN 'Strong' WHEN coalesce(n, 0) * 0.5 + coalesce(ac, 0) * 5 >= 6 THEN 'Moderate' ELSE 'Weak' END AS evidence_strength,
  CASE WHEN coalesce(recent, 0) > coalesce(n - recent, 0) THEN 'Recent' WHEN coalesce(n - recent, 0) > 2 * greatest(coalesce(recent, 0), 1) THEN 'Stale' ELSE 'Mixed' END AS evidence_recency,
  coalesce(recent, 0) AS new_evidence_count, strftime(latest, '%Y-%m-%d') AS latest_evidence_date, coalesce(tp.st, 'UNK') AS primary_state, CASE WHEN {_cls('p')} = {_cls('q')} THEN 'Agree' ELSE 'Disagree' END AS agreement,
  coalesce(nullif(concat_ws(' / ', CASE WHEN dec > 0 THEN 'Recent Delaware credential evidence detected (' || dec || ' record' || CASE WHEN dec > 1 THEN 's' ELSE '' END || ')' END,
    CASE WHEN oa >= 2 THEN 'Multiple non-Delaware address records identified (primary: ' || os.st || ')' END, CASE WHEN len(ts) > 0 AND len(ast) > 0 AND NOT list_has_any(ts, ast) THEN 'Vehicle title evidence conflicts with current address' END,
    CASE WHEN ns >= 4 THEN 'Evidence across sources is inconsistent' END, CASE WHEN coalesce(n, 0) < 4 THEN 'Limited recent evidence is available' END), ''),
    CASE WHEN {_cls('q')} = '{I}' THEN 'Signal spread across weak sources — no strong indicator' ELSE 'Model signals within historical baseline for this candidate profile' END) AS explanations
  FROM cp LEFT JOIN pr USING ({K}) LEFT JOIN tp USING ({K}) LEFT JOIN os USING ({K}))
"""
CW = f"WITH {EVIDENCE_SQL.strip()}, {CASES.strip()}"
FLAT = "t0_confidence t0_priority t1_confidence t1_priority"


def _flat(df):
    return df.withColumn("explanations", F.array_join("explanations", " / "))


@R.add("explanations", f"{CW} SELECT * FROM cs", FLAT)
def explanations(spark, sf_dir):
    return _flat(_cases(spark, sf_dir))


@R.add("priority_bands", f"{CW} SELECT {K}, t1_priority, {BAND.format('t1_priority')} AS band FROM cs", "t1_priority")
def priority_bands(spark, sf_dir):
    return _cases(spark, sf_dir).select(K, "t1_priority", priority_band(F.col("t1_priority")).alias("band"))


CHANGE = f"CASE WHEN t0_class = t1_class THEN 'no_change' WHEN t0_class = '{W}' AND t1_class = '{N}' THEN 'warranted_to_not' WHEN t0_class = '{N}' AND t1_class = '{W}' THEN 'not_to_warranted' WHEN t0_class = '{I}' AND t1_class = '{W}' THEN 'ii_to_warranted' WHEN t0_class = '{I}' AND t1_class = '{N}' THEN 'ii_to_not' ELSE 'to_ii' END"


def _all(section, keys, key, where=""):
    values = ", ".join(f"'{k}'" for k in keys)
    return f"SELECT '{section}' AS section, k AS key, (SELECT count(*) FROM cs WHERE {key} = k{where})::DOUBLE AS value FROM (SELECT unnest([{values}]) AS k)"


TENTH = "CAST(CAST(least(floor({0} * 10), 9) AS BIGINT) AS VARCHAR)"
DASHBOARD = " UNION ALL ".join([
    _all("class", CLASSES, "t1_class"), _all("band", review.BANDS, BAND.format("t1_priority")), _all("priority_bin", range(10), TENTH.format("t1_priority")), _all("confidence_bin", range(10), TENTH.format("t1_confidence")),
    _all("change", review.CHANGES, f"({CHANGE})"), _all("strength", ("Strong", "Moderate", "Weak"), "evidence_strength"), *[f"SELECT 'coverage', '{x}', (SELECT count(*) FROM cs WHERE n_{x} > 0)::DOUBLE" for x in SOURCES],
    "SELECT * FROM (SELECT 'state', primary_state, count(*)::DOUBLE AS n FROM cs GROUP BY 2 ORDER BY n DESC, 2 LIMIT 8)", "SELECT 'overall', 'total', count(*)::DOUBLE FROM cs", "SELECT 'overall', 'avg_confidence', round_even(sum(t1_confidence) / count(*), 3) FROM cs",
])


@R.add("stats_dashboard", f"{CW} {DASHBOARD}", "value")
def stats_dashboard(spark, sf_dir):
    return review.dashboard(_cases(spark, sf_dir))


@R.add("data_status", f"""{CW} SELECT 'rows' AS section, 'unique_candidates' AS key, count(*) AS n FROM cs UNION ALL SELECT 'rows', 't0_records', count(t0_class) FROM cs UNION ALL SELECT 'rows', 't1_records', count(t1_class) FROM cs
 UNION ALL SELECT 'rows', 'total_prediction_rows', count(t0_class) + count(t1_class) FROM cs UNION ALL SELECT 'rows', 'evidence_records', (SELECT count(*) FROM ev SEMI JOIN cs USING ({K}))
 UNION ALL SELECT 'class_t0', replace(t0_class, '{I}', 'insufficient_information'), count(*) FROM cs GROUP BY 2 UNION ALL SELECT 'class_t1', replace(t1_class, '{I}', 'insufficient_information'), count(*) FROM cs GROUP BY 2""")
def data_status(spark, sf_dir):
    return review.data_status(_cases(spark, sf_dir), evidence(spark, sf_dir))[0]


FILTERED = f"{CW}, fl AS (SELECT * FROM cs WHERE CAST({K} AS VARCHAR) LIKE '%1%' AND t1_class = '{W}' AND evidence_strength = 'Strong')"


@R.add("case_list_filters", f"{FILTERED} SELECT {K}, t1_class AS predicted_class, t1_priority AS review_priority, primary_state, (SELECT count(*) FROM fl) AS total FROM fl ORDER BY t1_priority DESC, {K} LIMIT 20 OFFSET 3", "review_priority")
def case_list_filters(spark, sf_dir):
    return review.case_list(_cases(spark, sf_dir), q="1", predicted=W, strong="Strong", skip=3, limit=20).select(K, "predicted_class", "review_priority", "primary_state", "total")


@R.add("case_list_nulls", f"{CW} SELECT {K}, day FROM (SELECT {K}, CASE WHEN {K} % 5 <> 0 THEN latest_evidence_date END AS day FROM cs) ORDER BY day DESC NULLS FIRST, {K} LIMIT 40")
def case_list_nulls(spark, sf_dir):
    c = _cases(spark, sf_dir).withColumn("day", F.when(F.col(K) % 5 != 0, F.col("latest_evidence_date")))
    return review.case_list(c, sort="day", limit=40).select(K, "day")


@R.add("case_list_status", f"""{CW}, rs AS (SELECT user_id AS {K}, arg_max(event_id, epoch_us(ts) * 1000000::HUGEINT + event_id) AS seq FROM events GROUP BY 1), fl AS (SELECT cs.*, CASE WHEN seq % 4 = 0 THEN 'unreviewed' ELSE ['unreviewed', 'in_progress', 'confirmed'][1 + seq % 3] END AS status FROM cs JOIN rs USING ({K}))
 SELECT {K}, status AS reviewer_status, (SELECT count(*) FROM fl WHERE status = 'confirmed' AND t1_priority < 0.4 AND seq % 5 = 0) AS total, CAST(greatest(1, ceil((SELECT count(*) FROM fl WHERE status = 'confirmed' AND t1_priority < 0.4 AND seq % 5 = 0) / 7.0)) AS BIGINT) AS pages
 FROM fl WHERE status = 'confirmed' AND t1_priority < 0.4 AND seq % 5 = 0""".replace("CASE WHEN seq % 4 = 0 THEN 'unreviewed' ELSE ['unreviewed', 'in_progress', 'confirmed'][1 + seq % 3] END AS status", "seq, ['unreviewed', 'in_progress', 'confirmed'][1 + seq % 3] AS status"))
def case_list_status(spark, sf_dir):
    c = review.with_state(_cases(spark, sf_dir), review.latest_state(_log(spark, sf_dir)))
    return review.case_list(c, status="confirmed", band="low", tag="duplicate").select(K, "reviewer_status", "total", review.page_count(F.col("total"), 7).alias("pages"))


@R.add("both_phases", f"""{CW}, a AS (SELECT {K}, 'T0' AS phase, t0_priority AS review_priority FROM cs ORDER BY t0_priority DESC, {K} LIMIT 10), b AS (SELECT {K}, 'T1' AS phase, t1_priority AS review_priority FROM cs ORDER BY t1_priority DESC, {K} LIMIT 10)
 SELECT *, (SELECT 2 * count(*) FROM cs) AS total FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""", "review_priority")
def both_phases(spark, sf_dir):
    return review.both_phases(_cases(spark, sf_dir), limit=10).select(K, "phase", "review_priority", "total")


@R.add("category_summary", f"{CW} SELECT count(*) AS total, avg(t1_priority) AS avg_priority, avg(t1_confidence) AS avg_confidence, (SELECT string_agg({K}, ',' ORDER BY t1_priority DESC, {K}) FROM (SELECT * FROM cs WHERE t1_class = '{N}' ORDER BY t1_priority DESC, {K} LIMIT 5)) AS top FROM cs WHERE t1_class = '{N}'", "avg_priority avg_confidence")
def category_summary(spark, sf_dir):
    return review.category_summary(_cases(spark, sf_dir), N).withColumn("top", F.array_join(F.col("top").cast("array<string>"), ","))


@R.add("field_changes", f"""{CW} SELECT {K}, CASE WHEN t0_class = t1_class THEN 'unchanged' ELSE 'change' END AS class_change, CASE WHEN t0_priority = t1_priority THEN 'unchanged' WHEN t1_priority > t0_priority THEN 'escalate' ELSE 'resolve' END AS priority_change,
 CASE WHEN t0_confidence = t1_confidence THEN 'unchanged' WHEN t1_confidence > t0_confidence THEN 'up' ELSE 'down' END AS confidence_change,
 CASE WHEN (t0_class = '{W}') = (t1_class = '{W}') THEN 'unchanged' WHEN t0_class = '{W}' THEN 'escalate' ELSE 'resolve' END AS flag_change, n_address + n_license + n_title + n_external + n_work AS all_records FROM cs""")
def field_changes(spark, sf_dir):
    c = lambda x: F.col(x)
    counts = F.create_map(*[x for s in SOURCES for x in (F.lit(s), c(f"n_{s}"))])
    return _cases(spark, sf_dir).select(
        K, review.field_change("str", "categorical", c("t0_class"), c("t1_class")).alias("class_change"), review.field_change("float", "escalate_up", c("t0_priority"), c("t1_priority")).alias("priority_change"),
        review.field_change("float", "neutral", c("t0_confidence"), c("t1_confidence")).alias("confidence_change"), review.field_change("bool", "escalate_when_false", c("t0_class") == W, c("t1_class") == W).alias("flag_change"),
        F.aggregate(F.map_values(counts), F.lit(0).cast("long"), lambda a, x: a + x).alias("all_records"),
    )


@R.add("case_detail_nested", f"""WITH {EVIDENCE_SQL.strip()}, r AS (SELECT *, row_number() OVER (PARTITION BY {K}, src ORDER BY event_dt, source_record_id) AS k FROM ev WHERE event_dt IS NOT NULL)
 SELECT {K}, src, string_agg(strftime(event_dt, '%Y-%m-%d') || ':' || state, ' ' ORDER BY event_dt, source_record_id) AS records FROM r WHERE k <= 20 GROUP BY 1, 2""")
def case_detail_nested(spark, sf_dir):
    t = review.timeline(evidence(spark, sf_dir))
    return t.select(K, "src", F.array_join(F.transform("records", lambda x: F.concat(F.date_format(x["event_dt"], "yyyy-MM-dd"), F.lit(":"), x["state"])), " ").alias("records"))


HAY = f"lower(concat_ws(' ', {K}, source_record_id, vehicle_ref, CASE WHEN state = '' THEN 'UNK' ELSE state END, event_type))"
FOUND = f"SELECT {K}, source_record_id, src, CASE WHEN state = '' THEN 'UNK' ELSE state END AS state, event_type FROM ev WHERE {{0}} ORDER BY event_dt DESC NULLS LAST, source_record_id LIMIT 50"
NJ = f"({HAY} LIKE '%new jersey%' OR {HAY} LIKE '%nj%') AND src = 'title' AND state = 'NJ'"


@R.add("evidence_search", f"WITH {EVIDENCE_SQL.strip()} {FOUND.format(NJ)}")
def evidence_search(spark, sf_dir):
    return review.evidence_search(evidence(spark, sf_dir), "New Jersey", "title", "NJ").select(K, "source_record_id", "src", "state", "event_type")


@R.add("search_totals", f"WITH {EVIDENCE_SQL.strip()}, fo AS ({FOUND.format(f'{HAY} LIKE ' + chr(39) + '%v1%' + chr(39))}) SELECT count(*) AS total_matches, count(DISTINCT {K}) AS candidates_matched FROM fo")
def search_totals(spark, sf_dir):
    return review.search_totals(review.evidence_search(evidence(spark, sf_dir), "V1"))


@R.add("search_groups", f"WITH {EVIDENCE_SQL.strip()}, fo AS ({FOUND.format(f'{HAY} LIKE ' + chr(39) + '%1%' + chr(39))}) SELECT {K}, CASE src WHEN 'license' THEN 'credential' WHEN 'title' THEN 'vehicle_title' ELSE src END AS kind, string_agg(source_record_id, ',' ORDER BY source_record_id) AS records FROM fo GROUP BY 1, 2")
def search_groups(spark, sf_dir):
    g = review.search_groups(review.evidence_search(evidence(spark, sf_dir), "1"))
    return g.withColumn("records", F.array_join(F.col("records").cast("array<string>"), ","))


@R.add("snippets", f"WITH {EVIDENCE_SQL.strip()} SELECT source_record_id, concat_ws(' · ', CASE WHEN state = 'DE' THEN 'Delaware' ELSE nullif(state, '') END, nullif(replace(event_type, '_', ' '), ''), source_record_id) AS snippet, regexp_replace(event_type, '(rec)', '[\\1]', 'gi') AS marked FROM ev")
def snippets(spark, sf_dir):
    e = evidence(spark, sf_dir)
    return e.select("source_record_id", review.snippet(F.col("state"), F.col("event_type"), F.col("source_record_id")).alias("snippet"), review.highlighted(F.col("event_type"), "REC").alias("marked"))


@R.add("strong_matches", f"WITH {EVIDENCE_SQL.strip()} SELECT {K}, count(*) AS records, count(*) FILTER (link_confidence >= 0.95) AS strong FROM ev GROUP BY 1")
def strong_matches(spark, sf_dir):
    return review.strong_matches(evidence(spark, sf_dir))


@R.add("canonical_sources", """SELECT event_id, CASE WHEN event_id % 2 = 1 THEN CASE WHEN lower(trim(d)) IN ('address', 'license', 'title', 'external', 'work') THEN lower(trim(d)) ELSE 'external' END
 ELSE CASE s WHEN 'address_history' THEN 'address' WHEN 'license_id_events' THEN 'license' WHEN 'vehicle_title_events' THEN 'title' WHEN 'external_context_signals' THEN 'external' WHEN 'work_location_signals' THEN 'work' ELSE s END END AS source, CASE WHEN lower(trim(d)) = 'nan' THEN '' ELSE trim(d) END AS cleaned
 FROM (SELECT event_id, ['address_history', 'license_id_events', 'vehicle_title_events', 'external_context_signals', 'work_location_signals', 'other_table'][1 + event_id % 6] AS s, [' Title ', 'WORK', 'nan', 'license', 'toll'][1 + event_id % 5] AS d FROM events)""")
def canonical_sources(spark, sf_dir):
    i = F.col("event_id")
    pick = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (i % len(xs)).cast("int"))
    s, d = pick([*(f"{x}" for x in ("address_history", "license_id_events", "vehicle_title_events", "external_context_signals", "work_location_signals", "other_table"))]), pick([" Title ", "WORK", "nan", "license", "toll"])
    return table(spark, sf_dir, "events").select("event_id", canonical_source(F.when(i % 2 == 1, "T1").otherwise("T0"), s, d).alias("source"), clean_text(d).alias("cleaned"))


@R.add("relative_ages", f"WITH {EVIDENCE_SQL.strip()}, d AS (SELECT source_record_id, DATE '2024-06-01' - event_dt - CAST(source_record_id % 400 - 300 AS INTEGER) AS n FROM ev WHERE event_dt IS NOT NULL) SELECT source_record_id, CASE WHEN n < 0 THEN 'in the future' WHEN n = 0 THEN 'today' WHEN n < 30 THEN n || 'd ago' WHEN n < 365 THEN (n // 30) || 'mo ago' ELSE (n // 365) || 'y ago' END AS age FROM d")
def relative_ages(spark, sf_dir):
    e = evidence(spark, sf_dir).where("event_dt is not null")
    days = F.date_diff(F.lit("2024-06-01").cast("date"), "event_dt") - (F.col("source_record_id") % 400 - 300)
    return e.select("source_record_id", relative_age(days).alias("age"))


def _log(spark, sf_dir):
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    tags = F.array_compact(F.array(F.when(i % 3 == 0, "urgent"), F.when(i % 4 == 0, "recheck"), F.when(i % 5 == 0, "duplicate")))
    return e.select(F.col("user_id").alias("candidate_id"), i.alias("seq"), F.col("ts").alias("last_updated"), F.get(F.array(*[F.lit(x) for x in ("unreviewed", "in_progress", "confirmed")]), (i % 3).cast("int")).alias("reviewer_status"), tags.alias("reviewer_tags"))


LOG = "lg AS (SELECT user_id AS candidate_id, event_id AS seq, ts, ['unreviewed', 'in_progress', 'confirmed'][1 + event_id % 3] AS reviewer_status FROM events), la AS (SELECT candidate_id, arg_max(seq, epoch_us(ts) * 1000000::HUGEINT + seq) AS seq FROM lg GROUP BY 1), st AS (SELECT lg.* FROM lg JOIN la USING (candidate_id, seq))"


@R.add("reviewer_state_upsert", f"WITH {LOG} SELECT candidate_id, seq, reviewer_status FROM st")
def reviewer_state_upsert(spark, sf_dir):
    return review.latest_state(_log(spark, sf_dir)).select("candidate_id", "seq", "reviewer_status")


@R.add("tag_counts", f"WITH {LOG}, t AS (SELECT 'urgent' AS tag FROM st WHERE seq % 3 = 0 UNION ALL SELECT 'recheck' FROM st WHERE seq % 4 = 0 UNION ALL SELECT 'duplicate' FROM st WHERE seq % 5 = 0) SELECT tag, count(*) AS n FROM t GROUP BY 1")
def tag_counts(spark, sf_dir):
    return review.tag_counts(review.latest_state(_log(spark, sf_dir)))


@R.add("audit_log_newest", "SELECT user_id AS candidate_id, event_id AS seq FROM events ORDER BY ts DESC, event_id LIMIT 100")
def audit_log_newest(spark, sf_dir):
    path = own_folder(spark, "audit-log")
    e = updates.read_events(spark, sf_dir).select(F.col("user_id").alias("candidate_id"), F.col("event_id").alias("seq"), "ts")
    updates.append_log(e, path, "audit")
    return spark.read.parquet(path).orderBy(F.desc("ts"), "seq").limit(100).select("candidate_id", "seq")


@R.add("tag_changes", f"""WITH {LOG}, t AS (SELECT candidate_id, list_concat(CASE WHEN seq % 3 = 0 THEN ['urgent'] ELSE [] END, CASE WHEN seq % 4 = 0 THEN ['recheck'] ELSE [] END, CASE WHEN seq % 5 = 0 THEN ['duplicate'] ELSE [] END) AS tags FROM st)
 SELECT candidate_id, array_to_string(list_filter(CASE WHEN list_contains(tags, 'recheck') THEN tags ELSE list_append(tags, 'recheck') END, lambda x: x <> 'urgent'), ',') AS tags FROM t""")
def tag_changes(spark, sf_dir):
    s = review.remove_tag(review.add_tag(review.latest_state(_log(spark, sf_dir)), " recheck "), "urgent")
    return s.select("candidate_id", F.array_join("reviewer_tags", ",").alias("tags"))


@R.add("bulk_tag", f"""{CW}, {LOG}, ids AS (SELECT DISTINCT {K} FROM cs WHERE {K} % 3 = 0) SELECT 'state' AS part, CAST({K} AS VARCHAR) AS id, coalesce(reviewer_status, 'unreviewed') AS status, '' AS notes FROM ids LEFT JOIN st ON candidate_id = {K}
 UNION ALL SELECT 'audit', 'BULK', 'tagged_' || (SELECT count(*) FROM ids), 'Bulk added tag ''batch'' to ' || (SELECT count(*) FROM ids) || ' candidates'""")
def bulk_tag(spark, sf_dir):
    c, log = _cases(spark, sf_dir), review.latest_state(_log(spark, sf_dir))
    ids = c.where(F.col(K) % 3 == 0).select(K).union(spark.range(1).select(F.lit(-5).cast(c.schema[K].dataType).alias(K)))
    new, entry = review.bulk_tag(c, log, ids, " batch ")
    states = new.where(F.array_contains("reviewer_tags", "batch")).select(F.lit("state").alias("part"), F.col("candidate_id").cast("string").alias("id"), F.col("reviewer_status").alias("status"), F.lit("").alias("notes"))
    return states.unionByName(entry.select(F.lit("audit").alias("part"), F.col("candidate_id").alias("id"), F.col("to_status").alias("status"), "notes"))


@R.add("decisions", f"""{CW}, {LOG} SELECT CAST(cs.{K} AS VARCHAR) AS candidate_id, 'confirmed' AS to_status, coalesce(reviewer_status, 'unreviewed') AS from_status, 'checked' AS notes, t1_class AS predicted_class, evidence_strength, n_title AS titles FROM cs LEFT JOIN st ON candidate_id = cs.{K} WHERE cs.{K} % 4 = 1""")
def decisions(spark, sf_dir):
    c, log = _cases(spark, sf_dir), review.latest_state(_log(spark, sf_dir))
    d = c.where(F.col(K) % 4 == 1).select(K, F.lit("confirmed").alias("reviewer_status"), F.lit("checked").alias("reviewer_notes"))
    _, entries = review.decided(c, log, d)
    snap = F.from_json("snapshot", "predicted_class string, evidence_strength string, evidence_summary struct<vehicle_title:long>")
    return entries.select("candidate_id", "to_status", "from_status", "notes", snap.alias("s")).select("candidate_id", "to_status", "from_status", "notes", "s.predicted_class", "s.evidence_strength", F.col("s.evidence_summary.vehicle_title").alias("titles"))


@R.add("compare_cases", f"{CW} SELECT a.{K} AS {K}_a, a.t1_priority AS t1_priority_a, a.total_records AS total_records_a, b.{K} AS {K}_b, b.t1_priority AS t1_priority_b, b.total_records AS total_records_b, abs(a.t1_priority - b.t1_priority) > 0.15 AS priority_differs, abs(a.total_records - b.total_records) >= 3 AS records_differ FROM cs a, cs b WHERE a.{K} = 3 AND b.{K} = 8", "t1_priority_a t1_priority_b")
def compare_cases(spark, sf_dir):
    return review.compare_pair(_cases(spark, sf_dir), 3, 8)


@R.add("export_stack", f"{CW} SELECT {K}, 'T0' AS phase, t0_class AS predicted_class, t0_priority AS review_priority FROM cs UNION ALL SELECT {K}, 'T1', t1_class, t1_priority FROM cs", "review_priority")
def export_stack(spark, sf_dir):
    return review.stacked(_cases(spark, sf_dir))


FE = ["linked_record_count", "oos_count_total", "de_count_90d", "oos_decay_share_365d"]


LONG = f"u AS (" + " UNION ALL ".join(f"SELECT {K}, t1_class, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM f_t0 JOIN cs USING ({K})" for c in FE) + ")"
TOP = """g AS (SELECT feature, avg(value) AS m, coalesce(nullif(stddev_samp(value), 0), 1) AS s FROM u GROUP BY 1), ef AS (SELECT t1_class, feature, avg(value) AS cm, any_value(m) AS m, any_value(s) AS s, abs((avg(value) - any_value(m)) / any_value(s)) AS e FROM u JOIN g USING (feature) GROUP BY 1, 2),
 tf AS (SELECT t1_class, feature, rank, round_even(e, 3) AS effect_size, round_even(cm, 3) AS class_mean, round_even(m, 3) AS overall_mean, round_even(s, 3) AS overall_std, CASE WHEN cm > m THEN 'higher' ELSE 'lower' END AS direction FROM (SELECT *, row_number() OVER (PARTITION BY t1_class ORDER BY e DESC, feature) AS rank FROM ef) WHERE rank <= 3)"""


@R.add("effect_sizes", f"{CW}, {features('T0').strip()}, {LONG}, {TOP} SELECT *, upper(left(replace(replace(feature, '_', ' '), 'de', 'DE'), 1)) || lower(substr(replace(replace(feature, '_', ' '), 'de', 'DE'), 2)) AS label FROM tf", "effect_size class_mean overall_mean overall_std")
def effect_sizes(spark, sf_dir):
    return _top(spark, sf_dir)[1]


def _top(spark, sf_dir):
    rows = _t0(spark, sf_dir).join(_cases(spark, sf_dir).select(K, "t1_class"), K)
    return rows, review.top_features(rows, "t1_class", FE, 3)


@R.add("case_explanations", f"""{CW}, {features('T0').strip()}, {LONG}, {TOP} SELECT {K}, t1_class, feature, rank, round_even(coalesce(value, 0), 3) AS case_value, round_even((coalesce(value, 0) - overall_mean) / coalesce(nullif(overall_std, 0), 1), 2) AS case_z_score,
 (coalesce(value, 0) > overall_mean AND direction = 'higher') OR (coalesce(value, 0) < overall_mean AND direction = 'lower') AS pushes_toward_class FROM u JOIN tf USING (t1_class, feature)""", "case_value case_z_score")
def case_explanations(spark, sf_dir):
    rows, top = _top(spark, sf_dir)
    return review.explained(rows, top, "t1_class", FE)


def _t0(spark, sf_dir):
    e = evidence(spark, sf_dir)
    return ev.phase_features(candidates(spark, sf_dir), e, "T0", e.where("phase = 'T1'"))


@R.add("compact_projection", f"{with_(features('T0'))} SELECT {K}, {', '.join(ev.T0_PREDICTORS)} FROM f_t0", " ".join(c for c in ev.T0_PREDICTORS if any(x in c for x in ("ratio", "share", "confidence_mean"))))
def compact_projection(spark, sf_dir):
    return ev.compact(_t0(spark, sf_dir), ev.T0_PREDICTORS)


@R.add("constant_columns", f"{with_(features('T0'))} " + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT floor(CAST({c} AS DOUBLE) * 1e9 + 0.5)) AS \"distinct\", count(*) FILTER ({c} IS NULL) AS missing, count(DISTINCT {c}) <= 1 AS constant, bool_and({c} IS NULL) AS all_missing FROM f_t0" for c in ev.T0_PREDICTORS))
def constant_columns(spark, sf_dir):
    return review.constant_columns(settled(_t0(spark, sf_dir)), ev.T0_PREDICTORS)


@R.add("evidence_groups", f"""{with_(features('T0'), features('T1'), UPDATES, DELTA)}, e AS (SELECT {K}, CASE WHEN new_t1_oos_count + new_t1_de_count > 0 OR new_t1_source_domain_diversity >= 2 OR newly_effective_t0_record_count > 0 OR delta_current_past_60_day_grace_proxy <> 0 OR delta_current_within_60_day_grace_proxy <> 0
 OR delta_post_60d_oos_vehicle_signal_count <> 0 OR delta_post_60d_active_oos_credential_signal_count <> 0 OR delta_post_60d_prior_state_persistence_any_present <> 0 OR delta_new_meaningful_oos_title_signal_post_60d_present <> 0 THEN 'meaningful_new_evidence'
 WHEN new_t1_record_count > 0 THEN 'weak_minor_update' ELSE 'effectively_no_meaningful_update' END AS evidence_group FROM dl) SELECT *, CASE evidence_group WHEN 'meaningful_new_evidence' THEN 1.0 WHEN 'weak_minor_update' THEN 0.5 ELSE 0.0 END::DOUBLE AS weight FROM e""")
def evidence_groups(spark, sf_dir):
    e = evidence(spark, sf_dir)
    d = ev.delta_features(candidates(spark, sf_dir), e, e.where("phase = 'T1'"))
    names = ["current_past_60_day_grace_proxy", "current_within_60_day_grace_proxy", "post_60d_oos_vehicle_signal_count", "post_60d_active_oos_credential_signal_count", "post_60d_prior_state_persistence_any_present", "new_meaningful_oos_title_signal_post_60d_present"]
    moved = F.exists(F.array(*[F.col(f"delta_{c}") for c in names]), lambda x: x != 0)
    g = evidence_group(F.col("new_t1_record_count"), F.col("new_t1_oos_count") + F.col("new_t1_de_count"), F.col("new_t1_source_domain_diversity"), F.col("newly_effective_t0_record_count"), moved)
    return d.select(K, g.alias("evidence_group")).withColumn("weight", anchor_weight(F.col("evidence_group")))


PW = f"WITH {PREDICTIONS_SQL.strip()}"


@R.add("override_merge", f"{PW} SELECT a.id, coalesce(b.q0, a.p0) AS p0, coalesce(b.q1, a.p1) AS p1, CASE WHEN b.id IS NULL THEN 'full_fit' ELSE 'outer_oof' END AS origin FROM pr a LEFT JOIN pr b ON a.id = b.id AND b.id % 3 = 0", "p0 p1")
def override_merge(spark, sf_dir):
    p = predictions(spark, sf_dir)
    return review.override_merge(p.select("id", "p0", "p1"), p.where("id % 3 = 0").select("id", F.col("q0").alias("p0"), F.col("q1").alias("p1")), "id", ["p0", "p1"])


def _submission(spark, sf_dir):
    """Predictions of both phases with faults: a missing row, sums, classes, blanks, priorities out of bounds."""
    p = predictions(spark, sf_dir)
    one = lambda ph, c: models.predictions_table(p.withColumnRenamed("id", K), K, ph, tuple(f"{c}{k}" for k in range(3)))
    k, first = F.col(K), sb.PROBABILITIES[0]
    out = one("T0", "p").unionByName(one("T1", "q")).where(f"not (phase = 'T1' and {K} % 50 = 7)").withColumn(first, F.when(k % 40 == 3, F.col(first) + 0.5).otherwise(F.col(first)))
    out = out.withColumn("predicted_class", F.when(k % 60 == 1, "other").when(k % 60 == 2, "").otherwise(F.col("predicted_class")))
    return out.withColumn("review_priority", F.when(k % 45 == 4, F.lit(1.5)).when(k % 45 != 5, F.col("review_priority")))


SUB = f"""sb AS (SELECT * REPLACE (a + CASE WHEN {K} % 40 = 3 THEN 0.5 ELSE 0 END AS a) FROM (SELECT id AS {K}, 'T0' AS phase, p0 AS a, p1 AS b, p2 AS c, {_cls('p')} AS cl, p0 AS pri FROM pr UNION ALL SELECT id, 'T1', q0, q1, q2, {_cls('q')}, q0 FROM pr) WHERE NOT (phase = 'T1' AND {K} % 50 = 7)),
 sc AS (SELECT * REPLACE (CASE WHEN {K} % 60 = 1 THEN 'other' WHEN {K} % 60 = 2 THEN '' ELSE cl END AS cl, CASE WHEN {K} % 45 = 4 THEN 1.5 WHEN {K} % 45 <> 5 THEN pri END AS pri) FROM sb), ky AS (SELECT id AS {K}, unnest(['T0', 'T1']) AS phase FROM pr)"""


@R.add("two_phase_union", f"{PW}, {SUB} SELECT {K}, phase, a AS p_review_warranted FROM sb", "p_review_warranted")
def two_phase_union(spark, sf_dir):
    return _submission(spark, sf_dir).select(K, "phase", "p_review_warranted")


def _keys(spark, sf_dir):
    return predictions(spark, sf_dir).select(F.col("id").alias(K), F.explode(F.array(F.lit("T0"), F.lit("T1"))).alias("phase"))


@R.add("set_difference_keys", f"{PW}, {SUB} SELECT {K}, phase FROM ky EXCEPT SELECT {K}, phase FROM sb")
def set_difference_keys(spark, sf_dir):
    return _keys(spark, sf_dir).subtract(_submission(spark, sf_dir).select(K, "phase"))


@R.add("submission_join", f"{PW}, {SUB} SELECT {K}, phase, cl AS predicted_class, a AS p_review_warranted, b AS p_review_not_warranted, c AS p_insufficient_evidence, pri AS review_priority FROM ky LEFT JOIN sc USING ({K}, phase)", " ".join(["review_priority", *sb.PROBABILITIES]))
def submission_join(spark, sf_dir):
    """The template and the submission go through their CSV files."""
    folder = own_folder(spark, "submission")
    files.write_csv(_keys(spark, sf_dir), f"{folder}/template")
    template = sb.read_template(spark, f"{folder}/template").withColumn(K, F.col(K).cast("long"))
    return sb.submission(template, _submission(spark, sf_dir))


N_RULE = {
    "missing_value": "count(*) FILTER (cl = '' OR pri IS NULL) FROM sc", "not_numeric": "count(*) FILTER (pri IS NULL) FROM sc", "probability_range": "count(*) FILTER (NOT (a BETWEEN 0 AND 1 AND b BETWEEN 0 AND 1 AND c BETWEEN 0 AND 1)) FROM sc",
    "priority_range": "count(*) FILTER (pri NOT BETWEEN 0 AND 1) FROM sc", "probability_sum": "count(*) FILTER (abs(a + b + c - 1) > 1e-8 + 1e-5) FROM sc", "unknown_class": f"count(*) FILTER (cl NOT IN ('{W}', '{N}', '{I}')) FROM sc", "unknown_phase": "0",
    "duplicate_key": f"count(*) FROM (SELECT 1 FROM sc GROUP BY {K}, phase HAVING count(*) > 1)", "missing_key": f"count(*) FROM (SELECT {K}, phase FROM ky EXCEPT SELECT {K}, phase FROM sc)", "extra_key": f"count(*) FROM (SELECT {K}, phase FROM sc EXCEPT SELECT {K}, phase FROM ky)",
    "phases": f"count(*) FROM (SELECT {K} FROM sc GROUP BY 1 HAVING count(DISTINCT phase) < 2)", "row_count": "abs((SELECT count(*) FROM sc) - (SELECT count(*) FROM ky))", "candidate_count": f"abs((SELECT count(DISTINCT {K}) FROM sc) - (SELECT count(DISTINCT {K}) FROM ky))", "extra_column": "0",
}


@R.add("validator", f"{PW}, {SUB} " + " UNION ALL ".join(f"SELECT '{k}' AS rule, CAST((SELECT {v}) AS BIGINT) AS violations" for k, v in N_RULE.items()))
def validator(spark, sf_dir):
    return sb.validate_submission(_submission(spark, sf_dir), _keys(spark, sf_dir))


def _groups(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumnRenamed("id", K)
    return p, p.select(K, F.get(F.array(*[F.lit(g) for g in ("meaningful_new_evidence", "weak_minor_update", "effectively_no_meaningful_update")]), (F.col(K) % 3).cast("int")).alias("evidence_group"))


BH = f"""gp AS (SELECT id AS {K}, y, ['meaningful_new_evidence', 'weak_minor_update', 'effectively_no_meaningful_update'][1 + id % 3] AS evidence_group, [1.0::DOUBLE, 0.5, 0.0][1 + id % 3] AS w, p0, p1, p2, q0, q1, q2 FROM pr),
 gb AS (SELECT *, w * q0 + (1 - w) * p0 AS x0, w * q1 + (1 - w) * p1 AS x1, w * q2 + (1 - w) * p2 AS x2 FROM gp), gd AS (SELECT *, x0 / (x0 + x1 + x2) AS b0, x1 / (x0 + x1 + x2) AS b1, x2 / (x0 + x1 + x2) AS b2 FROM gb),
 bh AS (SELECT {K}, y, evidence_group, CAST({_cls('p')} <> {_cls('q')} AS BIGINT) AS unanchored_class_changed, CAST({_cls('p')} <> {_cls('b')} AS BIGINT) AS experimental_anchored_class_changed, 0.5 * (abs(q0 - p0) + abs(q1 - p1) + abs(q2 - p2)) AS total_variation_probability_change,
 (abs(q0 - p0) + abs(q1 - p1) + abs(q2 - p2)) / 3 AS mean_absolute_probability_change, q0 - p0 AS p_review_warranted_change, w AS experimental_anchor_t1_weight FROM gd)"""


def _behaviour(spark, sf_dir):
    p, g = _groups(spark, sf_dir)
    return behaviour.update_behaviour(p.select(K, "p0", "p1", "p2"), p.select(K, "q0", "q1", "q2"), g)


@R.add("update_behaviour", f"{PW}, {BH} SELECT * EXCLUDE (y) FROM bh", "total_variation_probability_change mean_absolute_probability_change p_review_warranted_change experimental_anchor_t1_weight")
def update_behaviour(spark, sf_dir):
    return _behaviour(spark, sf_dir)


BS = "unanchored_class_change_rate experimental_anchored_class_change_rate mean_total_variation_change median_total_variation_change max_total_variation_change mean_absolute_probability_change mean_p_review_warranted_change"


@R.add("behaviour_summary", f"""{PW}, {BH} SELECT evidence_group, count(*) AS candidates, CAST(sum(unanchored_class_changed) AS BIGINT) AS unanchored_class_changes, avg(unanchored_class_changed) AS unanchored_class_change_rate, CAST(sum(experimental_anchored_class_changed) AS BIGINT) AS experimental_anchored_class_changes,
 avg(experimental_anchored_class_changed) AS experimental_anchored_class_change_rate, avg(total_variation_probability_change) AS mean_total_variation_change, median(total_variation_probability_change) AS median_total_variation_change, max(total_variation_probability_change) AS max_total_variation_change,
 avg(mean_absolute_probability_change) AS mean_absolute_probability_change, avg(p_review_warranted_change) AS mean_p_review_warranted_change FROM bh GROUP BY 1""", BS)
def behaviour_summary(spark, sf_dir):
    return behaviour.behaviour_summary(_behaviour(spark, sf_dir))


@R.add("labelled_behaviour", f"""{PW}, {BH} SELECT evidence_group, count(*) AS labeled_candidates, CAST(sum(a) AS BIGINT) AS actual_class_changes, avg(a) AS actual_class_change_rate, CAST(sum(unanchored_class_changed) AS BIGINT) AS unanchored_class_changes, avg(unanchored_class_changed) AS unanchored_class_change_rate,
 CAST(sum(experimental_anchored_class_changed) AS BIGINT) AS experimental_anchored_class_changes, avg(experimental_anchored_class_changed) AS experimental_anchored_class_change_rate FROM (SELECT *, CAST({K} % 4 = 0 AS BIGINT) AS a FROM bh WHERE {K} % 2 = 0) GROUP BY 1""", "actual_class_change_rate unanchored_class_change_rate experimental_anchored_class_change_rate")
def labelled_behaviour(spark, sf_dir):
    p, _ = _groups(spark, sf_dir)
    labels = p.where(F.col(K) % 2 == 0).select(K, F.col("y").alias("y0"), F.when(F.col(K) % 4 == 0, (F.col("y") + 1) % 3).otherwise(F.col("y")).alias("y1"))
    return behaviour.labelled_summary(_behaviour(spark, sf_dir), labels)


VC = ["log_loss", "macro_f1", "brier_multiclass", "ece_10bin"]


@R.add("version_comparison", f"""{PW}, vp AS (SELECT CASE WHEN id % 2 = 0 THEN 'T0' ELSE 'T1' END AS phase, * FROM pr), va AS (SELECT phase, y, p0 AS a, p1 AS b, p2 AS c FROM vp), vb AS (SELECT phase, y, q0 AS a, q1 AS b, q2 AS c FROM vp),
 {_bundle_ctes('va', 'ma', 'phase, ').strip()}, {_bundle_ctes('vb', 'mb', 'phase, ').strip()}, lo AS ({' UNION ALL '.join(f"SELECT phase, '{m}' AS metric, ma.{m} AS baseline, mb.{m} AS updated FROM ma JOIN mb USING (phase)" for m in VC)})
 SELECT *, updated - baseline AS delta, CASE WHEN CASE WHEN metric = 'macro_f1' THEN updated > baseline ELSE updated < baseline END THEN 'improved' WHEN updated = baseline THEN 'unchanged' ELSE 'worsened' END AS point_direction FROM lo""", "baseline updated delta")
def version_comparison(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("fold", F.col("id") % 5)
    one = lambda c: p.select("id", "fold", F.col("y").alias("label"), *[F.col(f"{c}{k}").alias(f"p{k}") for k in range(3)])
    both = behaviour.aligned(one("p"), one("q"), "id").withColumnRenamed("label", "y").withColumn("phase", F.when(F.col("id") % 2 == 0, "T0").otherwise("T1"))
    return behaviour.version_comparison(both, "id", VC)


PERF = f"{PW}, va AS (SELECT y, p0 AS a, p1 AS b, p2 AS c FROM pr), vb AS (SELECT y, q0 AS a, q1 AS b, q2 AS c FROM pr), {_bundle_ctes('va', 'ma').strip()}, {_bundle_ctes('vb', 'mb').strip()}"
PHASES = {"T0": ("p0", "p1", "p2"), "T1": ("q0", "q1", "q2")}


@R.add("model_performance", f"{PERF} SELECT {', '.join(f'round_even((ma.{c} + mb.{c}) / 2, 4) AS {c}' for c in ('log_loss', 'brier_multiclass', 'macro_f1', 'ece_10bin', 'accuracy'))} FROM ma, mb", "log_loss brier_multiclass macro_f1 ece_10bin accuracy")
def model_performance(spark, sf_dir):
    return behaviour.model_performance(predictions(spark, sf_dir), PHASES)[0]


@R.add("performance_matrix", f"{PW} SELECT t.range AS truth, g.range AS guess, (SELECT count(*) FROM pr WHERE y = t.range AND {_cls('p')} = ['{W}', '{N}', '{I}'][1 + g.range]) + (SELECT count(*) FROM pr WHERE y = t.range AND {_cls('q')} = ['{W}', '{N}', '{I}'][1 + g.range]) AS n FROM range(3) t, range(3) g")
def performance_matrix(spark, sf_dir):
    return behaviour.model_performance(predictions(spark, sf_dir), PHASES)[1]


@R.add("leaderboard", f"{PERF}, md AS (SELECT 'boosted' AS name, * FROM ma UNION ALL SELECT 'logistic', * FROM mb) SELECT name, round_even(macro_f1, 4) AS macro_f1, CASE WHEN log_loss < 2 THEN round_even(1 - log_loss / 2, 4) ELSE 0 END AS accuracy, round_even(log_loss, 4) AS log_loss, round_even(brier_multiclass, 4) AS brier, round_even(ece_10bin, 4) AS ece, name = 'logistic' AS current FROM md", "macro_f1 accuracy log_loss brier ece")
def leaderboard(spark, sf_dir):
    from attestra.operators.metrics import metric_bundle

    p = predictions(spark, sf_dir)
    rows = metric_bundle(p).withColumn("name", F.lit("boosted")).unionByName(metric_bundle(p, PHASES["T1"]).withColumn("name", F.lit("logistic")))
    return behaviour.leaderboard(rows, "logistic")


@R.add("dashboard_calibration", f"{PW} SELECT round_even((k + 0.5) / 10, 2) AS bin, round_even(avg(c), 3) AS expected, round_even(avg(r), 3) AS observed, count(*) AS n FROM (SELECT least(floor(greatest(p0, p1, p2) * 10), 9) AS k, greatest(p0, p1, p2) AS c, CAST({_cls('p')} = ['{W}', '{N}', '{I}'][1 + y] AS DOUBLE) AS r FROM pr) GROUP BY k", "bin expected observed")
def dashboard_calibration(spark, sf_dir):
    return behaviour.dashboard_calibration(predictions(spark, sf_dir), PHASES["T0"])


@R.add("entropies", f"{PW} SELECT id, -(p0 * ln(p0) + p1 * ln(p1) + p2 * ln(p2)) / ln(3) AS entropy FROM pr", "entropy")
def entropies(spark, sf_dir):
    return predictions(spark, sf_dir).select("id", entropy([F.col(c) for c in PHASES["T0"]]).alias("entropy"))


@R.add("update_matrix", f"{PW} SELECT id AS {K}, p0 AS p_review_warranted_t0, p1 AS p_review_not_warranted_t0, p2 AS p_insufficient_evidence_t0, p0 AS priority_t0, id % 7 AS delta FROM pr WHERE id % 5 <> 0", "p_review_warranted_t0 p_review_not_warranted_t0 p_insufficient_evidence_t0 priority_t0")
def update_matrix(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumnRenamed("id", K)
    m = models.update_matrix(models.predictions_table(p, K, "T0"), p.where(F.col(K) % 5 != 0).select(K, (F.col(K) % 7).alias("delta")))
    return m.select(K, *models.predictors(m), "priority_t0")


@R.add("probability_sum_error", f"{PW} SELECT floor(max(abs(p0 + p1 + p2 - 1)) * 1e9) AS error FROM pr", "error")
def probability_sum_error(spark, sf_dir):
    e = models.probability_sum_error(predictions(spark, sf_dir), ["p0", "p1", "p2"])
    return e.select(F.floor(F.col("probability_sum_max_error") * 1e9).cast("double").alias("error"))


@R.add("labelled_split", f"{PW}, l AS (SELECT id FROM pr WHERE id % 6 = 0) SELECT 'labelled' AS part, count(*) AS n FROM pr SEMI JOIN l USING (id) UNION ALL SELECT 'unlabelled', count(*) FROM pr ANTI JOIN l USING (id) UNION ALL SELECT 'shared', count(*) FROM (SELECT id FROM pr INTERSECT SELECT id FROM l)")
def labelled_split(spark, sf_dir):
    p = predictions(spark, sf_dir)
    own = p.where("id % 6 = 0").select("id")
    part = lambda df, name: df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"))
    return part(p.join(own, "id", "left_semi"), "labelled").union(part(p.join(own, "id", "left_anti"), "unlabelled")).union(part(behaviour.shared_ids("id", p, own), "shared"))


@R.add("scan_csv_roundtrip", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def scan_csv_roundtrip(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", F.when(F.col("c_custkey") % 9 == 0, "").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    path = own_folder(spark, "customer-csv")
    files.write_csv(c, path)
    return files.read_text_csv(spark, path, c.columns)


@R.add("scan_gzip", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def scan_gzip(spark, sf_dir):
    path = own_folder(spark, "nation-csv")
    table(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.options(header=True, compression="gzip").csv(path)
    return files.read_text_csv(spark, path)


@R.add("scan_typed_csv", "SELECT c_custkey, c_acctbal, TRY_CAST(nullif(c_mktsegment, 'BUILDING') AS DOUBLE) AS n, c_custkey % 4 = 0 AS dated FROM customer", "c_acctbal n")
def scan_typed_csv(spark, sf_dir):
    path = own_folder(spark, "typed-csv")
    c = table(spark, sf_dir, "customer")
    day = F.when(F.col("c_custkey") % 4 == 0, "2024-02-29").when(F.col("c_custkey") % 4 == 1, "2024-02-30").when(F.col("c_custkey") % 4 == 2, " ")
    files.write_csv(c.select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment", day.alias("day")), path)
    t = files.read_typed_csv(spark, path, "c_custkey long, c_acctbal double, c_mktsegment string, day string")
    return t.select("c_custkey", "c_acctbal", files.number(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("n"), files.lenient_date(F.col("day")).isNotNull().alias("dated"))


@R.add("scan_cases_csv", f"{PW} SELECT id AS {K}, {_cls('p')} AS t0_class, greatest(p0, p1, p2) AS t0_confidence, CASE WHEN id % 50 <> 7 THEN {_cls('q')} END AS t1_class, CASE WHEN id % 50 <> 7 THEN greatest(q0, q1, q2) END AS t1_confidence FROM pr", "t0_confidence t1_confidence")
def scan_cases_csv(spark, sf_dir):
    path = own_folder(spark, "cases-csv")
    p = predictions(spark, sf_dir).withColumnRenamed("id", K)
    rows = models.predictions_table(p, K, "T0", PHASES["T0"]).unionByName(models.predictions_table(p, K, "T1", PHASES["T1"]))
    files.write_csv(rows.where(f"not (phase = 'T1' and {K} % 50 = 7)"), path)
    return files.read_cases(spark, path).select(F.col(K).cast("long").alias(K), "t0_class", "t0_confidence", "t1_class", "t1_confidence")


@R.add("scan_oof_csv", f"{PW} SELECT id AS {K}, q0 AS p_review_warranted FROM pr", "p_review_warranted")
def scan_oof_csv(spark, sf_dir):
    path = own_folder(spark, "oof-csv")
    p = predictions(spark, sf_dir)
    one = lambda m, c: p.select(F.col("id").alias(K), F.lit(m).alias("model_name"), F.col(c).alias("p_review_warranted"))
    files.write_csv(one("boosted", "p0").unionByName(one("logistic", "q0")), path)
    return files.read_oof(spark, path, "logistic").select(F.col(K).cast("long").alias(K), "p_review_warranted")


@R.add("scan_json", "SELECT count(*) AS nations, max(n_nationkey) AS last FROM nation")
def scan_json(spark, sf_dir):
    path = own_folder(spark, "json")
    doc = table(spark, sf_dir, "nation").agg(F.to_json(F.struct(F.collect_list(F.struct("n_nationkey", "n_name")).alias("nations"))).alias("value"))
    doc.write.text(path)
    return files.read_json(spark, path).select(F.explode("nations").alias("n")).agg(F.count(F.lit(1)).alias("nations"), F.max("n.n_nationkey").alias("last"))


@R.add("csv_export", f"{CW} SELECT 1 + 2 * count(*) AS lines FROM cs")
def csv_export(spark, sf_dir):
    n = sum(1 for _ in files.csv_lines(review.stacked(_cases(spark, sf_dir))))
    return spark.range(1).select(F.lit(n).cast("long").alias("lines"))


@R.add("feature_dictionary")
def feature_dictionary(spark, sf_dir):
    f = catalog.described(_t0(spark, sf_dir))
    return catalog.dictionary(f, {"compact_model_predictor": ev.T0_PREDICTORS, "audit_only_review_signal": ev.T0_AUDIT})


@R.add("audit_columns", f"{with_(features('T0'), features('T1'), UPDATES, DELTA)} SELECT {K}, {', '.join(ev.T1_PREDICTORS + ev.T1_AUDIT)} FROM dl", " ".join(c for c in ev.T1_PREDICTORS if any(x in c for x in ("decay", "_mean"))))
def audit_columns(spark, sf_dir):
    e = evidence(spark, sf_dir)
    d = ev.delta_features(candidates(spark, sf_dir), e, e.where("phase = 'T1'"))
    return ev.compact(d, ev.T1_PREDICTORS + ev.T1_AUDIT)


@R.add("role_projection", f"WITH {EVIDENCE_SQL.strip()} SELECT {K}, phase, src AS source_domain, CAST(source_record_id AS VARCHAR) AS source_record_id, coalesce(strftime(event_dt, '%Y-%m-%d'), '') AS event_date, state, vehicle_ref, '1.1.0' AS rule_version FROM ev")
def role_projection(spark, sf_dir):
    return evidence(spark, sf_dir).select(K, "phase", F.col("src").alias("source_domain"), F.col("source_record_id").cast("string").alias("source_record_id"), F.coalesce(F.date_format("event_dt", "yyyy-MM-dd"), F.lit("")).alias("event_date"), "state", "vehicle_ref", F.lit("1.1.0").alias("rule_version"))


@R.add("sql_functions", "SELECT n_name, upper(n_name) AS folded, CASE WHEN n_name = 'CANADA' THEN 1.0 ELSE jaro_winkler_similarity(n_name, 'CANADA') END AS similarity, regexp_replace(upper(n_name), '[^A-Z0-9]', '', 'g') AS name FROM nation", "similarity")
def sql_functions(spark, sf_dir):
    register_functions(spark)
    table(spark, sf_dir, "nation").createOrReplaceTempView("attestra_nation")
    return spark.sql("select n_name, attestra_fold(n_name) as folded, jaro_winkler_floor(n_name, 'CANADA') as similarity, attestra_norm_name(n_name) as name from attestra_nation")


def _labelled(spark, sf_dir):
    f = ev.compact(_t0(spark, sf_dir), ev.T0_PREDICTORS)
    return f.withColumn("label", (F.conv(F.substring(F.md5(F.col(K).cast("string")), 1, 4), 16, 10).cast("long") % 3 * (F.col("oos_share_known_state") > 0.4).cast("int") + 0).cast("int"))


@R.add("logistic_oof")
def logistic_oof(spark, sf_dir):
    return models.out_of_fold(_labelled(spark, sf_dir), K, ev.T0_PREDICTORS, "logistic")


@R.add("boosted_oof")
def boosted_oof(spark, sf_dir):
    return models.out_of_fold(_labelled(spark, sf_dir), K, ev.T0_PREDICTORS, "boosted")


@R.add("nested_oof")
def nested_oof(spark, sf_dir):
    """Five outer folds, three inner ones, both configurations of the linear model."""
    out = models.nested(_labelled(spark, sf_dir), K, ev.T0_PREDICTORS, models.LOGISTIC_GRID)
    return out.rows.select(K, "label", "fold", "p0", "p1", "p2")


@R.add("importances")
def importances(spark, sf_dir):
    return models.Fitted.of(_labelled(spark, sf_dir), ev.T0_PREDICTORS, models.LOGISTIC_GRID[1]).importances(spark)


@R.add("stratified_folds", "WITH d AS (SELECT doc_id, toxic AS label, md5('42|' || doc_id) AS h FROM labels) SELECT doc_id, label, (row_number() OVER (PARTITION BY label ORDER BY h, doc_id) - 1) % 5 AS fold FROM d")
def stratified_folds(spark, sf_dir):
    return models.stratified_folds(table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")), "doc_id")


@R.add("stream_priors", "SELECT event_id, c_acctbal AS prior FROM events JOIN customer ON c_custkey = user_id", "prior")
def stream_priors(spark, sf_dir):
    e = updates.observed(updates.read_events(spark, sf_dir).select("event_id", F.col("user_id").alias("c_custkey"), "ts"), F.col("ts"))
    priors = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("prior"))
    return updates.with_priors(e, priors, "c_custkey").select("event_id", "prior")


@R.add("stream_counts", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_counts(spark, sf_dir):
    return updates.windowed_counts(spark, sf_dir).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


@R.add("stream_latest_state", "SELECT user_id, arg_max(event_id, epoch_us(ts) * 1000000::HUGEINT + event_id) AS event_id, arg_max(event_type, epoch_us(ts) * 1000000::HUGEINT + event_id) AS event_type FROM events GROUP BY 1")
def stream_latest_state(spark, sf_dir):
    return updates.latest_states(spark, sf_dir)


QUERIES, ORACLES = R.queries, R.oracles
