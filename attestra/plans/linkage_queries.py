"""Queries over names: normalisation, blocking, tiers, bridge, updates, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.config import REASONS, SOURCE_SPECS, LinkageRules
from attestra.functions.text import STREET, bucket, norm_address, norm_dob, norm_name, similarity, with_normalized
from attestra.operators import linkage as lk
from attestra.operators import name_search
from attestra.plans.common import Registry
from attestra.plans.testdata import PEOPLE_SQL, damaged, linkage_sources, people

R = Registry()
#: Transpositions round down where DuckDB is the oracle; the default keeps halves.
FLOOR = LinkageRules(transposition="floor")
NAME = r"regexp_replace(regexp_replace(upper(strip_accents(trim({}))), '^(SYNGIV-|SYNFAM-|SYNNAME-|SYNDOB-|SYNLOC-)', ''), '[^A-Z0-9]', '', 'g')"
DOB = r"coalesce(strftime(try_cast(nullif(regexp_replace(regexp_extract({0}, '[0-9]{{4}}[-/]?[0-9]{{2}}[-/]?[0-9]{{2}}'), '([0-9]{{4}})[-/]?([0-9]{{2}})[-/]?([0-9]{{2}})', '\1-\2-\3'), '') AS DATE), '%Y-%m-%d'), '')"
STREETS = "CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STREET.items()) + " ELSE w END"
ADDRESS = "array_to_string(list_transform(regexp_extract_all(upper({0}), '[A-Z0-9]+'), lambda w: " + STREETS + "), ' ')"
NORMAL = f"""
ix AS (SELECT id, {NAME.format('f')} AS cf, {NAME.format('l')} AS cl, {DOB.format('d')} AS cd, {ADDRESS.format('a')} AS ca FROM pe),
nm AS (SELECT *, {NAME.format('first_name')} AS nf, {NAME.format('last_name')} AS nl, {DOB.format('date_of_birth')} AS nd, {ADDRESS.format('street_address')} AS na FROM dm)
"""
WITH = f"WITH {PEOPLE_SQL.strip()}, {NORMAL.strip()}"
JW = "CASE WHEN {0} = {1} AND {0} <> '' THEN 1.0 WHEN {0} = '' OR {1} = '' THEN 0.0 ELSE jaro_winkler_similarity({0}, {1}) END"
SCORE = f"{JW.format('nf', 'cf')} AS fs, {JW.format('nl', 'cl')} AS ls"
DBL = "link_confidence first_name_similarity last_name_similarity name_similarity runner_up_margin"
D12 = ", ".join(lk.DECISION)
WHY = "CASE method " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REASONS.items()) + " ELSE '' END"


def _six(x):
    return f"round_even(CAST({x} AS DOUBLE), 6)"


def _rows(spark, sf_dir):
    return with_normalized(damaged(spark, sf_dir), "first_name", "last_name", "date_of_birth", "street_address")


def _index(spark, sf_dir):
    return lk.candidate_index(people(spark, sf_dir))


@R.add("normalize_name", f"{WITH} SELECT source_record_id, nf AS first_norm, nl AS last_norm FROM nm")
def normalize_name(spark, sf_dir):
    return damaged(spark, sf_dir).select("source_record_id", norm_name(F.col("first_name")).alias("first_norm"), norm_name(F.col("last_name")).alias("last_norm"))


@R.add("normalize_dob", f"{WITH} SELECT source_record_id, nd AS dob_norm FROM nm")
def normalize_dob(spark, sf_dir):
    return damaged(spark, sf_dir).select("source_record_id", norm_dob(F.col("date_of_birth")).alias("dob_norm"))


@R.add("normalize_address", f"{WITH} SELECT source_record_id, na AS address_norm FROM nm")
def normalize_address(spark, sf_dir):
    return damaged(spark, sf_dir).select("source_record_id", norm_address(F.col("street_address")).alias("address_norm"))


def _blocks(q, of):
    """SQL of block pairs: candidates for the names in q."""
    return f"""
{of}near AS (SELECT nf, nl, id, cf, cl FROM {q} JOIN ix ON nf = cf UNION SELECT nf, nl, id, cf, cl FROM {q} JOIN ix ON nl = cl),
{of}rest AS (SELECT * FROM {q} q WHERE NOT EXISTS (SELECT 1 FROM {of}near n WHERE n.nf = q.nf AND n.nl = q.nl)),
{of}bp AS (SELECT nf, nl, id, cf, cl FROM {of}near UNION ALL (SELECT nf, nl, id, cf, cl FROM {of}rest JOIN ix ON left(nf, 3) = left(cf, 3) UNION SELECT nf, nl, id, cf, cl FROM {of}rest JOIN ix ON left(nl, 4) = left(cl, 4)))"""


@R.add("block_pairs", f"{WITH}, q AS (SELECT DISTINCT nf, nl FROM nm WHERE nf <> '' AND nl <> ''), {_blocks('q', '').strip()} SELECT nf, nl, cf, cl, count(*) AS n FROM bp GROUP BY ALL")
def block_pairs(spark, sf_dir):
    q = _rows(spark, sf_dir).where("nf <> '' and nl <> ''").select("nf", "nl").distinct()
    return name_search.block_pairs(q, lk.candidate_names(_index(spark, sf_dir))).select("nf", "nl", "cf", "cl", "n")


@R.add("jaro_winkler_pairs", f"{WITH}, p AS (SELECT DISTINCT nf, cf FROM nm JOIN ix ON nl = cl) SELECT nf, cf, {JW.format('nf', 'cf')} AS similarity FROM p", "similarity")
def jaro_winkler_pairs(spark, sf_dir):
    p = name_search.first_names(_rows(spark, sf_dir), _index(spark, sf_dir))
    return p.withColumn("similarity", similarity(F.col("nf"), F.col("cf"), "floor"))


def _decided(keys, linked, conf, tier, dob="0", address="0"):
    """The twelve columns from id, fs, ls, s, pool, m and method."""
    z = lambda c: _six(f"coalesce({c}, 0.0)")
    return f"""SELECT {keys}, CASE WHEN {linked} THEN id END AS candidate_record_id, {z(conf)} AS link_confidence, CASE WHEN {linked} THEN {tier} ELSE 'UNRESOLVED' END AS link_tier, method AS link_method,
  {z('fs')} AS first_name_similarity, {z('ls')} AS last_name_similarity, {z('s')} AS name_similarity, CAST({dob} AS BIGINT) AS dob_match, CAST({address} AS BIGINT) AS address_match,
  CAST(coalesce(pool, 0) AS BIGINT) AS candidate_pool_size, {z('m')} AS runner_up_margin, CASE WHEN {linked} THEN '' ELSE {WHY} END AS ambiguity_reason"""


RANK = "ORDER BY s DESC, fs DESC, ls DESC, id DESC"


def _anchor_ctes(t, key, cand, cases, select):
    """CTEs that end in ``t``, the anchor's decisions for distinct names and keys."""
    return f"""
{t}q AS (SELECT DISTINCT nf, nl, {key} FROM nm),
{t}p AS (SELECT *, 0.45 * fs + 0.55 * ls AS s FROM (SELECT q.*, id, cf, cl, {SCORE} FROM {t}q q JOIN ix ON {key} = {cand} WHERE nf <> '' AND nl <> '' AND {key} <> '')),
{t}r AS (SELECT *, row_number() OVER o AS k, lead(s) OVER o AS nx, count(*) OVER (PARTITION BY nf, nl, {key}) AS pool FROM {t}p WINDOW o AS (PARTITION BY nf, nl, {key} {RANK})),
{t}b AS (SELECT q.*, id, cf, cl, fs, ls, s, pool, s - coalesce(nx, 0.0) AS m FROM {t}q q LEFT JOIN {t}r r ON r.k = 1 AND q.nf = r.nf AND q.nl = r.nl AND q.{key} = r.{key}),
{t} AS ({select} FROM (SELECT *, {cases} AS method FROM {t}b))"""


DOB_CASES = """CASE WHEN nf = '' OR nl = '' THEN 'missing_name' WHEN s IS NULL THEN 'dob_anchor_unavailable' WHEN nf = cf AND nl = cl THEN 'exact_name_and_dob'
 WHEN s >= 0.88 AND fs >= 0.75 AND ls >= 0.88 AND (pool = 1 OR m >= 0.05) THEN 'fuzzy_name_and_exact_dob' WHEN pool = 1 AND s >= 0.78 AND fs >= 0.65 AND ls >= 0.75 THEN 'unique_dob_and_acceptable_name' ELSE 'dob_name_conflict' END"""
DOB_CTE = _anchor_ctes("ad", "nd", "cd", DOB_CASES, _decided("nf, nl, nd", "method IN ('exact_name_and_dob', 'fuzzy_name_and_exact_dob', 'unique_dob_and_acceptable_name')",
    "CASE method WHEN 'exact_name_and_dob' THEN 0.995 WHEN 'fuzzy_name_and_exact_dob' THEN 0.975 WHEN 'unique_dob_and_acceptable_name' THEN 0.955 ELSE s END", "'A'", dob="s IS NOT NULL"))
ADDR_CASES = """CASE WHEN nf = '' OR nl = '' THEN 'missing_name' WHEN s IS NULL THEN 'address_anchor_unavailable' WHEN pool = 1 AND s >= 0.78 AND fs >= 0.65 AND ls >= 0.75 THEN 'exact_unique_address_and_name'
 WHEN pool > 1 AND s >= 0.9 AND m >= 0.08 THEN 'shared_address_resolved_by_name' ELSE 'address_name_conflict' END"""
ADDR_CTE = _anchor_ctes("aa", "na", "ca", ADDR_CASES, _decided("nf, nl, na", "method IN ('exact_unique_address_and_name', 'shared_address_resolved_by_name')",
    "CASE method WHEN 'exact_unique_address_and_name' THEN 0.965 WHEN 'shared_address_resolved_by_name' THEN 0.945 ELSE s END", "'B'", address="s IS NOT NULL"))


@R.add("dob_anchor", f"{WITH}, {DOB_CTE.strip()} SELECT * FROM ad", DBL)
def dob_anchor(spark, sf_dir):
    return lk.dob_anchor(_rows(spark, sf_dir), _index(spark, sf_dir), FLOOR)


@R.add("address_anchor", f"{WITH}, {ADDR_CTE.strip()} SELECT * FROM aa", DBL)
def address_anchor(spark, sf_dir):
    return lk.address_anchor(_rows(spark, sf_dir), _index(spark, sf_dir), FLOOR)


def _run(spark, sf_dir, rules=FLOOR) -> lk.LinkageRun:
    return lk.LinkageRun(people(spark, sf_dir), linkage_sources(spark, sf_dir), rules)


ANCHORS = f"{WITH}, {DOB_CTE.strip()}, {ADDR_CTE.strip()}"
ALIAS_CTE = """
al AS (SELECT nf, nl, list_sort(list(DISTINCT candidate_record_id)) AS ids FROM (SELECT nf, nl, candidate_record_id, link_confidence FROM ad UNION ALL SELECT nf, nl, candidate_record_id, link_confidence FROM aa)
 WHERE candidate_record_id IS NOT NULL AND link_confidence >= 0.95 GROUP BY 1, 2)"""


@R.add("alias_learning", f"{ANCHORS}, {ALIAS_CTE.strip()} SELECT nf, nl, array_to_string(ids, ',') AS ids FROM al")
def alias_learning(spark, sf_dir):
    return _run(spark, sf_dir).aliases.select("nf", "nl", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


def _name_ctes(q, al, t):
    """CTEs that end in ``t``, the names' decisions for the distinct names in q."""
    return f"""
{t}ex AS (SELECT cf AS nf, cl AS nl, list(id) AS same FROM ix GROUP BY 1, 2),
{t}k AS (SELECT q.nf, q.nl, coalesce(len(al.ids), 0) AS n_al, coalesce(len(ex.same), 0) AS n_ex, al.ids[1] AS a1, ex.same[1] AS e1 FROM {q} q LEFT JOIN {al} al ON al.nf = q.nf AND al.nl = q.nl LEFT JOIN {t}ex ex ON ex.nf = q.nf AND ex.nl = q.nl),
{t}o AS (SELECT nf, nl FROM {t}k WHERE nf <> '' AND nl <> '' AND n_al = 0 AND n_ex = 0 AND least(length(nf), length(nl)) >= 3), {_blocks(t + 'o', t).strip()},
{t}p AS (SELECT *, 0.45 * fs + 0.55 * ls AS s FROM (SELECT bp.*, {SCORE} FROM {t}bp bp)),
{t}r AS (SELECT *, row_number() OVER o AS r, lead(s) OVER o AS nx, count(*) OVER (PARTITION BY nf, nl) AS pool FROM {t}p WINDOW o AS (PARTITION BY nf, nl {RANK})),
{t}a AS (SELECT *, 0.45 * fs + 0.55 * ls AS s FROM (SELECT k.nf, k.nl, {SCORE} FROM {t}k k JOIN ix ON n_al = 1 AND a1 = id)),
{t}z AS (SELECT k.nf, k.nl, n_al, n_ex, CASE WHEN n_al = 1 THEN a1 WHEN n_al = 0 AND n_ex = 1 THEN e1 ELSE r.id END AS id,
  CASE WHEN n_al = 1 THEN a.fs WHEN n_al > 1 THEN 0 WHEN n_ex > 0 THEN 1 ELSE r.fs END AS fs, CASE WHEN n_al = 1 THEN a.ls WHEN n_al > 1 THEN 0 WHEN n_ex > 0 THEN 1 ELSE r.ls END AS ls,
  CASE WHEN n_al = 1 THEN a.s WHEN n_al > 1 THEN 0 WHEN n_ex > 0 THEN 1 ELSE r.s END AS s, CASE WHEN n_al > 0 THEN n_al WHEN n_ex > 0 THEN n_ex ELSE r.pool END AS pool,
  CASE WHEN n_al = 1 OR n_al = 0 AND n_ex = 1 THEN 1 WHEN n_al > 1 OR n_ex > 1 THEN 0 ELSE r.s - coalesce(nx, 0.0) END AS m FROM {t}k k LEFT JOIN {t}r r ON r.r = 1 AND r.nf = k.nf AND r.nl = k.nl LEFT JOIN {t}a a ON a.nf = k.nf AND a.nl = k.nl),
{t}v AS (SELECT * REPLACE (CASE WHEN nf = '' OR nl = '' THEN 0 ELSE fs END AS fs, CASE WHEN nf = '' OR nl = '' THEN 0 ELSE ls END AS ls, CASE WHEN nf = '' OR nl = '' THEN 0 ELSE s END AS s, CASE WHEN nf = '' OR nl = '' THEN 0 ELSE pool END AS pool, CASE WHEN nf = '' OR nl = '' THEN 0 ELSE m END AS m),
  CASE WHEN nf = '' OR nl = '' THEN 'missing_name' WHEN n_al = 1 THEN 'verified_dob_or_address_alias' WHEN n_al > 1 THEN 'ambiguous_verified_alias' WHEN n_ex = 1 THEN 'unique_exact_normalized_full_name'
 WHEN n_ex > 1 THEN 'ambiguous_exact_full_name' WHEN least(length(nf), length(nl)) < 3 THEN 'short_name_not_fuzzy_matched' WHEN s IS NULL THEN 'no_name_block'
 WHEN s >= 0.95 AND least(fs, ls) >= 0.9 AND m >= 0.06 THEN 'strong_fuzzy_name_clear_margin' ELSE 'weak_or_ambiguous_fuzzy_name' END AS method FROM {t}z),
{t} AS ({_decided("nf, nl", "method IN ('verified_dob_or_address_alias', 'unique_exact_normalized_full_name', 'strong_fuzzy_name_clear_margin')",
  "CASE method WHEN 'missing_name' THEN 0 WHEN 'verified_dob_or_address_alias' THEN 0.955 WHEN 'ambiguous_verified_alias' THEN 0 WHEN 'unique_exact_normalized_full_name' THEN 0.935 WHEN 'ambiguous_exact_full_name' THEN 1 WHEN 'strong_fuzzy_name_clear_margin' THEN 0.885 ELSE s END",
  "CASE method WHEN 'strong_fuzzy_name_clear_margin' THEN 'C' ELSE 'B' END")} FROM {t}v)"""


TITLES = f"""
tt AS (SELECT *, {NAME.format('first_name')} AS nf, {NAME.format('last_name')} AS nl, CASE WHEN lower(trim(raw_ref)) = 'nan' THEN '' ELSE trim(raw_ref) END AS vehicle_ref FROM (
  SELECT 2 * source_record_id AS source_record_id, first_name, last_name, vehicle_ref AS raw_ref, event_date, state FROM dm UNION ALL SELECT 2 * id + 1, f, l, 'V' || id, '2023-12-31', 'DE' FROM pe WHERE id % 2 = 0)),
kq AS (SELECT DISTINCT nf, nl FROM (SELECT nf, nl FROM nm UNION ALL SELECT nf, nl FROM tt))"""
NAMES = f"{ANCHORS}, {ALIAS_CTE.strip()}, {TITLES.strip()}, {_name_ctes('kq', 'al', 'rn').strip()}"


@R.add("name_tiers", f"{NAMES} SELECT * FROM rn", DBL)
def name_tiers(spark, sf_dir):
    return _run(spark, sf_dir).names


def _fit_ctes(q, t):
    """CTEs that end in ``t``: names and owners in q that fit, with scores and margin."""
    return f"""
{t}n AS (SELECT DISTINCT nf, nl FROM {q}), {_blocks(t + 'n', t).strip()},
{t}x AS (SELECT nf, nl, id, 0.45 * fs + 0.55 * ls AS s FROM (SELECT bp.*, {SCORE} FROM {t}bp bp)),
{t}o AS (SELECT *, 0.45 * fs + 0.55 * ls AS s FROM (SELECT q.*, {SCORE} FROM {q} q JOIN ix ON owner = id)),
{t}m AS (SELECT o.*, s - coalesce((SELECT max(x.s) FROM {t}x x WHERE x.nf = o.nf AND x.nl = o.nl AND x.id <> o.owner), 0.0) AS m FROM {t}o o),
{t} AS (SELECT * FROM {t}m WHERE s >= 0.9 AND fs >= 0.9 AND ls >= 0.9 AND m >= 0.02)"""


BRIDGE = f"""
tn AS (SELECT tt.*, {', '.join(f'rn.{c}' for c in lk.DECISION)} FROM tt JOIN rn ON tt.nf = rn.nf AND tt.nl = rn.nl),
vo AS (SELECT vehicle_ref, list(DISTINCT candidate_record_id) FILTER (link_confidence >= 0.95) AS st, list(DISTINCT candidate_record_id) AS li, count(*) FILTER (link_confidence >= 0.95) AS sr FROM tn WHERE vehicle_ref <> '' AND candidate_record_id IS NOT NULL GROUP BY 1),
ow AS (SELECT vehicle_ref, st[1] AS owner FROM vo WHERE len(st) = 1 AND len(li) = 1),
bq AS (SELECT DISTINCT nf, nl, owner FROM tn JOIN ow USING (vehicle_ref) WHERE candidate_record_id IS NULL AND nf <> '' AND nl <> ''), {_fit_ctes('bq', 'bf').strip()},
tb AS (SELECT tn.* REPLACE (CASE WHEN h THEN bf.owner ELSE candidate_record_id END AS candidate_record_id, CASE WHEN h THEN 0.97 ELSE link_confidence END AS link_confidence, CASE WHEN h THEN 'A' ELSE link_tier END AS link_tier,
  CASE WHEN h THEN 'unanimous_t0_vehicle_ref_with_strong_name' ELSE link_method END AS link_method, CASE WHEN h THEN {_six('fs')} ELSE first_name_similarity END AS first_name_similarity, CASE WHEN h THEN {_six('ls')} ELSE last_name_similarity END AS last_name_similarity,
  CASE WHEN h THEN {_six('s')} ELSE name_similarity END AS name_similarity, CASE WHEN h THEN 1 ELSE candidate_pool_size END AS candidate_pool_size, CASE WHEN h THEN {_six('m')} ELSE runner_up_margin END AS runner_up_margin, CASE WHEN h THEN '' ELSE ambiguity_reason END AS ambiguity_reason)
  FROM (SELECT tn.*, candidate_record_id IS NULL AND bf.owner IS NOT NULL AS h, bf.owner, fs, ls, s, m FROM tn LEFT JOIN ow ON tn.vehicle_ref = ow.vehicle_ref LEFT JOIN bf ON tn.nf = bf.nf AND tn.nl = bf.nl AND bf.owner = ow.owner) tn, (SELECT 1) one)"""
BRIDGE = BRIDGE.replace("THEN bf.owner ELSE candidate", "THEN owner ELSE candidate").replace(" tn, (SELECT 1) one)", " tn)")
TITLED = f"{NAMES}, {BRIDGE.strip()}"


@R.add("vehicle_bridge", f"{TITLED} SELECT source_record_id, vehicle_ref, {D12} FROM tb", DBL)
def vehicle_bridge(spark, sf_dir):
    return _run(spark, sf_dir).titles.select("source_record_id", "vehicle_ref", *lk.DECISION)


UPDATED = f"""
uo AS (SELECT vehicle_ref, list(DISTINCT candidate_record_id) AS ids FROM tb WHERE vehicle_ref <> '' AND candidate_record_id IS NOT NULL AND link_tier IN ('A', 'B') GROUP BY 1),
ua AS (SELECT nm.*, ids, CASE WHEN source_domain = 'title' AND update_ref <> '' THEN coalesce(len(ids), 0) ELSE 0 END AS n_own FROM nm LEFT JOIN uo ON uo.vehicle_ref = nm.update_ref),
ub AS (SELECT ua.*, 0.45 * fs + 0.55 * ls AS s FROM (SELECT ua.*, CASE WHEN n_own = 1 THEN ids[1] END AS owner, {SCORE} FROM ua LEFT JOIN ix ON n_own = 1 AND ids[1] = ix.id) ua),
uc AS (SELECT ub.*, rn.* EXCLUDE (nf, nl), CASE WHEN n_own = 0 THEN 'name' WHEN n_own > 1 THEN 'ambiguous_vehicle_ownership' WHEN candidate_record_id <> owner THEN 'vehicle_name_conflict' WHEN s < 0.72 THEN 'vehicle_name_noncontradiction_failed' ELSE 'known_vehicle_ref_with_noncontradictory_name' END AS method
  FROM ub JOIN rn ON ub.nf = rn.nf AND ub.nl = rn.nl),
ud AS (SELECT source_record_id, CASE method WHEN 'name' THEN candidate_record_id WHEN 'known_vehicle_ref_with_noncontradictory_name' THEN owner END AS candidate_record_id,
  CASE method WHEN 'name' THEN link_confidence WHEN 'known_vehicle_ref_with_noncontradictory_name' THEN 0.99 WHEN 'vehicle_name_noncontradiction_failed' THEN s ELSE name_similarity END AS link_confidence,
  CASE method WHEN 'name' THEN link_tier WHEN 'known_vehicle_ref_with_noncontradictory_name' THEN 'A' ELSE 'UNRESOLVED' END AS link_tier, CASE method WHEN 'name' THEN link_method ELSE method END AS link_method,
  {', '.join(f"CASE method WHEN 'vehicle_name_noncontradiction_failed' THEN {c} WHEN 'known_vehicle_ref_with_noncontradictory_name' THEN {_six(c)} ELSE {n} END AS {n}" for c, n in (('fs', 'first_name_similarity'), ('ls', 'last_name_similarity'), ('s', 'name_similarity')))},
  dob_match, address_match, CASE WHEN method = 'name' THEN candidate_pool_size WHEN method = 'vehicle_name_conflict' THEN 2 ELSE n_own END AS candidate_pool_size,
  CASE method WHEN 'name' THEN runner_up_margin WHEN 'known_vehicle_ref_with_noncontradictory_name' THEN 1.0 ELSE 0.0 END AS runner_up_margin, CASE method WHEN 'name' THEN ambiguity_reason ELSE {WHY} END AS ambiguity_reason FROM uc)"""
ALL = f"{TITLED}, {UPDATED.strip()}"


@R.add("update_resolution", f"{ALL} SELECT * FROM ud", DBL)
def update_resolution(spark, sf_dir):
    return _run(spark, sf_dir).updates.select("source_record_id", *lk.DECISION)


def _prefer(key, t):
    return f"SELECT nm.source_record_id, nm.*, " + ", ".join(f"CASE WHEN {t}.candidate_record_id IS NOT NULL THEN {t}.{c} ELSE rn.{c} END AS {c}" for c in lk.DECISION) + f" FROM nm JOIN {t} ON nm.nf = {t}.nf AND nm.nl = {t}.nl AND nm.{key} = {t}.{key} JOIN rn ON nm.nf = rn.nf AND nm.nl = rn.nl"


def _standard(source, rows, **roles):
    spec = SOURCE_SPECS[source]
    cols = {"phase": f"'{spec.phase}'", "source": f"'{source}'", "source_domain": f"'{source}'", "event_date": "event_date", "observed_date": "''", "state": "state", "vehicle_ref": "''", **{c: "''" for c in lk.EXTRAS}, **roles}
    return f"SELECT source_record_id, {D12}, '1.1.0' AS link_rule_version, " + ", ".join(f"{v} AS {k}" for k, v in cols.items()) + f" FROM ({rows})"


BY_NAME = f"SELECT nm.*, {', '.join(f'rn.{c}' for c in lk.DECISION)} FROM nm JOIN rn ON nm.nf = rn.nf AND nm.nl = rn.nl"
UNIFIED = f"""{ALL}, un AS ({' UNION ALL BY NAME '.join([
    _standard('address_history', _prefer('na', 'aa')), _standard('license_id_events', _prefer('nd', 'ad'), credential_status="'active'"), _standard('external_context_signals', BY_NAME, evidence_quality="'limited'"),
    _standard('vehicle_title_events', 'SELECT * FROM tb', vehicle_ref='vehicle_ref'), _standard('work_location_signals', BY_NAME, observed_date='event_date'),
    _standard('evidence_update_stream', 'SELECT ud.*, nm.source_domain, nm.record_action, nm.event_date, nm.state, nm.update_ref FROM ud JOIN nm USING (source_record_id)', source_domain='source_domain', record_action='record_action', observed_date='event_date', vehicle_ref='update_ref'),
])})"""  # fmt: skip


@R.add("unified_events", f"{UNIFIED} SELECT * FROM un", DBL)
def unified_events(spark, sf_dir):
    return _run(spark, sf_dir).unified


@R.add("linked_split", f"{UNIFIED} SELECT 'linked' AS part, source, count(*) AS n FROM un WHERE candidate_record_id IS NOT NULL GROUP BY ALL UNION ALL SELECT 'unresolved', source, count(*) FROM un WHERE candidate_record_id IS NULL GROUP BY ALL")
def linked_split(spark, sf_dir):
    run = _run(spark, sf_dir)
    part = lambda d, name: d.groupBy(F.lit(name).alias("part"), "source").agg(F.count(F.lit(1)).alias("n"))
    return part(run.linked, "linked").unionByName(part(run.unresolved, "unresolved"))


@R.add("linkage_summary", f"""{UNIFIED} SELECT phase, source, count(*) AS total_records, count(candidate_record_id) AS linked_records, count(*) - count(candidate_record_id) AS unresolved_records, round_even(count(candidate_record_id) / count(*)::DOUBLE, 6) AS link_rate,
 {', '.join(f"count(*) FILTER (link_tier = '{t}') AS tier_{t.lower()}_records" for t in 'ABC')}, count(DISTINCT candidate_record_id) AS linked_candidate_coverage, coalesce(round_even(avg(link_confidence) FILTER (candidate_record_id IS NOT NULL), 6), 0.0) AS mean_link_confidence FROM un GROUP BY 1, 2""", "link_rate mean_link_confidence")
def linkage_summary(spark, sf_dir):
    return lk.linkage_summary(_run(spark, sf_dir).unified)


@R.add("linkage_methods", f"{UNIFIED} SELECT phase, source, link_tier, link_method, count(*) AS record_count FROM un GROUP BY ALL")
def linkage_methods(spark, sf_dir):
    return lk.linkage_methods(_run(spark, sf_dir).unified)


@R.add("coverage_pivot", f"{UNIFIED} SELECT pe.id AS candidate_record_id, " + ", ".join(f"count(*) FILTER (source = '{k}') AS {s.phase.lower()}__{k}" for k, s in SOURCE_SPECS.items()) + " FROM pe LEFT JOIN un ON un.candidate_record_id = pe.id GROUP BY 1")
def coverage_pivot(spark, sf_dir):
    return lk.coverage(people(spark, sf_dir), _run(spark, sf_dir).unified)


COLLISIONS = """SELECT 'name' AS key_kind, count(DISTINCT id) AS n FROM ix GROUP BY cf, cl UNION ALL SELECT 'dob', count(DISTINCT id) FROM ix WHERE cd <> '' GROUP BY cd
 UNION ALL SELECT 'address', count(DISTINCT id) FROM ix WHERE ca <> '' GROUP BY ca"""


@R.add("key_collisions", f"{WITH} SELECT key_kind, count(*) AS shared_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS candidates FROM ({COLLISIONS}) WHERE n > 1 GROUP BY 1")
def key_collisions(spark, sf_dir):
    return lk.key_collisions(_index(spark, sf_dir)).where("shared_keys > 0")


@R.add("linkage_diagnostics", f"""{UNIFIED}, ua2 AS (SELECT vehicle_ref, count(DISTINCT candidate_record_id) AS n FROM tb WHERE vehicle_ref <> '' AND candidate_record_id IS NOT NULL AND link_tier IN ('A', 'B') GROUP BY 1)
SELECT 'method:' || link_method AS name, count(*)::DOUBLE AS value FROM un GROUP BY 1 UNION ALL SELECT 'candidate_' || kind || '_key_collisions', (SELECT count(*) FROM ({COLLISIONS}) WHERE n > 1 AND key_kind = kind) FROM (SELECT unnest(['name', 'dob', 'address']) AS kind)
UNION ALL SELECT unnest(['source_record_count', 'linked_record_count', 'unresolved_record_count', 'overall_link_rate', 'rows_recovered']), unnest([count(*)::DOUBLE, count(candidate_record_id), count(*) - count(candidate_record_id), round_even(count(candidate_record_id) / count(*)::DOUBLE, 6), count(*) FILTER (link_method = 'unanimous_t0_vehicle_ref_with_strong_name')]) FROM un
UNION ALL SELECT 'candidate_count', count(*) FROM pe UNION ALL SELECT unnest(['verified_alias_count', 'ambiguous_verified_alias_count']), unnest([count(*) FILTER (len(ids) = 1), count(*) FILTER (len(ids) > 1)]) FROM al
UNION ALL SELECT unnest(['vehicle_ref_count', 'ambiguous_vehicle_ref_count']), unnest([count(*), count(*) FILTER (n > 1)]) FROM ua2
UNION ALL SELECT unnest(['strong_anchor_rows', 'vehicle_refs_with_strong_anchors', 'vehicle_refs_with_conflicting_strong_anchors', 'vehicle_refs_with_any_linked_owner_conflict', 'vehicle_refs_eligible_for_bridge']),
  unnest([sum(sr)::DOUBLE, count(*) FILTER (len(st) > 0), count(*) FILTER (len(st) > 1), count(*) FILTER (len(li) > 1), count(*) FILTER (len(st) = 1 AND len(li) = 1)]) FROM vo
UNION ALL SELECT 'unresolved_rows_on_eligible_vehicle_refs', count(*) FROM tn JOIN ow USING (vehicle_ref) WHERE candidate_record_id IS NULL""", "value")
def linkage_diagnostics(spark, sf_dir):
    return lk.diagnostics(_run(spark, sf_dir))


BUCKET = "CAST(CAST('0x' || substr(sha256(concat_ws('|', nf, nl)), 1, 8) AS BIGINT) % 5 AS BIGINT)"


@R.add("holdout_hash_split", f"{WITH} SELECT source_record_id, {BUCKET} AS bucket FROM nm")
def holdout_hash_split(spark, sf_dir):
    return _rows(spark, sf_dir).select("source_record_id", bucket(F.concat_ws("|", "nf", "nl")).alias("bucket"))


@R.add("anchor_audit", f"""{ANCHORS}, rf AS (SELECT nm.source_record_id, nm.nf, nm.nl, ad.candidate_record_id, ad.link_confidence, {BUCKET.replace('nf, nl', 'nm.nf, nm.nl')} AS fold FROM nm JOIN ad ON nm.nf = ad.nf AND nm.nl = ad.nl AND nm.nd = ad.nd WHERE ad.link_tier = 'A'),
hl AS (SELECT nf, nl, list_sort(list(DISTINCT candidate_record_id)) AS ids FROM rf WHERE fold <> 0 AND link_confidence >= 0.95 GROUP BY 1, 2), hq AS (SELECT DISTINCT nf, nl FROM rf WHERE fold = 0), {_name_ctes('hq', 'hl', 'hr').strip()},
hh AS (SELECT rf.*, hr.candidate_record_id AS guess FROM rf LEFT JOIN hr ON rf.nf = hr.nf AND rf.nl = hr.nl AND fold = 0),
hn AS (SELECT count(*) AS reference_rows, count(*) FILTER (fold = 0) AS holdout_rows, count(guess) AS accepted, count(*) FILTER (guess = candidate_record_id) AS correct FROM hh)
SELECT *, accepted - correct AS incorrect, round_even(correct / nullif(accepted, 0)::DOUBLE, 6) AS precision, round_even(accepted / nullif(holdout_rows, 0)::DOUBLE, 6) AS coverage FROM hn""", "precision coverage")
def anchor_audit(spark, sf_dir):
    run = _run(spark, sf_dir)
    return lk.anchor_audit(run.license, run.index, FLOOR)


@R.add("bridge_audit", f"""{TITLED}, sa AS (SELECT * FROM tn WHERE vehicle_ref <> '' AND candidate_record_id IS NOT NULL), ss AS (SELECT * FROM sa WHERE link_confidence >= 0.95), sk AS (SELECT DISTINCT vehicle_ref, nf, nl FROM ss),
sp AS (SELECT sk.*, (SELECT list(DISTINCT candidate_record_id) FROM ss x WHERE x.vehicle_ref = sk.vehicle_ref AND (x.nf <> sk.nf OR x.nl <> sk.nl)) AS st, (SELECT list(DISTINCT candidate_record_id) FROM sa x WHERE x.vehicle_ref = sk.vehicle_ref AND (x.nf <> sk.nf OR x.nl <> sk.nl)) AS li FROM sk),
sw AS (SELECT vehicle_ref, nf, nl, st[1] AS owner FROM sp WHERE len(st) = 1 AND len(li) = 1 AND st[1] = li[1]), sq AS (SELECT DISTINCT nf, nl, owner FROM sw), {_fit_ctes('sq', 'sf').strip()},
sn AS (SELECT count(*) AS accepted, count(*) FILTER (candidate_record_id = owner) AS correct, count(DISTINCT vehicle_ref) AS vehicle_refs_tested FROM ss JOIN sw USING (vehicle_ref, nf, nl) JOIN sf USING (nf, nl, owner))
SELECT *, accepted - correct AS incorrect, round_even(correct / nullif(accepted, 0)::DOUBLE, 6) AS precision FROM sn""", "precision")
def bridge_audit(spark, sf_dir):
    run = _run(spark, sf_dir)
    return lk.bridge_audit(run.title_names, run.index, FLOOR)


QUERIES, ORACLES = R.queries, R.oracles
