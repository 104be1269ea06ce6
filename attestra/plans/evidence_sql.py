"""DuckDB SQL of the evidence features."""

from __future__ import annotations

from attestra.config import SOURCES
from attestra.operators.evidence import DELTAS
from attestra.plans.testdata import EVIDENCE_SQL

CLASS = "CASE WHEN upper(trim(state)) IN ('', 'NAN') THEN 'MISSING' WHEN upper(trim(state)) = 'DE' THEN 'DE' ELSE 'OOS' END"
K = "candidate_record_id"


def features(phase: str) -> str:
    """CTEs that end with ``f_<phase>``."""
    p = phase.lower()
    as_of = "candidate_dt" if phase == "T0" else "(SELECT as_of FROM t1cut)"
    n = lambda c: f"count(*) FILTER ({c})"
    sel = []
    for lab, cls in (("oos", "OOS"), ("de", "DE")):
        sel += [f"{n(f'sc = {cls!r} AND age <= {d}')} AS {lab}_count_{d}d" for d in (30, 60, 90, 180, 365)]
        sel += [f"max(event_dt) FILTER (sc = '{cls}') AS top_{lab}", f"count(DISTINCT src) FILTER (sc = '{cls}' AND age <= 90) AS recent_{lab}_independent_source_count_90d"]
        sel += [f"coalesce(sum(exp(-ln(2) * age / {h}.0)) FILTER (sc = '{cls}'), 0.0) AS {lab}_decay_{h}d" for h in (90, 365)]
    for s in SOURCES:
        m = f"src = '{s}'"
        sel += [f"{n(m)} AS {s}_record_count", f"{n(m + ' AND sc = ' + repr('DE'))} AS {s}_de_count", f"{n(m + ' AND sc = ' + repr('OOS'))} AS {s}_oos_count", f"{n(m + ' AND sc = ' + repr('MISSING'))} AS {s}_state_missing_count"]
        sel += [f"max(event_dt) FILTER ({m}) AS last_{s}", f"arg_max(sc, event_dt * 1e9 + source_record_id) FILTER ({m} AND event_dt IS NOT NULL) AS lastc_{s}".replace("event_dt * 1e9", "epoch(event_dt) * 1e6")]
        sel += [f"arg_max(sc, epoch(event_dt) * 1e6 + source_record_id) FILTER ({m} AND event_dt IS NOT NULL AND sc <> 'MISSING') AS knownc_{s}", f"max(event_dt) FILTER ({m} AND sc <> 'MISSING') AS knownd_{s}"]
        sel += [f"max(event_dt) FILTER ({m} AND sc = '{c.upper()}') AS {c}_{s}" for c in ("oos", "de")]
    v, c = "src = 'title' AND sc = 'OOS'", "src = 'license' AND sc = 'OOS'"
    act = "credential_status = 'active'"
    strong = "(event_type IN ('title_record', 'ownership_change') OR record_action = 'new_record')"
    same = "prior <> '' AND upper(trim(state)) = prior"
    post = {
        "pre_de_proxy_oos_vehicle_signal_count": f"{v} AND since < 0", "within_60d_oos_vehicle_signal_count": f"{v} AND since BETWEEN 0 AND 60", "post_60d_oos_vehicle_signal_count": f"{v} AND since > 60",
        "within_60d_active_oos_credential_signal_count": f"{c} AND {act} AND since BETWEEN 0 AND 60", "post_60d_active_oos_credential_signal_count": f"{c} AND {act} AND since > 60",
        "post_60d_oos_credential_update_status_unknown_count": f"{c} AND phase = 'T1' AND credential_status = '' AND since > 60",
        "post_move_oos_title_record_count": f"{v} AND since >= 0 AND event_type = 'title_record'", "post_move_oos_ownership_change_count": f"{v} AND since >= 0 AND event_type = 'ownership_change'",
        "post_move_oos_record_update_count": f"{v} AND since >= 0 AND event_type = 'record_update'", "post_move_oos_t1_title_new_record_count": f"{v} AND since >= 0 AND record_action = 'new_record'",
        "post_move_oos_t1_title_status_update_count": f"{v} AND since >= 0 AND record_action = 'status_update'", "post_move_oos_t1_title_correction_count": f"{v} AND since >= 0 AND record_action = 'record_correction'",
        "post_move_oos_vehicle_matches_prior_state_count": f"{v} AND since >= 0 AND {same}", "post_60d_oos_vehicle_matches_prior_state_count": f"{v} AND since > 60 AND {same}",
        "post_move_active_credential_matches_prior_state_count": f"{c} AND {act} AND since >= 0 AND {same}", "post_60d_active_credential_matches_prior_state_count": f"{c} AND {act} AND since > 60 AND {same}",
    }
    sel += [f"{n(x)} AS {k}" for k, x in post.items()]
    sel += [f"{n(f'{v} AND since >= 0 AND {strong}')} AS m0", f"{n(f'{v} AND since > 60 AND {strong}')} AS m60", f"max(since - 60) FILTER ({v} AND since > 60) AS v60", f"max(since - 60) FILTER ({c} AND {act} AND since > 60) AS c60"]
    f = lambda x: f"CAST(coalesce({x}, false) AS BIGINT)"
    days = lambda x: f"date_diff('day', {x}, a.as_of)"
    ksum = lambda cond: "(" + " + ".join(f(cond(s)) for s in SOURCES) + ")"
    n_de, n_oos = ksum(lambda s: f"knownc_{s} = 'DE'"), ksum(lambda s: f"knownc_{s} = 'OOS'")
    r_de, r_oos = ksum(lambda s: f"knownc_{s} = 'DE' AND {days(f'knownd_{s}')} <= 365"), ksum(lambda s: f"knownc_{s} = 'OOS' AND {days(f'knownd_{s}')} <= 365")
    z = lambda x: f"coalesce({x}, 0)"
    counts = ["linked_record_count", "de_count_total", "oos_count_total", "state_missing_count", "distinct_oos_states", "source_diversity", "historical_oos_count_over_365d", "oos_evidence_after_latest_de_count", "de_evidence_after_latest_oos_count", "oos_to_de_transition_count", "de_to_oos_transition_count",
              *(f"{x}_count_{d}d" for x in ("oos", "de") for d in (30, 60, 90, 180, 365)), *(f"recent_{x}_independent_source_count_90d" for x in ("oos", "de")), *(f"{s}_{x}_count" for s in SOURCES for x in ("record", "de", "oos", "state_missing")), *post,
              "active_address_de_count", "active_address_oos_count", "active_oos_credential_count", "active_de_credential_count", "expired_or_superseded_credential_count", "distinct_vehicle_count", "ownership_change_count", "limited_quality_external_count", "standard_quality_external_count", "t1_update_observation_lag_max_days", "t1_late_arriving_update_count_over_30d"]
    out = [f"{z('g.' + x)} AS {x}" for x in counts] + [f"coalesce(g.{x}_decay_{h}d, 0.0) AS {x}_decay_{h}d" for x in ("oos", "de") for h in (90, 365)]
    ratio = lambda a, b: f"coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0.0)"
    for s in SOURCES:
        out += [f"{f(f'lastc_{s} = ' + repr('DE'))} AS {s}_latest_is_de", f"{f(f'lastc_{s} = ' + repr('OOS'))} AS {s}_latest_is_oos", f"{days(f'last_{s}')} AS days_since_{s}_latest_record", f"{days(f'oos_{s}')} AS days_since_{s}_latest_oos", f"{days(f'de_{s}')} AS days_since_{s}_latest_de"]
    sp = f"greatest({days('r.proxy')}, 0)"
    v60, c60 = z("post_60d_oos_vehicle_signal_count"), z("post_60d_active_oos_credential_signal_count")
    vs, cs = "post_60d_oos_vehicle_matches_prior_state_count > 0", "post_60d_active_credential_matches_prior_state_count > 0"
    out += [
        f"{ratio('state_missing_count', 'linked_record_count')} AS state_missing_ratio", f"{ratio('oos_count_total', '(oos_count_total + de_count_total)')} AS oos_share_known_state",
        f"{days('top_oos')} AS days_since_latest_oos", f"{days('top_de')} AS days_since_latest_de", f"{f('top_de > top_oos')} AS de_after_oos", f"{f('top_oos > top_de')} AS oos_after_de",
        f"{days('top_de')} - {days('top_oos')} AS latest_oos_recency_advantage_days", f"{f('oos_count_total > 0 AND top_de > top_oos AND oos_count_365d = 0')} AS historical_oos_only",
        f"{f('oos_evidence_after_latest_de_count > 0 AND oos_count_365d > 0')} AS recent_oos_after_latest_de_present", f"{f('recent_oos_independent_source_count_90d >= 2')} AS recent_oos_cross_source_confirmation_present_90d",
        *(f"{ratio(f'oos_decay_{h}d', f'(oos_decay_{h}d + de_decay_{h}d)')} AS oos_decay_share_{h}d" for h in (90, 365)),
        f"{n_de} AS latest_source_de_count", f"{n_oos} AS latest_source_oos_count", f"{ratio(n_oos, f'({n_oos} + {n_de})')} AS latest_source_oos_share", f"{n_de} * {n_oos} AS cross_source_conflict_count", f"{f(f'{n_de} * {n_oos} > 0')} AS cross_source_conflict_present",
        f"{r_de} AS recent_latest_source_de_count_365d", f"{r_oos} AS recent_latest_source_oos_count_365d", f"{n_oos} - {r_oos} AS historical_latest_source_oos_count", f"{r_de} * {r_oos} AS recent_cross_source_conflict_count_365d", f"{f(f'{r_de} * {r_oos} > 0')} AS recent_cross_source_conflict_present_365d",
        "(" + " + ".join(f"CASE WHEN knownc_{s} = 'OOS' THEN exp(-ln(2) * {days(f'knownd_{s}')} / 365.0) ELSE 0.0 END" for s in SOURCES) + ") AS recency_weighted_latest_source_oos",
        "link_confidence_mean", "link_confidence_min", f"{ratio('low', 'conf')} AS low_confidence_link_share", f"{ratio('tc', 'linked_record_count')} AS tier_c_link_share", f"{f('active_address_de_count > 0 AND active_address_oos_count > 0')} AS active_address_state_conflict",
        "coalesce(t1_update_observation_lag_mean_days, 0.0) AS t1_update_observation_lag_mean_days",
        f"{f('r.proxy IS NOT NULL')} AS de_residency_proxy_present", f"CASE WHEN r.proxy IS NOT NULL THEN {sp} END AS days_since_de_residency_proxy", f"{z('r.sources')} AS de_residency_proxy_source_count",
        f"{f(f'r.proxy IS NOT NULL AND {sp} <= 60')} AS current_within_60_day_grace_proxy", f"{f(f'r.proxy IS NOT NULL AND {sp} > 60')} AS current_past_60_day_grace_proxy", f"CASE WHEN r.proxy IS NOT NULL THEN greatest({sp} - 60, 0) ELSE 0 END AS days_past_60_day_grace_proxy",
        f"{f('r.prior <> ' + repr(''))} AS prior_oos_address_state_proxy_present", f"{f(f'{v60} > 0')} AS post_60d_oos_vehicle_signal_present", f"{z('v60')} AS days_past_grace_at_latest_oos_vehicle_signal", f"{f(f'{c60} > 0')} AS post_60d_active_oos_credential_signal_present", f"{z('c60')} AS days_past_grace_at_latest_active_oos_credential_signal",
        f"CASE WHEN {v60} > 0 AND {c60} > 0 THEN {v60} + {c60} ELSE 0 END AS post_60d_combined_title_active_credential_conflict_count", f"{f(f'{v60} > 0 AND {c60} > 0')} AS post_60d_combined_title_active_credential_conflict_present",
        f"{f('m0 > 0')} AS new_meaningful_oos_title_signal_after_move_present", f"{f('m60 > 0')} AS new_meaningful_oos_title_signal_post_60d_present",
        f"{f(f'{vs} OR {cs}')} AS post_60d_prior_state_persistence_any_present", f"{f(f'{vs} AND {cs}')} AS post_60d_prior_state_persistence_cross_source_present",
        "coalesce(strftime(r.proxy, '%Y-%m-%d'), '') AS de_residency_proxy_date", "coalesce(r.prior, '') AS prior_oos_address_state_proxy",
    ]
    return f"""
as_{p} AS (SELECT *, {as_of} AS as_of FROM cand),
all_{p} AS (SELECT e.*, c.as_of, {CLASS} AS sc, CASE WHEN event_dt IS NOT NULL THEN greatest(date_diff('day', event_dt, as_of), 0) END AS age FROM ev e JOIN as_{p} c USING ({K}) {"WHERE phase = 'T0'" if phase == "T0" else ""}),
av_{p} AS (SELECT * FROM all_{p} WHERE (event_dt IS NULL OR event_dt <= as_of) AND (phase <> 'T1' OR observed_dt IS NULL OR observed_dt <= as_of)),
fut_{p} AS (SELECT {K}, count(*) FILTER (event_dt > as_of) AS n FROM all_{p} GROUP BY 1),
line_{p} AS (SELECT {K}, event_dt, CASE WHEN phase = 'T1' THEN 1 ELSE 0 END AS step, source_record_id AS i, sc, upper(trim(state)) AS st FROM av_{p} WHERE src = 'address' AND event_dt IS NOT NULL AND sc <> 'MISSING'
  UNION ALL SELECT {K}, candidate_dt, 2, NULL, CASE WHEN observed_state = 'DE' THEN 'DE' ELSE 'OOS' END, observed_state FROM as_{p} WHERE observed_state <> '' AND candidate_dt <= as_of),
rank_{p} AS (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY event_dt, step, i) AS k FROM line_{p}),
ends_{p} AS (SELECT {K}, max(k) FILTER (sc = 'OOS') AS o, max(k) FILTER (sc = 'DE') AS d, arg_max(st, k) FILTER (sc = 'OOS') AS st FROM rank_{p} GROUP BY 1),
res_{p} AS (SELECT {K}, min(event_dt) AS proxy, count(DISTINCT step) AS sources, coalesce(any_value(e.st), '') AS prior FROM rank_{p} r JOIN ends_{p} e USING ({K}) WHERE d > coalesce(o, 0) AND k > coalesce(o, 0) AND sc = 'DE' GROUP BY 1),
win_{p} AS (SELECT a.*, r.proxy, r.prior, date_diff('day', r.proxy, event_dt) AS since, max(event_dt) FILTER (sc = 'DE') OVER w AS tde, max(event_dt) FILTER (sc = 'OOS') OVER w AS toos,
  CASE WHEN event_dt IS NOT NULL AND sc <> 'MISSING' THEN lag(sc) OVER (PARTITION BY {K}, src, event_dt IS NOT NULL AND sc <> 'MISSING' ORDER BY event_dt, source_record_id) END AS before
  FROM av_{p} a LEFT JOIN res_{p} r USING ({K}) WINDOW w AS (PARTITION BY {K})),
g_{p} AS (SELECT {K}, count(*) AS linked_record_count, {n("sc = 'DE'")} AS de_count_total, {n("sc = 'OOS'")} AS oos_count_total, {n("sc = 'MISSING'")} AS state_missing_count,
  count(DISTINCT state) FILTER (sc = 'OOS') AS distinct_oos_states, count(DISTINCT src) AS source_diversity, {n("sc = 'OOS' AND age > 365")} AS historical_oos_count_over_365d,
  {n("sc = 'OOS' AND event_dt > tde")} AS oos_evidence_after_latest_de_count, {n("sc = 'DE' AND event_dt > toos")} AS de_evidence_after_latest_oos_count,
  {n("before = 'OOS' AND sc = 'DE'")} AS oos_to_de_transition_count, {n("before = 'DE' AND sc = 'OOS'")} AS de_to_oos_transition_count,
  avg(link_confidence) AS link_confidence_mean, min(link_confidence) AS link_confidence_min, {n("link_confidence < 0.93")} AS low, count(link_confidence) AS conf, {n("link_tier = 'C'")} AS tc,
  {n("src = 'address' AND (end_dt IS NULL OR end_dt >= as_of) AND sc = 'DE'")} AS active_address_de_count, {n("src = 'address' AND (end_dt IS NULL OR end_dt >= as_of) AND sc = 'OOS'")} AS active_address_oos_count,
  {n(f"src = 'license' AND {act} AND sc = 'OOS'")} AS active_oos_credential_count, {n(f"src = 'license' AND {act} AND sc = 'DE'")} AS active_de_credential_count, {n("src = 'license' AND credential_status IN ('expired', 'superseded')")} AS expired_or_superseded_credential_count,
  count(DISTINCT nullif(vehicle_ref, '')) FILTER (src = 'title') AS distinct_vehicle_count, {n("src = 'title' AND event_type = 'ownership_change'")} AS ownership_change_count,
  {n("src = 'external' AND evidence_quality = 'limited'")} AS limited_quality_external_count, {n("src = 'external' AND evidence_quality = 'standard'")} AS standard_quality_external_count,
  avg(date_diff('day', event_dt, observed_dt)) FILTER (phase = 'T1') AS t1_update_observation_lag_mean_days, max(date_diff('day', event_dt, observed_dt)) FILTER (phase = 'T1') AS t1_update_observation_lag_max_days,
  {n("phase = 'T1' AND date_diff('day', event_dt, observed_dt) > 30")} AS t1_late_arriving_update_count_over_30d,
  {", ".join(sel)} FROM win_{p} GROUP BY 1),
f_{p} AS (SELECT a.{K}, '{phase}' AS phase, strftime(a.as_of, '%Y-%m-%d') AS as_of_date, {f("observed_state = 'DE'")} AS candidate_observed_is_de, {f("observed_state NOT IN ('', 'DE')")} AS candidate_observed_is_oos,
  coalesce(u.n, 0) AS future_effective_record_count, {", ".join(out)}
  FROM as_{p} a LEFT JOIN g_{p} g USING ({K}) LEFT JOIN res_{p} r USING ({K}) LEFT JOIN fut_{p} u USING ({K}))
"""


UPDATES = f"""
new1 AS (SELECT {K}, count(*) AS new_t1_record_count, count(*) FILTER (sc = 'OOS') AS new_t1_oos_count, count(*) FILTER (sc = 'DE') AS new_t1_de_count, count(*) FILTER (sc = 'MISSING') AS new_t1_state_missing_count,
  count(DISTINCT state) FILTER (sc = 'OOS') AS new_t1_distinct_oos_states, count(DISTINCT source_domain) AS new_t1_source_domain_diversity,
  count(*) FILTER (record_action = 'new_record') AS new_t1_new_record_count, count(*) FILTER (record_action = 'record_correction') AS new_t1_record_correction_count, count(*) FILTER (record_action = 'status_update') AS new_t1_status_update_count
  FROM (SELECT *, {CLASS} AS sc FROM ev, t1cut) WHERE phase = 'T1' AND (event_dt IS NULL OR event_dt <= as_of) AND (observed_dt IS NULL OR observed_dt <= as_of) GROUP BY 1),
eff AS (SELECT {K}, count(*) AS newly_effective_t0_record_count FROM ev JOIN cand USING ({K}), t1cut WHERE phase = 'T0' AND candidate_dt < event_dt AND event_dt <= as_of GROUP BY 1)
"""
NEW = ["new_t1_record_count", "new_t1_oos_count", "new_t1_de_count", "new_t1_state_missing_count", "new_t1_distinct_oos_states", "new_t1_source_domain_diversity", "new_t1_new_record_count", "new_t1_record_correction_count", "new_t1_status_update_count", "newly_effective_t0_record_count"]
DELTA = f"""
dl AS (SELECT c.{K}, {", ".join(f"coalesce({x}, 0) AS {x}" for x in NEW)}, CAST(coalesce(new_t1_record_count, 0) > 0 AS BIGINT) AS t1_has_linked_update,
  {", ".join(f"b.{x} - a.{x} AS delta_{x}" for x in DELTAS)}
  FROM cand c LEFT JOIN new1 USING ({K}) LEFT JOIN eff USING ({K}) JOIN f_t0 a USING ({K}) JOIN f_t1 b USING ({K}))
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(x.strip() for x in (EVIDENCE_SQL, *ctes))
