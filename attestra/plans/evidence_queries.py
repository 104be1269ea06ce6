"""Queries over evidence: scans, the availability gate, features, deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.operators import evidence as ev
from attestra.plans.common import Registry
from attestra.plans.evidence_sql import DELTA, K, UPDATES, features, with_
from attestra.plans.testdata import candidates, evidence

R = Registry()
GROUPS = {
    "evidence_counts": "future_effective_record_count linked_record_count de_count_total oos_count_total state_missing_count state_missing_ratio oos_share_known_state distinct_oos_states source_diversity",
    "recency_windows": "oos_count_30d oos_count_60d oos_count_90d oos_count_180d oos_count_365d de_count_30d de_count_60d de_count_90d de_count_180d de_count_365d historical_oos_count_over_365d",
    "recency_latest": "days_since_latest_oos days_since_latest_de de_after_oos oos_after_de latest_oos_recency_advantage_days historical_oos_only oos_evidence_after_latest_de_count de_evidence_after_latest_oos_count recent_oos_after_latest_de_present recent_oos_independent_source_count_90d recent_de_independent_source_count_90d recent_oos_cross_source_confirmation_present_90d",
    "decay_weights": "oos_decay_90d oos_decay_365d de_decay_90d de_decay_365d oos_decay_share_90d oos_decay_share_365d",
    "transitions": "oos_to_de_transition_count de_to_oos_transition_count",
    "latest_source_conflict": "latest_source_de_count latest_source_oos_count latest_source_oos_share cross_source_conflict_count cross_source_conflict_present recent_latest_source_de_count_365d recent_latest_source_oos_count_365d historical_latest_source_oos_count recent_cross_source_conflict_count_365d recent_cross_source_conflict_present_365d recency_weighted_latest_source_oos",
    "per_source_pivot": " ".join(f"{s}_{x}" for s in ev.SOURCES for x in ("record_count", "de_count", "oos_count", "state_missing_count")),
    "per_source_latest": " ".join(x.format(s=s) for s in ev.SOURCES for x in ("{s}_latest_is_de", "{s}_latest_is_oos", "days_since_{s}_latest_record", "days_since_{s}_latest_oos", "days_since_{s}_latest_de")),
    "link_quality": "link_confidence_mean link_confidence_min low_confidence_link_share tier_c_link_share",
    "active_address": "active_address_de_count active_address_oos_count active_address_state_conflict active_oos_credential_count active_de_credential_count expired_or_superseded_credential_count distinct_vehicle_count ownership_change_count limited_quality_external_count standard_quality_external_count",
    "update_lag": "t1_update_observation_lag_mean_days t1_update_observation_lag_max_days t1_late_arriving_update_count_over_30d",
    "residency_proxy": "de_residency_proxy_present days_since_de_residency_proxy de_residency_proxy_source_count current_within_60_day_grace_proxy current_past_60_day_grace_proxy days_past_60_day_grace_proxy prior_oos_address_state_proxy_present de_residency_proxy_date prior_oos_address_state_proxy",
    "post_move_vehicle": "pre_de_proxy_oos_vehicle_signal_count within_60d_oos_vehicle_signal_count post_60d_oos_vehicle_signal_count post_60d_oos_vehicle_signal_present days_past_grace_at_latest_oos_vehicle_signal post_move_oos_title_record_count post_move_oos_ownership_change_count post_move_oos_record_update_count post_move_oos_t1_title_new_record_count post_move_oos_t1_title_status_update_count post_move_oos_t1_title_correction_count new_meaningful_oos_title_signal_after_move_present new_meaningful_oos_title_signal_post_60d_present",
    "post_move_credential": "within_60d_active_oos_credential_signal_count post_60d_active_oos_credential_signal_count post_60d_active_oos_credential_signal_present days_past_grace_at_latest_active_oos_credential_signal post_60d_oos_credential_update_status_unknown_count post_60d_combined_title_active_credential_conflict_count post_60d_combined_title_active_credential_conflict_present",
    "prior_state_persistence": "post_move_oos_vehicle_matches_prior_state_count post_60d_oos_vehicle_matches_prior_state_count post_move_active_credential_matches_prior_state_count post_60d_active_credential_matches_prior_state_count post_60d_prior_state_persistence_any_present post_60d_prior_state_persistence_cross_source_present",
}


def doubles(columns) -> str:
    """Columns that hold ratios, means and decays."""
    return " ".join(c for c in columns if any(x in c for x in ("ratio", "share", "decay", "_mean_days", "confidence_mean", "confidence_min", "recency_weighted")))


ALL = [c for g in GROUPS.values() for c in g.split()]


def _features(spark, sf_dir, phase):
    e = evidence(spark, sf_dir)
    return ev.phase_features(candidates(spark, sf_dir), e, phase, e.where("phase = 'T1'"))


for _name, _cols in GROUPS.items():
    # groups that need updates are shown at the second phase, others at the first
    _phase = "T1" if _name in ("update_lag", "residency_proxy", "post_move_vehicle", "post_move_credential", "prior_state_persistence", "recency_windows") else "T0"
    R.add(_name, f"{with_(features(_phase))} SELECT {K}, {', '.join(_cols.split())} FROM f_{_phase.lower()}", doubles(_cols.split()))(
        lambda spark, sf_dir, p=_phase, c=_cols: _features(spark, sf_dir, p).select(K, *c.split())
    )


@R.add("features_t0_full", f"{with_(features('T0'))} SELECT * FROM f_t0", doubles(ALL))
def features_t0_full(spark, sf_dir):
    return _features(spark, sf_dir, "T0")


@R.add("features_t1_full", f"{with_(features('T1'))} SELECT * FROM f_t1", doubles(ALL))
def features_t1_full(spark, sf_dir):
    return _features(spark, sf_dir, "T1")


@R.add("deltas_full", f"{with_(features('T0'), features('T1'), UPDATES, DELTA)} SELECT * FROM dl", doubles(f"delta_{c}" for c in ev.DELTAS))
def deltas_full(spark, sf_dir):
    e = evidence(spark, sf_dir)
    return ev.delta_features(candidates(spark, sf_dir), e, e.where("phase = 'T1'"))


@R.add("new_update_counts", f"{with_(UPDATES)} SELECT * FROM new1")
def new_update_counts(spark, sf_dir):
    e = evidence(spark, sf_dir)
    return ev.update_aggregates(e, e.where("phase = 'T1'"))


@R.add("newly_effective", f"{with_(UPDATES)} SELECT * FROM eff")
def newly_effective(spark, sf_dir):
    e = evidence(spark, sf_dir)
    return ev.newly_effective(candidates(spark, sf_dir), e, e.where("phase = 'T1'"))


def _availability(phase):
    def run(spark, sf_dir):
        e = evidence(spark, sf_dir)
        out = ev.available(candidates(spark, sf_dir), e, phase, e.where("phase = 'T1'"))
        return out.select(K, "source_record_id", "phase", "src", F.date_format("event_dt", "yyyy-MM-dd").alias("event_date"), "state")

    p = phase.lower()
    R.add(f"availability_asof_{p}", f"{with_(features(phase))} SELECT {K}, source_record_id, phase, src, strftime(event_dt, '%Y-%m-%d') AS event_date, state FROM av_{p}")(run)


_availability("T0")
_availability("T1")


@R.add("future_effective_count", f"{with_(features('T0'))} SELECT {K}, future_effective_record_count FROM f_t0 WHERE future_effective_record_count > 0")
def future_effective_count(spark, sf_dir):
    e = evidence(spark, sf_dir)
    g = ev.gated(ev.as_of_dates(candidates(spark, sf_dir), "T0", e.where("phase = 'T1'")), e, "T0")
    return g.where("future").groupBy(K).agg(F.count(F.lit(1)).alias("future_effective_record_count"))


QUERIES, ORACLES = R.queries, R.oracles
