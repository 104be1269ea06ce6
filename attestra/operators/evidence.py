"""Time-aware features of candidates' evidence, as of a point in time.

Evidence is dealt to candidates once; windows and the wide aggregate that
follow reuse that partitioning, so a phase costs one shuffle of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.config import SOURCES, FeatureRules
from attestra.functions.values import decay, safe_ratio, state_class

KEY = "candidate_record_id"

#: Columns whose change between phases is a feature. Fixed values.
DELTAS = """linked_record_count oos_count_total de_count_total distinct_oos_states days_since_latest_oos days_since_latest_de
source_diversity state_missing_ratio cross_source_conflict_count link_confidence_mean low_confidence_link_share oos_decay_90d de_decay_90d
oos_decay_365d de_decay_365d latest_source_oos_count latest_source_de_count active_address_oos_count recent_latest_source_oos_count_365d
recent_latest_source_de_count_365d historical_latest_source_oos_count recent_cross_source_conflict_count_365d
recency_weighted_latest_source_oos oos_evidence_after_latest_de_count de_evidence_after_latest_oos_count recent_oos_after_latest_de_present
recent_oos_independent_source_count_90d recent_de_independent_source_count_90d recent_oos_cross_source_confirmation_present_90d
active_address_de_count oos_to_de_transition_count de_to_oos_transition_count post_60d_oos_vehicle_signal_count
current_within_60_day_grace_proxy current_past_60_day_grace_proxy days_past_60_day_grace_proxy post_60d_active_oos_credential_signal_count
post_60d_combined_title_active_credential_conflict_present post_60d_prior_state_persistence_any_present
post_60d_prior_state_persistence_cross_source_present new_meaningful_oos_title_signal_post_60d_present
t1_update_observation_lag_mean_days t1_late_arriving_update_count_over_30d""".split()


def t1_as_of(updates: DataFrame) -> DataFrame:
    """The cut-off of the second phase: the latest observed date of the raw feed, one row."""
    return updates.agg(F.max("observed_dt").alias("as_of"))


def as_of_dates(candidates: DataFrame, phase: str, updates: DataFrame) -> DataFrame:
    if phase == "T0":
        return candidates.withColumn("as_of", F.col("candidate_dt"))
    return candidates.crossJoin(F.broadcast(t1_as_of(updates)))  # one row


def gated(candidates: DataFrame, events: DataFrame, phase: str) -> DataFrame:
    """Events of a phase with ``future`` and ``available``; undated events stay available."""
    known = events.where("phase = 'T0'") if phase == "T0" else events
    joined = known.join(candidates.select(KEY, "candidate_dt", "as_of"), KEY)
    future = F.coalesce(F.col("event_dt") > F.col("as_of"), F.lit(False))
    unseen = (F.col("phase") == "T1") & F.coalesce(F.col("observed_dt") > F.col("as_of"), F.lit(False))
    return joined.withColumn("future", future).withColumn("available", ~future & ~unseen)


def available(candidates: DataFrame, events: DataFrame, phase: str, updates: DataFrame) -> DataFrame:
    return gated(as_of_dates(candidates, phase, updates), events, phase).where("available").drop("future", "available")


def _n(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _distinct(value: Column) -> Column:
    return F.size(F.collect_set(value)).cast("long")


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("long")


def derived(rules: FeatureRules) -> dict[str, Column]:
    """Recency, decay and latest-source columns, from a candidate's ``as_of``, counts and latest places (_top_*, _last_*, _known_*, _oos_*, _de_*)."""
    col, days, out = F.col, lambda x: F.date_diff("as_of", x), {}
    known = [col(f"_known_{s}") for s in SOURCES]
    total = lambda xs: sum(xs[1:], xs[0])
    count = lambda f: total([_flag(f(k)) for k in known])
    near, is_oos, is_de = (lambda k: days(k["event_dt"]) <= 365), (lambda k: k["sc"] == "OOS"), (lambda k: k["sc"] == "DE")
    out |= {
        "state_missing_ratio": safe_ratio(col("state_missing_count"), col("linked_record_count")), "oos_share_known_state": safe_ratio(col("oos_count_total"), col("oos_count_total") + col("de_count_total")),
        "days_since_latest_oos": days("_top_oos"), "days_since_latest_de": days("_top_de"),
        "de_after_oos": _flag(col("_top_de") > col("_top_oos")), "oos_after_de": _flag(col("_top_oos") > col("_top_de")),
        "latest_oos_recency_advantage_days": days("_top_de") - days("_top_oos"),
        "historical_oos_only": _flag((col("oos_count_total") > 0) & (col("_top_de") > col("_top_oos")) & (col("oos_count_365d") == 0)),
        "recent_oos_after_latest_de_present": _flag((col("oos_evidence_after_latest_de_count") > 0) & (col("oos_count_365d") > 0)),
        "recent_oos_cross_source_confirmation_present_90d": _flag(col("recent_oos_independent_source_count_90d") >= 2),
    }
    for h in rules.half_lives:
        out[f"oos_decay_share_{h}d"] = safe_ratio(col(f"oos_decay_{h}d"), col(f"oos_decay_{h}d") + col(f"de_decay_{h}d"))
    n_de, n_oos = count(is_de), count(is_oos)
    r_de, r_oos = count(lambda k: is_de(k) & near(k)), count(lambda k: is_oos(k) & near(k))
    out |= {
        "latest_source_de_count": n_de, "latest_source_oos_count": n_oos, "latest_source_oos_share": safe_ratio(n_oos, n_oos + n_de),
        "cross_source_conflict_count": n_de * n_oos, "cross_source_conflict_present": _flag(n_de * n_oos > 0),
        "recent_latest_source_de_count_365d": r_de, "recent_latest_source_oos_count_365d": r_oos, "historical_latest_source_oos_count": n_oos - r_oos,
        "recent_cross_source_conflict_count_365d": r_de * r_oos, "recent_cross_source_conflict_present_365d": _flag(r_de * r_oos > 0),
        "recency_weighted_latest_source_oos": total([F.when(is_oos(k), decay(days(k["event_dt"]), 365)).otherwise(0.0) for k in known]),
    }
    for s in SOURCES:
        last = col(f"_last_{s}")
        out |= {f"{s}_latest_is_de": _flag(last["sc"] == "DE"), f"{s}_latest_is_oos": _flag(last["sc"] == "OOS"), f"days_since_{s}_latest_record": days(last["event_dt"]), f"days_since_{s}_latest_oos": days(col(f"_oos_{s}")), f"days_since_{s}_latest_de": days(col(f"_de_{s}"))}
    return out


def phase_features(candidates: DataFrame, events: DataFrame, phase: str, updates: DataFrame, rules: FeatureRules = FeatureRules()) -> DataFrame:
    """All feature columns of a phase, one row per candidate.

    ``candidates``: candidate_record_id, candidate_dt, observed_state.
    ``events``: the columns of plans.testdata.evidence. Ties of one day go by
    source_record_id. Absent recencies are null.
    """
    home, grace = rules.home_state, rules.grace_days
    cand = as_of_dates(candidates, phase, updates)
    e = gated(cand, events, phase).withColumn("sc", state_class(F.col("state"), home)).withColumn("own", F.lit(False))
    # the candidate's own row ends the residence timeline and counts nowhere else
    me = cand.select(
        KEY, "candidate_dt", "as_of", F.lit("T0").alias("phase"), F.lit("").alias("src"), F.lit(None).cast(events.schema["source_record_id"].dataType).alias("source_record_id"),
        F.col("candidate_dt").alias("event_dt"), F.col("observed_state").alias("state"), state_class(F.col("observed_state"), home).alias("sc"),
        F.lit(False).alias("future"), (F.col("candidate_dt") <= F.col("as_of")).alias("available"), F.lit(True).alias("own"),
    )
    e = e.unionByName(me, allowMissingColumns=True).repartition(KEY)

    live, dated = F.col("available") & ~F.col("own"), F.col("event_dt").isNotNull()
    oos, de = F.col("sc") == "OOS", F.col("sc") == "DE"
    src, age = F.col("src"), F.greatest(F.date_diff("as_of", "event_dt"), F.lit(0))
    line = F.col("available") & (F.col("own") | (src == "address")) & dated & (oos | de)
    step = F.when(F.col("own"), 2).when(F.col("phase") == "T1", 1).otherwise(0)
    place = F.struct(F.col("event_dt").alias("d"), step.alias("s"), F.col("source_record_id").alias("i"))
    w = Window.partitionBy(KEY)
    ordered = Window.partitionBy(KEY, "src", "counts").orderBy("event_dt", "source_record_id")
    e = (
        e.withColumn("counts", live & dated & (oos | de))
        .withColumn("place", place)
        .withColumn("line", line)
        .withColumn("top_oos", F.max(F.when(live & oos, F.col("event_dt"))).over(w))
        .withColumn("top_de", F.max(F.when(live & de, F.col("event_dt"))).over(w))
        .withColumn("line_oos", F.max(F.when(line & oos, F.struct("place", F.upper(F.trim("state")).alias("st")))).over(w))
        .withColumn("line_de", F.max(F.when(line & de, F.col("place"))).over(w))
        .withColumn("before", F.when(F.col("counts"), F.lag("sc").over(ordered)))
    )
    in_run = F.col("line") & de & (F.col("line_oos").isNull() | (F.col("place") > F.col("line_oos.place")))
    resident = F.col("line_de").isNotNull() & (F.col("line_oos").isNull() | (F.col("line_de") > F.col("line_oos.place")))
    e = e.withColumn("proxy", F.min(F.when(resident & in_run, F.col("event_dt"))).over(w)).withColumn("prior", F.when(resident, F.coalesce("line_oos.st", F.lit(""))))
    since = F.date_diff("event_dt", "proxy")

    a: dict[str, Column] = {
        "future_effective_record_count": _n(F.col("future")),
        "linked_record_count": _n(live), "de_count_total": _n(live & de), "oos_count_total": _n(live & oos), "state_missing_count": _n(live & (F.col("sc") == "MISSING")),
        "distinct_oos_states": _distinct(F.when(live & oos, F.col("state"))), "source_diversity": _distinct(F.when(live, src)),
    }
    for label, c in (("oos", oos), ("de", de)):
        for d in rules.windows:
            a[f"{label}_count_{d}d"] = _n(live & dated & c & (age <= d))
    a["historical_oos_count_over_365d"] = _n(live & dated & oos & (age > 365))
    for label, c in (("oos", oos), ("de", de)):
        a[f"_top_{label}"] = F.max(F.when(live & c, F.col("event_dt")))
        a[f"recent_{label}_independent_source_count_90d"] = _distinct(F.when(live & dated & c & (age <= 90), src))
        for h in rules.half_lives:
            a[f"{label}_decay_{h}d"] = F.coalesce(F.sum(F.when(live & dated & c, decay(age, h))), F.lit(0.0))
    a["oos_evidence_after_latest_de_count"] = _n(live & oos & (F.col("event_dt") > F.col("top_de")))
    a["de_evidence_after_latest_oos_count"] = _n(live & de & (F.col("event_dt") > F.col("top_oos")))
    a["oos_to_de_transition_count"] = _n(F.col("counts") & (F.col("before") == "OOS") & de)
    a["de_to_oos_transition_count"] = _n(F.col("counts") & (F.col("before") == "DE") & oos)
    stamp = F.struct("event_dt", "source_record_id", "sc")
    for s in SOURCES:
        mine = live & (src == s)
        a |= {
            f"{s}_record_count": _n(mine), f"{s}_de_count": _n(mine & de), f"{s}_oos_count": _n(mine & oos), f"{s}_state_missing_count": _n(mine & (F.col("sc") == "MISSING")),
            f"_last_{s}": F.max(F.when(mine & dated, stamp)), f"_known_{s}": F.max(F.when(mine & dated & (oos | de), stamp)),
            f"_oos_{s}": F.max(F.when(mine & oos, F.col("event_dt"))), f"_de_{s}": F.max(F.when(mine & de, F.col("event_dt"))),
        }
    conf, title, lic, ext = F.col("link_confidence"), live & (src == "title"), live & (src == "license"), live & (src == "external")
    holds = live & (src == "address") & (F.col("end_dt").isNull() | (F.col("end_dt") >= F.col("as_of")))
    lag = F.when(live & (F.col("phase") == "T1"), F.date_diff("observed_dt", "event_dt"))
    active = F.col("credential_status") == "active"
    a |= {
        "link_confidence_mean": F.avg(F.when(live, conf)), "link_confidence_min": F.min(F.when(live, conf)), "_low": _n(live & (conf < rules.low_confidence)), "_conf": F.count(F.when(live, conf)), "_c": _n(live & (F.col("link_tier") == "C")),
        "active_address_de_count": _n(holds & de), "active_address_oos_count": _n(holds & oos),
        "active_oos_credential_count": _n(lic & active & oos), "active_de_credential_count": _n(lic & active & de), "expired_or_superseded_credential_count": _n(lic & F.col("credential_status").isin("expired", "superseded")),
        "distinct_vehicle_count": _distinct(F.when(title, F.nullif("vehicle_ref", F.lit("")))), "ownership_change_count": _n(title & (F.col("event_type") == "ownership_change")),
        "limited_quality_external_count": _n(ext & (F.col("evidence_quality") == "limited")), "standard_quality_external_count": _n(ext & (F.col("evidence_quality") == "standard")),
        "t1_update_observation_lag_mean_days": F.coalesce(F.avg(lag), F.lit(0.0)), "t1_update_observation_lag_max_days": F.coalesce(F.max(lag), F.lit(0)).cast("long"), "t1_late_arriving_update_count_over_30d": _n(lag > 30),
        "_proxy": F.max("proxy"), "_prior": F.max("prior"),
        "de_residency_proxy_source_count": _distinct(F.when(resident & in_run, step)),
    }
    v, c = title & oos & since.isNotNull(), lic & oos & since.isNotNull()
    past, moved = since > grace, since >= 0
    strong = F.col("event_type").isin("title_record", "ownership_change") | (F.col("record_action") == "new_record")
    same = (F.col("prior") != "") & (F.upper("state") == F.col("prior"))
    a |= {
        "pre_de_proxy_oos_vehicle_signal_count": _n(v & (since < 0)), "within_60d_oos_vehicle_signal_count": _n(v & since.between(0, grace)), "post_60d_oos_vehicle_signal_count": _n(v & past),
        "_v": F.max(F.when(v & past, since - grace)), "within_60d_active_oos_credential_signal_count": _n(c & active & since.between(0, grace)), "post_60d_active_oos_credential_signal_count": _n(c & active & past),
        "_c60": F.max(F.when(c & active & past, since - grace)), "post_60d_oos_credential_update_status_unknown_count": _n(c & (F.col("phase") == "T1") & (F.col("credential_status") == "") & past),
        "post_move_oos_title_record_count": _n(v & moved & (F.col("event_type") == "title_record")), "post_move_oos_ownership_change_count": _n(v & moved & (F.col("event_type") == "ownership_change")),
        "post_move_oos_record_update_count": _n(v & moved & (F.col("event_type") == "record_update")),
        "post_move_oos_t1_title_new_record_count": _n(v & moved & (F.col("record_action") == "new_record")), "post_move_oos_t1_title_status_update_count": _n(v & moved & (F.col("record_action") == "status_update")),
        "post_move_oos_t1_title_correction_count": _n(v & moved & (F.col("record_action") == "record_correction")),
        "new_meaningful_oos_title_signal_after_move_present": F.coalesce(F.bool_or(v & moved & strong), F.lit(False)).cast("long"), "new_meaningful_oos_title_signal_post_60d_present": F.coalesce(F.bool_or(v & past & strong), F.lit(False)).cast("long"),
        "post_move_oos_vehicle_matches_prior_state_count": _n(v & moved & same), "post_60d_oos_vehicle_matches_prior_state_count": _n(v & past & same),
        "post_move_active_credential_matches_prior_state_count": _n(c & active & moved & same), "post_60d_active_credential_matches_prior_state_count": _n(c & active & past & same),
    }
    g = e.groupBy(KEY).agg(F.max("as_of").alias("as_of"), F.max(F.when(F.col("own"), F.col("state"))).alias("_own"), *[x.alias(k) for k, x in a.items()])
    col, days = F.col, lambda x: F.date_diff("as_of", x)

    out: dict[str, Column] = {
        KEY: col(KEY), "phase": F.lit(phase), "as_of_date": F.date_format("as_of", "yyyy-MM-dd"),
        "candidate_observed_is_de": _flag(col("_own") == home), "candidate_observed_is_oos": _flag((col("_own") != "") & (col("_own") != home)),
    }
    names = [k for k in a if not k.startswith("_")]
    out |= {k: col(k) for k in names}
    out |= derived(rules)
    here, since_proxy = col("_proxy").isNotNull(), F.greatest(days("_proxy"), F.lit(0))
    v60, c60 = col("post_60d_oos_vehicle_signal_count"), col("post_60d_active_oos_credential_signal_count")
    vs, cs = col("post_60d_oos_vehicle_matches_prior_state_count") > 0, col("post_60d_active_credential_matches_prior_state_count") > 0
    prior = F.when(here, F.coalesce("_prior", F.lit(""))).otherwise("")
    out |= {
        "low_confidence_link_share": safe_ratio(col("_low"), col("_conf")), "tier_c_link_share": safe_ratio(col("_c"), col("linked_record_count")),
        "active_address_state_conflict": _flag((col("active_address_de_count") > 0) & (col("active_address_oos_count") > 0)),
        "de_residency_proxy_present": _flag(here), "days_since_de_residency_proxy": F.when(here, since_proxy),
        "current_within_60_day_grace_proxy": _flag(here & (since_proxy <= grace)), "current_past_60_day_grace_proxy": _flag(here & (since_proxy > grace)),
        "days_past_60_day_grace_proxy": F.when(here, F.greatest(since_proxy - grace, F.lit(0))).otherwise(0).cast("long"), "prior_oos_address_state_proxy_present": _flag(prior != ""),
        "post_60d_oos_vehicle_signal_present": _flag(v60 > 0), "days_past_grace_at_latest_oos_vehicle_signal": F.coalesce("_v", F.lit(0)).cast("long"),
        "post_60d_active_oos_credential_signal_present": _flag(c60 > 0), "days_past_grace_at_latest_active_oos_credential_signal": F.coalesce("_c60", F.lit(0)).cast("long"),
        "post_60d_combined_title_active_credential_conflict_count": F.when((v60 > 0) & (c60 > 0), v60 + c60).otherwise(0).cast("long"),
        "post_60d_combined_title_active_credential_conflict_present": _flag((v60 > 0) & (c60 > 0)),
        "post_60d_prior_state_persistence_any_present": _flag(vs | cs), "post_60d_prior_state_persistence_cross_source_present": _flag(vs & cs),
        "de_residency_proxy_date": F.coalesce(F.date_format("_proxy", "yyyy-MM-dd"), F.lit("")), "prior_oos_address_state_proxy": prior,
    }
    return g.select(*[x.alias(k) for k, x in out.items()])


def update_aggregates(events: DataFrame, updates: DataFrame) -> DataFrame:
    """What the second phase adds per candidate: counts over the updates that are known at its cut-off."""
    cut = F.broadcast(t1_as_of(updates))  # one row
    u = events.where("phase = 'T1'").crossJoin(cut).where("(event_dt is null or event_dt <= as_of) and (observed_dt is null or observed_dt <= as_of)")
    u = u.withColumn("sc", state_class(F.col("state")))
    act = lambda x: _n(F.col("record_action") == x)
    return u.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("new_t1_record_count"), _n(F.col("sc") == "OOS").alias("new_t1_oos_count"), _n(F.col("sc") == "DE").alias("new_t1_de_count"), _n(F.col("sc") == "MISSING").alias("new_t1_state_missing_count"),
        _distinct(F.when(F.col("sc") == "OOS", F.col("state"))).alias("new_t1_distinct_oos_states"), _distinct(F.col("source_domain")).alias("new_t1_source_domain_diversity"),
        act("new_record").alias("new_t1_new_record_count"), act("record_correction").alias("new_t1_record_correction_count"), act("status_update").alias("new_t1_status_update_count"),
    )


def newly_effective(candidates: DataFrame, events: DataFrame, updates: DataFrame) -> DataFrame:
    """First-phase events whose date lies after the candidate's and not after the second cut-off: an equi-join with two inequalities."""
    cut = F.broadcast(t1_as_of(updates))  # one row
    e = events.where("phase = 'T0'").crossJoin(cut).join(candidates.select(KEY, "candidate_dt"), KEY)
    return e.where("candidate_dt < event_dt and event_dt <= as_of").groupBy(KEY).agg(F.count(F.lit(1)).alias("newly_effective_t0_record_count"))


def delta_features(candidates: DataFrame, events: DataFrame, updates: DataFrame, t0: DataFrame | None = None, t1: DataFrame | None = None) -> DataFrame:
    """One row per candidate: counts of updates, and second minus first phase for each of DELTAS."""
    t0 = phase_features(candidates, events, "T0", updates) if t0 is None else t0
    t1 = phase_features(candidates, events, "T1", updates) if t1 is None else t1
    pair = t1.select(KEY, *DELTAS).join(t0.select(KEY, *[F.col(c).alias(f"{c}__0") for c in DELTAS]), KEY)
    pair = pair.select(KEY, *[(F.col(c) - F.col(f"{c}__0")).alias(f"delta_{c}") for c in DELTAS])
    direct = update_aggregates(events, updates)
    fresh = [c for c in direct.columns if c != KEY] + ["newly_effective_t0_record_count"]
    out = candidates.select(KEY).join(direct, KEY, "left").join(newly_effective(candidates, events, updates), KEY, "left").join(pair, KEY)
    return out.select(KEY, *[F.coalesce(c, F.lit(0)).alias(c) for c in fresh], (F.coalesce("new_t1_record_count", F.lit(0)) > 0).cast("long").alias("t1_has_linked_update"), *[f"delta_{c}" for c in DELTAS])


#: Predictors of the two models, and columns kept for audits only. Fixed values.
T0_PREDICTORS = """linked_record_count source_diversity state_missing_ratio link_confidence_mean oos_share_known_state distinct_oos_states
active_address_oos_count active_address_de_count active_oos_credential_count active_de_credential_count de_count_90d
historical_oos_count_over_365d days_since_latest_oos latest_oos_recency_advantage_days historical_oos_only oos_decay_share_365d
recent_oos_independent_source_count_90d recent_latest_source_oos_count_365d recent_latest_source_de_count_365d
recent_cross_source_conflict_present_365d de_residency_proxy_present days_past_60_day_grace_proxy post_60d_oos_vehicle_signal_count
post_60d_prior_state_persistence_any_present""".split()
T1_PREDICTORS = """new_t1_record_count new_t1_oos_count new_t1_de_count new_t1_state_missing_count new_t1_source_domain_diversity new_t1_new_record_count
new_t1_record_correction_count new_t1_status_update_count newly_effective_t0_record_count delta_days_since_latest_oos
delta_days_since_latest_de delta_oos_decay_90d delta_de_decay_90d delta_recent_oos_independent_source_count_90d
delta_recent_de_independent_source_count_90d delta_active_address_oos_count delta_active_address_de_count delta_link_confidence_mean
delta_post_60d_oos_vehicle_signal_count delta_post_60d_prior_state_persistence_any_present delta_t1_update_observation_lag_mean_days
delta_t1_late_arriving_update_count_over_30d""".split()
T0_AUDIT = """post_60d_active_oos_credential_signal_count post_60d_combined_title_active_credential_conflict_present
new_meaningful_oos_title_signal_post_60d_present""".split()
T1_AUDIT = """delta_post_60d_active_oos_credential_signal_count delta_post_60d_combined_title_active_credential_conflict_present
delta_new_meaningful_oos_title_signal_post_60d_present""".split()


def compact(features: DataFrame, columns: list[str]) -> DataFrame:
    """Projection by manifest; a missing column is an error."""
    if lost := [c for c in columns if c not in features.columns]:
        raise ValueError(f"missing columns: {', '.join(lost)}")
    return features.select(KEY, *columns)
