"""Rules of linkage, features, models and reports, as immutable values."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from hashlib import sha256

HOME_STATE = "DE"
CLASSES = ("review_warranted", "review_not_warranted", "insufficient_evidence")
SOURCES = ("address", "license", "title", "external", "work")


@dataclass(frozen=True)
class LinkageRules:
    """Thresholds and confidences of the linkage tiers. Fixed values."""

    version: str = "1.1.0"
    first_weight: float = 0.45
    last_weight: float = 0.55
    dob_combined: float = 0.88
    dob_first: float = 0.75
    dob_last: float = 0.88
    dob_margin: float = 0.05
    unique_combined: float = 0.78
    unique_first: float = 0.65
    unique_last: float = 0.75
    shared_address_combined: float = 0.90
    shared_address_margin: float = 0.08
    name_combined: float = 0.95
    name_each: float = 0.90
    name_margin: float = 0.06
    vehicle_noncontradiction: float = 0.72
    bridge_confidence: float = 0.95
    bridge_combined: float = 0.90
    bridge_each: float = 0.90
    bridge_margin: float = 0.02
    alias_confidence: float = 0.95
    fuzzy_length: int = 3
    exact_dob_score: float = 0.995
    fuzzy_dob_score: float = 0.975
    unique_dob_score: float = 0.955
    exact_address_score: float = 0.965
    shared_address_score: float = 0.945
    alias_score: float = 0.955
    exact_name_score: float = 0.935
    fuzzy_name_score: float = 0.885
    vehicle_score: float = 0.990
    bridge_score: float = 0.970
    transposition: str = "half"


#: Why a method leaves a row open. Fixed values.
REASONS = {
    "missing_name": "missing_first_or_last_name",
    "dob_anchor_unavailable": "missing_or_unmatched_dob",
    "dob_name_conflict": "dob_matches_but_name_is_weak_or_ambiguous",
    "address_anchor_unavailable": "missing_or_unmatched_address",
    "address_name_conflict": "address_matches_but_name_is_weak_or_ambiguous",
    "ambiguous_verified_alias": "same_verified_alias_points_to_multiple_candidates",
    "ambiguous_exact_full_name": "exact_full_name_is_not_unique",
    "short_name_not_fuzzy_matched": "name_too_short_for_safe_fuzzy_linkage",
    "no_name_block": "no_candidate_in_name_block",
    "weak_or_ambiguous_fuzzy_name": "fuzzy_name_below_strength_or_margin_threshold",
    "ambiguous_vehicle_ownership": "vehicle_ref_is_linked_to_multiple_candidates",
    "vehicle_name_conflict": "vehicle_anchor_and_name_link_point_to_different_candidates",
    "vehicle_name_noncontradiction_failed": "vehicle_ref_matches_but_owner_name_is_contradictory",
}


@dataclass(frozen=True)
class SourceSpec:
    """Where a source is, and which of its columns has which role; '' where none has."""

    path: str
    phase: str = "T0"
    first: str = "first_name"
    last: str = "last_name"
    state: str = "state"
    event_date: str = "event_date"
    observed_date: str = ""
    vehicle_ref: str = ""


#: The sources of a run. Fixed values.
SOURCE_SPECS = {
    "address_history": SourceSpec("Data_T0/address_history.csv", event_date="effective_start_date"),
    "license_id_events": SourceSpec("Data_T0/license_id_events.csv", state="credential_state"),
    "external_context_signals": SourceSpec("Data_T0/external_context_signals.csv", state="signal_state", event_date="effective_date"),
    "vehicle_title_events": SourceSpec("Data_T0/vehicle_title_events.csv", first="owner_first_name", last="owner_last_name", state="event_state", vehicle_ref="vehicle_ref"),
    "work_location_signals": SourceSpec("Data_T0/work_location_signals.csv", state="work_state", event_date="observed_date", observed_date="observed_date"),
    "evidence_update_stream": SourceSpec("Data_T1/evidence_update_stream.csv", phase="T1", event_date="effective_date", observed_date="observed_date", vehicle_ref="vehicle_ref"),
}


@dataclass(frozen=True)
class FeatureRules:
    """Windows and limits of the features. Fixed values."""

    windows: tuple[int, ...] = (30, 60, 90, 180, 365)
    half_lives: tuple[int, ...] = (90, 365)
    low_confidence: float = 0.93
    grace_days: int = 60
    home_state: str = HOME_STATE


@dataclass(frozen=True)
class MetricRules:
    """Limits of the reports. Fixed values."""

    top_fractions: tuple[float, ...] = (0.1, 0.2)
    bins: int = 10
    bootstrap: int = 2000
    ks_limit: float = 0.2
    smd_limit: float = 0.5
    missing_limit: float = 0.1


def fingerprint(rules: object) -> str:
    """SHA-256 of a rule set's canonical JSON."""
    return sha256(json.dumps(asdict(rules), sort_keys=True).encode()).hexdigest()
