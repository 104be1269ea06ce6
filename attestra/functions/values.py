"""Scalar rules: state classes, sources, bands, probabilities."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestra.config import CLASSES, HOME_STATE, SOURCES

#: State names that a search understands. Fixed values.
STATES = {
    "delaware": "DE", "pennsylvania": "PA", "maryland": "MD", "new jersey": "NJ",
    "virginia": "VA", "new york": "NY", "ohio": "OH", "west virginia": "WV",
    "north carolina": "NC", "florida": "FL", "texas": "TX", "district of columbia": "DC",
}
#: Raw sources of the first snapshot. Fixed values.
RAW_SOURCES = {
    "address_history": "address", "license_id_events": "license", "vehicle_title_events": "title", "external_context_signals": "external", "work_location_signals": "work",
}


def state_class(state: Column, home: str = HOME_STATE) -> Column:
    s = F.upper(F.trim(F.coalesce(state, F.lit(""))))
    return F.when(s.isin("", "NAN"), "MISSING").when(s == home, "DE").otherwise("OOS")


def canonical_source(phase: Column, source: Column, domain: Column) -> Column:
    """T0 rows by their table, which keeps its name if it is not known; T1 rows by their domain, external if it is not known."""
    names = F.create_map(*[F.lit(x) for kv in RAW_SOURCES.items() for x in kv])
    known = F.when(F.lower(F.trim(domain)).isin(*SOURCES), F.lower(F.trim(domain)))
    return F.when(phase == "T1", F.coalesce(known, F.lit("external"))).otherwise(F.coalesce(F.try_element_at(names, source), source))


def safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def decay(age: Column, half_life: int) -> Column:
    return F.exp(F.lit(-math.log(2)) * age / F.lit(float(half_life)))


def priority_band(p: Column) -> Column:
    return F.when(p >= 0.85, "critical").when(p >= 0.70, "high").when(p >= 0.40, "medium").otherwise("low")


def argmax_class(p: list[Column]) -> Column:
    """The class of the greatest probability, the first one on ties."""
    out = F.lit(CLASSES[-1])
    for k in range(len(p) - 2, -1, -1):
        ahead = p[k] >= F.greatest(*p[k + 1 :]) if len(p) - k > 2 else p[k] >= p[k + 1]
        out = F.when(ahead, CLASSES[k]).otherwise(out)
    return out


def tempered(p: list[Column], t: float | Column, floor: float = 1e-12) -> list[Column]:
    """Clip, log, divide by the temperature, softmax."""
    clipped = [F.greatest(F.least(x, F.lit(1.0)), F.lit(floor)) for x in p]
    total = sum(clipped[1:], clipped[0])
    logs = [F.log(x / total) / (t if isinstance(t, Column) else F.lit(float(t))) for x in clipped]
    top = F.greatest(*logs)
    e = [F.exp(x - top) for x in logs]
    z = sum(e[1:], e[0])
    return [x / z for x in e]


def entropy(p: list[Column]) -> Column:
    """Shannon entropy over ln n, so 0 to 1."""
    terms = [F.when(x > 0, -x * F.log(x)).otherwise(0.0) for x in p]
    return sum(terms[1:], terms[0]) / F.lit(math.log(len(p)))


#: Groups of updates, and the weight of the second phase in each. Fixed values.
GROUPS = {"meaningful_new_evidence": 1.0, "weak_minor_update": 0.5, "effectively_no_meaningful_update": 0.0}


def evidence_group(records: Column, known: Column, domains: Column, effective: Column, grace_changed: Column) -> Column:
    """How much an update feed says about a candidate."""
    strong, weak, none = GROUPS
    return F.when((known > 0) | (domains >= 2) | (effective > 0) | grace_changed, strong).when(records > 0, weak).otherwise(none)


def anchor_weight(group: Column) -> Column:
    strong, weak, _ = GROUPS
    return F.when(group == strong, GROUPS[strong]).when(group == weak, GROUPS[weak]).otherwise(0.0)


def strength(n: Column, avg_confidence: Column) -> Column:
    score = n * 0.5 + avg_confidence * 5
    return F.when(score >= 12, "Strong").when(score >= 6, "Moderate").otherwise("Weak")


def relative_age(days: Column) -> Column:
    return (
        F.when(days < 0, "in the future").when(days == 0, "today")
        .when(days < 30, F.concat(days.cast("string"), F.lit("d ago")))
        .when(days < 365, F.concat(F.floor(days / 30).cast("string"), F.lit("mo ago")))
        .otherwise(F.concat(F.floor(days / 365).cast("string"), F.lit("y ago")))
    )
