"""What the feature columns mean: descriptions as column metadata, and a dictionary table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of column names, for people.
WORDS = {
    "oos": "out-of-state", "de": "Delaware", "t0": "first-phase", "t1": "second-phase", "60d": "60-day", "30d": "last 30 days", "90d": "last 90 days", "180d": "last 180 days", "365d": "last 365 days",
    "proxy": "proxy (not a legal date)", "ratio": "ratio", "share": "share",
}
IDENTITY = ("candidate_record_id", "phase", "as_of_date", "de_residency_proxy_date", "prior_oos_address_state_proxy")


def describe(column: str) -> str:
    """A sentence for a column, from the parts of its name."""
    if column in IDENTITY:
        return f"{column.replace('_', ' ').capitalize()}; metadata, never a predictor."
    if column.startswith("delta_"):
        return f"Second-phase value minus first-phase value: {describe(column.removeprefix('delta_'))}"
    words = [WORDS.get(w, w) for w in column.split("_")]
    text = " ".join(words)
    kind = "Whether it holds (1 or 0)" if column.endswith("_present") else "Whole days" if column.startswith("days_") else "Records" if column.endswith("_count") else "Value"
    origin = " Second-phase updates only." if column.startswith("new_t1_") else ""
    return f"{kind}: {text}.{origin}"


def references(column: str, vehicle: list[str], credential: list[str]) -> list[str]:
    """Which legal pages a column's window rests on: those of vehicles, of credentials, both, or none."""
    base = column.removeprefix("delta_")
    has_vehicle, has_credential = bool(re.search("vehicle|title", base)), "credential" in base
    if (has_vehicle and has_credential) or re.search("prior_state_persistence|60_day_grace|de_residency_proxy", base):
        return [*vehicle, *credential]
    if "60" not in base:
        return []
    return vehicle if has_vehicle else credential if has_credential else []


def described(df: DataFrame) -> DataFrame:
    """The same table with a description in each column's metadata, which Parquet keeps."""
    return df.select([F.col(f"`{c}`").alias(c, metadata={"description": describe(c)}) for c in df.columns])


def dictionary(df: DataFrame, groups: dict[str, list[str]], reasons: dict[str, str] | None = None, vehicle: list[str] | None = None, credential: list[str] | None = None) -> DataFrame:
    """A row per column: type, description, what it is used for, why it was chosen, references.

    ``groups``: columns by use, as compact_model_predictor or audit_only_review_signal; others are metadata.
    """
    use = {c: g for g, cs in groups.items() for c in cs}
    rows = [(f.name, f.dataType.simpleString(), describe(f.name), use.get(f.name, "metadata"), (reasons or {}).get(f.name, ""), "; ".join(references(f.name, vehicle or [], credential or []))) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, description string, model_use string, selection_reason string, source_urls string")
