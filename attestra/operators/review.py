"""The review layer: case views, queues, search, tags, audit, explanations, validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.config import CLASSES, HOME_STATE, SOURCES
from attestra.functions.values import STATES, argmax_class, priority_band, strength

#: How the review layer calls classes and sources. Fixed values.
CLASS_NAMES = {"review_warranted": "review_warranted", "review_not_warranted": "review_not_warranted", "insufficient_evidence": "insufficient_information"}
KINDS = {"license": "credential", "address": "address", "title": "vehicle_title", "work": "work", "external": "external"}
BANDS = ("critical", "high", "medium", "low")
CHANGES = ("warranted_to_not", "not_to_warranted", "ii_to_warranted", "ii_to_not", "to_ii", "no_change")


def mapped(value: Column, names: dict[str, str], back: bool = False) -> Column:
    """A value under its other name, as it is where it has none."""
    pairs = [(b, a) if back else (a, b) for a, b in names.items()]
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs for x in kv]), value), value)


def with_prediction(cases: DataFrame, p: tuple[str, str, str], prefix: str) -> DataFrame:
    cols = [F.col(c) for c in p]
    return cases.withColumn(f"{prefix}_class", argmax_class(cols)).withColumn(f"{prefix}_confidence", F.greatest(*cols)).withColumn(f"{prefix}_priority", cols[0])


def known_state(state: Column) -> Column:
    return F.when(F.trim(F.coalesce(state, F.lit(""))) == "", "UNK").otherwise(state)


def evidence_profile(cases: DataFrame, evidence: DataFrame, key: str = "candidate_record_id") -> DataFrame:
    """Counts, strength, recency, main state and explanations of each case's evidence, cases without any included.

    A blank state is UNK: it counts as a state, but not as the main one. Of
    equally frequent states the smaller one is main. The texts and limits are
    fixed values.
    """
    e = evidence.where(F.col("src").isin(*SOURCES)).withColumn("state", known_state(F.col("state")))
    src, home = F.col("src"), F.col("state") == HOME_STATE
    other = (src == "address") & ~home
    states = lambda c: F.collect_set(F.when(c, F.col("state")))
    g = e.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.coalesce("link_confidence", F.lit(0.0))).alias("avg_confidence"), F.max(F.coalesce("event_dt", "observed_dt")).alias("latest"), F.count_if(F.col("phase") == "T1").alias("recent"),
        F.count_if((src == "license") & home).alias("de_credentials"), F.count_if(other).alias("other_addresses"), states(src == "title").alias("title_states"), states(src == "address").alias("address_states"), states(F.lit(True)).alias("states"),
        *[F.count_if(src == x).alias(f"n_{x}") for x in SOURCES],
    )
    by_state = e.groupBy(key, "state").agg(F.count(F.lit(1)).alias("m"), F.count_if(other).alias("o"))
    first = lambda n, c: F.min(F.when(c, F.struct((-F.col(n)).alias("n"), F.col("state").alias("v"))))["v"]
    top = by_state.groupBy(key).agg(first("m", F.col("state") != "UNK").alias("top_state"), first("o", F.col("o") > 0).alias("other_state"))
    counts = ["n", "recent", "de_credentials", "other_addresses", *[f"n_{x}" for x in SOURCES]]
    c = cases.join(g, key, "left").join(top, key, "left").na.fill(0, counts).na.fill(0.0, ["avg_confidence"])
    none = F.array().cast("array<string>")
    size = lambda x: F.size(F.coalesce(x, none))
    plural = F.when(F.col("de_credentials") > 1, "s").otherwise("")
    said = F.array_compact(F.array(
        F.when(F.col("de_credentials") > 0, F.concat(F.lit("Recent Delaware credential evidence detected ("), F.col("de_credentials").cast("string"), F.lit(" record"), plural, F.lit(")"))),
        F.when(F.col("other_addresses") >= 2, F.concat(F.lit("Multiple non-Delaware address records identified (primary: "), F.col("other_state"), F.lit(")"))),
        F.when((size("title_states") > 0) & (size("address_states") > 0) & ~F.arrays_overlap("title_states", "address_states"), "Vehicle title evidence conflicts with current address"),
        F.when(size("states") >= 4, "Evidence across sources is inconsistent"),
        F.when(F.col("n") < 4, "Limited recent evidence is available"),
    ))
    quiet = F.when(F.col("t1_class") == CLASSES[2], "Signal spread across weak sources — no strong indicator").otherwise("Model signals within historical baseline for this candidate profile")
    older = F.col("n") - F.col("recent")
    return c.select(
        *cases.columns, F.col("n").alias("total_records"), *[f"n_{x}" for x in SOURCES], strength(F.col("n"), F.col("avg_confidence")).alias("evidence_strength"),
        F.when(F.col("recent") > older, "Recent").when(older > 2 * F.greatest(F.col("recent"), F.lit(1)), "Stale").otherwise("Mixed").alias("evidence_recency"),
        F.col("recent").alias("new_evidence_count"), F.date_format("latest", "yyyy-MM-dd").alias("latest_evidence_date"), F.coalesce("top_state", F.lit("UNK")).alias("primary_state"),
        F.when(F.col("t0_class") == F.col("t1_class"), "Agree").otherwise("Disagree").alias("agreement"), F.when(F.size(said) > 0, said).otherwise(F.array(quiet)).alias("explanations"),
    )


def change_kind(before: Column, after: Column) -> Column:
    w, n, i = CLASSES
    return (
        F.when(before == after, "no_change").when((before == w) & (after == n), "warranted_to_not").when((before == n) & (after == w), "not_to_warranted")
        .when((before == i) & (after == w), "ii_to_warranted").when((before == i) & (after == n), "ii_to_not").otherwise("to_ii")
    )


def dashboard(cases: DataFrame, phase: str = "t1") -> DataFrame:
    """Counts by section and key, one pass over the cases: (section, key, value).

    Classes, bands, histograms of priority and confidence, changes, coverage by
    source and strength have all of their keys, zeros included; states are the
    eight most frequent; the mean confidence is over all cases.
    """
    own = lambda c: F.col(f"{phase}_{c}")
    tenth = lambda c: F.least(F.floor(c * 10), F.lit(9)).cast("string")
    pair = lambda name, key: F.struct(F.lit(name).alias("section"), key.cast("string").alias("key"))
    seen = F.array(
        pair("class", own("class")), pair("band", priority_band(own("priority"))), pair("priority_bin", tenth(own("priority"))), pair("confidence_bin", tenth(own("confidence"))),
        pair("change", change_kind(F.coalesce("t0_class", own("class")), own("class"))), pair("strength", F.col("evidence_strength")), *[F.when(F.col(f"n_{x}") > 0, pair("coverage", F.lit(x))) for x in SOURCES],
    )
    with_one = cases.where(own("class").isNotNull())
    counted = with_one.select(F.explode(F.array_compact(seen)).alias("x")).groupBy("x.section", "x.key").agg(F.count(F.lit(1)).alias("n"))
    keys = {"class": CLASSES, "band": BANDS, "priority_bin": range(10), "confidence_bin": range(10), "change": CHANGES, "strength": ("Strong", "Moderate", "Weak"), "coverage": SOURCES}
    every = cases.sparkSession.createDataFrame([(k, str(v)) for k, vs in keys.items() for v in vs], "section string, key string")
    fixed = every.join(counted, ["section", "key"], "left").select("section", "key", F.coalesce("n", F.lit(0)).cast("double").alias("value"))
    top = with_one.groupBy(F.col("primary_state").alias("key")).agg(F.count(F.lit(1)).cast("double").alias("value")).orderBy(F.desc("value"), "key").limit(8).select(F.lit("state").alias("section"), "key", "value")
    one = cases.agg(F.count(F.lit(1)).cast("double").alias("total"), F.coalesce(F.bround(F.try_divide(F.sum(own("confidence")), F.count(F.lit(1))), 3), F.lit(0.0)).alias("avg_confidence"))
    return fixed.unionByName(top).unionByName(one.unpivot([], ["total", "avg_confidence"], "key", "value").select(F.lit("overall").alias("section"), "key", "value"))


def data_status(cases: DataFrame, evidence: DataFrame, expected_rows: int = 0) -> tuple[DataFrame, list[str]]:
    """What is loaded, as (section, key, n), and warnings where rows are missing or phases differ."""
    has = lambda p: F.col(f"{p}_class").isNotNull()
    one = cases.agg(F.count(F.lit(1)).alias("unique_candidates"), F.count_if(has("t0")).alias("t0_records"), F.count_if(has("t1")).alias("t1_records")).withColumn("total_prediction_rows", F.col("t0_records") + F.col("t1_records"))
    seen = evidence.join(cases.select("candidate_record_id"), "candidate_record_id", "left_semi").where(F.col("src").isin(*SOURCES)).agg(F.count(F.lit(1)).alias("n"))
    counts = one.unpivot([], one.columns, "key", "n").unionByName(seen.select(F.lit("evidence_records").alias("key"), "n")).select(F.lit("rows").alias("section"), "key", "n")
    by = [cases.where(has(p)).groupBy(mapped(F.col(f"{p}_class"), CLASS_NAMES).alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"class_{p}").alias("section"), "key", "n") for p in ("t0", "t1")]
    out = reduce(DataFrame.unionByName, [counts, *by])
    row = one.first()
    warnings = []
    if expected_rows and row["total_prediction_rows"] != expected_rows:
        warnings.append(f"Dataset validation issue: only {row['total_prediction_rows']} of {expected_rows} expected rows were loaded.")
    if row["unique_candidates"] != row["t0_records"] or row["unique_candidates"] != row["t1_records"]:
        warnings.append(f"Phase mismatch: {row['t0_records']} T0 records, {row['t1_records']} T1 records, {row['unique_candidates']} candidates.")
    return out, warnings


def phase_view(cases: DataFrame, phase: str = "t1") -> DataFrame:
    """Cases with one phase's prediction as predicted_class, confidence and review_priority; cases without one go."""
    own = cases.where(F.col(f"{phase}_class").isNotNull())
    return own.select("*", F.lit(phase.upper()).alias("phase"), F.col(f"{phase}_class").alias("predicted_class"), F.col(f"{phase}_confidence").alias("confidence"), F.col(f"{phase}_priority").alias("review_priority"))


def case_filter(cases: DataFrame, q: str | None = None, predicted: str = "all", band: str = "all", status: str = "all", tag: str = "all", strong: str = "all", phase: str = "t1", key: str = "candidate_record_id") -> DataFrame:
    """A phase's cases that pass all filters. None and 'all' mean no filter; ``q`` is looked for in the id."""
    preds = [F.lower(F.col(key).cast("string")).contains(q.lower())] if q else []
    for value, c in ((predicted, "predicted_class"), (status, "reviewer_status"), (strong, "evidence_strength")):
        if value not in (None, "all", ""):
            preds.append(F.col(c) == value)
    if band not in (None, "all", ""):
        preds.append(priority_band(F.col("review_priority")) == band)
    if tag not in (None, "all", ""):
        preds.append(F.array_contains("reviewer_tags", tag))
    out = phase_view(cases, phase)
    return out.where(reduce(lambda a, b: a & b, preds)) if preds else out


def case_list(cases: DataFrame, sort: str = "review_priority", descending: bool = True, skip: int = 0, limit: int = 0, key: str = "candidate_record_id", **filters) -> DataFrame:
    """A page of the queue, each row with the ``total`` of all pages. Limit 0 means all rows.

    Nulls come last upwards and first downwards; ties go by key.
    """
    found = case_filter(cases, key=key, **filters)
    c = F.col(sort)
    out = found.crossJoin(F.broadcast(found.agg(F.count(F.lit(1)).alias("total"))))  # one row
    out = out.orderBy(c.desc_nulls_first() if descending else c.asc_nulls_last(), key)
    out = out.offset(skip) if skip else out
    return out.limit(limit) if limit else out


def both_phases(cases: DataFrame, sort: str = "review_priority", descending: bool = True, skip: int = 0, limit: int = 0, key: str = "candidate_record_id", **filters) -> DataFrame:
    """A page of each phase, sorted as one list; ``total`` is that of both."""
    pages = [case_list(cases, sort, descending, skip, limit, key, phase=p, **filters) for p in ("t0", "t1")]
    total = reduce(DataFrame.unionByName, [case_filter(cases, key=key, phase=p, **filters).agg(F.count(F.lit(1)).alias("total")) for p in ("t0", "t1")]).agg(F.sum("total").alias("total"))
    out = pages[0].drop("total").unionByName(pages[1].drop("total")).crossJoin(F.broadcast(total))  # one row
    c = F.col(sort)
    return out.orderBy(c.desc_nulls_first() if descending else c.asc_nulls_last(), key, "phase")


def page_count(total: Column, per_page: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(total / per_page))


def category_summary(cases: DataFrame, predicted: str, most: int = 5, phase: str = "t1", key: str = "candidate_record_id") -> DataFrame:
    """Of a class: how many cases, their mean priority and confidence, and the ids that come first."""
    own = case_filter(cases, predicted=predicted, phase=phase, key=key)
    means = own.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.avg("review_priority"), F.lit(0.0)).alias("avg_priority"), F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("avg_confidence"))
    top = own.orderBy(F.desc("review_priority"), key).limit(most).agg(F.array_sort(F.collect_list(F.struct((-F.col("review_priority")).alias("p"), F.col(key).alias("id")))).alias("t"))
    return means.crossJoin(top.select(F.transform("t", lambda x: x["id"]).alias("top")))  # single rows


def field_change(kind: str, direction: str, before: Column, after: Column) -> Column:
    """How a field moved between phases: unchanged, escalate, resolve, up, down or change."""
    if kind == "bool":
        moved = F.when(before & ~after, "escalate").when(~before & after, "resolve") if direction == "escalate_when_false" else F.lit(None).cast("string")
        return F.when(before.eqNullSafe(after), "unchanged").otherwise(F.coalesce(moved, F.lit("change")))
    if kind == "str" or direction == "categorical":
        return F.when(before.eqNullSafe(after), "unchanged").otherwise("change")
    up, down = ("escalate", "resolve") if direction == "escalate_up" else ("up", "down")
    return F.when(before.eqNullSafe(after), "unchanged").when(after > before, up).otherwise(down)


def field_label(name: Column) -> Column:
    """A column's name for people: blanks, DE in capitals, then only the first letter."""
    text = F.replace(F.replace(name, F.lit("_"), F.lit(" ")), F.lit("de"), F.lit("DE"))
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, 2, 1 << 30)))


def snippet(state: Column, event_type: Column, record_id: Column) -> Column:
    """A record in a few words."""
    blank = lambda x: F.nullif(F.coalesce(x.cast("string"), F.lit("")), F.lit(""))
    return F.concat_ws(" · ", F.when(state == HOME_STATE, "Delaware").otherwise(blank(state)), F.replace(blank(event_type), F.lit("_"), F.lit(" ")), blank(record_id))


def highlighted(text: Column, query: str, left: str = "[", right: str = "]") -> Column:
    """The text with each match of two letters or more marked, whatever its case."""
    if len(query) < 2:
        return text
    quoted = "".join(f"\\{c}" if not c.isalnum() and not c.isspace() else c for c in query)
    return F.regexp_replace(text, f"(?iu)({quoted})", f"\\{left}$1\\{right}")


def latest_state(log: DataFrame, key: str = "candidate_id") -> DataFrame:
    """The newest row per key of an append-only log: what an upsert would hold."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("last_updated", "seq")).alias("s")).select(key, *[F.col(f"s.{c}").alias(c) for c in rest])


def with_state(cases: DataFrame, state: DataFrame, key: str = "candidate_record_id") -> DataFrame:
    s = state.withColumnRenamed("candidate_id", key).select(key, "reviewer_status", "reviewer_tags")
    return cases.join(s, key, "left").withColumn("reviewer_status", F.coalesce("reviewer_status", F.lit("unreviewed"))).withColumn("reviewer_tags", F.coalesce("reviewer_tags", F.array().cast("array<string>")))


def add_tag(state: DataFrame, tag: str) -> DataFrame:
    """A tag on every row that hasn't got it; blanks around it go."""
    tag = tag.strip()
    if not tag:
        raise ValueError("the tag is empty")
    return state.withColumn("reviewer_tags", F.array_union("reviewer_tags", F.array(F.lit(tag))))


def remove_tag(state: DataFrame, tag: str) -> DataFrame:
    return state.withColumn("reviewer_tags", F.array_remove("reviewer_tags", tag))


def bulk_tag(cases: DataFrame, state: DataFrame, ids: DataFrame, tag: str, key: str = "candidate_record_id") -> tuple[DataFrame, DataFrame]:
    """New states of the ids that are cases, with the tag, and the one audit row of it. ``ids`` has ``key``; without a case in it ValueError is raised."""
    own = ids.select(key).distinct().join(cases.select(key), key, "left_semi")
    held = own.join(state.withColumnRenamed("candidate_id", key), key, "left").withColumn("reviewer_status", F.coalesce("reviewer_status", F.lit("unreviewed")))
    held = add_tag(held.withColumn("reviewer_tags", F.coalesce("reviewer_tags", F.array().cast("array<string>"))), tag)
    n, tag = own.count(), tag.strip()
    if not n:
        raise ValueError("no id is a case")
    entry = audit_rows(cases.sparkSession.range(1), F.lit("BULK"), F.lit(f"bulk_tag_add:{tag}"), F.lit("-"), F.lit(f"tagged_{n}"), F.lit(f"Bulk added tag '{tag}' to {n} candidates"), F.struct(F.lit(tag).alias("tag"), F.lit(n).alias("count")))
    return held.withColumn("last_updated", F.current_timestamp()).withColumnRenamed(key, "candidate_id"), entry


def audit_rows(df: DataFrame, who: Column, action: Column, before: Column, after: Column, notes: Column, snapshot: Column, reviewer: str = "analyst_demo", model_version: str = "") -> DataFrame:
    """Audit entries of a change, one for each row of ``df``; times are UTC in ISO form and in the id."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    stamp = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyyMMdd_HHmmss")
    return df.select(
        F.concat_ws("-", who.cast("string"), stamp).alias("id"), who.cast("string").alias("candidate_id"), F.lit(model_version).alias("model_version"), action.alias("action"), F.lit(reviewer).alias("reviewer_id"),
        before.alias("from_status"), after.alias("to_status"), notes.alias("notes"), now.alias("timestamp"), F.to_json(snapshot).alias("snapshot"),
    )


def decided(cases: DataFrame, state: DataFrame, decisions: DataFrame, key: str = "candidate_record_id") -> tuple[DataFrame, DataFrame]:
    """Reviewers' decisions (key, reviewer_status, reviewer_notes): the new states, which keep their tags, and audit entries with what was known of the case."""
    d = decisions.join(cases, key).join(state.select(F.col("candidate_id").alias(key), F.col("reviewer_status").alias("_before"), "reviewer_tags"), key, "left")
    notes = F.coalesce("reviewer_notes", F.lit(""))
    known = F.struct(F.col("t1_class").alias("predicted_class"), F.col("t1_priority").alias("review_priority"), F.col("t1_confidence").alias("confidence"), "evidence_strength", F.struct(*[F.col(f"n_{x}").alias(KINDS[x]) for x in SOURCES]).alias("evidence_summary"))
    new = d.select(F.col(key).alias("candidate_id"), "reviewer_status", notes.alias("reviewer_notes"), F.coalesce("reviewer_tags", F.array().cast("array<string>")).alias("reviewer_tags"), F.current_timestamp().alias("last_updated"))
    return new, audit_rows(d, F.col(key), F.col("reviewer_status"), F.coalesce("_before", F.lit("unreviewed")), F.col("reviewer_status"), notes, known)


def tag_counts(state: DataFrame, most: int = 500) -> DataFrame:
    return state.select(F.explode("reviewer_tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(most)


def evidence_search(evidence: DataFrame, q: str = "", src: str = "all", state: str = "all", limit: int = 50) -> DataFrame:
    """Records whose id, record id, vehicle, state or type holds what is asked for, or the code of the state that it names; newest first. ``src`` is a source or its kind."""
    ask, src = q.strip().lower(), {v: k for k, v in KINDS.items()}.get(src, src)
    code = known_state(F.col("state"))
    hay = F.lower(F.concat_ws(" ", *[F.coalesce(x.cast("string"), F.lit("")) for x in (F.col("candidate_record_id"), F.col("source_record_id"), F.col("vehicle_ref"), code, F.col("event_type"))]))
    preds = [F.col("src").isin(*SOURCES) if src in (None, "all", "") else F.col("src") == src]
    if state not in (None, "all", ""):
        preds.append(code == state)
    if ask:
        preds.append(hay.contains(ask) | hay.contains(STATES[ask].lower()) if ask in STATES else hay.contains(ask))
    rows = evidence.where(reduce(lambda a, b: a & b, preds)).withColumn("state", code)
    return rows.orderBy(F.desc_nulls_last("event_dt"), "source_record_id").limit(limit)


def search_totals(found: DataFrame) -> DataFrame:
    """How many records and candidates a search returned; the limit caps both."""
    return found.agg(F.count(F.lit(1)).alias("total_matches"), F.countDistinct("candidate_record_id").alias("candidates_matched"))


def search_groups(found: DataFrame) -> DataFrame:
    """Records that were found, by candidate and kind, as arrays of ids."""
    return found.groupBy("candidate_record_id", mapped(F.col("src"), KINDS).alias("kind")).agg(F.sort_array(F.collect_list("source_record_id")).alias("records"))


def strong_matches(evidence: DataFrame, least: float = 0.95) -> DataFrame:
    """Per candidate: records, and those that are linked with a confidence of ``least`` or more."""
    return evidence.groupBy("candidate_record_id").agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("link_confidence") >= least).alias("strong"))


def timeline(evidence: DataFrame, key: str = "candidate_record_id", most: int = 20) -> DataFrame:
    """Per case and source the first ``most`` records in time, as arrays of structs."""
    w = Window.partitionBy(key, "src").orderBy("event_dt", "source_record_id")
    rows = evidence.where("event_dt is not null").withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)
    return rows.groupBy(key, "src").agg(F.array_sort(F.collect_list(F.struct("event_dt", "source_record_id", "state"))).alias("records"))


def effect_sizes(df: DataFrame, group: str, features: list[str]) -> DataFrame:
    """Per class and feature: (class mean - mean) / standard deviation, 1 where that is 0."""
    from attestra.operators.metrics import unpivoted

    u = unpivoted(df, [group], features)
    g = u.groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"))
    c = u.groupBy(group, "feature").agg(F.avg("value").alias("cm"))
    return c.join(F.broadcast(g), "feature").select(group, "feature", ((F.col("cm") - F.col("m")) / F.coalesce(F.nullif("s", F.lit(0.0)), F.lit(1.0))).alias("effect"))


def top_features(df: DataFrame, group: str, features: list[str], most: int = 12) -> DataFrame:
    """Per class the features that set it apart most: effect size, class and overall mean and deviation, direction, rank. Ties by name."""
    from attestra.operators.metrics import unpivoted

    u = unpivoted(df, [group], features)
    g = u.groupBy("feature").agg(F.avg("value").alias("m"), F.coalesce(F.nullif(F.stddev_samp("value"), F.lit(0.0)), F.lit(1.0)).alias("s"))
    c = u.groupBy(group, "feature").agg(F.avg("value").alias("cm")).join(F.broadcast(g), "feature").withColumn("e", F.abs((F.col("cm") - F.col("m")) / F.col("s")))
    r = c.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("e"), "feature"))).where(F.col("rank") <= most)
    three = lambda x: F.bround(x, 3)
    return r.select(group, "feature", "rank", three("e").alias("effect_size"), three("cm").alias("class_mean"), three("m").alias("overall_mean"), three("s").alias("overall_std"), F.when(F.col("cm") > F.col("m"), "higher").otherwise("lower").alias("direction"), field_label(F.col("feature")).alias("label"))


def explained(cases: DataFrame, top: DataFrame, group: str, features: list[str], key: str = "candidate_record_id") -> DataFrame:
    """For each case the top features of its class: value, z-score, and whether the value pushes toward the class. Missing values count as 0."""
    from attestra.operators.metrics import unpivoted

    v = unpivoted(cases, [key, group], features).join(F.broadcast(top), [group, "feature"]).withColumn("value", F.coalesce("value", F.lit(0.0)))
    z = (F.col("value") - F.col("overall_mean")) / F.coalesce(F.nullif("overall_std", F.lit(0.0)), F.lit(1.0))
    toward = ((F.col("value") > F.col("overall_mean")) & (F.col("direction") == "higher")) | ((F.col("value") < F.col("overall_mean")) & (F.col("direction") == "lower"))
    return v.select(key, group, "feature", "rank", F.bround("value", 3).alias("case_value"), F.bround(z, 2).alias("case_z_score"), toward.alias("pushes_toward_class"))


def override_merge(base: DataFrame, better: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Values of ``better`` where it has a row, else of ``base``; origin says which."""
    b = better.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_hit"))
    return base.join(b, key, "left").select(key, *[F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns], F.when(F.col("_hit"), "outer_oof").otherwise("full_fit").alias("origin"))


def constant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: distinct values, nulls, and whether it is constant or all missing. Values are counted in two levels, by column and value and then by column, so no row is repeated for each column before it is added up."""
    text = df.select(*[(F.col(c) + 0.0 if kind in ("double", "float") else F.col(c)).cast("string").alias(c) for c, kind in df.select(*columns).dtypes])
    each = text.unpivot([], columns, "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = each.groupBy("feature").agg(F.count("value").alias("distinct"), F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing"), F.sum("n").alias("n"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string").join(sums, "feature", "left").na.fill(0, ["distinct", "missing", "n"])
    return every.select("feature", "distinct", "missing", (F.col("distinct") <= 1).alias("constant"), (F.col("missing") == F.col("n")).alias("all_missing"))


def stacked(cases: DataFrame) -> DataFrame:
    """A row per case and phase, for export."""
    one = lambda p: F.struct(F.lit(p.upper()).alias("phase"), F.col(f"{p}_class").alias("predicted_class"), F.col(f"{p}_priority").alias("review_priority"))
    return cases.select("candidate_record_id", F.explode(F.array(one("t0"), one("t1"))).alias("r")).select("candidate_record_id", "r.*")


def compare_pair(cases: DataFrame, a: object, b: object, key: str = "candidate_record_id") -> DataFrame:
    """Two cases side by side, with flags of large differences."""
    pick = lambda v, s: cases.where(F.col(key) == v).select(F.lit(1).alias("j"), *[F.col(c).alias(f"{c}_{s}") for c in (key, "t1_priority", "total_records")])
    j = pick(a, "a").join(pick(b, "b"), "j").drop("j")
    return j.withColumn("priority_differs", F.abs(F.col("t1_priority_a") - F.col("t1_priority_b")) > 0.15).withColumn("records_differ", F.abs(F.col("total_records_a") - F.col("total_records_b")) >= 3)
