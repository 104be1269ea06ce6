"""Features that an update stream keeps current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.config import SOURCES, FeatureRules
from attestra.functions.values import decay, safe_ratio, state_class
from attestra.operators.evidence import KEY, derived
from attestra.streaming.state import drain

#: What a cell stands for: a candidate's records of one source, state and day.
CELL = [KEY, "phase", "src", "sc", "state", "event_dt"]


def cells(rows: DataFrame, rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Counts and latest places of evidence by CELL, for tables and streams. All are sums, minima and maxima, so parts merge in any order. Records are only added, as corrections are records of their own here."""
    conf, t1 = F.col("link_confidence"), F.col("phase") == "T1"
    lag = F.when(t1, F.date_diff("observed_dt", "event_dt"))
    return rows.withColumn("sc", state_class(F.col("state"), rules.home_state)).groupBy(*CELL).agg(
        F.count(F.lit(1)).alias("n"), F.count(conf).alias("n_conf"), F.sum(conf).alias("conf"), F.min(conf).alias("least_conf"), F.count_if(conf < rules.low_confidence).alias("n_low"), F.count_if(F.col("link_tier") == "C").alias("n_c"),
        F.count(lag).alias("n_lag"), F.sum(lag).alias("lag"), F.max(lag).alias("most_lag"), F.count_if(lag > 30).alias("n_late"), F.max("source_record_id").alias("last_id"), F.max(F.when(t1, F.col("observed_dt"))).alias("observed"),
    )


def keep_cells(stream: DataFrame, base: str, rules: FeatureRules = FeatureRules()) -> None:
    """Adds what has come to the cells, which a state store holds from run to run, and writes the cells that changed to ``base``/out/batch=<n>.

    A batch costs its own rows and cells, not the table's. A batch that runs
    again replaces its own folder with the same cells.
    """
    drain(cells(stream, rules), base, lambda batch, k: batch.write.mode("overwrite").parquet(f"{base}/out/batch={k}"), "update")


def newest_cells(spark: SparkSession, base: str, rows: DataFrame) -> DataFrame:
    """The cells as the last batch left them. ``rows``: a table with the stream's columns.

    All is dealt by candidate once, which features() goes on with. A candidate
    has a cell for each source, state and day at most, however many records.
    """
    schema = cells(rows).schema.add("batch", "integer")
    log = spark.read.schema(schema).parquet(f"{base}/out").repartition(KEY)
    rest = [c for c in schema.names if c not in (*CELL, "batch")]
    return log.groupBy(*CELL).agg(F.max_by(F.struct(*rest), "batch").alias("s")).select(*CELL, "s.*")


def features(candidates: DataFrame, kept: DataFrame, rules: FeatureRules = FeatureRules()) -> DataFrame:
    """Counts, windows, decays, latest sources, link quality and update lags of each candidate, from its cells.

    They are read as of the greatest date on which an update was observed, so
    they move on with the feed also where a candidate has none; before the
    first update as of the candidate's own date. Values are those that
    evidence.phase_features computes anew from all records.
    """
    now = kept.agg(F.max("observed").alias("_now"))
    cand = candidates.select(KEY, "candidate_dt").crossJoin(F.broadcast(now)).select(KEY, F.coalesce("_now", "candidate_dt").alias("as_of"))  # one row
    w = Window.partitionBy(KEY)
    c = kept.join(cand, KEY).withColumn("live", ~F.coalesce(F.col("event_dt") > F.col("as_of"), F.lit(False)))
    live, oos, de, src = F.col("live"), F.col("sc") == "OOS", F.col("sc") == "DE", F.col("src")
    dated, age = F.col("event_dt").isNotNull(), F.greatest(F.date_diff("as_of", "event_dt"), F.lit(0))
    c = c.withColumn("top_oos", F.max(F.when(live & oos, F.col("event_dt"))).over(w)).withColumn("top_de", F.max(F.when(live & de, F.col("event_dt"))).over(w))
    total = lambda cond, n="n": F.coalesce(F.sum(F.when(cond, F.col(n))), F.lit(0))
    kinds = lambda x: F.size(F.collect_set(x)).cast("long")
    a = {
        "future_effective_record_count": total(~live), "linked_record_count": total(live), "de_count_total": total(live & de), "oos_count_total": total(live & oos), "state_missing_count": total(live & (F.col("sc") == "MISSING")),
        "distinct_oos_states": kinds(F.when(live & oos, F.col("state"))), "source_diversity": kinds(F.when(live, src)), "historical_oos_count_over_365d": total(live & dated & oos & (age > 365)),
        "oos_evidence_after_latest_de_count": total(live & oos & (F.col("event_dt") > F.col("top_de"))), "de_evidence_after_latest_oos_count": total(live & de & (F.col("event_dt") > F.col("top_oos"))),
        "link_confidence_min": F.min(F.when(live, F.col("least_conf"))), "_conf_sum": F.sum(F.when(live, F.col("conf"))), "_conf": total(live, "n_conf"), "_low": total(live, "n_low"), "_c": total(live, "n_c"),
        "_lag": F.sum(F.when(live, F.col("lag"))), "_lags": total(live, "n_lag"), "t1_update_observation_lag_max_days": F.coalesce(F.max(F.when(live, F.col("most_lag"))), F.lit(0)).cast("long"), "t1_late_arriving_update_count_over_30d": total(live, "n_late"),
    }
    for label, of in (("oos", oos), ("de", de)):
        a |= {f"{label}_count_{d}d": total(live & dated & of & (age <= d)) for d in rules.windows}
        a |= {f"{label}_decay_{h}d": F.coalesce(F.sum(F.when(live & dated & of, F.col("n") * decay(age, h))), F.lit(0.0)) for h in rules.half_lives}
        a |= {f"_top_{label}": F.max(F.when(live & of, F.col("event_dt"))), f"recent_{label}_independent_source_count_90d": kinds(F.when(live & dated & of & (age <= 90), src))}
    stamp = F.struct("event_dt", F.col("last_id").alias("source_record_id"), "sc")
    for s in SOURCES:
        mine = live & (src == s)
        a |= {
            f"{s}_record_count": total(mine), f"{s}_de_count": total(mine & de), f"{s}_oos_count": total(mine & oos), f"{s}_state_missing_count": total(mine & (F.col("sc") == "MISSING")),
            f"_last_{s}": F.max(F.when(mine & dated, stamp)), f"_known_{s}": F.max(F.when(mine & dated & (oos | de), stamp)),
            f"_oos_{s}": F.max(F.when(mine & oos, F.col("event_dt"))), f"_de_{s}": F.max(F.when(mine & de, F.col("event_dt"))),
        }
    held = c.groupBy(KEY).agg(*[x.alias(k) for k, x in a.items()])
    numbers = [k for k, t in held.dtypes if t in ("bigint", "double") and k not in ("link_confidence_min", "_conf_sum", "_lag")]
    g = cand.join(held, KEY, "left").na.fill(0, numbers)
    names = [k for k in a if not k.startswith("_")]
    out = {KEY: F.col(KEY), "as_of_date": F.date_format("as_of", "yyyy-MM-dd")} | {k: F.col(k) for k in names} | derived(rules)
    out |= {
        "link_confidence_mean": F.try_divide(F.col("_conf_sum"), F.col("_conf")), "low_confidence_link_share": safe_ratio(F.col("_low"), F.col("_conf")), "tier_c_link_share": safe_ratio(F.col("_c"), F.col("linked_record_count")),
        "t1_update_observation_lag_mean_days": safe_ratio(F.col("_lag"), F.col("_lags")),
    }
    return g.select(*[x.alias(k) for k, x in out.items()])
