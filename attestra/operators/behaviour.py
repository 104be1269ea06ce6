"""How predictions move between phases and between versions, and the model reports of the review layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestra.functions.values import anchor_weight
from attestra.operators.metrics import blended, bundle_by, confusion, per_class, picked, priority_by, quantiles, rankings

#: Metrics of which less is better. Fixed values.
LOWER_IS_BETTER = ("log_loss", "brier_multiclass", "brier_macro_ovr", "ece_10bin")


def total_variation(p: tuple[str, ...], q: tuple[str, ...]) -> Column:
    return 0.5 * reduce(lambda a, b: a + b, [F.abs(F.col(y) - F.col(x)) for x, y in zip(p, q, strict=True)])


def shared_ids(key: str, *tables: DataFrame) -> DataFrame:
    """Ids that all tables have."""
    return reduce(DataFrame.intersect, [t.select(key) for t in tables])


def update_behaviour(t0: DataFrame, t1: DataFrame, groups: DataFrame, key: str = "candidate_record_id") -> DataFrame:
    """Per candidate that is in all three: how its class and probabilities moved, and would move under the anchored blend.

    ``t0`` has p0 to p2, ``t1`` q0 to q2, ``groups`` the evidence group.
    """
    p, q = ("p0", "p1", "p2"), ("q0", "q1", "q2")
    d = t0.select(key, *p).join(t1.select(key, *q), key).join(groups.select(key, "evidence_group"), key).withColumn("weight", anchor_weight(F.col("evidence_group")))
    d = d.select("*", *[x.alias(f"b{k}") for k, x in enumerate(blended(p, q, F.col("weight")))])
    tv = total_variation(p, q)
    return d.select(
        key, "evidence_group", (picked(p) != picked(q)).cast("int").alias("unanchored_class_changed"), (picked(p) != picked(("b0", "b1", "b2"))).cast("int").alias("experimental_anchored_class_changed"),
        tv.alias("total_variation_probability_change"), (2 * tv / 3).alias("mean_absolute_probability_change"), (F.col("q0") - F.col("p0")).alias("p_review_warranted_change"), F.col("weight").alias("experimental_anchor_t1_weight"),
    )


def behaviour_summary(behaviour: DataFrame) -> DataFrame:
    n, a, tv = "unanchored_class_changed", "experimental_anchored_class_changed", "total_variation_probability_change"
    out = behaviour.groupBy("evidence_group").agg(
        F.count(F.lit(1)).alias("candidates"), F.sum(n).alias("unanchored_class_changes"), F.avg(n).alias("unanchored_class_change_rate"), F.sum(a).alias("experimental_anchored_class_changes"), F.avg(a).alias("experimental_anchored_class_change_rate"),
        F.avg(tv).alias("mean_total_variation_change"), F.max(tv).alias("max_total_variation_change"), F.avg("mean_absolute_probability_change").alias("mean_absolute_probability_change"), F.avg("p_review_warranted_change").alias("mean_p_review_warranted_change"),
    )
    return out.join(quantiles(behaviour, tv, ["evidence_group"], {"median_total_variation_change": 0.5}), "evidence_group", "left")


def labelled_summary(behaviour: DataFrame, labels: DataFrame, key: str = "candidate_record_id") -> DataFrame:
    """Of labelled candidates (key, y0, y1): how many classes really changed, beside the predicted changes."""
    d = behaviour.join(labels.select(key, (F.col("y0") != F.col("y1")).cast("int").alias("actual")), key)
    part = lambda c, name: [F.sum(c).alias(f"{name}_class_changes"), F.avg(c).alias(f"{name}_class_change_rate")]
    return d.groupBy("evidence_group").agg(F.count(F.lit(1)).alias("labeled_candidates"), *part("actual", "actual"), *part("unanchored_class_changed", "unanchored"), *part("experimental_anchored_class_changed", "experimental_anchored"))


def aligned(baseline: DataFrame, updated: DataFrame, key: str = "candidate_record_id", same: tuple[str, ...] = ("fold", "label")) -> DataFrame:
    """Both versions' rows side by side, p of the baseline and q of the update. They must have the same ids, folds and labels, else ValueError."""
    b = baseline.select(key, *same, *[f"p{k}" for k in range(3)])
    u = updated.select(key, *[F.col(c).alias(f"_{c}") for c in same], *[F.col(f"p{k}").alias(f"q{k}") for k in range(3)])
    both = b.withColumn("_b", F.lit(True)).join(u.withColumn("_u", F.lit(True)), key, "full_outer")
    wrong = reduce(lambda x, y: x | y, [F.col("_b").isNull(), F.col("_u").isNull(), *[~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same]])
    if both.where(wrong).limit(1).count():
        raise ValueError("both versions must have the same candidates, folds and labels")
    return both.drop("_b", "_u", *[f"_{c}" for c in same])


def phase_metrics(df: DataFrame, p: tuple[str, ...], key: str, by: list[str]) -> DataFrame:
    """The bundle and the rankings of one version, by group. Groups are few, as phases are; each is ranked by all tasks."""
    each = []
    for group in df.select(*by).distinct().collect():
        own = df.where(reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(group[c])) for c in by]))
        each.append(rankings(own, p[0], F.col("y") == 0, key).select(*[F.lit(group[c]).cast(df.schema[c].dataType).alias(c) for c in by], "*"))
    ranked = reduce(DataFrame.unionByName, each) if each else priority_by(df, by, p[0], F.col("y") == 0, key)
    return bundle_by(df, by, p).join(ranked, by)


def draw_metrics(df: DataFrame, p: tuple[str, ...], key: str, by: list[str]) -> DataFrame:
    """The same for many small groups, as resamples are: each is ranked in one task."""
    return bundle_by(df, by, p).join(priority_by(df, by, p[0], F.col("y") == 0, key), by)


def improvement(metric: Column, delta: Column) -> Column:
    better = F.when(metric.isin(*LOWER_IS_BETTER), delta < 0).otherwise(delta > 0)
    return F.when(better, "improved").when(delta == 0, "unchanged").otherwise("worsened")


def version_comparison(df: DataFrame, key: str, metrics: list[str], by: str = "phase") -> DataFrame:
    """Per phase and metric: baseline, update, difference and direction. ``df`` has y, p0 to p2 and q0 to q2."""
    long = lambda p, name: phase_metrics(df, p, key, [by]).unpivot([by], metrics, "metric", name)
    d = long(("p0", "p1", "p2"), "baseline").join(long(("q0", "q1", "q2"), "updated"), [by, "metric"]).withColumn("delta", F.col("updated") - F.col("baseline"))
    return d.withColumn("point_direction", improvement(F.col("metric"), F.col("delta")))


def model_performance(df: DataFrame, phases: dict[str, tuple[str, ...]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Over both phases: mean metrics, one confusion matrix, and per class mean quality with the summed support. ``df`` has y and each phase's probabilities."""
    metrics = reduce(DataFrame.unionByName, [bundle_by(df, [], p) for p in phases.values()])
    names = ["log_loss", "brier_multiclass", "macro_f1", "ece_10bin", "accuracy"]
    mean = metrics.agg(*[F.bround(F.avg(c), 4).alias(c) for c in names])
    cells = reduce(DataFrame.unionByName, [confusion(df, F.col("y"), picked(p)) for p in phases.values()]).groupBy("truth", "guess").agg(F.sum("n").alias("n"))
    classes = reduce(DataFrame.unionByName, [per_class(df, F.col("y"), picked(p)) for p in phases.values()]).groupBy("class").agg(*[F.bround(F.avg(c), 3).alias(c) for c in ("precision", "recall", "f1")], F.sum("support").alias("support"))
    return mean, cells, classes


def leaderboard(models: DataFrame, selected: str) -> DataFrame:
    """Models with their mean metrics to four places. ``accuracy`` is one less half the log loss, as the dashboard shows it, not a share of right answers."""
    four = lambda c: F.bround(c, 4)
    return models.select(
        "name", four("macro_f1").alias("macro_f1"), F.when(F.col("log_loss") < 2, four(1 - F.col("log_loss") / 2)).otherwise(0.0).alias("accuracy"), four("log_loss").alias("log_loss"),
        four("brier_multiclass").alias("brier"), four("ece_10bin").alias("ece"), (F.col("name") == selected).alias("current"),
    )


def dashboard_calibration(df: DataFrame, p: tuple[str, ...]) -> DataFrame:
    """Tenths of confidence that hold any row: middle, mean confidence and share of right answers to three places, rows."""
    conf = F.greatest(*p)
    tenth = F.least(F.floor(conf * 10), F.lit(9))
    g = df.groupBy(tenth.alias("k")).agg(F.avg(conf).alias("e"), F.avg((picked(p) == F.col("y")).cast("double")).alias("o"), F.count(F.lit(1)).alias("n"))
    return g.select(F.bround((F.col("k") + 0.5) / 10, 2).alias("bin"), F.bround("e", 3).alias("expected"), F.bround("o", 3).alias("observed"), "n")
