"""The stages as commands: ``python -m attestra.cli STAGE ...``. Each reads what earlier ones wrote."""

from __future__ import annotations

import argparse
import json
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.config import CLASSES, SOURCE_SPECS, FeatureRules, LinkageRules, MetricRules, fingerprint
from attestra.functions.values import anchor_weight, canonical_source, evidence_group
from attestra.operators import behaviour, evidence, linkage, metrics, models, submission
from attestra.sources import catalog, files

KEY = evidence.KEY
PROBABILITIES = submission.PROBABILITIES


def _rules(path: str | None) -> LinkageRules:
    return files.load_rules(path, LinkageRules) if path else LinkageRules()


def _class_number(c: str) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in CLASSES]), F.col(c)).cast("int") - 1


def _typed(df: DataFrame) -> DataFrame:
    """All but ids, phases and dates as numbers."""
    text = {KEY, "phase", "as_of_date", "de_residency_proxy_date", "prior_oos_address_state_proxy", "predicted_class", "prediction_origin", "model", "evidence_group"}
    return df.select([F.col(c) if c in text or c.endswith("_date") else files.number(F.nullif(c, F.lit(""))).alias(c) for c in df.columns])


def run_linkage(spark: SparkSession, a: argparse.Namespace) -> None:
    """Links all sources; writes linked and unresolved events, summaries, coverage, diagnostics and audits."""
    rules, out = _rules(a.rules), f"{a.out}/linkage"
    candidates = files.read_text_csv(spark, f"{a.data}/Data_T0/candidate_records.csv")
    run = linkage.LinkageRun(candidates, files.read_sources(spark, a.data), rules)
    tables = {
        "linked_events": run.linked, "unresolved_or_ambiguous_events": run.unresolved, "linkage_summary": linkage.linkage_summary(run.unified), "linkage_method_summary": linkage.linkage_methods(run.unified),
        "candidate_linkage_coverage": linkage.coverage(candidates, run.unified), "diagnostics": linkage.diagnostics(run), "anchor_audit": linkage.anchor_audit(run.license, run.index, rules), "bridge_audit": linkage.bridge_audit(run.title_names, run.index, rules),
    }
    for name, df in tables.items():
        files.write_csv(df, f"{out}/{name}")
    small = {k: spark.read.option("header", True).csv(f"{out}/{k}") for k in ("linkage_summary", "diagnostics", "anchor_audit", "bridge_audit")}
    files.write_report("Linkage", small, f"{out}/report.md")
    files.write_json({"rules": fingerprint(rules), "code": files.code_hash(str(Path(__file__).parent)), "linked": files.content_hash(run.linked)}, f"{out}/manifest.json")
    if a.rules:
        files.freeze(a.rules, out)


def _events(linked: DataFrame) -> DataFrame:
    """Linked events as the features read them."""
    day = lambda c: files.lenient_date(F.col(c))
    return linked.select(
        KEY, "phase", "source_domain", canonical_source(F.col("phase"), F.col("source"), F.col("source_domain")).alias("src"), "source_record_id", day("event_date").alias("event_dt"), day("observed_date").alias("observed_dt"),
        day("effective_end_date").alias("end_dt"), "state", files.number(F.col("link_confidence")).alias("link_confidence"), "link_tier", "event_type", "record_action", "credential_status", "evidence_quality", "vehicle_ref",
    )


def build_features(spark: SparkSession, a: argparse.Namespace) -> None:
    """Features of both phases and their changes, with a dictionary of the columns."""
    out = f"{a.out}/features"
    e = _events(files.read_text_csv(spark, f"{a.out}/linkage/linked_events"))
    feed = files.read_text_csv(spark, f"{a.data}/{SOURCE_SPECS['evidence_update_stream'].path}").select(files.strict_date(F.col("observed_date")).alias("observed_dt"))
    c = files.read_candidates(spark, f"{a.data}/Data_T0/candidate_records.csv")
    t0, t1 = (evidence.phase_features(c, e, p, feed) for p in ("T0", "T1"))
    delta = evidence.delta_features(c, e, feed, t0, t1)
    for name, df in (("features_t0", t0), ("features_t1", t1), ("features_t1_delta", delta)):
        files.write_csv(df, f"{out}/{name}")
    words = catalog.dictionary(t0.limit(0), {}).unionByName(catalog.dictionary(delta.drop(KEY).limit(0), {}))
    files.write_csv(words, f"{out}/temporal_feature_dictionary")
    files.write_json({"rules": fingerprint(FeatureRules())}, f"{out}/manifest.json")


def select_compact(spark: SparkSession, a: argparse.Namespace) -> None:
    """The columns that models may see, and those kept for audits only."""
    t0, delta = (files.read_text_csv(spark, f"{a.out}/features/{n}") for n in ("features_t0", "features_t1_delta"))
    if not files.same_ids(t0, delta, KEY):
        raise ValueError("both phases must have the same candidates")
    tables = {"t0_compact": (t0, evidence.T0_PREDICTORS), "t1_compact": (delta, evidence.T1_PREDICTORS), "t0_audit": (t0, evidence.T0_AUDIT), "t1_audit": (delta, evidence.T1_AUDIT)}
    for name, (df, cols) in tables.items():
        files.write_csv(evidence.compact(df, cols), f"{a.out}/compact/{name}")


def _train(spark: SparkSession, a: argparse.Namespace, phase: str, rows: DataFrame, everyone: DataFrame, features: list[str], folds: DataFrame | None) -> None:
    """Nested validation of each kind of model, choice, final fit, predictions, importances, saved model."""
    out, grids = f"{a.out}/{phase}_model", {"logistic": models.LOGISTIC_GRID, "boosted": models.BOOSTED_GRID}
    found = {k: models.nested(rows, KEY, features, grids[k], a.outer, a.inner, folds) for k in a.kinds.split(",")}
    total = {k: n.metrics().where("fold is null").first().asDict() for k, n in found.items()}
    kind, why = models.choose_model(total["boosted"], total["logistic"]) if len(found) == 2 else (next(iter(found)), "The only kind that was asked for.")
    final = models.final_fit(rows, features, grids[kind], found[kind])
    final.fitted.save(spark, f"{out}/model")
    predicted = models.predictions_table(final.predict(everyone, [KEY]), KEY, phase.upper())
    names = dict(zip(("p0", "p1", "p2"), PROBABILITIES, strict=True))
    oof = models.predictions_table(found[kind].rows, KEY, phase.upper()).join(found[kind].rows.select(KEY, "fold", "label"), KEY)
    priors = predicted.join(oof.select(KEY, *[F.col(c).alias(f"_{c}") for c in names.values()], F.lit(True).alias("_own")), KEY, "left")
    better = [F.when(F.col("_own"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in names.values()]
    origin = F.when(F.col("_own"), "outer_oof").otherwise("full_fit").alias("prediction_origin")
    priors = priors.select(KEY, *better, origin).withColumn("review_priority", F.col(PROBABILITIES[0]))
    for name, df in {
        "predictions": predicted, "oof": oof, "folds": found[kind].rows.select(KEY, "fold"), "importance": final.fitted.importances(spark), "training_priors": priors,
        "fold_metrics": reduce(DataFrame.unionByName, [n.metrics().withColumn("model", F.lit(k)) for k, n in found.items()]),
    }.items():
        files.write_csv(df, f"{out}/{name}")
    error = models.probability_sum_error(predicted, PROBABILITIES).first()[0]
    files.write_json({"selected": kind, "reason": why, "config": final.fitted.config, "temperature": final.temperature, "probability_sum_max_error": error}, f"{out}/diagnostics.json")


def _labels(spark: SparkSession, path: str, phase: str) -> DataFrame:
    out = files.read_text_csv(spark, path).select(KEY, _class_number(f"label_{phase}").alias("label"))
    if out.where("label is null or label < 0").limit(1).count():
        raise ValueError(f"unknown class in label_{phase}")
    return out


def train_t0(spark: SparkSession, a: argparse.Namespace) -> None:
    x = _typed(files.read_text_csv(spark, f"{a.out}/compact/t0_compact"))
    _train(spark, a, "t0", models.one_to_one(_labels(spark, a.labels, "t0"), x, KEY), x, evidence.T0_PREDICTORS, None)


def train_t1(spark: SparkSession, a: argparse.Namespace) -> None:
    """Trains on out-of-fold priors and the folds of the first phase; scores with the final priors."""
    delta = _typed(files.read_text_csv(spark, f"{a.out}/compact/t1_compact"))
    read = lambda n: _typed(files.read_text_csv(spark, f"{a.out}/t0_model/{n}"))
    train, score = models.update_matrix(read("training_priors"), delta), models.update_matrix(read("predictions"), delta)
    rows = models.one_to_one(_labels(spark, a.labels, "t1"), train, KEY)
    folds = read("folds").withColumn("fold", F.col("fold").cast("int"))
    _train(spark, a, "t1", rows, score, models.predictors(train), folds)


def _phases(spark: SparkSession, out: str, name: str, labels: str | None = None) -> DataFrame:
    """Both phases' probabilities side by side: p of the first, q of the second."""
    read = lambda p, c: _typed(files.read_text_csv(spark, f"{out}/{p}_model/{name}")).select(KEY, *[F.col(x).alias(f"{c}{k}") for k, x in enumerate(PROBABILITIES)])
    both = models.one_to_one(read("t0", "p"), read("t1", "q"), KEY)
    if labels:
        y = files.read_text_csv(spark, labels).select(KEY, _class_number("label_t0").alias("y0"), _class_number("label_t1").alias("y1"))
        both = models.one_to_one(y, both, KEY)
    return both


def _evidence_groups(delta: DataFrame) -> DataFrame:
    names = ["current_past_60_day_grace_proxy", "current_within_60_day_grace_proxy", "post_60d_oos_vehicle_signal_count", "post_60d_active_oos_credential_signal_count", "post_60d_prior_state_persistence_any_present", "new_meaningful_oos_title_signal_post_60d_present"]
    moved = F.exists(F.array(*[F.col(f"delta_{c}") for c in names]), lambda x: x != 0)
    g = evidence_group(F.col("new_t1_record_count"), F.col("new_t1_oos_count") + F.col("new_t1_de_count"), F.col("new_t1_source_domain_diversity"), F.col("newly_effective_t0_record_count"), moved)
    return delta.select(KEY, g.alias("evidence_group"))


def _draws(df: DataFrame, n: int) -> DataFrame:
    """Resamples of labelled rows, numbered by a two-level order of their ids' digests."""
    d = models.stratified_folds(df.withColumn("_all", F.lit(0)), KEY, "_all", 1 << 30, name="i")
    return metrics.resampled(d.drop("_all"), "i", df.count(), n)


def analyze_behaviour(spark: SparkSession, a: argparse.Namespace) -> None:
    """How predictions move with the evidence, with and without the anchored blend, and whether the blend is clearly better."""
    out = f"{a.out}/behaviour"
    groups = _evidence_groups(_typed(files.read_text_csv(spark, f"{a.out}/features/features_t1_delta")))
    p = _phases(spark, a.out, "predictions")
    moved = behaviour.update_behaviour(p.select(KEY, "p0", "p1", "p2"), p.select(KEY, "q0", "q1", "q2"), groups)
    o = _phases(spark, a.out, "oof", a.labels).withColumn("y", F.col("y1")).join(groups, KEY)
    own = behaviour.update_behaviour(o.select(KEY, "p0", "p1", "p2"), o.select(KEY, "q0", "q1", "q2"), groups)
    q, b = ("q0", "q1", "q2"), ("b0", "b1", "b2")
    o = o.select("*", *[x.alias(f"b{k}") for k, x in enumerate(metrics.blended(metrics.P, q, anchor_weight(F.col("evidence_group"))))])
    draws = _draws(o, a.resamples)
    names = list(metrics.BUNDLE)
    deltas = metrics.interval(metrics.differences(metrics.bundle_by(draws, ["draw"], q), metrics.bundle_by(draws, ["draw"], b), "draw", names), "draw", names)
    for name, df in {"candidates": moved, "summary": behaviour.behaviour_summary(moved), "labelled_summary": behaviour.labelled_summary(own, o), "paired_intervals": deltas}.items():
        files.write_csv(df, f"{out}/{name}")
    before, after = (metrics.metric_bundle(o, c).first().asDict() for c in (q, b))
    quiet = groups.join(o.select(KEY), KEY, "left_semi").where("evidence_group = 'effectively_no_meaningful_update'").count()
    files.write_json({"unanchored": before, "anchored": after, "quiet_labels": quiet, "clear_improvement": models.clear_improvement(before, after, quiet)}, f"{out}/diagnostics.json")


def final_metrics(spark: SparkSession, a: argparse.Namespace) -> None:
    """Quality of both phases with intervals, calibration, drift, contracts, and the submission."""
    out, rules = f"{a.out}/metrics", MetricRules()
    o = _phases(spark, a.out, "oof", a.labels)
    arms = {"T0": (metrics.P, "y0"), "T1": (("q0", "q1", "q2"), "y1")}
    for phase, (p, y) in arms.items():
        d = o.withColumn("y", F.col(y))
        draws = _draws(d, a.resamples)
        each = metrics.bundle_by(draws, ["draw"], p).join(metrics.priority_by(draws, ["draw"], p[0], F.col("y") == 0, KEY), "draw")
        names = [*metrics.BUNDLE, *metrics.PRIORITY]
        compact = _typed(files.read_text_csv(spark, f"{a.out}/compact/{phase.lower()}_compact"))
        marked = compact.join(o.select(KEY, F.lit(1).alias("_own")), KEY, "left").withColumn("_own", F.coalesce("_own", F.lit(0)))
        cols = [c for c in compact.columns if c != KEY]
        tables = {
            "metrics": behaviour.phase_metrics(d.withColumn("phase", F.lit(phase)), p, KEY, ["phase"]), "intervals": metrics.interval(each, "draw", names), "confusion": metrics.confusion(d, F.col("y"), metrics.picked(p)),
            "classes": metrics.per_class(d, F.col("y"), metrics.picked(p)), "calibration": metrics.calibration(d, F.greatest(*p), metrics.picked(p) == F.col("y"), rules.bins),
            "drift": metrics.drift(marked, "_own", cols, rules.ks_limit, rules.smd_limit, rules.missing_limit), "contract": metrics.feature_contract(marked, cols, "_own"),
        }
        for name, df in tables.items():
            files.write_csv(df, f"{out}/{phase.lower()}_{name}")
    kq, kp = metrics.picked(("q0", "q1", "q2")), metrics.picked()
    files.write_csv(metrics.confusion(o, kp, kq), f"{out}/transitions")
    files.write_csv(metrics.change_detection(o, F.col("y0") != F.col("y1"), kp != kq), f"{out}/change_detection")
    read = lambda p: files.read_text_csv(spark, f"{a.out}/{p}_model/predictions")
    done = submission.submission(submission.read_template(spark, a.template), submission.combined(read("t0"), read("t1")))
    submission.refused(submission.validate_submission(done, submission.read_template(spark, a.template)))
    submission.write_submission(done, [f"{out}/case_predictions", f"{a.out}/submission", f"{a.out}/dashboard/case_predictions"])


def compare_versions(spark: SparkSession, a: argparse.Namespace) -> None:
    """Out-of-fold predictions of two runs on the same folds: differences, intervals, and how often they are for the better."""
    names = [*metrics.BUNDLE[:1], "macro_f1", "brier_multiclass", "ece_10bin", "average_precision", "ndcg", "precision_at_top_10pct", "recall_at_top_20pct"]
    both = []
    for phase in ("t0", "t1"):
        read = lambda root, p=phase: _typed(files.read_text_csv(spark, f"{root}/{p}_model/oof")).select(KEY, "fold", "label", *[F.col(x).alias(f"p{k}") for k, x in enumerate(PROBABILITIES)])
        both.append(behaviour.aligned(read(a.baseline), read(a.out), KEY).withColumn("phase", F.lit(phase.upper())).withColumn("y", F.col("label").cast("int")))
    rows = reduce(DataFrame.unionByName, both)
    files.write_csv(behaviour.version_comparison(rows, KEY, names), f"{a.out}/comparison/metrics")
    for d in both:
        draws = _draws(d, a.resamples)
        arm = lambda p, r=draws: behaviour.draw_metrics(r, p, KEY, ["draw"])
        moved = metrics.differences(arm(metrics.P), arm(("q0", "q1", "q2")), "draw", names)
        phase = d.select("phase").first()[0].lower()
        files.write_csv(metrics.interval(moved, "draw", names, {m: m in behaviour.LOWER_IS_BETTER for m in names}), f"{a.out}/comparison/{phase}_intervals")


def validate(spark: SparkSession, a: argparse.Namespace) -> None:
    submission.refused(submission.validate_submission(files.read_text_csv(spark, a.path), submission.read_template(spark, a.template)))
    print(json.dumps({"valid": a.path}))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    sub = parser.add_subparsers(required=True)

    def stage(name: str, run, *args: str, **options: tuple[type, object]) -> None:
        p = sub.add_parser(name, help=(run.__doc__ or name).split("\n")[0])
        for x in args:
            p.add_argument(x)
        for k, (kind, default) in options.items():
            p.add_argument(f"--{k}", type=kind, default=default)
        p.set_defaults(run=run)

    fit = {"outer": (int, models.OUTER), "inner": (int, models.INNER), "kinds": (str, "logistic,boosted")}
    draws = {"resamples": (int, MetricRules().bootstrap)}
    stage("linkage", run_linkage, "data", "out", rules=(str, None))
    stage("features", build_features, "data", "out")
    stage("compact", select_compact, "out")
    stage("t0", train_t0, "out", "labels", **fit)
    stage("t1", train_t1, "out", "labels", **fit)
    stage("behaviour", analyze_behaviour, "out", "labels", **draws)
    stage("metrics", final_metrics, "out", "labels", "template", **draws)
    stage("compare", compare_versions, "baseline", "out", **draws)
    stage("validate", validate, "path", "template")
    a = parser.parse_args(argv)
    a.run(spark or SparkSession.builder.appName("attestra").getOrCreate(), a)


if __name__ == "__main__":
    main()
