"""Queries over predictions: quality, calibration, ranking, drift, resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.functions.values import tempered
from attestra.operators import metrics as mt
from attestra.plans.common import Registry
from attestra.plans.testdata import PREDICTIONS_SQL, predictions, table
from attestra.sources.stages import barrier

R = Registry()
ARG = "CASE WHEN {0}0 >= {0}1 AND {0}0 >= {0}2 THEN 0 WHEN {0}1 >= {0}2 THEN 1 ELSE 2 END"
WITH = f"WITH {PREDICTIONS_SQL.strip()}, pd AS (SELECT *, CAST({ARG.format('p')} AS BIGINT) AS k, CAST({ARG.format('q')} AS BIGINT) AS kq, greatest(p0, p1, p2) AS c, [p0, p1, p2][y + 1] AS py, [q0, q1, q2][y + 1] AS qy FROM pr)"
CONF = "cm AS (SELECT t.range AS truth, g.range AS guess, (SELECT count(*) FROM pd WHERE y = t.range AND k = g.range) AS n FROM range(3) t, range(3) g)"
PRF = """prf AS (SELECT k.range AS class, coalesce(h / nullif(s, 0), 0.0) AS precision, coalesce(h / nullif(t, 0), 0.0) AS recall, coalesce(2 * h / nullif(s + t, 0), 0.0) AS f1, CAST(t AS BIGINT) AS support
 FROM range(3) k, LATERAL (SELECT sum(n) FILTER (truth = k.range)::DOUBLE AS t, sum(n) FILTER (guess = k.range)::DOUBLE AS s, sum(n) FILTER (truth = k.range AND guess = k.range)::DOUBLE AS h FROM cm))"""
EDGE = " + ".join(f"CAST(c >= {k * (1.0 / 10)!r}::DOUBLE AS INTEGER)" for k in range(1, 10))
CAL = f"cal AS (SELECT b.range AS bin, coalesce(n, 0) AS n, confidence, accuracy FROM range(10) b LEFT JOIN (SELECT {EDGE} AS bin, count(*) AS n, avg(c) AS confidence, avg(CAST(k = y AS DOUBLE)) AS accuracy FROM pd GROUP BY 1) ON bin = b.range)"
ECE = "ec AS (SELECT sum(n * abs(accuracy - confidence)) / sum(n) AS ece FROM cal)"
LL = "-ln(greatest(least({0}, 1 - 1e-15), 1e-15))"
BR = "pow({0}0 - CAST(y = 0 AS DOUBLE), 2) + pow({0}1 - CAST(y = 1 AS DOUBLE), 2) + pow({0}2 - CAST(y = 2 AS DOUBLE), 2)"


@R.add("confusion_matrix", f"{WITH}, {CONF} SELECT * FROM cm")
def confusion_matrix(spark, sf_dir):
    return mt.confusion(predictions(spark, sf_dir), F.col("y"), mt.picked())


@R.add("per_class_prf", f"{WITH}, {CONF}, {PRF} SELECT * FROM prf", "precision recall f1")
def per_class_prf(spark, sf_dir):
    return mt.per_class(predictions(spark, sf_dir), F.col("y"), mt.picked())


def _bundle_ctes(rows, out, by=""):
    """CTEs that end in ``out``: the metrics of a bundle for each group of ``rows`` (by, y, a, b, c)."""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    sums = ", ".join(f"count(*) FILTER (y = {j}) AS s{j}, count(*) FILTER (k = {j}) AS g{j}, count(*) FILTER (y = {j} AND k = {j}) AS h{j}" for j in range(3))
    f1 = [f"(2 * sum(h{j})::DOUBLE / nullif(sum(s{j}) + sum(g{j}), 0))" for j in range(3)]
    place = " + ".join(f"CAST(cf >= {k * (1.0 / 10)!r}::DOUBLE AS INTEGER)" for k in range(1, 10))
    return f"""
{out}a AS (SELECT {by}y, a / (a + b + c) AS p0, b / (a + b + c) AS p1, c / (a + b + c) AS p2 FROM (SELECT {by}y, greatest(least(a, 1), 1e-12) AS a, greatest(least(b, 1), 1e-12) AS b, greatest(least(c, 1), 1e-12) AS c FROM {rows})),
{out}b AS (SELECT {by}y, {ARG.format('p')} AS k, greatest(p0, p1, p2) AS cf, {LL.format('[p0, p1, p2][y + 1]')} AS ll, {BR.format('p')} AS br FROM {out}a),
{out}c AS (SELECT {by}{place} AS bin, count(*) AS n, sum(cf) AS c, count(*) FILTER (k = y) AS r, sum(ll) AS ll, sum(br) AS br, {sums} FROM {out}b GROUP BY {by}bin),
{out} AS (SELECT {by}sum(ll) / sum(n) AS log_loss, ({' + '.join(f'coalesce({x}, 0)' for x in f1)}) / ({' + '.join(f'CAST({x} IS NOT NULL AS INTEGER)' for x in f1)}) AS macro_f1, sum(r) / sum(n)::DOUBLE AS accuracy,
 sum(br) / sum(n) AS brier_multiclass, sum(br) / (sum(n) * 3) AS brier_macro_ovr, sum(abs(r - c)) / sum(n) AS ece_10bin FROM {out}c {group})"""


BUNDLE = " ".join(mt.BUNDLE)


@R.add("metric_bundle", f"{WITH}, pq AS (SELECT y, p0 AS a, p1 AS b, p2 AS c FROM pd), {_bundle_ctes('pq', 'mb').strip()} SELECT * FROM mb", BUNDLE)
def metric_bundle(spark, sf_dir):
    return mt.metric_bundle(predictions(spark, sf_dir))


@R.add("calibration_bins", f"{WITH}, {CAL} SELECT * FROM cal", "confidence accuracy")
def calibration_bins(spark, sf_dir):
    return mt.calibration(predictions(spark, sf_dir), F.greatest(*mt.P), mt.picked() == F.col("y"))


@R.add("ece", f"{WITH}, {CAL}, {ECE} SELECT * FROM ec", "ece")
def ece(spark, sf_dir):
    return mt.ece(calibration_bins(spark, sf_dir))


@R.add("confidence_histogram", f"{WITH} SELECT b.range AS bin, coalesce(n, 0) AS n FROM range(10) b LEFT JOIN (SELECT CAST(least(floor(c * 10), 9) AS BIGINT) AS bin, count(*) AS n FROM pd GROUP BY 1) ON bin = b.range")
def confidence_histogram(spark, sf_dir):
    h = predictions(spark, sf_dir).groupBy(F.least(F.floor(F.greatest(*mt.P) * 10), F.lit(9)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return spark.range(10).select(F.col("id").alias("bin")).join(h, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


RANK = "sc AS (SELECT p0 AS s, count(*) AS n, count(*) FILTER (y = 0) AS pos FROM pd GROUP BY 1), rk AS (SELECT *, sum(n) OVER (ORDER BY s DESC) AS cn, sum(pos) OVER (ORDER BY s DESC) AS cp FROM sc)"


@R.add("average_precision", f"{WITH}, {RANK} SELECT coalesce(sum(pos * cp::DOUBLE / cn) / nullif(sum(pos), 0), 0.0) AS average_precision FROM rk", "average_precision")
def average_precision(spark, sf_dir):
    return mt.average_precision(predictions(spark, sf_dir), "p0", F.col("y") == 0)


@R.add("ndcg", f"""{WITH}, {RANK}, e AS (SELECT pos::DOUBLE / n AS gain, unnest(generate_series(CAST(cn - n + 1 AS BIGINT), CAST(cn AS BIGINT))) AS r FROM rk)
 SELECT (SELECT sum(gain / log2(r + 1)) FROM e) / (SELECT sum(1 / log2(range + 1)) FROM range(1, (SELECT CAST(sum(pos) AS BIGINT) + 1 FROM sc))) AS ndcg""", "ndcg")
def ndcg(spark, sf_dir):
    return mt.ndcg(predictions(spark, sf_dir), "p0", F.col("y") == 0)


@R.add("topfraction", f"""{WITH}, o AS (SELECT *, row_number() OVER (ORDER BY p0 DESC, id) AS r, count(*) OVER () AS n FROM pd), f AS (SELECT unnest([0.1::DOUBLE, 0.2::DOUBLE]) AS fraction)
 SELECT fraction, CAST(ceil(any_value(n) * fraction) AS BIGINT) AS k, count(*) FILTER (y = 0 AND r <= ceil(n * fraction)) / ceil(any_value(n) * fraction) AS precision, count(*) FILTER (y = 0 AND r <= ceil(n * fraction)) / count(*) FILTER (y = 0)::DOUBLE AS recall FROM o, f GROUP BY fraction""", "fraction precision recall")
def topfraction(spark, sf_dir):
    return mt.top_fraction(predictions(spark, sf_dir), "p0", "id", F.col("y") == 0)


@R.add("transition_matrix", f"{WITH} SELECT t.range AS truth, g.range AS guess, (SELECT count(*) FROM pd WHERE k = t.range AND kq = g.range) AS n FROM range(3) t, range(3) g")
def transition_matrix(spark, sf_dir):
    return mt.confusion(predictions(spark, sf_dir), mt.picked(), mt.picked(("q0", "q1", "q2")))


@R.add("change_detection", f"""{WITH}, x AS (SELECT y <> kq AS a, k <> kq AS g FROM pd), t AS (SELECT count(*) FILTER (a) AS actual, count(*) FILTER (g) AS predicted, count(*) FILTER (a AND g)::DOUBLE AS tp FROM x)
 SELECT actual, predicted, coalesce(tp / nullif(predicted, 0), 0.0) AS precision, coalesce(tp / nullif(actual, 0), 0.0) AS recall, coalesce(2 * tp / nullif(actual + predicted, 0), 0.0) AS f1 FROM t""", "precision recall f1")
def change_detection(spark, sf_dir):
    kq = mt.picked(("q0", "q1", "q2"))
    return mt.change_detection(predictions(spark, sf_dir), F.col("y") != kq, mt.picked() != kq)


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sample(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") % 10 == 0).cast("int").alias("g"), *[F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 23 != 0, F.col(c)).alias(c) for c in FEATURES])


SAMPLE = "sm AS (" + " UNION ALL ".join(f"SELECT CAST(l_orderkey % 10 = 0 AS INTEGER) AS g, '{c}' AS feature, CASE WHEN (l_orderkey + l_linenumber) % 23 <> 0 THEN {c} END AS value FROM lineitem" for c in FEATURES) + ")"


KS = """ks AS (SELECT feature, max(abs(fa - fb)) AS ks_statistic FROM (SELECT feature, sum(a) OVER w::DOUBLE / sum(a) OVER (PARTITION BY feature) AS fa, sum(b) OVER w::DOUBLE / sum(b) OVER (PARTITION BY feature) AS fb
 FROM (SELECT feature, value, count(*) FILTER (g = 1) AS a, count(*) FILTER (g = 0) AS b FROM sm WHERE value IS NOT NULL GROUP BY 1, 2) WINDOW w AS (PARTITION BY feature ORDER BY value)) GROUP BY 1)"""
SMD = """sd AS (SELECT *, CASE WHEN s > 0 THEN (labeled_mean - unlabeled_mean) / s ELSE 0 END AS standardized_mean_difference, labeled_missing_rate - unlabeled_missing_rate AS missing_rate_difference FROM (
 SELECT feature, count(value) FILTER (g = 1) AS labeled_count, count(value) FILTER (g = 0) AS unlabeled_count, avg(value) FILTER (g = 1) AS labeled_mean, avg(value) FILTER (g = 0) AS unlabeled_mean, stddev_pop(value) AS s,
 avg(CAST(value IS NULL AS DOUBLE)) FILTER (g = 1) AS labeled_missing_rate, avg(CAST(value IS NULL AS DOUBLE)) FILTER (g = 0) AS unlabeled_missing_rate FROM sm GROUP BY 1))"""


@R.add("ks_drift", f"WITH {SAMPLE}, {KS} SELECT * FROM ks", "ks_statistic")
def ks_drift(spark, sf_dir):
    return mt.drift(_sample(spark, sf_dir), "g", FEATURES).select("feature", "ks_statistic")


@R.add("smd_drift", f"WITH {SAMPLE}, {KS}, {SMD} SELECT sd.* EXCLUDE (s), ks_statistic, ks_statistic > 0.2 OR abs(standardized_mean_difference) > 0.5 OR abs(missing_rate_difference) > 0.1 AS warning FROM sd JOIN ks USING (feature)",
       "ks_statistic labeled_mean unlabeled_mean labeled_missing_rate unlabeled_missing_rate standardized_mean_difference missing_rate_difference")
def smd_drift(spark, sf_dir):
    return mt.drift(_sample(spark, sf_dir), "g", FEATURES)


@R.add("feature_contract", f"""WITH {SAMPLE} SELECT feature, 'double' AS dtype, avg(CAST(value IS NULL AS DOUBLE)) AS full_missing_rate, min(value) AS full_min, quantile_cont(value, 0.01) AS full_q01, quantile_cont(value, 0.5) AS full_median,
 quantile_cont(value, 0.99) AS full_q99, max(value) AS full_max, min(value) FILTER (g = 1) AS labeled_min, max(value) FILTER (g = 1) AS labeled_max FROM sm GROUP BY 1""", "full_missing_rate full_min full_q01 full_median full_q99 full_max labeled_min labeled_max")
def feature_contract(spark, sf_dir):
    return mt.feature_contract(_sample(spark, sf_dir).select("g", *[F.col(c).cast("double").alias(c) for c in FEATURES]), FEATURES, "g")


DRAWS = 2000
DRAW = f"""nn AS (SELECT count(*) AS n FROM pd), ix AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS i FROM pd),
 dr AS (SELECT range // n AS draw, CAST('0x' || substr(md5(CAST(range AS VARCHAR)), 1, 8) AS BIGINT) % n AS i FROM nn, range({DRAWS} * (SELECT n FROM nn)))"""
CI = "SELECT metric, avg(value) AS mean, quantile_cont(value, 0.025) AS ci_2_5, quantile_cont(value, 0.975) AS ci_97_5{1} FROM (UNPIVOT m ON {0} INTO NAME metric VALUE value) GROUP BY 1"
CI_COLS = "mean ci_2_5 ci_97_5"


def _numbered(spark, sf_dir):
    """Labelled rows with numbers from 0: counts of blocks first, then places inside each, so no task sorts them all."""
    from pyspark.sql import Window

    d = predictions(spark, sf_dir)
    blocks = d.groupBy(F.floor(F.col("id") / 1000).alias("block")).count()
    before = blocks.withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("block", "before")
    place = F.row_number().over(Window.partitionBy("block").orderBy("id")) - 1
    out = d.withColumn("block", F.floor(F.col("id") / 1000)).withColumn("place", place).join(before, "block").withColumn("i", F.col("place") + F.col("before"))
    return out.drop("block", "place", "before"), d.count()


#: For every draw: rankings by p, ties as one.
DRAW_AP = """
{0}r AS (SELECT draw, s, count(*) AS n, count(*) FILTER (y = 0) AS pos FROM (SELECT draw, y, {1} AS s FROM dx) GROUP BY 1, 2), {0}w AS (SELECT *, sum(n) OVER w AS cn, sum(pos) OVER w AS cp FROM {0}r WINDOW w AS (PARTITION BY draw ORDER BY s DESC)),
{0} AS (SELECT draw, coalesce(sum(pos * cp::DOUBLE / cn) / nullif(sum(pos), 0), 0.0) AS average_precision FROM {0}w GROUP BY 1)"""


@R.add("bootstrap_ci", f"""{WITH}, {DRAW}, dx AS (SELECT draw, y, p0 AS a, p1 AS b, p2 AS c FROM dr JOIN ix USING (i)), {_bundle_ctes('dx', 'mb', 'draw, ').strip()}, {DRAW_AP.format('ap', 'a').strip()},
 m AS (SELECT draw, log_loss, macro_f1, brier_multiclass, ece_10bin, average_precision FROM mb JOIN ap USING (draw)) {CI.format('log_loss, macro_f1, brier_multiclass, ece_10bin, average_precision', '')}""", CI_COLS)
def bootstrap_ci(spark, sf_dir):
    d, n = _numbered(spark, sf_dir)
    rows = barrier(mt.multiplicities(d.select("i", "y", *mt.P), "i", n, DRAWS), "draws")
    m = mt.drawn_bundles(rows, DRAWS).join(mt.drawn_precision(rows, DRAWS, "p0", F.col("y") == 0), "draw")
    return mt.interval(m, "draw", ["log_loss", "macro_f1", "brier_multiclass", "ece_10bin", "average_precision"])


Q = ("q0", "q1", "q2")
BLEND = ", ".join(f"(w * q{k} + (1 - w) * p{k}) / (w * (q0 + q1 + q2) + (1 - w) * (p0 + p1 + p2)) AS b{k}" for k in range(3))
BLENDED = f"bl AS (SELECT *, {BLEND} FROM (SELECT *, [1.0::DOUBLE, 0.5, 0.0][1 + id % 3] AS w FROM pd))"
ANCHOR = ["log_loss", "macro_f1", "brier_multiclass", "brier_macro_ovr", "ece_10bin", "class_change_rate"]


def _anchored(df):
    w = F.get(F.array(F.lit(1.0), F.lit(0.5), F.lit(0.0)), (F.col("id") % 3).cast("int"))
    return df.select("*", *[x.alias(f"b{k}") for k, x in enumerate(mt.blended(mt.P, Q, w))])


@R.add("paired_bootstrap", f"""{WITH}, {BLENDED}, {DRAW.replace('FROM pd)', 'FROM bl)')}, dx AS (SELECT draw, ix.* FROM dr JOIN ix USING (i)), du AS (SELECT draw, y, q0 AS a, q1 AS b, q2 AS c FROM dx), da AS (SELECT draw, y, b0 AS a, b1 AS b, b2 AS c FROM dx),
 {_bundle_ctes('du', 'mu', 'draw, ').strip()}, {_bundle_ctes('da', 'ma', 'draw, ').strip()}, ch AS (SELECT draw, avg(CAST({ARG.format('b')} <> k AS DOUBLE)) - avg(CAST(kq <> k AS DOUBLE)) AS class_change_rate FROM dx GROUP BY 1),
 m AS (SELECT draw, {', '.join(f'ma.{c} - mu.{c} AS {c}' for c in ANCHOR[:-1])}, class_change_rate FROM mu JOIN ma USING (draw) JOIN ch USING (draw)) {CI.format(', '.join(ANCHOR), '')}""", CI_COLS)
def paired_bootstrap(spark, sf_dir):
    d, n = _numbered(spark, sf_dir)
    rows, b = barrier(mt.multiplicities(_anchored(d), "i", n, DRAWS), "draws"), ("b0", "b1", "b2")
    moved = (mt.picked(b) != mt.picked()).cast("double") - (mt.picked(Q) != mt.picked()).cast("double")
    after = mt.drawn_bundles(rows, DRAWS, b, more={"class_change_rate": moved})
    m = mt.differences(mt.drawn_bundles(rows, DRAWS, Q), after, "draw", ANCHOR[:-1]).join(after.select("draw", "class_change_rate"), "draw")
    return mt.interval(m, "draw", ANCHOR)


COMPARED = {"log_loss": True, "macro_f1": False, "brier_multiclass": True, "ece_10bin": True, "average_precision": False}


@R.add("baseline_bootstrap", f"""{WITH}, {DRAW}, dx AS (SELECT draw, ix.* FROM dr JOIN ix USING (i)), dp AS (SELECT draw, y, p0 AS a, p1 AS b, p2 AS c FROM dx), dq AS (SELECT draw, y, q0 AS a, q1 AS b, q2 AS c FROM dx),
 {_bundle_ctes('dp', 'mp', 'draw, ').strip()}, {_bundle_ctes('dq', 'mq', 'draw, ').strip()}, {DRAW_AP.format('ap', 'p0').strip()}, {DRAW_AP.format('aq', 'q0').strip()},
 m AS (SELECT draw, {', '.join(f'mq.{c} - mp.{c} AS {c}' for c in list(COMPARED)[:-1])}, aq.average_precision - ap.average_precision AS average_precision FROM mp JOIN mq USING (draw) JOIN ap USING (draw) JOIN aq USING (draw))
 {CI.format(', '.join(COMPARED), ", avg(CAST(CASE WHEN metric IN ('log_loss', 'brier_multiclass', 'ece_10bin') THEN value < 0 ELSE value > 0 END AS DOUBLE)) AS probability_beneficial")}""", CI_COLS + " probability_beneficial")
def baseline_bootstrap(spark, sf_dir):
    d, n = _numbered(spark, sf_dir)
    rows = barrier(mt.multiplicities(d, "i", n, DRAWS), "draws")
    arm = lambda p: mt.drawn_bundles(rows, DRAWS, p).join(mt.drawn_precision(rows, DRAWS, p[0], F.col("y") == 0), "draw")
    return mt.interval(mt.differences(arm(mt.P), arm(Q), "draw", list(COMPARED)), "draw", list(COMPARED), COMPARED)


@R.add("anchored_blend", f"{WITH}, {BLENDED} SELECT id, b0, b1, b2 FROM bl", "b0 b1 b2")
def anchored_blend(spark, sf_dir):
    return _anchored(predictions(spark, sf_dir)).select("id", "b0", "b1", "b2")


@R.add("temperature_apply", f"{WITH}, l AS (SELECT id, ln(p0) / 1.7 AS a, ln(p1) / 1.7 AS b, ln(p2) / 1.7 AS c FROM pr), e AS (SELECT id, exp(a - greatest(a, b, c)) AS a, exp(b - greatest(a, b, c)) AS b, exp(c - greatest(a, b, c)) AS c FROM l) SELECT id, a / (a + b + c) AS t0, b / (a + b + c) AS t1, c / (a + b + c) AS t2 FROM e", "t0 t1 t2")
def temperature_apply(spark, sf_dir):
    t = tempered([F.col(c) for c in mt.P], 1.7)
    return predictions(spark, sf_dir).select("id", *[x.alias(f"t{k}") for k, x in enumerate(t)])


def _temperature_sql(rounds=5, grid=24):
    """The same search: each round scores a grid of temperatures and narrows around the best."""
    soft = "exp(ln(p{0}) / t - greatest(ln(p0) / t, ln(p1) / t, ln(p2) / t))"
    z = " + ".join(soft.format(k) for k in range(3))
    own = "exp(ln(py) / t - greatest(ln(p0) / t, ln(p1) / t, ln(p2) / t))"
    out = ["r0 AS (SELECT 0.25::DOUBLE AS lo, 5.0::DOUBLE AS hi)"]
    for i in range(rounds):
        out.append(f"g{i} AS MATERIALIZED (SELECT x.j AS j, lo + (hi - lo) * x.j / {grid} AS t FROM r{i}, range({grid + 1}) x(j))")
        out.append(f"b{i} AS MATERIALIZED (SELECT arg_min(j, loss) AS j FROM (SELECT j, avg(-ln(greatest({own} / ({z}), 1e-15))) AS loss FROM g{i}, pd GROUP BY 1))")
        out.append(f"r{i + 1} AS MATERIALIZED (SELECT (SELECT t FROM g{i} g WHERE g.j = greatest(0, b.j - 1)) AS lo, (SELECT t FROM g{i} g WHERE g.j = least({grid}, b.j + 1)) AS hi FROM b{i} b)")
    return f"{WITH}, {', '.join(out)} SELECT (lo + hi) / 2 AS temperature FROM r{rounds}"


@R.add("temperature_fit", _temperature_sql(), "temperature")
def temperature_fit(spark, sf_dir):
    t = mt.fit_temperature(predictions(spark, sf_dir))
    return spark.range(1).select(F.lit(t).alias("temperature"))


QUERIES, ORACLES = R.queries, R.oracles
