"""Classifiers with nested out-of-fold probabilities, on Spark ML.

Everything is fitted on labelled rows, which are few beside the rows that are
scored; fits of different folds run side by side as jobs of one session.
"""

from __future__ import annotations

import json
import statistics
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attestra.config import CLASSES
from attestra.functions.values import argmax_class, tempered
from attestra.operators.metrics import P, bundle_by, fit_temperature
from attestra.sources.stages import barrier

#: Configurations that are tried. The boosted ones are this engine's own.
LOGISTIC_GRID = ({"id": "logistic_c_0_1", "kind": "logistic", "C": 0.1}, {"id": "logistic_c_1_0", "kind": "logistic", "C": 1.0})
BOOSTED_GRID = ({"id": "boosted_depth3", "kind": "boosted", "depth": 3, "rounds": 20, "step": 0.1}, {"id": "boosted_depth4", "kind": "boosted", "depth": 4, "rounds": 20, "step": 0.1})
OUTER, INNER, SIDE_BY_SIDE = 5, 3, 4


def stratified_folds(df: DataFrame, key: str, label: str = "label", k: int = 5, seed: str = "42", name: str = "fold") -> DataFrame:
    """Adds ``fold``: rows of a label are dealt in turn, in the order of a seeded digest.

    Places are found in two levels, inside one of 256 ranges of the digest and
    over the ranges, so that no task sorts all rows of a label.
    """
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    d = df.withColumn("_digest", digest).withColumn("_range", F.substring("_digest", 1, 2))
    sizes = d.groupBy(label, "_range").count()
    before = sizes.select(label, "_range", F.coalesce(F.sum("count").over(Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_digest", key)) - 1
    out = d.withColumn("_place", place).join(F.broadcast(before), [label, "_range"])
    return out.withColumn(name, ((F.col("_place") + F.col("_before")) % k).cast("int")).select(*[c for c in df.columns if c != name], name)


class Prepared:
    """Medians, means and deviations of a training fold; imputes, flags missing values, standardises."""

    def __init__(self, features: list[str], median: dict[str, float], flags: list[str], scale: dict[str, list[float]]):
        self.features, self.median, self.flags, self.scale = features, median, flags, scale

    @classmethod
    def of(cls, train: DataFrame, features: list[str]) -> Prepared:
        med = train.agg(*[F.percentile(F.col(c).cast("double"), 0.5).alias(c) for c in features], *[F.count_if(F.col(c).isNull()).alias(f"{c}__n") for c in features]).first()
        out = cls(features, {c: float(med[c]) if med[c] is not None else 0.0 for c in features}, [c for c in features if med[f"{c}__n"]], {})
        s = out._filled(train).agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in out.columns]).first()
        out.scale = {c: [s[c]["m"] or 0.0, s[c]["s"] or 1.0] for c in out.columns}
        return out

    @property
    def columns(self) -> list[str]:
        return [*self.features, *[f"{c}__missing" for c in self.flags]]

    def _filled(self, df: DataFrame) -> DataFrame:
        extra = [c for c in df.columns if c not in self.features]
        return df.select(*extra, *[F.coalesce(F.col(c).cast("double"), F.lit(self.median[c])).alias(c) for c in self.features], *[F.col(c).isNull().cast("double").alias(f"{c}__missing") for c in self.flags])

    def apply(self, df: DataFrame) -> DataFrame:
        f = self._filled(df)
        extra = [c for c in f.columns if c not in self.columns]
        scaled = f.select(*extra, *[((F.col(c) - self.scale[c][0]) / self.scale[c][1]).alias(c) for c in self.columns])
        return VectorAssembler(inputCols=self.columns, outputCol="_features").transform(scaled).select(*extra, "_features")


class Fitted:
    """A fitted classifier with its preparation: scores rows, tells importances, is saved and loaded."""

    def __init__(self, prep: Prepared, models: list, config: dict):
        self.prep, self.models, self.config = prep, models, config

    @classmethod
    def of(cls, train: DataFrame, features: list[str], config: dict, hold: str | None = None) -> Fitted:
        """L2 multinomial logistic regression, or boosted trees one against the rest.

        ``hold``: a column that marks rows on which boosting finds the best
        number of rounds; the others are what it is fitted on.
        """
        rows = train.where(~F.col(hold)) if hold else train
        prep = Prepared.of(rows, features)
        if config["kind"] == "logistic":
            model = LogisticRegression(featuresCol="_features", labelCol="label", family="multinomial", regParam=1 / (config["C"] * max(1, rows.count())), elasticNetParam=0.0, standardization=False, maxIter=200, probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_k")
            return cls(prep, [model.fit(prep.apply(rows.select(*features, "label")))], config)
        data = barrier(prep.apply(train.select(*features, "label", *([hold] if hold else []))), "boosted-train")
        models = []
        for k in range(len(CLASSES)):
            own = data.withColumn("_is", (F.col("label") == k).cast("double"))
            if own.agg(F.countDistinct("_is")).first()[0] < 2:
                models.append(None)
                continue
            gbt = GBTClassifier(featuresCol="_features", labelCol="_is", maxDepth=config["depth"], stepSize=config["step"], maxIter=config["rounds"], seed=42)
            models.append((gbt.setValidationIndicatorCol(hold) if hold else gbt).fit(own))
        return cls(prep, models, config)

    @property
    def rounds(self) -> int:
        return max([m.getNumTrees for m in self.models if m is not None], default=1)

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and p0, p1, p2, which sum to one."""
        d = self.prep.apply(df.select(*keep, *[c for c in self.prep.features if c not in keep]))
        if self.config["kind"] == "logistic":
            d = self.models[0].transform(d).withColumn("_v", vector_to_array("_p"))
        else:
            for k, m in enumerate(self.models):
                if m is None:
                    d = d.withColumn(f"_v{k}", F.lit(0.0))
                    continue
                scored = m.copy({m.probabilityCol: f"_p{k}", m.rawPredictionCol: f"_r{k}", m.predictionCol: f"_k{k}"}).transform(d)
                d = scored.withColumn(f"_v{k}", F.get(vector_to_array(f"_p{k}"), F.lit(1))).drop(f"_p{k}", f"_r{k}", f"_k{k}")
            d = d.withColumn("_v", F.array(*[f"_v{k}" for k in range(len(self.models))]))
        p = [F.greatest(F.coalesce(F.get("_v", F.lit(k)), F.lit(0.0)), F.lit(1e-12)) for k in range(3)]
        total = p[0] + p[1] + p[2]
        return d.select(*keep, *[(x / total).alias(f"p{k}") for k, x in enumerate(p)])

    def importances(self, spark: SparkSession) -> DataFrame:
        """feature, importance, rank: of trees their own, of coefficients the mean size over classes; ties by name."""
        n = len(self.prep.features)
        if self.config["kind"] == "logistic":
            c = self.models[0].coefficientMatrix.toArray()[:, :n]
            values = abs(c).mean(0).tolist()
        else:
            some = [m.featureImportances.toArray()[:n] for m in self.models if m is not None]
            values = (sum(some) / max(1, len(some))).tolist() if some else [0.0] * n
        rows = sorted(zip(self.prep.features, values, strict=True), key=lambda x: (-x[1], x[0]))
        return spark.createDataFrame([(f, float(v), k) for k, (f, v) in enumerate(rows, 1)], "feature string, importance double, rank int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Models as Spark ML saves them, the preparation as one JSON text; any store that Spark writes."""
        meta = {"features": self.prep.features, "median": self.prep.median, "flags": self.prep.flags, "scale": self.prep.scale, "config": self.config, "classes": [m is not None for m in self.models]}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        PipelineModel([m for m in self.models if m is not None]).write().overwrite().save(f"{path}/models")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Fitted:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        stages = iter(PipelineModel.load(f"{path}/models").stages)
        prep = Prepared(meta["features"], meta["median"], meta["flags"], meta["scale"])
        return cls(prep, [next(stages) if there else None for there in meta["classes"]], meta["config"])


def _each(f, items: list) -> list:
    with ThreadPool(min(SIDE_BY_SIDE, max(1, len(items)))) as pool:
        return pool.map(f, items)


def out_of_fold(df: DataFrame, key: str, features: list[str], config: dict | str = "logistic", folds: int = OUTER) -> DataFrame:
    """Every row scored by a model that has not seen it: key, label, fold, p0, p1, p2."""
    if isinstance(config, str):
        config = {"logistic": LOGISTIC_GRID[1], "boosted": BOOSTED_GRID[0]}[config]
    d = barrier(stratified_folds(df.select(key, "label", *features), key, k=folds), "folds")

    def one(k: int) -> DataFrame:
        return Fitted.of(d.where(F.col("fold") != k), features, config).predict(d.where(F.col("fold") == k), [key, "label", "fold"])

    return reduce(DataFrame.unionByName, _each(one, list(range(folds))))


def inner_oof(train: DataFrame, key: str, features: list[str], config: dict, folds: int = INNER, seed: str = "42") -> tuple[DataFrame, list[int]]:
    """Out-of-fold probabilities inside a training part, and the best number of rounds of each boosted fit, found on the fold held out."""
    d = barrier(stratified_folds(train.select(key, "label", *features), key, k=folds, seed=seed, name="inner"), "inner-folds")

    def one(k: int) -> tuple[DataFrame, int]:
        marked = d.withColumn("_hold", F.col("inner") == k)
        fitted = Fitted.of(marked, features, config, "_hold")
        return fitted.predict(d.where(F.col("inner") == k), [key, "label"]), 0 if config["kind"] == "logistic" else fitted.rounds

    done = [one(k) for k in range(folds)]
    return barrier(reduce(DataFrame.unionByName, [x for x, _ in done]), "inner-oof"), [r for _, r in done if r]


@dataclass
class Choice:
    """What is chosen for a training part: a configuration, its calibrated loss and temperature, and the median of its best rounds."""

    config: dict
    loss: float
    temperature: float
    rounds: int | None


def _calibrated(df: DataFrame, t: float) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in P], *[x.alias(c) for x, c in zip(tempered([F.col(c) for c in P], t), P, strict=True)])


def choose_config(train: DataFrame, key: str, features: list[str], grid: tuple[dict, ...], folds: int = INNER, seed: str = "42") -> Choice:
    """The configuration with the least calibrated log loss inside the training part, ties by id."""
    found = []
    for config in grid:
        oof, rounds = inner_oof(train, key, features, config, folds, f"{seed}|{config['id']}")
        y = oof.withColumnRenamed("label", "y")
        t = fit_temperature(y)
        loss = bundle_by(_calibrated(y, t), []).first()["log_loss"]
        found.append((loss, config["id"], Choice(config, loss, t, max(1, int(statistics.median(rounds))) if rounds else None)))
    return min(found, key=lambda x: x[:2])[2]


def _with_rounds(choice: Choice) -> dict:
    return choice.config | ({"rounds": choice.rounds} if choice.rounds else {})


@dataclass
class Nested:
    """Nested validation of one kind of model: out-of-fold rows (key, label, fold, raw and calibrated probabilities) and each fold's choice."""

    rows: DataFrame
    choices: dict[int, Choice]

    @property
    def config(self) -> str:
        """The configuration that most folds chose, ties by id."""
        ids = [c.config["id"] for c in self.choices.values()]
        return min(set(ids), key=lambda x: (-ids.count(x), x))

    def raw(self) -> DataFrame:
        return self.rows.select("label", *[F.col(f"raw{k}").alias(c) for k, c in enumerate(P)]).withColumnRenamed("label", "y")

    def metrics(self) -> DataFrame:
        """The bundle of calibrated probabilities over all folds, and per fold with its choice: fold is null for all."""
        y = self.rows.withColumnRenamed("label", "y")
        spark = self.rows.sparkSession
        chosen = spark.createDataFrame([(k, c.config["id"], c.loss, c.temperature, c.rounds) for k, c in sorted(self.choices.items())], "fold int, selected_config string, inner_calibrated_log_loss double, temperature double, selected_rounds int")
        per_fold = bundle_by(y, ["fold"]).join(chosen, "fold", "left")
        return bundle_by(y, []).unionByName(per_fold, allowMissingColumns=True)


def nested(df: DataFrame, key: str, features: list[str], grid: tuple[dict, ...], outer: int = OUTER, inner: int = INNER, folds: DataFrame | None = None) -> Nested:
    """Choice, temperature and fit of each outer fold see its training part only.

    ``folds`` (key, fold) are saved assignments; otherwise rows are dealt by
    label. Saved folds must hold every row once.
    """
    d = df.select(key, "label", *features)
    d = one_to_one(d, folds.select(key, "fold"), key) if folds is not None else stratified_folds(d, key, k=outer)
    d = barrier(d, "outer-folds")
    parts = sorted(r[0] for r in d.select("fold").distinct().collect())

    def one(k: int) -> tuple[int, Choice, DataFrame]:
        train, test = d.where(F.col("fold") != k), d.where(F.col("fold") == k)
        choice = choose_config(train, key, features, grid, inner, f"42|{k}")
        raw = Fitted.of(train, features, _with_rounds(choice)).predict(test, [key, "label", "fold"])
        kept = raw.select("*", *[F.col(c).alias(f"raw{j}") for j, c in enumerate(P)])
        return k, choice, _calibrated(kept, choice.temperature)

    done = _each(one, parts)
    return Nested(barrier(reduce(DataFrame.unionByName, [x for *_, x in done]), "nested-oof"), {k: c for k, c, _ in done})


@dataclass
class Final:
    fitted: Fitted
    temperature: float
    choice: Choice

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return _calibrated(self.fitted.predict(df, keep), self.temperature)


def final_fit(df: DataFrame, features: list[str], grid: tuple[dict, ...], result: Nested) -> Final:
    """The most common configuration on all labelled rows, with the median of its rounds, and the temperature of the nested raw probabilities."""
    config = next(c for c in grid if c["id"] == result.config)
    own = [c.rounds for c in result.choices.values() if c.config["id"] == result.config and c.rounds]
    choice = Choice(config, float("nan"), fit_temperature(result.raw()), max(1, int(statistics.median(own))) if own else None)
    return Final(Fitted.of(df, features, _with_rounds(choice)), choice.temperature, choice)


def choose_model(boosted: dict, logistic: dict) -> tuple[str, str]:
    """Boosted if its log loss is better by 0.01, or as good with a macro F1 better by 0.02; else logistic. With the reason."""
    gain = logistic["log_loss"] - boosted["log_loss"]
    if gain >= 0.01:
        return "boosted", f"Boosted trees improved calibrated log loss by {gain:.6f}."
    if gain > -0.01 and boosted["macro_f1"] - logistic["macro_f1"] >= 0.02:
        return "boosted", "Log loss was as good, and boosted trees improved macro F1 by 0.02 or more."
    return "logistic", "The simpler model is preferred where the difference is small."


def clear_improvement(before: dict, after: dict, quiet_labels: int) -> bool:
    """The gate for an anchored blend."""
    return before["log_loss"] - after["log_loss"] >= 0.01 and after["brier_multiclass"] <= before["brier_multiclass"] and before["macro_f1"] - after["macro_f1"] <= 0.01 and quiet_labels >= 30


def predictions_table(df: DataFrame, key: str, phase: str, p: tuple[str, ...] = P) -> DataFrame:
    """key, phase, the class probabilities by name, predicted_class and review_priority."""
    cols = [F.col(c) for c in p]
    return df.select(key, F.lit(phase).alias("phase"), *[x.alias(f"p_{c}") for x, c in zip(cols, CLASSES, strict=True)], argmax_class(cols).alias("predicted_class"), cols[0].alias("review_priority"))


def one_to_one(left: DataFrame, right: DataFrame, key: str, whole: bool = True) -> DataFrame:
    """An inner join that must be one to one; with ``whole``, every row on the left must be met. Raises ValueError otherwise."""
    for name, d in (("left", left), ("right", right)):
        if d.groupBy(key).count().where("count > 1").limit(1).count():
            raise ValueError(f"{key} is not unique on the {name}")
    if whole and left.join(right, key, "left_anti").limit(1).count():
        raise ValueError(f"not every {key} on the left is on the right")
    return left.join(right, key)


def update_matrix(priors: DataFrame, deltas: DataFrame, key: str = "candidate_record_id") -> DataFrame:
    """First-phase probabilities as predictors beside what changed: the matrix of the second phase."""
    names = {f"p_{c}": f"p_{c}_t0" for c in CLASSES} | {"review_priority": "priority_t0", "prediction_origin": "prediction_origin_t0"}
    some = priors.select(key, *[F.col(c).alias(n) for c, n in names.items() if c in priors.columns])
    return one_to_one(some, deltas, key, whole=False)


def predictors(matrix: DataFrame, key: str = "candidate_record_id", without: tuple[str, ...] = ("label", "fold", "outer_fold", "priority_t0", "prediction_origin_t0")) -> list[str]:
    """Columns that a second-phase model may see; the probabilities of the first must be among them."""
    out = [c for c in matrix.columns if c != key and c not in without]
    if missing := {f"p_{c}_t0" for c in CLASSES} - set(out):
        raise ValueError(f"prior predictors are missing: {sorted(missing)}")
    return out


def probability_sum_error(df: DataFrame, p: list[str]) -> DataFrame:
    total = reduce(lambda a, b: a + b, [F.col(c) for c in p])
    return df.agg(F.max(F.abs(total - 1)).alias("probability_sum_max_error"))


