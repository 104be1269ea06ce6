"""The submission: one row per template row, its rules, and where it is written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.config import CLASSES
from attestra.sources.files import read_text_csv, write_csv
from attestra.sources.stages import barrier

KEYS = ["candidate_record_id", "phase"]
PROBABILITIES = [f"p_{c}" for c in CLASSES]
COLUMNS = [*KEYS, "predicted_class", *PROBABILITIES, "review_priority"]


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """The (candidate, phase) rows that a submission must have."""
    return read_text_csv(spark, path).select(*KEYS)


def combined(t0: DataFrame, t1: DataFrame) -> DataFrame:
    """Both phases' predictions, a candidate's first phase before its second."""
    return t0.select(*COLUMNS).unionByName(t1.select(*COLUMNS)).orderBy(*KEYS)


def submission(template: DataFrame, predictions: DataFrame) -> DataFrame:
    """The template's rows with their predictions, in the columns of a submission. Either side must have a key once."""
    for name, d in (("template", template), ("predictions", predictions)):
        if d.groupBy(*KEYS).count().where("count > 1").limit(1).count():
            raise ValueError(f"{KEYS} repeat in the {name}")
    return template.select(*KEYS).join(predictions.select(*COLUMNS), KEYS, "left").select(*COLUMNS)


def write_submission(df: DataFrame, paths: list[str]) -> None:
    """The same rows, computed once, as one CSV file in each place."""
    done = barrier(df, "submission")
    for path in paths:
        write_csv(done.orderBy(*KEYS), path, single=True)


def _ordinary(c: str):
    return F.col(c).try_cast("double")


def validate_submission(sub: DataFrame, template: DataFrame, tolerance: float = 1e-8 + 1e-5) -> DataFrame:
    """Violations by rule: (rule, violations). A column that is missing altogether raises ValueError."""
    if missing := [c for c in COLUMNS if c not in sub.columns]:
        raise ValueError(f"missing columns: {missing}")
    extra = len([c for c in sub.columns if c not in COLUMNS])
    rule = lambda name, df: df.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations"))
    key, total = KEYS[0], reduce(lambda a, b: a + b, [_ordinary(c) for c in PROBABILITIES])
    outside = lambda c: F.coalesce(~_ordinary(c).between(0.0, 1.0), F.lit(False))
    anyone = lambda cs: reduce(lambda a, b: a | b, cs)
    # every rule of a row, in one pass
    row = {
        "missing_value": anyone([F.col(c).isNull() | F.coalesce(F.trim(F.col(c).cast("string")) == "", F.lit(False)) for c in sub.columns]),
        "not_numeric": anyone([_ordinary(c).isNull() for c in (*PROBABILITIES, "review_priority")]),
        "probability_range": anyone([outside(c) for c in PROBABILITIES]),
        "priority_range": outside("review_priority"),
        "probability_sum": F.coalesce(F.abs(total - 1.0) > tolerance, F.lit(True)),
        "unknown_class": ~F.coalesce(F.col("predicted_class").isin(*CLASSES), F.lit(False)),
        "unknown_phase": ~F.coalesce(F.col("phase").isin("T0", "T1"), F.lit(False)),
    }
    rows = sub.agg(*[F.count_if(c).alias(n) for n, c in row.items()]).unpivot([], list(row), "rule", "violations")
    size = lambda d, what: d.agg(what.alias("n"))
    apart = lambda name, what: size(sub, what).withColumnRenamed("n", "a").crossJoin(size(template, what)).select(F.lit(name).alias("rule"), F.abs(F.col("a") - F.col("n")).alias("violations"))  # noqa: E731, single rows
    phases = sub.groupBy(key).agg(F.count_if(F.col("phase") == "T0").alias("a"), F.count_if(F.col("phase") == "T1").alias("b"), F.count(F.lit(1)).alias("n"))
    rules = [
        rows, rule("duplicate_key", sub.groupBy(*KEYS).count().where("count > 1")), rule("missing_key", template.select(*KEYS).subtract(sub.select(*KEYS))), rule("extra_key", sub.select(*KEYS).subtract(template.select(*KEYS))),
        rule("phases", phases.where("a = 0 or b = 0 or a + b < n")), apart("row_count", F.count(F.lit(1))), apart("candidate_count", F.countDistinct(key)),
        sub.sparkSession.range(1).select(F.lit("extra_column").alias("rule"), F.lit(extra).cast("long").alias("violations")),
    ]
    return reduce(DataFrame.unionByName, rules)


def refused(violations: DataFrame) -> None:
    """Raises ValueError with the rules that are broken, if any."""
    bad = violations.where("violations > 0").orderBy("rule").collect()
    if bad:
        raise ValueError("submission refused: " + ", ".join(f"{r.rule} ({r.violations})" for r in bad))
