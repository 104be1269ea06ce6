"""Readers and writers: CSV as text or typed, JSON, optional files, sinks, manifests."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Iterator
from pathlib import Path
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from attestra.config import SOURCE_SPECS, SourceSpec

T = TypeVar("T")


def read_text_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV (plain or gzip) with every column as text and blanks kept as ''. Without ``columns`` the header names them."""
    names = columns or spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in names])
    return spark.read.schema(schema).options(header=True, multiLine=False, escape='"', emptyValue="", nullValue="\x00").csv(path).na.fill("")


def read_sources(spark: SparkSession, root: str, specs: dict[str, SourceSpec] = SOURCE_SPECS) -> dict[str, DataFrame]:
    """The sources of a linkage run under a folder, every column as text, by the names of their headers."""
    return {name: read_text_csv(spark, f"{root}/{spec.path}") for name, spec in specs.items()}


def read_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV of a given schema; a value that doesn't fit fails the read."""
    return spark.read.schema(schema).options(header=True, escape='"', mode="FAILFAST").csv(path)


def strict_date(value: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """A date; a text that is none fails the query."""
    return F.when(F.try_to_date(value, pattern).isNull(), F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(value, F.lit("null")))).cast("date")).otherwise(F.try_to_date(value, pattern))


def lenient_date(value: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(F.nullif(F.trim(value), F.lit("")), pattern)


def number(value: Column) -> Column:
    """A number, or null where the text is none."""
    return value.cast("string").try_cast("double")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Candidates as text, with ``candidate_dt`` from the day they were observed, which must be a valid date."""
    return read_text_csv(spark, path).withColumn("candidate_dt", strict_date(F.col("candidate_observed_date")))


def read_cases(spark: SparkSession, path: str, key: str = "candidate_record_id") -> DataFrame:
    """Predictions in long form as a row per case: t0_ and t1_ class, confidence and priority, null where a phase is missing."""
    p = read_text_csv(spark, path)
    probs = [number(F.col(c)) for c in p.columns if c.startswith("p_")]
    rows = p.select(key, F.lower("phase").alias("phase"), F.col("predicted_class").alias("class"), F.greatest(*probs).alias("confidence"), number(F.col("review_priority")).alias("priority"))
    wide = rows.groupBy(key).pivot("phase", ["t0", "t1"]).agg(*[F.first(c).alias(c) for c in ("class", "confidence", "priority")])
    return wide


def read_oof(spark: SparkSession, path: str, model: str) -> DataFrame:
    """Out-of-fold predictions of one model; the filter reaches the scan."""
    rows = read_text_csv(spark, path)
    return rows.where(F.col("model_name") == model).select(*[number(F.col(c)).alias(c) if c.startswith("p_") else F.col(c) for c in rows.columns])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A nested JSON document as one row."""
    return spark.read.option("multiLine", True).json(path)


def load_rules(path: str, kind: type[T]) -> T:
    """Rules from a JSON file: fields that it names replace the defaults; names that are no field raise ValueError."""
    given = json.loads(Path(path).read_text())
    fields = {f.name: f for f in dataclasses.fields(kind)}
    if unknown := set(given) - set(fields):
        raise ValueError(f"no such rule: {sorted(unknown)}")
    return kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})


def freeze(path: str, folder: str) -> str:
    """A copy of a file, byte for byte; its place."""
    target = Path(folder) / Path(path).name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_bytes(Path(path).read_bytes())
    return str(target)


def numeric_columns(df: DataFrame, without: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in without]


def columns_without(df: DataFrame, *names: str) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if c not in names])


def same_ids(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether two tables have the same ids."""
    return not a.select(key).exceptAll(b.select(key)).limit(1).count() and not b.select(key).exceptAll(a.select(key)).limit(1).count()


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one of this schema where there is none; any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    (df.coalesce(1) if single else df).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def write_json(values: dict, path: str) -> None:
    Path(path).write_text(json.dumps(values, indent=2, sort_keys=True) + "\n")


def write_report(title: str, tables: dict[str, DataFrame], path: str, most: int = 50) -> None:
    """A Markdown report of small tables."""
    out = [f"# {title}", ""]
    for name, df in tables.items():
        rows = df.limit(most).collect()
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(str(v) for v in r) + " |" for r in rows), ""]
    Path(path).write_text("\n".join(out))


def csv_lines(df: DataFrame) -> Iterator[str]:
    """A table as lines of CSV, a partition at a time, for a response that is streamed."""
    import csv
    import io

    def line(values: list[object]) -> str:
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerow(["" if v is None else v for v in values])
        return out.getvalue()

    yield line(list(df.columns))
    for row in df.toLocalIterator():
        yield line(list(row))


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows to a log; nothing in it is rewritten."""
    df.write.mode("append").parquet(path)


def code_hash(folder: str) -> str:
    """A digest over the names and bytes of all Python files of a folder."""
    h = hashlib.sha256()
    for f in sorted(Path(folder).rglob("*.py")):
        h.update(str(f.relative_to(folder)).encode() + b"\0" + f.read_bytes() + b"\0")
    return h.hexdigest()


def manifest(folder: str, paths: list[str]) -> dict[str, str]:
    """Digests of files by their name in a folder."""
    return {str(Path(p).relative_to(folder)): file_hash(p) for p in sorted(paths)}


def file_hash(path: str, chunk: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(chunk):
            h.update(block)
    return h.hexdigest()


def content_hash(df: DataFrame) -> str:
    """A digest of a table's rows that no order or partitioning changes: sums of row hashes."""
    cols = [F.col(c) for c in sorted(df.columns)]
    row = df.agg(F.count(F.lit(1)), *[F.sum(F.xxhash64(F.lit(k), *cols).cast("decimal(38,0)")) for k in range(2)]).first()
    return hashlib.sha256("|".join(map(str, row)).encode()).hexdigest()
