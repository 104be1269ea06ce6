"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir`` where the cluster names one. Otherwise a
    local session gets a temporary folder, and any other the warehouse.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.startswith(("local[", "local")) and not spark.sparkContext.master.startswith("local-cluster"):
            path = tempfile.mkdtemp(prefix="attestra-")
        else:
            path = spark.conf.get("spark.sql.warehouse.dir") + "/attestra_stages"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts lineage as checkpoint() does, but computes the rows once and
    stores them as compressed columns. A lost executor costs nothing that is
    in the table already.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
        _delete(spark, f)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        if spark.sparkContext._jsc is not None:
            _delete(spark, path)


def row_key(*cols: Column | str) -> Column:
    """128 bits that stand for a row: repeated rows share them, nulls are values."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    marks = [F.isnull(c).cast("int") for c in cols]
    return F.struct(F.xxhash64(*cols, *marks).alias("a"), F.xxhash64(F.lit(7), *marks, *reversed(cols)).alias("b"))


def slices(frame: pd.DataFrame, text: str, rows: int, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """Neighbouring rows of a batch, at most ``rows`` and about ``chars`` characters at a time; a longer text comes alone."""
    at, size = 0, frame[text].str.len().fillna(0).to_numpy(dtype=float) if len(frame) else []
    while at < len(frame):
        n = max(1, int((size[at : at + rows].cumsum() <= chars).sum()))
        yield frame.iloc[at : at + n]
        at += n


def release() -> None:
    """Give memory that is free in this process back to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # of the C library only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInPandas or mapInArrow, and ``release`` once a task's rows are done.

    A worker lives on after its task, and what it holds stands beside the
    memory of the stages that follow.
    """

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components of an undirected edge list: (node, component).

    ``component`` is the smallest node that can be reached. In a round every
    node hooks to its smallest neighbour, if that is smaller; pointers are
    doubled until each names a root, and the roots are the nodes of the next
    round. A root that nothing hooked to hooks itself in the next round, so
    two rounds at least halve the nodes that have edges, whatever the
    diameter, and rounds go on until no edge is left. All are joins and
    grouped minima over tables in the shared folder; the driver sees one count
    a step. Nodes without edges are not in the result.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).union(edges.select(F.col(dst), F.col(src)))
    both = stage(both.where("u <> v").distinct(), "cc-edges")
    labels = None
    while True:
        roots = stage(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("component")), "cc-roots")
        moved = True
        while moved:
            jump = roots.select(F.col("node").alias("component"), F.col("component").alias("top"))
            new = stage(roots.join(jump, "component").select("node", F.col("component").alias("old"), F.col("top").alias("component")), "cc-roots")
            moved = new.where("component <> old").limit(1).count() > 0
            drop_stage(spark, roots)
            roots = new.select("node", "component")
        top = roots.select(F.col("node").alias("component"), F.col("component").alias("top"))
        if labels is None:
            new = roots
        else:
            new = stage(labels.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component")), "cc-labels")
            drop_stage(spark, labels)
        labels = new
        u, v = top.toDF("u", "ru"), top.toDF("v", "rv")
        left = stage(both.join(u, "u").join(v, "v").where("ru <> rv").select(F.col("ru").alias("u"), F.col("rv").alias("v")).distinct(), "cc-edges")
        drop_stage(spark, both)
        both = left
        if not both.limit(1).count():
            return labels
