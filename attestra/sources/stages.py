"""Barriers between stages: tables written to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir where it is set; else a temporary folder for local sessions and the warehouse for others."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        local = master.startswith("local") and not master.startswith("local-cluster")
        path = tempfile.mkdtemp(prefix="attestra-") if local else spark.conf.get("spark.sql.warehouse.dir") + "/attestra_stages"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def own_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; what is written there goes when the program ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def barrier(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: later plans begin here, and lost executors cost nothing that is written."""
    path = own_folder(df.sparkSession, f"stages/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):
            if spark.sparkContext._jsc is not None:
                p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
