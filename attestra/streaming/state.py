"""Streams that keep state: reviews in a state store, feeds that arrive in drops, late rows, merges that may run again."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructField, StructType

from attestra.sources.stages import own_folder

#: Commands of a review: status sets, tag adds, untag pulls.
ACTIONS = ("status", "tag", "untag")
_STORE = "spark.sql.streaming.stateStore.providerClass"


def newest_commands(commands: DataFrame) -> DataFrame:
    """A row (key, case) for each key of a table of commands: as JSON, the place ``seen`` of its last command, what last ``put`` its status, and for each of its ``tags`` the last command.

    Of two commands at one place the greater status, and tag before untag, is the last.
    """
    setting, on_tag = F.col("action") == "status", (F.col("action") != "status") & (F.col("value") != "")
    place = [F.col("at").cast("long").alias("at"), F.col("seq").cast("long").alias("seq")]
    by_tag = commands.groupBy("key", F.when(on_tag, F.col("value")).alias("tag")).agg(
        F.max(F.struct(*place)).alias("seen"), F.max(F.when(setting, F.struct(*place, F.col("value").alias("status")))).alias("put"), F.max(F.when(on_tag, F.struct(*place, (F.col("action") == "tag").alias("held")))).alias("last")
    )
    tags = F.map_from_entries(F.collect_list(F.when(F.col("tag").isNotNull(), F.struct("tag", "last"))))
    one = by_tag.groupBy("key").agg(F.max("seen").alias("seen"), F.max("put").alias("put"), tags.alias("tags"))
    return one.select("key", F.to_json(F.struct("seen", "put", "tags")).alias("case"))


def _later(new: dict, old: dict | None) -> dict:
    return new if old is None or (new["at"], new["seq"]) > (old["at"], old["seq"]) else old


class ReviewState(StatefulProcessor):
    """The state of a case: its status with the place of the command that set it, and each tag with that of the last command on it.

    A command counts if it is later, by (at, seq), than the one that its
    status or tag has from before, so batches may come in any order and twice.
    Input are rows of ``newest_commands``, and the state is such a case: one
    value of the store, read and written once for each key of a batch, since the
    row that is put out has all its tags anyway. A case without a
    command for ``idle`` milliseconds of processing time is put out as idle by a timer.
    """

    def __init__(self, idle: int | None = None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.case = handle.getValueState("case", "case string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        case = self._case()
        for row in rows:
            new = json.loads(row.case)
            tags = new.pop("tags")
            case |= {part: _later(x, case.get(part)) for part, x in new.items()}
            case["tags"] |= {tag: _later(x, case["tags"].get(tag)) for tag, x in tags.items()}
        self.case.update((json.dumps(case),))
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        yield self._row(key, case, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield self._row(key, self._case(), True)

    def _case(self) -> dict:
        found = self.case.get()
        return json.loads(found[0]) if found else {"tags": {}}

    def _row(self, key, case: dict, idle: bool) -> Row:
        status = case["put"].get("status") if "put" in case else "unreviewed"
        return Row(key=key[0], reviewer_status=status, reviewer_tags=sorted(t for t, x in case["tags"].items() if x["held"]), at=case["seen"]["at"], idle=idle)

    def close(self) -> None:
        pass


@contextlib.contextmanager
def _stored(spark: SparkSession) -> Iterator[None]:
    """Queries that start within keep their state in the store that map and value states need."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, before) if before else spark.conf.unset(_STORE)


def drain(stream: DataFrame, base: str, put: Callable[[DataFrame, int], None], mode: str = "append", once: bool = False) -> None:
    """Runs a stream over what has come since the last run on the checkpoint in ``base``; ``once``: as one batch. ``put`` gets each batch and its number, and must not mind to get one again."""
    when = {"once": True} if once else {"availableNow": True}
    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{base}/checkpoint").trigger(**when).start().awaitTermination()


def review_states(commands: DataFrame, base: str, idle: int | None = None) -> None:
    """Keeps the states of a stream of commands (key, at, seq, action, value), and writes what changed in a batch to ``base``/out/batch=<n>.

    Commands without a key, place or action known are no commands. A first stream writes
    the last ones of each key in a batch to ``base``/newest, by built-in functions; a second one
    brings these to the store, so that has a row a key to read, however many commands came. The store is partitioned
    by key and checkpointed in ``base``, so a run that follows goes on where this one ended.
    With ``idle`` timers are kept, and a run is one batch, since clocks never have no more to come.
    """
    spark = commands.sparkSession
    known = commands.where(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("seq").isNotNull() & F.col("action").isin(*ACTIONS))
    kind = dict(commands.dtypes)["key"]
    drain(known, f"{base}/commands", lambda batch, k: newest_commands(batch).write.mode("overwrite").parquet(f"{base}/newest/batch={k}"))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/newest")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    newest = spark.readStream.schema(f"key {kind}, case string").option("recursiveFileLookup", True).parquet(f"{base}/newest")
    held = newest.groupBy("key").transformWithState(ReviewState(idle), f"key {kind}, reviewer_status string, reviewer_tags array<string>, at long, idle boolean", "Update", "None" if idle is None else "ProcessingTime")
    with _stored(spark):
        drain(held, base, lambda batch, k: batch.write.mode("overwrite").parquet(f"{base}/out/batch={k}"), "update", idle is not None)


def newest_states(spark: SparkSession, base: str, schema: str | StructType) -> DataFrame:
    """The last row of each key that ``review_states`` wrote."""
    out = spark.read.schema(schema).parquet(f"{base}/out")
    return out.groupBy("key").agg(F.max_by(F.struct("reviewer_status", "reviewer_tags"), F.col("batch")).alias("s")).select("key", "s.*")


def in_drops(df: DataFrame, drop: Column, name: str, run: Callable[[str, str], None]) -> str:
    """Lets a table arrive as files, one drop after the other, and runs ``run(folder, base)`` after each: a new stream on the same checkpoint. Returns ``base``. ``drop`` must have few values."""
    spark = df.sparkSession
    base = own_folder(spark, f"streams/{name}")
    folder = f"{base}/in"
    marked = df.withColumn("_drop", drop)
    for (value,) in marked.select("_drop").distinct().orderBy("_drop").collect():
        marked.where(F.col("_drop").eqNullSafe(F.lit(value))).drop("_drop").write.mode("append").parquet(folder)
        run(folder, base)
    return base


def lags(stream: DataFrame, event: str, observed: str, late: int, base: str) -> None:
    """Counts a stream's delays batch by batch: rows, seconds from ``event`` to ``observed``, delays of over 30 days, and rows that come late.

    A row is late if its event is more than ``late`` seconds before the newest
    event of earlier batches, which is where a watermark would stand. Late
    rows are counted and kept, in ``base``/late, not lost. A batch that runs
    again replaces its own folders, and reads only those of lower numbers.
    """
    spark = stream.sparkSession
    seconds = F.unix_timestamp(observed) - F.unix_timestamp(event)

    def put(batch: DataFrame, k: int) -> None:
        known = spark.read.schema("top long, batch long").parquet(f"{base}/lags") if k else None
        top = known.where(F.col("batch") < k).agg(F.max("top")).first()[0] if known else None
        behind = F.coalesce(F.unix_timestamp(event) < F.lit(top).cast("long") - late, F.lit(False))
        batch.where(behind).write.mode("overwrite").parquet(f"{base}/late/batch={k}")
        batch.agg(
            F.count(F.lit(1)).alias("rows"), F.count(seconds).alias("timed"), F.sum(seconds).alias("seconds"), F.max(seconds).alias("longest"), F.count_if(seconds > 30 * 86400).alias("over_30_days"),
            F.count_if(behind).alias("late"), F.max(F.unix_timestamp(event)).alias("top"),
        ).write.mode("overwrite").parquet(f"{base}/lags/batch={k}")

    drain(stream, base, put)


def lag_metrics(spark: SparkSession, base: str) -> DataFrame:
    """One row of what ``lags`` counted over all batches."""
    each = spark.read.schema("rows long, timed long, seconds long, longest long, over_30_days long, late long").parquet(f"{base}/lags")
    some = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return each.agg(some("rows").alias("rows"), F.try_divide(F.sum("seconds").cast("double"), F.sum("timed")).alias("mean_seconds"), F.max("longest").alias("longest_seconds"), some("over_30_days").alias("over_30_days"), some("late").alias("late_rows"))


def merge(stream: DataFrame, base: str, key: str, order: list[str], gone: Column | None = None) -> None:
    """Applies corrections by record id: after each batch ``base``/current/v=<n> is the table with the last row of each key, by ``order``.

    Batch n reads version n - 1 and writes version n anew, so a batch that
    runs again gives the same table, and a row that comes twice changes
    nothing. ``gone`` marks rows that delete; they stay in the table as marks, so that an
    older row that comes later does not bring a key back.
    """
    spark = stream.sparkSession
    rest = [c for c in stream.columns if c != key]

    def put(batch: DataFrame, k: int) -> None:
        rows = batch.withColumn("_gone", F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)))
        if k:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{base}/current/v={k - 1}"))
        last = F.max_by(F.struct(*rest, "_gone"), F.struct(*order, *[c for c in rest if c not in order]))
        rows.groupBy(key).agg(last.alias("s")).select(key, "s.*").write.mode("overwrite").parquet(f"{base}/current/v={k}")

    drain(stream, base, put)


def reload(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The newest whole version that ``merge`` wrote, without deleted keys; a version that a run left unfinished is not read."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/current")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [int(x.getPath().getParent().getName()[2:]) for x in store.globStatus(jvm.org.apache.hadoop.fs.Path(path, "v=*/_SUCCESS")) or []]
    if not found:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField("_gone", BooleanType())])).parquet(f"{base}/current/v={max(found)}")
    return rows.where("not _gone").select(*schema.fieldNames())
