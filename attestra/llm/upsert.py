"""Copy-on-write keyed upsert: Parquet files of sorted keys, of which only those with changed rows are written anew."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestra.llm.common import shared_dir, stage


def _in_order(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` in ranges of ``key``, written, with the number of its range as ``part``: what comes before a row lies in its own range or in lower ones."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(df.repartitionByRange(n, key).sortWithinPartitions(key).withColumn("part", F.spark_partition_id()), name)


def _write_files(rows: DataFrame, files: int, folder: str) -> None:
    """One Parquet file for each number in ``file``, of the structs ``row`` in the order of ``key``; one task writes each as it reads its rows."""
    if files:
        rows.repartitionById(files, F.col("file").cast("int")).sortWithinPartitions("key", "row").select("row.*").write.mode("append").parquet(folder)


def write_sorted(base: DataFrame, key: str, rows_per_file: int, folder: str) -> str:
    """Writes ``base``, all columns in order, as Parquet files of ``rows_per_file`` rows sorted by ``key``; the last has the rest.

    Ranks are places in ranges of the key plus the rows of lower ranges: no
    task sees more than a range. Null keys come first, rows of one key stand
    in the order of their columns, and an empty table gives a folder without
    data files. Returns the folder.
    """
    spark = base.sparkSession
    rows = _in_order(base.select(F.col(key).alias("key"), F.struct(*base.columns).alias("row")), "key", "upsert-start")
    counts = rows.groupBy("part").count()
    # one row for each range
    before = counts.select("part", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("key", "row")) + F.col("before") - 1
    n = counts.agg(F.sum("count")).first()[0] or 0
    _path(spark, folder)[0].mkdirs(_path(spark, folder)[1])
    _write_files(rows.join(F.broadcast(before), "part").select("key", "row", F.floor(place / rows_per_file).alias("file")), -(-n // rows_per_file), folder)
    return folder


def _path(spark: SparkSession, uri: str):
    """The store that a path lies in, and the path."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)) if ":" in uri else jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def files_of(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All rows of a folder's files with ``_path`` and ``_row``, the place of a row in its file."""
    return spark.read.schema(schema).parquet(folder).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))


def _join_neighbours(rows_per_file: int):
    def run(groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values(["home", "piece"])
        first, total, to = -1, 0, []
        for place, size in zip(groups["place"], groups["size"], strict=True):
            first, total = (first, total + size) if to and total + size <= rows_per_file else (place, size)
            to.append(first)
        return groups.assign(to=to)[["home", "piece", "to"]]

    return run


def upsert(
    spark: SparkSession, folder: str, schema, changes: DataFrame, key: str, order: list[str], sets: list[str], rows_per_file: int,
    ignored: Column | None = None, deleted: Column | None = None,
) -> DataFrame:
    """Applies the last change of each key to the files of a folder, which hold sorted, disjoint ranges of ``key``.

    A key's change is that with the greatest ``order`` columns. ``ignored``
    and ``deleted`` tell what it does, over ``first`` (the first key of the
    key's home) and ``change`` (the change's columns); any other sets the
    columns ``sets``, nulls included, and inserts an absent key with nulls
    elsewhere. A key's home is the last file that begins at or below it, or
    the first file. Files whose rows then differ are written anew as the
    fewest sorted files of at most ``rows_per_file`` rows, of sizes at most
    one apart, larger first; then each of these, ascending, is joined to the file before
    it if that is new too and both fit. Files that are left without rows go.

    Rows are not joined: base and changes are united and grouped by key once,
    with map-side maxima, so a key with many changes costs each task one row.
    Keys are then ranked in ranges; a key's home is the greatest home so far.
    What knows all files (a row for each) decides on cuts. New files are
    written before old ones are deleted, and a run that broke off leaves a
    folder that has both.

    Returns path, first, n_rows and rewritten of each file. Null keys are a
    key that sorts first. Base rows that repeat a key become the greatest of
    them, and their file is written anew. Equal changes are one. Of changes that tie in ``order``
    the greatest in the other columns wins. A change for an empty folder has a null
    ``first``; tests that come out null don't hold. Columns of ``changes``
    besides key, order, sets and what the tests read may have any name.
    Without changes no file is touched.
    """
    columns = [f.name for f in schema]
    old = files_of(spark, folder, schema)
    files = old.groupBy("_path").agg(F.min(key).alias("first"), F.min(F.struct(F.col(key).isNotNull(), key)).alias("begin"), F.count(F.lit(1)).alias("n"))
    files = stage(files.select("_path", "first", "n", (F.row_number().over(Window.orderBy("begin", "_path")) - 1).alias("home")), "upsert-files")

    base = old.join(files.select("_path", F.struct("home", "first").alias("home")), "_path").select(F.col(key).alias("key"), F.struct(*columns).alias("base"), "home")
    first_order = [*order, *[c for c in changes.columns if c not in order]]
    change = F.struct(*[F.col(c) for c in first_order])
    both = base.unionByName(changes.select(F.col(key).alias("key"), change.alias("change")), allowMissingColumns=True)
    keyed = both.groupBy("key").agg(F.max("base").alias("base"), F.count("base").alias("copies"), F.max("home").alias("home"), F.max_by("change", "change").alias("change"))
    keyed = _in_order(keyed, "key", "upsert-keys")

    # one row for each range: the last home that begins in lower ones
    so_far = keyed.groupBy("part").agg(F.max("home").alias("last"))
    so_far = so_far.select("part", F.max("last").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    head = files.where("home = 0").select("home", "first").first()
    start = F.struct(F.lit(0).alias("home"), F.lit(head["first"] if head else None).cast(schema[key].dataType).alias("first"))
    running = F.max("home").over(Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    homed = keyed.join(F.broadcast(so_far), "part").withColumn("at", F.coalesce(running, "before", start)).withColumn("first", F.col("at.first"))

    no = F.lit(False)
    acts = F.col("change").isNotNull() & ~F.coalesce(ignored if ignored is not None else no, no)
    gone = F.coalesce(deleted if deleted is not None else no, no)
    made = F.struct(*[
        (F.col("key") if c == key else F.col(f"change.{c}") if c in sets else F.col(f"base.{c}")).cast(schema[c].dataType).alias(c) for c in columns
    ])
    now = F.when(~acts, F.col("base")).when(~gone, made)
    decided = homed.select("part", F.col("at.home").alias("home"), "key", "base", "copies", now.alias("now"))
    decided = decided.select("part", "home", "key", "now", (~F.col("base").eqNullSafe(F.col("now")) | (F.col("copies") > 1)).alias("differs"))
    decided = stage(decided, "upsert-rows")

    # a row for each file and range from here to the cuts
    spread = stage(decided.groupBy("home", "part").agg(F.max("differs").alias("differs"), F.count("now").alias("rows")), "upsert-spread")
    homes = spread.groupBy("home").agg(F.max("differs").alias("differs"), F.sum("rows").alias("rows"))
    n = F.ceil(F.col("rows") / rows_per_file)
    small, more = F.floor(F.col("rows") / n), F.col("rows") % n
    sizes = F.when(~F.col("differs"), F.array("rows")).when(F.col("rows") > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: small + F.when(i < more, 1).otherwise(0)))
    pieces = homes.select("home", "differs", F.posexplode(sizes).alias("piece", "size"))
    by_place = Window.orderBy("home", "piece")
    pieces = pieces.withColumn("place", F.row_number().over(by_place)).withColumn("island", F.sum((~F.col("differs")).cast("int")).over(by_place))
    joined = pieces.where("differs").groupBy("island").applyInPandas(_join_neighbours(rows_per_file), "home int, piece int, to int")
    cuts = stage(joined.select("home", "piece", (F.dense_rank().over(Window.orderBy("to")) - 1).alias("file")), "upsert-cuts")
    made_files = cuts.agg(F.max("file")).first()[0]

    if made_files is not None:
        cut = homes.where("differs").select("home", "rows", n.alias("n")).join(cuts.groupBy("home").agg(F.transform(F.array_sort(F.collect_list(F.struct("piece", "file"))), lambda x: x["file"]).alias("to")), "home")
        ahead = spread.select("home", "part", F.coalesce(F.sum("rows").over(Window.partitionBy("home").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
        place = F.row_number().over(Window.partitionBy("part", "home").orderBy("key")) - 1 + F.col("ahead")
        fresh = decided.where("now is not null").join(cut, "home").join(ahead, ["home", "part"]).withColumn("place", place)
        bigger = F.col("rows") % F.col("n")
        size = F.floor(F.col("rows") / F.col("n"))
        piece = F.when(F.col("place") < bigger * (size + 1), F.floor(F.col("place") / (size + 1))).otherwise(bigger + F.floor((F.col("place") - bigger * (size + 1)) / size))
        _write_files(fresh.select("key", F.col("now").alias("row"), F.get("to", piece.cast("int")).alias("file")), made_files + 1, folder)
    stale = files.join(homes.where("differs").select("home"), "home").select("_path")
    for row in stale.toLocalIterator():  # a path for each file
        store, path = _path(spark, row[0])
        store.delete(path, False)
    found = files_of(spark, folder, schema).groupBy("_path").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n_rows"))
    return found.join(files.select("_path", F.lit(True).alias("stayed")), "_path", "left").select(F.col("_path").alias("path"), "first", "n_rows", F.col("stayed").isNull().alias("rewritten"))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hash_mod(value: Column, n: int) -> Column:
    return F.crc32(value.cast("string")) % n


def upsert_clients(spark: SparkSession, clients: DataFrame, changes: DataFrame) -> tuple[DataFrame, str]:
    """The contract's table: part of ``clients`` as starting files in a new folder, then ``changes``. The files, and the folder."""
    size = 1 + clients.count() // 1000
    folder = write_sorted(clients.where(hash_mod(F.col("client_id"), 7) > 3), "client_id", size, new_folder(spark, "upsert"))
    h = hash_mod(F.col("first"), 16)
    out = upsert(
        spark, folder, clients.schema, changes, "client_id", ["seq", "change_id"], ["source", "segment", "city", "balance"], size,
        ignored=h > 7, deleted=(F.col("change.op") == "D") | (hash_mod(F.col("change.change_id"), 8) < h),
    )
    return out, folder


def digest(spark: SparkSession, files: DataFrame, folder: str, schema) -> DataFrame:
    """What each file holds, read back from it: sums and hashes over its rows, in its order."""
    rows = files_of(spark, folder, schema)
    marks = F.crc32(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in ("source", "segment", "city")]))
    cents = F.coalesce(F.floor(100 * F.col("balance") + 0.5), F.lit(0))
    held = rows.groupBy(F.col("_path").alias("path")).agg(
        F.min_by("client_id", "_row").alias("first_id"), F.count(F.lit(1)).alias("n_rows"), F.sum(cents).alias("cents"), F.sum(marks).alias("rows_crc"),
        F.array_sort(F.collect_list(F.struct("_row", "client_id"))).alias("ids"),
    )
    ids = F.sha2(F.array_join(F.transform("ids", lambda x: F.coalesce(x["client_id"].cast("string"), F.lit(""))), ","), 256)
    return held.join(files.select("path", "rewritten"), "path").select(
        "first_id", "n_rows", "cents", "rows_crc", ids.alias("ids_sha256"), F.lit(",".join(f.name for f in schema)).alias("columns"), "path", "rewritten"
    )
