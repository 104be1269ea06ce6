"""A search index over evidence, and queues that are sorted once: pages and searches read only the folders that they need."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from attestra.config import SOURCES
from attestra.functions.values import STATES
from attestra.operators.review import KINDS, known_state
from attestra.sources.stages import own_folder

#: Ends a text, so that its last letters begin a gram too.
END = "\x03"
#: Grams of a search that are met; the rarest ones.
MOST_GRAMS = 4
#: Files over which a folder's rows are dealt, so that a frequent gram or candidate fills no single task.
SPREAD = 8


def searched_text(key: str = "candidate_record_id") -> Column:
    """What a search looks into: id, record id, vehicle, state code and type, in small letters."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(x.cast("string"), F.lit("")) for x in (F.col(key), F.col("source_record_id"), F.col("vehicle_ref"), known_state(F.col("state")), F.col("event_type"))]))


def grams(text: str) -> list[str]:
    """The different trigrams of a text; one of fewer letters stands for the trigrams that begin with it."""
    return sorted({text[k : k + 3] for k in range(max(1, len(text) - 2))})


@dataclass
class SearchIndex:
    """Evidence in ``folder``/rows/part=, its trigrams in ``folder``/grams/bucket= in their order, and how many rows have each in ``folder``/counts/bucket=."""

    spark: SparkSession
    folder: str
    schema: StructType
    buckets: int

    def _read(self, name: str) -> DataFrame:
        kind = {"grams": "part int, row long, gram string, bucket int", "counts": "gram string, n long, bucket int"}.get(name, self.schema)
        return self.spark.read.schema(kind).parquet(f"{self.folder}/{name}")

    def _has(self, gram: str) -> Column:
        """Rows of the tables of grams that a gram of a search stands for: one bucket's, or those that begin with it."""
        if len(gram) < 3:
            return F.col("gram").startswith(gram)
        return (F.col("bucket") == _slot(F.lit(gram), self.buckets)) & (F.col("gram") == gram)

    def candidates(self, text: str) -> DataFrame:
        """Rows that have the rarest grams of a text: (part, row). Rows that hold the text are among them."""
        each = grams(text)
        if len(each) > 1:
            # a row a gram of the search
            n = dict(self._read("counts").where(reduce(lambda a, b: a | b, [self._has(g) for g in each])).select("gram", "n").collect())
            each = sorted(each, key=lambda g: (n.get(g, 0), g))[:MOST_GRAMS]
        found = self._read("grams").where(reduce(lambda a, b: a | b, [self._has(g) for g in each]))
        if len(each) == 1:
            return found.select("part", "row").distinct()
        # a row has a gram once
        return found.groupBy("part", "row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(each)).select("part", "row")

    def rows(self, texts: list[str]) -> DataFrame:
        """Rows that hold one of the texts, with all their columns. No more numbers than there are parts pass the driver."""
        found = reduce(DataFrame.unionByName, [self.candidates(t) for t in texts]).distinct()
        here = [r[0] for r in found.select("part").distinct().collect()]
        held = reduce(lambda a, b: a | b, [F.col("_text").contains(t) for t in texts])
        return self._read("rows").where(F.col("part").isin(here) & held).join(found, ["part", "row"], "left_semi").drop("part", "row")

    def search(self, q: str = "", src: str = "all", state: str = "all", limit: int = 50) -> DataFrame:
        """What review.evidence_search finds. Searches for nothing read all rows, as they must."""
        ask, src = q.strip().lower(), {v: k for k, v in KINDS.items()}.get(src, src)
        rows = self.rows([ask, STATES[ask].lower()] if ask in STATES else [ask]) if ask else self._read("rows").drop("part", "row")
        rows = rows.where(F.col("src").isin(*SOURCES) if src in (None, "all", "") else F.col("src") == src).withColumn("state", known_state(F.col("state")))
        if state not in (None, "all", ""):
            rows = rows.where(F.col("state") == state)
        return rows.drop("_text").orderBy(F.desc_nulls_last("event_dt"), "source_record_id").limit(limit)


def _slot(x: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(x), F.lit(n)).cast("int")


def search_index(evidence: DataFrame, key: str = "candidate_record_id", parts: int = 64, buckets: int = 64) -> SearchIndex:
    """Writes the index of a table of evidence. ``parts`` and ``buckets`` are folders: take as many as give each some files of usual size.

    Rows are dealt by candidate and get a number that stays, as it is written
    before anything reads it. A row's different trigrams are postings; they
    lie sorted in their bucket, so a search reads the row groups of its grams.
    Rows that repeat are rows of their own. Names ``part``, ``row`` and ``_text`` are the index's.
    """
    spark, folder = evidence.sparkSession, own_folder(evidence.sparkSession, "search-index")
    r = evidence.withColumn("_text", searched_text(key)).withColumn("part", _slot(F.col(key), parts))
    r = r.repartition("part", F.pmod(F.xxhash64("source_record_id"), F.lit(SPREAD))).withColumn("row", F.monotonically_increasing_id())
    r.write.partitionBy("part").parquet(f"{folder}/rows")
    padded = F.concat("_text", F.lit(END * 2))
    each = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_text")), lambda k: F.substr(padded, k, F.lit(3))))
    index = SearchIndex(spark, folder, r.schema, buckets)
    p = index._read("rows").where(F.length("_text") > 0).select("part", "row", F.explode(each).alias("gram")).withColumn("bucket", _slot(F.col("gram"), buckets))
    p.repartition("bucket", F.pmod("row", F.lit(SPREAD))).sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{folder}/grams")
    n = index._read("grams").groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("n"))
    n.repartition("bucket").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(f"{folder}/counts")
    return index


@dataclass
class Queue:
    """A table in an order, in ``folder``/range=: ``starts`` are the place of each range's first row, and ``total`` how many rows there are."""

    spark: SparkSession
    folder: str
    schema: StructType
    order: list[tuple[str, bool]]
    starts: list[tuple[int, int]]
    total: int

    def _rows(self, first: int, last: int) -> DataFrame:
        """Rows with places from ``first`` on and before ``last``: of their ranges alone."""
        ends = [*(s for _, s in self.starts), self.total][1:]
        here = [r for (r, s), e in zip(self.starts, ends, strict=True) if s < last and e > first]
        begin = reduce(lambda c, x: c.when(F.col("range") == x[0], x[1]), [x for x in self.starts if x[0] in here], F.when(F.lit(False), 0))
        rows = self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows").where(F.col("range").isin(here))
        return rows.withColumn("place", (F.col("place") + begin).cast("long")).where((F.col("place") >= first) & (F.col("place") < last)).drop("range")

    def page(self, skip: int = 0, limit: int = 20) -> DataFrame:
        """``limit`` rows from place ``skip`` on, in order, with ``place`` and the ``total`` of all."""
        last = min(self.total, skip + limit) if limit else self.total
        return self._rows(max(0, skip), last).withColumn("total", F.lit(self.total).cast("long")).orderBy("place")

    def after(self, row: dict, limit: int = 20) -> DataFrame:
        """The ``limit`` rows that follow one, known by its values of the order's columns, which need not be there any more."""
        at = self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows")
        before, same = F.lit(False), F.lit(True)
        for c, down in self.order:
            x, v = F.col(c), F.lit(row[c]).cast(at.schema[c].dataType)
            # nulls are first downwards and last upwards, that is greatest
            above, below = (v.isNotNull() & (x.isNull() | (x > v))), (x.isNotNull() & (v.isNull() | (x < v)))
            before, same = before | (same & (above if down else below)), same & x.eqNullSafe(v)
        # ranges hold their bounds, so the place is found in one of them
        bounds = self.spark.read.schema(StructType([f for f in self.schema if f.name == "range" or f.name in dict(self.order)])).parquet(f"{self.folder}/bounds")
        r = bounds.where(before | same).agg(F.max("range")).first()[0]
        if r is None:
            return self.page(0, limit)
        n = at.where(F.col("range") == r).where(before | same).count()
        return self.page(dict(self.starts)[r] + n, limit)


def queue(rows: DataFrame, order: list[tuple[str, bool]], ranges: int = 32) -> Queue:
    """Sorts a table once for all its pages. ``order``: columns and whether they go down; the last ones must tell rows apart.

    Rows are range-partitioned by the whole order, so equal values of the
    first column spread. A range is sorted and numbered by itself; the driver sees a count a range.
    Nulls come first downwards and last upwards. ``range`` and ``place`` are the queue's names.
    """
    spark, folder = rows.sparkSession, own_folder(rows.sparkSession, "queue")
    by = [F.col(c).desc_nulls_first() if down else F.col(c).asc_nulls_last() for c, down in order]
    # the range is written with its rows before they are numbered, so that both hold whatever is computed again
    rows.repartitionByRange(ranges, *by).withColumn("range", F.spark_partition_id()).write.partitionBy("range").parquet(f"{folder}/dealt")
    dealt = spark.read.schema(StructType([*rows.schema.fields, StructField("range", IntegerType())])).parquet(f"{folder}/dealt")
    placed = dealt.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy(*by)) - 1)
    placed.sortWithinPartitions("range", "place").write.partitionBy("range").parquet(f"{folder}/rows")
    written = spark.read.schema(placed.schema).parquet(f"{folder}/rows")
    written.where("place = 0").select("range", *[c for c, _ in order]).coalesce(1).write.parquet(f"{folder}/bounds")
    counts = {r["range"]: r["count"] for r in written.groupBy("range").count().collect()}
    starts, total = [], 0
    for r in sorted(counts):
        starts.append((r, total))
        total += counts[r]
    return Queue(spark, folder, placed.schema, order, starts, total)
