"""The best candidate names of a block, without scoring the block.

A name's block are the candidates with its first or its last name, or, where
there are none, with the beginning of one. A common surname makes blocks large,
and nearly all their pairs are far apart. Marks of each word (length, first
letters, which letters it has once and twice) bound the similarity of a pair
from above, by built-in functions within the join, so most pairs end where
they arise: only those that can be the best or the second of their name are
scored, which is all that a decision and its margin read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.config import LinkageRules
from attestra.functions.text import similarity
from attestra.sources.stages import barrier

#: Names of each side that meet in one cell of a block.
CELL = 1000
#: Parts of a block of which each gives its most promising candidate to be scored first.
PARTS = 12
#: Up to so many pairs in all blocks together are scored as they are, in fewer stages.
FEW = 1_000_000
#: More than a rounding error of a score.
_SLACK = 1e-9


def marks(word: Column) -> Column:
    """Length, and the letters that a normalised word has at least once and at least twice, as bits."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(64)))
    none = F.struct(F.lit(0).cast("long").alias("one"), F.lit(0).cast("long").alias("two"))
    step = lambda x, c: F.struct(x["one"].bitwiseOR(bit(c)).alias("one"), x["two"].bitwiseOR(x["one"].bitwiseAND(bit(c))).alias("two"))
    seen = F.aggregate(F.regexp_extract_all(word, F.lit("(?s)."), F.lit(0)), none, step)
    return F.aggregate(F.array(seen), F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("one"), F.lit(0).cast("long").alias("two")), lambda _, x: F.struct(F.length(word).alias("n"), x["one"].alias("one"), x["two"].alias("two")))


def bound(a: str, b: str) -> Column:
    """No less than the Jaro-Winkler similarity of two words, by their marks in columns beside them.

    Letters can match at most as often as both words have them: those both
    have once, those both have twice, and of the rest, from third ones on, as
    many as the word with fewer of these has. All are taken to be in order,
    and the common beginning counts as it is.
    """
    of = lambda w, k: F.col(f"{w}_{k}")
    rest = lambda w: of(w, "n") - F.bit_count(of(w, "one")) - F.bit_count(of(w, "two"))
    m = F.bit_count(of(a, "one").bitwiseAND(of(b, "one"))) + F.bit_count(of(a, "two").bitwiseAND(of(b, "two"))) + F.least(rest(a), rest(b))
    base = (m / of(a, "n") + m / of(b, "n") + F.when(m > 0, 1.0).otherwise(0.0)) / 3
    agree = lambda k: (F.substring(a, 1, k) == F.substring(b, 1, k)).cast("int")
    # where the beginning counts it lifts a base over 0.7; under it the sum is no smaller than the base
    raised = base + 0.1 * (agree(1) + agree(2) + agree(3) + agree(4)) * F.greatest(1 - base, F.lit(0.0))
    return F.when((F.col(a) == "") | (F.col(b) == ""), 0.0).otherwise(F.least(raised, F.lit(1.0)))


def _keyed(df: DataFrame, first: str, last: str, kinds: list[str]) -> DataFrame:
    """A row for each key that a name is met by: f and l are its names, F and L their beginnings, fl and FL both."""
    word = {"f": F.col(first), "l": F.col(last), "F": F.substring(first, 1, 3), "L": F.substring(last, 1, 4)}
    return df.withColumn("_k", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.concat_ws("|", *[word[x] for x in k]).alias("word")) for k in kinds]))).select("*", "_k.*").drop("_k")


def pools(queries: DataFrame, names: DataFrame) -> DataFrame:
    """(nf, nl, pool, near): candidates in each name's block, by sums of keys less what both keys have; near says which keys make the block."""
    kinds = ["f", "l", "fl", "F", "L", "FL"]
    held = _keyed(names.select("cf", "cl", "n"), "cf", "cl", kinds).groupBy("kind", "word").agg(F.sum("n").alias("n"))
    signed = F.when(F.length("kind") == 2, -F.col("n")).otherwise(F.col("n"))
    met = _keyed(queries.select("nf", "nl").distinct(), "nf", "nl", kinds).join(held, ["kind", "word"])
    size = met.groupBy("nf", "nl").agg(*[F.coalesce(F.sum(F.when(F.lower("kind") == F.col("kind") if low else F.upper("kind") == F.col("kind"), signed)), F.lit(0)).alias(c) for c, low in (("near", True), ("far", False))])
    return size.select("nf", "nl", F.when(F.col("near") > 0, F.col("near")).otherwise(F.col("far")).alias("pool"), (F.col("near") > 0).alias("near"))


def cells(queries: DataFrame, names: DataFrame, cell: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of all blocks, keyed by kind, word, i and j: queries (nf, nl, pool, near) of a block are dealt to rows of cells, candidates to columns, so a block of any size meets in cells of about ``cell`` by ``cell`` names."""
    cell = cell or CELL
    q = queries.withColumn("kind", F.explode(F.when(F.col("near"), F.array(F.lit("f"), F.lit("l"))).otherwise(F.array(F.lit("F"), F.lit("L")))))
    word = F.when(F.col("kind") == "f", F.col("nf")).when(F.col("kind") == "l", F.col("nl")).when(F.col("kind") == "F", F.substring("nf", 1, 3)).otherwise(F.substring("nl", 1, 4))
    q = q.select("nf", "nl", "kind", word.alias("word"))
    c = _keyed(names, "cf", "cl", ["f", "l", "F", "L"])
    flat = lambda word, tag: [marks(word)[k].alias(f"{tag}_{k}") for k in ("n", "one", "two")]
    return _dealt(q, c, ["kind", "word"], cell, [*flat(F.col("nf"), "nf"), *flat(F.col("nl"), "nl")], [*flat(F.col("cf"), "cf"), *flat(F.col("cl"), "cl")])


def _dealt(q: DataFrame, c: DataFrame, by: list[str], cell: int, more_q: list[Column], more_c: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Names of both sides that have ``by`` in common, queries with a row i and candidates with a column j of their block's cells, each in all columns or rows of it."""
    part = lambda n: F.ceil(F.col(n) / cell).cast("int")
    block = q.groupBy(*by).agg(F.count(F.lit(1)).alias("x")).join(c.groupBy(*by).agg(F.count(F.lit(1)).alias("y")), by).select(*by, part("x").alias("x"), part("y").alias("y"))
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = q.join(block, by).select("*", *more_q)
    c = c.join(block, by).select("*", *more_c)
    q = q.withColumn("i", F.pmod(F.xxhash64("nf", "nl"), F.col("x")).cast("int")).withColumn("j", span("y")).drop("x", "y")
    c = c.withColumn("j", F.pmod(F.xxhash64("cf", "cl"), F.col("y")).cast("int")).withColumn("i", span("x")).drop("x", "y")
    return q, c


def first_names(queries: DataFrame, names: DataFrame, cell: int | None = None) -> DataFrame:
    """Distinct (nf, cf): first names of queries and candidates that have a last name in common.

    Names meet once each, however many rows have them, and those of a common
    last name in cells, which are dealt to tasks whatever their size in bytes.
    """
    q = barrier(queries.select("nf", "nl").distinct(), "first-q").withColumn("word", F.col("nl"))
    c = barrier(names.select("cf", "cl").distinct(), "first-c").withColumn("word", F.col("cl"))
    q, c = _dealt(q, c, ["word"], cell or CELL, [], [])
    n = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = q.select("nf", "word", "i", "j").repartition(n, "word", "i", "j").join(c.select("cf", "word", "i", "j"), ["word", "i", "j"])
    return met.select("nf", "cf").distinct()


def block_pairs(queries: DataFrame, names: DataFrame) -> DataFrame:
    """Candidate names with an equal first or last name; only where there is none, with an equal beginning of one.

    Each pair comes once. Where a common name makes a block large, the join is
    split at run time, and the distinct pairs are dealt by all of their words.
    """
    near = queries.join(names, F.col("nf") == F.col("cf")).union(queries.join(names, F.col("nl") == F.col("cl"))).distinct()
    rest = queries.join(near.select("nf", "nl").distinct(), ["nf", "nl"], "left_anti")
    far = rest.join(names, F.substring("nf", 1, 3) == F.substring("cf", 1, 3)).union(rest.join(names, F.substring("nl", 1, 4) == F.substring("cl", 1, 4))).distinct()
    return near.unionByName(far)


def scored(pairs: DataFrame, rules: LinkageRules) -> DataFrame:
    """Adds fs, ls and s to pairs of (nf, nl) and (cf, cl). Words that differ are compared in matrices, a batch at a time."""
    out = pairs.withColumn("fs", similarity(F.col("nf"), F.col("cf"), rules.transposition)).withColumn("ls", similarity(F.col("nl"), F.col("cl"), rules.transposition))
    return out.withColumn("s", F.lit(rules.first_weight) * F.col("fs") + F.lit(rules.last_weight) * F.col("ls"))


def contenders(queries: DataFrame, names: DataFrame, rules: LinkageRules, cell: int | None = None, few: int | None = None) -> DataFrame:
    """Scored pairs (nf, nl, cf, cl, n, id, fs, ls, s, pool): of each name's block all that can be its best or second, and few others.

    The block's candidates are dealt into PARTS, and of each part those with the
    highest bound are scored. The second of these is a score that the
    second of the block has at least, so pairs with a lower bound can be
    neither; the others are scored. Each pair comes once; ``pool`` is the block's size.
    """
    queries = queries.select("nf", "nl").distinct()
    size = barrier(pools(queries, names), "pools")
    if (size.agg(F.sum("pool")).first()[0] or 0) <= (FEW if few is None else few):
        return scored(block_pairs(queries, names), rules).join(size.select("nf", "nl", "pool"), ["nf", "nl"])
    q, c = cells(size.where("pool > 0"), names, cell)
    q, c = barrier(q, "cells-q"), barrier(c, "cells-c")
    most = rules.first_weight * bound("nf", "cf") + rules.last_weight * bound("nl", "cl")
    # a pair that shares both keys comes by the first
    once = ((F.col("kind") != "l") | (F.col("nf") != F.col("cf"))) & ((F.col("kind") != "L") | (F.substring("nf", 1, 3) != F.substring("cf", 1, 3)))
    part = F.pmod(F.xxhash64("cf", "cl"), F.lit(PARTS)).cast("int")

    def pairs(rows: DataFrame) -> DataFrame:
        return rows.join(c, ["kind", "word", "i", "j"]).where(once)

    columns = ("nf", "nl", "cf", "cl", "n", "id")
    tops = pairs(q).select("nf", "nl", part.alias("part"), most.alias("most")).groupBy("nf", "nl", "part").agg(F.max("most").alias("top"))
    tops = barrier(tops.groupBy("nf", "nl").agg(F.map_from_entries(F.collect_list(F.struct("part", "top"))).alias("tops")), "tops")
    top = F.coalesce(F.try_element_at("tops", part), F.lit(2.0))
    seeds = scored(pairs(q.join(tops, ["nf", "nl"])).where(most >= top - _SLACK).select(*columns), rules)
    w = Window.partitionBy("nf", "nl").orderBy(F.desc("s"))
    floor = seeds.withColumn("k", F.row_number().over(w)).where("k <= 2").groupBy("nf", "nl").agg(F.when(F.count(F.lit(1)) == 2, F.min("s")).otherwise(0.0).alias("floor"))
    least = barrier(tops.join(floor, ["nf", "nl"]), "floors")
    out = scored(pairs(q.join(least, ["nf", "nl"])).where(most >= F.least(top, F.col("floor")) - _SLACK).select(*columns), rules)
    return out.join(size.select("nf", "nl", "pool"), ["nf", "nl"])
