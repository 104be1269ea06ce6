"""The pruned search for names against all pairs of their blocks."""

import random

import pytest
from pyspark.sql import functions as F

from attestra.config import LinkageRules
from attestra.functions.text import jaro_winkler, jaro_winkler_of
from attestra.operators import name_search as ns
from attestra.operators.linkage import best_of

R = LinkageRules()


def word(rand, least=2):
    return "".join(rand.choice("AEIOUBCDLMNRST") for _ in range(rand.randrange(least, 11)))


@pytest.mark.parametrize("half", [True, False])
def test_matrices_equal_the_loop(half):
    rand = random.Random(3)
    a = [word(rand, 0) for _ in range(20_000)] + ["X" * 300, "A" * 70, "AB", ""]
    b = [x if rand.random() < 0.1 else x[:3] + word(rand, 0) if rand.random() < 0.5 else word(rand, 0) for x in a[:-4]] + ["X" * 299 + "Y", "A" * 70, "ABA", ""]
    assert jaro_winkler_of(a, b, half).tolist() == [jaro_winkler(x, y, half) for x, y in zip(a, b, strict=True)]


def _tables(spark, n_candidates, n_queries, seed=5):
    """One surname holds a tenth of the candidates."""
    rand = random.Random(seed)
    last = [word(rand) for _ in range(200)]
    names = {(word(rand), "COMMON" if k % 10 == 0 else rand.choice(last)) for k in range(n_candidates)}
    rows = [(f, l, rand.choice([1, 1, 1, 2]), f"id{k:05d}") for k, (f, l) in enumerate(sorted(names))]
    asked = {(word(rand), rand.choice(["COMMON", "COMMON", rand.choice(last), word(rand)])) for _ in range(n_queries)}
    asked |= {(r[0][:-1] + "X", r[1]) for r in rows[:: max(1, len(rows) // 40)]}
    return spark.createDataFrame(sorted(asked), "nf string, nl string"), spark.createDataFrame(rows, "cf string, cl string, n int, id string")


def test_best_and_second_of_each_block(spark):
    q, c = _tables(spark, 6000, 150)
    every = ns.scored(ns.block_pairs(q, c), R).cache()
    some = ns.contenders(q, c, R, cell=64, few=0).cache()
    assert some.groupBy("nf", "nl", "cf", "cl").count().where("count > 1").count() == 0
    want = best_of(every, ["nf", "nl"])
    got = best_of(some, ["nf", "nl"], F.first("pool"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    common = "nl = 'COMMON'"
    assert 10 * some.where(common).count() < every.where(common).count()


def test_bounds_hold_and_cells_are_small(spark):
    q, c = _tables(spark, 3000, 100, seed=6)
    pairs = ns.scored(ns.block_pairs(q, c), R)
    flat = pairs.select("*", *[ns.marks(F.col(w))[k].alias(f"{w}_{k}") for w in ("nf", "nl", "cf", "cl") for k in ("n", "one", "two")])
    assert flat.where((ns.bound("nf", "cf") < F.col("fs") - 1e-12) | (ns.bound("nl", "cl") < F.col("ls") - 1e-12)).count() == 0
    a, b = ns.cells(ns.pools(q, c).where("pool > 0"), c, cell=5)
    met = a.join(b, ["kind", "word", "i", "j"])
    largest, total = met.groupBy("kind", "word", "i", "j").count().agg(F.max("count"), F.sum("count")).first()
    assert largest <= total / 100, (largest, total)
    assert met.select("nf", "nl", "cf", "cl").distinct().count() == pairs.count()
    assert ns.contenders(q.limit(0), c, R, few=-1).count() == 0 == ns.contenders(q, c.limit(0), R, few=-1).count()
