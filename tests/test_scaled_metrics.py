"""Quantiles and resamples that no single task holds, against numpy and the joined form."""

import random

import numpy as np
from pyspark.sql import functions as F

from attestra.operators import metrics as mt


def test_quantiles(spark):
    rand = random.Random(4)
    groups = {"flat": [rand.random() for _ in range(501)], "ties": [rand.choice([0.0, 1.0, 2.5]) for _ in range(400)], "tail": [10.0 ** rand.randrange(12) * rand.random() for _ in range(300)], "one": [3.0], "two": [1.0, 2.0]}
    rows = [(g, v) for g, own in groups.items() for v in own] + [("flat", None), ("none", None)]
    at = {"a": 0.01, "b": 0.5, "c": 0.99, "d": 0.0, "e": 1.0}
    got = {r["g"]: r for r in mt.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], at).collect()}
    assert set(got) == set(groups)
    for g, own in groups.items():
        for name, q in at.items():
            assert np.isclose(got[g][name], np.quantile(own, q), rtol=1e-12), (g, name)
    whole = mt.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", [], {"m": 0.5}).collect()
    assert np.isclose(whole[0]["m"], np.median([v for _, v in rows if v is not None]))


def _predictions(spark, n, scores):
    rand = random.Random(n)
    rows = []
    for k in range(n):
        p = [rand.choice(scores) if scores else rand.random() + 1e-3 for _ in range(3)]
        rows.append((k, rand.randrange(3), *[x / sum(p) for x in p]))
    return spark.createDataFrame(rows, "i long, y int, p0 double, p1 double, p2 double")


def test_draws_equal_joined_resamples(spark, monkeypatch):
    monkeypatch.setattr(mt, "_DENSE", 7)
    for n, scores in ((60, None), (90, [0.2, 0.4]), (1, None)):
        df, draws = _predictions(spark, n, scores), 20
        rows = mt.resampled(df.withColumn("id", F.col("i")), "i", n, draws).cache()
        times = mt.multiplicities(df, "i", n, draws)
        assert times.select(F.sum(F.size("_d"))).first()[0] == n * draws
        want = mt.bundle_by(rows, ["draw"]).join(mt.priority_by(rows, ["draw"], "p0", F.col("y") == 0, "id"), "draw")
        got = mt.drawn_bundles(times, draws, more={"first": (F.col("y") == 0).cast("double")}).join(mt.drawn_precision(times, draws, "p0", F.col("y") == 0), "draw")
        want = want.join(rows.groupBy("draw").agg(F.avg((F.col("y") == 0).cast("double")).alias("first")), "draw")
        names = [*mt.BUNDLE, "average_precision", "first"]
        w, g = ({r["draw"]: [r[c] for c in names] for r in x.collect()} for x in (want, got))
        assert set(w) == set(g) == set(range(draws))
        assert all(np.allclose(w[d], g[d], rtol=1e-9, atol=1e-12) for d in w)


def test_rankings_equal_the_grouped_form(spark):
    df = _predictions(spark, 150, [0.1, 0.3, 0.6]).withColumn("id", F.col("i")).withColumn("g", F.lit(1))
    one, by = mt.rankings(df, "p0", F.col("y") == 0, "id").first(), mt.priority_by(df, ["g"], "p0", F.col("y") == 0, "id").first()
    assert all(np.isclose(one[c], by[c]) for c in mt.PRIORITY)
