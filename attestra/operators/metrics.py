"""Quality, calibration, ranking and drift of class probabilities.

Rankings are cumulative sums over distinct scores. They run in two levels,
inside a bin of scores and over the few bins, so no task sees all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestra.sources.stages import barrier

P = ("p0", "p1", "p2")
#: Bins of a ranking, by approximate quantiles, so that each holds about as many distinct scores; ranks that a task makes at a time.
BINS, CHUNK = 128, 4096


def picked(p: tuple[str, ...] = P) -> Column:
    """Index of the greatest probability, the first on ties."""
    a = F.array(*p)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def normalized(p: tuple[str, ...] = P, floor: float = 1e-12) -> list[Column]:
    """The probabilities clipped and divided by their sum."""
    clipped = [F.greatest(F.least(F.col(c), F.lit(1.0)), F.lit(floor)) for c in p]
    total = reduce(lambda a, b: a + b, clipped)
    return [(x / total).alias(c) for x, c in zip(clipped, p, strict=True)]


def blended(p: tuple[str, ...], q: tuple[str, ...], weight: Column) -> list[Column]:
    """``q`` with a weight and ``p`` with the rest, divided by their sum."""
    mixed = [weight * F.col(b) + (1 - weight) * F.col(a) for a, b in zip(p, q, strict=True)]
    total = reduce(lambda a, b: a + b, mixed)
    return [x / total for x in mixed]


def log_loss_of(p: tuple[str, ...] = P, y: str = "y") -> Column:
    own = F.get(F.array(*p), F.col(y))
    return -F.log(F.greatest(F.least(own, F.lit(1 - 1e-15)), F.lit(1e-15)))


def brier_of(p: tuple[str, ...] = P, y: str = "y") -> Column:
    return reduce(lambda a, b: a + b, [F.pow(F.col(c) - (F.col(y) == k).cast("double"), 2) for k, c in enumerate(p)])


def confusion(df: DataFrame, truth: Column, guess: Column, n: int = 3) -> DataFrame:
    """All n * n cells: truth, guess, count."""
    spark = df.sparkSession
    cells = spark.range(n * n).select((F.col("id") / n).cast("int").alias("truth"), (F.col("id") % n).cast("int").alias("guess"))
    seen = df.groupBy(truth.cast("int").alias("truth"), guess.cast("int").alias("guess")).count()
    return cells.join(seen, ["truth", "guess"], "left").select("truth", "guess", F.coalesce("count", F.lit(0)).alias("n"))


def per_class(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    c = confusion(df, truth, guess)
    rows = c.select(F.explode(F.array(F.struct(F.col("truth").alias("k"), F.col("n").alias("support"), F.lit(0).alias("said"), F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0).alias("hit")), F.struct(F.col("guess").alias("k"), F.lit(0).alias("support"), F.col("n").alias("said"), F.lit(0).alias("hit")))).alias("r"))
    g = rows.groupBy(F.col("r.k").alias("class")).agg(F.sum("r.support").alias("support"), F.sum("r.said").alias("said"), F.sum("r.hit").alias("hit"))
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return g.select("class", z(F.col("hit"), F.col("said")).alias("precision"), z(F.col("hit"), F.col("support")).alias("recall"), z(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1"), "support")


def calibration(df: DataFrame, conf: Column, right: Column, bins: int = 10) -> DataFrame:
    """Equal-width bins with the last one closed, empty ones kept: bin, n, mean confidence, accuracy."""
    edges = [k * (1.0 / bins) for k in range(1, bins)]
    b = reduce(lambda x, y: x + y, [(conf >= e).cast("int") for e in edges])
    g = df.select(b.alias("bin"), conf.alias("c"), right.cast("double").alias("r")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("c").alias("confidence"), F.avg("r").alias("accuracy"))
    return df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).join(g, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "confidence", "accuracy")


def ece(table: DataFrame) -> DataFrame:
    return table.agg(F.try_divide(F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))), F.sum("n")).alias("ece"))


BUNDLE = ("log_loss", "macro_f1", "accuracy", "brier_multiclass", "brier_macro_ovr", "ece_10bin")


def _bundle_parts(p: tuple[str, ...], bins: int) -> tuple[Column, dict[str, Column]]:
    """What a row with normalised ``p`` and its label y adds to the bundle: its confidence bin, and numbers that are summed by bin."""
    k, conf = picked(p), F.greatest(*p)
    place = reduce(lambda x, y: x + y, [(conf >= e * (1.0 / bins)).cast("int") for e in range(1, bins)])
    own = {"n": F.lit(1.0), "c": conf, "r": (k == F.col("y")).cast("double"), "ll": log_loss_of(p), "br": brier_of(p)}
    for j in range(len(p)):
        own |= {f"s{j}": (F.col("y") == j).cast("double"), f"g{j}": (k == j).cast("double"), f"h{j}": ((k == j) & (F.col("y") == j)).cast("double")}
    return place, own


def _bundle_of(first: DataFrame, by: list[str], n_class: int) -> DataFrame:
    """The bundle from the sums by bin."""
    n = F.sum("n")
    f1 = [F.try_divide(2 * F.sum(f"h{j}"), F.sum(f"s{j}") + F.sum(f"g{j}")) for j in range(n_class)]
    macro = F.try_divide(reduce(lambda a, b: a + b, [F.coalesce(x, F.lit(0.0)) for x in f1]), reduce(lambda a, b: a + b, [x.isNotNull().cast("int") for x in f1]))
    return first.groupBy(*by).agg(
        F.try_divide(F.sum("ll"), n).alias("log_loss"), macro.alias("macro_f1"), F.try_divide(F.sum("r"), n).alias("accuracy"), F.try_divide(F.sum("br"), n).alias("brier_multiclass"),
        F.try_divide(F.sum("br"), n * n_class).alias("brier_macro_ovr"), F.try_divide(F.sum(F.abs(F.col("r") - F.col("c"))), n).alias("ece_10bin"),
    )


def bundle_by(df: DataFrame, by: list[str], p: tuple[str, ...] = P, bins: int = 10) -> DataFrame:
    """The metrics of BUNDLE for each group: a first aggregate by confidence bin, a second over the few bins.

    Macro F1 is the mean over classes that occur, as a label or as a guess.
    """
    place, own = _bundle_parts(p, bins)
    d = df.select(*by, "y", *normalized(p)).select(*by, place.alias("_bin"), *[x.alias(c) for c, x in own.items()])
    return _bundle_of(d.groupBy(*by, "_bin").agg(*[F.sum(c).alias(c) for c in own]), by, len(p))


def metric_bundle(df: DataFrame, p: tuple[str, ...] = P) -> DataFrame:
    """The metrics of BUNDLE over all rows, one row."""
    return bundle_by(df, [], p)


def running(rows: DataFrame, value: str, sums: list[str], by: list[str], descending: bool = False) -> DataFrame:
    """Adds cum_<s>, the sum over rows up to each value. ``rows`` has one row per (by, value).

    Bins end at approximate quantiles of the group's values, so a heavy tail
    doesn't fill one; the few bins are summed first, rows inside theirs.
    """
    ends = rows.groupBy(*by).agg(F.percentile_approx(value, [k / BINS for k in range(1, BINS)], 10 * BINS).alias("_ends"))
    r = rows.join(F.broadcast(ends), by) if by else rows.crossJoin(F.broadcast(ends))  # one row a group
    r = r.withColumn("_bin", F.size(F.filter("_ends", lambda e: e < F.col(value))) * (-1 if descending else 1)).drop("_ends")
    bins = r.groupBy(*by, "_bin").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*by, "_bin", *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_b_{s}") for s in sums])
    w = Window.partitionBy(*by, "_bin").orderBy(F.desc(value) if descending else F.asc(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = r.join(bins, [*by, "_bin"]).select("*", *[(F.sum(s).over(w) + F.col(f"_b_{s}")).alias(f"cum_{s}") for s in sums])
    return out.drop("_bin", *[f"_b_{s}" for s in sums])


def _by_score(df: DataFrame, score: str, positive: Column) -> DataFrame:
    g = df.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("pos"))
    return running(g, "score", ["n", "pos"], [], descending=True)


def average_precision(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """0 where nothing is positive."""
    r = _by_score(df, score, positive)
    return r.agg(F.coalesce(F.try_divide(F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n")), F.sum("pos")), F.lit(0.0)).alias("average_precision"))


def _ranks(df: DataFrame, lo: Column, hi: Column, *keep: Column) -> DataFrame:
    """A row for each rank from lo to hi. Ranges are cut and the pieces dealt, so that a long one is not one array in one task."""
    cut = df.where(hi >= lo).select(*keep, F.explode(F.sequence(lo, hi, F.lit(CHUNK).cast("bigint"))).alias("_from"), hi.alias("_to"))
    cut = cut.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_from")
    return cut.select("*", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + CHUNK - 1, F.col("_to")))).alias("rank")).drop("_from", "_to")


def ndcg(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """Gains of 0 and 1 under logarithmic discounts, which tied scores share evenly; 0 where nothing is positive."""
    r = _by_score(df, score, positive)
    ranks = _ranks(r, F.col("cum_n") - F.col("n") + 1, F.col("cum_n"), (F.col("pos") / F.col("n")).alias("gain"))
    dcg = ranks.agg(F.sum(F.col("gain") / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = _ranks(r.agg(F.sum("pos").alias("m")), F.lit(1).cast("bigint"), F.col("m")).agg(F.sum(1 / F.log2(F.col("rank") + 1)).alias("best"))
    return dcg.crossJoin(ideal).select(F.coalesce(F.try_divide("dcg", "best"), F.lit(0.0)).alias("ndcg"))  # single rows


def top_fraction(df: DataFrame, score: str, key: str, positive: Column, fractions: tuple[float, ...] = (0.1, 0.2)) -> DataFrame:
    """Precision and recall in the top ceil(n * f) rows, one at least, ties by key."""
    n = df.count()
    out = []
    for f in fractions:
        k = max(1, -int(-n * f // 1))
        top = df.orderBy(F.desc(score), key).limit(k).agg(F.count_if(positive).alias("hit"))
        every = df.agg(F.greatest(F.lit(1), F.count_if(positive)).alias("all"))
        out.append(top.crossJoin(every).select(F.lit(f).alias("fraction"), F.lit(k).alias("k"), (F.col("hit") / k).alias("precision"), (F.col("hit") / F.col("all")).alias("recall")))  # single rows
    return reduce(DataFrame.union, out)


PRIORITY = ("average_precision", "ndcg", "precision_at_top_10pct", "recall_at_top_10pct", "precision_at_top_20pct", "recall_at_top_20pct")


def priority_by(df: DataFrame, by: list[str], score: str, positive: Column, key: str, fractions: tuple[float, ...] = (0.1, 0.2)) -> DataFrame:
    """The rankings of PRIORITY for each of many small groups, as resamples are: a group is sorted in one task."""
    w = Window.partitionBy(*by)
    row, peers = w.orderBy(F.desc(score), key), w.orderBy(F.desc(score)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    d = df.select(*by, positive.cast("int").alias("pos"), F.col(score).alias("s"), F.row_number().over(row).alias("r"), F.count(F.lit(1)).over(w).alias("n"), F.sum(positive.cast("int")).over(w).alias("m"), F.sum(positive.cast("int")).over(peers).alias("cp"), F.count(F.lit(1)).over(peers).alias("cn"))
    d = d.withColumn("gain", F.avg("pos").over(Window.partitionBy(*by, "s"))).withColumn("disc", 1 / F.log2(F.col("r") + 1))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    out = [
        zero(F.try_divide(F.sum(F.col("pos") * F.col("cp") / F.col("cn")), F.max("m"))).alias("average_precision"),
        zero(F.try_divide(F.sum(F.col("disc") * F.col("gain")), F.sum(F.when(F.col("r") <= F.col("m"), F.col("disc"))))).alias("ndcg"),
    ]
    for f in fractions:
        k = F.greatest(F.lit(1), F.ceil(F.col("n") * f))
        hit, name = F.sum(F.when(F.col("r") <= k, F.col("pos")).otherwise(0)), f"{round(100 * f)}pct"
        out += [(hit / F.max(k)).alias(f"precision_at_top_{name}"), (hit / F.greatest(F.lit(1), F.max("m"))).alias(f"recall_at_top_{name}")]
    return d.groupBy(*by).agg(*out)


def rankings(df: DataFrame, score: str, positive: Column, key: str, fractions: tuple[float, ...] = (0.1, 0.2)) -> DataFrame:
    """The rankings of PRIORITY over all rows, one row: cumulative sums in two levels and top-k sorts, no group in one task."""
    out = average_precision(df, score, positive).crossJoin(ndcg(df, score, positive))  # single rows
    for f in fractions:
        name = f"{round(100 * f)}pct"
        top = top_fraction(df, score, key, positive, (f,)).select(F.col("precision").alias(f"precision_at_top_{name}"), F.col("recall").alias(f"recall_at_top_{name}"))
        out = out.crossJoin(top)
    return out


def change_detection(df: DataFrame, changed: Column, predicted: Column) -> DataFrame:
    tp, a, g = F.count_if(changed & predicted), F.count_if(changed), F.count_if(predicted)
    z = lambda x, y: F.coalesce(F.try_divide(x, y), F.lit(0.0))
    return df.agg(a.alias("actual"), g.alias("predicted"), z(tp, g).alias("precision"), z(tp, a).alias("recall"), z(2 * tp, a + g).alias("f1"))


def unpivoted(df: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in features]).unpivot(keys, features, "feature", "value")


def drift(df: DataFrame, labelled: str, features: list[str], ks: float = 0.2, smd: float = 0.5, missing: float = 0.1) -> DataFrame:
    """Labelled rows (1) against the others (0) per feature: counts, means, KS distance, mean difference over the deviation of all, missing rates, warning."""
    u = unpivoted(df, [labelled], features)
    g = F.col(labelled)
    val = u.where("value is not null").groupBy("feature", "value").agg(F.count_if(g == 1).alias("a"), F.count_if(g == 0).alias("b"))
    r = running(val, "value", ["a", "b"], ["feature"])
    tot = val.groupBy("feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    dist = r.join(F.broadcast(tot), "feature").groupBy("feature").agg(F.max(F.abs(F.try_divide("cum_a", "na") - F.try_divide("cum_b", "nb"))).alias("ks_statistic"))
    v = lambda k: F.when(g == k, F.col("value"))
    lost = lambda k: F.avg(F.when(g == k, F.col("value").isNull().cast("double")))
    s = u.groupBy("feature").agg(
        F.count(v(1)).alias("labeled_count"), F.count(v(0)).alias("unlabeled_count"), F.avg(v(1)).alias("labeled_mean"), F.avg(v(0)).alias("unlabeled_mean"), F.stddev_pop("value").alias("_sd"),
        lost(1).alias("labeled_missing_rate"), lost(0).alias("unlabeled_missing_rate"),
    )
    apart = F.col("labeled_mean") - F.col("unlabeled_mean")
    out = s.join(dist, "feature", "left").select(
        "*", F.when(F.col("_sd") > 0, apart / F.col("_sd")).otherwise(0.0).alias("standardized_mean_difference"), (F.col("labeled_missing_rate") - F.col("unlabeled_missing_rate")).alias("missing_rate_difference")
    )
    over = lambda c, limit: F.coalesce(F.abs(c) > limit, F.lit(False))
    warn = over("ks_statistic", ks) | over("standardized_mean_difference", smd) | over("missing_rate_difference", missing)
    return out.drop("_sd").withColumn("warning", warn)


def quantiles(values: DataFrame, value: str, by: list[str], at: dict[str, float]) -> DataFrame:
    """Exact quantiles of each group, between neighbours in proportion: ``by`` and a column for each name in ``at``. Nulls don't count.

    Equal values are counted first, map-side; ``running`` gives each distinct
    value its rank over bins that tasks share; then the least value beyond a rank is a
    plain minimum. No task holds a group's values.
    """
    counts = values.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.groupBy(*by).agg(F.sum("_n").alias("_all"))
    ranked = running(counts, "_v", ["_n"], by)
    ranked = ranked.join(F.broadcast(total), by) if by else ranked.crossJoin(F.broadcast(total))  # a row for each group
    place = {name: F.lit(q) * (F.col("_all") - 1) for name, q in at.items()}
    sides = [F.min(F.when(F.col("cum__n") > end(place[name]), F.col("_v"))).alias(f"_{k}_{name}") for name in at for k, end in (("lo", F.floor), ("hi", F.ceil))]
    found = ranked.groupBy(*by).agg(F.first("_all").alias("_all"), *sides)

    def between(name: str) -> Column:
        lo, hi, x = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), place[name]
        return F.when(lo == hi, lo).otherwise((F.ceil(x) - x) * lo + (x - F.floor(x)) * hi)

    return found.select(*by, *[between(name).alias(name) for name in at])


def feature_contract(df: DataFrame, features: list[str], labelled: str) -> DataFrame:
    """Per feature: type, missing rate, extremes and quantiles of all rows, extremes of labelled rows (1)."""
    u = unpivoted(df, [labelled], features)
    own = F.when(F.col(labelled) == 1, F.col("value"))
    kinds = dict(df.dtypes)
    kind = F.create_map(*[F.lit(x) for c in features for x in (c, kinds[c])])
    g = u.groupBy("feature").agg(
        F.avg(F.col("value").isNull().cast("double")).alias("full_missing_rate"), F.min("value").alias("full_min"), F.max("value").alias("full_max"), F.min(own).alias("labeled_min"), F.max(own).alias("labeled_max"),
    )
    q = quantiles(u, "value", ["feature"], {"full_q01": 0.01, "full_median": 0.5, "full_q99": 0.99})
    out = g.join(q, "feature", "left").withColumn("dtype", kind[F.col("feature")])
    return out.select("feature", "full_missing_rate", "full_min", "full_q01", "full_median", "full_q99", "full_max", "labeled_min", "labeled_max", "dtype")


def resampled(df: DataFrame, key: str, n_rows: int, draws: int) -> DataFrame:
    """``draws`` resamples of a table with keys 0 to n - 1, drawn by digest: adds ``draw``."""
    picks = df.sparkSession.range(draws * n_rows).select(
        F.floor(F.col("id") / n_rows).alias("draw"),
        (F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long") % n_rows).alias(key),
    )
    return picks.join(df, key)


def multiplicities(df: DataFrame, key: str, n_rows: int, draws: int) -> DataFrame:
    """The same resamples, the other way round: adds to each row the draws that have it (_d), as often as they do. Rows are joined once and stay ``n_rows``, and one list is no longer than a few times the draws."""
    picks = df.sparkSession.range(draws * n_rows).select(
        F.floor(F.col("id") / n_rows).cast("int").alias("_d"), (F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 8), 16, 10).cast("long") % n_rows).alias(key)
    )
    return df.join(picks.groupBy(key).agg(F.collect_list("_d").alias("_d")), key)


#: Rows that a task holds against all draws at a time.
_DENSE = 512


def _dense(frame: pd.DataFrame, draws: int) -> np.ndarray:
    """How often each draw (column) has each row."""
    out = np.zeros((len(frame), draws))
    size = [len(x) for x in frame["_d"]]
    if sum(size):
        place = np.repeat(np.arange(len(frame)) * draws, size) + np.concatenate(frame["_d"].to_numpy())
        out = np.bincount(place, minlength=len(frame) * draws).reshape(len(frame), draws).astype(float)
    return out


def drawn_bundles(rows: DataFrame, draws: int, p: tuple[str, ...] = P, bins: int = 10, more: dict[str, Column] | None = None) -> DataFrame:
    """The bundle of each draw of ``multiplicities``, and the means of ``more``: a task multiplies its rows' numbers by how often each draw has them, and hands on sums by draw and bin."""
    place, own = _bundle_parts(p, bins)
    own |= {k: F.col(f"_x_{k}") for k in more or {}}
    names = list(own)
    d = rows.withColumns({f"_x_{k}": x for k, x in (more or {}).items()}).select("_d", "y", *[f"_x_{k}" for k in more or {}], *normalized(p))
    d = d.select("_d", place.alias("_bin"), F.array(*[F.coalesce(own[c], F.lit(0.0)).cast("double") for c in names]).alias("_x"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for lo in range(0, len(b), _DENSE):
                part = b.iloc[lo : lo + _DENSE]
                times, x, place = _dense(part, draws), np.stack(part["_x"].to_numpy()), part["_bin"].to_numpy()
                for k in np.unique(place):
                    sums[k] = sums.get(k, 0.0) + times[place == k].T @ x[place == k]
        for k, x in sums.items():
            yield pd.DataFrame({"draw": np.arange(draws), "_bin": k} | {c: x[:, j] for j, c in enumerate(names)})

    kind = ", ".join(f"`{c}` double" for c in names)
    first = d.mapInPandas(run, f"draw long, _bin int, {kind}").where("n > 0")
    first = first.groupBy("draw", "_bin").agg(*[F.sum(c).alias(c) for c in names])
    out = _bundle_of(first, ["draw"], len(p))
    return out.join(first.groupBy("draw").agg(*[(F.sum(c) / F.sum("n")).alias(c) for c in more]), "draw") if more else out


def drawn_precision(rows: DataFrame, draws: int, score: str, positive: Column) -> DataFrame:
    """Average precision of each draw of ``multiplicities``. Rows are ranked once for all draws, in ranges of the score; what a draw has in higher ranges is a sum of a row for each range."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = rows.select(F.col(score).alias("_s"), positive.cast("double").alias("_pos"), "_d").repartitionByRange(n, F.desc("_s"))
    ranked = barrier(ranked.withColumn("_part", F.spark_partition_id()), "ranked")

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, own in b.groupby("_part"):
                for lo in range(0, len(own), _DENSE):
                    some = own.iloc[lo : lo + _DENSE]
                    times = _dense(some, draws)
                    sums[part] = sums.get(part, 0.0) + np.stack((times.sum(0), some["_pos"].to_numpy() @ times), 1)
        for part, x in sums.items():
            yield pd.DataFrame({"_part": part, "draw": np.arange(draws), "n": x[:, 0], "pos": x[:, 1]})

    held = ranked.mapInPandas(totals, "_part int, draw long, n double, pos double").groupBy("_part", "draw").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    above = Window.partitionBy("draw").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("_part", "draw", *[F.coalesce(F.sum(c).over(above), F.lit(0.0)).alias(c) for c in ("n", "pos")])

    def precision(own: pd.DataFrame, before: pd.DataFrame) -> pd.DataFrame:
        cum = before.sort_values("draw")[["n", "pos"]].to_numpy().T
        own = own.sort_values("_s", ascending=False, kind="stable")
        value, total, found, open_ = own["_s"].to_numpy(), np.zeros(draws), np.zeros(draws), np.zeros((2, draws))
        for lo in range(0, len(own), _DENSE):
            some = own.iloc[lo : lo + _DENSE]
            times, s = _dense(some, draws), some["_s"].to_numpy()
            first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            each = np.stack([np.add.reduceat(x, first, axis=0) for x in (times, times * some["_pos"].to_numpy()[:, None])])
            each[:, 0] += open_
            # equal scores may go on in the next rows
            more = lo + _DENSE < len(own) and value[lo + _DENSE] == s[-1]
            open_ = each[:, -1].copy() if more else np.zeros((2, draws))
            each = each[:, :-1] if more else each
            if each.shape[1]:
                run = cum[:, None, :] + np.cumsum(each, axis=1)
                total += np.divide(each[1] * run[1], run[0], out=np.zeros_like(run[0]), where=run[0] > 0).sum(0)
                found += each[1].sum(0)
                cum = run[:, -1]
        return pd.DataFrame({"draw": np.arange(draws), "hit": total, "pos": found})

    parts = ranked.groupBy("_part").cogroup(held.groupBy("_part")).applyInPandas(precision, "draw long, hit double, pos double")
    return parts.groupBy("draw").agg(F.coalesce(F.try_divide(F.sum("hit"), F.sum("pos")), F.lit(0.0)).alias("average_precision"))


def interval(df: DataFrame, by: str, metrics: list[str], beneficial: dict[str, bool] | None = None) -> DataFrame:
    """95 % percentile intervals of per-draw metrics. ``beneficial``: whether lower is better, for the share of draws that are."""
    u = df.unpivot([by], metrics, "metric", "value")
    good = []
    if beneficial is not None:
        lower = F.col("metric").isin(*[m for m, low in beneficial.items() if low])
        good = [F.avg(F.when(lower, F.col("value") < 0).otherwise(F.col("value") > 0).cast("double")).alias("probability_beneficial")]
    return u.groupBy("metric").agg(F.avg("value").alias("mean"), F.percentile("value", 0.025).alias("ci_2_5"), F.percentile("value", 0.975).alias("ci_97_5"), *good)


def differences(before: DataFrame, after: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """``after`` minus ``before`` for each draw."""
    a, b = before.select(by, *[F.col(m).alias(f"_a_{m}") for m in metrics]), after.select(by, *[F.col(m).alias(f"_b_{m}") for m in metrics])
    return a.join(b, by).select(by, *[(F.col(f"_b_{m}") - F.col(f"_a_{m}")).alias(m) for m in metrics])


def fit_temperature(df: DataFrame, p: tuple[str, ...] = P, lo: float = 0.25, hi: float = 5.0, rounds: int = 5, grid: int = 24) -> float:
    """The temperature with the least log loss: each pass scores a grid, then narrows around its best."""
    from attestra.functions.values import tempered

    q = F.get(F.array(*tempered([F.col(c) for c in p], F.col("t"))), F.col("y"))
    for _ in range(rounds):
        ts = [lo + (hi - lo) * k / grid for k in range(grid + 1)]
        every = df.select("y", *p, F.posexplode(F.array(*[F.lit(t) for t in ts])).alias("k", "t"))
        found = every.groupBy("k").agg(F.avg(-F.log(F.greatest(q, F.lit(1e-15)))).alias("loss")).collect()
        best = min(found, key=lambda r: (r["loss"], r["k"]))["k"] if found else 0
        lo, hi = ts[max(0, best - 1)], ts[min(grid, best + 1)]
    return (lo + hi) / 2
