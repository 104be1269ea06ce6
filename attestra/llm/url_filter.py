"""URL filtering by rules and by the ratio of two character models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attestra.llm.common import stage

#: (verdict, host, path): a rule fits its host and all subdomains where the path starts with the rule's; the longest wins.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Characters of context that a model looks back at most, and the chance 1 / ALPHABET of a character that nothing is known of.
ORDER, ALPHABET = 4, 128
#: First hexadecimal digits of a text's MD5: of texts that have one, the rows calibrate instead of teaching.
HELD = "012"
#: Bins of the normalised difference for each unit, and how far they reach.
BINS, REACH = 200, 2000
#: Stands before the first and behind the last character of a text.
_EDGE = "\x01"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (then up to ``?``, ``#`` or the end); both '' for null and where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The rule that fits best, as (size, rule, verdict); null where none does."""
    fits = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size: int, rule: string, verdict: string>")


def _windows(text: Column, order: int) -> Column:
    """Each character of a text, and its end, behind the ``order`` characters before it."""
    padded = F.concat(F.lit(_EDGE * order), text, F.lit(_EDGE))
    return F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{order + 1}}}))."), F.lit(1))


def window_scores(windows: DataFrame, order: int = ORDER) -> DataFrame:
    """window and score: the log-likelihood of its last character under the accepted texts less that under the rejected ones, in millionths.

    ``windows`` has one row for each distinct window, with how often accepted
    (a) and rejected (b) texts have it. A model of order k takes a character's
    count behind its k characters of context and, with the weight of the
    number of different characters seen there (Witten-Bell), what the model
    of order k - 1 says; where a context is new, the shorter one speaks alone.
    """
    seen = windows.where("a + b > 0")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda n: F.struct(n.alias("n"), F.substring("window", -n, n).alias("gram"))))
    counts = seen.select(suffix.alias("s"), "a", "b").groupBy("s.n", "s.gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # one model without context: its totals are two numbers each, not a key that all windows share
    bare = counts.where("n = 1").agg(*[F.coalesce(f, F.lit(0)) for f in (F.sum("a"), F.count_if(F.col("a") > 0), F.sum("b"), F.count_if(F.col("b") > 0))]).first()
    contexts = (
        counts.where("n > 1").groupBy("n", F.expr("substring(gram, 1, n - 1)").alias("context"))
        .agg(F.sum("a").alias("na"), F.count_if(F.col("a") > 0).alias("ta"), F.sum("b").alias("nb"), F.count_if(F.col("b") > 0).alias("tb"))
    )
    chain = windows.select("window", suffix.alias("s")).select("window", "s.*").withColumn("context", F.expr("substring(gram, 1, n - 1)"))
    known = chain.join(counts, ["n", "gram"], "left").withColumn("context", F.when(F.col("n") > 1, F.col("context")).otherwise(F.col("window"))).join(contexts, ["n", "context"], "left")
    totals = dict(zip(("na", "ta", "nb", "tb"), bare, strict=True))
    stats = [F.coalesce(c, F.when(F.col("n") == 1, totals[c]) if c in totals else F.lit(0), F.lit(0)).cast("double").alias(c) for c in ("a", "na", "ta", "b", "nb", "tb")]
    steps = known.groupBy("window").agg(F.sort_array(F.collect_list(F.struct("n", *stats))).alias("steps"))

    def chance(own: str, n: str, t: str) -> Column:
        return F.aggregate("steps", F.lit(1.0 / ALPHABET), lambda p, s: F.when(s[n] > 0, (s[own] + s[t] * p) / (s[n] + s[t])).otherwise(p))

    score = F.round((F.log(chance("a", "na", "ta")) - F.log(chance("b", "nb", "tb"))) * 1e6).cast("long")
    return steps.select("window", score.alias("score"))


def _cut(labelled: DataFrame) -> float:
    """The difference under which a text is rejected: midway between two bins that have rows, such that the share of accepted rows over it plus that of rejected rows under it is largest; of equal ones the nearest to 0. 0 where held rows lack a class."""
    k = F.least(F.greatest(F.floor(F.col("difference") * BINS), F.lit(-REACH)), F.lit(REACH)).alias("bin")
    bins = labelled.groupBy(k).agg(F.count_if("allowed").alias("a"), F.count_if(~F.col("allowed")).alias("b"))
    every, below = Window.partitionBy(F.lit(1)), Window.partitionBy(F.lit(1)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    total = [F.sum(c).over(every) for c in "ab"]
    under = [F.coalesce(F.sum(c).over(below), F.lit(0)) for c in "ab"]
    gain = F.when((total[0] > 0) & (total[1] > 0), F.round(under[1] / total[1] - under[0] / total[0], 9))
    middle = (F.coalesce(F.lag("bin").over(Window.partitionBy(F.lit(1)).orderBy("bin")) + 1, F.col("bin")) + F.col("bin")) / 2
    best = bins.select(middle.alias("middle"), gain.alias("gain")).where("gain is not null").orderBy(F.desc("gain"), F.abs("middle"), "middle").first()
    return best["middle"] / BINS if best else 0.0


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", order: int = ORDER) -> DataFrame:
    """``id_col``, host, path, rule, verdict, by_rule and margin, one row per input row.

    Rules decide where one fits. The rows that rules accept and reject teach
    a character model each, over host and path (the whole url where it has no
    ``://``): interpolated orders 0 to ``order``. A url without a rule is
    rejected if its log-likelihood difference, divided by its length, is
    under a cut calibrated on labelled rows that taught nothing (about three
    of sixteen texts). ``margin`` is the difference less the cut, for all rows.

    Counts cover all rows. Windows are counted with map-side sums and scored
    once each; only the join of their occurrences is skewed, by windows that
    most urls have, and the engine splits such partitions. Null urls count as
    empty: host and path '', no rule. Repeated rows return repeated rows and
    weigh as often; ids may be null; equal urls get equal verdicts. A very long
    url is cut into windows in one pass. Where rules reject nothing every
    url without a rule is accepted, and where they accept nothing, rejected,
    if they reject any. Rules of one length go by their text, then verdict. Columns of
    ``pages`` besides the two are not read, whatever their names; an empty
    table gives no rows.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(url_col, F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.select("id", "url", host.alias("host"), path.alias("path"))
    text = F.when(F.contains("url", F.lit("://")), F.concat("host", "path")).otherwise(F.col("url"))
    rows = rows.select("id", "host", "path", match_rule(F.col("host"), F.col("path"), rules).alias("best"), text.alias("text"))
    # numbered as it is written, so that a task that runs again numbers nothing anew
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "urls")
    held = F.substring(F.md5("text"), 1, 1).isin(*HELD)
    every = rows.select("row", F.explode(_windows(F.col("text"), order)).alias("window"), *[F.when((F.col("best.verdict") == v) & ~held, 1).otherwise(0).alias(c) for v, c in (("allow", "a"), ("block", "b"))])
    counted = every.groupBy("window").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    scored = every.select("row", "window").join(window_scores(stage(counted, "url-windows"), order), "window")
    summed = scored.groupBy("row").agg((F.sum("score") / F.count(F.lit(1)) / 1e6).alias("difference"))
    out = stage(rows.withColumn("held", held).join(summed, "row"), "url-differences")

    labels = out.where("best is not null").groupBy().agg(F.count_if(F.col("best.verdict") == "allow").alias("a"), F.count_if(F.col("best.verdict") == "block").alias("b")).first()
    cut = _cut(out.where("held and best is not null").select("difference", (F.col("best.verdict") == "allow").alias("allowed")))
    guess = F.when(F.col("difference") < cut, "block").otherwise("allow") if labels["a"] and labels["b"] else F.lit("block" if labels["b"] else "allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), guess).alias("verdict"),
        F.col("best").isNotNull().alias("by_rule"), (F.col("difference") - cut).alias("margin"),
    )


def _oracle() -> str:
    """The same in SQL, for the rules and constants above."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN {{'rule': '{h + p}', 'verdict': '{v}'}}"
        for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    grams = " UNION ALL ".join(f"SELECT {n} AS n, right(w, {n}) AS gram, a, b FROM d WHERE a + b > 0" for n in range(1, ORDER + 2))
    joins = " ".join(
        f"LEFT JOIN counts g{n} ON g{n}.n = {n} AND g{n}.gram = right(w, {n}) LEFT JOIN contexts c{n} ON c{n}.n = {n} AND c{n}.context = left(right(w, {n}), {n - 1})"
        for n in range(1, ORDER + 2)
    )

    def chance(c: str) -> str:
        p = f"(1.0::DOUBLE / {ALPHABET})"
        for n in range(1, ORDER + 2):
            p = f"CASE WHEN coalesce(c{n}.n{c}, 0) > 0 THEN (coalesce(g{n}.{c}, 0)::DOUBLE + c{n}.t{c}::DOUBLE * {p}) / (c{n}.n{c}::DOUBLE + c{n}.t{c}::DOUBLE) ELSE {p} END"
        return p

    return rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, instr(coalesce(url, ''), '://') AS place FROM pages),
s AS (SELECT page_id, url, place, CASE WHEN place > 0 THEN substr(url, place + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, url, place, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
p AS (SELECT row_number() OVER () AS r, page_id, host, path, CASE {fits} END AS best, CASE WHEN place > 0 THEN host || path ELSE url END AS text FROM h),
l AS MATERIALIZED (SELECT *, substr(md5(text), 1, 1) IN ({", ".join(f"'{x}'" for x in HELD)}) AS held, repeat(chr(1), {ORDER}) || text || chr(1) AS padded FROM p),
o AS MATERIALIZED (SELECT r, CASE WHEN best.verdict = 'allow' AND NOT held THEN 1 ELSE 0 END AS a, CASE WHEN best.verdict = 'block' AND NOT held THEN 1 ELSE 0 END AS b, substr(padded, k, {ORDER + 1}) AS w
      FROM (SELECT *, unnest(range(1, length(padded) - {ORDER} + 1)) AS k FROM l)),
d AS MATERIALIZED (SELECT w, sum(a) AS a, sum(b) AS b FROM o GROUP BY w),
counts AS MATERIALIZED (SELECT n, gram, sum(a) AS a, sum(b) AS b FROM ({grams}) GROUP BY n, gram),
contexts AS MATERIALIZED (SELECT n, left(gram, n - 1) AS context, sum(a) AS na, count(*) FILTER (a > 0) AS ta, sum(b) AS nb, count(*) FILTER (b > 0) AS tb FROM counts GROUP BY n, context),
sc AS MATERIALIZED (SELECT w, round((ln({chance("a")}) - ln({chance("b")})) * 1e6)::BIGINT AS score FROM d {joins}),
f AS MATERIALIZED (SELECT r, sum(score)::BIGINT / count(*) / 1e6 AS difference FROM o JOIN sc USING (w) GROUP BY r),
m AS MATERIALIZED (SELECT * FROM l JOIN f USING (r)),
b AS (SELECT greatest(least(floor(difference * {BINS}), {REACH}), -{REACH}) AS bin, count(*) FILTER (best.verdict = 'allow') AS a, count(*) FILTER (best.verdict = 'block') AS b FROM m WHERE held AND best IS NOT NULL GROUP BY 1),
e AS (SELECT (coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin) + bin) / 2 AS middle, sum(a) OVER () AS ta, sum(b) OVER () AS tb, coalesce(sum(a) OVER x, 0) AS ua, coalesce(sum(b) OVER x, 0) AS ub FROM b WINDOW x AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce((SELECT middle / {BINS} FROM e WHERE ta > 0 AND tb > 0 ORDER BY round(ub / tb - ua / ta, 9) DESC, abs(middle), middle LIMIT 1), 0) AS cut),
k AS (SELECT count(*) FILTER (best.verdict = 'allow') AS ka, count(*) FILTER (best.verdict = 'block') AS kb FROM m)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN ka > 0 AND kb > 0 THEN CASE WHEN difference < cut THEN 'block' ELSE 'allow' END WHEN kb > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM m, cut, k
"""


ORACLE = _oracle()
