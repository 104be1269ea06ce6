"""Normalisation and similarity of names, dates and addresses."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

#: Reserved prefixes of names, dates and places. Fixed values.
PREFIXES = ("SYNGIV-", "SYNFAM-", "SYNNAME-", "SYNDOB-", "SYNLOC-")
#: Street words and their short forms. Fixed values.
STREET = {
    "STREET": "ST", "ROAD": "RD", "AVENUE": "AVE", "BOULEVARD": "BLVD", "DRIVE": "DR", "LANE": "LN", "COURT": "CT", "PLACE": "PL", "PARKWAY": "PKWY",
    "HIGHWAY": "HWY", "ROUTE": "RTE", "APARTMENT": "APT", "SUITE": "STE", "NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W",
}


def fold(value: str | None) -> str:
    text = (value or "").strip()
    if text.lower() == "nan":
        return ""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()


@F.pandas_udf(StringType())
def _fold_any(values: pd.Series) -> pd.Series:
    return values.map({v: fold(v) for v in values.unique()})


def upper_ascii(value: Column) -> Column:
    """Trimmed, without combining marks, upper case; missing is ''.

    Plain ASCII, nearly every value, is folded in the JVM; the compatibility
    decomposition that Spark lacks gets the rest in Arrow batches, and nulls
    for what is folded already.
    """
    plain = F.trim(F.coalesce(value, F.lit("")))
    easy = F.when(F.lower(plain) == "nan", "").otherwise(F.upper(plain))
    ascii_only = plain.rlike(r"^[\x00-\x7F]*$")
    return F.when(ascii_only, easy).otherwise(_fold_any(F.when(~ascii_only, plain)))


def clean_text(value: Column) -> Column:
    plain = F.trim(F.coalesce(value, F.lit("")))
    return F.when(F.lower(plain) == "nan", "").otherwise(plain)


def strip_prefix(value: Column) -> Column:
    return F.regexp_replace(value, f"^(?:{'|'.join(PREFIXES)})", "")


def norm_name(value: Column) -> Column:
    return F.regexp_replace(strip_prefix(upper_ascii(value)), "[^A-Z0-9]", "")


def norm_dob(value: Column) -> Column:
    """The first yyyymmdd, with or without - or / between its parts, as ISO text if it is a real date; '' otherwise."""
    text = strip_prefix(upper_ascii(value))
    parts = [F.regexp_extract(text, r"([0-9]{4})[-/]?([0-9]{2})[-/]?([0-9]{2})", k) for k in (1, 2, 3)]
    iso = F.when((parts[0] != "") & (parts[0] != "0000"), F.concat_ws("-", *parts))
    return F.coalesce(F.date_format(F.try_to_date(iso, "yyyy-MM-dd"), "yyyy-MM-dd"), F.lit(""))


def norm_address(value: Column) -> Column:
    words = F.regexp_extract_all(strip_prefix(upper_ascii(value)), F.lit("[A-Z0-9]+"), F.lit(0))
    short = F.create_map(*[F.lit(x) for kv in STREET.items() for x in kv])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def jaro(a: str, b: str, half: bool = True) -> float:
    """Jaro similarity. ``half`` counts odd transpositions as halves; otherwise they are rounded down."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free = [True] * len(b)
    left: list[str] = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                left.append(c)
                break
    if not left:
        return 0.0
    right = (c for c, f in zip(b, free, strict=True) if not f)
    odd = sum(x != y for x, y in zip(left, right, strict=True))
    m, t = len(left), odd / 2 if half else odd // 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def jaro_winkler(a: str, b: str, half: bool = True) -> float:
    base = jaro(a, b, half)
    if base <= 0.7:
        return base
    same = next((k for k, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return base + 0.1 * same * (1 - base)


def jaro_winkler_of(a: list[str], b: list[str], half: bool = True) -> np.ndarray:
    """Jaro-Winkler of many pairs at once: one step for each place of the longer words, over matrices of code points. Pairs go by the width they need, a few million cells at a time."""
    size_a, size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    out, widest = np.zeros(len(a)), np.maximum(size_a, size_b)
    some = np.flatnonzero((size_a > 0) & (size_b > 0))
    order = some[np.argsort(widest[some], kind="stable")]
    while len(order):
        width = max(8, 1 << int(widest[order[0]] - 1).bit_length())
        n = max(1, min(int((widest[order] <= width).sum()), (4 << 20) // width))
        rows, order = order[:n], order[n:]
        codes = [np.array([x[k] for k in rows], f"U{width}").view(np.uint32).reshape(n, width) for x in (a, b)]
        out[rows] = _matched(*codes, size_a[rows], size_b[rows], half)
    return out


def _matched(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, half: bool) -> np.ndarray:
    n, width = a.shape
    place = np.arange(width)
    reach = np.maximum(0, np.maximum(size_a, size_b) // 2 - 1)[:, None]
    left, free = np.zeros((n, width), bool), place < size_b[:, None]
    inside = free.copy()
    for i in range(int(size_a.max())):
        fits = free & (b == a[:, i : i + 1]) & (np.abs(place - i) <= reach) & (i < size_a)[:, None]
        j = fits.argmax(1)
        hit = np.flatnonzero(fits[np.arange(n), j])
        free[hit, j[hit]] = False
        left[hit, i] = True
    m = left.sum(1)
    # matched characters of both sides, each in its own order
    first, second = (np.take_along_axis(x, np.argsort(~f, axis=1, kind="stable"), 1) for x, f in ((a, left), (b, inside & ~free)))
    odd = ((first != second) & (place < m[:, None])).sum(1)
    t = odd / 2 if half else odd // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        base = np.where(m > 0, (m / size_a + m / size_b + (m - t) / m) / 3, 0.0)
    same = np.cumprod((a[:, :4] == b[:, :4]) & (place[:4] < np.minimum(size_a, size_b)[:, None]), axis=1).sum(1)
    base = np.where((size_a == size_b) & ((a == b) | ~inside).all(1), 1.0, base)
    return np.where(base <= 0.7, base, base + 0.1 * same * (1 - base))


def _pairwise(half: bool):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.zeros(len(a))
        some = np.flatnonzero(a.notna().to_numpy() & b.notna().to_numpy())
        out[some] = jaro_winkler_of(a.iloc[some].tolist(), b.iloc[some].tolist(), half)
        return pd.Series(out)

    return run


def similarity(a: Column, b: Column, transposition: str = "half") -> Column:
    """Jaro-Winkler. Where the words are equal or one is empty or null, the answer is known, and only nulls pass through the batches."""
    run, open_ = _pairwise(transposition == "half"), (a != b) & (a != "") & (b != "")
    return F.when((a == b) & (a != ""), 1.0).when(open_, run(F.when(open_, a), F.when(open_, b))).otherwise(0.0)


def bucket(key: Column, n: int = 5) -> Column:
    """The first 32 bits of a key's SHA-256, modulo ``n``."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def register_functions(spark: SparkSession) -> None:
    """SQL names for the scalars: the similarities and the fold as Arrow functions, the normalisers as SQL expressions of these."""
    spark.udf.register("attestra_fold", _fold_any)
    spark.udf.register("jaro_winkler", _pairwise(True))
    spark.udf.register("jaro_winkler_floor", _pairwise(False))
    prefix = f"^(?:{'|'.join(PREFIXES)})"
    plain = f"regexp_replace(attestra_fold(coalesce(x, '')), '{prefix}', '')"
    streets = "map(" + ", ".join(f"'{v}'" for kv in STREET.items() for v in kv) + ")"
    day = "([0-9]{4})[-/]?([0-9]{2})[-/]?([0-9]{2})"
    iso = "concat_ws('-', " + ", ".join(f"regexp_extract({plain}, '{day}', {k})" for k in (1, 2, 3)) + ")"
    spark.sql(f"create or replace temporary function attestra_norm_name(x string) returns string return regexp_replace({plain}, '[^A-Z0-9]', '')")
    spark.sql(f"create or replace temporary function attestra_norm_dob(x string) returns string return coalesce(date_format(try_to_date(nullif({iso}, '--'), 'yyyy-MM-dd'), 'yyyy-MM-dd'), '')")
    spark.sql(f"create or replace temporary function attestra_norm_address(x string) returns string return array_join(transform(regexp_extract_all({plain}, '[A-Z0-9]+', 0), w -> coalesce(try_element_at({streets}, w), w)), ' ')")


def with_normalized(df: DataFrame, first: str, last: str, dob: str | None = None, address: str | None = None) -> DataFrame:
    out = df.withColumn("nf", norm_name(F.col(first))).withColumn("nl", norm_name(F.col(last)))
    if dob:
        out = out.withColumn("nd", norm_dob(F.col(dob)))
    if address:
        out = out.withColumn("na", norm_address(F.col(address)))
    return out
