"""Near-duplicate detection with min-max hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import components, row_key, stage, tidy

#: Words in a shingle, and the similarity (in hundredths) from which documents are linked.
SHINGLE, PERCENT = 5, 75
#: Permutations: each gives a minimum and a maximum. BANDS bands of ROWS values over all of them.
PERMUTATIONS, ROWS = 64, 4
BANDS = 2 * PERMUTATIONS // ROWS
#: Four bits of each value are kept to estimate similarity before texts are fetched. Of the 512, a pair at a
#: similarity of 0.75 differs in 64 with a deviation of 11.3. Stars and pivots are compared up to NEAR_BITS: what
#: that refuses is met again in step 5. There the tail beyond FAR_BITS is 7e-9, small beside the 5e-6 of the bands.
SKETCH_BITS, NEAR_BITS, FAR_BITS = 4, 80, 136
#: Keys that a filter of texts may broadcast (24 bytes each); beyond it the join is shuffled.
BROADCAST_IDS = 250_000
#: Random members of a bucket that the rest is compared with before the exact join.
PIVOTS = 3
#: Pairs of one document that meet in a task; the text of one with more is dealt in several copies.
SALT = 500

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 4 << 20


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, np.uint64)


_BYTE = _random(11, 256)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = _random(12, SHINGLE) | np.uint64(1)
_MULT, _ADD = _random(13, PERMUTATIONS) | np.uint64(1), _random(14, PERMUTATIONS)


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64)))) for b in (_BASE, inverse))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit number for each word, over the bytes of the lower-cased text at once."""
    data, out = text.encode().lower(), []
    while data:
        cut = len(data)
        if cut > _PIECE:  # at a blank, so that no word is cut
            found = [x for x in (data.find(c, _PIECE) for c in b" \t\n\x0b\x0c\r") if x >= 0]
            cut = min(found, default=cut)
        piece, data = data[:cut], data[cut:]
        b = np.frombuffer(piece, np.uint8)
        up, down = _powers(1 << max(12, len(b)).bit_length())
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * up[: len(b)])))
        edge = np.diff(np.concatenate(([0], (~_SPACE[b]).view(np.int8), [0])))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out.append(_mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _STEP[0]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingles of a text as 64-bit numbers."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    n = min(SHINGLE, len(w))
    m = len(w) - n + 1
    x = np.full(m, n, np.uint64)
    for k in range(n):
        x = _mix(x + w[k : k + m] * _STEP[k])
    return np.unique(x)


def signature(x: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the set under each permutation: 2 * PERMUTATIONS values from PERMUTATIONS hash evaluations."""
    low, high = np.full(PERMUTATIONS, _M), np.zeros(PERMUTATIONS, np.uint64)
    for k in range(0, len(x), 4096):
        h = x[None, k : k + 4096] * _MULT[:, None] + _ADD[:, None]
        low, high = np.minimum(low, h.min(1)), np.maximum(high, h.max(1))
    return np.concatenate((low, high))


def _bands(sig: np.ndarray) -> np.ndarray:
    x = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        x = _mix(x + sig.reshape(BANDS, ROWS)[:, k])
    return x.view(np.int64)


def _bits(sig: np.ndarray) -> np.ndarray:
    x = _mix(sig)
    planes = [((x >> np.uint64(k)) & np.uint64(1)).astype(np.uint8) for k in range(SKETCH_BITS)]
    return np.packbits(np.concatenate(planes)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a, b, n_shingles, set_a, set_b, bits, bands): one pass over the texts, nothing shuffled. a and b: the row's key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 1000):
                part, out = b.iloc[lo : lo + 1000], []
                for t in part["text"]:
                    x = shingles(t)
                    if len(x):
                        sig = signature(x)
                        out.append((len(x), int(np.sum(_mix(x + _STEP[1])).view(np.int64)), int(np.bitwise_xor.reduce(_mix(x + _STEP[2])).view(np.int64)), _bits(sig), _bands(sig)))
                    else:
                        out.append((0, 0, 0, None, None))
                frame = pd.DataFrame(out, columns=["n_shingles", "set_a", "set_b", "bits", "bands"])
                for k, c in enumerate(("doc_id", "a", "b")):
                    frame.insert(k, c, part[c].array)
                yield frame

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")).select("doc_id", "key.a", "key.b", "text")
    return rows.mapInPandas(tidy(run), f"doc_id {kind}, a long, b long, n_shingles long, set_a long, set_b long, bits array<long>, bands array<long>")


class _Texts:
    """The text of any class, by the row that stands for it."""

    def __init__(self, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str):
        self.classes = classes.select("id", "rep.a", "rep.b")
        self.rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")).select("key.a", "key.b", "text")

    def of(self, ids: DataFrame) -> DataFrame:
        """(id, text); only the texts of these classes travel where they are few enough to broadcast."""
        wanted = stage(ids.select("id").distinct().join(self.classes, "id"), "near-ids")
        few = wanted.count() <= BROADCAST_IDS
        return self.rows.join(F.broadcast(wanted) if few else wanted, ["a", "b"]).select("id", "text").dropDuplicates(["id"])


def _confirmed(pairs: DataFrame, texts: _Texts, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full sets are similar enough. A class with many pairs as ``src`` is met in several tasks."""
    found = texts.of(pairs.select(F.explode(F.array("src", "dst")).alias("id")))
    hot = pairs.groupBy("src").count().where(F.col("count") > SALT).select("src", F.ceil(F.col("count") / SALT).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    dealt = pairs.join(hot, "src", "left").select("src", "dst", F.pmod(F.xxhash64("dst"), salts).cast("int").alias("salt"))
    copies = found.toDF("src", "x").join(hot, "src", "left").select("src", "x", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    full = dealt.join(found.toDF("dst", "y"), "dst").join(copies, ["src", "salt"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[object, np.ndarray] = {}

        def of(key: object, text: str) -> np.ndarray:
            if key not in held:
                if len(held) > 2000:
                    held.clear()
                held[key] = shingles(text)
            return held[key]

        for p in batches:
            keep = [similar(of(s, x), of(d, y), percent) for s, x, d, y in zip(p["src"], p["x"], p["dst"], p["y"], strict=True)]
            yield p.loc[keep, ["src", "dst"]]

    return stage(full.select("src", "dst", "x", "y").mapInPandas(tidy(run), "src long, dst long"), "near-links")


def _prefixes(open_: DataFrame, texts: _Texts, percent: int) -> DataFrame:
    """(id, part, n, tok, pos, early): the rarest shingles of each class, by place in the order (frequency, value).

    Two sets that are similar enough share one of the first
    n - ceil(percent n / 100) + 1 shingles of the larger set, and one of the
    first n - ceil(2 percent n / (100 + percent)) + 1 (``early``) of the
    smaller one. Shingles in one class only come first in the order and are
    met by no other, so they are counted but not shuffled back.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[["id"]].reset_index(drop=True)
            out["toks"] = [shingles(t).view(np.int64) for t in b["text"]]
            yield out

    sets = stage(texts.of(open_).mapInPandas(tidy(run), "id long, toks array<long>"), "near-sets")
    each = sets.select("id", F.explode("toks").alias("tok"))
    shared = each.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    kept = each.join(shared, "tok").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("s"))
    own = open_.select("id", "part").distinct().join(sets.select("id", F.size("toks").alias("n")), "id").join(kept, "id")
    far = F.col("n") - F.ceil(percent * F.col("n") / 100) + 1
    near = F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent)) + 1
    alone = F.col("n") - F.size("s")
    rows = own.select("id", "part", "n", alone.alias("alone"), near.cast("int").alias("near"), F.posexplode(F.slice("s", 1, F.greatest(far - alone, F.lit(0)).cast("int"))).alias("k", "x"))
    return stage(rows.select("id", "part", "n", "x.tok", (F.col("alone") + F.col("k")).alias("pos"), (F.col("alone") + F.col("k") < F.col("near")).alias("early")), "near-prefixes")


def _across(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components that may be similar enough: every one that is so is among them.

    The first shingle that both share lies in both prefixes, and what follows
    it must suffice for the overlap that the similarity asks for.
    """
    x, y = prefixes.where("early").alias("x"), prefixes.alias("y")
    smaller = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))
    rest = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    enough = (100 + percent) * rest >= percent * (F.col("x.n") + F.col("y.n"))
    sized = 100 * F.col("x.n") >= percent * F.col("y.n")
    met = x.join(y, (F.col("x.tok") == F.col("y.tok")) & smaller & sized & enough & (F.col("x.part") != F.col("y.part")))
    return met.select(F.col("x.id").alias("src"), F.col("y.id").alias("dst")).distinct()


def _classes(sigs: DataFrame) -> DataFrame:
    """Rows of equal sets: a number, n, the smallest id, the row that stands for it, bits and bands."""
    named = sigs.where("n_shingles > 0 and doc_id is not null")
    rep = F.min(F.struct("doc_id", "a", "b")).alias("rep")
    return named.groupBy("set_a", "set_b", F.col("n_shingles").alias("n")).agg(rep, F.first("bits").alias("bits"), F.first("bands").alias("bands")).withColumn("id", F.monotonically_increasing_id())


def _components(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(doc_id, a, b, n_shingles, component_id, part) of every row; part numbers the component, null where a row has no words."""
    sigs = stage(signatures(docs, id_col, text_col), "near-sigs")
    classes = stage(_classes(sigs), "near-classes")
    texts = _Texts(docs, classes, id_col, text_col)
    sketch = classes.select("id", "n", "bits")
    # a band's number is part of its hash
    buckets = classes.select("id", F.explode("bands").alias("hash"))
    shared = buckets.groupBy("hash").agg(F.min("id").alias("star"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    members = stage(buckets.join(shared, "hash"), "near-buckets")

    def promising(pairs: DataFrame, most: int) -> DataFrame:
        """Pairs that may be similar by size and signature bits."""
        s, d = (sketch.select(F.col("id").alias(x), F.struct("n", "bits").alias(f"{x}_")) for x in ("src", "dst"))
        sized = (100 * F.col("src_.n") >= percent * F.col("dst_.n")) & (100 * F.col("dst_.n") >= percent * F.col("src_.n"))
        apart = sum((F.bit_count(F.get("src_.bits", F.lit(k)).bitwiseXOR(F.get("dst_.bits", F.lit(k)))) for k in range(2 * PERMUTATIONS * SKETCH_BITS // 64)), F.lit(0))
        return pairs.join(s, "src").join(d, "dst").where(sized & (apart <= most)).select("src", "dst")

    def open_buckets(parts: DataFrame) -> DataFrame:
        """Members of the buckets that hold more than one component: (hash, id, part)."""
        own = members.join(parts.withColumnRenamed("node", "id"), "id", "left").select("hash", "id", F.coalesce("component", "id").alias("part"))
        mixed = own.groupBy("hash").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("hash")
        return stage(own.join(mixed, "hash"), "near-open")

    tested = stage(promising(members.where("id <> star").select(F.col("star").alias("src"), F.col("id").alias("dst")).distinct(), NEAR_BITS), "near-pairs")
    links = _confirmed(tested, texts, percent)
    parts = components(links)

    open_ = open_buckets(parts)
    # one order of all classes for each k: buckets of one group have the same pivots, so a pair is met once
    pivot = open_.groupBy("hash").agg(*[F.min(F.struct(F.xxhash64("id", F.lit(k)).alias("h"), "id", "part")).alias(f"p{k}") for k in range(PIVOTS)])
    pivot = pivot.select("hash", F.explode(F.array_distinct(F.array(*[F.struct(f"p{k}.id", f"p{k}.part") for k in range(PIVOTS)]))).alias("p"))
    some = open_.join(pivot, "hash").where(F.col("part") != F.col("p.part")).select(F.col("p.id").alias("src"), F.col("id").alias("dst")).distinct()
    some = stage(promising(some.join(tested.union(tested.select("dst", "src")), ["src", "dst"], "left_anti"), NEAR_BITS), "near-pairs")
    if some.limit(1).count():
        links = stage(links.union(_confirmed(some, texts, percent)), "near-links")
        tested = tested.union(some)
        parts = components(links)
        open_ = open_buckets(parts)

    if open_.limit(1).count():
        both = tested.union(tested.select("dst", "src"))
        across = stage(promising(_across(_prefixes(open_, texts, percent), percent).join(both, ["src", "dst"], "left_anti"), FAR_BITS), "near-pairs")
        if across.limit(1).count():
            more = _confirmed(across, texts, percent)
            if more.limit(1).count():
                parts = components(links.union(more))

    # the class of a row by its set, the component of the class, the smallest id of the component
    named = classes.select("id", "set_a", "set_b", F.col("n").alias("n_shingles"), F.col("rep.doc_id").alias("least")).join(parts.withColumnRenamed("node", "id"), "id", "left")
    top = named.where("component is not null").groupBy("component").agg(F.min("least").alias("top"))
    ids = named.join(top, "component", "left").select("set_a", "set_b", "n_shingles", F.coalesce("top", "least").alias("component_id"), F.coalesce("component", "id").alias("part"))
    out = sigs.select("doc_id", "a", "b", "n_shingles", "set_a", "set_b").join(ids, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "a", "b", "n_shingles", component.alias("component_id"), "part")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept.

    Documents are linked if their sets of five-word shingles have a Jaccard
    similarity of ``percent`` hundredths or more; a component is what links
    join, named by its smallest id, which is the row kept.

    1. Equal sets become one class, so exact copies meet no bucket twice.
    2. Every class has a minimum and a maximum for each permutation, and a
       bucket for each band of four. At 0.75 a link shares no bucket with a
       chance of 5e-6, at 0.8 of 4e-8.
    3. In a bucket each class is paired with one star only; pairs close by
       their signature bits are confirmed on full sets, and links give
       components. So a bucket of n makes n pairs, not n * n.
    4. Where a bucket has more than one component yet, its classes are paired
       with PIVOTS random members of other components, and confirmed.
    5. The classes of buckets that still have more than one go through an
       exact similarity join by length and by the rarest shingles; what shares
       one across components is confirmed on full sets. Nothing is capped, and
       no link is lost to steps 3 to 5, but for the signature bits of the last,
       which refuse one at 0.75 with a chance of 7e-9.

    Words are compared by 64-bit hashes, sets by two 64-bit digests and their
    size: two different sets of 20,000 shingles share a hash with a chance of
    2e-11. Null or empty text and text without words have no shingles and are
    linked with nothing. Rows are documents: repeated rows return repeated
    rows, and rows of one id with other texts each have their own links. A
    null id is linked with nothing. A very long text is one row, and its set
    is sorted in memory. Only two input columns are read; an empty table gives
    no rows.
    """
    out = _components(docs, id_col, text_col, percent)
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those that are near duplicates of a kept one, with all their columns, whatever their names.

    The row with the smallest id of a component stays, of several such rows
    one; of exact repeats of a row one. Rows of one id with other texts that
    are not linked are in components of their own and stay. Rows without words
    and rows with a null id stay, all of them. An empty table gives no rows.
    """
    rows = stage(_components(docs, id_col, text_col, percent).where("n_shingles > 0 and doc_id is not null"), "near-rows")
    best = rows.groupBy("part").agg(F.min(F.struct("doc_id", "a", "b")).alias("best"), F.count(F.lit(1)).alias("c")).where("c > 1").select("part", "best")
    multi = rows.join(best, "part").withColumn("own", (F.col("a") == F.col("best.a")) & (F.col("b") == F.col("best.b"))).select(F.struct("a", "b").alias("__near_key"), "own")
    gone = stage(multi.where("not own").select("__near_key").distinct(), "near-gone")
    repeats = stage(multi.where("own").groupBy("__near_key").count().where("count > 1").select("__near_key"), "near-repeats")
    out = docs.withColumn("__near_key", row_key(id_col, text_col)).join(gone, "__near_key", "left_anti")
    if repeats.limit(1).count():
        out = out.join(repeats, "__near_key", "left_anti").unionByName(out.join(repeats, "__near_key", "left_semi").dropDuplicates(["__near_key"]))
    return out.select(*docs.columns)
