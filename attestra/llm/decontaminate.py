"""Benchmark decontamination by suffix arrays of the training text."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import row_key, slices, stage, tidy

#: Bytes of benchmark text in one block (a larger item is a block of its own); every block is matched against all
#: documents. The driver holds the texts of one block at a time, a task builds the block's windows: 8 bytes of text
#: make some 60 bytes.
BLOCK_BYTES = 4 << 20

#: Lower-cases A-Z; bytes that are in no word become blanks. Every byte of a character above 127 is in a word.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class BenchmarkBlock:
    """The suffixes of one block of benchmark items, cut to a window, as numbers of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window, self.vocab = window, {}
        self.items = [x for x, _ in items]
        number = lambda w: self.vocab.setdefault(w, len(self.vocab) + 1)
        parts = [np.fromiter(map(number, ws), np.uint32, len(ws)) for ws in (words(t) for _, t in items)]
        length = np.array([len(x) for x in parts], np.int64)
        n = np.where(length > 0, length - np.minimum(length, window) + 1, 0)
        flat = np.concatenate((*parts, np.zeros(window, np.uint32)))
        self.item = np.repeat(np.arange(len(parts)), n)
        self.start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.size = np.minimum(length, window)[self.item]
        at = np.repeat(np.cumsum(length) - length, n) + self.start
        keys = np.lib.stride_tricks.sliding_window_view(flat, window)[at] if len(at) else np.zeros((0, window), np.uint32)
        self.keys = np.where(np.arange(window)[None, :] < self.size[:, None], keys, 0).astype(">u4")
        self.least = int(self.size.min()) if len(self.size) else 0

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the windows in a shard: (position in the shard, window).

        ``ids`` numbers the shard's words, 0 where a word is in no item and
        between documents. The suffix array has every suffix that can start a
        window: those in a stretch of known words as long as the shortest one.
        """
        none = np.zeros(0, np.int64)
        if not self.least or not len(ids):
            return none, none
        stop = np.flatnonzero(np.append(ids, 0) == 0)
        gap = stop[np.searchsorted(stop, np.arange(len(ids)))] - np.arange(len(ids))
        at = np.flatnonzero(gap >= self.least)
        if not len(at):
            return none, none
        padded = np.concatenate((ids, np.zeros(self.window, ids.dtype)))
        suffix = np.lib.stride_tricks.sliding_window_view(padded, self.window)[at].astype(">u4")
        suffix[np.arange(self.window)[None, :] >= gap[at][:, None]] = 0
        width = f"S{4 * self.window}"
        flat = suffix.view(width).ravel()
        order = np.argsort(flat, kind="stable")
        array, at = flat[order], at[order]
        lo = np.searchsorted(array, self.keys.view(width).ravel(), side="left")
        top = self.keys.copy()
        top[np.arange(self.window)[None, :] >= self.size[:, None]] = 0xFFFFFFFF
        hi = np.searchsorted(array, top.view(width).ravel(), side="right")
        n = hi - lo
        which = np.repeat(np.arange(len(n)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return at[lo[which] + offset], which


def match_shard(texts: list[str | None], test: BenchmarkBlock) -> list[tuple[int, list[tuple[str, int, int, int]]]]:
    """For each text its number of words and its longest verbatim matches: (item, start in item, start in text, words)."""
    get, parts, sizes = test.vocab.get, [], []
    for t in texts:
        w = words(t)
        parts += [np.fromiter(map(get, w, repeat(0)), np.uint32, len(w)), np.zeros(1, np.uint32)]
        sizes.append(len(w))
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    base = np.cumsum([0, *(n + 1 for n in sizes)])
    pos, win = test.search(ids)
    doc = np.searchsorted(base, pos, side="right") - 1
    item, start, size = test.item[win], test.start[win], test.size[win]
    local = pos - base[doc]
    # windows of one item on one diagonal that follow each other are one match
    order = np.lexsort((local, local - start, item, doc))
    doc, item, start, size, local = (x[order] for x in (doc, item, start, size, local))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | ((local - start)[1:] != (local - start)[:-1]) | (local[1:] > local[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    out: list[list] = [[] for _ in texts]
    for a, b in zip(first, last, strict=True):
        out[doc[a]].append((test.items[item[a]], int(start[a]), int(local[a]), int(local[b] + size[b] - local[a])))
    return list(zip(sizes, out, strict=True))


MATCH = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"


_BUILT: dict[str, BenchmarkBlock] = {}


def _built(name: str, sent: Broadcast, window: int) -> BenchmarkBlock:
    """The windows of a broadcast block; a worker remembers the last that it built."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = BenchmarkBlock(sent.value, window)
    return _BUILT[name]


def _row_matches(docs: DataFrame, bench: DataFrame, window: int, block_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """(id, a, b, n_words, matches) of every row; a and b are its key."""
    spark = docs.sparkSession
    items = bench.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    source = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")).select("id", "key.a", "key.b", "text")
    schema = f"id {dict(docs.dtypes)[id_col]}, a long, b long, n_words long, matches {MATCH}"

    def scan(k: int) -> DataFrame:
        block = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        texts = [tuple(r) for r in block.orderBy("item_id", "text").collect()]
        name, sent = uuid.uuid4().hex, spark.sparkContext.broadcast(texts)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            test = _built(name, sent, window)
            for b in batches:
                for part in slices(b, "text", 2000):
                    found = match_shard(part["text"].tolist(), test)
                    out = part[["id", "a", "b"]].reset_index(drop=True)
                    out["n_words"] = [n for n, _ in found]
                    out["matches"] = [[dict(zip(("item_id", "item_start", "doc_start", "n_words"), m, strict=True)) for m in ms] for _, ms in found]
                    yield out

        return source.mapInPandas(tidy(run), schema)

    if blocks == 1:
        return scan(0)
    # each row meets every block: it is known by its key, which has its text, and repeats of a row by their number
    hits = reduce(DataFrame.unionByName, [scan(k).withColumn("block", F.lit(k)) for k in range(blocks)])
    grouped = hits.groupBy("a", "b").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.count_if(F.col("block") == 0).alias("copies"),
        F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"),
    )
    return grouped.select("id", "a", "b", "n_words", "matches", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def benchmark_matches(docs: DataFrame, bench: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Longest verbatim matches of benchmark items in documents: ``id_col``, n_words, matches.

    A batch of documents is a shard with its own suffix array of words; every
    suffix of every item is found in it by two binary searches, as deep as the
    window, and neighbours on one diagonal join into the longest match with
    its places. The benchmark's size is measured first and it is dealt into
    blocks of about ``block_bytes``; each block goes to all documents, so what
    a task holds doesn't grow with the benchmark. With one block no row is
    shuffled; with more, results are the same.

    Null and empty texts, and items without words, match nothing. An item of
    fewer words than ``window`` is one window. An item with a null id is
    matched as any other, with a null in its matches; items of equal id and
    text are one, matched twice. Repeated rows each return their own row, and
    rows of one id with other texts have their own matches. A very long text
    is a shard by itself. Only two input columns are read. An empty benchmark
    gives no matches, an empty table no rows.
    """
    return _row_matches(docs, bench, window, block_bytes, id_col, text_col).select(F.col("id").alias(id_col), "n_words", "matches")


def contamination(docs: DataFrame, bench: DataFrame, window: int = 10, **options) -> DataFrame:
    """Per document: words, words inside any match, items that occur, and whether it is contaminated.

    The input may have any further columns; none is returned. Nulls, repeats
    and empty tables are as in ``benchmark_matches``: a row without words has
    zeros, and a null item id counts for n_hit and contaminated only.
    """
    m = benchmark_matches(docs, bench, window, **options)
    ends = F.transform(F.array_sort(F.transform("matches", lambda x: F.struct(x["doc_start"].alias("s"), (x["doc_start"] + x["n_words"]).alias("e")))), lambda x: x)
    hit = F.aggregate(
        ends,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["end"]))).cast("long").alias("n"),
            F.greatest(acc["end"], x["e"]).cast("int").alias("end"),
        ),
        lambda acc: acc["n"],
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda x: x["item_id"])))
    return m.select(
        "*",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = 10, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with all their columns, whatever their names.

    Texts go to the workers once and don't come back: rows with a match are
    known by their key. Null and empty texts stay; of rows that share an id
    only those go whose text has a match; repeated rows go or stay together.
    An empty benchmark takes nothing, an empty table gives no rows.
    """
    found = _row_matches(docs, bench, window, block_bytes, id_col, text_col).where(F.size("matches") > 0)
    gone = stage(found.select(F.struct("a", "b").alias("__leak_key")).distinct(), "leak-keys")
    return docs.withColumn("__leak_key", row_key(id_col, text_col)).join(gone, "__leak_key", "left_anti").select(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bp AS (SELECT item_id, w, least(len(w), 10) AS l, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS p FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[p:p + l - 1], ' ') AS k FROM bp),
dp AS (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS p FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l),
dw AS (SELECT doc_id, l, p, array_to_string(w[p:p + l - 1], ' ') AS k FROM dp),
h AS (SELECT doc_id, item_id, p, l FROM dw JOIN bw USING (l, k)),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + l - 1)) AS x FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""


def brute_force(docs: list[tuple[int, str | None]], bench: list[tuple[object, str | None]], window: int = 10) -> dict[int, tuple]:
    """The plain definition, for tests."""
    out = {}
    item_words = {str(i): words(t) for i, t in bench}
    for d, t in docs:
        w, hit, items = words(t), set(), set()
        for i, iw in item_words.items():
            n = min(window, len(iw))
            wins = {tuple(iw[p : p + n]) for p in range(len(iw) - n + 1)} if iw else set()
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in wins:
                    hit |= set(range(p, p + n))
                    items.add(i)
        out[d] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    return out
