"""Removal of repeated byte strings, with a logarithmic family of sparse suffix arrays."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import drop_stage, row_key, stage, tidy

#: Bytes of a repeated string, and of the grams whose smallest hash marks the suffix that stands for a window.
LENGTH, GRAM = 400, 32
#: Words of a passage that documents share, and of its grams.
PASSAGE, WORD_GRAM = 51, 6
#: Batches in which a query adds its rows to the family.
BATCHES = 4
#: Distinct contexts of one gram that a task compares; larger groups are compared window by window instead.
GROUP = 20_000
#: Keys that a filter of texts may broadcast, some 100 bytes each; beyond it the join is shuffled.
BROADCAST_KEYS = 250_000

_BASE = 0xD1342543DE82EF95
_POS_BITS = 20
_CHUNK = 1 << 19


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = _CHUNK + 2 * LENGTH + 8
    up, down = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, b, np.uint64)))) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return np.random.Generator(np.random.PCG64(21)).integers(0, 1 << 64, 256, np.uint64), up, down


_BYTE, _UP, _DOWN = _tables()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTER = np.array([i >= 0x80 or chr(i).isalnum() for i in range(256)])
_LOWER = np.where(_LETTER, _BYTE[[i + 32 if 65 <= i <= 90 else i for i in range(256)]], np.uint64(0))


def words(data: bytes) -> np.ndarray:
    """A hash for each word ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, with A-Z lower-cased."""
    b = np.frombuffer(data, np.uint8)
    inside = _LETTER[b]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    first, last = edges[::2], edges[1::2]
    if not len(first):
        return np.zeros(0, np.uint64)
    if len(b) < len(_UP):
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_LOWER[b] * _UP[: len(b)], out=total[1:])
        return _mix((total[last] - total[first]) * _DOWN[first])
    size = last - first
    at = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(at, size)
    return _mix(np.add.reduceat(_LOWER[b[inside]] * _UP[place % len(_UP)], at))


def _prefix(units: np.ndarray) -> np.ndarray:
    """Sums of bytes or of words' hashes, each times the power of its place."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((_BYTE[units] if units.dtype == np.uint8 else units) * _UP[: len(units)], out=out[1:])
    return out


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours: of the rest of one block and the beginning of the next."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def anchors(data: bytes, length: int = LENGTH, by_word: bool = False) -> tuple[np.ndarray, ...]:
    """The sampled suffixes of a text: place, gram hash, context hash, first and last window start.

    Every string of ``length`` bytes is represented by the place of the
    leftmost smallest gram in it, which depends on the string alone; windows
    with one place follow each other. The context is all bytes of the windows
    that a place stands for. With ``by_word``, words take the place of bytes.
    """
    parts = []
    size = WORD_GRAM if by_word else GRAM
    span = length - size + 1
    mask = np.uint64((1 << _POS_BITS) - 1)
    units = words(data) if by_word else np.frombuffer(data, np.uint8)
    for c in range(0, len(units) - length + 1, _CHUNK):
        b = units[c : c + _CHUNK + length - 1]
        total = _prefix(b)
        gram = _mix((total[size:] - total[:-size]) * _DOWN[: len(b) - size + 1])
        key = (gram & ~mask) | np.arange(len(gram), dtype=np.uint64)
        at = (_sliding_min(key, span) & mask).astype(np.int64)
        s1 = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        s2 = np.concatenate((s1[1:] - 1, [len(at) - 1]))
        p = at[s1]
        context = _mix((total[s2 + length] - total[s1]) * _DOWN[s1] + ((p - s1) * 4099 + (p - s2)).astype(np.uint64))
        parts.append((p + c, gram[p].view(np.int64), context.view(np.int64), s1 + c, s2 + c))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, np.int64) for _ in range(5))


SUFFIX = "a long, b long, batch int, p int, gram long, context long, lo int, hi int, n int"


def suffixes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = LENGTH, batches: int = BATCHES, by_word: bool = False) -> DataFrame:
    """Sampled suffixes of all rows; windows of a suffix start ``lo`` to ``hi`` bytes (or words) before it.

    Neighbours that are equal, as periodic texts have many, are one row with
    their number ``n``: as windows follow each other, each lies
    ``hi - lo + 1`` behind the one before.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in range(0, len(f), 2000):
                out: list[list] = [[] for _ in range(9)]
                for a, b, batch, t in f.iloc[k : k + 2000].itertuples(index=False):
                    data = (t or "").encode()
                    if len(data) < length:
                        continue
                    p, gram, context, s1, s2 = anchors(data, length, by_word)
                    lo, hi = p - s2, p - s1
                    other = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
                    at = np.flatnonzero(np.concatenate(([True], other))) if len(p) else np.zeros(0, np.int64)
                    n = np.diff(np.append(at, len(p)))
                    for col, x in zip(out, (np.full(len(at), a), np.full(len(at), b), np.full(len(at), batch), p[at], gram[at], context[at], lo[at], hi[at], n), strict=True):
                        col.append(x)
                if out[0]:
                    yield pd.DataFrame(dict(zip([x.split()[0] for x in SUFFIX.split(", ")], [np.concatenate(x) for x in out], strict=True)))

    key = row_key(id_col, text_col)
    rows = docs.select(key.alias("key"), F.col(text_col).alias("text")).select("key.a", "key.b", F.pmod(F.col("key.a"), F.lit(batches)).cast("int").alias("batch"), "text")
    return rows.mapInPandas(tidy(run), SUFFIX)


ENTRY = ["gram", "context", "lo", "hi"]


class SuffixFamily:
    """Suffix arrays of sampled suffixes in levels of doubling size.

    A batch becomes a run: its distinct suffixes by (gram, context), an order
    in which equal strings are neighbours, which is all that a scan for equal
    ones needs of a suffix array's order; with it goes the run's list of grams,
    each with its least and greatest context. Before a new run is merged it is
    merge-scanned against every level, entry by entry and gram by gram, each
    once on either side: equal entries are long matches (``whole``), a gram
    with other contexts on the other side may hold matches of a part of them
    (``shared``). Then, as long as the youngest level is as large, the two are
    merged. So a suffix is rewritten once a doubling, and n batches leave at
    most log2(n) + 1 levels to scan. Runs are tables in the shared folder.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame, DataFrame]] = []
        self.whole: list[DataFrame] = []
        self.shared: list[DataFrame] = []
        self.tables: list[DataFrame] = []

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stage(df, name))
        return self.tables[-1]

    def add(self, batch: DataFrame) -> None:
        run = self._stage(batch.groupBy(*ENTRY).agg(F.sum("n").alias("n"), F.min(F.struct("a", "b", "p")).alias("where")), "suffix-run")
        grams = self._stage(run.groupBy("gram").agg(F.min("context").alias("least"), F.max("context").alias("most")), "suffix-grams")
        self.whole.append(run.where("n > 1").select(*ENTRY))
        self.shared.append(grams.where("least <> most").select("gram"))
        for _, entries, others in self.levels:
            self.whole.append(run.select(*ENTRY).join(entries.select(*ENTRY), ENTRY))
            there = others.select("gram", F.col("least").alias("l"), F.col("most").alias("m"))
            self.shared.append(grams.join(there, "gram").where("least <> l or most <> m").select("gram"))
        size, merged = 1, False
        while self.levels and self.levels[-1][0] == size:
            _, entries, others = self.levels.pop()
            run = run.unionByName(entries).groupBy(*ENTRY).agg(F.sum("n").alias("n"), F.min("where").alias("where"))
            grams = grams.unionByName(others).groupBy("gram").agg(F.min("least").alias("least"), F.max("most").alias("most"))
            size, merged = size * 2, True
        self.levels.append((size, self._stage(run, "suffix-level") if merged else run, self._stage(grams, "suffix-grams") if merged else grams))

    def found(self) -> tuple[DataFrame, DataFrame]:
        """The entries that are repeated as a whole, and the entries of all levels whose grams have several contexts, with how many (m).

        The tables of the family go with it.
        """
        whole = stage(reduce(DataFrame.unionByName, self.whole).distinct(), "suffix-whole")
        shared = self._stage(reduce(DataFrame.unionByName, self.shared).distinct(), "suffix-shared")
        entries = reduce(DataFrame.unionByName, [e.join(shared, "gram", "left_semi") for _, e, _ in self.levels])
        entries = entries.groupBy(*ENTRY).agg(F.min("where").alias("where"))
        several = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("m"))
        partly = stage(entries.join(several, "gram"), "suffix-partly")
        for t in self.tables:
            drop_stage(t.sparkSession, t)
        return whole, partly


def _windows(frame: pd.DataFrame, length: int, unit: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, offset, hash) of every window of contexts."""
    entry, offset, hashes = [], [], []
    for k, (lo, hi, data) in enumerate(zip(frame["lo"], frame["hi"], frame["bytes"], strict=True)):
        total = _prefix(np.frombuffer(data, unit))
        n = hi - lo + 1
        hashes.append((total[length : length + n] - total[:n]) * _DOWN[:n])
        offset.append(np.arange(hi, lo - 1, -1))
        entry.append(np.full(n, k))
    return np.concatenate(entry), np.concatenate(offset), np.concatenate(hashes)


def _intervals(entry: np.ndarray, offset: np.ndarray, n: int) -> list[list[dict]]:
    """Runs of neighbouring offsets of each entry."""
    order = np.lexsort((offset, entry))
    e, d = entry[order], offset[order]
    new = np.ones(len(e), bool)
    new[1:] = (e[1:] != e[:-1]) | (d[1:] != d[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(e))[: len(first)] - 1
    out: list[list[dict]] = [[] for _ in range(n)]
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        out[e[i]].append({"lo": int(d[i]), "hi": int(d[j])})
    return out


INTERVALS = "array<struct<lo:int,hi:int>>"


def _compared(contexts: DataFrame, length: int, by_word: bool = False) -> DataFrame:
    """Repeated windows among the contexts of each gram; a partition holds whole groups, sorted.

    With ``by_word``, those whose contexts name different documents (``least``, ``most``).
    """

    def settle(f: pd.DataFrame) -> pd.DataFrame:
        entry, offset, h = _windows(f, length, np.uint64 if by_word else np.uint8)
        group = np.cumsum(np.concatenate(([0], f["gram"].to_numpy()[1:] != f["gram"].to_numpy()[:-1]))).astype(np.uint64)[entry]
        order = np.lexsort((h, group))
        g, x = group[order], h[order]
        same = (g[1:] == g[:-1]) & (x[1:] == x[:-1])
        if by_word:
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            least = np.minimum.reduceat(f["least"].to_numpy()[entry[order]], first)
            most = np.maximum.reduceat(f["most"].to_numpy()[entry[order]], first)
            hit = np.repeat(least != most, np.diff(np.append(first, len(order))))
        else:
            hit = np.concatenate((same, [False])) | np.concatenate(([False], same))
        found = order[hit]
        out = f[["gram", "context", "lo", "hi"]].reset_index(drop=True)
        out["repeated"] = _intervals(entry[found], offset[found], len(f))
        return out[out["repeated"].str.len() > 0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            # the last group may go on
            cut = len(f) - int((f["gram"].to_numpy()[::-1] == f["gram"].iloc[-1]).argmin() or len(f)) if len(f) else 0
            rest, done = f.iloc[cut:], f.iloc[:cut]
            for k in _cuts(done["gram"].to_numpy(), 3000):
                yield settle(done.iloc[k[0] : k[1]])
        if rest is not None and len(rest):
            yield settle(rest)

    n = max(int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = contexts.repartition(n, "gram").sortWithinPartitions("gram")
    return dealt.mapInPandas(run, f"gram long, context long, lo int, hi int, repeated {INTERVALS}")


def _cuts(gram: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Slices of about ``size`` entries that end with a group."""
    if not len(gram):
        return []
    ends = np.append(np.flatnonzero(gram[1:] != gram[:-1]) + 1, len(gram))
    out, at = [], 0
    while at < len(gram):
        k = np.searchsorted(ends, at + size)
        end = int(ends[min(k, len(ends) - 1)])
        out.append((at, end))
        at = end
    return out


def _by_window(contexts: DataFrame, length: int, by_word: bool = False) -> DataFrame:
    """As ``_compared`` for grams with many contexts: a row a window, counted by its hash over all tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in range(0, len(f), 500):
                part = f.iloc[k : k + 500].reset_index(drop=True)
                entry, offset, h = _windows(part, length, np.uint64 if by_word else np.uint8)
                out = part[["gram", "context", "lo", "hi", *of]].iloc[entry].reset_index(drop=True)
                out["offset"], out["h"] = offset, h.view(np.int64)
                yield out

    of = ["least", "most"] if by_word else []
    w = contexts.mapInPandas(run, f"gram long, context long, lo int, hi int, {''.join(f'{c} long, ' for c in of)}offset int, h long")
    w = stage(w, "suffix-windows")
    several = F.min("least") != F.max("most") if by_word else F.count(F.lit(1)) > 1
    twice = w.groupBy("gram", "h").agg(several.alias("several")).where("several").select("gram", "h")
    hit = w.join(twice, ["gram", "h"]).groupBy("gram", "context", "lo", "hi").agg(F.sort_array(F.collect_set("offset")).alias("o"))
    run_of = F.transform("o", lambda x, i: F.struct((x - i).alias("k"), x.alias("x")))
    runs = F.transform(F.array_distinct(F.transform(run_of, lambda r: r["k"])), lambda k: (lambda m: F.struct(F.array_min(m).alias("lo"), F.array_max(m).alias("hi")))(F.transform(F.filter(run_of, lambda r: r["k"] == k), lambda r: r["x"])))
    return hit.select("gram", "context", "lo", "hi", runs.cast(INTERVALS).alias("repeated"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, batches: int = BATCHES, group: int = GROUP) -> DataFrame:
    """(key, spans): byte spans, which may overlap, of strings that also start elsewhere."""
    all_suffixes = stage(suffixes(docs, text_col, id_col, length, batches), "suffixes", ["batch"])
    family = SuffixFamily()
    for k in range(batches):
        family.add(all_suffixes.where(F.col("batch") == k))
    # a context at two places is repeated as a whole; others share at most a part with another context of their gram
    matched, partly = family.found()
    whole = matched.select(*ENTRY, F.array(F.struct("lo", "hi")).cast(INTERVALS).alias("repeated"))
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    part = _partial(texts, partly, matched, length, group)
    spans = _spans(all_suffixes, whole.unionByName(part), length, "suffix-spans")
    for t in (all_suffixes, matched, partly, part):
        drop_stage(t.sparkSession, t)
    return spans


def _partial(texts: DataFrame, partly: DataFrame, matched: DataFrame, length: int, group: int, by_word: bool = False) -> DataFrame:
    """Entries that are no match as a whole, with the windows of them that are repeated."""
    owners = ["least", "most"] if by_word else []
    cols = [*ENTRY, "m", *owners]
    wanted = stage(partly.groupBy(F.struct("where.a", "where.b").alias("key")).agg(F.collect_list(F.struct("where.p", *cols)).alias("cuts")), "suffix-wanted")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for text, cuts in zip(f["text"], f["cuts"], strict=True):
                data = text.encode()
                data = words(data) if by_word else data
                for c in cuts:
                    piece = data[c["p"] - c["hi"] : c["p"] - c["lo"] + length]
                    out.append((*(c[x] for x in cols), piece.tobytes() if by_word else piece))
                if len(out) > 4000:
                    yield pd.DataFrame(out, columns=[*cols, "bytes"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=[*cols, "bytes"])

    kinds = f"gram long, context long, lo int, hi int, m long, {''.join(f'{c} long, ' for c in owners)}bytes binary"
    contexts = _of_keys(texts, wanted).select("text", "cuts").mapInPandas(tidy(cut), kinds)
    most = partly.agg(F.max("m")).first()[0] or 0
    if most > group:
        contexts = stage(contexts, "suffix-contexts")
        part = _compared(contexts.where(F.col("m") <= group), length, by_word).unionByName(_by_window(contexts.where(F.col("m") > group), length, by_word))
    else:
        part = _compared(contexts, length, by_word)
    part = stage(part.join(matched, ENTRY, "left_anti"), "suffix-repeated")
    drop_stage(wanted.sparkSession, wanted)
    if most > group:
        drop_stage(contexts.sparkSession, contexts)
    return part


def _spans(all_suffixes: DataFrame, verdict: DataFrame, length: int, name: str) -> DataFrame:
    """(key, spans): where the repeated windows of all suffixes lie.

    Equal neighbours that are repeated as a whole give one span, others one each.
    """
    step = F.col("hi") - F.col("lo") + 1
    long = F.struct((F.col("p") - F.col("r.hi")).alias("s"), (F.col("p") + (F.col("n") - 1) * step - F.col("r.lo") + length).alias("e"))
    each = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct((F.col("p") + i * step - F.col("r.hi")).alias("s"), (F.col("p") + i * step - F.col("r.lo") + length).alias("e")))
    whole = (F.col("n") == 1) | ((F.col("r.lo") == F.col("lo")) & (F.col("r.hi") == F.col("hi")))
    spans = all_suffixes.join(verdict, ENTRY).select(F.struct("a", "b").alias("key"), F.explode("repeated").alias("r"), "p", "lo", "hi", "n")
    spans = spans.select("key", F.explode(F.when(whole, F.array(long)).otherwise(each)).alias("span"))
    return stage(spans.groupBy("key").agg(F.collect_set("span").alias("spans")), name)


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = PASSAGE, group: int = GROUP) -> DataFrame:
    """(key, n_shared_words): words inside strings of ``length`` words that another document has too.

    Documents are told apart by id and text, so repeated rows are one. Case of
    A-Z, blanks and punctuation don't count. As with bytes, equal strings sample equal
    suffixes; a context that several documents have is shared as a whole, and
    the others of a gram that several documents have are compared window by
    window.
    """
    all_suffixes = stage(suffixes(docs, text_col, id_col, length, 1, True), "passages")
    entries = stage(all_suffixes.groupBy(*ENTRY).agg(F.min("a").alias("least"), F.max("a").alias("most"), F.min(F.struct("a", "b", "p")).alias("where")), "passage-entries")
    grams = entries.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("least") == F.col("most")).alias("own"), (F.min("least") != F.max("most")).alias("several"))
    shared = stage(entries.join(grams.where("several"), "gram"), "passages-shared")
    drop_stage(entries.sparkSession, entries)
    matched = shared.where("least <> most").select(*ENTRY)
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    part = _partial(texts, shared.where("m > 1 and own > 0").drop("own", "several"), matched, length, group, True)
    whole = matched.select(*ENTRY, F.array(F.struct("lo", "hi")).cast(INTERVALS).alias("repeated"))
    spans = _spans(all_suffixes, whole.unionByName(part), length, "passage-spans")
    for t in (all_suffixes, shared, part):
        drop_stage(t.sparkSession, t)
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        F.sort_array("spans"), zero, lambda x, y: F.struct(F.greatest(x["end"], y["e"]).alias("end"), (x["n"] + F.greatest(F.lit(0), y["e"] - F.greatest(x["end"], y["s"]))).alias("n")), lambda x: x["n"].cast("long")
    )
    return spans.select("key", covered.alias("n_shared_words"))


def _of_keys(texts: DataFrame, keyed: DataFrame, how: str = "inner") -> DataFrame:
    """Texts joined to a table of keys; texts without a key don't travel where the keys are few."""
    if keyed.count() <= BROADCAST_KEYS:
        texts = texts.join(F.broadcast(keyed.select("key")), "key", "left_semi")
    return texts.join(keyed, "key", how)


def remove_spans(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left, bytes removed, and maximal runs removed."""
    kept, at, removed, runs, end = [], 0, 0, 0, -1
    for s, e in sorted(spans):
        if s > end:
            kept.append(data[at:s])
            runs += 1
        if e > end:
            removed += e - max(s, end, 0)
            at = end = e
    kept.append(data[at:])
    return b"".join(kept), removed, runs


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, batches: int = BATCHES, group: int = GROUP, passage: int | None = None) -> DataFrame:
    """One row per input row: ``id_col``, kept (binary), n_bytes, n_removed, n_spans.

    With ``passage``, n_shared_words follows, the words inside strings of that
    many words that another document has too (``shared_passages``). It says
    what documents share beside what is removed, and changes neither.

    Texts are UTF-8 bytes, null counts as empty, and no match crosses texts.
    Every byte is removed that a string of ``length`` bytes covers which also
    starts anywhere else in the input, all copies included.

    Suffixes are sampled so that equal strings sample the same suffix. Batches
    of them are merge-scanned against the levels of a SuffixFamily and added to
    it. Equal contexts are repeated as they are; only contexts that share a
    gram with another one are fetched and compared window by window. Grams with
    over ``group`` contexts are compared over all tasks by window hashes, none
    is capped. Contexts and windows are compared by 64-bit hashes, windows
    among those of one gram only: two different ones of n have one hash with a
    chance of n * n / 4e19.

    Repeated rows are copies of each other; ids may be null or repeat. Texts
    under ``length`` bytes stay whole. A cut may fall inside a character, so
    what is kept is binary. A very long text is hashed in pieces. Columns but
    the two named are not read. An empty table gives no rows.
    """
    spans = repeated_spans(docs, id_col, text_col, length, batches, group)
    extra = [] if passage is None else ["n_shared_words"]
    if passage is not None:
        spans = stage(spans.join(shared_passages(docs, id_col, text_col, passage, group), "key", "full_outer"), "suffix-found")
    kind = dict(docs.dtypes)[id_col]
    d = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    few = spans.count() <= BROADCAST_KEYS
    keys = F.broadcast(spans.select("key")) if few else spans.select("key")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for i, text, found in zip(f["id"], f["text"], f["spans"], strict=True):
                data = text.encode()
                out.append((i, *remove_spans(data, [(x["s"], x["e"]) for x in found]), len(data)))
            frame = pd.DataFrame(out, columns=["id", "kept", "n_removed", "n_spans", "n_bytes"]).astype({"id": f["id"].dtype})
            for c in extra:
                frame[c] = f[c].to_numpy()
            yield frame[["id", "kept", "n_bytes", "n_removed", "n_spans", *extra]]

    clean = d.join(keys, "key", "left_anti").select("id", F.encode("text", "utf-8").alias("kept"), F.octet_length("text").cast("long").alias("n_bytes"), *(F.lit(0).cast("long").alias(c) for c in ("n_removed", "n_spans", *extra)))
    found = spans.select("key", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in extra))
    hit = d.join(keys, "key", "left_semi").join(found, "key").select("id", "text", "spans", *extra).mapInPandas(run, f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long{''.join(f', {c} long' for c in extra)}")
    return clean.unionByName(hit).withColumnRenamed("id", id_col)


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """The plain definition, for tests."""
    seen: dict[bytes, int] = {}
    data = [(t or "").encode() for t in texts]
    for b in data:
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = seen.get(b[s : s + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s] += 1
                gone[min(len(b), s + length)] -= 1
        m = np.cumsum(gone)[: len(b)] > 0
        runs = int((m & ~np.concatenate(([False], m[:-1]))).sum()) if len(b) else 0
        out.append((len(b), int(m.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~m].tobytes()).hexdigest()))
    return out


def brute_force_words(docs: list[tuple], length: int = PASSAGE) -> list[int]:
    """Words of (id, text) that different ones share, for tests."""
    found = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in docs]
    seen: dict[tuple, set[tuple]] = {}
    for d, w in zip(docs, found, strict=True):
        for i in range(len(w) - length + 1):
            seen.setdefault(tuple(w[i : i + length]), set()).add(d)
    return [len({j for i in range(len(w) - length + 1) if len(seen[tuple(w[i : i + length])]) > 1 for j in range(i, i + length)}) for w in found]
