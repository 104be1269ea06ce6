"""Alignment of two tokenizers: which tokens of one share bytes with which of the other, and how often."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from attestra.llm.common import stage

BYTE_BPE = os.environ.get("ATTESTRA_BYTE_BPE", "/opt/tokenizers/byte_bpe_50k.json")
PIECE_BPE = os.environ.get("ATTESTRA_SENTENCEPIECE", "/opt/tokenizers/piece_bpe_32k.model")
#: Stripes that the ids of the first tokenizer are dealt to, id modulo STRIPES: frequent ids, which are small, spread. One dense block is a stripe's ids by all ids of the second (50 MB for 50,257 by 32,000).
STRIPES = 256
#: Documents, and about how many characters, that are aligned at a time.
BATCH_DOCS, BATCH_CHARS = 2048, 2_000_000
#: Distinct segments that a worker remembers, and their bytes.
REMEMBERED, REMEMBERED_BYTES = 300_000, 32 << 20
#: Entries of counts that a task gathers before it hands them on, that one block adds up, and links that one task scores.
GATHERED, FOLDED, SCORED = 500_000, 400_000_000, 50_000_000
#: New segments that are encoded at a time.
LEARNT = 8192
#: Entries of one row.
_ROW = 1 << 20
_CODE_BITS, _DOC_BITS = 36, 13


class _Numbered(dict):
    """Numbers new keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted({*range(256)} - {*shown})
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def _gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices flat[at : at + size] behind each other."""
    begin = np.cumsum(size) - size
    return flat[np.repeat(at - begin, size) + np.arange(int(size.sum()))]


class Aligner:
    """Two tokenizers, and the aligned tokens of the segments met so far.

    A text is cut where neither lets a token reach over: before a blank or
    line break behind anything but white space, since the first splits there
    before it merges, and no piece of the second has a blank behind other
    characters, or a line break beside any. What a segment gives does not
    depend on its neighbours, so each distinct one is encoded once.
    """

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        table, vocabulary = _byte_of(), self.a.get_vocab(with_added_tokens=True)
        self.n_a, self.n_b = max(vocabulary.values()) + 1, self.b.vocab_size()
        self.a_bytes = [b""] * self.n_a
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        plain = [p for k, p in enumerate(pieces) if not self.b.is_byte(k)]
        stops = "".join(s for s, fine in ((" ", all("▁" not in p.lstrip("▁") for p in plain)), ("\n", all(p == "\n" or "\n" not in p for p in plain))) if fine)
        self.cut = re.compile(rf"(?s).[^{stops}]*(?:(?<=\s)[{stops}][^{stops}]*)*" if stops else r"(?s).+")
        self.forget()

    def forget(self) -> None:
        self.known, self.bytes = _Numbered(), 0
        self.groups: list[str] = []
        self.tokens, self.good = np.zeros((0, 3), np.int64), np.zeros(0, bool)
        self.at, self.size, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def codes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Stripe of a pair of ids, and its place in the stripe's block."""
        return ((a % STRIPES) << (_CODE_BITS + _DOC_BITS)) | (a // STRIPES * self.n_b + b)

    def learn(self, segments: list[str]) -> None:
        """Encodes new segments together; cuts of all are places in their joined bytes."""
        if not segments:
            return
        a = [x.ids for x in self.a.encode_batch(segments, add_special_tokens=False)]
        # the second puts a blank before each text; none merges with a line break
        b = self.b.encode([s[1:] if s[0] == " " else s for s in segments], num_threads=1)
        b = [[self.b.piece_to_id("▁")] if s == " " else x if s[0] == " " else x[1:] for s, x in zip(segments, b, strict=True)]
        data = [s.encode() for s in segments]
        good = np.array([b"".join(map(self.a_bytes.__getitem__, x)) == d == b"".join(map(self.b_bytes.__getitem__, y)) for d, x, y in zip(data, a, b, strict=True)])
        a, b = ([x if g else [] for x, g in zip(t, good, strict=True)] for t in (a, b))
        self.bytes += sum(map(len, data))
        n_a, n_b = (np.array([len(x) for x in t], np.int64) for t in (a, b))
        ids_a, ids_b = (np.array([k for x in t for k in x], np.int64) for t in (a, b))
        end_a, end_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        cuts = np.union1d(end_a, end_b)
        # between two cuts lies a part of one token of each: a link
        of_a, of_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        links = self.codes(ids_a[of_a], ids_b[of_b])
        whole = np.cumsum(np.array([len(d) if g else 0 for d, g in zip(data, good, strict=True)], np.int64))
        upto = np.searchsorted(cuts, whole, side="right")
        size = np.diff(upto, prepend=0)
        both = np.cumsum(np.isin(end_a, end_b, assume_unique=True))
        ends = np.concatenate(([0], both))[np.cumsum(n_a)]
        n_groups = np.diff(ends, prepend=0)
        self.groups += self._spelt(ids_a, ids_b, end_a, end_b, n_a)
        self.tokens = np.concatenate((self.tokens, np.stack((n_a, n_b, n_groups), 1)))
        self.good = np.concatenate((self.good, good))
        self.at = np.concatenate((self.at, len(self.links) + upto - size))
        self.size, self.links = np.concatenate((self.size, size)), np.concatenate((self.links, links))

    @staticmethod
    def _spelt(ids_a: np.ndarray, ids_b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, n_a: np.ndarray) -> list[str]:
        """Each segment's groups as text."""
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        upto_a, upto_b = (np.searchsorted(e, shared, side="right").tolist() for e in (end_a, end_b))
        text_a, text_b = (list(map(str, x.tolist())) for x in (ids_a, ids_b))
        groups, i, j = [], 0, 0
        for p, q in zip(upto_a, upto_b, strict=True):
            groups.append(f"{text_a[i]}|{text_b[j]}" if p == i + 1 and q == j + 1 else f"{','.join(text_a[i:p])}|{','.join(text_b[j:q])}")
            i, j = p, q
        last = np.searchsorted(np.array(upto_a, np.int64), np.cumsum(n_a), side="right").tolist()
        return [";".join(groups[i:j]) for i, j in zip([0, *last[:-1]], last, strict=True)]

    def align(self, texts: list[str | None]) -> tuple[dict[str, list], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and hashes of each text; and its pairs of ids, each once: key (stripe, text, place) ascending, and how many links it has."""
        if len(self.known) > REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.forget()
        before, number = len(self.known), self.known.__getitem__
        cut = [np.array(list(map(number, self.cut.findall(" " + t))), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        new = list(islice(self.known, before, None))
        for k in range(0, len(new), LEARNT):
            self.learn(new[k : k + LEARNT])
        doc, seg = np.repeat(np.arange(len(texts)), [len(x) for x in cut]), np.concatenate([*cut, np.zeros(0, np.int64)])
        fine = np.array([len(x) > 0 and bool(self.good[x].all()) for x in cut], bool)
        doc, seg = doc[fine[doc]], seg[fine[doc]]
        n_a, n_b, n_groups = (np.bincount(doc, self.tokens[seg, k], len(texts)).astype(np.int64) for k in range(3))
        spelt = [hashlib.sha256(";".join([self.groups[s] for s in x.tolist()]).encode()).hexdigest() if f else "" for x, f in zip(cut, fine, strict=True)]
        rows = {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_a + n_b - n_groups, "groups_sha256": spelt}
        each, times = np.unique(doc * len(self.known) + seg, return_counts=True)
        doc, seg = np.divmod(each, max(1, len(self.known)))
        keys = _gather(self.links, self.at[seg], self.size[seg]) + np.repeat(doc << _CODE_BITS, self.size[seg])
        times = np.repeat(times, self.size[seg])
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return rows, keys[first], np.add.reduceat(times, first) if len(first) else times, fine


@lru_cache(maxsize=1)
def _aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _schema(id_kind: pa.DataType) -> pa.Schema:
    many = pa.list_
    return pa.schema([
        ("batch", pa.int64()), ("stripe", pa.int32()),
        ("ids", many(id_kind)), *[(c, many(pa.int64())) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", many(pa.string())),
        ("docs", many(pa.int32())), ("ends", many(pa.int32())), ("codes", many(pa.int32())), ("times", many(pa.int32())),
        ("pairs", many(pa.int32())), ("counts", many(pa.int64())),
    ])


def _batch(schema: pa.Schema, n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _encode(a_path: str, b_path: str, schema: pa.Schema):
    """Three kinds of rows: a batch of texts; its links in a stripe; counts of pairs in a stripe, of many batches."""
    place, code = (1 << _CODE_BITS) - 1, _CODE_BITS + _DOC_BITS

    def striped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stripes = keys >> code
        first = np.flatnonzero(np.diff(stripes, prepend=-1))
        return stripes[first].astype(np.int32), np.append(first, len(keys))

    def counts(task: int, gathered: list) -> Iterator[pa.RecordBatch]:
        keys, n = _added(gathered)
        stripes, bounds = striped(keys)
        for i in range(0, len(stripes), 16):
            own = bounds[i : i + 17]
            some = slice(own[0], own[-1])
            yield _batch(schema, len(own) - 1, {"batch": pa.array([task] * (len(own) - 1), pa.int64()), "stripe": pa.array(stripes[i : i + 16]), "pairs": _lists(keys[some] & place, own - own[0], pa.int32()), "counts": _lists(n[some], own - own[0], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task, seq, gathered = _aligner(a_path, b_path), TaskContext.get().partitionId(), 0, []
        for b in batches:
            size, lo = pc.fill_null(pc.utf8_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64), 0
            while lo < b.num_rows:
                n = max(1, int((size[lo : lo + BATCH_DOCS].cumsum() <= BATCH_CHARS).sum()))
                part = b.slice(lo, n)
                lo += n
                rows, keys, times, _ = model.align(part.column(1).to_pylist())
                number, seq = (task << 32) + seq, seq + 1
                one = lambda v, t, n=n: _lists(v, np.array([0, n]), t)
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays([part.column(0)]))
                yield _batch(schema, 1, {"batch": pa.array([number], pa.int64()), "ids": ids, "groups_sha256": one(rows["groups_sha256"], pa.string()), **{c: one(rows[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}})
                if not len(keys):
                    continue
                stripes, bounds = striped(keys)
                runs = np.flatnonzero(np.diff(keys >> _CODE_BITS, prepend=-1))
                run_bounds = np.searchsorted(runs, bounds)
                docs = (keys[runs] >> _CODE_BITS) & ((1 << _DOC_BITS) - 1)
                base = np.repeat(bounds[:-1], np.diff(run_bounds))
                ends = np.append(runs[1:], len(keys)) - base
                yield _batch(schema, len(stripes), {
                    "batch": pa.array(np.full(len(stripes), number)), "stripe": pa.array(stripes), "docs": _lists(docs, run_bounds, pa.int32()), "ends": _lists(ends, run_bounds, pa.int32()),
                    "codes": _lists(keys & place, bounds, pa.int32()), "times": _lists(times, bounds, pa.int32()),
                })
                gathered.append(np.unique((keys >> code << code) | (keys & place), return_counts=True))
                if sum(len(k) for k, _ in gathered) > GATHERED:
                    gathered = [_added(gathered)]
                    if len(gathered[0][0]) > GATHERED // 2:
                        yield from counts(task, gathered)
                        gathered = []
        if gathered:
            yield from counts(task, gathered)
        # the worker lives on, and other stages need its memory
        model.forget()
        del gathered
        pa.default_memory_pool().release_unused()

    return run


def _added(gathered: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys with the sums of their counts."""
    keys, n = np.concatenate([k for k, _ in gathered]), np.concatenate([c for _, c in gathered])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(n, first)


def _values(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    x = batch.column(name)
    return x.values.slice(x.offsets[row].as_py(), x.offsets[row + 1].as_py() - x.offsets[row].as_py()).to_numpy(zero_copy_only=False)


def _rows(n_a: int, n_b: int) -> int:
    return -(-n_a // STRIPES) * n_b


def _fold(cells: int, schema: pa.Schema):
    """Adds the counts of a stripe, whose rows come together, into its block."""

    def emit(stripe: int, salt: int, block: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(block)
        for lo in range(0, len(at), _ROW):
            some = at[lo : lo + _ROW]
            yield _batch(schema, 1, {"stripe": pa.array([stripe], pa.int32()), "batch": pa.array([salt], pa.int64()), "pairs": _lists(some, np.array([0, len(some)]), pa.int32()), "counts": _lists(block[some], np.array([0, len(some)]), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block = None, np.zeros(cells, np.int64)
        for b in batches:
            for k, key in enumerate(zip(b.column("stripe").to_pylist(), b.column("batch").to_pylist(), strict=True)):
                if key != last:
                    if last is not None:
                        yield from emit(*last, block)
                        block[:] = 0
                    last = key
                np.add.at(block, _values(b, "pairs", k), _values(b, "counts", k))
        if last is not None:
            yield from emit(*last, block)

    return run


def _score(cells: int, n_b: int, schema: pa.Schema):
    """For each row of links: its texts with the links whose count is the highest of their first id, and the sum of counts. A stripe's counts come before its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, block, best = None, np.zeros(cells, np.int64), None
        for b in batches:
            stripes, salts, links = (b.column(c).to_pylist() for c in ("stripe", "salt", "links"))
            for k, key in enumerate(zip(stripes, salts, strict=True)):
                if key != last:
                    last, best = key, None
                    block[:] = 0
                if not links[k]:
                    np.add.at(block, _values(b, "pairs", k), _values(b, "counts", k))
                    continue
                if best is None:
                    best = block.reshape(-1, n_b).max(1)
                codes, times, ends, docs = (_values(b, c, k) for c in ("codes", "times", "ends", "docs"))
                count = block[codes]
                begin = np.concatenate(([0], ends[:-1]))
                won = np.add.reduceat(np.where(count == best[codes // n_b], times, 0).astype(np.int64), begin)
                total = np.add.reduceat(count * times, begin)
                whole = np.array([0, len(docs)])
                yield _batch(schema, 1, {"batch": b.column("batch").slice(k, 1), "docs": _lists(docs, whole, pa.int32()), "n_best": _lists(won, whole, pa.int64()), "count_sum": _lists(total, whole, pa.int64())})

    return run


def _finish(schema: pa.Schema):
    """The rows of each batch of texts, with the sums over its stripes. A batch's texts come before its sums."""

    def emit(b: pa.RecordBatch, k: int, won: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        columns = {}
        for f in schema:
            if f.name not in ("n_best", "count_sum"):
                x = b.column("ids" if f.name == schema[0].name else f.name)
                columns[f.name] = x.values.slice(x.offsets[k].as_py(), len(won))
        columns |= {"n_best": pa.array(won), "count_sum": pa.array(total)}
        return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            sums = b.column("sums").to_pylist()
            for k in range(b.num_rows):
                if not sums[k]:
                    if held:
                        yield emit(*held)
                    x = b.column("ids").offsets
                    n = x[k + 1].as_py() - x[k].as_py()
                    held = b, k, np.zeros(n, np.int64), np.zeros(n, np.int64)
                    continue
                docs = _values(b, "docs", k)
                held[2][docs] += _values(b, "n_best", k)
                held[3][docs] += _values(b, "count_sum", k)
        if held:
            yield emit(*held)

    return run


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {from_arrow_type(f.type).simpleString()}" for f in schema)


def _encoded(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str) -> tuple[DataFrame, pa.Schema]:
    schema = _schema(to_arrow_type(docs.schema[id_col].dataType))
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_encode(a_path, b_path, schema), _ddl(schema))
    return stage(out, "align-encoded"), schema


def _folded(counts: DataFrame, schema: pa.Schema, cells: int) -> DataFrame:
    """Counts of pairs, each in one row of its stripe. A block adds at most about FOLDED entries; where a stripe has more, partial blocks are added in rounds."""
    own = pa.schema([schema.field(c) for c in ("stripe", "batch", "pairs", "counts")])
    total = counts.agg(F.sum(F.size("pairs"))).first()[0] or 0
    salts = -(-total // (STRIPES * FOLDED))
    while True:
        dealt = counts.select("stripe", F.pmod(F.xxhash64("batch"), F.lit(max(1, salts))).alias("batch"), "pairs", "counts")
        counts = stage(dealt.repartition("stripe", "batch").sortWithinPartitions("stripe", "batch").mapInArrow(_fold(cells, own), _ddl(own)), "align-counts")
        if salts <= 1:
            return counts
        salts = -(-salts // 64)


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """a, b, n_docs (documents that hold the pair linked) and best (no pair of this a has more), for all pairs of ids."""
    model = _aligner(a_path, b_path)
    encoded, schema = _encoded(docs, id_col, text_col, a_path, b_path)
    counts = _folded(encoded.where("pairs is not null").select("stripe", "batch", "pairs", "counts"), schema, _rows(model.n_a, model.n_b))
    pairs = counts.select("stripe", F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    pairs = pairs.select((F.floor(F.col("x.pairs") / model.n_b).cast("int") * STRIPES + F.col("stripe")).alias("a"), (F.col("x.pairs") % model.n_b).alias("b"), F.col("x.counts").alias("n_docs"))
    top = pairs.groupBy("a").agg(F.max("n_docs").alias("top"))
    return pairs.join(top, "a").select("a", "b", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum, one row per input row.

    Both tokenizers encode a blank and the text. Tokens are linked where their bytes overlap; places
    where tokens of both end cut them into groups. A pair of ids counts the
    rows that hold it linked. ``n_best`` are the links whose pair has the
    highest count of its first id, ties included; ``count_sum`` adds the
    counts of all links.

    Batches of texts give, for each stripe of first ids, their links; tasks
    add up pairs of their batches before any is shuffled, so that the most
    frequent pair is one entry of a task. A stripe's counts are added into
    one dense block, and its links are dealt to the block, over several
    tasks where there are many, and scored there. Sums return to the batches.

    Null and empty texts, and those that either tokenizer does not give back
    byte by byte (as with U+2581), have no tokens: zeros and an empty hash. Strings of special
    tokens are plain text. Repeated rows count as often and return repeated
    rows; ids may be null or repeat. A very long text is a batch by itself;
    a very long run without white space is encoded whole and forgotten soon. Other columns of
    ``docs`` are not read, whatever their names. An empty table gives no rows.
    """
    model = _aligner(a_path, b_path)
    cells, n_b = _rows(model.n_a, model.n_b), model.n_b
    encoded, schema = _encoded(docs, id_col, text_col, a_path, b_path)
    counts = _folded(encoded.where("pairs is not null").select("stripe", "batch", "pairs", "counts"), schema, cells)

    links = encoded.where("codes is not null").select("stripe", "batch", "docs", "ends", "codes", "times")
    sizes = links.groupBy("stripe").agg(F.ceil(F.sum(F.size("codes")) / SCORED).cast("long").alias("salts"))  # a row for each stripe
    links = links.join(F.broadcast(sizes), "stripe").withColumn("salt", F.pmod(F.xxhash64("batch"), F.col("salts"))).drop("salts").withColumn("links", F.lit(True))
    every = counts.join(F.broadcast(sizes), "stripe").select("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), "pairs", "counts", F.lit(False).alias("links"))
    sums = pa.schema([schema.field("batch"), schema.field("docs"), ("n_best", pa.list_(pa.int64())), ("count_sum", pa.list_(pa.int64()))])
    both = links.unionByName(every, allowMissingColumns=True).repartition("stripe", "salt").sortWithinPartitions("stripe", "salt", "links")
    scored = both.mapInArrow(_score(cells, n_b, sums), _ddl(sums))

    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    texts = encoded.where("ids is not null").select("batch", "ids", *names, F.lit(False).alias("sums"))
    back = texts.unionByName(scored.withColumn("sums", F.lit(True)), allowMissingColumns=True).repartition("batch").sortWithinPartitions("batch", "sums")
    out = pa.schema([(id_col, schema.field("ids").type.value_type), *[(c, schema.field(c).type.value_type) for c in names], ("n_best", pa.int64()), ("count_sum", pa.int64())])
    return back.mapInArrow(_finish(out), _ddl(out))
