"""SentencePiece encoding and decoding in batched numpy."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from attestra.llm.common import tidy

MODEL = os.environ.get("ATTESTRA_SENTENCEPIECE", "/opt/tokenizers/piece_bpe_32k.model")
#: What a model writes for a blank.
SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Longer words than this are encoded one at a time.
LONG = 48
#: Words that a worker remembers between batches, some 250 bytes each. No result depends on it.
REMEMBERED = 200_000
#: Characters that are encoded at a time, about.
SLICE = 1_000_000


class _Numbered(dict):
    """Numbers new keys as they come."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes of the rows of a matrix of code points: column j covers the first j of them."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + codes[:, j] + np.uint64(1)
    return out


def _power(n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE, np.uint64))))


class Pieces:
    """A vocabulary: pieces with scores, and how they combine.

    Words are segmented by Viterbi: the best sum of scores that ends at each
    place, with a backpointer. For a unigram model any pieces may follow each
    other. ``bpe``: in the model's own segmentation pairs of neighbours merge,
    best score first and leftmost on ties. A segmentation is that one exactly
    if no two neighbours in it would have merged otherwise, so the Viterbi path
    may only go from a piece to one that it can stand beside.
    """

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: np.ndarray, unknown: int, bpe: bool, ordinary: list[bool]):
        self.pieces, self.bpe, self.bytes, self.unknown = pieces, bpe, byte_ids, unknown
        usable = [k for k, p in enumerate(pieces) if ordinary[k] and p]
        self.longest = max(len(pieces[k]) for k in usable)
        keys = np.zeros(len(usable), np.uint64)
        for n in {len(pieces[k]) for k in usable}:
            at = [j for j, k in enumerate(usable) if len(pieces[k]) == n]
            keys[at] = _hashes(np.array([[ord(c) for c in pieces[usable[j]]] for j in at], np.uint64))[:, -1]
        order = np.argsort(keys)
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.ids = np.array(usable, np.int64)[order]
        self.scores = np.array(scores, np.float64)
        # a bit for each short hash: most substrings are no piece and stop here
        self.filter = np.zeros(1 << 21, bool)
        self.filter[self._short(self.keys)] = True
        self.reachable = np.ones(len(pieces), bool)
        self.paired = bpe and self._split_pieces(usable)
        self._forget()
        # a character in no longer piece ends a word, and is one by itself
        inner = {c for k in usable if len(pieces[k]) > 1 for c in pieces[k]}
        stops = "".join(re.escape(c) for c in "\n\t" if c not in inner)
        self.split = re.compile(f"[{stops}]|{SPACE}*[^{SPACE}{stops}]+|{SPACE}+" if stops else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        out = [p.replace(SPACE, " ").encode() for p in pieces]
        for b, k in enumerate(byte_ids):
            out[k] = bytes([b])
        for k, usual in enumerate(ordinary):
            if not usual and k not in set(byte_ids.tolist()):
                out[k] = b" \xe2\x81\x87 " if k == unknown else b""
        self.out = np.frombuffer(b"".join(out), np.uint8)
        self.out_size = np.array([len(x) for x in out], np.int64)
        self.out_at = np.concatenate(([0], np.cumsum(self.out_size)[:-1]))

    @staticmethod
    def _short(h: np.ndarray) -> np.ndarray:
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(43)).astype(np.int64)

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of hashes, -1 where there is none."""
        out = np.full(h.shape, -1, np.int64)
        maybe = np.flatnonzero(self.filter[self._short(h)])
        g = h[maybe]
        k = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        out[maybe] = np.where(self.keys[k] == g, self.ids[k], -1)
        return out

    def _table(self, codes: np.ndarray) -> np.ndarray:
        """table[row, start, length - 1]: the piece that is this substring, or -1."""
        n, m = codes.shape
        pre, power, top = _hashes(codes), _power(m), min(m, self.longest)
        table = np.full((n, m, top), -1, np.int64)
        for size in range(1, top + 1):
            h = pre[:, size:] - pre[:, : m - size + 1] * power[size]
            table[:, : m - size + 1, size - 1] = self.probe(h.ravel()).reshape(h.shape)
        return table

    def _merge(self, codes: np.ndarray, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Merges pairs in words of one length, a pair of each word at a time: the end of the symbol that starts at each place (0 where none does), and where the last pair met."""
        n, m = codes.shape
        table, top = self._table(codes) if table is None else table, min(codes.shape[1], self.longest)
        score = np.where(table >= 0, self.scores[table], -np.inf)
        end, met = np.tile(np.arange(1, m + 1), (n, 1)), np.zeros(n, np.int64)
        live, start = np.arange(n), np.arange(m)
        while len(live) and m > 1:
            e = end[live]
            after = np.where((e > 0) & (e < m), np.take_along_axis(e, np.minimum(e, m - 1), 1), 0)
            size = after - start
            fits = (after > 0) & (size <= top)
            s = np.where(fits, score[live[:, None], start[None, :], np.clip(size - 1, 0, top - 1)], -np.inf)
            best = s.argmax(1)
            go = s[np.arange(len(live)), best] > -np.inf
            live, best, after, e = live[go], best[go], after[go], e[go]
            mid = e[np.arange(len(live)), best]
            end[live, best] = after[np.arange(len(live)), best]
            end[live, mid] = 0
            met[live] = mid
        return end, met

    def _split_pieces(self, usable: list[int]) -> bool:
        """Finds for each piece the two that it was merged from, and its turn among merges.

        Pieces of one score have no turn (``tied``: runs of blanks, in the
        public model); words with one are merged pair by pair. False if pairs
        alone can't tell the segmentation of the rest: where a character of a
        piece is no piece, or a piece comes before one that it is made of.
        """
        n = len(self.pieces)
        self.length = np.array([len(p) for p in self.pieces], np.int64)
        self.power = _power(self.longest + 1)
        self.hash = np.zeros(n, np.uint64)
        self.hash[self.ids] = self.keys
        long_ones = np.array([k for k in usable if self.length[k] > 1], np.int64)
        self.turn = np.full(n, -1, np.int64)
        self.turn[long_ones[np.argsort(-self.scores[long_ones], kind="stable")]] = np.arange(len(long_ones))
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.tied = np.zeros(n + 1, bool)
        own, times = np.unique(self.scores[long_ones], return_counts=True)
        self.tied[long_ones] = np.isin(self.scores[long_ones], own[times > 1])
        for size in {int(x) for x in self.length[long_ones]}:
            own = long_ones[self.length[long_ones] == size]
            for some in np.array_split(own, max(1, len(own) * size * size // 400_000)):
                codes = np.array([[ord(c) for c in self.pieces[k]] for k in some], np.uint64).reshape(len(some), size)
                end, mid = self._merge(codes)
                whole = end[:, 0] == size
                self.reachable[some[~whole]] = False
                pre, rows = _hashes(codes[whole]), np.arange(int(whole.sum()))
                at = mid[whole]
                self.left[some[whole]] = self.probe(pre[rows, at])
                self.right[some[whole]] = self.probe(pre[:, -1] - pre[rows, at] * self.power[size - at])
        made = long_ones[self.reachable[long_ones] & ~self.tied[long_ones]]
        sides = np.stack((self.left[made], self.right[made]))
        self.seen, self.verdict = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)
        return bool((sides >= 0).all() and (self.turn[sides] < self.turn[made]).all())

    def _beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces ``a`` and ``b`` stay apart as neighbours: no merge across them comes before theirs.

        Both are taken apart, the later made one first, down to the characters
        that touch. While a pair of parts touched, it would have merged if
        there is a piece for it whose turn came before the next part's.
        """
        apart, at = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), len(self.pieces) + 1)
        a, b = a.copy(), b.copy()
        while len(at):
            size = self.length[b]
            joint = self.probe(self.hash[a] * self.power[np.minimum(size, self.longest)] + self.hash[b])
            joint = np.where(self.length[a] + size <= self.longest, joint, -1)
            merged = (joint >= 0) & (self.turn[joint] < limit)
            apart[at[merged]] = False
            on = ~merged & ((self.turn[a] >= 0) | (self.turn[b] >= 0))
            at, a, b = at[on], a[on], b[on]
            # of equal pieces the left one was made first
            left_later = self.turn[a] > self.turn[b]
            limit = np.where(left_later, self.turn[a], self.turn[b] + 1)
            a, b = np.where(left_later, self.right[a], a), np.where(left_later, b, self.left[b])
        return apart

    def _allowed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """As ``_beside``, with the verdicts of many pairs remembered."""
        pair = a * len(self.pieces) + b
        slot = self._short(pair.view(np.uint64)) >> 1
        new = np.flatnonzero(self.seen[slot] != pair)
        out = self.verdict[slot]
        if len(new):
            which, back = np.unique(pair[new], return_inverse=True)
            found = self._beside(which // len(self.pieces), which % len(self.pieces))
            out[new] = found[back]
            place = self._short(which.view(np.uint64)) >> 1
            # of pairs that share a place one is remembered, with its own verdict
            last = np.unique(place[::-1], return_index=True)[1]
            keep = len(place) - 1 - last
            self.seen[place[keep]], self.verdict[place[keep]] = which[keep], found[keep]
        return out

    def _viterbi(self, codes: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """Ends of the pieces that start at each place, 0 where none does: words of one length advance a place together, maxima keep backpointers."""
        n, m = codes.shape
        table, top = self._table(codes) if table is None else table, min(codes.shape[1], self.longest)
        floor = self.scores.min() - 10.0
        best, back, last = np.full((n, m + 1), -np.inf), np.zeros((n, m + 1), np.int64), np.full((n, m + 1), -1, np.int64)
        best[:, 0] = 0
        rows = np.arange(n)
        for j in range(1, m + 1):
            sizes = np.arange(1, min(j, top) + 1)
            k = table[:, j - sizes, sizes - 1]
            step = np.where(k >= 0, self.scores[k], np.where(sizes[None, :] == 1, floor, -np.inf))
            if self.paired:
                before = last[:, j - sizes]
                step = np.where((k < 0) | self.reachable[k], step, -np.inf)
                r, c = np.nonzero((k >= 0) & (before >= 0) & (step > -np.inf))
                step[r, c] = np.where(self._allowed(before[r, c], k[r, c]), step[r, c], -np.inf)
            total = best[:, j - sizes] + step
            pick = total.argmax(1)
            best[:, j] = total[rows, pick]
            back[:, j] = j - sizes[pick]
            last[:, j] = k[rows, pick]
        end = np.zeros((n, m), np.int64)
        at, live = np.full(n, m), rows
        while len(live):
            prev = back[live, at[live]]
            end[live, prev] = at[live]
            at[live] = prev
            live = live[prev > 0]
        return end

    def _segmented(self, codes: np.ndarray) -> np.ndarray:
        """Ends of the pieces of words of one length."""
        if not self.bpe:
            return self._viterbi(codes)
        table = self._table(codes)
        odd = self.tied[table].any((1, 2)) if self.paired else np.ones(len(codes), bool)
        end = np.empty(codes.shape, np.int64)
        if not odd.all():
            end[~odd] = self._viterbi(codes[~odd], table[~odd])
        if odd.any():
            end[odd] = self._merge(codes[odd], table[odd])[0]
        return end

    def _long(self, word: str) -> np.ndarray:
        """One long word in memory that grows with its length: pairs from a heap, best first, leftmost on ties."""
        if not self.bpe:
            codes = np.array([[ord(c) for c in word]], np.uint64)
            return self._viterbi(codes)[0]
        import heapq

        m = len(word)
        pre = np.concatenate(([0], np.zeros(m, np.uint64))).astype(np.uint64)
        codes = np.array([ord(c) for c in word], np.uint64)
        power = [int(x) for x in _power(self.longest)]
        acc, hs = 0, [0]
        for c in codes.tolist():
            acc = (acc * int(_BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
            hs.append(acc)
        del pre
        score_of = self._score_map()
        end, prev = list(range(1, m + 1)), list(range(-1, m - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(s: int) -> None:
            if end[s] < m and (n := end[end[s]] - s) <= self.longest:
                x = score_of.get((hs[s + n] - hs[s] * power[n]) & 0xFFFFFFFFFFFFFFFF)
                if x is not None:
                    heapq.heappush(heap, (-x, s, s + n))

        for s in range(m - 1):
            offer(s)
        while heap:
            _, s, e = heapq.heappop(heap)
            if end[s] == 0 or end[s] >= m or end[end[s]] != e:
                continue
            end[end[s]] = 0
            end[s] = e
            if e < m:
                prev[e] = s
                offer(s)
            if prev[s] >= 0:
                offer(prev[s])
        return np.array(end)

    def _score_map(self) -> dict[int, float]:
        if not hasattr(self, "_by_hash"):
            self._by_hash = dict(zip(self.keys.tolist(), self.scores[self.ids].tolist(), strict=True))
        return self._by_hash

    def _spell(self, words: list[str], codes: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segmented words behind each other, and how many each has; characters without a piece become bytes."""
        row, s = np.nonzero(end)
        e = end[row, s]
        pre, power = _hashes(codes), _power(codes.shape[1])
        ids = self.probe(pre[row, e] - pre[row, s] * power[e - s])
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            spelt = [self.bytes[list(words[row[k]][s[k] : e[k]].encode())] if len(self.bytes) else np.array([self.unknown]) for k in lost]
            n = np.ones(len(ids), np.int64)
            n[lost] = [len(x) for x in spelt]
            out = np.repeat(ids, n)
            out[out < 0] = np.concatenate(spelt)
            ids, row = out, np.repeat(row, n)
        return ids.astype(np.int32), np.bincount(row, minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        """Ids of new words, added to what is remembered in the order of ``words``; words of one length advance together."""
        by: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by.setdefault(len(w), []).append(k)
        flat, at, size, used = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), len(self.flat)
        for n, places in by.items():
            step = 1 if n > LONG else max(1, 400_000 // (n * min(n, self.longest)))
            for lo in range(0, len(places), step):
                some = places[lo : lo + step]
                own = [words[k] for k in some]
                codes = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), n).astype(np.uint64)
                end = self._long(own[0])[None, :] if n > LONG else self._segmented(codes)
                ids, count = self._spell(own, codes, end)
                size[some] = count
                at[some] = used + np.cumsum(count) - count
                used += len(ids)
                flat.append(ids)
        self.flat = np.concatenate((self.flat, *flat))
        self.at, self.size = np.concatenate((self.at, at)), np.concatenate((self.size, size))

    def _forget(self) -> None:
        self.known = _Numbered()
        self.flat, self.at, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text: its words are numbered, new ones encoded together, and all looked up at once."""
        if len(self.known) > REMEMBERED:
            self._forget()
        before = len(self.known)
        number = self.known.__getitem__
        docs = []
        for t in texts:
            words = self.split.findall(SPACE + t.replace(" ", SPACE)) if t else ()
            docs.append(np.fromiter(map(number, words), np.int64, len(words)))
        if len(self.known) > before:
            self._learn(list(islice(self.known, before, None)))
        return [_gather(self.flat, self.at[d], self.size[d]) for d in docs]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words as they are."""
        self._forget()
        self._learn(words)
        out = [self.flat[a : a + n] for a, n in zip(self.at, self.size, strict=True)]
        self._forget()
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the blank before the first word goes."""
        data = _gather(self.out, self.out_at[ids], self.out_size[ids]).tobytes()
        return data.removeprefix(b" ").decode("utf-8", "replace") if len(ids) else ""


def _gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices flat[at : at + size] behind each other."""
    n = int(size.sum())
    if not n:
        return flat[:0]
    begin = np.cumsum(size) - size
    return flat[np.repeat(at - begin, size) + np.arange(n)]


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> Pieces:
    """A model file's vocabulary. The library only reads it; whether it is BPE is seen in how it scores its pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    pieces, scores = [sp.id_to_piece(k) for k in range(n)], [sp.get_score(k) for k in range(n)]
    as_byte = [k for k in range(n) if sp.is_byte(k)]
    ordinary = [not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)) for k in range(n)]
    kept = [s for s, o in zip(scores, ordinary, strict=True) if o]
    return Pieces(pieces, scores, np.array(as_byte, np.int64), sp.unk_id(), all(s == int(s) for s in kept), ordinary)


def encode_documents(docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, input_ids, n_tokens and round_trip, one row per input row, without a shuffle.

    Ids equal those of the sentencepiece library for a model with identity
    normalisation. ``round_trip`` says that decoding gives the text again,
    which holds unless the text has the blank sign U+2581 itself. Null and
    empty texts have no ids and round-trip to the empty text. Repeated rows
    return repeated rows; ids may be null. Only two input columns are read,
    whatever others are named. A very long text is a batch by itself. An empty
    table gives no rows.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        for b in batches:
            size, lo = pc.fill_null(pc.utf8_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64), 0
            while lo < b.num_rows:
                n = max(1, int((size[lo : lo + 4000].cumsum() <= SLICE).sum()))
                part = b.slice(lo, n)
                lo += n
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = model.encode(texts)
                count = np.array([len(x) for x in ids], np.int64)
                same = [model.decode(x) == t for x, t in zip(ids, texts, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(count), pa.array(same, pa.bool_())], names=[id_col, "input_ids", "n_tokens", "round_trip"])
        # the worker lives on, and other stages need its memory
        model._forget()

    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {kind}, input_ids array<int>, n_tokens long, round_trip boolean")


def digest(frame: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit integers) and round_trip."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[["doc_id", "n_tokens", "round_trip"]].copy()
            out["ids_sha256"] = [hashlib.sha256(np.asarray(x, "<i4").tobytes()).hexdigest() for x in b["input_ids"]]
            yield out

    return frame.mapInPandas(run, f"doc_id {dict(frame.dtypes)['doc_id']}, n_tokens long, round_trip boolean, ids_sha256 string")
