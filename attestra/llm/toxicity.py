"""Toxicity by nearest labelled examples."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestra.llm.common import row_key, stage, tidy

#: Labelled rows in the training sample, of each class.
SAMPLE_ROWS = 10_000
#: Terms of the vector space: all words of the sample that go with a class by so much, in G2 and odds.
LEAST_G2, LEAST_ODDS = 16.0, 4.0
NEIGHBOURS, BLOCK = 25, 64
THRESHOLD = 0.3
#: Weight of the base rate in a vote, in units of a neighbour at distance 0.
SMOOTH = 0.5
_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> Counter:
    """The words of a text, lower-cased, with their numbers."""
    return Counter(_WORD.findall((text or "").lower()))


class BlockMaxIndex:
    """Examples as unit TF-IDF vectors in blocks, with each term's largest weight in each block.

    ``search`` gives the exact nearest ones by cosine. A block is opened only
    if the sum of its maxima reaches the weakest of the best found so far.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, labels: np.ndarray, weights: np.ndarray, idf: np.ndarray):
        # like examples into the same blocks: by their heaviest term
        unit = [_unit(t, n, idf) for t, n in vectors]
        order = sorted(range(len(unit)), key=lambda k: (int(vectors[k][0][np.argmax(unit[k])]), -float(unit[k].max()), ids[k]))
        self.ids, self.labels, self.weights, self.idf = ids[order], labels[order], weights[order], idf
        self.n_blocks = max(1, -(-len(order) // BLOCK))
        row = np.repeat(np.arange(len(order)), [len(unit[k]) for k in order])
        term = np.concatenate([vectors[k][0] for k in order]) if order else np.zeros(0, np.int64)
        w = np.concatenate([unit[k] for k in order]).astype(np.float64) if order else np.zeros(0)
        by = np.lexsort((row, term))
        self.row, self.w = row[by], w[by]
        self.begin = np.searchsorted(term[by], np.arange(len(idf) + 1))
        self.top = np.zeros((len(idf), self.n_blocks))
        np.maximum.at(self.top, (term, row // BLOCK), w)

    def _scores(self, t: np.ndarray, q: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, sums = [], []
        for a, b, x in zip(self.begin[t], self.begin[t + 1], q, strict=True):
            r = self.row[a:b]
            m = open_[r // BLOCK]
            rows.append(r[m])
            sums.append(self.w[a:b][m] * x)
        rows, sums = np.concatenate(rows), np.concatenate(sums)
        found, back = np.unique(rows, return_inverse=True)
        return found, np.bincount(back, sums, len(found))

    def search(self, t: np.ndarray, n: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the ``k`` nearest, best first, ties by id. ``without``: an id to leave out."""
        q = _unit(t, n, self.idf)
        bound = q @ self.top[t]
        first = np.argsort(-bound, kind="stable")[: -(-(k + 1) // BLOCK) + 1]
        open_ = np.zeros(self.n_blocks, bool)
        open_[first] = True
        rows, cos = self._scores(t, q, open_)
        weakest = np.partition(cos, -(k + 1))[-(k + 1)] if len(cos) > k else 0.0
        more = bound >= weakest - 1e-9
        if (more & ~open_ & (bound > 0)).any():
            rows, cos = self._scores(t, q, more | open_)
        if without is not None:
            m = self.ids[rows] != without
            rows, cos = rows[m], cos[m]
        best = np.lexsort((self.ids[rows], -np.round(cos, 12)))[:k]
        return rows[best], cos[best]


def _unit(t: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(n)) * idf[t]
    return w / np.sqrt((w * w).sum())


class Model:
    def __init__(self, vocab: dict[str, int], idf: np.ndarray, examples: list[tuple], class_weight: tuple[float, float], k: int = NEIGHBOURS):
        """``examples``: (id, terms, counts, label). class_weight: what a row of class 0 or 1 of the sample stands for."""
        self.vocab, self.k, self.cache = vocab, k, {}
        label = np.array([e[3] for e in examples], np.int64)
        weight = np.array(class_weight)[label] if len(label) else np.zeros(0)
        total = weight.sum()
        self.base = float((weight * label).sum() / total) if total else 0.0
        full = np.array([len(e[1]) > 0 for e in examples], bool)
        blank = weight[~full]
        self.blank = float(((blank * label[~full]).sum() + self.base) / (blank.sum() + 1)) if len(label) else 0.0
        some = [e for e, f in zip(examples, full, strict=True) if f]
        self.index = BlockMaxIndex([(np.asarray(e[1], np.int64), np.asarray(e[2], np.float64)) for e in some], np.array([e[0] for e in some], object), label[full], weight[full], idf) if some else None
        self.cuts, self.rates = np.zeros(0), np.zeros(0)
        if some:
            raw = np.array([self._vote(np.asarray(e[1], np.int64), np.asarray(e[2], np.float64), e[0])[0] for e in some])
            self.cuts, self.rates = _isotonic(raw, label[full].astype(float), weight[full])

    def _vote(self, t: np.ndarray, n: np.ndarray, without: int | None = None) -> tuple[float, list[int]]:
        rows, cos = self.index.search(t, n, self.k, without)
        w = self.index.weights[rows] / self.index.weights.max() / (1 - np.minimum(cos, 1) + 0.1) * 0.1
        y = self.index.labels[rows]
        return float(((w * y).sum() + SMOOTH * self.base * 0.1) / (w.sum() + SMOOTH * 0.1)), [self.index.ids[r] for r in rows[:3]]

    def score(self, t: np.ndarray, n: np.ndarray) -> tuple[float, list[int]]:
        if not len(t) or self.index is None:
            return self.blank, []
        key = (t.tobytes(), n.tobytes())
        if key not in self.cache:
            if len(self.cache) > 100_000:
                self.cache.clear()
            raw, near = self._vote(t, n)
            rate = float(np.interp(raw, self.cuts, self.rates)) if len(self.cuts) else raw
            self.cache[key] = (min(1.0, max(0.0, 0.5 * raw + 0.5 * rate)), near)
        return self.cache[key]


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools of adjacent violators: scores and the observed rates, which rise with them."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for a, b, c in zip(x[order], y[order], w[order], strict=True):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    p = np.array(pools)
    return p[:, 0] / p[:, 2], p[:, 1] / p[:, 2]


def _telling(found: DataFrame, pos: int, neg: int) -> DataFrame:
    """Terms (term, a, b: rows of each class that have it) that go with a class: G2 of presence, and odds."""
    a, b, n = F.col("a"), F.col("b"), float(pos + neg)
    cells = [(a, pos * (a + b) / n), (b, neg * (a + b) / n), (pos - a, pos * (n - a - b) / n), (neg - b, neg * (n - a - b) / n)]
    g2 = sum((F.when(o > 0, 2 * o * F.log(o / e)).otherwise(0.0) for o, e in cells), F.lit(0.0))
    odds = (a + 0.5) * (neg - b + 0.5) / ((b + 0.5) * (pos - a + 0.5))
    return found.where((a + b >= 3) & (g2 >= LEAST_G2) & (F.greatest(odds, 1 / odds) >= LEAST_ODDS)).select("term", g2.alias("g2"))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A row per input row: key, ``id_col``, score and evidence (ids of the nearest examples).

    Learns from ``labels`` (id, toxic): about ``sample_rows`` labelled rows of
    each class by the hash of the id, a documented bound; a row of a class
    stands for what was left out. All words of the sample that go with a class
    span the space, by a test of significance that no count limits: the cosine
    of all words finds the nearest language and topic, not the nearest
    offence. Document frequencies come from all documents, in one pass that
    keeps each text's few counts and reads no text twice. Neighbours are exact
    by cosine; votes fall with distance, and are calibrated on the sample,
    each row judged without itself.

    Null and empty texts, and texts without such a word, get the rate of
    examples without one. Without labels of both classes every score is that
    rate, or 0. Labels that disagree for an id count as their mean, rounded
    up from a half; labels with a null id or value don't count. Of rows of a
    labelled id with other texts the one with the smallest key is the example;
    each row has the score of its own text, and repeated rows equal scores. A
    very long text is counted in one pass in memory. Columns but the two named
    are not read. An empty table gives no rows. ``key`` is that of
    common.row_key for id and text.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("key")).select("doc_id", "key.a", "key.b", "text")
    lab = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    lab = stage(lab, "toxic-labels")
    n = {r[0]: r[1] for r in lab.groupBy("y").count().collect()}
    every = {y: max(1, -(-n.get(y, 0) // sample_rows)) for y in (0, 1)}
    picked = lab.where(F.pmod(F.xxhash64("doc_id"), F.when(F.col("y") == 1, every[1]).otherwise(every[0])) == 0)
    # at most about two times sample_rows ids
    rows = d.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min(F.struct("a", "b", "text", "y")).alias("row"))
    sample = stage(rows.select("doc_id", "row.*"), "toxic-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pos, neg = Counter(), Counter()
            for t, y in zip(b["text"], b["y"], strict=True):
                (pos if y else neg).update(terms(t).keys())
            every_term = [*(pos.keys() | neg.keys())]
            yield pd.DataFrame({"term": every_term, "pos": [pos[t] for t in every_term], "neg": [neg[t] for t in every_term]})

    size = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    p, q = size.get(1, 0), size.get(0, 0)
    vocab: dict[str, int] = {}
    if p and q:
        found = sample.select("text", "y").mapInPandas(tidy(count), "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("a"), F.sum("neg").alias("b"))
        # bounded by the words of the sample
        vocab = {r["term"]: k for k, r in enumerate(sorted(_telling(found, p, q).collect(), key=lambda r: (-r["g2"], r["term"])))}
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = shared.value
        for b in batches:
            out = []
            for t in b["text"]:
                c: Counter = Counter()
                for w in _WORD.findall((t or "").lower()) if v else ():
                    k = v.get(w)
                    if k is not None:
                        c[k] += 1
                ks = sorted(c)
                out.append((ks, [c[k] for k in ks]))
            frame = b.drop(columns="text").reset_index(drop=True)
            frame[["terms", "counts"]] = pd.DataFrame(out, columns=["terms", "counts"]) if out else None
            yield frame

    kind = dict(d.dtypes)["doc_id"]
    part = "struct<a:bigint,b:bigint>"
    seen = stage(d.mapInPandas(tidy(vectors), f"doc_id {kind}, a long, b long, terms array<int>, counts array<int>"), "toxic-vectors")
    total = seen.count()
    df = {r[0]: r[1] for r in seen.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    idf = np.array([np.log((1 + total) / (1 + df.get(k, 0))) + 1 for k in range(len(vocab))])
    own = seen.join(F.broadcast(sample.select("doc_id", "a", "b", "y")), ["doc_id", "a", "b"]).dropDuplicates(["doc_id"])
    examples = [tuple(r) for r in own.select("doc_id", "terms", "counts", "y").collect()]
    examples.sort(key=lambda e: e[0])
    model = docs.sparkSession.sparkContext.broadcast(Model(vocab, idf, examples, (n.get(0, 0) / q if q else 1.0, n.get(1, 0) / p if p else 1.0)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for b in batches:
            out = [m.score(np.asarray(t, np.int64), np.asarray(c, np.float64)) for t, c in zip(b["terms"], b["counts"], strict=True)]
            frame = b[["doc_id", "a", "b"]].reset_index(drop=True)
            frame["score"], frame["evidence"] = [s for s, _ in out], [e for _, e in out]
            yield frame

    # what is staged is so small that its files would fill few tasks
    spread = seen.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a")
    scored = spread.mapInPandas(tidy(score), f"doc_id {kind}, a long, b long, score double, evidence array<{kind}>")
    return scored.select(F.struct("a", "b").cast(part).alias("key"), F.col("doc_id").alias(id_col), "score", "evidence")


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all their columns, whatever their names.

    Null and empty texts have the score of texts without a word. Repeated rows
    go or stay together; of rows that share an id each is judged by its text.
    An empty table gives no rows; without labels nothing goes.
    """
    gone = score_toxicity(docs, labels, id_col, text_col).where(F.col("score") >= threshold).select(F.col("key").alias("__toxic_key")).distinct()
    return docs.withColumn("__toxic_key", row_key(id_col, text_col)).join(gone, "__toxic_key", "left_anti").select(*docs.columns)
