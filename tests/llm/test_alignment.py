"""Token alignment against whole texts encoded by the libraries and plain loops."""

import hashlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from attestra.llm import token_alignment as T

ODD = [
    None, "", " ", "  ", "\n", "\n\n x", "a\n\nb", "a \n b", "a\t b", "a\t  b\t", "x   y  ", "trailing  ", "▁", "a▁b and more", "<|endoftext|> <s> </s> <unk>", "it's we're  they'll",
    "a\x1c b\x1c\x1d c", "!\x1c ! \x1c!", "  x  y  z", "  x ", "\x00\x01 \x7f", "café naïve é́", "中文没有空格的文本", "\U0001f600 \U0001f468‍\U0001f469", "﻿x �",
    "<0x0A> <0x41>", "x" * 3000, " " * 3000, "ab " * 500, "\r\n\r\n a", "a\x85 b", "　 a 　",
]


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(T.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=T.PIECE_BPE)
    table = T._byte_of()
    known = {v: bytes(table[c] for c in k) for k, v in a.get_vocab().items() if all(c in table for c in k)}

    def of_b(k):
        p = b.id_to_piece(k)
        return bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()

    return lambda t: [(k, known[k]) for k in a.encode(" " + t, add_special_tokens=False).ids], lambda t: [(k, of_b(k)) for k in b.encode(t)]


def brute(tools, texts):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups."""
    found = []
    for t in texts:
        a, b = (f(t) if t else [] for f in tools)
        if not t or any(b"".join(x for _, x in s) != (" " + t).encode() for s in (a, b)):
            found.append(([], [], [], ""))
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for k, x in side:
                own.append((k, at, at + len(x)))
                at += len(x)
            spans.append(own)
        links, j = [], 0
        for k, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            i = j
            while i < len(spans[1]) and spans[1][i][1] < e:
                links.append((k, spans[1][i][0]))
                i += 1
        groups, i, j, ends = [], 0, 0, sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        for e in ends:
            p, q = i, j
            while i < len(spans[0]) and spans[0][i][2] <= e:
                i += 1
            while j < len(spans[1]) and spans[1][j][2] <= e:
                j += 1
            groups.append(",".join(str(x[0]) for x in spans[0][p:i]) + "|" + ",".join(str(x[0]) for x in spans[1][q:j]))
        found.append((spans[0], spans[1], links, ";".join(groups)))
    count = Counter(p for _, _, links, _ in found for p in set(links))
    top: dict = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    return [
        (len(a), len(b), len(g.split(";")) if g else 0, len(li), hashlib.sha256(g.encode()).hexdigest() if g else "", sum(count[p] == top[p[0]] for p in li), sum(count[p] for p in li))
        for a, b, li, g in found
    ], count, top


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")


def check(spark, tools, texts, **kind):
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in enumerate(texts)], "doc_id long, text string, groups_sha256 string, batch int").repartition(3)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in T.align_tokens(docs).collect()}
    want, _, _ = brute(tools, texts)
    assert got == dict(enumerate(want))


def test_odd_texts(spark, tools):
    check(spark, tools, ODD + ODD[5:9])


def test_documents_and_pairs(spark, tools, monkeypatch):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    check(spark, tools, texts)
    # blocks added in rounds, links of a stripe over several tasks
    monkeypatch.setattr(T, "FOLDED", 20)
    monkeypatch.setattr(T, "SCORED", 50)
    check(spark, tools, texts[:60] + ODD)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:60])], "doc_id long, text string")
    _, count, top = brute(tools, texts[:60])
    got = {(r["a"], r["b"]): (r["n_docs"], r["best"]) for r in T.pair_counts(docs).collect()}
    assert got == {p: (n, n == top[p[0]]) for p, n in count.items()}


def test_rows(spark, tools):
    docs = spark.createDataFrame([("x", "a b"), ("x", "a b"), (None, "a b"), (None, None)], "doc_id string, text string")
    want, _, _ = brute(tools, ["a b"] * 3 + [None])
    rows = T.align_tokens(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in rows) == sorted((k, *[dict(zip(COLUMNS, w, strict=True))[c] for c in rows[0].__fields__[1:]]) for k, w in zip(["x", "x", "None", "None"], want, strict=True))
    assert T.align_tokens(docs.limit(0)).count() == 0


def test_small_memory(tools, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 5)
    model = T.Aligner(T.BYTE_BPE, T.PIECE_BPE)
    for t in ODD:
        rows, keys, times, _ = model.align([t])
        want = brute(tools, [t])[0][0]
        assert (rows["n_a"][0], rows["n_b"][0], rows["n_groups"][0], rows["n_links"][0], rows["groups_sha256"][0]) == want[:5], repr(t)
        assert times.sum() == want[3]
