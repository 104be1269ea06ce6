"""Each stage of the pipeline on its own input, against brute force, and on odd rows."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from attestra.llm import decontaminate, language_id, line_dedup, toxicity
from pyspark.sql import functions as F

from test_ops import brute_near, pairs, prose

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_lines(docs):
    """Texts without later copies of two lines in a row, or of one long line; None for a document of which nothing is left by that."""
    seen, out = set(), {}
    lone = lambda x: len(x) >= line_dedup.LONE_CHARS or len(x.split()) >= line_dedup.LONE_WORDS
    for d, t in sorted(docs, key=lambda x: x[0]):
        ls = (t or "").split("\n")
        gone = set()
        for p in range(len(ls)):
            for n in (1, 2):
                w = tuple(ls[p : p + n])
                if len(w) == n and (n == 2 or lone(w[0])):
                    if w in seen:
                        gone |= set(range(p, p + n))
                    seen.add(w)
        out[d] = t if not gone else None if len(gone) == len(ls) else "\n".join(x for k, x in enumerate(ls) if k not in gone)
    return out


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, outs = docs.columns, []
    for name, f in corpus_pipeline.STAGES:
        new = f(spark, docs, SF).cache()
        assert name == "sentencepiece" or new.columns == columns
        outs.append((docs, new))
        docs = new
    (a, b), (c, d), (e, g), (h, i), (j, k) = outs
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(~language_id.held_out("doc_id", 4, 2))
    scores = {r.doc_id: r.score for r in toxicity.score_toxicity(a, labels).collect()}
    assert {r.doc_id for r in b.collect()} == {x for x, s in scores.items() if s < toxicity.THRESHOLD} and b.count() < a.count() and b.exceptAll(a).count() == 0
    want = brute_lines(pairs(c))
    assert dict(pairs(d)) == {x: t for x, t in want.items() if t is not None or x in {y for y, z in pairs(c) if z is None}}
    assert d.where("n_chars <> length(text)").count() == 0
    assert {r.doc_id for r in g.collect()} == {x for x, v in brute_near(pairs(e)).items() if v[2]}
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r.doc_id for r in i.collect()} == {x for x, v in decontaminate.brute_force(pairs(h), bench).items() if not v[-1]}
    assert k.count() == j.count() and k.where("round_trip").count() == k.count()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_odd_rows(spark, stage):
    """Null and empty texts, null and repeated ids, repeated rows, a very long text, columns of other names; and an empty table."""
    f = dict(corpus_pipeline.STAGES)[stage]
    own = [(k, prose(40, 900 + k), "en", "s", 1) for k in range(4)]
    odd = [(10, None, None, None, None), (11, "", "en", "s", 0), (None, prose(30, 950), "en", "s", 1), (12, prose(30, 951), "en", "s", 1), (12, prose(30, 952), "en", "s", 1), (13, prose(30, 953), "en", "s", 1), (13, prose(30, 953), "en", "s", 1), (14, prose(30_000, 954), "en", "s", 1)]
    docs = spark.createDataFrame(own + odd, COLUMNS).withColumns({c: F.lit(7) for c in ("key", "a", "b", "id", "score", "matches", "n_words")})
    out = f(spark, docs, SF)
    got = sorted((str(r.doc_id) for r in out.collect()))
    everyone = sorted(str(r[0]) for r in own + odd)
    # the repeated row is a near copy of itself
    once = sorted(set(everyone) | {"12"}) + ["12"]
    assert got == (sorted(once) if stage == "near_dedup" else everyone)
    assert stage == "sentencepiece" or out.columns == docs.columns
    assert f(spark, docs.limit(0), SF).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "input_ids", "n_tokens", "round_trip"]


def test_worker_gives_memory_back():
    """After a task of the last stage a worker, which lives on beside the next run's, keeps little more than the model."""
    code = """
import random, re
import pandas as pd, pyarrow as pa
from attestra.llm import sentencepiece_np

def mb():
    return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem): +([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024

class Docs:
    dtypes, turn = [("doc_id", "bigint")], lambda self, b: b
    select = lambda self, *c: self
    mapInArrow = lambda self, run, schema: run
    def mapInPandas(self, run, schema):
        self.turn = pa.RecordBatch.to_pandas
        return run

docs, r, done = Docs(), random.Random(1), 0
run = sentencepiece_np.encode_documents(docs)
sentencepiece_np.load()
before = mb()
def batches():
    for k in range(8):
        texts = [" ".join(r.choice("abcdefgh") + hex(r.getrandbits(40)) for _ in range(50)) for _ in range(1000)]
        yield docs.turn(pa.RecordBatch.from_pydict({"doc_id": range(k * 1000, k * 1000 + 1000), "text": texts}))
for out in run(batches()):
    done += len(out)
del out
print(done, mb() - before)
"""
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(corpus_pipeline.__file__).parent, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == 8000 and float(out[1]) < 60
