"""The upsert against a plain one over rows in memory."""

import hashlib
import itertools
import zlib
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from attestra.llm import upsert
from attestra.llm.queries import op12_upsert

SF = "/root/testdata/sf0.001"


def crc(x) -> int:
    return zlib.crc32(str(x).encode())


def plain(starts: list[list[dict]], changes: dict, key: str, sets: list[str], size: int, ignored, deleted) -> list[tuple[list[dict], bool]]:
    """Files of rows and whether they are new. ``changes``: the last one of each key."""
    firsts = [f[0][key] for f in starts]
    homes = [{r[key]: dict(r) for r in f} for f in starts]
    for k, c in changes.items():
        home = max([i for i, f in enumerate(firsts) if f <= k], default=0)
        if ignored(firsts[home], c):
            continue
        if deleted(firsts[home], c):
            homes[home].pop(k, None)
        else:
            row = homes[home].setdefault(k, dict.fromkeys(starts[0][0]) | {key: k})
            row.update({s: c[s] for s in sets})
    files: list[list] = []
    for old, now in zip(starts, homes, strict=True):
        rows = [now[k] for k in sorted(now)]
        if rows == old:
            files.append([rows, False])
            continue
        total, pieces = len(rows), -(-len(rows) // size)
        for i in range(pieces):
            n = total // pieces + (i < total % pieces)
            files.append([rows[:n], True])
            rows = rows[n:]
    out: list[list] = []
    for rows, new in files:
        if new and out and out[-1][1] and len(out[-1][0]) + len(rows) <= size:
            out[-1][0] = out[-1][0] + rows
        else:
            out.append([rows, new])
    return [tuple(x) for x in out]


def test_query_equals_plain_upsert(spark):
    clients, changes = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("clients", "client_changes"))
    size = 1 + len(clients) // 1000
    base = sorted((r for r in clients if crc(r["client_id"]) % 7 > 3), key=lambda r: r["client_id"])
    starts = [list(x) for x in itertools.batched(base, size)]
    last: dict = {}
    for c in changes:
        if c["client_id"] not in last or (c["seq"], c["change_id"]) > (last[c["client_id"]]["seq"], last[c["client_id"]]["change_id"]):
            last[c["client_id"]] = c
    h = lambda first: crc(first) % 16
    want = plain(starts, last, "client_id", ["source", "segment", "city", "balance"], size, lambda f, c: h(f) > 7, lambda f, c: c["op"] == "D" or crc(c["change_id"]) % 8 < h(f))
    got = sorted(op12_upsert(spark, SF).collect(), key=lambda r: r["first_id"])
    assert len(got) == len(want)
    assert any(r["rewritten"] for r in got) and not all(r["rewritten"] for r in got)
    folder = Path(got[0]["path"].removeprefix("file:")).parent
    assert {p.name for p in folder.glob("*.parquet")} == {r["path"].rpartition("/")[2] for r in got}
    for r, (rows, new) in zip(got, want, strict=True):
        file = pq.ParquetFile("/" + r["path"].removeprefix("file:").lstrip("/"))
        assert file.schema_arrow.names == list(clients[0]) == r["columns"].split(",")
        assert file.read().to_pylist() == rows
        assert (r["first_id"], r["n_rows"], r["rewritten"]) == (rows[0]["client_id"], len(rows), new)
        assert r["cents"] == sum(int((100 * x["balance"] + 0.5) // 1) for x in rows if x["balance"] is not None)
        assert r["rows_crc"] == sum(crc("|".join(x[c] or "" for c in ("source", "segment", "city"))) for x in rows)
        assert r["ids_sha256"] == hashlib.sha256(",".join(str(x["client_id"]) for x in rows).encode()).hexdigest()


def _apply(spark, base, changes, size, **more):
    rows = spark.createDataFrame(base, "k int, a string, file string")
    folder = upsert.write_sorted(rows, "k", size, upsert.new_folder(spark, "test"))
    feed = spark.createDataFrame(changes, "k int, seq int, a string, part int")
    out = upsert.upsert(spark, folder, rows.schema, feed, "k", ["seq"], ["a"], size, **more)
    files = {r["path"]: r for r in out.collect()}
    held = {}
    for r in upsert.files_of(spark, folder, rows.schema).orderBy("_path", "_row").collect():
        held.setdefault(r["_path"], []).append((r["k"], r["a"], r["file"]))
    assert set(files) == set(held)
    assert all(files[p]["n_rows"] == len(x) for p, x in held.items())
    return sorted(((x, files[p]["rewritten"]) for p, x in held.items()), key=lambda x: (x[0][0][0] is not None, x[0][0][0]))


@pytest.mark.parametrize("seed", range(3))
def test_many_shapes(spark, seed):
    import random

    rand = random.Random(seed)
    base = [(k, rand.choice("ab"), "x") for k in sorted(rand.sample(range(10, 400), 120))]
    feed = [(rand.choice([7, 55, rand.randrange(420)]), rand.randrange(50), rand.choice(["a", "b", None]), n) for n in range(60)]
    feed += [(n, 99, "new", n) for n in range(200, 260)]
    last: dict = {}
    for k, s, a, p in feed:
        last[k] = max(last.get(k, (s, "", -1)), (s, a or "", p), key=lambda x: x)
    size = 7
    starts = [[{"k": k, "a": a, "file": f} for k, a, f in x] for x in itertools.batched(base, size)]
    want = plain(starts, {k: {"k": k, "a": a or None, "seq": s} for k, (s, a, _) in last.items()}, "k", ["a"], size, lambda f, c: f % 3 == 1, lambda f, c: c["seq"] % 4 == 0)
    got = _apply(spark, base, feed, size, ignored=F.col("first") % 3 == 1, deleted=F.col("change.seq") % 4 == 0)
    assert got == [([(r["k"], r["a"], r["file"]) for r in rows], new) for rows, new in want]


def test_odd_tables(spark):
    # no change, no base, neither; a null key; equal changes; every row deleted
    assert _apply(spark, [(1, "a", "f"), (2, "b", "f"), (3, "c", "f")], [], 2) == [([(1, "a", "f"), (2, "b", "f")], False), ([(3, "c", "f")], False)]
    assert _apply(spark, [], [(5, 1, "n", 0), (4, 1, "m", 0), (5, 1, "n", 0), (6, 0, None, 0)], 2) == [([(4, "m", None), (5, "n", None)], True), ([(6, None, None)], True)]
    assert _apply(spark, [], [], 2) == []
    assert _apply(spark, [(None, "a", "f"), (1, "b", "f")], [(None, 1, "z", 0), (None, 2, "y", 0)], 1) == [([(None, "y", "f")], True), ([(1, "b", "f")], False)]
    assert _apply(spark, [(1, "a", "f"), (2, "b", "f")], [(1, 1, "z", 0), (2, 2, "y", 0)], 5, deleted=F.lit(True)) == []
    # a change that alters nothing, and one that sets null
    assert _apply(spark, [(1, None, "f"), (2, "b", "f")], [(1, 1, None, 0), (2, 2, None, 0)], 1) == [([(1, None, "f")], False), ([(2, None, "f")], True)]
    # a repeated key is one row afterwards
    assert _apply(spark, [(1, "a", "f"), (1, "b", "f"), (2, "b", "f")], [], 2) == [([(1, "b", "f")], True), ([(2, "b", "f")], False)]
