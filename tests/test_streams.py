"""State that outlives runs, late files, batches that come twice, timers."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from attestra.operators import evidence as ev
from attestra.plans.stream_queries import CURRENT
from attestra.plans.testdata import candidates, evidence
from attestra.sources.stages import own_folder
from attestra.streaming import features as kept
from attestra.streaming import state

COMMANDS = "key string, at long, seq long, action string, value string"
OUT = "key string, reviewer_status string, reviewer_tags array<string>, at long, idle boolean, batch int"


@pytest.fixture()
def feed(spark):
    """Writes rows as a new file of a folder and gives a stream of it."""
    base = own_folder(spark, "test-stream")

    def put(rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        return spark.readStream.schema(schema).parquet(f"{base}/in")

    return base, put


def test_reviews_go_on_from_the_checkpoint(spark, feed):
    base, put = feed
    now = lambda: {r["key"]: (r["reviewer_status"], r["reviewer_tags"]) for r in state.newest_states(spark, base, OUT).collect()}
    state.review_states(put([("a", 1, 1, "tag", "x"), ("a", 2, 2, "tag", "y"), ("b", 1, 3, "status", "open"), (None, 1, 4, "tag", "x"), ("a", 1, 5, "drop", "x")], COMMANDS), base)
    assert now() == {"a": ("unreviewed", ["x", "y"]), "b": ("open", [])}
    # older commands that come later, the same again, a pull and a pull of nothing
    state.review_states(put([("a", 3, 6, "untag", "x"), ("a", 1, 1, "tag", "x"), ("b", 0, 9, "status", "older"), ("a", 4, 7, "untag", "z"), ("a", 5, 8, "status", None), ("c", 1, 1, "tag", None)], COMMANDS), base)
    assert now() == {"a": (None, ["y"]), "b": ("open", []), "c": ("unreviewed", [])}
    # only what the last file names is put out, and from what was there before
    state.review_states(put([("a", 6, 10, "tag", "x")], COMMANDS), base)
    last = spark.read.schema(OUT).parquet(f"{base}/out").where("batch = 2").collect()
    assert [(r["key"], r["reviewer_tags"]) for r in last] == [("a", ["x", "y"])]


def _replayed(rows):
    """States by a plain loop over all commands in their order."""
    out = {}
    for key, _, _, action, value in sorted((r for r in rows if None not in r[:4]), key=lambda r: r[1:3]):
        case = out.setdefault(key, ["unreviewed", set()])
        if action == "status":
            case[0] = value
        elif action in ("tag", "untag") and value:
            (case[1].add if action == "tag" else case[1].discard)(value)
    return {k: (s, sorted(t)) for k, (s, t) in out.items()}


def test_many_commands_are_a_row_a_key_for_the_store(spark, feed):
    base, put = feed
    rand = random.Random(8)
    rows = [
        (rand.choice(["hot", "hot", "hot", "b", "c", "é\"", None]), rand.randrange(50), k, rand.choice(["status", "tag", "tag", "untag", "other"]), rand.choice(["x", "y", 'z"\\', "ü", "", None]))
        for k in range(3000)
    ]
    rand.shuffle(rows)
    for some in (rows[:1400], rows[1200:]):
        state.review_states(put(some, COMMANDS), base)
    assert {r["key"]: (r["reviewer_status"], r["reviewer_tags"]) for r in state.newest_states(spark, base, OUT).collect()} == _replayed(rows)
    given = spark.read.schema("key string, case string, batch int").parquet(f"{base}/newest").groupBy("batch", "key").count().collect()
    assert {r["batch"] for r in given} == {0, 1} and {r["count"] for r in given} == {1}


def test_a_case_is_read_and_written_once(spark):
    cases = [r["case"] for rows in ([(1, 1, "tag", "x"), (2, 2, "status", "open")], [(3, 3, "untag", "x"), (1, 4, "status", "older"), (1, 5, "tag", "y")]) for r in state.newest_commands(spark.createDataFrame([("a", *r) for r in rows], COMMANDS)).collect()]

    class Store:
        calls, kept = 0, None

        def get(self):
            self.calls += 1
            return self.kept

        def update(self, value):
            self.calls, self.kept = self.calls + 1, value

    # the rows of two runs of a first stream, in either order and twice
    for some in (cases, cases[::-1], cases * 2):
        review = state.ReviewState()
        review.case = Store()
        (out,) = review.handleInputRows(("a",), iter([Row(case=c) for c in some]), None)
        assert (out.reviewer_status, out.reviewer_tags, out.at, review.case.calls) == ("open", ["y"], 3, 2)


def test_idle_reviews(spark, feed):
    import time

    base, put = feed
    state.review_states(put([("a", 1, 1, "tag", "x")], COMMANDS), base, idle=1)
    time.sleep(0.1)
    state.review_states(put([("b", 1, 1, "tag", "x")], COMMANDS), base, idle=600_000)
    rows = spark.read.schema(OUT).parquet(f"{base}/out").where("batch > 0").collect()
    assert {(r["key"], r["idle"]) for r in rows} >= {("a", True), ("b", False)}


def test_late_files_are_counted(spark, feed):
    base, put = feed
    rows = "id int, ts timestamp, seen timestamp"
    make = lambda *x: spark.sql("select * from values " + ", ".join(f"({k}, timestamp'{t}', timestamp'{s}')" for k, t, s in x) + " as t(id, ts, seen)").collect()
    state.lags(put(make((1, "2024-01-01 00:00:00", "2024-01-01 00:00:10"), (2, "2024-03-01 00:00:00", "2024-03-01 00:00:20")), rows), "ts", "seen", 86400, base)
    state.lags(put(make((3, "2024-01-02 00:00:00", "2024-03-05 00:00:00"), (4, "2024-03-04 00:00:00", "2024-03-04 00:00:30")), rows), "ts", "seen", 86400, base)
    r = state.lag_metrics(spark, base).first()
    assert (r["rows"], r["over_30_days"], r["late_rows"], r["longest_seconds"]) == (4, 1, 1, 63 * 86400)
    assert [x["id"] for x in spark.read.schema(rows).parquet(f"{base}/late").collect()] == [3]


def test_merges_may_run_again(spark, feed):
    base, put = feed
    schema = spark.createDataFrame([], "id int, seq int, v string").schema
    kept = lambda: sorted(map(tuple, state.reload(spark, base, schema).collect()))
    run = lambda rows: state.merge(put(rows, schema), base, "id", ["seq"], F.col("v") == "gone")
    assert kept() == []
    run([(1, 1, "a"), (2, 1, "b"), (2, 3, "c")])
    run([(1, 2, "gone"), (3, 1, None)])
    assert kept() == [(2, 3, "c"), (3, 1, None)]
    run([(1, 1, "a"), (2, 2, "old"), (3, 1, None), (2, 3, "c")])
    assert kept() == [(2, 3, "c"), (3, 1, None)]
    # the same batch by hand once more, as after a lost commit; a version without its mark is not read
    spark.createDataFrame([(9, 9, "half", False)], "id int, seq int, v string, _gone boolean").write.parquet(f"{base}/current/v=7")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/current/v=7/_SUCCESS")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    assert kept() == [(2, 3, "c"), (3, 1, None)]


def test_features_after_each_batch_equal_those_computed_anew(spark, feed):
    base, _ = feed
    sf = "/root/testdata/sf0.001"
    cand, all_rows = candidates(spark, sf).cache(), evidence(spark, sf)
    schema = all_rows.schema
    drops = [all_rows.where("phase = 'T0'"), all_rows.where("phase = 'T1' and source_record_id % 3 = 1"), all_rows.where("phase = 'T1' and source_record_id % 3 <> 1")]
    cols = [c for c in CURRENT if c not in ("as_of_date",)]
    for k, rows in enumerate(drops):
        rows.coalesce(2).write.mode("append").parquet(f"{base}/in")
        kept.keep_cells(spark.readStream.schema(schema).parquet(f"{base}/in"), base)
        seen = spark.read.schema(schema).parquet(f"{base}/in")
        want = ev.phase_features(cand, seen, "T1" if k else "T0", seen.where("phase = 'T1'")).select(ev.KEY, "as_of_date", *cols).collect()
        got = kept.features(cand, kept.newest_cells(spark, base, all_rows)).select(ev.KEY, "as_of_date", *cols).collect()
        norm = lambda rs: sorted([tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in rs])
        for a, b in zip(norm(want), norm(got), strict=True):
            assert a == b, [(c, x, y) for c, x, y in zip([ev.KEY, "as_of_date", *cols], a, b, strict=True) if x != y]
    # a batch changes only the cells that it names
    last = spark.read.parquet(f"{base}/out/batch=2")
    touched = drops[2].select(ev.KEY).distinct()
    assert last.count() and last.join(touched, ev.KEY, "left_anti").count() == 0
