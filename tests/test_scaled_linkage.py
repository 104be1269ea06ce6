"""Names and links where many rows share few names, against DuckDB."""

import random

import duckdb

from attestra.operators import name_search as ns
from attestra.plans.registry import ORACLES, QUERIES


def _parts(spark, folder, rows):
    """A folder whose ``part`` has only these keys and names."""
    spark.createDataFrame(rows, "p_partkey long, p_name string").coalesce(1).write.parquet(f"{folder}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{folder}/part.parquet/*.parquet')")
    return con


def test_diagnostics_without_a_linked_vehicle(spark, tmp_path):
    # two candidates of one name, each linked by its day of birth: the name is ambiguous, so no title has a link
    con = _parts(spark, str(tmp_path), [(7, "red bolt"), (21, "red bolt")])
    want = dict(con.execute(ORACLES["linkage_diagnostics"]).fetchall())
    got = {r["name"]: r["value"] for r in QUERIES["linkage_diagnostics"](spark, str(tmp_path)).collect()}
    assert want["ambiguous_verified_alias_count"] == 1 and want["strong_anchor_rows"] is None
    assert got == want


def _joined(df):
    """The most rows that a join of an executed plan put out."""
    df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if "Join" in p.nodeName() and p.metrics().contains("numOutputRows"):
            most = max(most, p.metrics().apply("numOutputRows").value())
        todo += [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if "QueryStage" in p.nodeName() else [p.children().apply(k) for k in range(p.children().size())]
    return most


def test_rows_of_one_name_meet_once(spark, tmp_path):
    rows = [(k, ("red", "old", "hot")[k % 3] + " bolt") for k in range(1500)]
    con = _parts(spark, str(tmp_path), rows)
    df = QUERIES["jaro_winkler_pairs"](spark, str(tmp_path))
    assert 0 < _joined(df) < 100
    want = sorted((a, b, round(float(x), 6)) for a, b, x in con.execute(ORACLES["jaro_winkler_pairs"]).fetchall())
    assert sorted((r["nf"], r["cf"], round(r["similarity"], 6)) for r in df.collect()) == want


def test_first_names_that_meet_in_cells(spark):
    rand = random.Random(3)
    one = lambda n: [("".join(rand.choices("ABC", k=4)), rand.choice(["COMMON", "COMMON", "", "X", f"Y{rand.randrange(40)}"])) for _ in range(n)]
    q, c = one(400), one(300)
    got = ns.first_names(spark.createDataFrame(q, "nf string, nl string"), spark.createDataFrame(c, "cf string, cl string"), cell=7).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == {(a, b) for a, x in q for b, y in c if x == y}
    assert ns.first_names(spark.createDataFrame([], "nf string, nl string"), spark.createDataFrame(c, "cf string, cl string")).count() == 0
