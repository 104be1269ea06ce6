"""The search index against scans, pages against one sort, and how little both read."""

import random
import re

import pytest
from pyspark.sql import functions as F

from attestra.operators import review
from attestra.operators.search_index import MOST_GRAMS, grams, queue, search_index

EVIDENCE = "candidate_record_id string, source_record_id string, src string, state string, event_type string, vehicle_ref string, event_dt date, row long, n int"


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(6000):
        who = "C1" if k % 3 == 0 else f"C{rnd.randrange(900)}"
        rows.append((who, f"R{k:05d}", rnd.choice(["title", "license", "address", "other"]), rnd.choice(["PA", "nj", "NJ", "", None]), rnd.choice(["title_record", "ownership_change", None]), rnd.choice([None, "", f"V{k % 977}"]), None, k, k % 7))
    rows += [rows[5], rows[5], (None, None, "title", None, None, None, None, 1, 1)]
    return spark.createDataFrame(rows, EVIDENCE.replace("row long", "own long")).withColumn("event_dt", F.when(F.col("n") > 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("n") * 3))).cache()


def test_searches_equal_scans(spark, table):
    index = search_index(table, parts=16, buckets=16)
    key = lambda df: sorted(map(str, df.select("candidate_record_id", "source_record_id", "src", "state", "event_type", "vehicle_ref", "event_dt", "own", "n").collect()))
    for ask in [("R00123",), ("v97",), ("New Jersey",), ("nj", "vehicle_title"), ("c1 r",), ("_", "all", "PA"), ("unk title",), ("5",), ("no such",), ("", "title"), ("%",), ("R0000", "credential")]:
        assert key(index.search(*ask, limit=100_000)) == key(review.evidence_search(table, *ask, limit=100_000)), ask


def test_a_search_reads_little(spark, table):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this table is so small that all of it would be one file
    index = search_index(table, parts=16, buckets=16)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for ask in ("r01234", "v976"):
        found = index.candidates(ask)
        assert 0 < found.count() <= table.count() / 100
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "EqualTo(gram" in plan
    # a gram lies in one folder
    assert index._read("grams").where(index._has("r01")).select(F.regexp_extract(F.input_file_name(), "bucket=[0-9]+", 0)).distinct().count() == 1
    assert len(grams("r01234")) <= MOST_GRAMS and grams("ab") == ["ab"] and grams("aaaa") == ["aaa"]
    # the most frequent candidate has a third of the rows and lies in several files
    files = index._read("rows").where("candidate_record_id = 'C1'").select(F.input_file_name()).distinct().count()
    assert files > 1


def test_an_empty_index(spark):
    index = search_index(spark.createDataFrame([], EVIDENCE.replace("row long", "own long")))
    assert index.search("abc").count() == 0 and index.search("a").count() == 0 and index.search().count() == 0


@pytest.mark.parametrize("down", [True, False])
def test_all_pages(spark, down):
    rnd = random.Random(5)
    values = [(k, rnd.choice([None, 0.5, 0.5, rnd.random()])) for k in range(503)]
    df = spark.createDataFrame(values, "id int, v double")
    top = lambda r: (r[1] is None, r[1] or 0.0)
    want = sorted(sorted(values, key=lambda r: r[0]), key=top, reverse=down)
    q = queue(df, [("v", down), ("id", False)], ranges=7)
    assert q.total == 503 and len(q.starts) > 3
    for skip in (0, 40, 200, 480, 500, 503, 900):
        got = q.page(skip, 40).collect()
        assert [(r["id"], r["v"]) for r in got] == want[skip : skip + 40] and all(r["total"] == 503 and r["place"] == skip + k for k, r in enumerate(got))
    for at in (0, 150, 333, 502):
        assert [(r["id"], r["v"]) for r in q.after({"id": want[at][0], "v": want[at][1]}, 30).collect()] == want[at + 1 : at + 31]
    # a page opens the ranges that it lies in
    assert q._rows(0, 10).select(F.regexp_extract(F.input_file_name(), "range=[0-9]+", 0)).distinct().count() == 1
    assert re.search(r"PartitionFilters: \[[^\]]*range", q.page(0, 10)._jdf.queryExecution().executedPlan().toString())


def test_no_rows_no_pages(spark):
    q = queue(spark.createDataFrame([], "id int, v double"), [("v", True), ("id", False)])
    assert q.total == 0 and q.page(0, 5).count() == 0 and q.after({"id": 1, "v": 0.5}).count() == 0
