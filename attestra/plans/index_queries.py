"""Queries over the search index and over queues that are sorted once."""

from __future__ import annotations

from pyspark.sql import functions as F

from attestra.operators.search_index import queue, search_index
from attestra.plans.common import Registry
from attestra.plans.review_queries import CW, FOUND, HAY, NJ, K, _cases
from attestra.plans.testdata import EVIDENCE_SQL, evidence

R = Registry()
PAGE = 20
#: Searches by kind of text: a state's name, a vehicle, two letters, a record's type, a source by its kind. Each shows the newest 50.
ASKS = {
    "state": (("New Jersey", "title", "NJ"), NJ),
    "vehicle": (("V1",), f"{HAY} LIKE '%v1%'"),
    "digit": (("7",), f"{HAY} LIKE '%7%'"),
    "type": (("Ownership_Change",), f"{HAY} LIKE '%ownership_change%'"),
    "kind": (("pa", "vehicle_title"), f"{HAY} LIKE '%pa%' AND src = 'title'"),
    "nothing": (("no such record",), "false"),
}


@R.add("search_index", f"WITH {EVIDENCE_SQL.strip()} " + " UNION ALL ".join(f"SELECT '{name}' AS ask, * FROM ({FOUND.format(cond)})" for name, (_, cond) in ASKS.items()))
def searches(spark, sf_dir):
    """One index, written once, answers all searches."""
    index = search_index(evidence(spark, sf_dir), buckets=32, parts=32)
    out = None
    for name, (ask, _) in ASKS.items():
        found = index.search(*ask).select(F.lit(name).alias("ask"), K, "source_record_id", "src", "state", "event_type")
        out = found if out is None else out.unionByName(found)
    return out


@R.add(
    "case_pages",
    f"""{CW}, o AS (SELECT {K}, t1_priority AS review_priority, row_number() OVER (ORDER BY t1_priority DESC, {K}) - 1 AS place, count(*) OVER () AS total FROM cs),
h AS (SELECT 'first' AS how, 0 AS lo UNION ALL SELECT 'middle', (SELECT count(*) FROM cs) // 2 UNION ALL SELECT 'last', ((SELECT count(*) FROM cs) - 1) // {PAGE} * {PAGE} UNION ALL SELECT 'after', (SELECT count(*) FROM cs) // 2 + {PAGE})
SELECT how, place, total, {K}, review_priority FROM o JOIN h ON place >= lo AND place < lo + {PAGE}""",
    "review_priority",
)
def case_pages(spark, sf_dir):
    """The case list sorted once; the first page, one from the middle, the last, and what follows the middle one's last row."""
    cases = _cases(spark, sf_dir).select(K, F.col("t1_priority").alias("review_priority"))
    q = queue(cases, [("review_priority", True), (K, False)])
    middle = q.page(q.total // 2, PAGE)
    last = middle.agg(F.max_by(F.struct(K, "review_priority"), "place").alias("s")).select("s.*").first()
    pages = {"first": q.page(0, PAGE), "middle": middle, "last": q.page((q.total - 1) // PAGE * PAGE, PAGE), "after": q.after(last.asDict(), PAGE)}
    out = None
    for how, rows in pages.items():
        rows = rows.select(F.lit(how).alias("how"), "place", "total", K, "review_priority")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES, ORACLES = R.queries, R.oracles
