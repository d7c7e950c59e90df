import random
from itertools import permutations

import duckdb
import pytest
from data import SF, SF_MORE
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import audit

SORTED = st.lists(st.integers(0, 60), unique=True).map(sorted)


@given(st.lists(SORTED, max_size=6))
def test_union(lists):
    assert audit.union(lists) == sorted(set().union(*lists))


@given(SORTED, SORTED)
def test_difference(a, b):
    assert audit.left_over(a, b) == len(set(a) - set(b))


@given(st.lists(st.integers(0, 99)).map(sorted), st.integers(-1, 100), st.integers(0, 5))
def test_gallop(ids, wanted, at):
    if at < len(ids):
        assert audit.gallop(ids, wanted, at) == next((i for i in range(at, len(ids)) if ids[i] >= wanted), len(ids))


def brute(rows, labels):
    """Rows as the report's, from whole texts, by running the filters one after the other."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc_id, text, part in rows:
        t = text or ""
        words = t.encode().split()
        own = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= x <= "Z" for x in t) > 3 * len(t),
               "D": any(x in "#$%&*|" for x in t),
               "E": doc_id is not None and any(d is not None and d < doc_id and (o or "") == t for d, o, _ in rows)}
        fails.append((doc_id, part or "", {k for k, v in own.items() if v}))
    out = set()
    for part in {p for _, p, _ in fails}:
        own, shapley, lines = [(d, f) for d, p, f in fails if p == part], dict.fromkeys("ABCDE", 0), []
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(gone)
                lines.append((part, order, step, len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own),
                              sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out |= {(*line, shapley[line[1][line[2] - 1]]) for line in lines}
    return out


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def test_odd_rows(spark, odd, none):
    labels = [(1, 1, 0), (1, 0, 1), (6, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1)]
    rows = [(r.doc_id, r.text, r.lang) for r in odd.select("doc_id", "text", "lang").collect()]
    judged = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit(odd, judged)
    assert found.columns == COLUMNS and {tuple(r) for r in found.collect()} == brute(rows, labels)
    assert audit.audit(none, judged).isEmpty()
    clash = odd.select("doc_id", "text", "lang", F.lit(1).alias("bits"), F.lit("x").alias("PART"), F.lit(2).alias("good"))
    assert {tuple(r) for r in audit.audit(clash, judged).collect()} == brute(rows, labels)


def test_many_ranges(spark):
    """Parts that span many batches and a text that a third of the rows share."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["same text"] * 3 + ["a % " + str(i), "UP " * 5, "w " * 300, " ".join(f"v{k}" for k in range(250)) + str(i % 7)]),
             rng.choice(["x", "x", "y", None])) for i in range(3000)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 3000, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        found = audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {tuple(r) for r in found} == brute([r for r in rows], labels)


@pytest.mark.parametrize("folder", [SF, SF_MORE])
def test_query(spark, folder):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    result = con.execute(audit.SQL)
    names = [d[0] for d in result.description]
    found = audit.op11_filter_audit(spark, folder).select(*names)
    assert sorted(map(tuple, found.collect())) == sorted(result.fetchall())
