import math

import duckdb
import numpy as np
import pytest
from data import SF_MORE
from pyspark.sql import functions as F

from shelfcast.llm import negatives


def brute(rows, every=50, positives=5, most=3):
    """(anchor, positive, rank, negative, scores) from products of all pairs, in Python's integers."""
    own = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints = [math.floor(256 * x) for x in v]
        if sum(x * x for x in ints) < 2 ** 62:
            own[vec_id] = min(own.get(vec_id, (label, ints)), (label, ints))
    out = []
    for a, (label, v) in own.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, same == label) for i, (same, w) in own.items() if i != a and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2]][:positives]:
            hits = [(-s, i) for s, i, same in scored if not same and 50 * -ps <= 100 * -s <= 95 * -ps][:most]
            out += [(a, p, r, i, -ps, s) for r, (s, i) in enumerate(hits, 1)]
    return sorted(out)


def mined(frame, every=50):
    return sorted(map(tuple, negatives.mine(frame, F.col("vec_id") % every == 0).collect()))


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_MORE}/embeddings.parquet'")
    rows = [(i, (x + 1) % 10 if i % 7 == 0 else x, v) for i, v, x in con.execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()]
    found = negatives.op13_hard_negatives(spark, SF_MORE)
    want = brute(rows)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == want and len(want) > 50
    assert sorted(con.execute(negatives.SQL).fetchall()) == want


def test_deep_trees(spark, monkeypatch):
    """Several levels, nodes split by hash, a vector that a third of the rows share, norms that differ; leaves are left out."""
    for name, value in (("LEAF", 12), ("LEVELS", 2), ("FANOUT", 3), ("SAMPLE", 40)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(5)
    heart = rng.normal(size=(6, 8))
    rows = [(int(i), int(i % 3), [0.5] * 8 if i % 3 == 1 and i % 4 else ((heart[i % 6] + 0.2 * rng.normal(size=8)) * (1 + i % 5)).tolist()) for i in range(900)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(frame) == brute(rows)


def test_a_tree_skips_rows():
    """Two windows of one query and one of another; far fewer rows are met than there are."""
    rng = np.random.default_rng(2)
    points = np.floor(256 * (rng.normal(size=(40, 1, 8)) * 20 + rng.normal(size=(40, 50, 8)))).astype(np.int64).reshape(-1, 8)
    queries, none = points[[7, 90]], negatives.LEAST
    want = queries @ points.T
    low, high = int(np.percentile(want[0], 40)), int(np.percentile(want[0], 45))
    best = negatives.Best([[none, low], [none]], [[negatives.MOST, high], [negatives.MOST]], [[none, none], [none]], [[i] for i in range(2000)], 4)
    met = negatives.CoverTree(points).search(queries, best)
    for q, w, inside in ((0, 0, want[0] == want[0]), (0, 1, (want[0] >= low) & (want[0] <= high)), (1, 0, want[1] == want[1])):
        own = best.key == q * 2 + w
        assert list(zip(-best.score[own], best.id[own])) == sorted((-int(s), i) for i, s in enumerate(want[q]) if inside[i])[:4]
    assert met[1] < 400 and met[0] < 1200


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_odd_vectors(spark, scale):
    """Nulls, non-finite numbers, lengths that differ, ties, repeats of id and vector, huge numbers, clashing columns."""
    rng = np.random.default_rng(9)
    rows = [(i, i % 2, [scale * float(x) for x in rng.integers(0, 3, 3)]) for i in range(120)]
    rows += [(200, None, [1.0]), (250, 1, None), (300, 1, [1.0, None]), (350, 0, [float("nan")]), (400, 0, [float("inf"), 1.0]), (None, 1, [1.0, 1.0, 1.0]),
             (450, 0, [1.0, 2.0]), (451, 0, [1.0, 2.0]), (452, 1, [1.0, 1.1]), (500, 0, []), (501, 0, []), (502, 1, []), (550, 1, [1e300, 1.0, 1.0]),
             (100, 0, [scale, scale, scale]), (100, 0, [scale, scale, scale]), (100, 1, [0.0, scale, scale]), (600, 0, [-1.0, -1.0, -1.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, rep int, VEC_IDS string").repartition(5)
    assert mined(frame, 10) == brute(rows, 10)
    assert negatives.mine(frame.limit(0), F.col("vec_id") % 10 == 0).isEmpty()
