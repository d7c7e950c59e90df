import corpus_pipeline
import numpy as np
import pytest
from data import SF, SF_MORE

from shelfcast.llm import simhash
from shelfcast.sources.staging import stage


def brute_kept(texts):
    """doc_ids of the first of each group of fingerprints linked at 2 bits, over all pairs."""
    ids = sorted(texts)
    points = np.array([simhash.fingerprint((texts[i] or "").encode()) for i in ids], np.uint64)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(points[i + 1:] ^ points[i]) <= 2):
            x, y = sorted((find(i), find(i + 1 + int(j))))
            root[y] = x
    return {ids[find(i)] for i in range(len(ids))}


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "mixture", "packing"]


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    spots = sorted((p.sequence_id * 4096 + p.offset, p.length) for p in pieces)
    assert spots[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spots, spots[1:]))


def test_near_duplicates(spark):
    docs = spark.read.parquet(f"{SF_MORE}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF_MORE)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    found = kept.collect()
    assert sorted(r.doc_id for r in found) == sorted(brute_kept({i: r.text for i, r in rows.items()}))
    assert all(r == rows[r.doc_id] for r in found)


def test_near_duplicates_of_rows_without_ids(spark):
    """Linked rows with and without ids, rows equal in all columns, and equal ids with different texts."""
    long = " ".join(f"w{i}" for i in range(400))
    rows = [(None, long, 1), (7, long + " end", 2), (9, long, 3), (9, long, 3), (None, "alone here now", 4), (None, "alone here now", 4), (9, "other words of nine", 5),
            (11, None, 6), (12, "", 7)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, component int").repartition(3)).collect()
    assert sorted(r.component for r in kept) == [2, 4, 5, 6]


@pytest.mark.parametrize("number", range(5))
def test_stages_on_odd_rows(spark, odd, number):
    name, stage_of = corpus_pipeline.STAGES[number]
    for docs in (odd, odd.limit(0)):
        docs = stage(docs, "odd")
        out = stage_of(spark, docs, SF)
        rows = out.collect()
        assert out.columns == docs.columns or number == 4
        assert rows or docs.isEmpty()
        if name == "near_duplicates" and rows:
            ids = [r.doc_id for r in rows]
            assert 1 in ids and 6 in ids and ids.count(6) == 1 and not {2, 3, 7} & set(ids)
