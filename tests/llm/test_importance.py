import numpy as np
import pytest
from data import SF_MORE
from pyspark.sql import functions as F

from shelfcast.llm import importance


def test_kth_largest(spark):
    values = np.concatenate([np.random.default_rng(2).normal(size=3000) ** 3, np.full(500, 1.5)])
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in (1, 2, 400, 900, 2000, 3500):
        assert importance.kth_largest(frame, "x", k, bins=16, few=50) == np.sort(values)[::-1][k - 1]


def test_level_parts_best():
    x = np.array([0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    assert importance.level(x, x > 0.35) == pytest.approx(0.35) and importance.level(x, x > 0) == 0 and importance.level(x, x > 9) == 0


def test_scores_are_sums_of_log_ratios(spark):
    texts = ["one two two", "two one", "", "three"]
    frame = spark.createDataFrame([(i, t, i == 0) for i, t in enumerate(texts)], "doc_id long, text string, target boolean")
    counts = importance.count_ngrams(frame).toPandas()
    assert counts[counts.model == 0].n.sum() == 6 + 3 and counts[counts.model == 1].n.sum() == 3 + 2
    ratio = np.random.default_rng(1).normal(size=2 * importance.BUCKETS)
    got = [r[0] for r in frame.orderBy("doc_id").select(importance.score_column(spark, ratio)).collect()]
    for text, g in zip(texts, got):
        bucket = [b for _, _, bucket, _ in importance.features([text.encode()]) for b in bucket]
        assert g.n == len(bucket) and g.total == pytest.approx(ratio[bucket].sum() if bucket else 0)


def test_good_stays_and_bad_goes(spark):
    rows = importance.op9_importance(spark, SF_MORE)
    labels = spark.read.parquet(f"{SF_MORE}/labels.parquet")
    rates = {(r.quality, r.toxic): r.rate for r in rows.join(labels, "doc_id").groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("rate")).collect()}
    assert rates[1, 0] > 0.9 and rates[0, 0] < 0.6
    assert rows.where("kept").agg(F.min("key")).first()[0] > rows.where("NOT kept").agg(F.max("key")).first()[0]
    again = importance.op9_importance(spark, SF_MORE)
    assert rows.where("kept").select("doc_id").exceptAll(again.where("kept").select("doc_id")).isEmpty()


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 1, 0), (7, 1, 1), (8, None, None), (99, 1, 0), (None, 1, 0), (10, 1, 0)], "doc_id long, quality int, toxic int")
    out = importance.keep_good(odd, labels)
    assert out.columns == odd.columns and not {r.text for r in out.collect()} & {None, "", " \t\n "}
    assert importance.keep_good(none, labels).collect() == []
    # Without labels every document with a word stays.
    assert importance.keep_good(odd, labels.limit(0)).count() == sum(bool((r.text or "").split()) for r in odd.collect())
