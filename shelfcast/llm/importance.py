"""Quality by importance: how much likelier a text is under a model of good text than under one of all text.

Both models give hashed words and word pairs a probability: the target model from a bounded sample
of documents labelled good (``LABELLED`` rows in all, a documented bound), the raw model from every document.  A
document's log weight is the sum over its n-grams of log(target / raw) less a level ``tau`` per
n-gram, which the other half of the labelled sample sets where it best tells good from bad.  As many documents
as have a log weight above zero are drawn without replacement in proportion to a power of their weights:
Gumbel noise of the document's own hash is added to each log weight and the largest keys are kept.

Defined cases: null and empty texts have no n-gram, log weight 0, and are rejected; rows that repeat
doc_id and text have one key and share a fate; a document labelled twice is good only if all its
labels say so; labels without a document teach nothing; without both good and bad labels, tau is 0 and
without a good one every document with text is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import chunks, mix, table, text_bytes, whole_rows, words_of
from shelfcast.sources.staging import stage

#: Labelled rows looked at, half to fit the target model and half to set tau.
LABELLED = 40_000
#: The draw is in proportion to weights to the power 1 / TEMPERATURE.
TEMPERATURE = 0.25
#: Buckets of words and of pairs; the first half of the counts are words.
BUCKETS = 1 << 16


def features(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For ranges of texts: begin, end, the bucket of each n-gram and the text it is in."""
    for a, b in chunks(texts, 1 << 18):
        words, owner, _ = words_of(texts[a:b])
        pair = owner[1:] == owner[:-1]
        both = mix(words[:-1][pair] * np.uint64(3) + words[1:][pair])
        shift = np.uint64(64 - 16)
        yield a, b, np.concatenate([(words >> shift).astype(np.int64), (both >> shift).astype(np.int64) + BUCKETS]), np.concatenate([owner, owner[1:][pair]])


def count_ngrams(docs: DataFrame) -> DataFrame:
    """model, bucket, n: n-grams of all rows (model 0) and of rows whose ``target`` is true (model 1)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, 2 * BUCKETS), np.int64)
        for batch in batches:
            chosen = batch["target"].to_numpy(bool)
            for a, b, bucket, owner in features(batch["text"].tolist()):
                counts[0] += np.bincount(bucket, minlength=2 * BUCKETS)
                counts[1] += np.bincount(bucket[chosen[a:b][owner]], minlength=2 * BUCKETS)
        model, bucket = np.nonzero(counts)
        yield pd.DataFrame({"model": model.astype(np.int32), "bucket": bucket.astype(np.int32), "n": counts[model, bucket]})

    sums = docs.select(text_bytes().alias("text"), "target").mapInPandas(run, "model int, bucket int, n long")
    return sums.groupBy("model", "bucket").agg(F.sum("n").alias("n"))


def log_ratio(counts: pd.DataFrame, smooth: float = 1.0, evidence: float = 3.0) -> np.ndarray:
    """log(target / raw) of each bucket, words and pairs each summing to one; zeros without a target.

    A ratio shrinks to 0 the less its target count differs, in standard errors, from what the raw
    model expects; under ``evidence`` of them it is 0.
    """
    n = np.zeros((2, 2, BUCKETS))
    n[counts["model"], counts["bucket"] // BUCKETS, counts["bucket"] % BUCKETS] = counts["n"]
    if not n[1].any():
        return np.zeros(2 * BUCKETS)
    p = (n + smooth) / (n + smooth).sum(axis=2, keepdims=True)
    expected = p[0] * n[1].sum(axis=1, keepdims=True)
    errors = np.abs(n[1] - expected) / np.sqrt(expected + 1)
    return (np.log(p[1] / p[0]) * np.clip(1 - (evidence / np.maximum(errors, 1e-9)) ** 2, 0, 1)).ravel()


def score_column(spark: SparkSession, ratio: np.ndarray) -> Column:
    """Of ``text``: number of n-grams and sum of their log ratios."""
    table_of = spark.sparkContext.broadcast(ratio)  # 2 x BUCKETS numbers

    @F.pandas_udf("n long, total double")
    def score(text: pd.Series) -> pd.DataFrame:
        n, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        for a, b, bucket, owner in features(text.tolist()):
            n[a:b] = np.bincount(owner, minlength=b - a)
            total[a:b] = np.bincount(owner, weights=table_of.value[bucket], minlength=b - a)
        return pd.DataFrame({"n": n, "total": total})

    return score(text_bytes())


def level(per_ngram: np.ndarray, good: np.ndarray) -> float:
    """The value per n-gram that best parts good from bad: the highest sum of the two rates of right answers."""
    if not good.any() or good.all():
        return 0.0
    order = np.argsort(per_ngram, kind="stable")
    value, good = per_ngram[order], good[order]
    bad_below = np.concatenate([[0], np.cumsum(~good)]) / (~good).sum()
    good_above = 1 - np.concatenate([[0], np.cumsum(good)]) / good.sum()
    ends = np.concatenate([[True], value[1:] != value[:-1], [True]])
    gain = np.where(ends, bad_below + good_above, -1)
    cut = np.flatnonzero(gain == gain.max())
    cut = int(cut[len(cut) // 2])
    return float(value[0] - 1e-9 if cut == 0 else value[-1] + 1e-9 if cut == len(value) else (value[cut - 1] + value[cut]) / 2)


def gumbel(seed: int) -> Column:
    """Gumbel noise of a row's doc_id and text, times the temperature."""
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 11).cast("double")
    return F.lit(-TEMPERATURE) * F.log(-F.log((bits + 0.5) / float(1 << 53)))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The k-th largest value, by counts per bin of an interval that narrows until it holds few rows."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0  # rows larger than the interval
    while True:
        inside = df.where(F.col(column).between(low, high))
        if high <= low or inside.count() <= few:
            values = sorted((r[0] for r in inside.select(column).limit(few).collect()), reverse=True) if high > low else [low]
            return values[min(k - above, len(values)) - 1]
        width = (high - low) / bins
        spot = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        held = inside.groupBy(spot.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
        for r in sorted(held, key=lambda r: -r.bin):
            if above + r.n >= k:
                low, high = r.lo, r.hi
                break
            above += r.n


@dataclass
class Model:
    """Log ratio per bucket, level per n-gram, and the smallest key that is kept."""

    ratio: np.ndarray
    tau: float
    cut: float
    seed: int

    def weigh(self, docs: DataFrame) -> DataFrame:
        """Adds ``_log_weight``, ``_key`` and ``_kept`` to a frame with doc_id and text."""
        found = docs.withColumn("_score", score_column(docs.sparkSession, self.ratio)).withColumn("_noise", gumbel(self.seed))
        weight = F.col("_score.total") - F.lit(self.tau) * F.col("_score.n")
        return (found.withColumn("_log_weight", weight).withColumn("_key", F.col("_log_weight") + F.col("_noise"))
                .withColumn("_kept", (F.col("_score.n") > 0) & (F.col("_key") >= F.lit(self.cut))).drop("_score", "_noise"))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, seed: int = 11) -> Model:
    """Reads all of ``docs`` (doc_id, text) twice; ``labels`` has doc_id, quality and toxic, good is quality 1 and not toxic."""
    order = F.xxhash64("doc_id", F.lit("labels"))
    judged = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.min(F.coalesce(F.col("quality") == 1, F.lit(False)) & ~F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("good"))
              .withColumn("half", F.pmod(order, F.lit(2))).orderBy(order, "doc_id").limit(labelled))
    judged = stage(judged.select(F.col("doc_id").alias("_id"), "good", "half"), "labels")  # at most `labelled` rows, so it may be broadcast
    target = judged.where("half = 0 AND good")
    marked = docs.join(F.broadcast(target), F.col("doc_id") == F.col("_id"), "left").select("text", F.col("_id").isNotNull().alias("target"))
    ratio = log_ratio(count_ngrams(marked).toPandas())  # at most 4 x BUCKETS rows
    found = stage(docs.select("doc_id", score_column(docs.sparkSession, ratio).alias("s"), gumbel(seed).alias("noise"))
                  .select("doc_id", "s.n", "s.total", "noise").where("n > 0"), "scores")
    test = found.join(F.broadcast(judged.where("half = 1")), F.col("doc_id") == F.col("_id")).select("n", "total", "good").limit(2 * labelled).toPandas()
    tau = level((test["total"] / test["n"]).to_numpy(float), test["good"].to_numpy(bool))
    if not ratio.any():
        return Model(ratio, tau, float("-inf"), seed)
    weight = F.col("total") - F.lit(tau) * F.col("n")
    keyed = found.select(weight.alias("w"), (weight + F.col("noise")).alias("key"))
    k = keyed.where("w > 0").count()
    return Model(ratio, tau, kth_largest(keyed, "key", k) if k else float("inf"), seed)


def op9_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log weight, key and fate of all ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return model.weigh(docs).select("doc_id", F.col("_log_weight").alias("log_weight"), F.col("_key").alias("key"), F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    rows = whole_rows(docs, "doc_id", "text")
    return fit(rows.drop("row"), labels).weigh(rows).where("_kept").select("row.*")
