"""Nearest neighbours by largest inner product, found by counting collisions.

Vectors are scaled by the largest norm and given one more coordinate that makes them unit vectors;
distance to a query (its added coordinate zero) then falls as the inner product grows.  Rows are dealt
into shards of bounded size by a hash.  A shard keeps, for each of ``lines`` random projections, its rows' values in
order.  A query uses the ``projections`` of them where its own value is farthest out: there few rows lie near it by
chance.  Around its value a window is opened in each and widened; a row inside a window has collided there
once more (virtual rehashing: wider windows take the place of tables with wider buckets, only the added ends
are read).  Rows with at least ``threshold`` x ``projections`` collisions are verified by their exact inner product.

Windows widen until a row as near as the j-th best verified one would have been verified with probability
1 - ``miss``, or until all rows were verified.  A row whose cosine with the query is s has value s c + sqrt(1 - s^2) z on a line
where the query has c, z standard normal and another for each line, so this width is computed, and windows read again every few widths on the
way.  Here j is how many of the k nearest a shard holds at most, but for a chance of ``LATE``, since rows are dealt at random; with one shard j is k.

Every row is indexed.  Queries are a stated set, sent in blocks to every shard.

Defined cases: vectors that are null, empty, all zero or hold null or non-finite numbers take no part,
nor do rows without an id; vectors of another length than the query's are no candidates; rows that
repeat id and vector count once; a query's own id is never its neighbour; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import table
from shelfcast.sources.staging import stage

#: Rows of a shard, queries that a shard answers together, and the chance that it holds more of the k nearest than it waits for.
SHARD, BLOCK, LATE = 8192, 128, 1e-3
#: Widths that a window may take, the last without ends, and how many it passes at most between two readings.
WIDTHS, STEP = 64, 5
_AT = np.linspace(-9, 9, 18001)
_BELOW = np.array([NormalDist().cdf(x) for x in _AT])


def below(x: np.ndarray) -> np.ndarray:
    """The standard normal distribution function."""
    return np.interp(x, _AT, _BELOW)


def most_held(k: int, shards: int) -> int:
    """How many of ``k`` rows dealt at random a shard holds at most, but for a chance of ``LATE``."""
    p, total = 1 / shards, 0.0
    for j in range(k + 1):
        total += comb(k, j) * p ** j * (1 - p) ** (k - j)
        if total >= 1 - LATE:
            return max(1, j)
    return k


class Index:
    """Sorted projections of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, lines: int, seed: int):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        n, dim = vectors.shape
        rng = np.random.default_rng([seed, dim])
        self.lines = rng.standard_normal((dim + 1, lines))
        unit = vectors / largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        # All projections in one sorted array, each lifted above the one before; |value| <= |line|.
        self.lift = np.arange(lines) * (4 * np.sqrt((self.lines ** 2).sum(axis=0)).max())
        self.values, self.order = np.empty(lines * n), np.empty(lines * n, np.int32)
        for first in range(0, lines, 64):
            block = (unit @ self.lines[:-1, first:first + 64] + rest[:, None] * self.lines[-1, first:first + 64]).T
            order = np.argsort(block, axis=1)
            block = np.take_along_axis(block, order, axis=1) + self.lift[first:first + 64, None]
            self.values[first * n:first * n + block.size], self.order[first * n:first * n + block.size] = block.ravel(), order.ravel()
        #: Entries of windows read and rows verified, over all queries.
        self.read = self.verified = 0

    def place(self, keys: np.ndarray, side: str = "left") -> np.ndarray:
        """Places of lifted keys in the sorted array, looked up in order, which keeps the lookups together."""
        order = np.argsort(keys, axis=None)
        out = np.empty(keys.size, np.int64)
        out[order] = self.values.searchsorted(keys.ravel()[order], side)
        return out.reshape(keys.shape)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, held: int, projections: int, threshold: float, miss: float,
               first: float, grow: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and inner products of the k best rows found for each of a block of queries."""
        n, m = len(self.ids), min(projections, len(self.lift))
        least, z = max(1, int(np.ceil(threshold * m))), NormalDist().inv_cdf(1 - miss)
        widths = np.append(first * grow ** np.arange(WIDTHS - 1), np.inf)
        long = np.sqrt((queries * queries).sum(axis=1))
        center = (queries / long[:, None]) @ self.lines[:-1]
        used = np.argpartition(-np.abs(center), m - 1, axis=1)[:, :m]
        center = np.take_along_axis(center, used, axis=1)
        out, lifted, floor, top_end = np.abs(center), center + self.lift[used], used * n, used * n + n
        left = np.clip(self.place(lifted), floor, top_end)
        right = left.copy()
        count = np.zeros((len(queries), n), np.int64)
        best_at, best = [np.zeros(0, np.int64)] * len(queries), [np.zeros(0)] * len(queries)
        norm, kth = self.largest * long, np.full(len(queries), -np.inf)
        step, active = np.zeros(len(queries), int), np.arange(len(queries))
        while len(active):
            half = widths[step[active], None]
            lo = np.clip(self.place(lifted[active] - half), floor[active], left[active])
            hi = np.clip(self.place(lifted[active] + half, "right"), right[active], top_end[active])
            for q, *ends in zip(active.tolist(), lo.tolist(), left[active].tolist(), right[active].tolist(), hi.tolist()):
                entries = np.concatenate([self.order[a:b] for starts, stops in (ends[:2], ends[2:]) for a, b in zip(starts, stops)])
                own = count[q]
                own += np.bincount(entries, minlength=n)
                found = np.flatnonzero(own >= least)
                own[found] = -m  # verified once
                self.read, self.verified = self.read + len(entries), self.verified + len(found)
                found = found[self.ids[found] != query_ids[q]]
                if len(found):
                    score = self.vectors.take(found, axis=0) @ queries[q]
                    if len(found) > k:
                        near = score >= np.partition(score, -k)[-k] - 1e-9 * norm[q]
                        found, score = found[near], score[near]
                    at, score = np.concatenate([best_at[q], found]), np.concatenate([best[q], score])
                    top = np.argsort(-score)
                    top = top[score[top] >= score[top[min(k, len(top)) - 1]] - 1e-9 * norm[q]]  # ties with the k-th stay
                    best_at[q], best[q] = at[top], score[top]
                    if len(top) >= held:
                        kth[q] = best[q][held - 1]
            left[active], right[active] = lo, hi
            # The first of the next widths at which a row as near as the kept one reaches the threshold.
            s = np.clip(kth[active] / norm[active], -1, 1 - 1e-12)[:, None, None]
            spread = np.sqrt(1 - s * s) + 1e-12
            away, next_width = (1 - s) * out[active][:, None, :], widths[np.minimum(step[active, None] + np.arange(STEP), WIDTHS - 1), None]
            p = below((away + next_width) / spread) - below((away - next_width) / spread)
            sure = (p.sum(axis=2) - z * np.sqrt((p * (1 - p)).sum(axis=2)) >= least - 0.5) & np.isfinite(kth[active, None])
            on = np.where(sure.any(axis=1), sure.argmax(axis=1), STEP)
            going = (on > 0) & (step[active] < WIDTHS - 1)
            step[active] = np.minimum(step[active] + on, WIDTHS - 1)
            active = active[going]
        results = []
        for q in range(len(queries)):
            score = (self.vectors[best_at[q]] * queries[q]).sum(axis=1)
            top = np.lexsort((self.ids[best_at[q]], -score))[:k]
            results.append((self.ids[best_at[q][top]], score[top]))
        return results


def nearest(rows: DataFrame, is_query, k: int = 20, lines: int = 512, projections: int = 24, threshold: float = 0.375, miss: float = 0.01,
            first: float = 1.3, grow: float = 1.05, shard: int = SHARD, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest of every row for which ``is_query`` holds."""
    usable = (F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
              & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    rows = stage(rows.where(usable).select("vec_id", F.col("embedding").cast("array<double>").alias("v")).distinct()
                 .withColumn("dim", F.size("v")), "vectors")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("norm")).first()
    if not facts.n:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    shards = -(-facts.n // shard)
    largest, held_most = facts.norm * (1 + 1e-9), most_held(k, shards)
    held = rows.select("dim", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).alias("shard"), F.lit(0).alias("asks"), "vec_id", "v")
    asked = rows.where(is_query).select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                                        F.lit(1).alias("asks"), "vec_id", "v")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, parts, index = None, [], None
        for batch in batches:
            for (dim, number, asks), own in batch.groupby(["dim", "shard", "asks"], sort=True):
                if (dim, number) != key:
                    key, parts, index = (dim, number), [], None
                ids, vectors = own["vec_id"].to_numpy(np.int64), np.stack(own["v"].to_numpy())
                if not asks:
                    parts.append((ids, vectors))
                    continue
                if not parts:
                    continue
                if index is None:
                    index = Index(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), largest, lines, seed)
                for at in range(0, len(ids), BLOCK):
                    block = ids[at:at + BLOCK]
                    found = index.search(block, vectors[at:at + BLOCK], k, held_most, projections, threshold, miss, first, grow)
                    yield pd.DataFrame({"query_id": np.repeat(block, [len(f) for f, _ in found]), "vec_id": np.concatenate([f for f, _ in found]),
                                        "score": np.concatenate([x for _, x in found])})

    found = (held.unionByName(asked).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asks")
             .mapInPandas(search, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op10_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row of ``embeddings`` whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
