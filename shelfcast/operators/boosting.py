"""Gradient boosting on all training rows: bins, splits and leaves are counted from every one of them.

A turn of rounds is one stage for each loss, as losses share no tree.  Its tasks hold the training rows between them: one task up to
``SAMPLE`` rows, more of them in a barrier stage above that.  Each counts histograms of its own rows and adds them up over all tasks
(``allGather``, about a second each time), so every task sees the sums of all rows and makes the same tree.  Nodes that a tree, always splitting the leaf that gains most, may still split are counted together, so a tree takes as many
exchanges as it is deep.  Counts are whole numbers, so trees do not depend on how rows are dealt.  A tree's leaves stand at the exact
quantile of the residuals of all rows that fall into them (a Newton step for the logistic loss) before the next tree is begun.  As in
the usual settings a tree sees a share of its rows and columns, drawn anew for each tree; its leaves see all rows.

At the end of a turn one pass writes the margins of all rows, and another, over validation rows, gives the error of each round.  Several
losses share their turns, each with its own trees and patience, which is looked at after every turn; the best round is kept.

Features are cut into at most 64 bins once.  Margins and trees go to a table store after every turn: the next turn starts
from there, so the cost of a round does not grow, and a fit that was killed goes on from its last turn.  Residuals are counted in
steps of 1/16.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import BarrierTaskContext, TaskContext, inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.staging import discard, new_path, stage
from shelfcast.sources.store import TableStore

#: Training rows that one task of a turn may hold before they are dealt to several (as far as there are cores); bins of a feature; rounds between two written margins.
SAMPLE, BINS, TURN = 1 << 20, 64, 20
#: Residuals are counted in steps of 1 / GRID.
GRID = 16
#: Steps on each side of zero that are told apart; 2^31 sales are more than a day has.
HALF = 1 << 39
#: Places a search for a quantile looks at in one exchange.
PROBES = 256
#: Rows that trees are looked through for at a time.
BLOCK = 1 << 16
#: Gradients and curvatures of the logistic loss are added in steps of 1 / UNIT, so that sums are exact in any order.
UNIT = 1 << 24
# Learning rate, and the shares of rows and columns a tree sees.
STEP, ROW_SHARE, COLUMN_SHARE = 0.05, 0.8, 0.8
DEEPEST = 24


@dataclass(frozen=True)
class Loss:
    """A quantile between 0 and 1 (0.5: absolute error), or the logistic loss when None."""

    quantile: float | None

    def start(self, y: DataFrame) -> float:
        """The best constant for the rows of ``y`` (y)."""
        if self.quantile is None:
            share = y.agg(F.avg("y")).first()[0]
            share = min(max(share or 0.0, 1e-6), 1 - 1e-6)
            return float(np.log(share / (1 - share)))
        return float(y.agg(F.percentile("y", self.quantile)).first()[0] or 0.0)

    def response(self, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Negative gradient and curvature."""
        if self.quantile is None:
            p = 1 / (1 + np.exp(-margin))
            return y - p, np.maximum(p * (1 - p), 1e-9)
        return np.where(y > margin, self.quantile, self.quantile - 1.0), np.ones(len(y))

    def errors(self, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
        if self.quantile is None:
            return np.logaddexp(0, margin) - y * margin
        gap = y - margin
        return np.maximum(self.quantile * gap, (self.quantile - 1) * gap)

    def error(self, y: np.ndarray, margin: np.ndarray) -> float:
        return float(self.errors(y, margin).sum())


@dataclass
class Tree:
    """Node arrays; a node with feature -1 is a leaf.  Codes up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaf(self, codes: np.ndarray) -> np.ndarray:
        """The leaf of each row; a node deals its rows to its two sides, so a row is looked at once a level."""
        out, waiting = np.zeros(len(codes), np.int64), [(0, np.arange(len(codes)))]
        while waiting:
            node, rows = waiting.pop()
            if self.feature[node] < 0:
                out[rows] = node
            elif len(rows):
                goes = codes[rows, self.feature[node]] <= self.cut[node]
                waiting += [(int(self.left[node]), rows[goes]), (int(self.right[node]), rows[~goes])]
        return out

    def lists(self) -> dict:
        return {k: getattr(self, k).tolist() for k in ("feature", "cut", "left", "right", "value")}

    @staticmethod
    def of(lists: dict) -> Tree:
        return Tree(*[np.array(lists[k], float if k == "value" else np.int64) for k in ("feature", "cut", "left", "right", "value")])


def gathered(part: np.ndarray) -> np.ndarray:
    """The array of whole numbers ``part`` of every task of a barrier stage, stacked."""
    kind = np.min_scalar_type(int(part.max(initial=0))) if part.min(initial=0) >= 0 else np.dtype(np.int64)
    own = kind.char + base64.b64encode(zlib.compress(np.ascontiguousarray(part, kind), 1)).decode()
    return np.stack([np.frombuffer(zlib.decompress(base64.b64decode(text[1:])), text[0]).astype(np.int64).reshape(part.shape)
                     for text in BarrierTaskContext.get().allGather(own)])


def split_sample(codes: np.ndarray, y: np.ndarray, margin: np.ndarray, loss: Loss, seen: np.ndarray, columns: np.ndarray, leaves: int,
                 leaf_rows: int, gather: Callable[[np.ndarray], np.ndarray], eager: bool = False) -> tuple[Tree, np.ndarray]:
    """A tree on the rows ``seen`` of all tasks, always splitting the leaf that gains most, and the leaf of each row held here.

    ``codes`` is rows x features.  ``gather`` stacks an array of all tasks.  Every task gets the same tree, its leaves still at 0.
    All nodes that may be split are tried at once if ``eager``, for few exchanges; else the best quarter of them, so that few are
    tried in vain.  The tree is the same.
    """
    logistic, width = loss.quantile is None, len(columns)
    if logistic:
        g, h = (np.round(x * UNIT) for x in loss.response(y, margin))
    else:
        above = y > margin

    def sums(parts: list[np.ndarray]) -> np.ndarray:
        """Histograms of each part's rows in all tasks: parts x (rows at or below, rows above the margin, or rows, g, h) x columns x bins."""
        kept = [part[seen[part]] for part in parts]
        rows, size, step = np.concatenate(kept), len(parts), BINS if logistic else 2 * BINS
        small = np.uint16 if size * step <= 1 << 16 else np.int64  # of half the cost, and enough for 512 parts
        spot = np.repeat((np.arange(size) * step).astype(small), [len(part) for part in kept])
        out = np.zeros((size, 3 if logistic else 2, width, BINS), np.int64)
        if not logistic:
            spot += above[rows] * small(BINS)
        block = codes[rows]  # whole rows at once: features one by one cost several times as much
        for i, f in enumerate(columns):
            at = spot + block[:, f]
            if logistic:
                for c, weight in enumerate((None, g[rows], h[rows])):
                    out[:, c, i] = np.bincount(at, weight, size * BINS).reshape(size, BINS)
            else:
                out[:, :, i] = np.bincount(at, minlength=2 * size * BINS).reshape(size, 2, BINS)
        return gather(out).sum(axis=0)

    def best(tables: np.ndarray) -> list[tuple[float, int, int, bool]]:
        """Of each table the best gain, its column and cut, and whether fewer rows go left."""
        upto = tables.cumsum(axis=3)
        if logistic:
            n, gs, hs = upto[:, 0], upto[:, 1] / UNIT, upto[:, 2] / UNIT
        else:
            n = hs = upto.sum(axis=1)
            gs = upto[:, 1] * loss.quantile + upto[:, 0] * (loss.quantile - 1.0)
        whole_n, whole_g, whole_h = n[:, :, -1:], gs[:, :, -1:], hs[:, :, -1:]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gs ** 2 / hs + (whole_g - gs) ** 2 / (whole_h - hs) - whole_g ** 2 / whole_h
        gain[(n < leaf_rows) | (whole_n - n < leaf_rows) | ~np.isfinite(gain)] = -np.inf
        gain, n = gain.reshape(len(tables), -1), n.reshape(len(tables), -1)
        top, all_n = gain.argmax(axis=1), whole_n[:, 0, 0]
        return [(float(gain[i, at]), int(columns[at // BINS]), int(at % BINS), bool(2 * n[i, at] <= all_n[i])) for i, at in enumerate(top)]

    # Of each node found so far: its split, its depth, its first child once it has been tried, rows and histograms until then.
    splits, depth, child, held, tables = [], [], [], [], []

    def add(parts: list[np.ndarray], found: np.ndarray, depths: list[int]) -> None:
        splits.extend(best(found))
        depth.extend(depths)
        child.extend([-1] * len(parts))
        held.extend(parts)
        tables.extend(found)

    root = [np.arange(len(codes))]
    add(root, sums(root), [0])
    while True:
        order, fresh, waiting = [], [], [(-splits[0][0], 0)]
        while waiting and len(order) + 1 < leaves:
            loss_of, node = heapq.heappop(waiting)
            if -loss_of <= 1e-9 or depth[node] >= DEEPEST:
                continue
            order.append(node)
            if child[node] < 0:
                fresh.append(node)
            else:
                for side in (child[node], child[node] + 1):
                    heapq.heappush(waiting, (-splits[side][0], side))
        if not fresh:  # every split of the tree is known; a node left out before had too many better ones
            break
        fresh = fresh if eager else fresh[:-(-len(fresh) // 4)]
        sides, small = [], []
        for node in fresh:
            _, f, cut, fewer_left = splits[node]
            goes = codes[held[node], f] <= cut
            sides += [held[node][goes], held[node][~goes]]
            small.append(0 if fewer_left else 1)
        counted = sums([sides[2 * i + s] for i, s in enumerate(small)])
        both = np.empty((2 * len(fresh), *counted.shape[1:]), np.int64)
        for i, (node, s) in enumerate(zip(fresh, small)):
            both[2 * i + s], both[2 * i + 1 - s] = counted[i], tables[node] - counted[i]
            child[node], held[node], tables[node] = len(splits) + 2 * i, None, None
        add(sides, both, [depth[node] + 1 for node in fresh for _ in range(2)])

    feature, cuts, left, right, place = [-1], [0], [0], [0], {0: 0}
    for node in order:
        at, _ = place[node], place.update({child[node]: len(feature), child[node] + 1: len(feature) + 1})
        feature[at], cuts[at], left[at], right[at] = splits[node][1], splits[node][2], len(feature), len(feature) + 1
        for own, value in ((feature, -1), (cuts, 0), (left, 0), (right, 0)):
            own += [value, value]
    leaf = np.zeros(len(codes), np.int64)
    for node, at in place.items():
        if feature[at] < 0:
            below = [node]
            while below:
                node = below.pop()
                if child[node] < 0:
                    leaf[held[node]] = at
                else:  # tried, but not split in the end
                    below += [child[node], child[node] + 1]
    return Tree(*[np.array(x, np.int64) for x in (feature, cuts, left, right)], np.zeros(len(feature))), leaf


def leaf_values(loss: Loss, leaf: np.ndarray, size: int, y: np.ndarray, margin: np.ndarray, gather: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The value of each of ``size`` nodes from the rows of all tasks: the exact quantile of its residuals, found by narrowing the
    range it lies in, or a Newton step; 0 for a node without rows."""
    out = np.zeros(size)
    if loss.quantile is None:
        g, h = gather(np.stack([np.bincount(leaf, np.round(x * UNIT), size) for x in loss.response(y, margin)]).astype(np.int64)).sum(axis=0) / UNIT
        np.divide(g, np.maximum(h, 1e-9), out=out, where=h > 0)
        return out
    step = np.clip(np.round((y - margin) * GRID), -HALF, HALF - 1).astype(np.int64)
    keys = np.sort((leaf << 40) + step + HALF)
    total = gather(np.bincount(leaf, minlength=size)).sum(axis=0)
    used = np.flatnonzero(total)
    place = loss.quantile * (total[used] - 1)
    rank = np.floor(place).astype(np.int64)
    base = (used << 40) + HALF
    begin, end = np.searchsorted(keys, base - HALF), np.searchsorted(keys, base + HALF)
    own = begin < end
    low, high = np.full(len(used), HALF), np.full(len(used), -HALF)
    low[own], high[own] = keys[begin[own]] - base[own], keys[end[own] - 1] - base[own]
    ends = gather(np.stack([low, high]))
    low, high = ends[:, 0].min(axis=0), ends[:, 1].max(axis=0)
    while (low < high).any():
        probes = low[:, None] + (high - low)[:, None] * np.arange(PROBES) // PROBES
        upto = gather(np.searchsorted(keys, base[:, None] + probes, "right") - begin[:, None]).sum(axis=0)
        enough = upto > rank[:, None]
        first, rows = np.where(enough.any(axis=1), enough.argmax(axis=1), PROBES), np.arange(len(used))
        high = np.where(first < PROBES, probes[rows, np.minimum(first, PROBES - 1)], high)
        low = np.where(first > 0, probes[rows, first - 1] + 1, low)
    # The residual after it in order: itself, if it has rows enough, or the next one any task has.
    after = np.searchsorted(keys, base + low, "right")
    following = np.full(len(used), HALF)
    following[after < end] = keys[after[after < end]] - base[after < end]
    both = gather(np.stack([after - begin, following]))
    upper = np.where(both[:, 0].sum(axis=0) > rank + 1, low, both[:, 1].min(axis=0))
    part = place - rank
    out[used] = np.where(part > 0, (1 - part) * low + part * upper, low) / GRID
    return out


@dataclass
class Forest:
    """Trees per loss over binned features; ``edges`` holds the upper ends of each feature's bins but the last."""

    names: list[str]
    edges: list[list[float]]
    losses: list[float | None]
    start: list[float]
    trees: list[list[Tree]] = field(default_factory=list)
    #: Validation errors per loss and round; the first is that of the constant.
    errors: list[list[float]] = field(default_factory=list)

    def codes(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def margins(self, codes: np.ndarray) -> np.ndarray:
        """Rows x losses."""
        out = np.repeat(np.array([self.start]), len(codes), axis=0)
        for k, trees in enumerate(self.trees):
            for tree in trees:
                out[:, k] += tree.value[tree.leaf(codes)]
        return out

    def dump(self) -> str:
        return json.dumps({"names": self.names, "edges": self.edges, "losses": self.losses, "start": self.start, "errors": self.errors,
                           "trees": [[t.lists() for t in trees] for trees in self.trees]})

    @staticmethod
    def parse(text: str) -> Forest:
        had = json.loads(text)
        return Forest(had["names"], had["edges"], had["losses"], had["start"], [[Tree.of(t) for t in trees] for trees in had["trees"]], had["errors"])

    def save(self, store: TableStore, name: str) -> None:
        """As a version of the table ``name``; a reader sees this model or the one before it."""
        store.replace(name, store.spark.createDataFrame([(self.dump(),)], "model string"))

    @staticmethod
    def load(store: TableStore, name: str) -> Forest:
        return Forest.parse(store.read(name).first()["model"])

    def best(self) -> Forest:
        """Each loss with its trees up to the round of the lowest validation error; all of them without such errors."""
        kept = [trees[:int(np.argmin(e))] if len(e) else trees for trees, e in zip(self.trees, self.errors)]
        return Forest(self.names, self.edges, self.losses, self.start, kept, self.errors)

    def coder(self, spark: SparkSession) -> Callable:
        """A function from a column of arrays to their codes, a byte per feature."""
        shared = spark.sparkContext.broadcast(Forest(self.names, self.edges, self.losses, self.start))

        @F.pandas_udf("binary")
        def coded(values: pd.Series) -> pd.Series:
            return pd.Series([row.tobytes() for row in shared.value.codes(np.stack(values.to_list()))] if len(values) else [], dtype=object)

        return coded

    def predict(self, rows: DataFrame, keep: list[str], features: str = "features") -> DataFrame:
        """``keep`` and ``margins``, an array with one number per loss, for all rows with a vector ``features``.

        Rows are dealt to all cores as codes: looking through the trees takes far longer, and a small table may lie in one file.
        """
        spark = rows.sparkSession
        shared = spark.sparkContext.broadcast(self)  # rounds x leaves numbers

        @F.pandas_udf("array<double>")
        def margins(codes: pd.Series) -> pd.Series:
            if not len(codes):
                return pd.Series([], dtype=object)
            model = shared.value
            return pd.Series(list(model.margins(np.frombuffer(b"".join(codes), np.uint8).reshape(-1, len(model.names)))))

        coded = rows.select(*keep, self.coder(spark)(vector_to_array(F.col(features))).alias("_codes"))
        return coded.repartition(spark.sparkContext.defaultParallelism).select(*keep, margins("_codes").alias("margins"))


def quantile_edges(values: np.ndarray) -> list[list[float]]:
    """Upper ends of at most ``BINS`` bins of each column of a sample: its values where they are few, else quantiles."""
    out = []
    for column in values.T:
        distinct = np.unique(column)
        ends = distinct[:-1] if len(distinct) <= BINS else np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
        out.append(ends.tolist() or [0.0])
    return out


def exact_edges(vectors: DataFrame, width: int) -> list[list[float]]:
    """:func:`quantile_edges` of all rows of ``vectors`` (v, an array), from counts of distinct values in ranges."""
    counts = vectors.select(F.posexplode("v").alias("f", "x")).groupBy("f", "x").agg(F.count(F.lit(1)).alias("n"))
    ranges = stage(counts.repartitionByRange("f", "x").withColumn("part", F.spark_partition_id()), "values")
    # A row per feature and range.
    sums = ranges.groupBy("f", "part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).orderBy("f", "part").collect()
    total, distinct, before = [0] * width, [0] * width, []
    for r in sums:
        before.append((r.f, r.part, total[r.f]))
        total[r.f] += r.n
        distinct[r.f] += r.distinct
    few = [f for f in range(width) if distinct[f] <= BINS]
    out = [set() for _ in range(width)]
    for r in ranges.where(F.col("f").isin(few)).select("f", "x").collect():  # at most BINS values of a feature
        out[r.f].add(r.x)
    out = [sorted(v)[:-1] for v in out]
    if len(few) < width:
        offsets = vectors.sparkSession.createDataFrame([(f, p, b, total[f]) for f, p, b in before if f not in few], "f int, part int, before long, total long")
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("f", "part").orderBy("x"))
        placed = ranges.join(F.broadcast(offsets), ["f", "part"]).withColumn("upto", upto)

        def passed(rows: str) -> str:  # of the BINS - 1 places floor((total - 1) * i / BINS), how many come before
            return f"least({BINS - 1}, greatest(1, ({BINS} * ({rows}) + total - 2) div (total - 1)) - 1)"

        for r in placed.where(f"{passed('upto')} > {passed('upto - n')}").select("f", "x").orderBy("f", "x").collect():  # at most BINS - 1 of a feature
            out[r.f].append(r.x)
    return [ends or [0.0] for ends in out]


def _added(recent: Forest, codes: np.ndarray, margins: np.ndarray) -> np.ndarray:
    """``margins`` with the trees of ``recent`` put on."""
    return margins + recent.margins(codes) - np.array(recent.start)


def _columns(losses: list) -> list[str]:
    """The margin columns, one per loss."""
    return [f"m{k}" for k in range(len(losses))]


def _larger(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches put together to about ``BLOCK`` rows: a tree costs as much a node as a row."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= BLOCK:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _arrays(batch: pd.DataFrame, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer(b"".join(batch["codes"]), np.uint8).reshape(-1, len(forest.names))
    return codes, batch["y"].to_numpy(float), batch[_columns(forest.losses)].to_numpy(float)


def renewed(rows: DataFrame, recent: Forest) -> DataFrame:
    """All rows with their margins after the trees of a turn, in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(recent)  # the trees of one turn

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _larger(batches):
            codes, _, before = _arrays(batch, shared.value)
            batch[_columns(shared.value.losses)] = _added(shared.value, codes, before)
            yield batch

    return rows.mapInPandas(run, rows.schema)


def round_errors(rows: DataFrame, recent: Forest) -> list[list[float]]:
    """Mean validation error per loss: at the margins of ``rows``, and after each tree of ``recent``.

    Whole parts and fractions (in steps of 1 / UNIT) are added as whole numbers, so means do not depend on the order of rows.
    """
    shared = rows.sparkSession.sparkContext.broadcast(recent)
    losses = [Loss(q) for q in recent.losses]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            codes, y, margins = _arrays(batch, model)
            out = []
            for k, loss in enumerate(losses):
                for j, tree in enumerate([None, *model.trees[k]]):
                    if tree is not None:
                        margins[:, k] += tree.value[tree.leaf(codes)]
                    errors = loss.errors(y, margins[:, k])
                    fine = np.isfinite(errors)
                    whole = np.floor(errors[fine])
                    fraction = np.round((errors[fine] - whole) * UNIT)
                    out.append((k, j, int(whole.astype(np.int64).sum()), int(fraction.astype(np.int64).sum()), int((~fine).sum()), len(y)))
            yield pd.DataFrame(out, columns=["loss", "tree", "whole", "fraction", "none", "n"]).astype({"loss": "int32", "tree": "int32"})

    found = (rows.where("is_val").select("codes", "y", *_columns(losses))
             .mapInPandas(run, "loss int, tree int, whole long, fraction long, none long, n long"))
    means = {(r.loss, r.tree): float("nan") if r.none else (r.whole + r.fraction / UNIT) / r.n
             for r in found.groupBy("loss", "tree").agg(*[F.sum(c).alias(c) for c in ("whole", "fraction", "none", "n")]).collect()}
    return [[means[k, j] for j in range(len(recent.trees[k]) + 1)] if (k, 0) in means else [] for k in range(len(losses))]


def drawn(keys: np.ndarray, *numbers: int) -> np.ndarray:
    """Which rows a tree sees: ``ROW_SHARE`` of them, by a hash of the key and the numbers."""
    z = keys.astype(np.int64).view(np.uint64) ^ np.uint64(np.random.default_rng(list(numbers)).integers(1 << 63))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(ROW_SHARE * 2 ** 64))


def _slots(spark: SparkSession) -> int:
    """Tasks that run at the same time; a barrier stage may have no more."""
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def _grown(rows: DataFrame, n_train: int, forest: Forest, upto: dict[int, int], leaves: int, leaf_rows: int, seed: int) -> list[list[Tree]]:
    """A turn's trees on all training rows, those of a loss up to the round ``upto``; a stage for each loss, side by side."""
    spark = rows.sparkSession
    tasks = min(_slots(spark), -(-n_train // SAMPLE)) if n_train > SAMPLE else 1

    def trees(k: int) -> list[Tree]:
        begin, end, loss, width = len(forest.trees[k]), upto[k], Loss(forest.losses[k]), len(forest.names)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            keys, codes, y, margin = [np.zeros(0, np.int64)], [np.zeros((0, width), np.uint8)], [np.zeros(0)], [np.zeros(0)]
            for batch in batches:
                keys.append(batch["key"].to_numpy())
                codes.append(np.frombuffer(b"".join(batch["codes"]), np.uint8).reshape(-1, width))
                y.append(batch["y"].to_numpy(float))
                margin.append(batch["margin"].to_numpy(float))
            keys, codes, y, margin = (np.concatenate(x) for x in (keys, codes, y, margin))
            made, gather = [], gathered if tasks > 1 else lambda part: part[None]
            for at in range(begin, end):
                columns = np.sort(np.random.default_rng([seed, k, at]).permutation(width)[:max(1, round(COLUMN_SHARE * width))])
                tree, leaf = split_sample(codes, y, margin, loss, drawn(keys, seed, k, at), columns, leaves, leaf_rows, gather, tasks > 1)
                tree.value = STEP * leaf_values(loss, leaf, len(tree.feature), y, margin, gather)
                margin += tree.value[leaf]
                made.append(tree.lists())
            if TaskContext.get().partitionId() == 0:  # all tasks have the same trees
                yield pd.DataFrame({"trees": [json.dumps(made)]})

        known = rows.where("NOT is_val AND y IS NOT NULL").select("key", "codes", "y", F.col(f"m{k}").alias("margin"))
        found = known.repartition(tasks, "key").mapInPandas(run, "trees string", barrier=tasks > 1).collect()  # the trees of a turn
        return [Tree.of(t) for t in json.loads(found[0].trees)] if found else []

    with ThreadPoolExecutor(len(upto)) as pool:
        grown = dict(zip(upto, pool.map(inheritable_thread_target(spark)(trees), upto)))
    return [grown.get(k, []) for k in range(len(forest.losses))]


def boost(matrix: DataFrame, names: list[str], label: str, losses: list[float | None], rounds: int, patience: int, leaves: int, leaf_rows: int,
          seed: int = 42, path: str | None = None) -> Forest:
    """Fits one forest per loss on ``matrix`` (id, date, features, is_val or no such column, ``label``).

    A loss stops when its validation error has not fallen for ``patience`` rounds; without validation rows it takes all ``rounds``.
    With a ``path`` the state lies there: a call that finds one goes on with it, and ``rounds`` may be raised later.
    """
    spark = matrix.sparkSession
    own = path or new_path(spark, "boosting")
    store = TableStore(spark, own)
    if store.exists("state"):
        state = store.read("state").first()
        forest, turn = Forest.parse(state["model"]), state["turn"]
    else:
        val = F.col("is_val") if "is_val" in matrix.columns else F.lit(False)
        plain = matrix.select("features", F.col(label).cast("double").alias("y"), val.alias("is_val"), F.xxhash64("id", "date", F.lit(seed)).alias("key"))
        train = plain.where("NOT is_val")
        edges = exact_edges(train.select(vector_to_array("features").alias("v")), len(names))
        forest = Forest(names, edges, list(losses), [Loss(q).start(train) for q in losses], [[] for _ in losses], [[] for _ in losses])
        start = [F.lit(float(x)).alias(c) for x, c in zip(forest.start, _columns(losses))]
        first = plain.select("y", "is_val", "key", forest.coder(spark)(vector_to_array("features")).alias("codes"), *start)
        turn = 0
        # At least a part per core: every round reads them.
        if not store.replace("margins_0", first.repartition(max(first.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism), "key")):
            return forest
        if path is not None:
            _remember(store, forest, turn)
    rows = store.read(f"margins_{turn}")
    sizes = {r["is_val"]: r["n"] for r in rows.groupBy("is_val").agg(F.count("y").alias("n")).collect()}
    n_train = sizes.get(False, 0)

    def active(k: int) -> bool:
        e = forest.errors[k]
        return len(forest.trees[k]) < rounds and not (len(e) and len(e) - 1 - int(np.argmin(e)) >= patience)

    while n_train and any(active(k) for k in range(len(losses))):
        upto = {k: min(rounds, len(forest.trees[k]) + TURN) for k in range(len(losses)) if active(k)}
        recent = Forest(names, forest.edges, forest.losses, forest.start, _grown(rows, n_train, forest, upto, leaves, leaf_rows, seed))
        for k, trees in enumerate(recent.trees):
            forest.trees[k] += trees
        for k, errors in enumerate(round_errors(rows, recent) if sizes.get(True) else []):
            forest.errors[k] += errors[1:] if forest.errors[k] else errors
        if path is None and not any(active(k) for k in range(len(losses))):
            break
        store.replace(f"margins_{turn + 1}", renewed(rows, recent))
        turn += 1
        if path is not None:
            _remember(store, forest, turn)
        rows = store.read(f"margins_{turn}")
        discard(spark, f"{own}/margins_{turn - 1}")
    if path is None:
        discard(spark, own)
    return forest


def _remember(store: TableStore, forest: Forest, turn: int) -> None:
    store.replace("state", store.spark.createDataFrame([(forest.dump(), turn)], "model string, turn int"))


def permutation_importance(spark: SparkSession, forest: Forest, rows: DataFrame, loss: int = 0, blocks: int | None = None) -> DataFrame:
    """(feature, importance): how much the mean error rises when a feature takes another series' value of the same day.

    ``rows`` has id, date, y and features.  Within a day, and a block of it, rows stand in order of a hash of the id, and each takes
    the value of the next, the last that of the first; so every permuted column keeps a day's values, and the result repeats.
    All features are permuted in one pass; a task holds one batch of rows at a time.  Blocks have about 4,096 rows unless their number is given.
    """
    if blocks is None:
        n, days = rows.agg(F.count(F.lit(1)), F.count_distinct("date")).first()
        blocks = max(1, n // max(1, days) // 4096)
    order = F.xxhash64("id", F.lit("permute"))
    near = Window.partitionBy("date", "block").orderBy("key", "id")
    whole = Window.partitionBy("date", "block").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    paired = (rows.select("id", "date", "y", vector_to_array("features").alias("own"), order.alias("key"), F.pmod(order, F.lit(blocks)).alias("block"))
              .withColumn("other", F.coalesce(F.lead("own").over(near), F.first("own").over(whole))).select("y", "own", "other"))
    shared = spark.sparkContext.broadcast(forest)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        measure = Loss(model.losses[loss])
        only = Forest(model.names, model.edges, [model.losses[loss]], [model.start[loss]], [model.trees[loss]])
        for batch in batches:
            if not len(batch):
                continue
            y, own, other = batch["y"].to_numpy(float), only.codes(np.stack(batch["own"].to_list())), only.codes(np.stack(batch["other"].to_list()))
            plain, out = measure.error(y, only.margins(own)[:, 0]), []
            for i, name in enumerate(model.names):
                mixed = own.copy()
                mixed[:, i] = other[:, i]
                out.append((name, measure.error(y, only.margins(mixed)[:, 0]) - plain, len(y)))
            yield pd.DataFrame(out, columns=["feature", "more", "n"])

    found = paired.mapInPandas(run, "feature string, more double, n long")
    return found.groupBy("feature").agg((F.sum("more") / F.sum("n")).alias("importance"))
