"""Hard negatives for anchors: rows of another label whose inner product lies in a window below a positive's.

Candidates are distinct (label, vector) classes.  They stand in a cover tree per label and dimension: a level deals the classes of
a node that holds too many to the nearest of a few of its vectors, found farthest-first on a bounded sample, and keeps, per child, how far
its members reach.  Distances are taken after one more coordinate has given all vectors of a node the same norm, so
that distance falls as the inner product grows and a node's covering radius bounds its members' inner products from
both sides.  The levels above are tables that anchors descend by joins, leaving out nodes outside their windows; a leaf holds at most
``LEAF`` classes and goes on as a tree in memory, descended best first by a block of anchors, each only where it must, with rows verified by exact integer products.
An anchor visits its most promising leaf first; what it finds there leaves most of the others out.

Labels are few: an anchor starts at the root of every other label.  Anchors with one label and vector search once.  Of equal vectors with one label only the least ids are kept, as many as can be
returned: more cannot appear in a result.

Defined cases: rows without an id, label or vector, or with a null or non-finite component, take no part, nor do vectors whose integer
components' squares sum to 2^62 or more, whose products a long cannot hold; vectors of another length than an anchor's are no
candidates of it; of rows that share a vec_id the least by label and vector counts; empty vectors have product 0 with each other; ties go to
the smaller vec_id; windows are empty for negative positives; an empty table gives no rows; columns other than the three named are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import table
from shelfcast.sources.staging import stage

#: Classes in a leaf, children of a node, rows of the sample that shapes a node, levels split by distance, and anchors a leaf meets at once.
LEAF, FANOUT, SAMPLE, LEVELS, QUERIES = 8192, 24, 1024, 8, 1024
#: Rows of an in-memory node that are verified together.
FEW = 32
#: Ends of a window without ends.
LEAST, MOST = -2 ** 63, 2 ** 63 - 1
FOUND = "rep long, window int, score long, vec_id long"


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the rows that take part; v holds floor(256 x)."""
    numbers = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.ceil(F.abs(256 * x.cast("double"))).cast("double"), 2.0))
    known = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite).where(squares < 2.0 ** 62)
    return (known.select(F.col("vec_id").cast("long"), F.struct(F.col("label").cast("long").alias("label"), numbers.alias("v")).alias("r"))
            .groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.*"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows; in doubles where these are exact, which is faster."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0 ** 52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def bounds(score, q2, c2, least, most, reach):
    """Bounds of the inner product of a query with the members of nodes, from the product with the nodes' centres.

    ``q2`` and ``c2`` are squared norms, ``least`` and ``most`` those of a node's members, ``reach`` the largest squared distance
    from the centre.  With squared norm ``most`` reached by one more coordinate, a member is at most ``radius`` away.
    """
    most = np.maximum(most, c2)
    own = np.sqrt(np.maximum(most - c2, 0))
    radius = np.sqrt(reach + np.maximum((np.sqrt(np.maximum(most - least, 0)) - own) ** 2, own ** 2)) * (1 + 1e-9)
    away = np.sqrt(np.maximum(q2 + most - 2.0 * score, 0))
    slack = 1e-9 * (q2 + most) + 1
    high = (q2 + most - np.maximum(away * (1 - 1e-9) - radius, 0) ** 2) / 2 + slack
    low = (q2 + most - (away * (1 + 1e-9) + radius) ** 2) / 2 - slack
    # Members differ from the centre by at most the root of ``reach``.
    turn = np.sqrt(np.asarray(q2, float) * reach) * (1 + 1e-9) + slack
    return np.maximum(low, score - turn), np.minimum(high, score + turn)


def spread(points: np.ndarray, n: int) -> np.ndarray:
    """Places of up to ``n`` distinct points, each the farthest from those before it."""
    x = points.astype(float)
    square = (x * x).sum(axis=1)
    at, away = 0, np.full(len(x), np.inf)
    chosen = []
    while len(chosen) < n:
        chosen.append(at)
        away = np.minimum(away, square + square[at] - 2 * (x @ x[at]))
        away[chosen] = 0
        at = int(np.argmax(away))
        if away[at] <= 0:
            break
    return np.array(chosen)


class CoverTree:
    """Nodes over the rows of one leaf: centre, reach and norms of the members, and children or a few members."""

    def __init__(self, points: np.ndarray):
        self.points, self.x = points, points.astype(float)
        self.square = (self.x * self.x).sum(axis=1)
        self.centre, self.reach, self.least, self.most, self.below = [], [], [], [], []
        self.grow(np.arange(len(points)))

    def grow(self, members: np.ndarray) -> int:
        node = len(self.centre)
        chosen = members[spread(self.x[members], FANOUT if len(members) > FEW else 1)]
        away = self.square[members, None] + self.square[chosen] - 2 * (self.x[members] @ self.x[chosen].T)
        for kept, value in ((self.centre, chosen[0]), (self.reach, max(0.0, away[:, 0].max())), (self.least, self.square[members].min()),
                            (self.most, self.square[members].max()), (self.below, None)):
            kept.append(value)
        if len(chosen) == 1:  # few, or all in one place up to rounding
            self.below[node] = (True, members)
        else:
            nearest = away.argmin(axis=1)
            nearest[np.searchsorted(members, chosen)] = np.arange(len(chosen))
            self.below[node] = (False, np.array([self.grow(members[nearest == i]) for i in range(len(chosen))]))
        return node

    def search(self, queries: np.ndarray, best: Best) -> np.ndarray:
        """Descends for a block of queries; ``best`` takes verified rows and closes its windows.  Returns how many rows each query met.

        A node's children follow by the highest bound that any query of the block still has for them; a query goes along
        only where a child may hold rows of one of its windows as they stand then.
        """
        x = queries.astype(float)
        square, met = (x * x).sum(axis=1), np.zeros(len(queries), np.int64)

        def down(node: int, who: np.ndarray) -> None:
            few, below = self.below[node]
            if few:
                met[who] += len(below)
                best.take(who, below, products(queries[who], self.points[below]))
                return
            at = [self.centre[i] for i in below]
            least, most, reach = (np.array([kept[i] for i in below]) for kept in (self.least, self.most, self.reach))
            low, high = bounds(x[who] @ self.x[at].T, square[who, None], self.square[at], least, most, reach)
            for i in np.argsort(-high.max(axis=0), kind="stable"):
                along = best.open(who, low[:, i], high[:, i])
                if along.any():
                    down(int(below[i]), who[along])

        if len(queries):
            down(0, np.arange(len(queries)))
        return met


class Best:
    """The first ``k`` (score, id) of each window of each query found so far; windows close from below as they fill.

    ``ids`` holds, per row of the leaf, the ids of its class.  ``floors`` are scores that an earlier visit found k rows at.
    """

    def __init__(self, lows, highs, floors, ids: list, k: int):
        wide = max(map(len, lows), default=0)

        def filled(parts, empty: int) -> np.ndarray:
            return np.array([[*part, *[empty] * (wide - len(part))] for part in parts], np.int64).reshape(-1, wide)

        # Windows that a query lacks are empty: their low is above their high.
        self.low, self.high = np.maximum(filled(lows, MOST), filled(floors, MOST)), filled(highs, LEAST)
        self.k, self.wide = k, wide
        self.count = np.fromiter(map(len, ids), np.int64, len(ids))
        self.first, self.flat = np.cumsum(self.count) - self.count, np.concatenate([np.asarray(i, np.int64) for i in ids])
        # Key (query and window), score and id of what is kept.
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def open(self, who: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which queries may find a row of a window between the bounds."""
        return ((high[:, None] >= self.low[who]) & (low[:, None] <= self.high[who])).any(axis=1)

    def take(self, who: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        key, score, found = [self.key], [self.score], [self.id]
        for w in range(self.wide):
            q, c = np.nonzero((scores >= self.low[who, w][:, None]) & (scores <= self.high[who, w][:, None]))
            if not len(q):
                continue
            n = self.count[rows[c]]  # a class of equal vectors gives all its ids
            each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key.append(np.repeat(who[q] * self.wide + w, n))
            score.append(np.repeat(scores[q, c], n))
            found.append(self.flat[np.repeat(self.first[rows[c]], n) + each])
        if len(key) == 1:
            return
        key, score, found = map(np.concatenate, (key, score, found))
        order = np.lexsort((found, -score, key))
        key = key[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.key, self.score, self.id = key[place < self.k], score[kept], found[kept]
        at = key[place == self.k - 1]
        flat = self.low.reshape(-1)
        flat[at] = np.maximum(flat[at], score[last])


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(rep, label, dim, v, ids): distinct vectors of a label with their ``keep`` least ids; ``rep`` is the least."""
    # Least ids are picked in rounds of combinable minima, so a vector that a third of the rows share is never gathered.
    picked = None
    left = rows
    for _ in range(keep):
        least = left.groupBy("label", "v").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("n"))
        least = stage(least, "least")
        picked = least.drop("n") if picked is None else picked.unionByName(least.drop("n"))
        more = least.where("n > 1")
        if more.isEmpty():
            break
        left = stage(left.join(more.select("label", "v"), ["label", "v"], "left_semi").join(more.select("vec_id"), "vec_id", "left_anti"), "repeats")
    return (picked.groupBy("label", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .select(F.col("ids")[0].alias("rep"), "label", F.size("v").alias("dim"), "v", "ids"))


def salted(left: DataFrame, right: DataFrame, keys: list[str], by: str, salts: int, how: str = "inner") -> DataFrame:
    """An equal join in which rows of ``left`` with one key are dealt to ``salts`` tasks by a hash of ``by``."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def percent(score, share: int, up: int):
    """share % of a score of at least 0 in whole numbers, cut (``up`` 0) or raised (99), for any long."""
    rest = score % F.lit(100)
    return F.call_function("div", score - rest, F.lit(100)) * F.lit(share) + F.call_function("div", rest * F.lit(share) + F.lit(up), F.lit(100))


def _norm(v):
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _apart(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2.0)), F.lit(0.0), lambda s, x: s + x)


def grow(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the leaf each is in, and the nodes (parent, node, leaf, label, dim, centre, reach, least, most) of all levels.

    A node is split while it holds over ``LEAF`` rows; one still too large after ``LEVELS`` levels is dealt by hash into parts
    that each have its bounds.
    """
    now = stage(rows.withColumn("node", F.concat_ws(":", "dim", "label")), "level")
    nodes = None
    for level in range(LEVELS + 1):
        sizes = now.groupBy("node", "label", "dim").agg(F.count(F.lit(1)).alias("n"))
        if level == 0:
            unknown = [F.lit(None).cast(kind).alias(c) for c, kind in (("centre", "array<long>"), ("least", "double"), ("most", "double"), ("reach", "double"))]
            nodes = sizes.select(F.lit("").alias("parent"), "node", "n", "label", "dim", *unknown)
        large = sizes.where(F.col("n") > LEAF)
        if large.isEmpty():
            break
        share = F.pmod(F.xxhash64("v", F.lit(level)), F.col("n")) < SAMPLE
        if level == LEVELS:
            parts = salted(now, large.select("node", "n"), ["node"], "rep", 64, "left")
            child = F.concat_ws("#", "node", F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / F.lit(LEAF // 2))).cast("string"))
            now = stage(parts.withColumn("child", F.when(F.col("n").isNotNull(), child)).drop("n"), "level")
        else:
            def shape(sample: pd.DataFrame) -> pd.DataFrame:
                points = _matrix(sample.sort_values("rep")["v"])
                return pd.DataFrame({"node": [sample["node"].iloc[0]], "centres": [points[spread(points, FANOUT)].tolist()]})

            sample = salted(now, large.select("node", "n"), ["node"], "rep", 64).where(share)
            centres = stage(sample.select("node", "rep", "v").groupBy("node").applyInPandas(shape, "node string, centres array<array<long>>"), "centres")
            nearest = F.array_min(F.transform("centres", lambda c, i: F.struct(_apart(c, F.col("v")).alias("d"), i.alias("i"))))
            dealt = salted(now.drop("centre"), centres, ["node"], "rep", 64, "left").withColumn("near", nearest)
            now = stage(dealt.withColumn("child", F.when(F.col("centres").isNotNull(), F.concat_ws("/", "node", F.col("near.i").cast("string"))))
                        .withColumn("centre", F.col("centres")[F.col("near.i")]).drop("centres", "near"), "level")
        split = now.where("child IS NOT NULL")
        # Reach and norms of the children; a part dealt by hash has its own first vector as its centre.
        centre = F.first("centre") if level < LEVELS else F.min("v")
        made = split.groupBy(F.col("node").alias("parent"), F.col("child").alias("node"), "label", "dim").agg(
            F.count(F.lit(1)).alias("n"), centre.alias("centre"), F.min(_norm("v")).alias("least"), F.max(_norm("v")).alias("most"),
            *([F.max(_apart("v", "centre")).alias("reach")] if level < LEVELS else []))
        if level == LEVELS:
            far = F.pow(F.sqrt("most") + F.sqrt(_norm("centre")), 2.0)
            made = made.withColumn("reach", far)
        nodes = nodes.unionByName(stage(made, "nodes"))
        now = stage(now.withColumn("node", F.coalesce("child", "node")).drop("child"), "level")
    nodes = stage(nodes, "tree")
    inner = nodes.select(F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
    return now.select("rep", "label", "dim", "v", "ids", F.col("node").alias("leaf")), stage(
        nodes.join(inner, "node", "left").withColumn("inner", F.coalesce("inner", F.lit(False))), "tree")


@F.pandas_udf(T.StructType([T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType())]))
def _node_bounds(score: pd.Series, q2: pd.Series, c2: pd.Series, least: pd.Series, most: pd.Series, reach: pd.Series) -> pd.DataFrame:
    low, high = bounds(*(c.to_numpy(float) for c in (score, q2, c2, least, most, reach)))
    return pd.DataFrame({"low": low, "high": high})


def descend(asked: DataFrame, nodes: DataFrame, same_label: bool) -> DataFrame:
    """(rep, leaf, high): the leaves that may hold rows in a window of each asked row, with the bound from above."""
    roots = nodes.where("parent = ''").select("dim", F.col("label").alias("other"), "node", "inner")
    front = asked.select("rep", "dim", "label", "v", "lows", "highs", _norm("v").alias("q2"))
    if same_label:
        front = salted(front, roots.withColumnRenamed("other", "label"), ["dim", "label"], "rep", 16)
    else:
        front = salted(front, roots, ["dim"], "rep", 16).where("other <> label").drop("other")
    front = stage(front.withColumn("high", F.lit(float("inf"))), "front")
    leaves = None
    kids = nodes.where("parent <> ''").select(F.col("parent").alias("node"), F.col("node").alias("child"), F.col("inner").alias("more"), "centre", "least", "most", "reach")
    while True:
        ended = front.where("NOT inner").select("rep", F.col("node").alias("leaf"), "high")
        leaves = ended if leaves is None else leaves.unionByName(ended)
        front = front.where("inner")
        if front.isEmpty():
            return leaves
        found = salted(front.drop("inner", "high"), kids, ["node"], "rep", 16)
        found = found.withColumn("b", _node_bounds(_dot("v", "centre"), "q2", _norm("centre"), "least", "most", "reach"))
        inside = F.exists(F.arrays_zip("lows", "highs"), lambda w: (F.col("b.high") >= w["lows"]) & (F.col("b.low") <= w["highs"]))
        front = stage(found.where(inside).select("rep", "dim", "label", "v", "lows", "highs", "q2", F.col("child").alias("node"),
                                                 F.col("more").alias("inner"), F.col("b.high").alias("high")), "front")


def visit(pairs: DataFrame, asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(rep, window, score, vec_id): the first k of each window in the leaves of ``pairs`` (rep, leaf, floors); ``verified`` rows ride as window -1."""
    def run(key, leaf: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({c: np.zeros(0, np.int64) for c in ("rep", "window", "score", "vec_id")})
        if len(leaf) and len(queries):
            leaf, rep = leaf.sort_values("rep"), queries["rep"].to_numpy()
            best = Best(*(queries[c].tolist() for c in ("lows", "highs", "floors")), leaf["ids"].tolist(), k)
            met = CoverTree(_matrix(leaf["v"])).search(_matrix(queries["v"]), best)
            out = pd.DataFrame({"rep": np.concatenate([rep[best.key // best.wide], rep]), "window": np.concatenate([best.key % best.wide, np.full(len(rep), -1)]),
                                "score": np.concatenate([best.score, met]), "vec_id": np.concatenate([best.id, np.full(len(rep), len(leaf))])})
        return out.astype({"window": "int32"})

    told = pairs.join(asked.select("rep", "v", "lows", "highs"), "rep")
    load = stage(pairs.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).cast("int").alias("turns")), "load")
    told = told.join(load, "leaf").withColumn("turn", F.pmod(F.xxhash64("rep"), F.col("turns")).cast("int"))
    held = rows.join(load, "leaf").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    return (held.select("leaf", "turn", "rep", "v", "ids").groupBy("leaf", "turn")
            .cogroup(told.select("leaf", "turn", "rep", "v", "lows", "highs", "floors").groupBy("leaf", "turn")).applyInPandas(run, FOUND))


def _firsts(found: DataFrame, k: int) -> DataFrame:
    """(rep, window, hits): the first k of what the leaves of a row found, at most k from each; best first."""
    hits = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    return found.where("window >= 0").groupBy("rep", "window").agg(F.slice(hits, 1, k).alias("hits"))


def search(asked: DataFrame, rows: DataFrame, nodes: DataFrame, same_label: bool, k: int) -> tuple[DataFrame, DataFrame]:
    """The first k rows per window of ``asked`` (rep, dim, label, v, lows, highs), and how many rows were verified for each."""
    leaves = stage(descend(asked, nodes, same_label), "leaves")
    nearest = leaves.groupBy("rep").agg(F.max_by("leaf", F.struct("high", "leaf")).alias("leaf"))
    none = F.transform("lows", lambda x: F.lit(LEAST))
    first = stage(visit(nearest.join(asked.select("rep", none.alias("floors")), "rep"), asked, rows, k), "first_visit")
    # The k-th found so far is a floor; a window that is not full has none.
    full = _firsts(first, k).where(F.size("hits") >= k).select("rep", "window", (-F.col("hits")[k - 1]["s"]).alias("floor"))
    floors = full.groupBy("rep").agg(F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("by"))
    floors = asked.select("rep", "lows", "highs").join(floors, "rep", "left").select(
        "rep", "highs", F.transform("lows", lambda x, i: F.greatest(x, F.coalesce(F.col("by")[i], F.lit(LEAST)))).alias("floors"))
    rest = leaves.join(nearest, ["rep", "leaf"], "left_anti").join(floors, "rep").where(F.exists("floors", lambda x: F.col("high") >= x))
    found = stage(visit(rest.select("rep", "leaf", "floors"), asked, rows, k), "visits").unionByName(first)
    return _firsts(found, k), found.where("window = -1").groupBy("rep").agg(F.sum("score").alias("verified"), F.sum("vec_id").alias("met"))


def mine(embeddings: DataFrame, anchors, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Hard negatives of the rows for which the column ``anchors`` of (vec_id, label, v) holds.

    A positive is one of the first ``positives`` other rows of the anchor's label; a negative of it has low % to high % of its score.
    """
    rows = stage(vectors(embeddings), "vectors")
    keep = max(positives + 1, negatives)
    known = stage(classes(rows, keep), "classes")
    repeated = known.where(F.size("ids") > 1).select("label", F.col("v"), F.col("rep").alias("least"))
    wanted = salted(rows.where(anchors), repeated, ["label", "v"], "vec_id", 8, "left")
    wanted = stage(wanted.select(F.col("vec_id").alias("anchor_id"), F.coalesce("least", "vec_id").alias("rep")), "anchors")
    asked = stage(known.join(wanted.select("rep").distinct(), "rep", "left_semi")
                  .select("rep", "dim", "label", "v", F.array(F.lit(LEAST)).alias("lows"), F.array(F.lit(MOST)).alias("highs")), "asked")
    placed, nodes = grow(known)
    near, _ = search(asked, placed, nodes, True, positives + 1)
    near = stage(near.select("rep", F.transform("hits", lambda h: F.struct((-h["s"]).alias("score"), h["vec_id"].alias("vec_id"))).alias("hits")), "positives")
    # Windows: one per distinct score that any anchor of the vector may use.
    scores = F.array_sort(F.array_distinct(F.transform(F.filter("hits", lambda h: h["score"] >= 0), lambda h: h["score"])))
    ranged = near.select("rep", scores.alias("scores")).where(F.size("scores") > 0)
    ranged = stage(asked.drop("lows", "highs").join(ranged, "rep").select(
        "*", F.transform("scores", lambda s: percent(s, low, 99)).alias("lows"), F.transform("scores", lambda s: percent(s, high, 0)).alias("highs")), "windows")
    hard, _ = search(ranged, placed, nodes, False, negatives)
    hard = hard.join(ranged.select("rep", "scores"), "rep").select("rep", F.col("scores")[F.col("window")].alias("positive_score"), "hits")
    others = F.filter("hits", lambda h: h["vec_id"] != F.col("anchor_id"))
    pairs = (salted(wanted, near, ["rep"], "anchor_id", 8).select("anchor_id", "rep", F.explode(F.slice(others, 1, positives)).alias("p"))
             .select("anchor_id", "rep", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score")))
    return salted(pairs, hard, ["rep", "positive_score"], "anchor_id", 8).select(
        "anchor_id", "positive_id", "positive_score", F.posexplode("hits").alias("at", "h")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("h.vec_id").alias("negative_id"), "positive_score",
        (-F.col("h.s")).alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector of ``embeddings``, with a seventh of the labels shifted."""
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", shifted.alias("label"), "embedding"), F.col("vec_id") % 50 == 0)


SQL = """
WITH kept AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
near AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM near p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY rank <= 3"""
