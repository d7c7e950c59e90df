"""Near duplicates by SimHash fingerprints, linked through vantage-point trees.

A fingerprint has 64 bits.  Fingerprints at ``radius`` bits or fewer are linked, and documents that
links connect are one component.

Finding the links: a vantage-point tree is built on a bounded sample of the distinct fingerprints.
Each node has a vantage point and a distance ``mu``; a fingerprint at distance d goes inside when
d <= mu and outside when d > mu - radius, so both when it lies in that shell.  By the triangle
inequality two fingerprints within the radius always share a side, so every linked pair meets in
some leaf: leaves are shards that need no other shard.  In a shard the same splitting goes on until a
few hundred fingerprints are left, which are compared in blocks.  A shard reports only a spanning
forest of its links, so copies and near copies by the thousand give as many rows, not pairs.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and are linked
like others; fewer words than a shingle make one shingle; repeated rows have equal fingerprints; a
component's id is its smallest doc_id, null if it has none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import mix, table, text_bytes, whole_rows
from shelfcast.llm.components import components
from shelfcast.sources.staging import stage

#: Fingerprints in the sample that shapes the tree, and aimed at in a leaf.
SAMPLE, LEAF = 1 << 15, 2048
_BLOCK = 256


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """64 bits, each set if it is set in over half of the shingles' XXH64 (seed 42)."""
    from xxhash import xxh64_intdigest
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    counts, n = np.zeros(64, np.int64), max(1, len(words) - shingle + 1)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    begin = [0, *(ends[:-1] + 1).tolist()]
    stop = ends[min(shingle, len(words)) - 1:].tolist()
    for a in range(0, n, 1 << 15):
        hashes = np.array([xxh64_intdigest(joined[i:j], 42) for i, j in zip(begin[a:min(n, a + (1 << 15))], stop[a:a + (1 << 15)])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, keys: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the long columns ``keys``, and ``fp``, the fingerprint as a signed long."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), **{k: batch[k] for k in keys}, "fp": found.view(np.int64)})

    kinds = "".join(f"{k} long, " for k in keys)
    return docs.select("doc_id", *keys, text_bytes().alias("text")).mapInPandas(run, f"doc_id long, {kinds}fp long")


def _split(points: np.ndarray, tries: int = 6) -> tuple[int, int] | None:
    """A vantage point and mu that put about half of ``points`` on each side; None if no point does."""
    best, found = 0.0, None
    for vantage in points[mix(np.arange(tries, dtype=np.uint64)) % np.uint64(len(points))]:
        d = np.bitwise_count(points ^ vantage)
        sizes = np.cumsum(np.bincount(d, minlength=65)) / len(points)
        mu = int(np.argmin(np.abs(sizes - 0.5)))
        even = min(sizes[mu], 1 - sizes[mu])
        if even > best:
            best, found = even, (int(vantage), mu)
    return found if best >= 0.02 else None


class Tree:
    """Node arrays of a vantage-point tree; a child below zero is leaf -child - 1."""

    def __init__(self, sample: np.ndarray, leaf: int, radius: int):
        self.radius = radius
        self.vantage, self.mu, self.children, self.leaves = [], [], [], 0
        self._grow(sample, max(1, leaf))

    def _grow(self, points: np.ndarray, leaf: int) -> int:
        split = _split(points) if len(points) > leaf else None
        if split is None:
            self.leaves += 1
            return -self.leaves
        node = len(self.vantage)
        self.vantage.append(split[0])
        self.mu.append(split[1])
        self.children.append([0, 0])
        d = np.bitwise_count(points ^ np.uint64(split[0]))
        self.children[node] = [self._grow(points[d <= split[1]], leaf), self._grow(points[d > split[1]], leaf)]
        return node

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each leaf a point belongs to: the point's place in ``points`` and the leaf."""
        at, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        if not self.vantage:
            return at, node
        vantage, mu, children = np.array(self.vantage, np.uint64), np.array(self.mu), np.array(self.children)
        done_at, done_leaf = [], []
        while len(at):
            d = np.bitwise_count(points[at] ^ vantage[node]).astype(np.int64)
            inside, outside = d <= mu[node], d > mu[node] - self.radius
            at, node = np.concatenate([at[inside], at[outside]]), np.concatenate([children[node[inside], 0], children[node[outside], 1]])
            leaf = node < 0
            done_at.append(at[leaf])
            done_leaf.append(-node[leaf] - 1)
            at, node = at[~leaf], node[~leaf]
        return np.concatenate(done_at), np.concatenate(done_leaf)


def _pairs(points: np.ndarray, at: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within the radius, some more than once, by the same splitting."""
    todo = [at]
    while todo:
        at = todo.pop()
        own = points[at]
        split = _split(own) if len(at) > 2 * _BLOCK else None
        if split is not None:
            d = np.bitwise_count(own ^ np.uint64(split[0])).astype(np.int64)
            inside, outside = at[d <= split[1]], at[d > split[1] - radius]
            if max(len(inside), len(outside)) < 0.95 * len(at):
                todo += [inside, outside]
                continue
        for a in range(0, len(at), _BLOCK):
            near = np.bitwise_count(own[a:a + _BLOCK, None] ^ own[None, a:]) <= radius
            i, j = np.nonzero(near)
            keep = j > i
            yield at[a + i[keep]], at[a + j[keep]]


def forest(points: np.ndarray, radius: int) -> np.ndarray:
    """For each distinct point the least place reachable from it by links among the points."""
    root = np.arange(len(points))
    for i, j in _pairs(points, np.arange(len(points)), radius):
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := root[root], root):
                root = up
    return root


def links(classes: DataFrame, radius: int, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) that connect the classes ``(fp, rep)`` whose fingerprints are within the radius."""
    spark = classes.sparkSession
    n = classes.count()
    # The sample, by hash, shapes the shards only; every fingerprint is routed.
    rate = min(1.0, sample / max(1, n))
    part = classes.where(F.pmod(F.xxhash64("fp", F.lit("tree")), F.lit(1 << 30)) < int(rate * (1 << 30)) + 1).select("fp").limit(2 * sample)
    shape = np.sort(np.array([r.fp for r in part.collect()], np.int64)).view(np.uint64)
    tree = spark.sparkContext.broadcast(Tree(shape, int(leaf * rate) if rate < 1 else leaf, radius))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, where = tree.value.route(batch["fp"].to_numpy().view(np.uint64))
            yield pd.DataFrame({"leaf": where, "fp": batch["fp"].to_numpy()[at], "rep": batch["rep"].to_numpy()[at]})

    def connect(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("rep")
        rep = shard["rep"].to_numpy()
        root = forest(shard["fp"].to_numpy().view(np.uint64), radius)
        moved = root != np.arange(len(root))
        return pd.DataFrame({"u": rep[moved], "v": rep[root[moved]]})

    routed = classes.select("fp", "rep").mapInPandas(route, "leaf long, fp long, rep long")
    return routed.groupBy("leaf").applyInPandas(connect, "u long, v long")


def linked(found: DataFrame, radius: int) -> DataFrame:
    """(fp, component, component_id) of all fingerprints of ``found`` (doc_id, fp): a number, and the smallest doc_id if there is one."""
    # Equal fingerprints are one class, known by its smallest doc_id; without any, by a number below all ids.
    unnamed = -F.abs(F.shiftright(F.xxhash64("fp"), 2)) - F.lit(1 << 62)
    classes = stage(found.groupBy("fp").agg(F.min("doc_id").alias("least"))
                    .select("fp", "least", F.coalesce("least", unnamed).alias("rep")), "classes")
    joined = components(links(classes, radius))
    named = classes.join(joined, classes["rep"] == joined["node"], "left").select("fp", F.coalesce("component", "rep").alias("component"))
    # A class that has no doc_id at all can be the least of a component; the name must be a doc_id.
    if classes.where("least IS NULL").isEmpty():
        return named.withColumn("component_id", F.col("component"))
    named = stage(named.join(classes, "fp"), "named")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(names, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    found = stage(fingerprints(docs, shingle), "fingerprints")
    named = linked(found, radius).drop("component")
    return found.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest doc_id, then of the least hash of the row.

    Rows without a doc_id come last in their component; rows equal in every column leave one.  Each text is moved once.
    """
    # 128 bits of a row; nulls leave a hash as it is, so they are counted apart.
    told = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    nulls = [F.col(f"row.`{c}`").isNull() for c in told]
    values = [F.col(f"row.`{c}`") for c in told]
    keyed = whole_rows(docs, "doc_id", "text").select("*", F.xxhash64(*nulls, *values).alias("a"), F.xxhash64(F.lit("b"), *reversed(values), *nulls).alias("b"))
    found = stage(fingerprints(keyed, shingle, ("a", "b")), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "a", "b")
    # Least rows are found per fingerprint first, so the join has one row of each.
    least = found.groupBy("fp").agg(F.min(first).alias("first"))
    kept = stage(least.join(linked(found, radius), "fp").groupBy("component").agg(F.min("first").alias("first")).select("first.a", "first.b"), "kept")
    repeated = stage(found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b").join(kept, ["a", "b"], "left_semi"), "repeated")
    rows = keyed.select("row", "a", "b")
    if repeated.isEmpty():
        return rows.join(kept, ["a", "b"], "left_semi").select("row.*")
    alone = rows.join(kept.join(repeated, ["a", "b"], "left_anti"), ["a", "b"], "left_semi")
    return alone.unionByName(rows.join(repeated, ["a", "b"], "left_semi").dropDuplicates(["a", "b"])).select("row.*")


def op1_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``: 3-word shingles, 2 bits."""
    return near_duplicates(table(spark, sf_dir, "documents"))
