"""Audit of how filters overlap, over sorted posting lists of failing documents.

Each document is measured once and failing marks are kept, with the document's part, as posting lists: the
documents of a part are dealt into ranges of ids, and a range keeps, per filter, the sorted places of the
documents that fail it (places in the range's own ``ids``, so rows that share an id stay apart).  Union sizes of
all sets of filters come from galloping k-way merges of a range's lists, their shares of good and toxic documents
from galloping differences; ranges are independent, so the sizes of a part are sums.  From these sums follow what
every order of the filters removes at every step.

Defined cases: null text is empty; null ``part`` values count as the empty string; equality of texts is judged by
SHA-256 over the whole table; a row without a doc_id is never a copy and makes none, and has no label; rows that
share a doc_id are rows of their own, none a copy of another; a document labelled twice is good (toxic) if any
label says so; labels without a document count nowhere; very long texts are measured whole; an empty table gives
no rows; columns other than doc_id, text and the part's are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heapreplace
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import table, text_bytes
from shelfcast.sources.staging import stage

#: Filters in bit order; the last is found by comparing texts, the others in a text alone.
FILTERS = "ABCDE"
_UPPER = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))  # bytes of a code point after its first


def alone_bits(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # of bytes: ASCII white space only
    points = len(text.translate(None, _INNER))
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * (len(text) - len(text.translate(None, _UPPER))) > 3 * points) << 2
            | (len(text.translate(None, b"#$%&*|")) < len(text)) << 3)


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, bits, nth) of every row of ``docs``; ``nth`` is the row's number in the task that read it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done = 0
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "part": batch["part"], "bits": [alone_bits(t) for t in batch["text"]],
                                "digest": [sha256(t).digest() for t in batch["text"]], "nth": np.arange(done, done + len(batch))})
            done += len(batch)

    plain = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_bytes().alias("text"))
    marks = stage(plain.mapInPandas(run, "doc_id long, part string, bits int, digest binary, nth long"), "filter_marks")
    # A row is no copy exactly if it holds its text's least id: the join key is nearly unique however common a text is.
    named = marks.where("doc_id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    judged = named.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", F.col("bits").bitwiseOR(copy).alias("bits"), "nth")
    return judged.unionByName(marks.where("doc_id IS NULL").select("doc_id", "part", "bits", "nth"))


def gallop(ids: list[int], wanted: int, at: int) -> int:
    """First place from ``at`` on whose id is not below ``wanted``: doubling steps, then bisection."""
    step, n = 1, len(ids)
    while at + step < n and ids[at + step] < wanted:
        step *= 2
    return bisect_left(ids, wanted, at + step // 2, min(n, at + step + 1))


def union(lists: list[list[int]]) -> list[int]:
    """Sorted ids that are in any of the sorted lists: runs below the other lists' next id are taken whole."""
    heads = [(ids[0], i, 0) for i, ids in enumerate(lists) if ids]
    heapify(heads)
    out: list[int] = []
    while len(heads) > 1:
        _, i, at = heads[0]
        ids, limit = lists[i], min(h[0] for h in heads[1:3])
        # An id that the next list holds too is left to that list.
        end = at + 1 if ids[at] == limit else gallop(ids, limit, at)
        if ids[at] != limit:
            out += ids[at:end]
        if end < len(ids):
            heapreplace(heads, (ids[end], i, end))
        else:
            heappop(heads)
    for _, i, at in heads:
        out += lists[i][at:]
    return out


def left_over(ids: list[int], others: list[int]) -> int:
    """How many of ``ids`` are not in ``others``; both are sorted."""
    i = j = kept = 0
    while i < len(ids):
        j = gallop(others, ids[i], j) if j < len(others) else j
        if j == len(others):
            return kept + len(ids) - i
        if others[j] == ids[i]:
            i += 1
        else:
            end = gallop(ids, others[j], i)
            kept, i = kept + end - i, end
    return kept


def posting_lists(marks: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, ids, A .. E, good, toxic): ranges of a part's documents, and the sorted places of some of them."""
    def flag(name: str):
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)

    judged = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(flag("quality"), flag("toxic"))
    known = marks.where("doc_id IS NOT NULL").join(judged, "doc_id", "left")
    rows = known.unionByName(marks.where("doc_id IS NULL"), allowMissingColumns=True)
    # The number deals rows without an id, or with one id, over ranges as well.
    rows = rows.repartitionByRange("part", "doc_id", "nth").sortWithinPartitions("part", "doc_id")
    names = [*FILTERS, "good", "toxic"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, own in batch.groupby("part", sort=False):
                bits = own["bits"].to_numpy()
                held = [bits >> i & 1 == 1 for i in range(len(FILTERS))] + [own[c].to_numpy(float) == 1 for c in ("quality", "toxic")]
                row = {"part": part, "ids": own["doc_id"].astype(object).where(own["doc_id"].notna(), None).tolist()}
                yield pd.DataFrame([row | {c: np.flatnonzero(h).tolist() for c, h in zip(names, held)}])

    return rows.select("part", "doc_id", "bits", "quality", "toxic").mapInPandas(
        run, "part string, ids array<long>, " + ", ".join(f"{c} array<int>" for c in names))


def set_sizes(lists: DataFrame) -> DataFrame:
    """(part, failing, n, good, toxic): documents that fail any filter of the set of bits; for set 0 all documents."""
    full = (1 << len(FILTERS)) - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                by_filter = [getattr(row, c).tolist() for c in FILTERS]
                good, toxic = row.good.tolist(), row.toxic.tolist()
                sizes = [(row.part, 0, row.n_ids, len(good), len(toxic))]
                for failing in range(1, full + 1):
                    any_of = union([own for i, own in enumerate(by_filter) if failing >> i & 1])
                    sizes.append((row.part, failing, len(any_of), len(any_of) - left_over(any_of, good), len(any_of) - left_over(any_of, toxic)))
                yield pd.DataFrame(sizes, columns=["part", "failing", "n", "good", "toxic"])

    found = lists.select("part", F.size("ids").alias("n_ids"), *FILTERS, "good", "toxic").mapInPandas(
        run, "part string, failing int, n long, good long, toxic long")
    return found.groupBy("part", "failing").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def report(sizes: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    full = (1 << len(FILTERS)) - 1
    entries = F.collect_list(F.struct("failing", F.struct("n", "good", "toxic")))  # 32 a part
    per_part = sizes.groupBy("part").agg(F.map_from_entries(entries).alias("of"))
    orders = F.split(F.lit(" ".join("".join(p) for p in permutations(FILTERS))), " ")
    steps = per_part.select("part", "of", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits(letters):
        return sum((F.when(F.instr(letters, c) > 0, 1 << i).otherwise(0) for i, c in enumerate(FILTERS)), F.lit(0))

    own = F.expr("substring(filter_order, step, 1)")
    steps = steps.select("part", "filter_order", "step", "of", own.alias("own"), bits(own).alias("bit"),
                         bits(F.expr("left(filter_order, step)")).alias("after"), bits(F.expr("left(filter_order, step - 1)")).alias("before"))

    def of(failing, what="n"):
        return F.when(failing == 0, F.lit(0)).otherwise(F.col("of")[failing][what]).cast("long")

    after, before, bit = F.col("after"), F.col("before"), F.col("bit")
    removed = of(after) - of(before)
    return steps.select(
        "part", "filter_order", "step", (F.col("of")[F.lit(0)]["n"] - of(after)).alias("kept"), removed.alias("removed"),
        (of(bit) - removed).alias("redundant"), (of(F.lit(full)) - of(F.lit(full) - bit)).alias("unique_fails"),
        (of(after, "good") - of(before, "good")).alias("good_lost"), (of(after, "toxic") - of(before, "toxic")).alias("toxic_lost"),
        F.sum(removed).over(Window.partitionBy("part", "own")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The report of all orders of the five filters over ``docs``."""
    return report(stage(set_sizes(stage(posting_lists(failures(docs, part), labels), "posting_lists")), "set_sizes"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters on all ``documents``, by language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
judged AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
marks AS (
    SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
           (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
           || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
           || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
           || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
    FROM docs LEFT JOIN judged USING (doc_id)),
counted AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM marks GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, left(filter_order, CAST(step AS BIGINT) - 1) AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step)),
told AS (
    SELECT part, n, good, bad, filter_order, step, own, contains(failed, own) AS fails, failed = own AS only_this,
           earlier <> '' AND translate(failed, earlier, '') <> failed AS gone FROM counted, steps),
summed AS (
    SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
           coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant, coalesce(sum(n) FILTER (only_this), 0) AS unique_fails,
           coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost, coalesce(sum(bad) FILTER (NOT gone AND fails), 0) AS toxic_lost
    FROM told GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed"""
