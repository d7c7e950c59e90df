"""Sequences of fixed length whose windows hold the sources in target proportions.

Each source is a queue of its documents in a hashed order.  Deficit round-robin fills the windows: a
window credits every waiting source its share of the window, sources with credit send tokens in turn,
and what a source has sent too much or too little is carried to the next window.

So that many tasks can do this, queues are laid side by side on a time at which source s has sent
weight_s x time tokens.  A slab is a stretch of time that holds about ``slab_tokens`` tokens; its
documents, its first position in the output and the deficit each source brings into it all follow
from running sums, so slabs are filled apart and windows reach across their borders.

Defined cases: null text is empty and a document of the end id only; a null source is a source of its
own; sources without a weight or with weight zero come after all others; repeated rows are documents
of their own; a very long text is cut over as many sequences as it fills; only the last sequence is not full; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import running_before, table, text_bytes
from shelfcast.llm.tokens import encoder
from shelfcast.sources.staging import stage

#: More sources than this are refused: their weights are given to every task.
MAX_SOURCES = 100_000


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, source, n and the ids (end id last) of every document, as little-endian 16 or 32 bits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        kind = "<u2" if max(enc.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for a in range(0, len(batch), 1024):
                part = batch.iloc[a:a + 1024]
                ids, lengths = enc.ids(part["text"].tolist())
                ids = np.insert(ids, np.cumsum(lengths), end_id).astype(kind)
                cut = np.cumsum(lengths + 1)
                yield pd.DataFrame({"doc_id": part["doc_id"], "source": part["source"], "n": lengths + 1,
                                    "ids": [ids[e - n:e].tobytes() for e, n in zip(cut, lengths + 1)]})

    return docs.select("doc_id", "source", text_bytes().alias("text")).mapInPandas(
        run, "doc_id long, source string, n long, ids binary")


def round_robin(queues: dict[str, deque], weight: dict[str, float], deficit: dict[str, float], at: int, window: int):
    """Pieces (key, start, length, position) that deficit round-robin sends from ``queues`` of (key, tokens)."""
    waiting = deque(s for s in sorted(queues) if queues[s])
    sent = 0  # of the document at the head of a queue
    sent = dict.fromkeys(waiting, 0)
    while waiting:
        room = window - at % window
        total = sum(weight[s] for s in waiting)
        for s in waiting:
            deficit[s] += room * weight[s] / total
        turns = len(waiting)
        while room and turns:
            s = waiting[0]
            turns -= 1
            while room and deficit[s] > 0 and queues[s]:
                key, tokens = queues[s][0]
                n = min(room, tokens - sent[s])
                yield key, sent[s], n, at
                at, room, deficit[s], sent[s] = at + n, room - n, deficit[s] - n, sent[s] + n
                if sent[s] == tokens:
                    queues[s].popleft()
                    sent[s] = 0
            if not queues[s]:
                waiting.popleft()
            elif room:
                waiting.rotate(-1)


def queue_name(source: str | None) -> str:
    """A name for each source's queue; no source has that of null."""
    return "" if source is None else f"={source}"


def plan(lengths: DataFrame, window: int, slab_tokens: int, weights: dict[str, float] | None = None) -> DataFrame:
    """Pieces of documents ``lengths`` (rid, doc_id, source, n): rid, start, length, position in the output."""
    spark = lengths.sparkSession
    totals = lengths.groupBy("source").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    tokens = {queue_name(r.source): r.tokens for r in totals}
    total = sum(tokens.values())
    share = {queue_name(r.source): weights.get(r.source, 0) if weights else r.tokens / total for r in totals}
    least = min([w for w in share.values() if w > 0], default=1.0) * 1e-6
    share = {s: w if w > 0 else least for s, w in share.items()}
    # Tokens sent by all sources up to a time: bends where a source has sent its last.
    ends = np.array(sorted({0.0, *(tokens[s] / share[s] for s in share)}))
    volume = sum((np.minimum(tokens[s], share[s] * ends) for s in share), np.zeros_like(ends))

    begin = running_before(lengths.withColumn("source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
                           .withColumn("_h", F.xxhash64("doc_id", "rid", F.lit("pack"))),
                           ["source"], ["_h", "rid"], "n", "before", sum(r.docs for r in totals))

    @F.pandas_udf("long")
    def slab_of(source: pd.Series, before: pd.Series) -> pd.Series:
        time = before.to_numpy(float) / source.map(share).to_numpy(float)
        return pd.Series((np.interp(time, ends, volume) // slab_tokens).astype(np.int64))

    dealt = stage(begin.withColumn("slab", slab_of("source", "before")).select("slab", "source", "_h", "rid", "before", "n"), "slabs")
    # One row per slab; running sum over them.
    first = dealt.groupBy("slab").agg(F.sum("n").alias("_n")).select(
        "slab", F.coalesce(F.sum("_n").over(Window.orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        time = float(np.interp(float(rows["slab"].iloc[0]) * slab_tokens, volume, ends))
        rows = rows.sort_values(["source", "before"])
        queues, owed = {}, {}
        for source, own in rows.groupby("source", sort=False):
            queues[source] = deque(zip(own["rid"].tolist(), own["n"].tolist()))
            owed[source] = share[source] * time - float(own["before"].iloc[0])
        return pd.DataFrame(list(round_robin(queues, share, owed, int(rows["first"].iloc[0]), window)),
                            columns=["rid", "start", "length", "position"])

    return dealt.join(first, "slab").groupBy("slab").applyInPandas(fill, "rid long, start long, length long, position long")


def pack(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, slab_tokens: int = 1 << 20,
         weights: dict[str, float] | None = None) -> DataFrame:
    """One row per piece, with its ids' checksum; weights by source, by default the sources' own shares."""
    tokens = stage(tokenized(docs, tokenizer, end_id).withColumn("rid", F.monotonically_increasing_id()), "tokens")
    pieces = plan(tokens.select("rid", "doc_id", "source", "n"), window, slab_tokens, weights)
    by_doc = pieces.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "length", "position"))).alias("pieces"))
    joined = tokens.join(by_doc, "rid").select("doc_id", "source", "n", "ids", "pieces")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, source, n, ids, own in zip(*(batch[c] for c in ("doc_id", "source", "n", "ids", "pieces"))):
                ids = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                for p in own:
                    a, m, at = p["start"], p["length"], p["position"]
                    out.append((doc_id, source, a, m, zlib.crc32(ids[a:a + m].tobytes()), n, at // window, at % window))
            yield pd.DataFrame(out, columns=["doc_id", "source", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]).astype(
                {"doc_id": "Int64"})

    return joined.mapInPandas(check, "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
                                     "sequence_id long, offset long")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 4096 tokens, every window with the sources' own shares."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
