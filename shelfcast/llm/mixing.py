"""Mixing sources to target weights by temperature, realised as budgeted permutations.

Source weights are token shares to the power ``alpha``, normalised.  ``alpha`` is found by bisection
in [0, 1]: the smallest that repeats no source more than ``max_epochs`` times and, if ``entropy`` is
given, the largest whose weights reach that entropy (in nats), whichever repeats less.  The budget is ``budget`` tokens, by default the
fewest at which every source is used at least once, so that no document is lost.

A source's budget is spent in whole passes over it and a last part of a pass.  Documents of a source
stand in blocks by a keyed hash, which permutes them; the last pass takes blocks in order, and within the
last block documents in order, while their tokens fit.  A source's plan is thus a number of passes and
a hash up to which documents come once more, so the documents themselves never move.  ``positions`` gives every
copy its pass, the block's place in that pass and its own place in the block; each pass permutes blocks and the
documents in them anew, the last one those it takes.

Defined cases: null text has no token; documents without a token come as often as their source's whole passes; a
null source is a source of its own; very long texts are encoded whole; rows that repeat doc_id and text fall on the same side of the hash; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import table, text_bytes, whole_rows
from shelfcast.llm.tokens import encoder
from shelfcast.sources.staging import stage

#: More sources than this are refused: their weights are found on the driver.
MAX_SOURCES = 100_000
#: Documents of a source in a block, about.
PER_BLOCK = 4096


def place(seed: int) -> Column:
    """A document's place in the permutation of its source, from 0 to 2^62."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(seed)), 2)


def source_key() -> Column:
    """A name for each source; no source has that of null."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))


def token_count(tokenizer: str) -> Column:
    """Number of token ids of ``text``."""
    @F.pandas_udf("long")
    def count(text: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(tokenizer)
        for batch in text:
            yield pd.Series(enc.ids(batch.tolist())[1])

    return count(text_bytes())


def weights(tokens: dict[str, int], alpha: float) -> dict[str, float]:
    total = sum(tokens.values())
    raised = {s: (t / total) ** alpha if t else 0.0 for s, t in tokens.items()}
    norm = sum(raised.values())
    return {s: w / norm for s, w in raised.items()}


def _entropy(w: dict[str, float]) -> float:
    p = np.array([x for x in w.values() if x > 0])
    return float(-(p * np.log(p)).sum())


def _most_epochs(tokens: dict[str, int], w: dict[str, float], budget: float | None) -> float:
    """Passes over the source that is repeated most."""
    per = [w[s] / t for s, t in tokens.items() if t]
    return max(per) * (budget if budget else 1 / min(per))


def solve(tokens: dict[str, int], max_epochs: float | None, entropy: float | None, budget: float | None = None) -> float:
    """The exponent; both measures fall as it rises, so each is met by bisection."""
    def bisect(met) -> float:
        low, high = 0.0, 1.0
        if met(low):
            return low
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (low, mid) if met(mid) else (mid, high)
        return high

    alpha = 0.0
    if entropy is not None:  # the largest exponent whose entropy is high enough
        alpha = bisect(lambda a: _entropy(weights(tokens, a)) < entropy)
    if max_epochs is not None:  # the smallest that repeats little enough
        alpha = max(alpha, bisect(lambda a: _most_epochs(tokens, weights(tokens, a), budget) <= max_epochs))
    return alpha


def plan(docs: DataFrame, tokenizer: str, max_epochs: float | None, entropy: float | None, budget: float | None, seed: int) -> DataFrame:
    """Per source (its key): weight, tokens, whole ``passes``, ``upto``, the last place that comes once more, and the ``width`` of a block in places."""
    spark = docs.sparkSession
    counted = stage(docs.select(source_key().alias("source"), place(seed).alias("at"), token_count(tokenizer).alias("n")), "counted")
    sums = counted.groupBy("source").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    tokens = {r.source: r.tokens for r in sums}
    schema = "source string, weight double, tokens long, passes int, rest long, blocks long"
    if not any(tokens.values()):
        shares = spark.createDataFrame([(s, 0.0, 0, 1, 0, 1) for s in tokens], schema)
    else:
        w = weights(tokens, solve(tokens, max_epochs, entropy, budget))
        size = budget if budget else max(t / w[s] for s, t in tokens.items() if t)
        rows = []
        for r in sums:
            # A source that is used a whole number of times must not lose a token to rounding.
            due = int(w[r.source] * size * (1 + 1e-12) + 0.5)
            passes, rest = divmod(due, r.tokens) if r.tokens else (1, 0)
            rows.append((r.source, w[r.source], r.tokens, passes, rest, -(-r.docs // PER_BLOCK)))
        shares = spark.createDataFrame(rows, schema)
    width = F.expr(f"({1 << 62}L DIV blocks) + 1")
    shares = F.broadcast(shares.withColumn("width", width))  # at most MAX_SOURCES rows
    dealt = counted.join(shares, "source").withColumn("block", F.expr("at DIV width")).select("source", "at", "n", "rest", "block")
    totals = dealt.groupBy("source", "block").agg(F.sum("n").alias("total"))
    running = totals.withColumn("before", F.coalesce(F.sum("total").over(
        Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The block in which a source's last pass ends, then the place in it; equal places go together.
    last = running.join(shares.select("source", "rest"), "source").where("before <= rest AND before + total > rest").select("source", "block", "before")
    places = dealt.join(F.broadcast(last), ["source", "block"]).groupBy("source", "before", "rest", "at").agg(F.sum("n").alias("n"))
    upto = places.withColumn("sum", F.col("before") + F.sum("n").over(Window.partitionBy("source").orderBy("at")))
    ends = upto.where("sum <= rest").groupBy("source").agg(F.max("at").alias("upto"))
    begins = dealt.join(F.broadcast(last), ["source", "block"]).groupBy("source").agg(F.min("at").alias("first"))
    return (shares.join(F.broadcast(ends), "source", "left").join(F.broadcast(begins), "source", "left")
            .select("source", "weight", "tokens", "passes", F.coalesce(F.col("upto"), F.col("first") - 1, F.lit(-1)).alias("upto"), "width"))


def copies(docs: DataFrame, tokenizer: str, max_epochs: float | None = 1.5, entropy: float | None = None,
           budget: float | None = None, seed: int = 5) -> DataFrame:
    """Adds ``_copies``, how often each row comes, its source's ``_weight`` and its ``_block`` to a frame with doc_id, text and source."""
    # One row per source, written so that its size is known; joined by broadcast only while that is small.
    shares = stage(plan(docs, tokenizer, max_epochs, entropy, budget, seed)
                   .select(F.col("source").alias("_source"), F.col("weight").alias("_weight"), "passes", "upto", "width"), "shares")
    return (docs.join(shares, source_key() == F.col("_source"))
            .withColumn("_at", place(seed))
            .withColumns({"_copies": F.col("passes") + (F.col("_at") <= F.col("upto")).cast("int"), "_block": F.expr("_at DIV width")})
            .drop("_source", "_at", "passes", "upto", "width"))


def mix(docs: DataFrame, tokenizer: str, **how) -> DataFrame:
    """The rows of ``docs``, each as often as its source's weight asks."""
    times = copies(whole_rows(docs, "doc_id", "text", "source"), tokenizer, **how).where("_copies > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")


def positions(docs: DataFrame, tokenizer: str, seed: int = 5, **how) -> DataFrame:
    """One row per copy: doc_id, source, weight, copies, and its pass, block and place, each counted from 1.

    A source's copies in order of pass, block and place are its stream; equal rows stand side by side in any order.
    """
    keyed = docs.select("doc_id", "text", "source")
    found = (copies(keyed, tokenizer, seed=seed, **how).where("_copies > 0")
             .select("doc_id", "source", source_key().alias("key"), place(seed).alias("at"), F.col("_block").alias("drawn"),
                     F.col("_weight").alias("weight"), F.col("_copies").cast("long").alias("copies")))
    each = found.withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    # One row per block of thousands of documents; a block's place is found among them, a document's in its block.
    blocks = (each.groupBy("key", "pass", "drawn").count()
              .withColumn("block", F.row_number().over(Window.partitionBy("key", "pass").orderBy(F.xxhash64("pass", "drawn", F.lit(seed)), "drawn"))))
    inside = Window.partitionBy("key", "pass", "drawn").orderBy(F.xxhash64("pass", "at", F.lit(seed)), "at", "doc_id")
    return (each.withColumn("place", F.row_number().over(inside)).join(blocks.drop("count"), ["key", "pass", "drawn"])
            .select("doc_id", "source", "weight", "copies", "pass", "block", "place"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of ``documents``, with its place in its source's stream, when no source is repeated more than one and a half times."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    return positions(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("weight", F.round("weight", 9))
