"""Small pieces that several operators of this folder share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Odd, so it has an inverse modulo 2^64; base of the rolling hashes.
BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_POWERS: dict[int, np.ndarray] = {}


#: Rows that a batch of whole texts, on its way to Python, holds at most.
BATCH_ROWS = 2000


def bound_batches(spark: SparkSession) -> None:
    """Keeps batches of whole texts small enough for a worker; a lower value set by the user stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(name: str = "text") -> Column:
    """A text column as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def whole_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and the whole row as ``row``, so that no column of it can clash with a new one."""
    return docs.select(F.struct("*").alias("row")).select("row", *[F.col(f"row.{c}") for c in columns])


def compressed(text: Column) -> Column:
    """Bytes in zstandard frames; an exchange's own codec sees too little of a text at once."""
    @F.pandas_udf("binary")
    def run(batch: pd.Series) -> pd.Series:
        from zstandard import ZstdCompressor
        return batch.map(ZstdCompressor(level=1).compress)

    return run(text)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        done, step = 1, base
        while done < size:
            have[done:2 * done] = have[:done] * np.uint64(step)
            done, step = 2 * done, step * step & _M64
        _POWERS[base] = have
    return have[:n]


def rolling(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`spans_hash` reads the hash of any span of ``data`` (bytes)."""
    values = mix(np.arange(1, 257, dtype=np.uint64))[data]
    values *= _powers(BASE, len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span, equal for equal bytes wherever they stand."""
    inverse = _powers(pow(BASE, -1, 1 << 64), len(prefix))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (runs without ASCII white space), the text each is in, and the first of each text."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    start, end = edges[::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(start, np.concatenate([[0], ends]))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    return spans_hash(rolling(data), start, end), owner, first


def chunks(texts: list[bytes], limit: int = 1 << 20):
    """Ranges of texts that hold about ``limit`` bytes together, one long text alone."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def running_before(df: DataFrame, group: list[str], order: list[str], value: str, out: str, rows: int,
                   per_bucket: int = 4096) -> DataFrame:
    """Adds, per row, the sum of ``value`` over the rows of its group that stand before it.

    The rows of a group are first ordered by a hash bucket, so a group of any size is summed by many
    tasks: totals per bucket, their running sum, then a window within each bucket.  ``order`` must be
    a hash (long) first and then whatever makes it unique.
    """
    n = max(1, -(-rows // per_bucket))
    df = df.withColumn("_bucket", F.pmod(F.shiftright(order[0], 8), F.lit(n)).cast("int"))
    keys = [*group, "_bucket"]
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)],
                           F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(totals, same).withColumn(out, F.col("_before") + F.col("_within"))
            .drop("_bucket", "_before", "_within", *[f"_{i}" for i in range(len(keys))]))
