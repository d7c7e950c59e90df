"""Language of a text by compression: the language whose dictionary makes the text smallest.

Per language a raw-content zstandard dictionary is cut from a bounded sample of labelled texts
(``DOCS`` texts per language give a piece each, ``DICT_BYTES`` in all).  A text in lower case is cut into
blocks of ``BLOCK`` bytes, each block is compressed with every dictionary, and the sizes are summed over
the whole text.  The score is the share of bytes the best language saves over the second; a
prediction with a score under ``reject`` is marked so.

Defined cases: null texts and texts without a letter are ``und`` with score 0; labelled rows with null
text or language teach nothing; equal sizes go to the language with most labelled rows; without any labelled
row every text is ``und``.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import table

#: Bounds of the sample: documents per language, dictionary bytes per language, languages.
DOCS, DICT_BYTES, LANGUAGES = 1000, 64 << 10, 1000
BLOCK, LEVEL = 1024, 6


def learn(labelled: DataFrame, docs: int = DOCS, size: int = DICT_BYTES) -> dict[str, bytes]:
    """Dictionary content by language from labelled (doc_id, text, lang), languages with most documents first."""
    spark = labelled.sparkSession
    known = labelled.where("lang IS NOT NULL AND text != ''").withColumn("_h", F.xxhash64("text", F.lit("dict")))
    place = F.shiftrightunsigned("_h", 1)
    found = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least")).limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not found:
        return {}
    sizes = {r.lang: r.n for r in found}
    # Places under a bound that about three times as many texts as wanted have (one at least), then the first of those.
    bounds = spark.createDataFrame([(r.lang, max(r.least, (1 << 63) - 1 if 3 * docs >= r.n else int(3 * docs / r.n * (1 << 63)))) for r in found], "lang string, _most long")
    few = (known.select("lang", "_h").join(F.broadcast(bounds), "lang").where(place <= F.col("_most"))
           .select("lang", "_h").distinct())
    order = Window.partitionBy("lang").orderBy(place, "_h")
    chosen = few.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= docs).select("lang", "_h").collect()
    counts = Counter(r.lang for r in chosen)
    keys = spark.createDataFrame([(r.lang, r._h, max(64, size // counts[r.lang])) for r in chosen], "lang string, _h long, _take int")
    # A piece as long as the sample allows, from a place the text's hash gives.
    start = F.pmod(F.col("_h"), F.greatest(F.length("text") - F.col("_take"), F.lit(1))).cast("int") + 1
    rows = (known.select("lang", "_h", "text").join(F.broadcast(keys), ["lang", "_h"])
            .select("lang", "_h", F.substring("text", start, F.col("_take")).alias("piece")).distinct().collect())
    pieces: dict[str, list[str]] = {lang: [] for lang in sorted(sizes, key=lambda x: (-sizes[x], x))}
    for r in sorted(rows):
        pieces[r.lang].append(r.piece.lower())
    return {lang: "\n".join(own).encode()[-size:] for lang, own in pieces.items()}


class Judge:
    """Sizes of texts under each language's dictionary."""

    def __init__(self, contents: dict[str, bytes]):
        import zstandard as z
        self.languages = list(contents)
        self.compress = []
        for content in contents.values():
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compress.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def best(self, text: str) -> tuple[int, float]:
        """The language's number, and the share of bytes by which it beats the second."""
        data = text.lower().encode()
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = np.array([sum(map(len, map(c, blocks))) for c in self.compress])
        order = np.argsort(sizes, kind="stable")
        second = sizes[order[1]] if len(sizes) > 1 else len(data) + 16 * len(blocks)
        return int(order[0]), float(np.clip(1 - sizes[order[0]] / second, 0, 1))


def has_letter(text: str | None) -> bool:
    return text is not None and any(unicodedata.category(c)[0] == "L" for c in text)


def predict(docs: DataFrame, contents: dict[str, bytes], reject: float = 0.01) -> DataFrame:
    """doc_id, lang_pred, score and ``rejected`` of every row of ``docs`` (doc_id, text)."""
    model = docs.sparkSession.sparkContext.broadcast(contents)  # at most LANGUAGES x DICT_BYTES

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(model.value)
        for batch in batches:
            found = [judge.best(t) if judge.languages and has_letter(t) else (-1, 0.0) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [judge.languages[i] if i >= 0 else "und" for i, _ in found],
                                "score": [s for _, s in found], "rejected": [s < reject for _, s in found]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs, learn(docs.where(~held_out()))).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")
