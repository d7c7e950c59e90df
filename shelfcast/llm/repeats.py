"""Exact removal of long repeats over a whole corpus, with run-length suffix indexes.

A byte goes when it lies in a string of ``window`` bytes (100) that also starts earlier: in a document of
smaller doc_id, or earlier in the same one.  Strings are judged on the input.

1. Routing.  In every window the ``K``-byte string with the least hash is its anchor, so equal windows have
   equal anchors at equal places.  A phrase is a maximal stretch of a text whose windows share one anchor
   occurrence; it is at most 2 x window - K bytes long.  Each task keeps the first of equal phrases it sees and marks
   the rest; then one shuffle by anchor keeps the first of each phrase and marks its copies.
2. Flanks.  Around its anchor a window has (window - K) / 2 bytes or more on one side, so two phrases share a window only
   if they agree in that many bytes left or right of the anchor.  Phrases whose flanks no other phrase of their
   anchor has, compared by 32 bits of hash, can share nothing and go no further.
3. Index.  The phrases left are dealt by anchor into shards of bounded size with their bytes.  A shard builds the Burrows-Wheeler transform of its phrases and run-length
   compresses it, with the text position of every run's first symbol sampled and the length of the match
   with its predecessor there.  Streaming the text through the samples gives every other position's predecessor
   and match length, each one more or less than that of the position before.  Positions whose matches reach
   a window are the same string as their predecessor's; all but the earliest are marked.
4. An anchor with more phrases than an index should hold (a line in very many texts) gives its windows one by
   one instead, and equal windows are settled as equal phrases were, in a stream of any length.
5. Marks become spans per document, and the spans are cut.

Phrases and windows are told apart by anchor and phrase hash together, 128 bits; the index compares bytes.  Texts
of one doc_id, at most 2^31, are numbered in an order of their hashes, of 128 bits too.

Defined cases: null text is empty; texts under a window's length keep all; rows that repeat doc_id and
text are one document and fare alike; different texts of one doc_id are ordered by their hash; a null
doc_id is before all others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import chunks, compressed, mix, rolling, running_before, spans_hash, table, text_bytes
from shelfcast.sources.staging import stage

WINDOW, K = 100, 24
#: Most phrases of one anchor that go to an index, and bytes of phrases in a shard, about.
HOT, SHARD_BYTES = 2000, 1 << 20
#: Stands for a null doc_id, before all others.
NO_ID = -(1 << 63)


# ---- anchors and phrases ---------------------------------------------------------------

def _window_least(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in each window of ``width`` values, the leftmost of equal ones."""
    n = len(hashes) - width + 1
    best = np.arange(len(hashes))
    span = 1
    while 2 * span <= width:
        left, right = best[:len(best) - span], best[span:]
        best = np.where(hashes[right] < hashes[left], right, left)
        span *= 2
    left, right = best[:n], best[width - span:width - span + n]
    return np.where(hashes[right] < hashes[left], right, left)


def _flank(prefix: np.ndarray, start: np.ndarray, size: int, there: np.ndarray) -> np.ndarray:
    """Hashes of ``size`` bytes from each start, odd numbers of 32 bits; 0 where they are not all ``there``."""
    at = start[there]
    out = np.zeros(len(start), np.uint32)
    out[there] = spans_hash(prefix, at, at + size) >> np.uint64(32) | np.uint64(1)
    return out.view(np.int32)


def phrases(data: np.ndarray, window: int = WINDOW, k: int = K) -> tuple[np.ndarray, ...]:
    """Of one run of bytes: each phrase's first window, number of windows, anchor's hash, phrase's hash, left and right flank."""
    prefix = rolling(data)
    at = np.arange(len(data) - k + 1)
    grams = spans_hash(prefix, at, at + k)
    least = _window_least(grams, window - k + 1)
    start = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(start, append=len(least))
    anchor = least[start]
    # The anchor's place in the phrase is part of the phrase's name.
    name = mix(spans_hash(prefix, start, start + count + window - 1) + (anchor - start).astype(np.uint64))
    size = (window - k + 1) // 2
    left = _flank(prefix, anchor - size, size, anchor - start >= size)
    right = _flank(prefix, anchor + k, size, start + count + window - 1 - anchor - k >= size)
    return start, count, grams[anchor], name, left, right


# ---- the index -------------------------------------------------------------------------

def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` (non-negative integers under 2^31, the last one unique) in order, and their ranks, by doubling."""
    n = len(text)
    bits = int(text.max() + 1).bit_length()
    span, key = 62 // bits, np.zeros(n, np.int64)
    for i in range(span):  # the first symbols at once
        key <<= bits
        key[:n - i] |= text[i:] + 1 if i else text + 1
    while True:
        order = np.argsort(key)
        ordered = key[order]
        step = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order, rank
        after = np.zeros(n, np.int64)
        after[:max(0, n - span)] = rank[span:] + 1
        key = rank * (n + 1) + after
        span *= 2


class RunLengthIndex:
    """Run-compressed transform of phrases, each closed by its own separator; samples at run starts.

    ``heads`` are the symbols of the runs, ``at`` the text positions of the suffixes at which runs start (in
    text order), ``before`` the suffix that precedes each in suffix order, ``match`` how many symbols both share.
    """

    def __init__(self, parts: list[bytes]):
        sizes = np.array([len(p) + 1 for p in parts])
        ends = np.cumsum(sizes) - 1
        # Separators are the smallest symbols, each its own, so no match passes the end of a phrase.
        text = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.int64) + len(parts)
        text[ends] = np.arange(len(parts))
        self.n = len(text)
        order, _ = suffix_array(text)
        last = text[order - 1]  # the transform; the first suffix has the last symbol before it
        last[last < len(parts)] = -1  # all separators alike: what precedes a phrase tells nothing
        start = np.concatenate([[True], (last[1:] != last[:-1]) | (last[1:] < 0)])
        run = np.flatnonzero(start)
        self.heads = last[run]
        previous = np.where(run > 0, order[run - 1], -1)
        sampled = order[run]
        by_place = np.argsort(sampled)
        self.at, self.before = sampled[by_place], previous[by_place]
        self.match = self._matches(text, self.at, self.before)

    @staticmethod
    def _matches(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(a), np.int64), np.flatnonzero(b >= 0)
        while len(todo):
            i, j = a[todo] + out[todo], b[todo] + out[todo]
            same = text[i] == text[j]
            todo = todo[same]
            out[todo] += 1
        return out

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """For every position in text order its predecessor in suffix order and the match length with it."""
        place = np.arange(self.n)
        run = np.searchsorted(self.at, place, "right") - 1
        ahead = place - self.at[run]
        return np.where(self.before[run] >= 0, self.before[run] + ahead, -1), self.match[run] - ahead


def _first_of(links: np.ndarray) -> np.ndarray:
    """Follows links to earlier members of a chain until all point to its end."""
    while not np.array_equal(up := links[links], links):
        links = up
    return links


def repeated_windows(parts: list[bytes], window: int = WINDOW) -> list[np.ndarray]:
    """For each of the phrases, given in corpus order, which of its windows occur earlier."""
    index = RunLengthIndex(parts)
    before, match = index.stream()
    sizes = np.array([len(p) + 1 for p in parts])
    begin = np.cumsum(sizes) - sizes
    same = match >= window
    links = np.arange(index.n)
    links[same] = before[same]
    group = _first_of(links)
    place = np.arange(index.n)
    first = np.full(index.n, index.n)
    np.minimum.at(first, group, place)
    later = place > first[group]
    return [later[b:b + max(0, len(p) - window + 1)] for b, p in zip(begin, parts)]


# ---- jobs ------------------------------------------------------------------------------

#: kind 0: the first of a phrase so far; 1: windows that occur earlier; 2: a phrase of an anchor with several.
_FOUND = "kind byte, anchor long, name long, left int, right int, doc_id long, place long, windows int"
_MARK = "doc_id long, place long, windows int"


def _rows(kind: int, doc_id, place, windows, anchor, name, left=0, right=0) -> pd.DataFrame:
    return pd.DataFrame({"kind": np.full(len(place), kind, np.int8), "anchor": anchor.view(np.int64), "name": name.view(np.int64),
                         "left": left, "right": right, "doc_id": doc_id, "place": place, "windows": windows.astype(np.int32)})


def _joined(place: np.ndarray, windows: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching stretches of windows of one owner as one; input in order of owner and place."""
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] > place[:-1] + windows[:-1])])[:len(place)]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    return place[first], place[last] + windows[last] - place[first], owner[first]


def _find(window: int, k: int):
    """Phrases of whole texts, (doc_id, tag, text): the first of each in a group of texts, and marks of the others."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates(["doc_id", "tag"]).sort_values(["doc_id", "tag"])
            ids, base, texts = batch["doc_id"].to_numpy(), batch["tag"].to_numpy() << 32, batch["text"].tolist()
            for begin, end in chunks(texts, 1 << 21):
                rows = []
                for i in range(begin, end):
                    data = np.frombuffer(texts[i], np.uint8)
                    # A very long text goes in stretches that share a window less one.
                    for a in range(0, max(0, len(data) - window + 1), 1 << 20):
                        start, *rest = phrases(data[a:a + (1 << 20) + window - 1], window, k)
                        rows.append((start + a, *rest, np.full(len(start), i)))
                if not rows:
                    continue
                start, count, anchor, name, left, right, owner = (np.concatenate(x) for x in zip(*rows))
                place = base[owner] + start
                first = np.zeros(len(place), bool)
                first[np.unique(mix(anchor) + name, return_index=True)[1]] = True  # rows are in corpus order
                yield _rows(0, ids[owner[first]], place[first], count[first], anchor[first], name[first], left[first], right[first])
                if not first.all():
                    place, windows, owner = _joined(place[~first], count[~first], owner[~first])
                    # Marks need no place among the anchors; any number spreads them.
                    yield _rows(1, ids[owner], place, windows, mix(place), np.zeros(len(place), np.uint64))
    return run


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order of anchor, name and corpus: copies of a phrase become marks, phrases of anchors with several stay."""
    held, held_pairs = None, False  # the last phrase seen, and whether the one before has its anchor
    for batch in batches:
        marks = batch["kind"].to_numpy() == 1
        if marks.any():
            yield batch[marks]
            batch = batch[~marks]
        if not len(batch):
            continue
        if held is not None:
            batch = pd.concat([held, batch])
        anchor, name, doc, place = (batch[c].to_numpy() for c in ("anchor", "name", "doc_id", "place"))
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (name[1:] != name[:-1])])
        head = np.flatnonzero(new)
        of = head[np.cumsum(new) - 1]
        copy = ~new & ((doc != doc[of]) | (place != place[of]))  # a repeated row is no copy
        if copy.any():
            yield batch[copy].assign(kind=np.int8(1))
        next_pairs = np.concatenate([anchor[head[1:]] == anchor[head[:-1]], [False]])
        pairs = np.concatenate([[held_pairs], next_pairs[:-1]])
        several = (pairs | next_pairs)[:-1]
        if several.any():
            yield batch.iloc[head[:-1][several]].assign(kind=np.int8(2))
        held, held_pairs = batch.iloc[head[-1:]], bool(pairs[-1])
    if held is not None and held_pairs:
        yield held.assign(kind=np.int8(2))


def _fetch(window: int):
    """Bytes of each wanted phrase, or its windows one by one where its anchor is hot."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zstandard import decompress
        for batch in batches:
            whole, single = [], []
            for doc_id, z, wanted in zip(batch["doc_id"], batch["z"], batch["wanted"]):
                text = decompress(z)
                for w in wanted:
                    at = w["place"] & 0x7FFFFFFF
                    part = text[at:at + w["windows"] + window - 1]
                    if not w["hot"]:
                        whole.append((w["anchor"], doc_id, w["place"], part))
                        continue
                    data, i = np.frombuffer(part, np.uint8), np.arange(w["windows"])
                    single.append((spans_hash(rolling(data), i, i + window), spans_hash(rolling(255 - data), i, i + window),
                                   np.full(len(i), doc_id), w["place"] + i))
            yield pd.DataFrame(whole, columns=["anchor", "doc_id", "place", "bytes"]).assign(name=0, left=0, right=0, kind=np.int8(2), windows=0)[_FETCHED]
            if single:
                anchor, name, doc_id, place = (np.concatenate(x) for x in zip(*single))
                yield _rows(0, doc_id, place, np.ones(len(place)), anchor, name).assign(bytes=pd.Series([None] * len(place), dtype=object))[_FETCHED]
    return run


_FETCHED = ["kind", "anchor", "name", "left", "right", "doc_id", "place", "windows", "bytes"]


def _index(window: int):
    """A shard of phrases to marks of their windows that occur earlier."""
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.drop_duplicates(["doc_id", "place"]).sort_values(["doc_id", "place"])  # of a repeated row once
        found = repeated_windows(shard["bytes"].tolist(), window)
        size = np.array([len(x) for x in found])
        later = np.concatenate([np.append(x, False) for x in found]).astype(np.int8)
        edge = np.flatnonzero(np.diff(later, prepend=0, append=0))
        begin, end = edge[::2], edge[1::2]
        first = np.cumsum(size + 1) - size - 1
        owner = np.searchsorted(first, begin, "right") - 1
        return pd.DataFrame({"doc_id": shard["doc_id"].to_numpy()[owner], "place": shard["place"].to_numpy()[owner] + begin - first[owner],
                             "windows": (end - begin).astype(np.int32)})
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_id`` and ``_tag``, which tell documents apart and order them; tags number the texts of an id."""
    keyed = docs.withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID)))
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return keyed.withColumn("_tag", F.lit(0).cast("long"))
    # Two hashes from different seeds: 128 bits.
    hashed = keyed.withColumns({"_h": F.xxhash64("text"), "_g": F.xxhash64(F.lit("second"), "text")})
    names = ["_id", "_h", "_g"]
    texts = stage(hashed.select(*names, F.lit(1).alias("one")).distinct(), "texts")
    tags = stage(running_before(texts, ["_id"], ["_h", "_g"], "one", "_tag", texts.count()).select(*names, F.col("_tag").cast("long")), "tags")
    return hashed.join(tags, names).drop("_h", "_g")


def _with_equal_flank(phrase: DataFrame) -> DataFrame:
    """The phrases of which another phrase of the same anchor has the left or the right flank."""
    for side in ("left", "right"):
        shared = phrase.where(F.col(side) != 0).groupBy("anchor", side).count().where("count > 1")
        phrase = phrase.join(shared.select("anchor", side, F.lit(True).alias(f"{side}_shared")), ["anchor", side], "left")
    return phrase.where("left_shared OR right_shared").select("anchor", "doc_id", "place", "windows")


def marks(docs: DataFrame, window: int = WINDOW, k: int = K, hot: int = HOT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(_id, _tag, spans): per document the stretches of windows, (place, windows), that occur earlier; ``docs`` is keyed."""
    order = ["anchor", "name", "doc_id", "place"]
    found = docs.select(F.col("_id").alias("doc_id"), F.col("_tag").alias("tag"), text_bytes().alias("text")).mapInPandas(_find(window, k), _FOUND)
    settled = stage(found.repartition("anchor").sortWithinPartitions(*order).mapInPandas(_settle, _FOUND), "settled")
    phrase = stage(_with_equal_flank(settled.where("kind = 2")), "flanked")
    crowded = stage(phrase.groupBy("anchor").count().where(F.col("count") > hot).select("anchor", F.lit(True).alias("hot")), "crowded")
    tag = F.shiftright("place", 32)
    wanted = (phrase.join(crowded, "anchor", "left").groupBy("doc_id", tag.alias("tag"))
              .agg(F.collect_list(F.struct("anchor", "place", "windows", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted")))
    texts = docs.where(F.octet_length("text") >= window).select(F.col("_id").alias("doc_id"), F.col("_tag").alias("tag"), compressed(text_bytes()).alias("z"))
    fetched = stage(texts.join(wanted, ["doc_id", "tag"]).mapInPandas(_fetch(window), _FOUND + ", bytes binary"), "fetched")
    whole = fetched.where("kind = 2")
    n = whole.agg(F.sum(F.length("bytes"))).first()[0] or 0
    indexed = (whole.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-n // shard_bytes)))))
               .select("shard", "doc_id", "place", "bytes").groupBy("shard").applyInPandas(_index(window), _MARK))
    single = (fetched.where("kind = 0").drop("bytes").repartition("anchor").sortWithinPartitions(*order)
              .mapInPandas(_settle, _FOUND).where("kind = 1"))
    all_marks = settled.where("kind = 1").select("doc_id", "place", "windows").unionByName(indexed).unionByName(single.select("doc_id", "place", "windows"))
    return (all_marks.groupBy(F.col("doc_id").alias("_id"), F.shiftright("place", 32).alias("_tag"))
            .agg(F.collect_list(F.struct(F.col("place").bitwiseAND(0x7FFFFFFF).alias("start"), "windows")).alias("spans")))


def covered(spans, window: int) -> np.ndarray:
    """(begin, end) rows of the maximal runs of bytes in stretches of windows (start, windows)."""
    if spans is None or not len(spans):
        return np.zeros((0, 2), np.int64)
    both = np.array([(s["start"], s["start"] + s["windows"] + window - 1) for s in spans], np.int64)
    both = both[np.argsort(both[:, 0], kind="stable")]
    reach = np.maximum.accumulate(both[:, 1])
    new = np.concatenate([[True], both[1:, 0] > reach[:-1]])
    first = np.flatnonzero(new)
    return np.stack([both[first, 0], reach[np.append(first[1:], len(both)) - 1]], axis=1)


def cut(text: bytes, runs: np.ndarray) -> bytes:
    """What is left of ``text`` without the runs."""
    ends = [0, *runs.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2]))


def with_spans(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """doc_id, the compressed text ``z``, the marks ``spans``, and as ``row`` the other columns of ``docs``."""
    rest = [F.col(c) for c in docs.columns if c != "text"]
    keyed = _keyed(docs.select("doc_id", "text", F.struct(*rest).alias("row")))
    found = marks(keyed.drop("row"), window, **how)
    return keyed.withColumn("z", compressed(text_bytes())).join(found, ["_id", "_tag"], "left").select("doc_id", "z", "spans", "row")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; a character that loses a byte goes whole, and null becomes empty."""
    @F.pandas_udf("string")
    def left(z: pd.Series, spans: pd.Series) -> pd.Series:
        from zstandard import decompress
        return pd.Series([cut(decompress(t), covered(s, window)).decode(errors="ignore") for t, s in zip(z, spans)], dtype=object)

    done = with_spans(docs, window, **how).withColumn("text", left("z", "spans"))
    return done.select(*["text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What goes and what is left of all ``documents`` when repeats of 100 bytes go."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zstandard import decompress
        for batch in batches:
            out = []
            for doc_id, z, spans in zip(batch["doc_id"], batch["z"], batch["spans"]):
                text, runs = decompress(z), covered(spans, WINDOW)
                out.append((doc_id, len(text), int((runs[:, 1] - runs[:, 0]).sum()), len(runs), hashlib.sha256(cut(text, runs)).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_spans(docs).select("doc_id", "z", "spans").mapInPandas(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
