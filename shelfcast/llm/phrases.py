"""Document fingerprints by locally consistent parsing.

Level by level a text's symbols (bytes at first) are grouped into phrases and each phrase gets a name,
a 64-bit hash of its symbols.  Runs of one symbol become one symbol.  Then deterministic coin tossing
relabels: a symbol's label is the lowest bit in which it differs from the one before and that bit's
value; after three rounds labels are small and neighbours still differ.  A phrase starts at every local
minimum of the labels.  So a cut depends on a few symbols around it only, and equal substrings have the
same phrases inside, wherever they stand.  Levels go on until a text is one phrase.

The fingerprint holds the ``KEEP`` smallest 32-bit hashes of the names from level ``FROM`` on (from a lower
level for ``SHORT`` texts, and the top name in any case), in hex; the likeness of two is the share of the smallest
of both that both have, an estimate of the share of phrases in common.

Defined cases: null text is empty; an empty text's fingerprint is empty and like no other but an empty
one; rows are in order of doc_id, null first, rows of one doc_id in order of their text's hash; the next
of the last row is the first, so a table of one row is its own next; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import BASE, chunks, mix, table, text_bytes
from shelfcast.sources.staging import stage

KEEP, FROM = 32, 4
#: Texts of fewer bytes also give their names from that level on.
SHORT = {3: 1500, 2: 400, 1: 100}
_POWERS = np.array([pow(BASE, i, 1 << 64) for i in range(512)], np.uint64)


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing; a text's first symbol is compared with its own complement's lowest bit."""
    one = x.dtype.type(1)
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = x[first] ^ one
    differ = x ^ before
    place = np.bitwise_count((differ & (~differ + one)) - one)
    place &= np.uint8(x.dtype.itemsize * 8 - 1)  # equal neighbours, which only a collision gives
    return (place << np.uint8(1)) | ((x >> place.astype(x.dtype)) & one).astype(np.uint8)


def _group(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of one level: their names, and the text each is in."""
    new = np.empty(len(names), bool)
    new[0] = True
    np.not_equal(owner[1:], owner[:-1], out=new[1:])
    turn = new.copy()
    turn[1:] |= names[1:] != names[:-1]
    start = np.flatnonzero(turn)
    if len(start) < len(names):  # runs become one symbol
        length = np.diff(start, append=len(names))
        names, owner, new = names[start], owner[start], new[start]
        many = length > 1
        names[many] = mix(names[many] + length[many].astype(np.uint64) * np.uint64(BASE))
    first = np.flatnonzero(new)
    label = _toss(_toss(_toss(names, first), first), first)
    cut = new
    cut[1:-1] |= (label[1:-1] < label[:-2]) & (label[1:-1] < label[2:]) & ~new[2:]
    cut[first[first + 1 < len(cut)] + 1] = False  # a first phrase has two symbols at least
    cut[first] = True
    begin = np.flatnonzero(cut)
    size = np.diff(begin, append=len(names))
    at = np.arange(len(names)) - np.repeat(begin, size)
    return mix(np.add.reduceat(names * _POWERS[at % 512], begin) + size.astype(np.uint64)), owner[begin]


def sketches(texts: list[bytes]) -> list[np.ndarray]:
    """Of each text the smallest distinct hashes of its phrases, ascending."""
    out: list[np.ndarray] = []
    for a, b in chunks(texts, 1 << 20):
        out += _sketches(texts[a:b])
    return out


def _sketches(texts: list[bytes]) -> list[np.ndarray]:
    n = len(texts)
    names = mix(np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1))
    owner = np.repeat(np.arange(n), [len(t) for t in texts])
    length = np.array([len(t) for t in texts])
    held, held_by, level = [], [], 0
    while len(names):
        sizes = np.bincount(owner, minlength=n)
        alone = sizes[owner] == 1
        counts = alone | (length[owner] < SHORT.get(level, 0 if level < FROM else np.inf))
        held.append(names[counts])
        held_by.append(owner[counts])
        names, owner = names[~alone], owner[~alone]
        if len(names):
            names, owner = _group(names, owner)
        level += 1
    value = (mix(np.concatenate([*held, np.zeros(0, np.uint64)])) >> np.uint64(32)).astype(np.uint32)
    by = np.concatenate([*held_by, np.zeros(0, np.int64)])
    both = np.unique(by.astype(np.uint64) << np.uint64(32) | value)
    ends = np.searchsorted(both, np.arange(n + 1, dtype=np.uint64) << np.uint64(32))
    return [both[i:min(j, i + KEEP)].astype(np.uint32) for i, j in zip(ends[:-1], ends[1:])]


def to_hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smallest hashes of both sketches that both hold; 1 for two empty ones."""
    if not len(a) and not len(b):
        return 1.0
    one, two = set(a.tolist()), set(b.tolist())
    least = sorted(one | two)[:KEEP]
    return sum(x in one and x in two for x in least) / len(least)


def edit(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(ids: list, texts: list[str], own: list[np.ndarray], after: list[str], after_own: list[np.ndarray]) -> pd.DataFrame:
    changed = [edit(t, f).encode() for t, f in zip(texts, after)]
    other = sketches(changed)
    return pd.DataFrame({
        "doc_id": pd.array(ids, "Int64"), "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(c).hexdigest() for c in changed],
        "fingerprint": [to_hex(x) for x in own], "edited_fingerprint": [to_hex(x) for x in other],
        "near_edited": [likeness(x, y) for x, y in zip(own, other)], "near_next": [likeness(x, y) for x, y in zip(own, after_own)]})


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's text."""
    columns = [c.split()[0] for c in ROW.split(", ")]
    names = [*columns, "edge", "part", "text"]

    def whole_row(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(**{n: pd.Series([None] * len(frame), dtype=object) for n in names if n not in frame})[names]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """All rows of a range but its last; the range's first and last row go with their texts, as edges."""
        part, held = TaskContext.get().partitionId(), None

        def edge(kind, row):
            return whole_row(pd.DataFrame({"doc_id": pd.array([row[0]], "Int64"), "edge": [kind], "part": [part], "text": [row[1]]}))

        for whole in batches:
            for a, b in chunks(whole["text"].tolist(), 1 << 21):
                batch = whole.iloc[a:b]
                ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
                raw = batch["text"].tolist()
                texts, own = [t.decode() for t in raw], sketches(raw)
                if held is None:
                    yield edge("first", (ids[0], texts[0]))
                else:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], [held[2], *own]
                if len(ids) > 1:
                    yield whole_row(_rows(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:]))
                held = ids[-1], texts[-1], own[-1]
        if held is not None:
            yield edge("last", held)

    def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, after = batch["text"].tolist(), batch["following"].tolist()
            yield _rows([None if pd.isna(i) else int(i) for i in batch["doc_id"]], texts, sketches([t.encode() for t in texts]),
                        after, sketches([t.encode() for t in after]))

    ordered = (docs.select("doc_id", text_bytes().alias("text")).withColumn("_h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text"))
    walked = stage(ordered.mapInPandas(walk, f"{ROW}, edge string, part int, text string"), "walked")
    # One first and one last row per range.
    lasts = walked.where("edge = 'last'").select("part", "doc_id", "text")
    firsts = walked.where("edge = 'first'").select("part", F.col("text").alias("own_first"))
    wrap = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("own_first").over(Window.orderBy("part")), F.first("own_first").over(wrap))
    closed = (lasts.join(firsts.withColumn("following", following).drop("own_first"), "part")
              .select("doc_id", "text", "following").mapInPandas(close, ROW))
    return walked.where("edge IS NULL").select(*columns).unionByName(closed)


def op7_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of each one's edit with the next."""
    return compare_with_next(table(spark, sf_dir, "documents"))
