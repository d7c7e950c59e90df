"""Token ids in bit-packed files, written by tasks into the shared folder and read back.

A file holds the documents of one range of ids.  Layout, all numbers little-endian:

    header   magic "TKB1", bits per id (u32), ids per block (u32), number of ids (u64), of documents (u64)
    blocks   each id in that many bits, low bit first; a block starts at a byte
    offsets  byte at which each block starts, and the end of the last (u64)
    index    per document: doc_id (i64), 1 if that is null (u8), first id in this file (u64)
    trailer  byte at which the offsets start (u64)

Block offsets give random access: :func:`read_span` reads only the blocks that hold a span.  Files
carry a task's attempt in their name until they are whole and are then renamed, so a lost executor's
half file is never read and a repeated task writes the same bytes again.

Defined cases: null text is empty and has the end id only; documents are in order of doc_id, null
first, rows of one doc_id in order of their text's hash; an empty table writes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import table, text_bytes
from shelfcast.llm.tokens import encoder
from shelfcast.sources.staging import new_path

MAGIC = b"TKB1"
HEADER = struct.Struct("<4sIIQQ")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("start", "<u8")])
BLOCK = 1 << 13


def bits_for(vocabulary: int) -> int:
    """The fewest bits that tell so many ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    rows = ids.astype("<u4").view(np.uint8).reshape(len(ids), 4)
    return np.packbits(np.unpackbits(rows, axis=1, count=bits, bitorder="little").ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    rows = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = rows
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Appends documents to one file."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.at = 0
        self.offsets, self.index = [], []
        self._put(b"\0" * HEADER.size)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        upto = len(ids) if whole else len(ids) - len(ids) % self.block
        for i in range(0, upto, self.block):
            self.offsets.append(self.at)
            self._put(pack(ids[i:min(i + self.block, upto)], self.bits))
        self.waiting, self.n_waiting = [ids[upto:]], len(ids) - upto

    def add(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        starts = self.n_ids + np.cumsum(lengths) - lengths
        self.index += [(k or 0, k is None, s) for k, s in zip(keys, starts)]
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= 64 * self.block:
            self._flush(False)

    def close(self) -> bytes:
        """Ends the file; the header that belongs at its start."""
        self._flush(True)
        tail = self.at
        self._put(np.array([*self.offsets, tail], "<u8").tobytes())
        self._put(np.array(self.index, INDEX).tobytes())
        self._put(struct.pack("<Q", tail))
        return HEADER.pack(MAGIC, self.bits, self.block, self.n_ids, len(self.index))


class Reader:
    def __init__(self, file):
        self.file = file
        magic, self.bits, self.block, self.n_ids, n_docs = HEADER.unpack(self._at(0, HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        size = file.size()
        tail, = struct.unpack("<Q", self._at(size - 8, 8))
        n_blocks = -(-self.n_ids // self.block)
        rest = self._at(tail, size - 8 - tail)
        self.offsets = np.frombuffer(rest, "<u8", n_blocks + 1)
        self.index = np.frombuffer(rest, INDEX, n_docs, 8 * (n_blocks + 1))

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def read_span(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the file, from the blocks that hold them only."""
        if end <= start:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-end // self.block)
        data = self._at(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a]))
        parts = []
        for k in range(a, b):
            n = min(self.block, self.n_ids - k * self.block)
            lo = int(self.offsets[k] - self.offsets[a])
            parts.append(unpack(data[lo:lo + -(-n * self.bits // 8)], self.bits, n))
        return np.concatenate(parts)[start - a * self.block:end - a * self.block]


def _files(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def write_packed(docs: DataFrame, root: str, tokenizer: str, end_id: int) -> DataFrame:
    """Writes the ids of all ``docs`` (doc_id, text) in order of doc_id under ``root``.

    Runs one job; returns the manifest, one row per file: file, number of documents and ids, and ids before it.
    """
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        where = writer = None
        n_docs = 0
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                files, folder = _files(root)
                files.create_dir(folder, recursive=True)
                where = f"{folder}/part-{part:06d}.tkb"
                half = f"{where}.{TaskContext.get().taskAttemptId()}"
                body = files.open_output_stream(f"{half}.body")
                writer = Writer(body, bits_for(max(enc.vocabulary, end_id + 1)))
            ids, lengths = enc.ids(batch["text"].tolist())
            ids = np.insert(ids, np.cumsum(lengths), end_id)
            writer.add([None if pd.isna(d) else int(d) for d in batch["doc_id"]], ids, lengths + 1)
            n_docs += len(batch)
        if writer is not None:
            header = writer.close()
            body.close()
            with files.open_input_stream(f"{half}.body") as src, files.open_output_stream(half) as out:
                out.write(header)
                src.read(len(header))
                while data := src.read(1 << 22):
                    out.write(data)
            files.delete_file(f"{half}.body")
            files.move(half, where)
            yield pd.DataFrame({"part": [part], "file": [f"{root}/part-{part:06d}.tkb"], "n_docs": [n_docs], "n_ids": [writer.n_ids]})

    spark = docs.sparkSession
    ordered = (docs.select("doc_id", text_bytes().alias("text")).withColumn("_h", F.xxhash64("text"))
               .repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h").select("doc_id", "text"))
    # One row per file: as many as the range exchange has partitions.
    rows = sorted(ordered.mapInPandas(write, "part int, file string, n_docs long, n_ids long").collect())
    before = np.cumsum([0, *(r.n_ids for r in rows)])
    return spark.createDataFrame([(r.file, r.n_docs, r.n_ids, int(b)) for r, b in zip(rows, before)],
                                 "file string, n_docs long, n_ids long, ids_before long")


def read_packed(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start over all files, n_tokens and the checksum of its ids."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                files, path = _files(row.file)
                with files.open_input_file(path) as f:
                    reader = Reader(f)
                    ends = np.append(reader.index["start"][1:], reader.n_ids).astype(np.int64)
                    starts = reader.index["start"].astype(np.int64)
                    for a in range(0, len(starts), 512):
                        b = min(a + 512, len(starts))
                        ids = reader.read_span(int(starts[a]), int(ends[b - 1]))
                        sums = [zlib.crc32(ids[s - starts[a]:e - starts[a]].tobytes()) for s, e in zip(starts[a:b], ends[a:b])]
                        ids_of = pd.array(reader.index["doc_id"][a:b].astype(np.int64), "Int64")
                        ids_of[reader.index["null"][a:b] == 1] = pd.NA
                        yield pd.DataFrame({"doc_id": ids_of, "start": starts[a:b] + row.ids_before,
                                            "n_tokens": ends[a:b] - starts[a:b], "ids_crc32": sums})

    n = max(1, manifest.count())
    return manifest.repartition(n, "file").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_packed_ids(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All ``documents`` encoded, end id 1 appended, written as packed files and read back."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return read_packed(write_packed(table(spark, sf_dir, "documents"), new_path(spark, "packed"), tokenizer, end_id=1))
