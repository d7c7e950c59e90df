"""Exact token counts of every prefix of a text, by dynamic programming over its prefixes.

Byte-pair encoding has one property that makes prefixes cheap: a sequence of tokens is the encoding of its text
exactly if each token is the encoding of itself and each neighbouring pair is the encoding of its two texts.  So
the last token of a prefix's encoding is the one token ending there that fits the last token of the prefix before
it, and the count is that prefix's count plus one.  A prefix that ends a word carries the word-end mark: its last
token is looked for with the mark, from the same table.

Texts are cut as the tokenizer file says: white space dropped, then contractions, runs of letters, single
digits and runs of other signs.  The runs are extended character by character; a character that later ones may still change (a
letter before a combining mark) is taken back and put on again with them.  Strings of special tokens count as one where
whole, as ordinary text where a prefix cuts them.  A worker remembers the counts of distinct pieces of text.

The store has one row per 65,536 code points: what stands before, and the steps from one prefix to the next.
Truncation and budget questions read it; nothing is encoded again.

Defined cases: null text is empty, with one row of no counts; very long texts give several rows of one size; rows that repeat
doc_id and text repeat their rows in the store and answer a question once; a null doc_id is a key like any other;
an empty table gives no rows; other columns are not read, whatever their names.  Tokenizer files cut in another way are refused.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import chunks, rolling, spans_hash, table, text_bytes
from shelfcast.llm.tokens import pieces, splits_at_blanks

#: Code points in a row of the store, pieces a worker remembers, and pairs of tokens it remembers.
BLOCK, PIECES, PAIRS = 1 << 16, 300_000, 1_000_000
#: Bytes of the longest piece that is counted together with others, and what such pieces are made of: one kind of character.
ARRAYS = 32
PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@\[-`{-~]+")
STORE = "doc_id long, text_key string, block int, start long, before long, n_bytes long, n_chars long, n_tokens long, steps binary"
# Characters with the White_Space property.
SPACES = frozenset("\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Contractions that are pieces of their own, by their length.
SHORT, LONG = ("'s", "'t", "'m", "'d"), ("'re", "'ve", "'ll")
_COUNTERS: dict[str, Counter] = {}


@cache
def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else letters from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@cache
def followers() -> frozenset[str]:
    """Characters that may melt into the one before them under NFC."""
    both = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    found = {chr(int(d[1], 16)) for d in both if len(d) == 2 and not d[0].startswith("<")}
    return frozenset(found | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))})


def kind(x: str) -> str:
    """L letter, N number, S white space, O other."""
    if x in SPACES:
        return "S"
    major = unicodedata.category(x)[0]
    return major if major in "LN" else "O"


class Vocabulary:
    """Tokens of a byte-pair vocabulary with word ends, and which of them may stand side by side."""

    def __init__(self, model: dict):
        self.end = model["end_of_word_suffix"]
        self.tokens = frozenset(model["vocab"])
        self.rank = {tuple(pair if isinstance(pair, list) else pair.split(" ")): i for i, pair in enumerate(model["merges"])}
        self.longest = max(len(t) for t in self.tokens)
        self.pairs: dict[tuple[str, str], bool] = {}
        self._arrays()
        self.sizes: dict[str, int] = {}  # of single characters and contractions

    def _letters(self, token: str) -> list[str]:
        if token.endswith(self.end) and len(token) > len(self.end):
            letters = list(token[:-len(self.end)])
            letters[-1] += self.end
            return letters
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """The symbols after all merges, best rank first, leftmost of equal ones."""
        while len(symbols) > 1:
            rank, at = min((self.rank.get(pair, len(self.rank)), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.rank):
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2:]]
        return symbols

    def fits(self, left: str, right: str) -> bool:
        """Whether the text of ``left`` then ``right`` is encoded as these two; an empty ``left`` asks for ``right`` alone."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._judge(left, right)
        return known

    def _judge(self, left: str, right: str) -> bool:
        letters = (self._letters(left) if left else []) + self._letters(right)
        return self.merged(letters) == ([left, right] if left else [right])


    def _arrays(self) -> None:
        """Hashes of the tokens' bytes in order, and for each the token within a word and the one that ends it (-1 if none)."""
        byte = {x: i for i, x in enumerate(byte_letters())}
        by_bytes: dict[bytes, list[int]] = {}
        self.names = [t for t in sorted(self.tokens) if t != self.end]
        for i, token in enumerate(self.names):
            ends = token.endswith(self.end)
            letters = token[:-len(self.end)] if ends else token
            if all(x in byte for x in letters):
                by_bytes.setdefault(bytes(byte[x] for x in letters), [-1, -1])[ends] = i
        data = np.frombuffer(b"".join(by_bytes), np.uint8)
        end = np.cumsum(np.fromiter(map(len, by_bytes), np.int64))
        begin = end - np.fromiter(map(len, by_bytes), np.int64)
        hashes, which = spans_hash(rolling(data), begin, end), np.array(list(by_bytes.values()), np.int64)
        order = np.argsort(hashes)
        self.spans, self.token_of = hashes[order], which[order]
        self.most_bytes = int((end - begin).max())
        # Known pairs as numbers in order with their answers, and those found since.
        self.pair, self.pair_fits, self.fresh = np.zeros(0, np.int64), np.zeros(0, bool), {}

    def fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`fits` for arrays of tokens, -1 for no left one."""
        keys = (left + 1) * len(self.names) + right
        at = np.minimum(np.searchsorted(self.pair, keys), max(0, len(self.pair) - 1))
        known = self.pair[at] == keys if len(self.pair) else np.zeros(len(keys), bool)
        out = np.zeros(len(keys), bool)
        out[known] = self.pair_fits[at[known]]
        for i in np.flatnonzero(~known):
            key = int(keys[i])
            if key not in self.fresh:
                self.fresh[key] = self._judge(self.names[left[i]] if left[i] >= 0 else "", self.names[right[i]])
            out[i] = self.fresh[key]
        return out

    def settle(self) -> None:
        """Puts the pairs found since the last call to the others."""
        if len(self.fresh) < 2048:
            return
        keys, fits = np.fromiter(self.fresh, np.int64), np.fromiter(self.fresh.values(), bool)
        if len(self.pair) >= PAIRS:
            self.pair, self.pair_fits = keys[:0], fits[:0]
        keys, fits = np.concatenate([self.pair, keys]), np.concatenate([self.pair_fits, fits])
        order = np.argsort(keys)
        self.pair, self.pair_fits, self.fresh = keys[order], fits[order], {}

    def runs(self, runs: list[bytes]) -> np.ndarray:
        """Counts of all prefixes of many short runs at once, one after the other; the same table as :class:`Run`'s, by arrays."""
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        order = np.argsort(-size, kind="stable")
        start = (np.cumsum(size) - size)[order]
        data = np.frombuffer(b"".join(runs), np.uint8)
        hashes, size, most = rolling(data), size[order], int(size.max())
        last, count = np.full((most + 1, len(runs)), -1, np.int64), np.zeros((most + 1, len(runs)), np.int32)
        out = np.zeros(len(data), np.int32)
        for n in range(1, most + 1):
            live = int(np.searchsorted(-size, -n, "right"))
            widths = np.arange(min(n, self.most_bytes), 0, -1)
            end = start[:live, None] + n
            wanted = spans_hash(hashes, end - widths, end)
            at = np.minimum(np.searchsorted(self.spans, wanted), len(self.spans) - 1)
            here = self.spans[at] == wanted
            for ends in (0, 1):
                token = self.token_of[at, ends]
                usable, rows = here & (token >= 0), np.arange(live)
                while len(rows):
                    col = usable[rows].argmax(axis=1)
                    if not usable[rows, col].all():
                        raise ValueError("the vocabulary lacks a byte")
                    before, found = n - widths[col], token[rows, col]
                    good = self.fit(last[before, rows], found)
                    done = rows[good]
                    total = count[before[good], done] + 1
                    if ends:
                        out[start[done] + n - 1] = total
                    else:
                        last[n, done], count[n, done] = found[good], total
                    usable[rows[~good], col[~good]] = False
                    rows = rows[~good]
        self.settle()
        lead = np.flatnonzero(data == 0xC3)  # of a letter of two bytes; both show the count behind it
        out[lead] = out[lead + 1]
        return out


class Run:
    """The table of one run of characters: last token and count of each prefix that does not end it."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.text, self.last, self.count = vocabulary, "", [""], [0]

    def _ending(self, mark: str) -> tuple[str, int]:
        """Last token and count of the text with ``mark`` put on."""
        words, n = self.vocabulary, len(self.text)
        for start in range(max(0, n - words.longest), n):
            token = self.text[start:] + mark
            if token in words.tokens and words.fits(self.last[start], token):
                return token, self.count[start] + 1
        raise ValueError("the vocabulary lacks a byte")

    def extend(self, x: str) -> None:
        for byte in x.encode("utf-8", "surrogatepass"):
            self.text += byte_letters()[byte]
            token, count = self._ending("")
            self.last.append(token)
            self.count.append(count)

    def whole(self) -> int:
        return self._ending(self.vocabulary.end)[1]

    def cut(self, n: int) -> None:
        self.text = self.text[:n]
        del self.last[n + 1:], self.count[n + 1:]


class Scan:
    """Tokens of the normalised characters fed so far, had the text ended with them."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.done, self.open, self.kind, self.run = 0, "", "", None

    def _size(self, piece: str) -> int:
        """Tokens of a single character or a contraction."""
        known = self.vocabulary.sizes.get(piece)
        if known is None:
            run = Run(self.vocabulary)
            for x in piece:
                run.extend(x)
            known = self.vocabulary.sizes[piece] = run.whole()
        return known

    def _close(self) -> None:
        if self.run is not None:
            self.done += self.run.whole()
        self.kind, self.run = "", None

    def _begin(self, x: str, what: str) -> None:
        self.kind, self.run = what, Run(self.vocabulary)
        self.run.extend(x)

    def feed(self, x: str) -> None:
        if self.open:  # an apostrophe that begins a piece, and perhaps a letter: a contraction or not
            longer = self.open + x
            if longer in SHORT or longer in LONG:
                self.done, self.open = self.done + self._size(longer), ""
                return
            if any(c.startswith(longer) for c in LONG):
                self.open = longer
                return
            letter, self.open = self.open[1:], ""
            self._begin("'", "O")
            if letter:
                self.feed(letter)
        what = kind(x)
        if what == self.kind:
            self.run.extend(x)
            return
        self._close()
        if what == "N":
            self.done += self._size(x)
        elif x == "'":
            self.open = x
        elif what != "S":
            self._begin(x, what)

    def tokens(self) -> int:
        if self.open:
            return self.done + sum(self._size(x) for x in self.open)
        return self.done + (self.run.whole() if self.run is not None else 0)

    def state(self) -> tuple:
        return self.done, self.open, self.kind, self.run, len(self.run.text) if self.run is not None else 0

    def back(self, state: tuple) -> None:
        self.done, self.open, self.kind, self.run, n = state
        if self.run is not None:
            self.run.cut(n)


def normal(cluster: str) -> str:
    """The normaliser of the tokenizer file, for characters that only depend on each other; lower case is by character."""
    return "".join(x.lower() for x in unicodedata.normalize("NFC", cluster))


class Counter:
    """``prefixes(texts)`` gives, for all bytes of the texts, the tokens of the text up to the byte's code point."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not splits_at_blanks(spec) or not spec["model"].get("end_of_word_suffix"):
            raise ValueError("prefix counts know byte-pair files with word ends that drop white space")
        self.vocabulary = Vocabulary(spec["model"])
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.hash, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def word(self, word: str) -> list[int]:
        """Tokens of each prefix of a word, from its first character on."""
        out, base, scan, begun = [], 0, Scan(self.vocabulary), 0
        marks = [m.span() for m in self.special.finditer(word)]
        for begin, end in [*marks, (len(word), len(word))]:
            cluster, before, ahead = "", scan.state(), base
            for at in range(begun, max(begin, end - 1)):
                if at == begin:
                    ahead = base + scan.tokens()
                x = word[at]
                if cluster and (unicodedata.combining(x) or x in followers()):
                    scan.back(before)
                    cluster += x
                else:
                    cluster, before = x, scan.state()
                for y in normal(cluster):
                    scan.feed(y)
                out.append(base + scan.tokens())
            if begin < end:
                base, scan, begun = ahead + 1, Scan(self.vocabulary), end
                out.append(base)
        return out

    def _all_bytes(self, found: list[bytes]) -> list[np.ndarray]:
        """Counts of each piece, per byte."""
        plain = [i for i, piece in enumerate(found) if len(piece) <= ARRAYS and PLAIN.fullmatch(piece) and b"<|" not in piece]
        out: list = [None] * len(found)
        if plain:
            counts = self.vocabulary.runs([found[i].decode().lower().encode() for i in plain])
            for i, own in zip(plain, np.split(counts, np.cumsum([len(found[i]) for i in plain])[:-1])):
                out[i] = own
        return [self._bytes_of(piece) if own is None else own for piece, own in zip(found, out)]

    def _bytes_of(self, piece: bytes) -> np.ndarray:
        text = piece.decode("utf-8", "surrogatepass")
        counts = np.array(self.word(text), np.int32)
        return counts if len(text) == len(piece) else np.repeat(counts, [len(x.encode("utf-8", "surrogatepass")) for x in text])

    def _some(self, texts: list[bytes]) -> np.ndarray:
        raw = b"\n".join([*texts, b""])
        data = np.frombuffer(raw, np.uint8)
        begin, end = pieces(data)
        if not len(begin):
            return np.zeros(len(data), np.int64)
        distinct, first, which = np.unique(spans_hash(rolling(data), begin, end), return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hash, distinct), max(0, len(self.hash) - 1))
        known = self.hash[at] == distinct if len(self.hash) else np.zeros(len(distinct), bool)
        got = self._all_bytes([raw[begin[i]:end[i]] for i in first[~known]])
        more = np.fromiter(map(len, got), np.int64, len(got))
        start, length = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        start[known], length[known] = self.start[at[known]], self.length[at[known]]
        start[~known], length[~known] = len(self.flat) + np.cumsum(more) - more, more
        flat = np.concatenate([self.flat, *got])
        if got and len(self.hash) + len(got) <= PIECES and len(flat) <= 8 * PIECES:
            put = np.searchsorted(self.hash, distinct[~known])
            self.flat = flat
            self.hash, self.start, self.length = (np.insert(a, put, b[~known]) for a, b in
                                                  ((self.hash, distinct), (self.start, start), (self.length, length)))
        start, length = start[which], length[which]
        total = flat[start + length - 1].astype(np.int64)
        base = np.cumsum(total) - total
        # A piece's bytes and the blanks after it: its own counts, then its last one.
        span = np.diff(np.append(begin, len(data)))
        offset = np.minimum(np.arange(len(data) - begin[0]) - np.repeat(begin - begin[0], span), np.repeat(length - 1, span))
        counts = np.zeros(len(data), np.int64)
        counts[begin[0]:] = np.repeat(base, span) + flat[np.repeat(start, span) + offset]
        heads = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        upto = np.append(base, base[-1] + total[-1])[np.searchsorted(begin, heads)]
        return counts - np.repeat(upto, [len(t) + 1 for t in texts])

    def prefixes(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Per text, the counts at the end of each code point."""
        for a, b in chunks(texts, 1 << 19):
            counts, at = self._some(texts[a:b]), 0
            for text in texts[a:b]:
                heads = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
                yield counts[at:at + len(text)][heads]
                at += len(text) + 1


def counter(path: str) -> Counter:
    """The worker's counter for this file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def prefix_store(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The store's rows for all of ``docs`` (doc_id, text)."""
    columns = [c.split()[0] for c in STORE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from zstandard import ZstdCompressor
        press = ZstdCompressor(level=1).compress
        for batch in batches:
            out, ids, texts = [], batch["doc_id"].astype("Int64").tolist(), batch["text"].tolist()
            for doc_id, text, counts in zip(ids, texts, counter(tokenizer).prefixes(texts)):
                key, n, tokens = md5(text).hexdigest(), len(counts), int(counts[-1]) if len(counts) else 0
                steps = np.diff(counts, prepend=0).astype("<i4")
                for block, start in enumerate(range(0, max(1, n), BLOCK)):
                    before = int(counts[start - 1]) if start else 0
                    out.append((doc_id, key, block, start, before, len(text), n, tokens, press(steps[start:start + BLOCK].tobytes())))
                if len(out) >= 500:
                    yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})
                    out = []
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    return docs.select("doc_id", text_bytes().alias("text")).mapInPandas(run, STORE)


def _counts(before: int, steps: bytes) -> np.ndarray:
    from zstandard import decompress
    return before + np.cumsum(np.frombuffer(decompress(steps), "<i4"), dtype=np.int64)


def tokens_at(store: DataFrame, cuts: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_chars, n_tokens) for ``cuts`` (doc_id, n_chars): tokens of the first ``n_chars`` code points, whole texts if shorter."""
    @F.pandas_udf("long")
    def read(at: pd.Series, before: pd.Series, steps: pd.Series) -> pd.Series:
        return pd.Series([int(_counts(b, s)[i]) if i >= 0 else 0 for i, b, s in zip(at, before, steps)], dtype="int64")

    asked = cuts.select("doc_id", F.greatest(F.col("n_chars"), F.lit(0)).alias("asked")).distinct()
    rows = store.drop("n_tokens").join(asked, store["doc_id"].eqNullSafe(asked["doc_id"])).drop(asked["doc_id"])
    last = F.least("asked", "n_chars") - 1
    rows = rows.where(F.greatest(last, F.lit(0)).between(F.col("start"), F.col("start") + (BLOCK - 1)))
    return rows.dropDuplicates(["doc_id", "text_key", "asked"]).select(
        "doc_id", "text_key", F.col("asked").alias("n_chars"), read(last - F.col("start"), "before", "steps").alias("n_tokens"))


def longest_prefix(store: DataFrame, budget: int) -> DataFrame:
    """(doc_id, text_key, n_chars, n_tokens): the longest prefix of each text with at most ``budget`` tokens, and its tokens."""
    @F.pandas_udf("n_chars long, n_tokens long")
    def fit(start: pd.Series, before: pd.Series, steps: pd.Series) -> pd.DataFrame:
        out = []
        for first, b, s in zip(start, before, steps):
            counts = _counts(b, s)
            good = np.flatnonzero(counts <= budget)
            out.append((first + good[-1] + 1, counts[good[-1]]) if len(good) else (0, 0))
        return pd.DataFrame(out, columns=["n_chars", "n_tokens"])

    found = store.select("doc_id", "text_key", fit("start", "before", "steps").alias("f"))
    return found.groupBy("doc_id", "text_key").agg(F.max(F.col("f")).alias("f")).select("doc_id", "text_key", "f.*")


def op12_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all whole texts of ``documents``, read at their last prefix."""
    import public_tokenizers
    store = prefix_store(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return store.where("block = 0").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
