import io
import zlib

import numpy as np
import pytest
from data import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shelfcast.llm import packfile
from shelfcast.llm.tokens import encoder
from shelfcast.sources.staging import new_path

ODD_TEXTS = ["", "<|endoftext|>x", "a<|startoftext|> b", "don't I'LL 's x\x01y é  z q 12 3.4 \x1c\x85", "É ÉA!! ß İ ﬁ Σσς", "x" * 5000, "á ́b",
             "’s ''S", "<|ENDOFTEXT|>", "×÷ café́", "naïve, (co-op) 50% a_b"]


def test_encoder_is_the_library(tokenizer, texts):
    given_texts = ODD_TEXTS + [t or "" for t in texts.values()]
    ids, lengths = encoder(tokenizer).ids([t.encode() for t in given_texts])
    want = [e.ids for e in Tokenizer.from_file(tokenizer).encode_batch(given_texts, add_special_tokens=False)]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aAzZéÉßçñ×÷'’.,!?-<>|09 \n\t ́İ漢ſ"), max_size=40))
def test_encoder_on_any_text(text):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, _ = encoder(path).ids([text.encode()])
    assert ids.tolist() == encoder(path).tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_file_round_trip_and_random_access(bits):
    class Kept(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    rng = np.random.default_rng(bits)
    out = Kept()
    writer = packfile.Writer(out, bits, block=64)
    docs = [rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 63, 64, 65, 5000, 0, 3)]
    for i, d in enumerate(docs):
        writer.add([i if i else None], d, np.array([len(d)]))
    header = writer.close()
    out.seek(0)
    out.write(header)
    reader = packfile.Reader(out)
    whole = np.concatenate(docs)
    for a, b in ((0, len(whole)), (0, 0), (63, 65), (64, 64), (100, 4321), (len(whole) - 1, len(whole))):
        assert np.array_equal(reader.read_span(a, b), whole[a:b])
    assert reader.index["start"].tolist() == [0, *np.cumsum([len(d) for d in docs])[:-1]] and reader.index["null"].tolist() == [1] + [0] * 7
    assert packfile.bits_for(2) == 1 and packfile.bits_for(49408) == 16 and packfile.bits_for(65537) == 17


def test_query_is_the_library(spark, texts, tokenizer):
    got = sorted(packfile.op5_packed_ids(spark, SF).collect())
    want, start = [], 0
    for doc_id, e in zip(texts, Tokenizer.from_file(tokenizer).encode_batch([t or "" for t in texts.values()], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_odd_rows(spark, odd, none, tokenizer):
    rows = sorted(packfile.read_packed(packfile.write_packed(odd, new_path(spark, "odd"), tokenizer, 1)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9, 10, 10, 11]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[2].n_tokens == 1
    assert packfile.read_packed(packfile.write_packed(none, new_path(spark, "none"), tokenizer, 1)).collect() == []


def test_case_before_combining_marks(tokenizer):
    """Letters that have a composed form in lower case only."""
    from shelfcast.llm.tokens import encoder
    library = Tokenizer.from_file(tokenizer)
    for text in ("H\u0331ello WORLD", "J\u030ca T\u0308x", "E\u0301cole H"):
        assert encoder(tokenizer).ids([text.encode()])[0].tolist() == library.encode(text, add_special_tokens=False).ids
