import numpy as np
import pytest
from data import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import prefixes

MIXED = ["don't they're we'll 're 'rest ''s '' ' 'lx 'vex 'S 'RE", "<|endoftext|> <|endoftex <|startoftext|>x!!<|endoftext|>é", "H̱ ẹ́ 한 Å",
         "Straße ÉCOLE 漢字かな🙂🙂👩‍👩‍👧 12½3 a1b2!?#", "İstanbul ΣΟΦΟΣ  x　y\x1c\x85z ​", "internationalization uncharacteristically zzzzzzzzzzzz", "́ ́a ='́s '́s ś 'ś"]


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def want(library, text):
    return [len(e.ids) for e in library.encode_batch([text[:k] for k in range(1, len(text) + 1)], add_special_tokens=False)]


def got(tokenizer, text):
    return next(prefixes.counter(tokenizer).prefixes([text.encode()])).tolist()


@pytest.mark.parametrize("text", MIXED)
def test_every_prefix(library, tokenizer, text):
    assert got(tokenizer, text) == want(library, text)


LETTERS = "aAeEinrtsSlLmvdhH'’ \t\ṇ̱́ éÉßİ漢🙂12½!<|>#-_한‍क्षि"


@settings(max_examples=400, deadline=None)
@given(st.text(LETTERS, max_size=24) | st.lists(st.sampled_from([*LETTERS, "<|endoftext|>", "'re", "'ll", " don't ", "tion", "ing "]), max_size=12).map("".join))
def test_any_text(library, tokenizer, text):
    assert got(tokenizer, text) == want(library, text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=16))
def test_unicode(library, tokenizer, text):
    assert got(tokenizer, text) == want(library, text)


def test_query(spark, texts, library):
    rows = {r.doc_id: r for r in prefixes.op12_prefix_counts(spark, SF).collect()}
    assert rows.keys() == texts.keys()
    for doc_id, e in zip(texts, library.encode_batch([t or "" for t in texts.values()], add_special_tokens=False)):
        r = rows[doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[doc_id] or "").encode()), len(e.ids), len(e.ids) > 2048)


def test_prefixes_of_whole_texts(spark, texts, library, tokenizer):
    """Every prefix of some texts, of any length, against the library."""
    for text in sorted(filter(None, texts.values()), key=len)[20:200:12]:
        at = np.unique(np.linspace(1, len(text), 60).astype(int))
        counts = got(tokenizer, text)
        assert [counts[k - 1] for k in at] == [len(e.ids) for e in library.encode_batch([text[:k] for k in at], add_special_tokens=False)]


def test_questions(spark, odd, library, tokenizer, monkeypatch):
    """Truncation and budgets from the store, over several blocks of a long text; other columns and repeats do not matter."""
    monkeypatch.setattr(prefixes, "BLOCK", 1 << 14)
    store = prefixes.prefix_store(odd, tokenizer).persist()
    rows = [r for r in odd.select("doc_id", "text").collect()]
    assert store.where("block = 0").count() == len(rows)
    best = {(r.doc_id, r.n_chars) for r in prefixes.longest_prefix(store, 100).collect()}
    short = {(r.doc_id, r.text) for r in rows if len(r.text or "") < 3000}
    for doc_id, text in short:
        counts = [0, *want(library, text or "")]
        assert (doc_id, max(k for k, n in enumerate(counts) if n <= 100)) in best
    long = next(r.text for r in rows if r.doc_id == 10 and len(r.text) > 100_000)
    counts = np.array([0, *got(tokenizer, long)])
    assert counts[-1] == len(library.encode(long, add_special_tokens=False).ids)
    assert (10, int(np.flatnonzero(counts <= 100)[-1])) in best
    cuts = spark.createDataFrame([(10, 0), (10, 5), (10, 70_000), (10, 10 ** 7), (None, 3)], "doc_id long, n_chars long")
    found = {(r.doc_id, r.n_chars, r.n_tokens) for r in prefixes.tokens_at(store, cuts).collect()}
    assert {(10, k, int(counts[min(k, len(counts) - 1)])) for k in (0, 5, 70_000, 10 ** 7)} <= found
    assert (None, 3, len(library.encode("no ", add_special_tokens=False).ids)) in found and (None, 3, 0) in found
    assert prefixes.prefix_store(odd.limit(0), tokenizer).isEmpty() and prefixes.longest_prefix(store.limit(0), 5).isEmpty()
    mixed = odd.select("doc_id", "text", F.lit("x").alias("BLOCK"), F.lit(1).alias("steps"))
    assert prefixes.prefix_store(mixed, tokenizer).where("block = 0").count() == len(rows)


def test_other_files_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError):
        prefixes.Counter(public_tokenizers.path("byte_bpe_50k.json"))
