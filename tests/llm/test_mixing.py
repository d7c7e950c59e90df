import math
from collections import Counter, defaultdict

import pytest
from data import SF
from pyspark.sql import functions as F

from shelfcast.llm import mixing
from shelfcast.llm.tokens import encoder

SOURCES = {"a": 8000, "b": 1500, "c": 400, "d": 100}


def test_exponent_meets_the_limits():
    alpha = mixing.solve(SOURCES, 4.0, None)
    w = mixing.weights(SOURCES, alpha)
    per = [w[s] / t for s, t in SOURCES.items()]
    assert 0 < alpha < 1 and math.isclose(max(per) / min(per), 4.0, rel_tol=1e-6)
    alpha = mixing.solve(SOURCES, None, 1.1)
    assert math.isclose(mixing._entropy(mixing.weights(SOURCES, alpha)), 1.1, rel_tol=1e-6)
    assert mixing.solve(SOURCES, None, math.log(4) + 1) == 0 and mixing.solve(SOURCES, 1.0, None) == pytest.approx(1, abs=1e-9)
    assert mixing.solve(SOURCES, 4.0, 1.1) == max(mixing.solve(SOURCES, 4.0, None), mixing.solve(SOURCES, None, 1.1))


def test_budgets_are_met_to_a_document(spark, tokenizer):
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', cast(1 + id % 9 as int))").alias("text"),
                                      F.expr("case when id % 10 < 7 then 'big' when id % 10 < 9 then 'mid' else 'low' end").alias("source"))
    for how in ({"max_epochs": 3.0}, {"max_epochs": None, "budget": 20_000}, {"max_epochs": 2.5, "budget": 150_000}):
        rows = mixing.copies(docs, tokenizer, **how).select("source", "_weight", "_copies", (F.col("doc_id") % 9 + 1).alias("n")).collect()
        tokens, sent, weight = Counter(), Counter(), {}
        for r in rows:
            tokens[r.source] += r.n
            sent[r.source] += r.n * r._copies
            weight[r.source] = r._weight
        budget = how.get("budget") or max(tokens[s] / weight[s] for s in tokens)
        assert sum(weight.values()) == pytest.approx(1)
        for s in tokens:
            assert 0 <= weight[s] * budget - sent[s] + 1 <= 11
        if not how.get("budget"):
            assert min(r._copies for r in rows) == 1 and max(sent[s] / tokens[s] for s in tokens) <= 3


def brute(rows, tokens_of, max_epochs, per_block):
    """(source, id) -> copies, and each document's block, from rows (id, text, source, place in the source's permutation)."""
    own = defaultdict(list)
    for doc_id, text, source, at in rows:
        own[source].append((at, doc_id, tokens_of(text)))
    tokens = {s: sum(n for *_, n in docs) for s, docs in own.items()}
    w = mixing.weights(tokens, mixing.solve(tokens, max_epochs, None))
    size = max(t / w[s] for s, t in tokens.items() if t)
    found, block = {}, {}
    for source, docs in own.items():
        passes, rest = divmod(int(w[source] * size * (1 + 1e-12) + 0.5), tokens[source])
        width = (1 << 62) // -(-len(docs) // per_block) + 1
        sent = 0
        for at, doc_id, n in sorted(docs):
            sent += n
            found[source, doc_id] = passes + (sent <= rest)
            block[source, doc_id] = at // width
    return found, block


def check_positions(rows, want, block):
    """Copies as wanted; in each pass blocks and places without gaps, a block's documents together."""
    seen, streams = Counter(), defaultdict(lambda: defaultdict(list))
    for r in rows:
        seen[r.source, r.doc_id] += 1
        assert r.copies == want[r.source, r.doc_id]
        streams[r.source, r["pass"]][r.block].append((r.place, r.doc_id))
    assert seen == want
    for (source, turn), blocks in streams.items():
        assert sorted(blocks) == list(range(1, len(blocks) + 1))
        for own in blocks.values():
            assert sorted(p for p, _ in own) == list(range(1, len(own) + 1)) and len({block[source, d] for _, d in own}) == 1
        due = {d for (s, d), n in want.items() if s == source and n >= turn}
        assert {d for own in blocks.values() for _, d in own} == due
    return streams


def test_query_is_brute_force(spark, tokenizer, texts):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source", mixing.place(5)).collect()
    enc = encoder(tokenizer)
    want, block = brute(rows, lambda t: int(enc.ids([(t or "").encode()])[1][0]), 1.5, mixing.PER_BLOCK)
    got = mixing.op8_mixing(spark, SF).collect()
    check_positions(got, want, block)
    assert sorted({r.doc_id for r in got}) == list(texts) and {r.copies for r in got} <= {1, 2}


def test_positions_of_many_blocks_and_a_null_source(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(mixing, "PER_BLOCK", 50)
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', cast(1 + id % 9 as int))").alias("text"),
                                    F.expr("case when id % 10 < 7 then 'big' when id % 10 = 8 then '' end").alias("source"))
    rows = docs.select("doc_id", "text", "source", mixing.place(5)).collect()
    want, block = brute(rows, lambda t: len(t) // 2, 3.0, 50)
    streams = check_positions(mixing.positions(docs, tokenizer, max_epochs=3.0).collect(), want, block)
    assert {s for s, _ in streams} == {"big", "", None}
    orders = {t: [d for b in sorted(own) for _, d in sorted(own[b])] for (s, t), own in streams.items() if s == ""}
    assert len(orders) >= 2 and sorted(orders[1]) != orders[1] and orders[1][:20] != orders[2][:20]


def test_count_is_the_encoder(spark, tokenizer, texts):
    got = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", mixing.token_count(tokenizer)).collect()}
    assert [got[i] for i in texts] == encoder(tokenizer).ids([(t or "").encode() for t in texts.values()])[1].tolist()


def test_odd_rows(spark, odd, none, tokenizer):
    out = mixing.mix(odd, tokenizer)
    assert out.columns == odd.columns
    fates = defaultdict(set)
    for r, n in Counter((r.doc_id, r.text, r.source) for r in out.collect()).items():
        fates[r].add(n)
    assert set(fates) == {(r.doc_id, r.text, r.source) for r in odd.collect()}
    assert mixing.mix(none, tokenizer).collect() == [] and mixing.positions(none, tokenizer).collect() == []
    assert mixing.positions(odd, tokenizer).count() == out.count()
    assert mixing.mix(odd.where("doc_id in (1, 2, 3)"), tokenizer).count() == 3
