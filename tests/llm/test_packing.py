import zlib
from collections import defaultdict, deque

import numpy as np
from data import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import packing


def check(pieces, want, window):
    """Every id in one piece, pieces without gaps, all sequences but the last full."""
    for doc, ids in want.items():
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]] and sum(p.length for p in own) == len(ids)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes()) and p.doc_tokens == len(ids) for p in own)
    by = defaultdict(list)
    for p in pieces:
        by[p.sequence_id].append(p)
    for number, own in by.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert sum(p.length for p in own) == window or number == len(by) - 1


def test_query(spark, texts, tokenizer):
    encoded = Tokenizer.from_file(tokenizer).encode_batch([t or "" for t in texts.values()], add_special_tokens=False)
    check(packing.op6_packing(spark, SF).collect(), {d: np.array([*e.ids, 2], "<u4") for d, e in zip(texts, encoded)}, 4096)


def test_slabs_carry_deficits(spark, tokenizer):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('a b c ', cast(1 + pmod(id * 37, 40) as int))").alias("text"),
                                    F.expr("case when id % 4 < 2 then 'big' when id % 4 = 2 then 'mid' else 'low' end").alias("source"))
    pieces = packing.pack(docs, tokenizer, window=256, slab_tokens=5000).collect()
    total, windows = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for p in pieces:
        total[p.source] += p.length
        windows[p.sequence_id][p.source] += p.length
    whole = sum(total.values())
    assert len(windows) == -(-whole // 256)
    # After any number of windows a source is within two documents of its share, across slabs too.
    for source, tokens in total.items():
        sent = np.cumsum([windows[i][source] for i in range(len(windows) - 1)])
        due = np.arange(1, len(windows)) * 256 * tokens / whole
        assert np.abs(sent - due).max() <= 256


def test_weights_drain_and_order(tokenizer):
    queues = {"a": deque((("a", i), 10) for i in range(30)), "b": deque((("b", i), 10) for i in range(10))}
    sent = list(packing.round_robin(queues, {"a": 0.5, "b": 0.5}, {"a": 0.0, "b": 0.0}, 0, 20))
    first = [s for s in sent if s[3] < 200]
    assert sum(n for k, _, n, _ in first if k[0] == "b") == 100 and sum(s[2] for s in sent) == 400


def test_odd_rows(spark, odd, none, tokenizer):
    pieces = packing.pack(odd, tokenizer, window=64, slab_tokens=1000).collect()
    n = sum(p.length for p in pieces)
    spots = sorted((p.sequence_id * 64 + p.offset, p.length) for p in pieces)
    assert [s for s, _ in spots] == [0, *np.cumsum([m for _, m in spots])[:-1]] and n == spots[-1][0] + spots[-1][1]
    assert sum(p.start == 0 for p in pieces) == odd.count()
    assert packing.pack(none, tokenizer).collect() == []
    weighted = packing.pack(odd, tokenizer, window=64, slab_tokens=1000, weights={"a": 0.9, "b": 0.1}).collect()
    assert sum(p.length for p in weighted) == n


def test_a_null_source_is_its_own(spark, tokenizer):
    docs = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.expr("repeat('a ', 20)").alias("text"),
                                   F.expr("case when id % 3 = 0 then '' when id % 3 = 1 then 'b' end").alias("source"))
    rows = packing.pack(docs, tokenizer, window=210, slab_tokens=2100, weights={None: 0.5, "": 0.25, "b": 0.25}).collect()
    first = [r for r in rows if r.sequence_id < 10]
    sent = {s: sum(r.length for r in first if r.source == s) for s in (None, "", "b")}
    assert abs(sent[None] - 1050) <= 63 and abs(sent[""] - 525) <= 63 and abs(sent["b"] - 525) <= 63
    assert sum(r.length for r in rows) == 300 * 21
