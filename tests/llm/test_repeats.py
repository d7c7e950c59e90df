import hashlib
import random

import numpy as np
import pytest
from data import SF
from pyspark.sql import functions as F

from shelfcast.llm import repeats


def brute(texts, window=100):
    """Mask of removed bytes of each text, in order."""
    seen, masks = set(), []
    for text in texts:
        cover = np.zeros(len(text) + 1, int)
        for i in range(len(text) - window + 1):
            if text[i:i + window] in seen:
                cover[i] += 1
                cover[i + window] -= 1
            else:
                seen.add(text[i:i + window])
        masks.append(np.cumsum(cover)[:-1] > 0)
    return masks


def digest(text, mask):
    edges = np.diff(mask.astype(int), prepend=0, append=0)
    return len(text), int(mask.sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(text, np.uint8)[~mask].tobytes()).hexdigest()


def test_index_against_all_windows():
    rnd = random.Random(3)
    for _ in range(150):
        base = bytes(rnd.choice(b"abc") for _ in range(60))
        parts = []
        for _ in range(rnd.randint(1, 9)):
            a = rnd.randint(0, 40)
            part = base[a:a + rnd.randint(10, 40)]
            parts.append((part[:len(part) // 2] + bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 3))) + part[len(part) // 2:]).ljust(8, b"a"))
        seen = set()
        for part, later in zip(parts, repeats.repeated_windows(parts, 8)):
            want = []
            for i in range(len(part) - 7):
                want.append(part[i:i + 8] in seen)
                seen.add(part[i:i + 8])
            assert later.tolist() == want


def test_phrases_that_share_a_window_share_a_flank():
    rnd = random.Random(8)
    met = 0
    for _ in range(60):
        shared = bytes(rnd.choice(b"abcdefgh") for _ in range(rnd.randint(40, 60)))
        sides = []
        for _ in range(2):
            text = bytes(rnd.choice(b"abcdefgh") for _ in range(rnd.randint(0, 50))) + shared + bytes(rnd.choice(b"abcdefgh") for _ in range(rnd.randint(0, 50)))
            if len(text) < 40:
                continue
            found = repeats.phrases(np.frombuffer(text, np.uint8), 40, 8)
            sides.append([(a, l, r, {text[i:i + 40] for i in range(s, s + n)}) for s, n, a, _, l, r in zip(*(x.tolist() for x in found))])
        for a, left, right, windows in sides[0]:
            for b, other_left, other_right, others in sides[1]:
                if windows & others:
                    met += 1
                    assert a == b and (left and left == other_left or right and right == other_right)
    assert met > 50


def test_runs_are_fewer_than_symbols_where_text_repeats():
    part = bytes(random.Random(1).choice(b"abcdefgh") for _ in range(150))
    index = repeats.RunLengthIndex([part] * 50)
    assert index.n == 50 * 151 and len(index.heads) < index.n / 10
    before, match = index.stream()
    text = np.concatenate([np.append(np.frombuffer(part, np.uint8).astype(int), -i - 1) for i in range(50)])
    for i in range(0, index.n, 37):
        if before[i] >= 0:
            n = max(0, match[i])
            assert (text[i:i + n] == text[before[i]:before[i] + n]).all()


def test_query_is_brute_force(spark, texts):
    got = {r.doc_id: tuple(r)[1:] for r in repeats.op4_repeats(spark, SF).collect()}
    data = [(t or "").encode() for t in texts.values()]
    assert [got[i] for i in texts] == [digest(t, m) for t, m in zip(data, brute(data))]


@pytest.mark.parametrize("how", [{"hot": 1}, {"hot": 3, "shard_bytes": 3000}, {"k": 40}])
def test_lines_passages_and_edits(spark, how):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(rnd.randint(2, 9)))
    line, passage = "A line of ninety bytes that stands in each text, with other words before and after. ", " ".join(word() for _ in range(70))
    base = " ".join(word() for _ in range(400))
    rows = []
    for i in range(120):
        text = " ".join(word() for _ in range(30)) + line + word() + (passage if i % 3 == 0 else "") + " ".join(word() for _ in range(20))
        if i % 4 == 0:
            words = base.split()
            words[rnd.randrange(400)] = word()
            text += " ".join(words)
        rows.append((i * 7 % 120, text + "z" * (250 if i % 10 == 0 else 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    left = {r.doc_id: r.text for r in repeats.remove_repeats(frame, **how).collect()}
    data = [t.encode() for _, t in sorted(rows)]
    assert [left[i].encode() for i in range(120)] == [np.frombuffer(t, np.uint8)[~m].tobytes() for t, m in zip(data, brute(data))]


def test_texts_without_an_id_whose_short_hashes_are_equal(spark):
    texts = spark.range(400_000).select(F.concat(*[F.sha2(F.concat("id", F.lit(f"/{i}")), 512) for i in range(2)]).alias("text"))
    pairs = (texts.groupBy(F.shiftrightunsigned(F.xxhash64("text"), 33)).agg(F.collect_list("text").alias("two")).where("size(two) = 2")
             .limit(3).collect())
    assert pairs
    for pair in pairs:
        frame = spark.createDataFrame([(None, pair.two[0]), (None, pair.two[1]), (1, pair.two[0]), (2, "x" + pair.two[1])], "doc_id long, text string")
        rows = repeats.remove_repeats(frame.repartition(3)).collect()
        assert sorted(r.text for r in rows if r.doc_id is None) == sorted(pair.two)
        assert {r.doc_id: r.text for r in rows if r.doc_id} == {1: "", 2: "x"}


def test_odd_rows(spark, odd, none):
    out = repeats.remove_repeats(odd)
    assert out.columns == odd.columns
    rows = out.collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r.text for r in rows if r.doc_id not in (None, 10, 6)}
    assert by[1] == "" and by[4] == "x" and by[7] == "" and by[11] == "y"
    # Rows that repeat a document fare alike; a null doc_id comes before all.
    sixth = b"ein Satz " * 30
    assert [r.text for r in rows if r.doc_id == 6] == [np.frombuffer(sixth, np.uint8)[~brute([sixth])[0]].tobytes().decode()] * 2
    assert len([r for r in rows if r.doc_id == 10 and r.text.startswith("other")]) == 1
    assert repeats.remove_repeats(none).collect() == []
