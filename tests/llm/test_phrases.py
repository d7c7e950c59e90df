import hashlib
from itertools import takewhile

import numpy as np
from data import SF

from shelfcast.llm import phrases


def test_query_is_brute_force(spark, texts):
    got = {r.doc_id: r for r in phrases.op7_phrase_fingerprints(spark, SF).collect()}
    own = [t or "" for t in texts.values()]
    edited = [t[:len(t) - len(t) // 4] + n[:len(t) // 4] for t, n in zip(own, [*own[1:], own[0]])]
    alone = [phrases.sketches([t.encode()])[0] for t in own]
    changed = [phrases.sketches([t.encode()])[0] for t in edited]
    for i, (doc_id, text) in enumerate(zip(texts, own)):
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited[i].encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (phrases.to_hex(alone[i]), phrases.to_hex(changed[i]))
        assert r.near_edited == phrases.likeness(alone[i], changed[i]) and r.near_next == phrases.likeness(alone[i], alone[(i + 1) % len(own)])
    near = [(r.near_edited, r.near_next) for r in got.values() if r.n_chars > 200]
    assert np.mean([a for a, _ in near]) > 0.45 and np.mean([b < a for a, b in near]) > 0.98


def test_interior_names_do_not_depend_on_the_offset():
    rng = np.random.default_rng(1)
    inner = rng.integers(97, 110, 4000, dtype=np.uint8).tobytes()
    names = []
    for before in (b"", b"x", b"some other start, ", rng.integers(97, 110, 333, dtype=np.uint8).tobytes()):
        data = np.frombuffer(before + inner, np.uint8)
        level, owner = phrases.mix(data.astype(np.uint64) + np.uint64(1)), np.zeros(len(data), np.int64)
        for _ in range(3):
            level, owner = phrases._group(level, owner)
        names.append(level.tolist())
    for other in names[1:]:
        common = sum(1 for _ in takewhile(lambda pair: pair[0] == pair[1], zip(reversed(names[0]), reversed(other))))
        assert common > 0.9 * len(names[0])


def test_runs_and_small_texts():
    found = phrases.sketches([b"", b"a", b"aa", b"ab", b"a" * 100_000, b"ab" * 50_000, b"a"])
    assert len(found[0]) == 0 and all(len(f) for f in found[1:]) and np.array_equal(found[1], found[6])
    assert len({f.tobytes() for f in found[1:6]}) == 5
    assert phrases.likeness(found[0], found[0]) == 1 and phrases.likeness(found[0], found[1]) == 0
    assert np.array_equal(phrases.from_hex(phrases.to_hex(found[5])), found[5])


def test_odd_rows(spark, odd, none):
    rows = phrases.compare_with_next(odd).collect()
    assert len(rows) == odd.count()
    sixth = [r for r in rows if r.doc_id == 6]
    assert sixth[0].fingerprint == sixth[1].fingerprint and max(r.near_next for r in sixth) == 1
    assert next(r for r in rows if r.doc_id == 1).fingerprint == "" and all(0 <= r.near_edited <= 1 for r in rows)
    assert phrases.compare_with_next(none).collect() == []
    one = phrases.compare_with_next(odd.where("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1
