import random
import re

import numpy as np
import pytest
import xxhash

from shelfcast.llm import simhash
from shelfcast.llm.components import components
from data import SF


def brute_fingerprint(text, width=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius):
    near = np.bitwise_count(np.array(prints, np.uint64)[:, None] ^ np.array(prints, np.uint64)[None, :]) <= radius
    at = np.arange(len(ids))
    while True:
        new = np.array([at[row].min() for row in near])
        if (new == at).all():
            return [ids[i] for i in at]
        at = new


def test_query_is_brute_force(spark, texts):
    got = {r.doc_id: r for r in simhash.op1_simhash_vptree(spark, SF).collect()}
    prints = [brute_fingerprint(t) for t in texts.values()]
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in zip(texts, prints)}
    assert [got[i].component_id for i in texts] == brute_components(list(texts), prints, 2)


@pytest.mark.parametrize("leaf", [1, 16, 1000])
def test_routed_shards_and_forest_lose_no_link(leaf):
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (60, 40), dtype=np.uint64)
    points = np.unique(np.concatenate([base, (base[:, None] ^ flips).ravel(), (base[:, None] ^ flips ^ np.roll(flips, 1, 1)).ravel()]))
    tree = simhash.Tree(points[::3], leaf, 2)
    at, where = tree.route(points)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    together = np.zeros_like(near)
    for shard in np.unique(where):
        own = at[where == shard]
        together[np.ix_(own, own)] = True
    assert not (near & ~together).any()
    want = brute_components(list(range(len(points))), points, 2)
    assert simhash.forest(points, 2).tolist() == want


def test_components_are_those_of_the_graph(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7777, 7777)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == root and len(got) == len(root)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert {c for i in (1, 2, 3) for _, c in by[i]} == {1} and {f for f, _ in by[1]} == {"0" * 16}
    assert by[6] == by[7] and {c for _, c in by[7]} == {6}
    assert (f"{brute_fingerprint('no id here ' * 20):016x}", None) in by[None] and ("0" * 16, 1) in by[None]
    assert simhash.near_duplicates(none).collect() == []
