import random

import numpy as np
import pytest
import xxhash

from trailmark.llm.components import components
from trailmark.llm.simhash import Planes, block_keys, forest, link, near_copies, near_dedup, safe_radius, simhash_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = (text or "").translate(LOWER).encode().split()
    return [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def fingerprint(text):
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles(text, 3)]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def roots(ids, linked):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    for lanes, radius in ((1, 0), (1, 2), (1, 3), (2, 20), (2, 36)):
        p = rng.integers(0, 1 << 63, (150, lanes)).astype(np.uint64)
        for k in range(1, 150, 3):
            p[k] = p[0] ^ np.uint64(rng.integers(0, 4) << rng.integers(0, 60))
        planes = Planes(p)
        for q in (0, 1, 77):
            far = np.array([sum(int(x).bit_count() for x in row ^ p[q]) for row in p])
            assert planes.within(planes.query[q], radius).tolist() == np.flatnonzero(far <= radius).tolist()
            assert planes.within(planes.query[q], radius, 70).tolist() == [k for k in np.flatnonzero(far <= radius) if k >= 70]


def test_forest_spans_the_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 6)
    p = np.array([int(b) ^ (1 << int(rng.integers(0, 40))) for b in np.repeat(base, 30)], np.uint64)
    want = roots(range(len(p)), lambda a, b: (int(p[a]) ^ int(p[b])).bit_count() <= 2)
    edges = forest(p, 2)
    assert roots(range(len(p)), lambda a, b: (a, b) in set(edges)) == want
    assert len(edges) == len(p) - len(set(want.values()))


def test_components(spark):
    rng = random.Random(3)
    path = [(k, k + 1) for k in range(100, 160)]
    edges = path + [(7, k) for k in range(8, 60)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5), (None, 1)]
    ids = sorted({x for e in edges if None not in e and e[0] != e[1] for x in e})
    pairs = {tuple(sorted(e)) for e in edges if None not in e}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots(ids, lambda a, b: (a, b) in pairs)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_with_hot_blocks(spark):
    rng = random.Random(4)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 300:
        p = rng.choice(sorted(prints)) if rng.random() < 0.5 else base
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "print long, rep long")
    want = roots(range(len(prints)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    for hot in (4096, 8):
        got = {r["rep"]: r["root"] for r in link(df, 2, hot).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_contract_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(900, None), (901, ""), (902, " \t"), (903, "One"), (904, "one"), (None, "one"), (903, "One")]
    got = simhash_components(docs(rows, fingerprint="x", component_id=1, print=2)).collect()
    prints = {}
    for i, t in rows:
        if i is not None:
            prints[i] = fingerprint(t)
    want = roots(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert len(got) == len(rows)
    for r in got:
        i = 904 if r["doc_id"] is None else r["doc_id"]
        assert r["fingerprint"] == f"{prints[i]:016x}" and r["component_id"] == want[i]
    assert simhash_components(docs([])).collect() == []


def near_corpus(seed=5, n=25):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        w = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(40, 200))]
        rows.append(" ".join(w))
        for _ in range(rng.randrange(4)):
            v = list(w)
            for _ in range(rng.randrange(0, 8)):
                v[rng.randrange(len(v))] = f"w{rng.randrange(5000)}"
            rows.append(" ".join(v))
    return list(enumerate(rows))


def test_near_copies_against_brute_force(docs):
    rows = near_corpus() + [(800, None), (801, ""), (802, "a b"), (803, "A b"), (804, "a b c")]
    sets = {i: set(shingles(t, 5)) for i, t in rows}

    def linked(a, b):
        x, y = sets[a], sets[b]
        return bool(x and y) and len(x & y) >= 0.8 * len(x | y)

    want = roots(sorted(sets), linked)
    for tile, leaders in ((1500, 8), (3, 8), (3, 1)):
        got = {r["doc_id"]: r["component_id"] for r in near_copies(docs(rows), tile=tile, leaders=leaders).collect()}
        assert {i: got.get(i, i) for i in want} == want
    df = docs(rows + [(None, rows[0][1])], band=1, key=2, __y=3)
    kept = near_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(set(want.values()))
    assert kept.where("doc_id is null").count() == 1
    assert near_dedup(docs([])).collect() == []


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_pairs_of_just_the_similarity_are_found(docs, similarity):
    """Pairs of texts, short and long, that have exactly this share of their shingles in common, and none with any other pair."""
    rng = random.Random(6)
    rows, n = [], 150
    for k in range(n):
        size = rng.choice((20, 60, 180))
        both = round(2 * size * similarity / (1 + similarity))
        while both / (2 * size - both) < similarity:
            both += 1
        w = [f"{k}-{i}" for i in range(2 * size + 4)]
        rows += [(2 * k, " ".join(w[: size + 4])), (2 * k + 1, " ".join(w[size - both : 2 * size - both + 4]))]
    got = {r["doc_id"]: r["component_id"] for r in near_copies(docs(rows), similarity=similarity).collect()}
    assert set(got.values()) <= {2 * k for k in range(n)} and len(got) >= 2 * n * 0.99


def test_keys_and_radius_follow_the_similarity():
    assert block_keys(0.8) == (10, 3) and block_keys(0.5) == (10, 1) and block_keys(1.0)[0] == 1
    assert [safe_radius(s) for s in (0.5, 0.8, 1.0)] == [65, 44, 0]
    with pytest.raises(ValueError):
        block_keys(0)


def test_near_copies_of_the_tables(spark):
    """Every pair of sf0.01 that brute force finds is in one component."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    sets = {i: set(shingles(t or "", 5)) for i, t in rows}
    want = roots(sorted(sets), lambda a, b: bool(sets[a] and sets[b]) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    got = {r["doc_id"]: r["component_id"] for r in near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: got.get(i, i) for i in want} == want and len(got) > 50
