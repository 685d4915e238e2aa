import random

import pytest

from trailmark.llm.decontaminate import drop_leaks, find_leaks, with_leaks

rng = random.Random(9)
ITEMS = [" ".join(f"q{rng.randrange(400)}" for _ in range(n)) for n in (15, 16, 30, 59, 200)]


def sub(text, *places):
    w = text.split()
    for p in places:
        w[p] = "other"
    return " ".join(w)


def around(text):
    return " ".join(f"r{rng.randrange(400)}" for _ in range(50)) + " " + text + " " + " ".join(f"r{rng.randrange(400)}" for _ in range(50))


@pytest.fixture
def bench(spark):
    rows = [(k, t) for k, t in enumerate(ITEMS)] + [(90, None), (91, ""), (92, "too short to tell"), (None, ITEMS[0]), (2, ITEMS[2])]
    return spark.createDataFrame(rows, "item_id long, text string")


CASES = [
    (1, around(ITEMS[0]), {0}),
    (2, around(ITEMS[1].upper().replace(" ", ",  ") + "."), {1}),
    (3, around(sub(ITEMS[2], 14)), {2}),
    (4, around(sub(ITEMS[3], 10, 30, 45)), {3}),
    (5, ITEMS[4], {4}),
    (6, around(" ".join(ITEMS[4].split()[60:90])), {4}),
    (7, around(" ".join(ITEMS[3].split()[:9])), set()),
    (8, around("nothing"), set()),
    (9, None, set()),
    (10, "", set()),
    (11, around(ITEMS[0]) + " " + ITEMS[3] + " " + ITEMS[0], {0, 3}),
    (12, "w " * 30_000 + ITEMS[2], {2}),
    (None, ITEMS[1], {1}),
    (1, around(ITEMS[0]), {0}),
]


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_planted_passages(docs, bench, broadcast):
    df = docs([(i, t) for i, t, _ in CASES], item_id=1, h=2, leaks=3, t1=4)
    got = with_leaks(df, bench, broadcast_tokens=broadcast).collect()
    found = sorted(((r["doc_id"], {x["item_id"] for x in r["leaks"]}) for r in got), key=repr)
    assert found == sorted(((i, s) for i, _, s in CASES), key=repr)
    assert got[0]["item_id"] == 1 and got[0]["t1"] == 4
    pairs = find_leaks(df, bench, broadcast_tokens=broadcast).collect()
    assert len(pairs) == sum(len(s) for _, _, s in CASES)
    assert all(r["n_equal"] >= 11 for r in pairs)


def test_empty_tables(spark, docs, bench):
    none = spark.createDataFrame([], "item_id long, text string")
    df = docs([(1, ITEMS[0]), (2, "b")], leaks=3)
    assert drop_leaks(df, none).count() == 2 and drop_leaks(df, none).columns == df.columns
    assert drop_leaks(docs([]), bench).collect() == []
    assert [r["doc_id"] for r in drop_leaks(df, bench).collect()] == [2]


def test_every_leak_of_the_tables_is_found(spark):
    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, items).collect()}
    known = {r["item_id"]: r["text"].split() for r in items.collect()}
    want = set()
    for r in docs.collect():
        text = f" {' '.join(r['text'].split())} "
        want |= {(r["doc_id"], i) for i, w in known.items() if f" {' '.join(w)} " in text}
    assert want <= got and len(got - want) <= 2


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_short_items_and_scripts_without_spaces(spark, docs, broadcast):
    """Items under ten words are found word for word; Chinese, Japanese and Thai items by their characters."""
    zh = "".join(chr(0x4E00 + 37 * k) for k in range(60))
    th = "".join(chr(0x0E01 + k * 7 % 46) for k in range(50))
    items = [(1, "what is the capital of France?"), (2, "one two three four five six seven eight nine"), (3, zh), (4, th), (5, "東京は日本の首都"), (6, "word"), (7, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (1, around("What is the  capital of france"), {1}),
        (2, around("what is the old capital of France?"), set()),
        (3, items[1][1] + " " + items[1][1] + " word.", {2, 6}),
        (4, "one two three four five six seven eight", set()),
        (5, "see BERT" + zh[:20] + "、" + zh[20:] + "。end", {3}),
        (6, zh[5:40], {3}),
        (7, zh[5:25], set()),
        (8, "x " + th + " y", {4}),
        (9, "昔、東京は日本の首都だ。", {5}),
        (10, "東京は日本の", set()),
        (11, "words", set()),
        (12, "wo", set()),
    ]
    got = with_leaks(docs([r[:2] for r in rows]), bench, broadcast_tokens=broadcast).collect()
    assert {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in got} == {i: s for i, _, s in rows}
    assert [tuple(x) for r in got if r["doc_id"] == 3 for x in r["leaks"]] == [(2, 9, 9, 9), (6, 1, 18, 1)]


def spelt_out(text, items):
    """Leaks by every diagonal that a seed hits, hit by hit, and every stretch of it."""
    import numpy as np
    import pyarrow as pa

    from trailmark.llm import decontaminate as D

    def tokens(t):
        w = D.Tokens(pa.array([t]))
        return w.bare_hashes().tolist()

    x, best = tokens(text), {}
    for i, item in items:
        y = tokens(item)
        masks = D.MASKS if len(y) >= D.SPAN else [range(len(y))]
        size = min(len(y), D.SPAN)
        if not size:
            continue
        ahead = {p - q for p in range(len(x) - size + 1) for q in range(len(y) - size + 1) if any(all(x[p + k] == y[q + k] for k in m) for m in masks)}
        if size < D.SPAN:
            ahead = {max(ahead)} if ahead else set()
        for d in ahead:
            lo, hi = max(d, 0), min(len(x), d + len(y))
            equal = [x[p] == y[p - d] for p in range(lo, hi)]
            top, got = 0, None
            for e in range(1, len(equal) + 1):  # the first stretch to end with the best sum, and its shortest form
                total = n = 0
                for a in range(e - 1, -1, -1):
                    total += 1 if equal[a] else -2
                    n += equal[a]
                    if total > top:
                        top, got = total, (n, lo + a, e - a)
            if got and got[0] >= D.needed(np.array(y, np.uint64)):
                best[i] = max(best.get(i, (0, 0, 0)), got)
    return sorted((i, *v) for i, v in best.items())


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_against_every_diagonal_spelt_out(spark, docs, broadcast):
    """Random substitutions, repeated words, stretches that stand apart on one diagonal, long copies."""
    r = random.Random(4)
    items = [(k, " ".join(f"q{r.randrange(300)}" for _ in range(n))) for k, n in enumerate((4, 9, 12, 20, 45, 90, 400))]
    items += [(20, "same " * 40), (21, "a b " * 15), (22, " ".join(f"s{k % 6}" for k in range(50)))]
    rows = []
    for n in range(150):
        w = []
        for _ in range(r.randrange(1, 4)):
            w += [f"r{r.randrange(50)}" for _ in range(r.randrange(30))]
            _, item = r.choice(items)
            x = item.split()
            lo = r.randrange(max(1, len(x) - 8))
            x = x[lo : lo + r.randrange(4, len(x) + 1)]
            rate = r.choice((0, 0.02, 0.1, 0.2))
            w += ["other" if r.random() < rate else t for t in x]
        rows.append((n, " ".join(w)))
    rows += [(900, "pre " * 3 + items[6][1] + " post"), (901, "same " * 700), (902, "b a " * 60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {d["doc_id"]: [tuple(x) for x in d["leaks"]] for d in with_leaks(docs(rows), bench, broadcast_tokens=broadcast).collect()}
    assert got[900] == [(6, 400, 3, 400)]
    assert sum(map(len, got.values())) > 100
    assert got == {i: spelt_out(t, items) for i, t in rows}


def test_long_texts_of_one_word_end(docs, spark):
    bench = spark.createDataFrame([(1, "same " * 300), (2, "same other " * 300)], "item_id long, text string")
    got = with_leaks(docs([(1, "same " * 100_000), (2, "same other " * 50_000)]), bench).collect()
    assert {r["doc_id"]: {x["item_id"] for x in r["leaks"]} for r in got} == {1: {1}, 2: {2}}
