import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm.substring import FingerprintIndex, dedup_substrings


def brute(rows, window):
    """doc_id -> list of (n_words, n_removed, kept) for each row."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    owner = {}
    for i, w in words:
        if i is None:
            continue
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            owner[g] = min(owner.get(g, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1) if i is not None else ():
            if owner[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=repr)


def run(df, **options):
    got = dedup_substrings(df, layout=False, **options).select("doc_id", "n_words", "n_removed", "text").collect()
    return sorted((tuple(r) for r in got), key=repr)


def corpus(seed, n, vocabulary=40):
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(5, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randrange(0, 5)):
            w += rng.choice(passages) if rng.random() < 0.6 else [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(12))]
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 2), (3, 3)])
def test_against_brute_force(docs, seed, batches):
    rows = corpus(seed, 60)
    assert run(docs(rows), window=12, batches=batches) == brute(rows, 12)


def test_defined_cases(docs):
    long = " ".join(f"x{k % 977}" for k in range(60_000))
    text = " ".join(f"a{k}" for k in range(30))
    rows = [(1, text), (1, text), (2, f"  {text}\t\n b"), (3, None), (4, ""), (5, long), (6, long), (None, text), (7, " \n")]
    df = docs(rows, spans=1, doc=2, windows=3, n_words=9, __x=4)
    assert run(df, window=10) == brute(rows, 10)
    kept = dedup_substrings(df, window=10).where("doc_id = 2 or doc_id = 3").orderBy("doc_id").collect()
    assert kept[0]["text"] == "  b" and kept[1]["text"] is None
    assert kept[0]["spans"] == 1 and kept[0]["doc"] == 2 and kept[0]["n_removed"] == 30


def test_empty(docs):
    assert run(docs([])) == []


@pytest.mark.parametrize("fanout,batches", [(2, 2), (8, 1)])
def test_calls_on_one_folder_are_as_one_call(spark, docs, tmp_path, fanout, batches):
    """Each call opens the index anew; earlier texts aren't at hand any more."""
    rows = corpus(5, 90)
    got = []
    for lo in range(0, 90, 30):
        index = FingerprintIndex(spark, str(tmp_path), fanout=fanout)
        got += run(docs(rows[lo : lo + 30]), window=12, batches=batches, index=index)
        assert len(index.runs) <= fanout and len(index.logs) == batches * (lo // 30 + 1)
    assert sorted(got, key=repr) == brute(rows, 12)
    runs = [p.name for p in tmp_path.iterdir() if p.name.startswith("run-")]
    assert sorted(runs) == sorted(FingerprintIndex(spark, str(tmp_path)).runs)
    # A day that was indexed already, under other ids, has nothing new.
    again = dedup_substrings(docs([(i - 1000, t) for i, t in rows]), window=12, index=FingerprintIndex(spark, str(tmp_path)))
    assert again.where("n_words >= 12 and n_removed = 0").count() == 0


def test_a_batch_that_died_leaves_the_index_as_it_was(spark, docs, tmp_path):
    from trailmark.llm.substring import segments

    text = " ".join(f"a{k}" for k in range(30))
    index = FingerprintIndex(spark, str(tmp_path))
    index.append(segments(docs([(1, text)]).selectExpr("doc_id as doc", "text"), 12))  # never committed
    assert run(docs([(2, text)]), window=12, index=FingerprintIndex(spark, str(tmp_path))) == [(2, 30, 0, text)]
    assert run(docs([(3, text)]), window=12, index=FingerprintIndex(spark, str(tmp_path))) == [(3, 30, 30, "")]


def thue_morse(n, a, b):
    return [b if bin(k).count("1") & 1 else a for k in range(n)]


def test_patterned_words_and_texts_do_not_collide(docs):
    """A sequence and its complement agree in every polynomial modulo a power of two, if long enough."""
    w = [f"w{k}" for k in range(49)]
    one, two = "".join(thue_morse(4096, "a", "b")), "".join(thue_morse(4096, "b", "a"))
    three, four = " ".join(thue_morse(4096, "a", "b")), " ".join(thue_morse(4096, "b", "a"))
    rows = [(1, " ".join([one, *w])), (2, " ".join([two, *w])), (3, " ".join([*w, one])), (4, " ".join([*w, two])), (5, three), (6, four), (7, "x " + three)]
    assert run(docs(rows)) == brute(rows, 50)
    assert [r[2] for r in run(docs(rows[:4]))] == [0, 0, 0, 0]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\tß", max_size=60), max_size=12))
def test_any_texts(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(df, window=4) == brute(rows, 4)
