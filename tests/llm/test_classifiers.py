import zlib

import numpy as np
import pyarrow as pa
import pytest

from trailmark.llm import quality, toxicity

DIR = "/root/testdata/sf0.1"


def auc(score, label):
    rank = np.empty(len(score))
    rank[np.argsort(score)] = np.arange(len(score))
    n = label.sum()
    return (rank[label == 1].mean() - (n - 1) / 2) / (len(label) - n)


@pytest.mark.parametrize("op,label,folds,held_out,least", [(toxicity, "toxic", 4, 2, 0.95), (quality, "quality", 5, 0, 0.85)])
def test_held_out_accuracy(spark, op, label, folds, held_out, least):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    got = op.classify(docs, labels, folds=folds, held_out=held_out)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held_out) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)
    known = {r["doc_id"]: r[label] for r in labels.collect()}
    s, y = np.array([(r["score"], known[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in known]).T
    assert auc(s, y) >= least
    assert ((s >= 0.3) == y).mean() >= 0.95


def test_labels_of_the_held_out_fold_do_not_matter(spark, docs):
    from pyspark.sql import functions as F

    rows = [(i, f"word{i % 7} bad{i % 3} " * 5) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.classify(docs(rows), x).collect())) for x in (labels, turned))
    assert a == b


@pytest.mark.parametrize("op,label", [(toxicity, "toxic"), (quality, "quality")])
def test_defined_cases(spark, docs, op, label):
    rows = [(i, "good words here" if i % 2 else "bad things there!!") for i in range(40)] + [(None, "bad"), (41, None), (42, ""), (3, "twice"), (43, "z" * 200_000), (44, "é" * 3)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (5, None), (6, 0), (6, 1), (999, 1)], f"doc_id long, {label} int")
    got = op.classify(docs(rows, score=1, label=2, predicted=3), labels)
    assert got.count() == len(rows)
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    by = {r["doc_id"]: r["score"] for r in got.collect()}
    assert by[41] == by[42]
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    assert {r["score"] for r in op.classify(docs(rows), none).collect()} == {0.5}
    assert op.classify(docs([]), labels).collect() == []
    one = spark.createDataFrame([(i, 1) for i in range(40)], f"doc_id long, {label} int")
    assert op.classify(docs(rows), one).where("score < 0.5").count() == 0


def test_toxicity_scores_are_the_formula(spark):
    """b, the weights of a text's distinct terms, and all their pairs, one by one."""
    texts = ["You are a moron, they said.", "they they they", "", "A b c d e f g h. moron", "é ü 你好 moronic"]
    rng = np.random.default_rng(2)
    ids, bounds = toxicity.terms(pa.array(texts), 12)
    slot = np.zeros(1 << 12, np.int32)
    some = np.unique(ids)[::2]
    slot[some] = np.arange(1, len(some) + 1)
    m = toxicity.Machine(slot, -0.3, np.append(0, rng.normal(size=len(some))), np.vstack([np.zeros(4), rng.normal(size=(len(some), 4))]))
    got = m.scores(pa.array(texts), 12)
    for k, s in enumerate(got):
        own = [int(slot[i]) for i in sorted(set(ids[bounds[k] : bounds[k + 1]].tolist())) if slot[i]]
        z = m.b + sum(m.w[i] for i in own) + sum(float(m.v[i] @ m.v[j]) for a, i in enumerate(own) for j in own[a + 1 :])
        assert s == pytest.approx(1 / (1 + np.exp(-z)))


def spelt_out(text):
    """A text's quality features by name, as often as they occur: what word_features hashes."""
    words = text.split()
    out = []
    for k, w in enumerate(words):
        out.append(("word", w))
        for n in quality.GRAMS:
            out += [(n, w[i : i + n]) for i in range(len(w) - n + 1)]
        if len(w) >= 3:
            out += [("first", w[:3]), ("last", w[-3:])]
        if k + 1 < len(words):
            out.append(("pair", w, words[k + 1]))
    return out


def test_quality_scores_are_the_formula():
    """The softmax of the average vector of words, character n-grams and word pairs, each as often as it occurs."""
    texts = ["Éan Éan çaux. a", "one two one two three", "", "日本語の文 x", "abcdefghij " * 3]
    n_features = [len(spelt_out(t)) for t in texts]
    bags = quality.bags(pa.array(texts), 20)
    assert [int(c.sum()) for _, c in bags] == n_features
    assert [len(i) for i, _ in bags] == [len(set(spelt_out(t))) for t in texts]  # 2**20 rows: nothing collides here
    # One feature, one row: the same feature in different texts, and nothing else, shares it.
    where = {}
    for t, (ids, _) in zip(texts, bags):
        for f in set(spelt_out(t)):
            where.setdefault(f, []).append(set(ids.tolist()))
    for f, sets in where.items():
        assert set.intersection(*sets), f
    rows = [(i, c) for i, c in bags] * 8
    m = quality.train(rows, np.array([0, 1, 1, 1, 0] * 8), bits=20, size=4, epochs=2)
    got = m.scores(pa.array(texts), 20)
    for (ids, counts), s in zip(bags, got):
        z = m.b + (sum(float(m.slopes[i]) * int(c) for i, c in zip(ids, counts)) / counts.sum() if len(ids) else 0)
        assert s == pytest.approx(1 / (1 + np.exp(-z)))
    assert got[0] < 0.5 < got[1]


def test_samples_are_bounded(spark):
    from pyspark.sql import functions as F

    from trailmark.llm.labelled import within

    rows = spark.range(4000).select(F.col("id").alias("_id"), F.sequence(F.lit(1), F.lit(10)).alias("x"))
    assert within(rows, F.size("x"), 40_000).count() == 4000
    assert 500 < within(rows, F.size("x"), 10_000).count() < 1500
    assert within(rows, F.size("x"), 10_000).exceptAll(within(rows, F.size("x"), 10_000)).count() == 0


def test_pairs_learn_what_single_terms_cannot():
    """Toxic only if an insult meets a group: each alone is as often clean as toxic."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for _ in range(1500):
        insult, group = rng.random(2) < 0.5
        texts.append(" ".join([*(["insulting"] if insult else []), *(["grouping"] if group else []), *(f"w{rng.integers(50)}" for _ in range(8))]))
        y.append(int(insult == group))
    ids, bounds = toxicity.terms(pa.array(texts))
    lists = [ids[bounds[k] : bounds[k + 1]] for k in range(len(texts))]
    m = toxicity.train(lists[:1000], np.array(y[:1000]), least=0.0, epochs=40)
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists[1000:]])])
    z = m.logits(np.concatenate(lists[1000:]), first)
    assert auc(z, np.array(y[1000:])) > 0.9
    linear = toxicity.Machine(m.slot, m.b, m.w, m.v * 0)
    assert auc(linear.logits(np.concatenate(lists[1000:]), first), np.array(y[1000:])) < 0.7


def test_terms_that_matter_only_in_a_pair_are_kept():
    """With production parameters: the balanced pair above, and a rare word that is toxic only beside a group mention."""
    rng = np.random.default_rng(1)
    balanced, rare, first, second = [], [], [], []
    for k in range(1500):
        insult, group = rng.random(2) < 0.5
        balanced.append(" ".join([*(["insulting"] if insult else []), *(["grouping"] if group else []), *(f"w{rng.integers(50)}" for _ in range(8))]))
        first.append(int(insult == group))
    for k in range(7500):
        word, group = k % 60 == 0, rng.random() < 0.2
        rare.append(" ".join([*(["scum"] if word else []), *(["them"] if group else []), *(["vile"] if not word and k % 10 == 1 else []), *(f"w{rng.integers(50)}" for _ in range(8))]))
        second.append(int(word and group or k % 10 == 1))
    for texts, y, cut, pair in ((balanced, first, 1000, ("insulting", "grouping")), (rare, second, 6000, ("scum", "them"))):
        ids, bounds = toxicity.terms(pa.array(texts))
        lists = [ids[bounds[k] : bounds[k + 1]] for k in range(len(texts))]
        y = np.array(y)
        m = toxicity.train(lists[:cut], y[:cut])
        assert all(m.slot[toxicity.terms(pa.array([w]))[0][0]] > 0 for w in pair)
        z = m.logits(np.concatenate(lists[cut:]), bounds[cut:] - bounds[cut])
        assert auc(z, y[cut:]) > 0.9
