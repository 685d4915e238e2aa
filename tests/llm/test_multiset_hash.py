import hashlib

from pyspark.sql import functions as F

from trailmark.llm.multiset_hash import add, fingerprint_edits, likeness, paragraph_vectors, same, to_hex


def test_homomorphic(spark):
    a, b, c = "first one\nsecond one here", "third line\n\nsecond one here", "first one\nthird line\nsecond one here\nsecond one here\n"
    v = paragraph_vectors(spark.createDataFrame([(1, a), (2, b), (3, c), (4, "second one here\nfirst one"), (5, None), (6, "")], "doc_id long, text string")).groupBy().pivot("doc_id", list(range(1, 7))).agg(F.first("v"))
    q = lambda k: F.col(f"`{k}`")
    r = v.select(same(add(q(1), q(2)), q(3)), same(add(q(3), q(2), -1), q(1)), same(q(1), q(4)), same(q(1), q(2)), same(q(5), q(6)), to_hex(q(3)) == to_hex(add(q(1), q(2)))).first()
    assert list(r) == [True, True, True, False, True, True]


def test_parts_of_a_document_add_up(spark):
    parts = spark.createDataFrame([(1, "x y\nz"), (1, "w"), (2, "w\nx y\nz")], "doc_id long, text string")
    assert paragraph_vectors(parts).select(to_hex("v")).distinct().count() == 1


def test_edits_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(1000, None), (1001, ""), (1002, "ab"), (1003, "é🎉" * 50_000), (1004, "last one of all, with words")]
    got = fingerprint_edits(docs(rows, v=1, d1=2, fingerprint=3)).collect()
    rows = sorted((i, t or "") for i, t in rows)
    nxt = {i: rows[(k + 1) % len(rows)][1] for k, (i, _) in enumerate(rows)}
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(by) == len(rows)
    prints = {}
    for i, t in rows:
        n = len(t) // 4
        edited = t[: len(t) - n] + nxt[i][:n]
        r = by[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        if edited == t:
            assert r["edited_fingerprint"] == r["fingerprint"] and r["near_edited"] == 1
    assert len(set(prints.values())) == len(prints)
    real = [r for r in got if r["doc_id"] < 1000]
    assert sum(r["near_edited"] for r in real) / len(real) > 0.6 > 0.2 > sum(r["near_next"] for r in real) / len(real)


def test_defined_cases(docs):
    one = fingerprint_edits(docs([(5, "abcdefgh")])).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one[0]["near_next"] == 1
    got = fingerprint_edits(docs([(None, "aaaa"), (1, "bbbb"), (1, "bbbb"), (2, "cccc")])).collect()
    ends = sorted(((r["doc_id"], r["edited_sha256"]) for r in got), key=repr)
    want = [(None, b"aaab"), (1, b"bbbc"), (1, b"bbbc"), (2, b"ccca")]
    assert ends == sorted(((i, hashlib.sha256(t).hexdigest()) for i, t in want), key=repr)
    assert fingerprint_edits(docs([])).collect() == []


def test_no_python_in_the_plan(docs):
    plan = fingerprint_edits(docs([(1, "a b\nc"), (2, "d")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def lanes(text):
    """A text's lanes by xxhash: what Spark's xxhash64 chains over columns with seed 42."""
    import re
    import struct

    import xxhash

    def h(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else struct.pack("<i", p), seed)
        return seed

    out = [0] * 81
    for p in text.split("\n"):
        for k in range(8):
            x = h(p, k)
            out[2 * k] += x & 0xFFFFFFFF
            out[2 * k + 1] += x >> 32
        words = [w for w in re.split(r"[\x20\x09\x0B-\x0D]+", p) if w]
        for a, b in zip(words, [*words[1:], ""]):
            x = h(a, b)
            out[16] += 1
            for k in range(64):
                out[17 + k] += 1 if x >> k & 1 else -1
    return out


def likeness_of(a, b):
    if a == b:
        return 1.0
    x, y = ([v if v < 1 << 31 else v - (1 << 32) for v in w[17:]] for w in (a, b))
    both = (sum(v * v for v in x) * sum(v * v for v in y)) ** 0.5
    return max(0.0, min(1.0, sum(v * w for v, w in zip(x, y)) / both)) if both else 0.0


def test_fingerprints_and_likeness_spelt_out(spark, docs):
    """Edits within one paragraph, at a line feed, in texts of empty lines, and those of the tables."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id < 60").collect()]
    rows += [(100, "a b\nc d\ne f\ng"), (101, "\n\n\n\n"), (102, "one two three four"), (103, "abc\n"), (104, "x y z\nw v u t s r q p"), (105, "é 🎉\né 🎉"), (106, None), (107, "l\tm\x0bn  o\n")]
    got = {r["doc_id"]: r for r in fingerprint_edits(docs(rows)).collect()}
    rows = sorted((i, t or "") for i, t in rows)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        own, changed, following = ([v & 0xFFFFFFFF for v in lanes(x)] for x in (t, edited, after))
        assert got[i]["fingerprint"] == "".join(f"{v:08x}" for v in own)
        assert got[i]["edited_fingerprint"] == "".join(f"{v:08x}" for v in changed)
        assert abs(got[i]["near_edited"] - likeness_of(own, changed)) < 1e-9
        assert abs(got[i]["near_next"] - likeness_of(own, following)) < 1e-9


def test_likeness_is_little_code(spark):
    """Lanes spelt out one by one are code whose compilation took over an executor's memory."""
    assert len(str(likeness(F.col("a"), F.col("b")))) < 5000
