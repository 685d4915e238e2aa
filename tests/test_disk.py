"""What keeps the archive queries' work tables and shuffles small."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from trailmark.functions import scalars as S
from trailmark.operators import candidates as C
from trailmark.operators import diagnostics as D
from trailmark.operators import paths as P
from trailmark.operators.closure import closure
from trailmark.operators.membership import split
from trailmark.plans import queries
from trailmark.plans import resolve as R
from trailmark.plans.queries import _proved as candidates_proved
from trailmark.plans.queries import candidate_rows, candidates_prefix, hydrated_entries, path_walk, status_histogram
from trailmark.plans.resolve import count_statuses, resolve_candidates
from trailmark.sources import archive as A
from trailmark.sources.derived import archive_for, requests_for


def test_winners_are_not_shuffled_to_the_requests(spark):
    """Before, both sides were, and requests took their origin's URL and key along."""
    plan = candidate_rows(spark, DATA)._jdf.queryExecution().sparkPlan().toString()
    assert "Bucketed: true" in plan
    executed = candidate_rows(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") <= 1


def test_joins_sort_by_columns(spark):
    """Before, requests were sorted by their URL and key, made anew by patterns in each comparison."""
    r = spark.createDataFrame([("a/b", "1234567")], "repo string, commit_id string")
    found = spark.createDataFrame([(1, "u", "1234567", 1)], "ask long, origin_url string, key string, root long")
    rows = spark.createDataFrame([("a/b", "swh:1:rev:1")], "repo string, rev_swhid string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (C._asked(r, found, 7, False), C._asked(r, found, 7, False, True, "left"), P.seeds(rows, archive_for(spark, DATA))):
            joins = re.findall(r"SortMergeJoin(?:\(skew=true\))? \[(.*?)\], \[(.*?)\], ", df._jdf.queryExecution().sparkPlan().toString())
            assert joins and all(re.fullmatch(r"\w+#\d+L?", k) for pair in joins for k in pair)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_urls_with_prefixes_and_suffixes_only(spark):
    urls = ["github.com/.git", "https://github.com/github.com/.git", "https://github.com/git", "github.com/x.git", "https://github.com/github.com", "xgithub.com/a", "a/github.com/b.git", ".git", "a.git", "git"]
    got = {r["u"]: r["c"][len(S.HOST) :] for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", S.canonical_url("u").alias("c")).collect()}
    assert list(got.values()) == ["", "", "git", "x", "github.com", "xgithub.com/a", "a/github.com/b", "", "a", "git"]


def test_other_requests_of_the_same_number(spark):
    """What shares the number of another URL and key, but not them, meets nothing."""
    r = spark.createDataFrame([("a/b", "1234567"), ("a/c", "1234567"), ("a/b", "zz")], "repo string, commit_id string")
    ask = r.limit(1).select(C._ask(S.canonical_url("repo"), C.asked_key(7, False)).alias("ask")).first()["ask"]
    found = spark.createDataFrame(
        [(ask, "https://github.com/a/other", "1234567", 1), (ask, "https://github.com/a/b", "7654321", 2), (ask, "https://github.com/a/b", "1234567", 3)],
        "ask long, origin_url string, key string, root long",
    )
    assert [tuple(x) for x in C._asked(r, found, 7, False).select("repo", "root").collect()] == [("a/b", 3)]
    assert sorted(map(str, (x["root"] for x in C._asked(r, found, 7, False, True, "left").collect()))) == ["3", "None", "None"]


def test_closure_makes_its_edges_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        made.add(1)
        return x

    edges = spark.range(20).select(F.col("id").alias("src"), (counted("id") + 1).alias("dst"))
    got = closure(spark.createDataFrame([(0,)], "node long"), edges)
    assert sorted(r["node"] for r in got.collect()) == list(range(21))
    assert made.value == 20


def test_bitmap_of_words_has_every_bit(spark):
    members = spark.range(0, 5000, 1).selectExpr("id * 7919 - 20000000 AS m")
    maybe, sure = split(spark.range(40000).selectExpr("id * 7919 - 20000000 AS k"), "k", members, "m")
    assert members.join(maybe, F.col("m") == F.col("k"), "left_anti").isEmpty()
    assert maybe.count() + sure.count() == 40000 and maybe.count() < 5100


def test_parts_of_the_edges(spark):
    a = archive_for(spark, DATA)
    parts = a.edge_parts()
    assert len(parts) > 1 and sum(p.count() for p in parts) == a.edges.count()
    linked = a.links("snp", "rev").select(F.col("dst").alias("node")).distinct()
    want = a.links("snp", "rev").union(a.links("rev", "rev")).join(linked, F.col("dst") == F.col("node"), "left_semi")
    assert sorted(map(tuple, C._into(a, "src_type in ('snp', 'rev') and dst_type = 'rev'", linked).collect())) == sorted(map(tuple, want.collect()))


def test_urls_without_patterns(spark):
    """Spellings that take no pattern come out as by the patterns."""
    urls = ["a/b", "https://github.com/a/b", "github.com/a/b.git", "https://github.com/github.com/a", "https://github.com//a", "github.com/https://github.com/a", "https://github.com/https://github.com/a"]
    urls += [".git", "https://github.com/.git", "a.git.git", "é/b", "b/é.git", " a/b", "a/b ", "/a/b", "a/b/", "", "x", "/", ".git/", "github.com/", "a .git"]

    def by_patterns(c):
        c = F.regexp_replace(S.trim_unicode(c), r"\A/+|/+\z", "")
        for p in (r"\Ahttps://github\.com/", r"\Agithub\.com/", r"\.git\z"):
            c = F.regexp_replace(c, p, "")
        return F.concat(F.lit(S.HOST), c)

    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [tuple(r) for r in df.where(~S.canonical_url("u").eqNullSafe(by_patterns(F.col("u")))).collect()] == []


def test_groups_are_counted_with_one_shuffle(spark):
    """Before, groups were made distinct with their URL and key by one shuffle and counted by these in another, before they met their winners."""
    a, r = archive_for(spark, DATA), A.as_requests(requests_for(spark, DATA, "7"))
    best = C.best_revisions(r, a, 7, False, candidates_proved(spark, DATA))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = C.met_groups(r.sparkSession.createDataFrame(r.limit(50).collect(), r.schema), best, 7, False)
        executed = met._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in executed
        assert met.count() == met.select("repo", "commit_id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hashes_are_packed_without_loss(spark):
    ids = ["swh:1:rev:" + "0a" * 20, "swh:1:rev:" + "0A" * 20, "swh:1:rev:12", "swh:1:rev:xyz", None, "", "swh:1:rev:" + "ab" * 21, "swh:1:rev:" + "1" * 39]
    hash_, text = S.packed("i")
    rows = spark.createDataFrame([(i,) for i in ids], "i string").select("i", hash_.alias("h"), text.alias("t")).withColumn("u", S.unpacked("h", "t")).collect()
    assert [r["u"] for r in rows] == ids and [r["h"] is not None for r in rows] == [True, False, True] + [False] * 5


def test_seeds_are_counted_without_shuffling_rows(spark):
    """Before, each row was shuffled with its paths, to its root and to its request."""
    a, r = archive_for(spark, DATA), A.as_requests(requests_for(spark, DATA, "7"))
    rows = C.candidate_rows(r, a, 7, candidates_proved(spark, DATA), numbered=True)
    assert rows.groupBy("ask", "repo", "commit_id", "rev_swhid").count()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
    assert D.seed_counts(rows, P.rooted(a)).collect() == D.seed_counts(P.seeds(rows.drop("ask"), a)).collect()


def test_seeds_of_several_revisions(spark):
    rows = [("r", "c", "p1", "a", "48", 1), ("r", "c", "p1", "b", "5", None), ("r", "c", "p2", "b", "x", 2), ("r", "d", "p1", "a", "", 1)]
    df = spark.createDataFrame(rows, "repo string, commit_id string, rel_path string, rev_swhid string, bin string, root long")
    want = {"n_rows": 4, "n_revisions": 2, "missing_roots": 1, "stray_bins": 3, "unparsable_bins": 2, "ambiguous": 1}
    assert D.seed_counts(df).first().asDict() == want
    known = spark.createDataFrame([("swh:1:rev:a", 1)], "rev_swhid string, root long")
    assert D.seed_counts(df, known).first().asDict() == want | {"missing_roots": 2}


def test_groups_of_known_origins_take_no_url_along(spark):
    """Before, groups were shuffled with their URL and its SWHID to the origins, and all of it lay about at the join with revisions."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        executed = candidates_prefix(spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning") <= 3 and "origin_swhid" not in executed
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    a, r = archive_for(spark, DATA), A.as_requests(requests_for(spark, DATA, "7"))
    assert sorted(map(tuple, C.known_groups(r, a).collect())) == sorted(map(tuple, C.with_origin(C.groups(r), a).select("repo", "commit_id").collect()))


def _built(spark):
    nodes = [(i, f"swh:1:{t}:{i}", t) for i, t in ((1, "rev"), (2, "dir"), (3, "cnt"), (4, "cnt"))]
    entries = [(2, b"a", 3, "cnt"), (2, b"b", 4, "cnt")]
    rows = [("r", "c", p, "swh:1:rev:1", "u", "swh:1:rev:1", p, "48", root) for p, root in (("a", 2), ("a", 2), ("./a", 2), ("b", 2), ("x", 2), ("", 2), ("a", None))]
    a = A.Archive(spark.createDataFrame(nodes, A.NODES), spark.createDataFrame([(1, "rev", 2, "dir")], A.EDGES), spark.createDataFrame(entries, A.ENTRIES), True)
    return spark.createDataFrame(rows, "repo string, commit_id string, rel_path string, id string, origin_url string, rev_swhid string, file_path string, bin string, root long"), a


def test_statuses_are_counted_without_rows(spark):
    """Before, all output rows were made and written to be counted."""
    rows, a = _built(spark)
    want = {r["status"]: r["n"] for r in D.status_histogram(resolve_candidates(rows, a)).collect()}
    got = count_statuses(P.counted_paths(rows), a)
    assert {r["status"]: r["n"] for r in got.collect()} == want == {"ok": 4, "path_not_found": 3}
    assert "qualified" not in status_histogram(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    tables = [p for p in status_histogram(spark, DATA).inputFiles() if "cut" in p]
    assert tables and not any("repo" in spark.read.parquet(p).columns for p in tables)


def test_rows_are_shuffled_once_to_their_paths(spark):
    """Before, rows that had met their path were shuffled again to its content, those without one to a single task."""
    rows, a = _built(spark)
    walked = P.walk(rows, a.entries)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = P.met_paths(rows, walked, a)
        plan = met._jdf.queryExecution().optimizedPlan().toString()
        assert re.findall(r"Join (\w+)", plan) == ["Inner", "LeftOuter"]  # from the top: rows with paths, and below that paths with contents
        assert "isnotnull(leaf" in plan and met.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_written_rows_repeat_nothing(spark):
    """Before, what several queries share was written with the qualified id, which has all of its row's ids once more."""
    rows, a = _built(spark)
    got = resolve_candidates(rows, a, written=True)
    (path,) = {p.rsplit("/", 1)[0] for p in got.inputFiles()}
    assert not {"qualified", "file_path", "root"} & set(spark.read.parquet(path).columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, resolve_candidates(rows, a).collect()))


def test_names_are_written_before_entries_are_made(spark):
    """Before, the shuffle of the rows lay about while names of all entries were shuffled, asked for or not."""
    rows, a = _built(spark)
    got = P.matched_components(rows, a)
    assert any("trailmark-cut" in p for p in got.inputFiles())
    assert sorted(map(tuple, got.collect())) == [(b"a", True), (b"b", True), (b"x", False)]


@pytest.mark.parametrize("query", [path_walk, hydrated_entries])
def test_walks_need_no_whole_rows(spark, monkeypatch, query):
    """Before, all columns of the rows were written for a walk that takes roots and paths."""
    monkeypatch.setattr(queries, "_cands", None)
    assert query(spark, DATA).count() > 0


def test_direct_walk_keeps_pairs_where_they_are(spark, monkeypatch):
    """Before, each level of a recursive query shuffled whole pairs twice, and all levels' files lay about until its end."""
    rows, a = _built(spark)
    plans, dealt = [], R.dealt

    def seen(df, *by):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return dealt(df, *by)

    monkeypatch.setattr(R, "dealt", seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = R.direct_walk(lambda: rows.withColumn("n", F.length("rel_path")), a, "n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, got.collect())) == [("swh:1:rev:1", "./a", 3, 3), ("swh:1:rev:1", "a", 1, 3), ("swh:1:rev:1", "b", 1, 4)]
    assert len(plans) == 2 and all("Bucketed: true" in p for p in plans) and plans[1].count("Exchange") == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("trailmark_")]


def test_direct_walk_needs_no_whole_rows(spark, monkeypatch):
    """Before, all columns of the candidate rows were written for it."""
    monkeypatch.setattr(queries, "_cands", None)
    assert queries.direct(spark, DATA).count() > 0


def test_rows_are_verified_by_counts(spark, monkeypatch):
    """Before, all output rows were made and written, met their paths by a shuffle, and were shuffled again to what was found."""
    rows, a = _built(spark)
    counted = rows.groupBy("rev_swhid", "root", "rel_path").agg(F.count("*").alias("n"))
    want = R.verify(a, resolve_candidates(rows, a), None).first().asDict()
    assert R.count_verified(lambda: counted, a).first().asDict() == want == {"sampled": 4, "matched": 4, "mismatched": 0, "unresolved": 0, "other": 3}
    # A walk that is wrong is found out: one pair leads elsewhere, another isn't found again.
    right = P.walk_dealt(counted, a, "rev_swhid")
    leaf = F.when(F.col("rel_path") == "b", F.lit(3)).when(F.col("rel_path") == "x", F.lit(4)).otherwise(F.col("leaf"))
    wrong = right.withColumn("leaf", leaf).withColumn("status_detail", F.when(F.col("rel_path") == "x", "ok").otherwise(F.col("status_detail")))
    monkeypatch.setattr(R, "walk_dealt", lambda *_: wrong)
    assert R.count_verified(lambda: counted, a).first().asDict() == {"sampled": 5, "matched": 3, "mismatched": 1, "unresolved": 1, "other": 2}


def test_dealt_walks_say_what_walks_say(spark):
    rows, a = _built(spark)
    want = P.walk(rows, a.entries).collect()
    got = P.walk_dealt(rows.withColumn("n", F.lit(1)), a).collect()
    said = [sorted((str(r["root"]), r["rel_path"], str(r["leaf"]), r["status_detail"]) for r in x) for x in (got, want)]
    assert said[0] == said[1]
    assert sum(r["n"] for r in got) == 7


def test_verified_counts_make_no_rows(spark, monkeypatch):
    monkeypatch.setattr(queries, "_resolved", None)
    got = queries.verify_counts(spark, DATA).first()
    assert got["sampled"] == got["matched"] > 0
