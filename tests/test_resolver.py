"""A hand-built archive with the cases that real ones rarely show."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from trailmark.functions.scalars import path_components
from trailmark.operators import candidates as C
from trailmark.operators.closure import closure, reachable_dirs
from trailmark.operators.paths import components, hydrated_entries, matched_components, seeds, walk
from trailmark.plans.resolve import mismatches, resolve, resolve_candidates, run, verify
from trailmark.sources import archive as A
from trailmark.streaming.resolve_stream import resolve_stream


def sha(key):
    return hashlib.sha1(key.encode()).hexdigest()


class Builder:
    def __init__(self):
        self.ids, self.nodes, self.edges, self.entries = {}, [], set(), []

    def node(self, kind, key, hash_=None):
        if (kind, key) not in self.ids:
            self.ids[kind, key] = len(self.ids) + 1
            self.nodes.append((self.ids[kind, key], f"swh:1:{kind}:{hash_ or sha(key)}", kind))
        return kind, key

    def link(self, a, b):
        self.edges.add((self.ids[a], a[0], self.ids[b], b[0]))

    def entry(self, d, name, child):
        self.link(d, child)
        self.entries.append((self.ids[d], name if isinstance(name, bytes) else name.encode(), self.ids[child], child[0]))

    def archive(self, spark):
        return A.Archive(spark.createDataFrame(self.nodes, A.NODES), spark.createDataFrame(sorted(self.edges), A.EDGES), spark.createDataFrame(self.entries, A.ENTRIES))

    def swhid(self, n):
        return next(s for i, s, _ in self.nodes if i == self.ids[n])


R = {k: h * 40 for k, h in zip(("one", "two", "orphan", "sub", "deep", "rootless", "tagged"), "123456a")}


@pytest.fixture(scope="module")
def built():
    b = Builder()
    ori = {k: b.node("ori", f"https://github.com/o/{k}") for k in ("a", "b", "none", "empty")}
    snp = {k: b.node("snp", f"s{k}") for k in ("a", "a2", "b")}
    rev = {k: b.node("rev", k, h) for k, h in R.items()}
    # Three that share the prefix abcdef0: the largest hash, a branch head, and one without provenance that is larger still.
    for k, h in (("plain", "abcdef0" + "f" * 33), ("head", "abcdef0" + "1" * 33), ("foreign", "abcdef0" + "f" * 32 + "e"), ("lone", "bbbbbbb" + "0" * 33), ("win_rootless", "ccccccc" + "f" * 33), ("runner_up", "ccccccc" + "0" * 33), ("chained", "ddddddd" + "f" * 33), ("direct", "ddddddd" + "0" * 33)):
        rev[k] = b.node("rev", k, h)
    root, src, docs, other = (b.node("dir", k) for k in ("root", "src", "docs", "other"))
    cnt = {k: b.node("cnt", k) for k in ("main", "readme", "low", "high", "bytes")}
    b.link(ori["a"], snp["a"]), b.link(ori["a"], snp["a2"]), b.link(ori["b"], snp["b"])
    for k in ("one", "head", "runner_up"):
        b.link(snp["a"], rev[k])
    b.link(snp["a2"], rev["win_rootless"])
    b.link(rev["one"], rev["two"]), b.link(rev["one"], rev["plain"])
    b.link(snp["b"], rev["foreign"])
    rel, rel2, rel3 = (b.node("rel", k) for k in ("r1", "r2", "r3"))
    b.link(snp["a"], rel), b.link(rel, rev["tagged"])
    b.link(snp["a"], rel2), b.link(rel2, rel3), b.link(rel3, rev["direct"])  # two releases: provenance, but no head
    b.link(rev["one"], rev["chained"])
    for k in ("one", "two", "orphan", "sub", "deep", "tagged", "plain", "head", "foreign", "lone", "runner_up", "chained", "direct"):
        b.link(rev[k], root if k != "sub" else other)
    b.entry(root, "src", src), b.entry(root, "docs", docs), b.entry(src, "main.c", cnt["main"]), b.entry(src, "docs", docs), b.entry(docs, "README.md", cnt["readme"])
    b.entry(root, "vendor", rev["sub"]), b.entry(root, "dup", cnt["high"]), b.entry(root, "dup", cnt["low"]), b.entry(root, b"\xff\xfe", cnt["bytes"]), b.entry(root, "Straße", cnt["readme"]), b.entry(root, "odd", rel)
    b.entry(other, "x", rev["deep"])
    return b


@pytest.fixture(scope="module")
def archive(spark, built):
    return built.archive(spark)


def requests(spark, rows, bins=True):
    df = spark.createDataFrame([(*r, "48")[:4] for r in rows], "repo string, commit_id string, rel_path string, bin string")
    return df if bins else df.drop("bin")


def answers(df):
    return sorted(tuple(r) for r in df.select("repo", "commit_id", "rel_path", "rev_swhid", "status_detail").collect())


def test_walk_of_every_kind(spark, archive, built):
    cases = {
        "src/main.c": "ok", "./src\\main.c": "ok", "docs/README.md": "ok", "src/docs/README.md": "ok", "src": "dir_target", "vendor": "submodule", "vendor/absent": "submodule", "vendor/x/y": "submodule", "absent": "not_found", "src/absent": "not_found",
        "src/main.c/x": "not_found", "": "not_found", "//": "not_found", "dup": "ok", "STRASSE": "not_found", "Straße": "ok", "��": "not_found", "src/../src/main.c": "not_found", "odd": "not_found", "odd/x": "not_found",
    }
    rows = requests(spark, [("o/a", R["one"], p) for p in cases] + [("o/a", R["one"], None)])
    got = {r["rel_path"]: r for r in resolve(rows, archive, detail=True).collect()}
    assert {p: got[p]["status_detail"] for p in cases} == cases
    low = min((built.ids["cnt", k], built.swhid(("cnt", k))) for k in ("high", "low"))[1]
    assert got["dup"]["cnt_swhid"] == low
    assert all((r["status"] == "ok") == (r["cnt_swhid"] != "") == (r["qualified"] != "") for r in got.values())
    assert got["./src\\main.c"]["qualified"].endswith(";path=/src/main.c") and got["src/main.c"]["snapshot_swhid"] == ""
    by = [{tuple(r) for r in resolve(rows, archive, pruning=p).collect()} for p in ("none", "names", "visited")]
    assert by[0] == by[1] == by[2]


def won(spark, archive, asked, nibbles=7):
    rows = requests(spark, [(repo, commit, "src") for repo, commit in asked])
    return {(r["repo"], r["commit_id"]): r["rev_swhid"][10:] for r in C.select_winners(A.as_requests(rows), archive, nibbles).collect()}


def test_winners(spark, archive):
    want = {
        ("o/a", "abcdef0"): "abcdef0" + "1" * 33,  # a head goes before a larger hash
        ("o/b", "ABCDEF0"): "abcdef0" + "f" * 32 + "e",  # the other origin's own, in upper case
        ("o/a", "bbbbbbb"): None,  # a lone candidate without provenance
        ("o/a", "ccccccc"): None,  # the winner has no root; the runner-up doesn't step in
        ("o/a", "ddddddd"): "ddddddd" + "f" * 33,  # a release of a release is no head, so the largest hash wins
        ("o/a", "aaaaaaa"): R["tagged"],
        ("o/a", "4444444"): R["sub"],  # by a submodule
        ("o/a", "5555555"): R["deep"],  # by a submodule's
        ("o/b", "4444444"): R["sub"],  # across origins
        ("o/none", "1111111"): None,
        ("o/missing", "1111111"): None,
        ("o/a", ""): None,
        ("o/a", "111111"): None,  # shorter than the prefix
        ("o/a", "xyz1234"): None,
    }
    got = won(spark, archive, want)
    assert {k: got.get(k) for k in want} == want


def test_modes(spark, archive):
    full, short = "abcdef0" + "f" * 33, "1111111"
    assert won(spark, archive, [("o/a", full), ("o/a", "A" * 40)]) == {("o/a", full): full}  # in full mode as written
    assert won(spark, archive, [("o/a", full), ("o/a", short)])[("o/a", full)] == "abcdef0" + "1" * 33  # one short id: all by prefix
    proved = C.provenance(archive)
    rows = A.as_requests(requests(spark, [("o/a", "9", "src")]))
    assert C.passing_candidates(rows, archive, 0, proved=proved).count() == 11  # every revision is a candidate
    for commit, nibbles, n in (("1" * 39 + "z", 99, 0), (R["one"][:39], 39, 1), ("abcdef01", 3, 2)):
        rows = A.as_requests(requests(spark, [("o/a", commit, "src")]))
        assert C.passing_candidates(rows, archive, nibbles, False, proved).count() == n


def test_requests_schema(spark, archive):
    rows = [("o/a", R["one"][:7], "src/main.c"), ("o/a", R["one"][:7], "src/main.c"), (" /o/a/ ", R["one"][:7], "src"), (None, None, None)]
    got = resolve(requests(spark, rows, bins=False), archive).collect()
    assert len(got) == 3 and {r["bin"] for r in got} == {0}
    assert {r["repo"] for r in got} == {"o/a", " /o/a/ "} and {r["origin_url"] for r in got} == {"https://github.com/o/a"}
    with pytest.raises(ValueError, match="rel_path"):
        resolve(spark.createDataFrame([("a", "b")], "repo string, commit_id string"), archive)
    assert resolve(requests(spark, []), archive).collect() == []


def test_external_candidates(spark, archive):
    rows = [("r", "c", "src/main.c", "x", "u", f"swh:1:rev:{h}", "src/main.c", "1") for h in (R["one"], R["rootless"], "9" * 40)]
    got = resolve_candidates(seeds(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in A.CANDIDATE)), archive), archive, detail=True)
    assert sorted(r["status_detail"] for r in got.collect()) == ["no_root", "no_root", "ok"]


def test_pruning_tables(spark, archive, built):
    rows = spark.createDataFrame([(built.ids["dir", "root"], "src/main.c"), (built.ids["dir", "root"], "docs/none"), (None, "x")], "root long, rel_path string")
    assert {r["dir"] for r in reachable_dirs(rows.select("root"), archive).collect()} == {built.ids["dir", k] for k in ("root", "src", "docs")}
    assert {bytes(r["name"]) for r in components(rows).collect()} == {b"src", b"main.c", b"docs", b"none", b"x"}
    assert {bytes(r["name"]): r["known"] for r in matched_components(rows, archive).collect()} == {b"src": True, b"main.c": True, b"docs": True, b"none": False, b"x": True}
    kept = {(r["dir"], bytes(r["name"])) for r in hydrated_entries(rows, archive).collect()}
    ids = built.ids
    assert kept == {(ids["dir", "root"], b"src"), (ids["dir", "root"], b"docs"), (ids["dir", "src"], b"main.c"), (ids["dir", "src"], b"docs")}
    full, pruned = (sorted(map(tuple, walk(rows, e).select("rel_path", "leaf", "status_detail").collect()), key=repr) for e in (archive.entries, hydrated_entries(rows, archive)))
    assert full == pruned


@pytest.mark.parametrize("patience", [24, 2, 0])
def test_closure_of_random_graphs(spark, patience):
    for seed in (1, 2):
        rng = random.Random(seed)
        edges = [(k, k + 1) for k in range(60)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(70)]
        starts = [(1, 0), (1, 70), (2, 99)]
        want = set()
        for key, s in starts:
            todo = [s]
            while todo:
                n = todo.pop()
                if (key, n) not in want:
                    want.add((key, n))
                    todo += [b for a, b in edges if a == n]
        got = closure(spark.createDataFrame(starts, "key long, node long"), spark.createDataFrame(edges, "src long, dst long"), ("key",), patience=patience)
        rows = [tuple(r) for r in got.select("key", "node").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == want


def test_closure_writes_what_the_starts_reach(spark, monkeypatch):
    from trailmark.operators import closure as module

    written, plain = [], module.cut

    def counted(df):
        out = plain(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(module, "cut", counted)
    edges = [(k, k + 1) for k in range(12)] + [(1000 + k, 1001 + k) for k in range(5000)]
    got = closure(spark.createDataFrame([(0,)], "node long"), spark.createDataFrame(edges, "src long, dst long"))
    assert got.count() == 13 and sum(written) <= 3 * 13


def test_closure_ends_early_once_all_that_is_wanted_is_reached(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)], "src long, dst long")
    starts = spark.createDataFrame([(1, 0), (2, 5), (3, 190)], "key long, node long")
    wanted = spark.createDataFrame([(1, 3), (2, 5), (3, 7)], "key long, node long")
    rows = {tuple(r) for r in closure(starts, edges, ("key",), wanted).select("key", "node").collect()}
    assert {(1, 3), (2, 5)} <= rows and (3, 7) not in rows and (3, 200) in rows
    assert sum(k == 1 for k, _ in rows) <= 6 and sum(k == 2 for k, _ in rows) <= 2
    assert closure(starts, edges, ("key",), wanted.limit(0)).count() == 3


def test_whole_hashes_end_provenance_early_with_the_same_winners(spark, archive):
    rows = A.as_requests(requests(spark, [("o/a", R[k], "src") for k in ("one", "two", "orphan", "deep", "tagged")]))
    early, whole = (sorted(tuple(r) for r in C.passing_candidates(rows, archive, proved=p).select("commit_id", "rev").collect()) for p in (None, C.provenance(archive)))
    assert early == whole and len(early) == 4


def test_command_line(spark, archive, tmp_path, capsys):
    from trailmark.plans.cli import main

    A.write_archive(archive, str(tmp_path / "graph"))
    rows = requests(spark, [("o/a", R["one"][:7], p) for p in ("src/main.c", "docs/README.md", "src")] + [("o/missing", "1111111", "x"), ("o/a", "bbbbbbb", "x")])
    rows.write.parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    assert main(["resolve", "--graph-dir", str(tmp_path / "graph"), "--input", str(tmp_path / "in"), "--cands-out", str(tmp_path / "cands"), "--out-dir", out]) == 0
    said = capsys.readouterr().out
    assert "'resolved': 1" in said and "'no_origin': 1" in said and "'no_provenance': 1" in said
    assert "'n_rows': 3" in said and "'ok': 2" in said and "'path_not_found': 1" in said
    assert main(["verify", "--graph-dir", str(tmp_path / "graph"), "--resolved", out]) == 0
    wrong = A.read_resolved(spark, out).withColumn("cnt_swhid", F.when(F.col("rel_path") == "src/main.c", F.lit("swh:1:cnt:0")).otherwise(F.col("cnt_swhid")))
    wrong.write.parquet(str(tmp_path / "wrong"))
    capsys.readouterr()
    assert main(["verify", "--graph-dir", str(tmp_path / "graph"), "--resolved", str(tmp_path / "wrong"), "--n", "5"]) == 1
    said = capsys.readouterr().out
    assert "'mismatched': 1" in said and "swh:1:cnt:0" in said and "src/main.c" in said


def test_settings_are_left_as_they_were(spark, archive, built):
    from trailmark.plans.resolve import LIMITS, direct_walk

    before = {k: spark.conf.get(k, None) for k in LIMITS}
    direct_walk(spark.createDataFrame([(R["one"], "src/main.c")], "rev_swhid string, rel_path string"), archive)
    assert {k: spark.conf.get(k, None) for k in LIMITS} == before
    assert not [v for v in spark.catalog.listTables() if v.name.startswith("_trailmark")]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from trailmark.operators.lineage import shared_dir

    def session(master, folder=None):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d: folder or d)))

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    assert shared_dir(session("yarn", "hdfs://x/y")) == "hdfs://x/y"


def test_files_verify_and_stream(spark, archive, tmp_path):
    A.write_archive(archive, str(tmp_path / "graph"))
    rows = requests(spark, [("o/a", R["one"][:7], p, b) for p, b in (("src/main.c", "48"), ("docs/README.md", "x"), ("src", "50"), ("dup", "50"))])
    rows.write.parquet(str(tmp_path / "in"))
    run(spark, str(tmp_path / "graph"), str(tmp_path / "in"), str(tmp_path / "cands"), str(tmp_path / "out"))
    back = A.read_resolved(spark, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {"bin=48", "bin=0", "bin=50"}
    assert spark.read.parquet(str(tmp_path / "cands")).columns == list(A.CANDIDATE)
    assert set(back.columns) == {*A.OUTPUT, "bin"}
    graph = A.read_archive(spark, str(tmp_path / "graph"))
    assert verify(graph, back).first().asDict() == {"sampled": 3, "matched": 3, "mismatched": 0, "unresolved": 0, "other": 1}
    wrong = back.withColumn("cnt_swhid", F.when(F.col("rel_path") == "dup", F.lit("swh:1:cnt:0")).otherwise(F.col("cnt_swhid"))).withColumn("rel_path", F.when(F.col("rel_path") == "src/main.c", F.lit("gone")).otherwise(F.col("rel_path")))
    assert verify(graph, wrong, None).first().asDict() == {"sampled": 3, "matched": 1, "mismatched": 1, "unresolved": 1, "other": 1}
    assert {r["rel_path"] for r in mismatches(graph, wrong).collect()} == {"dup", "gone"}
    resolve_stream(spark, str(tmp_path / "in"), graph, str(tmp_path / "streamed"), str(tmp_path / "progress")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "streamed"))
    assert {tuple(r) for r in streamed.select(*A.OUTPUT).collect()} == {tuple(r) for r in back.select(*A.OUTPUT).collect()}


def test_candidates_only(spark, archive, tmp_path):
    A.write_archive(archive, str(tmp_path / "graph"))
    requests(spark, []).write.parquet(str(tmp_path / "in"))
    run(spark, str(tmp_path / "graph"), str(tmp_path / "in"), str(tmp_path / "cands"), str(tmp_path / "out"), cands_only=True)
    assert spark.read.schema(", ".join(f"{c} string" for c in A.CANDIDATE)).parquet(str(tmp_path / "cands")).count() == 0 and not (tmp_path / "out").exists()


def test_rounds_of_a_walk_shuffle_paths_only(spark, archive, built):
    """Entries are read in the buckets they were written in, and the table is gone afterwards."""
    from trailmark.operators.paths import pruned

    rows = spark.createDataFrame([(built.ids["dir", "root"], "src/main.c")], "root long, rel_path string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pruned(rows, archive) as entries:
            assert {bytes(r["name"]) for r in entries.collect()} == {b"src", b"main.c"}
            asked = rows.select("root", F.explode(path_components("rel_path")).alias("want"))
            plan = asked.join(entries, (F.col("root") == F.col("dir")) & (F.col("want") == F.col("name")))._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and plan.count("Exchange") == 1
            walked = walk(rows, entries)
        assert [r["status_detail"] for r in walked.collect()] == ["ok"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("trailmark_")]


def test_provenance_leaves_its_result_only(spark, archive):
    from pathlib import Path

    from trailmark.operators.lineage import shared_dir

    there = lambda: {p.name for p in Path(shared_dir(spark)).glob("trailmark-*")}
    before = there()
    proved = C.provenance(archive)
    assert len(there() - before) == 1 and proved.count() > 0


def test_a_scope_removes_what_was_cut_in_it(spark):
    from pathlib import Path

    from trailmark.operators.lineage import cut, scope

    with scope():
        kept = cut(spark.range(3))
        assert kept.count() == 3
    assert not Path(kept._trailmark_path).exists()


def test_a_short_prefix_looks_among_what_the_origin_leads_to(spark, archive):
    """Not among all revisions of the archive, whose number by that of groups would be the rows of a join."""
    rows = A.as_requests(requests(spark, [("o/b", "9", "src"), ("github.com/o/b", "9", "src")]))
    proved = C.provenance(archive)
    found = C.passing_by_origin(rows, archive, 0, False, proved)
    origin = C.asked_origins(rows, archive)
    assert found.count() == proved.join(origin, "origin").count() < archive.of_type("rev").count()


def test_a_small_frontier_takes_single_steps_for_longer(spark, monkeypatch):
    from trailmark.operators import closure as module

    monkeypatch.setattr(module, "_jumps", lambda single: pytest.fail("jumps over the whole graph"))
    edges = [(k, k + 1) for k in range(12)] + [(1000 + k, 1001 + k) for k in range(50)]
    got = closure(spark.createDataFrame([(0,)], "node long"), spark.createDataFrame(edges, "src long, dst long"), patience=4)
    assert got.count() == 13


def test_the_derived_archive_is_made_by_type(spark):
    from trailmark.sources.derived import archive_for

    a = archive_for(spark, "/root/testdata/sf0.001")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (a.of_type("ori"), a.of_type("rev"), a.links("ori", "snp"), a.links("rev", "rev"))]
    assert not any("lineitem" in p for p in plans)
    assert "lineitem" in a.links("dir", "dir")._jdf.queryExecution().executedPlan().toString()
