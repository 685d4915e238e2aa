"""From requests to the winning revision of each (repo, commit)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.scalars import all_full_hashes, canonical_url, commit_key, hash_prefix, origin_swhid, packed, revision_swhid, same, unpacked
from trailmark.operators.closure import closure
from trailmark.operators.lineage import cut, only
from trailmark.operators.membership import marks_of, split_by
from trailmark.sources.archive import Archive

GROUP = ["repo", "commit_id"]


def groups(requests: DataFrame) -> DataFrame:
    """Distinct (repo, commit_id) as given, with the canonical URL and its SWHID."""
    g = requests.select(*GROUP).distinct().withColumn("origin_url", canonical_url("repo"))
    return g.withColumn("origin_swhid", origin_swhid("origin_url"))


def with_origin(g: DataFrame, archive: Archive) -> DataFrame:
    """Groups whose origin the archive has, with its node."""
    ori = archive.of_type("ori").select(F.col("swhid").alias("origin_swhid"), F.col("node_id").alias("origin"))
    return g.join(ori, "origin_swhid")


def known_groups(requests: DataFrame, archive: Archive) -> DataFrame:
    """Distinct (repo, commit_id) whose origin the archive has, written once.

    Spellings of repositories are looked up, not groups, so that no shuffle of groups takes a URL or a hash along.
    """

    def made() -> DataFrame:
        repos = requests.select("repo").distinct().withColumn("origin_swhid", origin_swhid(canonical_url("repo")))
        known = cut(with_origin(repos, archive).select("repo"))
        return requests.select(*GROUP).distinct().join(known, "repo", "left_semi")

    return only(made)


def origin_snapshots(archive: Archive) -> DataFrame:
    """(origin, snapshot), direct successors only."""
    return archive.links("ori", "snp").select(F.col("src").alias("origin"), F.col("dst").alias("snapshot")).distinct()


def revision_index(archive: Archive, nibbles: int) -> DataFrame:
    """(prefix, rev, rev_swhid) of every revision."""
    return archive.of_type("rev").select(hash_prefix("swhid", nibbles).alias("prefix"), F.col("node_id").alias("rev"), F.col("swhid").alias("rev_swhid"))


def is_full_hash_mode(requests: DataFrame) -> bool:
    """One decision for the whole input; an empty one is in prefix mode."""
    return bool(requests.agg(all_full_hashes("commit_id").alias("full")).first()["full"])


def candidates(g: DataFrame, archive: Archive, nibbles: int, full: bool) -> DataFrame:
    """Groups (with origin) and each revision that the commit id may mean."""
    if full:
        revs = archive.of_type("rev").select(F.col("swhid").alias("rev_swhid"), F.col("node_id").alias("rev"))
        return g.withColumn("rev_swhid", revision_swhid("commit_id")).join(revs, "rev_swhid")
    return g.withColumn("prefix", commit_key("commit_id", nibbles)).join(revision_index(archive, nibbles), "prefix").drop("prefix")


def revision_graph(archive: Archive) -> DataFrame:
    """Edges (src, dst) among the nodes from which a revision can be reached, which provenance has to follow.

    Contents lead nowhere; a directory leads to a revision only if one is below it, which is rare.
    """
    linked = cut(archive.links("dir", "rev").select(F.col("src").alias("node")).distinct())
    useful, fresh, above = linked, linked, []
    # Few directories lead to a revision, so nearly all edges to directories go before the joins.
    while not fresh.isEmpty():
        above.append(cut(_into(archive, "src_type = 'dir' and dst_type = 'dir'", fresh)))
        fresh = cut(above[-1].select(F.col("src").alias("node")).distinct().join(useful, "node", "left_anti"))
        useful = useful.union(fresh)
    kinds = archive.edges.where("dst_type not in ('cnt', 'dir') and src_type not in ('ori', 'dir')").select("src", "dst")
    others = _into(archive, "dst_type = 'dir' and src_type <> 'dir'", useful)
    return reduce(DataFrame.union, [kinds, others, archive.links("dir", "rev"), *above])


def _into(archive: Archive, kind: str, nodes: DataFrame) -> DataFrame:
    """Edges of a kind that lead to one of few nodes."""
    marks = marks_of(nodes, "node")
    edges = reduce(DataFrame.union, [split_by(part.where(kind).select("src", "dst"), "dst", marks)[0] for part in archive.edge_parts()])
    return edges.join(nodes, F.col("dst") == F.col("node"), "left_semi")


def provenance(archive: Archive, origins: DataFrame | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """(origin, rev): revisions that a snapshot of the origin leads to, along edges of every type.

    With wanted (origin, rev) an origin is followed only until these are found; of others some may be missing then.
    """

    def made() -> DataFrame:
        snaps = origin_snapshots(archive)
        if origins is not None:
            snaps = snaps.join(origins.select("origin").distinct(), "origin", "left_semi")
        goal = None if wanted is None else cut(wanted.select("origin", F.col("rev").alias("node")).distinct())
        reached = closure(snaps.select("origin", F.col("snapshot").alias("node")), revision_graph(archive), ("origin",), goal)
        revs = archive.of_type("rev").select(F.col("node_id").alias("node"))
        return reached.join(revs, "node", "left_semi").select("origin", F.col("node").alias("rev"))

    return only(made)


def branch_heads(archive: Archive) -> DataFrame:
    """(origin, rev): a snapshot's revisions, direct or by exactly one release."""
    snaps = origin_snapshots(archive)
    direct = snaps.join(archive.links("snp", "rev"), F.col("snapshot") == F.col("src")).select("origin", F.col("dst").alias("rev"))
    tagged = archive.links("snp", "rel").alias("s").join(archive.links("rel", "rev").alias("r"), F.col("s.dst") == F.col("r.src")).select(F.col("s.src").alias("src"), F.col("r.dst").alias("dst"))
    released = snaps.join(tagged, F.col("snapshot") == F.col("src")).select("origin", F.col("dst").alias("rev"))
    return direct.union(released).distinct()


def root_dirs(archive: Archive) -> DataFrame:
    """(rev, root): each revision's smallest directory successor."""
    return archive.links("rev", "dir").groupBy(F.col("src").alias("rev")).agg(F.min("dst").alias("root"))


def winners(passing: DataFrame, archive: Archive, by: tuple[str, ...] = (*GROUP, "origin_url")) -> DataFrame:
    """One revision of each group's passing candidates, a branch head before others, then the largest hash, with its root, null if it has none."""
    heads = branch_heads(archive).withColumn("head", F.lit(1))
    known = passing.join(heads, ["origin", "rev"], "left").join(root_dirs(archive), "rev", "left")
    return _best(known, by)


def _best(known: DataFrame, by: tuple[str, ...]) -> DataFrame:
    best = known.groupBy(*by).agg(F.max(F.struct(F.coalesce("head", F.lit(0)).alias("is_head"), "rev_swhid", "rev", "root")).alias("w"), F.count("*").cast("long").alias("n_passing"))
    return best.select(*by, "w.rev", "w.rev_swhid", "n_passing", "w.is_head", "w.root")


def revision_keys(archive: Archive, nibbles: int, full: bool) -> DataFrame:
    """(key, rev, rev_swhid) of every revision: what requests ask for it by."""
    return _keyed(archive.of_type("rev").select(F.col("node_id").alias("rev"), F.col("swhid").alias("rev_swhid")), nibbles, full)


def _keyed(revs: DataFrame, nibbles: int, full: bool) -> DataFrame:
    return revs.withColumn("key", F.col("rev_swhid") if full else hash_prefix("rev_swhid", nibbles))


def asked_key(nibbles: int, full: bool) -> Column:
    """The key of a request; null if it can't be one."""
    return revision_swhid("commit_id") if full else commit_key("commit_id", nibbles)


def asked_origins(requests: DataFrame, archive: Archive) -> DataFrame:
    """(origin_url, origin) of the requests' repositories that the archive has."""
    urls = requests.select("repo").distinct().select(canonical_url("repo").alias("origin_url")).distinct()
    return with_origin(urls.withColumn("origin_swhid", origin_swhid("origin_url")), archive).select("origin_url", "origin")


def passing_by_origin(requests: DataFrame, archive: Archive, nibbles: int, full: bool, proved: DataFrame | None = None) -> DataFrame:
    """(origin_url, origin, key, rev, rev_swhid): what the snapshots of the requests' origins lead to, under the keys that requests ask by.

    Provenance goes first: a short prefix has candidates all over the archive, but few of them in the origin that is asked.
    """
    revs = revision_keys(archive, nibbles, full)
    here = cut(asked_origins(requests, archive))
    return _proved_here(requests, archive, nibbles, full, proved, here).join(revs, "rev").join(here, "origin")


def _proved_here(requests: DataFrame, archive: Archive, nibbles: int, full: bool, proved: DataFrame | None, here: DataFrame) -> DataFrame:
    """(origin, rev): proved if given, else provenance of the requests' origins."""
    if proved is None:
        wanted = None
        if full:
            # A whole hash has one candidate, so an origin may be done early; a prefix has candidates of other origins, which are never reached.
            pairs = requests.select(canonical_url("repo").alias("origin_url"), revision_swhid("commit_id").alias("rev_swhid")).distinct()
            wanted = pairs.join(here, "origin_url").join(revision_keys(archive, nibbles, full), "rev_swhid").select("origin", "rev")
        proved = provenance(archive, here, wanted)
    return proved


def _ask(url: Column | str, key: Column | str) -> Column:
    """A number for (origin_url, key) to join by; others may have the same."""
    return F.xxhash64(url, key)


def _asked(requests: DataFrame, found: DataFrame, nibbles: int, full: bool, distinct: bool = False, how: str = "inner", numbered: bool = False) -> DataFrame:
    """Requests (distinct ones, if told) with what was found under their origin's URL and key, in buckets or not. One shuffle carries the requests' own columns and a number, by which rows are sorted and met."""
    url, key = canonical_url("repo"), asked_key(nibbles, full)
    asking = requests.withColumn("_ask", _ask(url, key))
    if distinct:
        # Dealt as the join wants it, so that equal rows meet on the way.
        asking = asking.repartition(int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_ask").distinct()
    return asking.join(found, (F.col("_ask") == F.col("ask")) & same(url, "origin_url") & same(key, "key"), how).drop("_ask", "key", *([] if numbered else ["ask"]))


def passing_candidates(requests: DataFrame, archive: Archive, nibbles: int = 7, full: bool | None = None, proved: DataFrame | None = None) -> DataFrame:
    """Groups with each candidate that their origin's snapshots lead to."""
    full = is_full_hash_mode(requests) if full is None else full
    found = passing_by_origin(requests, archive, nibbles, full, proved).withColumn("ask", _ask("origin_url", "key"))
    return _asked(requests.select(*GROUP), found, nibbles, full, distinct=True)


def best_revisions(requests: DataFrame, archive: Archive, nibbles: int = 7, full: bool | None = None, proved: DataFrame | None = None) -> DataFrame:
    """(origin_url, key) -> the winner with its root (null if it has none), written once, in buckets of a number for both (ask).

    All groups that ask an origin for a key have the same winner, however they spell the repository.
    """
    full = is_full_hash_mode(requests) if full is None else full

    def made() -> DataFrame:
        # Numbers are joined with numbers first: hashes are shuffled twice, with what is known of their revision and to their group.
        here = cut(asked_origins(requests, archive))
        found = _proved_here(requests, archive, nibbles, full, proved, here)
        heads = branch_heads(archive).withColumn("head", F.lit(1))
        ranked = cut(found.join(heads, ["origin", "rev"], "left").join(here, "origin").select("origin_url", "rev", "head"))
        hash_, text_ = packed("swhid")
        revs = archive.of_type("rev").select(F.col("node_id").alias("rev"), hash_.alias("_hash"), text_.alias("_text"))
        known = ranked.join(revs.join(root_dirs(archive), "rev", "left"), "rev").withColumn("rev_swhid", unpacked("_hash", "_text"))
        # SWHIDs and keys are spelt out again behind each shuffle.
        asked = _keyed(known, nibbles, full).withColumn("ask", _ask("origin_url", "key")).drop("rev_swhid", "key")
        n = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt_out = asked.repartition(n, "ask").withColumn("rev_swhid", unpacked("_hash", "_text")).drop("_hash", "_text")
        return _best(_keyed(dealt_out, nibbles, full), ("ask", "origin_url", "key"))

    return only(made, "ask")


def select_winners(requests: DataFrame, archive: Archive, nibbles: int = 7, proved: DataFrame | None = None) -> DataFrame:
    """The winning revision of each group that has one, with its root; a winner without root drops its group."""
    full = is_full_hash_mode(requests)
    best = best_revisions(requests, archive, nibbles, full, proved).where("root is not null")
    return _asked(requests.select(*GROUP), best, nibbles, full, distinct=True)


def met_groups(requests: DataFrame, best: DataFrame, nibbles: int, full: bool) -> DataFrame:
    """Each group (repo, commit_id) with what best_revisions() found for it, nulls if nothing."""
    return _asked(requests.select(*GROUP), best, nibbles, full, distinct=True, how="left")


def candidate_rows(requests: DataFrame, archive: Archive, nibbles: int = 7, proved: DataFrame | None = None, numbered: bool = False) -> DataFrame:
    """Request rows with their group's winner: repo, commit_id, rel_path, id, origin_url, rev_swhid, file_path, bin, and root. Numbered ones have ask, which they are dealt by and all rows of a group share."""
    full = is_full_hash_mode(requests)
    best = best_revisions(requests, archive, nibbles, full, proved).where("root is not null")
    return _filled(_asked(requests, best.select("ask", "origin_url", "key", "rev_swhid", "root"), nibbles, full, numbered=numbered), *(["ask"] if numbered else []))


def _filled(rows: DataFrame, *more: str) -> DataFrame:
    """Candidate rows with the columns that repeat others."""
    return rows.select("repo", "commit_id", "rel_path", F.col("rev_swhid").alias("id"), "origin_url", "rev_swhid", F.col("rel_path").alias("file_path"), "bin", "root", *more)


def kept_rows(cands: DataFrame) -> DataFrame:
    """Candidate rows written once, without the columns that repeat others."""
    return _filled(cut(cands.select("repo", "commit_id", "rel_path", "origin_url", "bin", "rev_swhid", "root")))


def counted_rows(requests: DataFrame, archive: Archive, nibbles: int = 7, proved: DataFrame | None = None) -> DataFrame:
    """Candidate rows counted (n) by revision, root and path where they meet their winner, and written without their shuffle; a pair comes once for each (origin, key) that asks for it."""
    rows = candidate_rows(requests, archive, nibbles, proved, numbered=True)
    return cut(rows.groupBy("ask", "rev_swhid", "root", "rel_path").agg(F.count("*").alias("n")).drop("ask"))
