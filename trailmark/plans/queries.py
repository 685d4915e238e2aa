"""One query per operator over the derived archive, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions import scalars as S
from trailmark.operators import candidates as C
from trailmark.operators import diagnostics as D
from trailmark.operators import paths as P
from trailmark.operators.closure import reachable_dirs
from trailmark.operators.lineage import cut, scratch
from trailmark.plans.resolve import count_statuses, count_verified, direct_walk, mismatches, resolve_candidates, run
from trailmark.sources import archive as A
from trailmark.sources.derived import archive_for, archive_path, duck_sql, requests_for

SHORT, FULL = "7", "40"
#: Every other order's requests give the whole hash: one short id sends all to prefix mode.
MIXED = "CASE WHEN l_orderkey % 2 = 0 THEN 40 ELSE 7 END"
#: Three digits collide, so that groups have several candidates.
TIES = 3

Query = Callable[[SparkSession, str], DataFrame]
_kept: dict[tuple, DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], write: bool = True) -> DataFrame:
    """What several queries share, made once a session and kept in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = cut(make()) if write else make()
    return _kept[key]


def _requests(spark: SparkSession, sf_dir: str, mode: str = SHORT) -> DataFrame:
    return _once(spark, sf_dir, f"requests {mode}", lambda: A.as_requests(requests_for(spark, sf_dir, mode)))


def _proved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "provenance", lambda: C.provenance(archive_for(spark, sf_dir)), False)


def _cands(spark: SparkSession, sf_dir: str, mode: str = SHORT, nibbles: int = 7) -> DataFrame:
    return _once(spark, sf_dir, f"cands {mode} {nibbles}", lambda: C.kept_rows(_rows(spark, sf_dir, mode, nibbles)), False)


def _rows(spark: SparkSession, sf_dir: str, mode: str = SHORT, nibbles: int = 7) -> DataFrame:
    """The candidate rows for a query that reads them once; nothing of them is written."""
    r, a = _requests(spark, sf_dir, mode), archive_for(spark, sf_dir)
    return _once(spark, sf_dir, f"rows {mode} {nibbles}", lambda: C.candidate_rows(r, a, nibbles, _proved(spark, sf_dir)), False)


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "paths", lambda: P.counted_paths(_rows(spark, sf_dir)), False)


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "resolved", lambda: resolve_candidates(_cands(spark, sf_dir), archive_for(spark, sf_dir), written=True), False)


def _name(c: str = "name"):
    return F.col(c).cast("string").alias(c)


def canonical_url(spark, d):
    return _requests(spark, d).select("repo", S.canonical_url("repo").alias("url")).distinct()


def origin_swhid(spark, d):
    return _requests(spark, d).select(S.canonical_url("repo").alias("url")).distinct().select("url", S.origin_swhid("url").alias("swhid"))


def normalize_path(spark, d):
    rows = _requests(spark, d).select("rel_path").union(spark.read.parquet(f"{d}/pages.parquet").select("url")).distinct()
    return rows.select("rel_path", S.normalize_path("rel_path").alias("path"))


def path_components(spark, d):
    rows = _requests(spark, d).select("rel_path").distinct()
    return rows.select("rel_path", F.posexplode(S.path_components("rel_path")).alias("pos", "name")).select("rel_path", F.col("pos").cast("long").alias("pos"), _name())


def qualified_id(spark, d):
    rows = _requests(spark, d).distinct()
    c, u = F.concat(F.lit(S.CONTENT), F.sha1("rel_path")), S.canonical_url("repo")
    return rows.select("repo", "commit_id", "rel_path", "bin", S.qualified_id(c, u, F.lit(""), S.revision_swhid("commit_id"), F.col("rel_path")).alias("qualified"))


def parse_bin(spark, d):
    return _requests(spark, d).select("bin", S.parse_bin("bin").alias("n")).distinct()


def node_counts(spark, d):
    return D.node_counts(archive_for(spark, d))


def rev_prefix_index(spark, d):
    rows = C.revision_index(archive_for(spark, d), TIES)
    return rows.groupBy("prefix").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("rev_swhid")), ",").alias("revisions"))


def origin_snapshots(spark, d):
    return C.origin_snapshots(archive_for(spark, d))


def candidates_prefix(spark, d):
    a = archive_for(spark, d)
    # Groups and revisions are distinct, and so are their pairs.
    return C.candidates(C.known_groups(_requests(spark, d), a), a, TIES + 1, False).select("repo", "commit_id", "rev_swhid")


def provenance_pass(spark, d):
    return _proved(spark, d)


def branch_heads(spark, d):
    return C.branch_heads(archive_for(spark, d))


def _winners(mode: str, nibbles: int) -> Query:
    def query(spark, d):
        r, a = _requests(spark, d, mode), archive_for(spark, d)
        return C.select_winners(r, a, nibbles, _proved(spark, d)).select("repo", "commit_id", "origin_url", "rev_swhid", "root", "n_passing", F.col("is_head").cast("long").alias("is_head"))

    return query


def root_dir(spark, d):
    return C.root_dirs(archive_for(spark, d))


def candidate_rows(spark, d):
    return _rows(spark, d)


def candidate_sink(spark, d):
    path = scratch(spark, "cands")
    A.write_candidates(_rows(spark, d), path)
    return spark.read.parquet(path)


def distinct_components(spark, d):
    return P.components(_rows(spark, d)).select(_name())


def component_match(spark, d):
    return P.matched_components(_rows(spark, d), archive_for(spark, d)).select(_name(), "known")


def reachable(spark, d):
    return reachable_dirs(_rows(spark, d).select("root").distinct(), archive_for(spark, d))


def hydrated_entries(spark, d):
    return P.hydrated_entries(_paths(spark, d), archive_for(spark, d)).groupBy("dir").agg(F.count("*").alias("n"), F.min("child").alias("first"), F.max("child").alias("last"))


def path_walk(spark, d):
    p = _paths(spark, d)
    with P.pruned(p, archive_for(spark, d)) as entries:
        return P.walk(p, entries, counted=True).drop("n").withColumn("leaf", F.coalesce("leaf", F.lit(0)))


def direct(spark, d):
    r, a, p = _requests(spark, d), archive_for(spark, d), _proved(spark, d)
    return direct_walk(lambda: C.counted_rows(r, a, 7, p), a)


def resolved(spark, d):
    return _resolved(spark, d)


def resolved_pruned(spark, d):
    return resolve_candidates(_cands(spark, d), archive_for(spark, d), pruning="visited")


def resolved_full_hash(spark, d):
    return resolve_candidates(_cands(spark, d, FULL), archive_for(spark, d))


def resolved_sink(spark, d):
    path = scratch(spark, "resolved")
    A.write_resolved(_resolved(spark, d), path)
    return A.read_resolved(spark, path).groupBy("bin", "status").agg(F.count("*").alias("n"), F.min("qualified").alias("first"), F.max("qualified").alias("last"))


def status_histogram(spark, d):
    return count_statuses(_paths(spark, d), archive_for(spark, d))


def seed_diagnostics(spark, d):
    a = archive_for(spark, d)
    return D.seed_counts(C.candidate_rows(_requests(spark, d), a, 7, _proved(spark, d), numbered=True), P.rooted(a))


def dropped_groups(spark, d):
    return D.dropped_groups(_requests(spark, d), archive_for(spark, d), 7, False, _proved(spark, d))


def verify_counts(spark, d):
    r, a, p = _requests(spark, d), archive_for(spark, d), _proved(spark, d)
    return count_verified(lambda: C.counted_rows(r, a, 7, p), a)


def request_scan(spark, d):
    """Request files without some columns and with others, read back."""
    path = scratch(spark, "requests")
    _requests(spark, d).withColumn("more", F.lit(1)).write.parquet(path)
    return A.read_requests(spark, path)


def null_paths(spark, d):
    """Requests some of whose paths are null, which have no components."""
    rows = _requests(spark, d).select("bin", F.when(F.col("bin") != "abc", F.col("rel_path")).alias("rel_path"))
    return rows.groupBy("bin").agg(F.count("*").alias("n"), F.sum(F.size(S.path_components("rel_path"))).alias("n_parts"))


def directory_entries(spark, d):
    """Entries as they lie in a written archive, one per directory and name."""
    return P.entries_of(archive_for(spark, d)).groupBy("dir").agg(F.count("*").alias("n"), F.min(F.col("name").cast("string")).alias("first"), F.max(F.col("name").cast("string")).alias("last"), F.max("child").alias("largest"))


def command_run(spark, d):
    """The whole command, from request files to resolved files."""
    base = scratch(spark, "run")
    _requests(spark, d).write.parquet(f"{base}-in")
    run(spark, archive_path(spark, d), f"{base}-in", f"{base}-cands", f"{base}-out")
    return A.read_resolved(spark, f"{base}-out")


def mismatch_examples(spark, d):
    """The first ten of the ok rows that a doctored result gets wrong."""
    wrong = _resolved(spark, d).where("bin % 5 = 0").dropDuplicates(["repo", "commit_id", "rel_path"]).withColumn("cnt_swhid", F.concat("cnt_swhid", F.lit("0")))
    return mismatches(archive_for(spark, d), wrong, None)


QUERIES: dict[str, Query] = {
    "canonical_url": canonical_url,
    "origin_swhid": origin_swhid,
    "normalize_path": normalize_path,
    "path_components": path_components,
    "qualified_id": qualified_id,
    "parse_bin": parse_bin,
    "node_counts": node_counts,
    "rev_prefix_index": rev_prefix_index,
    "origin_snapshots": origin_snapshots,
    "candidates_prefix": candidates_prefix,
    "provenance_pass": provenance_pass,
    "branch_heads": branch_heads,
    "winner_short_hash": _winners(SHORT, 7),
    "winner_prefix_ties": _winners(SHORT, TIES),
    "winner_full_hash": _winners(FULL, 7),
    "winner_mixed_hash": _winners(MIXED, 7),
    "root_dir": root_dir,
    "candidate_rows": candidate_rows,
    "candidate_sink": candidate_sink,
    "distinct_components": distinct_components,
    "component_match": component_match,
    "reachable_dirs": reachable,
    "hydrated_entries": hydrated_entries,
    "path_walk": path_walk,
    "direct_walk": direct,
    "resolved": resolved,
    "resolved_pruned": resolved_pruned,
    "resolved_full_hash": resolved_full_hash,
    "resolved_sink": resolved_sink,
    "status_histogram": status_histogram,
    "seed_diagnostics": seed_diagnostics,
    "dropped_groups": dropped_groups,
    "verify_counts": verify_counts,
    "request_scan": request_scan,
    "null_paths": null_paths,
    "directory_entries": directory_entries,
    "command_run": command_run,
    "mismatch_examples": mismatch_examples,
}

# ---------------------------------------------------------------- the same in SQL

_CANON = r"concat('https://github.com/', regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(repo, '^\s+|\s+$', '', 'g'), '^/+|/+$', '', 'g'), '^https://github\.com/', ''), '^github\.com/', ''), '\.git$', ''))"
_NORM = r"replace(regexp_replace(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '^(\./)*/*', ''), '\', '/')"
_PARTS = f"list_filter(string_split({_NORM}, '/'), lambda x: x <> '')"
_BIN = r"coalesce(CASE WHEN TRY_CAST(bin AS INTEGER) BETWEEN 0 AND 65535 THEN TRY_CAST(bin AS INTEGER) END, 0)"

#: Up to the winners; {n} digits, or the whole id.
_WIN = f"""
gu AS (SELECT DISTINCT repo, commit_id, {_CANON} AS origin_url FROM requests),
here AS (SELECT gu.*, node_id AS origin FROM gu JOIN nodes ON swhid = concat('swh:1:ori:', sha1(origin_url))),
snaps AS (SELECT DISTINCT src AS origin, dst AS snapshot FROM edges WHERE src_type = 'ori' AND dst_type = 'snp'),
revs AS (SELECT node_id AS rev, swhid AS rev_swhid FROM nodes WHERE node_type = 'rev'),
cand AS (SELECT here.*, rev, rev_swhid FROM here JOIN revs ON {{match}}),
reach(origin, node) AS (SELECT origin, snapshot FROM snaps UNION SELECT origin, dst FROM reach JOIN edges ON src = node AND dst_type <> 'cnt'),
proved AS (SELECT origin, node AS rev FROM reach JOIN revs ON rev = node),
tips AS (SELECT origin, dst AS rev FROM snaps JOIN edges ON src = snapshot AND dst_type = 'rev' UNION SELECT origin, b.dst FROM snaps JOIN edges a ON a.src = snapshot AND a.dst_type = 'rel' JOIN edges b ON b.src = a.dst AND b.dst_type = 'rev'),
roots AS (SELECT src AS rev, min(dst) AS root FROM edges WHERE src_type = 'rev' AND dst_type = 'dir' GROUP BY src),
passing AS (SELECT cand.*, CASE WHEN tips.rev IS NULL THEN 0 ELSE 1 END AS head FROM cand JOIN proved USING (origin, rev) LEFT JOIN tips ON tips.origin = cand.origin AND tips.rev = cand.rev),
placed AS (SELECT *, row_number() OVER (PARTITION BY repo, commit_id ORDER BY head DESC, rev_swhid DESC) AS place, count(*) OVER (PARTITION BY repo, commit_id) AS n_passing FROM passing),
chosen AS (SELECT * FROM placed WHERE place = 1),
won AS (SELECT chosen.*, root FROM chosen JOIN roots USING (rev)),
cands AS (SELECT requests.repo, requests.commit_id, rel_path, rev_swhid AS id, origin_url, rev_swhid, rel_path AS file_path, bin, root FROM requests JOIN won ON won.repo = requests.repo AND won.commit_id = requests.commit_id)
"""

_WALK = f"""
first_entries AS (SELECT dir, name, min(child) AS child, min_by(child_type, child) AS child_type FROM entries GROUP BY dir, name),
asked AS (SELECT DISTINCT root, rel_path, {_PARTS.format(c='rel_path')} AS comps FROM cands),
steps(root, rel_path, comps, i, cur, kind) AS (
  SELECT root, rel_path, comps, 0, root, 'dir' FROM asked
  UNION ALL SELECT s.root, s.rel_path, s.comps, s.i + 1, e.child, coalesce(e.child_type, 'absent') FROM steps s LEFT JOIN first_entries e ON e.dir = s.cur AND e.name = s.comps[s.i + 1] WHERE s.kind = 'dir' AND s.i < len(s.comps)),
ends AS (SELECT root, rel_path, comps, max_by(cur, i) AS cur, max_by(kind, i) AS kind, max(i) AS i FROM steps GROUP BY ALL),
walked AS (SELECT root, rel_path, CASE WHEN kind = 'cnt' AND i = len(comps) THEN cur END AS leaf,
  CASE WHEN len(comps) = 0 THEN 'not_found' WHEN kind = 'rev' THEN 'submodule' WHEN kind = 'dir' THEN 'dir_target' WHEN kind = 'cnt' AND i = len(comps) THEN 'ok' ELSE 'not_found' END AS status_detail FROM ends)
"""

_OUT = f"""
outs AS (SELECT c.repo, c.commit_id, c.rel_path, c.id, c.origin_url, '' AS snapshot_swhid, c.rev_swhid, coalesce(swhid, '') AS cnt_swhid,
  CASE WHEN leaf IS NULL THEN '' ELSE concat(swhid, ';origin=', origin_url, ';visit=;anchor=', c.id, ';path=/', {_NORM.format(c='c.rel_path')}) END AS qualified,
  CASE WHEN status_detail = 'ok' THEN 'ok' ELSE 'path_not_found' END AS status, {_BIN} AS bin
  FROM cands c JOIN walked w ON w.root = c.root AND w.rel_path = c.rel_path LEFT JOIN nodes ON node_id = leaf)
"""


def _match(n: int | None) -> str:
    return "rev_swhid = concat('swh:1:rev:', commit_id)" if n is None else f"substr(rev_swhid, 11, {n}) = lower(substr(commit_id, 1, {n}))"


def _sql(select: str, mode: str = SHORT, n: int | None = 7, upto: str = "requests") -> str:
    parts = [duck_sql(mode)]
    if upto in ("cands", "walked", "outs"):
        parts.append(_WIN.format(match=_match(n)))
    if upto in ("walked", "outs"):
        parts.append(_WALK)
    if upto == "outs":
        parts.append(_OUT)
    return f"WITH RECURSIVE {','.join(parts)} {select}"


_WON = "SELECT repo, commit_id, origin_url, rev_swhid, root, n_passing, head::BIGINT AS is_head FROM won"
_BELOW = "below(dir) AS (SELECT DISTINCT root FROM cands UNION SELECT child FROM below JOIN entries USING (dir) WHERE child_type = 'dir')"
_NAMES = f"names AS (SELECT DISTINCT unnest({_PARTS.format(c='rel_path')}) AS name FROM cands)"

#: Ok rows resolved once more, from revision and path alone, over all entries.
_AGAIN = f""",
okay AS MATERIALIZED (SELECT rev_swhid, rel_path, cnt_swhid FROM outs WHERE status = 'ok'),
tops AS MATERIALIZED (SELECT swhid AS rev_swhid, min(dst) AS top FROM nodes JOIN edges ON src = node_id AND src_type = 'rev' AND dst_type = 'dir' GROUP BY swhid),
down(rev_swhid, rel_path, names, place, cur, kind) AS (
  SELECT DISTINCT o.rev_swhid, o.rel_path, {_PARTS.format(c='o.rel_path')}, 0, top, 'dir' FROM okay o JOIN tops USING (rev_swhid)
  UNION SELECT d.rev_swhid, d.rel_path, d.names, d.place + 1, e.child, e.child_type FROM down d JOIN first_entries e ON e.dir = d.cur AND e.name = d.names[d.place + 1] WHERE d.kind = 'dir'),
redone AS (SELECT d.rev_swhid, d.rel_path, c.swhid AS again FROM down d JOIN nodes c ON c.node_id = d.cur WHERE d.kind = 'cnt' AND d.place = len(d.names))
"""
_COUNTS = """SELECT (SELECT count(*) FROM okay)::BIGINT AS sampled, count_if(again = cnt_swhid)::BIGINT AS matched, count_if(again <> cnt_swhid)::BIGINT AS mismatched, count_if(again IS NULL)::BIGINT AS unresolved,
  (SELECT count(*) FROM outs WHERE status <> 'ok')::BIGINT AS other FROM okay LEFT JOIN redone USING (rev_swhid, rel_path)"""


ORACLE_SQL: dict[str, str] = {
    "canonical_url": _sql(f"SELECT DISTINCT repo, {_CANON} AS url FROM requests"),
    "origin_swhid": _sql(f"SELECT url, concat('swh:1:ori:', sha1(url)) AS swhid FROM (SELECT DISTINCT {_CANON} AS url FROM requests)"),
    "normalize_path": _sql(f"SELECT rel_path, {_NORM.format(c='rel_path')} AS path FROM (SELECT rel_path FROM requests UNION SELECT url FROM pages)"),
    "path_components": _sql(f"SELECT rel_path, unnest(range(len(parts)))::BIGINT AS pos, unnest(parts) AS name FROM (SELECT DISTINCT rel_path, {_PARTS.format(c='rel_path')} AS parts FROM requests)"),
    "qualified_id": _sql(f"SELECT DISTINCT repo, commit_id, rel_path, bin, concat('swh:1:cnt:', sha1(rel_path), ';origin=', {_CANON}, ';visit=;anchor=swh:1:rev:', commit_id, ';path=/', {_NORM.format(c='rel_path')}) AS qualified FROM requests"),
    "parse_bin": _sql(f"SELECT DISTINCT bin, {_BIN} AS n FROM requests"),
    "node_counts": _sql("SELECT node_type, count(*) AS n FROM nodes GROUP BY node_type"),
    "rev_prefix_index": _sql(f"SELECT substr(swhid, 11, {TIES}) AS prefix, count(*) AS n, string_agg(swhid, ',' ORDER BY swhid) AS revisions FROM nodes WHERE node_type = 'rev' GROUP BY 1"),
    "origin_snapshots": _sql("SELECT DISTINCT src AS origin, dst AS snapshot FROM edges WHERE src_type = 'ori' AND dst_type = 'snp'"),
    "candidates_prefix": _sql("SELECT DISTINCT repo, commit_id, rev_swhid FROM cand", n=TIES + 1, upto="cands"),
    "provenance_pass": _sql("SELECT origin, rev FROM proved", upto="cands"),
    "branch_heads": _sql("SELECT origin, rev FROM tips", upto="cands"),
    "winner_short_hash": _sql(_WON, upto="cands"),
    "winner_prefix_ties": _sql(_WON, n=TIES, upto="cands"),
    "winner_full_hash": _sql(_WON, FULL, None, upto="cands"),
    "winner_mixed_hash": _sql(_WON, MIXED, 7, upto="cands"),
    "root_dir": _sql("SELECT rev, root FROM roots", upto="cands"),
    "candidate_rows": _sql("SELECT * FROM cands", upto="cands"),
    "candidate_sink": _sql("SELECT repo, commit_id, rel_path, id, origin_url, rev_swhid, file_path, bin FROM cands", upto="cands"),
    "distinct_components": _sql(f", {_NAMES} SELECT name FROM names", upto="cands"),
    "component_match": _sql(f", {_NAMES} SELECT name, name IN (SELECT name FROM entries) AS known FROM names", upto="cands"),
    "reachable_dirs": _sql(f", {_BELOW} SELECT dir FROM below", upto="cands"),
    "hydrated_entries": _sql(f", {_BELOW}, {_NAMES} SELECT dir, count(*) AS n, min(child) AS first, max(child) AS last FROM (SELECT DISTINCT dir, name, child FROM entries WHERE dir IN (SELECT dir FROM below) AND name IN (SELECT name FROM names)) GROUP BY dir", upto="cands"),
    "path_walk": _sql("SELECT root, rel_path, coalesce(leaf, 0) AS leaf, status_detail FROM walked", upto="walked"),
    "direct_walk": _sql("SELECT DISTINCT rev_swhid, c.rel_path, leaf FROM cands c JOIN walked w ON w.root = c.root AND w.rel_path = c.rel_path WHERE leaf IS NOT NULL", upto="walked"),
    "resolved": _sql("SELECT * FROM outs", upto="outs"),
    "resolved_pruned": _sql("SELECT * FROM outs", upto="outs"),
    "resolved_full_hash": _sql("SELECT * FROM outs", FULL, None, upto="outs"),
    "resolved_sink": _sql("SELECT bin, status, count(*) AS n, min(qualified) AS first, max(qualified) AS last FROM outs GROUP BY bin, status", upto="outs"),
    "status_histogram": _sql("SELECT status, count(*) AS n FROM outs GROUP BY status", upto="outs"),
    "seed_diagnostics": _sql(f"SELECT count(*) AS n_rows, count(DISTINCT rev_swhid) AS n_revisions, count_if(root IS NULL)::BIGINT AS missing_roots, count_if({_BIN} NOT BETWEEN 48 AND 127)::BIGINT AS stray_bins, count_if(TRY_CAST(bin AS INTEGER) IS NULL)::BIGINT AS unparsable_bins, 0::BIGINT AS ambiguous FROM cands", upto="cands"),
    "dropped_groups": _sql(
        """SELECT CASE WHEN h.origin IS NULL THEN 'no_origin' WHEN h.origin NOT IN (SELECT origin FROM snaps) THEN 'no_snapshot' WHEN c.repo IS NULL THEN 'no_candidate' WHEN p.repo IS NULL THEN 'no_provenance'
        WHEN w.repo IS NULL THEN 'no_root' ELSE 'resolved' END AS reason, count(*) AS n FROM gu LEFT JOIN here h USING (repo, commit_id) LEFT JOIN (SELECT DISTINCT repo, commit_id FROM cand) c USING (repo, commit_id)
        LEFT JOIN chosen p USING (repo, commit_id) LEFT JOIN won w USING (repo, commit_id) GROUP BY 1""",
        upto="cands",
    ),
    "verify_counts": _sql(f"{_AGAIN} {_COUNTS}", upto="outs"),
    "request_scan": _sql("SELECT repo, commit_id, rel_path, bin FROM requests"),
    "null_paths": _sql(f"SELECT bin, count(*) AS n, sum(CASE WHEN bin = 'abc' THEN 0 ELSE len({_PARTS.format(c='rel_path')}) END)::BIGINT AS n_parts FROM requests GROUP BY bin"),
    "directory_entries": _sql("SELECT dir, count(*) AS n, min(name) AS first, max(name) AS last, max(child) AS largest FROM (SELECT dir, name, min(child) AS child FROM entries GROUP BY dir, name) GROUP BY dir"),
    "command_run": _sql("SELECT * FROM outs", upto="outs"),
    "mismatch_examples": _sql(
        f"""{_AGAIN} SELECT DISTINCT o.repo, o.commit_id, o.rel_path, concat(o.cnt_swhid, '0') AS cnt_swhid, again FROM outs o LEFT JOIN redone r ON r.rev_swhid = o.rev_swhid AND r.rel_path = o.rel_path
        WHERE o.status = 'ok' AND o.bin % 5 = 0 ORDER BY o.repo, o.commit_id, o.rel_path LIMIT 10""",
        upto="outs",
    ),
}
