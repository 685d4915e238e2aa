"""Walking paths through directories, and what the walk needs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.functions.scalars import output_status, path_components, qualified_id, revision_swhid, same
from trailmark.operators.candidates import root_dirs
from trailmark.operators.closure import closure, reachable_dirs
from trailmark.operators.lineage import bucketed, cut, dealt, drop, met_in_buckets
from trailmark.operators.membership import WIDE, marks_of, split, split_by
from trailmark.sources.archive import Archive, first_entries

OK, NOT_FOUND, DIR_TARGET, SUBMODULE, NO_ROOT = "ok", "not_found", "dir_target", "submodule", "no_root"


def rooted(archive: Archive) -> DataFrame:
    """(rev_swhid, root) of the revisions that have a directory."""
    return archive.of_type("rev").select(F.col("swhid").alias("rev_swhid"), F.col("node_id").alias("rev")).join(root_dirs(archive), "rev").select("rev_swhid", "root")


def seeds(cands: DataFrame, archive: Archive) -> DataFrame:
    """Candidate rows with their revision's root; null for an unknown revision or one without directory."""
    revs = rooted(archive).withColumnRenamed("rev_swhid", "_rev")
    rows = cands.drop("root") if "root" in cands.columns else cands
    of = revision_swhid("rev_swhid")
    numbered = revs.withColumn("_their", F.xxhash64("_rev"))
    return rows.withColumn("_mine", F.xxhash64(of)).join(numbered, (F.col("_mine") == F.col("_their")) & same(of, "_rev"), "left").drop("_rev", "_mine", "_their")


def components(rows: DataFrame) -> DataFrame:
    """Distinct path components (name) of rows' rel_path."""
    return rows.select(F.explode(path_components("rel_path")).alias("name")).distinct()


def matched_components(rows: DataFrame, archive: Archive) -> DataFrame:
    """(name, known): whether any directory of the archive has an entry of that name, compared as bytes."""
    names = cut(components(rows))  # what the rows took is gone before entries are made
    have = split(archive.entries, "name", names, "name")[0].select("name").distinct().withColumn("known", F.lit(True))
    return names.join(have, "name", "left").select("name", F.coalesce("known", F.lit(False)).alias("known"))


def entries_of(archive: Archive, entries: DataFrame | None = None) -> DataFrame:
    """One entry per (dir, name), of all or of some entries of the archive."""
    entries = archive.entries if entries is None else entries
    return entries if archive.unique else first_entries(entries)


def named_entries(rows: DataFrame, archive: Archive) -> DataFrame:
    """The archive's entries that may have a name among the components of rows' rel_path: all that do, and a few others.

    A bitmap of the names rules entries out as they are read, so that what is left is all that is ever shuffled.
    """
    return split(archive.entries, "name", cut(components(rows)), "name")[0]


@contextmanager
def pruned(rows: DataFrame, archive: Archive) -> Iterator[DataFrame]:
    """The entries that walks of rows can look up by name, one per (dir, name), written once in buckets of both: a walk shuffles its paths only."""
    kept = entries_of(archive, named_entries(rows, archive)).select("dir", "name", "child", "child_type")
    with bucketed(kept, "dir", "name") as table:
        yield table


def visited(rows: DataFrame, named: DataFrame) -> DataFrame:
    """Of pruned entries those that walks of rows (root, rel_path) can come by: in a directory that
    their names lead to from one of the roots. Only these directories are followed, not all that lie below the roots.
    """
    starts = rows.where("root is not null").select(F.col("root").alias("node"))
    dirs = closure(starts, named.where("child_type = 'dir'").select(F.col("dir").alias("src"), F.col("child").alias("dst")))
    return named.join(dirs.select(F.col("node").alias("dir")), "dir", "left_semi")


def hydrated_entries(rows: DataFrame, archive: Archive) -> DataFrame:
    """The entries below the roots of rows (root, rel_path), however deep, that are named by one of their components."""
    dirs = reachable_dirs(rows.select("root").distinct(), archive)
    names = cut(components(rows))
    kept = split(archive.entries, "name", names, "name")[0].join(dirs, "dir", "left_semi").join(names, "name", "left_semi")
    return entries_of(archive, kept.select("dir", "name", "child", "child_type"))


def _step(last: Column) -> tuple[Column, Column]:
    """Status (null: go on) after a lookup that gave child_type."""
    kind = F.col("child_type")
    end = F.when(kind == "cnt", OK).when(kind == "dir", DIR_TARGET).when(kind == "rev", SUBMODULE).otherwise(NOT_FOUND)
    way = F.when(kind == "dir", F.lit(None).cast("string")).when(kind == "rev", SUBMODULE).otherwise(NOT_FOUND)
    return F.when(last, end).otherwise(way)


def counted_paths(rows: DataFrame) -> DataFrame:
    """Distinct (root, rel_path) of candidate rows with their number n, written once: all of the rows that a walk needs."""
    return cut(rows.groupBy("root", "rel_path").agg(F.count("*").alias("n")))


def walk(pairs: DataFrame, entries: DataFrame, counted: bool = False) -> DataFrame:
    """(root, rel_path) -> distinct root, rel_path, leaf, status_detail; entries has a row per (dir, name). Counted pairs are distinct, and keep their n.

    Each round looks up one more component of the paths still on their way, and finished ones are set
    aside, so that a round shuffles only what it has to and names like README.md meet their directory. All rounds are
    done when this returns; the result doesn't need entries any more.
    """
    cols = ["root", "rel_path", *(["n"] if counted else [])]
    rows = (pairs.select(cols) if counted else pairs.select(cols).distinct()).withColumn("comps", path_components("rel_path"))
    status = F.when(F.col("root").isNull(), NO_ROOT).when(F.size("comps") == 0, NOT_FOUND)
    rows = cut(rows.select(*cols, "comps", F.col("root").alias("cur"), F.lit(None).cast("long").alias("leaf"), status.alias("status_detail")))
    done = [rows.where("status_detail is not null")]
    i = 0
    while not (active := rows.where("status_detail is null")).isEmpty():
        found = active.join(entries, (F.col("cur") == F.col("dir")) & (F.get("comps", F.lit(i)) == F.col("name")), "left")
        last = F.size("comps") == i + 1
        status = _step(last)
        leaf = F.when(last & (F.col("child_type") == "cnt"), F.col("child"))
        rows = cut(found.select(*cols, "comps", F.col("child").alias("cur"), leaf.alias("leaf"), status.alias("status_detail")))
        done.append(rows.where("status_detail is not null"))
        i += 1
    return reduce(DataFrame.union, done).select(*cols, "leaf", "status_detail")


def walk_dealt(rows: DataFrame, archive: Archive, *keep: str) -> DataFrame:
    """What walk() says of rows (root, rel_path, keep, n), by root, rel_path and keep with the sum of n, in the same steps, for rows too many to be shuffled in each of them.

    Rows are dealt by root once and stay there; a round shuffles the distinct (root, directory, name) that it looks up, and of the entries
    those that a bitmap of these lets through.
    """
    cols, spark = ["root", "rel_path", *keep, "n"], rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    status = F.when(F.col("root").isNull(), NO_ROOT).when(F.size("comps") == 0, NOT_FOUND)
    counted = rows.repartition(n, "root").groupBy(*cols[:-1]).agg(F.sum("n").alias("n")).withColumn("comps", path_components("rel_path"))
    now = dealt(counted.select(*cols, "comps", F.col("root").alias("cur"), F.lit(None).cast("long").alias("leaf"), status.alias("status_detail")), "root")
    done: list[DataFrame] = []
    i = 0
    with met_in_buckets(spark):
        while not (active := now.where("status_detail is null")).isEmpty():
            active = active.withColumn("want", F.get("comps", F.lit(i)))
            asked = active.select("root", "cur", "want").distinct()
            marks = marks_of(asked.select(F.xxhash64("cur", "want").alias("at")), "at", WIDE)
            entries = entries_of(archive, split_by(archive.entries.withColumn("at", F.xxhash64("dir", "name")), "at", marks, WIDE)[0].drop("at"))
            met = asked.join(entries, (F.col("cur") == F.col("dir")) & (F.col("want") == F.col("name")))
            found = cut(met.select(F.col("root").alias("_root"), F.col("cur").alias("_cur"), F.col("want").alias("_want"), "child", "child_type"))
            last = F.size("comps") == i + 1
            leaf = F.when(last & (F.col("child_type") == "cnt"), F.col("child"))
            on = (F.col("root") == F.col("_root")) & (F.col("cur") == F.col("_cur")) & (F.col("want") == F.col("_want"))
            after = active.drop("leaf", "status_detail").join(found.repartition(n, "_root"), on, "left")
            after = dealt(after.select(*cols, "comps", F.col("child").alias("cur"), leaf.alias("leaf"), _step(last).alias("status_detail")), "root")
            ended = now.where("status_detail is not null")
            if not ended.isEmpty():
                done.append(cut(ended.select(*cols, "leaf", "status_detail")))
            drop(found), drop(now)
            now = after
            i += 1
    return reduce(DataFrame.union, [now.select(*cols, "leaf", "status_detail"), *done])


def met_paths(rows: DataFrame, walked: DataFrame, archive: Archive) -> DataFrame:
    """Candidate rows with status_detail and the SWHID (cnt) that their path leads to, without the columns that repeat others."""
    cnt = archive.of_type("cnt").select(F.col("node_id").alias("leaf"), F.col("swhid").alias("cnt"))
    # Contents are looked up for the walked paths that have one, so that rows are shuffled once and nulls never.
    cols = [F.col("root").alias("_root"), F.col("rel_path").alias("_path")]
    found = walked.where("leaf is not null").join(cnt, "leaf", "left").select(*cols, "cnt", "status_detail")
    w = found.union(walked.where("leaf is null").select(*cols, F.lit(None).cast("string").alias("cnt"), "status_detail"))
    out = rows.join(w, rows["root"].eqNullSafe(w["_root"]) & (rows["rel_path"] == w["_path"]))
    return out.select("repo", "commit_id", "rel_path", "id", "origin_url", "rev_swhid", "bin", "cnt", "status_detail")


def emit(met: DataFrame, detail: bool = False) -> DataFrame:
    """The ten output columns and bin (text) for each row of met_paths(); with detail, status_detail too."""
    ok = F.col("status_detail") == OK
    none = F.lit("")
    return met.select(
        "repo", "commit_id", "rel_path", revision_swhid("id").alias("id"), "origin_url", none.alias("snapshot_swhid"), "rev_swhid", F.when(ok, F.col("cnt")).otherwise(none).alias("cnt_swhid"),
        F.when(ok, qualified_id(F.col("cnt"), F.col("origin_url"), none, revision_swhid("id"), F.col("rel_path"))).otherwise(none).alias("qualified"), output_status("status_detail").alias("status"), "bin", *(["status_detail"] if detail else []),
    )
