"""Reachability by frontiers, in rounds that each end in the shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.operators.lineage import bucketed, cut, drop
from trailmark.operators.membership import split

ROUNDS = 100_000
#: Rounds of single steps before long stretches are looked for, and times as many if the frontier is small: its rounds are cheap, the stretches are those of the whole graph.
PATIENCE, LONGER = 24, 4
#: Rows of a frontier that are broadcast; below SOME a bitmap of what they lead to rules out most of what was reached before.
FEW, SOME = 100_000, 4_000_000


def _jumps(single: DataFrame) -> list[DataFrame]:
    """Tables (src, dst) of 1, 2, 4, ... steps along nodes with one way on; as many rows as such nodes at most.

    No way without a repeat is longer than there are such nodes, so cycles end the doubling too.
    """
    out = [cut(single)]
    most = out[0].count().bit_length()
    while not out[-1].isEmpty() and len(out) <= most:
        a, b = out[-1].alias("a"), out[-1].alias("b")
        out.append(cut(a.join(b, F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))))
    return [j for j in out if not j.isEmpty()]


def closure(starts: DataFrame, edges: DataFrame, keys: tuple[str, ...] = (), wanted: DataFrame | None = None, patience: int = PATIENCE) -> DataFrame:
    """All (keys, node) that starts (keys, node) reach along edges (src, dst), starts included.

    The first `patience` rounds go one step from what the round before reached, and write nothing else; a small frontier has LONGER times as
    many. If the frontier still lives then, there are long stretches of nodes with one way on, such as linear histories: these are run down by doubled jumps, in log2 of
    their length joins, and each round then takes one step where ways part; the jumps' tables hold a row per node with one way on. Nodes
    reached before aren't followed again, so cycles and diamonds end. With wanted (keys, node) a key is followed only
    until all that it wants is reached; what is wanted and reachable is in the result then, other nodes may not be.
    """
    if wanted is not None and not keys:
        raise ValueError("wanted needs keys")
    # Every round joins the edges: they are made and dealt by source once.
    with bucketed(edges.select("src", "dst"), "src") as table:
        return _closed(starts, table, keys, wanted, patience)


def _closed(starts: DataFrame, edges: DataFrame, keys: tuple[str, ...], wanted: DataFrame | None, patience: int) -> DataFrame:
    cols = [*keys, "node"]
    parts = [cut(starts.select(*cols).distinct())]
    parting = edges
    jumps: list[DataFrame] = []

    def run_down(rows: DataFrame) -> DataFrame:
        for j in reversed(jumps):
            step = j.select(F.col("src").alias("node"), F.col("dst").alias("_to"))
            rows = rows.join(step, "node", "left").select(*keys, F.explode(F.array_compact(F.array("node", "_to"))).alias("node"))
        return rows.distinct() if jumps else rows

    def seen() -> DataFrame:
        return reduce(DataFrame.union, parts)

    def followed(rows: DataFrame) -> DataFrame:
        if wanted is None:
            return rows
        missing = wanted.select(*cols).join(seen(), cols, "left_anti").select(*keys).distinct()
        return rows.join(missing, list(keys), "left_semi")

    def steps(rows: DataFrame, n: int) -> DataFrame:
        rows = F.broadcast(followed(rows)) if n <= FEW else followed(rows)
        return rows.join(parting, F.col("node") == F.col("src")).select(*keys, F.col("dst").alias("node")).distinct()

    def unseen(rows: DataFrame) -> DataFrame:
        """rows, once written, that weren't reached before; few rows spare what was reached a shuffle, more spare it most of one."""
        rows = cut(rows)
        n = rows.count()
        before = seen().join(F.broadcast(rows), cols, "left_semi") if n <= FEW else split(seen(), "node", rows, "node")[0] if n <= SOME else seen()
        out = cut(rows.join(before, cols, "left_anti"))
        drop(rows)
        return out

    many, run_out = parts[0].count(), False
    for n in range(ROUNDS):
        if not run_out and n >= patience and (many > FEW or n >= LONGER * patience):
            run_out = True
            # From here on the last part is all that has to be followed.
            ways = edges.distinct().groupBy("src").agg(F.count("*").alias("ways"), F.min("dst").alias("dst"))
            ways = cut(ways)
            jumps = _jumps(ways.where("ways = 1").select("src", "dst"))
            parting = edges.join(ways.where("ways > 1"), "src", "left_semi").select("src", "dst")
            last = parts.pop()
            before = reduce(DataFrame.union, parts) if parts else None
            down = run_down(last)
            parts.append(cut(down.join(before, cols, "left_anti") if before is not None else down))
            drop(last)
            many = parts[-1].count()
        fresh = unseen(steps(parts[-1], many))
        if jumps:
            fresh = unseen(run_down(fresh))
        many = fresh.count()
        if not many:
            return seen()
        parts.append(fresh)
        if len(parts) > 8:  # parts hold no row in common
            whole = cut(reduce(DataFrame.union, parts[:-1]))
            for old in parts[:-1]:
                drop(old)
            parts = [whole, fresh]
    raise RuntimeError("the closure did not end")


def reachable_dirs(roots: DataFrame, archive) -> DataFrame:
    """(dir) reachable from roots (root) along directory entries, roots included; null roots are left out."""
    starts = roots.where("root is not null").select(F.col("root").alias("node"))
    return closure(starts, archive.links("dir", "dir")).select(F.col("node").alias("dir"))
