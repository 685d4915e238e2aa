"""python -m trailmark.plans.cli resolve|verify"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from trailmark.operators.diagnostics import status_histogram
from trailmark.plans.resolve import mismatches, run, sampled, verify
from trailmark.sources.archive import read_archive, read_resolved


def main(args: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="trailmark")
    sub = top.add_subparsers(dest="command", required=True)
    r = sub.add_parser("resolve")
    for name in ("--graph-dir", "--input", "--cands-out", "--out-dir"):
        r.add_argument(name, required=True)
    r.add_argument("--prefix-nibbles", type=int, default=7)
    r.add_argument("--cands-only", action="store_true")
    r.add_argument("--quiet", action="store_true", help="print no counts")
    v = sub.add_parser("verify")
    for name in ("--graph-dir", "--resolved"):
        v.add_argument(name, required=True)
    v.add_argument("--n", type=int, default=2000)
    a = top.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if a.command == "resolve":
        run(spark, a.graph_dir, a.input, a.cands_out, a.out_dir, a.prefix_nibbles, a.cands_only, None if a.quiet else lambda name, counts: print(f"{name}: {counts}"))
        return 0
    archive, resolved = read_archive(spark, a.graph_dir), read_resolved(spark, a.resolved)
    status_histogram(resolved).show()
    ok = sampled(resolved, a.n)
    counts = verify(archive, resolved, ok=ok).first()
    print(counts.asDict())
    good = counts["matched"] == counts["sampled"]
    if not good:
        mismatches(archive, resolved, ok=ok).show(truncate=False)
    return 0 if good else 1


if __name__ == "__main__":
    raise SystemExit(main())
