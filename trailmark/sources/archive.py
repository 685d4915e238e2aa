"""An archive graph as three tables, and request files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.functions.scalars import text

NODES = "node_id long, swhid string, node_type string"
EDGES = "src long, src_type string, dst long, dst_type string"
ENTRIES = "dir long, name binary, child long, child_type string"
REQUEST = ("repo", "commit_id", "rel_path")
CANDIDATE = ("repo", "commit_id", "rel_path", "id", "origin_url", "rev_swhid", "file_path", "bin")
OUTPUT = ("repo", "commit_id", "rel_path", "id", "origin_url", "snapshot_swhid", "rev_swhid", "cnt_swhid", "qualified", "status")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


@dataclass(frozen=True)
class Archive:
    """nodes by SWHID, typed edges, and labelled directory entries. Node types: ori, snp, rel, rev, dir, cnt.

    unique tells that entries has one row per (dir, name), as write_archive leaves it.
    """

    nodes: DataFrame
    edges: DataFrame
    entries: DataFrame
    unique: bool = False

    def of_type(self, kind: str) -> DataFrame:
        return self.nodes.where(F.col("node_type") == kind)

    def links(self, src: str, dst: str) -> DataFrame:
        """(src, dst) of the edges between two types."""
        return self.edges.where((F.col("src_type") == src) & (F.col("dst_type") == dst)).select("src", "dst")

    def edge_parts(self) -> list[DataFrame]:
        """Frames that make up edges. What is filtered in each of them may spare computing the rest of a row."""
        return [self.edges]

    def num_nodes(self) -> int:
        return self.nodes.count()


#: Tells in an archive's folder that its entries have one row per (dir, name), clustered by dir.
CLUSTERED = "entries-by-dir"


def read_archive(spark: SparkSession, path: str) -> Archive:
    """The tables under path, by whomever they were written."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{CLUSTERED}")
    unique = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)
    return Archive(*(spark.read.schema(s).parquet(f"{path}/{n}") for n, s in (("nodes", NODES), ("edges", EDGES), ("entries", ENTRIES))), unique)


def first_entries(entries: DataFrame) -> DataFrame:
    """One entry per (dir, name): the smallest child."""
    first = entries.groupBy("dir", "name").agg(F.min(F.struct("child", "child_type")).alias("e"))
    return first.select("dir", "name", "e.child", "e.child_type")


def write_archive(archive: Archive, path: str) -> None:
    """The tables, clustered by what is looked up in them: nodes by type and SWHID, edges by types and source, entries by dir and name.

    Entries are dealt by ranges of dir, so that a file, and a row group in it, spans few directories and its statistics tell which;
    of several entries of one name in a directory the one that walks take is kept.
    """
    spark = archive.nodes.sparkSession
    archive.nodes.sortWithinPartitions("node_type", "swhid").write.parquet(f"{path}/nodes")
    archive.edges.sortWithinPartitions("src_type", "dst_type", "src").write.parquet(f"{path}/edges")
    entries = archive.entries if archive.unique else first_entries(archive.entries)
    entries.select("dir", "name", "child", "child_type").repartitionByRange("dir").sortWithinPartitions("dir", "name").write.parquet(f"{path}/entries")
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{CLUSTERED}")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()


def as_requests(df: DataFrame) -> DataFrame:
    """repo, commit_id, rel_path, bin as text, null as ''; a missing bin is ''. Other columns are dropped."""
    require_columns(df, *REQUEST)
    bin_ = text(F.col("bin").cast("string")) if "bin" in df.columns else F.lit("")
    return df.select(*[text(c).alias(c) for c in REQUEST], bin_.alias("bin"))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    return as_requests(spark.read.parquet(path))


def write_candidates(cands: DataFrame, path: str) -> None:
    require_columns(cands, *CANDIDATE).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in CANDIDATE]).write.parquet(path)


def write_resolved(resolved: DataFrame, path: str) -> None:
    """A folder bin=<b> for each bin, zstd Parquet. Rows are gathered by bin as far as partitions of a sensible size go: a large bin is several tasks' work and files."""
    out = require_columns(resolved, *OUTPUT, "bin").select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in OUTPUT], "bin")
    out.hint("rebalance", "bin").write.partitionBy("bin").option("compression", "zstd").parquet(path)


def read_resolved(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
