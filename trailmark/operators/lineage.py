"""Where lineage is cut: a folder that every executor sees."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only a local master, whose executors are this process, may leave it unset: a folder of our own, gone at exit."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(sc, "_trailmark_dir", None)
    if own is None:
        own = sc._trailmark_dir = tempfile.mkdtemp(prefix="trailmark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder, so that lost executors don't rerun what came before; gone once Spark's cleaner finds it unused."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: With this, an execution's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scope: ContextVar[list[DataFrame] | None] = ContextVar("scope", default=None)


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df._trailmark_path = path
    if (made := _scope.get()) is not None:
        made.append(df)
    return df


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder as compressed Parquet and read back: a fraction of a checkpoint, and the shuffle files that it took go at once.

    The table lasts until drop() or the end of the scope it was made in; outside of scopes, as long as the folder.
    """
    spark = df.sparkSession
    path = scratch(spark, "cut")
    with _tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    return _kept(spark.read.schema(df.schema).parquet(path), path)


def dealt(df: DataFrame, *cols: str) -> DataFrame:
    """cut() into buckets, for df that is grouped by cols already: joins on them shuffle the other side only."""
    name, path = f"trailmark_{uuid.uuid4().hex}", scratch(df.sparkSession, "dealt")
    return _kept(buckets(df, name, path, *cols, grouped=True), path)


def drop(df: DataFrame) -> None:
    """Remove the table that cut() or dealt() made; nothing that reads it may be run any more."""
    remove(df.sparkSession, df._trailmark_path)


@contextmanager
def scope() -> Iterator[None]:
    """What cut() makes in here is removed at the end."""
    made: list[DataFrame] = []
    outer = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(outer)
        for df in made:
            drop(df)


def only(make: Callable[[], DataFrame], *cols: str) -> DataFrame:
    """What make() returns, written, in buckets if it is grouped by cols; whatever else was cut on the way is removed."""
    made: list[DataFrame] = []
    outer = _scope.set(made)
    try:
        out = dealt(make(), *cols) if cols else cut(make())
    finally:
        _scope.reset(outer)
    for df in made:
        if df is not out:
            drop(df)
    if (around := _scope.get()) is not None:
        around.append(out)
    return out


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/trailmark-{name}-{uuid.uuid4().hex}"


@contextmanager
def bucketed(df: DataFrame, *cols: str) -> Iterator[DataFrame]:
    """df as a table in the shared folder, dealt into as many buckets as there are shuffle partitions: joins on cols shuffle the other side only.

    The table lasts as long as the context; a checkpoint wouldn't keep how its rows are dealt.
    """
    spark = df.sparkSession
    name = f"trailmark_{uuid.uuid4().hex}"
    path = scratch(spark, "buckets")
    try:
        yield buckets(df, name, path, *cols)
    finally:
        remove(spark, path)


def buckets(df: DataFrame, name: str, path: str, *cols: str, grouped: bool = False) -> DataFrame:
    """df as a table of that place, and of that name while it is written, in as many buckets of cols as there are shuffle partitions, sorted by them; grouped: it comes from an aggregation by cols."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _tidy(spark):
        (df if grouped else df.repartition(n, *cols)).write.option("path", path).option("compression", "zstd").bucketBy(n, *cols).sortBy(*cols).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry: files stay, and what was read knows them and their buckets
    return table


#: Off while rows in buckets of one column meet what agrees in it and in others: no shuffle of them then.
LIMITS = ("spark.sql.requireAllClusterKeysForCoPartition",)


@contextmanager
def met_in_buckets(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    try:
        for k in LIMITS:
            spark.conf.set(k, "false")
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Hadoop's file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
