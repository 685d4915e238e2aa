"""What the operators share at run time: cutting lineage, batches and tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from trailmark.operators.lineage import checkpointed as cut
from trailmark.operators.lineage import scratch
from trailmark.operators.membership import split

__all__ = ["cut", "kept", "listed", "pieces", "read_text", "remove", "scratch", "split", "write_text"]


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Hadoop's file system."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all."""
    p, fs = _file_system(spark, path)
    draft, _ = _file_system(spark, f"{path}.part")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, p)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _file_system(spark, path)
    file = fs.open(p)
    try:
        return bytes(file.readAllBytes()).decode()
    finally:
        file.close()


def kept(df: DataFrame, path: str) -> DataFrame:
    """df as a table under path, read back: half a checkpoint's size or less, and gone as soon as it is removed. Not compressed, being hashes mostly."""
    schema = df.schema
    df.write.option("compression", "uncompressed").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most so many bytes of a string column, or one row."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        if not len(col):
            continue
        sizes = pc.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False)
        at, total = 0, 0
        for i, n in enumerate(sizes):
            if i > at and total + n > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += int(n)
        yield batch.slice(at)
