"""Requests that arrive as a stream, resolved batch by batch.

Groups of requests don't depend on each other but for the choice between full and short commit ids,
which each batch makes for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trailmark.operators.lineage import scope
from trailmark.plans.resolve import resolve
from trailmark.sources.archive import OUTPUT, Archive


def resolve_stream(spark: SparkSession, path: str, archive: Archive, out_dir: str, checkpoint: str, prefix_nibbles: int = 7) -> StreamingQuery:
    """Resolve request files that land in path; each batch has its own folder batch=<n>, written anew if it is run again."""
    schema = "repo string, commit_id string, rel_path string, bin string"

    def each(batch: DataFrame, n: int) -> None:
        with scope():
            rows = resolve(batch, archive, prefix_nibbles).select(*OUTPUT, "bin")
            rows.write.mode("overwrite").partitionBy("bin").option("compression", "zstd").parquet(f"{out_dir}/batch={n}")

    stream = spark.readStream.schema(schema).parquet(path)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
