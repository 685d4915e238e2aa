"""Bounded samples of labelled rows."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.llm.runtime import cut


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of an id as text, modulo folds."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(folds))


def training_ids(labels: DataFrame, label: str, folds: int, held_out: int, bound: int, doc_id: str = "doc_id") -> DataFrame:
    """(_id, label int) of about `bound` labelled ids at most, the same ones each time, none of fold held_out.

    Which ids are taken depends on a hash of the id alone. An id's label is 1 if at least half of its
    labels are; null ids and labels don't count.
    """
    rows = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).where(fold(doc_id, folds) != held_out)
    rows = rows.groupBy(F.col(doc_id).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    share = min(1.0, bound / max(1, rows.count()))
    return rows.where(F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1 << 20)) < F.lit(round(share * (1 << 20))))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, bound: int, doc_id: str, text: str) -> DataFrame:
    """(_id, label, text) of the sample. The ids are broadcast, being bounded; the texts aren't shuffled."""
    ids = training_ids(labels, label, folds, held_out, bound)
    return docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(ids), "_id").select("_id", "label", "text")


def within(rows: DataFrame, size: Column, most: int) -> DataFrame:
    """rows (_id, ...) written once, or a share of them by a hash of the id alone, so that their sizes add up to about `most` at most."""
    rows = cut(rows)
    total = rows.agg(F.sum(size)).first()[0] or 0
    if total <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("_id", F.lit(18)), F.lit(1 << 20)) < F.lit(round(most / total * (1 << 20))))


def give_back() -> None:
    """Return what training took to the system, so that a small driver has it for what follows."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass
