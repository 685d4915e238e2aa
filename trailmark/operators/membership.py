"""Ruling rows out before a shuffle by a bitmap of the wanted keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmark.operators.lineage import checkpointed

#: Bits of a membership bitmap: 4 MB, whatever the input. Where it fills up, rows take the shuffle they would take without it.
BITS = 25
#: Bits of a bitmap for keys as many as requests: 16 MB.
WIDE = 27


def _number(c: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(1 << bits)) + 1


def marks_of(members: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """The bitmap of the values of a column, by bucket, in words of 64 bits that a lookup indexes without copying."""
    marks = members.where(F.col(column).isNotNull()).select(_number(F.col(column), bits).alias("n"))
    marks = marks.groupBy(F.bitmap_bucket_number("n").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
    words = F.expr("transform(sequence(0, 511), i -> cast(conv(hex(substring(bits, i * 8 + 1, 8)), 16, -10) as bigint))")
    return checkpointed(marks.select("__bucket", words.alias("__words")).repartition(1))  # 4 MB at most, or 16: one file


def split(df: DataFrame, key: str, members: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """df in two: rows whose key may be among members' values (all that are, and a few more), and rows whose key surely isn't (nulls too).

    The members' hashes are set in a bitmap of fixed size, which is broadcast, so that only the first
    part need be shuffled for an exact join. Both columns have one type.
    """
    return split_by(df, key, marks_of(members, column))


def split_by(df: DataFrame, key: str, marks: DataFrame, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """split() by a bitmap that was made before."""
    at = F.bitmap_bit_position(_number(F.col(key), bits))
    flagged = df.withColumns({"__bucket": F.bitmap_bucket_number(_number(F.col(key), bits)), "__at": at}).join(F.broadcast(marks), "__bucket", "left")
    # Bytes go from a word's high end down, bits of a byte from its low end up.
    bit = F.expr("shiftright(get(__words, cast(shiftright(__at, 6) as int)), cast(56 - (__at & 56) + (__at & 7) as int)) & 1")
    flagged = flagged.withColumn("__maybe", F.coalesce((bit == 1) & F.col(key).isNotNull(), F.lit(False)))
    cols = [F.col(f"`{c}`") for c in df.columns]
    return flagged.where("__maybe").select(*cols), flagged.where("not __maybe").select(*cols)
