"""Token ids in packed binary rows: best-fit-decreasing with a segment tree over capacities.

Each task packs what it reads, so no token is shuffled. A row is one sequence: a row of the id
matrix (capacity ids, little-endian unsigned 16 or 32 bits, padded), the cumulative lengths of its
segments and where positions start again from 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmark.llm.runtime import pieces
from trailmark.llm.tokens import TOKENIZER, VOCABULARY, encode_array

CAPACITY, END, PAD = 2048, 50256, 50256
#: A task packs at most so many tokens at once.
CHUNK = 1 << 22


class CapacityTree:
    """Open bins by free room. A node tells whether any bin below it is open; leaf r is for bins with r free."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, which: int) -> None:
        self.bins[room].append(which)
        i = room + self.leaves
        while i and not self.tree[i]:
            self.tree[i] = 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The open bin with the least room that is size or more, taken out; None if there is none."""
        i = size + self.leaves
        if not self.tree[i]:
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        room = i - self.leaves
        which = self.bins[room].pop()
        if not self.bins[room]:
            self.tree[i] = 0
            i >>= 1
            while i and not (self.tree[2 * i] or self.tree[2 * i + 1]):
                self.tree[i] = 0
                i >>= 1
        return room, which


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of sizes by bin."""
    tree, out = CapacityTree(capacity), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        got = tree.take(sizes[i])
        if got is None:
            got = (capacity, len(out))
            out.append([])
        room, which = got
        out[which].append(i)
        if room > sizes[i]:
            tree.put(room - sizes[i], which)
    return out


SCHEMA = "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, doc_ids array<long>, starts array<long>"


def packed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = END, pad: int = PAD, wide: bool = False, vocabulary: str = VOCABULARY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per sequence: sequence_id, n_tokens, ids, cu_seqlens, resets, doc_ids, starts.

    A document's ids are its text's and the id `end`; longer ones than capacity are cut into pieces
    of capacity and a last shorter one, and nothing is lost. ids holds capacity ids of 2 bytes (4 if wide), `pad`
    after the first n_tokens; an id that doesn't fit is an error. cu_seqlens begins with 0 and ends with n_tokens; resets are the offsets at which
    positions return to 0 (the pieces' first ids); doc_ids and starts tell each piece's document and
    how many of its ids came before. Null text: empty (one id). Null ids stay null; repeated rows are
    packed each. No documents: no rows.
    """
    kind = "<u4" if wide else "<u2"
    if not 0 <= max(end, pad) <= (0xFFFFFFFF if wide else 0xFFFF):
        raise ValueError("end and pad must fit into the rows' ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 33
        held: list[tuple[int | None, int, np.ndarray]] = []
        total = 0
        for b in pieces(batches, "text", 1 << 20):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode_array(t or "", vocabulary, tokenizer), np.uint32(end))
                if not wide and ids.max() > 0xFFFF:
                    raise ValueError(f"id {ids.max()} doesn't fit into 16 bits; ask for wide rows")
                ids = ids.astype(kind)
                held += [(i, lo, ids[lo : lo + capacity]) for lo in range(0, len(ids), capacity)]
                total += len(ids)
            if total >= CHUNK:
                yield flush(held, number)
                number, held, total = number + len(held), [], 0
        if held:
            yield flush(held, number)

    def flush(held: list, number: int) -> pa.RecordBatch:
        bins = best_fit_decreasing([len(x[2]) for x in held], capacity)
        cols: list[list] = [[] for _ in range(7)]
        for k, own in enumerate(bins):
            row, at, ends = np.full(capacity, pad, kind), 0, [0]
            for i in own:
                ids = held[i][2]
                row[at : at + len(ids)] = ids
                at += len(ids)
                ends.append(at)
            for c, v in zip(cols, (number + k, at, row.tobytes(), ends, ends[:-1], [held[i][0] for i in own], [held[i][1] for i in own])):
                c.append(v)
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["sequence_id", "n_tokens", "ids", "cu_seqlens", "resets", "doc_ids", "starts"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Packed rows as Parquet under path."""
    packed_rows(docs, **options).write.option("compression", "zstd").parquet(path)


def positions(n_tokens: int, resets: list[int]) -> np.ndarray:
    """Position ids of a row's n_tokens ids, which return to 0 at each reset."""
    at = np.arange(n_tokens)
    begin = np.zeros(n_tokens, np.int64)
    begin[list(resets)] = list(resets)
    return at - np.maximum.accumulate(begin)
