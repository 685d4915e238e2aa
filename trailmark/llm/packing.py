"""Best-fit packing by linear grouping.

Only how many pieces there are of each length (at most `capacity` numbers) comes to the driver. Large
lengths are split into groups of equal cardinality and rounded up to their group's largest, which leaves
few sizes; configurations of these sizes are chosen one after another, each as full as can be and used as
often as its sizes last. Then the real lengths take the rounded ones' places, and small pieces go
where they fit best. The plan is a list of (lengths of a sequence, how many such sequences); pieces are
then numbered within their length and find their places by that number.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmark.llm.runtime import cut, pieces
from trailmark.llm.tokens import TOKENIZER, VOCABULARY, encode_array

CAPACITY, GROUPS, SMALL, END = 1024, 400, 0.30, 2

Plan = list[tuple[tuple[int, ...], int]]


def _fullest(sizes: list[int], counts: list[int], room: int) -> list[int]:
    """How many of each size (as far as counts go) fill the room best; large sizes first among equals."""
    reach = np.full(room + 1, -1, np.int64)  # the last size that was used to come to this sum
    reach[0] = -2
    used = np.zeros(room + 1, np.int64)
    for k, (size, n) in enumerate(zip(sizes, counts)):
        if size > room or n < 1:
            continue
        used[:] = 0
        for at in range(size, room + 1):
            if reach[at] == -1 and reach[at - size] != -1 and used[at - size] < n:
                reach[at] = k
                used[at] = used[at - size] + 1
    best = int(np.flatnonzero(reach != -1)[-1])
    out = [0] * len(sizes)
    while best:
        out[reach[best]] += 1
        best -= sizes[reach[best]]
    return out


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """Patterns (how many of each size, descending) and how often, until all counts are used."""
    left, out = list(counts), []
    while any(left):
        big = next(i for i, n in enumerate(left) if n)
        left[big] -= 1
        rest = _fullest(sizes, left, capacity - sizes[big])
        left[big] += 1
        rest[big] += 1
        times = min(n // r for n, r in zip(left, rest) if r)
        left = [n - r * times for n, r in zip(left, rest)]
        out.append((rest, times))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: float = SMALL) -> Plan:
    """Sequences for so many pieces of each length (1 to capacity); every piece has a place, none overflows."""
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError("lengths are 1 to capacity")
    large = sorted(((s, n) for s, n in histogram.items() if s > small * capacity and n), reverse=True)
    total = sum(n for _, n in large)
    each = max(1, -(-total // groups))
    # Equal groups by rank; a group's size is its largest. runs[g]: its real lengths, descending.
    runs: list[list[tuple[int, int]]] = []
    room = 0
    for s, n in large:
        while n:
            if not room:
                runs.append([])
                room = each
            take = min(n, room)
            runs[-1].append((s, take))
            n, room = n - take, room - take
    merged: dict[int, list[tuple[int, int]]] = {}
    for r in runs:
        merged.setdefault(r[0][0], []).extend(r)
    sizes = sorted(merged, reverse=True)
    queues = {s: [list(x) for x in merged[s]] for s in sizes}
    bins: Counter = Counter()
    for pattern, times in _configurations(sizes, [sum(n for _, n in merged[s]) for s in sizes], capacity):
        slots = [sizes[k] for k, c in enumerate(pattern) for _ in range(c)]
        while times:
            # Real lengths stand in queues; as long as none of them runs out, all sequences are alike.
            need = Counter(slots)
            step = times
            for s, c in need.items():
                if queues[s][0][1] >= c:
                    step = min(step, queues[s][0][1] // c)
                else:
                    step = 1
            real = []
            for s, c in need.items():
                for _ in range(c):
                    k = step if queues[s][0][1] >= step else 1
                    real.append(queues[s][0][0])
                    queues[s][0][1] -= k
                    if not queues[s][0][1]:
                        queues[s].pop(0)
            bins[tuple(sorted(real, reverse=True))] += step
            times -= step
    # Small pieces, longest first, each into the fullest sequence that holds it; then into new ones.
    free: dict[int, list[list]] = {}
    for b, n in bins.items():
        free.setdefault(capacity - sum(b), []).append([b, n])
    for s in sorted((s for s, n in histogram.items() if s <= small * capacity and n), reverse=True):
        n = histogram[s]
        while n:
            gap = min((g for g, x in free.items() if g >= s and x), default=None)
            if gap is None:
                per = capacity // s
                fresh = n // per
                if fresh:
                    free.setdefault(capacity - s * per, []).append([(s,) * per, fresh])
                    n -= fresh * per
                if n:
                    free.setdefault(capacity - s * n, []).append([(s,) * n, 1])
                    n = 0
                break
            kind = free[gap][-1]
            per = min(gap // s, n)
            times = min(kind[1], n // per)
            kind[1] -= times
            if not kind[1]:
                free[gap].pop()
            free.setdefault(gap - s * per, []).append([kind[0] + (s,) * per, times])
            n -= times * per
    out: Counter = Counter()
    for x in free.values():
        for b, n in x:
            out[b] += n
    return sorted(out.items(), reverse=True)


def tokenize(docs: DataFrame, doc_id: str, text: str, capacity: int, vocabulary: str = VOCABULARY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. Strings of the vocabulary's special tokens become these, as with tokenizers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", 4 << 20):
            cols: list[list] = [[], [], [], [], []]
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode_array(t or "", vocabulary, tokenizer, special=True), np.uint32(END)).astype("<u4")
                first = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
                for k, (lo, hi) in enumerate(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity))):
                    for c, v in zip(cols, (i, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


#: Cells whose counts one task adds up in a row.
BLOCK = 1024


def place(rows: DataFrame, found: Plan, length: str = "length", per_cell: int = 500, block: int = BLOCK) -> DataFrame:
    """rows with sequence_id and offset, by a plan for their lengths.

    Rows are numbered within their length. For that each length's rows are dealt by hash into cells of
    about per_cell, counted (as many counts as cells), and numbered within their cell. The cells' counts are added up in blocks of
    `block` cells, and the blocks' sums then in one task a length: a row for every per_cell * block rows of that length.
    """
    slots: list[tuple[int, int, int, int]] = []  # length, first number, first sequence, offset
    seen: Counter = Counter()
    sequence = 0
    for lengths, times in found:
        at = 0
        for s in lengths:
            slots.append((s, seen[s], sequence, at))
            seen[s] += times
            at += s
        sequence += times
    slots.sort()
    table = np.array(slots, np.int64).reshape(-1, 4)
    cells = F.array(*[F.lit(-(-seen[s] // per_cell) or 1).cast("long") for s in range(max(seen, default=0) + 1)])
    cols = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    rows = rows.select(*cols).withColumn("_cell", F.pmod(F.xxhash64(*[F.col(c) for c in cols if c != length]), F.get(cells, F.col(length).cast("int"))))
    counts = rows.groupBy(F.col(length).alias("_l"), F.col("_cell").alias("_c")).agg(F.count("*").alias("_n")).withColumn("_block", F.expr(f"_c div {block}"))

    def before(*of: str, by: str) -> Column:
        return F.coalesce(F.sum("_n").over(Window.partitionBy(*of).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    blocks = counts.groupBy("_l", "_block").agg(F.sum("_n").alias("_n")).select("_l", "_block", before("_l", by="_block").alias("_earlier"))
    counts = counts.select("_l", "_c", "_block", before("_l", "_block", by="_c").alias("_before")).join(blocks, ["_l", "_block"]).select("_l", "_c", (F.col("_earlier") + F.col("_before")).alias("_before"))
    within = Window.partitionBy(length, "_cell").orderBy(*[F.col(c) for c in cols if c != length])
    numbered = rows.withColumn("_k", F.row_number().over(within))
    numbered = numbered.join(counts, (numbered[length] == counts["_l"]) & (numbered["_cell"] == counts["_c"])).select(*cols, (F.col("_before") + F.col("_k") - 1).alias("_rank"))
    key = table[:, 0] * (1 << 44) + table[:, 1]
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.select(*cols).schema.fields]
    at = cols.index(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, r = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (at, len(cols)))
            i = np.searchsorted(key, s * (1 << 44) + r, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[: len(cols)], pa.array(table[i, 2] + r - table[i, 1]), pa.array(table[i, 3])], names=[*cols, "sequence_id", "offset"])

    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, groups: int = GROUPS, vocabulary: str = VOCABULARY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Pieces of documents and their places in sequences of at most `capacity` tokens.

    A text's ids are those that tokenizers gives (special tokens' strings included) and id 2. Longer ones are cut into pieces of `capacity`, but for the first. Returns
    doc_id, piece, start, length, ids_crc32, sequence_id, offset, a row per piece. Null text: empty (one
    piece, the end id). Null doc_id stays null; rows that repeat an id are packed each, equal rows included.
    No documents: no rows.
    """
    rows = cut(tokenize(docs, doc_id, text, capacity, vocabulary, tokenizer))
    histogram = {int(r["length"]): int(r["n"]) for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    return place(rows, plan(histogram, capacity, groups))
