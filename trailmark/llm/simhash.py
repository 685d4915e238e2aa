"""SimHash near-dedup with bit-sliced comparison.

Fingerprints that can link share a block key. Within a block the fingerprints stand as bit planes:
plane j holds bit j of 64 fingerprints in each machine word. One query is compared with all of a
block at once: each plane is inverted where the query's bit is set, and the differing bits are
counted by carry-save adders into bit-sliced counters, which stick once they pass the radius; a
block is abandoned as soon as every counter has.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.components import components
from trailmark.llm.runtime import cut, pieces, split
from trailmark.llm.textops import ONES, U, Words, mix, runs


# ---------------------------------------------------------------- bit-sliced distances


class Planes:
    """Bit planes of n fingerprints of some 64-bit lanes: planes[j] has bit j of each, 64 to a word."""

    def __init__(self, prints: np.ndarray):
        prints = np.ascontiguousarray(prints.reshape(len(prints), -1), dtype="<u8")
        self.n, self.bits = len(prints), 64 * prints.shape[1]
        bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
        padded = np.zeros((-(-self.n // 64) * 64, self.bits), np.uint8)
        padded[: self.n] = bits
        self.planes = np.ascontiguousarray(np.packbits(np.ascontiguousarray(padded.T), axis=1, bitorder="little")).view("<u8")
        self.query = bits.astype(bool)
        self.real = np.packbits(np.arange(len(padded)) < self.n, bitorder="little").view("<u8")

    def within(self, query: np.ndarray, radius: int, since: int = 0) -> np.ndarray:
        """Which fingerprints, from the word that holds `since` on, differ from the query's bits in at most radius places."""
        lo = since // 64
        planes, far = self.planes[:, lo:], ~self.real[lo:]
        slices = [np.zeros(planes.shape[1], U) for _ in range(int(radius).bit_length())]
        flip = np.where(query, ONES, U(0))
        for j in range(0, self.bits, 3):
            # A carry-save adder takes three planes at once: their sum's two bits.
            x = planes[j] ^ flip[j]
            y = planes[j + 1] ^ flip[j + 1] if j + 1 < self.bits else np.zeros_like(x)
            z = planes[j + 2] ^ flip[j + 2] if j + 2 < self.bits else np.zeros_like(x)
            half = x ^ y
            one, two = half ^ z, (x & y) | (half & z)
            for add, level in ((one, 0), (two, 1)):
                for i in range(level, len(slices)):
                    carry = slices[i] & add
                    slices[i] ^= add
                    add = carry
                far = far | add
            if j % 12 == 9 or j + 3 >= self.bits:
                over, equal = np.zeros_like(far), ~far
                for i in reversed(range(len(slices))):
                    if radius >> i & 1:
                        equal &= slices[i]
                    else:
                        over |= equal & slices[i]
                        equal &= ~slices[i]
                far |= over
                if (far == ONES).all():
                    return np.zeros(0, np.int64)
        found = np.flatnonzero(np.unpackbits((~far).view(np.uint8), bitorder="little")) + 64 * lo
        return found[found >= since]


def forest(prints: np.ndarray, radius: int, agrees=None, groups: list | None = None, instead=None) -> list[tuple[int, int]]:
    """A spanning forest of the links within one block, as pairs of positions; agrees(i, j) may refuse a link.

    Positions of one group (of groups, a label each) count as linked already. instead(i) may give the later positions to be asked
    about in place of those within the radius, or None.
    """
    planes = Planes(prints)
    root = list(range(len(prints)))
    if groups is not None:
        first: dict = {}
        root = [first.setdefault(g, i) for i, g in enumerate(groups)]

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in range(len(prints) - 1):
        later = instead(i) if instead else None
        for j in planes.within(planes.query[i], radius, i + 1).tolist() if later is None else later:
            a, b = top(i), top(j)
            if a != b and (agrees is None or agrees(i, j)):
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


# ---------------------------------------------------------------- fingerprints


def _majority(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run of values (bounds first), the bits that are set in over half; an empty run: 0."""
    out = np.zeros(len(first) - 1, U)
    for lo in range(0, len(first) - 1, 256):
        own = first[lo : lo + 257]
        full = np.flatnonzero(np.diff(own))
        if len(full):
            bits = np.unpackbits(values[own[0] : own[-1]].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts = np.add.reduceat(bits, (own[:-1] - own[0])[full], axis=0, dtype=np.int32)
            over = 2 * counts > np.diff(own)[full, None]
            out[lo + full] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def exact_prints(col: pa.Array, shingle: int) -> np.ndarray:
    """SimHash of each text over XXH64 (seed 42) of its space-joined word shingles, repeats included."""
    w = Words(col, lower=True)
    text, starts, ends = w.joined()
    k = np.minimum(shingle, w.counts)
    per = np.where(w.counts > 0, w.counts - k + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(per)])
    at = np.repeat(w.first[:-1] - bounds[:-1], per) + np.arange(bounds[-1])
    last = at + np.repeat(k, per) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[a:b], 42) for a, b in zip(starts[at].tolist(), ends[last].tolist())), U, len(at))
    return _majority(h, bounds)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """docs with a long column of SimHash fingerprints (its 64 bits).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a text of fewer words than
    a shingle is one shingle; no words or null: 0. A column called name is replaced.
    """
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text):
            p = exact_prints(b.column(b.schema.get_field_index(text)), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


# ---------------------------------------------------------------- links of fingerprints


#: A block of more fingerprints than this is keyed again by a finer key.
HOT = 4096


def _band_keys(blocks: int, free: int, col: str, bits: int = 64, low: int = 0) -> Column:
    """An array of (band, key): the bits of all but `free` of the blocks of a fingerprint's bits from low on."""
    size = bits // blocks
    out = []
    for band, kept in enumerate(combinations(range(blocks), blocks - free)):
        mask = sum(((1 << size) - 1) << (low + size * i) for i in kept)
        mask -= (mask >> 63) << 64
        out.append(F.struct(F.lit(band).alias("band"), F.col(col).bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*out)


def _block_edges(members: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Spanning edges (a, b) of the links within each block; members: keys, rep, print, sorted by keys in each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(keys) + 2)], 1))
            t = np.concatenate(held)
            k = t[:, : len(keys)]
            bounds = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]).any(1)]))
            yield from found(t[: bounds[-1]], bounds)
            held = [t[bounds[-1] :]]
        if held:
            t = np.concatenate(held)
            yield from found(t, np.array([0, len(t)]))

    def found(t: np.ndarray, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if hi - lo > 1:
                rep = t[lo:hi, -2]
                for i, j in forest(t[lo:hi, -1].view(U), radius):
                    a.append(rep[i])
                    b.append(rep[j])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = members.select(*[F.col(k).cast("long").alias(k) for k in keys], "rep", "print")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "print").mapInArrow(run, "a long, b long")


def link(prints: DataFrame, radius: int = 2, hot: int = HOT) -> DataFrame:
    """(print long, rep long, distinct prints) -> (rep, root): components of prints that differ in at most radius (0 to 2) bits.

    Two prints within 2 bits agree in 2 of 4 blocks of 16 bits, so all six pairs of blocks serve as
    keys of 32 bits. The prints of a key that holds more than `hot` of them are keyed again by
    2 of the 4 bytes left, with the same argument; as prints are distinct, no key of 48 bits holds more
    than 65,536 prints, whatever the input, and one task compares them in bounded memory.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the block keys are complete up to radius 2")
    keyed = prints.select("print", "rep", F.explode(_band_keys(4, 2, "print")).alias("k")).select("print", "rep", "k.band", "k.key")
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = cut(keyed.join(sizes, ["band", "key"]).select("band", "key", "rep", "print", "size"))
    edges = _block_edges(members.where(F.col("size") <= hot), ["band", "key"], radius)
    if not members.where(F.col("size") > hot).isEmpty():
        left = [i for i in combinations(range(4), 2)]  # the blocks that band number i keeps
        finer = []
        for band, kept in enumerate(left):
            free = [8 * j for i in range(4) if i not in kept for j in (2 * i, 2 * i + 1)]
            for sub, pair in enumerate(combinations(free, 2)):
                mask = sum(255 << s for s in pair)
                mask -= (mask >> 63) << 64
                finer.append(F.when(F.col("band") == band, F.struct(F.lit(sub).alias("sub"), F.col("print").bitwiseAND(F.lit(mask)).alias("fine"))))
        again = members.where(F.col("size") > hot).select("band", "key", "rep", "print", F.explode(F.array_compact(F.array(*finer))).alias("f")).select("band", "key", "f.sub", "f.fine", "rep", "print")
        edges = edges.union(_block_edges(again, ["band", "key", "sub", "fine"], radius))
    return components(edges).select(F.col("node").alias("rep"), "root")


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 lowercase hex digits), component_id.

    component_id is the smallest doc_id that a chain of fingerprints within radius reaches. Rows of a
    null text have fingerprint 0 and link like others; rows of a null doc_id get the component of their
    fingerprint, null if no row with an id is in it. Repeated rows come out repeated; empty in, empty out.
    """
    marks = cut(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle, "text", "print").select("doc_id", "print"))
    known = marks.groupBy("print").agg(F.min("doc_id").alias("rep"))
    roots = link(known.where("rep is not null"), radius)
    classes = known.join(roots, "rep", "left").select("print", F.coalesce("root", "rep").alias("component_id"))
    return marks.join(classes, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


# ---------------------------------------------------------------- near copies by similarity


#: Share of the pairs at exactly the similarity that the block keys bring together, at least.
RECALL = 0.999
#: Sets of fewer shingles are compared whole, without their SimHash, whose bits say little then.
FEW = 64


def block_keys(similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """(keys, minima a key) that bring a pair of this similarity together with probability `recall` or more: as many minima as go with a dozen keys, one at least."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity is over 0, and 1 at most")
    out = (1, 1)
    for rows in range(1, 9):
        p = similarity**rows
        keys = 1 if p == 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if rows == 1 or keys <= 12:
            out = (keys, rows)
    return out


def safe_radius(similarity: float, bits: int = 128) -> int:
    """Differing bits of which pairs of this similarity stay six deviations clear.

    The cosine of two sets of Jaccard similarity s is 2s / (1 + s) at least, and a bit differs with probability arccos / pi.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return min(bits, math.ceil(bits * p + 6 * math.sqrt(bits * p * (1 - p))))


def shingle_sets(col: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one after another, and their bounds."""
    w = Words(col, lower=True)
    h = w.hashes()
    k = np.minimum(shingle, w.counts)
    every = runs(h, shingle)
    whole = np.flatnonzero(w.whole(shingle))
    doc, val = w.doc[whole], every[whole]
    for i in np.flatnonzero((w.counts > 0) & (w.counts < shingle)):  # a short text is one shingle
        own = Words(col.slice(int(i), 1), lower=True)
        doc = np.append(doc, i)
        val = np.append(val, runs(own.hashes(), int(k[i])))
    order = np.lexsort((val, doc))
    doc, val = doc[order], val[order]
    fresh = np.ones(len(val), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (val[1:] != val[:-1])
    doc, val = doc[fresh], val[fresh]
    return val, np.searchsorted(doc, np.arange(len(w.bounds)))


def _minima(val: np.ndarray, bounds: np.ndarray, keys: int, rows: int) -> np.ndarray:
    """Block keys of each set: hashes of `rows` minima under permutations of their own."""
    out = np.zeros((len(bounds) - 1, keys), U)
    mult = mix(np.arange(1, keys * rows + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
    for k in range(keys):
        for m in mult[k * rows : (k + 1) * rows]:
            p = val * m
            p ^= p >> U(32)
            out[:, k] = mix(out[:, k] * U(31) + np.minimum.reduceat(p, bounds[:-1]))
    return out


def _sets_of(docs: DataFrame, shingle: int, n_keys: int, rows: int) -> DataFrame:
    """docs (row_id, text) -> row_id, digest (of the set; null for none), keys array<long>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            val, bounds = shingle_sets(b.column(1), shingle)
            full = np.flatnonzero(np.diff(bounds))
            if not len(full):
                continue
            tight = np.append(bounds[:-1][full], bounds[-1])
            digest = np.add.reduceat(mix(val ^ U(0x51)), tight[:-1]) ^ mix(np.diff(tight).astype(U))
            second = np.add.reduceat(mix(val + U(0x2545F4914F6CDD1D)), tight[:-1])
            keys = _minima(val, tight, n_keys, rows).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(full)), pa.array(digest.view(np.int64)), pa.array(second.view(np.int64)), pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), n_keys).cast(pa.list_(pa.int64()))],
                names=["row_id", "d1", "d2", "keys"],
            )

    return docs.mapInArrow(run, "row_id long, d1 long, d2 long, keys array<long>")


def _wide(sets: list[np.ndarray]) -> np.ndarray:
    """128-bit SimHash of each set."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    val = np.concatenate(sets)
    return np.stack([_majority(mix(val ^ U(lane)), first) for lane in (0x1B873593, 0xE6546B64)], 1)


def _cell_edges(cells: DataFrame, base: DataFrame, shingle: int, similarity: float, radius: int) -> DataFrame:
    """cells (row_id, group_id, band, key, cell): spanning edges (a, b) of the links within each cell, checked on the whole sets of base's texts.

    Rows of a cell with one group_id count as linked already.
    """
    wanted = cut(cells.groupBy("row_id", "group_id").agg(F.collect_list(F.struct("band", "key", "cell")).alias("at")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            val, bounds = shingle_sets(b.column(3), shingle)
            own = pa.array([val[lo:hi].astype("<u8").tobytes() for lo, hi in zip(bounds[:-1], bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], own], names=["row_id", "group_id", "at", "set"])

    shown = wanted.join(split(base, "row_id", wanted, "row_id")[0], "row_id").select("row_id", "group_id", "at", "text")
    held = shown.mapInArrow(sets, "row_id long, group_id long, at array<struct<band:int,key:long,cell:long>>, set binary")
    keys = ["band", "key", "cell"]
    rows = held.select("row_id", "group_id", "set", F.explode("at").alias("k")).select("k.band", "k.key", "k.cell", "row_id", "group_id", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, groups, sets = None, [], [], []
        for b in batches:
            for band, key, cell, row_id, group, own in zip(*(c.to_pylist() for c in b.columns)):
                if (band, key, cell) != now:
                    yield from found(ids, groups, sets)
                    now, ids, groups, sets = (band, key, cell), [], [], []
                ids.append(row_id)
                groups.append(group)
                sets.append(np.frombuffer(own, "<u8"))
        yield from found(ids, groups, sets)

    def found(ids: list, groups: list, sets: list) -> Iterator[pa.RecordBatch]:
        if len(set(groups)) < 2:
            return
        # By size, so that what a small set may link to comes next to it.
        order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
        ids, groups, sets = ([x[i] for i in order] for x in (ids, groups, sets))
        sizes = [len(x) for x in sets]

        def agrees(i: int, j: int) -> bool:
            a, b = sizes[i], sizes[j]
            if a < similarity * b:
                return False
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            return both >= similarity * (a + b - both)

        def small(i: int) -> range | None:
            return range(i + 1, bisect_right(sizes, sizes[i] / similarity + 1e-6)) if sizes[i] < FEW else None

        e = forest(_wide(sets), radius, agrees, groups, small)
        if e:
            yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i, _ in e], pa.int64()), pa.array([ids[j] for _, j in e], pa.int64())], names=["a", "b"])

    return rows.repartition(*keys).sortWithinPartitions(*keys, "row_id").mapInArrow(run, "a long, b long")


#: A block of more members is dealt into tiles of about so many, and each tile first meets so many leaders.
TILE, LEADERS = 500, 8


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, recall: float = RECALL, tile: int = TILE, leaders: int = LEADERS) -> DataFrame:
    """(doc_id, component_id) of the documents that have a near copy: one row per id, component_id the smallest id reachable.

    Two texts link if the sets of their word shingles (A-Z lower-cased) have Jaccard similarity
    `similarity` or more. Texts of equal sets are one class and its smallest id stands for them.
    Representatives that share a block key (hashes of some minima; as many keys as bring a pair of just that similarity together
    with probability `recall`, and more similar ones with a greater) are compared bit-sliced as 128-bit SimHashes, and what lies
    within six deviations of what such pairs differ by is checked on the whole sets, unless already linked; sets of under FEW shingles
    are checked at once. A block of over `tile`
    representatives is dealt into tiles by hash. Each tile first meets the block's leaders; the members that are then
    one component needn't meet each other again, and only the others, in tiles too, meet everyone. No pair
    that could tie two components is left out, and a large group of copies costs what its members do, not their pairs.
    Texts without words, nulls and rows without id have no copies. An id that repeats has the links of all its texts.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("row_id"), F.col(text).alias("text")).where("row_id is not null and text is not null")
    radius = safe_radius(similarity)
    sets = cut(_sets_of(base, shingle, *block_keys(similarity, recall)))
    # One class per equal sets. Cut, so that joins with it have plain exchanges on both sides, which can be split where a class is large.
    classes = cut(sets.groupBy("d1", "d2").agg(F.min("row_id").alias("rep"), F.count("*").alias("n")))
    same = sets.join(classes.where("n > 1"), ["d1", "d2"]).select(F.col("row_id").alias("a"), F.col("rep").alias("b"))
    reps = sets.join(classes, ["d1", "d2"]).where("row_id = rep").select("row_id", "keys")
    keyed = reps.select("row_id", F.posexplode("keys").alias("band", "key"))
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    met = cut(keyed.join(sizes, ["band", "key"]))
    block, cells = ["band", "key"], ["row_id", "group_id", "band", "key", "cell"]
    small = met.where(F.col("size") <= tile).select("row_id", F.col("row_id").alias("group_id"), *block, F.lit(0).cast("long").alias("cell"))
    hot = met.where(F.col("size") > tile)
    if hot.isEmpty():
        return _named(components(_cell_edges(small, base, shingle, similarity, radius).union(same)))
    # Tile t of a hot block meets the leaders in cell t.
    dealt = F.xxhash64("row_id")
    tiles = F.ceil(F.col("size") / F.lit(tile)).cast("long")
    firsts = hot.groupBy(*block, "size", F.pmod(dealt, F.lit(leaders)).alias("nth")).agg(F.min("row_id").alias("row_id"))
    stars = hot.select("row_id", *block, F.pmod(dealt, tiles).alias("cell")).union(firsts.select("row_id", *block, F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)).alias("cell"))).distinct()
    edges = cut(_cell_edges(small.union(stars.select("row_id", F.col("row_id").alias("group_id"), *block, "cell")), base, shingle, similarity, radius).union(same))
    # The members outside the block's largest component meet all of it, and each other: cell (i, j) has tile i of them and tile j of all.
    roots = components(edges).select(F.col("node").alias("row_id"), F.col("root").alias("group_id")).distinct()
    known = cut(hot.join(roots, "row_id", "left").select("row_id", F.coalesce("group_id", "row_id").alias("group_id"), *block, "size"))
    most = known.groupBy(*block, "group_id").agg(F.count("*").alias("n")).groupBy(*block).agg(F.max_by("group_id", F.struct("n", "group_id")).alias("main"), (F.sum("n") - F.max("n")).alias("others"))
    most = cut(most.where("others > 0"))
    rest = known.join(most, block)
    many = F.ceil(F.col("others") / F.lit(tile)).cast("long")
    j, i = F.pmod(dealt, tiles), F.pmod(dealt, many)
    as_all = rest.select(*[F.col(c) for c in cells[:-1]], F.explode(F.transform(F.sequence(F.lit(0).cast("long"), many - 1), lambda x: x * tiles + j)).alias("cell"))
    as_other = rest.where("group_id <> main").select(*[F.col(c) for c in cells[:-1]], F.explode(F.transform(F.sequence(F.lit(0).cast("long"), tiles - 1), lambda x: i * tiles + x)).alias("cell"))
    again = _cell_edges(as_all.union(as_other).distinct(), base, shingle, similarity, radius)
    return _named(components(edges.union(again)))


def _named(found: DataFrame) -> DataFrame:
    return found.select(F.col("node").alias("doc_id"), F.col("root").alias("component_id"))


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs without near copies of a row with a smaller id: one row of each group stays.

    Rows without id or words stay. Rows that repeat an id stay or go together. Columns stay as they are.
    """
    found = near_copies(docs, doc_id, text, **options).select(F.col("doc_id").alias("__copy"), F.col("component_id").alias("__of"))
    gone = cut(found.where("__copy <> __of").select("__copy"))
    maybe, rest = split(docs, doc_id, gone, "__copy")
    return maybe.join(gone, maybe[doc_id] == gone["__copy"], "left_anti").union(rest)
