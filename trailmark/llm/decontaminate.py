"""Benchmark decontamination by spaced seeds.

Tokens are words, A-Z lower-cased, without closing punctuation; of scripts that are written without spaces
each character is a token, and two of them count as one word. A mask takes some of SPAN successive
tokens and ignores the others, so that a substitution at an ignored place changes no hash. Hashes of all masks
at all places of the texts meet those of the benchmark items; at each hit the two token sequences
are compared along the hit's whole diagonal, once, and substitutions are tolerated there. Items of fewer than SPAN tokens
have one seed, all their tokens, and are found where a text holds them token for token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.runtime import cut, pieces, split
from trailmark.llm.textops import CLOSING, U, Words, combine, mix

#: Taken places of each mask among SPAN tokens.
MASKS = ((0, 1, 2, 4, 5, 7, 8, 9), (0, 1, 3, 4, 6, 8, 9), (0, 2, 3, 4, 7, 8, 9))
SPAN = 10
_MULT = mix(np.arange(1, 33, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
#: A text leaks an item if a stretch of one diagonal has so many equal tokens (or SHARE of the item's, if fewer);
#: in the stretch each substitution takes away what two equal tokens add.
MATCHES, SHARE = 13, 0.7
#: Benchmarks of up to so many tokens are broadcast (8 bytes a token and 12 a seed); larger ones are joined.
BROADCAST_TOKENS = 2_000_000
#: Bits of the bitmaps that tell which hashes the benchmark may have, in either case.
BITS, JOINED_BITS = 22, 27


#: Code points of scripts written without spaces, and of punctuation and spaces between them, which are no tokens.
SINGLE = (
    (0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x30FA), (0x30FC, 0x312F), (0x31A0, 0x31BF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)
BETWEEN = (
    (0x3000, 0x3004), (0x3008, 0x3020), (0x302A, 0x3030), (0x30FB, 0x30FB), (0xFE30, 0xFE4F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
)


def among(code: np.ndarray, ranges: tuple) -> np.ndarray:
    lo, hi = np.array(ranges).T
    k = np.searchsorted(lo, code, "right") - 1
    return (k >= 0) & (code <= hi[k])


class Tokens(Words):
    """A batch's words, cut into characters where their script has no spaces; single tells those. A hash's last bit does too."""

    def __init__(self, col: pa.Array):
        super().__init__(col, lower=True)
        self.single = np.zeros(len(self.starts), bool)
        d = self.data
        at = np.flatnonzero(d >= 0xE0)
        if not len(at):
            return
        size = np.where(d[at] >= 0xF0, 4, 3)
        code = np.where(size == 4, d[at] & 0x07, d[at] & 0x0F).astype(np.int64)
        for k in (1, 2, 3):
            code = np.where(k < size, code << 6 | d[np.minimum(at + k, len(d) - 1)] & 0x3F, code)
        one, none = among(code, SINGLE), among(code, BETWEEN)
        cuts = np.unique(np.concatenate([at[one | none], (at + size)[one | none]]))
        k = np.searchsorted(self.starts, cuts, "right") - 1
        cuts = cuts[(k >= 0) & (cuts > self.starts[k]) & (cuts < self.ends[k])] if len(self.starts) else cuts[:0]
        self.starts, self.ends = np.sort(np.concatenate([self.starts, cuts])), np.sort(np.concatenate([self.ends, cuts]))
        mark = np.isin(self.starts, cuts) & (self.bare() - self.starts == 1) & CLOSING[d[self.starts]]
        keep = ~mark & ~np.isin(self.starts, at[none])
        self.starts, self.ends = self.starts[keep], self.ends[keep]
        self.single = np.isin(self.starts, at[one])
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def bare_hashes(self) -> np.ndarray:
        return super().bare_hashes() & ~U(1) | self.single.astype(U)


def seeds(tokens: np.ndarray) -> list[np.ndarray]:
    """For each mask the hash at every place with SPAN tokens from it on."""
    n = len(tokens) - SPAN + 1
    out = []
    for m, mask in enumerate(MASKS):
        h = np.full(max(n, 0), U(m + 1))
        for k in mask if n > 0 else ():
            h += tokens[k : k + n] * _MULT[k]
        out.append(mix(h))
    return out


def entire(tokens: np.ndarray, size: int) -> np.ndarray:
    """The hash of size tokens, fewer than SPAN, at every place with so many from it on."""
    n = max(len(tokens) - size + 1, 0)
    h = np.full(n, U(100 + size))
    for k in range(size if n else 0):
        h += tokens[k : k + n] * _MULT[k]
    return mix(h)


#: Stand for the seed before a text's and an item's first; they never meet.
BEFORE_TEXT, BEFORE_ITEM = U(1), U(2)


def own_seeds(tokens: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """An item's seeds with the seed before each (one place back, by the same mask)."""
    for h in seeds(tokens) if len(tokens) >= SPAN else [entire(tokens, len(tokens))]:
        yield h, np.append(BEFORE_ITEM, h[:-1])


def marked(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit is set that a hash's first bits number, in a bitmap of a power of two of bytes."""
    at = h >> U(64 - (8 * len(bits)).bit_length() + 1)
    return bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8) & np.uint8(1) > 0


def places(w: Tokens, tokens: np.ndarray, sizes: list[int], bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, their hashes, the hashes before) of the texts' seeds with a bit; of the seeds for items of sizes tokens each text's last."""
    whole = np.flatnonzero(w.whole(SPAN))
    for h in seeds(tokens):
        at = whole[marked(bits, h[whole])]
        yield at, h[at], np.where(at > w.first[w.doc[at]], h[at - 1], BEFORE_TEXT)
    for size in sizes:
        h = entire(tokens, size)
        at = np.flatnonzero(w.whole(size))
        at = at[marked(bits, h[at])]
        at = at[np.lexsort((at, h[at], w.doc[at]))]
        last = np.ones(len(at), bool)
        last[:-1] = (h[at[1:]] != h[at[:-1]]) | (w.doc[at[1:]] != w.doc[at[:-1]])
        at = at[last]
        yield at, h[at], np.full(len(at), BEFORE_TEXT)


def needed(item: np.ndarray) -> int:
    """Equal tokens that tell a leak of the item: all of a short one."""
    if len(item) < SPAN:
        return len(item)
    return min(int(np.ceil(MATCHES * (1 + (item & U(1)).mean()))), int(np.ceil(SHARE * len(item))))


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(equal tokens, first, end) of the stretch where equal tokens (1) less substitutions (2) add up to most; of several the first to end, and there the shortest."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
    least = np.minimum.accumulate(total)
    end = int(np.argmax(total - least))
    first = int(np.flatnonzero(total[: end + 1] == least[end])[-1])
    return int(equal[first:end].sum()), first, end


def overlap(text: np.ndarray, item: np.ndarray, ahead: int, need: int) -> tuple[int, int, int] | None:
    """(equal tokens, first token in the text, tokens) where the whole of an item that begins `ahead` tokens after the text does agrees best; None if it is too little."""
    lo, hi = max(ahead, 0), min(len(text), ahead + len(item))
    equal = text[lo:hi] == item[lo - ahead : hi - ahead]
    if equal.sum() < need:
        return None
    n, first, end = best_stretch(equal)
    return (n, lo + first, end - first) if n >= need else None


class Benchmark:
    """Items with their seeds sorted by hash, then by the hash before.

    Where a text's and an item's seeds agree, and those before them too, the diagonal is known already: a repeated
    word, or any copied passage, gives its diagonals once each and not a pair for all its places.
    """

    def __init__(self, ids: list[int], tokens: list[np.ndarray]):
        self.ids, self.tokens = ids, tokens
        self.need = [needed(t) for t in tokens]
        got = [(h, before, np.full(len(h), i), np.arange(len(h))) for i, t in enumerate(tokens) for h, before in own_seeds(t)]
        self.sizes = sorted({len(t) for t in tokens if len(t) < SPAN})
        cat = [np.concatenate([g[k] for g in got]) if got else np.zeros(0, U if k < 2 else np.int64) for k in range(4)]
        order = np.lexsort((cat[1], cat[0]))
        self.hash, before, self.item, self.at = (c[order] for c in cat)
        pair = combine(self.hash, before)
        lo = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])[: len(pair)])
        by = np.argsort(pair[lo], kind="stable")
        self.pair, self.pair_lo, self.pair_hi = pair[lo][by], lo[by], np.append(lo[1:], len(pair))[: len(lo)][by]
        at = np.unique(self.hash >> U(64 - BITS)).astype(np.int64)
        flags = np.zeros(1 << BITS, bool)
        flags[at] = True
        self.bits = np.packbits(flags, bitorder="little")

    def _met(self, h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number in h, number of a seed) of equal hashes but different ones before."""
        lo, hi = np.searchsorted(self.hash, h), np.searchsorted(self.hash, h, "right")
        pair = combine(h, before)
        k = np.minimum(np.searchsorted(self.pair, pair), max(len(self.pair) - 1, 0))
        same = self.pair[k] == pair if len(self.pair) else np.zeros(len(h), bool)
        till = np.where(same, self.pair_lo[k], hi) if len(self.pair) else hi
        since = np.where(same, self.pair_hi[k], hi) if len(self.pair) else hi
        one, two = till - lo, hi - since
        many = one + two
        which = np.repeat(np.arange(len(h)), many)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        return which, np.where(nth < one[which], lo[which] + nth, since[which] + nth - one[which])

    def leaks(self, col: pa.Array) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item id, equal tokens, first token, tokens), once an item, the fullest."""
        w = Tokens(col)
        tokens = w.bare_hashes()
        out: list[dict] = [{} for _ in range(len(col))]
        met = []
        for at, h, before in places(w, tokens, self.sizes, self.bits):
            which, seed = self._met(h, before)
            if len(which):
                doc = w.doc[at[which]]
                met.append(np.unique(np.stack([doc, self.item[seed], at[which] - w.first[doc] - self.at[seed]], 1), axis=0))
        for doc, item, ahead in np.unique(np.concatenate(met), axis=0).tolist() if met else ():
            got = overlap(tokens[w.first[doc] : w.first[doc + 1]], self.tokens[item], ahead, self.need[item])
            if got and got > out[doc].get(item, (0, 0, 0)):
                out[doc][item] = got
        return [[(self.ids[i], *v) for i, v in sorted(x.items())] for x in out]


LEAK = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("n_equal", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("n_tokens", T.IntegerType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("n_equal", pa.int32()), ("start", pa.int32()), ("n_tokens", pa.int32())]))


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, tokens array<long>) of the items with a token or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            w = Tokens(b.column(1))
            flat = pa.array(w.bare_hashes().view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(w.first, pa.int32()), flat)], names=["item_id", "tokens"])

    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id is not null and text is not null")
    return rows.mapInArrow(run, "item_id long, tokens array<long>").where(F.size("tokens") > 0)


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", broadcast_tokens: int = BROADCAST_TOKENS, name: str = "leaks") -> DataFrame:
    """docs with a column of arrays (item_id, n_equal, start, n_tokens): the items each text leaks, once each, by item_id.

    start and n_tokens (words) tell the stretch with most equal words, or the last place of an item of under SPAN words; each
    diagonal that a seed hits is compared over its whole length. Null or empty items and
    items without id are left out, being nothing to find; a null text leaks nothing.
    Repeated rows are judged each; a column called `name` is replaced. An item that stands twice under one
    id counts once. A benchmark beyond broadcast_tokens words is joined by seeds instead of broadcast, with the same
    seeds and comparisons, and so the same result.
    """
    docs = docs.drop(name)
    items = _items(benchmark, item_id, item_text)
    total = items.agg(F.sum(F.size("tokens"))).first()[0] or 0
    if total > broadcast_tokens:
        return _joined(docs, items, text, name)
    rows = items.orderBy("item_id", "tokens").collect()
    shared = docs.sparkSession.sparkContext.broadcast(([r["item_id"] for r in rows], [np.array(r["tokens"], np.int64).view(U) for r in rows]))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, LEAK)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Benchmark(*shared.value)
        for b in pieces(batches, text):
            found = known.leaks(b.column(b.schema.get_field_index(text)))
            rows = [[dict(zip(("item_id", "n_equal", "start", "n_tokens"), x)) for x in _once(own)] for own in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, _ARROW)], names=[*b.schema.names, name])

    return docs.mapInArrow(run, schema)


def _once(own: list[tuple]) -> list[tuple]:
    best: dict[int, tuple] = {}
    for x in own:
        if x[1:] > best.get(x[0], (0,) * 4)[1:]:
            best[x[0]] = x
    return [best[k] for k in sorted(best)]


def _joined(docs: DataFrame, items: DataFrame, text: str, name: str) -> DataFrame:
    """with_leaks for a benchmark of any size: seeds are joined, and then the tokens of both sides along each diagonal that was hit."""

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                tokens = np.asarray(t.values).astype(np.int64).view(U)
                for h, before in own_seeds(tokens):
                    n = len(h)
                    cols = [pa.array(h.view(np.int64)), pa.array(before.view(np.int64)), pa.array([key] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32))]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array([len(tokens)] * n, pa.int32())], names=["h", "own_before", "item", "at", "size"])

    def text_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, sizes = shared.value
        for b in pieces(batches, "text"):
            w = Tokens(b.column(2))
            tokens = w.bare_hashes()
            for at, h, before in places(w, tokens, sizes, bits):
                take = pa.array(w.doc[at])
                cols = [pa.array(h.view(np.int64)), pa.array(before.view(np.int64)), b.column(0).take(take), b.column(1).take(take)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array((at - w.first[w.doc[at]]).astype(np.int32))], names=["h", "before", "t1", "t2", "place"])

    def text_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            w = Tokens(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(w.first, pa.int32()), pa.array(w.bare_hashes().view(np.int64)))], names=["t1", "t2", "words"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t1, t2, item, lo, words, tokens in zip(*(c.to_pylist() for c in b.columns[:4]), b.column(4), b.column(5)):
                # words: the text from its token `lo` on, or from its first, as far as the item goes
                own, known = (np.asarray(x.values).astype(np.int64).view(U) for x in (words, tokens))
                got = overlap(own, known, min(lo, 0), needed(known))
                if got:
                    out.append((t1, t2, item, got[0], max(lo, 0) + got[1], got[2]))
            if out:
                kinds = [pa.int64()] * 3 + [pa.int32()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["t1", "t2", "item", "n_equal", "start", "n_tokens"])

    named = items.select("item_id", F.xxhash64("item_id", "tokens").alias("item"), "tokens").dropDuplicates(["item"])
    named = cut(named)
    known = named.select("item", "tokens").mapInArrow(item_seeds, "h long, own_before long, item long, at int, size int")
    hit = F.shiftrightunsigned("h", 64 - JOINED_BITS) + 1
    marks = known.select(hit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect()  # 2**JOINED_BITS bits at most
    bits = np.zeros(1 << JOINED_BITS - 3, np.uint8)
    for m in marks:
        lo = (m["k"] - 1) << 12  # a bucket holds 32,768 numbers from 1 on
        bits[lo : lo + (1 << 12)] = np.frombuffer(bytes(m["bits"]), np.uint8)
    sizes = sorted(r[0] for r in items.select(F.size("tokens")).where(F.size("tokens") < SPAN).distinct().collect())
    shared = docs.sparkSession.sparkContext.broadcast((bits, sizes))
    keys = docs.withColumns({"__t1": F.xxhash64(text), "__t2": F.xxhash64(F.lit(1), text)})
    texts = keys.select(F.col("__t1").alias("t1"), F.col("__t2").alias("t2"), F.col(text).alias("text")).where("text is not null")
    hits = texts.mapInArrow(text_seeds, "h long, before long, t1 long, t2 long, place int")
    met = hits.join(known, (hits["h"] == known["h"]) & (hits["before"] != known["own_before"]))
    met = cut(met.select("t1", "t2", "item", (F.col("place") - F.col("at")).alias("ahead"), "size").distinct())
    # Of the texts only those that were hit are shuffled, once each; a diagonal takes the words beside the item along.
    wanted = met.select("t1", "t2", F.xxhash64("t1", "t2").alias("t")).distinct()
    some = split(texts.withColumn("t", F.xxhash64("t1", "t2")), "t", wanted, "t")[0].dropDuplicates(["t1", "t2"])
    words = some.select("t1", "t2", "text").mapInArrow(text_tokens, "t1 long, t2 long, words array<long>")
    beside = met.join(words, ["t1", "t2"]).select("t1", "t2", "item", "ahead", F.expr("slice(words, greatest(ahead, 0) + 1, size + least(ahead, 0))").alias("words"))
    beside = beside.join(named.select("item", "tokens"), "item").select("t1", "t2", "item", "ahead", "words", "tokens")
    found = beside.mapInArrow(verify, "t1 long, t2 long, item long, n_equal int, start int, n_tokens int").join(named.select("item", "item_id"), "item")
    best = found.groupBy("t1", "t2", "item_id").agg(F.max(F.struct("n_equal", "start", "n_tokens")).alias("s")).select("t1", "t2", F.struct("item_id", "s.n_equal", "s.start", "s.n_tokens").alias("leak"))
    lists = best.groupBy("t1", "t2").agg(F.array_sort(F.collect_list("leak")).alias(name))
    out = keys.join(lists, (keys["__t1"] == lists["t1"]) & (keys["__t2"] == lists["t2"]), "left")
    return out.select(*[keys[c] for c in docs.columns], F.coalesce(lists[name], F.array().cast(LEAK)).alias(name))


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, n_equal, start, n_tokens): a row per leak."""
    rows = with_leaks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, "text", **options)
    return rows.select("doc_id", F.explode("leaks").alias("l")).select("doc_id", "l.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of docs that leak no item."""
    rows = with_leaks(docs, benchmark, text, name="__leaks", **options)
    return rows.where(F.size("__leaks") == 0).drop("__leaks")
