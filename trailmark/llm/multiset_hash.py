"""Homomorphic multiset hash of a document's paragraphs, in DataFrame functions only.

A paragraph is what stands between line feeds. It is hashed into a wide vector: 16 lanes that tell
paragraphs apart (eight XXH64 hashes of the paragraph, in halves), one lane that counts its words, and
64 lanes that add +1 or -1 for each of its word pairs, as the pair's hash has the lane's bit set or not
(the last word pairs with nothing). A document's fingerprint is the sum of its paragraphs' vectors
modulo 2**32, so it doesn't depend on their order, and paragraphs can be added and taken out
without the rest of the document. Equal multisets of paragraphs have equal fingerprints.

The likeness of two fingerprints is the cosine of their 64 signed lanes, which estimates the cosine of
the counts of word pairs, and is never below 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmark.llm.runtime import cut

M32 = (1 << 32) - 1
PAIRED = 1 << 32 | 1
SPACES = r"[\x20\x09\x0B-\x0D]+"
IDENTITY, SIGNED = 16, 64
LANES = IDENTITY + 1 + SIGNED


def _vectors(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, text (not null) -> keys, v array<int>: LANES sums modulo 2**32, from -2**31 on."""
    paragraphs = texts.select(*keys, F.explode(F.split("text", "\n")).alias("p"))
    words = paragraphs.select(*keys, "p", F.filter(F.split("p", SPACES), lambda x: x != "").alias("w"))
    none = F.array().cast("array<string>")
    following = F.concat(F.expr("slice(w, 2, greatest(size(w) - 1, 0))"), F.when(F.size("w") > 0, F.array(F.lit(""))).otherwise(none))
    pair = F.arrays_zip(F.col("w").alias("a"), following.alias("b"))
    marked = F.array(F.struct(F.col("p").alias("a"), F.lit(None).cast("string").alias("b")))
    items = words.select(*keys, F.explode(F.concat(marked, pair)).alias("s")).select(*keys, F.col("s.a").alias("a"), F.col("s.b").alias("b"))
    items = items.select(*keys, F.col("b").isNull().alias("whole"), "a", F.when(F.col("b").isNotNull(), F.xxhash64("a", "b")).alias("h"))
    sums = [F.sum(F.when(~F.col("whole"), F.lit(1).cast("long"))).alias("n")]
    for k in range(IDENTITY // 2):
        whole = F.when(F.col("whole"), F.xxhash64("a", F.lit(k)))
        sums += [F.sum(whole.bitwiseAND(F.lit(M32))).alias(f"i{k}"), F.sum(F.shiftrightunsigned(whole, 32)).alias(f"j{k}")]
    # Bits k and k + 32 of a hash are counted in the halves of one sum: counts stay below 2**31.
    sums += [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(PAIRED))).alias(f"c{k}") for k in range(32)]
    out = items.groupBy(*keys).agg(*sums)
    # Lanes are made by lambdas: spelt out one by one they are code whose compilation takes an executor's memory.
    n = F.coalesce("n", F.lit(0))
    identity = F.array(*[c for k in range(IDENTITY // 2) for c in (F.col(f"i{k}"), F.col(f"j{k}"))])
    counts = F.array(*[F.coalesce(F.col(f"c{k}"), F.lit(0)) for k in range(32)])
    out = out.select(*keys, n.alias("n"), identity.alias("i"), counts.alias("c"))
    low = F.transform("c", lambda c: F.lit(2) * c.bitwiseAND(F.lit(M32)) - F.col("n"))
    high = F.transform("c", lambda c: F.lit(2) * F.shiftrightunsigned(c, 32) - F.col("n"))
    return out.select(*keys, F.transform(F.concat("i", F.array("n"), low, high), lambda x: _wrap(x).cast("int")).alias("v"))


def to_hex(v: Column | str) -> Column:
    """A vector as 8 lowercase hex digits a lane."""
    v = F.col(v) if isinstance(v, str) else v
    return F.lower(F.array_join(F.transform(v, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(M32))), 8, "0")), ""))


def _wrap(x: Column) -> Column:
    """Modulo 2**32, from -2**31 on."""
    y = x.bitwiseAND(F.lit(M32))
    return F.when(y >= (1 << 31), y - (1 << 32)).otherwise(y)


def add(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector of two multisets together, or (sign -1) of a without b."""
    return F.zip_with(a, b, lambda x, y: _wrap(x.cast("long") + sign * y.cast("long")).cast("int"))


def same(a: Column, b: Column) -> Column:
    """Whether two vectors are equal modulo 2**32."""
    return a == b


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the cosine of the signed lanes, 0 at least."""

    def dot(x: Column, y: Column) -> Column:
        first = IDENTITY + 2
        products = F.zip_with(F.slice(x, first, SIGNED), F.slice(y, first, SIGNED), lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, t: s + t)

    both = F.named_struct(F.lit("norms"), F.sqrt(dot(a, a) * dot(b, b)), F.lit("dot"), dot(a, b))
    cosine = F.get(F.transform(F.array(both), lambda s: F.when(s["norms"] > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), s["dot"] / s["norms"]))).otherwise(F.lit(0.0))), F.lit(0))
    return F.when(same(a, b), F.lit(1.0)).otherwise(cosine)


def paragraph_vectors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, v): the sum over all rows of an id, of whole documents or of parts of one in any order; null text: empty."""
    return _vectors(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), ["doc_id"])


KEY = ["d1", "d2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with a 128-bit key of both."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("d1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("d2"), "text")


def followers(keyed: DataFrame) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, d1, d2, n_chars, copies, next_d1, next_d2.

    The order is by doc_id (null first), then by key; after the last comes the first. Only narrow rows
    are sorted, by ranges; each range's first row is handed to the range before.
    """
    narrow = keyed.groupBy("doc_id", *KEY, F.char_length("text").cast("long").alias("n_chars")).agg(F.count("*").alias("copies"))
    order = ["doc_id", *KEY]
    ranges = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = cut(narrow.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()))
    row = F.struct(*order)
    firsts = narrow.groupBy("range").agg(F.min(row).alias("first"))
    # As many rows as ranges, never as documents.
    over = Window.orderBy("range")
    firsts = firsts.select("range", F.coalesce(F.lead("first").over(over), F.min("first").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = narrow.withColumn("in_range", F.lead(row).over(Window.partitionBy("range").orderBy(*order)))
    joined = inside.join(F.broadcast(firsts), "range").withColumn("next", F.coalesce("in_range", "after"))
    return joined.select(*order, "n_chars", "copies", *[F.col(f"next.{k}").alias(f"next_{k}") for k in KEY])


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of documents and of their edited texts.

    A text's last floor(n_chars / 4) code points are replaced by the first as many (or all) of the next
    document's. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. Null text: empty. A null doc_id sorts first. Rows that repeat an id and text come out
    repeated and have one follower; of several texts of an id each follows the other. A lone document
    follows itself; no documents: no rows.
    """
    texts = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    links = cut(followers(texts))
    texts = texts.select(*KEY, "text")
    if not links.where("copies > 1").isEmpty():
        texts = texts.dropDuplicates(KEY)
    # The beginning of each document goes to the one before it.
    back = [F.col("next_d1").alias("d1"), F.col("next_d2").alias("d2"), F.col("d1").alias("to1"), F.col("d2").alias("to2")]
    wanted = links.select(*back, F.expr("cast(floor(n_chars / 4) as int)").alias("cut"))
    heads = texts.join(wanted, KEY).select(F.col("to1").alias("d1"), F.col("to2").alias("d2"), "cut", F.expr("substring(text, 1, cut)").alias("head"))
    both = texts.join(heads, KEY).select(*KEY, "text", F.expr("concat(substring(text, 1, char_length(text) - cut), head)").alias("edited"))
    digests = both.select(*KEY, F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    two = [F.struct(F.lit(e).alias("e"), F.col(c).alias("text")) for e, c in ((False, "text"), (True, "edited"))]
    sides = both.select(*KEY, F.explode(F.array(*two)).alias("s"))
    vectors = _vectors(sides.select(*KEY, "s.e", "s.text"), [*KEY, "e"])
    sides = vectors.groupBy(*KEY).agg(F.max(F.when(~F.col("e"), F.col("v"))).alias("v"), F.max(F.when(F.col("e"), F.col("v"))).alias("ev"))
    sides = cut(sides.join(digests, KEY))
    # So does its vector.
    after = sides.select(*KEY, F.col("v").alias("next_v")).join(links.select(*back), KEY).select(F.col("to1").alias("d1"), F.col("to2").alias("d2"), "next_v")
    rows = sides.join(after, KEY).join(links.select("doc_id", *KEY, "n_chars", "copies"), KEY)
    prints = [to_hex("v").alias("fingerprint"), to_hex("ev").alias("edited_fingerprint")]
    near = [likeness(F.col("v"), F.col(c)).alias(n) for c, n in (("ev", "near_edited"), ("next_v", "near_next"))]
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    rows = rows.select("doc_id", "n_chars", "edited_sha256", *prints, *near, copies)
    return rows.drop("copy")
