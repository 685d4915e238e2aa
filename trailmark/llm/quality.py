"""Quality by supervised subword embeddings.

A word (case kept) gives features: itself, its character n-grams of 3 to 5, and its first and last three characters
marked as such; each two words in a row give one more. All are hashed into 2**bits rows. A text is the average of its
features' learned vectors, each as often as it occurs; a softmax on that gives the two labels' probabilities. Vectors
and softmax are trained together by stochastic gradient descent, a text at a time, each number's steps divided by the root of
its squared gradients so far (AdaGrad), so that rare features learn as well as common ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.labelled import fold, give_back, training_rows, within
from trailmark.llm.runtime import pieces
from trailmark.llm.textops import U, Words, combine, hash_ranges

BITS, SIZE, SAMPLE, EPOCHS, RATE = 17, 16, 8_000, 4, 0.5
GRAMS = (3, 4, 5)
#: Distinct features of all texts of the sample, 6 bytes each: the other bound of the sample.
MOST = 10_000_000


def word_features(w: Words, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch: each word's kind, the features of all kinds one after another, the kinds' bounds, and for each word that of it and the next (-1 at a text's end)."""
    shift = U(64 - bits)
    own = hash_ranges(w.data, w.starts, w.ends, 1)
    _, at, kind = np.unique(own, return_index=True, return_inverse=True)
    # Characters of one word of each kind: where they begin, with the word's end after the last.
    s, e = w.starts[at], w.ends[at]
    begins = (w.data & 0xC0) != 0x80
    begins[s] = True
    count = np.concatenate([[0], np.cumsum(begins)])
    many = count[e] - count[s]
    place = np.flatnonzero(begins)
    which, values = [np.arange(len(at))], [own[at]]

    def grams(k: np.ndarray, nth: np.ndarray, n: int, salt: int) -> None:
        """Of words k the n characters from their nth on."""
        lo = count[s[k]] + nth
        end = np.where(nth + n < many[k], place[np.minimum(lo + n, len(place) - 1)], e[k])
        which.append(k)
        values.append(hash_ranges(w.data, place[lo], end, salt))

    for n in GRAMS:
        each = np.maximum(many - n + 1, 0)
        k = np.repeat(np.arange(len(at)), each)
        grams(k, np.arange(len(k)) - np.repeat(np.cumsum(each) - each, each), n, n)
    long = np.flatnonzero(many >= 3)
    grams(long, np.zeros(len(long), np.int64), 3, 11)
    grams(long, many[long] - 3, 3, 12)
    which_all = np.concatenate(which)
    order = np.argsort(which_all, kind="stable")
    ids = (np.concatenate(values)[order] >> shift).astype(np.int64)
    pair = np.full(len(own), -1, np.int64)
    pair[:-1] = np.where(w.doc[1:] == w.doc[:-1], (combine(own[:-1], own[1:]) >> shift).astype(np.int64), -1)
    return kind, ids, np.searchsorted(which_all[order], np.arange(len(at) + 1)), pair


def bags(col: pa.Array, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct features and counts of each text."""
    out = []
    for i in range(len(col)):
        w = Words(col.slice(i, 1))
        if not len(w):
            out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        kind, ids, bounds, pair = word_features(w, bits)
        each = np.bincount(kind, minlength=len(bounds) - 1)
        ids, pair = np.concatenate([ids, pair[pair >= 0]]), np.repeat(each, np.diff(bounds))
        counts = np.bincount(ids, np.concatenate([pair, np.ones(len(ids) - len(pair), np.int64)]))
        some = np.flatnonzero(counts)
        out.append((some, counts[some].astype(np.int64)))
    return out


@dataclass
class Embeddings:
    """A text's logit is b plus the average of its features' slopes: the softmax of two labels applied to each row of the vectors."""

    slopes: np.ndarray
    b: float

    def scores(self, col: pa.Array, bits: int) -> np.ndarray:
        w = Words(col)
        n = len(col)
        z = np.full(n, self.b)
        if len(w):
            kind, ids, bounds, pair = word_features(w, bits)
            sums = np.add.reduceat(self.slopes[ids], bounds[:-1])
            two = pair >= 0
            full = np.bincount(w.doc, np.diff(bounds)[kind] + two, n)
            z += np.bincount(w.doc, sums[kind] + np.where(two, self.slopes[pair], 0), n) / np.maximum(full, 1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, size: int = SIZE, epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> Embeddings:
    """Embeddings from bags of features and 0/1 labels. No rows: score 0.5; one label only: near it."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (1 << bits, size)).astype(np.float32)
    out, bias = np.zeros((size, 2), np.float32), np.zeros(2, np.float32)
    past, past_out, past_bias = (np.full(x.shape, 1e-8, np.float32) for x in (vectors, out, bias))
    y = np.asarray(labels, int)
    total = [max(1, int(c.sum())) for _, c in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            ids, share = rows[i][0], (rows[i][1] / total[i]).astype(np.float32)
            own = vectors[ids]
            hidden = share @ own if len(ids) else np.zeros(size, np.float32)
            z = hidden @ out + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y[i]] -= 1
            back = share[:, None] * (out @ g)
            slope = np.outer(hidden, g)
            past_out += slope * slope
            out -= rate * slope / np.sqrt(past_out)
            past_bias += g * g
            bias -= rate * g / np.sqrt(past_bias)
            if len(ids):  # distinct within a text
                so_far = past[ids] + back * back
                past[ids] = so_far
                vectors[ids] = own - rate * back / np.sqrt(so_far)
    return Embeddings((vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", bits: int = BITS, most: int = MOST) -> Embeddings:
    """Embeddings from a bounded sample of the labelled rows outside fold held_out: about `sample` rows and `most` distinct features at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            got = bags(b.column(2), bits)
            ids = pa.array([i.astype(np.int32) for i, _ in got], pa.list_(pa.int32()))
            counts = pa.array([np.minimum(c, 32767).astype(np.int16) for _, c in got], pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids, counts], names=["_id", "label", "ids", "counts"])

    rows = training_rows(docs, labels, label, folds, held_out, sample, doc_id, text).mapInArrow(run, "_id long, label int, ids array<int>, counts array<short>")
    got = within(rows, F.size("ids"), most).toArrow()
    # Views of the table's own memory, by id.
    bag = [(np.asarray(a.values), np.asarray(b.values)) for a, b in zip(got.column("ids"), got.column("counts"))]
    order = pc.sort_indices(got, [("_id", "ascending")]).to_numpy()
    model = train([bag[i] for i in order], got.column("label").to_numpy()[order], bits)
    del got, bag
    give_back()
    return model


def score(docs: DataFrame, model: Embeddings, text: str = "text", threshold: float = 0.3, bits: int = BITS) -> DataFrame:
    """docs with score (double) and predicted (int, 1 if score >= threshold) for each row; null text: empty. Columns of these names are replaced."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text, 1 << 19):
            s = shared.value.scores(b.column(b.schema.get_field_index(text)), bits)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs, by embeddings that never saw fold held_out's labels. A null id is in no fold."""
    model = fit(docs, labels, folds=folds, held_out=held_out, doc_id=doc_id, text=text, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(fold(doc_id, folds) == held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    return score(rows, model, "text", threshold).drop("text")
