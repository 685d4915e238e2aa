"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), x_i = 1 if the text has term i. A word gives
up to three terms: the word without closing punctuation, and its first four and five bytes, which words
of one stem share. Terms of the sample that tell the labels apart by `least` standard
errors or more take part, and those of a pair whose texts differ by PAIRED from what its two terms one by one let
expect; others have no weight. A pair's product lets two terms mean more, or less,
together than one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmark.llm.labelled import fold, give_back, training_rows, within
from trailmark.llm.runtime import pieces
from trailmark.llm.textops import U, Words, hash_ranges

BITS, FACTORS, SAMPLE, LEAST, EPOCHS = 18, 6, 20_000, 3.0, 12
#: Standard errors by which a pair's texts differ from what its two terms let expect; more than for terms, as there are so many more pairs.
PAIRED = 5.0
#: Distinct terms of all texts of the sample, 4 bytes each: the other bound of the sample.
MOST = 20_000_000
#: Distinct terms of the texts of the sample among which pairs are looked for: what that takes grows with the texts times the square of their terms.
PAIR_MOST = 2_000_000


def terms(col: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text one after another, and their bounds."""
    w = Words(col, lower=True)
    if not len(w):
        return np.zeros(0, np.int64), np.zeros(len(col) + 1, np.int64)
    ends = w.bare()
    got = [(hash_ranges(w.data, w.starts, ends, 1), w.doc)]
    for k in (4, 5):
        long = ends - w.starts > k
        s = w.starts[long]
        got.append((hash_ranges(w.data, s, s + k, k), w.doc[long]))
    h = np.concatenate([g for g, _ in got]) >> U(64 - bits)
    key = np.unique(np.concatenate([d for _, d in got]).astype(np.int64) << bits | h.astype(np.int64))
    return key & ((1 << bits) - 1), np.searchsorted(key >> bits, np.arange(len(col) + 1))


@dataclass
class Machine:
    """b, w and v; slot gives a term's row in w and v, 0 for terms without weight."""

    slot: np.ndarray
    b: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        row = self.slot[ids]
        live = row > 0
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[live]
        row = row[live]
        n = len(bounds) - 1
        out = self.b + np.bincount(doc, self.w[row], n)
        for f in range(self.v.shape[1]):
            x = self.v[row, f]
            out += 0.5 * (np.bincount(doc, x, n) ** 2 - np.bincount(doc, x * x, n))
        return out

    def scores(self, col: pa.Array, bits: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(*terms(col, bits)), -30, 30)))


def paired(lists: list[np.ndarray], y: np.ndarray, size: int, least: float = PAIRED) -> np.ndarray:
    """The terms below `size` of all pairs that tell the labels apart beyond their two terms. Equal texts count once."""
    own = {(xxhash.xxh3_128_digest(x.tobytes()), label): k for k, (x, label) in enumerate(zip(lists, y))}
    rows = [lists[k] for k in own.values()]
    y = y[list(own.values())] > 0
    p = (y.sum() + 0.5) / (len(y) + 1)
    seen, hits = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for x, label in zip(rows, y):
        seen[x] += 1
        hits[x] += label
    few = int(least)  # no pair in so few texts reaches least
    by = np.flatnonzero(seen > few)
    by = by[np.argsort(seen[by], kind="stable")]  # rare terms first: they meet those after them
    if not len(by):
        return by
    number = np.full(size, -1, np.int32)
    number[by] = np.arange(len(by))
    rows = [np.sort(x[x >= 0]) for x in (number[x] for x in rows)]
    flat, ends = np.concatenate(rows), np.cumsum([len(x) for x in rows])
    doc = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in rows])
    del rows, own
    place = np.argsort(flat, kind="stable").astype(np.int32)  # a term's places in flat, one after another
    first = np.concatenate([[0], np.cumsum(seen[by])])
    rate = (hits[by] + p) / (seen[by] + 1)
    odds, base = np.log(rate / (1 - rate)), np.log(p / (1 - p))
    out = np.zeros(len(by), bool)

    def after(at: np.ndarray) -> np.ndarray:
        got = [flat[a:z] for a, z in zip((at + 1).tolist(), ends[doc[at]].tolist())]
        return np.concatenate(got) if got else flat[:0]

    for i in range(len(by) - 1):
        at = place[first[i] : first[i + 1]]
        all_, toxic = after(at), after(at[y[doc[at]]])
        if 8 * len(all_) < len(by):  # a table of all terms costs more than sorting
            all_.sort()
            toxic.sort()
            again = all_[few:]
            j = np.unique(again[again == all_[: len(again)]])
            n, h = (np.searchsorted(x, j, "right") - np.searchsorted(x, j) for x in (all_, toxic))
        else:
            n = np.bincount(all_, minlength=len(by))
            j = np.flatnonzero(n > few)
            n, h = n[j], np.bincount(toxic, minlength=len(by))[j]
        e = 1 / (1 + np.exp(-np.clip(odds[i] + odds[j] - base, -30, 30)))
        j = j[np.abs(h - n * e) >= least * np.sqrt(n * e * (1 - e) + 1)]
        if len(j):
            out[j] = out[i] = True
    return by[out]


def train(lists: list[np.ndarray], labels: np.ndarray, bits: int = BITS, factors: int = FACTORS, least: float = LEAST, epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-4, seed: int = 7, pair_most: int = PAIR_MOST) -> Machine:
    """A machine from distinct terms by text, and 0/1 labels, by AdaGrad on the logistic loss. No rows: score 0.5; one label only: near it."""
    n = len(lists)
    y = np.asarray(labels, float)
    slot = np.zeros(1 << bits, np.int32)
    if not n:
        return Machine(slot, 0.0, np.zeros(1), np.zeros((1, factors)))
    seen, hits = np.zeros(1 << bits), np.zeros(1 << bits)
    for x, label in zip(lists, y):  # terms are distinct within a text
        seen[x] += 1
        hits[x] += label
    p = (y.sum() + 0.5) / (n + 1)
    z = (hits - seen * p) / np.sqrt(seen * p * (1 - p) + 1)
    # Texts in a random order, as many as the bound lets in.
    order = np.random.default_rng(seed).permutation(n)
    some = order[: max(1, int(np.searchsorted(np.cumsum([len(lists[i]) for i in order]), pair_most)))]
    kept = np.union1d(np.flatnonzero((seen >= 3) & (np.abs(z) >= least)), paired([lists[i] for i in some], y[some], 1 << bits))
    slot[kept] = np.arange(1, len(kept) + 1)
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(kept) + 1), rng.normal(0, 0.01, (len(kept) + 1, factors))
    v[0] = 0
    b = float(np.log(p / (1 - p)))
    gw, gv, gb = np.full(len(w), 1e-6), np.full(v.shape, 1e-6), 1e-6
    rows = [slot[x][slot[x] > 0] for x in lists]
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 64):
            batch = order[lo : lo + 64]
            row = np.concatenate([rows[i] for i in batch])
            doc = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
            x = v[row]
            s = np.zeros((len(batch), factors))
            np.add.at(s, doc, x)
            q = np.zeros(len(batch))
            np.add.at(q, doc, (x * x).sum(1))
            z = b + np.bincount(doc, w[row], len(batch)) + 0.5 * ((s * s).sum(1) - q)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            gb += g.sum() ** 2
            b -= rate * g.sum() / np.sqrt(gb)
            u, inv = np.unique(row, return_inverse=True)
            if not len(u):
                continue
            dw = np.bincount(inv, g[doc], len(u)) + decay * w[u]
            dv = np.zeros((len(u), factors))
            np.add.at(dv, inv, g[doc, None] * (s[doc] - x))
            dv += decay * v[u]
            gw[u] += dw * dw
            gv[u] += dv * dv
            w[u] -= rate * dw / np.sqrt(gw[u])
            v[u] -= 0.25 * rate * dv / np.sqrt(gv[u])
    return Machine(slot, b, w, v)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 4, held_out: int = 2, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text", bits: int = BITS, most: int = MOST, pair_most: int = PAIR_MOST) -> Machine:
    """A machine from a bounded sample of the labelled rows outside fold held_out: about `sample` rows and `most` distinct terms at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            ids, bounds = terms(b.column(2), bits)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))], names=["_id", "label", "terms"])

    rows = training_rows(docs, labels, label, folds, held_out, sample, doc_id, text).mapInArrow(run, "_id long, label int, terms array<int>")
    got = within(rows, F.size("terms"), most).toArrow()
    order = pc.sort_indices(got, [("_id", "ascending")]).to_numpy()
    lists = [np.asarray(x.values) for x in got.column("terms")]
    model = train([lists[i] for i in order], got.column("label").to_numpy()[order], bits, pair_most=pair_most)
    del got, lists
    give_back()
    return model


def score(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = 0.3, bits: int = BITS) -> DataFrame:
    """docs with score (double) and predicted (int, 1 if score >= threshold) for each row; null text: empty. Columns of these names are replaced."""
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # 2**bits slots and the sample's terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text):
            s = shared.value.scores(b.column(b.schema.get_field_index(text)), bits)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs, by a machine that never saw fold held_out's labels. A null id is in no fold."""
    machine = fit(docs, labels, folds=folds, held_out=held_out, doc_id=doc_id, text=text, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(fold(doc_id, folds) == held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    return score(rows, machine, "text", threshold).drop("text")
