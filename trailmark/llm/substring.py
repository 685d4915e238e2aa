"""Substring dedup on a log-structured fingerprint index.

A window is `window` words in a row of one text. Its fingerprint is the smallest hash of the GRAM-word
grams in it, so equal windows have equal fingerprints, and neighbouring windows mostly share one: a
text falls into segments of successive windows with one fingerprint. Each batch adds two immutable tables to the index: a run,
sorted by (fp, span), that tells for each fingerprint and span (an independent hash of all the segment's words) the first
document that has it; and a log of the segments with their windows' hashes. Runs are merge-joined with
the next batch, and compacted into one when there are `fanout` of them; the log is never rewritten. Then matches are verified:
equal spans are repeats as wholes; of a fingerprint's different spans, one document's windows each are read from
the log and compared (128 bits with the fingerprint). Texts of earlier batches are never read again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from trailmark.llm.runtime import cut, kept, listed, pieces, read_text, remove, scratch, split, write_text
from trailmark.llm.textops import U, Words, runs, slide, spans

WINDOW, GRAM = 50, 8


class Scan:
    """Windows and segments of a batch of texts."""

    def __init__(self, col: pa.Array, window: int, gram: int = GRAM):
        self.words = w = Words(col)
        gram = min(gram, window)
        self.start = np.flatnonzero(w.whole(window))
        self.doc = w.doc[self.start]
        self.fp = slide(runs(w.hashes(0), gram), window - gram + 1, np.minimum)[self.start]
        other = w.hashes(1)
        self.hash = runs(other, window)[self.start]
        new = np.ones(len(self.start), bool)
        new[1:] = (self.fp[1:] != self.fp[:-1]) | (np.diff(self.start) != 1)
        self.first = np.flatnonzero(new)
        self.segment = np.cumsum(new) - 1
        self.bounds = np.append(self.first, len(self.start))
        self.span = spans(other, self.start[self.first], self.start[self.bounds[1:] - 1] + window)


def segments(docs: DataFrame, window: int) -> DataFrame:
    """docs (doc long, text) -> (fp, span, doc, windows array<long>), each segment once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            s = Scan(b.column(1), window)
            if len(s.first):
                ids = b.column(0).to_numpy(zero_copy_only=False)
                rows = np.stack([s.doc[s.first].astype(U), s.fp[s.first], s.span], 1)
                _, at = np.unique(rows, axis=0, return_index=True)
                windows = pa.ListArray.from_arrays(pa.array(s.bounds, pa.int32()), pa.array(s.hash.view(np.int64))).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*(pa.array(rows[at, k].view(np.int64)) for k in (1, 2)), pa.array(ids[s.doc[s.first[at]]], pa.int64()), windows], names=["fp", "span", "doc", "windows"])

    return docs.where("doc is not null and text is not null").mapInArrow(run, f"{RUN}, windows array<long>")


RUN = "fp long, span long, doc long"
#: Bytes of a row group that a writer holds in memory.
ROW_GROUP = 16 << 20


class FingerprintIndex:
    """Runs and logs in a folder that all executors see, and a manifest that tells which of them count.

    Opening a folder again finds what earlier sessions left there. A new manifest has the next number and is written
    after what it names, so a job that dies leaves the index as it was. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.path = path or scratch(spark, "index")
        numbers = [int(n.removeprefix("manifest-")) for n in listed(spark, self.path) if n.startswith("manifest-") and n[9:].isdigit()]
        self.number = max(numbers, default=0)
        held = json.loads(read_text(spark, f"{self.path}/manifest-{self.number:05d}")) if numbers else {"runs": [], "logs": [], "made": 0}
        self.runs: list[str] = held["runs"]
        self.logs: list[str] = held["logs"]
        self.made: int = held["made"]

    def _commit(self, runs: list[str], logs: list[str]) -> None:
        write_text(self.spark, f"{self.path}/manifest-{self.number + 1:05d}", json.dumps({"runs": runs, "logs": logs, "made": self.made}))
        if self.number:
            remove(self.spark, f"{self.path}/manifest-{self.number:05d}")
        self.runs, self.logs, self.number = runs, logs, self.number + 1

    def _write(self, kind: str, rows: DataFrame) -> str:
        """A new table, in place of what a job that died may have left there."""
        self.made += 1
        name = f"{kind}-{self.made:05d}"
        # Hashes don't compress.
        rows.write.mode("overwrite").option("compression", "uncompressed").option("parquet.block.size", ROW_GROUP).parquet(f"{self.path}/{name}")
        return name

    def _read(self, names: list[str], more: str = "") -> DataFrame:
        return self.spark.read.schema(RUN + more).parquet(*[f"{self.path}/{n}" for n in names])

    def run(self, log: str) -> str:
        """Write the run of a log: the first document of each (fp, span)."""
        first = self.windows([log]).groupBy("fp", "span").agg(F.min("doc").alias("doc"))
        return self._write("run", first.sortWithinPartitions("fp", "span"))

    def append(self, rows: DataFrame) -> tuple[str, str]:
        """Write a batch's segments; the names of its run and log. They count once `commit` has them."""
        log = self._write("log", rows)
        return self.run(log), log

    def commit(self, run: str, log: str) -> None:
        self._commit([*self.runs, run], [*self.logs, log])

    def history(self) -> DataFrame | None:
        return self._read(self.runs) if self.runs else None

    def windows(self, logs: list[str]) -> DataFrame:
        return self._read(logs, ", windows array<long>")

    def settle(self) -> None:
        """Compact if there are enough runs. Tables read from the index before must not be read after."""
        if len(self.runs) >= self.fanout:
            self.compact()

    def compact(self) -> None:
        """Merge all runs into one, then delete them. The first document is the one in the earliest run, the smallest there."""
        old = self.runs
        each = [self._read([n]).withColumn("nth", F.lit(k)) for k, n in enumerate(old)]
        merged = each[0]
        for r in each[1:]:
            merged = merged.union(r)
        merged = merged.groupBy("fp", "span").agg(F.min(F.struct("nth", "doc")).alias("m")).select("fp", "span", "m.doc")
        self._commit([self._write("run", merged.sortWithinPartitions("fp", "span"))], self.logs)
        for n in old:
            remove(self.spark, f"{self.path}/{n}")

    def drop(self) -> None:
        remove(self.spark, self.path)
        self.runs, self.logs = [], []


def _merge(left: DataFrame, right: DataFrame, on: list[str], kind: str = "inner") -> DataFrame:
    return left.join(right.hint("merge"), on, kind)


def _key(*cols: str) -> Column:
    return F.xxhash64(*cols)


#: Stands for any document of an earlier batch; smaller than every id of this one.
PAST = -(1 << 63)


def repeats(batch: DataFrame, index: FingerprintIndex, window: int = WINDOW) -> DataFrame:
    """What of a batch (doc, text) repeats earlier documents, as doc, spans array<long>, windows array<long>.

    Earlier is all that the index holds, whatever its ids, and a smaller id within the batch. The batch is then in the index.
    spans: segments that are repeats as wholes; windows: hashes of other windows that are.
    """
    index.settle()
    old, old_logs = index.history(), list(index.logs)
    run, log = index.append(segments(batch, window))
    new, rows = index._read([run]), index._read([log])
    work = f"{index.path}/work-{index.made:05d}"  # what only this batch needs; removed at its end
    remove(index.spark, work)
    held_back: list[DataFrame] = []

    def hold(df: DataFrame) -> DataFrame:
        """df on the executors' disks, to be read more than once; what is lost with an executor is made again from the index's files."""
        held_back.append(df.persist(StorageLevel.DISK_ONLY))
        return df

    if old is None:
        known = new.select("fp", "span", "doc", F.lit(False).alias("past"))
        met = known.select("fp", "span", F.lit(True).alias("fresh"))
    else:
        # Of the history only what may share a fingerprint with the batch is shuffled.
        near = split(old, "fp", new, "fp")[0]
        held = near.select("fp", "span", F.lit(True).alias("past"))
        held = held.distinct() if len(index.runs) > 1 else held
        known = hold(_merge(new, held, ["fp", "span"], "left").select("fp", "span", "doc", F.coalesce("past", F.lit(False)).alias("past")))
        met = known.select("fp", "span", (~F.col("past")).alias("fresh")).union(near.select("fp", "span", F.lit(False)))
    # Fingerprints with different spans, one of them new at least. Tables, here and below, where a join must be able to split common keys: it has plain exchanges then.
    mixed = kept(met.groupBy("fp").agg((F.min("span") != F.max("span")).alias("mixed"), F.max("fresh").alias("fresh")).where("mixed and fresh").select("fp"), f"{work}/mixed")
    again = rows.groupBy("fp", "span").agg(F.max("doc").alias("last"))
    again = kept(_merge(known, again, ["fp", "span"]).where("past or last > doc").select("fp", "span", "doc", "past"), f"{work}/again")
    some = split(rows.withColumn("key", _key("fp", "span")), "key", again.select(_key("fp", "span").alias("key")), "key")[0]
    whole = _merge(some.select("fp", "span", F.col("doc").alias("who")), again, ["fp", "span"]).where("past or who > doc").select(F.col("who").alias("doc"), "span")
    # One document of each such span, the first, shows its windows.
    windows = _shown(index.windows([log]), hold(_merge(known.where("not past").select("fp", "span", "doc"), mixed, ["fp"], "left_semi"))).select("fp", "hash", F.col("doc").alias("who"))
    if old is not None:
        past = _shown(index.windows(old_logs), hold(_merge(near.select("fp", "span", "doc"), mixed, ["fp"], "left_semi")))
        windows = windows.union(past.select("fp", "hash", F.lit(PAST).cast("long").alias("who")))
    windows = kept(windows, f"{work}/windows")
    first = kept(windows.groupBy("fp", "hash").agg(F.min("who").alias("own"), F.max("who").alias("last")).where("own < last").select("fp", "hash", "own"), f"{work}/first")
    single = _merge(windows, first, ["fp", "hash"]).where("who > own").select(F.col("who").alias("doc"), "hash")
    found = whole.select("doc", "span", F.lit(None).cast("long").alias("hash")).union(single.select("doc", F.lit(None).cast("long").alias("span"), "hash"))
    found = cut(found.groupBy("doc").agg(F.collect_set("span").alias("spans"), F.collect_set("hash").alias("windows")))
    for df in held_back:
        df.unpersist()
    remove(index.spark, work)
    index.commit(run, log)
    return found


def _shown(log: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, hash, doc): the windows of wanted (fp, span, doc), from a log."""
    some = split(log.withColumn("key", _key("fp", "span", "doc")), "key", wanted.select(_key("fp", "span", "doc").alias("key")), "key")[0]
    return some.join(wanted.hint("merge"), ["fp", "span", "doc"], "left_semi").select("fp", "doc", F.explode("windows").alias("hash"))


def _marked(s: Scan, spans: pa.Array) -> np.ndarray:
    """Which segments have a span that is in their text's list."""
    out = np.zeros(len(s.first), bool)
    owner = s.doc[s.first]
    lists = spans.to_pylist() if len(spans) else []
    bounds = np.searchsorted(owner, np.arange(len(lists) + 1))
    for i, own in enumerate(lists):
        if own and bounds[i + 1] > bounds[i]:
            out[bounds[i] : bounds[i + 1]] = np.isin(s.span[bounds[i] : bounds[i + 1]], np.array(own, np.int64).view(U))
    return out


def _hashed(s: Scan, hashes: pa.Array) -> np.ndarray:
    """Which windows have a hash that is in their text's list."""
    out = np.zeros(len(s.start), bool)
    lists = hashes.to_pylist()
    bounds = np.searchsorted(s.doc, np.arange(len(lists) + 1))
    for i, own in enumerate(lists):
        if own and bounds[i + 1] > bounds[i]:
            out[bounds[i] : bounds[i + 1]] = np.isin(s.hash[bounds[i] : bounds[i + 1]], np.array(own, np.int64).view(U))
    return out


def _apply(texts: DataFrame, found: DataFrame, window: int, layout: bool) -> DataFrame:
    """texts (__row, __doc, __text) as __row, __text without what was found, __words, __gone."""
    found = found.select(F.col("doc").alias("__id"), "spans", "windows")
    maybe, rest = split(texts, "__doc", found, "__id")
    none = F.lit(None).cast("array<long>")
    joined = maybe.join(found, F.col("__doc") == F.col("__id"), "left").select("__row", "__text", "spans", "windows").union(rest.select("__row", "__text", none.alias("spans"), none.alias("windows")))
    schema = T.StructType([joined.schema["__row"], T.StructField("__text", T.StringType()), T.StructField("__words", T.LongType()), T.StructField("__gone", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "__text"):
            col = b.column(1)
            s = Scan(col, window)
            w = s.words
            covered = np.zeros(len(w) + 1, np.int64)
            if len(s.first):
                at = s.start[_marked(s, b.column(2))[s.segment] | _hashed(s, b.column(3))]
                covered[at] += 1
                covered[at + window] -= 1
            gone = np.cumsum(covered[:-1]) > 0
            lost = np.add.reduceat(np.append(gone, False).astype(np.int64), w.first[:-1]) if len(w) else np.zeros(b.num_rows, np.int64)
            lost[w.counts == 0] = 0
            data = w.data.tobytes()
            starts, ends = w.starts.tolist(), w.ends.tolist()
            texts = col.to_pylist()
            for i in range(b.num_rows) if not layout else np.flatnonzero(lost).tolist():
                lo, hi = int(w.first[i]), int(w.first[i + 1])
                if layout:
                    texts[i] = _cut_out(data, int(w.bounds[i]), int(w.bounds[i + 1]), gone[lo:hi], starts[lo:hi], ends[lo:hi])
                else:
                    texts[i] = b" ".join([data[starts[j] : ends[j]] for j in (np.flatnonzero(~gone[lo:hi]) + lo).tolist()]).decode()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(w.counts.astype(np.int64)), pa.array(lost)], names=["__row", "__text", "__words", "__gone"])

    return joined.mapInArrow(run, schema)


def _cut_out(data: bytes, lo: int, hi: int, gone: np.ndarray, starts: list[int], ends: list[int]) -> str:
    """A text without its gone words and the white space after them, else as it was."""
    out, at, i, n = [], lo, 0, len(gone)
    while i < n:
        if gone[i]:
            j = i
            while j < n and gone[j]:
                j += 1
            out.append(data[at : starts[i]])
            at = starts[j] if j < n else hi
            i = j
        else:
            i += 1
    out.append(data[at:hi])
    return b"".join(out).decode()


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, batches: int = 3, layout: bool = True, index: FingerprintIndex | None = None) -> DataFrame:
    """docs with the repeated passages of text removed, and n_words and n_removed (longs) for each row.

    A word goes if a window of `window` words that covers it also starts in a document with a smaller
    id; windows are judged on the input. The rows are taken as `batches` batches by ascending id, each
    against the index of those before; the result doesn't depend on their number. All that a given index holds from earlier
    calls counts as earlier too, whatever its ids: calls by ascending id give what one call over all rows would.
    Without one an index of its own is dropped at the end. With layout the rest of
    a text keeps its white space, without it the kept words are joined by one space.
    Texts under `window` words, nulls (which stay null with layout, and else become empty) and rows
    without id lose nothing and take nothing. Rows of one call that repeat an id are judged each by itself, never
    against each other. Columns called n_words and n_removed are replaced; others stay.
    """
    spark = docs.sparkSession
    own = index or FingerprintIndex(spark, fanout=2)
    rest = [c for c in docs.columns if c not in (text, "n_words", "n_removed")]
    bounds = docs.where(F.col(doc_id).isNotNull()).approxQuantile(doc_id, [i / batches for i in range(1, batches)], 0.001) if batches > 1 else []
    bounds = sorted({int(x) for x in bounds})
    key = F.col(doc_id).cast("long")
    out, low = None, None
    for high in [*bounds, None]:
        inside = F.lit(True)
        if low is not None:
            inside &= key > low
        if high is not None:
            inside &= key <= high
        if low is None:
            inside |= key.isNull()
        part = docs.where(inside)
        found = repeats(part.select(key.alias("doc"), F.col(text).alias("text")), own, window)
        done = _apply(part.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__row"), key.alias("__doc"), F.col(text).alias("__text")), found, window, layout)
        out = done if out is None else out.union(done)
        low = high
    if index is None:
        own.drop()
    cols = [(F.col("__text") if c == text else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns if c not in ("n_words", "n_removed")]
    return out.select(*cols, F.col("__words").alias("n_words"), F.col("__gone").alias("n_removed"))
