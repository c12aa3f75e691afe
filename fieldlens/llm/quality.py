"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of the whole text are computed for a block of documents at once. Trees are complete, of one depth, and
flattened into arrays (feature, threshold, leaf), so a block of documents walks all trees in ``depth`` numpy steps.
Training uses a bounded sample of labelled rows (``train_rows``), chosen by a hash of doc_id.

Defined results: null and empty texts have all statistics zero and get the score of such a row; labels that
are null are not learned; a doc_id that is labelled, or that rows share, more than once is learned once for each label, with
its least statistics; without any labelled row every score is ``prior``; repeated rows each keep a row, and equal texts get
equal scores; texts of any length are measured whole; an empty table gives an empty result; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import read
from fieldlens.llm._text import Words, blocks

TRAIN_ROWS = 20_000
THRESHOLD = 0.3
FEATURES = 16
BINS, DEPTH, TREES, RATE, LEAST = 64, 4, 80, 0.2, 8

_KIND = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 sentence mark, 6 symbol, 7 not ASCII
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[32, *range(9, 14)]] = 4
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 5
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_KIND[128:] = 7


def _per(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values over each text's range."""
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[ends[1:]] - total[ends[:-1]]).astype(float)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES numbers for each text."""
    w = Words(texts)
    n = np.diff(w.ends).astype(float)
    kinds = _KIND[w.data]
    share = np.maximum(n, 1)
    by = [_per(kinds == k, w.ends) / share for k in range(1, 8)]
    words = w.count.astype(float)
    safe = np.maximum(words, 1)
    lengths = w.end - w.start
    mean = _per(lengths, w.bounds) / safe
    spread = np.sqrt(np.maximum(_per(lengths * lengths, w.bounds) / safe - mean**2, 0))
    same = np.zeros(len(w.hash))
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((w.hash, w.doc))
    h, d = w.hash[order], w.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    firsts = np.flatnonzero(new)
    runs = np.diff(np.append(firsts, len(h)))
    distinct, most = np.zeros(len(n)), np.zeros(len(n))
    np.add.at(distinct, d[firsts], 1)
    np.maximum.at(most, d[firsts], runs)
    breaks = _per(w.data == 10, w.ends)
    ending = kinds[w.end - 1] if len(w.end) else np.zeros(0, int)
    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(words),
            mean,
            spread,
            *by,
            distinct / safe,
            most / safe,
            _per(same, w.bounds) / safe,
            np.log1p(breaks),
            _per(ending == 6, w.bounds) / safe,
        ]
    )


class Trees:
    """Boosted trees as arrays: feature and threshold of inner nodes in heap order, and the leaves' values."""

    def __init__(self, prior: float):
        self.start = float(np.log(prior / (1 - prior)))
        self.feature = np.zeros((0, 2**DEPTH - 1), np.int64)
        self.threshold = np.zeros((0, 2**DEPTH - 1))
        self.leaf = np.zeros((0, 2**DEPTH))

    def score(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        margin = self.start + self.leaf[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray, prior: float = 0.5) -> Trees:
    """Fit by second-order boosting of the logistic loss on quantile bins."""
    if not len(y):
        return Trees(prior)
    model = Trees(float(np.clip(y.mean(), 0.01, 0.99)))
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(k)]
    bins = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    margin = np.full(n, model.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        feature = np.zeros(2**DEPTH - 1, np.int64)
        threshold = np.full(2**DEPTH - 1, np.inf)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            local = node - first
            best = np.full(width, 1e-9)
            cut = np.full(width, BINS)
            for f in range(k):
                cell = local * BINS + bins[:, f]
                gs, hs, cs = (np.bincount(cell, v, width * BINS).reshape(width, BINS).cumsum(1) for v in (g, h, np.ones(n)))
                total_g, total_h, total_c = gs[:, -1:], hs[:, -1:], cs[:, -1:]
                gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                gain[(cs < LEAST) | (total_c - cs < LEAST)] = 0
                gain[:, len(edges[f]) :] = 0
                at = gain.argmax(1)
                better = gain[np.arange(width), at] > best
                best[better] = gain[np.arange(width), at][better]
                cut[better] = at[better]
                feature[first : first + width][better] = f
                for j in np.flatnonzero(better):
                    threshold[first + j] = edges[f][at[j]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        local = node - (2**DEPTH - 1)
        leaf = -RATE * np.bincount(local, g, 2**DEPTH) / (np.bincount(local, h, 2**DEPTH) + 1)
        margin += leaf[local]
        model.feature = np.vstack([model.feature, feature])
        model.threshold = np.vstack([model.threshold, threshold])
        model.leaf = np.vstack([model.leaf, leaf])
    return model


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def training_rows(labels: DataFrame, label: str, modulus: int, remainder: int, rows: int) -> DataFrame:
    """A bounded sample (doc_id, label) of the rows that may be learned, chosen by a hash of doc_id."""
    may = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
    return may.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    sample = training_rows(labels, "quality", 5, 0, rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            x = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.FixedSizeListArray.from_arrays(x.ravel(), FEATURES).cast(pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    measured = found.mapInArrow(measure, "doc_id long, label int, x array<double>")
    got = measured.groupBy("doc_id", "label").agg(F.min("x").alias("x")).toArrow()  # bounded by the sample
    if not got.num_rows:
        return fit(np.zeros((0, FEATURES)), np.zeros(0))
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    y = got.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, y, got.column("doc_id").to_numpy()))
    return fit(x[order], y[order])


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row of docs(doc_id, text)."""
    model = train(docs, labels, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            score = model.score(statistics(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that are predicted good, with all their columns."""
    model = train(docs, labels, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            yield batch.filter(pa.array(model.score(statistics(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_quality(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


QUERIES = {"op10_quality": op10_quality}
ORACLE: dict[str, str] = {}
