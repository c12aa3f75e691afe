"""Near-duplicate documents by SimHash: a binary trie self-join of 64-bit fingerprints.

A fingerprint bit is 1 if over half of a text's shingle hashes have it. Distinct fingerprints are the nodes of a graph; those that differ in ``BUDGET``
bits at most are linked, and documents of linked fingerprints form a component.

The join walks pairs of trie nodes of equal depth together, adds up the bits in which their prefixes differ, and drops a pair once that exceeds the
error budget. The budget grows with depth: the 64 bits are a ring of ``TURNS`` parts, and if two words differ in k bits, some part to start from has at
most floor(j * k / TURNS) differences in its first j parts, for every j. So one trie is made for each start, and a walk may spend only that much by the end of
its j-th part, which prunes near the root, where a plain walk of one trie cannot. No link is lost: every pair within the budget is met in one trie at least.

Spark walks the upper levels by joins of node tables, ``STEP`` bits at a time and only below pairs of nodes that hold more than ``LEAF_ROWS`` fingerprints each on average;
every smaller pair is one group, walked inside a task level by level on arrays. A crowd of near copies makes no hot group: it is split by further bits like all others, and
before the walk fingerprints that agree but for one of sixteen groups of four bits are linked by a grouping, so a crowd has few components left. Node pairs
that hold one and the same component are dropped, and a task returns only links that join components it has not joined yet, so the pairs of a crowd are
neither walked nor written one by one.

Defined results: words are split at ASCII white space and only A-Z is lower-cased; a text of fewer words than a shingle has its whole sequence as one; a text
without words, or null, has fingerprint zero and is linked like any other; a text of any length counts whole; repeated rows share a component;
a bit that exactly half of the hashes have is 0; null doc_ids are never a component's id unless they stand alone; an empty table gives an empty result; extra columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from fieldlens.llm._common import ASCII_UPPER, materialize, read
from fieldlens.llm._text import Words, blocks
from fieldlens.llm.components import components

BUDGET = 4
TURNS, STEP = 4, 4
LEAF_ROWS = 1 << 13
PAIRS_AT_ONCE = 1 << 19
ENUMERATED = 64  # node pairs with so few fingerprint pairs are compared one by one
BROADCAST_FINGERPRINTS = 1_000_000
HASHES_AT_ONCE = 1 << 16

_LOWER_BYTE = np.arange(256, dtype=np.uint8)
_LOWER_BYTE[np.frombuffer(ASCII_UPPER.encode(), np.uint8)] += 32


def fingerprints(texts: pa.Array, width: int = 4) -> np.ndarray:
    """The SimHash (uint64) of each text."""
    w = Words(texts)
    n_docs, n = len(w.count), len(w.start)
    out = np.zeros(n_docs, np.uint64)
    if not n:
        return out
    # All words on end, each followed by one space, so that a shingle is a slice.
    size = w.end - w.start
    start = np.concatenate([[0], np.cumsum(size + 1)])
    flat = np.full(start[-1], 0x20, np.uint8)
    source = np.repeat(w.start - (start[:-1] - np.arange(n)), size) + np.arange(size.sum())
    flat[source - np.repeat(w.start - start[:-1], size)] = _LOWER_BYTE[w.data[source]]
    buffer = flat.tobytes()
    last = w.bounds[1:][w.doc] - 1  # each text's last word
    at = np.arange(n)
    first = at == w.bounds[:-1][w.doc]
    begins = np.flatnonzero((at + width - 1 <= last) | first)
    ends = np.minimum(begins + width - 1, last[begins])
    doc = w.doc[begins]
    from_, to = start[begins], start[ends] + size[ends]
    counts = np.zeros((n_docs, 64), np.int64)
    for i in range(0, len(doc), HASHES_AT_ONCE):
        pieces = zip(from_[i : i + HASHES_AT_ONCE].tolist(), to[i : i + HASHES_AT_ONCE].tolist())
        hashes = np.array([xxh64_intdigest(buffer[a:b], 42) for a, b in pieces], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        of = doc[i : i + HASHES_AT_ONCE]
        cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        counts[of[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    total = np.bincount(doc, minlength=n_docs)
    packed = np.packbits(2 * counts > total[:, None], axis=1, bitorder="little")
    return packed.view("<u8").ravel().astype(np.uint64)


def _fingerprinted(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprints(batch.column("text"), width).view(np.int64))], ["doc_id", "f"])


def allowance(depth: int, budget: int) -> int:
    """Bits that may differ in the first ``depth`` bits of a trie."""
    return -(-depth * TURNS // 64) * budget // TURNS


def _turned(f: Column, turn: int) -> Column:
    """f with the bits of part ``turn`` in front."""
    by = turn * 64 // TURNS
    return F.shiftleft(f, by).bitwiseOR(F.shiftrightunsigned(f, 64 - by)) if by else f


def _prefix(f: Column, depth: int) -> Column:
    return F.shiftrightunsigned(f, 64 - depth) if depth else F.lit(0).cast("long")


class Walk:
    """One task's walk over pairs of trie nodes. a, b: sorted fingerprints (uint64) of the two roots with their components; equal roots are one array."""

    def __init__(self, a: np.ndarray, a_label: np.ndarray, b: np.ndarray, b_label: np.ndarray, same: bool, depth: int, differ: int, budget: int):
        self.a, self.b, self.same, self.budget = a, b, same, budget
        self.names, inverse = np.unique(np.concatenate([a_label, b_label]), return_inverse=True)
        self.root = np.arange(len(self.names))  # of each component, the one it was joined to here
        self.of_a, self.of_b = inverse[: len(a)], inverse[len(a) :]
        self.links: list[tuple[int, int]] = []
        self._refresh()
        start = np.array([[0, len(a), 0, len(b), differ]], np.int64)
        waiting = [(depth, start)]
        while waiting:  # the deepest first, in slices, so that memory stays bounded
            at, pairs = waiting.pop()
            if len(pairs) > PAIRS_AT_ONCE:
                waiting.append((at, pairs[PAIRS_AT_ONCE:]))
                pairs = pairs[:PAIRS_AT_ONCE]
            pairs = pairs[~self._joined(pairs)]
            if not len(pairs):
                continue
            few = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2]) <= ENUMERATED
            if at == 64:
                few[:] = True
            self._compare(pairs[few])
            if (~few).any():
                waiting.append((at + 1, self._children(pairs[~few], at)))

    def _refresh(self) -> None:
        while (self.root[self.root] != self.root).any():
            self.root = self.root[self.root]
        self.now_a, self.now_b = self.root[self.of_a], self.root[self.of_b]
        self.turns_a, self.turns_b = (np.concatenate([[0], np.cumsum(x[1:] != x[:-1])]) if len(x) else x for x in (self.now_a, self.now_b))

    def _joined(self, pairs: np.ndarray) -> np.ndarray:
        """Node pairs that hold one component."""
        a, b, c, d = pairs[:, 0], pairs[:, 1] - 1, pairs[:, 2], pairs[:, 3] - 1
        return (self.turns_a[a] == self.turns_a[b]) & (self.turns_b[c] == self.turns_b[d]) & (self.now_a[a] == self.now_b[c])

    def _children(self, pairs: np.ndarray, depth: int) -> np.ndarray:
        bit = np.uint64(63 - depth)

        def middle(words: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            return np.searchsorted(words, ((words[low] >> bit) | np.uint64(1)) << bit)  # where the words of the node with this bit set begin

        a, b, c, d, differ = pairs.T
        p, q = np.clip(middle(self.a, a, b), a, b), np.clip(middle(self.b, c, d), c, d)
        out = [np.stack(x, 1) for x in ((a, p, c, q, differ), (p, b, q, d, differ), (a, p, q, d, differ + 1), (p, b, c, q, differ + 1))]
        if self.same:  # of two halves of one node, one order is enough
            out[3] = out[3][(a != c) | (b != d)]
        found = np.concatenate(out)
        return found[(found[:, 0] < found[:, 1]) & (found[:, 2] < found[:, 3]) & (found[:, 4] <= allowance(depth + 1, self.budget))]

    def _compare(self, pairs: np.ndarray) -> None:
        if not len(pairs):
            return
        wide = pairs[:, 3] - pairs[:, 2]
        each = (pairs[:, 1] - pairs[:, 0]) * wide
        whose = np.repeat(np.arange(len(pairs)), each)
        place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        i, j = pairs[whose, 0] + place // wide[whose], pairs[whose, 2] + place % wide[whose]
        near = (np.bitwise_count(self.a[i] ^ self.b[j]) <= self.budget) & (self.now_a[i] != self.now_b[j])
        x, y = self.now_a[i[near]], self.now_b[j[near]]
        if not len(x):
            return
        met = np.unique(np.minimum(x, y) * len(self.names) + np.maximum(x, y))
        root = self.root
        for low, high in zip((met // len(self.names)).tolist(), (met % len(self.names)).tolist()):
            while root[low] != low:
                low = root[low]
            while root[high] != high:
                high = root[high]
            if low != high:
                root[max(low, high)] = min(low, high)
                self.links.append((int(self.names[low]), int(self.names[high])))
        self._refresh()


def _walker(depth: int, budget: int):
    """Links found by walking one pair of nodes of this depth."""

    def walked(key: tuple, table: pa.Table) -> pa.Table:
        p, q, differ = key[1].as_py(), key[2].as_py(), key[3].as_py()
        word, label, side = (table.column(c).to_numpy() for c in ("word", "label", "side"))
        halves = []
        for s in (0, 1):
            mine = word[side == s].view(np.uint64)
            order = np.argsort(mine)
            halves.append((mine[order], label[side == s][order]))
        (a, a_label), (b, b_label) = halves[0], halves[0] if p == q else halves[1]
        links = Walk(a, a_label, b, b_label, p == q, depth, differ, budget).links if len(a) and len(b) else []
        return pa.table([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return walked


def hamming_links(words: DataFrame, budget: int = BUDGET, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Pairs (a, b) of labels of words(f, label), f distinct longs: enough of those within the budget to join all components that any such pair joins."""
    spark = words.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    turned = F.explode(F.array(*(F.struct(F.lit(t).alias("turn"), _turned(F.col("f"), t).alias("word")) for t in range(TURNS))))
    rows = words.select("label", turned.alias("r")).select("r.turn", "r.word", "label")
    n = words.count()
    pairs = spark.range(TURNS).select(F.col("id").cast("int").alias("turn"), *(F.lit(0).cast("long").alias(c) for c in "pq"), F.lit(0).alias("differ"), F.lit(2 * n).cast("long").alias("held"))
    depth = 0
    while True:
        ready = pairs.where(F.col("held") <= 2 * leaf_rows) if depth < 64 else pairs
        sides = ready.select("turn", "p", "q", "differ", F.col("p").alias("node"), F.lit(0).alias("side"))
        sides = sides.union(ready.where("p <> q").select("turn", "p", "q", "differ", F.col("q").alias("node"), F.lit(1).alias("side")))
        dealt = rows.withColumn("node", _prefix(F.col("word"), depth)).join(sides, ["turn", "node"]).select("turn", "p", "q", "differ", "word", "label", "side")
        found = dealt.groupBy("turn", "p", "q", "differ").applyInArrow(_walker(depth, budget), "a long, b long")
        links = links.union(materialize(found))
        open_ = pairs.where(F.col("held") > 2 * leaf_rows)
        if depth == 64 or open_.isEmpty():
            return links
        # Only what lies below nodes that are still too large goes on.
        alive = open_.select("turn", F.col("p").alias("node")).union(open_.select("turn", F.col("q").alias("node"))).distinct()
        rows = materialize(rows.withColumn("node", _prefix(F.col("word"), depth)).join(alive, ["turn", "node"], "left_semi").select("turn", "word", "label"))
        above, depth = depth, depth + STEP
        nodes = rows.groupBy("turn", _prefix(F.col("word"), depth).alias("node")).agg(F.count("*").alias("rows"), F.min("label").alias("low"), F.max("label").alias("high"))
        nodes = materialize(nodes.withColumn("parent", F.shiftrightunsigned("node", STEP) if above else F.lit(0).cast("long")))
        x, y = (nodes.select("turn", F.col("parent").alias(p), *(F.col(c).alias(c + p) for c in ("node", "rows", "low", "high"))) for p in "pq")
        met = open_.select("turn", "p", "q").join(x, ["turn", "p"]).join(y, ["turn", "q"])
        met = met.withColumn("differ", F.bit_count(F.col("nodep").bitwiseXOR(F.col("nodeq"))))
        one = (F.col("lowp") == F.col("highp")) & (F.col("lowp") == F.col("lowq")) & (F.col("lowq") == F.col("highq"))
        met = met.where((F.col("differ") <= allowance(depth, budget)) & ((F.col("p") != F.col("q")) | (F.col("nodep") <= F.col("nodeq"))) & ~one)
        pairs = materialize(met.select("turn", F.col("nodep").alias("p"), F.col("nodeq").alias("q"), "differ", (F.col("rowsp") + F.col("rowsq")).alias("held")))


def _crowds(words: DataFrame, budget: int) -> DataFrame:
    """(f, label): words that agree but for ``budget`` adjoining bits have one label; these are within the budget, and bind a crowd without its pairs."""
    if not budget:
        return words.select("f", F.col("f").alias("label"))
    masks = np.array([(1 << 64) - 1 - (((1 << budget) - 1) << at) for at in range(0, 64 - budget + 1, budget)], np.uint64).view(np.int64).tolist()
    kept = F.explode(F.array(*(F.struct(F.lit(i).alias("mask"), F.col("f").bitwiseAND(F.lit(m).cast("long")).alias("rest")) for i, m in enumerate(masks))))
    spread = words.select("f", kept.alias("s")).select("f", "s.mask", "s.rest")
    least = spread.groupBy("mask", "rest").agg(F.min("f").alias("b"), F.count("*").alias("n")).where("n > 1").select("mask", "rest", "b")
    labels = components(spread.join(least, ["mask", "rest"]).select(F.col("f").alias("a"), "b"))
    return words.select("f").join(labels.withColumnRenamed("node", "f"), "f", "left").select("f", F.coalesce("label", "f").alias("label"))


def near_fingerprints(docs: DataFrame, width: int = 4, budget: int = BUDGET, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """doc_id, fingerprint, component_id for every row of docs(doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = materialize(texts.mapInArrow(lambda b: _fingerprinted(b, width), "doc_id long, f long"))
    words = materialize(every.groupBy("f").agg(F.min("doc_id").alias("doc_id")))
    crowds = materialize(_crowds(words, budget))
    joined = components(hamming_links(crowds, budget, leaf_rows)).select(F.col("node").alias("label"), F.col("label").alias("whole"))
    whole = materialize(crowds.join(joined, "label", "left").select("f", F.coalesce("whole", "label").alias("whole")).join(words, "f"))
    least = whole.groupBy("whole").agg(F.min("doc_id").alias("component_id"))
    of = materialize(whole.select("f", "whole").join(least, "whole").select("f", "component_id"))
    of = F.broadcast(of) if of.count() <= BROADCAST_FINGERPRINTS else of
    return every.join(of, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_fingerprints(read(spark, sf_dir, "documents"))


QUERIES = {"op11_simhash": op11_simhash}
ORACLE: dict[str, str] = {}
