"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised alike: lower-cased, each run of characters that are no letters or digits becomes one
space, and one space stands before and after them, so that an item without edits to spare matches whole words only. An item of n characters may differ from a passage by k = floor(``ERROR_RATE`` * n) edits. Cut into k + 1
pieces, one piece at least stands in every such passage unchanged, so exact piece hits (found for all items at once by an
Aho-Corasick automaton) give every place to look at. There, Myers' bit-parallel algorithm finds the least edit
distance of the whole item to a part of the text.

Items are taken in blocks of bounded size (``BLOCK_ITEMS``, ``BLOCK_CHARS``); a larger benchmark takes more passes, not more memory.

Defined results: items that are null or have no letter or digit match nothing; null and empty texts match nothing; texts of
any length are read whole; each match is given once for each (document row, item) with the least distance, of equal ones the
leftmost; repeated rows each keep their matches, repeated items count once; an empty table on either side gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import read
from fieldlens.llm._text import blocks

ERROR_RATE = 0.06
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000

_GAPS = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    return _GAPS.sub(" ", (text or "").lower()).strip()


def budget(n: int, rate: float) -> int:
    return int(rate * n)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item in edits + 1 pieces of near-equal length, with their places."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of pattern to any part of text, and the first place where such a part ends; None beyond ``most``."""
    n = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        v = eq | minus
        h = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(h | plus) & full, plus & h
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(v | up) & full, up & v
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


class Matcher:
    """All items of a block, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, f" {text} ", budget(len(text), rate)) for i, text in ((i, normalise(t)) for i, t in items) if text]
        self.automaton = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, edits) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                places.setdefault(piece, []).append((number, at))
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) for each item that the normalised text holds."""
        if not self.items or not text:
            return
        text = f" {text} "
        spots: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, at in where:
                spots.setdefault(number, set()).add(end + 1 - length - at)
        for number, starts in sorted(spots.items()):
            item_id, item, edits = self.items[number]
            found = self._best(text, item, edits, sorted(starts))
            if found:
                distance, start, end = found
                yield item_id, distance, min(start, len(text) - 2), max(end - 2, 0)  # without the added spaces

    @staticmethod
    def _best(text: str, item: str, edits: int, starts: list[int]) -> tuple[int, int, int] | None:
        at = text.find(item)
        if at >= 0:
            return 0, at, at + len(item)
        if not edits:
            return None
        best, past = None, -1
        windows: list[list[int]] = []
        for s in starts:  # places near each other share a window
            a, b = max(0, s - edits), min(len(text), s + len(item) + edits)
            if windows and a <= windows[-1][1] - len(item):
                windows[-1][1] = max(windows[-1][1], b)
            else:
                windows.append([a, b])
        for a, b in windows:
            got = myers(item, text[a:b], edits if best is None else best[0] - 1)
            if got:
                end = a + got[1]
                back = myers(item[::-1], text[max(a, end - len(item) - edits) : end][::-1], got[0])
                best = (got[0], end - (back[1] if back else len(item)), end)
        return best


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks that fit into a worker's memory."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("length(text) > 0")
    extent = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    number = max(1, -(-extent["n"] // BLOCK_ITEMS), -(-extent["chars"] // BLOCK_CHARS))
    for block in range(number):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == block).distinct()
        yield [(r["item_id"], r["text"]) for r in mine.orderBy("item_id", "text").collect()]  # bounded by the block's size


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """(doc_id, item_id, distance, start, end) for every row of docs(doc_id, text) and item of benchmark(item_id, text) it holds."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names, kinds = ["doc_id", "item_id", "distance", "start", "end"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def leaks(items: list[tuple[int, str]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in blocks(batches, "text"):
                out: list[list] = [[], [], [], [], []]
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    for match in matcher.find(normalise(text)):
                        for column, value in zip(out, (doc_id, *match)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

        return texts.mapInArrow(run, "doc_id long, item_id long, distance int, start long, end long")

    return reduce(DataFrame.union, map(leaks, _item_blocks(benchmark)))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of docs(text, ...) that hold no item of benchmark(item_id, text)."""
    for items in _item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, rate)
            for batch in blocks(batches, "text"):
                yield batch.filter(pa.array([next(matcher.find(normalise(t)), None) is None for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLE: dict[str, str] = {}
