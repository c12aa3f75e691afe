"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Lengths are whole numbers up to the sequence length, so the plan needs only how many pieces have each length. A
pattern (a multiset of lengths) is built like one bin: filled greedily, longest first, then its smallest document
is replaced by the two unpacked ones that fill the gap so widened most tightly. The pattern is used as often as
the counts allow, so the plan has some thousands of patterns at any corpus size. Pieces are then dealt to
the patterns' places by their rank among the pieces of the same length.

Documents longer than a sequence are cut; the first piece is the remainder, and all others fill a sequence alone.

Defined results: null text counts as empty and packs as its end mark alone; repeated rows each keep their pieces;
a null doc_id is kept; pieces of equal length are interchangeable, so ties only choose between equally good places; texts of any length
are tokenised whole; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, rank_in_buckets, read
from fieldlens.llm._text import blocks

LENGTH = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
ROWS_PER_BUCKET = 2_000
MOST_BUCKETS = 4_096


def _encoder(tokenizer: str | None):
    """A function from a text to its ids. The faster library has the same vocabulary and pattern; the file's own one stands in where it gives up."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = tokenizer or public_tokenizers.path(TOKENIZER)
    exact = Tokenizer.from_file(path)
    exact.encode_special_tokens = True

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if tokenizer is not None:
        return slow
    lines = open(public_tokenizers.path(TOKENIZER.replace(".json", ".tiktoken")), "rb")
    with lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:  # the library's own panic is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return slow(text)

    return encode


def tokenized_pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of docs(doc_id, text): doc_id, piece, start, length, ids_crc32, and the ids themselves where asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in blocks(batches, "text"):
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], "<u4")
                at, piece = 0, 0
                while at < len(ids):
                    to = at + ((len(ids) - at - 1) % length + 1 if at == 0 else length)
                    part = ids[at:to]
                    for column, value in zip(out, (doc_id, piece, at, len(part), zlib.crc32(part.tobytes()), part.tolist() if with_ids else None)):
                        column.append(value)
                    at, piece = to, piece + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + with_ids], names[: 5 + with_ids])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def plan_patterns(counts: np.ndarray, length: int) -> list[tuple[int, list[int]]]:
    """(how often, lengths) of each pattern; counts[s] pieces have length s. Every piece is placed once."""
    left = counts.astype(np.int64).copy()
    plan = []
    while left.any():
        used: dict[int, int] = {}
        gap = length

        def spare(s: int) -> int:
            return int(left[s]) - used.get(s, 0)

        size = gap
        while gap:  # longest first
            there = np.flatnonzero(left[1 : min(size, gap) + 1]) + 1
            there = [s for s in there[::-1][:8] if spare(s) > 0] or [s for s in there[::-1] if spare(s) > 0]
            if not there:
                break
            size = int(there[0])
            used[size] = used.get(size, 0) + 1
            gap -= size
        if gap and used:
            smallest = min(used)
            room = gap + smallest
            free = np.maximum(left, 0)
            for s, n in used.items():
                free[s] -= n
            best, pair = smallest, None
            sizes = np.flatnonzero(free[: room + 1])
            sizes = sizes[sizes > 0]
            if len(sizes):
                there = np.zeros(room + 1, bool)
                there[sizes] = True
                for total in range(room, smallest, -1):  # the tightest first
                    other = total - sizes
                    fit = sizes[(other >= sizes) & there[np.maximum(other, 0)]]
                    fit = [int(a) for a in fit if a != total - a or free[a] >= 2]
                    if fit:
                        best, pair = total, (fit[-1], total - fit[-1])
                        break
            if pair and best > smallest:
                used[smallest] -= 1
                for s in pair:
                    used[s] = used.get(s, 0) + 1
                used = {s: n for s, n in used.items() if n}
        times = min(int(left[s]) // n for s, n in used.items())
        for s, n in used.items():
            left[s] -= times * n
        plan.append((times, sorted((s for s, n in used.items() for _ in range(n)), reverse=True)))
    return plan


def _placements(plan: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """For each length and pattern: from which rank on it takes pieces, how many a bin, its first sequence, and the place in the bin."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, sizes in plan:
        offset = 0
        for s in sorted(set(sizes), reverse=True):
            n = sizes.count(s)
            rows.append((s, taken.get(s, 0), n, sequence, offset))
            taken[s] = taken.get(s, 0) + times * n
            offset += n * s
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "each", "sequence", "offset"), table.T))


def pack_documents(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, with_ids: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Pack docs(doc_id, text): every piece with its sequence and its offset there."""
    pieces = materialize(tokenized_pieces(docs, length, tokenizer, with_ids))
    found = pieces.groupBy("length").count().collect()  # one row for each length at most
    counts = np.zeros(length + 1, np.int64)
    for r in found:
        counts[r["length"]] = r["count"]
    places = _placements(plan_patterns(counts, length))
    step = int(counts.max()) + 1
    starts = places["length"] * step + places["rank"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(starts, size * step + rank, "right") - 1
            past = rank - places["rank"][at]
            each = places["each"][at]
            cells = {c: batch.column(c) for c in batch.schema.names if c != "rank"}
            cells["sequence_id"] = pa.array(places["sequence"][at] + past // each)
            cells["offset"] = pa.array(places["offset"][at] + past % each * size)
            yield pa.RecordBatch.from_pydict(cells)

    buckets = min(MOST_BUCKETS, max(16, int(counts.sum()) // rows_per_bucket))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    ranked = rank_in_buckets(spread, ["length"], "bucket", ["doc_id", "piece", "ids_crc32"], "rank").drop("bucket")
    columns = [c for c in pieces.columns]
    kinds = ", ".join(f"{c} {dict(pieces.dtypes)[c]}" for c in columns) + ", sequence_id long, offset long"
    return ranked.select(*columns, "rank").mapInArrow(deal, kinds)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


QUERIES = {"op5_packing": op5_packing}
ORACLE: dict[str, str] = {}
