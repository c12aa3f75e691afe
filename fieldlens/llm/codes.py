"""Vector code compression: product quantisation in whole numbers, with segment-mean lower bounds.

Components become integers, vectors are cut into ``PARTS`` equal consecutive parts, and each part position has a codebook of
``ENTRIES`` entries, at first the parts of the vectors with the smallest ids. Each of ``ROUNDS`` rounds assigns every part to the nearest entry of its
codebook and moves every entry to the floor of its parts' mean. A round is one pass over the vectors: tasks hold the codebooks, send sums and
counts for each entry, and Spark adds these up, so what reaches the driver is as large as the codebooks, whatever the number of rows.

Assignment does not compare each part with each entry in full. Two segments of m components with sums s and t, and residuals r and q
from their block means, are at least (s - t)^2 / m + (|r| - |q|)^2 apart (squared). Block sums are taken coarse to fine: one block, two, four. At
each level the entries whose bound exceeds an exact distance already known (to the entry with the least coarse bound) are dropped; bounds are lowered by
more than their rounding, so no nearest entry is dropped. Survivors get exact integer distances; ties go to the lower index.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do those whose length is not the most frequent one that
can be cut into ``PARTS``; integers are held to a range (``largest``: +-2^27 for up to 64 dimensions, so components beyond +-32,768) whose distances fit a long; repeated rows count as often as they stand
there, repeated ids of the first entries are ordered by their vectors, and null ids come last; fewer vectors than entries make smaller
codebooks; null labels are one label; a sum over a label that exceeds a long is null; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, read
from fieldlens.llm._vectors import complete, matrix, scaled

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
BROADCAST_LABELS = 100_000
BLOCK_ROWS = 8192


def largest(dim: int) -> int:
    """The power of two that no integer exceeds, so that a squared distance over dim components stays below 2^62."""
    return 1 << (60 - (dim - 1).bit_length()) // 2


def _levels(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Coarse to fine: block sums (rows, blocks), norms of the residuals from the block means, and the blocks' size."""
    width = x.shape[1]
    wanted = [b for b in (1, 2, 4) if width % b == 0 and b < width]
    out = []
    for blocks in wanted:
        size = width // blocks
        cut = x.reshape(len(x), blocks, size).astype(np.float64)
        sums = cut.sum(2)
        rest = cut - (sums / size)[:, :, None]
        out.append((sums, np.sqrt((rest**2).sum((1, 2))), size))
    return out


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x (long) the index of its nearest row in book and the exact squared distance; ties go to the lower index."""
    best = np.zeros(len(x), np.int64)
    distance = np.zeros(len(x), np.int64)
    entry_levels = _levels(book)
    for at in range(0, len(x), BLOCK_ROWS):
        rows = x[at : at + BLOCK_ROWS]
        n = np.arange(len(rows))
        limit = np.full(len(rows), np.inf)
        i, j = np.repeat(n, len(book)), np.tile(np.arange(len(book)), len(rows))  # pairs that are not ruled out yet
        for level, ((sums, norms, size), (entry_sums, entry_norms, _)) in enumerate(zip(_levels(rows), entry_levels)):
            bound = ((sums[i] - entry_sums[j]) ** 2).sum(1) / size + (norms[i] - entry_norms[j]) ** 2
            bound = bound * (1 - 1e-9) - 1e-9 * (norms[i] + entry_norms[j] + 1) ** 2
            if level == 0:
                likely = bound.reshape(len(rows), len(book)).argmin(1)
                limit = ((rows - book[likely]) ** 2).sum(1).astype(np.float64)
            keep = bound <= limit[i] * (1 + 1e-9)
            i, j = i[keep], j[keep]
        exact = ((rows[i] - book[j]) ** 2).sum(1)
        order = np.lexsort((j, exact, i))
        first = order[np.concatenate([[True], np.diff(i[order]) > 0])] if len(order) else order
        best[at + i[first]], distance[at + i[first]] = j[first], exact[first]
    return best, distance


def _assigned(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Indices and squared distances, one column a part."""
    width = x.shape[1] // len(books)
    found = [nearest_entries(np.ascontiguousarray(x[:, p * width : (p + 1) * width]), book) for p, book in enumerate(books)]
    return np.stack([b for b, _ in found], 1), np.stack([d for _, d in found], 1)


def _moved(rows: DataFrame, books: list[np.ndarray], dim: int) -> list[np.ndarray]:
    """The codebooks after one round; entries that no part uses stay."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # PARTS x ENTRIES x width numbers
    width = dim // len(books)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), width + 1), np.int64) for b in shared.value]
        for batch in batches:
            x = matrix(batch.column("x"), dim)
            best, _ = _assigned(x, shared.value)
            for p, total in enumerate(totals):
                part = x[:, p * width : (p + 1) * width]
                for e in np.unique(best[:, p]):
                    mine = part[best[:, p] == e]
                    total[e, :width] += mine.sum(0)
                    total[e, width] += len(mine)
        cells = [(p, e, total[e].tolist()) for p, total in enumerate(totals) for e in np.flatnonzero(total[:, width])]
        part, entry, sums = (list(c) for c in zip(*cells)) if cells else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(sums, pa.list_(pa.int64()))], ["part", "entry", "sums"])

    met = rows.select("x").mapInArrow(summed, "part int, entry int, sums array<long>").select("part", "entry", F.posexplode("sums").alias("at", "value"))
    totals = met.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    sums = {(r["part"], r["entry"], r["at"]): int(r["value"]) for r in totals}
    moved = [b.copy() for b in books]
    for (p, e, at), value in sums.items():
        if at < width:
            moved[p][e, at] = value // sums[p, e, width]
    shared.unpersist()
    return moved


def compress(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for each usable row of vectors(vec_id, vector, label)."""
    spark = vectors.sparkSession
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("given"), F.col(label).alias("label"))
    usable, dim = complete(given, "given", F.col("n") % PARTS == 0)
    if not dim:
        dim = PARTS
    rows = materialize(usable.select("vec_id", "label", scaled(F.col("v"), SCALE, 0, largest(dim)).alias("x")))
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).select("x").toArrow()
    x = matrix(first.column("x"), dim) if first.num_rows else np.zeros((0, dim), np.int64)
    width = dim // PARTS
    books = [np.ascontiguousarray(x[:, p * width : (p + 1) * width]) for p in range(PARTS)]
    if len(x):
        for _ in range(ROUNDS):
            books = _moved(rows, books, dim)
    digest = hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()
    shared = spark.sparkContext.broadcast(books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, distance = _assigned(matrix(batch.column("x"), dim), shared.value)
            code = pa.array(["".join(f"{e:02x}" for e in row) for row in best.tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), code, pa.array(distance.sum(1))], ["vec_id", "label", "code", "error"])

    kind = dict(rows.dtypes)["label"]
    found = materialize(rows.mapInArrow(coded, f"vec_id long, label {kind}, code string, error long"))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = found.groupBy("label").agg(F.when(total <= (1 << 63) - 1, total).cast("long").alias("label_error")).withColumnRenamed("label", "of")
    sums = F.broadcast(sums) if found.select("label").distinct().limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS else sums
    out = found.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds as chained tables: b0 to b6 are the codebooks, a0 to a6 the assignments."""
    steps = [
        "kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda e: floor(4096 * e::DOUBLE)::BIGINT) AS x FROM embeddings WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e))))",
        "parts AS MATERIALIZED (SELECT r, p::INT AS p, x[p * len(x) // 8 + 1 : (p + 1) * len(x) // 8] AS x FROM kept, range(8) t(p))",
        "b0 AS MATERIALIZED (SELECT p, (r - 1)::INT AS e, x FROM parts WHERE r <= 16)",
    ]
    for i in range(ROUNDS + 1):
        distance = "list_sum(list_transform(range(1, len(parts.x) + 1), lambda i: (parts.x[i] - b.x[i]) * (parts.x[i] - b.x[i])))::BIGINT"
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, parts.p, arg_min(b.e, ({distance}, b.e)) AS e, min({distance}) AS d FROM parts JOIN b{i} b USING (p) GROUP BY 1, 2)")
        if i < ROUNDS:
            # (s - (s mod n)) / n with a modulus that is never negative is the floor
            steps.append(f"s{i} AS (SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{i} JOIN parts USING (r, p), range(1, len(x) + 1) t(i) GROUP BY 1, 2, 3)")
            steps.append(f"m{i} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{i} GROUP BY 1, 2)")
            steps.append(f"b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m USING (p, e))")
    last = f"a{ROUNDS}"
    steps.append(f"c AS (SELECT r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM {last} GROUP BY r)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN c USING (r), h"


QUERIES = {"op12_vector_codes": op12_vector_codes}
ORACLE = {"op12_vector_codes": _sql()}
