"""Embedding whitening: matrix-free block subspace iteration.

Components become integers x, so sums, and with them the centre, are exact. A block Q of orthonormal columns is improved
in passes over the vectors: each computes X'(XQ) on centred rows without forming the covariance V (tasks add up their rows' share, Spark
adds up the tasks'), and from V Q come the Rayleigh-Ritz values and vectors (of Q'VQ), their residuals |Vy - ey|, and by QR the next block. The passes
end when residuals certify every wanted component: to ``TOLERANCE`` of the trace, divided by nothing else, as rounding allows no less.

The block begins with twice as many columns as components. The Ritz values tell how fast it converges, by the ratio of the value behind the block to
the last wanted one; where that promises more than ``PASSES_AHEAD`` further passes the block is doubled (``WIDEST`` columns at most, or
the dimension). A block as wide as the vectors spans everything, so its first pass is exact; embeddings whose spectrum is almost flat end so.
What a pass sends to the driver is dimension x block numbers, whatever the number of rows.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do those of a length other than the most frequent;
integers are held to +-2^40; repeated rows and null ids count like all others; components without variance (below rounding: ``NO_VARIANCE`` of the trace) are not
returned, so that fewer than k are where vectors span less, and none for a single vector; equal eigenvalues may come with any basis of
their space; deviation is null where the exact sum exceeds a long; an empty table gives an empty result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, read
from fieldlens.llm._vectors import complete, matrix, scaled

COMPONENTS = 8
SCALE, OFFSET, MOST = 1024, 100_000, 1 << 40
TOLERANCE = 1e-13  # of the trace, for each residual
NO_VARIANCE = 1e-12
PASSES, PASSES_AHEAD, WIDEST = 400, 8, 512


def centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - S/n with one rounding: the integer part of the difference is exact."""
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype(np.float64) - rest / n


def _total(rows: DataFrame, share, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all rows of share(x), a matrix of the given shape, for integer matrices x of rows."""
    dim = shape[0]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                mine = share(batch)
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    cells = rows.mapInArrow(part, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "value"))
    out = np.zeros(shape)
    for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow().to_pylist():
        out[r["i"], r["j"]] = r["value"]
    return out


def principal(rows: DataFrame, sums: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvectors (columns) and eigenvalues, falling, of the covariance of rows(x), and its trace."""
    dim = len(sums)
    spark = rows.sparkSession
    random = np.random.default_rng(11)
    block = min(dim, 2 * k)
    q = np.linalg.qr(random.standard_normal((dim, block)))[0] if block < dim else np.eye(dim)
    trace = float("nan")
    for _ in range(PASSES):
        shared = spark.sparkContext.broadcast((q, sums, n))

        def share(batch: pa.RecordBatch) -> np.ndarray:
            basis, s, count = shared.value
            x = centred(matrix(batch.column("x"), len(s)), s, count)
            return np.hstack([x.T @ (x @ basis), (x * x).sum(0)[:, None]])

        got = _total(rows.select("x"), share, (dim, block + 1)) / n
        shared.unpersist()
        vq, trace = got[:, :block], float(got[:, block].sum())
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        y, vy = q @ turn, vq @ turn
        wanted = min(k, block)
        residuals = np.linalg.norm(vy[:, :wanted] - y[:, :wanted] * values[:wanted], axis=0)
        if block == dim or residuals.max() <= TOLERANCE * trace:
            return y[:, :wanted], values[:wanted], trace
        ratio = values[-1] / values[wanted - 1] if values[wanted - 1] > 0 else 0.0
        ahead = np.log(TOLERANCE * trace / residuals.max()) / np.log(ratio) if 0 < ratio < 1 else (0 if ratio <= 0 else np.inf)
        q = np.linalg.qr(vy)[0]
        if ahead > PASSES_AHEAD and block < min(dim, WIDEST):
            block = min(dim, 2 * block, WIDEST)
            q = np.eye(dim) if block == dim else np.linalg.qr(np.hstack([q, random.standard_normal((dim, block - q.shape[1]))]))[0]
    raise ArithmeticError(f"{PASSES} passes did not certify {k} components; raise WIDEST or TOLERANCE")


def _fits(deviation: np.ndarray) -> pa.Array:
    """Exact sums of squares, null where a long can't hold them."""
    rough = (deviation.astype(np.float64) ** 2).sum(1)
    safe = rough < 2.0**62
    held = np.where(safe[:, None], deviation, 0)
    out = (held * held).sum(1)
    exact = {i: sum(int(d) ** 2 for d in deviation[i]) for i in np.flatnonzero(~safe & (rough < 2.0**64))}
    values = [exact.get(i, 1 << 63) if not safe[i] else int(out[i]) for i in range(len(out))]
    return pa.array([v if v < 1 << 63 else None for v in values], pa.int64())


def whiten(vectors: DataFrame, k: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: k rows for each usable row of vectors(vec_id, vector)."""
    spark = vectors.sparkSession
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("given"))
    usable, dim = complete(given, "given")
    rows = materialize(usable.select("vec_id", scaled(F.col("v"), SCALE, OFFSET, MOST).alias("x")))
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    n = rows.count()
    if not n:
        return spark.createDataFrame([], kinds)
    total = F.sum(F.col("value").cast("decimal(38,0)"))
    met = rows.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(total.alias("total")).orderBy("at").collect()  # one row a dimension
    sums = np.array([int(r["total"]) for r in met], np.int64)
    vectors_, values, trace = principal(rows, sums, n, k)
    kept = values > NO_VARIANCE * trace if trace > 0 else np.zeros(len(values), bool)
    if not kept.any():
        return spark.createDataFrame([], kinds)
    turn, values = vectors_[:, kept] / np.sqrt(values[kept]), values[kept]
    found = len(values)
    shared = spark.sparkContext.broadcast((turn, sums, n))

    def squares(batch: pa.RecordBatch) -> np.ndarray:
        basis, s, count = shared.value
        w = centred(matrix(batch.column("x"), len(s)), s, count) @ basis
        return np.hstack([w.T @ w, w.sum(0)[:, None]])

    got = _total(rows.select("x"), squares, (found, found + 1)) / n
    mean = got[:, found]
    error = float(np.abs(got[:, :found] - np.outer(mean, mean) - np.eye(found)).max())
    explained = (values / trace).tolist()

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, s, count = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x = matrix(batch.column("x"), len(s))
                w = centred(x, s, count) @ basis
                # beyond this the product does not fit a long: such a row's sum does not either
                far = np.abs(x.astype(np.float64) * count - s).max(1) >= 2.0**62
                deviation = np.where(far[:, None], 1 << 62, np.where(far[:, None], 0, x) * count - s)
                row = np.repeat(np.arange(len(x)), found)
                component = np.tile(np.arange(found), len(x))
                columns = [batch.column("vec_id").take(pa.array(row)), pa.array((component + 1).astype(np.int32)), pa.array(np.full(len(row), count)), _fits(deviation).take(pa.array(row)), pa.array(w.ravel())]
                columns += [pa.array(np.array(explained)[component]), pa.array(np.full(len(row), error))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(projected, kinds)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {"op13_whitening": op13_whitening}
ORACLE: dict[str, str] = {}
