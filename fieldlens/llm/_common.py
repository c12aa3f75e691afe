"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.session import shared_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def literal_rows(spark: SparkSession, rows: list[tuple], names: list[str], kinds: list[str]) -> DataFrame:
    """A small table of constants, made by the JVM alone."""
    value = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
    cells = F.array(*(F.struct(*(value(v).cast(k).alias(n) for v, n, k in zip(row, names, kinds))) for row in rows))
    empty = F.lit(None).cast(f"array<struct<{','.join(f'{n}:{k}' for n, k in zip(names, kinds))}>>")
    return spark.range(1).select(F.inline(cells if rows else empty))


#: Tables written since ``scratch`` was entered, oldest first; outside of it tables stay until Python ends.
_written: ContextVar[list[tuple] | None] = ContextVar("written", default=None)


def _drop(files: Any, path: Any) -> None:
    try:
        files.delete(path, True)
    except Exception:  # the JVM may have ended before; the table is only scratch space
        pass


def materialize(df: DataFrame) -> DataFrame:
    """Write df once into the shared folder and read it back: lineage is cut, and lost executors lose nothing.

    The table is deleted when Python ends, even if the session was stopped before, or earlier by ``scratch``.
    """
    spark = df.sparkSession
    name = f"{shared_dir(spark)}/fieldlens-{uuid.uuid4().hex}"
    df.write.parquet(name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    atexit.register(_drop, files, path)
    if (written := _written.get()) is not None:
        written.append((files, path))
    return spark.read.schema(df.schema).parquet(name)


@contextmanager
def scratch() -> Iterator[Callable[[], None]]:
    """Gives a function that deletes the tables materialized so far within it, but for the last one, which the caller goes on with."""
    mine: list[tuple] = []
    outer = _written.set(mine)

    def free() -> None:
        for files, path in mine[:-1]:
            _drop(files, path)
        del mine[:-1]

    try:
        yield free
    finally:
        _written.reset(outer)


def rank_in_buckets(df: DataFrame, group: list[str], bucket: str, order: list[str], out: str) -> DataFrame:
    """Zero-based rank of each row within ``group`` by ``order``, without one task holding a whole group.

    ``bucket`` is a non-null integer column that never falls along ``order``. Rows are ranked inside
    (group, bucket); the buckets' row counts, a small table, are summed to give each bucket its start.
    """
    keys = [*group, bucket]
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*group) if group else Window.partitionBy()
    starts = counts.withColumn(
        "__start", F.coalesce(F.sum("__n").over(before.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("__n")
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("__local", local.cast("long")).join(starts, keys).withColumn(out, F.col("__local") + F.col("__start")).drop("__local", "__start")
