"""Keyed de-duplication by windows; every order is total, so results do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key by an order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__r", rank).where("__r = 1").drop("__r")


def last_wins(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of each key that came last."""
    return first_by(df, keys, F.desc(seq))


def keep_min_rank(df: DataFrame, keys: list[str], rank: str, seq: str) -> DataFrame:
    """The row of each key with the smallest numeric rank; text that is no number counts as infinite, ties go to the first."""
    number = F.col(rank).cast("string").try_cast("double")
    return first_by(df, keys, F.coalesce(number, F.lit(float("inf"))), F.col(seq))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; maps are compared by their sorted entries."""
    maps = [f.name for f in df.schema if f.dataType.typeName() == "map"]
    if not maps:
        return df.dropDuplicates()
    keyed = df.withColumns({f"__{m}": F.array_sort(F.map_entries(m)) for m in maps})
    rest = [c for c in df.columns if c not in maps]
    return keyed.dropDuplicates(rest + [f"__{m}" for m in maps]).select(*df.columns)
