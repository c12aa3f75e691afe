"""Snapshots, versions and keyed writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_values(df: DataFrame, name: str) -> DataFrame:
    """Rows with the largest numeric value of a column."""
    number = F.col(name).cast("string").try_cast("double")
    top = df.agg(F.max(number).alias("__top"))
    return df.join(F.broadcast(top), number == F.col("__top")).drop("__top")


def latest_per_group(df: DataFrame, group: str, *order: str) -> DataFrame:
    """In each group, keep the rows of the largest first column, then of the largest second one among them, and so on.

    That is the largest tuple, so one aggregate with partial maxima finds it, and a group of any size stays spread out.
    """
    top = df.groupBy(F.col(group).alias("__group")).agg(F.max(F.struct(*order)).alias("__top"))
    return df.join(top, F.col(group).eqNullSafe(F.col("__group")) & F.struct(*order).eqNullSafe(F.col("__top")), "left_semi")


def latest_relabelled(df: DataFrame, group: str, period: str) -> DataFrame:
    """Each group's latest period, labelled with the latest of all."""
    top = df.agg(F.max(period).alias("__all"))
    return latest_per_group(df, group, period).crossJoin(F.broadcast(top)).withColumn(period, F.col("__all")).drop("__all")


def known(df: DataFrame, reference: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key a reference table has, and those it has not."""
    keys = reference.select(key).where(F.col(key).isNotNull()).distinct()
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def append_version(current: DataFrame, incoming: DataFrame, scope: list[str]) -> DataFrame:
    """Incoming rows get the next version of their scope and become current; older rows of those scopes no longer are.

    Scopes are compared null-safely.
    """
    had = current.groupBy(*scope).agg(F.max("version").alias("__v"))
    same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in scope]
    new = incoming.alias("i").join(had.alias("h"), [F.col(f"i.{c}").eqNullSafe(F.col(f"h.{c}")) for c in scope], "left")
    new = new.select("i.*", (F.coalesce("h.__v", F.lit(0)) + 1).cast("int").alias("version"), F.lit(True).alias("is_current"))
    touched = incoming.select(*scope).distinct().withColumn("__touched", F.lit(True))
    old = current.alias("c").join(touched.alias("t"), [F.col(f"c.{c}").eqNullSafe(F.col(f"t.{c}")) for c in scope], "left")
    old = old.select(*[f"c.{c}" for c in current.columns if c != "is_current"], (F.col("c.is_current") & F.col("t.__touched").isNull()).alias("is_current"))
    return old.unionByName(new, allowMissingColumns=True)


def version_history(df: DataFrame, scope: list[str]) -> DataFrame:
    """Rows of each version of a scope."""
    return df.groupBy(*scope, "version").agg(F.count("*").alias("n"), F.max("is_current").alias("is_current"))


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows that incoming does not replace, and incoming; without keys, an insert."""
    kept = target.join(incoming.select(*keys).distinct(), keys, "left_anti") if keys else target
    return kept.unionByName(incoming, allowMissingColumns=True)


def clear_except(df: DataFrame, name: str, guard: object) -> DataFrame:
    """What stays of a table after deleting all rows whose column differs from the guard (nulls stay)."""
    return df.where(F.col(name).isNull() | (F.col(name) == guard))


def insert_new(target: DataFrame, incoming: DataFrame, key: str, seq: Column | str) -> DataFrame:
    """The incoming rows whose key the target lacks, the first of each key."""
    fresh = incoming.join(target.select(key).distinct(), key, "left_anti")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(seq))
    return fresh.withColumn("__r", rank).where("__r = 1").drop("__r")


def position_rollup(df: DataFrame) -> DataFrame:
    """Players by position group for each team, and in all."""
    group = F.lit("OTH")
    for name, codes in reversed(POSITION_GROUPS.items()):
        group = F.when(F.upper("position").isin(*codes), F.lit(name)).otherwise(group)
    counted = df.withColumn("grp", group).groupBy("team").pivot("grp", [*POSITION_GROUPS, "OTH"]).count().na.fill(0)
    return counted.withColumn("total", sum((F.col(c) for c in [*POSITION_GROUPS, "OTH"]), F.lit(0)))


# Position codes of each group.
POSITION_GROUPS = {
    "QB": ["QB"],
    "RB": ["RB", "FB", "HB"],
    "WR": ["WR"],
    "TE": ["TE"],
    "OL": ["OL", "C", "G", "T", "LT", "LG", "RG", "RT", "OT", "OG"],
    "DL": ["DL", "DT", "DE", "NT", "EDGE"],
    "LB": ["LB", "ILB", "OLB", "MLB"],
    "DB": ["DB", "CB", "S", "FS", "SS", "NB"],
    "ST": ["K", "P", "LS", "KR", "PR"],
}


def starters(df: DataFrame) -> DataFrame:
    """For each team, the first player of rank 1 at the main positions, and how many entries it has."""
    first = lambda p: F.min_by("player", F.when((F.col("pos") == p) & (F.col("pos_rank") == "1"), F.col("seq")))
    return df.groupBy("team").agg(*(first(p).alias(p.lower()) for p in ("QB", "RB", "WR", "TE")), F.count("*").alias("entries"))
