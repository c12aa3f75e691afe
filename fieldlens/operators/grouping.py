"""Story groups by vector similarity (family E).

All-pairs work is done in blocks of a grid: each row goes to as many cells as the grid has columns, a cell is
one numpy product, and only pairs at or above the threshold (or a cell's sums) leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.vectors import cosine, unit

THRESHOLD = 0.88
MERGE_THRESHOLD, MERGE_PAIRS = 0.92, 200
BLOCK_ROWS = 2_000
GRID_ROWS = 6_000  # rows of a block of the grid of pairs
BROADCAST_NUMBERS = 4_000_000  # 32 MB of centroids


def of_one_length(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has the most frequent length (of equally frequent ones the smaller); null vectors fall away."""
    sized = df.where(F.col(vector).isNotNull())
    common = sized.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return sized.where(F.size(vector) == (common["n"] if common else 0))


def centroids(df: DataFrame, key: str, vector: str, normalised: bool = True, order: str | None = None) -> DataFrame:
    """Mean vector of each key, scaled to length 1 unless pooled.

    Vectors of another length than the key's first by ``order`` (the shortest one without it) are skipped, and so are null ones.
    """
    size = F.size(vector)
    sized = df.where(F.col(vector).isNotNull()).withColumn("__size", size)
    first = sized.groupBy(key).agg((F.min("__size") if order is None else F.min(F.struct(order, "__size"))["__size"]).alias("__first"))
    at = sized.join(first, key).where("__size = __first").select(key, F.posexplode(vector).alias("pos", "x"))
    mean = at.groupBy(key, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    out = mean.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))
    return out.withColumn("centroid", unit(F.col("centroid"))) if normalised else out


def weighted_update(base: Column, count: Column, vectors_sum: Column, n: Column) -> Column:
    """The centroid of a stored group (weight: its members) and n new vectors (weight 1 each), scaled to length 1."""
    return unit(F.zip_with(F.transform(base, lambda x: x * count), vectors_sum, lambda a, b: (a + b) / (count + n)))


def _grid(df: DataFrame, n_blocks: int, id_col: str) -> DataFrame:
    block = F.pmod(F.xxhash64(id_col), F.lit(n_blocks)).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.lit(n_blocks - 1)), lambda j: F.struct(F.least(block, j).alias("lo"), F.greatest(block, j).alias("hi")))
    return df.withColumn("block", block).withColumn("cell", F.explode(F.array_distinct(cells)))


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.vstack(vectors).astype(float)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _similar(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    nx, ny = np.linalg.norm(x, axis=1, keepdims=True), np.linalg.norm(y, axis=1, keepdims=True)
    return np.clip((x / np.where(nx > 0, nx, 1)) @ (y / np.where(ny > 0, ny, 1)).T, 0.0, 1.0)


def similar_pairs(df: DataFrame, id_col: str, vector: str, threshold: float, blocks: int | None = None, places: int | None = None, most: int | None = None) -> DataFrame:
    """Pairs a < b of similarity at or above a threshold; vectors of an unusual length have no similarity to others.

    ``blocks`` is the least number of blocks: none is larger than ``GRID_ROWS`` rows or so, and a cell compares ``BLOCK_ROWS`` of them at a time, so its memory does not
    grow with the table. ``places`` rounds similarities; ``most`` keeps each cell's best pairs by (similarity down, a, b), which hold the best of all.
    """
    rows = of_one_length(df.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v")
    n = max(blocks or 1, -(-rows.count() // GRID_ROWS))

    def best(found: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
        a, b, sim = (np.concatenate(c) for c in zip(*found))
        first = np.lexsort((b, a, -sim))[:most]
        return [(a[first], b[first], sim[first])]

    def cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(batches))  # two blocks at most
        lo, hi = frame["cell"].iloc[0]["lo"], frame["cell"].iloc[0]["hi"]
        first, second = frame[frame["block"] == lo], frame[frame["block"] == hi]
        kept: list[tuple[np.ndarray, ...]] = []
        if len(first) and len(second):
            x, y = _units(first["v"]), _units(second["v"])
            ids_x, ids_y = first["id"].to_numpy(), second["id"].to_numpy()
            for r in range(0, len(x), BLOCK_ROWS):
                for c in range(r if lo == hi else 0, len(y), BLOCK_ROWS):
                    s = np.clip(x[r : r + BLOCK_ROWS] @ y[c : c + BLOCK_ROWS].T, 0.0, 1.0)
                    if lo == hi and r == c:
                        s[np.tril_indices(len(s))] = -1.0  # each pair once
                    i, j = np.nonzero(s >= max(threshold, 0.0))
                    ids_a, ids_b = ids_x[r + i], ids_y[c + j]
                    sim = s[i, j] if places is None else np.round(s[i, j], places)
                    pairs = tuple(p[ids_a != ids_b] for p in (np.minimum(ids_a, ids_b), np.maximum(ids_a, ids_b), sim))
                    if most is None:
                        yield pd.DataFrame(dict(zip(("a", "b", "sim"), pairs)))
                    else:
                        kept = best([*kept, pairs])
        for pairs in kept:
            yield pd.DataFrame(dict(zip(("a", "b", "sim"), pairs)))

    return _grid(rows, n, "id").groupBy("cell").applyInPandas(cell, "a long, b long, sim double")


def nearest_group(df: DataFrame, groups: DataFrame, threshold: float, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The most similar of some groups (group_id, centroid) for each row, the last of equals; none under the threshold.

    Centroids of ``BROADCAST_NUMBERS`` numbers at most go to every task as one matrix, and rows are not moved. Beyond that rows and groups are cut
    into blocks, and each block of rows meets each block of groups. Rows whose vector has another length than the centroids get none.
    """
    groups = of_one_length(groups.select("group_id", "centroid"), "centroid")
    n = groups.count()
    size = groups.select(F.size("centroid").alias("n")).first()
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("v"))
    if size and n * size["n"] <= BROADCAST_NUMBERS:
        found = _nearest_by_broadcast(rows, groups, size["n"])
        best = lambda f: F.col(f)
    else:
        alike = rows.where(F.size("v") == (size["n"] if size else -1))
        nearest = _nearest_in_blocks(alike, groups, max(n, 1)).groupBy("id").agg(F.max(F.struct("sim", "group_id")).alias("best"))
        found = rows.select("id").join(nearest, "id", "left")
        best = lambda f: F.col(f"best.{f}")
    return found.select(F.col("id").alias(id_col), F.when(best("sim") >= threshold, best("group_id")).alias("group_id"), best("sim").alias("sim"))


def _nearest_by_broadcast(rows: DataFrame, groups: DataFrame, dim: int) -> DataFrame:
    held = groups.select(F.col("group_id").cast("long").alias("g"), F.col("centroid").cast("array<double>").alias("c")).orderBy("g").toPandas()  # BROADCAST_NUMBERS at most
    shared = rows.sparkSession.sparkContext.broadcast((held["g"].to_numpy(), np.vstack(held["c"])))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, centres = shared.value
        for batch in batches:
            vectors = batch.column("v")
            fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), dim), False)
            own = vectors.filter(fits).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
            sim, group = np.full(batch.num_rows, np.nan), np.zeros(batch.num_rows, np.int64)
            at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
            for i in range(0, len(own), BLOCK_ROWS):
                s = np.round(_similar(own[i : i + BLOCK_ROWS], centres), 9)
                best = s.shape[1] - 1 - np.argmax(s[:, ::-1], axis=1)
                group[at[i : i + BLOCK_ROWS]], sim[at[i : i + BLOCK_ROWS]] = ids[best], s[np.arange(len(s)), best]
            none = np.isnan(sim)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(group, mask=none), pa.array(sim, mask=none)], ["id", "group_id", "sim"])

    return rows.mapInArrow(nearest, f"id {dict(rows.dtypes)['id']}, group_id long, sim double")


def _nearest_in_blocks(rows: DataFrame, groups: DataFrame, n_groups: int) -> DataFrame:
    across, down = -(-n_groups // BLOCK_ROWS), max(1, -(-rows.count() // BLOCK_ROWS))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = rows.withColumn("v", F.col("v").cast("array<double>")).withColumn("row", block("id", down)).withColumn("col", spread(across)).withColumn("centre", F.lit(False))
    right = groups.select(F.col("group_id").alias("id"), F.col("centroid").cast("array<double>").alias("v"), block("group_id", across).alias("col")).withColumn("row", spread(down)).withColumn("centre", F.lit(True))

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        own, centres = frame[~frame["centre"]], frame[frame["centre"]].sort_values("id")
        if own.empty or centres.empty:
            return pd.DataFrame({"id": [], "group_id": [], "sim": []}).astype({"id": "int64", "group_id": "int64", "sim": "float64"})
        s = np.round(_similar(np.vstack(own["v"]).astype(float), np.vstack(centres["v"]).astype(float)), 9)
        best = s.shape[1] - 1 - np.argmax(s[:, ::-1], axis=1)
        return pd.DataFrame({"id": own["id"].to_numpy(), "group_id": centres["id"].to_numpy()[best], "sim": s[np.arange(len(s)), best]})

    return left.unionByName(right).groupBy("row", "col").applyInPandas(cell, "id long, group_id long, sim double")


def cohesion(df: DataFrame, key: str, id_col: str, vector: str) -> DataFrame:
    """E5: mean similarity of the pairs of each group; 1 for fewer than two members.

    A group is cut into grid cells too, so a large one is spread over many tasks. Vectors of an unusual length take no part.
    """
    rows = of_one_length(df.select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.col(vector).alias("v")), "v")
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    dealt = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi")))
    dealt = dealt.withColumn("cell", F.explode(F.array_distinct(cells)))

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        lo, hi = frame["cell"].iloc[0]["lo"], frame["cell"].iloc[0]["hi"]
        a, b = frame[frame["block"] == lo], frame[frame["block"] == hi]
        total, n = 0.0, 0
        if len(a) and len(b):
            s = _similar(np.vstack(a["v"]).astype(float), np.vstack(b["v"]).astype(float))
            if lo == hi:
                total, n = float(np.triu(s, 1).sum()), len(a) * (len(a) - 1) // 2
            else:
                total, n = float(s.sum()), s.size
        return pd.DataFrame({"key": [frame["key"].iloc[0]], "total": [total], "n": [n]})

    kind = dict(rows.dtypes)["key"]
    sums = dealt.groupBy("key", "cell").applyInPandas(cell, f"key {kind}, total double, n long")
    return sums.groupBy("key").agg(F.coalesce(F.try_divide(F.sum("total"), F.sum("n")), F.lit(1.0)).alias("cohesion")).withColumnRenamed("key", key)


class Leader:
    """Online leader clustering. Each story joins the most similar group at or above the threshold (the last of equals), whose centroid moves, or opens one.

    Stored groups begin with their centroid times their member count. A fact that the group got in this run already, or, for a story without a fact, its URL, is not
    added again. What is held is one sum and one unit vector a group, in arrays that double as they fill, and the keys of this run.
    """

    def __init__(self, threshold: float = THRESHOLD, stored: list[tuple[np.ndarray, int]] | None = None):
        self.threshold, self.n = threshold, 0
        self.sums = self.units = np.zeros((0, 0))
        self.counts: list[int] = []
        self.facts: list[set] = []
        self.urls: list[set] = []
        for centroid, count in stored or []:
            self._open(np.asarray(centroid, float) * max(count, 1), count)

    @classmethod
    def resumed(cls, threshold: float, sums: list, counts: list[int]) -> Leader:
        """Groups as an earlier run left them, to the last digit."""
        leader = cls(threshold)
        for total, count in zip(sums, counts):
            leader._open(np.asarray(total, float), count)
        return leader

    def _open(self, total: np.ndarray, count: int) -> None:
        if self.n == len(self.sums):
            grown = np.zeros((max(16, 2 * self.n), len(total)))
            units = grown.copy()
            if self.n:
                grown[: self.n], units[: self.n] = self.sums[: self.n], self.units[: self.n]
            self.sums, self.units = grown, units
        self.n += 1
        self.counts.append(count)
        self.facts.append(set())
        self.urls.append(set())
        self._set(self.n - 1, total)

    def _set(self, group: int, total: np.ndarray) -> None:
        length = np.linalg.norm(total)
        self.sums[group], self.units[group] = total, total / length if length > 0 else total

    def assign(self, url: object, vector: np.ndarray, fact: object = None) -> tuple[int, float, bool]:
        """The group, the similarity to its centroid before, and whether the story was added."""
        vector = np.asarray(vector, float)
        if self.n:
            length = np.linalg.norm(vector)
            s = np.clip(self.units[: self.n] @ (vector / (length if length > 0 else 1)), 0.0, 1.0)
            best = len(s) - 1 - int(np.argmax(s[::-1]))
            if s[best] >= self.threshold:
                if fact is not None and fact in self.facts[best] or fact is None and url in self.urls[best]:
                    return best, 1.0, False
                self._set(best, self.sums[best] + vector)
                self.counts[best] += 1
                self._note(best, url, fact)
                return best, float(s[best]), True
        self._open(vector, 1)
        self._note(self.n - 1, url, fact)
        return self.n - 1, 1.0, True

    def _note(self, group: int, url: object, fact: object) -> None:
        self.urls[group].add(url)
        if fact is not None:
            self.facts[group].add(fact)


def leader_clusters(
    df: DataFrame, block: Column, order: list[Column | str], threshold: float = THRESHOLD, id_col: str = "vec_id", vector: str = "embedding", fact: str | None = None, stored: DataFrame | None = None
) -> DataFrame:
    """E7 over whole tables: exact within each block, in the given order. One constant block is the reference behaviour.

    stored has block, group_id, centroid and member_count: groups to begin with, by group_id. Rows come out with local_group (stored ones first), group_id (null for a new
    group), sim and added. Rows without a vector take no part.
    """
    seq = F.row_number().over(Window.partitionBy(block).orderBy(*order))
    facts = F.col(fact).cast("string") if fact else F.lit(None).cast("string")
    rows = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).select(block.alias("block"), F.col(id_col).alias("id"), F.col(vector).alias("v"), facts.alias("fact"), seq.alias("seq"))
    kind = dict(rows.dtypes)["block"]
    groups = rows.sparkSession.createDataFrame([], f"block {kind}, group_id long, centroid array<double>, member_count long") if stored is None else stored.select("block", F.col("group_id").cast("long").alias("group_id"), F.col("centroid").cast("array<double>").alias("centroid"), "member_count")

    def run(frame: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        held, frame = held.sort_values("group_id"), frame.sort_values("seq")
        state = Leader(threshold, list(zip(held["centroid"], held["member_count"].astype(int))))
        found = [state.assign(i, v, f) for i, v, f in zip(frame["id"], frame["v"], frame["fact"])]
        local = [g for g, _, _ in found]
        ids = pd.array([held["group_id"].iloc[g] if g < len(held) else None for g in local], "Int64")
        return pd.DataFrame({"block": frame["block"], "id": frame["id"], "local_group": local, "group_id": ids, "sim": [s for _, s, _ in found], "added": [a for _, _, a in found]})

    return rows.groupBy("block").cogroup(groups.groupBy("block")).applyInPandas(run, f"block {kind}, id long, local_group int, group_id long, sim double, added boolean")


def group_stats(members: DataFrame, key: str) -> DataFrame:
    """How many groups, members and singletons there are, and the extremes."""
    per = members.groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(
        F.count("*").alias("total_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_stories"), F.round(F.avg("n"), 4).alias("avg_size"), F.min("n").alias("min_size"), F.max("n").alias("max_size"),
        F.count_if(F.col("n") == 1).alias("singletons"),
    )


def merge_plan(groups: DataFrame, threshold: float = MERGE_THRESHOLD, most: int = MERGE_PAIRS) -> DataFrame:
    """(group_id, primary_id) for groups to merge: components of the ``most`` most similar pairs; the largest, then oldest, group stays.

    groups has group_id, centroid, member_count, created_at. The pairs are few by definition, so their union runs on the driver.
    """
    pairs = similar_pairs(groups, "group_id", "centroid", threshold, places=9, most=most)
    top = pairs.orderBy(F.desc(F.round("sim", 9)), "a", "b").limit(most).collect()
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p in top:
        a, b = find(p["a"]), find(p["b"])
        root[max(a, b)] = min(a, b)
    spark = groups.sparkSession
    part = spark.createDataFrame([(x, find(x)) for x in root] or [], "group_id long, component long")
    best = F.row_number().over(Window.partitionBy("component").orderBy(F.desc("member_count"), "created_at", "group_id"))
    ranked = groups.select("group_id", "member_count", "created_at").join(F.broadcast(part), "group_id").withColumn("r", best)
    primary = ranked.where("r = 1").select("component", F.col("group_id").alias("primary_id"))
    return ranked.join(primary, "component").select("group_id", "primary_id")


def move_members(members: DataFrame, plan: DataFrame) -> DataFrame:
    """Membership after a merge. A fact already in the target, or a URL already there where the fact is missing, is not moved twice.

    members has group_id, fact_id, url_id, seq.
    """
    moved = members.join(plan, "group_id", "left").withColumn("target", F.coalesce("primary_id", "group_id"))
    own = (F.col("target") == F.col("group_id")).cast("int")
    key = F.when(F.col("fact_id").isNotNull(), F.concat(F.lit("f"), F.col("fact_id").cast("string"))).otherwise(F.concat(F.lit("u"), F.col("url_id").cast("string")))
    first = F.row_number().over(Window.partitionBy("target", key).orderBy(F.desc(own), "group_id", "seq"))
    has_url = F.max(F.when(own == 1, 1)).over(Window.partitionBy("target", "url_id"))
    kept = moved.withColumn("r", first).withColumn("has", F.coalesce(has_url, F.lit(0)))
    skip = F.col("fact_id").isNull() & (own == 0) & (F.col("has") == 1)
    return kept.where((F.col("r") == 1) & ~skip).select(F.col("target").alias("group_id"), "fact_id", "url_id", "seq")


def ungrouped(embeddings: DataFrame, members: DataFrame, key: str = "vec_id") -> DataFrame:
    """Rows that no group has."""
    return embeddings.join(members.where(F.col(key).isNotNull()).select(key).distinct(), key, "left_anti")


def group_summary(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Stored groups with what their members show; groups without any stay."""
    seen = members.groupBy("group_id").agg(F.count("*").alias("n"), F.round(F.avg("sim"), 6).alias("avg_sim"), F.round(F.min("sim"), 6).alias("min_sim"), F.round(F.max("sim"), 6).alias("max_sim"))
    return groups.join(seen, "group_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def repaired_counts(groups: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups with true member counts, and those whose stored count was wrong."""
    true = members.groupBy("group_id").agg(F.count("*").alias("true_count"))
    both = groups.join(true, "group_id", "left").withColumn("true_count", F.coalesce("true_count", F.lit(0)))
    return both.withColumn("member_count", F.col("true_count")).drop("true_count"), both.where("member_count <> true_count")


def loose_groups(groups: DataFrame, members: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Active groups whose members' mean similarity is under a threshold."""
    mean = members.groupBy("group_id").agg(F.round(F.avg("sim"), 6).alias("avg_sim"))
    return groups.where("status = 'active'").join(mean, "group_id").where(F.col("avg_sim") < threshold).select("group_id", "member_count", "avg_sim")


def embedding_stats(embeddings: DataFrame, members: DataFrame, key: str = "vec_id") -> DataFrame:
    """Vectors in all, grouped and not, exactly."""
    open_ = ungrouped(embeddings, members, key).agg(F.count("*").alias("ungrouped"))
    return embeddings.agg(F.count("*").alias("total")).crossJoin(open_).withColumn("grouped", F.col("total") - F.col("ungrouped"))


def nearest(df: DataFrame, query: list[float], k: int = 5, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k rows most similar to one vector, exactly."""
    sim = F.round(cosine(F.col(vector), F.array(*map(F.lit, query))), 9)
    return df.select(id_col, sim.alias("sim")).orderBy(F.desc("sim"), id_col).limit(k)


def lookback(df: DataFrame, moment: str, as_of: Column, days: int) -> DataFrame:
    """Rows no older than so many days."""
    return df.where(F.col(moment) >= as_of - F.make_interval(days=F.lit(days)))

