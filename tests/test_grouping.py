"""Vector cases by hand, and the grid of pairs against a double loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.functions.vectors import cosine
from fieldlens.operators import grouping as E


def clusters(frame, vectors, threshold):
    df = frame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    return [(r["local_group"], r["sim"]) for r in E.leader_clusters(df, F.lit(0), ["vec_id"], threshold).orderBy("id").collect()]


def test_leader_cases(frame):
    assert clusters(frame, [[1.0, 0.0, 0.0]], 0.8) == [(0, 1.0)]
    two = clusters(frame, [[0.9, 0.1, 0.0], [0.88, 0.12, 0.0]], 0.75)
    assert [g for g, _ in two] == [0, 0] and two[1][1] > 0.95
    assert clusters(frame, [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0]], 0.9) == [(0, 1.0), (1, 1.0)]
    assert [g for g, _ in clusters(frame, [[1.0, 0.0, 0.0], [0.99, 0.01, 0.0], [0.0, 1.0, 0.0]], 0.5)] == [0, 0, 1]


def test_stats(frame):
    row = E.group_stats(frame([(0,), (0,), (1,)], "g int"), "g").first()
    assert (row["total_groups"], row["total_stories"], row["singletons"], row["avg_size"]) == (2, 3, 1, 1.5)


def test_cosine_is_clamped(frame):
    df = frame([([1.0, 0.0], [-1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0]


def test_centroids(frame):
    df = frame([(0, [1.0, 0.0]), (0, [0.0, 1.0])], "g int, v array<float>")
    assert E.centroids(df, "g", "v").first()["centroid"] == pytest.approx([0.5**0.5] * 2)
    assert E.centroids(df, "g", "v", normalised=False).first()["centroid"] == [0.5, 0.5]


def test_ragged_vectors(frame):
    """Vectors of another length than a key's first are skipped, and hinder no pair, mean or search."""
    df = frame([(0, 1, [1.0, 0.0]), (0, 2, [0.0, 1.0, 9.0]), (0, 3, None), (1, 4, [0.0, 2.0]), (1, 5, [0.0, 4.0])], "g int, id long, v array<double>")
    assert {r["g"]: r["centroid"] for r in E.centroids(df, "g", "v", normalised=False, order="id").collect()} == {0: [1.0, 0.0], 1: [0.0, 3.0]}
    assert [(r["a"], r["b"]) for r in E.similar_pairs(df, "id", "v", 0.9).collect()] == [(4, 5)]
    assert {r["g"]: r["cohesion"] for r in E.cohesion(df, "g", "id", "v").collect()} == {0: 1.0, 1: 1.0}
    groups = frame([(7, [0.0, 1.0])], "group_id long, centroid array<double>")
    assert {r["id"]: r["group_id"] for r in E.nearest_group(df, groups, 0.5, "id", "v").collect()} == {1: None, 2: None, 3: None, 4: 7, 5: 7}


@pytest.mark.parametrize("blocks", [1, 2, 5])
def test_pairs_in_blocks(frame, blocks):
    x = np.random.default_rng(1).normal(size=(40, 4))
    df = frame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {(r["a"], r["b"]) for r in E.similar_pairs(df, "id", "v", 0.6, blocks).collect()}
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert got == {(i, j) for i in range(40) for j in range(i + 1, 40) if n[i] @ n[j] >= 0.6}


def test_blocks_are_bounded_whatever_their_number(frame, monkeypatch):
    """A number of blocks that is given is the least: a larger table is cut further, and no product is larger than its bound."""
    monkeypatch.setattr(E, "GRID_ROWS", 8)
    monkeypatch.setattr(E, "BLOCK_ROWS", 3)
    x = np.random.default_rng(1).normal(size=(40, 4))
    df = frame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = sorted((-round(n[i] @ n[j], 7), i, j) for i in range(40) for j in range(i + 1, 40) if n[i] @ n[j] >= 0.6)
    pairs = E.similar_pairs(df, "id", "v", 0.6, blocks=1)
    assert pairs.count() == len(want) and {(r["a"], r["b"]) for r in pairs.collect()} == {w[1:] for w in want}
    best = E.similar_pairs(df, "id", "v", 0.6, blocks=1, places=7, most=4)
    assert best.count() < len(want)
    assert [(r["a"], r["b"]) for r in best.orderBy(F.desc("sim"), "a", "b").limit(4).collect()] == [w[1:] for w in want[:4]]


def test_merge_plan_keeps_the_largest(frame):
    rows = [(1, [1.0, 0.0], 2, 5), (2, [1.0, 0.01], 4, 9), (3, [1.0, 0.02], 4, 3), (4, [0.0, 1.0], 1, 1)]
    plan = E.merge_plan(frame(rows, "group_id long, centroid array<double>, member_count int, created_at int"))
    assert {(r["group_id"], r["primary_id"]) for r in plan.collect()} == {(1, 3), (2, 3), (3, 3)}


def test_empty_tables(frame):
    empty = frame([], "vec_id long, embedding array<float>")
    assert E.similar_pairs(empty, "vec_id", "embedding", 0.5).count() == 0
    assert E.leader_clusters(empty, F.lit(0), ["vec_id"]).count() == 0


def test_nearest_group_in_blocks(frame, monkeypatch):
    rng = np.random.default_rng(4)
    rows = frame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 3)))], "vec_id long, embedding array<float>")
    groups = frame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(9, 3)))], "group_id long, centroid array<float>")
    want = E.nearest_group(rows, groups, 0.5).orderBy("vec_id").collect()
    monkeypatch.setattr(E, "BLOCK_ROWS", 4)
    got = E.nearest_group(rows, groups, 0.5).orderBy("vec_id").collect()
    assert [(r["vec_id"], r["group_id"], round(r["sim"], 6)) for r in got] == [(r["vec_id"], r["group_id"], round(r["sim"], 6)) for r in want]


def test_leader_with_stored_groups_against_a_plain_loop(frame):
    """Stored groups weigh as much as their members; facts count before URLs; the last of equal groups wins."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(9, 6))
    stored = [(7, base[0] / np.linalg.norm(base[0]), 5), (3, base[1], 0), (9, base[2] / np.linalg.norm(base[2]), 40)]
    stories = [(int(rng.integers(0, 25)), (base[i % 9] + rng.normal(size=6) * 0.25).tolist(), f"f{i % 13}" if i % 3 else None, i) for i in range(120)]

    def unit(x):
        return x / np.linalg.norm(x)

    groups = [{"id": g, "sum": c * max(n, 1), "urls": set(), "facts": set()} for g, c, n in sorted(stored, key=lambda s: s[0])]
    want = []
    for url, v, fact, seq in stories:
        sims = [min(1.0, max(0.0, float(unit(g["sum"]) @ unit(np.array(v))))) for g in groups]
        top = max(sims)
        if top >= 0.8:
            at = max(i for i, s in enumerate(sims) if s == top)
            g = groups[at]
            if fact in g["facts"] if fact is not None else url in g["urls"]:
                want.append((seq, at, g["id"], 1.0, False))
                continue
            g["sum"] = g["sum"] + np.array(v)
        else:
            groups.append({"id": None, "sum": np.array(v), "urls": set(), "facts": set()})
            at, g, top = len(groups) - 1, groups[-1], 1.0
        g["urls"].add(url)
        if fact is not None:
            g["facts"].add(fact)
        want.append((seq, at, g["id"], round(top, 6), True))
    held = frame([(0, g, c.tolist(), n) for g, c, n in stored], "b int, group_id long, centroid array<double>, member_count long").withColumnRenamed("b", "block")
    df = frame([*stories, (99, None, None, 500), (98, [], None, 501)], "vec_id long, embedding array<double>, fact string, seq long")
    got = E.leader_clusters(df.withColumn("k", F.col("seq")), F.lit(0), ["seq"], 0.8, fact="fact", stored=held)
    rows = [(r["local_group"], r["group_id"], round(r["sim"], 6), r["added"]) for r in got.collect()]
    assert rows == [w[1:] for w in want] and {False, True} == {w[4] for w in want} and any(w[2] for w in want)


def test_stream_clusters_follow_ids_and_not_files(spark, frame, tmp_path):
    """Files whose times run against their ids, and blocks that come in several Arrow batches, give the groups of the batch form."""
    import time

    from fieldlens.plans import all_queries

    x = np.random.default_rng(5).normal(size=(900, 4))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(x)]
    for k in (2, 1, 0):
        for i, r in enumerate((rows[k * 300 : k * 300 + 150], rows[k * 300 + 150 : k * 300 + 300])):
            frame(r[::-1], "vec_id long, embedding array<float>, label int").coalesce(1).write.mode("append").parquet(str(tmp_path / "embeddings.parquet"))
            time.sleep(0.02)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        got = {r["id"]: (r["block"], r["local_group"], r["sim"]) for r in all_queries()[0]["stream_clusters"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = E.leader_clusters(frame(rows, "vec_id long, embedding array<float>, label int"), F.col("label"), ["vec_id"], 0.3).collect()
    assert got == {r["id"]: (r["block"], r["local_group"], round(r["sim"], 6)) for r in want}
