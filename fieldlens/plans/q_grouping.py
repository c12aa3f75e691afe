"""Queries of family E over the embeddings; their pairwise similarities are low, so thresholds are too."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.functions.vectors import cosine, parsed
from fieldlens.operators import grouping as E
from fieldlens.plans.registry import query

_COS = "least(1.0, greatest(0.0, list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[])))))"
_CENTRES = """m AS (SELECT group_id, i, avg(x) AS x FROM (SELECT group_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM members) GROUP BY ALL),
  c AS (SELECT group_id, list(x ORDER BY i) AS v, sqrt(sum(x * x)) AS n FROM m GROUP BY group_id), centre AS (SELECT group_id, list_transform(v, lambda y: y / n) AS centroid FROM c)"""


def _cos(a: str, b: str) -> str:
    return _COS.format(a=a, b=b)


def _centres(t):
    return E.centroids(t.members, "group_id", "embedding")


@query("cosine_pairs_topk", f"SELECT a.vec_id AS a, b.vec_id AS b, round({_cos('a.embedding', 'b.embedding')}, 7) AS sim FROM members a JOIN members b ON a.vec_id < b.vec_id ORDER BY sim DESC, a, b LIMIT 25", "members")
def cosine_pairs_topk(t):
    pairs = E.similar_pairs(t.members, "vec_id", "embedding", 0.3, blocks=3, places=7, most=25)
    return pairs.withColumn("sim", F.round("sim", 7)).orderBy(F.desc("sim"), "a", "b").limit(25)


@query("similar_pairs", f"SELECT a.vec_id AS a, b.vec_id AS b, round({_cos('a.embedding', 'b.embedding')}, 7) AS sim FROM members a JOIN members b ON a.vec_id < b.vec_id WHERE {_cos('a.embedding', 'b.embedding')} >= 0.33", "members")
def similar_pairs(t):
    return E.similar_pairs(t.members, "vec_id", "embedding", 0.33, blocks=2).withColumn("sim", F.round("sim", 7))


def _components(df, vector):
    """A vector as rows of its components."""
    return df.select("group_id", F.posexplode(vector).alias("pos", "x")).withColumn("x", F.round("x", 7))


_EACH = "unnest(range(len({v}))) AS pos, unnest(list_transform({v}, lambda x: round(x, 7))) AS x"


@query("centroids", f"WITH {_CENTRES} SELECT group_id, pos::INT AS pos, x FROM (SELECT group_id, {_EACH.format(v='centroid')} FROM centre)", "members")
def centroids(t):
    return _components(_centres(t), "centroid")


@query("pooled_embedding", f"WITH {_CENTRES} SELECT group_id, pos::INT AS pos, x FROM (SELECT group_id, {_EACH.format(v='v')} FROM c)", "members")
def pooled_embedding(t):
    return _components(E.centroids(t.members, "group_id", "embedding", normalised=False), "centroid")


@query("nearest_centroid", f"WITH {_CENTRES}, s AS (SELECT vec_id, centre.group_id, round({_cos('embedding', 'centroid')}, 9) AS sim FROM members CROSS JOIN centre), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, group_id DESC) AS r FROM s) SELECT vec_id, CASE WHEN sim >= 0.2 THEN group_id END AS group_id, round(sim, 6) AS sim FROM r WHERE r = 1", "members")
def nearest_centroid(t):
    return E.nearest_group(t.members, _centres(t), 0.2).withColumn("sim", F.round("sim", 6))


@query("cohesion", f"SELECT a.group_id, round(avg({_cos('a.embedding', 'b.embedding')}), 7) AS cohesion FROM members a JOIN members b ON a.group_id = b.group_id AND a.vec_id < b.vec_id GROUP BY a.group_id", "members")
def cohesion(t):
    return E.cohesion(t.members, "group_id", "vec_id", "embedding").withColumn("cohesion", F.round("cohesion", 7))


@query("low_cohesion", f"WITH p AS (SELECT a.group_id, avg({_cos('a.embedding', 'b.embedding')}) AS c FROM members a JOIN members b ON a.group_id = b.group_id AND a.vec_id < b.vec_id GROUP BY a.group_id) SELECT group_id FROM p WHERE c < 0.06", "members")
def low_cohesion(t):
    return E.cohesion(t.members, "group_id", "vec_id", "embedding").where("cohesion < 0.06").select("group_id")


@query("knn", f"SELECT m.vec_id, round({_cos('m.embedding', 'q.embedding')}, 9) AS sim FROM members m CROSS JOIN (SELECT embedding FROM members WHERE vec_id = 7) q ORDER BY sim DESC, m.vec_id LIMIT 5", "members")
def knn(t):
    one = t.members.where("vec_id = 7").first()
    return E.nearest(t.members, list(one["embedding"]))


@query("group_stats", "WITH p AS (SELECT group_id, count(*) AS n FROM members GROUP BY group_id) SELECT count(*) AS total_groups, CAST(sum(n) AS BIGINT) AS total_stories, round(avg(n), 4) AS avg_size, min(n) AS min_size, max(n) AS max_size, count(*) FILTER (n = 1) AS singletons FROM p", "members")
def group_stats(t):
    return E.group_stats(t.members, "group_id")


@query("ungrouped", "SELECT vec_id FROM members WHERE vec_id % 3 = 0", "members")
def ungrouped(t):
    return E.ungrouped(t.members, t.members.where("vec_id % 3 <> 0")).select("vec_id")


@query("group_summary", "SELECT g.group_id, count(s.sim) AS n, round(avg(s.sim), 6) AS avg_sim, round(min(s.sim), 6) AS min_sim, round(max(s.sim), 6) AS max_sim FROM (SELECT DISTINCT group_id FROM members) g LEFT JOIN (SELECT group_id, (vec_id % 100)::DOUBLE / 100 AS sim FROM members WHERE group_id < 8) s USING (group_id) GROUP BY g.group_id", "members")
def group_summary(t):
    members = t.members.where("group_id < 8").select("group_id", ((F.col("vec_id") % 100).cast("double") / 100).alias("sim"))
    return E.group_summary(t.members.select("group_id").distinct(), members)


@query("member_count_repair", "SELECT group_id, count(*) AS true_count, count(*) + CASE WHEN group_id % 2 = 0 THEN 1 ELSE 0 END AS member_count FROM members GROUP BY group_id HAVING group_id % 2 = 0", "members")
def member_count_repair(t):
    stored = t.members.groupBy("group_id").agg(F.count("*").alias("member_count")).withColumn("member_count", F.col("member_count") + F.when(F.col("group_id") % 2 == 0, 1).otherwise(0))
    return E.repaired_counts(stored, t.members)[1]


@query("vector_parse", "SELECT vec_id, round(embedding[1]::DOUBLE, 5) AS first, len(embedding)::INT AS n FROM members", "members")
def vector_parse(t):
    text = t.members.select("vec_id", F.to_json("embedding").alias("text"))
    return text.select("vec_id", F.round(F.get(parsed(F.col("text")), F.lit(0)).cast("double"), 5).alias("first"), F.size(parsed(F.col("text"))).alias("n"))


@query("weighted_centroid", f"WITH {_CENTRES}, b AS (SELECT c.group_id, list_transform(list_zip(centre.centroid, c.v), lambda z: z[1] * 3 + z[2] * 2) AS s FROM c JOIN centre USING (group_id)), u AS (SELECT group_id, list_transform(s, lambda x: x / sqrt(list_sum(list_transform(s, lambda y: y * y)))) AS w FROM b) SELECT group_id, pos::INT AS pos, x FROM (SELECT group_id, {_EACH.format(v='w')} FROM u)", "members")
def weighted_centroid(t):
    both = _centres(t).join(E.centroids(t.members, "group_id", "embedding", normalised=False).withColumnRenamed("centroid", "mean"), "group_id")
    moved = E.weighted_update(F.col("centroid"), F.lit(3.0), F.transform("mean", lambda x: x * 2.0), F.lit(2.0))
    return _components(both.select("group_id", moved.alias("centroid")), "centroid")


_LEAD = """o AS (SELECT vec_id, embedding::DOUBLE[] AS v, row_number() OVER (ORDER BY vec_id) AS i FROM members WHERE {where}), {start},
  r AS (SELECT 0::BIGINT AS i, sums, 0::BIGINT AS g, 0.0::DOUBLE AS sim FROM start UNION ALL
    SELECT i, CASE WHEN hit THEN list_transform(sums, lambda s, k: CASE WHEN k = best THEN list_transform(list_zip(s, v), lambda z: z[1] + z[2]) ELSE s END) ELSE list_append(sums, v) END, CASE WHEN hit THEN best ELSE len(sums) + 1 END, CASE WHEN hit THEN top ELSE 1.0 END
    FROM (SELECT i, sums, v, list_max(sims) AS top, len(sims) - list_position(list_reverse(sims), list_max(sims)) + 1 AS best, coalesce(list_max(sims) >= {threshold}, false) AS hit FROM (SELECT o.i, r.sums, o.v, list_transform(r.sums, lambda s: {cos}) AS sims FROM r JOIN o ON o.i = r.i + 1)))"""


def _lead(where: str, start: str, threshold: float) -> str:
    return "WITH RECURSIVE " + _LEAD.format(where=where, start=start, threshold=threshold, cos=_cos("s", "o.v"))


#: Within each label: one state a label, which starts without groups.
LEADERS_BY_LABEL = (
    "WITH RECURSIVE "
    + _LEAD.format(where="TRUE", start="start AS (SELECT DISTINCT group_id, []::DOUBLE[][] AS sums FROM members)", threshold=0.3, cos=_cos("s", "o.v"))
    .replace("SELECT vec_id, embedding", "SELECT group_id, vec_id, embedding").replace("OVER (ORDER BY vec_id)", "OVER (PARTITION BY group_id ORDER BY vec_id)")
    .replace("SELECT 0::BIGINT AS i,", "SELECT group_id, 0::BIGINT AS i,").replace("SELECT i, CASE WHEN hit", "SELECT group_id, i, CASE WHEN hit").replace("FROM (SELECT i, sums", "FROM (SELECT group_id, i, sums")
    .replace("(SELECT o.i, r.sums", "(SELECT o.group_id, o.i, r.sums").replace("ON o.i = r.i + 1", "ON o.i = r.i + 1 AND o.group_id = r.group_id")
    + " SELECT group_id AS block, vec_id AS id, (g - 1)::INT AS local_group, round(sim, 6) AS sim FROM r JOIN o USING (group_id, i)"
)


@query("leader_clusters", _lead("TRUE", "start AS (SELECT []::DOUBLE[][] AS sums)", 0.3) + " SELECT 0::INT AS block, vec_id AS id, (g - 1)::INT AS local_group, round(sim, 6) AS sim FROM r JOIN o USING (i)", "members")
def leader_clusters(t):
    return E.leader_clusters(t.members, F.lit(0), ["vec_id"], threshold=0.3).select("block", "id", "local_group", F.round("sim", 6).alias("sim"))


@query("leader_stored", _lead("vec_id % 2 = 1", """st AS (SELECT group_id, count(*) AS n FROM members WHERE vec_id % 2 = 0 GROUP BY group_id), sm AS (SELECT group_id, i, avg(x) AS x FROM (SELECT group_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM members WHERE vec_id % 2 = 0) GROUP BY ALL),
  sc AS (SELECT group_id, list(x ORDER BY i) AS v, sqrt(sum(x * x)) AS len FROM sm GROUP BY group_id), start AS (SELECT list(list_transform(v, lambda y: y / len * n) ORDER BY group_id) AS sums FROM sc JOIN st USING (group_id))""", 0.25)
  + ", names AS (SELECT group_id, row_number() OVER (ORDER BY group_id) AS g FROM st) SELECT vec_id AS id, (r.g - 1)::INT AS local_group, names.group_id::BIGINT AS group_id, round(sim, 6) AS sim FROM r JOIN o USING (i) LEFT JOIN names ON names.g = r.g", "members")
def leader_stored(t):
    """Odd vectors join the groups of the even ones, whose centroids weigh as much as their members, or open new ones."""
    even = t.members.where("vec_id % 2 = 0")
    stored = E.centroids(even, "group_id", "embedding").join(even.groupBy("group_id").agg(F.count("*").alias("member_count")), "group_id").withColumn("block", F.lit(0))
    return E.leader_clusters(t.members.where("vec_id % 2 = 1"), F.lit(0), ["vec_id"], threshold=0.25, stored=stored).select("id", "local_group", "group_id", F.round("sim", 6).alias("sim"))


@query("merge_components")
def merge_components(t):
    groups = E.leader_clusters(t.members, F.lit(0), ["vec_id"], threshold=0.3).join(t.members, F.col("id") == F.col("vec_id"))
    made = E.centroids(groups.withColumn("group_key", F.col("local_group").cast("long")), "group_key", "embedding")
    sizes = groups.groupBy(F.col("local_group").cast("long").alias("group_key")).agg(F.count("*").alias("member_count"), F.min("vec_id").alias("created_at"))
    return E.merge_plan(made.join(sizes, "group_key").withColumnRenamed("group_key", "group_id"), threshold=0.35)


@query("merge_plan", """WITH RECURSIVE g AS (SELECT vec_id, group_id * 4 + vec_id % 4 AS gid, embedding FROM members), z AS (SELECT gid, count(*) AS n, min(vec_id) AS created FROM g GROUP BY gid),
  px AS (SELECT gid, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM g), m AS (SELECT gid, pos, avg(x) AS x FROM px GROUP BY ALL), l AS (SELECT gid, sqrt(sum(x * x)) AS len FROM m GROUP BY gid),
  s AS (SELECT u.gid AS a, v.gid AS b, sum(u.x * v.x) / (any_value(lu.len) * any_value(lv.len)) AS sim FROM m u JOIN m v ON u.pos = v.pos AND u.gid < v.gid JOIN l lu ON lu.gid = u.gid JOIN l lv ON lv.gid = v.gid GROUP BY ALL),
  best AS (SELECT a, b FROM s WHERE sim >= 0.35 ORDER BY round(sim, 9) DESC, a, b LIMIT 200), e AS (SELECT a, b FROM best UNION SELECT b, a FROM best),
  r AS (SELECT a AS x, b AS y FROM e UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a), c AS (SELECT x AS gid, min(y) AS component FROM r GROUP BY x)
  SELECT gid AS group_id, first_value(gid) OVER (PARTITION BY component ORDER BY n DESC, created, gid) AS primary_id FROM c JOIN z USING (gid)""", "members")
def merge_plan(t):
    """E10 over forty stored groups."""
    groups = t.members.withColumn("gid", F.col("group_id") * 4 + F.col("vec_id") % 4)
    sizes = groups.groupBy("gid").agg(F.count("*").alias("member_count"), F.min("vec_id").alias("created_at"))
    made = E.centroids(groups, "gid", "embedding").join(sizes, "gid").withColumn("group_id", F.col("gid").cast("long"))
    return E.merge_plan(made, threshold=0.35)


@query("move_members", """WITH s AS (SELECT vec_id, group_id, CASE WHEN vec_id % 7 = 0 THEN NULL ELSE vec_id % 90 END AS fact_id, vec_id % 60 AS url_id FROM members),
  p AS (SELECT *, CASE WHEN group_id IN (1, 2) THEN 0 ELSE group_id END AS target FROM s),
  r AS (SELECT *, row_number() OVER (PARTITION BY target, coalesce('f' || fact_id, 'u' || url_id) ORDER BY target <> group_id, group_id, vec_id) AS r FROM p)
  SELECT target AS group_id, fact_id, url_id, vec_id AS seq FROM r WHERE r = 1 AND NOT (fact_id IS NULL AND target <> group_id AND EXISTS (SELECT 1 FROM p o WHERE o.group_id = r.target AND o.target = o.group_id AND o.url_id = r.url_id))""", "members")
def move_members(t):
    members = t.members.select("group_id", F.when(F.col("vec_id") % 7 != 0, F.col("vec_id") % 90).alias("fact_id"), (F.col("vec_id") % 60).alias("url_id"), F.col("vec_id").alias("seq"))
    plan = members.where("group_id in (0, 1, 2)").select("group_id").distinct().withColumn("primary_id", F.lit(0))
    return E.move_members(members, plan)


@query("self_similarity", f"SELECT a.vec_id, b.vec_id AS other, round(greatest(0, least(1, {_cos('a.embedding', 'b.embedding')})), 6) AS sim FROM members a JOIN members b ON b.vec_id IN (a.vec_id, a.vec_id + 1, a.vec_id + 7)", "members")
def self_similarity(t):
    """Each vector with itself and two others: similarities below zero count as zero."""
    both = t.members.select("vec_id", "embedding", F.explode(F.array(F.col("vec_id"), F.col("vec_id") + 1, F.col("vec_id") + 7)).alias("other"))
    both = both.join(t.members.select(F.col("vec_id").alias("other"), F.col("embedding").alias("e")), "other")
    return both.select("vec_id", "other", F.round(cosine(F.col("embedding"), F.col("e")), 6).alias("sim"))


@query("loose_groups", "SELECT group_id, count(*) AS member_count, round(avg((vec_id % 100)::DOUBLE / 100), 6) AS avg_sim FROM members WHERE group_id % 3 <> 0 GROUP BY group_id HAVING round(avg((vec_id % 100)::DOUBLE / 100), 6) < 0.5", "members")
def loose_groups(t):
    members = t.members.select("group_id", ((F.col("vec_id") % 100).cast("double") / 100).alias("sim"))
    groups = t.members.groupBy("group_id").agg(F.count("*").alias("member_count")).withColumn("status", F.when(F.col("group_id") % 3 == 0, "archived").otherwise("active"))
    return E.loose_groups(groups, members, 0.5)


@query("embedding_stats", "SELECT count(*) AS total, count(*) FILTER (vec_id % 3 = 0) AS ungrouped, count(*) FILTER (vec_id % 3 <> 0) AS grouped FROM members", "members")
def embedding_stats(t):
    return E.embedding_stats(t.members, t.members.where("vec_id % 3 <> 0"))
