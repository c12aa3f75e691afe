"""Queries of sources, sinks and packages."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.operators import providers as P
from fieldlens.plans.registry import query
from fieldlens.session import shared_dir
from fieldlens.sources import readers as R
from fieldlens.sources.paged import use_pages
from fieldlens.sources.sinks import Pipeline, sync_all
from fieldlens.sources.tables import Leases, Table


def _folder(t) -> str:
    return f"{shared_dir(t.spark)}/query-{uuid.uuid4().hex}"


@query("source_scan", """SELECT 'all' AS asked, game_id FROM games UNION ALL SELECT 'season', game_id FROM games WHERE season = 1995 UNION ALL SELECT 'season and week', game_id FROM games WHERE season = 1995 AND wk = 4
  UNION ALL SELECT 'no such column', n_nationkey FROM nation""", "games")
def source_scan(t):
    """A schedule in folders by season, scanned whole, by season, and by season and week; a table without these columns comes whole."""
    path = _folder(t)
    t.games.withColumnRenamed("wk", "game_week").repartition("season").write.partitionBy("season").parquet(path)
    ids = lambda asked, **by: R.scan(t.spark, path, **by).select(F.lit(asked).alias("asked"), "game_id")
    whole = R.scan(t.spark, f"{t.sf_dir}/nation.parquet", season=1995, week=4).select(F.lit("no such column").alias("asked"), F.col("n_nationkey").cast("long").alias("game_id"))
    return reduce(DataFrame.union, [ids("all"), ids("season", season=1995), ids("season and week", season=1995, week=4), whole])


@query("preferred_source", "SELECT 'first' AS asked, n_name AS name FROM nation UNION ALL SELECT 'second', s_name FROM supplier")
def preferred_source(t):
    """The first source where it has rows, the second where it has none."""
    first, second = t.nation.select(F.col("n_name").alias("name")), t.supplier.select(F.col("s_name").alias("name"))
    none = first.where("name is null")
    return R.preferred(first, second).select(F.lit("first").alias("asked"), "name").union(R.preferred(none, second).select(F.lit("second").alias("asked"), "name"))


def _flows(t, path: str) -> tuple[dict[str, Pipeline], dict[str, Table]]:
    flow = lambda df, *keys: Pipeline(lambda: df, lambda d: d.where(F.col(keys[0]).isNotNull()), list(keys))
    flows = {"suppliers": flow(t.supplier.select("s_suppkey", "s_acctbal"), "s_suppkey"), "nations": flow(t.nation.select("n_nationkey", "n_name"), "n_nationkey"), "broken": flow(t.region, "no_such_column")}
    return flows, {name: Table(t.spark, f"{path}/{name}") for name in flows}


@query("sync_report", "SELECT run, name, result FROM (SELECT 'suppliers' AS name, CAST(count(*) AS VARCHAR) AS result FROM supplier UNION ALL SELECT 'nations', CAST(count(*) AS VARCHAR) FROM nation UNION ALL SELECT 'broken', 'failed') r CROSS JOIN (SELECT 'dry' AS run UNION ALL SELECT 'real') x UNION ALL SELECT 'dry', 'tables', '0'")
def sync_report(t):
    """What each of three pipelines, one of them broken, reports from a dry and a real run; the dry run leaves no table."""
    flows, tables = _flows(t, _folder(t))
    said = lambda run, found: [(run, name, str(v).split(":")[0]) for name, v in found.items()]
    rows = said("dry", sync_all(flows, tables, dry_run=True))
    rows.append(("dry", "tables", str(sum(table.version() is not None for table in tables.values()))))
    return t.spark.createDataFrame(rows + said("real", sync_all(flows, tables)), "run string, name string, result string")


@query("pipeline_upsert", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE s_acctbal END::DOUBLE AS s_acctbal FROM supplier")
def pipeline_upsert(t):
    """A table after two runs, the second with other values of every other key."""
    flows, tables = _flows(t, _folder(t))
    table = tables["suppliers"]
    flows["suppliers"].run(table)
    again = flows["suppliers"].prepare().where("s_suppkey % 2 = 0").withColumn("s_acctbal", F.lit(0.0))
    Pipeline(lambda: again, lambda d: d, ["s_suppkey"]).run(table)
    return table.read()


@query("provider_json", "SELECT CAST(c_custkey AS VARCHAR) AS player_id, CAST(c_nationkey AS VARCHAR) AS team FROM customer")
def provider_json(t):
    """Rows as JSON; read back here."""
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("player_id"), "c_nationkey", F.lit(2024).alias("season"))
    found = P.registry({"ftn": rows}.__getitem__)["ftn"].get(output="json", season=2024)
    return found.select(F.get_json_object("json", "$.player_id").alias("player_id"), F.get_json_object("json", "$.c_nationkey").alias("team"))


_HEAD = '{"bundles":[{"name":"line","provider":"pfr"},{"name":"later","provider":"pfr"},{"name":"lost","provider":"none"}],"schema_version":"1.0.0","scope":{"season":2024},"sources":[{"name":"own","version":"1"}],"subject":{"id":"C7"}}'


@query("package_envelope", f"""SELECT sha256('{_HEAD}') AS package_id, 'line' AS bundle, CAST(c_custkey AS VARCHAR) AS player_id, c_acctbal FROM customer WHERE c_custkey IN (5, 7)
  UNION ALL SELECT sha256('{_HEAD}'), 'later', NULL, NULL UNION ALL SELECT sha256('{_HEAD}'), 'lost', NULL, NULL""")
def package_envelope(t):
    """A package of rows, a pointer and a bundle that fails, by its id; nulls leave the id as it is."""
    stats = t.customer.select(F.col("c_custkey").cast("string").alias("player_id"), F.lit(2024).alias("season"), "c_acctbal")
    bundles = [{"name": "line", "provider": "pfr", "filters": {"season": 2024, "player_id": ["5", "7"]}}, {"name": "later", "provider": "pfr", "inline": False}, {"name": "lost", "provider": "none"}]
    request = {"schema_version": "1.0.0", "subject": {"id": "C7", "team": None}, "scope": {"season": 2024, "week": None}, "sources": [{"version": "1", "name": "own"}], "bundles": bundles}
    made = P.package(request, P.registry({"pfr": stats}.__getitem__), strict=False)
    rows = [(made["package_id"], name, r["player_id"], r["c_acctbal"]) for name, found in made["payload"].items() for r in found]
    rows += [(made["package_id"], name, None, None) for name in [k for k in made["links"] if k != "bundle_errors"] + [e["bundle"] for e in made["links"]["bundle_errors"]]]
    return t.spark.createDataFrame(rows, "package_id string, bundle string, player_id string, c_acctbal double")


@query("older_requests", """SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN 'team_weekly_stats' ELSE 'player_weekly_stats' END AS bundle, CASE WHEN r_regionkey % 2 = 0 THEN 'team_week' ELSE 'player_week' END AS grain,
  CASE WHEN r_regionkey % 2 = 0 THEN 'team_abbr=T' || r_regionkey ELSE 'player_id=t' || r_regionkey END AS subject, 'legacy.feed' AS source FROM region
  UNION ALL SELECT r_regionkey, 'injuries', 'team_week_player', CASE WHEN r_regionkey % 2 = 0 THEN 'team_abbr=T' || r_regionkey ELSE 'player_id=t' || r_regionkey END, 'legacy.feed' FROM region""")
def older_requests(t):
    """Older requests, one for each region, in today's shape: a row for each bundle."""
    rows = []
    for key in [r[0] for r in t.region.select("r_regionkey").collect()]:  # five rows at every size
        kind = "team" if key % 2 == 0 else "player"
        old = {"subject": {"entity_type": kind, "entity_id": f" t{key} "}, "scope": {"temporal": {"season": "2024", "week": 3}}, "provenance": {"sources": ["feed"]}, "bundles": [{"provider": "player_weekly_stats"}, {"stream": "injury_reports"}]}
        new, _ = P.modern_request(old)
        for b in new["bundles"]:
            own = {k: v for k, v in b["filters"].items() if k not in ("season", "week")}
            rows.append((key, b["name"], b["record_grain"], ",".join(f"{k}={v}" for k, v in own.items()), new["provenance"]["sources"][0]["name"]))
    return t.spark.createDataFrame(rows, "r_regionkey long, bundle string, grain string, subject string, source string")


@query("table_layers", """SELECT s_suppkey AS k, CASE WHEN s_suppkey % 5 = 1 THEN s_acctbal + 1 WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_acctbal END::DOUBLE AS v FROM supplier WHERE s_suppkey % 7 <> 2 OR s_suppkey % 5 = 1
  UNION ALL SELECT -s_suppkey, s_acctbal FROM supplier WHERE s_suppkey % 11 = 4""")
def table_layers(t):
    """A table after an upsert of some keys, a deletion, a compare-and-set, an append, a transaction that comes twice, and merges on the way."""
    table = Table(t.spark, _folder(t), merge_after=3)
    rows = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").cast("double").alias("v"))
    table.write(rows)
    table.upsert(rows.where("k % 3 = 0").withColumn("v", F.lit(0.0)), ["k"])
    table.delete(rows.where("k % 7 = 2 or k % 5 = 1"), ["k"])
    table.change(lambda now: rows.where("k % 5 = 1").withColumn("v", F.col("v") + 1), ["k"])
    for _ in range(2):
        table.append(rows.where("k % 11 = 4").withColumn("k", -F.col("k")), transaction=("query", 1))
    return table.read()


@query("table_history", "SELECT 0 AS version, count(*) AS n, sum(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS changed FROM supplier WHERE s_suppkey % 2 = 1 UNION ALL SELECT 1, count(*), sum(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END) FROM supplier UNION ALL SELECT 2, count(*), 0 FROM supplier WHERE s_suppkey % 2 = 1")
def table_history(t):
    """Each version of a table that an upsert and a deletion changed."""
    table = Table(t.spark, _folder(t))
    table.write(t.supplier.where("s_suppkey % 2 = 1").select("s_suppkey", "s_acctbal"))
    table.upsert(t.supplier.where("s_suppkey % 2 = 0").select("s_suppkey", "s_acctbal"), ["s_suppkey"])
    table.delete(t.supplier.where("s_suppkey % 2 = 0"), ["s_suppkey"])
    versions = [table.read(v).agg(F.lit(v).alias("version"), F.count("*").alias("n"), F.coalesce(F.count_if(F.col("s_suppkey") % 2 == 0), F.lit(0)).alias("changed")) for v in range(3)]
    return reduce(DataFrame.union, versions)


@query("leased_claims", """WITH q AS (SELECT n_nationkey AS item_id, CAST(row_number() OVER (ORDER BY n_nationkey) AS INT) AS r FROM nation)
  SELECT item_id, CASE WHEN r <= 4 THEN 'done' WHEN r <= 6 THEN 'leased' ELSE 'queued' END AS status, CASE WHEN r <= 4 THEN 1 WHEN r <= 6 THEN 2 WHEN r <= 8 THEN 1 ELSE 0 END AS attempts, CASE WHEN r BETWEEN 5 AND 6 THEN 'second' END AS worker FROM q""")
def leased_claims(t):
    """A worker claims six rows and ends four, its lease on two runs out and another takes these; two more are given back."""
    at = lambda m: F.lit(f"2024-01-01 10:{m:02d}:00").cast("timestamp")
    queue = Leases(Table(t.spark, _folder(t)), seconds=600)
    queue.put(t.nation.select(F.col("n_nationkey").alias("item_id"), F.col("n_name").alias("payload")))
    queue.done(queue.claim("first", 6, at(0)).orderBy("item_id").limit(4), "first", at(1))
    queue.back(queue.claim("second", 2, at(2)), "second", at(3))  # the next two: the first worker's leases still hold
    queue.claim("second", 2, at(30))
    queue.done(queue.table.read().where("worker = 'second'"), "first", at(31))  # not its own
    return queue.table.read().select("item_id", "status", "attempts", "worker")


def _paged(t):
    """The schedule as a service would page it: a file of 50 games at most for each season, week and page."""
    place = F.row_number().over(Window.partitionBy("season", "wk").orderBy("game_id")) - 1
    rows = t.games.withColumn("page", F.floor(place / 50).cast("int"))
    pages = rows.groupBy("season", "wk", "page").agg(F.to_json(F.array_sort(F.collect_list(F.struct("game_id", "home", "away")))).alias("body"))
    path = _folder(t).removeprefix("file://")
    weeks = [r["wk"] for r in t.games.select("wk").distinct().collect()]
    seasons = [r["season"] for r in t.games.select("season").distinct().collect()]

    def put(part):
        for r in part:
            os.makedirs(f"{path}/{r['season']}/{r['wk']}", exist_ok=True)
            with open(f"{path}/{r['season']}/{r['wk']}/{r['page']}.json", "w") as out:
                out.write(r["body"])

    pages.foreachPartition(put)
    use_pages(t.spark)
    return t.spark.read.format("paged").schema("season int, week int, game_id long, home string, away string").options(url=f"file://{path}/{{season}}/{{week}}/{{page}}.json", seasons=",".join(map(str, seasons)), weeks=",".join(map(str, weeks)), pageSize=50).load()


@query("paged_scan", "SELECT season, wk AS week, game_id, home, away FROM games", "games")
def paged_scan(t):
    """Every page of every season and week, each until a short one."""
    return _paged(t)


@query("paged_season", "SELECT season, wk AS week, game_id, home, away FROM games WHERE season = 1995 AND wk IN (3, 4) AND home > 'T05'", "games")
def paged_season(t):
    """A1: a season and two weeks, which choose the pages that are asked for."""
    return _paged(t).where("season = 1995 and week in (3, 4) and home > 'T05'")
