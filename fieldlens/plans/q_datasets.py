"""Queries of families A and B over deliberately untidy views of the test tables, and of the streaming extensions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.operators import datasets as B
from fieldlens.operators import dedupe as U
from fieldlens.operators import providers as P
from fieldlens.operators import snapshots as S
from fieldlens.plans.q_grouping import LEADERS_BY_LABEL
from fieldlens.plans.registry import query
from fieldlens.sources import readers as A
from fieldlens.sources.feeds import SITEMAP_SPACE, extracted
from fieldlens.sources.feeds import feed_entries as feed_rows
from fieldlens.sources.feeds import sitemap_entries as sitemap_rows
from fieldlens.session import shared_dir
from fieldlens.sources.tables import Table
from fieldlens.streaming import news_stream as J
from fieldlens.streaming.drain import drain, stream_table
from fieldlens.streaming.job_stream import changes, use_rocksdb

_s = lambda c: F.col(c).cast("string")
ID_RANGES = 3


@query("game_projection", "SELECT CAST(game_id AS VARCHAR) AS game_id, season, 'REG' AS game_type, wk AS week, strftime(DATE '2024-01-01' + CAST(wk AS INT), '%A') AS weekday, away AS away_team, away_score::DOUBLE AS away_score, home AS home_team, home_score::DOUBLE AS home_score FROM games", "games")
def game_projection(t):
    g = t.games
    raw = g.select(
        F.concat(F.lit("  "), _s("game_id"), F.lit(" ")).alias("game_key"), F.lit("").alias("game_id"), F.concat(_s("season"), F.lit(".0")).alias("season_year"), F.lit(" reg").alias("game_type"), F.concat(_s("wk"), F.lit(".0")).alias("week"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("wk")), "yyyy-MM-dd").alias("gameday"), F.lower("away").alias("away_team"), F.coalesce(_s("away_score"), F.lit("nan")).alias("away_score"), F.lower("home").alias("home_team"),
        F.col("home_score").cast("double").alias("home_score"),
    )
    return B.games(raw).select("game_id", "season", "game_type", "week", "weekday", "away_team", "away_score", "home_team", "home_score")


@query("play_projection", """SELECT game_id, play_id, coalesce(interception_player_id, receiver_player_id, rusher_player_id) IS NOT NULL AS named, coalesce(receiver_player_id, rusher_player_id, passer_player_id, interception_player_id, sacker, kicker_player_id) AS player_id,
  coalesce(passer_player_id, receiver_player_id, rusher_player_id, interception_player_id, kicker_player_id, sacker) AS primary_player_id FROM plays WHERE game_id <> 0""", "plays")
def play_projection(t):
    raw = t.plays.withColumn("season", F.lit(2024)).withColumn("week", F.lit(3)).withColumnRenamed("sacker", "sack_player_id").withColumn("desc", F.lit("x")).withColumnRenamed("quarter", "qtr")
    named = F.coalesce("interception_player_id", "receiver_player_id", "rusher_player_id").isNotNull()
    return B.plays(raw).select("game_id", "play_id", named.alias("named"), "player_id", "primary_player_id")


@query("player_projection", "SELECT 'C' || c_custkey AS player_id, c_name AS display_name, substr(c_name, 1, 10) AS short_name, CAST(c_custkey % 99 AS VARCHAR) AS jersey_number, 'T' || c_nationkey AS latest_team, lower(c_mktsegment) AS status FROM customer")
def player_projection(t):
    raw = t.customer.select(
        F.lit("").alias("player_id"), F.concat(F.lit("C"), _s("c_custkey")).alias("gsis_id"), F.concat(F.col("c_name"), F.lit("  ")).alias("first_name"), F.lit(None).cast("string").alias("last_name"),
        F.concat(F.col("c_custkey") % 99, F.lit(".0")).alias("jersey_number"), F.concat(F.lit("t"), _s("c_nationkey")).alias("team"), F.col("c_mktsegment").alias("status"),
    )
    return B.players(raw).select("player_id", "display_name", "short_name", "jersey_number", "latest_team", "status")


@query("active_players", "SELECT c_custkey FROM customer WHERE c_custkey % 5 > 1 AND c_custkey % 3 <> 2")
def active_players(t):
    k = F.col("c_custkey")
    raw = t.customer.select("c_custkey", F.when(k % 5 > 0, _sum(k % 5 + 2018)).alias("last_season"), F.when(k % 3 == 0, " Active/Starter").when(k % 3 == 1, "ACT").otherwise("inactive").alias("status"))
    return B.active_players(raw, active_only=True, season=2021).select("c_custkey")


def _sum(c):
    return c.cast("string")


@query("weekly_stats", "SELECT 'S' || s_suppkey AS player_id, 2024 AS season, 1 AS week, s_nationkey, s_acctbal FROM supplier")
def weekly_stats(t):
    raw = t.supplier.select(F.lit("").alias("player_id"), F.concat(F.lit("S"), _s("s_suppkey")).alias("pfr_id"), F.lit(2024).alias("season"), F.lit(1).alias("week"), "s_nationkey", "s_acctbal", "s_name")
    return B.weekly_stats(raw)


@query("game_dedupe_last_wins", "SELECT 'P' || (l_partkey % 200) AS player_id, CAST(l_linenumber AS INT) AS week, arg_max(l_quantity, s) AS qty FROM (SELECT *, l_orderkey * 100 + CAST(l_quantity AS BIGINT) + l_extendedprice / 10000000 AS s FROM lineitem) GROUP BY ALL")
def game_dedupe_last_wins(t):
    seq = F.col("l_orderkey") * 100 + F.col("l_quantity").cast("long") + F.col("l_extendedprice") / 10000000
    raw = t.lineitem.select(F.concat(F.lit("P"), (F.col("l_partkey") % 200).cast("string")).alias("pfr_player_id"), F.lit(2024).alias("season"), F.col("l_linenumber").alias("week"), F.col("l_quantity").alias("qty"), F.lit("pass").alias("stat_type"), seq.alias("seq"))
    return B.pfr(raw, "seq").select("player_id", "week", F.col("metrics")["qty"].alias("qty"))


@query("snap_counts", "SELECT 'S' || s_suppkey AS player_id, CAST(s_suppkey AS VARCHAR) AS game_id, s_acctbal AS offensive_snaps, s_nationkey::DOUBLE AS special_teams_snaps FROM supplier")
def snap_counts(t):
    raw = t.supplier.select(F.concat(F.lit(" S"), _s("s_suppkey")).alias("pfr_player_id"), _s("s_suppkey").alias("game_id"), F.col("s_acctbal").alias("offense_snaps"), _s("s_nationkey").alias("st_snaps"))
    return B.game_snap_counts(raw).select("player_id", "game_id", "offensive_snaps", "special_teams_snaps")


@query("week_snap_counts", "SELECT 'S' || s_suppkey AS player_id, s_nationkey AS offensive_snaps FROM supplier")
def week_snap_counts(t):
    raw = t.supplier.select(F.concat(F.lit("S"), _s("s_suppkey")).alias("player_id"), F.lit(2024).alias("season"), F.lit(1).alias("week"), F.col("s_nationkey").alias("offense_snaps"))
    return B.snap_counts(raw).select("player_id", "offensive_snaps")


@query("depth_keep_min_rank", "WITH r AS (SELECT team, player, pos, seq, CASE WHEN seq % 4 = 0 THEN NULL ELSE seq % 3 + 1 END AS rank FROM rosters UNION ALL SELECT team, player, pos, seq + 100000000, 2 FROM rosters) SELECT team, player AS player_id, pos AS pos_grp, pos || coalesce(min(rank)::VARCHAR, '') AS pos_slot, CAST(min(rank) AS VARCHAR) AS pos_rank FROM r GROUP BY team, player, pos", "rosters")
def depth_keep_min_rank(t):
    r = t.rosters
    one = r.select("team", F.col("player").alias("gsis_id"), F.col("pos").alias("pos_abb"), F.when(F.col("seq") % 4 != 0, F.concat(_s("seq") % 3 + 1, F.lit(""))).alias("depth_chart_order"), F.lit(2024).alias("season"), F.lit(2).alias("week"), "seq")
    two = one.withColumn("depth_chart_order", F.lit("2.0")).withColumn("seq", F.col("seq") + 100000000)
    return B.depth_charts(one.union(two), "seq").select("team", "player_id", "pos_grp", "pos_slot", "pos_rank")


@query("roster_projection", "SELECT upper(team) AS team, player, pos AS depth_chart_position, season, wk AS week FROM rosters", "rosters")
def roster_projection(t):
    raw = t.rosters.select(F.lower("team").alias("recent_team"), F.col("player").alias("gsis_id"), F.lower("pos").alias("position"), F.concat(_s("season"), F.lit(".0")).alias("season"), F.col("wk").alias("week"), "player_name")
    return B.rosters(raw).select("team", "player", "depth_chart_position", "season", "week")


@query("next_gen_stats", "SELECT 'S' || s_suppkey AS player_id, 2024 AS season, CAST(s_suppkey % 4 AS INT) AS week, 'passing' AS stat_type, s_acctbal FROM supplier WHERE s_suppkey % 5 <> 0")
def next_gen_stats(t):
    k = F.col("s_suppkey")
    raw = t.supplier.select(F.lit(" ").alias("player_gsis_id"), F.when(k % 5 != 0, F.concat(F.lit("S"), _s("s_suppkey"))).alias("pfr_id"), F.lit("2024").alias("season"), (k % 4).cast("string").alias("week"), "s_acctbal")
    return B.next_gen_stats(raw, "passing").select("player_id", "season", "week", "stat_type", "s_acctbal")


@query("ftn_projection", "SELECT p_partkey AS ftn_play_id, trim(p_name) AS note FROM part WHERE p_partkey <> 0")
def ftn_projection(t):
    raw = t.part.select(F.col("p_partkey").alias("ftn_play_id"), F.lit(2024).alias("season"), F.lit(2).alias("week"), F.concat(F.lit(" "), "p_name", F.lit("\t")).alias("note"))
    return B.ftn(raw).select("ftn_play_id", "note")


@query("injury_projection", """SELECT CASE c_custkey % 4 WHEN 0 THEN 'KC' WHEN 1 THEN 'LV' WHEN 2 THEN 'GB' END AS team_abbr, c_name AS player_name, CASE c_custkey % 3 WHEN 0 THEN 'Did Not Practice' WHEN 1 THEN NULL ELSE 'Was Ill Today' END AS practice_status FROM customer WHERE c_custkey % 4 <> 3""")
def injury_projection(t):
    k = F.col("c_custkey")
    raw = t.customer.select(
        F.when(k % 4 == 0, "kan").when(k % 4 == 1, "oak").otherwise("??").alias("team_abbr"), F.when(k % 4 == 2, "Green Bay Packers").otherwise("nobody").alias("team_name"), F.concat(F.lit(" "), "c_name").alias("player_name"),
        F.when(k % 3 == 0, "D N P").when(k % 3 == 1, "--").otherwise("was   ILL today").alias("practice_status"),
    )
    return B.injuries(raw).select("team_abbr", "player_name", "practice_status")


@query("team_projection", "SELECT 'N' || n_nationkey AS team_abbr, 'City ' || n_name AS team_name, n_name AS team_nick, CAST(n_regionkey AS VARCHAR) AS team_conference FROM nation")
def team_projection(t):
    raw = t.nation.select(F.concat(F.lit("n"), _s("n_nationkey")).alias("abbr"), F.lit("City").alias("location"), F.col("n_name").alias("nickname"), _s("n_regionkey").alias("team_conf"))
    return B.teams(raw).select("team_abbr", "team_name", "team_nick", "team_conference")


@query("tagged_union", "SELECT o_orderstatus AS k, 'orders' AS stat_type, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT l_linestatus, 'lines', count(*) FROM lineitem GROUP BY ALL")
def tagged_union(t):
    both = A.tagged_union({"orders": t.orders.select(F.col("o_orderstatus").alias("k"), "o_orderkey"), "lines": t.lineitem.select(F.col("l_linestatus").alias("k"), "l_tax")})
    return both.groupBy("k", "stat_type").agg(F.count("*").alias("n"))


@query("latest_week_per_team", "WITH m AS (SELECT team, max(wk) AS wk FROM rosters GROUP BY team) SELECT r.team, player, (SELECT max(wk) FROM rosters)::INT AS wk FROM rosters r JOIN m ON r.team = m.team AND r.wk = m.wk", "rosters")
def latest_week_per_team(t):
    return S.latest_relabelled(t.rosters, "team", "wk").select("team", "player", "wk")


@query("latest_snapshot", "WITH a AS (SELECT *, max(season) OVER (PARTITION BY team) AS s FROM rosters), b AS (SELECT *, max(wk) OVER (PARTITION BY team) AS w FROM a WHERE season = s) SELECT team, player FROM b WHERE wk = w", "rosters")
def latest_snapshot(t):
    return S.latest_per_group(t.rosters, "team", "season", "wk").select("team", "player")


@query("latest_season", "SELECT count(*) AS n FROM games WHERE season = (SELECT max(season) FROM games)", "games")
def latest_season(t):
    return S.latest_values(t.games, "season").agg(F.count("*").alias("n"))


@query("semi_known_refs", "SELECT player FROM rosters WHERE team IN (SELECT team_abbr FROM teams WHERE conference = 'ASIA')", "rosters teams")
def semi_known_refs(t):
    return S.known(t.rosters, t.teams.where("conference = 'ASIA'").withColumnRenamed("team_abbr", "team"), "team")[0].select("player")


@query("anti_unknown_refs", "SELECT player FROM rosters WHERE team NOT IN (SELECT team_abbr FROM teams WHERE conference = 'ASIA')", "rosters teams")
def anti_unknown_refs(t):
    return S.known(t.rosters, t.teams.where("conference = 'ASIA'").withColumnRenamed("team_abbr", "team"), "team")[1].select("player")


_VERSIONED = "cur AS (SELECT season, wk, player, CAST(1 + season % 2 AS INT) AS version, true AS is_current FROM rosters WHERE seq % 2 = 0), inc AS (SELECT season, wk, player FROM rosters WHERE seq % 3 = 0 AND wk < 5)"


@query("versioned_append", f"""WITH {_VERSIONED} SELECT season, wk, player, version, (season, wk) NOT IN (SELECT (season, wk) FROM inc) AS is_current FROM cur
  UNION ALL SELECT i.season, i.wk, i.player, CAST(coalesce(v, 0) + 1 AS INT), true FROM inc i LEFT JOIN (SELECT season, wk, max(version) AS v FROM cur GROUP BY ALL) m ON i.season = m.season AND i.wk = m.wk""", "rosters")
def versioned_append(t):
    current = t.rosters.where("seq % 2 = 0").select("season", "wk", "player", (1 + F.col("season") % 2).cast("int").alias("version"), F.lit(True).alias("is_current"))
    return S.append_version(current, t.rosters.where("seq % 3 = 0 and wk < 5").select("season", "wk", "player"), ["season", "wk"]).select("season", "wk", "player", "version", "is_current")


@query("version_history", "SELECT season, CAST(1 + wk % 3 AS INT) AS version, count(*) AS n, bool_or(wk > 4) AS is_current FROM rosters GROUP BY ALL", "rosters")
def version_history(t):
    return S.version_history(t.rosters.select("season", (1 + F.col("wk") % 3).cast("int").alias("version"), (F.col("wk") > 4).alias("is_current")), ["season"])


@query("upsert_state", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN -1.0 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 4 = 0")
def upsert_state(t):
    target = t.customer.where("c_custkey % 3 <> 0").select("c_custkey", "c_acctbal")
    return S.upsert(target, t.customer.where("c_custkey % 4 = 0").select("c_custkey", F.lit(-1.0).alias("c_acctbal")), ["c_custkey"])


@query("clear_with_guard", "SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0 OR c_mktsegment = 'BUILDING'")
def clear_with_guard(t):
    marked = t.customer.withColumn("seg", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")))
    return S.clear_except(marked, "seg", "BUILDING").select("c_custkey")


@query("insert_new_urls", "SELECT url, min(item_id) AS item_id FROM news WHERE url NOT IN (SELECT url FROM news WHERE item_id % 13 = 0) GROUP BY url", "news")
def insert_new_urls(t):
    return S.insert_new(t.news.where("item_id % 13 = 0"), t.news, "url", "item_id").select("url", "item_id")


@query("position_pivot", "SELECT team, " + ", ".join(f"count(*) FILTER (pos IN ({', '.join(repr(p) for p in ps)})) AS {g}" for g, ps in S.POSITION_GROUPS.items()) + ", count(*) FILTER (pos = 'XX') AS OTH, count(*) AS total FROM rosters GROUP BY team", "rosters")
def position_pivot(t):
    return S.position_rollup(t.rosters.withColumnRenamed("pos", "position"))


@query("starters", "SELECT team, arg_min(player, seq) FILTER (pos = 'QB' AND seq % 2 = 0) AS qb, arg_min(player, seq) FILTER (pos = 'WR' AND seq % 2 = 0) AS wr, count(*) AS entries FROM rosters GROUP BY team", "rosters")
def starters(t):
    return S.starters(t.rosters.withColumn("pos_rank", F.when(F.col("seq") % 2 == 0, "1").otherwise("2"))).select("team", "qb", "wr", "entries")


@query("residual_filters", "SELECT doc_id FROM documents WHERE lang IN ('de', 'fr') AND source = 'src3' AND (doc_id % 2 = 0 OR doc_id % 3 = 0)")
def residual_filters(t):
    k = F.col("doc_id")
    tagged = t.documents.withColumn("tags", F.array_compact(F.array(F.when(k % 2 == 0, "even"), F.when(k % 3 == 0, "third"), F.lit("all"))))
    provider = P.Provider(lambda: tagged, required=("source",), drop=("text",))
    return P.residual(provider.get(source="src3", lang=["de", "fr"], tags=["even", "third"]), {"tags": "all"}).select("doc_id")


@query("season_week_of_id", "SELECT game_id, season, wk AS week FROM games", "games")
def season_week_of_id(t):
    season, week = P.season_week_of(F.concat_ws("_", F.col("season").cast("string"), F.lpad(F.col("wk").cast("string"), 2, "0"), "away", "home"))
    return t.games.select("game_id", season.alias("season"), week.alias("week"))


@query("player_lookup", "SELECT player, player_name FROM rosters WHERE player_name ILIKE '%0012%' ORDER BY player_name, player LIMIT 7", "rosters")
def player_lookup(t):
    return P.find_players(t.rosters, "0012", limit=7).select("player", "player_name")


@query("season_calendar", "SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 3 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END::INT AS season, (floor(date_diff('day', DATE '1992-01-01', o_orderdate::DATE) / 7) + 1)::INT AS week FROM orders")
def season_calendar(t):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", P.season_of(day).cast("int").alias("season"), P.week_of(day, F.lit("1992-01-01").cast("date")).alias("week"))


@query("id_parts", "SELECT game_id, season AS id_season, wk AS id_week, away AS away_team, home AS home_team FROM games", "games")
def id_parts(t):
    from fieldlens.operators.plays import id_parts as parts

    g = t.games.select("game_id", F.concat_ws("_", F.col("season").cast("string"), F.col("wk").cast("string"), "away", "home").alias("key"))
    return parts(g, "key").drop("key")


@query("page_articles", "SELECT page_id, regexp_matches(html, '<p[ >]') AS has_text FROM pages")
def page_articles(t):
    return A.html_articles(t.pages).select("page_id", (F.size("paragraphs") > 0).alias("has_text"))


@query("page_meta", "SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title, regexp_extract(html, '(?is)<html\\b[^>]*\\blang=\"([^\"]+)\"', 1) AS language FROM pages")
def page_meta(t):
    meta = A.meta_tags(F.col("html"))
    return t.pages.select("page_id", F.coalesce(meta["title"], F.lit("")).alias("title"), F.coalesce(meta["language"], F.lit("")).alias("language"))


@query("nested_injuries", """SELECT 'T' || doc_id AS team_name, 'P' || doc_id || '_' || k AS player_name, CASE WHEN k % 2 = 0 THEN 'Knee' ELSE 'Ankle' END AS injury
  FROM (SELECT doc_id, unnest(range(doc_id % 3)) AS k FROM documents)""")
def nested_injuries(t):
    """Teams with no, one and two injured players."""
    one = lambda k: F.format_string('{"athlete": {"displayName": "P%d_' + str(k) + '"}, "details": {}, "type": {"description": "' + ("Knee", "Ankle")[k] + '"}, "status": "Out"}', "doc_id")
    hurt = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(F.col("doc_id") % 3 == 1, one(0)).otherwise(F.concat_ws(", ", one(0), one(1)))
    text = F.concat(F.format_string('{"injuries": [{"team": {"displayName": "T%d"}, "injuries": [', "doc_id"), hurt, F.lit("]}]}"))
    return A.nested_injuries(t.documents.select(text.alias("payload"))).select("team_name", "player_name", "injury")


@query("json_nodes", "SELECT doc_id AS id, '$' || repeat('.a', (doc_id % 4)::INT) || '.b[' || (doc_id % 3) || ']' AS path FROM documents")
def json_nodes(t):
    """Nodes at depths and places that vary."""
    deep, before = (F.col("doc_id") % 4).cast("int"), (F.col("doc_id") % 3).cast("int")
    text = F.concat(F.repeat(F.lit('{"a": '), deep), F.lit('{"b": ['), F.repeat(F.lit("2, "), before), F.lit('{"players": [1]}]}'), F.repeat(F.lit("}"), deep))
    return A.nodes_with(t.documents.select("doc_id", text.alias("j")), "doc_id", "j", ["players"]).select("id", "path")


@query("html_tables", "SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'Chiefs' ELSE 'Bears' END AS heading, 'A ' || doc_id || '_' || k AS player, 'Knee' AS injury FROM (SELECT doc_id, unnest(range(1 + doc_id % 3)) AS k FROM documents)")
def html_tables(t):
    """Tables of one to three rows under different headings."""
    row = lambda k: F.when(F.col("doc_id") % 3 >= k, F.format_string(f"<tr><td><a>A %d_{k}</a></td><td>QB</td><td>Knee</td></tr>", "doc_id")).otherwise("")
    heading = F.when(F.col("doc_id") % 2 == 0, "<h3>Chiefs</h3>").otherwise("<h3>Bears</h3>")
    html = F.concat(heading, F.lit("<table><tr><th>Player Name</th><th>Pos</th><th>Injuries</th></tr>"), row(0), row(1), row(2), F.lit("</table>"))
    return A.html_tables(t.documents.select("doc_id", html.alias("h")), "doc_id", "h", {"player": ["player"], "injury": ["injur"]})


_MARKED = "replace(replace(%s, '&', '&amp;'), '<', '&lt;')"
_TITLE = "'T&' || substr(coalesce(text, ''), 1, 20) || '<' || doc_id"
_FEED_OF = "source || '/' || CAST(floor(doc_id / 3000) AS BIGINT)"  # so that no payload grows with the table


def _payloads(t, item: str, hidden: str) -> DataFrame:
    """One payload for each source and 3,000 ids: an item for each document, by id, and a hidden one in a comment after each."""
    texts = t.documents.where("source is not null").selectExpr(f"{_FEED_OF} AS source", "doc_id", rf"regexp_replace({_TITLE}, '[\\x00-\\x1f]|]]>', ' ') AS title")
    rows = texts.selectExpr("source", "doc_id", f"{item} || '<!-- ' || {hidden} || ' -->' AS item")
    return rows.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda r: r["item"]), "").alias("items"))


_OWN = rf"SELECT {_FEED_OF} AS source, doc_id, trim(regexp_replace({_TITLE}, '[\x00-\x1f]|]]>', ' ', 'g')) AS title, row_number() OVER (PARTITION BY {_FEED_OF} ORDER BY doc_id) AS r FROM documents WHERE source IS NOT NULL"


@query("feed_entries", f"""SELECT source, 'https://x.com/?id=' || doc_id || '&s=' || source AS url, title, CASE WHEN doc_id % 4 = 3 THEN 'by ' || source END AS author, CASE WHEN doc_id % 2 = 0 THEN 'a&b,' || source ELSE '' END AS tags,
  CASE WHEN doc_id % 5 < 4 THEN TIMESTAMP '2024-01-02 03:04:05' + INTERVAL (doc_id % 60) SECOND END AS published FROM ({_OWN}) WHERE r <= 1000 AND doc_id % 7 <> 0""")
def feed_entries(t):
    """A feed for each source, RSS or Atom, some with prefixes: entities, CDATA, comments, media titles, links of several kinds, dates in four places; one in seven entries has no link."""
    plain, cdata = _MARKED % "title", "'<![CDATA[' || title || ']]>'"
    url = _MARKED % "'https://x.com/?id=' || doc_id || '&s=' || source"
    at = "TIMESTAMP '2024-01-02 03:04:05' + make_dt_interval(0, 0, 0, doc_id % 60)"
    mail, iso = f"date_format({at}, \"EEE, dd MMM yyyy HH:mm:ss 'GMT'\")", f"date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    rss = f"""'<item><media:title>no</media:title><title>' || CASE WHEN doc_id % 3 = 0 THEN {cdata} ELSE {plain} END || '</title>' ||
      CASE WHEN doc_id % 7 = 0 THEN '<guid isPermaLink="false">' || doc_id || '</guid>' WHEN doc_id % 3 = 1 THEN '<link><![CDATA[https://x.com/?id=' || doc_id || '&s=' || source || ']]></link>' WHEN doc_id % 3 = 2 THEN '<guid>' || {url} || '</guid>' ELSE '<link> ' || {url} || ' </link>' END ||
      CASE doc_id % 5 WHEN 0 THEN '<pubDate>' || {mail} || '</pubDate>' WHEN 1 THEN '<dc:date>' || {iso} || '</dc:date>' WHEN 2 THEN '<pubDate>soon</pubDate><dcterms:created>' || {iso} || '</dcterms:created>' WHEN 3 THEN '<updated>' || {iso} || '</updated>' ELSE '' END ||
      CASE WHEN doc_id % 4 = 3 THEN '<dc:creator>by ' || source || '</dc:creator>' ELSE '' END || CASE WHEN doc_id % 2 = 0 THEN '<category>a&amp;b</category><category>' || source || '</category>' ELSE '' END || '</item>'"""
    atom = f"""'<entry><title type="html">' || CASE WHEN doc_id % 3 = 0 THEN {cdata} ELSE {plain} END || '</title><link rel="self" href="https://self"/>' || CASE WHEN doc_id % 7 = 0 THEN '' ELSE '<link href="' || {url} || '"/>' END ||
      CASE WHEN doc_id % 5 < 2 THEN '<published>' || {iso} || '</published>' WHEN doc_id % 5 < 4 THEN '<updated>' || {iso} || '</updated>' ELSE '' END ||
      CASE WHEN doc_id % 4 = 3 THEN '<author><name>by ' || source || '</name></author>' ELSE '' END || CASE WHEN doc_id % 2 = 0 THEN '<category term="a&amp;b"/><category term="' || source || '"/>' ELSE '' END || '</entry>'"""
    hidden = "'<item><link>https://hidden</link></item>'"
    spaces = 'xmlns:media="urn:media" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:dcterms="http://purl.org/dc/terms/"'
    kind = F.pmod(F.crc32("source"), F.lit(3))
    of = lambda item: _payloads(t, item, hidden)
    wrapped = lambda df, head, tail: df.select("source", F.concat(F.lit(head), "items", F.lit(tail)).alias("xml"))
    feeds = wrapped(of(rss).where(kind == 0), f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0" {spaces}><channel><title>C</title><atom:link xmlns:atom="http://www.w3.org/2005/Atom" href="https://own"/>', "</channel></rss>")
    feeds = feeds.union(wrapped(of(atom).where(kind == 1), '<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>', "</feed>"))
    prefixed = F.regexp_replace("items", r"(</?)(entry|title|link|published|updated|author|name|category)\b", "$1a:$2")
    feeds = feeds.union(wrapped(of(atom).where(kind == 2).withColumn("items", prefixed), '<a:feed xmlns:a="http://www.w3.org/2005/Atom">', "</a:feed>"))
    found = feed_rows(feeds)
    return found.select("source", "url", "title", "author", F.array_join("tags", ",").alias("tags"), F.col("published").cast("timestamp_ntz").alias("published"))


@query("sitemap_entries", f"""SELECT source, 'https://x.com/?id=' || doc_id || '&s=' || source AS url, CASE WHEN doc_id % 2 = 0 THEN title END AS title, CASE WHEN doc_id % 3 < 2 THEN TIMESTAMP '2024-01-02 00:00:00' + INTERVAL (doc_id % 20) DAY END AS published
  FROM ({_OWN}) WHERE r <= 5000 AND doc_id % 7 <> 0""")
def sitemap_entries(t):
    """A sitemap for each source, some with a prefix: entities, CDATA, comments, images with addresses of their own, and news elements that date what has no change date."""
    url, plain = _MARKED % "'https://x.com/?id=' || doc_id || '&s=' || source", _MARKED % "title"
    day = "date_format(TIMESTAMP '2024-01-02 00:00:00' + make_dt_interval(CAST(doc_id % 20 AS INT)), 'yyyy-MM-dd')"
    item = f"""'<url>' || CASE WHEN doc_id % 7 = 0 THEN '<loc> </loc>' WHEN doc_id % 2 = 0 THEN '<loc><![CDATA[https://x.com/?id=' || doc_id || '&s=' || source || ']]></loc>' ELSE '<loc> ' || {url} || '</loc>' END || '<image:image><image:loc>https://img</image:loc></image:image>' ||
      CASE WHEN doc_id % 3 = 0 THEN '<lastmod>' || {day} || '</lastmod>' ELSE '' END || '<news:news>' || CASE WHEN doc_id % 2 = 0 THEN '<news:title>' || {plain} || '</news:title>' ELSE '' END ||
      CASE doc_id % 3 WHEN 0 THEN '<news:publication_date>2001-01-01</news:publication_date>' WHEN 1 THEN '<news:publication_date>' || {day} || 'T02:00:00+02:00</news:publication_date>' ELSE '' END || '</news:news></url>'"""
    maps = _payloads(t, item, "'<url><loc>https://hidden</loc></url>'")
    spaces = 'xmlns:news="http://www.google.com/schemas/sitemap-news/0.9" xmlns:image="urn:image"'
    prefix = F.pmod(F.crc32("source"), F.lit(2)) == 0
    named = F.when(prefix, F.concat(F.lit(f'<s:urlset xmlns:s="{SITEMAP_SPACE}" {spaces}>'), F.regexp_replace("items", r"(</?)(url|loc|lastmod)\b", "$1s:$2"), F.lit("</s:urlset>")))
    maps = maps.select("source", F.coalesce(named, F.concat(F.lit(f'<urlset xmlns="{SITEMAP_SPACE}" {spaces}>'), "items", F.lit("</urlset>"))).alias("xml"))
    return sitemap_rows(maps).select("source", "url", "title", F.col("published").cast("timestamp_ntz").alias("published"))


_SOURCES = "sources AS (SELECT n_nationkey AS k, 'S' || n_nationkey AS source, CAST(24 - n_nationkey AS INT) AS source_order, CASE WHEN n_nationkey % 5 = 4 THEN 'timeout' WHEN n_nationkey % 7 = 3 THEN 'missing result' WHEN n_nationkey % 2 = 1 AND n_nationkey % 9 = 7 THEN 'invalid xml' END AS error FROM nation)"


def _extracted(t):
    """Feeds and sitemaps of one to three entries; some sources fail, some were never read, and one sitemap breaks off."""
    k = F.col("n_nationkey")
    rss = F.transform(F.sequence(F.lit(0), k % 3), lambda i: F.concat(F.lit("<item><title>T</title><link>https://x.com/"), k, F.lit("/"), i, F.lit("</link></item>")))
    maps = F.transform(F.sequence(F.lit(0), k % 3), lambda i: F.concat(F.lit("<url><loc>https://x.com/"), k, F.lit("/"), i, F.lit("</loc></url>")))
    xml = F.when(k % 2 == 0, F.concat(F.lit("<rss>"), F.array_join(rss, ""), F.lit("</rss>"))).otherwise(F.concat(F.lit(f'<urlset xmlns="{SITEMAP_SPACE}">'), F.array_join(maps, ""), F.when(k % 9 != 7, F.lit("</urlset>")).otherwise("")))
    sources = t.nation.select(F.concat(F.lit("S"), k).alias("source"), (24 - k).cast("int").alias("source_order"), F.when(k % 2 == 0, "rss").otherwise("sitemap").alias("kind"))
    return extracted(sources, t.nation.where("n_nationkey % 7 <> 3 or n_nationkey % 5 = 4").select(F.concat(F.lit("S"), k).alias("source"), F.when(k % 5 != 4, xml).alias("xml"), F.when(k % 5 == 4, "timeout").alias("error")))


@query("source_extraction", f"WITH {_SOURCES} SELECT source, source_order, CAST(i AS INT) AS pos, 'https://x.com/' || k || '/' || i AS url FROM (SELECT *, unnest(range(1 + k % 3)) AS i FROM sources WHERE error IS NULL)")
def source_extraction(t):
    return _extracted(t)[0].select("source", "seq.source_order", "seq.pos", "url")


@query("source_outcomes", f"WITH {_SOURCES} SELECT source, source_order, error IS NULL AS success, error, CASE WHEN error IS NULL THEN 1 + k % 3 ELSE 0 END::BIGINT AS found FROM sources")
def source_outcomes(t):
    return _extracted(t)[1]


@query("api_articles", "SELECT 'https://x.com/' || doc_id AS url, CASE WHEN doc_id % 2 = 0 THEN 'Draft' ELSE 'Trade' END AS tag FROM documents WHERE doc_id % 3 <> 2")
def api_articles(t):
    """Replies whose first item is a story or, in one of three, a clip that is not read."""
    kind, tag = F.when(F.col("doc_id") % 3 == 2, "Clip").otherwise("Story"), F.when(F.col("doc_id") % 2 == 0, "Draft").otherwise("Trade")
    text = F.format_string('{"articles": [{"type": "%s", "headline": "h", "links": {"web": {"href": "https://x.com/%d"}}, "categories": [{"description": "%s"}, {}]}, {"type": "Clip", "links": {"web": {"href": "https://x.com/"}}}]}', kind, "doc_id", tag)
    return A.api_articles(t.documents.select(text.alias("payload"))).select("url", F.get("tags", F.lit(0)).alias("tag"))


@query("fact_parse", "SELECT doc_id, 'one ' || doc_id || '|two' AS facts FROM documents")
def fact_parse(t):
    """Whole replies, fenced ones, and ones that break off."""
    k, one = F.col("doc_id") % 3, F.format_string('{"facts": ["one %d", "two"', "doc_id")
    text = F.when(k == 0, F.concat(one, F.lit("]}"))).when(k == 1, F.concat(F.lit("```json\n"), one, F.lit("]}\n```"))).otherwise(F.concat(F.lit("```json\n"), one, F.lit(', "thr')))
    return t.documents.select("doc_id", F.array_join(A.parsed_facts(text), "|").alias("facts"))


@query("document_flatten", "SELECT doc_id AS id, unnest(['head', 'body[1].x', 'body']) AS path, unnest(['H' || doc_id, 'X', 'B']) AS text FROM documents")
def document_flatten(t):
    text = F.format_string('{"head": "H%d", "body": ["B", {"x": "X"}], "n": null}', "doc_id")
    return A.flattened(t.documents.select("doc_id", text.alias("j")), "doc_id", "j").select("id", "path", "text")


@query("event_tumbling", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_tumbling(t):
    return J.tumbling(t.events).withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("event_session", """WITH g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
  SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_session(t):
    return J.sessions(t.events).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(t):
    return U.distinct_rows(t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", F.create_map(F.lit("a"), F.lit(1)).alias("m"))).drop("m")


@query("value_cleaning", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS v, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'S' END AS player_id FROM supplier")
def value_cleaning(t):
    from fieldlens.operators.plays import cleaned

    k = F.col("s_suppkey")
    raw = t.supplier.select("s_suppkey", F.when(k % 3 == 0, F.lit(float("nan"))).otherwise(F.col("s_acctbal")).alias("v"), F.when(k % 2 == 0, "null").otherwise("S").alias("player_id"))
    return cleaned(raw)


@query("id_mapping", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN '00-' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') WHEN 1 THEN 'static' || s_suppkey ELSE 'roster' || s_suppkey END AS league_id FROM supplier")
def id_mapping(t):
    from fieldlens.operators.plays import mapped_ids

    k = F.col("s_suppkey")
    asked = t.supplier.select("s_suppkey", F.when(k % 3 == 0, F.concat(F.lit("00"), F.lpad(_s("s_suppkey"), 7, "0"))).otherwise(F.concat(F.lit("Ab"), _s("s_suppkey"))).alias("pid"))
    of = lambda kind, want: t.supplier.where(k % 3 == want).select(F.concat(F.lit("AB"), _s("s_suppkey")).alias("other_id"), F.concat(F.lit(kind), _s("s_suppkey")).alias("league_id"))
    roster = of("roster", 2).union(of("late", 1))
    return mapped_ids(asked, "pid", of("static", 1), of("table", 0), roster).select("s_suppkey", "league_id")


@query("roster_fill", "SELECT player, CASE WHEN seq % 2 = 0 THEN pos ELSE 'known' END AS position FROM rosters", "rosters")
def roster_fill(t):
    from fieldlens.operators.plays import filled

    asked = t.rosters.select("player", F.when(F.col("seq") % 2 != 0, "known").alias("position"))
    return filled(asked, t.rosters.select("player", F.col("pos").alias("position"), "seq"), "player", ["position"], "seq")


@query("snap_lines", "SELECT s_suppkey, CAST(round_even(CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey ELSE s_nationkey + 3.5 END, 0) AS INT) AS snaps_played, CASE WHEN s_suppkey % 2 = 0 THEN 0.5 ELSE 0.25 END::DOUBLE AS snap_share FROM supplier")
def snap_lines(t):
    from fieldlens.operators.plays import snap_line

    k = F.col("s_suppkey")
    raw = t.supplier.select(
        "s_suppkey", F.when(k % 2 == 0, F.col("s_nationkey")).alias("snaps"), F.when(k % 2 != 0, F.col("s_nationkey").cast("double")).alias("offensive_snaps"), F.lit(None).cast("double").alias("defensive_snaps"), F.lit(3.5).alias("special_teams_snaps"),
        F.when(k % 2 == 0, F.lit(0.5)).alias("snap_pct"), F.lit(None).cast("double").alias("offensive_pct"), F.lit(0.25).alias("defensive_pct"), F.lit(0.75).alias("special_teams_pct"),
    )
    return snap_line(raw).select("s_suppkey", "snaps_played", "snap_share")


@query("same_game", "SELECT game_id AS asked, count(*) AS n, min(CASE WHEN game_id % 2 = 0 THEN 1 ELSE 3 END)::INT AS how FROM games GROUP BY game_id", "games")
def same_game(t):
    from fieldlens.operators.plays import same_game as match

    g = t.games.select("game_id", F.concat(F.lit("x"), _s("game_id")).alias("pfr_game_id"), "season", F.col("game_id").alias("week"), F.col("home").alias("team"), F.col("away").alias("opponent"))
    other = g.select(F.when(F.col("game_id") % 2 == 0, F.col("game_id")).otherwise(-F.col("game_id")).alias("game_id"), F.lit("none").alias("pfr_game_id"), "season", "week", F.col("opponent").alias("team"), F.col("team").alias("opponent"))
    return match(g, other).groupBy("asked").agg(F.count("*").alias("n"), F.min("how").alias("how"))


@query("stat_records", "SELECT 'P' || (s_suppkey % 20) AS player_id, CAST(count(DISTINCT s_nationkey % 2) AS INT) AS n FROM supplier GROUP BY ALL")
def stat_records(t):
    from fieldlens.operators.plays import stat_records as records

    rows = t.supplier.groupBy(F.concat(F.lit("P"), (F.col("s_suppkey") % 20).cast("string")).alias("player_id"), (F.col("s_nationkey") % 2).cast("string").alias("stat_type")).agg(F.sum("s_acctbal").alias("v"))
    return records(rows, "player_id", "stat_type").select("player_id", F.size("records").alias("n"))


def _providers(t):
    plays = t.plays.select(F.concat_ws("_", F.lit("2024"), F.lpad((F.col("game_id") % 18 + 1).cast("string"), 2, "0"), F.col("game_id").cast("string")).alias("game_id"), "play_id", F.lit(2024).alias("season"), (F.col("game_id") % 18 + 1).cast("int").alias("week"), F.col("passer_player_id").alias("player_id"))
    injuries = t.customer.select(F.lit(2024).alias("season"), (F.col("c_custkey") % 5).cast("int").alias("week"), F.lit("REG").alias("season_type"), F.concat(F.lit("T"), _s("c_nationkey")).alias("team_abbr"), _s("c_custkey").alias("player_id"), (F.col("c_custkey") % 2 == 0).alias("is_current"))
    weekly = t.customer.select(_s("c_custkey").alias("player_id"), F.lit(2024).alias("season"), (F.col("c_custkey") % 4).cast("int").alias("week"), F.col("c_name").alias("player_name"), "c_acctbal")
    tables = {"plays": plays, "snap_counts": plays, "injuries": injuries, "weekly_stats": weekly, "ngs": weekly.withColumn("stat_type", F.lit("passing")), "pfr": weekly, "ftn": weekly, "games": t.games, "rosters": t.rosters}
    return P.registry(tables.__getitem__)


@query("pbp_provider", "SELECT play_id FROM plays WHERE game_id = 160", "plays")
def pbp_provider(t):
    return _providers(t)["pbp"].get(game_id=" 2024_17_160 ").select("play_id")


@query("snap_provider", "SELECT play_id FROM plays WHERE game_id % 18 = 2 AND game_id = 128 AND passer_player_id IS NOT NULL AND passer_player_id = (SELECT min(passer_player_id) FROM plays WHERE game_id = 128)", "plays")
def snap_provider(t):
    first = t.plays.where("game_id = 128").agg(F.min("passer_player_id")).first()[0] or "none"
    return _providers(t)["snap_counts"].get(games_id="2024_03_128", pfr_id=first).select("play_id")


@query("ngs_provider", "SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_acctbal FROM customer WHERE c_custkey IN (5, 6, 9, 12, 13) AND c_custkey % 4 IN (1, 2)")
def ngs_provider(t):
    return _providers(t)["ngs"].get(season="2024", week=["1 ", 2, None], player_id=["5", " 6", "9", "12", "13", ""], stat_type="passing").select("player_id", "c_acctbal")


@query("weekly_provider", "SELECT CAST(c_custkey AS VARCHAR) AS player_id, 2024 AS season, CAST(c_custkey % 4 AS INT) AS week, c_acctbal FROM customer WHERE c_custkey IN (5, 9)")
def weekly_provider(t):
    return _providers(t)["player_weekly_stats"].get(season=2024, week=1, player_id=["5", "9"])


@query("pfr_provider", "SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_acctbal FROM customer WHERE c_custkey = 7")
def pfr_provider(t):
    return _providers(t)["pfr"].get(season=2024, pfr_id="7").select("player_id", "c_acctbal")


@query("injuries_provider", "SELECT CAST(c_custkey AS VARCHAR) AS player_id FROM customer WHERE c_custkey % 5 = 3 AND c_nationkey = 7 AND c_custkey % 2 = 0")
def injuries_provider(t):
    return _providers(t)["injuries"].get(season=2024, week=3, team_abbr=" t7 ").select("player_id")


@query("team_season_provider", "SELECT season, count(home_score + away_score) AS games_played FROM games WHERE season = 1995 AND (home = 'T07' OR away = 'T07') GROUP BY season", "games")
def team_season_provider(t):
    return _providers(t)["team_season_stats"].get(team_abbr="t07", season=1995).select("season", "games_played")


@query("play_adaptation", "SELECT game_id, play_id, CAST(quarter AS VARCHAR) AS time, CAST(yards_gained AS VARCHAR) IS NOT NULL AS gained, CAST(1 AS INT) AS n_more FROM plays", "plays")
def play_adaptation(t):
    from fieldlens.operators.plays import adapted

    raw = t.plays.select("game_id", "play_id", F.col("quarter").cast("string").alias("clock"), "yards_gained", F.lit("x").alias("weather"), F.lit(None).cast("string").alias("nothing"))
    return adapted(raw).select("game_id", "play_id", "time", F.col("yards_gained").isNotNull().alias("gained"), F.size("additional_fields").alias("n_more"))


@query("calendar_week", """WITH d AS (SELECT event_id, DATE '2023-07-20' + CAST(event_id % 240 AS INT) AS day FROM events), w AS (SELECT *, (floor((day - DATE '2023-08-03') / 7) + 1)::INT AS e, (floor((day - DATE '2023-09-07') / 7) + 1)::INT AS w FROM d)
  SELECT event_id, CASE WHEN day < DATE '2023-08-03' OR w > 22 THEN NULL WHEN day < DATE '2023-09-07' THEN least(e, 3) WHEN w <= 18 THEN w ELSE w - 18 END AS week,
  CASE WHEN day < DATE '2023-08-03' OR w > 22 THEN NULL WHEN day < DATE '2023-09-07' THEN 'pre' WHEN w <= 18 THEN 'reg' ELSE 'post' END AS part FROM w""")
def calendar_week(t):
    day = F.date_add(F.lit("2023-07-20").cast("date"), (F.col("event_id") % 240).cast("int"))
    week, part = P.calendar_week(day, F.lit("2023-08-03").cast("date"), F.lit(P.opening_day(2023)))
    return t.events.select("event_id", week.alias("week"), part.alias("part"))


@query("stream_tumbling", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def stream_tumbling(t):
    """The windows of event_tumbling, from a stream."""
    return drain(J.tumbling(stream_table(t.spark, t.sf_dir, "events")), "complete").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("stream_sessions", """WITH g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
  SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def stream_sessions(t):
    """The sessions of event_session, from a stream."""
    return drain(J.sessions(stream_table(t.spark, t.sf_dir, "events")), "complete").withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("stream_seen_once", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY ALL")
def stream_seen_once(t):
    """One event of each user and type, within a bound that spans the table."""
    events = stream_table(t.spark, t.sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).select("user_id", "event_type", "at", F.concat_ws("#", "user_id", "event_type").alias("key"))
    return drain(J.seen_once(events, "key", "at", "60 days")).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


_STEP = """p{i} AS (SELECT news.* FROM news LEFT JOIN m{b} USING (source) WHERE item_id % 3 = {i} AND (published IS NULL OR mark IS NULL OR published > mark) AND url NOT IN (SELECT url FROM l{b})),
  f{i} AS (SELECT item_id, url, source, published, {i} AS batch FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS r FROM p{i}) WHERE r = 1), l{i} AS (SELECT * FROM l{b} UNION ALL SELECT * FROM f{i}),
  m{i} AS (SELECT source, max(mark) AS mark FROM (SELECT * FROM m{b} UNION ALL SELECT source, published FROM f{i}) GROUP BY source)"""
_FLOW = "l_ AS (SELECT item_id, url, source, published, 0 AS batch FROM news WHERE FALSE), m_ AS (SELECT source, published AS mark FROM news WHERE FALSE), " + ", ".join(_STEP.format(i=i, b="_" if i == 0 else i - 1) for i in range(3))


def _flowed(t) -> J.NewsFlow:
    """The news in three batches through the flow, the last one twice."""
    path = f"{shared_dir(t.spark)}/query-{uuid.uuid4().hex}"
    flow = J.NewsFlow(Table(t.spark, f"{path}/links"), Table(t.spark, f"{path}/marks"))
    items = t.news.withColumn("published", F.col("published").cast("timestamp"))
    for i in range(3):  # a stream of one folder at a time: a restart for each
        items.where(F.col("item_id") % 3 == i).write.parquet(f"{path}/in/part={i}")
        stream = t.spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 100_000).parquet(f"{path}/in")
        flow.start(stream.drop("part"), f"{path}/checkpoint").awaitTermination()
    flow.batch(items.where("item_id % 3 = 2"), 2)
    return flow


@query("stream_news", f"WITH {_FLOW} SELECT item_id, url, source, batch FROM l2", "news")
def stream_news(t):
    """G1-G4 as a stream: which links are new, and in which batch."""
    return _flowed(t).links.read().select("item_id", "url", "source", "batch")


@query("stream_marks", f"WITH {_FLOW} SELECT source, mark AS last_published_at FROM m2", "news")
def stream_marks(t):
    """G2, G3 as a stream: every source's mark in the end."""
    return _flowed(t).marks.read().select("source", F.col("last_published_at").cast("timestamp_ntz").alias("last_published_at"))


@query("stream_clusters", LEADERS_BY_LABEL, "members")
def stream_clusters(t):
    """Stateful clustering by label block: groups and similarities of leader clustering within each label."""
    path = f"{shared_dir(t.spark)}/query-{uuid.uuid4().hex}"
    stories = t.embeddings.select(F.col("vec_id").cast("long").alias("id"), "embedding", "label")
    # The table's files hold any ids in any order of time, so ranges of ids become folders: a restart of the stream, and one micro-batch, for each.
    ends = sorted(set(stories.approxQuantile("id", [i / ID_RANGES for i in range(1, ID_RANGES)], 0.01)))
    for i, (low, high) in enumerate(zip([None, *ends], [*ends, None])):
        part = stories if low is None else stories.where((F.col("id") >= int(low)) | F.col("id").isNull())
        part = part if high is None else part.where(F.col("id") < int(high))
        part.write.parquet(f"{path}/in/part={i}")
        vectors = t.spark.readStream.schema(stories.schema).option("maxFilesPerTrigger", 1_000_000).parquet(f"{path}/in").drop("part")
        groups = drain(J.clustered(vectors, F.col("label").cast("int"), 0.3), path=f"{path}/groups")
    return groups.select("block", "id", "local_group", F.round("sim", 6).alias("sim"))


@query("stream_jobs", """SELECT c_custkey AS job_id, 'queued' AS status, 0::INT AS attempts, 'created' AS cause FROM customer UNION ALL SELECT c_custkey, 'running', 1, 'claimed' FROM customer WHERE c_custkey % 3 > 0
  UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN 'failed' ELSE 'succeeded' END, 1, CASE WHEN c_custkey % 4 = 1 THEN 'failed' ELSE 'succeeded' END FROM customer WHERE c_custkey % 3 = 2""")
def stream_jobs(t):
    """G30 as keyed state: every job is created, some are claimed (a second claim and a late end change nothing), some end; claims of unknown jobs do nothing."""
    k = F.col("c_custkey")
    end = F.when(k % 4 == 1, "failed").otherwise("succeeded")
    say = lambda event, seq: F.struct(k.alias("job_id"), event.alias("event"), F.lit(seq).cast("long").alias("seq"))
    told = F.when(k % 3 == 0, F.array(say(F.lit("created"), 1), say(F.lit("succeeded"), 2))).when(k % 3 == 1, F.array(say(F.lit("claimed"), 0), say(F.lit("created"), 1), say(F.lit("claimed"), 2), say(F.lit("claimed"), 3)))
    told = told.otherwise(F.array(say(F.lit("created"), 1), say(F.lit("claimed"), 2), say(end, 3), say(F.lit("failed"), 4), say(F.lit("created"), 5)))
    path = f"{shared_dir(t.spark)}/query-{uuid.uuid4().hex}"
    t.customer.select(F.inline(told)).write.parquet(path)
    before = t.spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(t.spark)
    try:
        return drain(changes(t.spark.readStream.schema("job_id long, event string, seq long").parquet(path), running=86_400), "update", once=True).select("job_id", "status", "attempts", "cause")
    finally:
        t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
