"""Sports and news tables derived from the star-schema test tables, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "teams": """SELECT 'T' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS team_abbr, n_name AS team_name, r_name AS conference,
  r_name || ' ' || CAST(n_nationkey % 2 AS STRING) AS division FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "games": """SELECT game_id, season, wk, home, away, CASE WHEN played THEN CAST(hs AS INT) END AS home_score, CASE WHEN played THEN CAST(aws AS INT) END AS away_score
  FROM (SELECT CAST(o_orderkey AS BIGINT) AS game_id, CAST(year(o_orderdate) AS INT) AS season,
    CAST(least(18, floor((dayofyear(o_orderdate) - 1) / 20) + 1) AS INT) AS wk,
    'T' || lpad(CAST(c_nationkey AS STRING), 2, '0') AS home, 'T' || lpad(CAST((o_orderkey * 7 + 3) % 25 AS STRING), 2, '0') AS away,
    CAST(floor(o_totalprice) AS BIGINT) % 45 AS hs, CAST(floor(o_totalprice / 7) AS BIGINT) % 45 AS aws, o_orderstatus <> 'P' AS played
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey) g WHERE home <> away""",
    "plays": """SELECT game_id, play_id, CAST(1 + (play_id - 1) % 4 AS INT) AS quarter, 'A' || CAST(side AS STRING) AS posteam, 'A' || CAST(1 - side AS STRING) AS defteam,
    CASE WHEN flag = 'A' THEN 'pass' WHEN flag = 'N' THEN 'run' WHEN pk % 3 = 0 THEN 'field_goal' WHEN pk % 3 = 1 THEN 'extra_point' ELSE 'punt' END AS play_type,
    CAST(qty - 20 AS DOUBLE) AS yards_gained, CASE WHEN disc >= 9 THEN 1 ELSE 0 END AS touchdown, CASE WHEN tax = 7 AND flag = 'N' AND pk % 5 = 0 THEN 1 ELSE 0 END AS safety,
    CASE WHEN flag = 'A' THEN 'P' || CAST(sk % 5 AS STRING) || 'S' || CAST(side AS STRING) END AS passer_player_id,
    CASE WHEN flag = 'A' AND pk % 3 <> 0 THEN 'P' || CAST(5 + pk % 7 AS STRING) || 'S' || CAST(side AS STRING) END AS receiver_player_id,
    CASE WHEN flag = 'N' THEN 'P' || CAST(3 + pk % 6 AS STRING) || 'S' || CAST(side AS STRING) END AS rusher_player_id,
    CASE WHEN flag = 'R' AND pk % 3 <> 2 THEN 'P20S' || CAST(side AS STRING) END AS kicker_player_id,
    CASE WHEN flag = 'R' AND pk % 3 = 2 THEN 'P21S' || CAST(side AS STRING) END AS punter_player_id,
    CASE WHEN flag = 'R' AND pk % 3 = 2 THEN 'P' || CAST(5 + pk % 7 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS returner_player_id,
    CASE WHEN flag = 'A' AND tax = 8 THEN 'P' || CAST(10 + pk % 4 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS interception_player_id,
    CASE WHEN flag = 'N' AND tax = 6 THEN 'P' || CAST(12 + pk % 4 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS forced_fumble_player_id,
    CASE WHEN flag = 'N' AND tax = 6 AND pk % 2 = 0 THEN 'P' || CAST(13 + pk % 3 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS fumble_recovery_player_id,
    CASE WHEN flag = 'A' AND tax = 5 THEN 'P' || CAST(10 + sk % 6 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS sacker,
    CASE WHEN flag <> 'R' AND tax < 5 THEN 'P' || CAST(10 + (pk + sk) % 8 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS tackler,
    CASE WHEN flag <> 'R' AND tax < 2 THEN 'P' || CAST(10 + pk % 8 AS STRING) || 'S' || CAST(1 - side AS STRING) END AS assistant
  FROM (SELECT CAST(l_orderkey AS BIGINT) AS game_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS BIGINT) AS play_id,
    l_suppkey % 2 AS side, l_suppkey AS sk, l_partkey AS pk, l_returnflag AS flag, CAST(l_quantity AS INT) AS qty, CAST(round(l_discount * 100) AS INT) AS disc, CAST(round(l_tax * 100) AS INT) AS tax FROM {lineitem}) s""",
    "rosters": """SELECT 'T' || lpad(CAST(c_nationkey AS STRING), 2, '0') AS team, 'C' || CAST(c_custkey AS STRING) AS player, CAST(2020 + c_custkey % 3 AS INT) AS season,
    CAST(1 + (c_custkey + c_nationkey) % 9 AS INT) AS wk, c_name AS player_name, c_custkey AS seq,
    CASE c_custkey % 12 WHEN 0 THEN 'QB' WHEN 1 THEN 'RB' WHEN 2 THEN 'WR' WHEN 3 THEN 'TE' WHEN 4 THEN 'OT' WHEN 5 THEN 'DE' WHEN 6 THEN 'LB' WHEN 7 THEN 'CB' WHEN 8 THEN 'K' WHEN 9 THEN 'FS' WHEN 10 THEN 'C' ELSE 'XX' END AS pos
  FROM {customer}""",
    "members": """SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(label AS INT) AS group_id, embedding FROM {embeddings}""",
    "facts": """SELECT CAST(doc_id AS BIGINT) AS url_id, CAST(doc_id * 10 + k AS BIGINT) AS fact_id, k, source, lang, n_chars FROM (SELECT doc_id, source, lang, n_chars, k FROM {documents} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) n) x
  WHERE k < n_chars % 5""",
    "topics": """SELECT fact_id, url_id, CASE (fact_id * 31 + j) % 7 WHEN 0 THEN 'Quarterback Performance & Analysis' WHEN 1 THEN 'injury update' WHEN 2 THEN 'Trade Rumors' WHEN 3 THEN 'Draft outlook' WHEN 4 THEN 'Contract news' WHEN 5 THEN 'coaching staff' ELSE 'Other talk' END AS topic,
    CAST((fact_id * 17 + j * 5) % 10 AS DOUBLE) / 10 AS confidence, CASE WHEN (fact_id + j) % 4 = 0 THEN NULL ELSE CAST((fact_id + j * 3) % 4 AS INT) END AS rnk, (fact_id + j) % 3 = 0 AS is_primary, j AS seq
  FROM {facts} CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2) n WHERE fact_id % 6 <> 5""",
    "entities": """SELECT fact_id, url_id, CASE (fact_id + j) % 3 WHEN 0 THEN 'player' WHEN 1 THEN 'team' ELSE 'game' END AS entity_type,
    CASE WHEN (fact_id + j) % 5 = 0 THEN NULL ELSE 'E' || CAST((fact_id * 3 + j * 7) % 12 AS STRING) END AS entity_id, 'Name ' || CAST((fact_id + j) % 9 AS STRING) AS mention,
    CAST((fact_id * 13 + j * 29) % 10 AS DOUBLE) / 10 AS confidence, (fact_id + j * 2) % 4 = 0 AS is_primary, CASE WHEN (fact_id + j) % 3 = 0 THEN 0 ELSE CAST(j + 1 AS INT) END AS rnk,
    CASE WHEN (fact_id + j) % 2 = 0 THEN 'T' || lpad(CAST((fact_id + j) % 25 AS STRING), 2, '0') END AS team_abbr, j AS seq
  FROM {facts} CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) n WHERE fact_id % 7 <> 3""",
    "news": """SELECT CAST(event_id AS BIGINT) AS item_id, 'https://site' || CAST(user_id % 40 AS STRING) || '.example.com/nfl/' || CAST(event_id % 700 AS STRING) AS url, event_type AS source,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS published, CAST(ascii(event_type) AS BIGINT) * 1000000 + event_id AS seq FROM {events}""",
    "urls": """SELECT CAST(event_id AS BIGINT) AS url_id, ts AS updated_at, CASE WHEN user_id % 3 <> 0 THEN ts END AS content_at, CASE WHEN user_id % 3 <> 0 AND event_id % 4 <> 0 THEN ts END AS facts_at,
    CASE WHEN user_id % 3 <> 0 AND event_id % 4 <> 0 AND event_id % 5 < 3 THEN ts END AS summary_at, CASE WHEN user_id % 3 <> 0 AND event_id % 4 <> 0 AND event_id % 3 = 0 THEN ts END AS knowledge_at,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 6 AS INT) END AS error_count, CAST(floor(value) AS INT) % 60 AS facts_count,
    CASE WHEN CAST(floor(value) AS INT) % 60 < 10 THEN 'easy' WHEN CAST(floor(value) AS INT) % 60 <= 30 THEN 'medium' ELSE 'hard' END AS difficulty FROM {events}""",
}

# The tables that a view's window deals out: the key, and the window's order.
DEALT = {"plays": {"lineitem": "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split()}}

_NAME = re.compile(r"\{(\w+)\}")


class Tables:
    """Base tables and derived views of one data folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        return self.sql(VIEWS[name], **{n: self._dealt(n, *by) for n, by in DEALT.get(name, {}).items()})

    def _dealt(self, name: str, key: str, *order: str) -> DataFrame:
        """A base table in one shuffle by a key, sorted: a view's own window needs no other, and its rows stay known as dealt by what the view makes of the key."""
        return getattr(self, name).repartition(key).sortWithinPartitions(key, *order)

    def sql(self, text: str, **given: DataFrame) -> DataFrame:
        """SQL over tables and views named in braces."""
        return self.spark.sql(text, **{n: given[n] if n in given else getattr(self, n) for n in set(_NAME.findall(text))})


def with_views(names: list[str], sql: str) -> str:
    """DuckDB SQL with the named views, and those they need, before it."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in VIEWS and name not in order:
            for other in _NAME.findall(VIEWS[name]):
                need(other)
            order.append(name)

    for name in names:
        need(name)
    if not order:
        return sql
    ctes = ", ".join(f"{n} AS ({_NAME.sub(r'\1', VIEWS[n])})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {body[14:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"
