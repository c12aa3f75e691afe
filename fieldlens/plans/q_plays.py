"""Queries of family D over the derived play log."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.operators import plays as D
from fieldlens.plans.registry import query


def log(t):
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(c)).otherwise(F.expr("cast(array() as array<string>)"))
    return t.plays.withColumns({"sack_player_ids": one("sacker"), "tackler_player_ids": one("tackler"), "assist_tackler_player_ids": one("assistant")}).drop("sacker", "tackler", "assistant")


_SCALAR = {"passer": "passer_player_id", "receiver": "receiver_player_id", "rusher": "rusher_player_id", "interceptor": "interception_player_id", "forcer": "forced_fumble_player_id", "recoverer": "fumble_recovery_player_id",
           "kicker": "kicker_player_id", "punter": "punter_player_id", "returner": "returner_player_id", "sacker": "sacker", "tackler": "tackler", "assistant": "assistant"}
_LONG = "long AS (" + " UNION ALL ".join(f"SELECT *, '{r}' AS role, {c} AS player FROM plays WHERE {c} IS NOT NULL" for r, c in _SCALAR.items()) + ")"
_OFF = "('passer', 'receiver', 'rusher')"
_SIGNALS = f"""sig AS (SELECT game_id, player, CAST(count(*) AS INT) AS play_frequency, CAST(count(*) FILTER (role IN ('passer', 'receiver', 'rusher', 'returner')) AS INT) AS touches,
  coalesce(sum(yards_gained) FILTER (role IN {_OFF}), 0) AS yards, CAST(count(*) FILTER (role IN {_OFF} AND touchdown = 1) AS INT) AS touchdowns,
  CAST(count(*) FILTER (role IN ('interceptor', 'forcer', 'recoverer')) AS INT) AS turnovers_caused, CAST(0 AS INT) AS turnovers_committed, CAST(count(*) FILTER (role = 'sacker') AS INT) AS sacks,
  CAST(count(*) FILTER (role = 'passer' AND sacker IS NOT NULL) AS INT) AS sacks_allowed, CAST(count(*) FILTER (role IN ('passer', 'receiver', 'rusher', 'interceptor', 'returner') AND abs(yards_gained) >= 20) AS INT) AS explosive_plays,
  CAST(count(*) FILTER (role IN ('kicker', 'punter')) AS INT) AS kick_attempts, coalesce(sum(abs(yards_gained)) FILTER (role IN ('interceptor', 'returner')), 0) AS return_yards FROM long GROUP BY game_id, player)"""
_SCORE = "score AS (SELECT *, round(greatest(0, abs(yards) * 0.1::DOUBLE + play_frequency * 1.0::DOUBLE + touches * 0.5::DOUBLE + touchdowns * 20.0::DOUBLE + turnovers_caused * 15.0::DOUBLE + sacks * 10.0::DOUBLE + explosive_plays * 5.0::DOUBLE + return_yards * 0.05::DOUBLE + kick_attempts * 2.0::DOUBLE - sacks_allowed * 3.0::DOUBLE), 6) AS relevance FROM sig)"
_META = """meta AS (SELECT game_id, player, arg_min(pos, (spec, play_id, step)) AS position, arg_min(tm, (play_id, step)) AS team FROM (SELECT game_id, player, play_id,
  CASE role WHEN 'passer' THEN 'QB' WHEN 'rusher' THEN 'RB' WHEN 'receiver' THEN 'WR' WHEN 'sacker' THEN 'DL' WHEN 'interceptor' THEN 'DB' ELSE 'DEF' END AS pos,
  CASE role WHEN 'passer' THEN 1 WHEN 'rusher' THEN 2 WHEN 'receiver' THEN 2 WHEN 'sacker' THEN 3 WHEN 'interceptor' THEN 4 ELSE 5 END AS spec,
  CASE role WHEN 'passer' THEN 0 WHEN 'rusher' THEN 1 WHEN 'receiver' THEN 2 WHEN 'sacker' THEN 3 WHEN 'interceptor' THEN 4 ELSE 5 END AS step,
  CASE WHEN role IN ('passer', 'receiver', 'rusher') THEN posteam ELSE defteam END AS tm FROM long WHERE role IN ('passer', 'rusher', 'receiver', 'sacker', 'interceptor', 'tackler')) GROUP BY game_id, player)"""


@query("play_participants", f"WITH {_LONG} SELECT DISTINCT game_id, player FROM long", "plays")
def play_participants(t):
    return D.players(log(t))


@query("players_by_side", f"WITH {_LONG} SELECT DISTINCT game_id, CASE WHEN role IN {_OFF} THEN posteam ELSE defteam END AS team, player FROM long l WHERE role IN {_OFF} OR player NOT IN (coalesce(l.passer_player_id, ''), coalesce(l.receiver_player_id, ''), coalesce(l.rusher_player_id, ''))", "plays")
def players_by_side(t):
    return D.players_by_side(log(t))


@query("role_unpivot_signals", f"WITH {_LONG}, {_SIGNALS} SELECT * FROM sig", "plays")
def role_unpivot_signals(t):
    return D.impact(log(t))


@query("relevance_score", f"WITH {_LONG}, {_SIGNALS}, {_SCORE} SELECT game_id, player, relevance FROM score", "plays")
def relevance_score(t):
    return D.relevance(D.impact(log(t))).select("game_id", "player", "relevance")


@query("inferred_positions", f"WITH {_LONG}, {_META} SELECT * FROM meta", "plays")
def inferred_positions(t):
    return D.inferred(log(t))


@query("quota_selection", f"""WITH {_LONG}, {_SIGNALS}, {_SCORE}, {_META},
  j AS (SELECT s.*, position, team, row_number() OVER (PARTITION BY game_id, team ORDER BY relevance DESC, player) AS top FROM score s LEFT JOIN meta USING (game_id, player)),
  f AS (SELECT *, coalesce(touchdowns > 0 OR (position = 'QB' AND touches >= 2) OR (team IS NOT NULL AND top <= 1), false) AS forced FROM j),
  g AS (SELECT *, count(*) FILTER (forced) OVER (PARTITION BY game_id) AS n, row_number() OVER (PARTITION BY game_id, NOT forced ORDER BY relevance DESC, player) AS fill FROM f)
  SELECT game_id, player, team, position, relevance, forced FROM g WHERE forced OR fill <= 6 - n""", "plays")
def quota_selection(t):
    return D.selected(log(t), per_team=1, total=6, qb_touches=2)


@query("team_game_summary", """WITH s AS (SELECT *, posteam AS team, true AS o FROM plays UNION ALL SELECT *, defteam, false FROM plays)
  SELECT game_id, team, CAST(count(*) AS INT) AS total_plays, CAST(count(*) FILTER (o) AS INT) AS offensive_plays, CAST(count(*) FILTER (NOT o) AS INT) AS defensive_plays,
  coalesce(sum(yards_gained) FILTER (o), 0) AS total_yards, coalesce(sum(yards_gained) FILTER (o AND play_type = 'pass'), 0) AS passing_yards, coalesce(sum(yards_gained) FILTER (o AND play_type = 'run'), 0) AS rushing_yards,
  CAST(count(*) FILTER (o AND touchdown = 1) AS INT) AS touchdowns, CAST(count(*) FILTER (o AND play_type = 'field_goal' AND kicker_player_id IS NOT NULL) AS INT) AS field_goals,
  CAST(6 * count(*) FILTER (o AND touchdown = 1) + 3 * count(*) FILTER (o AND play_type = 'field_goal' AND kicker_player_id IS NOT NULL) + count(*) FILTER (o AND play_type = 'extra_point' AND kicker_player_id IS NOT NULL) + 2 * count(*) FILTER (NOT o AND safety = 1) AS INT) AS points,
  CAST(count(*) FILTER (o AND interception_player_id IS NOT NULL) AS INT) AS interceptions_thrown,
  round(coalesce(sum(yards_gained) FILTER (o) / nullif(count(*) FILTER (o), 0), 0), 6) AS yards_per_play FROM s GROUP BY game_id, team""", "plays")
def team_game_summary(t):
    return D.team_summaries(log(t))


_LINE = f"""line AS (SELECT game_id, player, CAST(count(*) FILTER (role NOT IN ('kicker', 'punter', 'returner')) AS INT) AS plays_involved, CAST(count(*) FILTER (role = 'passer') AS INT) AS pass_attempts,
  CAST(count(*) FILTER (role = 'passer' AND receiver_player_id IS NOT NULL) AS INT) AS completions, coalesce(sum(yards_gained) FILTER (role = 'passer' AND receiver_player_id IS NOT NULL), 0) AS passing_yards,
  coalesce(sum(yards_gained) FILTER (role = 'receiver'), 0) AS receiving_yards, coalesce(sum(yards_gained) FILTER (role = 'rusher'), 0) AS rushing_yards,
  CAST(count(*) FILTER (touchdown = 1 AND (role IN ('receiver', 'rusher') OR role = 'passer' AND receiver_player_id IS NOT NULL)) AS INT) AS touchdowns, CAST(count(*) FILTER (role IN ('receiver', 'rusher')) AS INT) AS touches,
  count(*) FILTER (role = 'tackler') + 0.5::DOUBLE * count(*) FILTER (role = 'assistant') AS tackles, CAST(count(*) FILTER (role = 'sacker') AS DOUBLE) AS sacks,
  CAST(count(*) FILTER (role = 'interceptor') AS INT) AS interceptions, CAST(count(*) FILTER (role = 'forcer') AS INT) AS forced_fumbles FROM long GROUP BY game_id, player)"""
_LINE_COLUMNS = ["game_id", "player", "plays_involved", "pass_attempts", "completions", "passing_yards", "receiving_yards", "rushing_yards", "touchdowns", "touches", "tackles", "sacks", "interceptions", "forced_fumbles"]


@query("player_game_summary", f"WITH {_LONG}, {_LINE} SELECT *, rushing_yards + receiving_yards + passing_yards AS total_yards, round(completions * 100.0::DOUBLE / nullif(pass_attempts, 0), 6) AS completion_pct FROM line", "plays")
def player_game_summary(t):
    return D.player_summaries(log(t)).select(*_LINE_COLUMNS, "total_yards", "completion_pct")


@query("notable_events", f"""WITH {_LONG}, {_LINE} SELECT game_id, player, array_to_string(list_filter([CASE WHEN touchdowns >= 3 THEN touchdowns || ' TDs' WHEN touchdowns >= 1 THEN touchdowns || ' TD' END,
  CASE WHEN rushing_yards >= 100 THEN CAST(rushing_yards AS BIGINT) || ' rush yds' END, CASE WHEN receiving_yards >= 100 THEN CAST(receiving_yards AS BIGINT) || ' rec yds' END, CASE WHEN passing_yards >= 300 THEN CAST(passing_yards AS BIGINT) || ' pass yds' END,
  CASE WHEN sacks >= 2 THEN printf('%.1f', sacks) || ' sacks' END, CASE WHEN interceptions >= 1 THEN interceptions || ' INT' END, CASE WHEN forced_fumbles >= 1 THEN forced_fumbles || ' FF' END], lambda x: x IS NOT NULL), '; ') AS notable FROM line""", "plays")
def notable_events(t):
    return D.notable(D.player_summaries(log(t))).select("game_id", "player", F.array_join("notable", "; ").alias("notable"))


@query("key_sequences", """SELECT game_id, play_id, quarter, 'score' AS kind, CASE WHEN touchdown = 1 THEN 'TD by ' || posteam WHEN play_type = 'field_goal' AND kicker_player_id IS NOT NULL THEN 'FG by ' || posteam ELSE 'Safety by ' || defteam END AS label,
  CASE WHEN touchdown = 1 OR play_type = 'field_goal' AND kicker_player_id IS NOT NULL THEN posteam ELSE defteam END AS team FROM plays WHERE touchdown = 1 OR play_type = 'field_goal' AND kicker_player_id IS NOT NULL OR safety = 1
  UNION ALL SELECT game_id, play_id, quarter, 'turnover', 'INT by ' || defteam, defteam FROM plays WHERE interception_player_id IS NOT NULL
  UNION ALL SELECT game_id, play_id, quarter, 'big_play', CAST(yards_gained AS INT) || 'yd ' || play_type || ' by ' || posteam, posteam FROM plays WHERE yards_gained >= 20""", "plays")
def key_sequences(t):
    return D.key_sequences(log(t))


_REPORT = f"""{_LONG}, people AS (SELECT game_id, count(DISTINCT player) AS n_players, count(DISTINCT player) FILTER (len(string_split(player, '-')) = 2 AND NOT regexp_matches(player, '^..-[0-9]{{7}}$')) AS odd FROM long GROUP BY game_id),
  b AS (SELECT *, coalesce(quarter < lag(quarter) OVER w, false) AS back, coalesce(play_id = lag(play_id) OVER w, false) AS again FROM plays WINDOW w AS (PARTITION BY game_id ORDER BY play_id)),
  side AS (SELECT game_id, count(DISTINCT team) AS n_teams FROM (SELECT game_id, posteam AS team FROM plays UNION ALL SELECT game_id, defteam FROM plays) GROUP BY game_id),
  p AS (SELECT game_id, count(*) AS n, count(*) FILTER (again) AS again, count(*) FILTER (back) AS back, count(*) FILTER (posteam IS NULL OR defteam IS NULL) AS no_team, count(*) FILTER (quarter IS NULL) AS no_quarter, count(*) FILTER (play_type IS NULL) AS no_type,
    count(*) FILTER (quarter NOT BETWEEN 1 AND 5) AS bad_quarter, count(*) FILTER (yards_gained NOT BETWEEN -99 AND 99) AS bad_yards, count(*) FILTER (touchdown NOT IN (0, 1)) AS bad_td,
    count(*) FILTER (play_type = 'pass' AND passer_player_id IS NULL) AS no_passer, count(*) FILTER (play_type = 'run' AND rusher_player_id IS NULL) AS no_rusher FROM b GROUP BY game_id),
  f AS (SELECT game_id, n, unnest(['duplicate_play_ids', 'play_order', 'missing_team', 'missing_quarter', 'missing_down', 'missing_yards_to_go', 'missing_yardline', 'missing_type', 'quarter_range', 'down_range', 'yards_to_go_range', 'yards_range',
      'touchdown_value', 'passer_missing', 'rusher_missing', 'play_count', 'team_count', 'game_teams', 'player_count', 'player_ids']) AS rule,
    unnest([again, back, no_team, no_quarter, n, n, n, no_type, bad_quarter, 0, 0, bad_yards, bad_td, no_passer, no_rusher, n, n_teams, n_teams, coalesce(n_players, 0), coalesce(odd, 0)]) AS found
    FROM p JOIN side USING (game_id) LEFT JOIN people USING (game_id)),
  report AS (SELECT game_id, rule, CASE WHEN rule IN ('duplicate_play_ids', 'quarter_range', 'down_range') THEN 'error' ELSE 'warning' END AS level, found,
    CASE WHEN rule = 'play_order' OR starts_with(rule, 'missing') AND rule <> 'missing_team' THEN found > n * 0.1 WHEN rule = 'play_count' THEN found NOT BETWEEN 50 AND 250 WHEN rule = 'team_count' THEN found <> 2
      WHEN rule = 'game_teams' THEN false WHEN rule = 'player_count' THEN found NOT BETWEEN 5 AND 100 ELSE found > 0 END AS broken FROM f)"""


@query("validation_report", f"WITH {_REPORT} SELECT * FROM report", "plays")
def validation_report(t):
    return D.checks(log(t))


@query("valid_logs", f"WITH {_REPORT} SELECT game_id, count(*) FILTER (broken AND level = 'error') AS errors, count(*) FILTER (broken AND level = 'warning') AS warnings, count(*) FILTER (broken AND level = 'error') = 0 AS is_valid FROM report GROUP BY game_id", "plays")
def valid_logs(t):
    return D.valid_logs(D.checks(log(t)))


@query("log_statistics", f"""WITH {_LONG}, people AS (SELECT game_id, count(DISTINCT player) AS n_players FROM long GROUP BY game_id),
  side AS (SELECT game_id, array_to_string(list_sort(list(DISTINCT team)), ',') AS teams FROM (SELECT game_id, posteam AS team FROM plays UNION ALL SELECT game_id, defteam FROM plays) GROUP BY game_id),
  p AS (SELECT game_id, count(*) AS n_plays, array_to_string(list_sort(list(DISTINCT quarter)), ',') AS quarters, count(DISTINCT play_type) AS n_types FROM plays GROUP BY game_id)
  SELECT game_id, n_plays, quarters, teams, n_types, coalesce(n_players, 0) AS n_players FROM p JOIN side USING (game_id) LEFT JOIN people USING (game_id)""", "plays")
def log_statistics(t):
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return D.log_statistics(log(t)).select("game_id", "n_plays", joined("quarters"), joined("teams"), "n_types", "n_players")


@query("play_type_counts", "SELECT game_id, play_type, count(*) AS n FROM plays GROUP BY ALL", "plays")
def play_type_counts(t):
    return D.play_type_counts(log(t))


@query("sparse_stats", f"WITH {_LONG}, {_LINE} SELECT game_id, player, CAST((touchdowns <> 0)::INT + (rushing_yards <> 0)::INT + (tackles <> 0)::INT AS INT) AS n_stats, nullif(round_even(tackles, 1), 0) AS tackles FROM line", "plays")
def sparse_stats(t):
    s = D.sparse_stats(D.player_summaries(log(t)), ["touchdowns", "rushing_yards", "tackles"])
    return s.select("game_id", "player", F.size("stats").alias("n_stats"), F.try_element_at("stats", F.lit("tackles")).alias("tackles"))


@query("stat_requests", f"""WITH {_LONG}, {_META}, w AS (SELECT game_id, player, unnest(CASE position WHEN 'QB' THEN ['passing', 'rushing'] WHEN 'RB' THEN ['rushing', 'receiving'] WHEN 'WR' THEN ['receiving'] ELSE [] END) AS stat_type FROM meta)
  SELECT game_id, stat_type, array_to_string(list_sort(list(DISTINCT player)), ',') AS players FROM w GROUP BY ALL""", "plays")
def stat_requests(t):
    return D.stat_requests(D.inferred(log(t))).select("game_id", "stat_type", F.array_join("players", ",").alias("players"))


@query("participant_context", f"WITH {_LONG}, {_LINE} SELECT DISTINCT l.game_id, l.player, tackles FROM long l LEFT JOIN line USING (game_id, player)", "plays")
def participant_context(t):
    return D.with_context(log(t), D.player_summaries(log(t)).select("game_id", "player", "tackles"))


@query("play_enrichment", "SELECT p.game_id, p.play_id, posteam, l.k AS tag FROM plays p JOIN (SELECT game_id, play_id, max(quarter + play_id % 3) AS k FROM plays WHERE play_id % 2 = 0 GROUP BY ALL) l USING (game_id, play_id)", "plays")
def play_enrichment(t):
    detail = t.plays.where("play_id % 2 = 0").select("game_id", "play_id", (F.col("quarter") + F.col("play_id") % 3).alias("tag"))
    detail = detail.withColumn("seq", F.col("tag")).union(detail.withColumn("tag", F.col("tag") - 1).withColumn("seq", F.col("tag") - 1))
    return D.enriched(log(t).select("game_id", "play_id", "posteam"), detail, "seq")


@query("source_conflicts", "SELECT p.game_id, p.play_id, 'quarter' AS field, CAST(quarter AS VARCHAR) AS old, CAST(quarter + 1 AS VARCHAR) AS new FROM plays p WHERE play_id % 3 = 0", "plays")
def source_conflicts(t):
    left = t.plays.select("game_id", "play_id", "quarter", "posteam")
    right = left.withColumn("quarter", F.when(F.col("play_id") % 3 == 0, F.col("quarter") + 1).otherwise(F.col("quarter")))
    return D.conflicts(left, right, ["game_id", "play_id"])


@query("game_envelope")
def game_envelope(t):
    return D.envelope(log(t))
