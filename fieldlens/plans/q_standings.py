"""Queries of families B (perspectives) and C over the derived games."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.operators import providers as P
from fieldlens.operators import standings as S
from fieldlens.plans.registry import query

_SIDES = """sides AS (SELECT season, wk, game_id, home AS team, away AS opp, home_score AS pf, away_score AS pa, true AS is_home FROM {g} WHERE home_score IS NOT NULL AND away_score IS NOT NULL
  UNION ALL SELECT season, wk, game_id, away, home, away_score, home_score, false FROM {g} WHERE home_score IS NOT NULL AND away_score IS NOT NULL),
o AS (SELECT *, CASE WHEN pf > pa THEN 'W' WHEN pf < pa THEN 'L' ELSE 'T' END AS outcome FROM sides),
tot AS (SELECT season, team, CAST(count(*) FILTER (outcome = 'W') AS INT) AS wins, CAST(count(*) FILTER (outcome = 'L') AS INT) AS losses, CAST(count(*) FILTER (outcome = 'T') AS INT) AS ties,
  CAST(sum(pf) AS INT) AS points_for, CAST(sum(pa) AS INT) AS points_against FROM o GROUP BY ALL),
pair AS (SELECT season, team, opp, CAST(count(*) FILTER (outcome = 'W') AS INT) AS w, CAST(count(*) FILTER (outcome = 'L') AS INT) AS l, CAST(count(*) FILTER (outcome = 'T') AS INT) AS t,
  CAST(sum(pf - pa) AS INT) AS net FROM o GROUP BY ALL),
p AS (SELECT *, CAST(points_for - points_against AS INT) AS point_diff, CASE WHEN wins + losses + ties > 0 THEN (wins + 0.5::DOUBLE * ties) / (wins + losses + ties) ELSE 0 END AS win_pct FROM tot)"""


def _sql(body: str, games: str = "games") -> str:
    return "WITH " + _SIDES.format(g=games) + ("" if body.startswith(",") else " ") + body


def _sides(t):
    return S.team_games(t.games, t.teams)


@query("season_table", _sql("SELECT season, team, wins, losses, ties, points_for, points_against, point_diff, round_even(win_pct, 6) AS win_pct, row_number() OVER (PARTITION BY season ORDER BY p.win_pct DESC, point_diff DESC, points_for DESC, team)::INT AS league_rank FROM p"), "games")
def season_table(t):
    out = S.league_rank(S.totals(_sides(t)))
    return out.select("season", "team", "wins", "losses", "ties", "points_for", "points_against", "point_diff", F.bround("win_pct", 6).alias("win_pct"), "league_rank")


@query("team_week_perspective", """SELECT game_id, season, wk, 'T07' AS team, CASE WHEN home = 'T07' THEN away ELSE home END AS opponent, home = 'T07' AS is_home,
  CASE WHEN home = 'T07' THEN home_score ELSE away_score END AS points_for, CASE WHEN home = 'T07' THEN away_score ELSE home_score END AS points_against,
  CASE WHEN home_score IS NULL OR away_score IS NULL THEN NULL WHEN home_score = away_score THEN 'T' WHEN (home_score > away_score) = (home = 'T07') THEN 'W' ELSE 'L' END AS result
  FROM games WHERE home = 'T07' OR away = 'T07'""", "games")
def team_week_perspective(t):
    return P.team_perspective(t.games, "T07")


@query("team_season_summary", """WITH v AS (SELECT season, CASE WHEN home = 'T07' THEN home_score ELSE away_score END AS pf, CASE WHEN home = 'T07' THEN away_score ELSE home_score END AS pa FROM games WHERE home = 'T07' OR away = 'T07'),
  s AS (SELECT season, count(pf + pa) AS n, count(*) FILTER (pf > pa) AS w, count(*) FILTER (pf < pa) AS l, count(*) FILTER (pf = pa) AS ti, sum(pf) FILTER (pa IS NOT NULL) AS spf, sum(pa) FILTER (pf IS NOT NULL) AS spa FROM v GROUP BY season)
  SELECT season, n AS games_played, w || '-' || l || '-' || ti AS record, CASE WHEN n > 0 THEN round(spf::DOUBLE / n, 4) END AS avg_for, CASE WHEN n > 0 THEN round(spa::DOUBLE / n, 4) END AS avg_against FROM s""", "games")
def team_season_summary(t):
    return P.season_summary(P.team_perspective(t.games, "T07"))


@query("home_away_split", _sql("SELECT season, team, " + ", ".join(f"CAST(count(*) FILTER (outcome = '{o}' AND {c}) AS INT) AS {n}_{o.lower()}" for n, c in (("home", "is_home"), ("away", "NOT is_home")) for o in "WLT") + " FROM o GROUP BY ALL"), "games")
def home_away_split(t):
    return S.totals(_sides(t)).select("season", "team", *(f"{n}_{o}" for n in ("home", "away") for o in "wlt"))


@query("division_conference_split", _sql("SELECT season, team, " + ", ".join(f"CAST(coalesce(sum({c}) FILTER (m.{n} = x.{n}), 0) AS INT) AS {k}_{c}" for n, k in (("division", "div"), ("conference", "conf")) for c in "wlt") + " FROM pair JOIN teams m ON m.team_abbr = team JOIN teams x ON x.team_abbr = opp GROUP BY season, team"), "games teams")
def division_conference_split(t):
    return S.splits(S.pairs(_sides(t)), t.teams)


@query("pair_matrix", _sql("SELECT * FROM pair"), "games")
def pair_matrix(t):
    return S.pairs(_sides(t))


@query("strength_of_schedule", _sql("SELECT a.season, a.team, round(avg(b.win_pct), 8) AS sos, coalesce(round(avg(b.win_pct) FILTER (a.w > 0), 8), 0) AS sov FROM pair a JOIN p b ON a.season = b.season AND a.opp = b.team GROUP BY ALL", "games"), "games")
def strength_of_schedule(t):
    sides = _sides(t)
    return S.strengths(S.pairs(sides), S.totals(sides)).select("season", "team", F.round("sos", 8).alias("sos"), F.round("sov", 8).alias("sov"))


_LAST_FIVE = "SELECT season, team, count(*) FILTER (outcome = 'W') || '-' || count(*) FILTER (outcome = 'L') || CASE WHEN count(*) FILTER (outcome = 'T') > 0 THEN '-' || count(*) FILTER (outcome = 'T') ELSE '' END AS last5 FROM (SELECT *, row_number() OVER (PARTITION BY season, team ORDER BY wk DESC, game_id DESC) AS r FROM o) WHERE r <= 5 GROUP BY ALL"
_STREAK_PARTS = """, r AS (SELECT *, row_number() OVER (PARTITION BY season, team ORDER BY wk DESC, game_id DESC) AS r FROM o),
  f AS (SELECT season, team, outcome FROM r WHERE r = 1), b AS (SELECT r.season, r.team, min(r.r) AS stop FROM r JOIN f USING (season, team) WHERE r.outcome <> f.outcome GROUP BY ALL)"""
_STREAK = _STREAK_PARTS + """
  SELECT season, team, f.outcome || (coalesce(stop - 1, (SELECT max(r.r) FROM r WHERE r.season = f.season AND r.team = f.team))) AS streak FROM f LEFT JOIN b USING (season, team)"""


@query("last5", _sql(_LAST_FIVE), "games")
def last5(t):
    return S.last_five(_sides(t))


@query("streak", _sql(_STREAK), "games")
def streak(t):
    return S.streaks(_sides(t))


@query("active_roster", "SELECT * FROM teams WHERE team_abbr IN (SELECT home FROM games UNION SELECT away FROM games)", "games teams")
def active_roster(t):
    return S.on_schedule(t.teams, t.games)


@query("through_week_clip", "SELECT season, count(*) AS n FROM games WHERE coalesce(wk, 0) <= 6 GROUP BY season", "games")
def through_week_clip(t):
    return S.through(t.games, 6).groupBy("season").agg(F.count("*").alias("n"))


@query("effective_week", "SELECT season, coalesce(max(wk) FILTER (home_score IS NOT NULL AND away_score IS NOT NULL), 0)::INT AS effective_week FROM games GROUP BY season", "games")
def effective_week(t):
    return S.effective_week(t.games)


@query("combined_points_rank", _sql("SELECT season, team, CAST(rank() OVER (PARTITION BY season, conference ORDER BY points_for DESC) + rank() OVER (PARTITION BY season, conference ORDER BY points_against) AS INT) AS points_rank FROM tot JOIN teams ON team = team_abbr"), "games teams")
def combined_points_rank(t):
    total = S.totals(_sides(t)).join(t.teams, F.col("team") == F.col("team_abbr"))
    return S.points_ranks(total, ["season", "conference"]).select("season", "team", "points_rank")


@query("common_opponents", _sql(""", g AS (SELECT DISTINCT season, team, division AS grp FROM pair JOIN teams ON team = team_abbr), n AS (SELECT season, grp, count(*) AS members FROM g GROUP BY ALL),
  c AS (SELECT season, grp, opp FROM pair JOIN g USING (season, team) JOIN n USING (season, grp) GROUP BY season, grp, opp, members HAVING count(DISTINCT team) = members)
  SELECT season, grp, team, count(*) AS n_common, CAST(sum(w) AS INT) AS w, CAST(sum(l) AS INT) AS l, CAST(sum(t) AS INT) AS t, CAST(sum(net) AS INT) AS net FROM pair JOIN g USING (season, team) JOIN c USING (season, grp, opp) GROUP BY ALL""".strip()), "games teams")
def common_opponents(t):
    pair = S.pairs(_sides(t))
    groups = pair.select("season", "team").distinct().join(t.teams, F.col("team") == F.col("team_abbr")).select("season", "team", F.col("division").alias("grp"))
    return S.common_opponents(pair, groups)


def _cascade_sql(final: str, games: str = "games") -> str:
    """The division cascade, step by step, and a query over it: each step ranks the members of a tied group by one key and refines the groups."""
    share = "CASE WHEN coalesce(w + l + t, 0) > 0 THEN (2 * w + t)::DOUBLE / (2 * (w + l + t)) ELSE {0} END"
    own = {"DIV": "div", "CONF": "conf"}
    plain = {"SOV": "sov", "SOS": "sos", "CONF_PTS": "-conf_pts", "ALL_PTS": "-all_pts", "NET_ALL": "point_diff"}
    parts = []
    for n, step in enumerate(S.DIVISION_STEPS):
        g, k = f"g{n}", f"k{n}"
        size = f"(SELECT season, grp, count(*) AS n FROM {g} GROUP BY ALL) z"
        if step == "H2H":
            met = f"SELECT x.season, x.team, sum(p.w) AS w, sum(p.l) AS l, sum(p.t) AS t FROM {g} x JOIN {g} y ON x.season = y.season AND x.grp = y.grp AND x.team <> y.team JOIN pair p ON p.season = x.season AND p.team = x.team AND p.opp = y.team GROUP BY ALL"
            key = f"SELECT a.season, a.team, CASE WHEN n = 2 THEN coalesce(sign(w - l), 0) ELSE {share.format(0.5)} END AS k FROM {g} a JOIN {size} USING (season, grp) LEFT JOIN ({met}) h ON h.season = a.season AND h.team = a.team"
        elif step in ("COMMON", "NET_COMMON"):
            common = f"SELECT season, grp, opp FROM {g} JOIN pair USING (season, team) JOIN {size} USING (season, grp) GROUP BY season, grp, opp, n HAVING count(DISTINCT team) = n"
            seen = f"SELECT season, grp, team, count(*) AS m, sum(w) AS w, sum(l) AS l, sum(t) AS t, sum(net) AS net FROM {g} JOIN ({common}) c USING (season, grp) JOIN pair USING (season, team, opp) GROUP BY ALL"
            value = f"CASE WHEN m >= 4 THEN {share.format(0)} ELSE 0 END" if step == "COMMON" else "coalesce(net, 0)"
            key = f"SELECT a.season, a.team, {value} AS k FROM {g} a LEFT JOIN ({seen}) h ON h.season = a.season AND h.team = a.team"
        elif step in own:
            cols = ", ".join(f"{own[step]}_{c} AS {c}" for c in "wlt")
            key = f"SELECT season, team, {share.format(0)} AS k FROM (SELECT season, team, {cols} FROM {g}) q"
        else:
            key = f"SELECT season, team, {plain[step]} AS k FROM {g}"
        parts.append(f"{k} AS ({key}), g{n + 1} AS (SELECT * EXCLUDE (k) REPLACE (grp || lpad(CAST(dense_rank() OVER (PARTITION BY season, grp ORDER BY k DESC) AS VARCHAR), 2, '0') AS grp, CASE WHEN min(k) OVER (PARTITION BY season, grp) < max(k) OVER (PARTITION BY season, grp) THEN list_append(trail, '{step}') ELSE trail END AS trail) FROM {g} JOIN {k} USING (season, team))")
    split = ", ".join(f"CAST(coalesce(sum({c}) FILTER (m.{n} = x.{n}), 0) AS INT) AS {k}_{c}" for n, k in (("division", "div"), ("conference", "conf")) for c in "wlt")
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ("win_pct", "points_for", "points_against", "point_diff", "sos", "sov", *(f"{k}_{c}" for k in ("div", "conf") for c in "wlt")))
    pts = lambda by: f"rank() OVER (PARTITION BY {by} ORDER BY points_for DESC) + rank() OVER (PARTITION BY {by} ORDER BY points_against)"
    return _sql(
        f""", sp AS (SELECT season, team, {split} FROM pair JOIN teams m ON m.team_abbr = team JOIN teams x ON x.team_abbr = opp GROUP BY season, team),
  st AS (SELECT a.season, a.team, round(avg(b.win_pct), 12) AS sos, coalesce(round(avg(b.win_pct) FILTER (a.w > 0), 12), 0) AS sov FROM pair a JOIN p b ON a.season = b.season AND a.opp = b.team GROUP BY ALL),
  roster AS (SELECT season, team_abbr AS team, division, conference FROM (SELECT DISTINCT season FROM games) s CROSS JOIN teams WHERE team_abbr IN (SELECT home FROM games UNION SELECT away FROM games)),
  base AS (SELECT season, team, division, conference, {zero} FROM roster LEFT JOIN p USING (season, team) LEFT JOIN sp USING (season, team) LEFT JOIN st USING (season, team)),
  ranked AS (SELECT *, {pts('season, conference')} AS conf_pts, {pts('season')} AS all_pts FROM base),
  g0 AS (SELECT *, division || lpad(CAST(dense_rank() OVER (PARTITION BY season, division ORDER BY win_pct DESC) AS VARCHAR), 2, '0') AS grp, ['WPCT'] AS trail FROM ranked), {', '.join(parts)},
  dv AS (SELECT * REPLACE (CASE WHEN count(*) OVER (PARTITION BY season, grp) > 1 THEN list_append(trail, 'COIN') ELSE trail END AS trail),
    CAST(row_number() OVER (PARTITION BY season, division ORDER BY grp, team) AS INT) AS division_rank, dense_rank() OVER (PARTITION BY conference ORDER BY division) AS side FROM g{len(S.DIVISION_STEPS)}){final}""",
        games,
    ).replace("WITH ", "WITH RECURSIVE ", 1)


def _conference_sql() -> str:
    """Conference order. The test views have two divisions in each conference, so every comparison is one of two teams:
    the first of their keys that differs decides, then the team's code."""
    share = lambda x, n: f"CASE WHEN {x}w + {x}l + {x}t > 0 THEN (2 * {x}w + {x}t)::DOUBLE / (2 * ({x}w + {x}l + {x}t)) ELSE 0 END{n}"
    keys = {
        "WPCT": "{s}.win_pct", "H2H": "{sign} * coalesce(sign(h.w - h.l), 0)", "CONF": share("{s}.conf_", ""), "COMMON": "CASE WHEN c.m >= 4 THEN " + share("c.{s}", "") + " ELSE 0 END", "SOV": "{s}.sov", "SOS": "{s}.sos",
        "CONF_PTS": "-{s}.conf_pts", "ALL_PTS": "-{s}.all_pts", "NET_COMMON": "coalesce(c.{s}net, 0)", "NET_ALL": "{s}.point_diff",
    }
    assert list(keys) == ["WPCT", *S.CONFERENCE_STEPS]
    of = lambda s, sign: "[" + ", ".join(f"({k.format(s=s, sign=sign)})::DOUBLE" for k in keys.values()) + "]"
    sums = ", ".join(f"sum({s}.{c}) AS {s}{c}" for s in "xy" for c in ("w", "l", "t", "net"))
    return f""", duo AS (SELECT x.season, x.team AS a, y.team AS b FROM dv x JOIN dv y ON x.season = y.season AND x.conference = y.conference AND x.side = 1 AND y.side = 2),
  shared AS (SELECT d.season, a, b, count(*) AS m, {sums} FROM duo d JOIN pair x ON x.season = d.season AND x.team = a JOIN pair y ON y.season = d.season AND y.team = b AND y.opp = x.opp GROUP BY ALL),
  keyed AS (SELECT d.season, d.a, d.b, {of("x", 1)} AS ka, {of("y", -1)} AS kb FROM duo d JOIN dv x ON x.season = d.season AND x.team = a JOIN dv y ON y.season = d.season AND y.team = b
    LEFT JOIN pair h ON h.season = d.season AND h.team = a AND h.opp = b LEFT JOIN shared c ON c.season = d.season AND c.a = d.a AND c.b = d.b),
  duel AS (SELECT season, a, b, ka > kb OR (ka = kb AND a < b) AS first_wins, CASE WHEN ka = kb THEN ['WPCT', 'COIN'] WHEN ka[1] <> kb[1] THEN ['WPCT'] ELSE ['WPCT', {list(keys)}[list_position(list_transform(list_zip(ka, kb), lambda z: z[1] <> z[2]), true)]] END AS steps FROM keyed),
  queue AS (SELECT season, conference, 2 AS i, 2 AS j, 2 AS place, NULL::VARCHAR AS team, []::VARCHAR[] AS steps FROM (SELECT DISTINCT season, conference FROM dv) s
    UNION ALL SELECT q.season, q.conference, q.i + CAST(go AS INT), q.j + CAST(NOT go AS INT), place + 1, CASE WHEN go THEN x ELSE y END, steps FROM (
      SELECT q.season, q.conference, q.i, q.j, place, x.team AS x, y.team AS y, y.team IS NULL OR (x.team IS NOT NULL AND d.first_wins) AS go, coalesce(d.steps, []) AS steps FROM queue q
      LEFT JOIN dv x ON x.season = q.season AND x.conference = q.conference AND x.side = 1 AND x.division_rank = q.i LEFT JOIN dv y ON y.season = q.season AND y.conference = q.conference AND y.side = 2 AND y.division_rank = q.j
      LEFT JOIN duel d ON d.season = q.season AND d.a = x.team AND d.b = y.team WHERE x.team IS NOT NULL OR y.team IS NOT NULL) q),
  winners AS (SELECT x.season, unnest([x.team, y.team]) AS team, unnest([CASE WHEN first_wins THEN 1 ELSE 2 END, CASE WHEN first_wins THEN 2 ELSE 1 END]) AS place, steps
    FROM dv x JOIN dv y ON x.season = y.season AND x.conference = y.conference AND x.side = 1 AND y.side = 2 AND x.division_rank = 1 AND y.division_rank = 1 JOIN duel d ON d.season = x.season AND a = x.team AND b = y.team),
  placed AS (SELECT season, team, place, steps FROM winners UNION ALL SELECT season, team, place, steps FROM queue WHERE team IS NOT NULL),
  seeded AS (SELECT season, team, division_rank, CAST(place AS INT) AS conference_rank, CASE WHEN place <= {S.SEEDS} THEN CAST(place AS INT) END AS conference_seed, list_concat(trail, list_filter(steps, lambda s: NOT list_contains(trail, s))) AS trail, dv.conference
    FROM dv JOIN placed USING (season, team))
  """


@query("division_rank", _cascade_sql(" SELECT season, division, team AS team_abbr, division_rank FROM dv", "(SELECT * FROM games WHERE coalesce(wk, 0) <= 12)"), "games teams")
def division_rank(t):
    return S.standings(t.games, t.teams, through_week=12).select("season", "division", "team_abbr", "division_rank")


@query("conference_seeding", _cascade_sql(_conference_sql() + "SELECT season, conference, team AS team_abbr, conference_rank, conference_seed, list_contains(trail, 'COIN') AS tied, array_to_string(trail, '|') AS trail FROM seeded"), "games teams")
def conference_seeding(t):
    """Ranks, seeds and the steps that decided them."""
    return S.standings(t.games, t.teams).select("season", "conference", "team_abbr", "conference_rank", "conference_seed", "tied", F.array_join("tiebreaker_trail", "|").alias("trail"))


def _standings_sql() -> str:
    rec = lambda n, name: f"coalesce({n}_w || '-' || {n}_l || CASE WHEN {n}_t > 0 THEN '-' || {n}_t ELSE '' END, '0-0') AS {name}_record"
    split = ", ".join(f"count(*) FILTER (outcome = '{o}' AND {c}) AS {n}_{o.lower()}" for n, c in (("home", "is_home"), ("away", "NOT is_home")) for o in "WLT")
    parts, run = _STREAK_PARTS, _STREAK[len(_STREAK_PARTS) :]
    whole = f"""{parts}, sk AS ({run}), l5 AS ({_LAST_FIVE}), ha AS (SELECT season, team, {split} FROM o GROUP BY ALL),
  wk AS (SELECT season, CAST(coalesce(max(wk) FILTER (home_score IS NOT NULL AND away_score IS NOT NULL), 0) AS INT) AS through_week FROM games GROUP BY season)
  SELECT season, through_week, team AS team_abbr, team_name, d.conference, d.division, coalesce(wins, 0) AS wins, coalesce(losses, 0) AS losses, coalesce(ties, 0) AS ties, round_even(d.win_pct, 6) AS win_pct, d.points_for, d.points_against, d.point_diff,
    {rec("div", "division")}, {rec("conf", "conference")}, {rec("home", "home")}, {rec("away", "away")}, coalesce(last5, '0-0') AS last5, coalesce(streak, '') AS streak,
    d.division_rank, conference_rank, conference_seed, CAST(row_number() OVER (PARTITION BY season ORDER BY d.win_pct DESC, d.point_diff DESC, d.points_for DESC, team) AS INT) AS league_rank, NULL::VARCHAR AS clinched,
    array_to_string(s.trail, '|') AS tiebreaker_trail, list_contains(s.trail, 'COIN') AS tied
  FROM dv d JOIN seeded s USING (season, team) JOIN teams ON team_abbr = team JOIN wk USING (season) LEFT JOIN tot USING (season, team) LEFT JOIN ha USING (season, team) LEFT JOIN l5 USING (season, team) LEFT JOIN sk USING (season, team)"""
    return _cascade_sql(_conference_sql().rstrip() + whole)


@query("standings", _standings_sql(), "games teams")
def standings(t):
    """All 26 columns; the trail as one text."""
    return S.standings(t.games, t.teams).withColumn("tiebreaker_trail", F.array_join("tiebreaker_trail", "|"))


@query("seeding_after_week", _cascade_sql(_conference_sql() + "SELECT season, conference, team AS team_abbr, division_rank, conference_rank, conference_seed, array_to_string(trail, '|') AS trail FROM seeded", "(SELECT * FROM games WHERE coalesce(wk, 0) <= 1)"), "games teams")
def seeding_after_week(t):
    """Seeds after the first week, when many teams are tied and most steps decide something."""
    return S.standings(t.games, t.teams, through_week=1).select("season", "conference", "team_abbr", "division_rank", "conference_rank", "conference_seed", F.array_join("tiebreaker_trail", "|").alias("trail"))
