"""Game analysis over a play log: roles, impact, summaries, key moments, checks (family D).

A play has scalar role columns and three list role columns. ``roles`` unpivots them once; everything on players is an
aggregate of that long table, so one shuffle by (game, player) serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALAR_ROLES = {
    "passer": "passer_player_id", "receiver": "receiver_player_id", "rusher": "rusher_player_id", "interceptor": "interception_player_id", "forcer": "forced_fumble_player_id",
    "recoverer": "fumble_recovery_player_id", "kicker": "kicker_player_id", "punter": "punter_player_id", "returner": "returner_player_id",
}
LIST_ROLES = {"sacker": "sack_player_ids", "tackler": "tackler_player_ids", "assistant": "assist_tackler_player_ids"}
OFFENSE = ["passer", "receiver", "rusher"]
EXPLOSIVE = 20


def _ids(role: str) -> Column:
    c = SCALAR_ROLES.get(role)
    return F.array(F.col(c)) if c else F.coalesce(F.col(LIST_ROLES[role]), F.expr("cast(array() as array<string>)"))


def roles(plays: DataFrame) -> DataFrame:
    """D3: one row for each (play, role, player); a player with two roles in a play has two rows."""
    of = [F.struct(F.lit(r).alias("role"), _ids(r).alias("__ids")) for r in (*SCALAR_ROLES, *LIST_ROLES)]
    each = plays.select("*", F.inline(F.array(*of)))  # two plain explodes compile; functions over lists with a lambda are interpreted
    return each.select("*", F.explode("__ids").alias("player")).drop("__ids").where("player <> ''")  # nulls fall away too


def players(plays: DataFrame) -> DataFrame:
    """The distinct players of each game, over all role columns and any other column named like a player id."""
    named = [*SCALAR_ROLES.values(), *LIST_ROLES.values()]
    more = [c for c, kind in plays.dtypes if "player_id" in c and c not in named and kind == "string"]
    ids = F.array_distinct(F.concat(F.array(*(F.col(c) for c in [*SCALAR_ROLES.values(), *more])), *(_ids(r) for r in LIST_ROLES)))
    return plays.select("game_id", F.explode(ids).alias("player")).where("player is not null and player <> ''").distinct()


def players_by_side(plays: DataFrame) -> DataFrame:
    """Players of the side with the ball, and all others, for each play's teams."""
    own = F.array_distinct(F.array_compact(F.array(*(F.col(SCALAR_ROLES[r]) for r in OFFENSE))))
    rest = [r for r in SCALAR_ROLES if r not in OFFENSE]
    others = F.array_except(F.array_distinct(F.array_compact(F.concat(F.array(*(F.col(SCALAR_ROLES[r]) for r in rest)), *(_ids(r) for r in LIST_ROLES)))), own)
    sides = F.array(F.struct(F.col("posteam").alias("team"), own.alias("ids")), F.struct(F.col("defteam").alias("team"), others.alias("ids")))
    return plays.select("game_id", F.inline(sides)).select("game_id", "team", F.explode("ids").alias("player")).where("team is not null").distinct()


def _n(*of: str, where: Column | None = None) -> Column:
    hit = F.col("role").isin(*of)
    return F.count_if(hit if where is None else hit & where).cast("int")


def _sum(value: Column, *of: str) -> Column:
    return F.sum(F.when(F.col("role").isin(*of), value).otherwise(0.0))


def _long(plays: DataFrame) -> DataFrame:
    return roles(plays.withColumn("__sacked", F.size(F.coalesce("sack_player_ids", F.expr("array()"))) > 0))


def _signals() -> list[Column]:
    yards = F.coalesce("yards_gained", F.lit(0.0))
    big = F.abs(yards) >= EXPLOSIVE
    return [
        F.count("*").cast("int").alias("play_frequency"),
        _n(*OFFENSE, "returner").alias("touches"),
        _sum(yards, *OFFENSE).alias("yards"),
        _n(*OFFENSE, where=F.col("touchdown") == 1).alias("touchdowns"),
        _n("interceptor", "forcer", "recoverer").alias("turnovers_caused"),
        F.lit(0).alias("turnovers_committed"),
        _n("sacker").alias("sacks"),
        _n("passer", where=F.col("__sacked")).alias("sacks_allowed"),
        _n(*OFFENSE, "interceptor", "returner", where=big).alias("explosive_plays"),
        _n("kicker", "punter").alias("kick_attempts"),
        _sum(F.abs(yards), "interceptor", "returner").alias("return_yards"),
    ]


def impact(plays: DataFrame) -> DataFrame:
    """What each player did in each game. Turnovers committed are not in a play log and stay 0."""
    return _long(plays).groupBy("game_id", "player").agg(*_signals())


# Weight of each signal in the relevance score.
WEIGHTS = {
    "play_frequency": 1.0, "touches": 0.5, "touchdowns": 20.0, "turnovers_caused": 15.0, "sacks": 10.0, "explosive_plays": 5.0, "return_yards": 0.05, "kick_attempts": 2.0,
    "turnovers_committed": -10.0, "sacks_allowed": -3.0,
}
YARD_WEIGHT = 0.1


def relevance(signals: DataFrame) -> DataFrame:
    """A weighted sum, never below 0."""
    total = sum((F.col(c) * w for c, w in WEIGHTS.items()), F.abs("yards") * YARD_WEIGHT)
    return signals.withColumn("relevance", F.round(F.greatest(F.lit(0.0), total), 6))


# The position a role suggests, most telling first.
POSITION_OF = {"passer": "QB", "rusher": "RB", "receiver": "WR", "sacker": "DL", "interceptor": "DB", "tackler": "DEF"}
SPECIFICITY = {"QB": 1, "RB": 2, "WR": 2, "DL": 3, "DB": 4, "DEF": 5}


def _inferred() -> list[Column]:
    telling = F.col("role").isin(*POSITION_OF)
    step = F.element_at(F.create_map(*(F.lit(x) for i, r in enumerate(POSITION_OF) for x in (r, i))), F.col("role"))
    position = F.element_at(F.create_map(*(F.lit(x) for p in POSITION_OF.items() for x in p)), F.col("role"))
    rank = F.element_at(F.create_map(*(F.lit(x) for p in SPECIFICITY.items() for x in p)), position)
    team = F.when(F.col("role").isin(*OFFENSE), F.col("posteam")).otherwise(F.col("defteam"))
    seq = F.struct("play_id", step)
    return [F.min_by(position, F.when(telling, F.struct(rank, seq))).alias("position"), F.min_by(team, F.when(telling & team.isNotNull(), seq)).alias("team")]


def inferred(plays: DataFrame) -> DataFrame:
    """Position by the most telling role (the first one seen among equals), team of the first such play."""
    return roles(plays).where(F.col("role").isin(*POSITION_OF)).groupBy("game_id", "player").agg(*_inferred())


def selected(plays: DataFrame, per_team: int = 5, total: int = 30, qb_touches: int = 5, min_plays: int = 1) -> DataFrame:
    """Scorers, busy quarterbacks and each team's best, filled up to ``total`` by score. More than ``total`` forced players add none."""
    scored = relevance(_long(plays).groupBy("game_id", "player").agg(*_signals(), *_inferred()))
    best = [F.desc("relevance"), F.col("player")]
    top = F.row_number().over(Window.partitionBy("game_id", "team").orderBy(*best))
    forced = (F.col("touchdowns") > 0) | ((F.col("position") == "QB") & (F.col("touches") >= qb_touches)) | (F.col("team").isNotNull() & (F.col("__top") <= per_team))
    flagged = scored.withColumn("__top", top).withColumn("__forced", F.coalesce(forced, F.lit(False)))
    able = F.col("play_frequency") >= min_plays
    place = F.row_number().over(Window.partitionBy("game_id").orderBy(F.desc("__forced"), F.desc("__able"), *best))  # the forced first, so the others fill what is left of the total
    kept = flagged.withColumn("__able", able).withColumn("__place", place).where(F.col("__forced") | (F.col("__able") & (F.col("__place") <= total)))
    return kept.select("game_id", "player", "team", "position", "relevance", F.col("__forced").alias("forced"))


def team_summaries(plays: DataFrame) -> DataFrame:
    """Plays, yards and points of both teams. A touchdown always counts for the side with the ball."""
    had = plays.where("posteam is not null and posteam <> ''").withColumn("__y", F.when(~F.isnan("yards_gained"), F.col("yards_gained")))
    sides = had.select("*", F.inline(F.array(F.struct(F.col("posteam").alias("team"), F.lit(True).alias("off")), F.struct(F.col("defteam").alias("team"), F.lit(False).alias("off"))))).where("team is not null")
    off, kind = F.col("off"), F.col("play_type")
    n = lambda c: F.count_if(c).cast("int")
    yards = lambda c: F.coalesce(F.sum(F.when(c, F.col("__y"))), F.lit(0.0))
    td, kicked = off & (F.col("touchdown") == 1), off & F.col("kicker_player_id").isNotNull()
    points = (
        6 * n(td) + 3 * n(kicked & (kind == "field_goal")) + n(kicked & (kind == "extra_point")) + 2 * n(td & (kind == "two_point_attempt")) + 2 * n(~off & (F.col("safety") == 1))
    )
    out = sides.groupBy("game_id", "team").agg(
        F.count("*").cast("int").alias("total_plays"), n(off).alias("offensive_plays"), n(~off).alias("defensive_plays"), yards(off).alias("total_yards"), yards(off & (kind == "pass")).alias("passing_yards"),
        yards(off & (kind == "run")).alias("rushing_yards"), n(td).alias("touchdowns"), n(kicked & (kind == "field_goal")).alias("field_goals"), points.cast("int").alias("points"),
        n(off & F.col("interception_player_id").isNotNull()).alias("interceptions_thrown"),
    )
    return out.withColumn("yards_per_play", F.round(F.coalesce(F.try_divide("total_yards", "offensive_plays"), F.lit(0.0)), 6))


def player_summaries(plays: DataFrame) -> DataFrame:
    """Each player's line in each game. Targets equal receptions, as the log names receivers of catches only."""
    yards = F.coalesce("yards_gained", F.lit(0.0))
    td, caught = F.col("touchdown") == 1, F.col("receiver_player_id").isNotNull()
    known = ["passer", "receiver", "rusher", "tackler", "assistant", "sacker", "interceptor", "forcer", "recoverer"]
    out = roles(plays).groupBy("game_id", "player").agg(
        _n(*known).alias("plays_involved"), _n("passer").alias("pass_attempts"), _n("passer", where=caught).alias("completions"), F.sum(F.when((F.col("role") == "passer") & caught, yards).otherwise(0.0)).alias("passing_yards"),
        _n("passer", where=caught & td).alias("passing_tds"), _n("receiver").alias("receptions"), _sum(yards, "receiver").alias("receiving_yards"), _n("receiver", where=td).alias("receiving_tds"),
        _n("rusher").alias("rushing_attempts"), _sum(yards, "rusher").alias("rushing_yards"), _n("rusher", where=td).alias("rushing_tds"), (_n("tackler") + 0.5 * _n("assistant")).cast("double").alias("tackles"),
        _n("sacker").cast("double").alias("sacks"), _n("interceptor").alias("interceptions"), _n("forcer").alias("forced_fumbles"), _n("recoverer").alias("fumble_recoveries"),
    )
    return out.withColumns(
        {
            "targets": F.col("receptions"),
            "touches": F.col("rushing_attempts") + F.col("receptions"),
            "total_yards": F.col("rushing_yards") + F.col("receiving_yards") + F.col("passing_yards"),
            "touchdowns": F.col("rushing_tds") + F.col("receiving_tds") + F.col("passing_tds"),
            "completion_pct": F.round(F.try_divide(F.col("completions") * 100.0, F.col("pass_attempts")), 6),
        }
    )


def notable(summary: DataFrame) -> DataFrame:
    """Labels of what stands out; touchdowns are summed first (K2)."""
    whole = lambda c: F.format_string("%d", F.bround(c).cast("long"))
    events = F.array_compact(
        F.array(
            F.when(F.col("touchdowns") >= 3, F.concat(F.col("touchdowns").cast("string"), F.lit(" TDs"))).when(F.col("touchdowns") >= 1, F.concat(F.col("touchdowns").cast("string"), F.lit(" TD"))),
            F.when(F.col("rushing_yards") >= 100, F.concat(whole("rushing_yards"), F.lit(" rush yds"))),
            F.when(F.col("receiving_yards") >= 100, F.concat(whole("receiving_yards"), F.lit(" rec yds"))),
            F.when(F.col("passing_yards") >= 300, F.concat(whole("passing_yards"), F.lit(" pass yds"))),
            F.when(F.col("sacks") >= 2, F.concat(F.format_string("%.1f", "sacks"), F.lit(" sacks"))),
            F.when(F.col("interceptions") >= 1, F.concat(F.col("interceptions").cast("string"), F.lit(" INT"))),
            F.when(F.col("forced_fumbles") >= 1, F.concat(F.col("forced_fumbles").cast("string"), F.lit(" FF"))),
        )
    )
    return summary.withColumn("notable", events)


def sparse_stats(summary: DataFrame, columns: list[str], places: int = 1) -> DataFrame:
    """A map of the statistics that are not 0."""
    full = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(F.bround(F.col(c).cast("double"), places) for c in columns)))
    return summary.withColumn("stats", F.map_filter(full, lambda k, v: v.isNotNull() & (v != 0)))


def key_sequences(plays: DataFrame) -> DataFrame:
    """Up to three labelled moments of a play: a score, a turnover, a long gain."""
    moment = lambda kind, label, team: F.struct(F.lit(kind).alias("kind"), label.alias("label"), team.alias("team"))
    pos, dfn = F.coalesce("posteam", F.lit("None")), F.coalesce("defteam", F.lit("None"))
    score = (
        F.when(F.col("touchdown") == 1, moment("score", F.concat(F.lit("TD by "), pos), F.col("posteam")))
        .when((F.col("play_type") == "field_goal") & F.col("kicker_player_id").isNotNull(), moment("score", F.concat(F.lit("FG by "), pos), F.col("posteam")))
        .when(F.col("safety") == 1, moment("score", F.concat(F.lit("Safety by "), dfn), F.col("defteam")))
    )
    turnover = F.when(F.col("interception_player_id").isNotNull(), moment("turnover", F.concat(F.lit("INT by "), dfn), F.col("defteam")))
    gain = F.concat(F.col("yards_gained").cast("int").cast("string"), F.lit("yd "), F.coalesce("play_type", F.lit("play")), F.lit(" by "), pos)
    big = F.when(F.col("yards_gained") >= EXPLOSIVE, moment("big_play", gain, F.col("posteam")))
    return plays.select("game_id", "play_id", "quarter", F.inline(F.array_compact(F.array(score, turnover, big))))


def snap_line(raw: DataFrame) -> DataFrame:
    """Total snaps, or the sum of the units' counts; the first share that is there."""
    units = [F.col(f"{u}_snaps") for u in ("offensive", "defensive", "special_teams")]
    some = F.when(F.coalesce(*units).isNotNull(), sum((F.coalesce(u, F.lit(0.0)) for u in units), F.lit(0.0)))
    return raw.withColumn("snaps_played", F.bround(F.coalesce(F.col("snaps").cast("double"), some)).cast("int")).withColumn("snap_share", F.coalesce("snap_pct", "offensive_pct", "defensive_pct", "special_teams_pct"))


def enriched(plays: DataFrame, detail: DataFrame, seq: str) -> DataFrame:
    """Plays with their detail rows; of two with one id, the last counts."""
    last = Window.partitionBy("game_id", "play_id").orderBy(F.desc(seq))
    one = detail.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r", seq)
    return plays.join(one, ["game_id", "play_id"])


def with_context(plays: DataFrame, summaries: DataFrame) -> DataFrame:
    """Every participant has a row, with its summary where there is one."""
    return players(plays).join(summaries, ["game_id", "player"], "left")


def stat_records(records: DataFrame, key: str, kind: str) -> DataFrame:
    """A player's records of several types as one map from type to record."""
    rest = [c for c in records.columns if c not in (key, kind)]
    entry = F.struct(F.col(kind), F.struct(*rest))
    return records.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("records"))


def conflicts(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Fields in which two sources differ; the right one wins."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    both = left.alias("l").join(right.alias("r"), keys)
    rows = F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"l.{c}").cast("string").alias("old"), F.col(f"r.{c}").cast("string").alias("new")) for c in shared))
    return both.select(*keys, F.inline(F.filter(rows, lambda x: ~x["old"].eqNullSafe(x["new"]))))


def cleaned(df: DataFrame) -> DataFrame:
    """NaN and infinities become null, at any depth; so do blank or "null" ids."""

    def fix(c: Column, kind, name: str) -> Column:
        t = kind.typeName()
        if t in ("double", "float"):
            return F.when(~(F.isnan(c) | (F.abs(c) == float("inf"))), c)
        if t == "string" and (name.endswith("_id") or name == "id"):
            return F.when(~F.lower(F.trim(c)).isin("", "null"), c)
        if t == "array":
            return F.transform(c, lambda x: fix(x, kind.elementType, name[:-1] if name.endswith("_ids") else ""))
        if t == "map":
            return F.transform_values(c, lambda k, v: fix(v, kind.valueType, ""))
        if t == "struct":
            return F.when(c.isNotNull(), F.struct(*(fix(c[f.name], f.dataType, f.name).alias(f.name) for f in kind)))
        return c

    return df.select(*(fix(F.col(f"`{f.name}`"), f.dataType, f.name).alias(f.name) for f in df.schema))


LEAGUE_ID, OTHER_ID = r"^\d{2}-\d{7}$", r"^[A-Za-z]{2,6}[A-Z][a-z][0-9]{2}$"


def mapped_ids(df: DataFrame, name: str, static: DataFrame, table: DataFrame, roster: DataFrame) -> DataFrame:
    """League ids pass (repaired where the dash is missing), others are looked up in three tables (other_id, league_id) in turn."""
    c = F.trim(name)
    repaired = F.when(c.rlike(LEAGUE_ID), c).when(c.rlike(r"^\d{9}$"), F.concat(c.substr(1, 2), F.lit("-"), c.substr(3, 7)))
    out, found = df.withColumn("__k", F.lower(c)), [repaired]
    for i, source in enumerate((static, table, roster)):
        one = source.groupBy(F.lower(F.trim("other_id")).alias("__k")).agg(F.min("league_id").alias(f"__f{i}"))
        out = out.join(one, "__k", "left")
        found.append(F.col(f"__f{i}"))
    return out.withColumn("league_id", F.coalesce(*found)).drop("__k", *(f"__f{i}" for i in range(3)))


# What a whole game's log holds.
PLAY_COUNTS, PLAYER_COUNTS = (50, 250), (5, 100)
NEEDED = {"missing_quarter": "quarter", "missing_down": "down", "missing_yards_to_go": "yards_to_go", "missing_yardline": "yardline", "missing_type": "play_type"}
RANGES = {"quarter_range": ("error", "quarter", 1, 5), "down_range": ("error", "down", 1, 4), "yards_to_go_range": ("warning", "yards_to_go", 0, 99), "yards_range": ("warning", "yards_gained", -99, 99)}


def _seen(*columns: str) -> Column:
    """A game's distinct combinations of its plays' columns: one small set, whatever the number of plays."""
    return F.collect_set(F.struct(*columns)).alias("__seen")


def _lineups() -> Column:
    """A game's distinct lineups: the ids of all roles of a play."""
    return F.collect_set(F.concat(F.array(*map(F.col, SCALAR_ROLES.values())), *map(_ids, LIST_ROLES))).alias("__lineups")


def _log_teams() -> Column:
    """The names of the teams on either side, in order."""
    return F.array_sort(F.filter(F.array_union("__seen.posteam", "__seen.defteam"), lambda x: x != ""))


def _log_players() -> Column:
    return F.filter(F.array_distinct(F.flatten("__lineups")), lambda x: x != "")


def checks(plays: DataFrame, share: float = 0.1) -> DataFrame:
    """One row for each rule of a game's log: how often it fails, and whether that breaks it.

    Disorder and missing fields may reach ``share`` of the plays; a column that the log lacks is missing throughout.
    """
    raw = lambda c: F.col(c) if c in plays.columns else F.lit(None).cast("string")
    number = lambda c: F.nanvl(raw(c).cast("double"), F.lit(None).cast("double"))
    named = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    before = Window.partitionBy("game_id").orderBy("play_id")
    seen = plays.withColumns({"__back": F.col("quarter") < F.lag("quarter").over(before), "__again": F.col("play_id") == F.lag("play_id").over(before)})
    faults = {
        "n_plays": F.lit(True), "again": F.col("__again"), "back": F.col("__back"), "no_team": ~named("posteam") | ~named("defteam"), **{rule: raw(c).isNull() for rule, c in NEEDED.items()},
        **{rule: ~number(c).between(low, high) for rule, (_, c, low, high) in RANGES.items()}, "odd_touchdowns": ~number("touchdown").isin(0, 1),
        "no_passer": (F.col("play_type") == "pass") & ~named("passer_player_id"), "no_rusher": (F.col("play_type") == "run") & ~named("rusher_player_id"),
    }
    per = seen.groupBy("game_id").agg(*(F.count_if(c).alias(n) for n, c in faults.items()), _seen("posteam", "defteam"), _lineups())
    odd = lambda x: (F.size(F.split(x, "-")) == 2) & ~x.rlike("^..-[0-9]{7}$")  # noqa: E731  (ids in two parts that are not two signs and seven digits)
    per = per.withColumns({"teams": _log_teams(), "__players": _log_players(), "__id": F.col("game_id").cast("string")})
    whole = id_parts(per.withColumns({"n_players": F.size("__players"), "odd_ids": F.size(F.filter("__players", odd))}), "__id")
    expected = F.array_sort(F.array_distinct(F.array("away_team", "home_team")))
    other_teams = (F.col("away_team") != "") & (F.col("home_team") != "") & (F.size("teams") > 0) & (F.col("teams") != expected)

    def rule(name: str, found: Column, level: str = "warning", broken: Column | None = None) -> Column:
        held = F.coalesce(found > 0 if broken is None else broken, F.lit(False))
        return F.struct(F.lit(name).alias("rule"), F.lit(level).alias("level"), found.cast("long").alias("found"), held.alias("broken"))

    most = F.col("n_plays") * share
    n_plays, n_players, n_teams = F.col("n_plays"), F.col("n_players"), F.size("teams")
    rules = [
        rule("duplicate_play_ids", F.col("again"), "error"), rule("play_order", F.col("back"), broken=F.col("back") > most), rule("missing_team", F.col("no_team")),
        *(rule(name, F.col(name), broken=F.col(name) > most) for name in NEEDED), *(rule(name, F.col(name), level) for name, (level, *_) in RANGES.items()),
        rule("touchdown_value", F.col("odd_touchdowns")), rule("passer_missing", F.col("no_passer")), rule("rusher_missing", F.col("no_rusher")),
        rule("play_count", n_plays, broken=~n_plays.between(*PLAY_COUNTS)), rule("team_count", n_teams, broken=n_teams != 2), rule("game_teams", n_teams, broken=other_teams),
        rule("player_count", n_players, broken=~n_players.between(*PLAYER_COUNTS)), rule("player_ids", F.col("odd_ids")),
    ]
    return whole.select("game_id", F.inline(F.array(*rules)))


def valid_logs(report: DataFrame, strict: bool = False) -> DataFrame:
    """The verdict on each game: no error, and if ``strict`` no warning either."""
    per = report.groupBy("game_id").agg(*(F.count_if(F.col("broken") & (F.col("level") == k)).alias(f"{k}s") for k in ("error", "warning")))
    return per.withColumn("is_valid", (F.col("errors") == 0) & (F.lit(not strict) | (F.col("warnings") == 0)))


def log_statistics(plays: DataFrame) -> DataFrame:
    """What a game's log covers."""
    per = plays.groupBy("game_id").agg(F.count("*").alias("n_plays"), _seen("quarter", "posteam", "defteam", "play_type"), _lineups())
    return per.select(
        "game_id", "n_plays", F.array_sort(F.filter(F.array_distinct("__seen.quarter"), lambda q: q != 0)).alias("quarters"), _log_teams().alias("teams"),
        F.size(F.array_distinct(F.array_compact("__seen.play_type"))).cast("long").alias("n_types"), F.size(_log_players()).cast("long").alias("n_players"),
    )


def play_type_counts(plays: DataFrame) -> DataFrame:
    return plays.groupBy("game_id", "play_type").agg(F.count("*").alias("n"))


# The statistics that are asked for by position.
STAT_TYPES = {"QB": ["passing", "rushing"], "RB": ["rushing", "receiving"], "FB": ["rushing", "receiving"], "WR": ["receiving"], "TE": ["receiving"]}


def stat_requests(chosen: DataFrame) -> DataFrame:
    """The players of each game for whom each type of statistics is wanted."""
    kinds = F.element_at(F.create_map(*(x for p, k in STAT_TYPES.items() for x in (F.lit(p), F.array(*map(F.lit, k))))), F.col("position"))
    wanted = chosen.select("game_id", "player", F.explode(kinds).alias("stat_type"))
    return wanted.groupBy("game_id", "stat_type").agg(F.array_sort(F.collect_set("player")).alias("players"))


def same_game(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of right for a game of left: by id, else by the other id, else by season, week and the two teams in any order."""
    teams = lambda t: F.array_sort(F.array(f"{t}.team", f"{t}.opponent"))
    by_id = F.col("l.game_id") == F.col("r.game_id")
    by_other = F.col("l.pfr_game_id") == F.col("r.pfr_game_id")
    by_teams = (F.col("l.season") == F.col("r.season")) & (F.col("l.week") == F.col("r.week")) & (teams("l") == teams("r"))
    rank = F.when(by_id, 1).when(by_other, 2).otherwise(3)
    parts = [left.alias("l").join(right.alias("r"), on).select(F.col("l.game_id").alias("asked"), "r.*", rank.alias("how")) for on in (by_id, by_other, by_teams)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return both.groupBy("asked", *right.columns).agg(F.min("how").alias("how"))


def filled(df: DataFrame, roster: DataFrame, key: str, names: list[str], seq: str) -> DataFrame:
    """Null fields filled from a roster, whose last row for a key counts."""
    last = Window.partitionBy(key).orderBy(F.desc(seq))
    one = roster.withColumn("__r", F.row_number().over(last)).where("__r = 1").select(key, *(F.col(n).alias(f"__{n}") for n in names))
    return df.join(one, key, "left").withColumns({n: F.coalesce(F.col(n), F.col(f"__{n}")) for n in names}).drop(*(f"__{n}" for n in names))


def id_parts(df: DataFrame, name: str = "game_id") -> DataFrame:
    """Season, week, away and home team of an id season_week_away_home."""
    p = F.split(name, "_")
    ok = F.size(p) >= 4
    part = lambda i: F.when(ok, F.get(p, F.lit(i)))
    return df.withColumns({"id_season": part(0).try_cast("int"), "id_week": part(1).try_cast("int"), "away_team": part(2), "home_team": part(3)})


PLAY_COLUMNS = [
    "play_id", "game_id", "quarter", "time", "down", "yards_to_go", "yardline", "posteam", "defteam", "play_type", "yards_gained", "touchdown", "safety", *SCALAR_ROLES.values(), *LIST_ROLES.values(),
]
OLDER_NAMES = {"time": "clock", "yards_to_go": "distance", "yardline": "yardline_100"}


def adapted(raw: DataFrame) -> DataFrame:
    """Plays under today's or older column names; what is left over goes to a map of text. Both ids are needed."""
    missing = [c for c in ("play_id", "game_id") if c not in raw.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    names = [*PLAY_COLUMNS, *OLDER_NAMES.values()]

    def one(name: str) -> Column:
        found = [F.col(n) for n in (name, OLDER_NAMES.get(name)) if n in raw.columns]
        kind = "array<string>" if name in LIST_ROLES.values() else "string"
        c = F.coalesce(*found) if found else F.lit(None).cast(kind)
        return (F.coalesce(c, F.expr("cast(array() as array<string>)")) if name in LIST_ROLES.values() else c).alias(name)

    rest = [c for c in raw.columns if c not in names]
    more = F.map_from_arrays(F.array(*map(F.lit, rest)), F.array(*(F.col(c).cast("string") for c in rest))) if rest else F.expr("cast(map() as map<string,string>)")
    return raw.select(*map(one, PLAY_COLUMNS), F.map_filter(more, lambda k, v: v.isNotNull()).alias("additional_fields"))


def headers(plays: DataFrame) -> DataFrame:
    """Season, week and teams of each game by its id (K4); an id that names no teams leaves them to the log, in order of name."""
    per = plays.groupBy("game_id").agg(_seen("posteam", "defteam"), F.count("*").alias("n_plays")).withColumns({"teams": _log_teams(), "__id": F.col("game_id").cast("string")})
    team = lambda name, i: F.coalesce(F.nullif(F.col(name), F.lit("")), F.get("teams", F.lit(i)), F.lit("UNKNOWN")).alias(name)
    header = F.struct(F.col("__id").alias("game_id"), F.col("id_season").alias("season"), F.col("id_week").alias("week"), team("away_team", 0), team("home_team", 1))
    return id_parts(per, "__id").select("game_id", header.alias("header"), "n_plays")


def envelope(plays: DataFrame, top: int = 5) -> DataFrame:
    """One nested document for each game: header, teams, leaders, key moments, and pointers that count what is kept outside."""
    team = F.struct("team", "points", "total_yards", "touchdowns")
    teams = team_summaries(plays).groupBy("game_id").agg(F.array_sort(F.collect_list(team)).alias("teams"))
    best = selected(plays).groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("relevance")).alias("order"), "player", "team", "position"))).alias("chosen"))
    moments = key_sequences(plays).groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct("play_id", "kind", "label"))).alias("moments"))
    whole = headers(plays).join(teams, "game_id", "left").join(best, "game_id", "left").join(moments, "game_id", "left")
    leaders = F.transform(F.slice("chosen", 1, top), lambda x: x["player"]).alias("leaders")
    count = lambda n, name: F.when(n > 0, F.struct(n.alias("record_count"))).alias(name)
    pointers = F.struct(count(F.col("n_plays"), "play_by_play"), count(F.size("chosen"), "player_data"), count(F.size("teams"), "team_data"))
    return whole.select("game_id", F.to_json(F.struct("header", "teams", leaders, "moments", pointers.alias("pointers"))).alias("envelope"))
