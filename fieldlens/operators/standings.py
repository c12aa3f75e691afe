"""Season standings: records, splits, streaks, strengths, tie-breaks and seeds (family C).

Games have season, wk, home, away, home_score, away_score; teams have team_abbr, team_name, conference, division. Everything
works on all seasons at once. Tie-breaks run for one season's teams at a time, some tens of rows.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY = ["season", "team"]


def on_schedule(teams: DataFrame, games: DataFrame) -> DataFrame:
    """Teams that the unclipped schedule names; all of them if it is empty."""
    named = games.select(F.col("home").alias("team_abbr")).union(games.select("away")).distinct()
    empty = games.agg((F.count("*") == 0).alias("__none"))
    listed = teams.join(named.withColumn("__on", F.lit(True)), "team_abbr", "left").crossJoin(F.broadcast(empty))
    return listed.where(F.col("__on") | F.col("__none")).drop("__on", "__none")


def through(games: DataFrame, week: int | None) -> DataFrame:
    """Games up to a week; a missing week counts as 0."""
    return games if week is None else games.where(F.coalesce("wk", F.lit(0)) <= week)


def effective_week(games: DataFrame) -> DataFrame:
    """Each season's last week with a full score, else 0."""
    played = F.col("home_score").isNotNull() & F.col("away_score").isNotNull()
    return games.groupBy("season").agg(F.coalesce(F.max(F.when(played, F.col("wk"))), F.lit(0)).alias("effective_week"))


def team_games(games: DataFrame, teams: DataFrame) -> DataFrame:
    """C4: two rows for each scored game between known teams."""
    scored = games.where("home_score is not null and away_score is not null")
    for side in ("home", "away"):
        scored = scored.join(teams.select(F.col("team_abbr").alias(side)), side, "left_semi")
    side = lambda me, them, home: F.struct(
        F.col(me).alias("team"), F.col(them).alias("opp"), F.col(f"{me}_score").alias("pf"), F.col(f"{them}_score").alias("pa"), F.lit(home).alias("is_home")
    )
    both = scored.select("season", "wk", "game_id", F.inline(F.array(side("home", "away", True), side("away", "home", False))))
    return both.withColumn("outcome", F.when(F.col("pf") > F.col("pa"), "W").when(F.col("pf") < F.col("pa"), "L").otherwise("T"))


def _count(outcome: str, where: Column | None = None) -> Column:
    hit = F.col("outcome") == outcome
    return F.count_if(hit if where is None else hit & where).cast("int")


def pct(w: Column, losses: Column, t: Column) -> Column:
    """Wins and half the ties by games; 0 without games."""
    n = w + losses + t
    return F.when(n > 0, (w + 0.5 * t) / n).otherwise(0.0)


def record(w: Column, losses: Column, t: Column) -> Column:
    """W-L, or W-L-T where there are ties."""
    return F.when(t > 0, F.concat_ws("-", w, losses, t)).otherwise(F.concat_ws("-", w, losses))


def totals(sides: DataFrame) -> DataFrame:
    """Each team's season totals, with home and away splits."""
    home = F.col("is_home")
    out = sides.groupBy(*KEY).agg(
        *(_count(o).alias(n) for o, n in (("W", "wins"), ("L", "losses"), ("T", "ties"))),
        F.sum("pf").cast("int").alias("points_for"),
        F.sum("pa").cast("int").alias("points_against"),
        *(_count(o, c).alias(f"{n}_{k}") for n, c in (("home", home), ("away", ~home)) for o, k in (("W", "w"), ("L", "l"), ("T", "t"))),
    )
    return out.withColumn("point_diff", F.col("points_for") - F.col("points_against")).withColumn("win_pct", pct(F.col("wins"), F.col("losses"), F.col("ties")))


def pairs(sides: DataFrame) -> DataFrame:
    """Each team's record and net points against each opponent."""
    return sides.groupBy("season", "team", "opp").agg(_count("W").alias("w"), _count("L").alias("l"), _count("T").alias("t"), F.sum(F.col("pf") - F.col("pa")).cast("int").alias("net"))


def splits(pair: DataFrame, teams: DataFrame) -> DataFrame:
    """Records within division and conference; blank ones match nothing."""
    meta = lambda key, mark: teams.select(F.col("team_abbr").alias(key), F.col("division").alias(f"{mark}d"), F.col("conference").alias(f"{mark}c"))
    joined = pair.join(meta("team", "m"), "team").join(meta("opp", "o"), "opp")
    inside = {"div": (F.col("md") == F.col("od")) & (F.col("md") != ""), "conf": (F.col("mc") == F.col("oc")) & (F.col("mc") != "")}
    return joined.groupBy(*KEY).agg(*(F.sum(F.when(ok, F.col(c)).otherwise(0)).cast("int").alias(f"{n}_{c}") for n, ok in inside.items() for c in "wlt"))


def strengths(pair: DataFrame, total: DataFrame) -> DataFrame:
    """Mean win share of the distinct opponents (sos), and of those beaten (sov); 0 without any."""
    opp = total.select("season", F.col("team").alias("opp"), F.col("win_pct").alias("__p"))
    mean = lambda c: F.coalesce(F.round(F.avg(c), 12), F.lit(0.0))
    return pair.join(opp, ["season", "opp"]).groupBy(*KEY).agg(mean(F.col("__p")).alias("sos"), mean(F.when(F.col("w") > 0, F.col("__p"))).alias("sov"))


def _latest():
    return Window.partitionBy(*KEY).orderBy(F.desc("wk"), F.desc("game_id"))


def last_five(sides: DataFrame, n: int = 5) -> DataFrame:
    """The record of the last n games."""
    recent = sides.withColumn("__r", F.row_number().over(_latest())).where(F.col("__r") <= n)
    return recent.groupBy(*KEY).agg(record(_count("W"), _count("L"), _count("T")).alias("last5"))


def streaks(sides: DataFrame) -> DataFrame:
    """C11: the outcome of the last game, and how many games in a row had it."""
    last = F.first("outcome").over(_latest())
    broken = F.sum(F.when(F.col("outcome") != F.col("__last"), 1).otherwise(0)).over(_latest())
    run = sides.withColumn("__last", last).withColumn("__broken", broken).where("__broken = 0")
    return run.groupBy(*KEY).agg(F.concat(F.first("outcome"), F.count("*").cast("string")).alias("streak"))


def form(sides: DataFrame, n: int = 5) -> DataFrame:
    """last_five and streaks in one pass over the games of a team."""
    of = sides.select(*KEY, "wk", "game_id", "outcome").withColumn("__r", F.row_number().over(_latest())).withColumn("__last", F.first("outcome").over(_latest()))
    of = of.withColumn("__broken", F.sum(F.when(F.col("outcome") != F.col("__last"), 1).otherwise(0)).over(_latest()))
    recent = [_count(o, F.col("__r") <= n) for o in "WLT"]
    return of.groupBy(*KEY).agg(record(*recent).alias("last5"), F.concat(F.first("__last"), F.count_if(F.col("__broken") == 0).cast("string")).alias("streak"))


def league_rank(total: DataFrame) -> DataFrame:
    """Unique ranks by win share, point difference, points and code."""
    order = Window.partitionBy("season").orderBy(F.desc("win_pct"), F.desc("point_diff"), F.desc("points_for"), "team")
    return total.withColumn("league_rank", F.row_number().over(order))


def points_ranks(total: DataFrame, scope: list[str]) -> DataFrame:
    """Rank by points for plus rank by points against, equal values sharing the lower rank."""
    w = Window.partitionBy(*scope)
    return total.withColumn("points_rank", F.rank().over(w.orderBy(F.desc("points_for"))) + F.rank().over(w.orderBy("points_against")))


def common_opponents(pair: DataFrame, groups: DataFrame) -> DataFrame:
    """C17, C20: opponents that every member of a group has met, with each member's record and net points against them.

    groups has season, team, grp.
    """
    size = groups.groupBy("season", "grp").agg(F.count("*").alias("members"))
    met = pair.join(groups, KEY)
    shared = met.groupBy("season", "grp", "opp").agg(F.countDistinct("team").alias("n")).join(size, ["season", "grp"]).where("n = members")
    inside = met.join(shared.select("season", "grp", "opp"), ["season", "grp", "opp"])
    return inside.groupBy("season", "grp", "team").agg(F.count("*").alias("n_common"), *(F.sum(c).cast("int").alias(c) for c in ("w", "l", "t", "net")))


# Tie-breaks -------------------------------------------------------------------------------------------------


class Season:
    """One season's teams as dictionaries, and the keys by which each step parts a tied group (larger is better)."""

    def __init__(self, rows: list[dict], pair: dict[tuple[str, str], tuple[int, int, int, int]]):
        self.rows = {r["team"]: r for r in rows}
        self.pair = pair
        self.met: dict[str, set[str]] = {t: set() for t in self.rows}
        for team, opp in pair:
            self.met[team].add(opp)

    @staticmethod
    def share(w: int, losses: int, t: int, empty: float = 0.0) -> float:
        n = w + losses + t
        return (2 * w + t) / (2 * n) if n else empty

    def against(self, team: str, opponents) -> tuple[int, int, int, int]:
        seen = [self.pair[team, o] for o in opponents if (team, o) in self.pair]
        return tuple(map(sum, zip(*seen))) if seen else (0, 0, 0, 0)

    def common(self, group: list[str]) -> set[str]:
        return set.intersection(*(self.met[t] for t in group))

    def key(self, step: str, group: list[str]) -> dict[str, float]:
        of = lambda f: {t: f(self.rows[t]) for t in group}
        if step == "H2H":
            if len(group) == 2:
                return {t: (lambda r: (r[0] > r[1]) - (r[0] < r[1]))(self.against(t, set(group) - {t})) for t in group}
            return {t: self.share(*self.against(t, set(group) - {t})[:3], empty=0.5) for t in group}
        if step in ("DIV", "CONF"):
            k = step.lower()
            return of(lambda r: self.share(r[f"{k}_w"], r[f"{k}_l"], r[f"{k}_t"]))
        if step in ("COMMON", "NET_COMMON"):
            shared = self.common(group)
            if len(shared) < (4 if step == "COMMON" else 1):
                return dict.fromkeys(group, 0.0)
            seen = {t: self.against(t, shared) for t in group}
            return {t: self.share(*s[:3]) if step == "COMMON" else s[3] for t, s in seen.items()}
        if step in ("CONF_PTS", "ALL_PTS"):
            conference = self.rows[group[0]]["conference"]
            pool = [r for r in self.rows.values() if step == "ALL_PTS" or r["conference"] == conference]
            rank = lambda r: sum(o["points_for"] > r["points_for"] for o in pool) + sum(o["points_against"] < r["points_against"] for o in pool)
            return of(lambda r: -rank(r))
        return of(lambda r: r[{"SOV": "sov", "SOS": "sos", "NET_ALL": "point_diff", "WPCT": "win_pct"}[step]])

    def order(self, teams: list[str], steps: list[str]) -> list[tuple[str, list[str]]]:
        """Teams from best to worst, each with the labels of the steps that parted it from others.

        Every tied group meets the steps in one fixed order, so one pass over the steps refines all groups together.
        """
        if len(teams) < 2:
            return [(t, []) for t in teams]
        trail: dict[str, list[str]] = {t: ["WPCT"] for t in teams}
        groups = self._part(teams, self.key("WPCT", teams))
        for step in steps:
            refined = []
            for group in groups:
                parts = self._part(group, self.key(step, group)) if len(group) > 1 else [group]
                if len(parts) > 1:
                    for t in group:
                        trail[t].append(step)
                refined += parts
            groups = refined
        for group in groups:
            if len(group) > 1:
                for t in group:
                    trail[t].append("COIN")
        return [(t, trail[t]) for group in groups for t in sorted(group)]

    @staticmethod
    def _part(group: list[str], key: dict[str, float]) -> list[list[str]]:
        return [[t for t in group if key[t] == v] for v in sorted({key[t] for t in group}, reverse=True)]


DIVISION_STEPS = ["H2H", "DIV", "COMMON", "CONF", "SOV", "SOS", "CONF_PTS", "ALL_PTS", "NET_COMMON", "NET_ALL"]
CONFERENCE_STEPS = ["H2H", "CONF", "COMMON", "SOV", "SOS", "CONF_PTS", "ALL_PTS", "NET_COMMON", "NET_ALL"]
SEEDS = 7


def ranked(season: Season) -> list[dict]:
    """Division and conference ranks, seeds and trails of a season's teams."""
    divisions: dict[tuple[str, str], list[str]] = {}
    for team, r in sorted(season.rows.items()):
        divisions.setdefault((r["conference"], r["division"]), []).append(team)
    out: dict[str, dict] = {}
    queues: dict[str, dict[str, list[str]]] = {}
    for (conference, division), teams in divisions.items():
        for place, (team, trail) in enumerate(season.order(teams, DIVISION_STEPS), 1):
            out[team] = {"team": team, "division_rank": place, "tiebreaker_trail": trail}
            queues.setdefault(conference, {}).setdefault(division, []).append(team)
    for conference, by_division in queues.items():
        placed = [(t, trail) for t, trail in season.order([q[0] for q in by_division.values()], CONFERENCE_STEPS)]
        waiting = [q[1:] for q in by_division.values()]
        while heads := [q[0] for q in waiting if q]:  # the best head of all divisions goes next
            best, trail = season.order(heads, CONFERENCE_STEPS)[0]
            placed.append((best, trail))
            next(q for q in waiting if q and q[0] == best).pop(0)
        for place, (team, trail) in enumerate(placed, 1):
            row = out[team]
            row["tiebreaker_trail"] = list(dict.fromkeys(row["tiebreaker_trail"] + trail))
            row |= {"conference_rank": place, "conference_seed": place if place <= SEEDS else None, "tied": "COIN" in row["tiebreaker_trail"]}
    return list(out.values())


_RANK_SCHEMA = "season int, team string, division_rank int, conference_rank int, conference_seed int, tiebreaker_trail array<string>, tied boolean"


def tie_breaks(base: DataFrame, pair: DataFrame) -> DataFrame:
    """C13-C24 for every season of base (one row for each team) and pair."""

    met = pair.groupBy("season", "team").agg(F.collect_list(F.struct("opp", "w", "l", "t", "net")).alias("met"))  # as many as there are teams

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        records = frame.to_dict("records")
        seen = {(r["team"], p["opp"]): (p["w"], p["l"], p["t"], p["net"]) for r in records if r["met"] is not None for p in r["met"]}
        rows = pd.DataFrame(ranked(Season(records, seen)), columns=["team", "division_rank", "conference_rank", "conference_seed", "tiebreaker_trail", "tied"])
        rows.insert(0, "season", int(key[0]))
        return rows.astype({"conference_seed": "Int32"})

    return base.join(met, KEY, "left").groupBy("season").applyInPandas(one, _RANK_SCHEMA)


def standings(games: DataFrame, teams: DataFrame, through_week: int | None = None) -> DataFrame:
    """One row of 26 columns for each season and team on the schedule."""
    seasons = games.select("season").distinct()
    listed = on_schedule(teams, games)
    clipped = through(games, through_week)
    sides = team_games(clipped, listed)
    total, pair = totals(sides), pairs(sides)
    roster = seasons.crossJoin(listed.withColumnRenamed("team_abbr", "team"))
    whole = roster.select("season", "team", "team_name", "conference", "division").join(total, KEY, "left").join(splits(pair, listed), KEY, "left").join(strengths(pair, total), KEY, "left")
    counts = [c for c, kind in whole.dtypes if kind in ("int", "double") and c != "season"]
    base = league_rank(whole.na.fill(0, counts))
    week = effective_week(clipped) if through_week is None else seasons.withColumn("effective_week", F.lit(through_week))
    ranks = tie_breaks(base.select("season", "team", "conference", "division", *counts), pair)
    full = base.join(ranks, KEY).join(form(sides), KEY, "left").join(week, "season", "left")
    rec = lambda n: record(*(F.col(f"{n}_{c}") for c in "wlt")).alias(f"{n}_record")
    return full.select(
        "season", F.coalesce("effective_week", F.lit(0)).alias("through_week"), F.col("team").alias("team_abbr"), "team_name", "conference", "division", "wins", "losses", "ties",
        F.bround("win_pct", 6).alias("win_pct"), "points_for", "points_against", "point_diff", rec("div").alias("division_record"), rec("conf").alias("conference_record"), rec("home"), rec("away"),
        F.coalesce("last5", F.lit("0-0")).alias("last5"), F.coalesce("streak", F.lit("")).alias("streak"), "division_rank", "conference_rank", "conference_seed", "league_rank",
        F.lit(None).cast("string").alias("clinched"), "tiebreaker_trail", "tied",
    )
