"""Parameterised reads: filters, calendars and package envelopes."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEASON_COLUMNS = ["season", "season_year", "year"]


def filter_first_present(df: DataFrame, value: Any, columns: list[str]) -> DataFrame:
    """A2: equality on the first of the columns that is present; no filter where none is, or value is None."""
    name = next((c for c in columns if c in df.columns), None)
    return df if name is None or value is None else df.where(F.col(name) == value)


def residual(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Array and list overlap, array and value contains, value and list in, value and value null-safe equality."""
    for name, want in filters.items():
        c, many = F.col(name), isinstance(want, (list, tuple, set))
        if df.schema[name].dataType.typeName() == "array":
            df = df.where(F.arrays_overlap(c, F.array(*map(F.lit, want))) if many else F.array_contains(c, want))
        elif many:
            df = df.where(c.isin(*want))
        else:
            df = df.where(c.eqNullSafe(F.lit(want)))
    return df


class Provider:
    """A table with required parameters; every filter is a predicate, which Catalyst pushes to the scan."""

    def __init__(self, table: Callable[[], DataFrame], required: tuple[str, ...] = (), drop: tuple[str, ...] = (), prepare: Callable[[DataFrame], DataFrame] | None = None):
        self.table, self.required, self.drop, self.prepare = table, required, drop, prepare

    def get(self, output: str = "frame", **filters: Any) -> Any:
        missing = [r for r in self.required if filters.get(r) is None]
        if missing:
            raise ValueError(f"missing parameters: {', '.join(missing)}")
        df = self.table()
        df = self.prepare(df) if self.prepare else df
        df = residual(df, {k: v for k, v in filters.items() if v is not None}).drop(*self.drop)
        if output == "json":
            return df.select(F.to_json(F.struct("*")).alias("json"))
        return df


def _given(filters: dict, *names: str) -> dict:
    """Filters with text trimmed, emptied lists refused, and the first of several names used."""
    out = {}
    for key, value in filters.items():
        if isinstance(value, str):
            value = value.strip() or None
        elif isinstance(value, (list, tuple, set)):
            value = [v for v in (x.strip() if isinstance(x, str) else x for x in value) if v not in (None, "")] or None
        out[key] = value
    if names:
        first = next((out.pop(n) for n in names if out.get(n) is not None), None)
        for n in names:
            out.pop(n, None)
        out[names[0]] = first
    return out


class GameProvider(Provider):
    """Rows of one game; season and week are read off the game's id where they are not given, so partitions are pruned."""

    def __init__(self, table: Callable[[], DataFrame], by_player: bool = False):
        super().__init__(table, ("game_id", "season") + ("player_id",) * by_player)
        self.by_player = by_player

    def get(self, output: str = "frame", **filters: Any) -> Any:
        asked = _given(_given(filters, "game_id", "games_id"), *(("player_id", "pfr_id") if self.by_player else ()))
        parts = str(asked.get("game_id") or "").split("_")
        if len(parts) > 2 and parts[0].isdigit() and len(parts[0]) == 4 and parts[1].isdigit():
            asked["season"] = asked.get("season") or int(parts[0])
            asked["week"] = asked.get("week") or int(parts[1])
        if isinstance(asked.get("player_id"), (int, float)):
            asked["player_id"] = str(int(asked["player_id"]))
        return super().get(output, **asked)


class KeyedProvider(Provider):
    """Rows by season, week and player, each of which may be a list."""

    def get(self, output: str = "frame", **filters: Any) -> Any:
        asked = _given(filters, "player_id", "pfr_id")
        for name in ("season", "week"):
            if isinstance(asked.get(name), str) and asked[name].isdigit():
                asked[name] = int(asked[name])
        return super().get(output, **asked)


class CurrentInjuries(Provider):
    """The current version of a week's injuries; the regular season unless told otherwise."""

    def __init__(self, table: Callable[[], DataFrame]):
        super().__init__(table, ("season", "week"), prepare=lambda df: df.where("is_current"))

    def get(self, output: str = "frame", **filters: Any) -> Any:
        asked = _given(filters)
        asked["season_type"] = (asked.get("season_type") or "REG").upper()
        asked["team_abbr"] = asked["team_abbr"].upper() if asked.get("team_abbr") else None
        return super().get(output, **asked)


class TeamProvider:
    """A team's games of a season or week, or their summary."""

    def __init__(self, games: Callable[[], DataFrame], summary: bool):
        self.games, self.summary = games, summary

    def get(self, output: str = "frame", **filters: Any) -> Any:
        if filters.get("team_abbr") is None or filters.get("season") is None:
            raise ValueError("missing parameters: team_abbr, season")
        df = self.games().where(F.col("season") == filters["season"])
        if filters.get("week") is not None:
            df = df.where(F.col("wk") == filters["week"])
        view = team_perspective(df, str(filters["team_abbr"]).strip().upper())
        out = season_summary(view) if self.summary else view
        return out.select(F.to_json(F.struct("*")).alias("json")) if output == "json" else out


def season_summary(view: DataFrame) -> DataFrame:
    """Record and averages by season of a team's view; averages are null without games."""
    played = F.col("result").isNotNull()
    n = lambda r: F.count_if(F.col("result") == r)
    mean = lambda c: F.round(F.try_divide(F.sum(F.when(played, F.col(c))).cast("double"), F.count_if(played)), 4)
    return view.groupBy("season").agg(F.count_if(played).alias("games_played"), F.concat_ws("-", n("W"), n("L"), n("T")).alias("record"), mean("points_for").alias("avg_for"), mean("points_against").alias("avg_against"))


class Lookup:
    """Players by part of their name."""

    def __init__(self, players: Callable[[], DataFrame]):
        self.players = players

    def get(self, output: str = "frame", **filters: Any) -> Any:
        if not str(filters.get("name") or "").strip():
            raise ValueError("missing parameters: name")
        out = find_players(self.players(), filters["name"].strip(), filters.get("team"), filters.get("limit", 10))
        return out.select(F.to_json(F.struct("*")).alias("json")) if output == "json" else out


# Columns that weekly statistics leave out.
DESCRIPTIVE = ["player_name", "player_display_name", "position", "position_group", "headshot_url", "season_type", "team", "opponent_team"]


def registry(table: Callable[[str], DataFrame]) -> dict[str, Any]:
    """All providers by name, over a function from a table's name to its rows."""
    of = lambda name: lambda: table(name)
    keyed = ("season", "week", "player_id")
    return {
        "pfr": KeyedProvider(of("pfr"), ("season", "player_id")),
        "ftn": Provider(of("ftn"), ()),
        "snap_counts": GameProvider(of("snap_counts"), by_player=True),
        "pbp": GameProvider(of("plays")),
        "ngs": KeyedProvider(of("ngs"), keyed),
        "player_weekly_stats": KeyedProvider(of("weekly_stats"), keyed, drop=tuple(DESCRIPTIVE)),
        "player_season_stats": KeyedProvider(of("pfr"), ("season", "player_id")),
        "team_weekly_stats": TeamProvider(of("games"), summary=False),
        "team_season_stats": TeamProvider(of("games"), summary=True),
        "injuries": CurrentInjuries(of("injuries")),
        "player_lookup": Lookup(of("rosters")),
    }


def season_week_of(game_id: Column) -> tuple[Column, Column]:
    """Season and week of an id that begins with year_week_."""
    part = lambda i: F.nullif(F.regexp_extract(game_id, r"(\d{4})_(\d{1,2})_", i), F.lit("")).cast("int")
    return part(1), part(2)


def team_perspective(games: DataFrame, team: str | Column) -> DataFrame:
    """One team's view of its games, with the result where both scores are known."""
    team = F.lit(team) if isinstance(team, str) else team
    home = F.col("home") == team
    mine, theirs = F.when(home, F.col("home_score")).otherwise(F.col("away_score")), F.when(home, F.col("away_score")).otherwise(F.col("home_score"))
    return games.where(home | (F.col("away") == team)).select(
        "game_id", "season", "wk", team.alias("team"), F.when(home, F.col("away")).otherwise(F.col("home")).alias("opponent"), home.alias("is_home"), mine.alias("points_for"), theirs.alias("points_against"),
        F.when(mine > theirs, "W").when(mine < theirs, "L").when(mine == theirs, "T").alias("result"),
    )


def find_players(players: DataFrame, name: str, team: str | None = None, limit: int = 10) -> DataFrame:
    """Players whose name holds the text in any case; ordered, so that the limit is stable."""
    escaped = "".join("\\" + c if c in "%_\\" else c for c in name)
    found = players.where(F.col("player_name").ilike(f"%{escaped}%"))
    if team is not None:
        found = found.where(F.col("team") == team)
    return found.orderBy("player_name", "player").limit(limit)


def season_of(day: Column) -> Column:
    """The season a day belongs to; seasons begin in March."""
    return F.when(F.month(day) >= 3, F.year(day)).otherwise(F.year(day) - 1)


def week_of(day: Column, opening: Column) -> Column:
    """Weeks since the opening day, from 1."""
    return (F.floor(F.datediff(day, opening) / 7) + 1).cast("int")


# Weeks of each part of a season.
PRESEASON_WEEKS, REGULAR_WEEKS, PLAYOFF_WEEKS = 3, 18, 4


def calendar_week(day: Column, preseason: Column, opening: Column) -> tuple[Column, Column]:
    """Week and part (pre, reg, post) of the season that begins on two given days; both null outside of it."""
    early, week = week_of(day, preseason), week_of(day, opening)
    inside = (day >= preseason) & (week <= REGULAR_WEEKS + PLAYOFF_WEEKS)
    part = F.when(day < opening, "pre").when(week <= REGULAR_WEEKS, "reg").otherwise("post")
    number = F.when(day < opening, F.least(early, F.lit(PRESEASON_WEEKS))).when(week <= REGULAR_WEEKS, week).otherwise(week - REGULAR_WEEKS)
    return F.when(inside, number), F.when(inside, part)


def in_season(day: Column, preseason: Column, opening: Column) -> Column:
    """From the preseason to the end of the playoffs."""
    return calendar_week(day, preseason, opening)[0].isNotNull()


def opening_day(year: int) -> date:
    """The Thursday after the first Monday of September."""
    first = date(year, 9, 1)
    monday = 1 + (7 - first.weekday()) % 7
    return date(year, 9, monday + 3)


def pruned(value: Any) -> Any:
    """Without nulls, at any depth."""
    if isinstance(value, Mapping):
        return {k: pruned(v) for k, v in value.items() if v is not None}
    if isinstance(value, (list, tuple)):
        return [pruned(v) for v in value if v is not None]
    return value


def package_id(schema_version: str, subject: Mapping, scope: Mapping, bundles: list, sources: list) -> str:
    """SHA-256 of the canonical JSON of what identifies a package."""
    body = pruned({"schema_version": schema_version, "subject": subject, "scope": scope, "bundles": bundles, "sources": sources})
    return hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()).hexdigest()


def package(request: Mapping[str, Any], providers: Mapping[str, Provider], strict: bool = True) -> dict[str, Any]:
    """An envelope with the rows of each inlined bundle, or a pointer; without ``strict``, bundles that fail are noted.

    A request is small by nature: all rows that its filters let through are inlined, and a bundle that states a ``limit`` gets an error if there are more.
    """
    payload, links, errors = {}, {}, []
    for bundle in request.get("bundles", []):
        name = bundle["name"]
        try:
            if bundle["provider"] not in providers:
                raise KeyError(f"unknown provider {bundle['provider']}")
            if bundle.get("inline", bundle.get("storage_mode", "inlined") == "inlined"):
                rows = providers[bundle["provider"]].get(**bundle.get("filters", {}))
                most = bundle.get("limit")
                found = (rows if most is None else rows.limit(most + 1)).collect()
                if most is not None and len(found) > most:
                    raise ValueError(f"{name} has more than {most} rows")
                payload[name] = [r.asDict(True) for r in found]
            else:
                links[name] = {"provider": bundle["provider"], "filters": dict(bundle.get("filters", {}))}
        except Exception as e:
            if strict:
                raise
            errors.append({"bundle": name, "error": str(e).splitlines()[0]})
    if errors:
        links["bundle_errors"] = errors
    heads = [{k: b[k] for k in ("name", "provider") if k in b} for b in request.get("bundles", [])]
    ident = package_id(request["schema_version"], request.get("subject", {}), request.get("scope", {}), heads, list(request.get("sources") or request.get("provenance", {}).get("sources", [])))
    return pruned({"schema_version": request["schema_version"], "package_id": ident, "subject": request.get("subject"), "scope": request.get("scope"), "bundles": heads, "payload": payload, "links": links or None})


# How converted requests name their parts. By provider: the schema of its rows, and what one row is.
ADAPTER = {"name": "legacy_payload_adapter", "version": "legacy-adapter.v1"}
BUNDLE_KINDS = {
    "team_weekly_stats": ("team.weekly_stats.v1", "team_week"),
    "player_weekly_stats": ("player.weekly_stats.v1", "player_week"),
    "injuries": ("team.injuries.v1", "team_week_player"),
    "player_lookup": ("player.lookup.v1", "player_match"),
}
NAMED_AS_PROVIDER = ["team_weekly_stats", "player_weekly_stats", "injuries"]


def is_older_request(request: Mapping[str, Any]) -> bool:
    """A subject with one plain id, bundles by stream, or sources given by name alone."""
    subject, bundles = request.get("subject"), request.get("bundles")
    if not isinstance(subject, Mapping) or not isinstance(bundles, list):
        return False
    provenance = request.get("provenance")
    sources = provenance.get("sources") if isinstance(provenance, Mapping) else None
    by_name = isinstance(sources, list) and len(sources) > 0 and all(isinstance(s, str) for s in sources)
    return "entity_id" in subject or by_name or any("stream" in b for b in bundles if isinstance(b, Mapping))


def _positive(value: Any, name: str) -> int:
    if int(value) <= 0:
        raise ValueError(f"{name} must be positive")
    return int(value)


def modern_request(request: Mapping[str, Any]) -> tuple[dict[str, Any], list[str]]:
    """An older request in today's shape with a note, any other as it is. Without a season, or with a season or week that is not positive, it is refused."""
    if not is_older_request(request):
        return dict(request), []
    temporal = request.get("scope", {}).get("temporal", {})
    if temporal.get("season") is None:
        raise ValueError("scope.temporal.season is missing")
    season = _positive(temporal["season"], "season")
    week = None if temporal.get("week") is None else _positive(temporal["week"] or 0, "week")
    kind = str(request["subject"].get("entity_type", "")).strip() or "team"
    ident = str(request["subject"].get("entity_id", "")).strip()
    ids = {"player_id": ident} if kind == "player" else {"team_abbr": ident.upper()}
    filters = pruned({"season": season, "week": week}) | (ids if kind in ("team", "player") else {})

    def bundle(old: Mapping[str, Any]) -> dict[str, Any]:
        asked, stream = (str(old.get(k, "")).strip() for k in ("provider", "stream"))
        provider = "injuries" if stream == "injury_reports" else asked
        if provider == "player_weekly_stats" and kind == "team":
            provider = "team_weekly_stats"
        schema, grain = BUNDLE_KINDS.get(provider, (f"{provider}.v1", "record"))
        name = provider if provider in NAMED_AS_PROVIDER else f"{kind}_{provider}"
        why = f"Converted from legacy bundle provider={asked} stream={stream}"
        return {"name": name, "schema_ref": schema, "record_grain": grain, "provider": provider, "filters": dict(filters), "storage_mode": "inlined", "description": why}

    named = request.get("provenance", {}).get("sources", [])
    sources = [{"name": f"legacy.{s}", "version": ADAPTER["version"]} for s in named if isinstance(s, str)]
    sources += [{"name": str(s["name"]), "version": str(s["version"])} for s in named if isinstance(s, Mapping) and s.get("name") and s.get("version")]
    new = {
        "schema_version": str(request.get("schema_version", "1.0.0")),
        "producer": str(request.get("producer", "legacy-client")),
        "subject": {"entity_type": "player" if kind == "player" else "team", "ids": ids, "display": {"name": ident} if kind == "player" else dict(ids)},
        "scope": {"granularity": "week", "competition": "regular", "temporal": {"season": season, "week": week}},
        "provenance": {"sources": sources or [{"name": "legacy.unknown", "version": ADAPTER["version"]}], "transforms": [dict(ADAPTER)]},
        "bundles": [bundle(b) for b in request["bundles"] if isinstance(b, Mapping)],
        "payload": request.get("payload") or None,
        "links": request.get("links") or None,
    }
    return new, ["an older request was converted; send bundles with providers and filters"]
