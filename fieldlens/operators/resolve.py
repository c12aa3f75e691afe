"""Entity resolution and fuzzy search.

Exact and alias matches are equi-joins, and so are names one letter away where there are many mentions. Only mentions left over are scored, by an
Arrow-batched UDF against a directory of names. A directory within ``DIRECTORY`` names goes to every task once; of a larger one, mentions within
``FEW_MENTIONS`` go to every task, and more of them meet every block of that size. The joins of players and of
similar names do not leave it to Spark what to broadcast: a side counted within ``DIRECTORY`` is, and others are shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions import fuzzy
from fieldlens.functions.text import lookup, normalised, position_code
from fieldlens.session import shared_dir

THRESHOLD = 0.6
CUTOFF = 60
DIRECTORY = 100_000
FEW_MENTIONS = 1_000
GAME_CONFIDENCE = 0.9

# What a team is called, lower-cased.
TEAM_ALIASES = {
    "arizona cardinals": "ARI", "arizona": "ARI", "cardinals": "ARI",
    "atlanta falcons": "ATL", "atlanta": "ATL", "falcons": "ATL",
    "baltimore ravens": "BAL", "ravens": "BAL", "baltimore": "BAL",
    "buffalo bills": "BUF", "bills": "BUF", "buffalo": "BUF",
    "carolina panthers": "CAR", "carolina": "CAR", "panthers": "CAR",
    "chicago bears": "CHI", "bears": "CHI", "chicago": "CHI",
    "cincinnati bengals": "CIN", "bengals": "CIN", "cincinnati": "CIN",
    "cleveland browns": "CLE", "browns": "CLE", "cleveland": "CLE",
    "dallas cowboys": "DAL", "dallas": "DAL", "cowboys": "DAL", "america's team": "DAL",
    "denver broncos": "DEN", "denver": "DEN", "broncos": "DEN",
    "detroit lions": "DET", "lions": "DET", "detroit": "DET",
    "green bay packers": "GB", "pack": "GB", "packers": "GB", "green bay": "GB",
    "houston texans": "HOU", "texans": "HOU", "houston": "HOU",
    "indianapolis colts": "IND", "colts": "IND", "indianapolis": "IND",
    "jacksonville jaguars": "JAX", "jags": "JAX", "jaguars": "JAX", "jacksonville": "JAX",
    "kansas city chiefs": "KC", "chiefs": "KC", "kansas city": "KC",
    "los angeles rams": "LA", "rams": "LA", "los angeles": "LA",
    "los angeles chargers": "LAC", "bolts": "LAC", "chargers": "LAC",
    "las vegas raiders": "LV", "raiders": "LV", "las vegas": "LV",
    "miami dolphins": "MIA", "fins": "MIA", "miami": "MIA", "dolphins": "MIA",
    "minnesota vikings": "MIN", "vikings": "MIN", "minnesota": "MIN",
    "new england patriots": "NE", "pats": "NE", "patriots": "NE", "new england": "NE",
    "new orleans saints": "NO", "saints": "NO", "new orleans": "NO",
    "new york giants": "NYG", "g-men": "NYG", "giants": "NYG", "new york": "NYG", "big blue": "NYG",
    "new york jets": "NYJ", "jets": "NYJ",
    "philadelphia eagles": "PHI", "birds": "PHI", "eagles": "PHI", "philadelphia": "PHI",
    "pittsburgh steelers": "PIT", "steelers": "PIT", "pittsburgh": "PIT",
    "seattle seahawks": "SEA", "hawks": "SEA", "seattle": "SEA", "seahawks": "SEA",
    "san francisco 49ers": "SF", "49ers": "SF", "niners": "SF", "san francisco": "SF",
    "tampa bay buccaneers": "TB", "bucs": "TB", "tampa": "TB", "tampa bay": "TB", "buccaneers": "TB",
    "tennessee titans": "TEN", "titans": "TEN", "tennessee": "TEN",
    "washington commanders": "WAS", "redskins": "WAS", "washington": "WAS", "commanders": "WAS",
}


class Directory:
    """Names with their letter counts. Two strings share at most the smaller count of each letter, which bounds their score,
    so names are scored from the highest bound down until no bound reaches the best score. Counts are kept by letter, so that a
    mention reads those of its own letters alone.
    """

    LETTERS, FIRST = 64, 64

    def __init__(self, names: list[str]):
        self.names = names
        self.words = [fuzzy.sorted_words(n) for n in names]
        self.sizes = np.array([len(w) for w in self.words], float)
        self.counts = np.ascontiguousarray(np.vstack([self._count(w) for w in self.words]).T) if names else np.zeros((self.LETTERS, 0), np.int16)

    def _count(self, words: str) -> np.ndarray:
        return np.bincount(np.frombuffer(words.encode("utf-32-le"), np.uint32) % self.LETTERS, minlength=self.LETTERS).astype(np.int16)

    def _likeliest(self, bound: np.ndarray, cutoff: float) -> Iterator[int]:
        """Names from the highest bound down: a few first, as these mostly do."""
        if len(bound) > self.FIRST:
            first = np.argpartition(-bound, self.FIRST)[: self.FIRST]
            first = first[np.argsort(-bound[first], kind="stable")]
            edge = bound[first[-1]]
            yield from (i for i in first if bound[i] > edge)
            bound = np.where(bound > edge, -1.0, bound)
        likely = np.flatnonzero(bound >= cutoff)
        yield from likely[np.argsort(-bound[likely], kind="stable")]

    def best(self, mention: str, cutoff: float) -> tuple[str, float] | None:
        own = fuzzy.sorted_words(mention)
        if not self.names or not own:
            return None
        letters = self._count(own)
        shared = np.zeros(len(self.names), np.int32)
        for c in np.flatnonzero(letters):
            shared += np.minimum(self.counts[c], letters[c])
        bound = 200 * shared / (self.sizes + len(own))
        top, name = cutoff, None
        for i in self._likeliest(bound, cutoff):
            if bound[i] < top:
                break
            got = fuzzy.ratio(own, self.words[i])
            if got > top or got == top and (name is None or self.names[i] < name):
                top, name = got, self.names[i]
        return None if name is None else (name, top)


def kept(df: DataFrame) -> DataFrame:
    """A table that is read several times, through the shared folder."""
    path = f"{shared_dir(df.sparkSession)}/names-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _sized(side: DataFrame, rows: int) -> DataFrame:
    """One side of a join, by its number of rows: broadcast within ``DIRECTORY``, else both sides are shuffled.

    Spark would judge by the sizes of compressed files, which are a small part of the hash tables that the driver builds.
    """
    return F.broadcast(side) if rows <= DIRECTORY else side.hint("merge")


def _joined(left: DataFrame, n: int, right: DataFrame, total: int, on: str | Column) -> DataFrame:
    """An inner join of two counted sides, n and total rows at most."""
    return left.join(_sized(right, total), on) if total <= n else _sized(left, n).join(right, on)


def _by_one_letter(wanted: DataFrame, n_wanted: int, listed: DataFrame, total: int, cutoff: float) -> DataFrame:
    """The best name of each mention (of three letters or more) with a name that is equal, or has one letter more or less, by joins on words with a letter left out.

    Of n letters: equal words score 100, a name with a letter more 200n / (2n + 1), one with a letter less 200(n - 1) / (2n - 1), and any other
    name at most 200n / (2n + 2), which is less than these from three letters on.
    """

    @F.pandas_udf("string")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(fuzzy.sorted_words)

    shorter = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("words")), lambda i: F.concat(F.substring("words", F.lit(1), i - 1), F.substring("words", i + 1, F.length("words")))))
    asked = wanted.select("mention", words("mention").alias("words")).where(F.length("words") > 2)
    named = listed.select("name", words("name").alias("words")).where("words <> ''")
    n = F.length("w")
    whole, names = asked.select("mention", F.col("words").alias("w"), F.col("words").alias("k")), named.select("name", F.col("words").alias("k"))
    steps = [
        (_joined(whole, n_wanted, names, total, "k"), F.lit(100.0)),
        (_sized(whole, n_wanted).join(named.select("name", F.explode(shorter).alias("k")), "k"), F.lit(200.0) * n / (2 * n + 1)),
        (asked.select("mention", F.col("words").alias("w"), F.explode(shorter).alias("k")).join(_sized(names, total), "k"), F.lit(200.0) * (n - 1) / (2 * n - 1)),
    ]
    found = [met.select("mention", "name", score.alias("score")) for met, score in steps]
    met = found[0].union(found[1]).union(found[2]).where(F.col("score") >= cutoff)
    return met.groupBy("mention").agg(F.min(F.struct((-F.col("score")).alias("less"), "name")).alias("best")).select("mention", F.col("best.name").alias("name"), (-F.col("best.less")).alias("score"))


def _best_found(found: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("mention").orderBy(F.desc("score"), "name"))
    return found.withColumn("r", rank).where("r = 1").drop("r")


def _by_few_mentions(wanted: DataFrame, listed: DataFrame, cutoff: float) -> DataFrame:
    """All mentions go to every task, and names are not moved; each task gives its best for each mention."""
    asked = wanted.sparkSession.sparkContext.broadcast([r["mention"] for r in wanted.collect()])  # FEW_MENTIONS at most

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[str, tuple[str, float]] = {}
        for batch in batches:
            index = Directory(sorted(batch["name"]))
            for m in asked.value:
                got = index.best(m, best[m][1] if m in best else cutoff)
                if got and (m not in best or (-got[1], got[0]) < (-best[m][1], best[m][0])):
                    best[m] = got
        yield pd.DataFrame([(m, *got) for m, got in best.items()], columns=["mention", "name", "score"])

    spread = listed.repartition(wanted.sparkSession.sparkContext.defaultParallelism)
    return _best_found(spread.mapInPandas(score, "mention string, name string, score double"))


def fuzzy_best(mentions: DataFrame, names: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """for each distinct mention, the name of the best token-sort score at or above the threshold (ties: the first name).

    Of many mentions, those at most one letter from a name are settled by joins, which grow with the tables; only the rest are scored against all names.
    """
    cutoff = threshold * 100
    wanted = kept(mentions.select("mention").where("mention is not null").distinct())
    listed = kept(names.select("name").where("name is not null").distinct())
    total, n = listed.count(), wanted.count()
    if n <= FEW_MENTIONS:
        return _scored(wanted, n, listed, total, cutoff)
    near = kept(_by_one_letter(wanted, n, listed, total, cutoff))
    rest = kept(wanted.join(_sized(near, n), "mention", "left_anti"))
    n = rest.count()
    return near.unionByName(_scored(rest, n, listed, total, cutoff)) if n else near


def _scored(wanted: DataFrame, n: int, listed: DataFrame, total: int, cutoff: float) -> DataFrame:
    """``fuzzy_best`` by scores against all names."""
    parallel = wanted.sparkSession.sparkContext.defaultParallelism
    if total <= DIRECTORY:
        directory = sorted(r["name"] for r in listed.collect())  # bounded by DIRECTORY
        shared = wanted.sparkSession.sparkContext.broadcast(directory)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            index = Directory(shared.value)
            for batch in batches:
                found = ((m, *got) for m in batch["mention"] if (got := index.best(m, cutoff)))
                yield pd.DataFrame(found, columns=["mention", "name", "score"])

        return wanted.repartition(parallel, "mention").mapInPandas(score, "mention string, name string, score double")
    if n <= FEW_MENTIONS:
        return _by_few_mentions(wanted, listed, cutoff)
    # Blocks of names by blocks of mentions: each cell holds one block of names, and gives the best of its own.
    wide = -(-n // max(1, DIRECTORY))
    tall = max(-(-total // max(1, DIRECTORY // 2)), -(-parallel // wide))
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = wanted.select("mention", dealt("mention", wide).alias("column")).withColumn("row", every(tall))
    right = listed.select("name", dealt("name", tall).alias("row")).withColumn("column", every(wide))

    def cell(asked: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        index = Directory(sorted(block["name"])) if len(asked) else None
        found = [(m, *got) for m in asked["mention"] if index and (got := index.best(m, cutoff))]
        return pd.DataFrame(found, columns=["mention", "name", "score"])

    return _best_found(left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInPandas(cell, "mention string, name string, score double"))


def resolve_players(mentions: DataFrame, players: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """mentions(id, mention, position, team_abbr, team_name) to players(player_id, names array, position, team_abbr, team_name).

    An exact name beats a similar one; a position or team that is given must agree; the most certain, then first, player wins.
    """
    told = [F.col(c).cast("string").alias(c) for c in ("position", "team_abbr", "team_name")]
    asked = kept(mentions.select("id", normalised(F.col("mention")).alias("mention"), *told))  # read five times, as is flat
    flat = kept(players.select("player_id", F.explode("names").alias("name")).withColumn("name", normalised(F.col("name"))).where("name <> ''").distinct())
    n, total = asked.count(), flat.count()
    exact = _joined(asked, n, flat, total, F.col("mention") == F.col("name")).select("id", "player_id", F.lit(1.0).alias("confidence"))
    rest = asked.join(_sized(exact.select("id").distinct(), n), "id", "left_anti")
    near = _joined(rest.join(_sized(fuzzy_best(rest, flat, threshold), n), "mention"), n, flat, total, "name").select("id", "player_id", (F.col("score") / 100).alias("confidence"))
    found = exact.union(near).join(_sized(players.drop("names"), players.count()), "player_id")
    found = found.join(_sized(asked.select("id", F.col("position").alias("p"), F.col("team_abbr").alias("t"), F.lower("team_name").alias("tn")), n), "id")  # last, as the window needs the ids together too
    agree = lambda want, have: F.coalesce(want, F.lit("")).isin("") | (want == have)
    by_name = F.coalesce("tn", F.lit("")).isin("") | F.contains(F.lower("team_name"), F.col("tn")) | F.contains(F.col("tn"), F.lower("team_name"))
    fits = found.where(agree(position_code(F.col("p")), position_code(F.col("position"))) & agree(F.upper("t"), F.upper("team_abbr")) & F.coalesce(by_name, F.lit(True)))
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("confidence"), "player_id"))
    return fits.withColumn("r", best).where("r = 1").select("id", "player_id", F.round("confidence", 6).alias("confidence"))


def resolve_teams(mentions: DataFrame, teams: DataFrame, threshold: float = THRESHOLD, aliases: dict[str, str] | None = None) -> DataFrame:
    """mentions(id, mention) to teams(team_abbr, names array): by alias, by exact name, by similar name."""
    asked = mentions.withColumn("mention", normalised(F.col("mention")))
    flat = teams.select("team_abbr", F.explode("names").alias("name")).withColumn("name", normalised(F.col("name"))).where("name <> ''")
    flat = flat.groupBy("name").agg(F.min("team_abbr").alias("team_abbr"))
    alias = lookup(F.col("mention"), aliases if aliases is not None else TEAM_ALIASES)
    first = asked.join(flat.select(F.col("name").alias("mention"), F.col("team_abbr").alias("exact")), "mention", "left").withColumn("found", F.coalesce(alias, F.col("exact")))
    open_ = first.where("found is null")
    near = open_.select("id", "mention").join(fuzzy_best(open_, flat, threshold), "mention").join(flat, "name").select("id", F.col("team_abbr").alias("near"), F.round(F.col("score") / 100, 6).alias("s"))
    out = first.select("id", "found").join(near, "id", "left")
    return out.select("id", F.coalesce("found", "near").alias("team_abbr"), F.when(F.col("found").isNotNull(), 1.0).otherwise(F.col("s")).alias("confidence")).where("team_abbr is not null")


# Words of a game mention that name no team.
GAME_STOP_WORDS = ["vs", "at", "versus", "v", "game", "matchup", "week"]


def game_words(c: Column) -> Column:
    """words before the first comma that may name a team."""
    words = F.split(F.trim(F.get(F.split(c, ","), F.lit(0))), r"\s+")
    return F.filter(words, lambda w: ~F.lower(w).isin(*GAME_STOP_WORDS) & ~w.rlike(r"^\d+$") & (F.length(w) >= 2))


def resolve_games(mentions: DataFrame, games: DataFrame, teams: DataFrame) -> DataFrame:
    """mentions(id, mention) whose first two teams play each other, home or away; the first game of several."""
    words = mentions.select("id", F.posexplode(game_words(F.col("mention"))).alias("pos", "mention"))
    keyed = words.withColumn("key", F.concat_ws("#", "id", "pos"))
    named = resolve_teams(keyed.select(F.col("key").alias("id"), "mention"), teams)
    both = keyed.join(named.withColumnRenamed("id", "key"), "key").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "team_abbr"))).alias("t")).where(F.size("t") >= 2)
    pair = both.select("id", F.get("t", F.lit(0))["team_abbr"].alias("x"), F.get("t", F.lit(1))["team_abbr"].alias("y"))
    # Two teams may meet often: the first of their games is found before mentions join.
    first = games.groupBy(F.least("home", "away").alias("low"), F.greatest("home", "away").alias("high")).agg(F.min("game_id").alias("game_id"))
    met = pair.join(first, (F.least("x", "y") == F.col("low")) & (F.greatest("x", "y") == F.col("high")))
    return met.groupBy("id").agg(F.min("game_id").alias("game_id")).withColumn("confidence", F.lit(GAME_CONFIDENCE))


def search(records: DataFrame, label: Column, query: str, limit: int = 10, cutoff: float = CUTOFF, seq: str | None = None) -> DataFrame:
    """F8: the records whose label is most like a query; of equal labels the last record counts."""

    @F.pandas_udf("double")
    def like(names: pd.Series) -> pd.Series:
        return pd.Series([fuzzy.weighted(query, n) for n in names])

    rows = records.withColumn("label", label).where("label is not null and label <> ''")
    if seq:
        rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy(F.desc(seq)))).where("r = 1").drop("r")
    return rows.withColumn("score", F.round(like("label"), 4)).where(F.col("score") >= cutoff).orderBy(F.desc("score"), "label").limit(limit)


def player_label(name: Column, team: Column) -> Column:
    """name, and team in brackets where there is one."""
    return F.when(team.isNotNull() & (team != ""), F.concat(name, F.lit(" ("), team, F.lit(")"))).otherwise(name)


def game_label(away: Column, home: Column, week: Column, season: Column, weekday: Column) -> Column:
    """away at home, week, season and weekday."""
    return F.concat_ws(" | ", F.concat(away, F.lit(" at "), home), F.concat(F.lit("Week "), week.cast("string")), season.cast("string"), weekday)


def filtered(df: DataFrame, equal: dict | None = None, contains: dict | None = None) -> DataFrame:
    """equality, and text held in any case (% and _ match as in SQL)."""
    for name, value in (equal or {}).items():
        df = df.where(F.col(name) == value)
    for name, value in (contains or {}).items():
        df = df.where(F.col(name).ilike(f"%{value}%"))
    return df


def injured_ids(injuries: DataFrame, players: DataFrame) -> DataFrame:
    """F32: injuries(id, player_name, team_abbr) to players(player_id, display_name, first_name, last_name, team_abbr) by folded name.

    A player of the same team wins, else the only one of the name, else the smallest id.
    """
    fold = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    forms = F.array(F.col("display_name"), F.concat_ws(" ", "first_name", "last_name"), F.concat_ws(", ", "last_name", "first_name"))
    keys = players.select("player_id", "team_abbr", F.explode(F.array_distinct(F.transform(forms, fold))).alias("k")).where("k <> ''").distinct()
    swapped = F.when(F.contains(F.col("player_name"), F.lit(",")), F.concat_ws(" ", F.trim(F.get(F.split("player_name", ","), F.lit(1))), F.trim(F.get(F.split("player_name", ","), F.lit(0))))).otherwise(F.col("player_name"))
    asked = injuries.select("id", F.col("team_abbr").alias("t"), fold(swapped).alias("k"))
    order = [F.desc(F.coalesce((F.col("t") == F.col("team_abbr")).cast("int"), F.lit(0))), F.col("player_id")]
    met = asked.join(keys, "k").withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy(*order))).where("r = 1")
    return injuries.join(met.select("id", F.col("player_id")), "id", "left")
