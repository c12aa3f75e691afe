"""Queries of family F over documents, pages and customers."""

from __future__ import annotations



from pyspark.sql import functions as F

from fieldlens.functions import text as X
from fieldlens.operators import resolve as R
from fieldlens.plans.registry import query

_TAIL = {
    0: " Follow us on Twitter for the news", 1: " He rushed for 120 yards and two touchdowns", 2: "  The Chiefs signed the rookie. It's the team's 3rd win!", 3: " Senior NFL reporter", 4: " see also: Related Stories",
    5: " Jane Roe covers the beat", 6: ' He said "we will win" on Sunday.', 7: " The Chiefs lost the playoff game by 7 points in 2024.",
}
_CASE = "CASE doc_id % 8 " + " ".join(f"WHEN {k} THEN '" + v.replace("'", "''") + "'" for k, v in _TAIL.items()) + " END"
_FACTS = f"texts AS (SELECT doc_id, translate(text, chr(10), ' ') || {_CASE} AS fact FROM documents)"


def facts(t):
    """Each whole text and one of eight sentences."""
    return t.documents.select("doc_id", F.concat(F.translate("text", "\n", " "), X.lookup((F.col("doc_id") % 8).cast("int"), _TAIL)).alias("fact"))


def _re2(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns).replace("'", "''")


@query("text_normalise", f"WITH {_FACTS} SELECT doc_id, trim(regexp_replace(replace(replace(lower(fact), '''s', ''), '''', ''), '\\s+', ' ', 'g')) AS fact FROM texts")
def text_normalise(t):
    return facts(t).select("doc_id", X.normalised(F.col("fact")).alias("fact"))


@query("fact_filter", f"WITH {_FACTS} SELECT doc_id, length(fact) >= 15 AND NOT regexp_matches(lower(fact), '{_re2(X.NOT_STORY)}') AS valid FROM texts")
def fact_filter(t):
    return facts(t).select("doc_id", X.is_story_fact(F.col("fact")).alias("valid"))


@query("author_fact_cleanup", f"WITH {_FACTS} SELECT doc_id FROM texts WHERE length(fact) >= 15 AND NOT regexp_matches(lower(fact), '{_re2(X.NOT_STORY)}')")
def author_fact_cleanup(t):
    """what stays after bylines are found and removed."""
    f = facts(t)
    bad = f.where(~X.is_story_fact(F.col("fact"))).select("doc_id")
    return f.join(bad, "doc_id", "left_anti").select("doc_id")


@query("paragraph_clean", f"WITH p AS (SELECT doc_id, i, trim(x, ' ' || chr(9) || chr(13)) AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)) SELECT doc_id, count(*) FILTER (length(x) >= 20 AND NOT regexp_matches(lower(x), '{_re2(X.NOT_PARAGRAPH)}')) AS kept FROM p GROUP BY doc_id")
def paragraph_clean(t):
    return t.documents.select("doc_id", F.size(X.clean_paragraphs(F.split("text", "\n"))).cast("long").alias("kept"))


@query("paragraph_dedupe", "WITH p AS (SELECT doc_id, trim(regexp_replace(x, '\\s+', ' ', 'g')) AS x FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents) WHERE x <> '') SELECT doc_id, count(DISTINCT x) AS kept FROM p GROUP BY doc_id")
def paragraph_dedupe(t):
    return t.documents.select("doc_id", F.size(X.distinct_paragraphs(F.split("text", "\n"))).cast("long").alias("kept")).where("kept > 0")


_KIND = """CASE WHEN regexp_matches(s, '"[^"]+"') THEN 'quote' WHEN contains(l, 'chiefs') AND regexp_matches(l, 'signed|waived|traded|activated|injury|lineup|starter|rookie') THEN 'roster'
  WHEN contains(l, 'chiefs') AND regexp_matches(l, 'win|loss|defeat|victory|matchup|playoff|game|tournament|final') THEN 'event'
  WHEN regexp_matches(s, '\\d') AND regexp_matches(l, 'points|yards|touchdowns|rebounds|assists|sacks|interceptions|goals') THEN 'statistic' WHEN regexp_matches(s, '\\d') OR contains(l, 'chiefs') THEN 'factual' ELSE 'generic' END"""
_SENT = f"{_FACTS}, parts AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(regexp_replace(fact, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')) AS s FROM texts), kinds AS (SELECT doc_id, s, lower(s) AS l FROM parts), claims AS (SELECT doc_id, s, l, {_KIND} AS kind FROM kinds)"


def claims(t):
    s = facts(t).select("doc_id", F.posexplode(X.sentences(F.col("fact"))).alias("sentence_index", "sentence"))
    return s.withColumn("kind", X.sentence_kind(F.col("sentence"), ["chiefs"]))


@query("sentence_claims", f"WITH {_SENT} SELECT doc_id, s AS sentence, kind FROM claims WHERE kind <> 'generic'")
def sentence_claims(t):
    return claims(t).where("kind <> 'generic'").select("doc_id", "sentence", "kind")


@query("topic_canonical", "WITH k AS (SELECT *, lower(trim(topic)) AS l FROM topics) SELECT fact_id, seq, " + "CASE " + " ".join(f"WHEN regexp_matches(l, '{'|'.join(p)}') THEN '{k}'" for k, p in X.TOPIC_RULES) + " ELSE replace(l, ' ', '_') END AS canonical FROM k", "topics")
def topic_canonical(t):
    return t.topics.select("fact_id", "seq", X.canonical_topic(F.col("topic")).alias("canonical"))


@query("topic_category", "SELECT fact_id, seq, CASE WHEN topic LIKE 'Quarterback%' THEN 'quarterback performance & analysis' END AS category FROM topics", "topics")
def topic_category(t):
    return t.topics.select("fact_id", "seq", X.topic_category(F.col("topic")).alias("category"))


@query("mention_clean", "SELECT fact_id, seq, trim(mention) AS mention FROM entities", "entities")
def mention_clean(t):
    return t.entities.select("fact_id", "seq", X.clean_mention(F.concat(F.lit("  Player: "), "mention")).alias("mention"))


@query("url_normalise", "SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) || '://' || lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)) || regexp_extract(url, '^[a-z]+://[^/?#]+(.*)$', 1) AS url FROM pages")
def url_normalise(t):
    shouted = F.concat(F.upper(F.regexp_extract("url", "^([a-z]+://[^/]+)", 1)), F.regexp_extract("url", "^[a-z]+://[^/]+(.*)$", 1))
    return t.pages.select("page_id", X.normal_url(shouted).alias("url"))


@query("url_tests", "SELECT page_id, regexp_matches(url, '^https?://[^/?#]+') AS valid, regexp_matches(lower(url), '/nfl(/|$)') AS league, regexp_matches(url, '^[a-z]+://[^/?#]*[^?#]*(/amp$|/amp/)') AS amp, 'light' AS route FROM pages")
def url_tests(t):
    u = F.col("url")
    return t.pages.select("page_id", X.valid_url(u).alias("valid"), X.league_url(u).alias("league"), X.amp_url(u).alias("amp"), X.route(u).alias("route"))


_HOSTS = "CASE page_id % 6 WHEN 0 THEN 'www.espn.com' WHEN 1 THEN 'static.espn.com' WHEN 2 THEN 'a.blogspot.com' WHEN 3 THEN 'wsj.com' WHEN 4 THEN 'WWW.WashingtonPost.com' ELSE 'other.example.org' END"


@query("source_reputation", f"SELECT page_id, {_HOSTS} AS host, CASE page_id % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.9 WHEN 2 THEN 0.2 WHEN 3 THEN 0.95 WHEN 4 THEN 0.95 ELSE 0.5 END::DOUBLE AS score FROM pages")
def source_reputation(t):
    return t.pages.select("page_id", F.expr(_HOSTS).alias("host")).withColumn("score", X.source_score(F.col("host")))


@query("keyword_top3", """WITH w AS (SELECT lang, regexp_replace(x, '[^\\p{L}]', '', 'g') AS w, doc_id, i FROM (SELECT lang, doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS x, generate_subscripts(regexp_split_to_array(lower(text), '\\s+'), 1) AS i FROM documents)),
  c AS (SELECT lang, w, count(*) AS n, min((doc_id, i)) AS f FROM w WHERE length(w) > 3 AND w NOT IN ('the','and','for','with','that','from','this','game','team','season','have','will','their') GROUP BY lang, w),
  r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS r FROM c) SELECT lang, w AS word, n FROM r WHERE r <= 3""")
def keyword_top3(t):
    from pyspark.sql import Window

    bare = t.documents.select("lang", "doc_id", F.posexplode(X.theme_words(F.col("text"))).alias("i", "word"))
    counted = bare.groupBy("lang", "word").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "i")).alias("f"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "f"))
    return counted.withColumn("r", rank).where("r <= 3").select("lang", "word", "n")


@query("name_runs", f"WITH {_FACTS} SELECT doc_id, array_to_string(list_filter(regexp_extract_all(regexp_replace(fact, '[^\\x00-\\x7F]', '0', 'g'), '\\b([A-Z][a-z]+(?:\\s+[A-Z][a-z]+)*)\\b', 1), lambda r: lower(r) NOT IN ('the','and','for','with','from','into','game','season','team','coach','match','league') AND len(regexp_split_to_array(r, '\\s+')) <= 4), '|') AS runs FROM texts")
def name_runs(t):
    return facts(t).select("doc_id", F.array_join(X.name_runs(F.col("fact")), "|").alias("runs"))


_NO_TERMS = "('the','and','for','with','from','that','this','into','der','die','das','und','mit','für','vom','von','dass','nfl','american','football','headshot','photo','image')"


@query("query_terms", rf"""WITH w AS (SELECT doc_id, list_transform(list_filter(regexp_split_to_array('-site:x photo ' || text, '\s+'), lambda x: NOT starts_with(x, '-') AND NOT contains(x, 'site:')), lambda x: lower(regexp_replace(x, '[^a-zA-Z0-9]', '', 'g'))) AS b FROM documents),
  e AS (SELECT doc_id, unnest(b) AS term, generate_subscripts(b, 1) AS pos FROM w), d AS (SELECT doc_id, term, min(pos) AS pos FROM e WHERE length(term) >= 3 AND term NOT IN {_NO_TERMS} GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM d)
  SELECT doc_id, coalesce(terms, '') AS terms FROM documents LEFT JOIN (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS terms FROM r WHERE r <= 8 GROUP BY doc_id) USING (doc_id)""")
def query_terms(t):
    """Terms of whole texts, behind an exclusion and a stop word."""
    return t.documents.select("doc_id", F.array_join(X.query_terms(F.concat(F.lit("-site:x photo "), "text")), " ").alias("terms"))


_EDGES = "[,.!?:;()\\[\\]{}\"''’-]+"


@query("capitalised_entities", rf"""WITH w AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\s+'), lambda x: regexp_replace(x, '^{_EDGES}|{_EDGES}$', '', 'g')), lambda x: x <> '') AS b FROM documents),
  e AS (SELECT doc_id, b, unnest(range(1, len(b) + 1)) AS i FROM w), u AS (SELECT doc_id, i, b[i] AS w, CASE WHEN i > 1 THEN b[i - 1] END AS p FROM e WHERE regexp_matches(b[i], '^\p{{Lu}}')),
  x AS (SELECT doc_id, p || ' ' || w AS e, 2 * i AS pos FROM u UNION ALL SELECT doc_id, w, 2 * i + 1 FROM u), d AS (SELECT doc_id, e, min(pos) AS pos FROM x WHERE length(e) > 2 GROUP BY 1, 2)
  SELECT doc_id, coalesce(entities, '') AS entities FROM documents LEFT JOIN (SELECT doc_id, string_agg(e, '|' ORDER BY pos) AS entities FROM d GROUP BY doc_id) USING (doc_id)""")
def capitalised_entities(t):
    """Of whole texts."""
    return t.documents.select("doc_id", F.array_join(X.capitalised(F.split("text", r"\s+")), "|").alias("entities"))


@query("team_name_lookup", """SELECT 'a' || n_nationkey AS id, n_nationkey AS player_id, 1.0::DOUBLE AS confidence FROM nation UNION ALL SELECT 'b' || n_nationkey, n_nationkey, 1.0 FROM nation WHERE contains(lower(n_name), 'an') UNION ALL SELECT 'c' || n_nationkey, n_nationkey, 1.0 FROM nation
  UNION ALL SELECT 'd' || n_nationkey, n_nationkey, 1.0 FROM nation WHERE contains('team of nation_17', lower(n_name))""")
def team_name_lookup(t):
    """a player's team by a longer name than the table's, by a part of it, by none, and by another team's name; exact player names."""
    k = F.col("n_nationkey")
    players = t.nation.select(k.alias("player_id"), F.array(F.concat(F.lit("Player number "), k.cast("string"))).alias("names"), F.lit("QB").alias("position"), F.lit(None).cast("string").alias("team_abbr"), F.col("n_name").alias("team_name"))
    none = F.lit(None).cast("string")
    asked = lambda kind, team: t.nation.select(F.concat(F.lit(kind), k.cast("string")).alias("id"), F.concat(F.lit("player NUMBER "), k.cast("string")).alias("mention"), none.alias("position"), none.alias("team_abbr"), team.alias("team_name"))
    mentions = asked("a", F.concat(F.lit("The "), F.lower("n_name"), F.lit(" eleven"))).union(asked("b", F.lit("AN"))).union(asked("c", F.lit(""))).union(asked("d", F.lit("Team of NATION_17")))
    return R.resolve_players(mentions, players)


@query("summary_format", f"WITH {_FACTS} SELECT doc_id, trim(regexp_replace(fact, '\\s+', ' ', 'g')) AS summary FROM texts")
def summary_format(t):
    return facts(t).select("doc_id", X.formatted_summary(F.concat(F.lit("Summary:  "), "fact")).alias("summary"))


@query("feed_dates", "SELECT event_id, date_trunc('second', ts) AS at FROM events WHERE event_id % 3 < 3")
def feed_dates(t):
    ts = F.col("ts")
    text = F.when(F.col("event_id") % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 3 == 1, F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss +0000")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", X.feed_date(text).cast("timestamp_ntz").alias("at"))


@query("position_codes", "SELECT player, CASE pos WHEN 'FS' THEN 'S' ELSE pos END AS code FROM rosters", "rosters")
def position_codes(t):
    return t.rosters.select("player", X.position_code(F.concat(F.lit(" "), F.lower("pos"))).alias("code"))


@query("search_labels", "SELECT game_id, away || ' at ' || home || ' | Week ' || wk || ' | ' || season AS label FROM games", "games")
def search_labels(t):
    return t.games.select("game_id", R.game_label(F.col("away"), F.col("home"), F.col("wk"), F.col("season"), F.lit(None).cast("string")).alias("label"))


@query("search_predicates", "SELECT player, player_name FROM rosters WHERE team = 'T07' AND player_name ILIKE '%00001%'", "rosters")
def search_predicates(t):
    return R.filtered(t.rosters, {"team": "T07"}, {"player_name": "00001"}).select("player", "player_name")


@query("injured_player_ids", "SELECT c_custkey AS id, 'C' || min(c_custkey) OVER (PARTITION BY c_name) AS player_id FROM customer")
def injured_player_ids(t):
    players = t.customer.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("player_id"), F.col("c_name").alias("display_name"), F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name"), F.col("c_nationkey").cast("string").alias("team_abbr"))
    hurt = t.customer.select(F.col("c_custkey").alias("id"), F.upper("c_name").alias("player_name"), F.lit("x").alias("team_abbr"))
    return R.injured_ids(hurt, players).select("id", "player_id")


@query("game_resolve", "WITH f AS (SELECT least(home, away) AS low, greatest(home, away) AS high, min(game_id) AS first FROM games GROUP BY ALL) SELECT CAST(game_id AS VARCHAR) AS id, first AS game_id, 0.9::DOUBLE AS confidence FROM games JOIN f ON least(home, away) = low AND greatest(home, away) = high", "games")
def game_resolve(t):
    mentions = t.games.select(F.col("game_id").cast("string").alias("id"), F.concat(F.lit("Week 3: "), "away", F.lit(" at "), "home", F.lit(", 2024")).alias("mention"))
    return R.resolve_games(mentions, t.games, t.teams.select("team_abbr", F.array("team_name", "team_abbr").alias("names")))


@query("fuzzy_topk")
def fuzzy_topk(t):
    return R.search(t.customer, R.player_label(F.col("c_name"), F.col("c_mktsegment")), "Custmer#000000123 BUILDING", seq="c_custkey").select("c_custkey", "label", "score")


@query("entity_resolve", "SELECT 'C' || c_custkey AS id, 'C' || c_custkey AS player_id, CASE WHEN c_custkey % 2 = 0 THEN round(2 * 17 / 35.0::DOUBLE, 6) ELSE 1 END::DOUBLE AS confidence FROM customer")
def entity_resolve(t):
    players = t.rosters.select(F.col("player").alias("player_id"), F.array("player_name").alias("names"), F.col("pos").alias("position"), F.col("team").alias("team_abbr"), F.lit(None).cast("string").alias("team_name"))
    typo = F.when(F.col("seq") % 2 == 0, F.replace(F.col("player_name"), F.lit("o"), F.lit(""))).otherwise(F.col("player_name"))
    mentions = t.rosters.select(F.col("player").alias("id"), typo.alias("mention"), F.lit(None).cast("string").alias("position"), F.lit(None).cast("string").alias("team_abbr"), F.lit(None).cast("string").alias("team_name"))
    return R.resolve_players(mentions, players)


@query("team_resolve", "SELECT team_abbr AS id, team_abbr, 1.0::DOUBLE AS confidence FROM teams", "teams")
def team_resolve(t):
    teams = t.teams.select("team_abbr", F.array("team_name").alias("names"))
    mentions = t.teams.select(F.col("team_abbr").alias("id"), F.concat(F.lower("team_name"), F.lit("'s")).alias("mention"))
    return R.resolve_teams(mentions, teams, aliases={"france": "T06"})



