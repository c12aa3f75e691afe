"""Result files of batch requests (G34, G35): JSON lines to summaries, topics and entities, by VARIANT columns on the JVM.

A line holds custom_id, error and response (status_code, body); the reply's text is in one of three places of the body. Lines that are no JSON, report an error or
another status than 200 are counted and left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.text import ENTITY_TYPES, clean_mention, topic_category
from fieldlens.operators import resolve as R
from fieldlens.operators.dedupe import first_by

NO_TOPICS = "NO_TOPICS_FOUND"

# What marks a fact without entities.
NO_ENTITIES, NO_ENTITIES_TEXT = "NO_ENTITIES_FOUND", "[no entities extracted]"

ENTITIES = "array<struct<entity_type: string, type: string, mention_text: string, name: string, position: string, team_abbr: string, team_name: string, is_primary: boolean, rank: int>>"

# Mentions that are no entity, and what a team mention holds that belongs to another sport or league.
REJECTED_MENTIONS = ["nfl", "league", "football", "sports", "espn", "fox", "cbs", "nbc", "museum", "hall of fame", "super bowl"]
OTHER_TEAMS = [
    "tech", "college", "university", "state", "tigers", "blue jays", "yankees", "red sox", "dodgers", "cubs", "mets", "braves", "lakers", "celtics", "warriors", "heat", "knicks", "bulls",
    "bruins", "penguins", "blackhawks", "rangers", "maple leafs", "barcelona", "madrid", "manchester", "liverpool", "arsenal", "motors", "racing", "nascar",
    "notre dame", "alabama", "ohio state", "michigan", "clemson", "georgia", "lsu", "texas", "oklahoma", "usc", "oregon", "syracuse", "boston college", "miami hurricanes", "florida state",
]


def _at(v: Column | str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _filled(c: Column) -> Column:
    """Null for what counts as nothing."""
    return F.when(~c.isin("", "0", "false", "[]", "{}"), c)


def _reply(r: str) -> Column:
    """The text of a reply: the first choice's content or its first text part, else the body's own text, else its output message."""
    content = _at(r, "$.response.body.choices[0].message.content", "variant")
    parts = _at(r, "$.response.body.choices[0].message.content", "array<struct<type: string, text: string>>")
    outputs = _at(r, "$.response.body.output", "array<struct<type: string, content: array<struct<type: string, text: string>>>>")
    said = F.flatten(F.transform(F.filter(outputs, lambda o: o["type"] == "message"), lambda o: F.coalesce(o["content"], F.expr("cast(array() as array<struct<type: string, text: string>>)"))))
    first = lambda texts, kind: F.get(F.transform(F.filter(texts, lambda p: p["type"] == kind), lambda p: F.coalesce(p["text"], F.lit(""))), F.lit(0))
    return F.coalesce(F.when(_is(content, "STRING"), _at(content, "$")), first(parts, "text"), _at(r, "$.response.body.output_text"), first(said, "output_text"))


def replies(lines: DataFrame) -> DataFrame:
    """lines(value, and seq, their order) as seq, custom_id, llm_model, text and failed; text is null where a line has none.

    What a line holds is generated as one value: filters on it then stay above the parser, where else each of their terms would parse the line again.
    """
    r = lines.select("seq", F.try_parse_json("value").alias("r"))
    bad = F.col("r").isNull() | _filled(_at("r", "$.error")).isNotNull() | (F.coalesce(_at("r", "$.response.status_code", "int"), F.lit(0)) != 200)
    held = F.struct(_at("r", "$.custom_id").alias("custom_id"), F.coalesce(_filled(_at("r", "$.response.body.model")), F.lit("unknown")).alias("llm_model"), F.nullif(_reply("r"), F.lit("")).alias("text"), bad.alias("failed"))
    return r.select("seq", F.explode(F.array(held)).alias("held")).select("seq", "held.*")


def request_id(c: Column) -> Column:
    """A request's id: easy_ARTICLE, hard_ARTICLE_INDEX|topic|scope type|scope id|scope label, or, before that, all joined by underscores."""
    head, rest = F.split(F.regexp_extract(c, r"^([^|]*)", 1), "_"), F.split(F.regexp_extract(c, r"(?s)^[^|]*\|(.*)$", 1), r"\|")
    older = F.split(c, "_", 6)
    part = lambda a, i: F.get(a, F.lit(i))
    of = lambda kind, article, index, topic, *scope: F.struct(F.lit(kind).alias("kind"), article.alias("article_id"), index.alias("index"), topic.alias("topic"), *(s.alias(n) for s, n in zip(scope, ("scope_type", "scope_id", "scope_label"))))
    none = F.lit(None).cast("string")
    easy = of("easy", F.substring(c, 6, 1 << 30), none, none, none, none, none)
    hard = F.when(F.size(head) >= 3, of("hard", part(head, 1), part(head, 2), part(rest, 0), part(rest, 1), part(rest, 2), F.when(F.size(rest) > 3, part(rest, 3)).otherwise(part(rest, 2))))
    old = F.when(F.size(older) >= 5, of("hard", part(older, 1), part(older, 2), part(older, 3), part(older, 4), part(older, 5), part(older, 5)))
    return F.when(c.startswith("easy_"), easy).when(c.startswith("hard_"), F.when(c.contains("|"), hard).otherwise(old))


def summary_text(text: Column) -> Column:
    """The summary in a reply: of a JSON object, of one inside other text by pattern, or of the outermost braces."""
    whole = F.try_parse_json(text)
    inner = F.try_parse_json(F.regexp_extract(text, r"(?s)(\{.*\})", 1))
    found = F.nullif(F.regexp_extract(text, r'(?s)\{[^{}]*"summary"\s*:\s*"([^"]+)"[^{}]*\}', 1), F.lit(""))
    return F.nullif(F.trim(F.when(whole.isNotNull(), _at(whole, "$.summary")).otherwise(F.coalesce(found, _at(inner, "$.summary")))), F.lit(""))


def garbled(topic: Column, kind: Column, ident: Column) -> Column:
    """Whether a topic summary's id was cut in the wrong places."""
    odd = F.coalesce(ident.rlike("found_player|found_team|found_none|^&_|_&_|UNRESOLVED:"), F.lit(False))
    return F.coalesce(kind.isin("topics", "&"), F.lit(False)) | odd | F.coalesce(topic == "no", F.lit(False))


def summary_batch(lines: DataFrame, held: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The summaries of articles, those of topics, and a report of one row, from result lines(value, seq).

    Articles in held(article_id, kind) are skipped. Of an article's own summaries the last line counts; topic
    summaries all count, but for those whose ids are garbled.
    """
    said = replies(lines)
    parsed = said.where("not failed and text is not null").withColumn("summary_text", summary_text(F.col("text"))).withColumn("of", request_id(F.col("custom_id")))
    good = parsed.where("summary_text is not null and of is not null").select("seq", "llm_model", "summary_text", "of.*")
    done = (good.select("article_id", "kind").limit(0) if held is None else held).select("article_id", "kind").distinct().withColumn("__held", F.lit(True))
    marked = good.join(done, ["article_id", "kind"], "left")
    new = marked.where("__held is null")
    easy = first_by(new.where("kind = 'easy'"), ["article_id"], F.desc("seq")).select("article_id", "summary_text", "llm_model")
    topics = new.where("kind = 'hard'").withColumn("garbled", garbled(F.col("topic"), F.col("scope_type"), F.col("scope_id")))
    real = lambda c: F.nullif(c, F.lit("none"))
    label = F.coalesce(F.nullif("scope_label", F.lit("")), "scope_id")
    hard = topics.where("not garbled").select(
        "article_id", F.col("topic").alias("primary_topic"), F.when(F.col("scope_type") == "team", F.col("scope_id")).alias("primary_team"),
        real(F.col("scope_type")).alias("primary_scope_type"), real(F.col("scope_id")).alias("primary_scope_id"), real(label).alias("primary_scope_label"), "summary_text", "llm_model", "seq",
    )
    counts = marked.agg(F.countDistinct("article_id").alias("articles"), F.count_distinct(F.when(F.col("__held"), F.struct("article_id", "kind"))).alias("skipped_existing"))
    lost = topics.agg(F.count_if("garbled").alias("garbled"))
    failed = said.agg(F.count_if("failed").alias("errors"))
    without = parsed.agg(F.count_if(F.col("summary_text").isNull()).alias("without_data"))
    return easy, hard, counts.crossJoin(lost).crossJoin(failed).crossJoin(without)  # one row each


def _rows(said: DataFrame) -> DataFrame:
    """Replies as rows of fact_id, llm_model and row (VARIANT): a list, one inside other text, or the results or data of an object."""
    whole = F.try_parse_json("text")
    payload = said.where("not failed and text is not null").withColumn("p", F.coalesce(whole, F.try_parse_json(F.regexp_extract("text", r"(?s)(\[.*\])", 1))))
    listed = lambda path: _at("p", path, "array<variant>")
    some = lambda a: F.when(F.size(a) > 0, a)
    each = payload.select("seq", "llm_model", F.explode(F.coalesce(listed("$"), some(listed("$.results")), some(listed("$.data")))).alias("row"))
    return each.withColumn("fact_id", F.nullif(_at("row", "$.news_fact_id"), F.lit(""))).where("fact_id is not null")  # null for what is no object


def _asked(rows: DataFrame, facts: DataFrame, held: DataFrame | None) -> DataFrame:
    ids = lambda df: df.select(F.col("fact_id").cast("string").alias("fact_id")).distinct()
    marked = rows.join(ids(facts).withColumn("__there", F.lit(True)), "fact_id", "left").withColumn("__there", F.coalesce("__there", F.lit(False)))
    if held is None:
        return marked.withColumn("__held", F.lit(False))
    return marked.join(ids(held).withColumn("__held", F.lit(True)), "fact_id", "left").withColumn("__held", F.coalesce("__held", F.lit(False)))


def _report(said: DataFrame, marked: DataFrame, empty: DataFrame) -> DataFrame:
    report = marked.agg(F.count("*").alias("facts_in_output"), F.count_if(~F.col("__there")).alias("skipped_missing"), F.count_if(F.col("__there") & F.col("__held")).alias("skipped_existing"))
    return report.crossJoin(said.agg(F.count_if("failed").alias("errors"))).crossJoin(empty.agg(F.count("*").alias("without_data")))  # one row each


def topic_batch(lines: DataFrame, facts: DataFrame, held: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The topics of a batch's result lines(value, seq), ready to be written, and a report of one row.

    Facts that do not exist in facts(fact_id) are counted as missing; those in held(fact_id) as existing, if they are to be skipped. A topic is an object, a text, or
    the row's only one; it passes the list of labels, of a fact's equal ones the most certain stays (then the best rank, then the first), and a fact without any gets
    a marker, so that it is not asked for again.
    """
    said = replies(lines)
    marked = _asked(_rows(said), facts, held)
    raw = _at("row", "$.topics", "variant")
    one = F.when(_is(raw, "STRING"), F.array(raw)).when(raw.isNull(), F.array(_at("row", "$.topic", "variant")))
    new = marked.where("__there and not __held").withColumn("topics", F.coalesce(_at("row", "$.topics", "array<variant>"), one))
    each = new.select("fact_id", "llm_model", "seq", F.posexplode_outer("topics").alias("pos", "t"))
    object_ = _is(F.col("t"), "OBJECT")
    named = F.when(object_, F.coalesce(_filled(_at("t", "$.topic")), _at("t", "$.text"))).otherwise(_at("t", "$"))
    found = each.select("fact_id", "llm_model", "seq", "pos", topic_category(F.trim(named)).alias("topic"), F.when(object_, _at("t", "$.confidence", "double")).alias("confidence"), F.coalesce(F.when(object_, _at("t", "$.rank", "int")), F.col("pos") + 1).alias("rank"))
    best = first_by(found.where("topic is not null"), ["fact_id", "topic"], F.desc(F.coalesce("confidence", F.lit(0.0))), F.coalesce("rank", F.lit(1 << 30)), F.col("seq"), F.col("pos"))
    empty = first_by(found.join(best.select("fact_id").distinct(), "fact_id", "left_anti"), ["fact_id"], F.col("seq"), F.col("pos")).select("fact_id", "llm_model", F.lit(NO_TOPICS).alias("topic"), F.lit(1.0).alias("confidence"), F.lit(1).alias("rank"))
    return best.select("fact_id", "llm_model", "topic", "confidence", "rank").unionByName(empty), _report(said, marked, empty)


def entity_batch(lines: DataFrame, facts: DataFrame, players: DataFrame, teams: DataFrame, games: DataFrame, held: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The entities of a batch's result lines(value, seq), resolved and ready to be written, and a report of one row.

    Mentions lose their type word; generic ones, and teams of other sports, are left out. Players, teams and games resolve as in ``resolve``; a player that is not found
    keeps an UNRESOLVED id without confidence, a team or game that is not found is dropped. A fact without any entity gets a marker.
    """
    said = replies(lines)
    marked = _asked(_rows(said), facts, held)
    entities = F.when(F.col("__there") & ~F.col("__held"), _at("row", "$.entities", ENTITIES))  # read once, not field by field; null for what is no object
    each = marked.select("fact_id", "llm_model", "seq", "__there", "__held", F.posexplode_outer(entities).alias("pos", "e"))
    kind = F.lower(F.coalesce(_filled(F.col("e.entity_type")), "e.type"))
    mention = clean_mention(F.coalesce(_filled(F.col("e.mention_text")), "e.name"))
    own = {n: F.col(f"e.{n}") for n in ("position", "team_abbr", "team_name", "rank")} | {"is_primary": F.coalesce("e.is_primary", F.lit(False))}
    found = each.select("fact_id", "llm_model", "seq", "pos", "__there", "__held", kind.alias("entity_type"), mention.alias("mention"), *(c.alias(n) for n, c in own.items()))
    low, player = F.lower("mention"), F.col("entity_type") == "player"
    foreign = (F.col("entity_type") == "team") & F.coalesce(F.exists(F.array(*map(F.lit, OTHER_TEAMS)), lambda p: F.contains(low, p)), F.lit(False))
    asked = F.col("entity_type").isin(*ENTITY_TYPES) & F.col("mention").isNotNull() & ~low.isin(*REJECTED_MENTIONS) & ~foreign
    told = ["position", "team_abbr", "team_name"]
    found = found.withColumns({n: F.when(player, F.col(n)) for n in told}).withColumn("id", F.when(asked, F.to_json(F.struct("entity_type", "mention", *told))))
    found = R.kept(found)  # read by three resolvers and twice more; a persisted plan is not found again once it has been joined with itself
    # What a mention means depends on its id alone: each id is resolved once, however many facts have it.
    once = R.kept(found.where("id is not null").select("id", "entity_type", "mention", *told).distinct())
    of = lambda k: once.where(F.col("entity_type") == k)
    met = R.resolve_players(of("player").select("id", "mention", *told), players).select("id", F.col("player_id").alias("entity_id"), "confidence")
    met = met.unionByName(R.resolve_teams(of("team").select("id", "mention"), teams).select("id", F.col("team_abbr").alias("entity_id"), "confidence"))
    met = met.unionByName(R.resolve_games(of("game").select("id", "mention"), games, teams).select("id", F.col("game_id").cast("string").alias("entity_id"), "confidence"))
    met = F.broadcast(met) if once.count() <= R.DIRECTORY else met  # a row for each id at most; most facts share few ids or have none
    lost = F.when(player & F.col("id").isNotNull(), F.concat(F.lit("UNRESOLVED:"), F.replace(F.trim(low), F.lit(" "), F.lit("_"))))
    both = found.where("__there and not __held").join(met, "id", "left").withColumn("entity_id", F.coalesce("entity_id", lost)).withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    fact = Window.partitionBy("fact_id")
    same = Window.partitionBy("fact_id", "entity_type", "entity_id").orderBy(F.desc("is_primary"), F.desc("confidence"), F.desc("seq"), F.desc("pos"))
    ranked = both.withColumn("__n", F.count("entity_id").over(fact)).withColumn("__first", F.row_number().over(fact.orderBy("seq", "pos"))).withColumn("__r", F.row_number().over(same))
    kept = ranked.where("entity_id is not null and __r = 1 or __n = 0 and __first = 1")  # the latter: facts without any
    named = F.col("entity_id").isNotNull()
    marker = lambda n, value: F.when(named, F.col(n)).otherwise(F.lit(value)).alias(n)
    out = kept.select(
        "fact_id", "llm_model", marker("entity_type", "none"), F.coalesce("entity_id", F.lit(NO_ENTITIES)).alias("entity_id"), marker("mention", NO_ENTITIES_TEXT), marker("confidence", 0.0), marker("is_primary", False),
        *(F.when(named, F.col(n)).alias(n) for n in ("rank", *told)),
    )
    none = both.groupBy("fact_id").agg(F.count("entity_id").alias("n")).where("n = 0")
    return out, _report(said, found.where("coalesce(pos, 0) = 0"), none)


def completed_links(facts: DataFrame, topics: DataFrame, entities: DataFrame, processed: DataFrame) -> DataFrame:
    """The links of processed(fact_id) whose facts all have topics and entities now, markers included."""
    touched = facts.join(processed.select("fact_id").distinct(), "fact_id", "left_semi").select("url_id").distinct()
    has = lambda df, name: df.select("fact_id").distinct().withColumn(name, F.lit(True))
    each = facts.join(touched, "url_id", "left_semi").join(has(topics, "t"), "fact_id", "left").join(has(entities, "e"), "fact_id", "left")
    return each.groupBy("url_id").agg(F.every(F.col("t").isNotNull() & F.col("e").isNotNull()).alias("complete")).where("complete").select("url_id")
