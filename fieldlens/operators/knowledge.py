"""Facts, topics, entities and their completion (F17, F18, G10-G24, G36; batch results are in batches)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.text import canonical_topic, entity_key
from fieldlens.operators.dedupe import first_by


def best_topics(topics: DataFrame) -> DataFrame:
    """one row for each fact and canonical topic: most certain, then best rank, then first."""
    keyed = topics.withColumn("canonical", canonical_topic(F.col("topic")))
    return first_by(keyed, ["fact_id", "canonical"], F.desc(F.coalesce("confidence", F.lit(0.0))), F.coalesce("rnk", F.lit(1 << 30)), F.col("seq"))


def best_entities(entities: DataFrame) -> DataFrame:
    """one row for each fact, type and entity: primary ones first, then the most certain, the later of equals."""
    keyed = entities.withColumn("key", entity_key(F.col("entity_id"), F.lit(None).cast("string"), F.col("mention")))
    return first_by(keyed, ["fact_id", "entity_type", "key"], F.desc("is_primary"), F.desc(F.coalesce("confidence", F.lit(0.0))), F.desc("seq"))


def _rank(c: str = "rnk") -> Column:
    return F.when(F.coalesce(F.col(c), F.lit(0)) == 0, 99).otherwise(F.col(c))


def primary_topic(topics: DataFrame) -> DataFrame:
    """The primary topic, else the best ranked; missing and zero ranks come last."""
    order = F.struct(F.when(F.col("is_primary"), 0).otherwise(1), _rank(), "seq")
    return topics.groupBy("fact_id").agg(F.min_by("topic", order).alias("topic"))


def primary_scope(entities: DataFrame) -> DataFrame:
    """A team, else a player, else a game; within a type as for topics."""
    kind = F.when(F.col("entity_type") == "team", 0).when(F.col("entity_type") == "player", 1).otherwise(2)
    best = entities.groupBy("fact_id").agg(F.min_by(F.struct("entity_type", "entity_id", "mention", "team_abbr"), F.struct(kind, F.when(F.col("is_primary"), 0).otherwise(1), _rank(), "seq")).alias("e"))
    team = F.col("e.entity_type") == "team"
    ident = F.coalesce("e.entity_id", F.when(team, F.col("e.team_abbr")).otherwise(F.col("e.mention")))
    return best.select("fact_id", F.col("e.entity_type").alias("scope_type"), ident.alias("scope_id"), F.when(team, ident).when(F.col("e.entity_type") == "player", F.col("e.team_abbr")).alias("scope_team"))


def scope_label(kind: Column, ident: Column, label: Column) -> Column:
    """A readable scope; none means the whole league."""
    shown = F.coalesce(F.nullif(label, F.lit("")), F.when(kind == "team", F.coalesce(ident, F.lit("Team context"))).when(kind == "player", "Player context").when(kind == "game", "Game context"), F.lit("League-wide"))
    return F.when(kind.isNull() | (kind == "team"), shown).otherwise(F.concat(shown, F.lit(" ("), kind, F.lit(")")))


NO_TOPICS, GENERAL = "NO_TOPICS_FOUND", "general"


def facts_by_topic_scope(facts: DataFrame, topics: DataFrame, entities: DataFrame, batch: bool = False) -> DataFrame:
    """Facts of a link grouped by primary topic and scope. In batches games give no scope and a sentinel topic means general."""
    kinds = entities.where("entity_type <> 'game'") if batch else entities
    topic = primary_topic(topics.withColumn("topic", F.when(F.col("topic") == NO_TOPICS, GENERAL).otherwise(F.col("topic"))) if batch else topics)
    joined = facts.join(topic, "fact_id", "left").join(primary_scope(kinds), "fact_id", "left").withColumn("topic", F.coalesce("topic", F.lit(GENERAL)))
    grouped = joined.groupBy("url_id", "topic", "scope_type", "scope_id")
    return grouped.agg(F.array_sort(F.collect_list("fact_id")).alias("facts"))


def lacking(facts: DataFrame, topics: DataFrame, entities: DataFrame) -> DataFrame:
    """Facts without topics or without entities, and which of them."""
    has = lambda df, name: df.select("fact_id").distinct().withColumn(name, F.lit(True))
    both = facts.join(has(topics, "t"), "fact_id", "left").join(has(entities, "e"), "fact_id", "left")
    return both.where("t is null or e is null").select("fact_id", F.col("t").isNull().alias("needs_topics"), F.col("e").isNull().alias("needs_entities"))


def pending_knowledge(urls: DataFrame, retry: bool = False, most_errors: int = 3) -> DataFrame:
    """Links with facts and no knowledge, few errors unless retried; a missing error count is not few."""
    out = urls.where("facts_at is not null and knowledge_at is null")
    return out if retry else out.where(F.col("error_count") <= most_errors)


def completion(urls: DataFrame, facts: DataFrame, topics: DataFrame, entities: DataFrame) -> DataFrame:
    """A link is complete if it has facts and each of them has topics and entities."""
    has = lambda df, name: df.select("fact_id").distinct().withColumn(name, F.lit(True))
    each = facts.join(has(topics, "t"), "fact_id", "left").join(has(entities, "e"), "fact_id", "left")
    per = each.groupBy("url_id").agg(F.every(F.col("t").isNotNull() & F.col("e").isNotNull()).alias("complete"))
    return urls.select("url_id").join(per, "url_id", "left").select("url_id", F.coalesce("complete", F.lit(False)).alias("complete"))


def reconcile(urls: DataFrame, facts: DataFrame, topics: DataFrame, entities: DataFrame) -> DataFrame:
    """Links stamped without facts, stamped without complete knowledge, or ready without facts."""
    some = facts.select("url_id").distinct().withColumn("has", F.lit(True))
    done = completion(urls, facts, topics, entities)
    both = urls.join(some, "url_id", "left").join(done, "url_id")
    state = (
        F.when(F.col("facts_at").isNotNull() & F.col("has").isNull(), "stamped_without_facts")
        .when(F.col("knowledge_at").isNotNull() & ~F.col("complete"), "stamped_incomplete")
        .when(F.col("content_at").isNotNull() & F.col("facts_at").isNull() & F.col("has").isNull(), "ready_without_facts")
    )
    return both.select("url_id", state.alias("state")).where("state is not null")


def post_processed(urls: DataFrame, facts: DataFrame, topics: DataFrame, entities: DataFrame) -> DataFrame:
    """Fact counts, latest extraction and difficulty of each link, from three aggregates in two full outer joins.

    topics and entities have url_id and extracted_at.
    """
    n = facts.groupBy("url_id").agg(F.count("*").alias("n"))
    t = topics.groupBy("url_id").agg(F.max("extracted_at").alias("t"))
    e = entities.groupBy("url_id").agg(F.max("extracted_at").alias("e"))
    c = n.join(t, "url_id", "full_outer").join(e, "url_id", "full_outer")
    c = c.select("url_id", F.coalesce("n", F.lit(0)).alias("facts_count"), F.greatest("t", "e").alias("knowledge_extracted_at"))
    return urls.select("url_id").join(c.withColumn("difficulty", stored_difficulty(F.col("facts_count"))), "url_id")


def stored_difficulty(n: Column) -> Column:
    """G15's buckets."""
    return F.when(n <= 5, "easy").when(n <= 15, "medium").otherwise("hard")


def fact_difficulty(n: Column) -> Column:
    """G17's buckets."""
    return F.when(n < 10, "easy").when(n <= 30, "medium").otherwise("hard")


def article_metrics(facts: DataFrame, topics: DataFrame, entities: DataFrame) -> DataFrame:
    """Facts, distinct topics and teams of each link, and a two-step difficulty."""
    n = facts.groupBy("url_id").agg(F.count("*").alias("n_facts"))
    t = topics.groupBy("url_id").agg(F.countDistinct(canonical_topic(F.col("topic"))).alias("n_topics"))
    team = F.when(F.col("entity_type") == "team", F.coalesce("entity_id", "team_abbr")).otherwise(F.col("team_abbr"))
    e = entities.groupBy("url_id").agg(F.countDistinct(team).alias("n_teams"))
    c = n.join(t, "url_id", "left").join(e, "url_id", "left").na.fill(0)
    return c.withColumn("difficulty", F.when((F.col("n_facts") <= 50) & (F.col("n_topics") <= 3) & (F.col("n_teams") <= 3), "easy").otherwise("hard"))


def chunks(facts: DataFrame, size: int) -> DataFrame:
    """A link's facts in chunks of a size."""
    place = F.row_number().over(Window.partitionBy("url_id").orderBy("fact_id")) - 1
    return facts.withColumn("chunk", F.floor(place / size).cast("int")).groupBy("url_id", "chunk").agg(F.array_sort(F.collect_list("fact_id")).alias("facts"))


def replaced(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """A table in which the rows of each key that ``rows`` brings are cleared before these are put in."""
    return table.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def partitioned(mentions: DataFrame, resolved: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Mentions with and without a resolved id."""
    both = mentions.join(resolved, key, "left")
    found = [c for c in resolved.columns if c != key][0]
    return both.where(F.col(found).isNotNull()), both.where(F.col(found).isNull())
