"""News flow: watermarks, link processing, stage queues and delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.text import league_url, normal_url, valid_url
from fieldlens.operators.dedupe import first_by


def after_watermark(items: DataFrame, watermarks: DataFrame) -> DataFrame:
    """G1: items newer than their source's mark; undated items, and those of new sources, stay."""
    marked = items.join(watermarks.select("source", "last_published_at"), "source", "left")
    return marked.where(F.col("published").isNull() | F.col("last_published_at").isNull() | (F.col("published") > F.col("last_published_at"))).drop("last_published_at")


def processed_links(items: DataFrame, seq: str, cutoff: Column | None = None, league_only: bool = False) -> DataFrame:
    """Valid links, the first of each, then by date (undated stay), then by content. A link counts as seen before its date is looked at."""
    out = first_by(items.where(valid_url(F.col("url"))), ["url"], seq)
    if cutoff is not None:
        out = out.where(F.col("published").isNull() | (F.col("published") >= F.date_trunc("day", cutoff)))
    return out.where(league_url(F.col("url"))) if league_only else out


def advanced(watermarks: DataFrame, written: DataFrame) -> DataFrame:
    """Marks after a successful write: the newest surviving item of each source; sources whose items all fell away keep theirs."""
    newest = written.groupBy("source").agg(F.max("published").alias("newest"))
    both = watermarks.select("source", "last_published_at").join(newest, "source", "full_outer")
    return both.select("source", F.greatest("last_published_at", "newest").alias("last_published_at"))


def run_metrics(items: DataFrame, kept: DataFrame) -> DataFrame:
    """Items found, kept and dropped by source."""
    found = items.groupBy("source").agg(F.count("*").alias("found"))
    left = kept.groupBy("source").agg(F.count("*").alias("kept"))
    return found.join(left, "source", "left").select("source", "found", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("found") - F.coalesce("kept", F.lit(0))).alias("dropped"))


# The stages of a link, each as what must be there and what must not.
STAGES = {"content": ([], "content_at"), "facts": (["content_at"], "facts_at"), "summary": (["facts_at"], "summary_at"), "knowledge": (["facts_at"], "knowledge_at")}


def pending(urls: DataFrame, stage: str, limit: int) -> DataFrame:
    """Links that wait for a stage, the most recently changed first."""
    done, missing = STAGES[stage]
    wait = F.col(missing).isNull()
    for c in done:
        wait = wait & F.col(c).isNotNull()
    return urls.where(wait).orderBy(F.desc("updated_at"), "url_id").limit(limit)


def balanced(urls: DataFrame, limit: int) -> DataFrame:
    """Half the newest and half the oldest waiting links, by turns, each once."""
    half = -(-limit // 2)
    side = lambda order, turn: urls.orderBy(*order).limit(half).withColumn("r", F.row_number().over(Window.orderBy(*order)) * 2 + turn)
    both = side([F.desc("updated_at"), F.col("url_id")], 0).unionByName(side([F.col("updated_at"), F.col("url_id")], 1))
    return both.groupBy("url_id").agg(F.min("r").alias("place")).orderBy("place").limit(limit)


def many_facts(urls: DataFrame, threshold: int) -> DataFrame:
    """Links with more facts than the threshold."""
    return urls.where(F.col("facts_count") > threshold)


def by_difficulty(urls: DataFrame, difficulty: str | None, as_of: Column, max_days: int | None, limit: int) -> DataFrame:
    """Links that wait for a summary, by difficulty and age, newest first."""
    out = urls.where("facts_at is not null and summary_at is null")
    if difficulty is not None:
        out = out.where(F.col("difficulty") == difficulty)
    if max_days is not None:
        out = out.where(F.col("updated_at") >= as_of - F.make_interval(days=F.lit(max_days)))
    return out.orderBy(F.desc("updated_at"), "url_id").limit(limit)


def subject_urls(links: DataFrame, groups: DataFrame, members: DataFrame, urls: DataFrame, subject: str, cutoff: Column | None, limit: int) -> DataFrame:
    """Subject to groups to members to links, each hop after the cutoff where one is given; one row for each normal URL, newest first."""
    late = lambda df, c: df if cutoff is None else df.where(F.col(c) >= cutoff)
    own = links.where(F.col("subject") == subject).select("group_id").distinct()
    found = late(groups, "group_at").join(own, "group_id", "left_semi").select("group_id")
    ids = late(members, "member_at").join(found, "group_id", "left_semi").select("url_id").distinct()
    hit = late(urls, "url_at").join(ids, "url_id", "left_semi").withColumn("url", normal_url(F.col("url"))).where("url is not null")
    return first_by(hit, ["url"], F.desc("url_at"), F.col("url_id")).orderBy(F.desc("url_at"), "url_id").limit(limit)


def articles_with_images(articles: DataFrame, links: DataFrame, images: DataFrame, language: str) -> DataFrame:
    """A language's articles with up to two images, newest first."""
    joined = articles.where(F.col("lang") == language).join(links, "article_id", "left")
    for i in (1, 2):
        joined = joined.join(images.select(F.col("image_id").alias(f"image_{i}"), F.col("image_url").alias(f"image_url_{i}")), f"image_{i}", "left")
    return joined.select("article_id", "created_at", "image_url_1", "image_url_2")


def listing(parents: DataFrame, children: DataFrame, key: str, sort: str, offset: int, limit: int) -> DataFrame:
    """A page of parents that have children, with their number and the total."""
    n = children.groupBy(key).agg(F.count("*").alias("n_children"))
    own = parents.join(n, key)
    total = own.agg(F.count("*").alias("total"))
    return own.crossJoin(F.broadcast(total)).orderBy(F.desc(sort), key).offset(offset).limit(limit)


def detail(parents: DataFrame, children: DataFrame, key: str, seq: str) -> DataFrame:
    """Parents with their children as an ordered array."""
    nested = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(seq))).alias("children"))
    return parents.join(nested, key, "left")


def active_teams(teams: DataFrame) -> DataFrame:
    """Teams not marked inactive; a missing mark counts as active."""
    return teams.where(F.coalesce("is_active", F.lit(True)) & F.coalesce("active", F.lit(True)))


def claimed(queue: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The oldest pending rows of a queue, now processing, and the queue after that."""
    take = queue.where("status = 'pending'").orderBy("created_at", "id").limit(limit).select("id").withColumn("__t", F.lit(True))
    after = queue.join(F.broadcast(take), "id", "left").withColumn("status", F.when(F.col("__t"), "processing").otherwise(F.col("status"))).drop("__t")
    return queue.join(F.broadcast(take.select("id")), "id", "left_semi").withColumn("status", F.lit("processing")), after
