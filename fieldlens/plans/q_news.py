"""Queries of family G over links, facts, topics and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.operators import batches as T
from fieldlens.operators import jobs as J
from fieldlens.operators import knowledge as K
from fieldlens.operators import monitoring as M
from fieldlens.operators import news as N
from fieldlens.plans.registry import query

_AT = "TIMESTAMP '2024-01-20 00:00:00'"
_MARKS = "marks AS (SELECT source, max(published) AS last_published_at FROM news WHERE item_id % 2 = 0 AND published < TIMESTAMP '2024-01-15' AND source <> 'error' GROUP BY source)"


def _as_of():
    return F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))


def _marks(t):
    early = t.news.where((F.col("item_id") % 2 == 0) & (F.col("published") < F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))) & (F.col("source") != "error"))
    return early.groupBy("source").agg(F.max("published").alias("last_published_at"))


@query("watermark_filter", f"WITH {_MARKS} SELECT item_id FROM news LEFT JOIN marks USING (source) WHERE published IS NULL OR last_published_at IS NULL OR published > last_published_at", "news")
def watermark_filter(t):
    return N.after_watermark(t.news, _marks(t)).select("item_id")


_LINKS = "links AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS r FROM news) WHERE r = 1 AND (published IS NULL OR published >= TIMESTAMP '2024-01-10'))"


def _links(t):
    return N.processed_links(t.news, "seq", F.to_timestamp_ntz(F.lit("2024-01-10 09:30:00")), league_only=True)


@query("url_dedupe_first_seen", f"WITH {_LINKS} SELECT item_id, url, source FROM links", "news")
def url_dedupe_first_seen(t):
    return _links(t).select("item_id", "url", "source")


@query("watermark_advance", f"WITH {_MARKS}, {_LINKS}, n AS (SELECT source, max(published) AS newest FROM links GROUP BY source) SELECT source, greatest(last_published_at, newest) AS last_published_at FROM marks FULL JOIN n USING (source)", "news")
def watermark_advance(t):
    return N.advanced(_marks(t), _links(t))


@query("news_run_metrics", f"WITH {_LINKS} SELECT source, count(*) AS found, count(*) FILTER (item_id IN (SELECT item_id FROM links)) AS kept, count(*) FILTER (item_id NOT IN (SELECT item_id FROM links)) AS dropped FROM news GROUP BY source", "news")
def news_run_metrics(t):
    return N.run_metrics(t.news, _links(t))


@query("observed_run", f"""WITH {_LINKS}, x AS (SELECT 'extracted' AS stage, source, published IS NULL AS failed FROM news UNION ALL SELECT 'kept', source, FALSE FROM links)
  SELECT stage, NULL AS source, count(*) AS rows, count(*) FILTER (failed) AS failed FROM x GROUP BY stage UNION ALL SELECT stage, source, count(*), count(*) FILTER (failed) FROM x GROUP BY stage, source""", "news")
def observed_run(t):
    """A run's rows, undated ones as failures, and kept links, in all and by source, counted while the links are written: no second scan."""
    run = M.Run(sources=sorted(r["source"] for r in t.news.select("source").distinct().collect()))  # the configured sources
    links = N.processed_links(run.observed("extracted", t.news, F.col("published").isNull()), "seq", F.to_timestamp_ntz(F.lit("2024-01-10 09:30:00")), league_only=True)
    with run.timed("kept"):
        run.observed("kept", links).write.format("noop").mode("overwrite").save()
    return run.rows(t.spark).where("rows > 0 or source is null")


@query("pending_stage_queue", "SELECT url_id, 'facts' AS stage FROM (SELECT url_id FROM urls WHERE content_at IS NOT NULL AND facts_at IS NULL ORDER BY updated_at DESC, url_id LIMIT 40) UNION ALL SELECT url_id, 'content' FROM (SELECT url_id FROM urls WHERE content_at IS NULL ORDER BY updated_at DESC, url_id LIMIT 30)", "urls")
def pending_stage_queue(t):
    return N.pending(t.urls, "facts", 40).select("url_id", F.lit("facts").alias("stage")).union(N.pending(t.urls, "content", 30).select("url_id", F.lit("content").alias("stage")))


@query("balanced_backlog", "WITH w AS (SELECT url_id, row_number() OVER (ORDER BY updated_at DESC, url_id) AS a, row_number() OVER (ORDER BY updated_at, url_id) AS b FROM urls WHERE content_at IS NULL) SELECT url_id, CAST(min(p) AS INT) AS place FROM (SELECT url_id, a * 2 AS p FROM w WHERE a <= 25 UNION ALL SELECT url_id, b * 2 + 1 FROM w WHERE b <= 25) GROUP BY url_id", "urls")
def balanced_backlog(t):
    return N.balanced(t.urls.where("content_at is null"), 50)


@query("many_facts", "SELECT url_id FROM urls WHERE facts_count > 50", "urls")
def many_facts(t):
    return N.many_facts(t.urls, 50).select("url_id")


@query("pending_summaries", f"SELECT url_id FROM urls WHERE facts_at IS NOT NULL AND summary_at IS NULL AND difficulty = 'easy' AND updated_at >= {_AT} - INTERVAL 9 DAY ORDER BY updated_at DESC, url_id LIMIT 60", "urls")
def pending_summaries(t):
    return N.by_difficulty(t.urls, "easy", _as_of(), 9, 60).select("url_id")


@query("team_url_chain", """WITH u AS (SELECT event_id AS url_id, 'https://s.example.com/p/' || (event_id % 300) AS url, ts AS url_at FROM events),
  m AS (SELECT event_id AS url_id, user_id % 50 AS group_id, ts AS member_at FROM events), g AS (SELECT group_id, max(member_at) AS group_at FROM m GROUP BY group_id),
  h AS (SELECT u.* FROM u WHERE url_at >= TIMESTAMP '2024-01-12' AND url_id IN (SELECT url_id FROM m WHERE member_at >= TIMESTAMP '2024-01-12' AND group_id IN (SELECT group_id FROM g WHERE group_at >= TIMESTAMP '2024-01-12' AND group_id % 5 = 2))),
  f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY url_at DESC, url_id) AS r FROM h) SELECT url_id, url FROM f WHERE r = 1 ORDER BY url_at DESC, url_id LIMIT 40""")
def team_url_chain(t):
    e = t.events
    urls = e.select(F.col("event_id").alias("url_id"), F.concat(F.lit("HTTPS://S.example.com/p/"), (F.col("event_id") % 300).cast("string")).alias("url"), F.col("ts").alias("url_at"))
    members = e.select(F.col("event_id").alias("url_id"), (F.col("user_id") % 50).alias("group_id"), F.col("ts").alias("member_at"))
    groups = members.groupBy("group_id").agg(F.max("member_at").alias("group_at"))
    links = groups.select(F.concat(F.lit("team"), (F.col("group_id") % 5).cast("string")).alias("subject"), "group_id")
    return N.subject_urls(links, groups, members, urls, "team2", F.to_timestamp_ntz(F.lit("2024-01-12 00:00:00")), 40).select("url_id", "url")


@query("articles_with_images", "SELECT d.doc_id AS article_id, d.n_chars AS created_at, 'p' || p1.page_id AS image_url_1, 'p' || p2.page_id AS image_url_2 FROM documents d LEFT JOIN pages p1 ON p1.page_id = CASE WHEN d.doc_id % 3 <> 0 THEN d.doc_id % 200 END LEFT JOIN pages p2 ON p2.page_id = CASE WHEN d.doc_id % 3 = 1 THEN d.doc_id % 70 END WHERE lang = 'de'")
def articles_with_images(t):
    articles = t.documents.select(F.col("doc_id").alias("article_id"), "lang", F.col("n_chars").alias("created_at"))
    links = t.documents.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("article_id"), (F.col("doc_id") % 200).alias("image_1"), F.when(F.col("doc_id") % 3 == 1, F.col("doc_id") % 70).alias("image_2"))
    images = t.pages.select(F.col("page_id").alias("image_id"), F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("image_url"))
    return N.articles_with_images(articles, links, images, "de")


@query("news_listing", "WITH n AS (SELECT url_id, count(*) AS n_children FROM facts GROUP BY url_id) SELECT d.doc_id AS url_id, n_children, (SELECT count(*) FROM n) AS total FROM documents d JOIN n ON d.doc_id = n.url_id ORDER BY n_chars DESC, d.doc_id LIMIT 20 OFFSET 10", "facts")
def news_listing(t):
    return N.listing(t.documents.select(F.col("doc_id").alias("url_id"), "n_chars"), t.facts, "url_id", "n_chars", 10, 20).select("url_id", "n_children", "total")


@query("news_detail", "SELECT d.doc_id AS url_id, array_to_string(list_sort(list(fact_id) FILTER (fact_id IS NOT NULL)), ',') AS facts FROM documents d LEFT JOIN facts f ON f.url_id = d.doc_id GROUP BY d.doc_id", "facts")
def news_detail(t):
    nested = N.detail(t.documents.select(F.col("doc_id").alias("url_id")), t.facts, "url_id", "fact_id")
    return nested.select("url_id", F.array_join(F.transform("children", lambda c: c["fact_id"].cast("string")), ",").alias("facts"))


@query("active_teams", "SELECT team_abbr FROM teams WHERE CAST(right(team_abbr, 1) AS INT) <> 3", "teams")
def active_teams(t):
    marked = t.teams.withColumn("is_active", F.when(F.col("team_abbr").endswith("3"), False)).withColumn("active", F.lit(None).cast("boolean"))
    return N.active_teams(marked).select("team_abbr")


@query("queue_claim", "SELECT event_id AS id FROM events WHERE event_type = 'view' ORDER BY ts, event_id LIMIT 25")
def queue_claim(t):
    queue = t.events.select(F.col("event_id").alias("id"), F.col("ts").alias("created_at"), F.when(F.col("event_type") == "view", "pending").otherwise("done").alias("status"))
    return N.claimed(queue, 25)[0].select("id")


_CANON = "CASE WHEN lower(topic) LIKE '%injur%' THEN 'injury' WHEN lower(topic) LIKE '%trade%' THEN 'trade' WHEN lower(topic) LIKE '%contract%' THEN 'contract' WHEN lower(topic) LIKE '%draft%' THEN 'draft' WHEN lower(topic) LIKE '%quarterback%' THEN 'offense' ELSE replace(lower(topic), ' ', '_') END"


@query("topic_dedupe", f"SELECT fact_id, canonical, confidence, seq FROM (SELECT *, {_CANON} AS canonical, row_number() OVER (PARTITION BY fact_id, {_CANON} ORDER BY confidence DESC, coalesce(rnk, 1073741824), seq) AS r FROM topics) WHERE r = 1", "topics")
def topic_dedupe(t):
    return K.best_topics(t.topics).select("fact_id", "canonical", "confidence", "seq")


@query("entity_dedupe", "WITH k AS (SELECT *, lower(coalesce(entity_id, mention)) AS key FROM entities) SELECT fact_id, entity_type, key, seq FROM (SELECT *, row_number() OVER (PARTITION BY fact_id, entity_type, key ORDER BY is_primary DESC, confidence DESC, seq DESC) AS r FROM k) WHERE r = 1", "entities")
def entity_dedupe(t):
    return K.best_entities(t.entities).select("fact_id", "entity_type", "key", "seq")


_PT = "pt AS (SELECT fact_id, arg_min(topic, (CASE WHEN is_primary THEN 0 ELSE 1 END, CASE WHEN coalesce(rnk, 0) = 0 THEN 99 ELSE rnk END, seq)) AS topic FROM topics GROUP BY fact_id)"
_PS = """ps AS (SELECT fact_id, e.t AS scope_type, coalesce(e.i, CASE WHEN e.t = 'team' THEN e.a ELSE e.m END) AS scope_id, CASE WHEN e.t = 'team' THEN coalesce(e.i, e.a) WHEN e.t = 'player' THEN e.a END AS scope_team
  FROM (SELECT fact_id, arg_min({'t': entity_type, 'i': entity_id, 'm': mention, 'a': team_abbr}, (CASE entity_type WHEN 'team' THEN 0 WHEN 'player' THEN 1 ELSE 2 END, CASE WHEN is_primary THEN 0 ELSE 1 END, CASE WHEN coalesce(rnk, 0) = 0 THEN 99 ELSE rnk END, seq)) AS e FROM entities GROUP BY fact_id))"""


@query("primary_topic", f"WITH {_PT} SELECT * FROM pt", "topics")
def primary_topic(t):
    return K.primary_topic(t.topics)


@query("primary_scope", f"WITH {_PS} SELECT * FROM ps", "entities")
def primary_scope(t):
    return K.primary_scope(t.entities)


@query("scope_labels", f"WITH {_PS} SELECT fact_id, CASE scope_type WHEN 'team' THEN coalesce(scope_id, 'Team context') WHEN 'player' THEN 'Player context (player)' ELSE 'Game context (game)' END AS label FROM ps", "entities")
def scope_labels(t):
    return K.primary_scope(t.entities).select("fact_id", K.scope_label(F.col("scope_type"), F.col("scope_id"), F.lit(None).cast("string")).alias("label"))


@query("facts_by_topic_scope", f"WITH {_PT}, {_PS} SELECT url_id, coalesce(topic, 'general') AS topic, scope_type, scope_id, array_to_string(list_sort(list(f.fact_id)), ',') AS facts FROM facts f LEFT JOIN pt USING (fact_id) LEFT JOIN ps USING (fact_id) GROUP BY ALL", "facts topics entities")
def facts_by_topic_scope(t):
    out = K.facts_by_topic_scope(t.facts, t.topics, t.entities)
    return out.select("url_id", "topic", "scope_type", "scope_id", F.array_join(F.transform("facts", lambda x: x.cast("string")), ",").alias("facts"))


@query("facts_by_topic_scope_batch", f"WITH {_PT}, {_PS.replace('FROM entities GROUP', 'FROM entities WHERE entity_type <> ' + chr(39) + 'game' + chr(39) + ' GROUP')} SELECT url_id, coalesce(topic, 'general') AS topic, scope_type, scope_id, array_to_string(list_sort(list(f.fact_id)), ',') AS facts FROM facts f LEFT JOIN pt USING (fact_id) LEFT JOIN ps USING (fact_id) GROUP BY ALL", "facts topics entities")
def facts_by_topic_scope_batch(t):
    out = K.facts_by_topic_scope(t.facts, t.topics, t.entities, batch=True)
    return out.select("url_id", "topic", "scope_type", "scope_id", F.array_join(F.transform("facts", lambda x: x.cast("string")), ",").alias("facts"))


@query("lacking_knowledge", "SELECT fact_id, fact_id NOT IN (SELECT fact_id FROM topics) AS needs_topics, fact_id NOT IN (SELECT fact_id FROM entities) AS needs_entities FROM facts WHERE fact_id NOT IN (SELECT fact_id FROM topics) OR fact_id NOT IN (SELECT fact_id FROM entities)", "facts topics entities")
def lacking_knowledge(t):
    return K.lacking(t.facts, t.topics, t.entities)


@query("pending_knowledge", "SELECT url_id FROM urls WHERE facts_at IS NOT NULL AND knowledge_at IS NULL AND error_count <= 3", "urls")
def pending_knowledge(t):
    return K.pending_knowledge(t.urls).select("url_id")


_DONE = "done AS (SELECT url_id, bool_and(fact_id IN (SELECT fact_id FROM topics) AND fact_id IN (SELECT fact_id FROM entities)) AS complete FROM facts GROUP BY url_id)"


@query("completion", f"WITH {_DONE} SELECT doc_id AS url_id, coalesce(complete, false) AS complete FROM documents LEFT JOIN done ON doc_id = url_id", "facts topics entities")
def completion(t):
    return K.completion(t.documents.select(F.col("doc_id").alias("url_id")), t.facts, t.topics, t.entities)


@query("reconcile", f"""WITH {_DONE}, s AS (SELECT u.url_id, CASE WHEN facts_at IS NOT NULL AND u.url_id NOT IN (SELECT url_id FROM facts) THEN 'stamped_without_facts' WHEN knowledge_at IS NOT NULL AND NOT coalesce(complete, false) THEN 'stamped_incomplete'
  WHEN content_at IS NOT NULL AND facts_at IS NULL AND u.url_id NOT IN (SELECT url_id FROM facts) THEN 'ready_without_facts' END AS state FROM urls u LEFT JOIN done USING (url_id)) SELECT * FROM s WHERE state IS NOT NULL""", "urls facts topics entities")
def reconcile(t):
    return K.reconcile(t.urls, t.facts, t.topics, t.entities)


@query("full_outer_postprocess", """WITH n AS (SELECT url_id, count(*) AS n FROM facts WHERE url_id % 5 <> 0 GROUP BY url_id), a AS (SELECT url_id, max(fact_id * 3) AS t FROM topics WHERE url_id % 4 <> 0 GROUP BY url_id), b AS (SELECT url_id, max(fact_id * 2 + seq) AS e FROM entities GROUP BY url_id),
  c AS (SELECT url_id, coalesce(n, 0) AS facts_count, greatest(t, e) AS knowledge_extracted_at FROM n FULL JOIN a USING (url_id) FULL JOIN b USING (url_id))
  SELECT *, CASE WHEN facts_count <= 5 THEN 'easy' WHEN facts_count <= 15 THEN 'medium' ELSE 'hard' END AS difficulty FROM c WHERE url_id IN (SELECT doc_id FROM documents)""", "facts topics entities")
def full_outer_postprocess(t):
    topics = t.topics.where("url_id % 4 <> 0").select("url_id", (F.col("fact_id") * 3).alias("extracted_at"))
    entities = t.entities.select("url_id", (F.col("fact_id") * 2 + F.col("seq")).alias("extracted_at"))
    return K.post_processed(t.documents.select(F.col("doc_id").alias("url_id")), t.facts.where("url_id % 5 <> 0"), topics, entities)


@query("article_metrics", f"""WITH n AS (SELECT url_id, count(*) AS n FROM facts GROUP BY url_id), a AS (SELECT url_id, count(DISTINCT {_CANON}) AS t FROM topics GROUP BY url_id),
  b AS (SELECT url_id, count(DISTINCT CASE WHEN entity_type = 'team' THEN coalesce(entity_id, team_abbr) ELSE team_abbr END) AS e FROM entities GROUP BY url_id)
  SELECT url_id, n AS n_facts, coalesce(t, 0) AS n_topics, coalesce(e, 0) AS n_teams, CASE WHEN n <= 50 AND coalesce(t, 0) <= 3 AND coalesce(e, 0) <= 3 THEN 'easy' ELSE 'hard' END AS difficulty FROM n LEFT JOIN a USING (url_id) LEFT JOIN b USING (url_id)""", "facts topics entities")
def article_metrics(t):
    return K.article_metrics(t.facts, t.topics, t.entities)


@query("difficulty_buckets", "SELECT difficulty, count(*) AS n FROM urls GROUP BY difficulty", "urls")
def difficulty_buckets(t):
    return t.urls.select(K.fact_difficulty(F.col("facts_count")).alias("difficulty")).groupBy("difficulty").agg(F.count("*").alias("n"))


@query("fact_chunks", "WITH r AS (SELECT url_id, fact_id, (row_number() OVER (PARTITION BY url_id ORDER BY fact_id) - 1) // 2 AS chunk FROM facts) SELECT url_id, CAST(chunk AS INT) AS chunk, count(*) AS n, min(fact_id) AS first FROM r GROUP BY ALL", "facts")
def fact_chunks(t):
    return K.chunks(t.facts, 2).select("url_id", "chunk", F.size("facts").cast("long").alias("n"), F.get("facts", F.lit(0)).alias("first"))


#: An article's id in the form of a UUID, in SQL of both engines.
_UUID = "substr(md5(CAST(doc_id AS STRING)), 1, 8) || '-' || substr(md5(CAST(doc_id AS STRING)), 9, 4) || '-' || substr(md5(CAST(doc_id AS STRING)), 13, 4) || '-' || substr(md5(CAST(doc_id AS STRING)), 17, 4) || '-' || substr(md5(CAST(doc_id AS STRING)), 21, 12)"
_SUMMARY = f"x AS (SELECT doc_id, {_UUID} AS article_id, 'Sum ' || doc_id || ': ' || regexp_replace(substr(coalesce(text, ''), 1, 40), '[^A-Za-z0-9 ]', '_'%s) || '.' AS summary_text FROM documents)"
_SUMMARY_SQL = _SUMMARY % ", 'g'" + ", u AS (SELECT * FROM x WHERE doc_id % 11 < 8 AND doc_id % 13 <> 5)"  # 11: broken lines, errors, refusals; 13: no summary


def _summary_batch(t):
    """Result lines with UUIDs: articles asked for twice, topics in both forms of id, garbled ids, replies in several shapes, broken lines, errors, refusals, and articles held already."""
    x = t.spark.sql(f"WITH {_SUMMARY % ''} SELECT * FROM x".replace("documents", "{documents}"), documents=t.documents)
    k, article = F.col("doc_id"), F.col("article_id")
    scope = F.when(k % 5 == 0, "|team|KC|Chiefs").when(k % 5 == 1, "|none|none|none").when(k % 5 == 2, "|player|00-0033873").when(k % 5 == 3, "|topics|x").otherwise("|player|UNRESOLVED:jo_roe|Jo")
    hard = F.concat(F.lit("hard_"), article, F.lit("_2|injuries & health"), scope)
    old = F.concat(F.lit("hard_"), article, F.lit("_1_trades_team_BUF_x"))
    asks = x.select("*", F.posexplode(F.when(k % 3 == 0, F.array(F.concat(F.lit("easy_"), article), F.concat(F.lit("easy_"), article))).when(k % 3 == 1, F.array(hard, old)).otherwise(F.array(hard))).alias("turn", "custom_id"))
    last = (k % 3 != 0) | (F.col("turn") == 1)
    summary = F.when(last, F.col("summary_text")).otherwise("earlier")
    json = F.to_json(F.struct(F.when(k % 13 != 5, summary).alias("summary")), {"ignoreNullFields": "true"})
    text = F.when(k % 4 == 1, F.concat(F.lit("Here it is: "), json, F.lit(" done"))).when(k % 4 == 2, F.concat(F.lit("```json\n"), json, F.lit("\n```"))).otherwise(json)
    content = lambda body: F.to_json(F.struct(F.col("custom_id"), F.when(k % 11 == 9, F.struct(F.lit("no").alias("message"))).alias("error"), F.struct(F.when(k % 11 == 10, 429).otherwise(200).alias("status_code"), body.alias("body")).alias("response")))
    plain = content(F.struct(F.lit("m1").alias("model"), F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")))
    parts = content(F.struct(F.lit("m1").alias("model"), F.array(F.struct(F.struct(F.array(F.struct(F.lit("note").alias("type"), F.lit("no").alias("text")), F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("content")).alias("message"))).alias("choices")))
    line = F.when(k % 11 == 8, '{"custom_id": "easy_').when(k % 7 == 0, parts).otherwise(plain)
    held = x.where("doc_id % 17 = 3").select("article_id", F.lit("easy").alias("kind"))
    return T.summary_batch(asks.select((k * 2 + F.col("turn")).alias("seq"), line.alias("value")), held)


@query("batch_results", f"WITH {_SUMMARY_SQL} SELECT article_id, summary_text, 'm1' AS llm_model FROM u WHERE doc_id % 3 = 0 AND doc_id % 17 <> 3")
def batch_results(t):
    """Summaries of whole articles."""
    return _summary_batch(t)[0]


@query("batch_topic_summaries", f"""WITH {_SUMMARY_SQL} SELECT article_id, 'injuries & health' AS primary_topic, CASE doc_id % 5 WHEN 0 THEN 'KC' END AS primary_team, CASE doc_id % 5 WHEN 0 THEN 'team' WHEN 2 THEN 'player' END AS primary_scope_type,
  CASE doc_id % 5 WHEN 0 THEN 'KC' WHEN 2 THEN '00-0033873' END AS primary_scope_id, CASE doc_id % 5 WHEN 0 THEN 'Chiefs' WHEN 2 THEN '00-0033873' END AS primary_scope_label, summary_text, 'm1' AS llm_model FROM u WHERE doc_id % 3 <> 0 AND doc_id % 5 < 3
  UNION ALL SELECT article_id, 'trades', 'BUF_x', 'team', 'BUF_x', 'BUF_x', summary_text, 'm1' FROM u WHERE doc_id % 3 = 1""")
def batch_topic_summaries(t):
    """Summaries of topics, with their scopes."""
    return _summary_batch(t)[1].drop("seq")


@query("batch_report", f"""WITH {_SUMMARY_SQL}, a AS (SELECT *, CASE doc_id % 3 WHEN 2 THEN 1 ELSE 2 END AS n FROM x) SELECT (SELECT count(*) FROM u) AS articles, (SELECT count(*) FROM u WHERE doc_id % 3 = 0 AND doc_id % 17 = 3) AS skipped_existing,
  (SELECT count(*) FROM u WHERE doc_id % 3 <> 0 AND doc_id % 5 >= 3) AS garbled, (SELECT coalesce(sum(n), 0)::BIGINT FROM a WHERE doc_id % 11 >= 8) AS errors, (SELECT coalesce(sum(n), 0)::BIGINT FROM a WHERE doc_id % 11 < 8 AND doc_id % 13 = 5) AS without_data""")
def batch_report(t):
    return _summary_batch(t)[2]


_FINE = "fine AS (SELECT fact_id FROM facts WHERE fact_id % 13 NOT IN (5, 6, 7)), new AS (SELECT * FROM fine WHERE fact_id % 17 <> 3 AND fact_id % 19 <> 0)"


def _topic_batch(t):
    """Result lines: broken ones, errors and refusals, unknown facts, facts held already, equal topics and unlisted ones."""
    f = F.col("fact_id")
    topic = lambda name, conf, rank: F.to_json(F.struct(F.lit(name).alias("topic"), F.lit(conf).alias("confidence"), F.lit(rank).alias("rank")))
    two = F.concat(F.lit("["), topic("Injuries & Player Health", 0.5, 2), F.lit(","), topic("injuries and player health", 0.9, 1), F.lit("]"))
    topics = F.when(f % 3 == 0, F.concat(F.lit('"topics": '), two)).when(f % 3 == 1, '"topics": ["Nonsense", {"text": ""}]').otherwise(F.when(f % 2 == 0, '"topics": "Statistics & Rankings"').otherwise('"topic": " statistics and rankings "'))
    row = F.concat(F.lit('{"news_fact_id": '), F.when(f % 17 == 3, f + 1_000_000_000).otherwise(f).cast("string"), F.lit(", "), topics, F.lit("}"))
    text = F.when(f % 5 == 0, F.concat(F.lit("["), row, F.lit(", 7]"))).when(f % 5 == 1, F.concat(F.lit('{"results": ['), row, F.lit("]}"))).when(f % 5 == 2, F.concat(F.lit('{"results": [], "data": ['), row, F.lit("]}"))).otherwise(F.concat(F.lit("Sure: ["), row, F.lit("] ok")))
    body = F.struct(F.lit("m").alias("model"), text.alias("output_text"))
    status = F.when(f % 13 == 6, 500).otherwise(200)
    line = F.to_json(F.struct(F.concat(F.lit("t_"), f.cast("string")).alias("custom_id"), F.when(f % 13 == 5, "refused").alias("error"), F.struct(status.alias("status_code"), body.alias("body")).alias("response")))
    out, report = T.topic_batch(t.facts.select(f.alias("seq"), F.when(f % 13 == 7, '{"custom_id": ').otherwise(line).alias("value")), t.facts, t.facts.where("fact_id % 19 = 0"))
    return out.withColumn("fact_id", F.col("fact_id").cast("long")), report


@query("topic_batch", f"WITH {_FINE} SELECT fact_id, 'm' AS llm_model, CASE fact_id % 3 WHEN 0 THEN 'injuries & player health' WHEN 1 THEN 'NO_TOPICS_FOUND' ELSE 'statistics & rankings' END AS topic, CASE fact_id % 3 WHEN 0 THEN 0.9 WHEN 1 THEN 1 END::DOUBLE AS confidence, 1::INT AS rank FROM new", "facts")
def topic_batch(t):
    return _topic_batch(t)[0]


@query("topic_batch_report", f"WITH {_FINE} SELECT (SELECT count(*) FROM fine) AS facts_in_output, (SELECT count(*) FROM fine WHERE fact_id % 17 = 3) AS skipped_missing, (SELECT count(*) FROM fine WHERE fact_id % 17 <> 3 AND fact_id % 19 = 0) AS skipped_existing, (SELECT count(*) FROM facts WHERE fact_id % 13 IN (5, 6, 7)) AS errors, (SELECT count(*) FROM new WHERE fact_id % 3 = 1) AS without_data", "facts")
def topic_batch_report(t):
    return _topic_batch(t)[1]


def _entity_batch(t):
    """Result lines of entities: players by name with a type word, players nobody knows, teams, games, and what is to be left out."""
    f = F.col("fact_id")
    nation = t.nation.select(F.col("n_nationkey").cast("long").alias("nk"), "n_name")
    facts = t.facts.join(F.broadcast(nation.select(F.col("nk").alias("n1"), F.col("n_name").alias("one"))), (f % 6) == F.col("n1")).join(F.broadcast(nation.select(F.col("nk").alias("n2"), F.col("n_name").alias("two"))), (f % 6) + 1 == F.col("n2"))
    player = F.concat(F.lit('{"entity_type": "Player", "mention_text": "Players: Customer#'), F.lpad((f % 100 + 1).cast("string"), 9, "0"), F.lit('", "is_primary": true, "rank": 1, "confidence": 0.4}'))
    unknown = F.concat(F.lit('{"type": "player", "name": " Zzyx Qwv'), (f % 5).cast("string"), F.lit(' ", "position": "QB"}'))
    team = F.concat(F.lit('{"entity_type": "team", "mention_text": "team: '), F.col("one"), F.lit('"}'))
    game = F.concat(F.lit('{"entity_type": "game", "mention_text": "'), F.col("one"), F.lit(" at "), F.col("two"), F.lit(', week 3"}'))
    out = F.lit('{"entity_type": "team", "mention_text": "Ohio State"}, {"entity_type": "player", "mention_text": "NFL"}, {"entity_type": "coach", "mention_text": "X"}, {"entity_type": "team"}, 5')
    kinds = F.when(f % 5 == 0, F.concat_ws(", ", player, player, team)).when(f % 5 == 1, F.concat_ws(", ", unknown, out)).when(f % 5 == 2, game).when(f % 5 == 3, out).otherwise(F.lit(""))
    text = F.concat(F.lit('[{"news_fact_id": '), f.cast("string"), F.lit(', "entities": ['), kinds, F.lit("]}]"))
    body = F.struct(F.lit("m").alias("model"), F.array(F.struct(F.lit("message").alias("type"), F.array(F.struct(F.lit("output_text").alias("type"), text.alias("text"))).alias("content"))).alias("output"))
    line = F.to_json(F.struct(F.concat(F.lit("e_"), f.cast("string")).alias("custom_id"), F.struct(F.lit(200).alias("status_code"), body.alias("body")).alias("response")))
    teams = t.teams.select("team_abbr", F.array("team_name").alias("names"))
    players = t.rosters.select(F.col("player").alias("player_id"), F.array("player_name").alias("names"), F.col("pos").alias("position"), F.col("team").alias("team_abbr"), F.lit(None).cast("string").alias("team_name"))
    # Documents may lie in a few row groups, and small rows make long lines: they are dealt out before, into as many parts at any size.
    lines = facts.repartition(4 * t.spark.sparkContext.defaultParallelism, "fact_id").select(f.alias("seq"), line.alias("value"))
    return T.entity_batch(lines, t.facts, players, teams, t.games)


_MET = "met AS (SELECT least(home, away) AS low, greatest(home, away) AS high, min(game_id) AS game_id FROM games GROUP BY 1, 2), asked AS (SELECT fact_id, 'T' || lpad(CAST(fact_id % 6 AS VARCHAR), 2, '0') AS one, 'T' || lpad(CAST(fact_id % 6 + 1 AS VARCHAR), 2, '0') AS two FROM facts), \
g AS (SELECT fact_id, CAST(game_id AS VARCHAR) AS game_id FROM asked LEFT JOIN met ON least(one, two) = low AND greatest(one, two) = high)"


@query("entity_batch", f"""WITH {_MET} SELECT fact_id, 'player' AS entity_type, 'C' || (fact_id % 100 + 1) AS entity_id, 1.0::DOUBLE AS confidence, TRUE AS is_primary, NULL AS position FROM facts WHERE fact_id % 5 = 0
  UNION ALL SELECT fact_id, 'team', one, 1.0, FALSE, NULL FROM asked WHERE fact_id % 5 = 0 UNION ALL SELECT fact_id, 'player', 'UNRESOLVED:zzyx_qwv' || (fact_id % 5), 0.0, FALSE, 'QB' FROM facts WHERE fact_id % 5 = 1
  UNION ALL SELECT fact_id, CASE WHEN game_id IS NULL THEN 'none' ELSE 'game' END, coalesce(game_id, 'NO_ENTITIES_FOUND'), CASE WHEN game_id IS NULL THEN 0.0 ELSE 0.9 END, FALSE, NULL FROM g WHERE fact_id % 5 = 2
  UNION ALL SELECT fact_id, 'none', 'NO_ENTITIES_FOUND', 0.0, FALSE, NULL FROM facts WHERE fact_id % 5 > 2""", "facts games")
def entity_batch(t):
    return _entity_batch(t)[0].select(F.col("fact_id").cast("long").alias("fact_id"), "entity_type", "entity_id", "confidence", "is_primary", "position")


@query("entity_batch_report", f"WITH {_MET} SELECT count(*) AS facts_in_output, 0::BIGINT AS skipped_missing, 0::BIGINT AS skipped_existing, 0::BIGINT AS errors, count(*) FILTER (fact_id % 5 > 2 OR fact_id % 5 = 2 AND game_id IS NULL) AS without_data FROM g", "facts games")
def entity_batch_report(t):
    return _entity_batch(t)[1]


@query("completed_links", "WITH done AS (SELECT url_id FROM facts LEFT JOIN (SELECT DISTINCT fact_id FROM topics) a USING (fact_id) LEFT JOIN (SELECT DISTINCT fact_id FROM entities) b USING (fact_id) GROUP BY url_id HAVING count(*) = count(a.fact_id) AND count(*) = count(b.fact_id) AND bool_or(facts.fact_id % 3 = 0)) SELECT url_id FROM done", "facts topics entities")
def completed_links(t):
    """The links that a batch of every third fact completes."""
    return T.completed_links(t.facts, t.topics, t.entities, t.facts.where("fact_id % 3 = 0"))


@query("batch_replaces", "SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 'new' ELSE 'old' END AS body FROM documents UNION ALL SELECT -doc_id, 'new' FROM documents WHERE doc_id % 8 = 4")
def batch_replaces(t):
    """Old summaries make room for those that a batch brings."""
    k = F.col("doc_id")
    old = t.documents.select(k.alias("id"), F.lit("old").alias("body"))
    rows = t.documents.where(k % 4 == 0).select(k.alias("id"), F.lit("new").alias("body")).union(t.documents.where(k % 8 == 4).select(-k, F.lit("new")))
    return K.replaced(old, rows, "id")


@query("resolved_partition", "SELECT CASE WHEN doc_id % 3 = 0 THEN 'resolved' ELSE 'open' END AS part, count(*) AS n FROM documents GROUP BY ALL")
def resolved_partition(t):
    mentions = t.documents.select(F.col("doc_id").alias("id"))
    yes, no = K.partitioned(mentions, mentions.where("id % 3 = 0").withColumn("player_id", F.col("id").cast("string")))
    return yes.agg(F.lit("resolved").alias("part"), F.count("*").alias("n")).union(no.agg(F.lit("open").alias("part"), F.count("*").alias("n")))


_JOBS = """jobs AS (SELECT event_id AS job_id, 'news' AS service, CASE event_id % 4 WHEN 0 THEN 'queued' WHEN 1 THEN 'running' WHEN 2 THEN 'succeeded' ELSE 'failed' END AS status, CAST(user_id % 5 AS INT) AS attempts, ts AS created_at,
  CASE WHEN event_id % 4 > 0 THEN ts + INTERVAL '7' MINUTE END AS started_at, ts + INTERVAL '9' MINUTE AS updated_at, CASE WHEN event_id % 9 > 0 THEN ts + INTERVAL '5' DAY END AS expires_at,
  CAST(NULL AS TIMESTAMP) AS finished_at, CAST(NULL AS STRING) AS result, CASE WHEN event_id % 4 = 3 THEN 'why' END AS error FROM @events)"""
_JOBS_SQL = _JOBS.replace("@events", "events")
_LATE_SQL = f"status = 'running' AND attempts < 3 AND started_at < {_AT} - INTERVAL 10 MINUTE"


def _jobs(t):
    return t.spark.sql(f"WITH {_JOBS} SELECT * FROM jobs".replace("@events", "{events}").replace("CAST(NULL AS TIMESTAMP)", "CAST(NULL AS TIMESTAMP_NTZ)"), events=t.events)


@query("job_sweep", f"""WITH {_JOBS_SQL} SELECT job_id, CASE WHEN {_LATE_SQL} THEN 'queued' ELSE status END AS status, CASE WHEN NOT ({_LATE_SQL}) THEN started_at END AS started_at, CASE WHEN {_LATE_SQL} THEN {_AT} ELSE updated_at END AS updated_at, attempts
  FROM jobs WHERE expires_at IS NULL OR expires_at >= {_AT}""")
def job_sweep(t):
    """Lost workers' jobs go back into the queue while they have attempts left; expired jobs of any state leave."""
    return J.swept(_jobs(t), _as_of()).select("job_id", "status", "started_at", "updated_at", "attempts")


@query("stale_jobs", f"""WITH {_JOBS_SQL} SELECT job_id, status FROM (SELECT job_id, status FROM jobs WHERE status = 'queued' AND attempts < 3 AND created_at < {_AT} - INTERVAL 2 MINUTE ORDER BY created_at, job_id LIMIT 100)
  UNION ALL SELECT job_id, status FROM (SELECT job_id, status FROM jobs WHERE {_LATE_SQL} ORDER BY started_at, job_id LIMIT 100)""")
def stale_jobs(t):
    """The hundred oldest of either kind, as the report lists them."""
    return J.stale(_jobs(t), _as_of()).select("job_id", "status")


@query("job_claim", f"WITH {_JOBS_SQL} SELECT job_id, CASE WHEN job_id = 8 THEN 'running' ELSE status END AS status, CASE WHEN job_id = 8 THEN {_AT} ELSE started_at END AS started_at, attempts + CASE WHEN job_id = 8 THEN 1 ELSE 0 END AS attempts FROM jobs")
def job_claim(t):
    """A queued job is taken once; one that runs is not."""
    at = _as_of()
    return J.claim(J.claim(J.claim(_jobs(t), 8, at), 9, at), 8, at).select("job_id", "status", "started_at", "attempts")


@query("job_outcomes", f"""WITH {_JOBS_SQL} SELECT job_id, CASE WHEN job_id % 4 = 1 THEN CASE WHEN job_id % 8 = 1 THEN 'failed' ELSE 'succeeded' END WHEN job_id % 8 = 3 THEN 'succeeded' ELSE status END AS status, CASE WHEN job_id % 8 IN (3, 5) THEN 'r' || job_id END AS result,
  CASE WHEN job_id % 8 = 1 THEN 'lost' WHEN job_id % 8 = 3 THEN NULL ELSE error END AS error, CASE WHEN job_id % 8 IN (1, 3, 5) THEN {_AT} END AS finished_at FROM jobs WHERE job_id <> 2""")
def job_outcomes(t):
    """Running jobs end, half of them in failure; some failed ones succeed after all; one ended job is consumed, one that waits is not."""
    k = F.col("job_id")
    told = _jobs(t).where(k % 8 < 6).where(k % 2 == 1).select("job_id", F.when(k % 8 != 1, F.concat(F.lit("r"), k.cast("string"))).alias("result"), F.when(k % 8 == 1, "lost").alias("error"))
    after = J.consumed(J.consumed(J.finished(_jobs(t), told, _as_of()), 2, "news")[1], 4, "news")[1]
    return after.select("job_id", "status", "result", "error", "finished_at")


@query("batch_buckets", f"""SELECT event_id AS batch_id, CASE WHEN event_id % 5 = 0 AND ts < {_AT} - INTERVAL 30 MINUTE THEN 'stale' WHEN event_id % 5 IN (0, 1) THEN 'pending' WHEN event_id % 5 = 2 THEN 'active' WHEN event_id % 5 = 3 AND user_id % 4 < 3 THEN 'retry' ELSE 'done' END AS bucket,
  CASE WHEN event_id % 5 = 4 THEN CASE user_id % 3 WHEN 0 THEN 'facts' WHEN 1 THEN 'summary' END END AS next_stage FROM events""")
def batch_buckets(t):
    k, u = F.col("event_id") % 5, F.col("user_id")
    b = t.events.select(
        F.col("event_id").alias("batch_id"), F.col("ts").alias("updated_at"), F.when(k == 0, "creating").when(k == 1, "pending").when(k == 2, "processing").when(k == 3, "failed").otherwise("completed").alias("status"),
        (u % 4).alias("retry_count"), F.lit(3).alias("max_retries"), F.when(u % 3 == 0, "content").when(u % 3 == 1, "knowledge").otherwise("summary").alias("stage"),
    )
    return J.batch_buckets(b, _as_of()).select("batch_id", "bucket", "next_stage")


@query("given_up", "SELECT event_type AS stage, user_id AS article_id, count(*) AS attempts FROM events WHERE event_type = 'error' GROUP BY ALL HAVING count(*) >= 3")
def given_up(t):
    return J.given_up(t.events.where("event_type = 'error'").select(F.col("event_type").alias("stage"), F.col("user_id").alias("article_id")), 3)


@query("stages_left", "SELECT doc_id AS article_id, CASE doc_id % 3 WHEN 0 THEN 'content' WHEN 1 THEN 'facts' END AS next_stage FROM documents")
def stages_left(t):
    ids = t.documents.select(F.col("doc_id").alias("article_id"))
    done = ids.where("article_id % 3 > 0").withColumn("stage", F.lit("content")).union(ids.where("article_id % 3 = 2").withColumn("stage", F.lit("facts")))
    return J.stages_left(done, ids, ["content", "facts"])


@query("stage_progress", "SELECT lang, round(count(*) FILTER (doc_id % 3 = 0)::DOUBLE / count(*), 6) AS share, round(count(*) FILTER (doc_id % 3 = 0)::DOUBLE / 60, 6) AS rate, round(count(*) FILTER (doc_id % 3 <> 0) / (count(*) FILTER (doc_id % 3 = 0)::DOUBLE / 60), 4) AS seconds_left FROM documents GROUP BY lang")
def stage_progress(t):
    per = t.documents.groupBy("lang").agg(F.count_if(F.col("doc_id") % 3 == 0).alias("done"), F.count("*").alias("total"))
    share, rate, left = J.progress(F.col("done"), F.col("total"), F.lit(60.0))
    return per.select("lang", F.round(share, 6).alias("share"), F.round(rate, 6).alias("rate"), F.round(left, 4).alias("seconds_left"))


@query("stage_checkpoint", "SELECT doc_id AS article_id FROM documents WHERE doc_id % 4 <> 2")
def stage_checkpoint(t):
    ids = t.documents.select(F.col("doc_id").alias("article_id"))
    return J.stage_completion(ids.where("article_id % 4 = 2").withColumn("stage", F.lit("facts")), ids, "facts")
