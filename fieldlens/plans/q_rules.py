"""Queries of family H."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldlens.operators import rules as H
from fieldlens.plans.q_text import _SENT, claims
from fieldlens.plans.registry import query


def _any(c: str, words: list[str]) -> str:
    return f"regexp_matches({c}, '{'|'.join(words)}')"


_PRIORITY = f"""raw AS (SELECT *, CASE kind WHEN 'roster' THEN 0.75 WHEN 'event' THEN 0.65 WHEN 'statistic' THEN 0.7 WHEN 'factual' THEN 0.55 WHEN 'quote' THEN 0.2 ELSE 0.4 END::DOUBLE
  + CASE WHEN {_any('l', H.TRANSACTION_WORDS)} THEN 0.18 ELSE 0 END::DOUBLE + CASE WHEN {_any('l', H.STATUS_WORDS)} THEN 0.12 ELSE 0 END::DOUBLE + CASE WHEN regexp_matches(s, '\\d') THEN 0.08 ELSE 0 END::DOUBLE
  + CASE WHEN regexp_matches(s, '\\d') AND {_any('l', H.PERFORMANCE_WORDS)} THEN 0.12 ELSE 0 END::DOUBLE + CASE WHEN {_any('l', H.TIME_WORDS)} THEN 0.05 ELSE 0 END::DOUBLE + CASE WHEN contains(l, 'chiefs') THEN 0.05 ELSE 0 END::DOUBLE AS p FROM claims),
  priced AS (SELECT doc_id, s, kind, round(least(1.0, CASE WHEN kind = 'quote' THEN p * 0.4::DOUBLE ELSE p END), 6) AS priority FROM raw)"""


def _priced(t):
    c = claims(t)
    return c.withColumn("priority", F.round(H.claim_priority(F.col("sentence"), F.col("kind"), ["chiefs"]), 6))


@query("claim_priority", f"WITH {_SENT}, {_PRIORITY} SELECT doc_id, s AS sentence, kind, priority FROM priced")
def claim_priority(t):
    return _priced(t).select("doc_id", "sentence", "kind", "priority")


@query("claim_selection", f"WITH {_SENT}, {_PRIORITY}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id % 50, priority >= 0.45 ORDER BY priority DESC, doc_id, s) AS r FROM priced) SELECT doc_id, s AS sentence, CASE WHEN priority < 0.45 THEN 'low' WHEN r <= 10 THEN 'selected' ELSE 'overflow' END AS bucket FROM r")
def claim_selection(t):
    c = _priced(t).withColumn("article", F.col("doc_id") % 50).withColumn("seq", F.struct("doc_id", "sentence"))
    return H.claim_buckets(c, "article", "seq").select("doc_id", "sentence", "bucket")


_CHECKS = "checks AS (SELECT source, doc_id, CASE doc_id % 5 WHEN 0 THEN 'contradicted' WHEN 1 THEN 'error' ELSE 'verified' END AS outcome, (doc_id % 10)::DOUBLE / 10 AS confidence, (doc_id % 7)::DOUBLE / 6 AS match, doc_id % 3 = 0 AS transaction, doc_id % 7 >= 3 OR doc_id % 11 = 0 AS is_match, CASE doc_id % 20 WHEN 7 THEN 'team' ELSE 'player' END AS kind, 'A' || (doc_id % 400) AS article FROM documents)"


def _checks(t):
    k = F.col("doc_id")
    return t.documents.select(
        "source", "doc_id", F.when(k % 5 == 0, "contradicted").when(k % 5 == 1, "error").otherwise("verified").alias("outcome"), ((k % 10).cast("double") / 10).alias("confidence"), ((k % 7).cast("double") / 6).alias("match"),
        (k % 3 == 0).alias("transaction"), ((k % 7 >= 3) | (k % 11 == 0)).alias("is_match"), F.concat(F.lit("A"), (k % 400).cast("string")).alias("article"), F.when(k % 20 == 7, "team").otherwise("player").alias("kind"),
    )


_ARTICLES = "articles AS (SELECT 'A' || x AS article, x % 2 AS claims FROM range(450) r(x))"


def _articles(t):
    return t.spark.range(450).select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("article"), (F.col("id") % 2).alias("claims"))


@query("factual_dimension", f"WITH {_CHECKS}, {_ARTICLES}, c AS (SELECT article, count(*) AS n, count(*) FILTER (outcome = 'contradicted') AS bad, avg(CASE WHEN outcome = 'error' THEN 0 ELSE confidence END) AS conf FROM checks GROUP BY article) SELECT article, coalesce(round(1 - bad::DOUBLE / n, 6), 1) AS score, CASE WHEN n IS NULL THEN CASE claims WHEN 0 THEN 1.0 ELSE 0.7 END::DOUBLE ELSE round(conf, 6) END AS confidence, coalesce(bad = 0, true) AS passed FROM articles LEFT JOIN c USING (article)")
def factual_dimension(t):
    return H.factual_dimension(_checks(t), "article", _articles(t))


@query("quality_dimension", f"""WITH {_CHECKS}, {_ARTICLES}, w AS (SELECT article, outcome, confidence, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE (doc_id % 4)::DOUBLE + 1 END AS weight FROM checks),
  q AS (SELECT article, round(coalesce(sum(CASE WHEN outcome <> 'contradicted' THEN weight ELSE 0 END) / nullif(sum(weight), 0), 1), 6) AS score, round(coalesce(sum(CASE WHEN outcome <> 'error' THEN confidence * weight ELSE 0 END) / nullif(sum(weight), 0), 0), 6) AS confidence,
  count(*) FILTER (outcome = 'contradicted') AS violations, count(*) FILTER (outcome = 'error') AS errors, count(*) AS rules FROM w GROUP BY article)
  SELECT article, coalesce(score, 1) AS score, coalesce(confidence, 0) AS confidence, coalesce(violations = 0, true) AS passed, coalesce(violations, 0) AS violations, coalesce(errors, 0) AS errors, coalesce(rules, 0) AS rules FROM articles LEFT JOIN q USING (article)""")
def quality_dimension(t):
    """Rules of different weights, some without any, some in error; articles without rules."""
    weight = F.when(F.col("doc_id") % 9 == 0, 0.0).otherwise((F.col("doc_id") % 4).cast("double") + 1)
    rules = _checks(t).withColumn("outcome", F.when(F.col("outcome") == "contradicted", "failed").otherwise(F.col("outcome"))).withColumn("weight", weight)
    return H.quality_dimension(rules, "article", _articles(t))


@query("contextual_dimension", f"""WITH {_CHECKS}, {_ARTICLES}, e AS (SELECT article, CASE WHEN outcome = 'error' THEN 1.0 WHEN NOT is_match AND transaction THEN greatest(match, 0.75) ELSE match END AS v, outcome <> 'error' AND NOT is_match AND NOT transaction AS wrong, kind FROM checks),
  d AS (SELECT article, round(avg(v), 6) AS score, round(avg(v), 6) AS confidence, count(*) FILTER (wrong) AS mismatches, bool_or(wrong AND kind = 'team') AS critical FROM e GROUP BY article)
  SELECT article, coalesce(score, 1) AS score, coalesce(confidence, 0) AS confidence, coalesce(mismatches, 0) AS mismatches, coalesce(critical, false) AS critical, coalesce(score, 1) >= 0.7 AS passed FROM articles LEFT JOIN d USING (article)""")
def contextual_dimension(t):
    return H.contextual_dimension(_checks(t), "article", _articles(t))


@query("decision", """WITH d AS (SELECT doc_id AS article, unnest(['factual', 'quality']) AS dimension, unnest([doc_id % 9 <> 4, true]) AS enabled, unnest([(doc_id % 10)::DOUBLE / 10, 0.9]) AS score, unnest([doc_id % 7 <> 0, true]) AS passed,
  unnest([CASE doc_id % 6 WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' END, CASE WHEN doc_id % 11 = 3 THEN 'warning' END]) AS worst FROM documents),
  r AS (SELECT *, list_concat(CASE WHEN worst = 'critical' THEN [dimension || ': critical issue'] ELSE [] END, CASE WHEN score < 0.3 THEN [dimension || ': score below threshold'] WHEN NOT passed THEN [dimension || ': checks did not pass'] ELSE [] END) AS r FROM d WHERE enabled),
  g AS (SELECT article, list_sort(flatten(list(r))) AS reasons, coalesce(bool_or(worst = 'warning'), false) AS warned FROM r GROUP BY article)
  SELECT article, CASE WHEN len(reasons) > 0 THEN 'reject' WHEN warned THEN 'review_required' ELSE 'release' END AS decision, array_to_string(reasons, '; ') AS reasons FROM g""")
def decision(t):
    k = F.col("doc_id")
    one = lambda name, enabled, score, passed, worst: F.struct(F.lit(name).alias("dimension"), enabled.alias("enabled"), score.alias("score"), passed.alias("passed"), worst.alias("worst"))
    factual = one("factual", k % 9 != 4, (k % 10).cast("double") / 10, k % 7 != 0, F.when(k % 6 == 0, "critical").when(k % 6 == 1, "warning"))
    quality = one("quality", F.lit(True), F.lit(0.9), F.lit(True), F.when(k % 11 == 3, "warning"))
    rows = t.documents.select(k.alias("article"), F.inline(F.array(factual, quality))).withColumn("threshold", F.lit(0.3))
    return H.decision(rows, "article").withColumn("reasons", F.array_join("reasons", "; "))


_CAND = """cand AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN 'Chiefs news photo' WHEN 1 THEN 'A logo' WHEN 2 THEN 'Game day' ELSE '' END AS title, CAST(page_id % 900 AS INT) AS width, CAST(page_id % 500 AS INT) AS height, CAST(page_id % 60 * 1000 AS INT) AS byte_size,
  CASE page_id % 3 WHEN 0 THEN 'CC BY' WHEN 1 THEN 'Getty stock' ELSE '' END AS license FROM pages)"""


def _candidates(t):
    k = F.col("page_id")
    return t.pages.select(
        "page_id", "url", F.when(k % 4 == 0, "Chiefs news photo").when(k % 4 == 1, "A logo").when(k % 4 == 2, "Game day").otherwise("").alias("title"), (k % 900).cast("int").alias("width"), (k % 500).cast("int").alias("height"),
        (k % 60 * 1000).cast("int").alias("byte_size"), F.when(k % 3 == 0, "CC BY").when(k % 3 == 1, "Getty stock").otherwise("").alias("license"), F.lit(None).cast("string").alias("context_url"),
    )


@query("candidate_filters", f"""WITH {_CAND} SELECT page_id FROM cand WHERE NOT contains(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), 'example.org') AND NOT contains(lower(title), 'logo') AND NOT regexp_matches(lower(url), '/fr/')
  AND (width = 0 OR height = 0 OR width >= 100 AND height >= 50) AND (byte_size = 0 OR byte_size >= 5000) AND license = 'CC BY'""")
def candidate_filters(t):
    return H.candidates_kept(_candidates(t), ["example.org"], ["logo"], ["/fr/"], 100, 50, 5000).select("page_id")


@query("candidate_score", f"""WITH {_CAND}, s AS (SELECT page_id, width, height, 3.5 * CASE page_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END + 6 * CASE page_id % 4 WHEN 0 THEN 1 ELSE 0 END + CASE page_id % 4 WHEN 0 THEN 3 ELSE 0 END + CASE page_id % 4 WHEN 0 THEN 0.5 ELSE 0 END + 1.5
  + CASE WHEN width >= 100 AND height >= 50 THEN CASE WHEN width / greatest(height, 1) BETWEEN 1.3 AND 2.5 THEN 2.5 ELSE 2 END ELSE 0 END AS score FROM cand) SELECT page_id, round(score::DOUBLE, 6) AS score FROM s""")
def candidate_score(t):
    return H.candidate_score(_candidates(t), F.lit("The Chiefs won a game; photo inside"), "chiefs", 100, 50).select("page_id", "score")


@query("candidate_terms", f"WITH {_CAND} SELECT page_id FROM cand WHERE contains(lower(title || ' ' || url), 'chiefs') OR contains(lower(title || ' ' || url), '/de/')")
def candidate_terms(t):
    return H.trusted(H.with_terms(_candidates(t), ["chiefs", "/de/"]), 0.4).select("page_id")


@query("stored_paths", "SELECT page_id, 'images/' || md5(url) || '.jpg' AS path FROM pages")
def stored_paths(t):
    return t.pages.select("page_id", H.stored_path(F.col("url"), "images", ".jpg").alias("path"))


@query("article_rules", """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'missing: headline, sub_header' WHEN 1 THEN 'no paragraph' WHEN 2 THEN 'short paragraph' WHEN 3 THEN 'team not named' END AS error FROM documents""")
def article_rules(t):
    k = F.col("doc_id") % 5
    long = F.lit("one two three four five six seven eight nine ten")
    body = F.when(k == 1, F.array().cast("array<string>")).when(k == 2, F.array(long, F.lit("too short"))).otherwise(F.array(long))
    rows = t.documents.select("doc_id", F.when(k == 0, " ").otherwise("The Chiefs win").alias("headline"), F.when(k != 0, "sub").alias("sub_header"), F.lit("intro").alias("introduction"), body.alias("content"), F.when(k == 3, "Bears").otherwise("chiefs").alias("team_name"))
    return rows.select("doc_id", H.article_error(rows).alias("error"))


@query("translation_checks", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'paragraph count' WHEN 1 THEN 'lost: Reid' ELSE '' END AS issues FROM documents")
def translation_checks(t):
    k = F.col("doc_id") % 3
    source = F.array(F.lit("a"), F.lit("b"))
    target = F.when(k == 0, F.array(F.lit("Mahomes Reid"))).when(k == 1, F.array(F.lit("Mahomes"), F.lit("x"))).otherwise(F.array(F.lit("Reid"), F.lit("Mahomes")))
    return t.documents.select("doc_id", F.array_join(H.translation_issues(source, target, F.array(F.lit("Mahomes"), F.lit("Reid"))), "; ").alias("issues"))


@query("run_totals", "SELECT unnest(['a', 'b']) AS stage, unnest([CAST(count(*) AS DOUBLE), round(sum((doc_id % 5)::DOUBLE), 4)]) AS seconds, unnest([count(*), count(*)]) AS n FROM documents")
def run_totals(t):
    runs = t.documents.select(F.lit(1).alias("articles"), F.lit(0).alias("errors"), F.create_map(F.lit("a"), F.lit(1.0), F.lit("b"), (F.col("doc_id") % 5).cast("double")).alias("durations"))
    return H.run_metrics(runs)[1]
