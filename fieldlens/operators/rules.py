"""Rule scores, checks and decisions (family H)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.text import holds_any, host, lookup, source_score

# Weights of kinds of claims, and what raises a claim's priority.
KIND_WEIGHTS = {"roster": 0.75, "event": 0.65, "statistic": 0.7, "factual": 0.55, "quote": 0.2}
OTHER_WEIGHT, QUOTE_SHARE = 0.4, 0.4
TRANSACTION_WORDS = ["signed", "re-signed", "resigned", "waived", "traded", "acquired", "released", "claimed", "activated", "designated to return"]
STATUS_WORDS = ["injured reserve", "season-ending", "status", "returning", "questionable", "out for", "expected to play"]
PERFORMANCE_WORDS = ["yards", "touchdowns", "receptions", "sacks", "interceptions", "points", "assists", "goals"]
TIME_WORDS = ["this season", "last season", "last year", "this year", "since", "through", "over the past"]
LEAST_PRIORITY, MOST_CLAIMS = 0.45, 10


def claim_priority(text: Column, kind: Column, team_words: list[str]) -> Column:
    """H1: a claim's weight and bonuses, within 0 and 1; quotes count less."""
    low, number = F.lower(text), text.rlike(r"\d")
    bonus = lambda c, v: F.when(c, v).otherwise(0.0)
    score = F.coalesce(lookup(kind, KIND_WEIGHTS), F.lit(OTHER_WEIGHT)) + bonus(holds_any(low, TRANSACTION_WORDS), 0.18) + bonus(holds_any(low, STATUS_WORDS), 0.12) + bonus(number, 0.08)
    score = score + bonus(number & holds_any(low, PERFORMANCE_WORDS), 0.12) + bonus(holds_any(low, TIME_WORDS), 0.05) + bonus(holds_any(low, team_words), 0.05)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(kind == "quote", score * QUOTE_SHARE).otherwise(score)))


def claim_buckets(claims: DataFrame, group: str, seq: str, least: float = LEAST_PRIORITY, most: int = MOST_CLAIMS) -> DataFrame:
    """H2: the best claims of each article are selected, more good ones overflow, the rest is low."""
    good = F.col("priority") >= least
    rank = F.row_number().over(Window.partitionBy(group, good).orderBy(F.desc("priority"), seq))
    return claims.withColumn("__r", rank).withColumn("bucket", F.when(~good, "low").when(F.col("__r") <= most, "selected").otherwise("overflow")).drop("__r")


def factual_dimension(checks: DataFrame, key: str, considered: DataFrame | None = None) -> DataFrame:
    """H3: one less the share of contradicted claims in all that were checked, errors included, and the mean confidence (errors count 0).

    It passes without a contradicted claim. ``considered`` (key, claims) lists articles and their claims before selection: those
    without checks get score 1, with confidence 1 if they had no claim and 0.7 if none was selected.
    """
    contradicted = F.count_if(F.col("outcome") == "contradicted")
    conf = F.coalesce(F.avg(F.when(F.col("outcome") == "error", 0.0).otherwise(F.col("confidence"))), F.lit(0.0))
    out = checks.groupBy(key).agg(F.round(1 - contradicted / F.count("*"), 6).alias("score"), F.round(conf, 6).alias("confidence"), (contradicted == 0).alias("passed"))
    if considered is None:
        return out
    every = considered.select(key, F.col("claims").alias("__claims")).join(out, key, "left")
    alone = F.when(F.col("__claims") == 0, 1.0).otherwise(0.7)
    return every.select(key, F.coalesce("score", F.lit(1.0)).alias("score"), F.coalesce("confidence", alone).alias("confidence"), F.coalesce("passed", F.lit(True)).alias("passed"))


def quality_dimension(rules: DataFrame, key: str, articles: DataFrame | None = None) -> DataFrame:
    """H4: passed weight by all weight, and confidence by weight; rules in error count as passed without confidence, as they prove no violation.

    It passes without a violation. ``articles`` lists articles that may have no rules; these score 1 without confidence.
    """
    share = lambda c, none: F.round(F.coalesce(F.try_divide(F.sum(c), F.sum("weight")), F.lit(none)), 6)
    broken = F.count_if(F.col("outcome") == "failed")
    passed, sure = F.when(F.col("outcome") != "failed", F.col("weight")).otherwise(0.0), F.when(F.col("outcome") != "error", F.col("confidence") * F.col("weight")).otherwise(0.0)
    out = rules.groupBy(key).agg(share(passed, 1.0).alias("score"), share(sure, 0.0).alias("confidence"), (broken == 0).alias("passed"), broken.alias("violations"), F.count_if(F.col("outcome") == "error").alias("errors"), F.count("*").alias("rules"))
    if articles is None:
        return out
    none = {"score": 1.0, "confidence": 0.0, "passed": True, "violations": 0, "errors": 0, "rules": 0}
    return articles.select(key).distinct().join(out, key, "left").select(key, *(F.coalesce(c, F.lit(v)).alias(c) for c, v in none.items()))


LIFTED, CONTEXT_PASS = 0.75, 0.70


def contextual_dimension(checks: DataFrame, key: str, articles: DataFrame | None = None) -> DataFrame:
    """Mean match score (1 for errors), which is the confidence too, passed at 0.7 by itself; a team that does not match is critical, whatever the score.

    checks has kind, is_match, match, transaction and outcome; an accepted transaction turns a mismatch into a match of 0.75 at least.
    ``articles`` lists articles that may have no checks; these score 1 without confidence.
    """
    wrong = ~F.col("is_match") & (F.col("outcome") != "error")
    lifted = F.when(wrong & F.col("transaction"), F.greatest(F.col("match"), F.lit(LIFTED))).otherwise(F.col("match"))
    each = F.when(F.col("outcome") == "error", 1.0).otherwise(lifted)
    left = wrong & ~F.col("transaction")
    out = checks.groupBy(key).agg(F.round(F.avg(each), 6).alias("score"), F.round(F.avg(each), 6).alias("confidence"), F.count_if(left).alias("mismatches"), F.coalesce(F.some((F.col("kind") == "team") & left), F.lit(False)).alias("critical"))
    if articles is not None:
        out = articles.select(key).distinct().join(out, key, "left").select(key, F.coalesce("score", F.lit(1.0)).alias("score"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("mismatches", F.lit(0)).alias("mismatches"), F.coalesce("critical", F.lit(False)).alias("critical"))
    return out.withColumn("passed", F.col("score") >= CONTEXT_PASS)


def decision(dimensions: DataFrame, key: str) -> DataFrame:
    """H5: reject on a critical issue, a low score or failed checks; review on a warning; else release. Disabled dimensions do not count."""
    on = dimensions.where("enabled")
    low = F.col("score") < F.col("threshold")
    reasons = F.concat(
        F.when(F.col("worst") == "critical", F.array(F.concat(F.col("dimension"), F.lit(": critical issue")))).otherwise(F.array().cast("array<string>")),
        F.when(low, F.array(F.concat(F.col("dimension"), F.lit(": score below threshold")))).when(~F.col("passed"), F.array(F.concat(F.col("dimension"), F.lit(": checks did not pass")))).otherwise(F.array().cast("array<string>")),
    )
    per = on.withColumn("r", reasons).groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("r"))).alias("reasons"), F.some(F.col("worst") == "warning").alias("warned"))
    return per.select(key, F.when(F.size("reasons") > 0, "reject").when(F.col("warned"), "review_required").otherwise("release").alias("decision"), "reasons")


# Words in a licence that forbid or allow use.
FORBIDDEN_LICENCES = ["all rights reserved", "copyright", "©", "getty", "shutterstock", "stock"]
ALLOWED_LICENCES = ["creative commons", "cc", "public domain", "public", "sharealike", "share alike", "attribution", "wikimedia"]


def licence_allowed(c: Column) -> Column:
    low = F.lower(c)
    return ~holds_any(low, FORBIDDEN_LICENCES) & holds_any(low, ALLOWED_LICENCES)


def candidates_kept(df: DataFrame, blocked_hosts: list[str], title_words: list[str], url_patterns: list[str], min_width: int, min_height: int, min_bytes: int, licence_needed: bool = True) -> DataFrame:
    """H6: candidates that no block-list, title word, URL pattern, size or licence rules out."""
    h, title, url = host(F.col("url")), F.lower(F.coalesce("title", F.lit(""))), F.lower("url")
    out = df.where(~holds_any(h, blocked_hosts) & ~holds_any(title, title_words))
    if url_patterns:
        out = out.where(~url.rlike("|".join(url_patterns)))
    sized = (F.coalesce("width", F.lit(0)) != 0) & (F.coalesce("height", F.lit(0)) != 0)
    out = out.where(~sized | ((F.col("width") >= min_width) & (F.col("height") >= min_height)))
    out = out.where((F.coalesce("byte_size", F.lit(0)) == 0) | (F.col("byte_size") >= min_bytes))
    has = F.coalesce("license", F.lit("")) != ""
    return out.where(F.when(has, licence_allowed(F.col("license"))).otherwise(F.lit(not licence_needed)))


def candidate_score(df: DataFrame, article: Column, query: str, min_width: int, min_height: int) -> DataFrame:
    """H7: overlap of title with article and query, size and shape, and trust in the source, for every candidate (K5)."""
    title = F.lower(F.coalesce("title", F.lit("")))
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"\w+"), F.lit(0)))
    terms = list(dict.fromkeys(query.lower().split()))
    asked = F.array(*map(F.lit, terms)) if terms else F.expr("cast(array() as array<string>)")
    score = 3.5 * F.size(F.array_intersect(words(title), words(F.lower(article)))) + 6.0 * F.size(F.array_intersect(words(title), asked))
    for term in terms:
        score = score + F.when(F.contains(title, F.lit(term)), 3.0).otherwise(0.0)
    large = (F.col("width") >= min_width) & (F.col("height") >= min_height)
    shape = (F.col("width") / F.greatest("height", F.lit(1))).between(1.3, 2.5)
    score = score + F.when(large & shape, 2.5).when(large, 2.0).otherwise(0.0) + F.when(F.contains(title, F.lit("news")), 0.5).otherwise(0.0)
    score = score + F.when(F.col("url").isNotNull(), source_score(host(F.col("url"))) * 3.0).otherwise(0.0)
    return df.withColumn("score", F.round(F.when(score <= 0, score - 5.0).otherwise(score), 6))


def with_terms(df: DataFrame, terms: list[str]) -> DataFrame:
    """H8: candidates that hold a required term in title or addresses; all where none is required."""
    hay = F.lower(F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("url", F.lit("")), F.coalesce("context_url", F.lit(""))))
    return df.where(holds_any(hay, terms)) if terms else df


def trusted(df: DataFrame, threshold: float) -> DataFrame:
    """H8: candidates whose page or address is trusted enough."""
    return df if threshold <= 0 else df.where(source_score(host(F.coalesce(F.nullif("context_url", F.lit("")), F.col("url")))) >= threshold)


def stored_path(url: Column, prefix: str, suffix: str) -> Column:
    """H9: a path by the content's address."""
    return F.concat(F.lit(f"{prefix}/"), F.md5(url), F.lit(suffix))


def article_error(df: DataFrame) -> Column:
    """The first broken rule of an article (headline, sub_header, introduction, content array, team_name), or null."""
    heads = ["headline", "sub_header", "introduction"]
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    missing = F.array_compact(F.array(*(F.when(blank(c), F.lit(c)) for c in heads)))
    short = F.exists("content", lambda p: F.size(F.filter(F.split(F.trim(p), r"\s+"), lambda w: w != "")) < 10)
    team = F.lower(F.trim(F.coalesce("team_name", F.lit(""))))
    named = (team == "") | F.contains(F.lower(F.concat_ws("\n", *heads)), team)
    return (
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        .when(F.coalesce(F.size("content"), F.lit(0)) <= 0, "no paragraph")
        .when(short, "short paragraph")
        .when(~named, "team not named")
    )


def translation_issues(source: Column, target: Column, terms: Column) -> Column:
    """Another number of paragraphs, and terms that the translation lost."""
    text = F.array_join(target, "\n")
    lost = F.filter(terms, lambda t: ~F.contains(text, t))
    return F.concat(F.when(F.size(source) != F.size(target), F.array(F.lit("paragraph count"))).otherwise(F.array().cast("array<string>")), F.transform(lost, lambda t: F.concat(F.lit("lost: "), t)))


def run_metrics(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals over runs, and seconds by stage from their duration maps."""
    total = runs.agg(F.count("*").alias("runs"), F.sum("articles").alias("articles"), F.sum("errors").alias("errors"))
    stages = runs.select(F.explode("durations").alias("stage", "seconds")).groupBy("stage").agg(F.round(F.sum("seconds"), 4).alias("seconds"), F.count("*").alias("n"))
    return total, stages
