"""URL filter: host-suffix and path-prefix expressions against a rule list, by short hash prefixes.

Each URL is expanded into (host suffix + path prefix) expressions. Expressions and rules meet on the first
eight hex digits of SHA-256; the full digest and the text are then confirmed, and the longest rule wins (ties:
longer host, then block before allow). Only built-in functions are used.

Rules are (host, path, verdict). A rule fits its host and every subdomain where the URL's path starts with the
rule's path. Prefix lengths that no rule has are not expanded, since nothing could match them.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets the default verdict;
an empty rule list gives every page the default; repeated pages each keep a row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import ascii_lower, literal_rows, read

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT_VERDICT = "allow"
BROADCAST_RULES = 200_000  # above so many rules, the join is shuffled
PREFIX_DIGITS = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Verdict for every row of pages(page_id, url) under rules(host, path, verdict)."""
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null and verdict is not null")
    listed = rules.select(
        F.concat("host", "path").alias("rule"),
        F.length("host").alias("host_length"),
        F.col("verdict").alias("rule_verdict"),
        F.sha2(F.concat_ws("\x00", "host", "path"), 256).alias("digest"),
    ).withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    shape = rules.select(F.length("path").alias("n"), F.col("path").endswith("/").alias("slash")).distinct()
    sizes = shape.agg(
        F.array_sort(F.collect_set(F.when(F.col("slash"), F.col("n")))).alias("slash"),
        F.array_sort(F.collect_set(F.when(~F.col("slash"), F.col("n")))).alias("other"),
    ).first()
    labels = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0

    def lengths(found: list[int]) -> Column:
        return F.array(*map(F.lit, found)).cast("array<int>") if found else F.expr("cast(array() as array<int>)")

    host, path = split_url(F.col("url"))
    urls = pages.select(F.col("page_id"), host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    parts = F.split(F.col("host"), r"\.", -1)
    first = F.greatest(F.lit(1), F.size(parts) - labels + 1)
    suffixes = F.transform(F.sequence(first, F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fits = F.concat(
        F.filter(lengths(sizes["slash"]), lambda n: F.col("path").substr(n, F.lit(1)) == "/") if sizes["slash"] else lengths([]),
        F.filter(lengths(sizes["other"]), lambda n: n <= F.length("path")),
    )
    prefixes = F.transform(fits, lambda n: F.col("path").substr(F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.sha2(F.concat_ws("\x00", s, p), 256))))
    expressions = urls.withColumn("expression", F.explode_outer(pairs)).withColumn("short", F.substring("expression", 1, PREFIX_DIGITS))
    table = F.broadcast(listed) if listed.count() <= broadcast_rules else listed
    met = expressions.join(table, "short", "left")
    confirmed = F.when(
        F.col("digest") == F.col("expression"),
        F.struct(
            F.length("rule").alias("length"),
            F.col("host_length"),
            (F.col("rule_verdict") == "block").alias("block"),
            F.col("rule"),
            F.col("rule_verdict"),
        ),
    )
    best = met.groupBy("row", "page_id", "host", "path").agg(F.max(confirmed).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = literal_rows(spark, RULES, ["host", "path", "verdict"], ["string"] * 3)
    return judge_urls(read(spark, sf_dir, "pages"), rules)


QUERIES = {"op9_url_rules": op9_url_rules}

_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE = {
    "op9_url_rules": f"""
WITH rules(rh, rp, rv) AS (VALUES {_VALUES}),
rest AS (SELECT page_id, row_number() OVER () AS rn, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, rn, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
met AS (SELECT p.*, rh || rp AS rule, rv, row_number() OVER (PARTITION BY rn ORDER BY length(rh || rp) DESC NULLS LAST, length(rh) DESC, rv DESC) AS k
  FROM parts p LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(rv, '{DEFAULT_VERDICT}') AS verdict FROM met WHERE k = 1"""
}
