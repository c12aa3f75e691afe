"""Sources: typed scans, tagged unions, and nested or marked-up payloads to rows (A1-A14, A17-A19, F14, F28; feeds and sitemaps are in feeds).

JSON and regular-expression work stays on the JVM. HTML, recursive JSON and repair of broken JSON have no built-in, and
run as Arrow-batched functions; each yields rows for one payload at a time, so memory follows the largest payload.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.text import feed_date, squeezed
from fieldlens.operators.providers import SEASON_COLUMNS, filter_first_present

WEEK_COLUMNS = ["week", "week_number", "game_week"]


def scan(spark: SparkSession, path: str, season: int | None = None, week: int | None = None, schema: T.StructType | None = None, form: str = "parquet") -> DataFrame:
    """A table with season and week as predicates on whichever columns it has; they reach the scan or its partitions."""
    reader = spark.read.format(form)
    df = (reader.schema(schema) if schema is not None else reader).load(path)
    return filter_first_present(filter_first_present(df, season, SEASON_COLUMNS), week, WEEK_COLUMNS)


def tagged_union(frames: dict[str, DataFrame], tag: str = "stat_type", week: int | None = None) -> DataFrame:
    """A10: tables of different columns on end, each with its name."""
    out = None
    for name, df in frames.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return filter_first_present(out, week, WEEK_COLUMNS)


_INJURY_SCHEMA = """struct<injuries: array<struct<team: struct<displayName: string, abbreviation: string>, displayName: string, injuries: array<struct<
  athlete: struct<id: string, displayName: string>, status: string, date: string, shortComment: string,
  type: struct<description: string, name: string>, details: struct<type: string, fantasyStatus: struct<description: string>>>>>>>"""


def nested_injuries(payloads: DataFrame, name: str = "payload") -> DataFrame:
    """injuries[].injuries[] of a JSON payload to rows; the injury is the first of several fields that is there."""
    parsed = payloads.withColumn("j", F.from_json(name, _INJURY_SCHEMA)).select(F.explode("j.injuries").alias("t"))
    rows = parsed.select(F.coalesce("t.team.displayName", "t.displayName").alias("team_name"), F.col("t.team.abbreviation").alias("team_abbr"), F.explode("t.injuries").alias("i"))
    kind = F.coalesce("i.details.type", "i.type.description", "i.type.name", "i.shortComment")
    return rows.select("team_name", "team_abbr", F.col("i.athlete.displayName").alias("player_name"), F.col("i.athlete.id").alias("source_player_id"), kind.alias("injury"), F.col("i.status").alias("game_status"), F.col("i.date").alias("last_update"))


def preferred(first: DataFrame, second: DataFrame) -> DataFrame:
    """The first source's rows, or the second's where the first has none."""
    return first.unionByName(second.join(F.broadcast(first.agg((F.count("*") == 0).alias("__none"))), F.col("__none")).drop("__none"))


def _walk(value: Any, keys: set[str], path: str = "$") -> Iterator[tuple[str, dict]]:
    stack = [(path, value)]
    while stack:
        at, here = stack.pop()
        if isinstance(here, dict):
            if keys & here.keys():
                yield at, here
            stack += [(f"{at}.{k}", v) for k, v in reversed(here.items())]
        elif isinstance(here, list):
            stack += [(f"{at}[{i}]", v) for i, v in reversed(list(enumerate(here)))]


def nodes_with(payloads: DataFrame, id_col: str, name: str, keys: list[str]) -> DataFrame:
    """Every object at any depth of a JSON payload that has one of some keys: its path and its JSON."""
    wanted = set(keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ident, text in zip(batch[id_col], batch[name]):
                try:
                    rows = [(ident, p, json.dumps(o, ensure_ascii=False)) for p, o in _walk(json.loads(text or "null"), wanted)]
                except ValueError:
                    rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["id", "path", "node"])

    kind = dict(payloads.dtypes)[id_col]
    return payloads.select(id_col, name).mapInPandas(run, f"id {kind}, path string, node string")


class _Tables(HTMLParser):
    """Rows of cell texts of each table, with the caption or heading before it."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[int, str, list[str]]] = []
        self.table, self.heading, self.cells, self.text, self.in_heading = -1, "", None, None, False

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table += 1
        elif tag == "tr":
            self.cells = []
        elif tag in ("td", "th"):
            self.text = []
        elif tag in ("h1", "h2", "h3", "h4", "caption"):
            self.in_heading, self.heading = True, ""

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.text is not None:
            if self.cells is not None:
                self.cells.append(" ".join("".join(self.text).split()))
            self.text = None
        elif tag == "tr" and self.cells is not None:
            if self.cells:
                self.rows.append((self.table, " ".join(self.heading.split()), self.cells))
            self.cells = None
        elif tag in ("h1", "h2", "h3", "h4", "caption"):
            self.in_heading = False

    def handle_data(self, data):
        if self.text is not None:
            self.text.append(data)
        elif self.in_heading:
            self.heading += data


def html_tables(pages: DataFrame, id_col: str, name: str, columns: dict[str, list[str]]) -> DataFrame:
    """Rows of HTML tables by header names: columns maps an output to the fragments that its header may hold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ident, html in zip(batch[id_col], batch[name]):
                parser = _Tables()
                parser.feed(html or "")
                heads: dict[int, dict[str, int]] = {}
                for table, heading, cells in parser.rows:
                    if table not in heads:
                        low = [c.lower() for c in cells]
                        heads[table] = {o: next((i for i, c in enumerate(low) if any(f in c for f in fs)), -1) for o, fs in columns.items()}
                    elif any(i >= 0 for i in heads[table].values()):
                        out.append((ident, heading, *(cells[i] if 0 <= i < len(cells) else None for i in heads[table].values())))
            yield pd.DataFrame(out, columns=["id", "heading", *columns])

    kind = dict(pages.dtypes)[id_col]
    return pages.select(id_col, name).mapInPandas(run, f"id {kind}, heading string, " + ", ".join(f"`{c}` string" for c in columns))


ARTICLE_TYPES = ["Story", "HeadlineNews"]


def api_articles(payloads: DataFrame, name: str = "payload", types: list[str] | None = None) -> DataFrame:
    """Articles of JSON payloads of a supported type with a web link; tags are their categories."""
    schema = "struct<articles: array<struct<type: string, headline: string, description: string, published: string, links: struct<web: struct<href: string>>, categories: array<struct<description: string>>>>>"
    rows = payloads.select(F.explode(F.from_json(name, schema)["articles"]).alias("a"))
    out = rows.select("a.type", F.col("a.links.web.href").alias("url"), F.col("a.headline").alias("title"), "a.description", feed_date(F.col("a.published")).alias("published"), F.filter(F.transform("a.categories", lambda c: c["description"]), lambda d: d.isNotNull()).alias("tags"))
    return out.where(F.col("type").isin(*(types or ARTICLE_TYPES)) & F.col("url").rlike("^https?://"))


class _Article(HTMLParser):
    """Paragraphs, quotes and title; the part inside article or main is preferred."""

    SKIP = {"script", "style", "nav", "noscript"}

    def __init__(self) -> None:
        super().__init__()
        self.title, self.found = "", {"article": ([], []), "main": ([], []), "body": ([], [])}
        self.open: list[str] = []
        self.parts: dict[str, list[str]] = {}

    def _close(self, tag: str) -> None:
        text = " ".join("".join(self.parts.pop(tag, [])).split())
        if text and tag in ("p", "blockquote"):
            for place in ("article", "main", "body"):
                if place == "body" or place in self.open:
                    self.found[place][tag == "blockquote"].append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "p" and "p" in self.parts:
            self._close("p")
        if tag in ("p", "blockquote", "title"):
            self.parts[tag] = []
        if tag in self.SKIP or tag in ("article", "main"):
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag == "title":
            self.title = self.title or " ".join("".join(self.parts.pop("title", [])).split())
        if tag in ("article", "main", "body", "div", "section") and "p" in self.parts:
            self._close("p")
        if tag in ("p", "blockquote"):
            self._close(tag)
        if tag in self.open:
            self.open.remove(tag)

    def handle_data(self, data):
        if not any(t in self.SKIP for t in self.open):
            for tag in self.parts:
                self.parts[tag].append(data)


def html_articles(pages: DataFrame, id_col: str = "page_id", name: str = "html") -> DataFrame:
    """Title, paragraphs and quotes of pages, from article, else main, else body."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ident, html in zip(batch[id_col], batch[name]):
                parser = _Article()
                parser.feed(html or "")
                parser.close()
                if "p" in parser.parts:
                    parser._close("p")
                texts, quotes = next((f for f in (parser.found[p] for p in ("article", "main", "body")) if f[0]), ([], []))
                out.append((ident, parser.title or None, texts, quotes))
            yield pd.DataFrame(out, columns=[id_col, "title", "paragraphs", "quotes"])

    kind = dict(pages.dtypes)[id_col]
    return pages.select(id_col, name).mapInPandas(run, f"{id_col} {kind}, title string, paragraphs array<string>, quotes array<string>")


def meta_tags(html: Column) -> dict[str, Column]:
    """Title, description, author, date and language from meta tags, the first that is there."""

    def tag(*names: str) -> Column:
        found = []
        for n in names:
            for a, b in (("(?:name|property|itemprop)", "content"), ("content", "(?:name|property|itemprop)")):
                pattern = rf"(?is)<meta\b[^>]*\b{a}=[\"']{n}[\"'][^>]*\b{b}=[\"']([^\"']*)[\"']" if b == "content" else rf"(?is)<meta\b[^>]*\b{a}=[\"']([^\"']*)[\"'][^>]*\b{b}=[\"']{n}[\"']"
                found.append(F.nullif(squeezed(F.regexp_extract(html, pattern, 1)), F.lit("")))
        return F.coalesce(*found)

    return {
        "title": F.coalesce(tag("og:title", "twitter:title"), F.nullif(squeezed(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))),
        "description": tag("og:description", "twitter:description", "description"),
        "author": tag("author", "article:author"),
        "published": feed_date(tag("article:published_time", "datePublished", "date")),
        "language": F.nullif(F.regexp_extract(html, r"(?is)<html\b[^>]*\blang=[\"']([^\"']+)[\"']", 1), F.lit("")),
    }


def _repaired(text: str) -> list | None:
    """A JSON list of facts from a reply that may be fenced, hold control characters or break off."""
    body = re.sub(r"^\s*```(?:json)?|```\s*$", "", text or "", flags=re.IGNORECASE)
    body = re.sub(r"[\x00-\x1f]", " ", body)
    start = min((i for i in (body.find("{"), body.find("[")) if i >= 0), default=-1)
    if start < 0:
        return None
    body = body[start:]
    decoder = json.JSONDecoder()
    stack, quoted, escaped, safe = [], False, False, []
    try:
        return _facts_of(decoder.raw_decode(body)[0])
    except ValueError:
        pass
    for i, c in enumerate(body):  # places where the text may be cut and closed
        if quoted:
            quoted, escaped = (c != '"' or escaped), (c == "\\" and not escaped)
            if not quoted:
                safe.append((i + 1, "".join(reversed(stack))))
        elif c == '"':
            quoted, escaped = True, False
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
        elif c in "}]" and stack:
            stack.pop()
            safe.append((i + 1, "".join(reversed(stack))))
    for at, closing in reversed(safe[-200:]):
        try:
            return _facts_of(json.loads(body[:at] + closing))
        except ValueError:
            continue
    return None


def _facts_of(value: Any) -> list | None:
    if isinstance(value, dict):
        value = value.get("facts", value.get("items"))
    if not isinstance(value, list):
        return None
    texts = [v.get("fact", v.get("text")) if isinstance(v, dict) else v for v in value]
    return [t.strip() for t in texts if isinstance(t, str) and t.strip()]


def parsed_facts(c: Column) -> Column:
    """the facts of a reply: well-formed replies on the JVM, others through repair."""

    @F.pandas_udf("array<string>")
    def repaired_facts(texts: pd.Series) -> pd.Series:
        return texts.map(_repaired)

    good = F.from_json(c, "struct<facts: array<string>>")["facts"]
    return F.coalesce(F.when(c.startswith("{"), good), repaired_facts(c))


def flattened(docs: DataFrame, id_col: str, name: str) -> DataFrame:
    """the texts of a nested JSON document with their paths; texts of one list share a path."""

    def texts(value: Any, path: str) -> Iterator[tuple[str, str]]:
        if isinstance(value, str):
            yield path, value
        elif isinstance(value, dict):
            for k, v in value.items():
                yield from texts(v, f"{path}.{k}" if path else k)
        elif isinstance(value, list):
            for i, v in enumerate(value):
                yield from texts(v, path if isinstance(v, str) else f"{path}[{i}]")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for ident, text in zip(batch[id_col], batch[name]):
                try:
                    out += [(ident, i, p, s) for i, (p, s) in enumerate(texts(json.loads(text or "null"), ""))]
                except ValueError:
                    continue
            yield pd.DataFrame(out, columns=["id", "seq", "path", "text"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, name).mapInPandas(run, f"id {kind}, seq int, path string, text string")
