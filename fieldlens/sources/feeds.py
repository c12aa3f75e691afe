"""News feeds and sitemaps (A15, A16, G5): XML payloads to rows by Spark's own XML parser.

``from_xml`` resolves entities, CDATA and comments; the schema names what is read, so other elements cost nothing. Three readings are tried, each only
where the one before found no item: names as they stand (so that media:title is no title), names without prefixes (feeds whose own elements have one), and a mended text
(stray ampersands, a feed that breaks off after some whole items). RSS 0.9x, 1.0, 2.0 and Atom share one schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.functions.text import feed_date, once

FEED_ENTRIES, SITEMAP_ENTRIES = 1000, 5000
SITEMAP_SPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"

_TEXTS = ["title", "description", "summary", "content:encoded", "encoded", "dc:creator", "creator", "dc:subject", "subject"]
_MOMENTS = ["pubDate", "published", "dcterms:issued", "issued", "updated", "dc:date", "date", "dcterms:modified", "modified", "created", "dcterms:created"]
_ITEM = ", ".join([
    "link: array<struct<_VALUE: string, _href: string, _rel: string>>", "guid: struct<_VALUE: string, _isPermaLink: string>", "author: array<struct<_VALUE: string, name: string, email: string>>",
    "category: array<struct<_VALUE: string, _term: string>>", "content: array<struct<_VALUE: string>>", *(f"`{n}`: array<string>" for n in _TEXTS), *(f"`{n}`: string" for n in _MOMENTS),
])
_FEED = f"struct<channel: struct<item: array<struct<{_ITEM}>>>, item: array<struct<{_ITEM}>>, entry: array<struct<{_ITEM}>>>"
_MAP = "struct<url: array<struct<loc: string, lastmod: string, news: struct<title: string, publication_date: string>>>>"


def _items(xml: Column, prefixes: bool) -> Column:
    """The items of a feed, or null if it has none."""
    parsed = F.from_xml(xml, _FEED, {"ignoreNamespace": str(not prefixes).lower()})
    return once(parsed, lambda j: F.coalesce(*(F.when(F.size(items) > 0, items) for items in (j["channel"]["item"], j["item"], j["entry"]))))


def _mended(xml: Column) -> Column:
    """Ampersands that begin no entity of XML escaped, and what follows the last whole item cut off and closed."""
    plain = F.regexp_replace(xml, r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)", "&amp;")
    whole = lambda tag, end: F.when(F.lower(plain).contains(f"</{tag}>"), F.concat(F.regexp_extract(plain, rf"(?is)^(.*</{tag}>)", 1), F.lit(end)))
    closed = F.when(plain.rlike(r"(?i)</(?:rss|feed|rdf:RDF)\s*>\s*$"), plain)
    return F.coalesce(closed, F.when(F.lower(plain).contains("<channel"), whole("item", "</channel></rss>")), whole("entry", "</feed>"), plain)


def _text(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _first(texts: Column) -> Column:
    """The first text that is not blank."""
    return F.get(F.filter(F.transform(texts, _text), lambda t: t.isNotNull()), F.lit(0))


def recent(published: Column, as_of: Column, days_back: int | None) -> Column:
    """Whether a time lies at most so many days before the day of ``as_of``; undated items count as recent."""
    if days_back is None:
        return F.lit(True)
    age = F.floor((F.unix_seconds(F.date_trunc("day", as_of)) - F.unix_seconds(published)) / 86_400)
    return F.coalesce(age <= days_back, F.lit(True))


def capped(entries: DataFrame, most: int | None, place: bool = False) -> DataFrame:
    """The first entries of each source, with their place (pos) in it if asked for."""
    if most is not None:
        rank = F.row_number().over(Window.partitionBy("source").orderBy("pos"))
        entries = entries.withColumn("__r", rank).where(F.col("__r") <= most).drop("__r")
    return entries if place else entries.drop("pos")


def feed_entries(feeds: DataFrame, name: str = "xml", most: int | None = None, place: bool = False, days_back: int | None = None, as_of: Column | None = None) -> DataFrame:
    """The entries of feeds (source, xml): url, title, description, author, tags, published.

    Of each feed the first ``FEED_ENTRIES`` are read. A link is needed: the link's text, an alternate link's address, or a guid that is one. The
    date is the first that can be read of publication, update and creation. ``most`` counts what is left after that and after ``days_back``.
    """
    items = F.coalesce(_items(F.col(name), True), _items(F.col(name), False), _items(_mended(F.col(name)), True))
    each = feeds.select("source", F.posexplode(F.slice(items, 1, FEED_ENTRIES)).alias("pos", "i"))
    i = lambda field: F.col("i")[field]
    own = F.filter(i("link"), lambda k: F.coalesce(k["_rel"], F.lit("alternate")) == "alternate")
    address = F.coalesce(_first(F.transform(own, lambda k: F.coalesce(_text(k["_VALUE"]), k["_href"]))), F.when(F.coalesce(F.lower(i("guid")["_isPermaLink"]), F.lit("true")) == "true", _text(i("guid")["_VALUE"])))
    author = F.coalesce(_first(F.transform(i("author"), lambda a: F.coalesce(_text(a["name"]), _text(a["_VALUE"]), a["email"]))), _first(i("dc:creator")), _first(i("creator")))
    told = F.coalesce(*(_first(i(t)) for t in ("summary", "description", "content:encoded", "encoded")), _first(F.transform(i("content"), lambda c: c["_VALUE"])))
    none = F.expr("cast(array() as array<string>)")
    terms = F.concat(F.coalesce(F.transform(i("category"), lambda c: F.coalesce(_text(c["_term"]), _text(c["_VALUE"]))), none), F.coalesce(i("dc:subject"), i("subject"), none))
    published = F.coalesce(*(feed_date(i(m)) for m in _MOMENTS))
    out = each.select("source", "pos", address.alias("url"), _first(i("title")).alias("title"), told.alias("description"), author.alias("author"), F.filter(terms, lambda t: t.isNotNull()).alias("tags"), published.alias("published"))
    return capped(out.where(F.col("url").isNotNull() & recent(F.col("published"), F.current_timestamp() if as_of is None else as_of, days_back)), most, place)


def broken(xml: Column) -> Column:
    """Whether a text is no well-formed XML."""
    return F.from_xml(xml, "struct<_broken: string>", {"columnNameOfCorruptRecord": "_broken"})["_broken"].isNotNull()


def sitemap_entries(maps: DataFrame, name: str = "xml", most: int | None = SITEMAP_ENTRIES, place: bool = False, days_back: int | None = None, as_of: Column | None = None) -> DataFrame:
    """The url elements of sitemaps (source, xml), with any prefix, if the sitemap names the protocol's space: url, title, published.

    Of each map the first ``SITEMAP_ENTRIES`` are read; the date is the last change, else the publication.
    """
    named = F.col(name).rlike(rf"xmlns(?::[\w.-]+)?\s*=\s*[\"']{SITEMAP_SPACE}[\"']")
    each = maps.where(named).select("source", F.posexplode(F.slice(F.from_xml(name, _MAP, {"ignoreNamespace": "true"})["url"], 1, SITEMAP_ENTRIES)).alias("pos", "i"))
    published = F.coalesce(feed_date(F.col("i.lastmod")), feed_date(F.col("i.news.publication_date")))
    out = each.select("source", "pos", _text(F.col("i.loc")).alias("url"), _text(F.col("i.news.title")).alias("title"), published.alias("published"))
    return capped(out.where(F.col("url").isNotNull() & recent(F.col("published"), F.current_timestamp() if as_of is None else as_of, days_back)), most, place)


def extracted(sources: DataFrame, payloads: DataFrame, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The items of many sources in the order of the configuration, and how each source fared.

    sources has source, source_order and kind (rss or sitemap); payloads has source, xml and error, a row for each source that was
    asked. A source with an error, without a payload, or with a sitemap that is no XML, fails alone: it gives no items, and all others theirs.
    """
    why = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("xml").isNull(), "missing result").when(F.col("kind") == "sitemap", F.when(broken(F.col("xml")), "invalid xml"))
    asked = sources.join(payloads, "source", "left").withColumn("error", why)
    read = asked.where("error is null")
    feeds = feed_entries(read.where("kind = 'rss'").select("source", "xml"), most=most, place=True).select("source", "pos", "url", "title", "published")
    maps = sitemap_entries(read.where("kind = 'sitemap'").select("source", "xml"), most=most or SITEMAP_ENTRIES, place=True).select("source", "pos", "url", "title", "published")
    items = feeds.unionByName(maps).join(sources.select("source", "source_order"), "source").withColumn("seq", F.struct("source_order", "pos"))
    found = items.groupBy("source").agg(F.count("*").alias("found"))
    outcomes = asked.join(found, "source", "left").select("source", "source_order", F.col("error").isNull().alias("success"), "error", F.coalesce("found", F.lit(0)).alias("found"))
    return items, outcomes
