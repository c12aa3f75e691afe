"""Readers and rules by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import text as X
from fieldlens.operators import jobs as J
from fieldlens.operators import rules as H
from fieldlens.operators import snapshots as S
from fieldlens.sources import feeds as E
from fieldlens.sources import readers as A


@pytest.mark.parametrize(
    ("text", "facts"),
    [
        ('{"facts": ["a", "b"]}', ["a", "b"]),
        ('```json\n[{"fact": "a"}, {"text": " b "}]\n```', ["a", "b"]),
        ('Here: {"facts": ["a", "b", "cut of', ["a", "b"]),
        ('{"facts": ["say \\"x\\"", "b\n"]}', ['say "x"', "b"]),
        ("no json", None),
        (None, None),
        ('{"facts": []}', []),
    ],
)
def test_fact_replies(frame, text, facts):
    assert frame([(text,)], "t string").select(A.parsed_facts(F.col("t"))).first()[0] == facts


def test_article_prefers_article_over_body(frame):
    html = "<html><title> A  b </title><body><p>outside</p><article><p>one<script>x()</script> two<p>three</p><blockquote>q</blockquote></article></body></html>"
    row = A.html_articles(frame([(1, html), (2, "<p>only"), (3, None)], "page_id long, html string")).orderBy("page_id").collect()
    assert (row[0]["title"], row[0]["paragraphs"], row[0]["quotes"]) == ("A b", ["one two", "three"], ["q"])
    assert row[1]["paragraphs"] == ["only"] and row[2]["paragraphs"] == []


def test_meta_tags(frame):
    html = '<html lang="en"><meta content="From OG" property="og:title"><meta name="author" content=" Jo  Roe "><meta property="article:published_time" content="2024-01-02T03:04:05Z">'
    meta = A.meta_tags(F.col("h"))
    row = frame([(html,)], "h string").select(*(c.alias(n) for n, c in meta.items())).first()
    assert (row["title"], row["author"], row["language"], row["published"]) == ("From OG", "Jo Roe", "en", datetime(2024, 1, 2, 3, 4, 5)) and row["description"] is None


def test_scan_prunes_and_ignores_absent_columns(spark, frame, tmp_path):
    frame([(2023, 1), (2024, 2)], "season int, x int").write.partitionBy("season").parquet(str(tmp_path / "t"))
    df = A.scan(spark, str(tmp_path / "t"), season=2024, week=9)
    assert [r["x"] for r in df.collect()] == [2]
    assert "PartitionFilters: [isnotnull(season" in df._jdf.queryExecution().toString()


def test_preferred_source(frame):
    one, none = frame([(1,)], "a int"), frame([], "a int")
    two = frame([(2,)], "a int")
    assert [r["a"] for r in A.preferred(one, two).collect()] == [1] and [r["a"] for r in A.preferred(none, two).collect()] == [2]


def test_nested_nodes_survive_bad_json(frame):
    rows = A.nodes_with(frame([(1, '{"a": [{"players": []}], "players": 1}'), (2, "{"), (3, None)], "id long, j string"), "id", "j", ["players"]).collect()
    assert {(r["id"], r["path"]) for r in rows} == {(1, "$"), (1, "$.a[0]")}


@pytest.mark.parametrize(("host", "score"), [("www.espn.com", 1.0), ("static.espn.com", 0.9), ("wsj.com", 0.95), ("a.b.reddit.com", 0.2), ("x.org", 0.5), ("localhost", 0.5)])
def test_source_scores(frame, host, score):
    assert frame([(host,)], "h string").select(X.source_score(F.col("h"))).first()[0] == pytest.approx(score)


def test_sentence_kinds(frame):
    rows = [('He said "go".', "quote"), ("The Chiefs signed him.", "roster"), ("The Chiefs had a victory.", "event"), ("He had 3 sacks.", "statistic"), ("In 2024 it was cold.", "factual"), ("Nothing here.", "generic")]
    df = frame(rows, "s string, want string").withColumn("got", X.sentence_kind(F.col("s"), ["Chiefs"]))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_decision_order(frame):
    schema = "a int, dimension string, enabled boolean, score double, threshold double, passed boolean, worst string"
    rows = [(1, "f", True, 0.9, 0.5, True, None), (2, "f", True, 0.9, 0.5, True, "warning"), (3, "f", True, 0.4, 0.5, True, "warning"), (4, "f", True, 0.9, 0.5, True, "critical"), (5, "f", False, 0.0, 0.5, False, "critical"), (5, "q", True, 1.0, 0.5, True, None)]
    got = {r["a"]: r["decision"] for r in H.decision(frame(rows, schema), "a").collect()}
    assert got == {1: "release", 2: "review_required", 3: "reject", 4: "reject", 5: "release"}


def test_versions_and_null_scopes(frame):
    now = frame([(1, None, "a", 1, True), (2, "x", "b", 3, True)], "season int, part string, v string, version int, is_current boolean")
    out = S.append_version(now, frame([(1, None, "c"), (3, "y", "d")], "season int, part string, v string"), ["season", "part"]).collect()
    assert {(r["v"], r["version"], r["is_current"]) for r in out} == {("a", 1, False), ("b", 3, True), ("c", 2, True), ("d", 1, True)}


def test_latest_snapshot_keeps_null_groups(frame):
    df = frame([("a", 1, 5), ("a", 2, 1), ("a", 2, 3), (None, 1, 1), (None, 1, None)], "team string, season int, wk int")
    assert {(r["team"], r["season"], r["wk"]) for r in S.latest_per_group(df, "team", "season", "wk").collect()} == {("a", 2, 3), (None, 1, 1)}


def test_job_claims_compare_first(frame):
    jobs = frame([(1, "queued"), (2, "running")], "job_id int, status string")
    after = {r["job_id"]: r["status"] for r in J.claim(J.claim(jobs, 1), 2, to="failed").collect()}
    assert after == {1: "running", 2: "running"}


_RSS = """<?xml version="1.0"?><rss xmlns:media="m" xmlns:dc="d"><channel><title>C</title><!-- <item><link>https://hidden</link></item> -->
<item><media:title>no</media:title><title>A &amp; B &#8217;<![CDATA[ <b>x</b>]]></title><link>https://x.com/?a=1&amp;b=2</link><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate><category>n1</category><category>n2</category></item>
<item><link><![CDATA[https://x.com/2]]></link><dc:date>2024-01-02T03:04:05.120Z</dc:date><dc:creator>Jo</dc:creator></item><item><title>no link</title><guid isPermaLink="false">9</guid></item>
<item><guid>https://x.com/3</guid><pubDate>soon</pubDate><description/></item></channel></rss>"""
_ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title><entry><title>T</title><link rel="self" href="https://s"/><link rel="alternate" href="https://a/1?x=1&amp;y=2"/><updated>2024-01-02T03:04:05Z</updated><author><name>Ro</name></author><summary>S</summary><category term="t"/></entry></feed>"""


def _entries(frame, xml, **options):
    return [tuple(r) for r in E.feed_entries(frame([("s", xml)], "source string, xml string"), place=True, **options).orderBy("pos").select("url", "title", "author", "tags", F.date_format("published", "HH:mm:ss")).collect()]


def test_feeds_are_read_as_xml(frame):
    assert _entries(frame, _RSS) == [("https://x.com/?a=1&b=2", "A & B \u2019 <b>x</b>", None, ["n1", "n2"], "03:04:05"), ("https://x.com/2", None, "Jo", [], "03:04:05"), ("https://x.com/3", None, None, [], None)]
    atom = [("https://a/1?x=1&y=2", "T", "Ro", ["t"], "03:04:05")]
    assert _entries(frame, _ATOM) == atom
    prefixed = _ATOM.replace("xmlns=", "xmlns:a=").replace("<feed", "<a:feed").replace("</feed", "</a:feed").replace("<entry", "<a:entry").replace("</entry", "</a:entry")
    for tag in ("title", "link", "updated", "author", "summary", "category"):
        prefixed = prefixed.replace(f"<{tag}", f"<a:{tag}").replace(f"</{tag}", f"</a:{tag}")
    assert [r[:2] for r in _entries(frame, prefixed)] == [r[:2] for r in atom]


@pytest.mark.parametrize(
    ("xml", "urls"),
    [
        ("<rss><channel><item><link>https://x/?a=1&b=2</link></item></channel></rss>", ["https://x/?a=1&b=2"]),  # a stray ampersand
        ("<rss><channel><item><link>https://x/1</link></item><item><link>https://x", ["https://x/1"]),  # breaks off
        ("<feed><entry><link href='https://x/1'/></entry><entry><li", ["https://x/1"]),
        ("<rdf:RDF xmlns:rdf='r'><channel/><item><link>https://x/1</link></item></rdf:RDF>", ["https://x/1"]),
        ("<html>", []), ("", []), (None, []), ("no xml", []),
    ],
)
def test_feeds_that_are_odd_or_broken(frame, xml, urls):
    assert [r[0] for r in _entries(frame, xml)] == urls


def test_feed_limits(frame):
    items = "".join(f"<item><link>https://x/{i}</link><pubDate>{1 + i % 9} Jan 2024 00:00:00 +0000</pubDate></item>" for i in range(1100))
    xml = f"<rss><channel>{items}</channel></rss>"
    assert len(_entries(frame, xml)) == 1000
    late = _entries(frame, xml, most=5, days_back=3, as_of=F.lit("2024-01-10 12:00:00").cast("timestamp"))
    assert [r[0] for r in late] == [f"https://x/{i}" for i in (6, 7, 8, 15, 16)]


def test_sitemaps(frame):
    own = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    url = "<url><loc><![CDATA[https://x/?a=1&b=2]]></loc><image:image xmlns:image='i'><image:loc>https://img</image:loc></image:image><news:news xmlns:news='n'><news:title>T &amp; U</news:title><news:publication_date>2024-01-03</news:publication_date></news:news></url>"
    rows = [("a", f"<urlset {own}><!-- {url} -->{url}<url><lastmod>2024-01-01</lastmod></url></urlset>"), ("b", f"<urlset>{url}</urlset>"), ("c", f"<urlset {own}>{url}"), ("d", None)]
    df = frame(rows, "source string, xml string")
    assert [tuple(r) for r in E.sitemap_entries(df).select("source", "url", "title", F.date_format("published", "yyyy-MM-dd")).collect()] == [("a", "https://x/?a=1&b=2", "T & U", "2024-01-03")]
    assert {r["source"] for r in df.where(E.broken(F.col("xml"))).collect()} == {"c"}
