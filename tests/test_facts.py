"""Patterns of facts are tried only where a text that they need is held."""

from pyspark.sql import functions as F

from fieldlens.functions import text as X

SAID = [
    "he is a senior writer for espn", "Reporter at NFL.com today", "staff and other analyst words", "covering games for espn now", "covers the beat here", "covers the league-wide", "covered the team since 2001",
    "joined the cbs desk", "assists with draft reporting", "contributes to the radio hour", "she is the author of it", "is co-author of two", "author of two published novels", "member of the old hall of fame",
    "contact us by email please", "get all the updates here", "write to @someone today", "a comment on this one", "please click here for it", "from Getty Images today", "copyright by someone", "see the privacy policy", "this is sponsored today",
    "install app on a phone", "The Chiefs won by seven points", "applications are unlike others", "short",
]


def test_guarded_patterns_equal_the_plain_ones(frame):
    assert len(X.NEEDED) == len(X.NOT_STORY) - 1
    df = frame([(s,) for s in [*SAID, None]], "s string")
    plain = F.coalesce((F.length("s") >= X.SHORTEST_FACT) & ~F.lower("s").rlike(X.either(X.NOT_STORY)), F.lit(False))
    rows = df.select("s", X.is_story_fact(F.col("s")).alias("got"), plain.alias("want")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]
    assert {r["s"] for r in rows if r["got"]} == {"The Chiefs won by seven points", "applications are unlike others"}
