"""Watermarks, links, facts and topics by hand; a stream gives what a batch gives."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fieldlens.functions import text as X
from fieldlens.operators import batches as T
from fieldlens.operators import jobs as J
from fieldlens.operators import knowledge as K
from fieldlens.operators import news as N
from fieldlens.sources.sinks import Pipeline, sync_all
from fieldlens.sources.tables import Table
from fieldlens.streaming.news_stream import NewsFlow

T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3))
ITEMS = "source string, url string, published timestamp, seq long"


def test_mark_does_not_move_when_everything_was_seen(frame):
    marks = frame([("a", T1), ("b", T1)], "source string, last_published_at timestamp")
    items = frame([("a", "https://x.com/1", T2, 1), ("b", "https://x.com/1", T3, 2)], ITEMS)
    links = N.processed_links(N.after_watermark(items, marks), "seq")
    out = {r["source"]: r["last_published_at"] for r in N.advanced(marks, links).collect()}
    assert out == {"a": T2, "b": T1}


def test_watermark_is_strict_and_undated_items_pass(frame):
    marks = frame([("a", T2)], "source string, last_published_at timestamp")
    items = frame([("a", "u1", T2, 1), ("a", "u2", T3, 2), ("a", "u3", None, 3), ("c", "u4", T1, 4)], ITEMS)
    assert {r["url"] for r in N.after_watermark(items, marks).collect()} == {"u2", "u3", "u4"}


def test_seen_before_the_date_test(frame):
    items = frame([("a", "https://x.com/1", T1, 1), ("b", "https://x.com/1", T3, 2), ("a", "bad", T3, 3)], ITEMS)
    assert N.processed_links(items, "seq", F.lit(T2)).count() == 0


@pytest.mark.parametrize(("url", "league"), [("https://x.com/nfl/a", True), ("https://x.com/my-nfl-style", False), ("https://www.nfl.com/b", True), ("https://x.com/nfl", True), ("https://notnfl.com/", False)])
def test_league_urls(frame, url, league):
    assert frame([(url,)], "u string").select(X.league_url(F.col("u"))).first()[0] is league


def test_difficulty(frame):
    df = frame([(n,) for n in (9, 10, 30, 31)], "n int")
    assert [r[0] for r in df.select(K.fact_difficulty(F.col("n"))).collect()] == ["easy", "medium", "medium", "hard"]


def test_story_facts(frame):
    df = frame([("Adam Roe is a senior NFL reporter for ESPN.",), ("Mahomes threw for 300 yards on Sunday.",), ("short",), (None,)], "f string")
    assert [r[0] for r in df.select(X.is_story_fact(F.col("f"))).collect()] == [False, True, False, False]


def test_entities_and_topics_unique(frame):
    entities = frame([(1, "player", "E1", "A", 0.9, False, 1, None, 0), (1, "player", "e1", "B", 0.1, True, 1, None, 1), (1, "player", None, "B", 0.5, False, 1, None, 2)],
                     "fact_id long, entity_type string, entity_id string, mention string, confidence double, is_primary boolean, rnk int, team_abbr string, seq int")
    assert {r["seq"] for r in K.best_entities(entities).collect()} == {1, 2}
    topics = frame([(1, "Injury", 0.5, 1, False, 0), (1, "injuries", 0.9, 2, False, 1)], "fact_id long, topic string, confidence double, rnk int, is_primary boolean, seq int")
    assert [r["seq"] for r in K.best_topics(topics).collect()] == [1]


def test_scope_prefers_team(frame):
    entities = frame([(1, "player", "P", "p", 1.0, True, 1, "KC", 0), (1, "team", None, "t", 0.1, False, 9, "SF", 1)],
                     "fact_id long, entity_type string, entity_id string, mention string, confidence double, is_primary boolean, rnk int, team_abbr string, seq int")
    row = K.primary_scope(entities).first()
    assert (row["scope_type"], row["scope_id"], row["scope_team"]) == ("team", "SF", "SF")


def test_stream_equals_batch(spark, frame, tmp_path):
    rows = [("a", f"https://x.com/{i % 7}", datetime(2024, 1, 1 + i % 5), i) for i in range(20)]
    for part in (rows[:10], rows[10:]):
        frame(part, ITEMS).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    flow = NewsFlow(Table(spark, str(tmp_path / "links")), Table(spark, str(tmp_path / "marks")))
    for _ in range(2):  # the second start finds nothing new
        stream = spark.readStream.schema(ITEMS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        flow.start(stream, str(tmp_path / "checkpoint")).awaitTermination(60)
    urls = [r["url"] for r in flow.links.read().collect()]
    assert len(urls) == len(set(urls)) and set(urls) <= {f"https://x.com/{i}" for i in range(7)}
    assert flow.marks.read().first()["last_published_at"] == datetime(2024, 1, 5)
    flow.batch(frame(rows, ITEMS), 99)
    assert flow.links.read().count() == len(urls)


def test_a_batch_that_runs_again_gives_the_same_state(spark, frame, tmp_path):
    """The first run breaks between the links and the marks; the second one still moves the marks."""
    flow = NewsFlow(Table(spark, str(tmp_path / "links")), Table(spark, str(tmp_path / "marks")))
    day = lambda d: datetime(2024, 1, d)
    flow.batch(frame([("a", "https://x.com/1", day(1), 1)], ITEMS), 0)
    items = frame([("a", "https://x.com/2", day(3), 2), ("a", "https://x.com/1", day(2), 3)], ITEMS)
    upsert = flow.marks.upsert
    flow.marks.upsert = lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        flow.batch(items, 1)
    flow.marks.upsert = upsert
    for _ in range(2):
        flow.batch(items, 1)
        assert {(r["url"], r["batch"]) for r in flow.links.read().collect()} == {("https://x.com/1", 0), ("https://x.com/2", 1)}
        assert flow.marks.read().first()["last_published_at"] == day(3)


def test_table_upsert_and_sync(spark, frame, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    good = Pipeline(lambda: frame([(1, "a"), (2, "b")], "k int, v string"), lambda d: d, ["k"])
    bad = Pipeline(lambda: frame([(1,)], "k int"), lambda d: d.select("missing"))
    assert sync_all({"good": good, "bad": bad}, {"good": table, "bad": table})["good"] == 2
    table.upsert(frame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert {(r["k"], r["v"]) for r in table.read().collect()} == {(1, "a"), (2, "c"), (3, "d")} and table.version() == 1
    assert good.run(None) == 2 and good.inspect()["rows"] == 2


@pytest.mark.parametrize(
    ("custom_id", "want"),
    [
        ("easy_3f2a77c0-1b9d-4a6e-9d2c-000000000001", ("easy", "3f2a77c0-1b9d-4a6e-9d2c-000000000001", None, None, None, None, None)),
        ("hard_9b1deb4d-3b7d_2|injuries|team|KC|Chiefs", ("hard", "9b1deb4d-3b7d", "2", "injuries", "team", "KC", "Chiefs")),
        ("hard_9b1deb4d_2|a_b|player|00-1", ("hard", "9b1deb4d", "2", "a_b", "player", "00-1", "00-1")),
        ("hard_9b1deb4d_2|", ("hard", "9b1deb4d", "2", "", None, None, None)),
        ("hard_9b1deb4d_2_trades_team_KC_x", ("hard", "9b1deb4d", "2", "trades", "team", "KC_x", "KC_x")),
        ("hard_9b1deb4d_2_trades_none", ("hard", "9b1deb4d", "2", "trades", "none", None, None)),
        ("hard_9b1deb4d|x", None), ("hard_9b1deb4d_2", None), ("facts_1", None), (None, None), ("", None),
    ],
)
def test_request_ids(frame, custom_id, want):
    got = frame([(custom_id,)], "c string").select(T.request_id(F.col("c")).alias("r")).first()["r"]
    assert (got and tuple(got)) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"summary": " a b "}', "a b"), ('note {"x": 1, "summary": "in it"} end', "in it"), ('```json\n{"summary": "f"}\n```', "f"), ('x {"summary": "f\\"q\\""}', "f\\"), ('{"other": "x"}', None),
        ("plain words", None), ('{"summary": ""}', None), (None, None), ('x {"a": {"b": 1}, "summary": "deep"} y', "deep"),
    ],
)
def test_summaries_in_replies(frame, text, want):
    assert frame([(text,)], "t string").select(T.summary_text(F.col("t"))).first()[0] == want


def test_reply_shapes(frame):
    bodies = [
        '{"choices": [{"message": {"content": "one"}}], "output_text": "no"}', '{"choices": [{"message": {"content": [{"type": "x"}, {"type": "text", "text": "two"}]}}]}', '{"output_text": "three"}',
        '{"output": [{"type": "reasoning"}, {"type": "message", "content": [{"type": "output_text", "text": "four"}]}]}', "{}", "null",
    ]
    lines = [(i, f'{{"custom_id": "c{i}", "error": null, "response": {{"status_code": 200, "body": {b}}}}}') for i, b in enumerate(bodies)]
    lines += [(10, "broken {"), (11, '{"error": {"code": 1}, "response": {"status_code": 200}}'), (12, '{"response": null}'), (13, None)]
    rows = {r["seq"]: r for r in T.replies(frame(lines, "seq int, value string")).collect()}
    assert [rows[i]["text"] for i in range(6)] == ["one", "two", "three", "four", None, None]
    assert [rows[i]["failed"] for i in (0, 5, 10, 11, 12, 13)] == [False, False, True, True, True, True]


def test_jobs_go_back_to_the_queue(frame):
    at = F.lit("2024-01-10 12:00:00").cast("timestamp")
    rows = [(1, "running", 1, "11:00", None), (2, "running", 3, "11:00", None), (3, "running", 0, "11:55", None), (4, "queued", 0, None, None), (5, "succeeded", 1, "10:00", "11:59"), (6, "queued", 0, None, "12:00"), (7, "running", 0, None, None)]
    jobs = frame(rows, "job_id int, status string, attempts int, s string, e string").select("job_id", "status", "attempts", *(F.concat(F.lit("2024-01-10 "), c).cast("timestamp").alias(n) for c, n in (("s", "started_at"), ("e", "expires_at"))), F.lit("2024-01-10 09:00:00").cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"))
    after = {r["job_id"]: r for r in J.swept(jobs, at).collect()}
    assert set(after) == {1, 2, 3, 4, 6, 7} and after[1]["status"] == "queued" and after[1]["started_at"] is None and after[2]["status"] == after[3]["status"] == after[7]["status"] == "running"
    assert {r["job_id"] for r in J.stale(jobs, at).collect()} == {1, 4, 6}
    again = J.claim(J.swept(jobs, at), 1, at).where("job_id = 1").first()
    assert (again["status"], again["attempts"]) == ("running", 2) and again["started_at"] is not None
