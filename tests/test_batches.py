"""Entities of batch results: facts share mentions, and each mention is resolved once."""

import json

from fieldlens.operators import batches as T


def _line(*rows):
    return json.dumps({"custom_id": "e", "response": {"status_code": 200, "body": {"output_text": json.dumps([{"news_fact_id": i, "entities": e} for i, e in rows])}}})


def _batch(frame, *rows):
    lines = frame([(0, _line(*rows))], "seq long, value string")
    players = frame([("P1", ["Jo Roe"], "QB", "KC", None)], "player_id string, names array<string>, position string, team_abbr string, team_name string")
    teams = frame([("KC", ["Chiefs"]), ("BUF", ["Bills"])], "team_abbr string, names array<string>")
    games = frame([(7, "KC", "BUF")], "game_id long, home string, away string")
    return T.entity_batch(lines, frame([("1",), ("2",), ("3",), ("4",)], "fact_id string"), players, teams, games)


def test_a_mention_of_many_facts_is_resolved_once(frame, monkeypatch):
    asked, resolve = [], T.R.resolve_players
    monkeypatch.setattr(T.R, "resolve_players", lambda mentions, players: asked.append(mentions.count()) or resolve(mentions, players))
    roe = {"type": "player", "name": "Jo Roe"}
    out, _ = _batch(frame, ("1", [roe, roe]), ("2", [roe, roe | {"position": "K"}]), ("3", [roe, {"type": "team", "name": "Chiefs"}, {"type": "game", "name": "Chiefs at Bills"}]), ("4", []))
    rows = sorted((r["fact_id"], r["entity_type"], r["entity_id"], r["confidence"]) for r in out.collect())
    assert asked == [2]  # Jo Roe, and Jo Roe the kicker
    assert rows == [
        ("1", "player", "P1", 1.0), ("2", "player", "P1", 1.0), ("2", "player", "UNRESOLVED:jo_roe", 0.0), ("3", "game", "7", 0.9), ("3", "player", "P1", 1.0), ("3", "team", "KC", 1.0),
        ("4", "none", "NO_ENTITIES_FOUND", 0.0),
    ]


def test_the_report_reads_what_the_batch_has_parsed(frame):
    _, report = _batch(frame, ("1", []), ("9", []), ("2", [{"type": "player", "name": "Jo Roe"}, {"type": "coach", "name": "X"}]))
    assert report.first().asDict() == {"facts_in_output": 3, "skipped_missing": 1, "skipped_existing": 0, "errors": 0, "without_data": 1}
    assert "$.entities" not in report._jdf.queryExecution().optimizedPlan().toString()  # what the batch has parsed is read, not parsed again


def test_filters_on_replies_do_not_parse_the_line_again(frame):
    said = T.replies(frame([(0, _line(("1", [])))], "seq long, value string")).where("not failed and text is not null")
    assert said.count() == 1
    assert said._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1


def test_entities_of_odd_shapes(frame):
    odd = [5, "x", [1], None, {"type": "player", "name": "Jo Roe", "rank": "a", "is_primary": "no", "position": {"a": 1}}, {"name": {"b": 2}, "type": "player", "rank": 2.0}, {"type": ["player"], "name": "Jo Roe"}]
    out, _ = _batch(frame, ("1", odd), ("2", "none"))
    rows = sorted(((r["fact_id"], r["entity_type"], r["entity_id"], r["rank"], r["is_primary"], r["position"]) for r in out.collect()), key=repr)
    assert rows == [("1", "player", "UNRESOLVED:jo_roe", None, False, '{"a":1}'), ("1", "player", 'UNRESOLVED:{"b":2}', 2, False, None), ("2", "none", "NO_ENTITIES_FOUND", None, False, None)]


def test_entities_are_read_at_once_and_the_report_sorts_no_facts(frame, monkeypatch):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    plans, kept = [], T.R.kept
    monkeypatch.setattr(T.R, "kept", lambda df: plans.append(plan(df)) or kept(df))
    _, report = _batch(frame, ("1", [{"type": "player", "name": "Jo Roe"}]), ("2", []))
    assert "$.entities" in plans[0] and "variant_get(e#" not in plans[0]
    assert report.first()["without_data"] == 1
    assert "windowspecdefinition(fact_id" not in plan(report)
