"""Hand cases of game analysis."""

import json

import pytest

from fieldlens.operators import plays as D
from fieldlens.plans import all_queries

QUERIES = all_queries()[0]

SCHEMA = """game_id string, play_id long, quarter int, posteam string, defteam string, play_type string, yards_gained double, touchdown int, safety int, passer_player_id string,
  receiver_player_id string, rusher_player_id string, kicker_player_id string, punter_player_id string, returner_player_id string, interception_player_id string, forced_fumble_player_id string,
  fumble_recovery_player_id string, sack_player_ids array<string>, tackler_player_ids array<string>, assist_tackler_player_ids array<string>"""
NAMES = [part.split()[0] for part in SCHEMA.replace("\n", " ").split(",")]


@pytest.fixture
def log(frame):
    def make(*plays):
        base = {"game_id": "g", "quarter": 1, "posteam": "SF", "defteam": "KC", "play_type": "run", "yards_gained": 0.0, "touchdown": 0, "safety": 0}
        return frame([tuple((base | {"play_id": i} | p).get(n) for n in NAMES) for i, p in enumerate(plays)], SCHEMA)

    return make


def test_play_counts(log):
    out = {r["team"]: r for r in D.team_summaries(log({}, {}, *({"posteam": "KC", "defteam": "SF"} for _ in range(3)))).collect()}
    assert [(out[t]["total_plays"], out[t]["offensive_plays"], out[t]["defensive_plays"]) for t in ("SF", "KC")] == [(5, 2, 3), (5, 3, 2)]


def test_points(log):
    rows = log({"touchdown": 1}, {"play_type": "field_goal", "kicker_player_id": "K"}, {"play_type": "extra_point", "kicker_player_id": "K"}, {"play_type": "two_point_attempt", "touchdown": 1}, {"safety": 1})
    out = {r["team"]: r for r in D.team_summaries(rows).collect()}
    assert out["SF"]["points"] == 6 + 3 + 1 + 8 and out["KC"]["points"] == 2


def test_relevance_of_ten_plays(log):
    plays = [{"rusher_player_id": "A", "yards_gained": 25.0, "touchdown": 1}, {"rusher_player_id": "A", "yards_gained": 25.0}] + [{"rusher_player_id": "A", "yards_gained": y} for y in (9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 7.0)]
    assert D.relevance(D.impact(log(*plays))).first()["relevance"] == 57.0


def test_two_roles_count_twice_and_sacks_count_against_the_passer(log):
    rows = D.impact(log({"play_type": "pass", "passer_player_id": "Q", "receiver_player_id": "Q", "sack_player_ids": ["D"]}))
    out = {r["player"]: r for r in rows.collect()}
    assert out["Q"]["play_frequency"] == 2 and out["Q"]["sacks_allowed"] == 1 and out["D"]["sacks"] == 1


def test_completions_need_a_receiver(log):
    out = {r["player"]: r for r in D.player_summaries(log({"passer_player_id": "Q", "yards_gained": 9.0}, {"passer_player_id": "Q", "receiver_player_id": "W", "yards_gained": 12.0, "touchdown": 1})).collect()}
    assert (out["Q"]["pass_attempts"], out["Q"]["completions"], out["Q"]["passing_yards"], out["Q"]["completion_pct"]) == (2, 1, 12.0, 50.0)
    assert (out["W"]["receptions"], out["W"]["targets"], out["W"]["touchdowns"]) == (1, 1, 1)


def test_half_tackles(log):
    out = D.player_summaries(log({"tackler_player_ids": ["T"], "assist_tackler_player_ids": ["T"]})).first()
    assert out["tackles"] == 1.5


def test_notable_events_after_totals(log):
    rows = D.notable(D.player_summaries(log(*({"rusher_player_id": "A", "yards_gained": 40.0, "touchdown": 1} for _ in range(3)))))
    assert rows.first()["notable"] == ["3 TDs", "120 rush yds"]


def test_one_play_three_moments(log):
    rows = D.key_sequences(log({"touchdown": 1, "interception_player_id": "D", "yards_gained": 30.0, "play_type": "pass"})).collect()
    assert sorted(r["kind"] for r in rows) == ["big_play", "score", "turnover"]


def test_more_forced_players_than_slots_add_none(log):
    rows = D.selected(log(*({"rusher_player_id": f"R{i}", "touchdown": 1} for i in range(5)), {"rusher_player_id": "Z"}), per_team=0, total=3)
    assert rows.count() == 5


def test_cleaning_keeps_good_values(frame):
    df = frame([("null", float("nan"), ["x", "null"], {"a": float("inf"), "b": 1.0}), ("id", 2.0, ["y"], {})], "player_id string, v double, tackler_player_ids array<string>, m map<string,double>")
    a, b = D.cleaned(df).collect()
    assert (a["player_id"], a["v"], a["tackler_player_ids"], a["m"]) == (None, None, ["x", None], {"a": None, "b": 1.0})
    assert (b["player_id"], b["v"]) == ("id", 2.0)


def _broken(df):
    return {r["rule"] for r in D.checks(df).collect() if r["broken"]}


def _whole(log, *changed, game="2024_05_SF_KC"):
    """A log of 60 plays without fault, but for what ``changed`` says of the first ones."""
    plays = [{"game_id": game, "quarter": 1 + i // 15, "rusher_player_id": f"00-000000{i % 6}"} for i in range(60)]
    done = log(*({**p, **(changed[i] if i < len(changed) else {})} for i, p in enumerate(plays)))
    return done.selectExpr("*", "1 as down", "10 as yards_to_go", "50 as yardline")


def test_a_whole_log_breaks_no_rule(log):
    assert _broken(_whole(log)) == set()


@pytest.mark.parametrize(
    "changed, rules",
    [
        ([{"play_id": 1}], {"duplicate_play_ids"}), ([{"quarter": 9}], {"quarter_range"}), ([{"posteam": None}], {"missing_team"}), ([{"yards_gained": 120.0}], {"yards_range"}), ([{"touchdown": 2}], {"touchdown_value"}),
        ([{"rusher_player_id": ""}], {"rusher_missing"}), ([{"play_type": "pass"}], {"passer_missing"}), ([{"posteam": "LA"}], {"team_count", "game_teams"}), ([{"rusher_player_id": "00-12"}], {"player_ids"}),
        ([{"rusher_player_id": "Z9"}], set()), ([{"play_type": None}] * 6, set()), ([{"play_type": None}] * 7, {"missing_type"}), ([{"quarter": 4, "yards_gained": float("nan")}], set()),
        ([{"tackler_player_ids": [f"T{i}" for i in range(95)]}], {"player_count"}),
    ],
)
def test_each_rule_alone(log, changed, rules):
    assert _broken(_whole(log, *changed)) == rules


def test_broken_logs_are_reported(log):
    twice = log({}, {"quarter": 3}, {"quarter": 2}).union(log({}))
    absent = {"missing_down", "missing_yards_to_go", "missing_yardline"}  # this log has no such columns
    assert _broken(twice) == {"duplicate_play_ids", "play_order", "rusher_missing", "play_count", "player_count"} | absent
    assert D.valid_logs(D.checks(twice)).first().asDict() == {"game_id": "g", "errors": 1, "warnings": 7, "is_valid": False}
    loose = D.checks(_whole(log, {"posteam": None}))
    assert [D.valid_logs(loose, strict).first()["is_valid"] for strict in (False, True)] == [True, False]


def test_statistics_name_both_sides_and_count_players(log):
    row = D.log_statistics(log({"defteam": "LA", "rusher_player_id": "R"}, {"quarter": 2, "rusher_player_id": "R", "tackler_player_ids": ["T", ""]})).first()
    assert (row["n_plays"], row["quarters"], row["teams"], row["n_players"]) == (2, [1, 2], ["KC", "LA", "SF"], 2)


def test_envelope(log):
    plays = log({"game_id": "2024_05_SF_KC", "touchdown": 1, "rusher_player_id": "R", "yards_gained": 4.0}, {"game_id": "odd", "rusher_player_id": "Q"})
    by_id = {r["game_id"]: json.loads(r["envelope"]) for r in D.envelope(plays).collect()}
    game, odd = by_id["2024_05_SF_KC"], by_id["odd"]
    assert game["header"] == {"game_id": "2024_05_SF_KC", "season": 2024, "week": 5, "away_team": "SF", "home_team": "KC"}
    assert game["pointers"] == {"play_by_play": {"record_count": 1}, "player_data": {"record_count": 1}, "team_data": {"record_count": 2}}
    assert game["leaders"] == ["R"] and [m["kind"] for m in game["moments"]] == ["score"] and {t["team"]: t["points"] for t in game["teams"]} == {"SF": 6, "KC": 0}
    assert odd["header"] == {"game_id": "odd", "away_team": "KC", "home_team": "SF"} and "moments" not in odd


def test_ids(frame):
    row = D.id_parts(frame([("2024_05_SF_KC",), ("odd",)], "game_id string")).orderBy("game_id").first()
    assert (row["id_season"], row["id_week"], row["away_team"], row["home_team"]) == (2024, 5, "SF", "KC")
    empty = frame([], "other_id string, league_id string")
    static = frame([("MahoPa00", "00-0033873")], "other_id string, league_id string")
    out = D.mapped_ids(frame([("mahopa00",), ("001234567",), ("00-1111111",), (None,)], "pid string"), "pid", static, empty, empty)
    assert {r["pid"]: r["league_id"] for r in out.collect()} == {"mahopa00": "00-0033873", "001234567": "00-1234567", "00-1111111": "00-1111111", None: None}


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("name, most", [("quota_selection", 1), ("log_statistics", 1), ("validation_report", 1), ("valid_logs", 1), ("game_envelope", 4)])
def test_plays_are_dealt_out_once(spark, name, most):
    """All that is asked of a game stays where its plays are; the envelope has one shuffle for each of its four parts at most."""
    assert _exchanges(QUERIES[name](spark, "/root/testdata/sf0.001")) <= most


def test_roles_and_sets_have_no_lambda_over_plays(log):
    assert "lambda" not in D.roles(log({"rusher_player_id": "R", "sack_player_ids": ["S", "", None]}))._jdf.queryExecution().optimizedPlan().toString()
    rows = D.roles(log({"rusher_player_id": "R", "kicker_player_id": "", "sack_player_ids": ["S", "", None]})).collect()
    assert sorted((r["role"], r["player"]) for r in rows) == [("rusher", "R"), ("sacker", "S")]


def test_others_fill_what_the_forced_leave(log):
    rows = D.selected(log({"rusher_player_id": "A", "touchdown": 1}, *({"rusher_player_id": p} for p in "BBBCCD")), per_team=0, total=3).collect()
    assert sorted((r["player"], r["forced"]) for r in rows) == [("A", True), ("B", False), ("C", False)]
    rare = D.selected(log({"rusher_player_id": "A", "touchdown": 1}, *({"rusher_player_id": p} for p in "BCDD")), per_team=0, total=3, min_plays=2).collect()
    assert sorted(r["player"] for r in rare) == ["A", "D"]  # too few plays take no place
