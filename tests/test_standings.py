"""Hand-computed seasons, and the tie-break cascade against a plain recursive version."""

import random

import pytest

from fieldlens.operators import standings as S

CLUBS = [("OAK", "Oaks", "North", "Trees"), ("ELM", "Elms", "North", "Trees"), ("FIR", "Firs", "North", "Trees"), ("ASH", "Ashes", "North", "Trees")]


def run(frame, games, teams=CLUBS, through=None):
    g = frame([(i, 2024, *row) for i, row in enumerate(games)], "game_id long, season int, wk int, home string, away string, home_score int, away_score int")
    t = frame(teams, "team_abbr string, team_name string, conference string, division string")
    return {r["team_abbr"]: r for r in S.standings(g, t, through).collect()}


#: Every club meets every other once: FIR wins three, ASH two, OAK one.
ROUND = [(1, "FIR", "OAK", 30, 9), (2, "ELM", "FIR", 3, 12), (3, "FIR", "ASH", 8, 6), (4, "ASH", "OAK", 22, 19), (5, "ELM", "ASH", 0, 5), (6, "OAK", "ELM", 16, 15)]


def test_records(frame):
    out = run(frame, ROUND)
    assert len(out["FIR"]) == 26
    assert {t: (r["wins"], r["losses"], r["points_for"], r["points_against"]) for t, r in out.items()} == {"FIR": (3, 0, 50, 18), "ASH": (2, 1, 33, 27), "OAK": (1, 2, 44, 67), "ELM": (0, 3, 18, 33)}
    assert out["ASH"]["division_record"] == out["ASH"]["conference_record"] == "2-1" and (out["ASH"]["home_record"], out["ASH"]["away_record"]) == ("1-0", "1-1")
    assert [out[t]["division_rank"] for t in ("FIR", "ASH", "OAK", "ELM")] == [1, 2, 3, 4]
    assert out["ELM"]["through_week"] == 6


def test_streaks_and_last_games(frame):
    weeks = [(w, "OAK", "ELM", *score) for w, score in enumerate([(7, 0), (1, 2), (0, 9), (5, 5), (14, 20), (3, 4), (0, 1)], 1)]
    out = run(frame, weeks, teams=CLUBS[:2])
    assert (out["OAK"]["streak"], out["OAK"]["last5"]) == ("L3", "0-4-1") and (out["ELM"]["streak"], out["ELM"]["last5"]) == ("W3", "4-0-1")
    assert (out["OAK"]["wins"], out["OAK"]["losses"], out["OAK"]["ties"]) == (1, 5, 1)


def test_through_week_keeps_scheduled_teams(frame):
    out = run(frame, ROUND[:4], through=1)
    assert out["FIR"]["wins"] == 1 and (out["ASH"]["wins"], out["ASH"]["losses"]) == (0, 0)


def test_ties_and_unplayed_games(frame):
    out = run(frame, [(1, "OAK", "ELM", 6, 6), (2, "FIR", "ASH", 33, 33), (4, "OAK", "FIR", None, None)])
    assert {r["win_pct"] for r in out.values()} == {0.5} and out["ASH"]["ties"] == 1
    assert out["OAK"]["through_week"] == 2


def test_unknown_teams_are_left_out(frame):
    out = run(frame, [(1, "YEW", "OAK", 2, 18), (2, "ASH", "FIR", 4, 3)])
    assert out["OAK"]["wins"] == 0 and "YEW" not in out


def test_equal_clubs_are_parted_by_their_game(frame):
    """OAK and ELM both win two of three; ELM won when they met, though OAK scored far more."""
    out = run(frame, [(1, "ELM", "OAK", 11, 10), (2, "OAK", "FIR", 40, 0), (3, "OAK", "ASH", 41, 0), (4, "ELM", "FIR", 7, 6), (5, "ASH", "ELM", 9, 2), (6, "ASH", "FIR", 1, 2)])
    assert (out["ELM"]["division_rank"], out["OAK"]["division_rank"]) == (1, 2)
    assert "H2H" in out["ELM"]["tiebreaker_trail"] and out["OAK"]["league_rank"] < out["ELM"]["league_rank"]


def test_identical_teams_are_parted_by_name(frame):
    out = run(frame, [(1, "OAK", "ELM", 3, 3)], teams=CLUBS[:2])
    assert out["ELM"]["division_rank"] == 1 and out["ELM"]["tied"] and "COIN" in out["OAK"]["tiebreaker_trail"]


def test_empty_schedule_keeps_all_teams(frame):
    t = frame(CLUBS, "team_abbr string, team_name string, conference string, division string")
    g = frame([], "game_id long, season int, wk int, home string, away string, home_score int, away_score int")
    assert S.on_schedule(t, g).count() == 4


def _naive(season, members, steps):
    """Recursive partition, as the rules are usually told."""
    if len(members) == 1:
        return list(members)
    for i, step in enumerate(steps):
        key = season.key(step, members)
        values = sorted(set(key.values()), reverse=True)
        if len(values) > 1:
            return [t for v in values for t in _naive(season, [m for m in members if key[m] == v], steps[i + 1 :])]
    return sorted(members)


@pytest.mark.parametrize("seed", range(12))
def test_cascade_against_recursion(seed):
    rng = random.Random(seed)
    teams = [f"T{i}" for i in range(6)]
    pair = {}
    for a in teams:
        for b in teams:
            if a < b and rng.random() < 0.8:
                w, losses, t, net = rng.randint(0, 1), rng.randint(0, 1), rng.randint(0, 1), rng.randint(-2, 2)
                pair[a, b], pair[b, a] = (w, losses, t, net), (losses, w, t, -net)
    rows = [
        {"team": t, "conference": "C", "win_pct": rng.choice([0.4, 0.5]), "sov": rng.choice([0, 0.5]), "sos": rng.choice([0, 0.5]), "points_for": rng.randint(1, 3), "points_against": rng.randint(1, 3), "point_diff": rng.randint(0, 1)}
        | {f"{k}_{c}": rng.randint(0, 1) for k in ("div", "conf") for c in "wlt"}
        for t in teams
    ]
    season = S.Season(rows, pair)
    got = [t for t, _ in season.order(teams, S.DIVISION_STEPS)]
    assert got == _naive(season, teams, ["WPCT", *S.DIVISION_STEPS])


def test_seeds_go_to_division_winners_first(frame):
    teams = [(f"{d}{i}", f"{d}{i}", "C", d) for d in ("E", "W") for i in range(3)]
    games = [(1, "E0", "E1", 9, 0), (2, "E0", "E2", 9, 0), (3, "E1", "E2", 9, 0), (4, "W0", "W1", 9, 8), (5, "W1", "W2", 9, 0), (6, "W0", "E1", 0, 9)]
    out = run(frame, games, teams)
    assert {out["E0"]["conference_seed"], out["W0"]["conference_seed"]} == {1, 2}
    assert out["E1"]["conference_seed"] == 3
    assert sorted(r["conference_rank"] for r in out.values()) == [1, 2, 3, 4, 5, 6]


def test_form_is_last_five_and_streak(spark, frame):
    rows = [(2030, "A", 1 + i % 7, i, o) for i, o in enumerate("WLTWWWLLTTWWL")] + [(2030, "B", 1, 90, "T"), (2031, "A", 2, 91, "L"), (2031, "A", 2, 92, "L")]
    sides = frame(rows, "season int, team string, wk int, game_id long, outcome string")
    apart = S.last_five(sides).join(S.streaks(sides), S.KEY).select("season", "team", "last5", "streak")
    assert sorted(S.form(sides).select(*apart.columns).collect()) == sorted(apart.collect())
    assert {(r.season, r.team): r.streak for r in S.form(sides).collect()}[2031, "A"] == "L2"
