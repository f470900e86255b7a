"""Scorecards and season totals on hand-built matches."""

import pytest
from matches import ball, document, innings, rows, write
from pyspark.sql import functions as F

from scorebook import operators as ops
from scorebook.sources import read_match_documents


class Built:
    def __init__(self, spark, folder, **documents):
        docs = read_match_documents(spark, write(folder, **documents))
        self.bronze = ops.flatten_deliveries(docs)
        self.registry = ops.match_player_registry(docs)
        self.facts = ops.fact_from_documents(docs)
        self.matches = ops.dim_match(self.bronze)
        self.players = ops.dim_player(self.registry)
        self.batting = ops.batting_scorecard(self.facts, self.players)
        self.bowling = ops.bowling_scorecard(self.facts, self.players)
        self.summary = ops.team_match_summary(self.facts, self.matches)
        self.season = ops.player_season_stats(
            self.registry, self.matches, self.batting, self.bowling
        )


@pytest.fixture
def built(spark, tmp_path):
    return lambda **documents: Built(spark, tmp_path, **documents)


def out(player, kind, **more):
    return [{"player_out": player, "kind": kind, **more}]


def test_batting_counts(built):
    balls = [ball(runs=r) for r in (0, 4, 6, 1)]
    balls += [ball(extras={"wides": 1}), ball(runs=0, extras={"noballs": 1})]
    card = built(m1=document(innings("A", balls))).batting
    found = rows(
        card, "batter_name", "runs", "balls_faced", "fours", "sixes", "dot_balls", "not_out"
    )
    assert found == [("A1", 11, 5, 1, 1, 2, 1)]
    assert [str(r[0]) for r in rows(card, "strike_rate")] == ["220.00"]


def test_strike_rate_without_a_ball_faced_is_null(built):
    card = built(m1=document(innings("A", [ball(extras={"wides": 1})]))).batting
    assert rows(card, "balls_faced", "strike_rate") == [(0, None)]


def test_strike_rate_rounds_half_up(built):
    balls = [ball(runs=1)] + [ball() for _ in range(799)]
    card = built(m1=document(innings("A", balls))).batting
    assert str(rows(card, "strike_rate")[0][0]) == "0.13"


def test_not_out_looks_at_balls_faced_only(built):
    balls = [ball("A1", non_striker="A2", wickets=out("A2", "run out")), ball("A3"), ball("A2")]
    card = built(m1=document(innings("A", balls))).batting
    assert rows(card, "player_id_batter", "not_out", "dismissal_kind") == [
        ("id-A1", 0, "run out"),
        ("id-A2", 1, None),
        ("id-A3", 1, None),
    ]


def test_dismissal_kind_is_the_greatest(built):
    balls = [ball(wickets=out("A1", "retired hurt")), ball(wickets=out("A1", "bowled")), ball()]
    card = built(m1=document(innings("A", balls))).batting
    assert rows(card, "dismissal_kind", "not_out", "balls_faced") == [("retired hurt", 0, 3)]


def test_batting_positions_tie_and_skip_after_long_overs(built):
    first = [ball("A1") for _ in range(6)] + [ball("A2")]
    card = built(m1=document(innings("A", first, [ball("A3")], [ball(None)]))).batting
    assert rows(card, "batting_position", "batter_name", "first_ball") == [
        (1, "A1", 0),
        (2, "A2", 6),
        (2, "A3", 6),
        (4, None, 12),
    ]


def test_display_name_is_the_smallest_variant(built):
    second = document(innings("A", [ball("A0")]))
    second["info"]["registry"]["people"]["A0"] = "id-A1"
    second["info"]["players"]["A"] = ["A0", "A2"]
    card = built(m1=document(innings("A", [ball("A1")])), m2=second).batting
    assert rows(card, "match_id", "batter_name") == [("m1", "A0"), ("m2", "A0")]


def test_bowling_figures(built):
    balls = [
        ball(runs=0),
        ball(runs=4),
        ball(extras={"wides": 3}),
        ball(runs=1, extras={"noballs": 1}),
        ball(extras={"byes": 2}),
        ball(extras={"legbyes": 1}),
        *[ball() for _ in range(4)],
    ]
    card = built(m1=document(innings("A", balls))).bowling
    found = rows(card, "balls_bowled", "dot_balls", "overs_bowled", "runs_conceded", "wides")
    assert found == [(8, 5, "1.2", 9, 3)]
    assert [(n, str(e), a) for n, e, a in rows(card, "noballs", "economy", "bowling_average")] == [
        (1, "6.75", None)
    ]


def test_economy_without_a_legal_ball_is_null(built):
    card = built(m1=document(innings("A", [ball(extras={"wides": 1})]))).bowling
    assert rows(card, "balls_bowled", "overs_bowled", "economy") == [(0, "0.0", None)]


@pytest.mark.parametrize(
    ("kind", "wickets"),
    [
        ("bowled", 1),
        ("caught", 1),
        ("lbw", 1),
        ("stumped", 1),
        ("retired out", 1),
        ("run out", 0),
        ("retired hurt", 0),
        ("obstructing the field", 0),
        (None, 0),
    ],
)
def test_wickets_credited_to_the_bowler(built, kind, wickets):
    card = built(m1=document(innings("A", [ball(runs=3, wickets=out("A1", kind))]))).bowling
    average = 3.0 if wickets else None
    assert rows(card, "wickets", "bowling_average") == [(wickets, average)]


def test_innings_totals(built):
    balls = [
        ball(runs=2, extras={"noballs": 1}),
        ball(extras={"byes": 1}),
        ball(extras={"legbyes": 4}),
        ball(extras={"wides": 5}),
        ball(extras={"penalty": 5}),
        ball(wickets=out("A1", "bowled") + out("A2", "run out")),
    ]
    totals = ops.innings_totals(built(m1=document(innings("A", balls))).facts)
    assert rows(totals, "total_runs", "total_wickets", "total_balls", "total_extras") == [
        (18, 1, 4, 11)
    ]


def summary_of(built, outcome):
    scores = [innings(team, [ball(runs=r)]) for team, r in zip("ABAB", (5, 3, 2, 6), strict=True)]
    summary = built(m1=document(*scores, outcome=outcome)).summary
    return [target for _, target in rows(summary, "innings_number", "target")]


def test_even_innings_chase_the_one_before(built):
    assert summary_of(built, {"result": "tie"}) == [None, 6, None, 3]


def test_unknown_results_set_no_target(built):
    assert summary_of(built, {"result": "no result"}) == [None] * 4


def test_match_without_dimension_has_no_target(built):
    tables = built(m1=document(innings("A", [ball()]), innings("B", [ball()])))
    summary = ops.team_match_summary(tables.facts, tables.matches.where("false"))
    assert rows(summary, "win_type", "target") == [(None, None)] * 2


def test_run_rate_and_overs(built):
    summary = built(m1=document(innings("A", [ball(runs=1)] * 6, [ball(runs=4)]))).summary
    assert [(o, str(r)) for o, r in rows(summary, "overs_played", "run_rate")] == [("1.1", "8.57")]


def season_row(tables, player, *names):
    return rows(tables.season.where(F.col("player_id") == player), *names)


def test_everyone_in_a_squad_appears(built):
    tables = built(m1=document(innings("A", [ball()])))
    assert tables.season.count() == 6
    found = season_row(tables, "id-A3", "matches_played", "player_name", "runs", "wickets")
    assert found == [(1, None, None, None)]


def test_fifties_and_hundreds(built):
    scores = {"m1": 49, "m2": 50, "m3": 99, "m4": 100}
    tables = built(
        **{m: document(innings("A", [ball(runs=score)])) for m, score in scores.items()}
    )
    found = season_row(
        tables, "id-A1", "innings_batted", "runs", "highest_score", "fifties", "hundreds"
    )
    assert found == [(4, 298, 100, 2, 1)]


def test_average_of_the_undismissed_is_their_runs(built):
    tables = built(m1=document(innings("A", [ball(runs=7)])))
    assert season_row(tables, "id-A1", "not_outs", "batting_average") == [(1, 7.0)]


def test_super_overs_can_turn_the_average_negative(built):
    scores = [innings(t, [ball(b, runs=3)]) for t, b in (("A", "A1"), ("B", "B2"), ("A", "A1"))]
    tables = built(m1=document(*scores))
    assert season_row(tables, "id-A1", "innings_batted", "not_outs", "batting_average") == [
        (1, 2, -6.0)
    ]


def test_teams_of_a_season_are_combined(built):
    second = document(innings("C", [ball("A1", runs=2)]), innings("B", [ball("B1", bowler="A1")]))
    second["info"]["teams"] = ["C", "B"]
    second["info"]["players"] = {"C": ["A1"], "B": ["B1"]}
    first = document(innings("A", [ball(runs=1)]), innings("B", [ball("B1", bowler="A1")]))
    tables = built(m1=first, m2=second)
    found = season_row(tables, "id-A1", "team", "runs", "balls_bowled")
    assert found == [("A", 1, 1), ("A", 1, 1), ("C", 2, 1), ("C", 2, 1)]


def test_null_season_matches_no_figures(built):
    tables = built(m1=document(innings("A", [ball(runs=9)]), season=None))
    assert season_row(tables, "id-A1", "season", "matches_played", "runs") == [(None, 1, None)]


def test_seasons_are_separate(built):
    tables = built(
        m1=document(innings("A", [ball(runs=1)])),
        m2=document(innings("A", [ball(runs=2)]), season="2017"),
    )
    assert season_row(tables, "id-A1", "season", "runs") == [("2016", 1), ("2017", 2)]


def test_report_order(built):
    tables = built(
        m2=document(innings("A", [ball("A2"), ball("A1")]), innings("B", [ball("B1", "A1")])),
        m1=document(innings("A", [ball("A3")])),
    )
    card = ops.batting_scorecard(tables.facts, tables.players, ordered=True)
    names = [row.batter_name for row in card.select("batter_name").collect()]
    assert names == ["A3", "A2", "A1", "B1"]
    season = ops.player_season_stats(
        tables.registry, tables.matches, tables.batting, tables.bowling, ordered=True
    )
    assert [row.matches_played for row in season.collect()] == [2] * 6


def test_lookups(built):
    tables = built(
        m1=document(innings("A", [ball(wickets=out("A1", "lbw")), ball("A2")])),
        m2=document(innings("A", [ball()]), season="2017", outcome={"result": "tie"}),
    )
    assert rows(ops.distinct_win_types(tables.matches)) == [("run",), ("tie",)]
    assert rows(ops.distinct_dismissal_kinds(tables.facts)) == [(None,), ("lbw",)]
    found = ops.player_season_lookup(tables.season, "%1", "2016")
    assert rows(found, "player_id", "season") == [("id-A1", "2016"), ("id-B1", "2016")]


def test_totals_agree_across_marts(built):
    balls = [ball(runs=r, extras=e) for r, e in ((1, None), (0, {"wides": 2}), (4, {"byes": 1}))]
    tables = built(m1=document(innings("A", balls, [ball("A2", "B2", runs=6)])))
    (bat,) = tables.batting.agg(F.sum("runs")).first()
    (balls_bowled,) = tables.bowling.agg(F.sum("balls_bowled")).first()
    total = tables.summary.first()
    assert bat == tables.facts.agg(F.sum("runs_batter")).first()[0]
    assert balls_bowled == total.total_balls
    assert total.total_runs == tables.facts.agg(F.sum("runs_total")).first()[0]
