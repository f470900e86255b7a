"""Documents, flattening, registry and name resolution on hand-built matches."""

import pytest
from matches import ball, document, innings, rows, write
from pyspark.sql import functions as F

from scorebook import operators as ops
from scorebook.schema import TABLES
from scorebook.sources import read_match_documents

def at():
    return F.lit("2024-01-01").cast("timestamp")


def flat(spark, folder, **documents):
    docs = read_match_documents(spark, write(folder, **documents))
    return ops.flatten_deliveries(docs, at())


def test_types_are_the_declared_ones(spark, tmp_path):
    docs = read_match_documents(spark, write(tmp_path, m1=document(innings("A", [ball()]))))
    registry = ops.match_player_registry(docs)
    bronze = ops.flatten_deliveries(docs, at())
    facts = ops.fact_delivery(bronze, registry)
    matches, players = ops.dim_match(bronze), ops.dim_player(registry)
    batting = ops.batting_scorecard(facts, players)
    bowling = ops.bowling_scorecard(facts, players)
    built = {
        "bronze": bronze,
        "match_player_registry": registry,
        "dim_player": players,
        "dim_match": matches,
        "fact_delivery": facts,
        "batting_scorecard": batting,
        "bowling_scorecard": bowling,
        "team_match_summary": ops.team_match_summary(facts, matches),
        "player_season_stats": ops.player_season_stats(registry, matches, batting, bowling),
        "manifest": ops.document_manifest(docs, at()),
    }
    for table, df in built.items():
        assert {f.name: f.dataType.simpleString() for f in df.schema} == TABLES[table], table
        assert df.columns == list(TABLES[table]), table
    assert ops.fact_from_documents(docs, at()).schema.simpleString() == facts.schema.simpleString()


def test_match_id_is_the_file_stem(spark, tmp_path):
    names = {"a b": document(innings("A", [ball()])), "c+d%": document(innings("A", [ball()]))}
    bronze = flat(spark, tmp_path, **names)
    assert rows(bronze, "match_id", "source_file") == [("a b", "a b.json"), ("c+d%", "c+d%.json")]


def test_other_files_are_not_read(spark, tmp_path):
    folder = write(tmp_path, m1=document(innings("A", [ball()])))
    (tmp_path / "notes.txt").write_text("no document")
    assert read_match_documents(spark, folder).count() == 1


def test_malformed_documents_are_marked(spark, tmp_path):
    write(tmp_path, m1=document(innings("A", [ball()])))
    (tmp_path / "broken.json").write_text('{"meta": ')
    docs = read_match_documents(spark, str(tmp_path))
    found = rows(docs, "match_id", "meta.revision", "malformed_text")
    assert found == [("broken", None, '{"meta": '), ("m1", 1, None)]


def test_numeric_season_is_text(spark, tmp_path):
    bronze = flat(
        spark,
        tmp_path,
        m1=document(innings("A", [ball()]), season=2009),
        m2=document(innings("A", [ball()]), season="2007/08"),
    )
    assert rows(bronze, "season") == [("2007/08",), ("2009",)]


def test_positions(spark, tmp_path):
    doc = document(
        innings("A", [ball(runs=1), ball(runs=2)], [ball(runs=3)]), innings("B", [ball(runs=4)])
    )
    bronze = flat(spark, tmp_path, m1=doc)
    assert rows(bronze, "innings_number", "over_number", "delivery_index", "runs_batter") == [
        (1, 0, 0, 1),
        (1, 0, 1, 2),
        (1, 1, 0, 3),
        (2, 0, 0, 4),
    ]


def test_innings_without_overs_and_overs_without_balls_give_no_rows(spark, tmp_path):
    doc = document({"team": "A"}, innings("B", [], [ball(runs=5)]))
    bronze = flat(spark, tmp_path, m1=doc, m2=document())
    assert rows(bronze, "match_id", "innings_number", "over_number") == [("m1", 2, 1)]


def test_bowling_team_defaults_to_the_first(spark, tmp_path):
    doc = document(innings("A", [ball()]), innings("B", [ball()]), innings("C", [ball()]))
    bronze = flat(spark, tmp_path, m1=doc)
    assert rows(bronze, "batting_team", "bowling_team") == [("A", "B"), ("B", "A"), ("C", "A")]


@pytest.mark.parametrize(
    ("outcome", "expected"),
    [
        ({"winner": "A", "by": {"runs": 0}}, ("run", 0)),
        ({"winner": "A", "by": {"runs": 12, "wickets": 3}}, ("run", 12)),
        ({"winner": "B", "by": {"wickets": 4}}, ("wickets", 4)),
        ({"result": "tie", "eliminator": "A"}, ("tie", 0)),
        ({"result": "no result"}, ("unknown", 0)),
    ],
)
def test_win_type_and_margin(spark, tmp_path, outcome, expected):
    bronze = flat(spark, tmp_path, m1=document(innings("A", [ball()]), outcome=outcome))
    assert rows(bronze, "win_type", "win_margin") == [expected]


def test_legal_means_no_wides_and_no_noballs_recorded(spark, tmp_path):
    extras = ({"wides": 1}, {"noballs": 1}, {"byes": 1}, {"legbyes": 2}, {"wides": 0})
    doc = document(innings("A", [ball(extras=e) for e in extras]))
    legal = rows(flat(spark, tmp_path, m1=doc), "delivery_index", "is_legal_delivery")
    assert [flag for _, flag in legal] == [False, False, True, True, False]


def test_only_the_first_wicket_and_fielder_count(spark, tmp_path):
    wickets = [
        {"player_out": "A1", "kind": "caught", "fielders": [{"name": "B2"}, {"name": "B3"}]},
        {"player_out": "A2", "kind": "run out"},
    ]
    doc = document(innings("A", [ball(wickets=wickets), ball(wickets=[]), ball()]))
    bronze = flat(spark, tmp_path, m1=doc)
    found = rows(
        bronze, "delivery_index", "is_wicket", "player_out", "dismissal_kind", "fielder"
    )
    assert found == [
        (0, 1, "A1", "caught", "B2"),
        (1, 1, None, None, None),
        (2, 0, None, None, None),
    ]


def test_empty_arrays_read_as_null(spark, tmp_path):
    doc = document(innings("A", [ball()]), dates=[], teams=[], player_of_match=[])
    bronze = flat(spark, tmp_path, m1=doc)
    assert rows(bronze, "match_date", "team_1", "team_2", "player_of_match") == [(None,) * 4]


def test_absent_fields_read_as_null(spark, tmp_path):
    doc = {"meta": {"revision": 1}, "info": {}, "innings": [innings("A", [ball()])]}
    bronze = flat(spark, tmp_path, m1=doc)
    assert rows(bronze, "season", "city", "win_type", "win_margin") == [(None, None, "unknown", 0)]


def test_super_over_is_any_recorded_flag(spark, tmp_path):
    doc = document(
        innings("A", [ball()]),
        innings("B", [ball()], super_over=True),
        innings("A", [ball()], super_over=False),
    )
    bronze = flat(spark, tmp_path, m1=doc, m2=document(innings("A", [ball()])))
    assert rows(bronze, "match_id", "innings_number", "is_super_over") == [
        ("m1", 1, 0),
        ("m1", 2, 1),
        ("m1", 3, 1),
        ("m2", 1, 0),
    ]
    assert rows(ops.dim_match(bronze), "match_id", "has_super_over") == [("m1", 1), ("m2", 0)]


def test_dim_match_keeps_every_combination_under_one_flag(spark, tmp_path):
    bronze = flat(spark, tmp_path, m1=document(innings("A", [ball()])))
    other = bronze.withColumn("city", F.lit("Elsewhere")).withColumn("is_super_over", F.lit(1))
    found = rows(ops.dim_match(bronze.union(other)), "city", "has_super_over")
    assert found == [("Elsewhere", 1), ("Town", 1)]


def test_officials_are_in_no_squad(spark, tmp_path):
    people = {"Kaya": "p7", "Ilse": "p3", "Tomo": "p9", "Ref One": "u1", "Ref Two": "u2"}
    league = {
        "m1": {"Reds": ["Kaya", "Tomo"], "Blues": ["Ilse"]},
        "m2": {"Blues": ["Ilse", "Kaya"], "Greens": []},
    }
    documents = {
        match: document(innings("Reds", [ball("Kaya")]), registry={"people": people}, players=squads)
        for match, squads in league.items()
    }
    docs = read_match_documents(spark, write(tmp_path, **documents))
    registry = ops.match_player_registry(docs)
    assert rows(ops.player_registry(registry)) == [("p3", "Ilse"), ("p7", "Kaya"), ("p9", "Tomo")]
    expected = sorted(
        (match, name, people[name], team)
        for match, squads in league.items()
        for team, names in squads.items()
        for name in names
    )
    assert rows(registry) == expected
    assert rows(ops.match_player_registry(docs, distinct=False)) == expected


def test_matches_straight_from_documents(spark, tmp_path):
    documents = {
        "m1": document(innings("A", [ball()]), innings("B", [ball()], super_over=True)),
        "m2": document(innings("A", [ball()]), innings("B", super_over=True)),
        "m3": document(innings("A", [])),
        "m4": document(),
        "m5": {"meta": {"revision": 1}, "innings": [{"team": "A", "overs": [{"over": 0}]}]},
        "m6": {"innings": [{"overs": [{"deliveries": [ball()]}]}]},
    }
    docs = read_match_documents(spark, write(tmp_path, **documents))
    found = ops.dim_match_from_documents(docs)
    assert rows(found, "match_id", "has_super_over") == [("m1", 1), ("m2", 0), ("m6", 0)]
    assert rows(found) == rows(ops.dim_match(ops.flatten_deliveries(docs)))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_facts_move_the_balls_once(spark, tmp_path):
    docs = read_match_documents(spark, write(tmp_path, m1=document(innings("A", [ball()]))))
    ops.flatten_deliveries(docs, at()).write.parquet(f"{tmp_path}/b")
    ops.match_player_registry(docs).write.parquet(f"{tmp_path}/r")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = ops.fact_delivery(
            spark.read.parquet(f"{tmp_path}/b"), spark.read.parquet(f"{tmp_path}/r")
        )
        plan = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange hashpartitioning") == 2


def test_squad_names_without_an_id_are_left_out(spark, tmp_path):
    doc = document(innings("A", [ball()]), players={"A": ["A1", "A1", "Nobody"], "B": []})
    docs = read_match_documents(spark, write(tmp_path, m1=doc))
    assert rows(ops.match_player_registry(docs), "player_name", "team") == [("A1", "A")]


def test_name_variants(spark):
    registry = spark.createDataFrame(
        [("m1", "Z", "p1", "A"), ("m2", "Y", "p1", "A"), ("m3", "Z", "p1", "A")],
        "match_id string, player_name string, player_id string, team string",
    )
    assert rows(ops.dim_player(registry)) == [("p1", ["Y", "Z"])]


def resolved(spark, folder, doc):
    docs = read_match_documents(spark, write(folder, m1=doc))
    bronze, registry = ops.flatten_deliveries(docs, at()), ops.match_player_registry(docs)
    facts = ops.fact_delivery(bronze, registry)
    assert rows(facts) == rows(ops.fact_from_documents(docs, at()))
    return bronze, facts


def test_names_become_ids_and_unknown_names_null(spark, tmp_path):
    caught = [{"player_out": "A1", "kind": "caught", "fielders": [{"name": "Substitute"}]}]
    doc = document(innings("A", [ball(wickets=caught), ball(batter=None, bowler="Umpire")]))
    _, facts = resolved(spark, tmp_path, doc)
    roles = [c for c in facts.columns if c.startswith("player_id")]
    assert rows(facts, "delivery_index", *roles) == [
        (0, "id-A1", "id-B1", "id-A2", "id-A1", None),
        (1, None, None, "id-A2", None, None),
    ]


def test_name_in_both_squads_repeats_the_ball_per_role(spark, tmp_path):
    squads = {"A": ["A1", "A2", "B1"], "B": ["B1", "A2"]}
    doc = document(innings("A", [ball(), ball(bowler="A1", non_striker="A1")]), players=squads)
    bronze, facts = resolved(spark, tmp_path, doc)
    assert rows(facts.groupBy("delivery_index").count()) == [(0, 4), (1, 1)]
    audit = rows(ops.fact_audit(bronze, facts))
    assert audit == [("m1", 2, 5, 0, False)]


def test_audit_counts_unknown_batters(spark, tmp_path):
    doc = document(innings("A", [ball(), ball(batter="Nobody")]))
    bronze, facts = resolved(spark, tmp_path, doc)
    assert rows(ops.fact_audit(bronze, facts)) == [("m1", 2, 2, 1, True)]


def test_a_changed_ball_is_caught_where_counts_agree(spark, tmp_path):
    balls = [ball("A1", runs=1), ball("A2", runs=4), ball("A1", runs=2)]
    folder = write(tmp_path, m1=document(innings("A", balls)), m2=document(innings("A", balls)))
    docs = read_match_documents(spark, folder)
    bronze, facts = ops.flatten_deliveries(docs), ops.fact_from_documents(docs)
    runs = F.when((F.col("match_id") == "m2") & (F.col("runs_batter") < 4), 3 - F.col("runs_batter"))
    swapped = facts.withColumn("runs_batter", F.coalesce(runs, F.col("runs_batter")))
    audit = ops.content_audit(bronze, swapped.repartition(3))
    assert rows(audit, "match_id", "reconciled", "content_equal") == [("m1", True, True), ("m2", True, False)]
    doubled = facts.where("match_id = 'm1'").unionByName(facts.where("match_id = 'm2' and runs_batter <> 4"))
    doubled = doubled.unionByName(facts.where("match_id = 'm2' and runs_batter = 1"))
    audit = ops.content_audit(bronze, doubled)
    assert rows(audit, "match_id", "reconciled", "content_equal") == [("m1", True, True), ("m2", True, False)]
    gone = ops.content_audit(bronze, facts.limit(0))
    assert rows(gone, "match_id", "reconciled", "content_equal") == [("m1", False, False), ("m2", False, False)]
