"""Manifest, stored tables and the incremental run."""

import json
import os
from datetime import datetime, timezone
from functools import partial
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from matches import ball, document, innings, rows, write
from pyspark.sql import functions as F

from __spark_entry__ import queries
from scorebook import operators as ops
from scorebook import sources
from scorebook.plans import archive, build, build_arrivals, build_folder
from scorebook.schema import TABLES, ddl
from scorebook.sources import workspace
from scorebook.sources.jobs import run_together
from scorebook.sources.workspace import require_shared

MANIFEST = "match_id string, revision bigint, created string, data_version string, ingested_at int"


def test_due_are_the_unseen_and_the_revised(spark):
    known = spark.createDataFrame(
        [("same", 2), ("older", 3), ("newer", 1)], "match_id string, revision int"
    )
    found = spark.createDataFrame(
        [("same", 2), ("older", 2), ("newer", 2), ("unseen", 1), ("unseen too", None)],
        "match_id string, revision int",
    )
    due = ops.due_documents(found, known)
    assert rows(due, "match_id") == [("newer",), ("unseen",), ("unseen too",)]


def test_upsert_refreshes_revision_and_time_only(spark):
    old = spark.createDataFrame(
        [("kept", 1, "c1", "v1", 1), ("again", 1, None, "v1", 1)], MANIFEST
    )
    new = spark.createDataFrame(
        [("again", 3, "c2", "v2", 2), ("again", 2, "c9", "v9", 9), ("first", 1, "c2", "v2", 2)],
        MANIFEST,
    )
    assert rows(ops.upsert_manifest(old, new)) == [
        ("again", 3, None, "v1", 2),
        ("first", 1, "c2", "v2", 2),
        ("kept", 1, "c1", "v1", 1),
    ]


def stored(spark, root, table, **kwargs):
    return rows(sources.read_table(spark, root, table, **kwargs))


def summary_row(match_id, runs, season):
    return (match_id, 1, "A", "B", runs, 0, 6, 0, "run", "1.0", None, None, season)


def write_summaries(spark, root, seasons, *summaries):
    df = spark.createDataFrame(summaries, ddl("team_match_summary", "season string"))
    sources.write_seasons(df, root, "team_match_summary", seasons)


def test_writing_replaces_the_named_seasons_only(spark, tmp_path):
    root = str(tmp_path)
    sources.create_tables(spark, root)
    first = [summary_row(m, 1, s) for m, s in (("a", "2007/08"), ("b", "2009"), ("c", None))]
    write_summaries(spark, root, ["2007/08", "2009", None], *first)
    write_summaries(spark, root, ["2009"], summary_row("d", 2, "2009"))
    left = sources.read_table(spark, root, "team_match_summary", with_season=True)
    assert rows(left, "match_id", "season") == [("a", "2007/08"), ("c", None), ("d", "2009")]
    pruned = sources.read_table(spark, root, "team_match_summary", seasons=["2009", None])
    assert rows(pruned, "match_id") == [("c",), ("d",)]


@pytest.mark.parametrize("season", ["2007/08", "2009", None, "a b+%"])
def test_a_season_left_empty_is_cleared(spark, tmp_path, season):
    root = str(tmp_path)
    sources.create_tables(spark, root)
    write_summaries(
        spark, root, [season, "x"], summary_row("a", 1, season), summary_row("b", 1, "x")
    )
    write_summaries(spark, root, [season, "y"], summary_row("a", 2, "y"))
    left = sources.read_table(spark, root, "team_match_summary", with_season=True)
    assert rows(left, "match_id", "season") == [("a", "y"), ("b", "x")]


def test_nothing_left_at_all(spark, tmp_path):
    root = str(tmp_path)
    sources.create_tables(spark, root)
    write_summaries(spark, root, ["x", ""], summary_row("a", 1, "x"), summary_row("b", 1, ""))
    assert len(stored(spark, root, "team_match_summary")) == 2
    write_summaries(spark, root, ["x", None])
    assert stored(spark, root, "team_match_summary") == []


def test_marts_can_be_partitioned_by_another_column(spark, tmp_path):
    df = spark.createDataFrame([("m1", 1), ("m2", 2)], "match_id string, runs int")
    sources.write_table(df, str(tmp_path), partition_by="match_id")
    again = df.where("runs = 2").withColumn("runs", F.lit(3))
    sources.write_table(again, str(tmp_path), "match_id")
    assert rows(spark.read.parquet(str(tmp_path)), "match_id", "runs") == [("m1", 1), ("m2", 3)]


def test_files_are_sorted_bounded_and_skipped(spark, tmp_path, monkeypatch):
    """By match in the facts' files, by name in the season mart: a lookup can skip most files."""
    monkeypatch.setattr("scorebook.sources.tables.FILE_ROWS", 50)
    store = sources.Store(spark, str(tmp_path), slices=2)
    names = F.concat(F.lit("P"), F.format_string("%04d", (F.col("id") * 37) % 1000))
    stats = spark.range(1000).select(F.col("id").cast("string").alias("player_id"), names.alias("player_name"))
    empty = store.read("player_season_stats").withColumn("season", F.lit("2016"))
    stats = empty.limit(0).unionByName(stats.withColumn("season", F.lit("2016")), allowMissingColumns=True)
    store.write("player_season_stats", stats)
    store.commit()
    files = [pq.read_table(f, columns=["player_name"]).column(0).to_pylist() for f in tmp_path.glob("player_season_stats/**/*.parquet")]
    assert sum(map(len, files)) == 1000 and max(map(len, files)) <= 50
    assert all(f == sorted(f) for f in files)
    assert sum(1 for f in files if f[0][:3] <= "P04" <= f[-1][:3]) <= 6 < len(files) / 3
    found = ops.player_season_lookup(store.read("player_season_stats"), "P04%", "2016")
    assert found.count() == 100
    plan = found._jdf.queryExecution().toString()
    assert "StringStartsWith(player_name,P04)" in plan
    balls = spark.createDataFrame(
        [(f"m{i % 7}", i % 2, i % 5, i % 3) for i in range(210)],
        "match_id string, innings_number int, over_number long, delivery_index int",
    )
    balls = store.read("fact_delivery").limit(0).unionByName(balls, allowMissingColumns=True)
    sources.write_seasons(balls.withColumn("season", F.lit("x")), str(tmp_path / "plain"), "fact_delivery", ["x"])
    files = [pq.read_table(f).select(["match_id", "innings_number", "over_number", "delivery_index"]).to_pylist()
             for f in tmp_path.glob("plain/fact_delivery/**/*.parquet")]
    assert sum(map(len, files)) == 210 and max(map(len, files)) <= 50
    assert all(f == sorted(f, key=lambda row: list(row.values())) for f in files)


def test_views_carry_the_tables(spark, tmp_path):
    root = str(tmp_path)
    sources.create_tables(spark, root)
    write_summaries(spark, root, ["x"], summary_row("a", 1, "x"))
    sources.register_views(spark, partial(sources.read_table, spark, root))
    assert rows(spark.sql("SELECT match_id FROM team_match_summary")) == [("a",)]
    for view in ("fact_del", "dim_match", "dim_player", "match_player_registry"):
        assert spark.table(view).count() == 0


def match(runs, season="2016", batter="A1", **kwargs):
    doc = document(
        innings("A", [ball(batter, runs=runs), ball("A2", runs=1)]),
        innings("B", [ball("B1", "A3", "B2", runs=2)]),
        season=season,
        **kwargs,
    )
    return doc


class Warehouse:
    """Tables built from a folder of documents."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.root = spark, folder, str(folder / "tables")
        (folder / "documents").mkdir(parents=True)

    def run(self, **documents):
        folder = write(self.folder / "documents", **documents)
        at = datetime(2024, 1, 1, tzinfo=timezone.utc)
        return build_folder(self.spark, folder, self.root, ingested_at=at)

    def read(self, table, **kwargs):
        return sources.Store(self.spark, self.root).read(table, **kwargs)

    def content(self):
        tables = set(TABLES) - {"manifest_history", "files"}
        return {t: rows(self.read(t, with_season=True)) for t in sorted(tables)}


def test_first_run_equals_the_plain_builders(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    documents = {"m1": match(3), "m2": match(50, season="2017"), "m3": match(8, season=None)}
    result = house.run(**documents)
    assert result.seasons == {"2016", "2017", None}
    assert result.rows["bronze"] == result.rows["fact_delivery"] == 9
    assert result.null_batters == 0 and result.quarantined == {}

    docs = sources.read_match_documents(spark, str(tmp_path / "documents"))
    registry, facts = ops.match_player_registry(docs), ops.fact_from_documents(docs)
    matches = ops.dim_match(ops.flatten_deliveries(docs))
    players = ops.dim_player(registry)
    batting = ops.batting_scorecard(facts, players)
    bowling = ops.bowling_scorecard(facts, players)
    expected = {
        "match_player_registry": registry,
        "dim_match": matches,
        "dim_player": players,
        "batting_scorecard": batting,
        "bowling_scorecard": bowling,
        "team_match_summary": ops.team_match_summary(facts, matches),
        "player_season_stats": ops.player_season_stats(registry, matches, batting, bowling),
    }
    for table, df in expected.items():
        assert rows(house.read(table)) == rows(df), table
    marts = {t: house.read(t) for t in ("bronze", "dim_match")}
    assert rows(ops.mart_row_counts(marts)) == [("bronze", 9), ("dim_match", 3)]
    assert rows(house.read("bronze", seasons=["2017", None]), "match_id") == [("m2",)] * 3 + [("m3",)] * 3


def test_nothing_due_leaves_everything_alone(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    assert house.run() is None
    assert house.run(m1=match(3)).rows["manifest"] == 1
    before = house.content()
    assert house.run(m1=match(99)) is None  # another file, but no greater revision
    assert house.content() == before


def parsed(monkeypatch):
    """Collects the paths handed to the reader."""
    seen = []
    real = sources.read_match_documents

    def read(spark, paths):
        seen.extend(p.rsplit("/", 1)[-1] for p in paths)
        return real(spark, paths)

    monkeypatch.setattr("scorebook.plans.incremental.read_match_documents", read)
    return seen


def test_only_new_files_are_opened(spark, tmp_path, monkeypatch):
    """Also one with an old time, and in reads of bounded size."""
    monkeypatch.setattr("scorebook.plans.incremental.FILES_AT_ONCE", 2)
    house = Warehouse(spark, tmp_path)
    house.run(**{f"m{i}": match(i) for i in range(5)})
    seen = parsed(monkeypatch)
    write(tmp_path / "documents", m9=match(9))
    os.utime(tmp_path / "documents" / "m9.json", (10**9, 10**9))
    assert house.run().rows["bronze"] == 3
    assert house.run() is None
    assert seen == ["m9.json"]
    assert len(rows(house.read("manifest"))) == 6


def partitions_written(house, table, run):
    """The partitions of a table that lie in the folders of a run, by the newest pointer."""
    found = sources.Store(house.spark, house.root).current.folders[table]
    return {folder for folder, name in found.items() if name.startswith(f"{run}-")}


def test_arrivals_are_read_once(spark, tmp_path, monkeypatch):
    """In batches, also under an old time or after a lost run; tables as from the whole folder."""
    seen = []

    def recorded(session, documents, *args):
        seen.append(sorted(row.match_id for row in documents.select("match_id").collect()))
        return build(session, documents, *args)

    monkeypatch.setattr("scorebook.plans.arrivals.build", recorded)
    root, folder = str(tmp_path / "tables"), tmp_path / "documents"
    write(folder, m1=match(3), m2=match(50, season="2017"), m3=match(8))
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    results = build_arrivals(spark, str(folder), root, at, files_at_once=2)
    assert sum(r.rows["bronze"] for r in results) == 9 and sorted(sum(seen, [])) == ["m1", "m2", "m3"]
    assert max(map(len, seen)) == 2
    seen.clear()
    assert build_arrivals(spark, str(folder), root, at) == [] and seen == []
    write(folder / "later", m1=match(77, revision=2), m4=match(4))
    os.utime(folder / "later" / "m4.json", (10**9, 10**9))
    (folder / "m5.json").write_text('{"info": {"season": "2016"')
    with monkeypatch.context() as broken:
        broken.setattr(sources.Store, "commit", lambda self: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivision"):
            build_arrivals(spark, str(folder), root, at)
    seen.clear()
    (result,) = build_arrivals(spark, str(folder), root, at)
    assert seen == [["m1", "m4", "m5"]] and result.quarantined == {"malformed": 1}
    store = sources.Store(spark, root)
    assert rows(store.read("quarantine"), "match_id") == [("m5",)]
    whole = Warehouse(spark, tmp_path / "whole")
    whole.run(m1=match(77, revision=2), m2=match(50, season="2017"), m3=match(8), m4=match(4))
    for table in ("player_season_stats", "batting_scorecard", "dim_player", "manifest"):
        assert rows(store.read(table)) == rows(whole.read(table))


def test_a_run_writes_the_partitions_of_its_batch(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    house.run(**{f"m{i}": match(i) for i in range(20)}, other=match(1, season="2017"))
    before = sources.Store(spark, house.root).current
    result = house.run(m99=match(9), m1=match(7, revision=2))
    counts = {t: result.rows[t] for t in ("bronze", "fact_delivery", "batting_scorecard", "dim_match")}
    assert counts == {"bronze": 6, "fact_delivery": 6, "batting_scorecard": 6, "dim_match": 2}
    assert len(rows(house.read("bronze"))) == 22 * 3
    store = sources.Store(spark, house.root)
    touched = store.partitions("bronze", spark.createDataFrame([("m1", "2016"), ("m99", "2016")], "match_id string, season string"))
    for table in ("bronze", "fact_delivery", "match_player_registry", "dim_match", "batting_scorecard"):
        written = partitions_written(house, table, 2)
        assert {f.partition("/")[0] for f in written} == {"season=2016"}
        assert len(written) == len(touched) < len(partitions_written(house, table, 1))
    # What the run before the last needed alone is removed, nothing that the last one reads.
    replaced = [f"{t}/run={r}/{f}" for t, found in before.folders.items() for f, r in found.items()
                if store.current.folders[t].get(f) != r]
    assert replaced and all((tmp_path / "tables" / folder).exists() for folder in replaced)
    content = house.content()
    archive(spark, house.root, datetime(2024, 2, 1))
    assert not any((tmp_path / "tables" / folder).exists() for folder in replaced)
    assert {t: c for t, c in house.content().items() if t != "manifest"} == {t: c for t, c in content.items() if t != "manifest"}


def test_of_two_runs_at_once_the_second_fails(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    house.run(m1=match(3))
    first, second = sources.Store(spark, house.root), sources.Store(spark, house.root)
    names = spark.createDataFrame([("p", "P", 1)], ddl("player_names"))
    for store in (first, second):
        store.write("player_names", names.withColumn("player_name", F.lit(store.run)), only=[(0,), (1,)])
    first.commit()
    content = house.content()
    with pytest.raises(sources.ConcurrentRunError):
        second.commit()
    assert house.content() == content
    # Also if both look before either has written, and the other's pointer is not complete yet.
    third, fourth = sources.Store(spark, house.root), sources.Store(spark, house.root)
    number = third.current.number
    third.write("player_names", names, only=[(0,)])
    pointer = tmp_path / "tables" / "pointers" / f"{number + 1:012d}"
    pointer.write_text('{"number": 3')
    assert house.content() == content and fourth.current.number == number
    third.commit()
    assert sources.Store(spark, house.root).current.number == number + 2
    with pytest.raises(sources.ConcurrentRunError):
        fourth.commit()


def test_changes_add_up_to_a_rebuild(spark, tmp_path):
    """Random batches of new and revised matches that move, lose players and rename them."""
    import random

    r = random.Random(4)
    house, latest = Warehouse(spark, tmp_path / "parts"), {}
    for batch in range(4):
        documents = {}
        for name in r.sample([f"m{i}" for i in range(12)], 6):
            doc = match(r.choice([0, 30, 50, 99, 100]), r.choice(["2016", "2017", None]), revision=batch + 1)
            if r.random() < 0.4:  # a player under another name, or in another's place
                doc["info"]["registry"]["people"]["A0"] = r.choice(["id-A1", "id-A0"])
                doc["info"]["players"]["A"].append("A0")
            if r.random() < 0.3:
                doc["info"]["players"]["A"].remove("A2")
            documents[name] = doc
        house.run(**documents)
        latest |= documents
    whole = Warehouse(spark, tmp_path / "whole")
    whole.run(**latest)
    assert house.content() == whole.content()
    read = house.read
    stats = ops.player_season_stats(
        *(read(t, with_season=True) for t in ("match_player_registry", "dim_match", "batting_scorecard", "bowling_scorecard"))
    )
    assert rows(read("player_season_stats")) == rows(stats)
    assert rows(read("dim_player")) == rows(ops.dim_player(read("match_player_registry")))


def test_batches_add_up_to_one_run(spark, tmp_path, monkeypatch):
    """With a revised match, an emptied season, a new name variant and lost runs."""
    revised = match(5, season="2017", revision=2, batter="A0")
    revised["info"]["registry"]["people"]["A0"] = "id-A1"
    revised["info"]["players"]["A"].append("A0")
    final = {
        "m1": match(3),
        "m2": revised,
        "m3": match(8, season="2017"),
        "m4": match(1, season="2018"),
    }
    whole = Warehouse(spark, tmp_path / "whole")
    whole.run(**final)

    house = Warehouse(spark, tmp_path / "parts")
    house.run(m1=final["m1"], m2=match(77, season="2015"))
    before = house.content()

    def fail(*_, **__):
        raise RuntimeError("lost")

    # Wherever a run stops, readers see the state before it, and it can be repeated.
    real, calls = sources.Store.save, []

    def stops_at(n):
        def save(self, *args, **how):
            calls.append(args[0])
            return fail() if len(calls) > n else real(self, *args, **how)

        return save

    for n in (0, 3, 7, 12):
        with monkeypatch.context() as broken:
            calls.clear()
            broken.setattr(sources.Store, "save", stops_at(n))
            with pytest.raises(RuntimeError, match="lost"):
                house.run(**final)
        assert house.content() == before
    with monkeypatch.context() as broken:
        broken.setattr(sources.Store, "commit", fail)
        with pytest.raises(RuntimeError, match="lost"):
            house.run(**final)
    assert house.content() == before

    result = house.run(**final)
    # 2015 is left empty; in 2016 only a display name changes.
    assert result.seasons == {"2015", "2016", "2017", "2018"}
    assert house.content() == whole.content()
    # Folders of lost runs go with the next commit.
    archive(spark, house.root)
    assert not list((tmp_path / "parts" / "tables" / "staging").iterdir())
    assert len(list((tmp_path / "parts" / "tables" / "bronze").glob("run=*"))) == 2


def test_unusable_documents_are_set_aside_and_the_rest_is_built(spark, tmp_path):
    both = {"A": ["A1", "A2", "A3", "B1"], "B": ["B1", "B2"]}
    house = Warehouse(spark, tmp_path)
    house.run(m1=match(1), m2=match(2))
    before = rows(house.read("bronze").where("match_id = 'm1'"))
    write(tmp_path / "documents" / "more", m3=match(4, revision=5))
    (tmp_path / "documents" / "m5.json").write_text('{"info": {"season": "2016"')
    result = house.run(
        m1=match(3, revision=2, players=both), m3=match(3), m4=match(3, players=both), m6=match(6)
    )
    assert result.quarantined == {"malformed": 1, "repeated in the batch": 1, "unreconciled": 2}
    assert rows(house.read("quarantine"), "match_id", "reason") == [
        ("m1", "unreconciled"),
        ("m3", "repeated in the batch"),
        ("m4", "unreconciled"),
        ("m5", "malformed"),
    ]
    assert rows(house.read("bronze").where("match_id = 'm1'")) == before
    assert rows(house.read("manifest"), "match_id", "revision") == [
        ("m1", 1), ("m2", 1), ("m3", 5), ("m6", 1)
    ]
    assert rows(house.read("batting_scorecard"), "match_id")[-1] == ("m6",)


def test_only_unusable_documents(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    doc = match(3, players={"A": ["A1", "A2", "A3", "B1"], "B": ["B1", "B2"]})
    assert house.run(m1=doc).quarantined == {"unreconciled": 1}
    assert rows(house.read("manifest")) == [] and rows(house.read("bronze")) == []
    assert house.run() is None


def test_documents_from_elsewhere(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    folder = write(tmp_path / "documents", m1=match(3), m2=match(5, season=""))
    docs = sources.read_match_documents(spark, folder)
    assert build(spark, docs, house.root).seasons == {"2016", None}
    assert build(spark, docs, house.root) is None
    assert len(rows(house.read("player_season_stats"))) == 12


def test_archiving_makes_every_document_due_again(spark, tmp_path):
    house = Warehouse(spark, tmp_path)
    house.run(m1=match(3), m2=match(5, season="2017"))
    before = house.content()
    at = datetime(2024, 2, 1)
    archive(spark, house.root, at)
    assert rows(house.read("manifest")) == []
    assert rows(house.read("manifest_history"), "match_id", "archived_at") == [("m1", at), ("m2", at)]
    house.run()
    assert house.content() == before
    archive(spark, house.root, at)
    assert house.read("manifest_history").count() == 4


def test_json_lines_carry_their_match_id(spark, tmp_path):
    lines = [json.dumps({"match_id": m, **match(3)}) for m in ("m1", "m2")]
    (tmp_path / "part.json").write_text("\n".join([*lines, "{broken"]))
    docs = sources.read_document_lines(spark, str(tmp_path))
    assert rows(docs, "match_id", "meta.revision") == [(None, None), ("m1", 1), ("m2", 1)]
    assert ops.flatten_deliveries(docs).count() == 6


def test_shared_folder_is_the_sessions(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert sources.new_folder(spark, "x").startswith(f"{shared}/x-")


def test_a_folder_of_one_machine_is_refused_on_a_cluster(spark, tmp_path, monkeypatch):
    assert require_shared(spark, f"{tmp_path}/") == str(tmp_path)
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    for folder in (str(tmp_path), f"file://{tmp_path}"):
        with pytest.raises(ValueError, match="executors"):
            sources.Store(spark, folder)
        with pytest.raises(ValueError, match="executors"):
            require_shared(spark, folder)


def test_a_mounted_folder_will_do_on_a_standalone_cluster(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    events = [(i, float(i % 7), "click", i % 5, None) for i in range(500)]
    events = spark.createDataFrame(events, "event_id long, value double, event_type string, user_id long, props string")
    events.withColumn("ts", F.lit("2024-06-01").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    assert queries()["archive_manifest"](spark, str(tmp_path)).count() > 0
    assert require_shared(spark, f"{tmp_path}/") == str(tmp_path)
    assert not [name for name in os.listdir(tmp_path) if "seen" in name]
    monkeypatch.setattr(workspace, "_seen_by_tasks", lambda spark, folder: False)
    with pytest.raises(ValueError, match="executors"):
        require_shared(spark, str(tmp_path))


@pytest.mark.parametrize(
    ("named", "context", "master", "expected"),
    [
        ("/a", "/b", "local-cluster[2,1,512]", "/a"),
        (None, "/b", "local-cluster[2,1,512]", "/b"),
        (None, None, "local-cluster[2,1,512]", "/warehouse"),
        (None, None, "local[2]", None),
    ],
)
def test_a_session_without_checkpoint_folder_has_its_warehouse(named, context, master, expected):
    held = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "/warehouse"}
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: held[key] or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: context),
    )
    assert sources.shared_folder(session) == expected
    if expected:
        assert sources.new_folder(session, "x").startswith(f"{expected}/x-")
    else:
        with pytest.raises(ValueError, match="checkpoint"):
            sources.new_folder(session, "x")


def test_jobs_side_by_side_keep_local_properties(spark):
    context = spark.sparkContext
    context.setLocalProperty("spark.scheduler.pool", "own")
    try:
        got = run_together(*[lambda: context.getLocalProperty("spark.scheduler.pool")] * 3)
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)
    assert got == ["own"] * 3
