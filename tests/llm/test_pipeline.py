import duckdb
import pytest
from scorebook.llm.queries import QUERIES, SQL

import corpus_pipeline
from tests.llm.conftest import FOLDER, prose


@pytest.mark.parametrize("name", SQL)
def test_queries_against_sql(spark, name):
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = QUERIES[name](spark, str(FOLDER))
    expected = connection.sql(SQL[name]).select(*found.columns)
    rows = sorted(map(str, map(tuple, found.collect())))
    assert rows and rows == sorted(map(str, expected.fetchall()))


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


@pytest.fixture
def folder(spark, make, tmp_path):
    """Junk, a frequent line, copies, a leak and clean documents."""
    item = prose(7777, 40)
    rows = [(i, prose(i, 120), "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, prose(200 + i, 60) + "\nThe same footer.", "en", "s0") for i in range(12)]
    rows += [(200, rows[5][1], "en", "s1"), (201, prose(6, 120) + " " + item + " " + prose(8, 9), "en", "s2")]
    rows += [(300 + i, "!!! ### ||| " * 40 + prose(i, 3), "en", "s1") for i in range(20)]
    make(rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 300), 0) for i, *_ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_every_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append({r["doc_id"]: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {*range(40), *range(100, 112)}
    quality, lines, groups, decontaminated, mixed = kept
    assert set(quality) == clean | {200, 201}
    assert not any("footer" in r["text"] for r in lines.values()) and set(lines) == set(quality)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())
    assert set(groups) == clean | {201}
    assert set(decontaminated) == clean
    assert set(mixed) <= clean and all(r["copies"] > 0 for r in mixed.values())
    words = {s: sum(r["taken"] for r in mixed.values() if r["source"] == s) for s in ("s0", "s1", "s2")}
    targets = {r["source"]: r["target"] for r in mixed.values()}
    assert words == pytest.approx(targets, rel=0.05)
    whole = {r["doc_id"]: r["taken"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert whole == {i: r["taken"] for i, r in mixed.items()}


def test_no_documents(spark, folder, empty, tmp_path):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.collect() == []
