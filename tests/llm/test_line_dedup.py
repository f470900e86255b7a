import re
from collections import Counter

from pyspark.sql import functions as F
from scorebook.llm.line_dedup import LineRuns, drop_frequent_lines
from scorebook.llm.shared import scratch

UPPER = {c: c + 32 for c in range(65, 91)}


def key(line):
    return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(UPPER)


def brute_force(rows, frequent):
    counts = Counter(k for _, t, *_ in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if counts[key(x)] < frequent]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


def check(df, rows, frequent, **options):
    found = drop_frequent_lines(df, frequent=frequent, **options)
    names = [c for c in found.columns if c.endswith("n_lines")][-1], found.columns[-1]
    got = [(r["doc_id"], r[names[0]], r[names[1]], r["text"]) for r in found.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_force(rows, frequent)))
    assert found.columns[: len(df.columns)] == df.columns


def test_frequent_lines_go(make, odd_rows):
    rows = list(odd_rows)
    for i in range(12):
        rows.append((20 + i, f"Own {i}\n  THE Footer \nÉté\n\né{i % 3}\n{'footer' if i < 9 else ''}", "en", "a"))
    check(make(rows), rows, 10)
    check(make(rows), rows, 2, batches=7)
    check(make(rows), rows, 1, batches=1)


def test_empty(empty):
    assert drop_frequent_lines(empty).collect() == []


def test_runs_are_levelled_and_counts_add_up(spark):
    runs = LineRuns(spark, scratch(spark, "runs"), frequent=3, fan_out=2)
    for batch in range(5):
        runs.add(spark.createDataFrame([(k,) for k in (1, 2, 10 + batch, 10 + batch)], "key long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r["key"] for r in runs.frequent_keys().collect()) == [1, 2]
    counts = {r["key"]: r["n"] for r in runs.read().groupBy("key").agg(F.sum("n").alias("n")).collect()}
    assert counts[14] == 2 and counts[1] == 3  # a known frequent key is not counted on
