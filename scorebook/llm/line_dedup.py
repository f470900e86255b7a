"""Line dedup with levelled sorted runs of line hashes, in DataFrame functions only.

A run is a table of line keys and the number of documents that have them,
sorted by key. Each batch of documents counts its keys, drops those already
known to be frequent by a merge anti-join with the runs, and adds the others as
a run of its own. When a level holds ``fan_out`` runs they are merged into one
run of the next level, so that n batches leave about log n runs to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.shared import WHITE_SPACE, fresh, row_key, scratch, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column, least: int = 1) -> Column:
    """Hash of a line without white space at its ends and with A-Z lower-cased.

    Null for keys of fewer than ``least`` code points, which are never dropped.
    """
    key = F.btrim(line, F.lit(WHITE_SPACE))
    ascii_only = F.length(key) == F.octet_length(key)
    folded = F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))
    return F.when(F.length(key) >= least, F.xxhash64(folded))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """The runs of one corpus, in ``folder``. ``add`` takes one batch after the other."""

    def __init__(self, spark: SparkSession, folder: str, frequent: int, fan_out: int = 3):
        self.spark, self.folder = spark, folder
        self.frequent, self.fan_out = frequent, fan_out
        self.levels: list[list[str]] = [[]]
        self._written = 0

    def read(self) -> DataFrame:
        """(key, n) over all runs; a key may be in several."""
        paths = [path for level in self.levels for path in level]
        schema = "key long, n long"
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, counts: DataFrame) -> str:
        self._written += 1
        path = f"{self.folder}/run-{self._written}"
        counts.sortWithinPartitions("key").write.parquet(path)
        return path

    def add(self, keys: DataFrame) -> None:
        """``keys`` (key): one row for each document of the batch and key it has.

        Keys that a run already knows as frequent need no more counting. Counts
        stop at ``frequent``: what lies above it makes no difference.
        """
        counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        if any(self.levels):
            known = self.read().where(F.col("n") >= self.frequent).select("key")
            counts = counts.join(known.hint("merge"), "key", "left_anti")
        self.levels[0].append(self._write(counts))
        for at, level in enumerate(self.levels):
            if len(level) >= self.fan_out:
                if at + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[at + 1].append(self._write(self._merged(level)))
                self.levels[at] = []

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = self.spark.read.schema("key long, n long").parquet(*paths)
        return runs.groupBy("key").agg(F.least(F.sum("n"), F.lit(self.frequent)).alias("n"))

    def frequent_keys(self) -> DataFrame:
        total = self.read().groupBy("key").agg(F.sum("n").alias("n"))
        return total.where(F.col("n") >= self.frequent).select("key")


def drop_frequent_lines(
    documents: DataFrame,
    frequent: int = 10,
    least: int = 1,
    batches: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``documents`` with two more columns: lines (before) and lines dropped; the text is
    what is left. Their names are ``n_lines`` and ``n_dropped``, underscored if taken.

    Keys found in ``frequent`` or more rows lose all their lines. A null text
    becomes one empty line, which has no key and stays. Every row counts as a
    document, repeated rows too. A text all of whose lines go becomes empty. The
    corpus passes through the runs in ``batches`` by row hash. Texts are moved
    once, to the list of their frequent keys, which is no longer than the text.
    """
    spark = documents.sparkSession
    row, frequent_column, before, left, n_lines, n_dropped = fresh(
        documents, "row", "frequent", "before", "left", "n_lines", "n_dropped"
    )
    named = documents.withColumn(row, row_key(id_column, text_column))
    folder = scratch(spark, "line-runs")
    keys = F.array_distinct(
        F.array_compact(F.transform(lines_of(F.col(text_column)), lambda x: line_key(x, least)))
    )
    rows = named.select(
        F.col(row).alias("row"), keys.alias("keys"), F.pmod(F.col(row), F.lit(batches)).alias("batch")
    ).where(F.size("keys") > 0)
    rows.write.partitionBy("batch").parquet(f"{folder}/keys")
    schema = "row long, keys array<long>, batch int"
    rows = spark.read.schema(schema).parquet(f"{folder}/keys")
    runs = LineRuns(spark, folder, frequent)
    for batch in range(batches):
        runs.add(rows.where(F.col("batch") == batch).select(F.explode("keys").alias("key")))
    exploded = rows.select("row", F.explode("keys").alias("key"))
    # Stored, so that both sides of the join are plain exchanges: a key that most
    # documents have is then split over tasks.
    known = stored(runs.frequent_keys(), "frequent-lines")
    dropped = (
        exploded.join(known, "key", "left_semi")
        .groupBy(F.col("row").alias(row))
        .agg(F.collect_set("key").alias(frequent_column))
    )
    hit, lines = F.col(frequent_column), lines_of(F.col(text_column))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(hit, line_key(x, least)), F.lit(False)))
    count = lambda of: F.length(of) - F.length(F.replace(of, F.lit("\n"))) + 1
    joined = named.join(dropped, row, "left").select(
        *(c for c in documents.columns if c != text_column),
        F.coalesce(F.col(text_column), F.lit("")).alias(before),
        F.when(hit.isNotNull(), kept).alias(left),
    )
    text = F.coalesce(F.array_join(left, "\n"), F.col(before))
    total = count(F.col(before)).cast("long")
    return joined.select(
        *(text.alias(c) if c == text_column else F.col(c) for c in documents.columns),
        total.alias(n_lines),
        F.coalesce(total - F.size(left), F.lit(0)).cast("long").alias(n_dropped),
    )
