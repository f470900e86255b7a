"""Parquet tables under one root folder.

Every table that grows with the matches is partitioned by season, also those
whose own columns have no season. These are plain sinks, replaced by season;
``scorebook.sources.store`` keeps the tables of the incremental run.
"""

from collections.abc import Callable, Collection
from functools import partial
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from scorebook.schema import MARTS, RUN_TABLES, TABLES, columns, ddl
from scorebook.sources.jobs import run_together

# View names that SQL users of the tables rely on.
SILVER_VIEWS = {
    "fact_del": "fact_delivery",
    "dim_match": "dim_match",
    "dim_player": "dim_player",
    "match_player_registry": "match_player_registry",
}

#: Rows of a file: a bound on its size, and on what a reader of one file holds.
FILE_ROWS = 4_000_000
_BY_BALL = ("match_id", "innings_number", "over_number", "delivery_index")
#: What the files of a table are sorted by within a partition, so that column statistics let readers
#: skip most of them: for one match, or for names that begin alike.
ORDER = {
    "bronze": _BY_BALL,
    "fact_delivery": _BY_BALL,
    "batting_scorecard": ("match_id", "innings_number", "batting_position"),
    "bowling_scorecard": ("match_id", "innings_number"),
    "team_match_summary": ("match_id", "innings_number"),
    "match_player_registry": ("match_id", "team"),
    "player_season_stats": ("player_name", "player_id"),
    "dim_player": ("player_id",),
}
#: Columns that are looked up by equal values get a Bloom filter in every file.
LOOKED_UP = {
    "batting_scorecard": ("match_id",),
    "bowling_scorecard": ("match_id",),
    "fact_delivery": ("match_id",),
    "player_season_stats": ("player_name", "player_id"),
}

_UNPARTITIONED = {"dim_player", "manifest_history"}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def season_in(seasons: Collection[str | None], column: str = "season") -> Column:
    """Season filter that also finds the NULL season."""
    named = [season for season in seasons if season is not None]
    found = F.col(column).isin(named)
    return found | F.col(column).isNull() if None in seasons else found


def _season_field(table: str) -> list[str]:
    """The partition column, for tables whose own columns do not include it."""
    return [] if table in _UNPARTITIONED or "season" in TABLES[table] else ["season string"]


def no_rows(spark: SparkSession, fields: dict[str, str]) -> DataFrame:
    return spark.range(0).select(
        *(F.lit(None).cast(kind).alias(name) for name, kind in fields.items())
    )


def create_tables(spark: SparkSession, root: str):
    """Lay down an empty table wherever there is none yet."""

    def create(table: str):
        if table in _UNPARTITIONED:
            writer = no_rows(spark, TABLES[table]).write
        else:
            fields = {**TABLES[table], "season": "string"}
            writer = no_rows(spark, fields).write.partitionBy("season")
        writer.mode("ignore").parquet(table_path(root, table))

    run_together(*(partial(create, table) for table in TABLES if table not in RUN_TABLES))


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    seasons: Collection[str | None] | None = None,
    with_season: bool = False,
) -> DataFrame:
    """A table; ``seasons`` prunes partitions, ``with_season`` keeps their column."""
    extra = _season_field(table)
    # The schema is given because an all-digit season would be read as a number.
    df = spark.read.schema(ddl(table, *extra)).parquet(table_path(root, table))
    if seasons is not None:
        df = df.where(season_in(seasons))
    return df.select(*columns(table), *(["season"] if with_season and extra else []))


def _laid_out(df: DataFrame, partition_by: str, rebalance: bool) -> DataFrame:
    """Rows gathered by partition value, each value in as many tasks as its size asks for.

    That is neither one task per value, so a season holding a third of the rows
    is split, nor a file per task and value. Not needed for input that already
    comes value by value.
    """
    return df.hint("rebalance", F.col(partition_by)) if rebalance else df


def sorted_files(df: DataFrame, table: str, partition_by: tuple[str, ...]) -> DataFrame:
    """Each task's rows by partition and then in the table's ``ORDER``; no row changes its task."""
    order = [c for c in ORDER.get(table, ()) if c not in partition_by]
    return df.sortWithinPartitions(*partition_by, *order) if order else df


def writer(df: DataFrame, table: str = "") -> DataFrameWriter:
    """Files of at most ``FILE_ROWS`` rows, with Bloom filters where the table is looked up by value."""
    found = df.write.mode("overwrite").option("maxRecordsPerFile", FILE_ROWS)
    for column in LOOKED_UP.get(table, ()):
        found = found.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return found


def _overwrite_partitions(df: DataFrame, path: str, partition_by: str, table: str = ""):
    (
        writer(sorted_files(df, table, (partition_by,)), table)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, partition_by: str = "season", rebalance: bool = True):
    """Replace the partitions that occur in ``df``, leave the others alone."""
    _overwrite_partitions(_laid_out(df, partition_by, rebalance), path, partition_by)


def write_seasons(
    df: DataFrame,
    root: str,
    table: str,
    seasons: Collection[str | None],
    rebalance: bool = True,
) -> int:
    """Make ``df`` the whole content of ``seasons``; returns the rows written.

    A season that ``df`` leaves empty has no partition to replace, so its old
    files are cleared afterwards. Which seasons were written is observed during
    the write itself, without a second pass.
    """
    # An empty name ends up in the same partition as no name.
    named = df.withColumn("season", F.nullif("season", F.lit("")))
    seen = Observation()
    # Observed after the exchange, which Spark drops if it turns out empty.
    observed = _laid_out(named, "season", rebalance).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("season").isNull()).alias("unnamed"),
        F.collect_set("season").alias("seasons"),
    )
    _overwrite_partitions(observed, table_path(root, table), "season", table)
    written = set(seen.get["seasons"]) | ({None} if seen.get["unnamed"] else set())
    _clear_seasons(df.sparkSession, root, table, set(seasons) - written)
    return seen.get["rows"]


def _clear_seasons(spark: SparkSession, root: str, table: str, seasons: set[str | None]):
    if not seasons:
        return
    fields = {name: kind for name, kind in TABLES[table].items() if name != "season"}
    partitions = (
        spark.read.schema(ddl(table, *_season_field(table)))
        .parquet(table_path(root, table))
        .where(season_in(seasons))
        .select(F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("folder"))
        .distinct()
    )
    # One row per emptied season, not per match or delivery.
    for partition in partitions.collect():
        no_rows(spark, fields).write.mode("overwrite").parquet(unquote(partition.folder))


def write_players(players: DataFrame, root: str):
    """Replace the player dimension, the one table that spans all seasons."""
    players.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        table_path(root, "dim_player")
    )


def register_views(spark: SparkSession, read: Callable[[str], DataFrame]):
    """Temporary views over the silver and gold tables, for SQL users.

    ``read`` gives a table by name: ``Store(spark, root).read``, or a partial
    of ``read_table``.
    """
    for view, table in {**SILVER_VIEWS, **{name: name for name in MARTS}}.items():
        read(table).createOrReplaceTempView(view)
