"""Checks on the built tables."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fact_audit(bronze: DataFrame, fact: DataFrame) -> DataFrame:
    """Per match: balls in bronze, rows in the fact, and rows without a known batter."""
    balls = bronze.groupBy("match_id").agg(F.count(F.lit(1)).alias("bronze_rows"))
    rows = fact.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("player_id_batter").isNull()).alias("null_batters"),
    )
    counts = ("bronze_rows", "fact_rows", "null_batters")
    audit = balls.join(rows, "match_id", "full").select(
        "match_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts)
    )
    return audit.withColumn("reconciled", F.col("bronze_rows") == F.col("fact_rows"))


#: What bronze and the fact say about a ball in the same words.
SHARED = (
    "innings_number",
    "batting_team",
    "bowling_team",
    "over_number",
    "delivery_index",
    "is_legal_delivery",
    "is_super_over",
    "runs_batter",
    "runs_extras",
    "runs_total",
    "extras_wides",
    "extras_noballs",
    "extras_byes",
    "extras_legbyes",
    "is_wicket",
    "dismissal_kind",
)


def _checksum() -> list[Column]:
    """Of a match's balls as a multiset: sums of two hashes of each ball, whatever their order.

    Exact sums of 64 bits each, so a ball that is missing, doubled or changed shows
    unless both hashes collide.
    """
    wide = (F.xxhash64(*SHARED), F.xxhash64(F.lit(1), *reversed(SHARED)))
    return [F.sum(h.cast("decimal(20,0)")) for h in wide]


def content_audit(bronze: DataFrame, fact: DataFrame) -> DataFrame:
    """``fact_audit`` with ``content_equal``: whether both hold the same balls, not just as many.

    Checksums are taken in the same aggregation as the counts; balls are not
    joined, sorted or moved for them.
    """
    first, second = _checksum()
    balls = bronze.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("bronze_rows"), F.struct(first, second).alias("bronze_sum")
    )
    rows = fact.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.count_if(F.col("player_id_batter").isNull()).alias("null_batters"),
        F.struct(first, second).alias("fact_sum"),
    )
    counts = ("bronze_rows", "fact_rows", "null_batters")
    return balls.join(rows, "match_id", "full").select(
        "match_id",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        (F.coalesce("bronze_rows", F.lit(0)) == F.coalesce("fact_rows", F.lit(0))).alias("reconciled"),
        F.col("bronze_sum").eqNullSafe(F.col("fact_sum")).alias("content_equal"),
    )


def mart_row_counts(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("mart"), "row_count")
        for name, df in marts.items()
    ]
    return reduce(DataFrame.unionByName, counts)
