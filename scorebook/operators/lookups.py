"""Small look-ups on the finished tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_win_types(matches: DataFrame) -> DataFrame:
    return matches.select("win_type").distinct()


def distinct_dismissal_kinds(fact: DataFrame) -> DataFrame:
    return fact.select("dismissal_kind").distinct()


def player_season_lookup(stats: DataFrame, name_pattern: str, season: str) -> DataFrame:
    """A season's rows of the players whose name is LIKE the pattern."""
    return stats.where(F.col("player_name").like(name_pattern) & (F.col("season") == season))
