"""Season totals that matches are added to and taken from.

A match contributes rows with a sign: 1 where it comes, -1 where it goes. The
sum by key is the new state; keys that sum to nothing are gone. A greatest score
cannot be taken back by subtraction, so batting keeps how often each score occurs.
All functions expect ``season`` beside the match's rows.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.functions import overs_text
from scorebook.schema import columns

_BATTED = ("balls_faced", "fours", "sixes", "dot_balls", "not_outs")
_BOWLED = ("balls_bowled", "wides", "noballs", "dot_balls", "wickets")
_KEYS = {
    "player_names": ("player_id", "player_name"),
    "season_players": ("season", "player_id"),
    "season_batting": ("season", "player_id", "player_name", "team", "is_score", "runs"),
    "season_bowling": ("season", "player_id", "player_name", "team"),
}
_COUNT = {"player_names": "entries", "season_players": "matches"}


def _signed(rows: DataFrame, sign: int, *added: str) -> DataFrame:
    return rows.withColumns({name: F.col(name) * sign for name in added})


def name_changes(registry: DataFrame, sign: int) -> DataFrame:
    """Squad entries by player and name."""
    counts = registry.groupBy("player_id", "player_name").agg(F.count(F.lit(1)).alias("entries"))
    return _signed(counts, sign, "entries")


def player_changes(registry: DataFrame, sign: int) -> DataFrame:
    """Matches by season and player; two squads of one match count once."""
    once = registry.groupBy("match_id", "season", "player_id").agg(F.lit(sign).cast("long").alias("matches"))
    return once.groupBy("season", "player_id").agg(F.sum("matches").alias("matches"))


def batting_changes(batting: DataFrame, sign: int) -> DataFrame:
    """Scores with their innings, and everything else by match."""
    who = {"player_id": "player_id_batter", "player_name": "batter_name", "team": "batting_team"}
    card = batting.select(
        "season",
        "match_id",
        *(F.col(old).alias(new) for new, old in who.items()),
        "runs",
        F.col("not_out").cast("long").alias("not_outs"),
        *(name for name in _BATTED if name != "not_outs"),
    )
    key = ("season", *who)
    zero = F.lit(0).cast("long")
    scores = card.groupBy(*key, "runs").agg(F.count(F.lit(1)).alias("n"))
    scores = scores.select(
        *key, F.lit(True).alias("is_score"), "runs", "n", *(zero.alias(name) for name in _BATTED)
    )
    by_match = card.groupBy(*key, "match_id").agg(*(F.sum(name).alias(name) for name in _BATTED))
    lines = by_match.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(name).alias(name) for name in _BATTED)
    )
    lines = lines.select(
        *key, F.lit(False).alias("is_score"), F.lit(None).cast("long").alias("runs"), "n", *_BATTED
    )
    return _signed(scores.unionByName(lines), sign, "n", *_BATTED)


def bowling_changes(bowling: DataFrame, sign: int) -> DataFrame:
    """``charged`` counts the innings whose runs conceded are known."""
    who = {"player_id": "player_id_bowler", "player_name": "bowler_name", "team": "bowling_team"}
    card = bowling.withColumns({new: F.col(old) for new, old in who.items()})
    key = ("season", *who)
    added = ("charged", "runs_conceded", *_BOWLED)
    by_match = card.groupBy(*key, "match_id").agg(
        F.count("runs_conceded").alias("charged"),
        F.sum(F.coalesce("runs_conceded", F.lit(0))).alias("runs_conceded"),
        *(F.sum(name).alias(name) for name in _BOWLED),
    )
    lines = by_match.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(name).alias(name) for name in added)
    )
    return _signed(lines, sign, "n", *added)


def summed(table: str, *rows: DataFrame) -> DataFrame:
    """The state after all changes; grouping takes equal nulls for one key."""
    keys, count = _KEYS[table], _COUNT.get(table, "n")
    added = [name for name in columns(table) if name not in keys]
    union = reduce(DataFrame.unionByName, (r.select(*keys, *added) for r in rows))
    return (
        union.groupBy(*keys).agg(*(F.sum(name).alias(name) for name in added)).where(F.col(count) != 0)
    )


def _total(value: Column, known: Column) -> Column:
    """A sum over known values, null where there are none."""
    return F.when(known > 0, value)


def batting_totals(state: DataFrame) -> DataFrame:
    """What ``batting_season_stats`` gives, from the state."""
    n, runs, score = F.col("n"), F.col("runs"), F.col("is_score")
    return state.groupBy(
        F.col("player_id").alias("player_id_batter"), F.col("player_name").alias("batter_name"), "season", "team"
    ).agg(
        F.sum(F.when(~score, n)).alias("innings"),
        F.sum(F.when(score, n * runs)).alias("runs"),
        F.max(F.when(score, runs)).alias("highest_score"),
        *(F.sum(name).alias(name) for name in _BATTED),
        F.sum(F.when(score & (runs >= 50) & (runs < 100), n).otherwise(0)).alias("fifties"),
        F.sum(F.when(score & (runs >= 100), n).otherwise(0)).alias("hundreds"),
    )


def bowling_totals(state: DataFrame) -> DataFrame:
    """What ``bowling_season_stats`` gives, from the state."""
    return state.select(
        F.col("player_id").alias("player_id_bowler"),
        F.col("player_name").alias("bowler_name"),
        "season",
        "team",
        F.col("n").alias("innings"),
        _total(F.col("runs_conceded"), F.col("charged")).alias("runs_conceded"),
        overs_text(F.col("balls_bowled")).alias("overs_bowled"),
        *_BOWLED,
    )


def matches_played(state: DataFrame) -> DataFrame:
    return state.select("player_id", "season", F.col("matches").alias("matches_played"))
