"""Player totals per season."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.functions import average, overs_text, rate
from scorebook.schema import columns


def _with_match_season(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Stored tables lie by season and carry it; others get it from the match."""
    if "season" in rows.columns:
        return rows
    return rows.join(matches.select("match_id", "season"), "match_id", "left")


def player_matches(registry: DataFrame, matches: DataFrame) -> DataFrame:
    """Matches per player and season, for everyone named in a squad."""
    return (
        _with_match_season(registry, matches)
        .groupBy("player_id", "season")
        .agg(F.count_distinct("match_id").alias("matches_played"))
    )


def batting_season_stats(batting: DataFrame, matches: DataFrame) -> DataFrame:
    """Season batting totals. ``innings`` counts matches, ``not_outs`` counts innings."""
    runs = F.col("runs")
    return (
        _with_match_season(batting, matches)
        .groupBy("player_id_batter", "batter_name", "season", F.col("batting_team").alias("team"))
        .agg(
            F.count_distinct("match_id").alias("innings"),
            F.sum(runs).alias("runs"),
            F.max(runs).alias("highest_score"),
            F.sum("balls_faced").alias("balls_faced"),
            F.sum("fours").alias("fours"),
            F.sum("sixes").alias("sixes"),
            F.sum("dot_balls").alias("dot_balls"),
            F.sum("not_out").alias("not_outs"),
            F.count_if((runs >= 50) & (runs < 100)).alias("fifties"),
            F.count_if(runs >= 100).alias("hundreds"),
        )
    )


def bowling_season_stats(bowling: DataFrame, matches: DataFrame) -> DataFrame:
    """Season bowling totals."""
    return (
        _with_match_season(bowling, matches)
        .groupBy("player_id_bowler", "bowler_name", "season", F.col("bowling_team").alias("team"))
        .agg(
            F.count_distinct("match_id").alias("innings"),
            F.sum("runs_conceded").alias("runs_conceded"),
            F.sum("balls_bowled").alias("balls_bowled"),
            overs_text(F.sum("balls_bowled")).alias("overs_bowled"),
            F.sum("wides").alias("wides"),
            F.sum("noballs").alias("noballs"),
            F.sum("dot_balls").alias("dot_balls"),
            F.sum("wickets").alias("wickets"),
        )
    )


def _batting_average(innings: Column, not_outs: Column, runs: Column) -> Column:
    # Never dismissed: the runs stand as the average. Two innings in one match
    # count once in ``innings``, so the divisor can also be negative.
    dismissals = innings - not_outs
    return F.when(dismissals == 0, runs.cast("double")).otherwise(average(runs, dismissals))


def player_season_stats(
    registry: DataFrame,
    matches: DataFrame,
    batting: DataFrame,
    bowling: DataFrame,
    ordered: bool = False,
) -> DataFrame:
    """One row per squad member and season with batting and bowling totals.

    Players who neither bat nor bowl appear with NULL figures. Batting and
    bowling meet on player and season but not on team, so a player of several
    teams gets every combination of theirs. A NULL season matches no figures.
    """
    stats = season_rows(
        player_matches(registry, matches),
        batting_season_stats(batting, matches),
        bowling_season_stats(bowling, matches),
    )
    return stats.orderBy("season", F.desc("matches_played")) if ordered else stats


def season_rows(played: DataFrame, batting: DataFrame, bowling: DataFrame) -> DataFrame:
    """The rows of ``player_season_stats`` from matches played and the two kinds of totals."""
    bat = batting.select(
        F.col("player_id_batter").alias("player_id"), "season", F.struct("*").alias("bat")
    )
    bowl = bowling.select(
        F.col("player_id_bowler").alias("player_id"), "season", F.struct("*").alias("bowl")
    )
    stats = played.join(bat, ["player_id", "season"], "left").join(
        bowl, ["player_id", "season"], "left"
    )
    derived = {
        "player_name": F.coalesce("bat.batter_name", "bowl.bowler_name"),
        "team": F.coalesce("bat.team", "bowl.team"),
        "innings_batted": F.col("bat.innings"),
        "dot_balls_faced": F.col("bat.dot_balls"),
        "strike_rate": rate(F.col("bat.runs"), "100.0", F.col("bat.balls_faced")),
        "batting_average": _batting_average(
            F.col("bat.innings"), F.col("bat.not_outs"), F.col("bat.runs")
        ),
        "innings_bowled": F.col("bowl.innings"),
        "dot_balls_bowled": F.col("bowl.dot_balls"),
        "economy_rate": rate(F.col("bowl.runs_conceded"), "6.0", F.col("bowl.balls_bowled")),
        "bowling_average": average(F.col("bowl.runs_conceded"), F.col("bowl.wickets")),
    }
    batted = ("runs", "highest_score", "balls_faced", "fours", "sixes", "not_outs")
    for name in (*batted, "fifties", "hundreds"):
        derived[name] = F.col(f"bat.{name}")
    for name in ("runs_conceded", "balls_bowled", "overs_bowled", "wides", "noballs", "wickets"):
        derived[name] = F.col(f"bowl.{name}")
    return stats.select(
        *(
            derived[name].alias(name) if name in derived else F.col(name)
            for name in columns("player_season_stats")
        )
    )
