"""Innings totals per team."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorebook.functions import overs_text, rate
from scorebook.schema import UNKNOWN_RESULT, columns


def innings_totals(fact: DataFrame) -> DataFrame:
    """Runs, wickets, legal balls and extras per innings; penalty runs are no extras here."""
    kinds = ("extras_wides", "extras_noballs", "extras_byes", "extras_legbyes")
    extras = sum(F.coalesce(F.col(kind), F.lit(0)) for kind in kinds)
    return fact.groupBy("match_id", "innings_number", "batting_team", "bowling_team").agg(
        F.sum("runs_total").alias("total_runs"),
        F.count_if(F.col("is_wicket") == 1).alias("total_wickets"),
        F.sum(F.col("is_legal_delivery").cast("int")).alias("total_balls"),
        F.sum(extras).alias("total_extras"),
    )


def team_match_summary(fact: DataFrame, matches: DataFrame, ordered: bool = False) -> DataFrame:
    """Innings totals with run rate and, for the side batting second, the target.

    Every even innings chases the one before it, so a super over does too. A
    match with an unknown result sets no target.
    """
    results = matches.select("match_id", "win_type")
    # Both the join and the window go by match, on one exchange of the totals.
    totals = innings_totals(fact).join(results, "match_id", "left")
    in_order = Window.partitionBy("match_id").orderBy(
        "innings_number", "batting_team", "bowling_team"
    )
    chasing = (F.col("innings_number") % 2 == 0) & (F.col("win_type") != UNKNOWN_RESULT)
    summary = totals.select(
        "*",
        overs_text(F.col("total_balls")).alias("overs_played"),
        rate(F.col("total_runs"), "6.0", F.col("total_balls")).alias("run_rate"),
        F.when(chasing, F.lag("total_runs").over(in_order) + 1).alias("target"),
    ).select(*columns("team_match_summary"))
    return summary.orderBy("match_id", "innings_number") if ordered else summary
