"""Batting and bowling figures per player and innings."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorebook.functions import average, overs_text, rate
from scorebook.functions.rates import BALLS_PER_OVER
from scorebook.operators.registry import display_names
from scorebook.schema import NOT_BOWLERS_WICKET, columns


def _with_name(card: DataFrame, players: DataFrame, player: str, name: str) -> DataFrame:
    # Names are joined to the finished figures, some tens of rows per innings,
    # not to the balls. Spark broadcasts the names if their size allows it.
    names = display_names(players).select(
        F.col("player_id").alias(player), F.col("display_name").alias(name)
    )
    return card.join(names, player, "left")


def batting_scorecard(fact: DataFrame, players: DataFrame, ordered: bool = False) -> DataFrame:
    """Runs, balls, boundaries and order of appearance per batter and innings.

    ``not_out`` looks only at the balls the batter faced: a non-striker run out
    still counts as not out, and the striker of that ball as out. Order of
    appearance counts six balls to every over, so a long over can tie with the
    next one.
    """
    innings = ["match_id", "innings_number"]
    batter = [*innings, "player_id_batter", "batting_team", "bowling_team"]
    faced = F.col("extras_wides").isNull()
    scored = F.col("runs_batter")
    wicket = F.when(F.col("is_wicket") == 1, F.col("dismissal_kind"))
    # A maximum of text cannot be hash-aggregated and would sort every ball. So
    # the kind is a grouping key first, and its maximum is taken over the one or
    # two rows per batter that are left, already placed for the window below.
    by_kind = fact.groupBy(*batter, wicket.alias("dismissal_kind")).agg(
        F.min(F.col("over_number") * BALLS_PER_OVER + F.col("delivery_index")).alias("first_ball"),
        F.sum(scored).alias("runs"),
        F.count_if(faced).alias("balls_faced"),
        F.count_if(scored == 4).alias("fours"),
        F.count_if(scored == 6).alias("sixes"),
        F.count_if(faced & (scored == 0)).alias("dot_balls"),
        F.max("is_wicket").alias("is_wicket"),
    )
    added = ("runs", "balls_faced", "fours", "sixes", "dot_balls")
    figures = (
        by_kind.repartition(*innings)
        .groupBy(*batter)
        .agg(
            F.min("first_ball").alias("first_ball"),
            *(F.sum(c).alias(c) for c in added),
            (F.max("is_wicket") == 0).alias("survived"),
            F.max("dismissal_kind").alias("dismissal_kind"),
        )
    )
    appearance = Window.partitionBy(*innings).orderBy("first_ball")
    card = (
        figures.withColumn("batting_position", F.rank().over(appearance))
        .withColumn("not_out", F.when(F.col("survived"), 1).otherwise(0))
        .withColumn("strike_rate", rate(F.col("runs"), "100.0", F.col("balls_faced")))
    )
    card = _with_name(card, players, "player_id_batter", "batter_name")
    card = card.select(*columns("batting_scorecard"))
    return card.orderBy("match_id", "innings_number", "batting_position") if ordered else card


def bowling_scorecard(fact: DataFrame, players: DataFrame, ordered: bool = False) -> DataFrame:
    """Overs, runs conceded and wickets per bowler and innings.

    Byes and leg byes are not charged to the bowler.
    """
    legal = F.col("is_legal_delivery")
    wides = F.coalesce("extras_wides", F.lit(0))
    noballs = F.coalesce("extras_noballs", F.lit(0))
    credited = (F.col("is_wicket") == 1) & ~F.col("dismissal_kind").isin(*NOT_BOWLERS_WICKET)
    figures = fact.groupBy(
        "match_id", "innings_number", "player_id_bowler", "batting_team", "bowling_team"
    ).agg(
        F.sum(legal.cast("int")).alias("balls_bowled"),
        F.count_if(legal & (F.col("runs_total") == 0)).alias("dot_balls"),
        F.sum(F.col("runs_batter") + wides + noballs).alias("runs_conceded"),
        F.sum(wides).alias("wides"),
        F.sum(noballs).alias("noballs"),
        F.count_if(credited).alias("wickets"),
    )
    balls, conceded = F.col("balls_bowled"), F.col("runs_conceded")
    card = (
        figures.withColumn("overs_bowled", overs_text(balls))
        .withColumn("economy", rate(conceded, "6.0", balls))
        .withColumn("bowling_average", average(conceded, F.col("wickets")))
    )
    card = _with_name(card, players, "player_id_bowler", "bowler_name")
    card = card.select(*columns("bowling_scorecard"))
    return card.orderBy("match_id", "innings_number") if ordered else card
