"""Documents to one row per ball."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.schema import (
    TIED,
    UNKNOWN_RESULT,
    WON_BY_RUNS,
    WON_BY_WICKETS,
    columns,
)


def first(values: str | Column) -> Column:
    """First element, NULL for an empty or absent array."""
    return F.get(values, F.lit(0))


def match_columns() -> dict[str, Column]:
    """The match's attributes, from its document."""
    margin = F.col("info.outcome.by")
    by_runs, by_wickets = margin["runs"], margin["wickets"]
    won = (
        F.when(by_runs.isNotNull(), WON_BY_RUNS)
        .when(by_wickets.isNotNull(), WON_BY_WICKETS)
        .when(F.col("info.outcome.result") == TIED, TIED)
        .otherwise(UNKNOWN_RESULT)
    )
    return {
        "match_id": F.col("match_id"),
        "season": F.col("info.season"),
        "match_date": first("info.dates"),
        "venue": F.col("info.venue"),
        "city": F.col("info.city"),
        "match_number": F.col("info.event.match_number"),
        "team_1": first("info.teams"),
        "team_2": F.get("info.teams", F.lit(1)),
        "toss_winner": F.col("info.toss.winner"),
        "toss_decision": F.col("info.toss.decision"),
        "match_winner": F.col("info.outcome.winner"),
        "player_of_match": first("info.player_of_match"),
        "win_type": won,
        "win_margin": F.coalesce(by_runs, by_wickets, F.lit(0)),
    }


def flatten_deliveries(
    docs: DataFrame, ingested_at: Column | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The bronze table: 39 columns per delivery.

    A map over the documents, without a shuffle. Position is data: innings are
    numbered from 1 and balls from 0 in the order they stand in the document.
    Innings without overs and overs without balls yield no rows. ``carry``
    names further document columns to keep.
    """
    matches = docs.select(
        F.col("meta.data_version").alias("meta_version"),
        F.col("meta.created").alias("meta_created"),
        *(c.alias(name) for name, c in match_columns().items()),
        *carry,
        F.posexplode("innings").alias("innings_pos", "inning"),
    )
    overs = matches.withColumn("over", F.explode("inning.overs"))
    balls = overs.select("*", F.posexplode("over.deliveries").alias("delivery_index", "ball"))

    batting_team = F.col("inning.team")
    wicket = first("ball.wickets")
    ball_columns = {
        "innings_number": F.col("innings_pos") + 1,
        "batting_team": batting_team,
        "bowling_team": F.when(batting_team == F.col("team_1"), F.col("team_2")).otherwise(
            F.col("team_1")
        ),
        "batter": F.col("ball.batter"),
        "bowler": F.col("ball.bowler"),
        "non_striker": F.col("ball.non_striker"),
        "is_legal_delivery": F.col("ball.extras.wides").isNull()
        & F.col("ball.extras.noballs").isNull(),
        "over_number": F.col("over.over"),
        "runs_batter": F.col("ball.runs.batter"),
        "runs_extras": F.col("ball.runs.extras"),
        "runs_total": F.col("ball.runs.total"),
        "extras_wides": F.col("ball.extras.wides"),
        "extras_noballs": F.col("ball.extras.noballs"),
        "extras_byes": F.col("ball.extras.byes"),
        "extras_legbyes": F.col("ball.extras.legbyes"),
        "is_wicket": F.col("ball.wickets").isNotNull().cast("int"),
        "player_out": wicket["player_out"],
        "dismissal_kind": wicket["kind"],
        "fielder": first(wicket["fielders"])["name"],
        "is_super_over": F.col("inning.super_over").isNotNull().cast("int"),
        "source_file": F.concat("match_id", F.lit(".json")),
        "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
    }
    return balls.select(
        *(
            ball_columns[name].alias(name) if name in ball_columns else F.col(name)
            for name in columns("bronze")
        ),
        *carry,
    )
