"""The silver star: match dimension and delivery facts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorebook.operators.deliveries import flatten_deliveries, match_columns
from scorebook.schema import MATCH_COLUMNS, columns

# Name column of the ball -> id column of the fact.
ROLES = {
    "batter": "player_id_batter",
    "bowler": "player_id_bowler",
    "non_striker": "player_id_non_striker",
    "player_out": "player_id_out",
    "fielder": "player_id_fielder",
}


def dim_match(bronze: DataFrame) -> DataFrame:
    """Each combination of match attributes once, with the match's super-over flag.

    Balls are reduced to one row per match before the window over the match
    sees them, so no task holds a match's balls.
    """
    described = bronze.groupBy(*MATCH_COLUMNS).agg(F.max("is_super_over").alias("super_over"))
    flag = F.max("super_over").over(Window.partitionBy("match_id"))
    return described.select(*MATCH_COLUMNS, flag.alias("has_super_over"))


def dim_match_from_documents(docs: DataFrame) -> DataFrame:
    """``dim_match`` of documents that hold a match once: one row for each that has a ball.

    Everything lies in the document, so nothing is shuffled and no ball is unnested.
    """
    def has_ball(inning: Column) -> Column:
        balls = F.exists(inning["overs"], lambda over: F.size(over["deliveries"]) > 0)
        return F.coalesce(balls, F.lit(False))

    played = F.filter("innings", has_ball)
    super_over = F.exists(played, lambda inning: inning["super_over"].isNotNull())
    return docs.where(F.size(played) > 0).select(
        *(c.alias(name) for name, c in match_columns().items()),
        super_over.cast("int").alias("has_super_over"),
    )


def fact_delivery(bronze: DataFrame, registry: DataFrame) -> DataFrame:
    """Balls with the five names replaced by player ids.

    An unknown name gives a NULL id, a name found in both squads repeats the
    ball. The registry becomes one map per match, name to ids, which the squads
    bound; so the balls move once, to their match, and are looked up there.
    """
    ids = (
        registry.where(F.col("player_name").isNotNull())
        .repartition("match_id")
        .groupBy("match_id", "player_name")
        .agg(F.collect_list(F.struct("player_id")).alias("ids"))
        .groupBy("match_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("player_name", "ids"))).alias("ids"))
        .select(F.col("match_id").alias("of_match"), F.col("ids").alias("ids_by_name"))
    )
    balls = bronze.join(ids, F.col("match_id") == F.col("of_match"), "left")
    found = {role: F.try_element_at("ids_by_name", F.col(role)) for role in ROLES}
    balls = balls.withColumns({f"found_{role}": ids for role, ids in found.items()})
    sizes = {role: F.greatest(F.coalesce(F.size(f"found_{role}"), F.lit(1)), F.lit(1)) for role in ROLES}
    copies = F.lit(1)
    for size in sizes.values():
        copies = copies * size
    balls = balls.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    resolved, stride = {}, F.lit(1)
    for role, player_id in ROLES.items():
        at = (F.floor(F.col("copy") / stride) % sizes[role]).cast("int")
        resolved[player_id] = F.get(f"found_{role}", at)["player_id"]
        stride = stride * sizes[role]
    return balls.select(
        *(resolved.get(c, F.col(c)).alias(c) for c in columns("fact_delivery"))
    )


def fact_from_documents(
    docs: DataFrame, ingested_at: Column | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``fact_delivery`` straight from the documents, without any shuffle.

    Each document names its own squads and people, so every ball is resolved
    where it lies. ``docs`` must hold a match once. ``carry`` names bronze
    columns to keep beside the fact's own.
    """
    people = F.col("info.registry.people")
    squads = F.filter(F.map_values("info.players"), lambda squad: squad.isNotNull())
    names = F.filter(
        F.array_distinct(F.flatten(squads)),
        lambda name: F.try_element_at(people, name).isNotNull(),
    )
    member = F.transform(
        names,
        lambda name: F.struct(
            F.try_element_at(people, name).alias("player_id"),
            F.size(F.filter(squads, lambda squad: F.array_contains(squad, name))).alias("squads"),
        ),
    )
    roster = F.map_from_arrays(names, member)
    balls = flatten_deliveries(docs.withColumn("roster", roster), ingested_at, ("roster",))

    found = {role: F.try_element_at("roster", F.col(role)) for role in ROLES}
    copies = F.lit(1)
    for entry in found.values():
        copies = copies * F.coalesce(entry["squads"], F.lit(1))
    ids = {player_id: found[role]["player_id"] for role, player_id in ROLES.items()}
    facts = balls.select(
        *(ids[c].alias(c) if c in ids else F.col(c) for c in columns("fact_delivery")),
        *carry,
        copies.alias("copies"),
    )
    repeated = facts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.drop("copies", "copy")
