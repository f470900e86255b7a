"""Who played in which match, and under which names."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_player_registry(
    docs: DataFrame, carry: tuple[str, ...] = (), distinct: bool = True
) -> DataFrame:
    """Squad members per match with their id; officials are in no squad.

    Starts from the squads and looks each name up in the document's own
    people, rather than pairing every person with every squad. ``carry`` names
    further document columns to keep. Rows of one document are unique as they
    are; where a match has one document only, ``distinct=False`` saves a shuffle.
    """
    squads = docs.select(
        "match_id",
        *carry,
        F.col("info.registry.people").alias("people"),
        F.explode("info.players").alias("team", "squad"),
    )
    members = squads.select(
        "match_id",
        *carry,
        "people",
        "team",
        F.explode(F.array_distinct("squad")).alias("player_name"),
    )
    found = members.select(
        "match_id",
        "player_name",
        F.try_element_at("people", F.col("player_name")).alias("player_id"),
        "team",
        *carry,
    ).where(F.col("player_id").isNotNull())
    return found.distinct() if distinct else found


def player_registry(registry: DataFrame) -> DataFrame:
    """Each (player id, name) once."""
    return registry.select("player_id", "player_name").distinct()


def dim_player(registry: DataFrame) -> DataFrame:
    """All name variants per player, sorted.

    Pairs are made distinct first, so a player's many matches are reduced
    before the shuffle and the set holds nothing but the variants.
    """
    return (
        player_registry(registry)
        .groupBy("player_id")
        .agg(F.array_sort(F.collect_set("player_name")).alias("name_variants"))
    )


def display_names(players: DataFrame) -> DataFrame:
    """One name per player: the smallest variant."""
    return players.select("player_id", F.array_min("name_variants").alias("display_name"))
