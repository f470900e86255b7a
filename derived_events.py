"""Cricket tables derived from a generic ``events`` table.

Stand-in for real match data where none is at hand: every 250 consecutive
event ids make a match, and names, runs, extras and wickets follow from the
event's fields by arithmetic. All of it is a projection of ``events`` and
grows with it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorebook.schema import MATCH_COLUMNS, TIED, columns

EVENTS_PER_MATCH = 250
SQUAD_SIZE = 11


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _player_name(team_no: Column, slot: Column, match_no: Column) -> Column:
    """Opening batters go by a second name in every other match."""
    prefix = F.when((slot == 0) & (match_no % 2 == 1), "Alt P").otherwise("P")
    return _text(prefix, team_no, "_", slot)


def _player_id(team_no: Column, slot: Column) -> Column:
    return _text("id", team_no, "_", slot)


def _sides(match_no: Column) -> tuple[Column, Column]:
    return match_no % 10, (match_no + 3) % 10


def _with_teams(rows: DataFrame) -> DataFrame:
    """Adds what the match columns are built from, as columns to refer to."""
    home, away = _sides(F.col("match_no"))
    first_day = F.lit("2008-04-01").cast("date")
    day = F.date_add(first_day, (F.col("match_no") % 28).cast("int"))
    return rows.withColumns(
        {
            "match_id": _text("m", F.col("match_no")),
            "team_1": _text("T", home),
            "team_2": _text("T", away),
            "match_date": day.cast("string"),
        }
    )


def _match_columns() -> dict[str, Column]:
    no, team_1, team_2 = F.col("match_no"), F.col("team_1"), F.col("team_2")
    home, _ = _sides(no)
    outcome = no % 4
    return {
        "meta_version": F.lit("1.1.0"),
        "meta_created": F.col("match_date"),
        "season": F.when(no % 3 == 0, "2007/08").when(no % 3 == 1, "2009").otherwise("2010"),
        "venue": _text("V", no % 7),
        "city": F.when(no % 9 != 8, _text("C", no % 4)),
        "match_number": F.when(no % 20 != 19, no % 60 + 1),
        "toss_winner": F.when(no % 2 == 0, team_1).otherwise(team_2),
        "toss_decision": F.when(no % 5 < 2, "bat").otherwise("field"),
        "match_winner": F.when(outcome == 0, team_1).when(outcome == 1, team_2),
        "player_of_match": F.when(outcome != 3, _player_name(home, no % SQUAD_SIZE, no)),
        "win_type": F.when(outcome == 0, "run")
        .when(outcome == 1, "wickets")
        .when(outcome == 2, "tie")
        .otherwise("unknown"),
        "win_margin": F.when(outcome == 0, no % 90 + 5)
        .when(outcome == 1, no % 9 + 1)
        .otherwise(F.lit(0)),
        "source_file": _text(F.col("match_id"), ".json"),
    }


def _balls(events: DataFrame) -> DataFrame:
    """Events with their place in the match and the slots of the five roles."""
    event, no = F.col("event_id"), F.col("match_no")
    kind, k, b = F.col("event_type"), F.col("k"), F.col("b")
    balls = events.select(
        event,
        "user_id",
        kind,
        F.expr(f"event_id div {EVENTS_PER_MATCH}").alias("match_no"),
        (event % EVENTS_PER_MATCH).alias("b"),
        F.floor("value").alias("v"),
        F.regexp_extract("props", '"k": *([0-9]+)', 1).try_cast("bigint").alias("k"),
    )
    super_over = no % 5 == 0
    balls = balls.withColumn(
        "innings_number",
        F.when(b < 120, 1)
        .when((b < 240) | ~super_over, 2)
        .when(b < 245, 3)
        .otherwise(4),
    )
    innings = F.col("innings_number")
    start = F.when(innings == 1, 0).when(innings == 2, 120).when(innings == 3, 240).otherwise(245)
    home, away = _sides(no)
    striker = F.when(event % 10 < 7, F.col("user_id") % 3).otherwise(F.col("user_id") % SQUAD_SIZE)
    balls = balls.withColumns(
        {
            "ball": b - start,
            "batting_no": F.when(innings % 2 == 1, home).otherwise(away),
            "fielding_no": F.when(innings % 2 == 1, away).otherwise(home),
            "striker": striker,
            "bowling_slot": 5 + k % 6,
            "extras_wides": F.when((kind == "error") & (k % 2 == 0), k % 3 + 1),
            "extras_noballs": F.when((kind == "error") & (k % 2 == 1), F.lit(1).cast("bigint")),
            "extras_byes": F.when((kind == "view") & (k < 10), F.lit(1).cast("bigint")),
            "extras_legbyes": F.when((kind == "view") & k.between(10, 19), F.lit(1).cast("bigint")),
            "dismissal_kind": F.when(
                (kind == "signup") & (k < 30),
                F.element_at(
                    F.array(*map(F.lit, ("caught", "bowled", "run out", "retired hurt", "lbw"))),
                    (k % 5 + 1).cast("int"),
                ),
            ),
        }
    )
    out = F.col("dismissal_kind")
    partner = (F.col("striker") + 1) % SQUAD_SIZE
    return balls.withColumns(
        {
            "over_number": F.floor(F.col("ball") / 7),
            "delivery_index": (F.col("ball") % 7).cast("int"),
            "partner": partner,
            "out_slot": F.when((out == "run out") & (k % 4 < 2), partner).when(
                out.isNotNull(), F.col("striker")
            ),
            "catcher": F.when(out == "caught", k % SQUAD_SIZE),
            "runs_batter": F.when(F.col("extras_wides").isNotNull(), F.lit(0)).otherwise(
                F.col("v") % 7
            ),
        }
    )


def _ball_columns() -> dict[str, Column]:
    kinds = ("extras_wides", "extras_noballs", "extras_byes", "extras_legbyes")
    extras = sum(F.coalesce(F.col(kind), F.lit(0)) for kind in kinds)
    odd = F.col("innings_number") % 2 == 1
    return {
        "batting_team": F.when(odd, F.col("team_1")).otherwise(F.col("team_2")),
        "bowling_team": F.when(odd, F.col("team_2")).otherwise(F.col("team_1")),
        "is_legal_delivery": F.col("extras_wides").isNull() & F.col("extras_noballs").isNull(),
        "runs_extras": extras,
        "runs_total": F.col("runs_batter") + extras,
        "is_wicket": F.col("dismissal_kind").isNotNull().cast("int"),
        "is_super_over": (F.col("innings_number") > 2).cast("int"),
    }


def deliveries_from_events(
    events: DataFrame, ingested_at: Column, carry: tuple[str, ...] = ()
) -> DataFrame:
    """The bronze table; ``carry`` may add ``match_no``."""
    no, batting, fielding = F.col("match_no"), F.col("batting_no"), F.col("fielding_no")
    substitute = F.col("k") % 2 == 0
    # The match's columns are worked out once per match. Beside the balls' they would
    # make one projection that is too long to be compiled.
    match = _match_columns()
    matches = _with_teams(_match_numbers(events)).select(
        "match_no", "match_id", "team_1", "team_2", "match_date", *(c.alias(k) for k, c in match.items())
    )
    derived = {
        **_ball_columns(),
        "batter": _player_name(batting, F.col("striker"), no),
        "non_striker": _player_name(batting, F.col("partner"), no),
        # Bowlers come from the slots that have one name only.
        "bowler": _text("P", fielding, "_", F.col("bowling_slot")),
        "player_out": _player_name(batting, F.col("out_slot"), no),
        "fielder": F.when(F.col("catcher").isNotNull() & substitute, "Sub Fielder").otherwise(
            _player_name(fielding, F.col("catcher"), no)
        ),
        "ingested_at": ingested_at,
    }
    return _balls(events).join(matches, "match_no").select(
        *(derived.get(c, F.col(c)).alias(c) for c in columns("bronze")), *carry
    )


def facts_from_events(events: DataFrame, ingested_at: Column) -> DataFrame:
    """The fact table, its player ids worked out in place instead of looked up."""
    no, batting, fielding = F.col("match_no"), F.col("batting_no"), F.col("fielding_no")
    derived = {
        **_match_columns(),
        **_ball_columns(),
        "player_id_batter": _player_id(batting, F.col("striker")),
        "player_id_non_striker": _player_id(batting, F.col("partner")),
        "player_id_bowler": _player_id(fielding, F.col("bowling_slot")),
        "player_id_out": _player_id(batting, F.col("out_slot")),
        "player_id_fielder": F.when(F.col("k") % 2 == 1, _player_id(fielding, F.col("catcher"))),
        "ingested_at": ingested_at,
    }
    return _with_teams(_balls(events)).select(
        *(derived.get(c, F.col(c)).alias(c) for c in columns("fact_delivery"))
    )


def _match_numbers(events: DataFrame) -> DataFrame:
    return events.select(F.expr(f"event_id div {EVENTS_PER_MATCH}").alias("match_no")).distinct()


def registry_from_events(events: DataFrame) -> DataFrame:
    """Both squads of every match."""
    no, team_no, slot = F.col("match_no"), F.col("team_no"), F.col("slot")
    members = (
        _match_numbers(events)
        .withColumn("team_no", F.explode(F.array(*_sides(no))))
        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SQUAD_SIZE - 1))))
    )
    return members.select(
        _text("m", no).alias("match_id"),
        _player_name(team_no, slot, no).alias("player_name"),
        _player_id(team_no, slot).alias("player_id"),
        _text("T", team_no).alias("team"),
    )


def matches_from_events(events: DataFrame) -> DataFrame:
    """The match dimension."""
    no = F.col("match_no")
    derived = {**_match_columns(), "has_super_over": (no % 5 == 0).cast("int")}
    return _with_teams(_match_numbers(events)).select(
        *(derived.get(c, F.col(c)).alias(c) for c in columns("dim_match"))
    )


def revisions_from_events(events: DataFrame, ingested_at: Column) -> DataFrame:
    """Manifest rows of all documents as they arrive."""
    match = _match_columns()
    return _with_teams(_match_numbers(events)).select(
        "match_id",
        (F.col("match_no") % 3 + 1).alias("revision"),
        match["meta_created"].alias("created"),
        match["meta_version"].alias("data_version"),
        ingested_at.alias("ingested_at"),
    )


def known_revisions_from_events(events: DataFrame, ingested_at: Column) -> DataFrame:
    """A manifest that lacks every fifth match and holds mixed revisions of the others.

    For every third match it also knows an earlier one (``old``) that does not arrive.
    """
    no = F.col("match_no")
    ids = F.when(no % 3 == 0, F.array(_text("m", no), _text("old", no))).otherwise(
        F.array(_text("m", no))
    )
    return (
        _match_numbers(events)
        .where(no % 5 != 4)
        .select("match_no", F.explode(ids).alias("match_id"))
        .select(
            "match_id",
            (no % 4).alias("revision"),
            F.lit("2007-12-31").alias("created"),
            F.lit("1.0.0").alias("data_version"),
            ingested_at.alias("ingested_at"),
        )
    )


def superseded_deliveries(deliveries: DataFrame) -> DataFrame:
    """An earlier delivery of the same documents, for runs in two batches.

    Every fourth match has not arrived yet. Another fourth came in a lower
    revision, without batter's runs, and half of those under another season,
    which the final revision leaves empty. Expects ``match_no`` and ``revision``.
    """
    no = F.col("match_no")
    outdated = no % 4 == 1
    return deliveries.where(no % 4 != 3).withColumns(
        {
            "revision": F.col("revision") - outdated.cast("bigint"),
            "runs_batter": F.when(outdated, F.lit(0)).otherwise(F.col("runs_batter")),
            "season": F.when(no % 8 == 1, "2008").otherwise(F.col("season")),
        }
    )


def document_texts(balls: DataFrame) -> DataFrame:
    """Match documents as JSON text with their id, nested from bronze rows.

    Expects ``match_no`` and ``revision`` beside the bronze columns. Each match
    is collected, which its 250 events bound.
    """
    match = ["meta_version", "meta_created", *MATCH_COLUMNS]
    ball = F.struct(
        "batter",
        "bowler",
        "non_striker",
        F.struct(
            F.col("runs_batter").alias("batter"),
            F.col("runs_extras").alias("extras"),
            F.col("runs_total").alias("total"),
        ).alias("runs"),
        F.struct(
            *(F.col(f"extras_{c}").alias(c) for c in ("wides", "noballs", "byes", "legbyes"))
        ).alias("extras"),
        F.when(
            F.col("is_wicket") == 1,
            F.array(
                F.struct(
                    "player_out",
                    F.col("dismissal_kind").alias("kind"),
                    F.when(
                        F.col("fielder").isNotNull(),
                        F.array(F.struct(F.col("fielder").alias("name"))),
                    ).alias("fielders"),
                )
            ),
        ).alias("wickets"),
    )
    overs = (
        balls.repartition("match_id")
        .groupBy("match_id", "innings_number", "over_number")
        .agg(
            F.any_value(F.struct("match_no", "revision", *match)).alias("match"),
            F.any_value("batting_team").alias("team"),
            F.any_value("is_super_over").alias("is_super_over"),
            F.sort_array(F.collect_list(F.struct("delivery_index", ball.alias("ball")))).alias(
                "balls"
            ),
        )
    )
    over = F.struct(F.col("over_number").alias("over"), F.col("balls.ball").alias("deliveries"))
    innings = overs.groupBy("match_id", "innings_number").agg(
        F.any_value("match").alias("match"),
        F.any_value("team").alias("team"),
        F.any_value("is_super_over").alias("is_super_over"),
        F.sort_array(F.collect_list(over)).alias("overs"),
    )
    inning = F.struct(
        "innings_number",
        "team",
        F.when(F.col("is_super_over") == 1, True).alias("super_over"),
        "overs",
    )
    matches = innings.groupBy("match_id").agg(
        F.any_value("match").alias("match"),
        F.sort_array(F.collect_list(inning)).alias("innings"),
    )
    matches = matches.select("match.*", "innings")
    return matches.select("match_id", F.to_json(F.struct(*_document(matches))).alias("document"))


def _document(matches: DataFrame) -> list[Column]:
    no = F.col("match_no")
    home, away = _sides(no)
    slots = F.sequence(F.lit(0), F.lit(SQUAD_SIZE - 1))

    def names(team_no):
        return F.transform(slots, lambda slot: _player_name(team_no, slot, no))

    def ids(team_no):
        return F.transform(slots, lambda slot: _player_id(team_no, slot))

    win = F.col("win_type")
    meta = F.struct(
        F.col("meta_version").alias("data_version"),
        F.col("meta_created").alias("created"),
        "revision",
    )
    outcome = F.struct(
        F.col("match_winner").alias("winner"),
        F.when(win == "tie", TIED).when(win == "unknown", "no result").alias("result"),
        F.struct(
            F.when(win == "run", F.col("win_margin")).alias("runs"),
            F.when(win == "wickets", F.col("win_margin")).alias("wickets"),
        ).alias("by"),
    )
    info = F.struct(
        "season",
        F.array("match_date").alias("dates"),
        "venue",
        "city",
        F.struct("match_number").alias("event"),
        F.array("team_1", "team_2").alias("teams"),
        F.struct(
            F.col("toss_winner").alias("winner"), F.col("toss_decision").alias("decision")
        ).alias("toss"),
        outcome.alias("outcome"),
        F.when(F.col("player_of_match").isNotNull(), F.array("player_of_match")).alias(
            "player_of_match"
        ),
        F.struct(
            F.map_from_arrays(
                F.concat(names(home), names(away), F.array(_text("Ump", no))),
                F.concat(ids(home), ids(away), F.array(_text("idU", no))),
            ).alias("people")
        ).alias("registry"),
        F.create_map("team_1", names(home), "team_2", names(away)).alias("players"),
    )
    innings = F.transform("innings", lambda inning: inning.dropFields("innings_number"))
    return [F.col("match_id"), meta.alias("meta"), info.alias("info"), innings.alias("innings")]
