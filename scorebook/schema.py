"""Document schema, table schemas and fixed values."""

# The match document format. Only fields that are used are
# declared, so absent ones read as NULL and undeclared ones are never kept.
DOCUMENT_SCHEMA = """
    meta struct<data_version: string, created: string, revision: bigint>,
    info struct<
        season: string,
        dates: array<string>,
        venue: string,
        city: string,
        event: struct<match_number: bigint>,
        teams: array<string>,
        toss: struct<winner: string, decision: string>,
        outcome: struct<
            winner: string,
            result: string,
            by: struct<runs: bigint, wickets: bigint>>,
        player_of_match: array<string>,
        registry: struct<people: map<string, string>>,
        players: map<string, array<string>>>,
    innings array<struct<
        team: string,
        super_over: boolean,
        overs: array<struct<
            over: bigint,
            deliveries: array<struct<
                batter: string,
                bowler: string,
                non_striker: string,
                runs: struct<batter: bigint, extras: bigint, total: bigint>,
                extras: struct<
                    wides: bigint, noballs: bigint, byes: bigint, legbyes: bigint>,
                wickets: array<struct<
                    player_out: string,
                    kind: string,
                    fielders: array<struct<name: string>>>>>>>>>>
"""

# Win types, in the order they are tested.
WON_BY_RUNS = "run"
WON_BY_WICKETS = "wickets"
TIED = "tie"
UNKNOWN_RESULT = "unknown"

# Dismissals that are not credited to the bowler.
NOT_BOWLERS_WICKET = ("run out", "obstructing the field", "retired hurt")

# The columns of every table, in order.
MATCH_COLUMNS = {
    "match_id": "string",
    "season": "string",
    "match_date": "string",
    "venue": "string",
    "city": "string",
    "match_number": "bigint",
    "team_1": "string",
    "team_2": "string",
    "toss_winner": "string",
    "toss_decision": "string",
    "match_winner": "string",
    "player_of_match": "string",
    "win_type": "string",
    "win_margin": "bigint",
}

TABLES = {
    "bronze": {
        "meta_version": "string",
        "meta_created": "string",
        **MATCH_COLUMNS,
        "innings_number": "int",
        "batting_team": "string",
        "bowling_team": "string",
        "delivery_index": "int",
        "batter": "string",
        "bowler": "string",
        "non_striker": "string",
        "is_legal_delivery": "boolean",
        "over_number": "bigint",
        "runs_batter": "bigint",
        "runs_extras": "bigint",
        "runs_total": "bigint",
        "extras_wides": "bigint",
        "extras_noballs": "bigint",
        "extras_byes": "bigint",
        "extras_legbyes": "bigint",
        "is_wicket": "int",
        "player_out": "string",
        "dismissal_kind": "string",
        "fielder": "string",
        "is_super_over": "int",
        "source_file": "string",
        "ingested_at": "timestamp",
    },
    "match_player_registry": {
        "match_id": "string",
        "player_name": "string",
        "player_id": "string",
        "team": "string",
    },
    "dim_player": {
        "player_id": "string",
        "name_variants": "array<string>",
    },
    "dim_match": {
        **MATCH_COLUMNS,
        "has_super_over": "int",
    },
    "fact_delivery": {
        "match_id": "string",
        "player_id_batter": "string",
        "player_id_bowler": "string",
        "player_id_non_striker": "string",
        "batting_team": "string",
        "bowling_team": "string",
        "innings_number": "int",
        "over_number": "bigint",
        "delivery_index": "int",
        "is_legal_delivery": "boolean",
        "is_super_over": "int",
        "runs_batter": "bigint",
        "runs_extras": "bigint",
        "runs_total": "bigint",
        "extras_wides": "bigint",
        "extras_noballs": "bigint",
        "extras_byes": "bigint",
        "extras_legbyes": "bigint",
        "is_wicket": "int",
        "player_id_out": "string",
        "dismissal_kind": "string",
        "player_id_fielder": "string",
        "source_file": "string",
        "ingested_at": "timestamp",
    },
    "batting_scorecard": {
        "match_id": "string",
        "innings_number": "int",
        "player_id_batter": "string",
        "batter_name": "string",
        "batting_team": "string",
        "bowling_team": "string",
        "first_ball": "bigint",
        "runs": "bigint",
        "balls_faced": "bigint",
        "fours": "bigint",
        "sixes": "bigint",
        "dot_balls": "bigint",
        "not_out": "int",
        "dismissal_kind": "string",
        "batting_position": "int",
        "strike_rate": "decimal(27,2)",
    },
    "bowling_scorecard": {
        "match_id": "string",
        "innings_number": "int",
        "player_id_bowler": "string",
        "bowler_name": "string",
        "batting_team": "string",
        "bowling_team": "string",
        "balls_bowled": "bigint",
        "dot_balls": "bigint",
        "overs_bowled": "string",
        "runs_conceded": "bigint",
        "wides": "bigint",
        "noballs": "bigint",
        "wickets": "bigint",
        "economy": "decimal(25,2)",
        "bowling_average": "double",
    },
    "team_match_summary": {
        "match_id": "string",
        "innings_number": "int",
        "batting_team": "string",
        "bowling_team": "string",
        "total_runs": "bigint",
        "total_wickets": "bigint",
        "total_balls": "bigint",
        "total_extras": "bigint",
        "win_type": "string",
        "overs_played": "string",
        "run_rate": "decimal(25,2)",
        "target": "bigint",
    },
    "player_season_stats": {
        "player_id": "string",
        "season": "string",
        "matches_played": "bigint",
        "player_name": "string",
        "team": "string",
        "innings_batted": "bigint",
        "runs": "bigint",
        "highest_score": "bigint",
        "balls_faced": "bigint",
        "fours": "bigint",
        "sixes": "bigint",
        "dot_balls_faced": "bigint",
        "not_outs": "bigint",
        "fifties": "bigint",
        "hundreds": "bigint",
        "strike_rate": "decimal(27,2)",
        "batting_average": "double",
        "innings_bowled": "bigint",
        "runs_conceded": "bigint",
        "balls_bowled": "bigint",
        "overs_bowled": "string",
        "wides": "bigint",
        "noballs": "bigint",
        "dot_balls_bowled": "bigint",
        "wickets": "bigint",
        "economy_rate": "decimal(25,2)",
        "bowling_average": "double",
    },
    "manifest": {
        "match_id": "string",
        "revision": "bigint",
        "created": "string",
        "data_version": "string",
        "ingested_at": "timestamp",
    },
}
# What the incremental run has seen: document files, and documents it could not use.
TABLES["files"] = {"path": "string", "modified": "timestamp", "length": "bigint"}
TABLES["quarantine"] = {"match_id": "string", "reason": "string", "ingested_at": "timestamp"}
TABLES["manifest_history"] = {**TABLES["manifest"], "archived_at": "timestamp"}
# What it keeps to work from changes alone: the season each match is stored under, how many squad
# entries give a player a name, and season totals that matches can be added to and taken from.
TABLES["placement"] = {"match_id": "string", "season": "string"}
TABLES["player_names"] = {"player_id": "string", "player_name": "string", "entries": "bigint"}
TABLES["season_players"] = {"player_id": "string", "matches": "bigint"}
TABLES["season_batting"] = {
    "player_id": "string",
    "player_name": "string",
    "team": "string",
    # One row for all innings, with the matches, and one for each score, with its innings.
    "is_score": "boolean",
    "runs": "bigint",
    "n": "bigint",
    "balls_faced": "bigint",
    "fours": "bigint",
    "sixes": "bigint",
    "dot_balls": "bigint",
    "not_outs": "bigint",
}
TABLES["season_bowling"] = {
    "player_id": "string",
    "player_name": "string",
    "team": "string",
    "n": "bigint",
    "charged": "bigint",
    "runs_conceded": "bigint",
    "balls_bowled": "bigint",
    "wides": "bigint",
    "noballs": "bigint",
    "dot_balls": "bigint",
    "wickets": "bigint",
}
#: Tables that only the incremental run keeps.
RUN_TABLES = {
    "files",
    "quarantine",
    "placement",
    "player_names",
    "season_players",
    "season_batting",
    "season_bowling",
}

MARTS = (
    "batting_scorecard",
    "bowling_scorecard",
    "team_match_summary",
    "player_season_stats",
)


def columns(table: str) -> list[str]:
    return list(TABLES[table])


def ddl(table: str, *extra: str) -> str:
    fields = [f"{name} {kind}" for name, kind in TABLES[table].items()]
    return ", ".join(fields + list(extra))
