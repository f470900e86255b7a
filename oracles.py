"""DuckDB SQL for every query in ``__spark_entry__``, over the same tables.

Ratios are written with integers: Spark rounds decimals half up, DuckDB rounds
doubles, and the two differ in the last place.
"""

PLAYER_SLOTS = 11


def _half_up(amount: str, divisor: str) -> str:
    """amount / divisor to two places, half up; NULL for a zero divisor."""
    scaled = f"(200 * ({amount}) + abs({divisor})) // (2 * abs({divisor}))"
    return f"CASE WHEN ({divisor}) <> 0 THEN sign({divisor}) * ({scaled}) / 100.0 END"


def _overs(balls: str) -> str:
    return f"(({balls}) // 6) || '.' || (({balls}) % 6)"


def _name(team: str, slot: str) -> str:
    alias = f"CASE WHEN {slot} = 0 AND no % 2 = 1 THEN 'Alt ' ELSE '' END"
    return f"({alias} || 'P' || {team} || '_' || {slot})"


_SHARED = """match_id, innings_number, batting_team, bowling_team, over_number, delivery_index,
    is_legal_delivery, is_super_over, runs_batter, runs_extras, runs_total, extras_wides,
    extras_noballs, extras_byes, extras_legbyes, is_wicket, dismissal_kind"""

_CTE = {
    "numbered": """
        SELECT event_id, user_id, event_type, event_id // 250 AS no, event_id % 250 AS b,
               CAST(floor(value) AS BIGINT) AS v,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
        FROM events""",
    "placed": """
        SELECT *, CAST(CASE WHEN b < 120 THEN 1 WHEN b < 240 OR no % 5 <> 0 THEN 2
                            WHEN b < 245 THEN 3 ELSE 4 END AS BIGINT) AS inn
        FROM numbered""",
    "ball": """
        SELECT *,
               b - [0, 120, 240, 245][inn] AS pos,
               CASE inn % 2 WHEN 1 THEN no % 10 ELSE (no + 3) % 10 END AS bat_no,
               CASE inn % 2 WHEN 1 THEN (no + 3) % 10 ELSE no % 10 END AS field_no,
               CASE WHEN event_id % 10 < 7 THEN user_id % 3 ELSE user_id % 11 END AS striker,
               CASE WHEN event_type = 'error' AND k % 2 = 0 THEN k % 3 + 1 END AS wides,
               CASE WHEN event_type = 'error' AND k % 2 = 1 THEN 1::BIGINT END AS noballs,
               CASE WHEN event_type = 'view' AND k < 10 THEN 1::BIGINT END AS byes,
               CASE WHEN event_type = 'view' AND k BETWEEN 10 AND 19 THEN 1::BIGINT END AS legbyes,
               CASE WHEN event_type = 'signup' AND k < 30 THEN
                   ['caught', 'bowled', 'run out', 'retired hurt', 'lbw'][k % 5 + 1] END AS kind
        FROM placed""",
    "game": f"""
        SELECT no, 'm' || no AS match_id,
               ['2007/08', '2009', '2010'][no % 3 + 1] AS season,
               CAST(DATE '2008-04-01' + CAST(no % 28 AS INTEGER) AS VARCHAR) AS match_date,
               'V' || (no % 7) AS venue,
               CASE WHEN no % 9 < 8 THEN 'C' || (no % 4) END AS city,
               CASE WHEN no % 20 < 19 THEN no % 60 + 1 END AS match_number,
               'T' || (no % 10) AS team_1, 'T' || ((no + 3) % 10) AS team_2,
               'T' || CASE no % 2 WHEN 0 THEN no % 10 ELSE (no + 3) % 10 END AS toss_winner,
               CASE WHEN no % 5 < 2 THEN 'bat' ELSE 'field' END AS toss_decision,
               CASE no % 4 WHEN 0 THEN 'T' || (no % 10) WHEN 1 THEN 'T' || ((no + 3) % 10) END
                   AS match_winner,
               CASE WHEN no % 4 < 3 THEN {_name('(no % 10)', '(no % 11)')} END AS player_of_match,
               ['run', 'wickets', 'tie', 'unknown'][no % 4 + 1] AS win_type,
               CASE no % 4 WHEN 0 THEN no % 90 + 5 WHEN 1 THEN no % 9 + 1 ELSE 0 END AS win_margin
        FROM (SELECT DISTINCT no FROM numbered)""",
    "delivery": f"""
        SELECT '1.1.0' AS meta_version, match_date AS meta_created, game.*,
               inn AS innings_number, 'T' || bat_no AS batting_team, 'T' || field_no AS bowling_team,
               pos % 7 AS delivery_index, pos // 7 AS over_number,
               {_name('bat_no', 'striker')} AS batter,
               {_name('field_no', '(5 + k % 6)')} AS bowler,
               {_name('bat_no', '((striker + 1) % 11)')} AS non_striker,
               wides IS NULL AND noballs IS NULL AS is_legal_delivery,
               CASE WHEN wides IS NULL THEN v % 7 ELSE 0 END AS runs_batter,
               coalesce(wides, 0) + coalesce(noballs, 0) + coalesce(byes, 0) + coalesce(legbyes, 0)
                   AS runs_extras,
               runs_batter + runs_extras AS runs_total,
               wides AS extras_wides, noballs AS extras_noballs,
               byes AS extras_byes, legbyes AS extras_legbyes,
               CAST(kind IS NOT NULL AS BIGINT) AS is_wicket,
               CASE WHEN kind = 'run out' AND k % 4 < 2 THEN {_name('bat_no', '((striker + 1) % 11)')}
                    WHEN kind IS NOT NULL THEN {_name('bat_no', 'striker')} END AS player_out,
               kind AS dismissal_kind,
               CASE WHEN kind = 'caught' AND k % 2 = 0 THEN 'Sub Fielder'
                    WHEN kind = 'caught' THEN {_name('field_no', '(k % 11)')} END AS fielder,
               CAST(inn > 2 AS BIGINT) AS is_super_over,
               match_id || '.json' AS source_file, '2024-06-02 00:00:00' AS ingested_at
        FROM ball JOIN game USING (no)""",
    "squad": f"""
        SELECT match_id, {_name('team_no', 'slot')} AS player_name,
               'id' || team_no || '_' || slot AS player_id, 'T' || team_no AS team
        FROM (SELECT no, match_id, unnest([no % 10, (no + 3) % 10]) AS team_no FROM game),
             range({PLAYER_SLOTS}) AS slots(slot)""",
    "player": """
        SELECT player_id, min(player_name) AS display_name,
               string_agg(DISTINCT player_name, '|' ORDER BY player_name) AS name_variants
        FROM squad GROUP BY player_id""",
    "fact": """
        SELECT delivery.*, s.player_id AS player_id_batter, b.player_id AS player_id_bowler,
               n.player_id AS player_id_non_striker, o.player_id AS player_id_out,
               c.player_id AS player_id_fielder
        FROM delivery
        LEFT JOIN squad s ON s.match_id = delivery.match_id AND s.player_name = batter
        LEFT JOIN squad b ON b.match_id = delivery.match_id AND b.player_name = bowler
        LEFT JOIN squad n ON n.match_id = delivery.match_id AND n.player_name = non_striker
        LEFT JOIN squad o ON o.match_id = delivery.match_id AND o.player_name = player_out
        LEFT JOIN squad c ON c.match_id = delivery.match_id AND c.player_name = fielder""",
    "tampered": """
        SELECT * REPLACE (runs_extras + CASE WHEN no % 4 = 1 AND innings_number = 1 AND over_number = 0
                                             THEN CASE delivery_index WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END
                                             ELSE 0 END AS runs_extras)
        FROM fact""",
    "batting": f"""
        SELECT g.*, display_name AS batter_name,
               rank() OVER (PARTITION BY match_id, innings_number ORDER BY first_ball)
                   AS batting_position,
               {_half_up('100 * runs', 'balls_faced')} AS strike_rate
        FROM (SELECT match_id, season, innings_number, player_id_batter, batting_team, bowling_team,
                     CAST(min(6 * over_number + delivery_index) AS BIGINT) AS first_ball,
                     CAST(sum(runs_batter) AS BIGINT) AS runs,
                     count(*) FILTER (extras_wides IS NULL) AS balls_faced,
                     count(*) FILTER (runs_batter = 4) AS fours,
                     count(*) FILTER (runs_batter = 6) AS sixes,
                     count(*) FILTER (extras_wides IS NULL AND runs_batter = 0) AS dot_balls,
                     CAST(1 - max(is_wicket) AS BIGINT) AS not_out,
                     max(dismissal_kind) AS dismissal_kind
              FROM fact GROUP BY ALL) g
        LEFT JOIN player ON player_id = player_id_batter""",
    "bowling": f"""
        SELECT g.*, display_name AS bowler_name, {_overs('balls_bowled')} AS overs_bowled,
               {_half_up('6 * runs_conceded', 'balls_bowled')} AS economy,
               {_half_up('runs_conceded', 'wickets')} AS bowling_average
        FROM (SELECT match_id, season, innings_number, player_id_bowler, batting_team, bowling_team,
                     count(*) FILTER (is_legal_delivery) AS balls_bowled,
                     count(*) FILTER (is_legal_delivery AND runs_total = 0) AS dot_balls,
                     CAST(sum(runs_total) - sum(coalesce(extras_byes, 0) + coalesce(extras_legbyes, 0))
                         AS BIGINT) AS runs_conceded,
                     CAST(coalesce(sum(extras_wides), 0) AS BIGINT) AS wides,
                     CAST(coalesce(sum(extras_noballs), 0) AS BIGINT) AS noballs,
                     count(*) FILTER (dismissal_kind IN ('caught', 'bowled', 'lbw')) AS wickets
              FROM fact GROUP BY ALL) g
        LEFT JOIN player ON player_id = player_id_bowler""",
    "totals": """
        SELECT match_id, innings_number, batting_team, bowling_team,
               CAST(sum(runs_total) AS BIGINT) AS total_runs,
               count(*) FILTER (is_wicket = 1) AS total_wickets,
               count(*) FILTER (is_legal_delivery) AS total_balls,
               CAST(sum(runs_extras) AS BIGINT) AS total_extras
        FROM fact GROUP BY ALL""",
    "summary": f"""
        SELECT totals.*, win_type, {_overs('total_balls')} AS overs_played,
               {_half_up('6 * total_runs', 'total_balls')} AS run_rate,
               CASE WHEN totals.innings_number IN (2, 4) AND win_type <> 'unknown'
                    THEN earlier.runs + 1 END AS target
        FROM totals JOIN game USING (match_id)
        LEFT JOIN (SELECT match_id, innings_number + 1 AS next_innings, total_runs AS runs
                   FROM totals) earlier
          ON earlier.match_id = totals.match_id AND next_innings = totals.innings_number""",
    "appearances": """
        SELECT player_id, season, count(DISTINCT match_id) AS matches_played
        FROM squad JOIN game USING (match_id) GROUP BY ALL""",
    "bat_season": """
        SELECT player_id_batter, batter_name, season, batting_team AS team,
               count(DISTINCT match_id) AS innings, CAST(sum(runs) AS BIGINT) AS runs,
               max(runs) AS highest_score, CAST(sum(balls_faced) AS BIGINT) AS balls_faced,
               CAST(sum(fours) AS BIGINT) AS fours, CAST(sum(sixes) AS BIGINT) AS sixes,
               CAST(sum(dot_balls) AS BIGINT) AS dot_balls,
               CAST(sum(not_out) AS BIGINT) AS not_outs,
               count(*) FILTER (runs BETWEEN 50 AND 99) AS fifties,
               count(*) FILTER (runs > 99) AS hundreds
        FROM batting GROUP BY ALL""",
    "bowl_season": f"""
        SELECT *, {_overs('balls_bowled')} AS overs_bowled
        FROM (SELECT player_id_bowler, bowler_name, season, bowling_team AS team,
                     count(DISTINCT match_id) AS innings,
                     CAST(sum(runs_conceded) AS BIGINT) AS runs_conceded,
                     CAST(sum(balls_bowled) AS BIGINT) AS balls_bowled,
                     CAST(sum(wides) AS BIGINT) AS wides,
                     CAST(sum(noballs) AS BIGINT) AS noballs,
                     CAST(sum(dot_balls) AS BIGINT) AS dot_balls,
                     CAST(sum(wickets) AS BIGINT) AS wickets
              FROM bowling GROUP BY ALL)""",
    "season_stats": f"""
        SELECT a.player_id, a.season, matches_played,
               coalesce(batter_name, bowler_name) AS player_name,
               coalesce(x.team, y.team) AS team,
               x.innings AS innings_batted, runs, highest_score, balls_faced, fours, sixes,
               x.dot_balls AS dot_balls_faced, not_outs, fifties, hundreds,
               {_half_up('100 * runs', 'balls_faced')} AS strike_rate,
               CASE x.innings WHEN not_outs THEN CAST(runs AS DOUBLE)
                    ELSE {_half_up('runs', '(x.innings - not_outs)')} END AS batting_average,
               y.innings AS innings_bowled, runs_conceded, balls_bowled, overs_bowled, wides,
               noballs, y.dot_balls AS dot_balls_bowled, wickets,
               {_half_up('6 * runs_conceded', 'balls_bowled')} AS economy_rate,
               {_half_up('runs_conceded', 'wickets')} AS bowling_average
        FROM appearances a
        LEFT JOIN bat_season x ON x.player_id_batter = a.player_id AND x.season = a.season
        LEFT JOIN bowl_season y ON y.player_id_bowler = a.player_id AND y.season = a.season""",
    "arriving": """
        SELECT match_id, no % 3 + 1 AS revision, match_date AS created, '1.1.0' AS data_version,
               '2024-06-02 00:00:00' AS ingested_at
        FROM game""",
    "known": """
        SELECT unnest(CASE no % 3 WHEN 0 THEN [match_id, 'old' || no] ELSE [match_id] END) AS match_id,
               no % 4 AS revision, '2007-12-31' AS created, '1.0.0' AS data_version,
               '2024-06-01 00:00:00' AS ingested_at
        FROM game WHERE no % 5 <> 4""",
    "flawed": """
        SELECT match_id, player_name, player_id FROM squad JOIN game USING (match_id)
        WHERE NOT (suffix(player_id, '_0') AND no % 4 = 1)
        UNION ALL
        SELECT match_id, player_name, player_id FROM squad JOIN game USING (match_id)
        WHERE suffix(player_id, '_2') AND no % 5 = 2""",
}

_MATCH = """match_id, season, match_date, venue, city, match_number, team_1, team_2, toss_winner,
    toss_decision, match_winner, player_of_match, win_type, win_margin"""
_POSITION = "innings_number, over_number, delivery_index"
_SCORING = """is_legal_delivery, runs_batter, runs_extras, runs_total, extras_wides,
    extras_noballs, extras_byes, extras_legbyes, is_wicket, dismissal_kind, is_super_over,
    batting_team, bowling_team, source_file, ingested_at"""
_DELIVERY = f"""meta_version, meta_created, {_MATCH}, {_POSITION}, {_SCORING}, batter, bowler,
    non_striker, player_out, fielder"""
_FACT = f"""match_id, {_POSITION}, {_SCORING}, player_id_batter, player_id_bowler,
    player_id_non_striker, player_id_out, player_id_fielder"""
_HAS_SUPER_OVER = """SELECT no, max(CAST(inn > 2 AS BIGINT)) AS has_super_over
    FROM placed GROUP BY no"""


def _with_tables(select: str, until: str) -> str:
    """The select over all derived tables up to ``until``."""
    names = list(_CTE)
    needed = names[: names.index(until) + 1]
    tables = ",\n".join(f"{name} AS ({_CTE[name]})" for name in needed)
    return f"WITH {tables}\n{select}"


_SELECTS = {
    "read_match_docs": (
        """SELECT true AS named_by_file, any_value(no % 3 + 1) AS revision,
                  any_value(season) AS season, any_value(team_1 || '|' || team_2) AS teams,
                  count(DISTINCT innings_number) AS innings, count(*) AS deliveries,
                  23::BIGINT AS people, 22::BIGINT AS squad_members
           FROM delivery GROUP BY match_id""",
        "delivery",
    ),
    "read_document_lines": (
        """SELECT match_id, any_value(no % 3 + 1) AS revision, any_value(season) AS season,
                  any_value(team_1 || '|' || team_2) AS teams,
                  count(DISTINCT innings_number) AS innings, count(*) AS deliveries,
                  23::BIGINT AS people, 22::BIGINT AS squad_members
           FROM delivery GROUP BY match_id""",
        "delivery",
    ),
    "flatten_deliveries": (f"SELECT {_DELIVERY} FROM delivery", "delivery"),
    "match_player_registry": ("SELECT * FROM squad", "squad"),
    "player_registry": ("SELECT DISTINCT player_id, player_name FROM squad", "squad"),
    "dim_player": ("SELECT player_id, name_variants FROM player", "player"),
    "dim_match": (
        f"SELECT {_MATCH}, has_super_over FROM game JOIN ({_HAS_SUPER_OVER}) USING (no)",
        "game",
    ),
    "fact_delivery": (f"SELECT {_FACT} FROM fact", "fact"),
    "fact_from_documents": (f"SELECT {_FACT} FROM fact", "fact"),
    "fact_audit": (
        """SELECT match_id, bronze_rows, fact_rows, null_batters,
                  bronze_rows = fact_rows AS reconciled
           FROM (SELECT match_id, count(*) AS bronze_rows FROM delivery GROUP BY match_id)
           JOIN (SELECT d.match_id, count(*) AS fact_rows,
                        count(*) FILTER (s.player_id IS NULL) AS null_batters
                 FROM delivery d
                 LEFT JOIN flawed s ON s.match_id = d.match_id AND s.player_name = d.batter
                 LEFT JOIN flawed b ON b.match_id = d.match_id AND b.player_name = d.bowler
                 LEFT JOIN flawed n ON n.match_id = d.match_id AND n.player_name = d.non_striker
                 LEFT JOIN flawed o ON o.match_id = d.match_id AND o.player_name = d.player_out
                 LEFT JOIN flawed c ON c.match_id = d.match_id AND c.player_name = d.fielder
                 GROUP BY d.match_id) USING (match_id)""",
        "flawed",
    ),
    "content_audit": (
        f"""SELECT match_id, b.n AS bronze_rows, f.n AS fact_rows, null_batters, b.n = f.n AS reconciled,
                   match_id NOT IN (
                       SELECT match_id FROM (
                           (SELECT {_SHARED} FROM delivery EXCEPT ALL SELECT {_SHARED} FROM tampered)
                           UNION ALL
                           (SELECT {_SHARED} FROM tampered EXCEPT ALL SELECT {_SHARED} FROM delivery)
                       )) AS content_equal
            FROM (SELECT match_id, count(*) AS n FROM delivery GROUP BY match_id) b
            JOIN (SELECT match_id, count(*) AS n, count(*) FILTER (player_id_batter IS NULL) AS null_batters
                  FROM tampered GROUP BY match_id) f USING (match_id)""",
        "tampered",
    ),
    "batting_scorecard": ("SELECT * EXCLUDE (season) FROM batting", "batting"),
    "bowling_scorecard": ("SELECT * EXCLUDE (season) FROM bowling", "bowling"),
    "innings_totals": ("SELECT * FROM totals", "totals"),
    "team_match_summary": ("SELECT * FROM summary", "summary"),
    "player_matches": ("SELECT * FROM appearances", "appearances"),
    "batting_season_stats": ("SELECT * FROM bat_season", "bat_season"),
    "bowling_season_stats": ("SELECT * FROM bowl_season", "bowl_season"),
    "player_season_stats": ("SELECT * FROM season_stats", "season_stats"),
    "mart_row_counts": (
        """SELECT 'batting_scorecard' AS mart, count(*) AS row_count FROM batting
           UNION ALL SELECT 'bowling_scorecard', count(*) FROM bowling
           UNION ALL SELECT 'team_match_summary', count(*) FROM summary
           UNION ALL SELECT 'player_season_stats', count(*) FROM season_stats""",
        "season_stats",
    ),
    "distinct_win_types": ("SELECT DISTINCT win_type FROM game", "game"),
    "distinct_dismissal_kinds": ("SELECT DISTINCT dismissal_kind FROM fact", "fact"),
    "player_season_lookup": (
        "SELECT * FROM season_stats WHERE player_name LIKE '%P1\\_%' ESCAPE '\\' AND season = '2009'",
        "season_stats",
    ),
    "due_documents": (
        """SELECT match_id, revision FROM arriving
           WHERE NOT EXISTS (SELECT 1 FROM known
                             WHERE known.match_id = arriving.match_id
                               AND known.revision >= arriving.revision)""",
        "known",
    ),
    "upsert_manifest": (
        """SELECT match_id, greatest(a.revision, k.revision) AS revision,
                  coalesce(k.created, a.created) AS created,
                  coalesce(k.data_version, a.data_version) AS data_version,
                  CASE WHEN k.match_id IS NULL OR a.revision > k.revision
                       THEN a.ingested_at ELSE k.ingested_at END AS ingested_at
           FROM arriving a FULL JOIN known k USING (match_id)""",
        "known",
    ),
    "archive_manifest": (
        """SELECT *, '2024-06-03 00:00:00' AS archived_at, 'history' AS place FROM known
           UNION ALL BY NAME
           SELECT *, '2024-06-04 00:00:00' AS archived_at, 'history' AS place FROM arriving""",
        "known",
    ),
    "write_bronze_roundtrip": (
        f"""SELECT * REPLACE (CASE season WHEN '2007/08' THEN '1.0.0' ELSE meta_version END
                              AS meta_version)
            FROM (SELECT {_DELIVERY} FROM delivery)""",
        "delivery",
    ),
    "write_mart_roundtrip": ("SELECT * FROM summary", "summary"),
    "register_views": (
        """SELECT season, display_name AS batter_name, CAST(sum(runs_batter) AS BIGINT) AS runs
           FROM fact JOIN player ON player_id = player_id_batter GROUP BY ALL""",
        "fact",
    ),
    "incremental_build": ("SELECT * FROM season_stats", "season_stats"),
    "incremental_tables": (
        "\nUNION ALL\n".join(
            f"""SELECT '{table}' AS table_name, {unit} AS unit, count(*) AS row_count,
                       CAST(sum({total}) AS BIGINT) AS total
                FROM {source} GROUP BY {unit}"""
            for table, source, unit, total in (
                ("bronze", "delivery", "match_id", "runs_total"),
                ("fact_delivery", "fact", "match_id", "runs_total"),
                ("match_player_registry", "squad", "match_id", "1"),
                ("dim_match", "game", "match_id", "win_margin"),
                ("batting_scorecard", "batting", "match_id", "runs"),
                ("bowling_scorecard", "bowling", "match_id", "runs_conceded"),
                ("team_match_summary", "summary", "match_id", "total_runs"),
                ("manifest", "arriving", "match_id", "revision"),
                ("dim_player", "player", "player_id", "length(name_variants) - "
                 "length(replace(name_variants, '|', '')) + 1"),
                ("player_season_stats", "season_stats", "player_id", "matches_played"),
            )
        ),
        "arriving",
    ),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_tables(select, until) for name, (select, until) in _SELECTS.items()}
