from scorebook.operators.deliveries import flatten_deliveries
from scorebook.operators.lookups import (
    distinct_dismissal_kinds,
    distinct_win_types,
    player_season_lookup,
)
from scorebook.operators.manifest import (
    archive_manifest,
    document_manifest,
    due_documents,
    upsert_manifest,
)
from scorebook.operators.quality import content_audit, fact_audit, mart_row_counts
from scorebook.operators.registry import dim_player, match_player_registry, player_registry
from scorebook.operators.scorecards import batting_scorecard, bowling_scorecard
from scorebook.operators.season import (
    batting_season_stats,
    bowling_season_stats,
    player_matches,
    player_season_stats,
)
from scorebook.operators.star import (
    dim_match,
    dim_match_from_documents,
    fact_delivery,
    fact_from_documents,
)
from scorebook.operators.summary import innings_totals, team_match_summary

__all__ = [
    "archive_manifest",
    "batting_scorecard",
    "batting_season_stats",
    "bowling_scorecard",
    "bowling_season_stats",
    "content_audit",
    "dim_match",
    "dim_match_from_documents",
    "dim_player",
    "distinct_dismissal_kinds",
    "distinct_win_types",
    "document_manifest",
    "due_documents",
    "fact_audit",
    "fact_delivery",
    "fact_from_documents",
    "flatten_deliveries",
    "innings_totals",
    "mart_row_counts",
    "match_player_registry",
    "player_matches",
    "player_registry",
    "player_season_lookup",
    "player_season_stats",
    "team_match_summary",
    "upsert_manifest",
]
