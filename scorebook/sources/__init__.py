from scorebook.sources.documents import (
    list_documents,
    parse_documents,
    read_document_lines,
    read_match_documents,
    stream_match_documents,
)
from scorebook.sources.store import ConcurrentRunError, Store
from scorebook.sources.tables import (
    create_tables,
    read_table,
    register_views,
    write_players,
    write_seasons,
    write_table,
)
from scorebook.sources.workspace import new_folder, shared_folder

__all__ = [
    "ConcurrentRunError",
    "Store",
    "create_tables",
    "list_documents",
    "new_folder",
    "parse_documents",
    "read_document_lines",
    "read_match_documents",
    "read_table",
    "register_views",
    "shared_folder",
    "stream_match_documents",
    "write_players",
    "write_seasons",
    "write_table",
]
