"""Writers for documents, files and tables."""

from reelstat.sinks.batches import append_rows
from reelstat.sinks.compaction import compact_table
from reelstat.sinks.files import write_csv, write_documents
from reelstat.sinks.tables import (
    append_curated, append_table, create_curated, overwrite_partitions, reload_curated,
    replace_table,
)
from reelstat.sinks.versions import compact_versions, current_documents, land_version

__all__ = [
    "append_curated", "append_rows", "append_table", "compact_table", "compact_versions",
    "create_curated", "current_documents", "land_version", "overwrite_partitions", "reload_curated",
    "replace_table", "write_csv", "write_documents",
]
