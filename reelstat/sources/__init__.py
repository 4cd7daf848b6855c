"""Readers for landing documents, raw responses, files and tables."""

from reelstat.sources.checked import (
    checked_landing, documents_of, landing_with_rest, quarantined,
)
from reelstat.sources.curated import curated_since, read_curated
from reelstat.sources.files import NA_STRINGS, load_file, read_csv_headerless
from reelstat.sources.landing import (
    channel_paths, landing_manifest, of_channels, read_landing,
)
from reelstat.sources.responses import (
    channels_from_responses, ids_from_playlist_pages, videos_from_responses,
)

__all__ = [
    "NA_STRINGS", "channel_paths", "channels_from_responses", "checked_landing", "curated_since",
    "documents_of", "ids_from_playlist_pages", "landing_manifest", "landing_with_rest", "load_file",
    "of_channels", "quarantined", "read_csv_headerless", "read_curated", "read_landing", "videos_from_responses",
]
