"""DataFrame → DataFrame operators that hold up when one key owns a large share of the rows."""

from reelstat.operators.chains import chain_positions, flatten_chain
from reelstat.operators.documents import assemble_documents, chunk_ids, flatten_pages
from reelstat.operators.joins import having_keys
from reelstat.operators.nested import expand_nested, explode_videos
from reelstat.operators.ordinals import positions, running_total
from reelstat.operators.ranking import top_k, top_k_per

__all__ = [
    "assemble_documents", "chain_positions", "chunk_ids", "expand_nested", "explode_videos",
    "flatten_chain", "flatten_pages", "having_keys", "positions", "running_total", "top_k", "top_k_per",
]
