"""Streaming form of the popularity count.

The reference is batch only.  The one operator that is naturally
incremental — the popularity score of A1, a count per item — is offered over
a stream of interaction files as well, with the same result as the batch
``popularity_scores`` once the stream has caught up.
"""

from tastemap.streaming.popularity import latest_snapshot, popularity_stream

__all__ = ["latest_snapshot", "popularity_stream"]
