from contactgate.sources.delivery import (
    deliver, ingest_change, ingest_enrollment, ingest_snapshot, read_pipe_csv, with_lineage,
)
from contactgate.sources.standin import (
    change_feed, enrollment_feed, feeds, permission_requests, snapshot_feed,
)

__all__ = [
    "deliver", "ingest_change", "ingest_enrollment", "ingest_snapshot", "read_pipe_csv",
    "with_lineage", "change_feed", "enrollment_feed", "feeds", "permission_requests",
    "snapshot_feed",
]
