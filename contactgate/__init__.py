"""contactgate: contact-point permission analytics as Spark DataFrame operators.

Layers
------
sources    raw delivery files, stand-in feeds over the test tables, versioned tables
functions  column-level helpers (account key, phone normalisation, tri-state, dates)
operators  generic DataFrame operators (latest-by, deletes, reconcile, decide,
           upsert, change diff, quality checks)
plans      the phone-consent configuration, incremental state, reports, query catalog
streaming  incremental application of change files with Structured Streaming

Most used entry points::

    from contactgate import ingest_snapshot, ingest_change, ingest_enrollment
    from contactgate import build_state, build_consent, decide, can_send_sms
"""

__version__ = "0.1.0"

from contactgate.operators.decide import can_send_sms, decide, denial_reason  # noqa: E402
from contactgate.operators.latest import dedup_by, latest_by  # noqa: E402
from contactgate.operators.merge import diff, gap_fill, upsert  # noqa: E402
from contactgate.operators.quality import evaluate, gate, verdict  # noqa: E402
from contactgate.plans.incremental import IncrementalState  # noqa: E402
from contactgate.plans.phone_state import (  # noqa: E402
    build_consent, build_state, consent_history,
)
from contactgate.sources.delivery import (  # noqa: E402
    ingest_change, ingest_enrollment, ingest_snapshot,
)
from contactgate.sources.tables import RunTable  # noqa: E402

__all__ = [
    "IncrementalState", "RunTable", "build_consent", "build_state", "can_send_sms",
    "consent_history", "decide", "dedup_by", "denial_reason", "diff", "evaluate", "gap_fill",
    "gate", "ingest_change", "ingest_enrollment", "ingest_snapshot", "latest_by", "upsert",
    "verdict",
]
