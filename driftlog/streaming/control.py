"""Job control: ``--key value`` options, checkpoint/trigger settings, restarts.

A checkpointed query resumes from its last committed micro-batch, so a
restart loop around ``start()``/``awaitTermination()`` gives the fixed-delay
restart strategy of the reference; on a cluster the resource manager's own
retries (``spark.yarn.maxAppAttempts``, Kubernetes restart policy) do the
same for driver loss.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

# Default checkpoint interval and restart delay (milliseconds).
DEFAULT_CK_TIME_MS = 5000
RESTART_DELAY_MS = 5000


def parse_job_args(argv: Sequence[str], required: Sequence[str] = ("topics", "restart_count")) -> dict[str, str]:
    """``--key value`` pairs (also ``-key value``) into a dict; checks required keys."""
    opts: dict[str, str] = {}
    i = 0
    argv = list(argv)
    while i < len(argv):
        a = argv[i]
        if not a.startswith("-"):
            raise ValueError(f"expected --key, got {a!r}")
        key = a.lstrip("-")
        if i + 1 < len(argv) and not argv[i + 1].startswith("--"):
            opts[key] = argv[i + 1]
            i += 2
        else:
            opts[key] = "true"
            i += 1
    missing = [k for k in required if k not in opts]
    if missing:
        raise ValueError(f"missing required option(s): {', '.join('--' + k for k in missing)}")
    return opts


def trigger_of(opts: dict[str, str]) -> dict:
    """Micro-batch trigger from ``ck_time`` (ms): each batch commits a checkpoint."""
    ms = int(opts.get("ck_time", DEFAULT_CK_TIME_MS))
    return {"processingTime": f"{ms} milliseconds"}


def checkpoint_of(spark: SparkSession, opts: dict[str, str], job: str) -> str:
    """Checkpoint folder: ``--checkpoint`` or ``<spark.checkpoint.dir>/driftlog/<job>``.

    Checkpoints are never deleted by the job, so a cancelled query can be
    resumed (the reference keeps externalized checkpoints on cancel).
    """
    if "checkpoint" in opts:
        return opts["checkpoint"]
    from driftlog.session import shared_path
    return shared_path(spark, "checkpoints", job)


def run_with_restarts(start: Callable[[], StreamingQuery], restart_count: int,
                      delay_ms: int = RESTART_DELAY_MS,
                      sleep: Callable[[float], None] = time.sleep,
                      until: Callable[[StreamingQuery], None] | None = None) -> int:
    """Start a query; on failure (to start, too: a source may be away) wait ``delay_ms`` and start it again, at most
    ``restart_count`` times.  Returns the number of restarts used.

    ``until`` waits for the query (default ``awaitTermination``); tests pass
    ``processAllAvailable`` + ``stop``.
    """
    if restart_count is None or int(restart_count) < 0:
        raise ValueError("restart_count must be a non-negative integer")
    restarts = 0
    while True:
        q = None
        try:
            q = start()
            if until is None:
                q.awaitTermination()
            else:
                until(q)
            return restarts
        except Exception:
            if q is not None:
                try:
                    q.stop()
                except Exception:
                    pass
            if restarts >= int(restart_count):
                raise
            restarts += 1
            sleep(delay_ms / 1000.0)
