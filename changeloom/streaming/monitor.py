"""What a running capture reports: counts that Spark gathers as rows pass (Dataset.observe), and a listener that adds them up, warns of retained log and of failures, once in a while.

    spark.streams.addListener(Monitor(client, options))
    assembled(watched(landed)).writeStream...
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from changeloom.operators.decode import message_kind
from changeloom.sources.control import Options, Throttle, retention_warning

LOG = logging.getLogger(__name__)
NAME = "capture"
LEVELS = {"error": logging.ERROR, "warn": logging.WARNING, "debug": logging.DEBUG}


def watched(raw: DataFrame, name: str = NAME) -> DataFrame:
    """raw messages, counted on their way: messages, bytes, changes, snapshot_rows, definitions, commits and the last position."""
    kind = message_kind(F.col("data"))
    of = lambda *kinds: F.count_if(kind.isin(*kinds))
    return raw.observe(
        name, F.count("*").alias("messages"), F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).alias("bytes"), of("I", "U", "D", "T").alias("changes"), of("s").alias("snapshot_rows"), of("R").alias("definitions"),
        of("C", "c").alias("commits"), F.max("recv_lsn").alias("last_lsn"),
    )


class Monitor(StreamingQueryListener):
    """Counters by query id. With a client and options the log that the server keeps for the slot is looked at after each batch and warned of when it is more than allowed; failures are errors at first, then warnings a minute apart."""

    def __init__(self, client=None, options: Options | None = None, name: str = NAME, every: float = 60, clock=time.monotonic):
        self.client, self.options, self.name = client, options, name
        self.retained, self.failures = Throttle(every, clock), Throttle(every, clock)
        self.counters: dict[str, dict[str, int]] = {}

    def _of(self, query) -> dict[str, int]:
        return self.counters.setdefault(str(query), {"batches": 0, "failures": 0})

    def onQueryStarted(self, event) -> None:
        self._of(event.id)

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        held = self._of(event.progress.id)
        if seen is not None:
            held["batches"] += 1
            for k, v in seen.asDict().items():
                held[k] = max(held.get(k, 0), v or 0) if k.startswith("last_") else held.get(k, 0) + (v or 0)
            LOG.info("batch %d: %s", event.progress.batchId, seen.asDict())
        self.failures.success()
        if self.client is not None and self.options is not None:
            try:
                warning = retention_warning(self.client, self.options, self.retained)
            except OSError as e:
                LOG.log(LEVELS[self.failures.failure()], "asking for the retained log failed: %s", e)
            else:
                if warning:
                    LOG.warning(warning)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._of(event.id)["failures"] += 1
            LOG.log(LEVELS[self.failures.failure()], "query %s failed: %s", event.id, event.exception)
