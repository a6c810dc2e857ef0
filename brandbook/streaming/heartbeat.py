"""What a running stream tells of itself: a listener turns the progress of its batches into a status file."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from brandbook.session import replace_text


class Heartbeat(StreamingQueryListener):
    """Replaces ``path`` in one step after each batch of the query named ``query``, so that ``records.read_status`` reads a whole object:
    association, state (running, done, stopped or failed), processed, rate_per_min since the start, updated_at, and in
    counts the last batch and its rows. Idle triggers renew updated_at, by which readers tell a live stream."""

    def __init__(self, spark: SparkSession, path: str, association: str, query: str):
        self.spark, self.path, self.association, self.query = spark, path, association, query
        self.run, self.began, self.processed, self.counts = None, None, 0, {}

    def _tell(self, state: str) -> None:
        now = datetime.now(timezone.utc)
        minutes = (now - self.began).total_seconds() / 60
        told = {
            "association": self.association, "state": state, "counts": self.counts, "processed": self.processed,
            "rate_per_min": round(self.processed / minutes, 1) if minutes > 0 else 0.0, "updated_at": now.isoformat(),
        }
        replace_text(self.spark, self.path, json.dumps(told))

    def onQueryStarted(self, event) -> None:
        if event.name == self.query:
            self.run, self.began, self.processed, self.counts = event.runId, datetime.now(timezone.utc), 0, {}
            self._tell("running")

    def onQueryProgress(self, event) -> None:
        if event.progress.runId == self.run:
            self.processed += event.progress.numInputRows
            self.counts = {"batch": event.progress.batchId, "rows": event.progress.numInputRows}
            self._tell("running")

    def onQueryIdle(self, event) -> None:
        if event.runId == self.run:
            self._tell("running")

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self._tell("failed" if event.exception else "stopped")


def listened(spark: SparkSession, path: str, association: str, query: str) -> Heartbeat:
    """A heartbeat that is told of the session's queries; ``spark.streams.removeListener`` ends that."""
    beat = Heartbeat(spark, path, association, query)
    spark.streams.addListener(beat)
    return beat
