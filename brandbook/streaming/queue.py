"""The visit queue as a stream of outcomes with timers, beside the table in ``operators.frontier``.

Outcomes are rows (association, reg_number, outcome, error, retry_after, at): seed, done, skipped, failed or refused. Two
views of them hold state:

* ``entries``, one state an animal: what ``frontier.visited`` makes of the outcomes in order. An entry that is done or
  skipped is forgotten ``keep`` seconds later, told by a timer, so state holds what may still change;
* ``hosts``, one state an association: refusals in a row, the wait that each one asks for and whether to stop, as
  ``frontier.refusal_streaks`` tells them, and a row ``resume`` by a timer when the wait is over.

Timers run on event time: they ring when the watermark has passed them, so a replay rings them at the same rows. Rows of a
batch are taken in order of ``at`` and reg_number; those later than the watermark are dropped by Spark. A host's
state is three numbers, and its rows of one batch are read in chunks, yet by one task: a refusal counts only with those before it.
State must be in RocksDB, which ``ready`` sets."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brandbook.operators.frontier import BACKOFF_STEP, MOST_BACKOFF, STOP_AFTER

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTCOME = "association string, reg_number string, outcome string, error string, retry_after int, at timestamp"
ENTRY = "association string, reg_number string, status string, attempts int, last_error string, at timestamp"
VISIT = "association string, reg_number string, kind string, streak int, wait int, stop boolean, at timestamp"
KEEP = 86_400
MOST_ATTEMPTS = 3


def ready(spark: SparkSession) -> None:
    """Keep the state of streams that this session starts from now on in RocksDB, as timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def _millis(at: pd.Timestamp) -> int:
    return int(at.timestamp() * 1000)


def _time(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc).replace(tzinfo=None)


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(["at", "reg_number", "outcome"], kind="stable", na_position="first")


def _nothing(ddl: str) -> pd.DataFrame:
    return pd.DataFrame(columns=[c.split(" ")[0] for c in ddl.split(", ")])


class _Entry(StatefulProcessor):
    def __init__(self, most_attempts: int, keep: int):
        self.most_attempts, self.keep = most_attempts, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "status string, attempts int, last_error string, ends bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        status, attempts, error, ends = self.entry.get() if self.entry.exists() else (None, 0, None, None)
        out = []
        for row in _in_order(rows).itertuples(index=False):
            if status is None:  # whatever is heard first of an animal makes it known
                status = "pending"
            elif row.outcome in ("seed", "refused"):
                continue
            if row.outcome in ("done", "skipped"):
                status = row.outcome
            elif row.outcome == "failed":
                attempts, error = attempts + 1, None if row.error is None else row.error[:500]
                status = "failed" if attempts >= self.most_attempts else "pending"
            out.append((*key, status, attempts, error, row.at))
            if ends is not None:
                self.handle.deleteTimer(ends)
            ends = _millis(row.at) + 1000 * self.keep if status in ("done", "skipped") else None
            if ends is not None:
                self.handle.registerTimer(ends)
        self.entry.update((status, attempts, error, ends))
        yield pd.DataFrame(out, columns=_nothing(ENTRY).columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.entry.clear()
        yield _nothing(ENTRY)

    def close(self) -> None:
        pass


class _Host(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.host = handle.getValueState("host", "streak int, ends bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        streak, ends = self.host.get() if self.host.exists() else (0, None)
        out = []
        for row in _in_order(rows).itertuples(index=False):
            if row.outcome == "seed":
                continue
            if ends is not None:
                self.handle.deleteTimer(ends)
                ends = None
            streak, wait = (streak + 1, 0) if row.outcome == "refused" else (0, 0)
            if streak:
                wait = min(BACKOFF_STEP * streak, MOST_BACKOFF) if pd.isna(row.retry_after) else int(row.retry_after)
                ends = _millis(row.at) + 1000 * wait
                self.handle.registerTimer(ends)
            out.append((*key, row.reg_number, "visit", streak, wait, streak >= STOP_AFTER, row.at))
        self.host.update((streak, ends))
        yield pd.DataFrame(out, columns=_nothing(VISIT).columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        streak, ends = self.host.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        if ends == at:
            self.host.update((streak, None))
        yield pd.DataFrame([(*key, None, "resume", streak, 0, streak >= STOP_AFTER, _time(at))], columns=_nothing(VISIT).columns)

    def close(self) -> None:
        pass


def entries(outcomes: DataFrame, most_attempts: int = MOST_ATTEMPTS, keep: int = KEEP, late: str = "0 seconds") -> DataFrame:
    """A row (association, reg_number, status, attempts, last_error, at) for each change of an entry; the last of an animal counts."""
    rows = outcomes.where("association is not null and reg_number is not null and at is not null").withWatermark("at", late)
    return rows.groupBy("association", "reg_number").transformWithStateInPandas(_Entry(most_attempts, keep), ENTRY, "Append", "EventTime")


def hosts(outcomes: DataFrame, late: str = "0 seconds") -> DataFrame:
    """A row of kind visit for each outcome, with streak, wait and stop, and one of kind resume when a wait is over."""
    rows = outcomes.where("association is not null and at is not null").withWatermark("at", late)
    return rows.groupBy("association").transformWithStateInPandas(_Host(), VISIT, "Append", "EventTime")
