"""Jobs as keyed state with time to live and timers (G30, G31 as a stream).

Each job is one key: a value of its state with a time to live, and a list of its attempts. Events move it on by the rules of
``operators.jobs``: only a queued job can be claimed, an ended one stays ended. A claimed job sets a processing-time timer; if it fires and the same attempt still runs, the
job goes back into the queue while it has attempts left. Expired jobs leave the state store by themselves. State is kept by RocksDB, one column family a variable,
so its size on disk and its checkpoints follow the number of live jobs, and a restart goes on where the last run stopped. A query with timers never runs out of batches:
start it with a processing-time trigger, or with ``once`` for what is there.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fieldlens.operators.jobs import MOST_ATTEMPTS, RUNNING_SECONDS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "job_id long, status string, attempts int, cause string, at long"  # at: milliseconds
_JOB = T.StructType([T.StructField("status", T.StringType()), T.StructField("attempts", T.IntegerType()), T.StructField("deadline", T.LongType())])
_ATTEMPT = T.StructType([T.StructField("started", T.LongType())])


class Jobs(StatefulProcessor):
    """Rows (job_id, event, seq) in, changes of state out; event is created, claimed, succeeded or failed."""

    def __init__(self, running: float = RUNNING_SECONDS, attempts: int = MOST_ATTEMPTS, live: float = 86_400):
        self.running, self.attempts, self.live = int(running * 1000), attempts, int(live * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.job = handle.getValueState("job", _JOB, self.live)
        self.tries = handle.getListState("tries", _ATTEMPT, self.live)

    def _rows(self, key: Any, changes: list[tuple[str, int, str, int]]) -> Iterator[Row]:
        for status, attempts, cause, at in changes:
            yield Row(job_id=key[0], status=status, attempts=attempts, cause=cause, at=at)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now, changes = timerValues.getCurrentProcessingTimeInMs(), []
        status, attempts, deadline = self.job.get() or (None, 0, 0)
        for event in [r["event"] for r in sorted(rows, key=lambda r: (r["seq"] is None, r["seq"]))]:
            before = status
            if event == "created" and status is None:
                status = "queued"
            elif event == "claimed" and status == "queued":
                status, attempts, deadline = "running", attempts + 1, now + self.running
                self.tries.appendValue((now,))
            elif event in ("succeeded", "failed") and status == "running":
                status, deadline = event, 0
            if status != before:
                changes.append((status, attempts, event, now))
        if changes:
            if status == "running" and deadline == now + self.running:
                self.handle.registerTimer(deadline)
            self.job.update((status, attempts, deadline))
        yield from self._rows(key, changes)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        found = self.job.get()
        if not found:  # expired meanwhile
            return
        status, attempts, deadline = found
        if status == "running" and deadline == expiredTimerInfo.getExpiryTimeInMs() and attempts < self.attempts:
            self.job.update(("queued", attempts, 0))
            yield from self._rows(key, [("queued", attempts, "timer", timerValues.getCurrentProcessingTimeInMs())])

    def close(self) -> None:
        pass


def changes(events: DataFrame, running: float = RUNNING_SECONDS, attempts: int = MOST_ATTEMPTS, live: float = 86_400) -> DataFrame:
    """A stream of job events(job_id, event, seq) as a stream of state changes."""
    rows = events.select("job_id", "event", "seq")
    return rows.groupBy("job_id").transformWithState(Jobs(running, attempts, live), OUTPUT, "Update", "ProcessingTime")


def use_rocksdb(spark: SparkSession) -> None:
    """Several state variables, timers and time to live need this state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
