"""Metrics of a run (G6, H12, G39), gathered in the passes that do the work: ``DataFrame.observe`` for batches, a listener for streams.

A stage that is observed costs no second scan: its counts come with the action that computes it, and only then. Counts by source are conditional counts of the configured sources,
so a report has as many figures as the configuration has sources, whatever the number of rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STAGE_ROWS = "stage string, source string, rows long, failed long"


@dataclass
class Run:
    """What one run found, kept, wrote and failed at, and how long its stages took."""

    run_id: str = field(default_factory=lambda: f"run-{uuid.uuid4().hex[:12]}")
    sources: list[str] = field(default_factory=list)
    clock: Callable[[], float] = time.monotonic
    seconds: dict[str, float] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._began, self._ended = self.clock(), None
        self._seen: dict[str, Observation] = {}

    def observed(self, stage: str, df: DataFrame, failed: Column | None = None, source: str = "source") -> DataFrame:
        """df as it is; its first action counts its rows, those that failed, and those of each configured source."""
        self._seen[stage] = seen = Observation(f"{self.run_id}-{stage}")
        by = [F.count_if(F.col(source) == s).alias(f"s{i}") for i, s in enumerate(self.sources)] if source in df.columns else []
        fails = [F.count_if((F.col(source) == s) & failed).alias(f"f{i}") for i, s in enumerate(self.sources)] if by and failed is not None else []
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *([] if failed is None else [F.count_if(failed).alias("failed")]), *by, *fails)

    @contextmanager
    def timed(self, stage: str) -> Iterator[None]:
        """Time a stage; an error is noted, and goes on."""
        at = self.clock()
        try:
            yield
        except Exception as e:
            self.errors.append(f"{stage}: {str(e).splitlines()[0] if str(e) else type(e).__name__}")
            raise
        finally:
            self.seconds[stage] = self.seconds.get(stage, 0.0) + self.clock() - at

    def finish(self) -> None:
        self._ended = self.clock()

    def counts(self, stage: str) -> dict[str, int]:
        """The figures of a stage whose action has run."""
        return self._seen[stage].get

    def report(self) -> dict:
        """Rows and failures of each stage, durations, and rows a second."""
        total = (self.clock() if self._ended is None else self._ended) - self._began
        stages = {}
        for name in self._seen:
            got, took = self.counts(name), self.seconds.get(name)
            rate = got["rows"] / took if took else None
            stages[name] = {"rows": got["rows"], "failed": got.get("failed", 0), "seconds": took, "per_second": rate, "by_source": {s: got[f"s{i}"] for i, s in enumerate(self.sources) if f"s{i}" in got}}
        return {"run_id": self.run_id, "seconds": total, "stages": stages, "errors": list(self.errors)}

    def rows(self, spark: SparkSession) -> DataFrame:
        """The report's counts as a table: one row a stage (source null) and one a stage and source."""
        out = []
        for name in self._seen:
            got = self.counts(name)
            out.append((name, None, got["rows"], got.get("failed", 0)))
            out += [(name, s, got[f"s{i}"], got.get(f"f{i}", 0)) for i, s in enumerate(self.sources) if f"s{i}" in got]
        return spark.createDataFrame(out, STAGE_ROWS)


class StreamMetrics(StreamingQueryListener):
    """Sums of each streaming query's batches, kept as they come: batches, rows, what the query observes, durations, and rates."""

    def __init__(self) -> None:
        self.queries: dict[str, dict] = {}
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        self.queries.setdefault(str(event.id), {"batches": 0, "rows": 0, "seconds": 0.0, "observed": {}})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        held = self.queries.setdefault(str(p.id), {"batches": 0, "rows": 0, "seconds": 0.0, "observed": {}})
        held["batches"] += 1
        held["rows"] += p.numInputRows
        held["seconds"] += dict(p.durationMs).get("triggerExecution", 0) / 1000
        for name, row in (p.observedMetrics or {}).items():
            sums = held["observed"].setdefault(name, {})
            for k, v in row.asDict().items():
                sums[k] = sums.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.id)] = event.exception

    def summary(self, query_id: str) -> dict:
        held = self.queries[query_id]
        return held | {"per_second": held["rows"] / held["seconds"] if held["seconds"] else None, "error": self.ended.get(query_id)}

    def as_json(self) -> str:
        return json.dumps({k: self.summary(k) for k in self.queries}, sort_keys=True)
