"""Pipelines that feed keyed tables, dry runs, and runs over all of them (A20-A30); the tables are in tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from fieldlens.sources.tables import Table


@dataclass
class Pipeline:
    """A source, a transformation and a keyed target."""

    source: Callable[[], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    keys: list[str] = field(default_factory=list)

    def prepare(self) -> DataFrame:
        return self.transform(self.source())

    def inspect(self, rows: int = 5) -> dict:
        raw = self.source()
        return {"columns": raw.columns, "types": dict(raw.dtypes), "head": raw.limit(rows).collect(), "rows": raw.count()}

    def run(self, table: Table | None) -> int:
        """Write to the table; without one (a dry run, A26) only compute."""
        out = self.prepare()
        if table is None:
            out.write.format("noop").mode("overwrite").save()
            return out.count()
        table.upsert(out, self.keys)
        return table.read().count()


def sync_all(pipelines: dict[str, Pipeline], tables: dict[str, Table], dry_run: bool = False) -> dict[str, int | str]:
    """Run every pipeline; one that fails is noted and the others go on."""
    done: dict[str, int | str] = {}
    for name, pipeline in pipelines.items():
        try:
            done[name] = pipeline.run(None if dry_run else tables[name])
        except Exception as e:
            done[name] = f"failed: {str(e).splitlines()[0]}"
    return done
