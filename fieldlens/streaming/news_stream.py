"""Structured Streaming forms of the news flow (section J): marks per source, links seen once, keyed sinks, windows, clustering.

The marks are not Spark's watermark: each source has its own, compared strictly, and undated items pass. Links and marks are tables with a
commit log; a batch appends its links and upserts its marks as a transaction with its number, so one that is run again after a failure
anywhere gives the same state. Layers merge as they grow many, so what a batch opens does not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldlens.operators import news as N
from fieldlens.operators.grouping import THRESHOLD, Leader
from fieldlens.operators.snapshots import insert_new
from fieldlens.sources.tables import Table


class NewsFlow:
    """Items in, new links out: filter by mark, drop what is known, write, then advance the marks."""

    def __init__(self, links: Table, marks: Table, league_only: bool = False):
        self.links, self.marks, self.league_only = links, marks, league_only

    def batch(self, items: DataFrame, batch_id: int) -> None:
        """One micro-batch; running it again changes nothing more."""
        items = items.persist()
        try:
            marks = self.marks.read()
            fresh = items if marks is None else N.after_watermark(items, marks)
            links = N.processed_links(fresh, "seq", league_only=self.league_only)
            known = self.links.read()
            earlier = None if known is None else known.where(F.col("batch") < batch_id)  # not what an interrupted run of this batch wrote
            new = (links if earlier is None else insert_new(earlier, links, "url", "seq")).withColumn("batch", F.lit(batch_id)).persist()
            self.links.append(new, transaction=("links", batch_id))
            empty = items.sparkSession.createDataFrame([], "source string, last_published_at timestamp") if marks is None else marks
            self.marks.upsert(N.advanced(empty, new).coalesce(1), ["source"], transaction=("marks", batch_id))  # a row for each source
            new.unpersist()
        finally:
            items.unpersist()

    def start(self, stream: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()


def tumbling(events: DataFrame, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of each event type by fixed windows."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    return timed.groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts of each user's sessions, parted by a gap."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    return timed.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def seen_once(items: DataFrame, key: str, moment: str, late: str) -> DataFrame:
    """The first of each key within the lateness bound."""
    return items.withWatermark(moment, late).dropDuplicatesWithinWatermark([key])


def clustered(stream: DataFrame, block: Column, threshold: float = THRESHOLD) -> DataFrame:
    """E7 on a stream of (id, embedding): each block's state is its groups' sums and counts, so it grows with the groups and not with the stories.

    Stories join in the order of their ids within a micro-batch, and in the order of the batches. As in a run over stored groups, a story counts once in a
    micro-batch; stories grouped before are left out upstream (E12).
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        sums, counts = state.get if state.exists else ([], [])
        leader = Leader.resumed(threshold, sums, counts)
        out = []
        stories = pd.concat([frame[["id", "embedding"]] for frame in frames])  # a block's frames are parts of it in any order
        for ident, vector in stories.sort_values("id", kind="stable").itertuples(index=False):
            group, sim, _ = leader.assign(ident, np.asarray(vector, float))
            out.append((key[0], ident, group, sim))
        state.update((leader.sums[: leader.n].tolist(), leader.counts))
        yield pd.DataFrame(out, columns=["block", "id", "local_group", "sim"])

    rows = stream.withColumn("block", block)
    kind = dict(rows.dtypes)["block"]
    return rows.groupBy("block").applyInPandasWithState(step, f"block {kind}, id long, local_group int, sim double", "sums array<array<double>>, counts array<int>", "append", "NoTimeout")
