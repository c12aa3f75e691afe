"""Jobs as keyed state: timers, time to live, and a restart, against the batch form of the rules."""

import time

from fieldlens.streaming.job_stream import changes, use_rocksdb

EVENTS = "job_id long, event string, seq long"


def test_timers_and_expiry_over_restarts(spark, frame, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    out = []

    def run(rows, **limits):
        """One start of the query over what has come since the last one."""
        frame(rows, EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = changes(spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in")), **limits)
        query = stream.writeStream.outputMode("update").foreachBatch(lambda df, _: out.extend(tuple(r)[:4] for r in df.collect())).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(once=True).start()
        assert query.awaitTermination(60)
        got = sorted(out)
        out.clear()
        return got

    limits = {"running": 1.0, "attempts": 2, "live": 30}
    try:
        assert run([(1, "created", 1), (1, "claimed", 2), (2, "created", 1), (2, "claimed", 2), (2, "succeeded", 3), (3, "claimed", 1), (4, "created", 1), (4, "claimed", 2), (4, "claimed", 3)], **limits) == [
            (1, "queued", 0, "created"), (1, "running", 1, "claimed"), (2, "queued", 0, "created"), (2, "running", 1, "claimed"), (2, "succeeded", 1, "succeeded"), (4, "queued", 0, "created"), (4, "running", 1, "claimed"),
        ]
        time.sleep(1.2)
        # The timers of 1 and 4 fire after the restart; the end of 4 that comes in the same batch is handled before its timer.
        assert run([(4, "succeeded", 4), (5, "created", 1)], **limits) == [(1, "queued", 1, "timer"), (4, "succeeded", 1, "succeeded"), (5, "queued", 0, "created")]
        assert run([(1, "claimed", 5), (2, "claimed", 9)], **limits) == [(1, "running", 2, "claimed")]
        time.sleep(1.2)
        assert run([(6, "created", 1)], **limits) == [(6, "queued", 0, "created")]  # 1 has no attempts left: it stays
        assert run([(1, "failed", 6)], **limits) == [(1, "failed", 2, "failed")]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_expired_jobs_leave_the_state(spark, frame, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    use_rocksdb(spark)
    out = []
    try:
        for wait in (0, 2.5):
            time.sleep(wait)
            frame([(1, "created", 1)], EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = changes(spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in")), live=2)
            stream.writeStream.outputMode("update").foreachBatch(lambda df, _: out.extend(tuple(r)[:4] for r in df.collect())).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(once=True).start().awaitTermination(60)
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert out == [(1, "queued", 0, "created")] * 2  # the second is a new job
