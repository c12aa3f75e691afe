"""Figures of a run equal separate counts and come with the work."""

import time

import pytest
from pyspark.sql import functions as F

from fieldlens.operators.monitoring import Run, StreamMetrics


def test_counts_come_with_the_action(spark, frame):
    ticks = iter(range(100))
    run = Run(sources=["a", "b"], clock=lambda: float(next(ticks)))
    df = frame([("a", 1), ("a", None), ("b", 3), ("c", 4)], "source string, v int")
    kept = run.observed("kept", run.observed("read", df, F.col("v").isNull()).where("v is not null"))
    with run.timed("kept"):
        kept.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError), run.timed("broken"):
        raise ValueError("why\nmore")
    run.finish()
    got = run.report()
    assert got["stages"]["read"] == {"rows": 4, "failed": 1, "seconds": None, "per_second": None, "by_source": {"a": 2, "b": 1}}
    assert got["stages"]["kept"] == {"rows": 3, "failed": 0, "seconds": 1.0, "per_second": 3.0, "by_source": {"a": 1, "b": 1}}
    assert got["errors"] == ["broken: why"] and got["seconds"] == 5.0
    assert {tuple(r) for r in run.rows(spark).collect()} == {("read", None, 4, 1), ("read", "a", 2, 1), ("read", "b", 1, 0), ("kept", None, 3, 0), ("kept", "a", 1, 0), ("kept", "b", 1, 0)}


def test_stream_metrics(spark, frame, tmp_path):
    metrics = StreamMetrics()
    spark.streams.addListener(metrics)
    try:
        for part in ([1, 2, 3], [4, 5]):
            frame([(x,) for x in part], "v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("v int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")).observe("seen", F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") > 2).alias("large"))
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        query.awaitTermination()
        for _ in range(100):
            if str(query.id) in metrics.ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(metrics)
    got = metrics.summary(str(query.id))
    assert (got["batches"], got["rows"], got["observed"], got["error"]) == (2, 5, {"seen": {"n": 5, "large": 3}}, None) and got["seconds"] > 0
