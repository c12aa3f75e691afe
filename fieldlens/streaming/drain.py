"""Run a streaming query over what is there now and return its output as a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldlens.session import shared_dir


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 1) -> DataFrame:
    """A table's files as a stream; its schema is read first, as streams want it declared."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isFile():  # streams read folders
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(path)


def drain(stream: DataFrame, mode: str = "append", once: bool = False, path: str | None = None) -> DataFrame:
    """Everything that the query gives for the files present, through a Parquet folder in the shared checkpoint folder.

    A query with timers always has another batch to run, so it takes all files in one (``once``). With a ``path``, a query that is started again goes on where it stopped.
    """
    spark = stream.sparkSession
    path = path or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(path if mode == "complete" else f"{path}/batch={number}")

    query = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(**{"once" if once else "availableNow": True}).start()
    query.awaitTermination()
    read = spark.read.schema(stream.schema)
    return read.parquet(path) if mode == "complete" else read.option("recursiveFileLookup", "true").parquet(path)
