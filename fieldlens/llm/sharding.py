"""Sharding by proportional stratified interleaving.

Within each source, rows are put in a seeded pseudo-random order; row r of n gets the fractional rank
(2r + 1) / 2n. Sorting all rows by fractional rank interleaves the sources in proportion, so equal cuts of
that order are shards that all show the corpus mixture. Shard row counts differ by one at most (law ``rows``).

Defined results: a null source is a stratum of its own; null text counts as empty (size 1, CRC 0); a null
doc_id shuffles as the empty string; ties in the shuffle are ordered by doc_id, checksum and size; repeated rows each keep a slot; texts
of any length are measured whole; an empty table gives an empty result; extra columns are ignored, whatever their names.
Only a slim row (id, size, checksum, key) is shuffled, never the text.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm._common import materialize, rank_in_buckets, read

SHARDS = 16
SEED = 17
ROWS_PER_BUCKET = 2_000
MOST_BUCKETS = 65_536


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Assign every row of docs(doc_id, text, source) to a shard and to a gapless slot within it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col("source").cast("string"))).alias("stratum"),
            F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("shuffle_key"),
        )
    )
    n = slim.count()
    buckets = min(MOST_BUCKETS, max(16, math.ceil(n / rows_per_bucket)))
    ties = ["shuffle_key", "doc_id", "text_crc32", "size"]
    uniform = F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long")
    within = rank_in_buckets(slim.withColumn("bucket", F.shiftright(uniform * buckets, 32)), ["stratum"], "bucket", ties, "rank")
    totals = slim.groupBy("stratum").agg(F.count("*").alias("total"))
    spread = within.drop("bucket").join(totals, "stratum").withColumn("fraction", (2 * F.col("rank") + 1) / (2 * F.col("total")))
    spread = spread.withColumn("bucket", F.floor(F.col("fraction") * buckets))
    placed = rank_in_buckets(spread, [], "bucket", ["fraction", *ties], "place")
    cut = placed.withColumn("shard", F.expr(f"place * {shards} div {max(n, 1)}"))
    return cut.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("place") - F.expr(f"(shard * {n} + {shards - 1}) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"))


QUERIES = {"op1_sharding": op1_sharding}


def _crc_table() -> str:
    """CRC-32 of each byte (reflected polynomial 0xEDB88320), as a SQL list."""
    table = []
    for i in range(256):
        for _ in range(8):
            i = (i >> 1) ^ 0xEDB88320 if i & 1 else i >> 1
        table.append(i)
    return "[" + ",".join(map(str, table)) + "]::BIGINT[]"


CRC_SQL = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(t)) + 1),
  lambda i: ('0x' || substr(hex(encode(t)), 2 * i - 1, 2))::BIGINT)),
  lambda acc, b: xor(acc >> 8, ({_crc_table()})[(xor(acc, b) & 255) + 1])), 4294967295)"""

ORACLE = {
    "op1_sharding": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS stratum,
  md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
e AS (SELECT doc_id, stratum, k, octet_length(encode(t)) + 1 AS size, {CRC_SQL} AS text_crc32 FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY k, doc_id, text_crc32, size) - 1 AS r, count(*) OVER (PARTITION BY stratum) AS n FROM e),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * r + 1)::DOUBLE / (2 * n)::DOUBLE, k, doc_id, text_crc32, size) - 1 AS p, count(*) OVER () AS total FROM r),
s AS (SELECT *, p * {SHARDS} // total AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
  (p - (shard * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM s""",
}
