"""Corpus preparation in five stages: drop toxic documents, drop poor ones, keep one of each group of near-duplicates, drop
documents that hold benchmark items, and pack the rest into sequences.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept; all but the last return the
columns of documents. Tables are written as Parquet between stages. Labels of held-out documents are not learned, as in the
single operators.

Defined results: null and empty texts are scored like any other and packed as their end mark alone; texts of any length are
read whole by every stage; repeated rows are scored alike, and near_dedup keeps one of them; ties do not matter to a decision, as each
is a threshold or a smallest doc_id; empty tables give empty tables (without labels nothing is rejected, without benchmark
nothing is dropped); extra columns of documents pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldlens.llm._common import materialize, read, scratch
from fieldlens.llm.decontaminate import drop_leaking
from fieldlens.llm.near_dedup import keep_one
from fieldlens.llm.packing import pack_documents
from fieldlens.llm.quality import keep_good
from fieldlens.llm.toxicity import keep_clean


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below the toxicity threshold; a null text is scored as an empty one, an empty table gives an empty one."""
    return keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that score as good; without labels all rows stay."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the smallest doc_id; texts without words stay, null doc_ids are kept where they stand alone, and repeated rows leave one."""
    return keep_one(docs, width=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item; an empty benchmark drops nothing."""
    return drop_leaking(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences; a null text is its end mark alone, and an empty table gives no sequence."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: Models are learned and tokens counted on the way, which SQL cannot express; tests hold near_dedup against brute force, and the other stages' operators against naive versions and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    with scratch() as free:
        for _, stage in STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir))
            free()  # the next stage needs this table alone
    return STAGES[-1][1](spark, docs, sf_dir)
