"""Corpus pipeline: toxic documents go, copies and near copies go, benchmark passages go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.  All but the last return
the columns of ``documents``.  Between stages the documents are a Parquet table in the
folder that all executors share, so a lost executor costs at most the running stage.

Cases: stages treat null texts as empty; empty tables pass through as empty tables; further columns
of the input are kept up to packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import decontam, near_copies, packing, simhash_gph, stream_dedup, toxicity_gru
from riskframe.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity_gru.reject_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stream_dedup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of op4's fingerprint links, then one of each component of similar shingle sets.

    Most edited copies lie further apart than op4's radius; the sets find those.
    """
    return near_copies.keep_one(written(simhash_gph.keep_one(docs), "fingerprint-dedup"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, added=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
