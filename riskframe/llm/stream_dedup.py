"""Exact deduplication with a streaming keyed state on disk.

Arrivals (digest, id, place of the content) are streamed into an aggregation whose state
lies in RocksDB and never expires: per digest the number of rows and the largest
(id, arrival), with the place of that row's content.  Rows whose digest occurs more than
once are hits; their whole texts are compared, and a digest that stands for several texts
is decided by the texts themselves.

Cases: null and empty texts are equal; texts are equal when identical after lower-casing
A-Z only; of equal texts the row with the largest id stays, null ids last, and of repeated
rows with the same id the one read last; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import spread_join
from riskframe.llm.common import ascii_lower, shared_folder, texts, written
from riskframe.llm.membership import mark_likely

#: State on disk.  Without reserving space ahead, a partition takes the room of its rows alone.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Files of arrivals that one micro-batch takes.
FILES_PER_BATCH = 10_000


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def normal(text: Column) -> Column:
    return ascii_lower(text)


def _digested(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    rows = texts(docs).select("doc_id", normal(F.col("text")).alias("norm"))
    return rows.withColumn("digest", digest(F.col("norm")))


def arrivals(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One narrow row per document, kept in the shared folder: id, digest, arrival number and content place."""
    rows = _digested(docs, digest).select(
        "doc_id",
        "digest",
        F.monotonically_increasing_id().alias("arrival"),
        F.struct(F.input_file_name().alias("file"), F.octet_length("norm").alias("bytes")).alias("place"),
    )
    return written(rows, "arrivals")


def streamed_state(rows: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Run the stream over the arrivals and read its state: digest, keep_id, keep_arrival, place, n."""
    spark = rows.sparkSession
    (source,) = {f.rsplit("/", 1)[0] for f in rows.inputFiles()} or {None}
    if source is None:
        return spark.createDataFrame([], _STATE)
    saved = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    log = shared_folder(spark, "dedup-state")
    try:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        keyed = stream.groupBy("digest").agg(
            F.max(F.struct("doc_id", "arrival", "place")).alias("kept"), F.count(F.lit(1)).alias("n")
        )
        run = (
            keyed.writeStream.outputMode("update").format("noop").option("checkpointLocation", log)
            .trigger(availableNow=True).start()
        )
        run.awaitTermination()
        if run.exception():
            raise run.exception()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
    state = spark.read.format("statestore").load(log)
    kept, n = state.schema["value"].dataType.names
    return state.select(
        "key.digest",
        F.col(f"value.{kept}.doc_id").alias("keep_id"),
        F.col(f"value.{kept}.arrival").alias("keep_arrival"),
        F.col(f"value.{kept}.place").alias("place"),
        F.col(f"value.{n}").alias("n"),
    )


_STATE = "digest string, keep_id long, keep_arrival long, place struct<file:string,bytes:int>, n long"


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = arrivals(docs, digest)
    state = written(streamed_state(rows), "state")
    repeated = state.where(F.col("n") > 1).select("digest")
    collided = _collisions(docs, repeated, digest)
    joined = spread_join(rows.drop("place"), state.drop("place"), ["digest"], "inner", spread_by="arrival")
    decided = joined.select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("arrival") == F.col("keep_arrival")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    if collided is None:
        return decided
    return decided.join(collided.select(F.col("digest").alias("text_sha256")), "text_sha256", "left_anti").select(
        *decided.columns
    ).unionByName(_by_text(docs, collided, digest))


def _collisions(docs: DataFrame, repeated: DataFrame, digest) -> DataFrame | None:
    """Digests that stand for more than one text, after a look at every byte of the hits."""
    hits = mark_likely(_digested(docs, digest), F.col("digest"), repeated).where("_likely")
    spans = hits.groupBy("digest").agg(F.min("norm").alias("first"), F.max("norm").alias("last"))
    collided = written(spans.where(F.col("first") != F.col("last")).select("digest"), "collided")
    return None if collided.isEmpty() else collided


def _by_text(docs: DataFrame, collided: DataFrame, digest) -> DataFrame:
    """The same decision on whole texts, for the digests that cannot tell them apart."""
    rows = _digested(docs, digest).withColumn("arrival", F.monotonically_increasing_id())
    rows = written(rows.join(collided, "digest", "left_semi"), "collided-rows")
    groups = rows.groupBy("digest", "norm").agg(
        F.max(F.struct("doc_id", "arrival")).alias("last"), F.count(F.lit(1)).alias("group_size")
    )
    return rows.join(groups, ["digest", "norm"]).select(
        "doc_id",
        F.col("last.doc_id").alias("keep_id"),
        "group_size",
        (F.col("arrival") == F.col("last.arrival")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    Texts that occur once pass by without a shuffle; only rows that may be repeated are
    grouped, on (digest, text), so no two texts are taken for one.  The id is part of the
    join key, so copies of one text do not meet in one task.
    """
    rows = arrivals(docs)
    state = written(streamed_state(rows), "state")
    repeated = state.where(F.col("n") > 1)
    norm = normal(F.coalesce(F.col("text"), F.lit("")))
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), norm.alias("norm"))
    packed = packed.withColumn("digest", sha256(F.col("norm")))
    marked = mark_likely(packed, F.col("digest"), repeated.select("digest"))
    once = marked.where(~F.col("_likely")).select("doc.*")
    again = marked.where("_likely")
    last = again.groupBy("digest", "norm").agg(F.max("id").alias("keep"))
    last = last.select(F.col("digest").alias("its_digest"), F.col("norm").alias("its_norm"), "keep")
    same = (F.col("digest") == F.col("its_digest")) & (F.col("norm") == F.col("its_norm"))
    kept = again.join(last, same & F.col("id").eqNullSafe(F.col("keep"))).dropDuplicates(["digest", "norm"])
    return once.unionByName(kept.select("doc.*"))


ORACLE_SQL = """
with rows as (
  select row_number() over () as arrival, doc_id,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
  from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  row_number() over (partition by norm order by doc_id desc nulls last, arrival desc) = 1 as kept,
  sha256(norm) as text_sha256
from rows window w as (partition by norm)
"""
