"""Which row a question is, as keyed state: placeholders move to late answers, withdrawn questions stay so."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import by_question, filled
from . import identity, now, versions

#: Hits and what a table held, as the stream reads both; told marks hits.
HIT = "q_nr string, pk string, withdrawn boolean, at long, told boolean"
SCHEMA = "pk string, q_nr string, status string, added_at string, updated_at string"
WITHDRAWN = "anfrage_zurueckgezogen"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _status(withdrawn: Column) -> Column:
    return F.when(withdrawn, WITHDRAWN).otherwise("pending")


def _known(rows: DataFrame) -> DataFrame:
    """One state a question number; the latest answer counts (ties: the greater one), in whatever order hits come."""
    pk = filled(F.col("pk"))
    answer = F.when(pk != F.col("q_nr"), F.struct("at", pk.alias("pk")))
    known = rows.groupBy("q_nr").agg(F.max(answer).alias("answer"), F.coalesce(F.bool_or("withdrawn"), F.lit(False)).alias("withdrawn"), F.bool_or("told").alias("told"))
    return known.select("q_nr", F.coalesce("answer.pk", "q_nr").alias("pk"), _status(F.col("withdrawn")).alias("status"), "told")


def _start(spark: SparkSession, initial: DataFrame | None, folder: str) -> DataFrame:
    """What the table held before the stream began, older than any hit, as a source that the first batch reads whole.

    It is written beside the checkpoint once, so a restart finds the same source and nothing new in it.
    """
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        rows = spark.createDataFrame([], HIT) if initial is None else initial.select("q_nr", "pk", (F.col("status") == WITHDRAWN).alias("withdrawn"), F.lit(-1).cast("long").alias("at"), F.lit(False).alias("told"))
        rows.write.mode("overwrite").parquet(folder)
    return spark.readStream.schema(HIT).parquet(folder)


@contextmanager
def _rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start in this block keep their state in RocksDB, so it may be larger than memory."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _written(rows: DataFrame, folder: str) -> DataFrame:
    """The rows from a folder, so that the state is gone through once, however often they are read."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _changed(told: DataFrame, table: str, width: int) -> DataFrame:
    """Those questions of which the table holds anything but the one row that is known now.

    Files are far smaller than their rows, so the planner isn't left to broadcast what is held.
    """
    spark = told.sparkSession
    keys = told.select("pk").unionByName(told.select(F.col("q_nr").alias("pk")))
    near = [r["range"] for r in keys.select(versions.key_range(F.col("pk"), width).alias("range")).distinct().collect()]  # as many as the table has ranges at most
    row = F.struct("pk", "status")
    held = versions.read(spark, table, SCHEMA, near).groupBy("q_nr").agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
    same = row.eqNullSafe(F.col("_low")) & row.eqNullSafe(F.col("_high"))
    return told.join(held.hint("merge"), "q_nr", "left").where(~same).select(*told.columns)


def stream_identities(hits: DataFrame, table: str, checkpoint: str, initial: DataFrame | None = None, width: int = versions.WIDTH) -> StreamingQuery:
    """Keeps a table in versions with one row a question (STR-3), keyed by its answer, or by itself while there is none.

    hits has q_nr, pk (null without an answer), withdrawn and at; initial is what the table holds
    (pk, q_nr, status) when the first run starts.  Only questions that changed are written; the state
    survives a restart with the checkpoint, and a repeated batch finds itself committed.
    """
    spark = hits.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = f"{checkpoint}/told/{uuid.uuid4().hex}"
        try:
            told = _written(batch.where("told").drop("told"), f"{folder}/all")
            new = _written(_changed(told, table, width), f"{folder}/new")
            if new.isEmpty():
                return
            # a question's placeholder goes when its answer is known
            keys = new.select("pk").unionByName(new.select(F.col("q_nr").alias("pk"))).distinct()

            def moved(stored: DataFrame) -> DataFrame:
                answered = new.where("pk <> q_nr").select("q_nr", F.col("pk").alias("_new"))
                kept = stored.join(answered.hint("merge"), "q_nr", "left").where("_new is null or pk = _new")
                return by_question(kept.select(*stored.columns), new, ["q_nr", "status"], now())

            versions.change(keys, table, SCHEMA, "pk", moved, (identity(spark, checkpoint), number), width)
        finally:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    rows = hits.select("q_nr", "pk", "withdrawn", F.col("at").cast("long").alias("at"), F.lit(True).alias("told"))
    known = _known(rows.unionByName(_start(spark, initial, f"{checkpoint}/initial")))
    with _rocksdb(spark):
        return known.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
