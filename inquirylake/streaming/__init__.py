"""Incremental runs: an upsert of each micro-batch into a table in versions."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import keep_last
from ..operators.keyed import upsert
from . import versions


def scratch(spark: SparkSession) -> str:
    """A new folder for what a run writes in between, where all machines of a cluster reach it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="inquirylake-")
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written to a new folder and read back, so that a costly plan that several steps read runs once."""
    folder = scratch(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def latest(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, int]:
    """The last version of a table and its number; an empty table before the first."""
    return versions.read(spark, path, schema), versions.head(spark, path)[0]


def identity(spark: SparkSession, checkpoint: str) -> str:
    """The name that a stream's checkpoint gives it."""
    return spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id").alias("id")).first()["id"]


def now() -> Column:
    """The time in UTC, to the second (D-3)."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")


def stream_upserts(source: DataFrame, path: str, checkpoint: str, schema: str, key: str, mask: Sequence[str], position: str, width: int = versions.WIDTH, once: Sequence[str] = (), beside: Sequence[str] = ()) -> StreamingQuery:
    """Upserts a stream of new rows into a table in versions; each batch commits one.

    Any number of streams may write one table: a batch that another one overtakes is applied to the
    new version, and one that is run again after a failure finds itself committed.  Only the key
    ranges that a batch touches are rewritten.  Within a batch the last row of each key counts; once
    and beside are those of upsert.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col(key).isNotNull() & (F.col(key) != ""))
        new = keep_last(rows, position, key, *beside).persist()
        try:
            if not new.isEmpty():
                versions.change(new, path, schema, key, lambda stored: upsert(stored, new, key, mask, now(), once, beside), (identity(spark, checkpoint), number), width)
        finally:
            new.unpersist()

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
