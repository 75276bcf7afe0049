"""Helpers that the operators share: Arrow workers, cut lineage, reading tables."""

from __future__ import annotations

import ctypes
import gc
import os
import pickle
import tempfile
from collections.abc import Callable, Iterator
from importlib import import_module

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows and bytes of an Arrow batch; long texts make the bytes the limit that counts.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, so that long texts don't fill a worker."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame, release: bool = False) -> DataFrame:
    """Cut lineage through the shared folder of ``spark.checkpoint.dir``.

    The session's setting wins.  Where none is set, a local master takes a temporary folder, as its
    executor is the driver; on a cluster the folder lies in the warehouse, if that is in a store that
    all machines share, and else there is an error.  With release the shuffle files of earlier, finished steps go first.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and (context.master == "local" or context.master.startswith("local[")):
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if not folder and (":" not in warehouse or warehouse.startswith("file:")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(folder or f"{warehouse}/_checkpoints")
    if release:
        drop_shuffles(spark)
    return df.checkpoint(eager=True)


def drop_shuffles(spark: SparkSession) -> None:
    """Executors drop shuffle files when the driver collects what refers to them: now, not some time later.

    The last query stays referred to until another one has run, so an empty one runs first; and what
    Python has given up waits in a queue for up to a second, which is emptied here.
    """
    gc.collect()
    spark.range(0).count()
    given_up = getattr(spark._jvm._gateway_client, "finalizer_deque", None)
    while given_up:
        try:
            task = given_up.pop()
        except IndexError:  # the queue's own worker was faster
            break
        if not isinstance(task, tuple):  # the mark that tells the worker to end
            given_up.append(task)
            break
        task[0].garbage_collect_object(task[1], False)
    spark._jvm.System.gc()


def arrow_map(df: DataFrame, function: Callable, schema: str | StructType, *args) -> DataFrame:
    """``mapInArrow`` with a module's function, found by name so that workers keep its caches."""
    module, name, root, packed = function.__module__, function.__qualname__, ROOT, pickle.dumps(args)

    def run(batches):
        import pickle
        import sys
        from importlib import import_module

        if root not in sys.path:
            sys.path.append(root)
        try:
            yield from getattr(import_module(module), name)(batches, *pickle.loads(packed))
        finally:
            import_module("inquirylake.llm.common").release()

    return df.mapInArrow(run, schema)


def arrow_groups(df: DataFrame, keys: list, function: Callable, schema: str, *args) -> DataFrame:
    """``applyInArrow`` over groups, with a module's function found by name."""
    module, name, root, packed = function.__module__, function.__qualname__, ROOT, pickle.dumps(args)

    def run(group):
        import pickle
        import sys
        from importlib import import_module

        if root not in sys.path:
            sys.path.append(root)
        out = getattr(import_module(module), name)(group, *pickle.loads(packed))
        if group.nbytes > 1 << 20:
            import_module("inquirylake.llm.common").release()
        return out

    return df.groupBy(*keys).applyInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str], module: str, name: str, args: tuple) -> Iterator[pa.RecordBatch]:
    """Calls a function for each group of rows that come ordered by keys; a group is held whole."""
    function, held, last = getattr(import_module(module), name), [], None

    def out() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        yield from function(rows, *args).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch[key]) for key in keys]
        new = np.zeros(batch.num_rows, bool)
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
        first = tuple(column[0] for column in columns)
        new[0] = bool(held) and first != last
        at = 0
        for cut in np.flatnonzero(new).tolist():
            if cut > at:
                held.append(batch.slice(at, cut - at))
            yield from out()
            held, at = [], cut
        held.append(batch.slice(at))
        last = tuple(column[-1] for column in columns)
    if held:
        yield from out()


def dealt_groups(df: DataFrame, keys: list[str], slot: Column, function: Callable, schema: str, *args) -> DataFrame:
    """As arrow_groups, but groups go to the tasks that slot numbers, so that a few large groups don't meet in one."""
    tasks = partitions(df.sparkSession)
    dealt = df.repartitionById(tasks, F.pmod(slot, F.lit(tasks)).cast("int")).sortWithinPartitions(*keys)
    return arrow_map(dealt, _groups, schema, keys, function.__module__, function.__qualname__, args)


def release() -> None:
    """Give freed memory back to the system, as workers live on and share a machine's memory."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


try:
    _LIBC = ctypes.CDLL("libc.so.6")
    _LIBC.malloc_trim
except (OSError, AttributeError):  # another C library
    _LIBC = None


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    compress = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        bodies = [compress((text or "").encode()) for text in batch["text"].to_pylist()]
        names = [name if name != "text" else "body" for name in batch.schema.names]
        yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary()) if name == "body" else batch[name] for name in names], names)


def packed(df: DataFrame) -> DataFrame:
    """Column text as compressed body: what texts take in a shuffle falls by more than a third."""
    fields = [StructField("body", BinaryType()) if field.name == "text" else field for field in df.schema]
    return arrow_map(df, _pack, StructType(fields))


def bodies(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of column body, as UTF-8."""
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(body) for body in column.to_pylist()]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of a key from which it may be hot, and keys that may be hot at once.
HOT, MOST_HOT = 512, 4096


def split_join(rows: DataFrame, other: DataFrame, key: list[str], weights: DataFrame) -> DataFrame:
    """rows joined with other on key, where a key of rows that is hot is dealt over several tasks.

    weights holds key and n, about how many rows have it.  Hot is a key with more than a quarter of a
    task's share; as those are at most MOST_HOT, they may be broadcast.  Only their rows in other
    are repeated, once for each such share, so other should have few rows a key.
    """
    spark = rows.sparkSession
    tasks = partitions(spark)
    total = weights.agg(F.sum("n")).first()[0] or 0
    least = max(HOT, total // min(4 * tasks, MOST_HOT))
    salts = F.least(F.lit(tasks), F.ceil(F.col("n") / least)).cast("int")
    hot = weights.where(F.col("n") > least).select(*key, salts.alias("salts_")).limit(MOST_HOT)
    found = hot.collect()
    if not found:
        return rows.join(other, key)
    hot = F.broadcast(spark.createDataFrame(found, hot.schema).groupBy(*key).agg(F.max("salts_").alias("salts_")))
    dealt = rows.join(hot, key, "left").withColumn("salt_", F.coalesce(F.pmod(F.xxhash64(*rows.columns), F.col("salts_")), F.lit(0)).cast("int")).drop("salts_")
    each = F.sequence(F.lit(0), F.coalesce("salts_", F.lit(1)) - 1)
    copies = other.join(hot, key, "left").withColumn("salt_", F.explode(each)).drop("salts_")
    return dealt.join(copies, [*key, "salt_"]).drop("salt_")


def with_text(docs: DataFrame) -> DataFrame:
    """doc_id and text (null: empty), whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
