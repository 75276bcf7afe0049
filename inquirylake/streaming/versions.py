"""Tables in versions: several writers commit without losing a change, and rewrite only the key ranges it falls into.

A version is one small file, _commits/N.json, that names the folder of each key range and the last
batch of each stream.  Its number is claimed by creating that file, whole and only if nobody has; a
writer that comes second reads the new version and makes its change again.  Folders are written
before, under names of their own, so a writer that dies leaves nothing that readers see.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bucket, paper

#: Numbers of a key range, and what keys that are no papers fall into.
WIDTH, OTHER = 2000, "other"


def key_range(key: Column, width: int = WIDTH) -> Column:
    """The range of a paper, '18_1-2000'."""
    p = paper(key)
    return F.when(p["n"].isNotNull() & p["wp"].isNotNull(), F.concat_ws("_", p["wp"], bucket(p["n"], width))).otherwise(OTHER)


def _paths(spark: SparkSession, path: str) -> tuple:
    fs = spark._jvm.org.apache.hadoop.fs
    root = fs.Path(path)
    return fs, root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, root, files = _paths(spark, path)
    commits = fs.Path(root, "_commits")
    if not files.exists(commits):
        return []
    names = [s.getPath().getName() for s in files.listStatus(commits)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _entry(spark: SparkSession, path: str, number: int) -> dict:
    fs, root, files = _paths(spark, path)
    stream = files.open(fs.Path(root, f"_commits/{number:08d}.json"))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def head(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The last version's number, -1 before the first, and its entry."""
    numbers = _numbers(spark, path)
    return (numbers[-1], _entry(spark, path, numbers[-1])) if numbers else (-1, {"ranges": {}, "streams": {}})


def _claim(spark: SparkSession, path: str, number: int, entry: dict) -> bool:
    """Creates a version's file with its whole content, unless it is there already.

    The content is written under another name first.  A store's rename fails if the new name is
    taken; a local folder's would overwrite, so there the new name is a link, which can't.
    """
    fs, root, files = _paths(spark, path)
    target, draft = fs.Path(root, f"_commits/{number:08d}.json"), fs.Path(root, f"_commits/.{uuid.uuid4().hex}.draft")
    files.mkdirs(target.getParent())
    if files.exists(target):
        return False
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    stream.close()
    try:
        where = files.resolvePath(draft)
        if where.toUri().getScheme() != "file":
            return bool(files.rename(draft, target))
        try:
            os.link(where.toUri().getPath(), f"{files.resolvePath(target.getParent()).toUri().getPath()}/{target.getName()}")
        except FileExistsError:
            return False
        return True
    finally:
        if files.exists(draft):
            files.delete(draft, False)


def _write(df: DataFrame, path: str, key: str, width: int) -> dict[str, str]:
    """Writes rows below a folder of their own, sorted by key within each range; the ranges' folders.

    A range has at most width numbers, so it is one task's; what is no paper is dealt over several.
    Partitions are by hash: finding bounds for sorted ones would run the plan twice.
    """
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    p = paper(F.col(key))
    rows = df.withColumns({"range_of_key": key_range(F.col(key), width), "number_of_key": F.coalesce(p["n"], F.lit(2**31 - 1))})
    deal = F.when(F.col("range_of_key") == OTHER, F.pmod(F.xxhash64(key), F.lit(64))).otherwise(0)
    rows.repartition("range_of_key", deal).sortWithinPartitions("range_of_key", "number_of_key", key).drop("number_of_key").write.partitionBy("range_of_key").parquet(f"{path}/{folder}")
    fs, root, files = _paths(spark, path)
    made = [s.getPath().getName() for s in files.listStatus(fs.Path(root, folder))]
    return {name.partition("=")[2]: f"{folder}/{name}" for name in made if name.startswith("range_of_key=")}


def _drop(spark: SparkSession, path: str, folders: Iterable[str]) -> None:
    fs, root, files = _paths(spark, path)
    for folder in {f.rpartition("/")[0] for f in folders}:
        files.delete(fs.Path(root, folder), True)


def read(spark: SparkSession, path: str, schema: str | None = None, ranges: Iterable[str] | None = None, number: int | None = None) -> DataFrame:
    """A version's rows (the last one's), or those of some ranges; a schema makes an empty table readable."""
    entry = head(spark, path)[1] if number is None else _entry(spark, path, number)
    chosen = [f"{path}/{folder}" for name, folder in sorted(entry["ranges"].items()) if ranges is None or name in set(ranges)]
    if chosen:
        return (spark.read.schema(schema) if schema else spark.read).parquet(*chosen)
    return spark.createDataFrame([], schema or "key string")


def load(spark: SparkSession, path: str) -> DataFrame:
    """A table in versions, or one without."""
    return read(spark, path) if _numbers(spark, path) else spark.read.parquet(path)


def replace(df: DataFrame, path: str, key: str, width: int = WIDTH) -> int:
    """Writes a whole table as the next version; the number it got."""
    spark = df.sparkSession
    ranges = _write(df, path, key, width)
    while True:
        number, entry = head(spark, path)
        if _claim(spark, path, number + 1, {"ranges": ranges, "streams": entry["streams"]}):
            return number + 1


def change(rows: DataFrame, path: str, schema: str, key: str, apply: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None, width: int = WIDTH) -> int:
    """Commits apply(stored rows) for the key ranges that rows fall into; the number of the version.

    apply gets what is stored in those ranges and gives what is to be stored there; ranges that rows
    don't touch keep their files.  batch names a stream and its batch: one that is in the table
    already is left out, so a run that is repeated changes nothing.  Should another writer commit
    first, its version is read and the change made again.
    """
    spark = rows.sparkSession
    touched = [r["range"] for r in rows.select(key_range(F.col(key), width).alias("range")).distinct().collect()]  # as many as the table has ranges at most
    while True:
        number, entry = head(spark, path)
        if batch and entry["streams"].get(batch[0], -1) >= batch[1]:
            return number
        written = _write(apply(read(spark, path, schema, touched)), path, key, width)
        ranges = {r: f for r, f in entry["ranges"].items() if r not in touched} | written
        streams = entry["streams"] | ({batch[0]: batch[1]} if batch else {})
        if _claim(spark, path, number + 1, {"ranges": ranges, "streams": streams}):
            return number + 1
        _drop(spark, path, written.values())


def expire(spark: SparkSession, path: str, keep: int = 10, idle_hours: float = 24.0) -> int:
    """Removes older versions, and folders no kept version names that nobody has written to of late."""
    fs, root, files = _paths(spark, path)
    numbers = _numbers(spark, path)
    used = {folder.split("/")[1] for n in numbers[-keep:] for folder in _entry(spark, path, n)["ranges"].values()}
    for n in numbers[:-keep]:
        files.delete(fs.Path(root, f"_commits/{n:08d}.json"), False)
    data, removed = fs.Path(root, "data"), 0
    for status in files.listStatus(data) if files.exists(data) else []:
        if status.getPath().getName() not in used and status.getModificationTime() <= (time.time() - idle_hours * 3600) * 1000:
            removed += files.delete(status.getPath(), True)
    return removed
