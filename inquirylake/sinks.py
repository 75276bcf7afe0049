"""Writers: versioned tables, snapshots, audit logs, bucketed texts and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.text import bucket, paper

# Columns of the snapshot that only discovery writes, in order.
SNAPSHOT = ["wp", "kleine_anfrage_nr", "drucksache_anfrage_nr", "drucksache_antwort_nr", "anfrager", "fraktion", "anfragedatum", "anfragetitel", "antwortdatum", "systematik", "schlagworte", "link_drucksache_anfrage", "link_drucksache_antwort", "ministerium_kuerzel", "antworttext_status", "hinzugefuegt_am", "aktualisiert_am"]


def save_version(df: DataFrame, path: str, version: int, key: str) -> str:
    """Writes a table as a new version, range-partitioned and sorted by key (SNK-1).

    A version is a folder of its own that readers see only when its _SUCCESS mark is there, so
    no lock is needed and an interrupted write is simply written again.
    """
    p = paper(F.col(key))
    target = f"{path}/version={version:08d}"
    df.withColumns({"_wp": F.coalesce(p["wp"], F.lit(2**31 - 1)), "_n": F.coalesce(p["n"], F.lit(2**31 - 1))}).repartitionByRange("_wp", "_n").sortWithinPartitions("_wp", "_n").drop("_wp", "_n").write.mode("overwrite").parquet(target)
    return target


def save_snapshot(df: DataFrame, path: str, columns: Sequence[str] = SNAPSHOT) -> None:
    """Writes the snapshot's columns that the table has (SNK-2)."""
    df.select(*[c for c in columns if c in df.columns]).write.mode("overwrite").parquet(path)


def append_audit(df: DataFrame, path: str, run_at: Column) -> None:
    """Appends structured audit rows; a log line is a view of them (SNK-3)."""
    df.withColumn("run_at", run_at).write.mode("append").parquet(path)


def save_texts(df: DataFrame, path: str, number: str, text: str = "text") -> None:
    """Writes texts below their archive bucket (SNK-4)."""
    df.select(bucket(F.col(number)).alias("bucket"), F.col(number), F.col(text)).write.mode("overwrite").partitionBy("bucket").parquet(path)


def save_report(df: DataFrame, path: str, *split: str) -> None:
    """Writes a report as CSV with a header, one folder for each value of the split columns (SNK-6, SNK-8, SNK-10)."""
    writer = df.write.mode("overwrite").option("header", True)
    (writer.partitionBy(*split) if split else writer).csv(path)
