"""Response-time reports: the aggregate block, totals, rankings, pivots and overviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What the grand total is called.
TOTAL_KEY, TOTAL_NAME = "LREG", "LANDESREGIERUNG GESAMT"


def block() -> list[Column]:
    """Number, mean response time, number late (A9); missing answers count as not late."""
    return [
        F.count("*").alias("anzahl"),
        F.round(F.avg("days"), 6).alias("zeit"),
        F.coalesce(F.sum(F.col("late").cast("int")), F.lit(0)).cast("long").alias("verspaetet"),
    ]


def punctual(df: DataFrame) -> DataFrame:
    """Adds the share on time in per cent."""
    return df.withColumn("quote", F.round(100 - F.col("verspaetet") / F.col("anzahl") * 100, 6))


def sla(df: DataFrame, *keys: str) -> DataFrame:
    """The block by keys."""
    return punctual(df.groupBy(*keys).agg(*block()))


def sla_with_total(df: DataFrame, key: str, within: str) -> DataFrame:
    """The block by (within, key) with a total row for each within, in one pass (A10)."""
    rows = df.groupingSets([[within, key], [within]], within, key).agg(F.grouping(key).alias("_total"), *block())
    return punctual(rows.withColumn(key, F.when(F.col("_total") == 1, F.lit(TOTAL_KEY)).otherwise(F.col(key)))).withColumn("name", F.when(F.col("_total") == 1, F.lit(TOTAL_NAME)).otherwise(F.col(key))).drop("_total")


def separate(df: DataFrame, column: str, out: str) -> DataFrame:
    """One row for each part of a '; ' list; parts are trimmed, empty ones dropped (FN-2, FN-3)."""
    parts = F.transform(F.split(column, r"\s*;\s*"), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " ")))
    return df.withColumn(out, F.explode(parts)).where(F.col(out) != "")


def first_seen(values: str, position: str) -> Column:
    """Distinct values by first position, joined by '/' (FN-22)."""
    ordered = F.transform(F.sort_array(F.collect_set(F.struct(F.col(position).alias("p"), F.col(values).alias("v")))), lambda x: x["v"])
    return F.array_join(F.array_distinct(ordered), "/")


def sla_of_members(df: DataFrame, *keys: str) -> DataFrame:
    """The block by keys, and the factions in order of each one's first question (A12), in one pass.

    States are kept by faction first, so what is collected is as small as the factions.
    """
    states = df.groupBy(*keys, "fraktion").agg(F.count("*").alias("n"), F.sum("days").alias("days"), F.count("days").alias("timed"), F.coalesce(F.sum(F.col("late").cast("int")), F.lit(0)).alias("late"), F.min("ka_nr").alias("first"))
    rows = states.groupBy(*keys).agg(F.sum("n").alias("anzahl"), F.round(F.sum("days") / F.sum("timed"), 6).alias("zeit"), F.sum("late").cast("long").alias("verspaetet"), first_seen("fraktion", "first").alias("fraktionen"))
    return punctual(rows)


def topics_by_period(df: DataFrame, *keys: str) -> DataFrame:
    """Exploded topics by period."""
    return sla(df, *keys, "periode", "topic")


def reaggregate(df: DataFrame, *keys: str) -> DataFrame:
    """Periods summed up; the mean is weighted by all rows, also those without a time."""
    rows = df.groupBy(*keys, "topic").agg(
        F.sum("anzahl").alias("n"),
        F.round(F.sum(F.col("zeit") * F.col("anzahl")) / F.sum("anzahl"), 4).alias("zeit"),
        F.sum("verspaetet").alias("verspaetet"),
    )
    return punctual(rows.withColumnRenamed("n", "anzahl"))


def top(df: DataFrame, n: int, keys: Sequence[str], by: str = "anzahl", tie: str = "topic") -> DataFrame:
    """The n first rows of each group by a count, ties in order (W1-W3); adds rank."""
    order = Window.partitionBy(*keys).orderBy(F.desc(by), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_with_ties(df: DataFrame, n: int, by: str) -> DataFrame:
    """All rows whose count is among the n greatest places.

    The bar is the n-th greatest count, found by a top-k, so the table is not sorted in one task.
    """
    bar = df.orderBy(F.desc(by)).limit(n).agg(F.min(by).alias("_bar"))
    return df.join(F.broadcast(bar), F.col(by) >= F.col("_bar")).drop("_bar")


def pivot_ranks(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """rank -> columns topic_k, anzahl_k, interleaved."""
    columns = []
    for k in range(1, n + 1):
        columns += [F.max(F.when(F.col("rank") == k, F.col(c))).alias(f"{c}_{k}") for c in ("topic", "anzahl")]
    return df.groupBy(*keys).agg(*columns)


def extremes(df: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    """The n slowest and the n fastest rows, as two top-k passes (W5, SET-2)."""
    known = df.where(F.col(by).isNotNull())
    slow = known.orderBy(F.desc(by), F.col(tie)).limit(n).withColumn("kind", F.lit("slowest"))
    fast = known.orderBy(F.col(by), F.col(tie)).limit(n).withColumn("kind", F.lit("fastest"))
    return slow.unionByName(fast)


def overview(df: DataFrame, *keys: str) -> DataFrame:
    """One row a measure: the block as (name, wert)."""
    rows = sla(df, *keys)
    measures = ["anzahl", "zeit", "verspaetet", "quote"]
    return rows.select(*keys, *(F.col(c).cast("double").alias(c) for c in measures)).unpivot(list(keys), measures, "name", "wert")


def zero_floor(column: Column) -> Column:
    """Numbers that aren't positive become 1; missing ones stay missing."""
    return F.when(column.isNull(), None).when(column > 0, column).otherwise(F.lit(1))
