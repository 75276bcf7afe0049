"""Domain views over generic order tables, so that every operator has real input at any scale."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task, where much is computed for each row.
COSTLY = 100_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A table that is scanned by fewer tasks than there are cores, dealt over all of them.

    For plans that compute much for each row.  With the number of rows, a table is dealt over tasks of
    COSTLY rows, so their number grows with it and the time and memory of one don't.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        return df.repartition(max(cores, -(-rows // COSTLY)))
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def inquiries(spark: SparkSession, sf_dir: str, costly: bool = False) -> DataFrame:
    """One row per order as a question: keys, dates, status, faction and ministry.

    costly tells that much is computed for each row.
    """
    o, c, n = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    key = F.col("o_orderkey")
    wp = (key % 2 + 17).cast("int")
    asked = F.add_months(F.col("o_orderdate").cast("date"), 252)
    nations = F.broadcast(n.select("n_nationkey", "n_name"))  # a table of countries
    out = (
        o.join(c.select("c_custkey", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias("ka_nr"),
            wp.alias("wp"),
            F.concat_ws("/", wp, key + 1).alias("q_nr"),
            F.concat_ws("/", wp, key + 100001).alias("a_nr"),
            asked.alias("question_date"),
            F.when(key % 97 != 0, F.date_add(asked, (key * 37 % 61).cast("int"))).alias("answer_date"),
            F.when(F.col("o_orderstatus") == "P", "pending").otherwise("extracted").alias("status"),
            F.col("c_mktsegment").alias("fraktion"),
            F.col("n_name").alias("ministry"),
        )
    )
    return spread(out, o.count()) if costly else out  # the files' own counts: no scan


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """inquiries with pk: the answer's number, or the question's while no line item answers it."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ka_nr")).distinct().withColumn("_has", F.lit(True))
    rows = inquiries(spark, sf_dir).join(lines, "ka_nr", "left")
    return rows.withColumn("pk", F.when(F.col("_has"), F.col("a_nr")).otherwise(F.col("q_nr"))).drop("_has")


def base(spark: SparkSession, sf_dir: str, cutoff: str = "2026-03-24") -> DataFrame:
    """The report's rows (P8) with period, response days and lateness."""
    from .functions.dates import with_lateness

    rows = inquiries(spark, sf_dir).where(~F.col("status").rlike("pending|anfrage_zurueckgezogen|abbruch") & (F.col("question_date") <= F.lit(cutoff).cast("date")))
    rows = rows.withColumns({"periode": F.trunc("question_date", "month"), "days": F.datediff("answer_date", "question_date").cast("double")})
    return with_lateness(rows)


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ka_nr, topics: the names of an order's parts, in order, joined by '; '."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy(F.col("l_orderkey").alias("ka_nr")).agg(F.array_join(F.array_sort(F.collect_list("p_name")), "; ").alias("topics"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ka_nr, members, n_members: the distinct suppliers of an order, in order, joined by '; '."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    names = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = lines.join(names, F.col("l_suppkey") == F.col("s_suppkey"))
    grouped = rows.groupBy(F.col("l_orderkey").alias("ka_nr")).agg(F.array_sort(F.collect_set("s_name")).alias("m"))
    return grouped.select("ka_nr", F.array_join("m", "; ").alias("members"), F.size("m").alias("n_members"))
