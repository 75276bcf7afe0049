"""All reports from one scan: states that add up, by every report's keys, and the reports made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import reports as r

#: What a state is kept by; keys that a site doesn't have are null.
GRAIN = ["site", "wp", "fraktion", "periode", "key"]


def states(facts: DataFrame) -> DataFrame:
    """Counts, sums of days and lateness by site and keys, in one pass and one shuffle.

    facts has a row a question: ka_nr, wp, fraktion, ministry, periode, days, late, beteiligte, and
    the lists members and topics.  A row is counted once for each of its keys at each site, at the
    finest grain that a report needs; coarser ones add states up.  Tasks add up before the shuffle,
    so what crosses it is as large as the reports.
    """

    def entry(site: str, key: Column | None = None, **more: str) -> Column:
        of = lambda name: (F.col(more[name]) if name in more else F.lit(None)).cast("date" if name == "periode" else "int" if name == "wp" else "string").alias(name)
        return F.struct(F.lit(site).alias("site"), of("wp"), of("fraktion"), of("periode"), (F.lit(None) if key is None else key).cast("string").alias("key"))

    single = F.array(
        entry("ministerien", F.col("ministry"), wp="wp"),
        entry("parteien", wp="wp", fraktion="fraktion"),
        entry("beteiligte", r.zero_floor(F.col("beteiligte")), wp="wp"),
        entry("monate", wp="wp", periode="periode"),
    )
    none = F.array().cast("array<string>")
    listed = [
        F.transform(F.coalesce("members", none), lambda m: entry("abgeordnete", m, wp="wp", fraktion="fraktion")),
        F.transform(F.coalesce("topics", none), lambda t: entry("sachgebiete", t, wp="wp", fraktion="fraktion", periode="periode")),
    ]
    rows = facts.select("ka_nr", "days", F.col("late").cast("int").alias("late"), F.explode(F.concat(single, *listed)).alias("e"))
    return rows.groupBy(*(F.col(f"e.{c}").alias(c) for c in GRAIN)).agg(
        F.count("*").alias("n"), F.sum("days").alias("days"), F.count("days").alias("timed"), F.coalesce(F.sum("late"), F.lit(0)).cast("long").alias("late"), F.min("ka_nr").alias("first")
    )


def block(rows: DataFrame, *keys: str) -> DataFrame:
    """The block of a report (A9) by keys, states added up."""
    summed = rows.groupBy(*keys).agg(F.sum("n").alias("anzahl"), F.round(F.sum("days") / F.sum("timed"), 6).alias("zeit"), F.sum("late").alias("verspaetet"))
    return r.punctual(summed)


def reports(kept: DataFrame, facts: DataFrame, extremes: int = 5, topics: int = 20) -> dict[str, DataFrame]:
    """Every report of the run (SNK-8), from states; the slowest and fastest rows alone from facts."""
    at = lambda site: kept.where(F.col("site") == site)
    ministries, members, subjects = at("ministerien"), at("abgeordnete"), at("sachgebiete")
    total = block(ministries, "wp").select("wp", F.lit(r.TOTAL_KEY).alias("key"), "anzahl", "zeit", "verspaetet", "quote")
    seen = members.groupBy("wp", "key").agg(r.first_seen("fraktion", "first").alias("fraktionen"))
    monthly, monthly_faction = block(subjects, "wp", "periode", "key"), block(subjects, "wp", "fraktion", "periode", "key")
    named = lambda df: df.withColumnRenamed("key", "topic")
    return {
        "ministerien": block(ministries, "wp", "key").unionByName(total),
        "parteien": block(at("parteien"), "wp", "fraktion"),
        "abgeordnete": block(members, "wp", "key").join(seen, ["wp", "key"]),
        "sachgebiete": r.reaggregate(named(monthly), "wp"),
        "sachgebiete_fraktion": r.top(r.reaggregate(named(monthly_faction), "wp", "fraktion"), topics, ["wp", "fraktion"]),
        "sachgebiete_zeitreihe": r.pivot_ranks(r.top(named(monthly_faction), 3, ["wp", "fraktion", "periode"]), 3, ["wp", "fraktion", "periode"]),
        "topthemen_zeitreihe": r.pivot_ranks(r.top(named(block(subjects, "periode", "key")), 5, ["periode"]), 5, ["periode"]),
        "topthemen": r.top_with_ties(named(subjects.groupBy("key").agg(F.sum("n").alias("n"))), topics, "n"),
        "beteiligte": block(at("beteiligte"), "wp", "key"),
        "zeitreihe": block(at("monate"), "periode"),
        "uebersicht": _long(block(at("monate"), "wp")),
        "extremwerte": r.extremes(facts.select("ka_nr", "wp", "ministry", "days"), extremes, "days", "ka_nr"),
    }


def _long(rows: DataFrame) -> DataFrame:
    measures = ["anzahl", "zeit", "verspaetet", "quote"]
    return rows.select("wp", *(F.col(c).cast("double").alias(c) for c in measures)).unpivot(["wp"], measures, "name", "wert")


def write(facts: DataFrame, folder: str) -> dict[str, str]:
    """Writes facts, states and each report below folder, split by term and faction where it has them.

    The source is scanned once, for facts; states are made from the written facts, reports from the
    written states, and a run that broke off is simply run again.
    """
    from ..sinks import save_report

    spark = facts.sparkSession
    facts.write.mode("overwrite").parquet(f"{folder}/_facts")
    facts = spark.read.parquet(f"{folder}/_facts")
    states(facts).write.mode("overwrite").parquet(f"{folder}/_states")
    kept = spark.read.parquet(f"{folder}/_states")
    written = {}
    for name, rows in reports(kept, facts).items():
        written[name] = f"{folder}/{name}"
        save_report(rows, written[name], *(c for c in ("wp", "fraktion") if c in rows.columns))
    return written
