"""Dates: rendered in one form and recovered, and the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter
from ..functions import dates as d
from .common import CALENDAR, INQUIRIES
from .registry import registry

QUERIES, SQL, query = registry()


@query("d1_german_date", f"WITH {INQUIRIES} SELECT ka_nr, strftime(question_date, '%Y-%m-%d') AS worded, strftime(question_date, '%Y-%m-%d') AS digits, '' AS broken FROM inq")
def d1(spark, sf_dir):
    names = F.array(*map(F.lit, d.MONTHS))
    q = F.col("question_date")
    worded = F.concat(F.dayofmonth(q), F.lit(". "), F.element_at(names, F.month(q)), F.lit(" "), F.year(q))
    broken = F.concat(F.dayofmonth(q), F.lit(". Foo "), F.year(q))
    return adapter.inquiries(spark, sf_dir).select("ka_nr", d.german_date(worded).alias("worded"), d.german_date(F.date_format(q, "d.M.yyyy")).alias("digits"), d.german_date(broken).alias("broken"))


@query("d2_footer_date", f"""WITH {INQUIRIES} SELECT ka_nr, CASE WHEN ka_nr % 5 = 4 THEN '' ELSE strftime(question_date, '%Y-%m-%d') END AS iso FROM inq""")
def d2(spark, sf_dir):
    q, k = F.col("question_date"), F.col("ka_nr") % 5
    text = (
        F.when(k == 0, F.date_format(q, "dd.MM.yyyy"))
        .when(k == 1, F.date_format(q, "dd MM.yyyy"))
        .when(k == 2, F.date_format(q, "d.M.yy"))
        .when(k == 3, F.concat(F.date_format(q, "dd.MM."), F.lit("0205")))
        .otherwise(F.concat(F.lit("32.13."), F.year(q)))
    )
    return adapter.inquiries(spark, sf_dir).select("ka_nr", d.footer_date(text, F.year(q)).alias("iso"))


@query("d8_easter", f"WITH {INQUIRIES}, {CALENDAR} SELECT ka_nr, CAST(easter AS DATE) AS easter, CAST(question_date - easter AS INTEGER) AS days_after FROM inq JOIN f ON day = question_date")
def d8(spark, sf_dir):
    """Easter Sunday of each question's year."""
    rows = adapter.inquiries(spark, sf_dir).withColumn("easter", d.easter(F.year("question_date")))
    return rows.select("ka_nr", "easter", F.datediff("question_date", "easter").alias("days_after"))


@query("d9_calendar", f"WITH {INQUIRIES}, {CALENDAR} SELECT ka_nr, free, CAST(workday AS DATE) AS workday FROM inq JOIN cal ON day = question_date")
def d9(spark, sf_dir):
    """Whether each question came on a free day, and the first working day from then on."""
    days = F.broadcast(d.calendar(spark).withColumnRenamed("day", "question_date"))  # a fixed number of days
    return adapter.inquiries(spark, sf_dir).join(days, "question_date").select("ka_nr", "free", "workday")


@query("d11_lateness", f"WITH {INQUIRIES}, {CALENDAR} SELECT ka_nr, CAST(workday AS DATE) AS deadline, answer_date > workday AS late FROM inq LEFT JOIN cal ON day = question_date + 27")
def d11(spark, sf_dir):
    return d.with_lateness(adapter.inquiries(spark, sf_dir)).select("ka_nr", "deadline", "late")


@query("d12_year_heal", f"WITH {INQUIRIES} SELECT ka_nr, strftime(CASE WHEN ka_nr % 2 = 0 AND month(question_date) = 2 AND day(question_date) = 29 THEN question_date - 1 ELSE question_date END, '%Y-%m-%d') AS original FROM inq")
def d12(spark, sf_dir):
    """Letters whose year is one too small are healed by the issue date a few days later.

    A 29 February has no such day the year before; its letter says the 28th, and keeps to it.
    """
    q = F.col("question_date")
    rows = adapter.inquiries(spark, sf_dir)
    written = F.when(F.col("ka_nr") % 2 == 0, F.add_months(q, -12)).otherwise(q)
    issued = F.date_add(q, (F.col("ka_nr") % 20).cast("int"))
    return rows.select("ka_nr", d.heal_year(F.date_format(written, "yyyy-MM-dd"), F.date_format(issued, "yyyy-MM-dd")).alias("original"))
