"""Dates: German date texts, repair of letter dates, the working-day calendar and lateness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# German month names and their numbers.
MONTHS = {"Januar": 1, "Februar": 2, "März": 3, "April": 4, "Mai": 5, "Juni": 6, "Juli": 7, "August": 8, "September": 9, "Oktober": 10, "November": 11, "Dezember": 12}
# Holidays as (month, day), and as days after Easter Sunday.
FIXED_HOLIDAYS = [(1, 1), (5, 1), (10, 3), (11, 1), (12, 25), (12, 26)]
EASTER_HOLIDAYS = [-2, 1, 39, 50, 60]
#: Days of the answering period; the day of the question is the first.
PERIOD = 28
#: Years of the calendar: a fixed range, so its size is fixed as well.
FIRST_YEAR, LAST_YEAR = 1900, 2099


def iso(year: Column, month: Column, day: Column) -> Column:
    """yyyy-mm-dd from numbers or digit texts; no check that the day exists."""
    return F.concat_ws("-", F.lpad(year.cast("int").cast("string"), 4, "0"), F.lpad(month.cast("int").cast("string"), 2, "0"), F.lpad(day.cast("int").cast("string"), 2, "0"))


def part(text: Column, pattern: str, group: int) -> Column:
    """A regular expression's group, null where it is empty or absent."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def german_date(text: Column) -> Column:
    """'24. August 2022' or '28.09.2022' as an ISO text; '' if it is neither (D-1)."""
    t = F.trim(text)
    named = r"^(\d{1,2})\.\s*([A-Za-zÄÖÜäöüß]+)\s+(\d{4})$"
    digits = r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$"
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.try_element_at(months, part(t, named, 2))
    worded = F.when(month.isNotNull(), iso(part(t, named, 3), month, part(t, named, 1)))
    return F.when(text.isNull(), F.lit("")).otherwise(F.coalesce(worded, F.when(t.rlike(digits), iso(part(t, digits, 3), part(t, digits, 2), part(t, digits, 1))), F.lit("")))


def footer_date(text: Column, fallback_year: Column | None = None) -> Column:
    """'21.09.2022', '03 07.2025' or '1.2.25' as an ISO text; '' if out of range (D-2).

    A year outside 2000-2099 is replaced by the fallback year if that one is inside.
    """
    rx = r"^(\d{1,2})[. ]\s*(\d{1,2})[. ]\s*(\d{2,4})$"
    t = F.trim(text)
    day, month, written = (part(t, rx, i).cast("int") for i in (1, 2, 3))
    year = F.when(written < 100, written + 2000).otherwise(written)
    if fallback_year is not None:
        year = F.when(~year.between(2000, 2099) & fallback_year.between(2000, 2099), fallback_year).otherwise(year)
    fine = month.between(1, 12) & day.between(1, 31) & year.between(2000, 2099)
    return F.coalesce(F.when(fine, iso(year, month, day)), F.lit(""))


def as_date(text: Column) -> Column:
    """The date of an ISO text; null if there is no such day."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def days(later: Column, earlier: Column) -> Column:
    """later - earlier in days; null if either text is no date (D-4)."""
    return F.datediff(as_date(later), as_date(earlier))


def year_of(text: Column) -> Column:
    """The year that an ISO text begins with (D-5)."""
    return part(text, r"^(\d{4})-", 1).cast("int")


def years_apart(gap: Column) -> Column:
    """About how many years a number of days is (D-14)."""
    return F.bround(F.abs(gap) / 365, 0).cast("int")


def heal_year(original: Column, issued: Column) -> Column:
    """Adds a year to a letter date that lies over 60 days before the issue, if that fits (D-12)."""
    a, b = as_date(original), as_date(issued)
    moved = F.when(~((F.month(a) == 2) & (F.dayofmonth(a) == 29)), F.add_months(a, 12))
    fits = (F.datediff(b, a) > 60) & F.datediff(b, moved).between(0, 60)
    return F.when(F.coalesce(fits, F.lit(False)), F.date_format(moved, "yyyy-MM-dd")).otherwise(original)


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar, by Oudin's integer method (D-8)."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    c = div(year, 100)
    n = year % 19
    moon = (c - div(c, 4) - div(c - div(c - 17, 25), 3) + 19 * n + 15) % 30
    late = F.when((moon == 29) | ((moon == 28) & (n > 10)), moon - 1).otherwise(moon)
    weekday = (year + div(year, 4) + late + 2 - c + div(c, 4)) % 7
    after = late - weekday  # days from 28 March
    return F.date_add(F.make_date(year, F.lit(3), F.lit(28)), after)


def holiday(day: Column, sunday: Column) -> Column:
    """Whether the day is a public holiday of the state, by the Easter Sunday of its year (D-9)."""
    fixed = (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in FIXED_HOLIDAYS])
    return fixed | F.datediff(day, sunday).isin(EASTER_HOLIDAYS)


def calendar(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """day, free (holiday or weekend, D-10), workday (the first working day from it on).

    No more than four free days follow each other in these years.  The days looked ahead may lie in
    the next year, whose holidays so early are fixed dates, so one Easter Sunday a year will do.
    """
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    years = years.select("year", easter(F.col("year")).alias("sunday"))
    one, twelve = F.lit(1), F.lit(12)
    days_ = years.select("sunday", F.explode(F.sequence(F.make_date("year", one, one), F.make_date("year", twelve, F.lit(31)))).alias("day"))

    def free(day: Column) -> Column:
        return holiday(day, F.col("sunday")) | (F.weekday(day) >= 5)

    ahead = [F.date_add("day", n) for n in range(6)]
    return days_.select("day", free(F.col("day")).alias("free"), F.coalesce(*(F.when(~free(d), d) for d in ahead)).alias("workday"))


def with_lateness(df: DataFrame, asked: str = "question_date", answered: str = "answer_date") -> DataFrame:
    """Adds deadline and late: later than the working day on or after asked + 27 days (D-11).

    The calendar holds a fixed number of days, so it is broadcast; a missing answer isn't late but
    null, as is a day outside the calendar.
    """
    days_ = F.broadcast(calendar(df.sparkSession).select(F.col("day").alias("_day"), F.col("workday").alias("deadline")))
    joined = df.join(days_, F.date_add(F.col(asked), PERIOD - 1) == F.col("_day"), "left").drop("_day")
    return joined.withColumn("late", F.col(answered) > F.col("deadline"))
