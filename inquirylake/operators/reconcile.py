"""Reconciling dates of several sources, cross checks, the merge verdict and its classifier."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.dates import as_date, days, year_of, years_apart
from ..functions.text import FACTIONS, dedouble, trimmed_parts

# Years that a date may have, days that a stored date may lie before and after a
# document's, days of the narrow corridor, and tags of rows corrected by hand.
YEARS, BEFORE, AFTER, NARROW = (2015, 2030), -14, 122, 14
# Fixed value: characters of a text's head.
HEAD = 16000
MANUAL_TAGS = ["anfrager_manual", "anfrager_pdf_typo", "anfrager_from_db", "anfrager_cross_fraktion", "pdf_database_mismatch", "anfragedatum_manual", "antwortdatum_manual"]


def let(body: Callable[[Column], Column], /, **values: Column) -> Column:
    """body over a struct of values, each computed once however often body uses it."""
    return F.get(F.transform(F.array(F.struct(*(v.alias(k) for k, v in values.items()))), body), F.lit(0))


def blank(column: Column) -> Column:
    return F.coalesce(column, F.lit("")) == ""


def reconcile(pdf: Column, db: Column, kind: str) -> Column:
    """The date that counts and a flag, '' if there is nothing to flag (Q3)."""
    apart = days(db, pdf)
    unreadable = as_date(pdf).isNull() | as_date(db).isNull()

    def verdict(chosen: Column, flag: str = "") -> Column:
        return F.struct(F.coalesce(chosen, F.lit("")).alias("chosen"), F.lit(flag).alias("flag"))

    return (
        F.when(blank(pdf), verdict(db))
        .when(blank(db) | (pdf == db), verdict(pdf))
        .when(unreadable, verdict(db))
        .when(~year_of(pdf).between(*YEARS), verdict(db, kind))
        .when(apart.between(BEFORE, AFTER), verdict(pdf))
        .otherwise(verdict(pdf, kind))
    )


def mismatch(pdf: Column, db: Column) -> Column:
    """Whether two readable dates contradict: outside the corridor, or the document's year can't be (Q4)."""
    apart = days(db, pdf)
    return F.coalesce((pdf != db) & apart.isNotNull() & (~year_of(pdf).between(*YEARS) | ~apart.between(BEFORE, AFTER)), F.lit(False))


def cross_flags(body: Column, footer: Column, locked: Column, name: str) -> Column:
    """The flag if a text's two dates lie over the narrow corridor apart (Q6)."""
    return F.when(~locked & F.coalesce(F.abs(days(body, footer)) > NARROW, F.lit(False)), F.lit(name))


def answer_before_question(asked: Column, answered: Column) -> Column:
    return F.when(F.coalesce(as_date(answered) < as_date(asked), F.lit(False)), F.lit("antwort_vor_anfrage"))


def header_flags(parsed_nr: Column, nr: Column, parsed_faction: Column, faction: Column, number_found: Column) -> Column:
    """Flags of header fields that contradict the table (Q5)."""

    def differs(a: Column, b: Column, name: str) -> Column:
        return F.when(~blank(a) & ~blank(b) & (a != b), F.lit(name))

    return F.array_compact(F.array(differs(parsed_nr, nr, "drucksache_anfrage_nr"), differs(parsed_faction, faction, "fraktion"), F.when(~number_found, F.lit("md_kanr"))))


def number_in(text: Column, number: Column) -> Column:
    """Whether a text's head names the question's number, spaces lost or not (Q5, Q14).

    Doubled characters are repaired first.  Without a number there is nothing to miss.
    """
    n = number.cast("string")
    rx = F.concat(F.lit(r"(?U)Kleine\s+Anfrage\s*"), n, F.lit(r"\s*(?:vom|\b)|Anfrage\s*"), n, F.lit(r"\s*vom"))
    found = F.coalesce(F.regexp_like(dedouble(F.substring(text, 1, HEAD)), rx), F.lit(False))
    return F.coalesce(number.cast("long"), F.lit(0)).eqNullSafe(0) | found


def quality(status: Column, flags: Column, note: Column, tags: Column, before: Column) -> Column:
    """The verdict on a merged row (Q7)."""
    none = F.size(flags) == 0
    noted = ~blank(F.trim(note))
    manual = F.arrays_overlap(trimmed_parts(tags), F.array(*map(F.lit, MANUAL_TAGS)))
    return (
        F.when((status != "extracted") & none, "")
        .when(before == "review", "review")
        .when(~none, F.when(noted, "korrigiert").otherwise("ask_review"))
        .when(noted | manual, "korrigiert")
        .otherwise("ok")
    )


def _state(note: str | None = None, date: Column | None = None) -> Column:
    return F.struct(F.lit(note).cast("string").alias("note"), (F.lit(None) if date is None else date).cast("string").alias("date"))


def number_reason(pdf: Column, db: Column, question: Column) -> Column:
    """Why a document's question number differs from the table's: the first reason that fits (Q8)."""
    wp_db, n_db = F.substring_index(db, "/", 1), F.substring_index(db, "/", -1)
    wp_pdf, n_pdf = F.substring_index(pdf, "/", 1), F.substring_index(pdf, "/", -1)
    number = n_pdf.try_cast("int")

    def compared(s: Column) -> Column:
        gap = s["gap"]
        return (
            F.when(wp_db != wp_pdf, "wrong_term")
            .when(s["number"] == question, "question_number")
            .when(n_pdf == wp_db, "term_header")
            .when(F.abs(gap).isin(1, 10, 100, 1000), F.concat(F.lit("typo "), F.when(gap > 0, "+").otherwise(""), gap))
            .when(F.length(n_pdf) > F.length(n_db), "doubled_digit")
            .when(F.length(n_pdf) < F.length(n_db), "dropped_digit")
            .otherwise(F.concat(F.lit("digit_error "), F.when(gap > 0, "+").otherwise(""), gap))
        )

    both = pdf.rlike(r"^\d+/\d+$") & db.rlike(r"^\d+/\d+$")
    return F.when(both, let(compared, number=number, gap=number - n_db.try_cast("int"))).when(~blank(pdf), "unparseable")


def faction_reason(pdf: Column, db: Column, wp: Column) -> Column:
    """Why a document's faction differs from the table's; null if there is none to compare (Q8)."""
    known = F.create_map(*[F.lit(x) for pair in FACTIONS.items() for x in pair])
    return (
        F.when(blank(pdf), None)
        .when(F.coalesce(F.try_element_at(known, F.upper(pdf)), pdf) == db, "same_faction")
        .when((wp == 17) & (db == "AfD") & (F.lower(pdf) == "fraktionslos"), "left_faction")
        .otherwise("header_or_several")
    )


def classify(flags: Column, row: dict[str, Column]) -> Column:
    """Notes of a row's flags in order, the dates they set, and whether every flag is explained (Q8).

    row has question_body, question_footer, question_db, answer_body, answer_footer, answer_db,
    pdf_nr, db_nr, question, pdf_faction, faction, wp, number_found, header_doubled and text_there.  A
    flag that isn't explained ends the walk, but dates set before it stay.
    """
    body, foot, db = row["question_body"], row["question_footer"], row["question_db"]
    a_body, a_foot, a_db = row["answer_body"], row["answer_footer"], row["answer_db"]
    question_pdf = F.when(blank(body), foot).otherwise(body)

    readable = {k: as_date(v) for k, v in {"question": question_pdf, "body": body, "foot": foot, "db": db, "a_body": a_body, "a_foot": a_foot, "a_db": a_db}.items()}

    def gaps(d: Column) -> Column:
        apart = {"gap": ("db", "question"), "fd": ("db", "foot"), "bf": ("foot", "body"), "bd": ("db", "body"), "a_gap": ("a_db", "a_foot"), "abd": ("a_db", "a_body")}
        return let(walk, **{k: F.datediff(d[later], d[earlier]) for k, (later, earlier) in apart.items()})

    def near(gap: Column) -> Column:
        return F.coalesce(gap.between(-NARROW, NARROW), F.lit(False))

    def a_year(gap: Column) -> Column:
        return F.coalesce(F.abs(gap).between(360, 370), F.lit(False))

    def out_of_years(text: Column) -> Column:
        return F.coalesce(~year_of(text).between(*YEARS), F.lit(False))

    def one_date(pdf: Column, stored: Column, gap: Column, foot_gap: Column | None) -> Column:
        out = F.when(out_of_years(pdf), _state("ocr_year")).when(gap.isNull(), F.when(blank(pdf) & blank(stored), _state()).otherwise(_state("incomplete"))).when(a_year(gap), _state("year_typo", stored))
        if foot_gap is not None:
            out = out.when(near(foot_gap), _state("body_typo", foot)).when(F.array_contains(flags, "anfragedatum_pdf_kreuz"), _state("see_cross"))
        return out.otherwise(_state("pdf_kept"))

    def question_cross(g: Column) -> Column:
        bf, bd = g["bf"], g["bd"]
        years_off = F.abs(bd).between(700, 1850) & F.abs(bf).between(700, 1850) & (F.abs(bd - bf) <= NARROW)
        return (
            F.when(out_of_years(body), _state("ocr_year"))
            .when(a_year(bf) & a_year(bd), _state("year_typo", db))
            .when(F.coalesce(years_off, F.lit(False)), F.struct(F.concat(F.lit("years_typo "), years_apart(bd)).alias("note"), db.cast("string").alias("date")))
            .when(near(bd), _state("footer_typo"))
            .when(near(g["fd"]) & F.coalesce(F.abs(bd) > NARROW, F.lit(False)), _state("body_typo", foot))
            .otherwise(_state())
        )

    def answer_cross(g: Column) -> Column:
        return F.when(near(g["abd"]), _state("footer_typo", a_body)).when(near(g["a_gap"]) & F.coalesce(F.abs(g["abd"]) > NARROW, F.lit(False)), _state("body_typo")).otherwise(_state())

    nr, faction = number_reason(row["pdf_nr"], row["db_nr"], row["question"]), faction_reason(row["pdf_faction"], row["faction"], row["wp"])
    nothing = blank(row["question_body"]) & blank(row["answer_body"]) & blank(row["pdf_nr"]) & blank(row["pdf_faction"])
    number = F.when(nothing & row["text_there"] & row["number_found"], _state("spacing")).when(nothing & row["text_there"] & row["header_doubled"], _state("doubled_header")).when(~nothing, _state("other_number")).otherwise(_state())

    def noted(reason: Column) -> Column:
        return F.struct(reason.alias("note"), F.lit(None).cast("string").alias("date"))

    def judge(flag: Column, g: Column) -> Column:
        return (
            F.when(flag == "anfragedatum", one_date(question_pdf, db, g["gap"], g["fd"]))
            .when(flag == "antwortdatum", one_date(a_foot, a_db, g["a_gap"], None))
            .when(flag == "drucksache_anfrage_nr", noted(nr))
            .when(flag == "fraktion", noted(faction))
            .when(flag == "md_kanr", number)
            .when(flag == "anfragedatum_pdf_kreuz", question_cross(g))
            .when(flag == "antwortdatum_pdf_kreuz", answer_cross(g))
            .otherwise(_state())
        )

    start = F.struct(F.array().cast("array<string>").alias("notes"), F.lit(None).cast("string").alias("question_date"), F.lit(None).cast("string").alias("answer_date"), F.lit(True).alias("open"))

    def step(state: Column, flag: Column, one: Column) -> Column:
        go = state["open"] & one["note"].isNotNull()
        asks = F.startswith(flag, F.lit("anfragedatum"))
        return F.struct(
            F.when(go, F.concat(state["notes"], F.array(F.concat_ws(":", flag, one["note"])))).otherwise(state["notes"]).alias("notes"),
            F.when(go & asks & one["date"].isNotNull(), one["date"]).otherwise(state["question_date"]).alias("question_date"),
            F.when(go & ~asks & one["date"].isNotNull(), one["date"]).otherwise(state["answer_date"]).alias("answer_date"),
            go.alias("open"),
        )

    def walk(g: Column) -> Column:
        judged = F.transform(flags, lambda flag: F.struct(flag.alias("flag"), judge(flag, g).alias("one")))
        done = lambda w: F.struct(w["notes"].alias("notes"), w["question_date"].alias("question_date"), w["answer_date"].alias("answer_date"), (w["open"] & (F.size(flags) > 0)).alias("resolved"))
        return F.aggregate(judged, start, lambda state, j: step(state, j["flag"], j["one"]), done)

    return let(lambda d: gaps(d), **readable)
