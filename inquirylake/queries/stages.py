"""Stage decisions over the question table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter, sources
from ..functions import text as t
from ..functions.dates import days
from ..operators import joins as j
from ..operators import keyed as k
from ..operators import runs
from ..operators import stages as s
from .common import ANSWERED, INQUIRIES
from .quality import FIELDS, PAIRS, _pairs
from .registry import registry

QUERIES, SQL, query = registry()

ACTION = """CASE WHEN ka_nr % 13 = 0 THEN 'bad_name' WHEN ka_nr % 11 = 0 THEN 'unknown' WHEN ka_nr % 7 = 0 THEN 'withdrawn' WHEN ka_nr % 5 = 0 THEN 'complete'
    WHEN ka_nr % 3 = 0 THEN 'unreadable' WHEN ka_nr % 4 = 0 THEN 'large_inquiry' WHEN ka_nr % 4 = 1 THEN 'no_answer' ELSE 'parse' END"""


def _actions(spark, sf_dir):
    n = F.col("ka_nr")
    row = {
        "named": n % 13 != 0,
        "known": n % 11 != 0,
        "status": F.when(n % 7 == 0, "anfrage_zurueckgezogen").when(n % 2 == 0, "extracted"),
        "number": F.when(n % 5 == 0, n),
        "title": F.lit("Titel"),
        "ministry": F.col("ministry"),
        "text": F.when(n % 3 != 0, "text"),
        "large": n % 4 == 0,
        "answer": n % 4 != 1,
    }
    return adapter.inquiries(spark, sf_dir).select("ka_nr", s.scan_action(row).alias("action"))


@query("x17_scan_archive", f"WITH {INQUIRIES} SELECT ka_nr, {ACTION} AS action FROM inq")
def x17(spark, sf_dir):
    return _actions(spark, sf_dir)


@query("a20_run_counters", f"WITH {INQUIRIES} SELECT {ACTION} AS action, count(*) AS n FROM inq GROUP BY 1")
def a20(spark, sf_dir):
    return s.counters(_actions(spark, sf_dir), "action")


@query("q8a_resolve_auto", f"""WITH {PAIRS} SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_partkey % 5 = 0 THEN 'ok' WHEN l_partkey % 3 = 0 THEN 'ask_review' ELSE 'korrigiert' END AS quality,
    CASE WHEN l_partkey % 5 <> 0 AND y BETWEEN 2015 AND 2030 AND abs(gap) BETWEEN 360 AND 370 THEN db ELSE pdf END AS question_date,
    CASE WHEN l_partkey % 5 = 0 OR l_partkey % 3 = 0 THEN '' WHEN y NOT BETWEEN 2015 AND 2030 THEN 'anfragedatum:ocr_year' WHEN gap IS NULL THEN 'anfragedatum:incomplete'
        WHEN abs(gap) BETWEEN 360 AND 370 THEN 'anfragedatum:year_typo' ELSE 'anfragedatum:pdf_kept' END AS note FROM judged""")
def q8a(spark, sf_dir):
    """Question dates that were flagged; every third row has another flag that nothing explains."""
    rows = _pairs(spark, sf_dir, costly=True).withColumns(
        {
            "quality": F.when(F.col("l_partkey") % 5 == 0, "ok").otherwise("ask_review"),
            "note": F.when(F.col("l_partkey") % 2 == 0, " ").otherwise(""),
            "question_date": F.col("pdf"),
            "answer_date": F.lit(""),
            "flags": F.when(F.col("l_partkey") % 3 == 0, "anfragedatum, antwort_vor_anfrage").otherwise(" anfragedatum"),
        }
    )
    empty = {f: F.lit("") for f in FIELDS} | {"question": F.lit(1), "wp": F.lit(18), "number_found": F.lit(False), "header_doubled": F.lit(False), "text_there": F.lit(False)}
    out = s.resolve(rows, "flags", empty | {"question_body": F.col("pdf"), "question_db": F.col("db")})
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "quality", "question_date", F.trim("note").alias("note"))


@query("q15_source_findings", f"""WITH {PAIRS} SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN pdf <> db AND gap IS NOT NULL AND (y NOT BETWEEN 2015 AND 2030 OR gap NOT BETWEEN -14 AND 122) THEN 'anfragedatum' END,
    CASE WHEN l_partkey % 3 = 0 THEN 'drucksache_anfrage_nr' END, CASE WHEN l_partkey % 4 = 0 THEN 'fraktion' END) AS findings, CAST(gap AS INTEGER) AS gap FROM judged""")
def q15(spark, sf_dir):
    pdf, db, n = F.col("pdf"), F.col("db"), F.col("l_partkey")
    found = s.source_findings(pdf, db, F.lit(""), F.lit("2020-01-01"), F.when(n % 3 == 0, "18/1").otherwise("18/2"), F.lit("18/2"), F.when(n % 4 == 0, "SPD").otherwise(""), F.lit("CDU"))
    return _pairs(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(found, ",").alias("findings"), days(db, pdf).alias("gap"))


@query("p4_rescue_candidates", f"WITH {INQUIRIES} SELECT ka_nr FROM inq WHERE status <> 'pending' AND ka_nr % 3 = 0 AND wp = 17 AND ka_nr % 5 <> 0")
def p4(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir).withColumn("extract_flags", F.when(F.col("ka_nr") % 3 == 0, "missing_anfrager"))
    return s.rescue_candidates(rows, rows.where("ka_nr % 5 <> 0"), "q_nr", 17).select("ka_nr")


@query("p13_review_pending", f"WITH {INQUIRIES} SELECT ka_nr FROM inq WHERE ka_nr % 2 = 0 AND ka_nr % 3 <> 0")
def p13(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir).withColumns({"quality": F.when(F.col("ka_nr") % 2 == 0, "ask_review").otherwise("ok"), "note": F.when(F.col("ka_nr") % 3 == 0, "seen")})
    return s.review_pending(rows).select("ka_nr")


@query("p15_without_tag", f"WITH {INQUIRIES} SELECT ka_nr FROM inq WHERE ka_nr % 3 <> 0")
def p15(spark, sf_dir):
    flags = F.when(F.col("ka_nr") % 3 == 0, "x,anfrager_manual").when(F.col("ka_nr") % 3 == 1, "anfrager_manual_not")
    return s.without_tag(adapter.inquiries(spark, sf_dir).withColumn("flags", flags), "flags", "anfrager_manual").select("ka_nr")


@query("q8b_decisions", f"""WITH {INQUIRIES}, e AS (SELECT ka_nr, ka_nr % 7 AS session, CASE WHEN ka_nr = 1004 THEN ' Q ' WHEN ka_nr % 9 = 0 THEN '' ELSE 'n' || ka_nr END AS note, CASE WHEN ka_nr % 4 = 0 THEN 's' ELSE 'K' END AS verdict FROM inq WHERE ka_nr % 3 <> 1 OR ka_nr = 1004),
h AS (SELECT ka_nr, note, verdict FROM e WHERE note <> '' AND NOT (session = 3 AND ka_nr >= 1004)),
f AS (SELECT i.ka_nr, coalesce(h.note, CASE WHEN i.ka_nr % 12 = 0 THEN 'late' END) AS note, CASE WHEN h.note IS NOT NULL THEN h.verdict ELSE '' END AS verdict FROM inq i LEFT JOIN h USING (ka_nr))
SELECT ka_nr, CASE WHEN ka_nr % 5 = 0 THEN 'seen' WHEN ka_nr % 2 = 0 AND note IS NOT NULL THEN note ELSE '' END AS notizen,
    CASE WHEN ka_nr % 2 = 1 THEN 'ok' WHEN ka_nr % 5 <> 0 AND note IS NOT NULL AND verdict <> 's' THEN 'korrigiert' ELSE 'ask_review' END AS datenqualitaet FROM f""")
def q8b(spark, sf_dir):
    """Seven sessions over the table, one of them broken off, and a later one; skipped rows, unlike verdicts, rows with a note."""
    n, key = F.col("ka_nr"), F.col("q_nr").alias("drucksache_antwort_nr")
    rows = adapter.inquiries(spark, sf_dir)
    table = rows.select("ka_nr", key, F.when(n % 2 == 0, "ask_review").otherwise("ok").alias("datenqualitaet"), F.when(n % 5 == 0, "seen").otherwise("").alias("notizen"))
    note = F.when(n == 1004, " Q ").when(n % 9 == 0, " ").otherwise(F.concat(F.lit("n"), n))
    made = rows.where("ka_nr % 3 <> 1 or ka_nr = 1004").select(key, (n % 7).alias("session"), n.alias("seq"), note.alias("note"), F.when(n % 4 == 0, "s").otherwise("K").alias("verdict"))
    late = rows.where("ka_nr % 12 = 0").select(key, F.lit(100).cast("long").alias("session"), n.alias("seq"), F.lit("late").alias("note"), F.lit("").alias("verdict"))
    return runs.reviewed(table, made.unionByName(late), F.lit("t")).select("ka_nr", "notizen", "datenqualitaet")


@query("j15_letters_again", f"""WITH {ANSWERED}, t AS (SELECT wp, ka_nr, q_nr AS paper, 'Anfrage' AS kind FROM ans UNION ALL SELECT wp, ka_nr, pk, 'Antwort' FROM ans WHERE pk <> q_nr)
SELECT t.wp, ka_nr, paper, kind, CASE WHEN ka_nr % 3 = 0 AND kind = 'Anfrage' THEN 'ok' WHEN ka_nr % 5 = 0 THEN 'pdf_missing' WHEN ka_nr % 7 = 0 THEN 'no_match' ELSE 'ok' END AS status,
    CASE WHEN ka_nr % 3 = 0 AND kind = 'Anfrage' THEN '2001-01-01' WHEN ka_nr % 5 = 0 OR ka_nr % 7 = 0 THEN '' ELSE strftime(question_date, '%Y-%m-%d') END AS original FROM t JOIN (SELECT ka_nr, question_date FROM inq) USING (ka_nr)""")
def j15(spark, sf_dir):
    """Letters read before, a third of the questions' well, all others badly; pages of most papers, some without a foot."""
    n, index = F.col("ka_nr"), adapter.answered(spark, sf_dir).select("wp", "ka_nr", "q_nr", "pk", "question_date")
    day = F.date_format("question_date", "dd.MM.yyyy")
    foot = F.concat(F.lit("Datum des Originals: "), day, F.lit("/Ausgegeben: "), day)
    page = F.when(n % 7 == 0, "no foot").otherwise(foot)
    fit = index.where("ka_nr % 5 <> 0")
    asked = fit.select(F.col("q_nr").alias("paper"), F.lit("Anfrage").alias("kind"), page.alias("page"))
    pages = asked.unionByName(fit.where("pk <> q_nr").select(F.col("pk").alias("paper"), F.lit("Antwort").alias("kind"), page.alias("page")))
    tasks = index.select("wp", "ka_nr", F.explode(F.array(F.struct(F.col("q_nr").alias("paper"), F.lit("Anfrage").alias("kind")), F.struct(F.col("pk").alias("paper"), F.lit("Antwort").alias("kind")))).alias("t")).select("wp", "ka_nr", "t.*")
    well = (n % 3 == 0) & (F.col("kind") == "Anfrage")
    existing = tasks.where("not (kind = 'Antwort' and ka_nr % 2 = 0)").where(well | (n % 4 == 0)).select("paper", "kind", "wp", "ka_nr", F.when(well, "ok").otherwise("parse_failed").alias("status"), F.when(well, "2001-01-01").otherwise("").alias("original"), F.lit("").alias("issued"))
    existing = existing.join(j.tasks(index).select("paper", "kind"), ["paper", "kind"], "left_semi")
    return runs.letters(index, pages, existing).select("wp", "ka_nr", "paper", "kind", "status", "original")


@query("j17_logged_rows", f"WITH {INQUIRIES} SELECT q_nr AS pk, ka_nr, CAST(2 AS INTEGER) AS parsed FROM inq WHERE ka_nr % 3 = 0")
def j17(spark, sf_dir):
    """Logged mismatches of stored rows; logged keys that aren't stored fall out."""
    rows = adapter.inquiries(spark, sf_dir)
    line = F.concat(F.lit("t | "), F.when(F.col("ka_nr") % 2 == 0, F.col("q_nr")).otherwise(F.concat(F.lit("x"), "q_nr")), F.lit(' | SPD | MISMATCH parsed=2 db_min=3 | db_anfrager="" | block=""'))
    more = F.concat(F.lit("t | "), "q_nr", F.lit(' | SPD | MISMATCH parsed=2 db_min=3 | db_anfrager="" | block=""'))
    lines = rows.where("ka_nr % 3 = 0").select("ka_nr", more.alias("value")).unionByName(rows.where("ka_nr % 3 = 0").select("ka_nr", F.regexp_replace(line, r"\| 1", "| x1").alias("value")))
    log = sources.mismatch_log(lines, "ka_nr")
    return rows.select(F.col("q_nr").alias("pk"), "ka_nr").join(log, "pk").select("pk", "ka_nr", "parsed")


@query("u4_withdrawn_override", f"WITH {INQUIRIES} SELECT ka_nr, CASE WHEN ka_nr % 11 = 0 THEN 'anfrage_zurueckgezogen' ELSE status END AS status FROM inq")
def u4(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir).withColumn("withdrawn", F.col("ka_nr") % 11 == 0)
    return rows.select("ka_nr", k.withdrawn("withdrawn", "status").alias("status"))


@query("fn20_sorted_flags", f"WITH {INQUIRIES} SELECT ka_nr, CASE WHEN ka_nr % 2 = 0 THEN 'a,b,c' ELSE 'a,c' END AS flags FROM inq")
def fn20(spark, sf_dir):
    flags = F.array_compact(F.array(F.lit("c"), F.when(F.col("ka_nr") % 2 == 0, "b"), F.lit("a"), F.lit("c")))
    return adapter.inquiries(spark, sf_dir).select("ka_nr", t.sorted_flags(flags).alias("flags"))


@query("snk2_snapshot_columns", f"WITH {INQUIRIES} SELECT wp, CAST(ka_nr AS INTEGER) AS kleine_anfrage_nr, q_nr AS drucksache_anfrage_nr, fraktion FROM inq")
def snk2(spark, sf_dir):
    from ..sinks import SNAPSHOT

    rows = adapter.inquiries(spark, sf_dir).select("wp", F.col("ka_nr").cast("int").alias("kleine_anfrage_nr"), F.col("q_nr").alias("drucksache_anfrage_nr"), "fraktion", "ministry")
    return rows.select(*[c for c in SNAPSHOT if c in rows.columns])


MERGED = INQUIRIES + """,
m AS (
    SELECT *, question_date AS q, ka_nr % 9 <> 0 AS ext, ka_nr % 17 = 0 AS kept, question_date + CAST(CASE WHEN ka_nr % 13 = 0 THEN 150 ELSE ka_nr % 3 * 10 END AS INTEGER) AS db_q, question_date + 25 AS db_a,
        CASE WHEN ka_nr % 9 <> 0 THEN question_date END AS body_q, CASE WHEN ka_nr % 9 <> 0 THEN question_date + 20 END AS body_a,
        CASE WHEN ka_nr % 4 <> 0 AND ka_nr % 7 <> 0 THEN question_date - CASE WHEN ka_nr % 8 = 3 THEN 30 ELSE 2 END END AS foot_q,
        CASE WHEN ka_nr % 5 <> 4 THEN question_date + CAST(CASE WHEN ka_nr % 10 = 1 THEN -5 ELSE 20 - ka_nr % 2 END AS INTEGER) END AS foot_a FROM inq
),
n AS (SELECT *, coalesce(body_q, foot_q) AS pdf_q, foot_a AS pdf_a FROM m),
o AS (
    SELECT *, CASE WHEN kept OR pdf_q IS NULL OR pdf_q = db_q THEN false WHEN year(pdf_q) NOT BETWEEN 2015 AND 2030 THEN true ELSE db_q - pdf_q NOT BETWEEN -14 AND 122 END AS flag_q,
        CASE WHEN kept OR pdf_q IS NULL OR year(pdf_q) NOT BETWEEN 2015 AND 2030 THEN db_q ELSE pdf_q END AS new_q,
        CASE WHEN pdf_a IS NULL OR pdf_a = db_a THEN false WHEN year(pdf_a) NOT BETWEEN 2015 AND 2030 THEN true ELSE db_a - pdf_a NOT BETWEEN -14 AND 122 END AS flag_a,
        CASE WHEN pdf_a IS NULL OR year(pdf_a) NOT BETWEEN 2015 AND 2030 THEN db_a ELSE pdf_a END AS new_a FROM n
),
p AS (
    SELECT *, concat_ws(',', CASE WHEN flag_q THEN 'anfragedatum' END, CASE WHEN flag_a THEN 'antwortdatum' END, CASE WHEN NOT kept AND abs(body_q - foot_q) > 14 THEN 'anfragedatum_pdf_kreuz' END,
        CASE WHEN abs(body_a - foot_a) > 14 THEN 'antwortdatum_pdf_kreuz' END, CASE WHEN new_a < new_q THEN 'antwort_vor_anfrage' END, CASE WHEN ext AND ka_nr % 7 = 0 THEN 'drucksache_anfrage_nr' END,
        CASE WHEN ext AND ka_nr % 6 = 5 THEN 'fraktion' END, CASE WHEN ext AND ka_nr % 11 = 0 THEN 'md_kanr' END) AS flags FROM o
),
r AS (
    SELECT *, CASE WHEN NOT ext AND flags = '' THEN '' WHEN ka_nr % 23 = 0 THEN 'review' WHEN flags <> '' THEN CASE WHEN ka_nr % 19 = 0 THEN 'korrigiert' ELSE 'ask_review' END
        WHEN ka_nr % 19 = 0 OR kept THEN 'korrigiert' ELSE 'ok' END AS verdict FROM p
)"""


def merged(spark, sf_dir):
    """The table with dates, papers, factions and numbers altered by rule, merged with its letters and rendered answers."""
    from .extraction import _worded

    n, q = F.col("ka_nr"), F.col("question_date")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    pk = F.concat_ws("/", "wp", n + 10_000_000)
    rows = adapter.inquiries(spark, sf_dir, costly=True)
    token = F.when(n % 3 == 0, "BÜNDNIS 90/DIE GRÜNEN").when(n % 3 == 1, "FRAKTIONSLOS").otherwise("AFD")
    lost = F.when(n % 2 == 0, "").otherwise(" ")
    head = F.concat(
        F.lit("LANDTAG NORDRHEIN-WESTFALEN Wahlperiode Antwort der Landesregierung auf die Kleine Anfrage "), n, lost, F.lit("vom "), _worded(q), F.lit(" der Abgeordneten Eva Muster "), token,
        F.lit("\nDrucksache"), lost, "q_nr", F.lit("\nDie Ministerin der Justiz hat die Kleine Anfrage "), n, F.lit(" mit Schreiben vom "), _worded(F.date_add(q, 20)), F.lit(" beantwortet."),
    )
    texts = rows.select(pk.alias("drucksache_antwort_nr"), F.when(n % 4 == 3, F.regexp_replace(head, r"(\S)", "$1$1")).otherwise(head).alias("text"))
    asked = rows.where("ka_nr % 4 <> 0").select(F.col("q_nr").alias("paper"), F.lit("Anfrage").alias("kind"), iso(F.date_sub(q, F.when(n % 8 == 3, 30).otherwise(2))).alias("date"))
    told = rows.where("ka_nr % 5 <> 4").select(pk.alias("paper"), F.lit("Antwort").alias("kind"), iso(F.date_add(q, F.when(n % 10 == 1, -5).otherwise(20 - n % 2).cast("int"))).alias("date"))
    faction = F.when(n % 6 == 5, "SPD").when(n % 3 == 0, "GRÜNE").when(n % 3 == 1, "fraktionslos").otherwise("AfD")
    table = rows.select(
        F.col("ka_nr").alias("id"),
        pk.alias("drucksache_antwort_nr"),
        F.when(n % 7 == 0, "18/0").otherwise(F.col("q_nr")).alias("drucksache_anfrage_nr"),
        F.when(n % 11 == 0, n + 1).otherwise(n).alias("kleine_anfrage_nr"),
        faction.alias("fraktion"),
        iso(F.date_add(q, F.when(n % 13 == 0, 150).otherwise(n % 3 * 10).cast("int"))).alias("anfragedatum"),
        iso(F.date_add(q, 25)).alias("antwortdatum"),
        F.lit("").alias("anfragedatum_db"),
        F.lit(None).cast("string").alias("antwortdatum_db"),
        F.when(n % 9 == 0, "pending").otherwise("extracted").alias("antworttext_status"),
        F.when(n % 17 == 0, "x, anfragedatum_manual").otherwise("").alias("extract_flags"),
        F.when(n % 19 == 0, "seen").otherwise(" ").alias("notizen"),
        F.when(n % 23 == 0, "review").otherwise("ok").alias("datenqualitaet"),
    )
    letters = asked.unionByName(told).withColumn("position", F.lit(1))
    earlier = letters.withColumns({"date": F.lit("1999-01-01"), "position": F.lit(0)})
    older = texts.withColumn("text", F.lit("an earlier text")).withColumn("position", F.lit(0))
    return s.merge(table, letters.unionByName(earlier), texts.withColumn("position", F.lit(1)).unionByName(older))


@query("m1_merge", f"""WITH {MERGED} SELECT ka_nr AS id, strftime(new_q, '%Y-%m-%d') AS anfragedatum, strftime(new_a, '%Y-%m-%d') AS antwortdatum, strftime(db_q, '%Y-%m-%d') AS anfragedatum_db, flags AS mismatch_flags, verdict AS datenqualitaet,
    CASE WHEN flag_q THEN 'flagged' WHEN pdf_q <> db_q THEN 'silent' WHEN pdf_q IS NULL THEN 'missing' ELSE '' END AS outcome_anfragedatum,
    CASE WHEN flag_a THEN 'flagged' WHEN pdf_a <> db_a THEN 'silent' WHEN pdf_a IS NULL THEN 'missing' ELSE '' END AS outcome_antwortdatum FROM r""")
def m1(spark, sf_dir):
    return merged(spark, sf_dir).select("id", "anfragedatum", "antwortdatum", "anfragedatum_db", "mismatch_flags", "datenqualitaet", "outcome_anfragedatum", "outcome_antwortdatum")


@query("m1_merge_counters", f"WITH {MERGED} SELECT CASE WHEN verdict = '' THEN 'skipped' ELSE verdict END AS disposition, count(*) AS n FROM r GROUP BY 1")
def m1_counters(spark, sf_dir):
    return s.counters(merged(spark, sf_dir), "disposition")
