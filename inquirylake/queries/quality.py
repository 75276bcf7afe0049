"""Reconciliation, classification and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter
from ..operators import quality as q
from ..operators import reconcile as r
from .common import ANSWERED, INQUIRIES
from .registry import registry

QUERIES, SQL, query = registry()

PAIRS = """
pairs AS (
    SELECT l_orderkey, l_linenumber, l_partkey, strftime(CAST(CAST(o_orderdate AS DATE) + INTERVAL 252 MONTH AS DATE), '%Y-%m-%d') AS db,
        CASE WHEN l_partkey % 50 = 0 THEN '' WHEN l_partkey % 53 = 0 THEN '2022-02-31'
            WHEN l_linenumber = 7 THEN strftime(CAST(CAST(l_shipdate AS DATE) + INTERVAL 492 MONTH AS DATE), '%Y-%m-%d')
            ELSE strftime(CAST(CAST(l_shipdate AS DATE) + INTERVAL 252 MONTH AS DATE), '%Y-%m-%d') END AS pdf
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
judged AS (SELECT *, TRY_CAST(db AS DATE) - TRY_CAST(pdf AS DATE) AS gap, CASE WHEN pdf <> '' THEN CAST(substr(pdf, 1, 4) AS INTEGER) END AS y FROM pairs)"""


def _pairs(spark, sf_dir, costly=False):
    """A stored date and a document's date for each line item, some missing, unreadable or far off."""
    lines = adapter.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    lines = adapter.spread(lines) if costly else lines
    orders = adapter.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    shipped = F.col("l_shipdate").cast("date")
    pdf = (
        F.when(F.col("l_partkey") % 50 == 0, "")
        .when(F.col("l_partkey") % 53 == 0, "2022-02-31")
        .when(F.col("l_linenumber") == 7, F.date_format(F.add_months(shipped, 492), "yyyy-MM-dd"))
        .otherwise(F.date_format(F.add_months(shipped, 252), "yyyy-MM-dd"))
    )
    db = F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 252), "yyyy-MM-dd")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", db.alias("db"), pdf.alias("pdf"))


KEYS = "l_orderkey, l_linenumber, l_partkey"


@query("q3_reconcile", f"""WITH {PAIRS} SELECT {KEYS},
    CASE WHEN pdf = '' THEN db WHEN gap IS NULL THEN db WHEN y NOT BETWEEN 2015 AND 2030 THEN db ELSE pdf END AS chosen,
    CASE WHEN pdf = '' OR gap IS NULL OR pdf = db THEN '' WHEN y NOT BETWEEN 2015 AND 2030 THEN 'k' WHEN gap BETWEEN -14 AND 122 THEN '' ELSE 'k' END AS flag FROM judged""")
def q3(spark, sf_dir):
    return _pairs(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", r.reconcile(F.col("pdf"), F.col("db"), "k").alias("r")).select("l_orderkey", "l_linenumber", "l_partkey", "r.*")


@query("q4_date_mismatch", f"WITH {PAIRS} SELECT {KEYS}, coalesce(pdf <> db AND gap IS NOT NULL AND (y NOT BETWEEN 2015 AND 2030 OR gap NOT BETWEEN -14 AND 122), false) AS mismatch FROM judged")
def q4(spark, sf_dir):
    return _pairs(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", r.mismatch(F.col("pdf"), F.col("db")).alias("mismatch"))


@query("q6_cross_checks", f"""WITH {PAIRS} SELECT {KEYS}, CASE WHEN l_partkey % 7 <> 0 AND abs(gap) > 14 THEN 'anfragedatum_pdf_kreuz' END AS crossed,
    CASE WHEN gap < 0 THEN 'antwort_vor_anfrage' END AS before FROM judged""")
def q6(spark, sf_dir):
    pdf, db = F.col("pdf"), F.col("db")
    crossed = r.cross_flags(pdf, db, F.col("l_partkey") % 7 == 0, "anfragedatum_pdf_kreuz")
    return _pairs(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", crossed.alias("crossed"), r.answer_before_question(pdf, db).alias("before"))


@query("q5_header_flags", f"""WITH {INQUIRIES} SELECT ka_nr, concat_ws(',', CASE WHEN ka_nr % 5 = 0 THEN 'drucksache_anfrage_nr' END,
    CASE WHEN ka_nr % 4 = 0 THEN 'fraktion' END, CASE WHEN ka_nr % 3 = 2 AND ka_nr % 11 <> 0 THEN 'md_kanr' END) AS flags FROM inq""")
def q5(spark, sf_dir):
    """Every seventh head has all its characters doubled, every eleventh row no number."""
    k = F.col("ka_nr")
    text = F.when(k % 3 == 0, F.concat(F.lit("Kleine Anfrage "), k, F.lit(" vom 1. Mai"))).when(k % 3 == 1, F.concat(F.lit("Anfrage"), k, F.lit("vom 1. Mai"))).otherwise(F.concat(F.lit("Kleine Anfrage "), k, F.lit("7 vom")))
    nr = F.when(k % 5 == 0, "18/0").when(k % 5 == 1, "").otherwise(F.col("q_nr"))
    faction = F.when(k % 4 == 0, "SPD").when(k % 4 == 1, "").otherwise(F.col("fraktion"))
    head = F.concat(F.lit("LANDTAG NORDRHEIN-WESTFALEN Antwort der Landesregierung in der Sache auf die "), text)
    head = F.when(k % 7 == 0, F.regexp_replace(head, r"(\S)", "$1$1")).otherwise(head)
    flags = r.header_flags(nr, F.col("q_nr"), faction, F.col("fraktion"), r.number_in(head, F.when(k % 11 != 0, k)))
    return adapter.inquiries(spark, sf_dir).select("ka_nr", F.array_join(flags, ",").alias("flags"))


@query("q7_merge_verdict", f"""WITH {INQUIRIES}, x AS (SELECT ka_nr, status, ka_nr % 3 = 0 AS flagged, ka_nr % 5 = 0 AS noted, ka_nr % 7 = 0 AS manual, ka_nr % 11 = 0 AS reviewed FROM inq)
SELECT ka_nr, CASE WHEN status <> 'extracted' AND NOT flagged THEN '' WHEN reviewed THEN 'review' WHEN flagged THEN CASE WHEN noted THEN 'korrigiert' ELSE 'ask_review' END
    WHEN noted OR manual THEN 'korrigiert' ELSE 'ok' END AS quality FROM x""")
def q7(spark, sf_dir):
    k = F.col("ka_nr")
    flags = F.when(k % 3 == 0, F.array(F.lit("fraktion"))).otherwise(F.array().cast("array<string>"))
    verdict = r.quality(F.col("status"), flags, F.when(k % 5 == 0, "checked").otherwise(" "), F.when(k % 7 == 0, "x, anfrager_from_db ").otherwise("x"), F.when(k % 11 == 0, "review").otherwise("ok"))
    return adapter.inquiries(spark, sf_dir).select("ka_nr", verdict.alias("quality"))


FIELDS = ["question_body", "question_footer", "question_db", "answer_body", "answer_footer", "answer_db", "pdf_nr", "db_nr", "question", "pdf_faction", "faction", "wp", "number_found", "header_doubled", "text_there"]


#: Why a question number differs, of pdf_n and db_n within one term, and question n.
REASON = """CASE WHEN pdf_n = n THEN 'question_number' WHEN pdf_n = 18 THEN 'term_header' WHEN abs(pdf_n - db_n) IN (1, 10, 100, 1000) THEN 'typo ' || CASE WHEN pdf_n > db_n THEN '+' ELSE '' END || (pdf_n - db_n)
    WHEN len(pdf_n || '') > len(db_n || '') THEN 'doubled_digit' WHEN len(pdf_n || '') < len(db_n || '') THEN 'dropped_digit' ELSE 'digit_error ' || CASE WHEN pdf_n > db_n THEN '+' ELSE '' END || (pdf_n - db_n) END"""


@query("q8_classify", f"""WITH {PAIRS}, c AS (SELECT *, CAST(l_partkey + 100 AS BIGINT) AS db_n, CAST(l_partkey + l_orderkey % 23 + 89 AS BIGINT) AS pdf_n, CAST(l_partkey + 95 AS BIGINT) AS n, CAST(l_linenumber % 4 AS INTEGER) AS kind,
    strftime(CAST(db AS DATE) + CAST(l_orderkey % 40 - 20 AS INTEGER), '%Y-%m-%d') AS foot, CAST(l_orderkey % 40 - 20 AS INTEGER) AS away FROM judged), w AS (
SELECT *, CASE kind
    WHEN 0 THEN CASE WHEN pdf = '' THEN CASE WHEN abs(away) BETWEEN 360 AND 370 THEN 'year_typo' WHEN abs(away) <= 14 THEN 'body_typo' ELSE 'pdf_kept' END WHEN y NOT BETWEEN 2015 AND 2030 THEN 'ocr_year' WHEN gap IS NULL THEN 'incomplete' WHEN abs(gap) BETWEEN 360 AND 370 THEN 'year_typo' WHEN abs(away) <= 14 THEN 'body_typo' ELSE 'pdf_kept' END
    WHEN 1 THEN CASE WHEN pdf <> '' AND y NOT BETWEEN 2015 AND 2030 THEN 'ocr_year' WHEN gap IS NULL THEN 'incomplete' WHEN abs(gap) BETWEEN 360 AND 370 THEN 'year_typo' ELSE 'pdf_kept' END
    WHEN 2 THEN {REASON} ELSE CASE l_partkey % 3 WHEN 0 THEN 'same_faction' WHEN 1 THEN 'left_faction' ELSE 'header_or_several' END END AS note FROM c)
SELECT {KEYS}, CASE kind WHEN 0 THEN 'anfragedatum' WHEN 1 THEN 'antwortdatum' WHEN 2 THEN 'drucksache_anfrage_nr' ELSE 'fraktion' END || ':' || note AS notes,
    CASE WHEN kind = 0 AND note = 'year_typo' THEN db WHEN kind = 0 AND note = 'body_typo' THEN foot ELSE '' END AS question_date, CASE WHEN kind = 1 AND note = 'year_typo' THEN db ELSE '' END AS answer_date, l_orderkey % 5 <> 0 AS resolved FROM w""")
def q8(spark, sf_dir):
    """A flagged question date, answer date, paper or faction for each pair; each fifth order also has a flag that nothing explains."""
    kind, part = F.col("l_linenumber") % 4, F.col("l_partkey")
    flag = F.element_at(F.array(*map(F.lit, ("anfragedatum", "antwortdatum", "drucksache_anfrage_nr", "fraktion"))), (kind + 1).cast("int"))
    foot = F.date_format(F.date_add(F.col("db").cast("date"), (F.col("l_orderkey") % 40 - 20).cast("int")), "yyyy-MM-dd")
    row = {f: F.lit("") for f in FIELDS} | {
        "question_body": F.when(kind == 0, F.col("pdf")).otherwise(""),
        "question_footer": F.when(kind == 0, foot).otherwise(""),
        "question_db": F.when(kind == 0, F.col("db")).otherwise(""),
        "answer_footer": F.when(kind == 1, F.col("pdf")).otherwise(""),
        "answer_db": F.when(kind == 1, F.col("db")).otherwise(""),
        "pdf_nr": F.concat(F.lit("18/"), part + F.col("l_orderkey") % 23 + 89),
        "db_nr": F.concat(F.lit("18/"), part + 100),
        "question": part + 95,
        "pdf_faction": F.when(part % 3 == 0, "BÜNDNIS 90/DIE GRÜNEN").when(part % 3 == 1, "fraktionslos").otherwise("SPD"),
        "faction": F.when(part % 3 == 0, "GRÜNE").when(part % 3 == 1, "AfD").otherwise("CDU"),
        "wp": F.lit(17),
        "number_found": F.lit(False),
        "header_doubled": F.lit(False),
        "text_there": F.lit(False),
    }
    flags = F.when(F.col("l_orderkey") % 5 == 0, F.array(flag, F.lit("antwort_vor_anfrage"))).otherwise(F.array(flag))
    out = _pairs(spark, sf_dir, costly=True).withColumns({f"_{f}": c for f, c in row.items()} | {"flags": flags})
    out = out.withColumn("c", r.classify(F.col("flags"), {f: F.col(f"_{f}") for f in FIELDS}))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join("c.notes", ";").alias("notes"), F.coalesce("c.question_date", F.lit("")).alias("question_date"), F.coalesce("c.answer_date", F.lit("")).alias("answer_date"), F.col("c.resolved").alias("resolved"))


def _table(spark, sf_dir):
    """The working table's columns that flags and normalisation read, some blanked by rule."""
    k = F.col("ka_nr")
    rows = adapter.answered(spark, sf_dir)
    return rows.select(
        "ka_nr",
        F.when(k % 13 == 0, "").otherwise(F.col("q_nr")).alias("drucksache_anfrage_nr"),
        F.col("pk").alias("drucksache_antwort_nr"),
        F.when(k % 5 == 0, "").otherwise("Muster, Eva").alias("anfrager"),
        F.when(k % 7 == 0, "").otherwise(F.col("fraktion")).alias("fraktion"),
        F.lit("Titel").alias("anfragetitel"),
        F.when(k % 3 == 0, "").otherwise(F.col("ministry")).alias("ministerium"),
        F.date_format("question_date", "yyyy-MM-dd").alias("anfragedatum"),
        F.when(k % 17 == 0, "anfrage_zurueckgezogen").otherwise(F.col("status")).alias("antworttext_status"),
        F.lit("").alias("ministerium_canonical"),
        F.when(k % 6 == 0, F.concat(F.lit("N"), F.regexp_extract("ministry", r"(\d+)", 1))).otherwise("").alias("ministerium_kuerzel"),
        F.lit("keep").alias("fraktion_canonical"),
        F.lit("").alias("beteiligte_ministerien_kuerzel"),
        F.lit("missing_anfrager,kept").alias("extract_flags"),
    )


FACTIONS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
TABLE = ANSWERED + """,
tab AS (
    SELECT ka_nr, ka_nr % 13 = 0 AS no_nr, ka_nr % 13 <> 0 AND pk = q_nr AS ph, ka_nr % 5 = 0 AS no_asker, ka_nr % 7 = 0 AS no_faction, fraktion,
        CASE WHEN ka_nr % 3 = 0 THEN '' ELSE ministry END AS prose, CASE WHEN ka_nr % 6 = 0 THEN 'N' || regexp_extract(ministry, '(\\d+)', 1) ELSE '' END AS code,
        ka_nr % 17 = 0 AS withdrawn, CAST(regexp_extract(ministry, '(\\d+)', 1) AS INTEGER) AS nation
    FROM ans
)"""
FLAGS = """CASE WHEN no_nr THEN 'missing_drucksache_anfrage_nr' END, CASE WHEN no_asker THEN 'missing_anfrager' END, CASE WHEN no_faction THEN 'missing_fraktion' END,
    CASE WHEN NOT (withdrawn OR ph) AND prose = '' AND {code} = '' AND {name} = '' THEN 'missing_ministerium' END,
    CASE WHEN NOT no_faction AND fraktion NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'novel_fraktion' END"""


@query("q1_flags", f"WITH {TABLE} SELECT ka_nr, concat_ws(',', {FLAGS.format(code='code', name=chr(39) * 2)}) AS flags FROM tab")
def q1(spark, sf_dir):
    return _table(spark, sf_dir).select("ka_nr", F.array_join(q.row_flags(FACTIONS), ",").alias("flags"))


# Nations by n_nationkey % 4 -- 0: has a name of its own; 1: its code is an alias of the one before;
# 2: its prose is overridden to its code, which has a name; 3: nothing, so the name with its tokens counts,
# which is that of nation 10, as names here differ in digits alone and longer ones win.
@query("q2_normalize", f"""WITH {TABLE}, m AS (
    SELECT *, CASE WHEN code <> '' THEN CASE WHEN nation % 4 IN (0, 2) THEN 'NATION_' || nation WHEN nation % 4 = 1 THEN 'NATION_' || (nation - 1) ELSE '' END
        WHEN prose <> '' AND nation % 4 = 2 THEN 'NATION_' || nation WHEN prose <> '' AND nation % 4 = 3 THEN 'NATION_10' ELSE '' END AS name,
        CASE WHEN code <> '' THEN code WHEN prose <> '' AND nation % 4 = 2 THEN 'N' || nation WHEN prose <> '' AND nation % 4 = 3 THEN 'N10' ELSE '' END AS kz FROM tab)
SELECT ka_nr, kz AS ministerium_kuerzel, name AS ministerium_canonical, CASE WHEN no_faction THEN 'keep' WHEN fraktion IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN fraktion ELSE '' END AS fraktion_canonical,
    kz AS beteiligte_ministerien_kuerzel, CAST(kz <> '' AS INTEGER) AS beteiligte_ministerien,
    concat_ws(',', 'kept', {FLAGS.format(code="kz", name="name")}, CASE WHEN prose <> '' AND name = '' THEN 'novel_ministerium' END, CASE WHEN kz <> '' AND name = '' THEN 'unknown_ministerium_kuerzel' END) AS extract_flags FROM m""")
def q2(spark, sf_dir):
    nations = adapter.read(spark, sf_dir, "nation")
    code = F.concat(F.lit("N"), "n_nationkey")
    names = nations.where("n_nationkey % 4 in (0, 2)").select(code.alias("code"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("position"))
    aliases = nations.where("n_nationkey % 4 = 1").select(code.alias("alias"), F.concat(F.lit("N"), F.col("n_nationkey") - 1).alias("primary"))
    overrides = nations.where("n_nationkey % 4 = 2").select(F.col("n_name").alias("raw"), code.alias("code"))
    blocked = nations.where("n_nationkey % 4 < 2").select(F.col("n_name").alias("raw"), F.lit("unknown").alias("code"))
    out = q.normalise(_table(spark, sf_dir), names, aliases, overrides.unionByName(blocked), FACTIONS)
    return out.select("ka_nr", "ministerium_kuerzel", "ministerium_canonical", "fraktion_canonical", "beteiligte_ministerien_kuerzel", "beteiligte_ministerien", "extract_flags")


@query("q9_gaps", """WITH s AS (SELECT DISTINCT CAST(o_orderkey % 2 + 17 AS INTEGER) AS wp, o_orderkey // 2 AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 9 <> 0),
g AS (SELECT wp, n, coalesce(lag(n) OVER (PARTITION BY wp ORDER BY n), 0) AS p FROM s WHERE n >= 1) SELECT wp, p + 1 AS "from", n - 1 AS "to" FROM g WHERE n > p + 1""")
def q9(spark, sf_dir):
    rows = _numbered(spark, sf_dir)
    return q.gaps(rows, "wp", "n")


@query("set3_missing_numbers", """WITH s AS (SELECT DISTINCT CAST(o_orderkey % 2 + 17 AS INTEGER) AS wp, o_orderkey // 2 AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 9 <> 0),
m AS (SELECT wp, max(n) AS top FROM s GROUP BY wp) SELECT wp, n FROM (SELECT wp, unnest(generate_series(1, top)) AS n FROM m) EXCEPT SELECT wp, n FROM s""")
def set3(spark, sf_dir):
    return q.missing_numbers(_numbered(spark, sf_dir), "wp", "n")


def _numbered(spark, sf_dir):
    orders = adapter.read(spark, sf_dir, "orders").where("o_orderkey % 9 <> 0")
    answered = orders.join(adapter.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return answered.select((F.col("o_orderkey") % 2 + 17).cast("int").alias("wp"), F.floor(F.col("o_orderkey") / 2).alias("n"))


@query("q10_duplicates", """SELECT l_orderkey, l_linenumber, count(*) AS n, array_to_string(list_slice(list_sort(list(l_partkey || '')), 1, 10), ',') AS pks FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def q10(spark, sf_dir):
    rows = adapter.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("l_partkey"))
    return q.duplicates(rows, ["l_orderkey", "l_linenumber"], "l_partkey")


@query("q11_malformed", f"WITH {INQUIRIES} SELECT ka_nr FROM inq WHERE ka_nr % 10 = 3")
def q11(spark, sf_dir):
    pk = F.when(F.col("ka_nr") % 10 == 3, "18-5").when(F.col("ka_nr") % 10 == 7, "").otherwise(F.col("q_nr"))
    return q.malformed(adapter.inquiries(spark, sf_dir).withColumn("pk", pk), "pk").select("ka_nr")


@query("q12_negative_time", f"WITH {PAIRS} SELECT {KEYS} FROM judged WHERE gap < 0")
def q12(spark, sf_dir):
    return q.negative_time(_pairs(spark, sf_dir), "pdf", "db").select("l_orderkey", "l_linenumber", "l_partkey")


@query("q13_short_text", "SELECT key FROM (SELECT doc_id AS key FROM documents UNION SELECT c_custkey FROM customer) LEFT JOIN documents ON doc_id = key WHERE coalesce(strlen(text) < 200, true)")
def q13(spark, sf_dir):
    """All documents; customers whose number no document has lack a text."""
    texts = adapter.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    rows = texts.select("key").union(adapter.read(spark, sf_dir, "customer").select("c_custkey")).distinct()
    return q.short_texts(rows, texts, "key").select("key")


@query("q14_number_in_text", f"WITH {INQUIRIES} SELECT ka_nr FROM inq WHERE ka_nr % 4 = 3 AND ka_nr % 9 <> 0 AND ka_nr % 11 <> 0")
def q14(spark, sf_dir):
    """Every ninth text is too short to be judged, every seventh has its characters doubled, every eleventh row has no number."""
    k = F.col("ka_nr")
    text = F.when(k % 4 == 0, F.concat(F.lit("die Kleine Anfrage "), k, F.lit("."))).when(k % 4 == 1, F.concat(F.lit("Anfrage "), k, F.lit("vom"))).when(k % 4 == 2, F.concat(F.lit("Kleine  Anfrage"), k, F.lit(" vom"))).otherwise(F.concat(F.lit("Kleine Anfrage "), k + 1, F.lit("8 ")))
    whole = F.concat(F.lit("Antwort der Landesregierung in der Sache auf die Frage: "), text, F.repeat(F.lit(" Text."), F.when(k % 9 == 0, 1).otherwise(40)))
    whole = F.when((k % 7 == 0) & (k % 9 != 0), F.regexp_replace(whole, r"(\S)", "$1$1")).otherwise(whole)
    rows = adapter.inquiries(spark, sf_dir).withColumns({"text": whole, "number": F.when(k % 11 != 0, k)})
    return q.lacks_number(rows, "text", "number").select("ka_nr")


@query("q17_verify_report", f"""WITH {INQUIRIES}, x AS (SELECT 'malformed' AS "check", ka_nr || '' AS key FROM inq WHERE ka_nr % 10 = 3 UNION ALL SELECT 'orphans', o_orderkey || '' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
SELECT "check", count(*) AS total, array_to_string(list_slice(list_sort(list(key)), 1, 10), ',') AS listed FROM x GROUP BY 1""")
def q17(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir)
    bad = q.malformed(rows.withColumn("pk", F.when(F.col("ka_nr") % 10 == 3, "18-5").otherwise(F.col("q_nr"))), "pk")
    lines = adapter.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    lost = adapter.read(spark, sf_dir, "orders").join(lines, "o_orderkey", "left_anti").select(F.col("o_orderkey").alias("ka_nr"))
    return q.report({"malformed": bad, "orphans": lost}, "ka_nr")
