"""Stored tables: dimensions, letters, verification and targeted searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter, sinks, sources, streaming
from ..functions import text as t
from ..operators import keyed as k
from ..operators.extract import next_page
from ..operators import quality as q
from ..plans import reports
from .common import BASE, BLOCK, INQUIRIES, MEMBERS
from .registry import registry

QUERIES, SQL, query = registry()


@query("fn18_least_askers", f"""WITH {INQUIRIES}, {MEMBERS}, n AS (SELECT ka_nr, count(*) AS n FROM members GROUP BY 1)
SELECT ka_nr, CAST(CASE WHEN ka_nr % 4 = 0 THEN 0 WHEN ka_nr % 3 = 0 AND n >= 2 THEN n + 1 ELSE n END AS INTEGER) AS least FROM inq JOIN n USING (ka_nr)""")
def fn18(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir).join(adapter.members(spark, sf_dir), "ka_nr")
    named = F.array_join(F.transform(F.split("members", "; "), lambda m: F.concat(m, F.lit(", Eva"))), "; ")
    listed = F.when(F.col("ka_nr") % 4 == 0, "").when(F.col("ka_nr") % 3 == 0, F.concat(named, F.lit(" u.a."))).otherwise(named)
    return rows.select("ka_nr", t.least_askers(listed).alias("least"))


@query("src4_src5_src7_dimensions", """SELECT 'faction' AS kind, c_mktsegment AS a, CAST(NULL AS VARCHAR) AS b FROM (SELECT DISTINCT c_mktsegment FROM customer)
UNION ALL SELECT 'ministry', 'N' || n_nationkey, n_name FROM nation WHERE n_nationkey % 5 <> 0 UNION ALL SELECT 'override', n_name, 'N' || n_nationkey FROM nation WHERE n_nationkey % 4 <> 0""")
def dimensions(spark, sf_dir):
    """Factions repeat; some ministries and overrides lack a name or a code."""
    nations = adapter.read(spark, sf_dir, "nation")
    code, n = F.concat(F.lit("N"), "n_nationkey"), F.col("n_nationkey")
    factions = sources.factions(adapter.read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("Fraktion")))
    ministries = sources.ministries(nations.select(code.alias("Kürzel"), F.when(n % 5 != 0, F.col("n_name")).alias("Ministerium"), F.lit("").alias("Aliases")))
    overrides = sources.overrides(nations.select(F.concat(F.lit(" "), "n_name").alias("Raw"), F.when(n % 4 != 0, F.concat(code, F.lit(" "))).otherwise("").alias("Kuerzel")))
    none = F.lit(None).cast("string")
    rows = factions.select(F.lit("faction").alias("kind"), F.col("fraktion").alias("a"), none.alias("b"))
    return rows.unionByName(ministries.select(F.lit("ministry").alias("kind"), F.col("code").alias("a"), F.col("name").alias("b"))).unionByName(overrides.select(F.lit("override").alias("kind"), F.col("raw").alias("a"), F.col("code").alias("b")))


@query("src8_member_lexicon", "SELECT CAST(17 AS INTEGER) AS wp, n_name AS fraktion, 'Eva ' || s_name AS form, s_name AS nach, 'Eva' AS vor FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 <> 0")
def src8(spark, sf_dir):
    rows = adapter.read(spark, sf_dir, "supplier").join(F.broadcast(adapter.read(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # a table of countries
    form = F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("Eva "), "s_name"))
    return sources.members(rows.select(F.lit("17").alias("WP"), F.col("n_name").alias("Fraktion"), form.alias("PDF_Form"), F.col("s_name").alias("Nachname"), F.lit("Eva").alias("Vorname")))


@query("src9_letter_dates", f"""WITH {INQUIRIES}, l AS (
    SELECT q_nr, 1 AS line, CASE WHEN ka_nr % 5 <> 0 THEN question_date END AS d, CASE WHEN ka_nr % 3 = 0 THEN 'no_match' WHEN ka_nr % 4 = 0 THEN 'OK' ELSE 'ok' END AS status FROM inq
    UNION ALL SELECT q_nr, 2, question_date + 7, CASE WHEN ka_nr % 7 = 0 THEN 'ok' ELSE 'parse_failed' END FROM inq WHERE ka_nr % 2 = 0
), k AS (SELECT q_nr, d, row_number() OVER (PARTITION BY q_nr ORDER BY line DESC) AS k FROM l WHERE status = 'ok' AND d IS NOT NULL)
SELECT q_nr AS paper, 'Anfrage' AS kind, strftime(d, '%Y-%m-%d') AS date FROM k WHERE k = 1""")
def src9(spark, sf_dir):
    """Every other letter stands in a second line, some of them read well; 'OK' is not the mark of a good reading."""
    n = F.col("ka_nr")
    rows = adapter.inquiries(spark, sf_dir).select(
        F.col("q_nr").alias("Drucksache_Nr"),
        F.lit("Anfrage").alias("Anfrage_oder_Antwort"),
        F.when(n % 5 == 0, "").otherwise(F.date_format("question_date", "yyyy-MM-dd")).alias("Datum_Original"),
        F.when(n % 3 == 0, "no_match").when(n % 4 == 0, "OK").otherwise("ok").alias("Status"),
        F.lit(1).alias("_line"),
    )
    second = adapter.inquiries(spark, sf_dir).where("ka_nr % 2 = 0").select(
        F.col("q_nr").alias("Drucksache_Nr"),
        F.lit("Anfrage").alias("Anfrage_oder_Antwort"),
        F.date_format(F.date_add("question_date", 7), "yyyy-MM-dd").alias("Datum_Original"),
        F.when(n % 7 == 0, "ok").otherwise("parse_failed").alias("Status"),
        F.lit(2).alias("_line"),
    )
    return sources.letter_dates(rows.unionByName(second))


@query("src6_aliases", """WITH a AS (SELECT n_nationkey AS n, 'N' || n_nationkey AS code, unnest(['A' || n_nationkey, 'A' || (n_nationkey + 1)]) AS alias FROM nation WHERE n_nationkey % 5 <> 0)
SELECT alias, arg_max(code, n) AS "primary" FROM a GROUP BY alias""")
def src6(spark, sf_dir):
    """Each code lists its own alias and its successor's, so most aliases stand in two lines; some lines have no code."""
    n = F.col("n_nationkey")
    sheet = adapter.read(spark, sf_dir, "nation").select(F.when(n % 5 != 0, F.concat(F.lit("N"), n)).alias("Kürzel"), F.concat(F.lit(" A"), n, F.lit(", ,A"), n + 1, F.lit(" ")).alias("Aliases"), n.alias("_line"))
    return sources.aliases(sheet)


@query("u7_targeted_search", f"""WITH {INQUIRIES}, x AS (SELECT *, wp || '/' || (ka_nr + 10000000) AS own FROM inq)
SELECT CASE WHEN ka_nr % 5 = 0 AND ka_nr % 2 = 0 THEN own ELSE q_nr END AS pk, CASE WHEN ka_nr % 5 = 0 THEN 'new' ELSE 'old' END AS name FROM x WHERE ka_nr % 3 <> 0 OR ka_nr % 5 = 0""")
def u7(spark, sf_dir):
    """Two thirds of the questions are stored as placeholders; every fifth one is searched for, half of those have an answer."""
    rows = adapter.inquiries(spark, sf_dir)
    table = rows.where("ka_nr % 3 <> 0").select(F.col("q_nr").alias("pk"), "q_nr", "wp", "ka_nr", F.lit("old").alias("name"), F.lit("a").alias("added_at"), F.lit("a").alias("updated_at"))
    answer = F.when(F.col("ka_nr") % 2 == 0, F.concat_ws("/", "wp", F.col("ka_nr") + 10_000_000))
    hits = rows.select(answer.alias("pk"), "q_nr", "wp", "ka_nr", F.lit("new").alias("name"), F.lit(False).alias("withdrawn"))
    return k.targeted(table, hits, rows.where("ka_nr % 5 = 0"), ["name", "q_nr", "wp", "ka_nr"], F.lit("b")).select("pk", "name")


@query("v1_verify", f"""WITH {INQUIRIES}, x AS (SELECT ka_nr AS n, true AS first FROM inq UNION ALL SELECT ka_nr, false FROM inq WHERE ka_nr % 50 = 0), y AS (SELECT *, first AND n % 9 <> 0 AS ext FROM x)
SELECT 'text_missing' AS "check", count(*) AS total FROM y WHERE ext AND n % 7 = 0 UNION ALL SELECT 'text_short', count(*) FROM y WHERE ext AND n % 7 <> 0 AND n % 11 = 0
UNION ALL SELECT 'number', count(*) FROM y WHERE ext AND n % 7 <> 0 AND n % 11 <> 0 AND n % 13 = 0 UNION ALL SELECT 'malformed', count(*) FROM y WHERE first AND n % 10 = 3
UNION ALL SELECT 'duplicates', count(*) FROM y WHERE NOT first AND n <> 0 UNION ALL SELECT 'negative_time', count(*) FROM y WHERE n % 17 = 0""")
def v1(spark, sf_dir):
    """The whole suite over a table in which each check has findings by rule."""
    n = F.col("ka_nr")
    rows = adapter.inquiries(spark, sf_dir)
    key = F.when(n % 10 == 3, F.concat(F.lit("18-"), n)).otherwise(F.concat(F.lit("18/"), n))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    table = rows.select(
        key.alias("drucksache_antwort_nr"),
        "wp",
        n.alias("kleine_anfrage_nr"),
        F.when(n % 9 == 0, "pending").otherwise("extracted").alias("antworttext_status"),
        day(F.col("question_date")).alias("anfragedatum"),
        day(F.date_add("question_date", F.when(n % 17 == 0, -1).otherwise(9))).alias("antwortdatum"),
    )
    twice = table.where("kleine_anfrage_nr % 50 = 0").withColumns({"drucksache_antwort_nr": F.concat(F.lit("19/"), "kleine_anfrage_nr"), "antworttext_status": F.lit("pending")})
    body = F.concat(F.lit("Antwort auf die Kleine Anfrage "), F.when(n % 13 == 0, 0).otherwise(n), F.lit(" vom 1. Mai."), F.repeat(F.lit(" Text."), F.when(n % 11 == 0, 1).otherwise(40)))
    texts = rows.where("ka_nr % 7 <> 0").select(key.alias("drucksache_antwort_nr"), body.alias("text"), F.lit(1).alias("position"))
    texts = texts.unionByName(texts.withColumns({"text": F.lit("an earlier, short text"), "position": F.lit(0)}))
    findings = q.verify(table.unionByName(twice), texts)
    return q.report(findings, "drucksache_antwort_nr").select("check", "total")


@query("fn9_document_urls", f"""WITH {INQUIRIES}, u AS (SELECT ka_nr, CASE WHEN ka_nr % 13 <> 0 THEN 'https://www.landtag.nrw.de/portal/WWW/dokumentenarchiv/Dokument/MMD' || replace(q_nr, '/', '-') || '.pdf' END AS url FROM inq)
SELECT ka_nr, url, ka_nr % 13 <> 0 AND ka_nr % 4 NOT IN (1, 2) AS allowed FROM u""")
def fn9(spark, sf_dir):
    """Addresses by the template; some papers are malformed, some links are relative, elsewhere, or go on behind the document."""
    n, paper = F.col("ka_nr"), F.when(F.col("ka_nr") % 13 == 0, F.replace("q_nr", F.lit("/"), F.lit("-"))).otherwise(F.col("q_nr"))
    rows = adapter.inquiries(spark, sf_dir).select("ka_nr", t.document_url(paper).alias("url"))
    link = F.when(n % 4 == 0, F.regexp_replace("url", "^https://[^/]*", "")).when(n % 4 == 1, F.regexp_replace("url", "landtag.nrw", "elsewhere")).when(n % 4 == 2, F.concat("url", F.lit("?x"))).otherwise(F.col("url"))
    return rows.select("ka_nr", "url", t.may_fetch(t.absolute(link)).alias("allowed"))


@query("src17_next_pages", """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://www.landtag.nrw.de/suche.html?page=' || (page_id + 1) WHEN 1 THEN url END AS next FROM pages""")
def src17(spark, sf_dir):
    """Saved pages with a relative link to the next one, an absolute one, a disabled one, or none."""
    n = F.col("page_id")
    anchor = (
        F.when(n % 4 == 0, F.concat(F.lit('<a class="item item--next" href="/suche.html?page='), n + 1, F.lit('">weiter</a>')))
        .when(n % 4 == 1, F.concat(F.lit('<a rel="x" class="item--next item" href="'), "url", F.lit('">weiter</a>')))
        .when(n % 4 == 2, F.lit('<a class="item--next item--disabled" href="/suche.html?page=9">weiter</a>'))
        .otherwise("")
    )
    rows = adapter.read(spark, sf_dir, "pages")
    return rows.select("page_id", next_page(F.concat(F.coalesce("html", F.lit("")), anchor)).alias("next"))


@query("snk4_bucketed_texts", "SELECT ((doc_id + 1 - 1) // 2000 * 2000 + 1) || '-' || ((doc_id + 1 - 1) // 2000 * 2000 + 2000) AS bucket, count(*) AS n, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS characters FROM documents GROUP BY 1")
def snk4(spark, sf_dir):
    """Texts written below the folder of their number, and read back with it."""
    folder = f"{streaming.scratch(spark)}/texts"
    rows = adapter.read(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("number"), F.coalesce("text", F.lit("")).alias("text"))
    sinks.save_texts(rows, folder, "number")
    return spark.read.parquet(folder).groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("characters"))


@query("snk3_audit_log", f"WITH {INQUIRIES} SELECT 'first' AS run_at, status AS what, count(*) AS n FROM inq GROUP BY status UNION ALL SELECT 'second', fraktion, count(*) FROM inq GROUP BY fraktion")
def snk3(spark, sf_dir):
    """Two runs append to one log."""
    folder = f"{streaming.scratch(spark)}/audit"
    rows = adapter.inquiries(spark, sf_dir)
    for run, column in (("first", "status"), ("second", "fraktion")):
        sinks.append_audit(rows.select("ka_nr", F.col(column).alias("what")), folder, F.lit(run))
    return spark.read.parquet(folder).groupBy("run_at", "what").agg(F.count("*").alias("n"))


@query("snk10_report_files", f"WITH {BASE} SELECT wp, fraktion, {BLOCK} FROM base GROUP BY ALL")
def snk10(spark, sf_dir):
    """A report written as CSV, a folder for each term, and read back."""
    folder = f"{streaming.scratch(spark)}/report"
    sinks.save_report(reports.sla(adapter.base(spark, sf_dir), "wp", "fraktion"), folder, "wp")
    kinds = "fraktion string, anzahl long, zeit double, verspaetet long, quote double, wp int"
    return spark.read.option("header", True).schema(kinds).csv(folder)
