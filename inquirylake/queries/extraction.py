"""Extraction: documents are rendered from the question table, and the fields are recovered."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter, sources, streaming
from ..functions.dates import MONTHS
from ..operators import extract as x
from ..operators import joins as j
from ..operators import keyed as k
from ..sources.search import saved_pages
from ..streaming import archive, versions
from .common import INQUIRIES, MEMBERS
from .registry import registry

QUERIES, SQL, query = registry()

FACTIONS = ["CDU", "SPD", "GRÜNE", "FDP", "AfD"]
SQL_FACTION = "['CDU', 'SPD', 'GRÜNE', 'FDP', 'AfD'][CAST(ka_nr % 5 AS INTEGER) + 1]"


def _worded(date):
    return F.concat(F.dayofmonth(date), F.lit(". "), F.element_at(F.array(*map(F.lit, MONTHS)), F.month(date)), F.lit(" "), F.year(date))


def _rows(spark, sf_dir):
    k_ = F.col("ka_nr")
    rows = adapter.inquiries(spark, sf_dir, costly=True)
    return rows.withColumns({"party": F.array(*map(F.lit, FACTIONS))[(k_ % 5).cast("int")], "issued": F.date_add("question_date", 20)})


def _page():
    """The first page of an answer."""
    q = F.col("question_date")
    return F.concat(
        F.lit("LANDTAG NORDRHEIN-WESTFALEN\nDrucksache "), "a_nr", F.lit("\n\nAntwort der Landesregierung\nauf die Kleine Anfrage "), "ka_nr", F.lit(" vom "), _worded(q),
        F.lit("\ndes Abgeordneten  Max   Muster "), "party", F.lit("\nDrucksache "), "q_nr", F.lit("\n\nTitel der  Frage\nNummer "), "ka_nr", F.lit("\n\nVorbemerkung der Kleinen Anfrage\nText.\n\nDer Minister für "),
        "ministry", F.lit(" und\nKultur hat die Kleine Anfrage "), "ka_nr", F.lit(" mit Schreiben vom "), _worded(F.col("issued")), F.lit(" namens der Landesregierung im Einvernehmen mit dem Minister des Innern und der Ministerin der Finanzen beantwortet.\nAusgegeben: "), F.date_format("issued", "dd.MM.yyyy"),
    )


@query("x1_page_fields", f"""WITH {INQUIRIES} SELECT a_nr AS drucksache_antwort_nr, CAST(ka_nr AS INTEGER) AS kleine_anfrage_nr, strftime(question_date, '%Y-%m-%d') AS anfragedatum, 'Max Muster' AS anfrager,
    {SQL_FACTION} AS fraktion, q_nr AS drucksache_anfrage_nr, strftime(question_date + 20, '%Y-%m-%d') AS antwortdatum, 'Titel der Frage Nummer ' || ka_nr AS anfragetitel, 'Minister ' || ministry || ' und Kultur' AS ministerium, true AS answer, false AS large FROM inq""")
def x1(spark, sf_dir):
    pages = _rows(spark, sf_dir).select(_page().alias("page"))
    flagged = pages.withColumns({"answer": x.is_answer(F.col("page")), "large": x.is_large_inquiry(F.col("page"))})
    return x.page_fields(flagged, "page").drop("page")


@query("src10_archive_stream", f"""WITH {INQUIRIES}, c AS (SELECT *, ka_nr % 11 <> 0 AS known, ka_nr % 7 = 0 AS withdrawn, ka_nr % 5 = 0 AS complete, ka_nr % 3 = 0 AS silent FROM inq),
a AS (SELECT *, NOT withdrawn AND NOT complete AND NOT silent AS parsed FROM c WHERE known)
SELECT a_nr AS drucksache_antwort_nr, CASE WHEN complete THEN 'alt' WHEN parsed THEN 'Titel der Frage Nummer ' || ka_nr END AS anfragetitel, CASE WHEN complete THEN 'alt' WHEN parsed THEN 'Minister ' || ministry || ' und Kultur' END AS ministerium,
    CASE WHEN parsed THEN 'local' END AS antworttext_quelle, CASE WHEN withdrawn THEN 'anfrage_zurueckgezogen' ELSE 'pending' END AS antworttext_status, CASE WHEN parsed THEN 'keep' ELSE 'keep,missing_anfragetitel' END AS extract_flags FROM a""")
def src10(spark, sf_dir):
    """A table, and documents of all its rows and of others in a stream of several batches; some rows are
    withdrawn or complete, some documents are questions.  What the table knows isn't overwritten."""
    n, folder = F.col("ka_nr"), streaming.scratch(spark)
    rows = _rows(spark, sf_dir)
    done = F.when(n % 5 == 0, "alt")
    table = rows.where("ka_nr % 11 <> 0").select(
        F.col("a_nr").alias("drucksache_antwort_nr"), "wp", n.cast("int").alias("kleine_anfrage_nr"), F.col("q_nr").alias("drucksache_anfrage_nr"), F.lit("Muster, Eva").alias("anfrager"), F.lit("SPD").alias("fraktion"), F.lit("2020-01-01").alias("anfragedatum"),
        done.alias("anfragetitel"), F.lit("").alias("antwortdatum"), done.alias("ministerium"), F.lit("").alias("ministerium_kuerzel"), F.lit("").alias("ministerium_canonical"), F.when(n % 7 == 0, "anfrage_zurueckgezogen").otherwise("pending").alias("antworttext_status"),
        F.lit(None).cast("string").alias("antworttext_quelle"), F.lit("keep,missing_anfragetitel").alias("extract_flags"), F.lit("a").alias("added_at"), F.lit("a").alias("updated_at"),
    )
    versions.replace(table, f"{folder}/table", archive.KEY, 200_000)
    page = F.when(n % 3 == 0, F.concat(F.lit("LANDTAG NORDRHEIN-WESTFALEN\nKleine Anfrage "), n, F.lit("\ndes Abgeordneten Max Muster"))).otherwise(_page())
    texts = rows.select(F.concat(F.lit("archive/MMD"), F.replace("a_nr", F.lit("/"), F.lit("-")), F.lit(".md")).alias("path"), page.alias("text"))
    half = -(-texts.rdd.getNumPartitions() // 2)  # two batches, of as many files as there are tasks
    texts.repartition(2 * half).write.parquet(f"{folder}/documents")
    stream = spark.readStream.schema("path string, text string").option("maxFilesPerTrigger", half).parquet(f"{folder}/documents")
    archive.scan(stream, f"{folder}/table", f"{folder}/mark", f"{folder}/audit", width=200_000).awaitTermination()
    return versions.read(spark, f"{folder}/table").select("drucksache_antwort_nr", "anfragetitel", "ministerium", "antworttext_quelle", "antworttext_status", "extract_flags")


@query("x2_header_fields", f"""WITH {INQUIRIES} SELECT ka_nr, strftime(question_date + 20, '%Y-%m-%d') AS antwortdatum, strftime(question_date, '%Y-%m-%d') AS anfragedatum, q_nr AS drucksache_anfrage_nr,
    CASE ka_nr % 3 WHEN 0 THEN 'GRÜNE' WHEN 1 THEN 'fraktionslos' ELSE 'AfD' END AS fraktion FROM inq""")
def x2(spark, sf_dir):
    """Spaces are lost by rule, and every fourth header has all its characters doubled."""
    k_ = F.col("ka_nr")
    token = F.when(k_ % 3 == 0, "BÜNDNIS 90/DIE GRÜNEN").when(k_ % 3 == 1, "FRAKTIONSLOS").otherwise("AFD")
    lost = F.when(k_ % 2 == 0, "").otherwise(" ")
    head = F.concat(
        F.lit("LANDTAG NORDRHEIN-WESTFALEN Wahlperiode Antwort der Landesregierung auf die Kleine Anfrage "), k_, lost, F.lit("vom "), _worded(F.col("question_date")), F.lit(" der Abgeordneten Eva Muster "), token,
        F.lit("\nDrucksache"), lost, "q_nr", F.lit("\nDie Ministerin der Justiz hat die Kleine Anfrage "), k_, F.lit(" mit Schreiben vom "), _worded(F.col("issued")), F.lit(" beantwortet."),
    )
    shown = F.when(k_ % 4 == 3, F.regexp_replace(head, r"(\S)", "$1$1")).otherwise(head)
    return x.header_fields(_rows(spark, sf_dir).select("ka_nr", shown.alias("head")), "head").drop("head")


@query("x3_x4_minister_forms", f"""WITH {INQUIRIES} SELECT ka_nr, 'Minister ' || ministry || ' und Kultur' AS first, 'Minister Innern' AS second, 'Ministerin Finanzen' AS third, CAST(3 AS INTEGER) AS n FROM inq""")
def x3(spark, sf_dir):
    forms = x.minister_forms(_rows(spark, sf_dir).select("ka_nr", _page().alias("page")), "page", "f")
    return forms.select("ka_nr", *(F.get("f", F.lit(i)).alias(n) for i, n in enumerate(("first", "second", "third"))), F.size("f").alias("n"))


@query("x16_letter_date", f"""WITH {INQUIRIES} SELECT ka_nr, CASE WHEN ka_nr % 5 = 4 THEN 'no_match' ELSE 'ok' END AS status, CASE WHEN ka_nr % 5 = 4 THEN '' WHEN ka_nr % 5 = 2 AND month(question_date) = 2 AND day(question_date) = 29 THEN strftime(question_date - 1, '%Y-%m-%d') ELSE strftime(question_date, '%Y-%m-%d') END AS original,
    CASE WHEN ka_nr % 5 IN (3, 4) THEN '' ELSE strftime(question_date + 7, '%Y-%m-%d') END AS issued FROM inq""")
def x16(spark, sf_dir):
    """Plain, with a space for a dot, a year too small, without issue date, and without any date."""
    q, k_ = F.col("question_date"), F.col("ka_nr") % 5
    rows = adapter.inquiries(spark, sf_dir)
    original = F.when(k_ == 1, F.date_format(q, "dd MM.yyyy")).when(k_ == 2, F.date_format(F.add_months(q, -12), "dd.MM.yyyy")).otherwise(F.date_format(q, "dd.MM.yyyy"))
    issued = F.when(k_ == 3, "").otherwise(F.concat(F.lit("/Ausgegeben: "), F.date_format(F.date_add(q, 7), "dd.MM.yyyy")))
    page = F.when(k_ == 4, "Datum unbekannt").otherwise(F.concat(F.lit("Kopf\nDatum des Originals: "), original, issued))
    return x.letter_date(rows.select("ka_nr", page.alias("page")), "page").select("ka_nr", "status", "original", "issued")


@query("x6_involved_ministries", f"""WITH {INQUIRIES} SELECT ka_nr, CASE WHEN ka_nr % 4 = 0 THEN 'IM,FM' ELSE 'LEAD,IM,FM' END AS codes, CAST(CASE WHEN ka_nr % 4 = 0 THEN 2 ELSE 3 END AS INTEGER) AS n FROM inq""")
def x6(spark, sf_dir):
    """The lead's code first, mapped if it is an alias, then each form's; unknown forms stay out."""
    rows = _rows(spark, sf_dir).withColumn("lead", F.when(F.col("ka_nr") % 4 == 0, "MI").otherwise("LEAD"))
    forms = x.minister_forms(rows.select("ka_nr", _page().alias("page")), "page").select("ka_nr", F.posexplode_outer("forms").alias("at", "form"))  # the other kind finds forms once more to filter by them
    forms = streaming.stored(forms.where("form is not null"))
    names = spark.createDataFrame([("FM", "Ministerium der Finanzen", 1), ("IM", "Ministerium des Innern", 2)], "code string, name string, position int")
    resolved = j.subset_match(forms, "form", names).where("code is not null")
    listed = resolved.groupBy("ka_nr").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda r: r["code"]).alias("c"))
    aliases = spark.createDataFrame([("MI", "IM")], "lead string, primary string")
    out = rows.join(F.broadcast(aliases), "lead", "left").join(listed, "ka_nr", "left")  # one alias
    codes = F.array_distinct(F.concat(F.array(F.coalesce("primary", "lead")), F.coalesce("c", F.array().cast("array<string>"))))
    return out.select("ka_nr", F.array_join(codes, ",").alias("codes"), F.size(codes).alias("n"))


@query("x7_x12_search_hits", f"""WITH {INQUIRIES} SELECT ka_nr, CAST(0 AS INTEGER) AS hit, 'Frage zur Kleinen Anfrage 941 & AfD' AS anfragetitel, wp, q_nr AS drucksache_anfrage_nr,
    'https://www.landtag.nrw.de/MMD' || replace(q_nr, '/', '-') || '.pdf' AS link_drucksache_anfrage, a_nr AS drucksache_antwort_nr, 'https://other.example/MMD' || replace(a_nr, '/', '-') || '.pdf' AS link_drucksache_antwort,
    CAST(ka_nr AS INTEGER) AS kleine_anfrage_nr, 'Muster, Eva u.a.' AS anfrager, {SQL_FACTION} AS fraktion, strftime(question_date, '%Y-%m-%d') AS anfragedatum, strftime(question_date + 20, '%Y-%m-%d') AS antwortdatum,
    CASE WHEN ka_nr % 3 = 0 THEN '' ELSE 'MBEIM' END AS ministerium_kuerzel, CASE WHEN ka_nr % 3 = 0 THEN 'anfrage_zurueckgezogen' ELSE '' END AS antworttext_status, 'Schule; Kultur' AS systematik,
    'Lehrer; Mangel' || CASE WHEN ka_nr % 3 = 0 THEN ' Unterrichtung Präs Drucksache ' || a_nr || ' ' || strftime(question_date + 20, '%d.%m.%Y') || ' 5 S.' ELSE '' END AS schlagworte FROM inq""")
def x7(spark, sf_dir):
    q = F.col("question_date")
    link = lambda nr: F.concat(F.lit("MMD"), F.replace(nr, F.lit("/"), F.lit("-")), F.lit(".pdf"))
    answer = F.when(F.col("ka_nr") % 3 == 0, F.lit("<p>Unterrichtung Präs</p>")).otherwise(F.lit("<p>Antwort MBEIM</p>"))
    html = F.concat(
        F.lit('<html><article class="e-search-result"><div class="e-search-result__body"><b>Frage zur\n Kleinen Anfrage 941 &amp; AfD</b><p>Kleine Anfrage '), "ka_nr", F.lit("</p><p>Muster, Eva u.a. "), "party",
        F.lit('</p><p>Antwort BT-Drs. 17/8134</p><a href="/'), link(F.col("q_nr")), F.lit('">Drucksache '), "q_nr", F.lit("</a><p>"), F.date_format(q, "dd.MM.yyyy"), F.lit(" 2 S.</p><p>Systematik:</p><p>Schule * Kultur</p><p>Schlagworte:</p><p>Lehrer * Mangel</p>"),
        answer, F.lit('<a href="https://other.example/'), link(F.col("a_nr")), F.lit('">Drucksache '), "a_nr", F.lit("</a><p>"), F.date_format("issued", "dd.MM.yyyy"), F.lit(" 5 S.</p></div></article></html>"),
    )
    return x.search_hits(_rows(spark, sf_dir).select("ka_nr", html.alias("html")))


@query("src15_saved_search", f"""WITH {INQUIRIES} SELECT CAST(wp AS VARCHAR) AS term, ka_nr // 2000 + 1 AS page, q_nr AS drucksache_anfrage_nr, CASE WHEN ka_nr % 2 = 0 THEN a_nr END AS drucksache_antwort_nr, CAST(ka_nr AS INTEGER) AS kleine_anfrage_nr, strftime(question_date, '%Y-%m-%d') AS anfragedatum FROM inq""")
def src15(spark, sf_dir):
    """All questions as hits on saved pages, some dozens a page, each page with a link to the next one; read as a stream."""
    n, folder = F.col("ka_nr"), streaming.scratch(spark)
    link = lambda c: F.concat(F.lit("portal/WWW/dokumentenarchiv/Dokument/MMD"), F.replace(c, F.lit("/"), F.lit("-")), F.lit(".pdf"))
    answer = F.when(n % 2 == 0, F.concat(F.lit('<a href="/'), link(F.col("a_nr")), F.lit('">Drucksache '), "a_nr", F.lit("</a><p>"), F.date_format("issued", "dd.MM.yyyy"), F.lit(" 5 S.</p>"))).otherwise("")
    hit = F.concat(
        F.lit('<article class="e-search-result"><div><b>Frage</b><p>Kleine Anfrage '), n, F.lit("</p><p>Muster, Eva "), "party", F.lit('</p><a href="/'), link(F.col("q_nr")), F.lit('">Drucksache '), "q_nr", F.lit("</a><p>"), F.date_format("question_date", "dd.MM.yyyy"),
        F.lit(" 2 S.</p>"), answer, F.lit("</div></article>"),
    )
    rows = _rows(spark, sf_dir).select(F.col("wp").cast("string").alias("term"), (F.floor(n / 2000) + 1).alias("page"), hit.alias("hit"))
    ends = rows.groupBy("term").agg(F.max("page").alias("last"))
    pages = rows.groupBy("term", "page").agg(F.concat_ws("", F.collect_list("hit")).alias("html")).join(ends, "term")
    tag = F.when(F.col("page") < F.col("last"), F.concat(F.lit('<a class="item--next" href="/s.html?page='), F.col("page") + 1, F.lit('">'))).otherwise('<a class="item--next item--disabled" href="/s.html?page=1">')
    pages.select("term", "page", F.concat("html", tag).alias("value")).repartition("term", "page").write.partitionBy("term", "page").text(f"{folder}/pages")
    stream = saved_pages(spark, f"{folder}/pages").writeStream.format("parquet").option("path", f"{folder}/read").option("checkpointLocation", f"{folder}/mark").trigger(availableNow=True).start()
    stream.awaitTermination()
    hits = x.search_hits(spark.read.schema("term string, page long, html string").parquet(f"{folder}/read"))
    return hits.select("term", "page", "drucksache_anfrage_nr", "drucksache_antwort_nr", "kleine_anfrage_nr", "anfragedatum")


def _names(spark, sf_dir):
    """ka_nr, wp, fraktion and suppliers as people: 'Nach<i>, Vor'."""
    rows = adapter.inquiries(spark, sf_dir).join(adapter.members(spark, sf_dir), "ka_nr")
    people = F.transform(F.split("members", "; "), lambda s: F.concat(F.lit("Nach"), F.translate(F.regexp_extract(s, r"0*(\d+)$", 1), "0123456789", "abcdefghij")))
    return rows.select("ka_nr", "wp", "fraktion", people.alias("people"), "n_members")


SQL_NAME = "'Nach' || translate(CAST(CAST(regexp_extract(member, '(\\d+)$', 1) AS INTEGER) AS VARCHAR), '0123456789', 'abcdefghij')"


@query("x13_members_from_text", f"""WITH {INQUIRIES}, {MEMBERS} SELECT ka_nr, string_agg({SQL_NAME} || ', Eva', '; ' ORDER BY member) AS anfrager_alle, CAST(count(*) AS INTEGER) AS anzahl_abgeordnete, 'Frank' AS rest FROM inq JOIN members USING (ka_nr) GROUP BY ka_nr""")
def x13(spark, sf_dir):
    """Names are rendered into a block of askers, some spaces lost, and found again by the lexicon."""
    shown = F.concat(F.lit("auf die Kleine Anfrage der AbgeordnetenFrank und "), F.array_join(F.transform("people", lambda n: F.concat(F.lit("Eva"), n)), ", "), F.lit(" CDU\nDrucksache 18/1"))
    text = F.regexp_replace(shown, r"Eva(?=N)", "Eva ")
    rows = streaming.stored(_names(spark, sf_dir).withColumn("block", x.first_block(text)))
    forms = rows.select("wp", "fraktion", F.explode("people").alias("nach")).distinct().select("wp", "fraktion", F.concat(F.lit("Eva "), "nach").alias("form"), "nach", F.lit("Eva").alias("vor"))
    found = x.names_found(rows, forms, F.col("block"), ["wp", "fraktion"])
    return found.select("ka_nr", "anfrager_alle", "anzahl_abgeordnete", "rest")


@query("x14_remediate", f"""WITH {INQUIRIES} SELECT ka_nr, CASE ka_nr % 8 WHEN 0 THEN 'Vogel, Nic' WHEN 1 THEN 'Vogel, Nic; Neppe, Frank' WHEN 2 THEN '' WHEN 3 THEN 'Vogel, Nic; Neppe, Frank' WHEN 4 THEN 'Vogel, Nic' WHEN 7 THEN 'Vogel, Nic; Neppe, Frank' ELSE '' END AS names,
    CASE ka_nr % 8 WHEN 0 THEN 'anfrager_manual' WHEN 1 THEN 'anfrager_manual,anfrager_cross_fraktion' WHEN 2 THEN 'anfrager_manual' WHEN 3 THEN 'anfrager_manual,anfrager_from_db' WHEN 4 THEN 'anfrager_unverified'
        WHEN 6 THEN 'anfrager_unverified' WHEN 7 THEN 'anfrager_manual,anfrager_cross_fraktion' ELSE '' END AS tag FROM inq""")
def x14(spark, sf_dir):
    """0: enough; 1: enough across factions; 2: withdrawn; 3: the table's names; 4: too few; 5: done before;
    6: no name and none asked for; 7: enough for the table, but the log asks for more."""
    c = F.col("ka_nr") % 8
    text = (
        F.when(c.isin(1, 7), "der Abgeordneten Nic Vogel AfD und Frank Neppe FRAKTIONSLOS\nDrucksache")
        .when(c == 6, "des Abgeordneten Niemand AfD\nDrucksache")
        .otherwise("des Abgeordneten Nic Vogel AfD\nDrucksache")
    )
    lexicon = spark.createDataFrame([(wp, faction, f"{v} {n}", n, v) for wp in (17, 18) for faction, n, v in (("AfD", "Vogel", "Nic"), ("fraktionslos", "Neppe", "Frank"))], "wp int, fraktion string, form string, nach string, vor string")
    names = lambda: F.filter(F.split("anfrager_alle", "; "), lambda n: n != "")
    rows = adapter.inquiries(spark, sf_dir).select("ka_nr", "wp", F.lit("AfD").alias("fraktion"), x.all_blocks(text).alias("block"))
    own = x.names_found(rows, lexicon, F.col("block"), ["wp", "fraktion"]).select("ka_nr", "wp", "block", names().alias("own"))
    both = x.names_found(own, lexicon.drop("fraktion").distinct(), F.col("block"), ["wp"]).withColumn("all", names())
    logged = F.when(c.isin(1, 3, 4, 7), 2).when(c == 6, 0).otherwise(1)
    least = F.when(c == 7, 1).otherwise(logged)
    listed = F.when(c == 3, "Vogel, Nic; Neppe, Frank").when(c == 6, "").otherwise("Vogel, Nic; Neppe, Frank u.a.")
    tags = F.when(c == 5, F.array(F.lit("anfrager_manual"))).otherwise(F.array().cast("array<string>"))
    tried = x.remediate(F.col("own"), F.col("all"), logged, least, listed, F.when(c == 6, 0).otherwise(2), c == 2, tags, F.lit(True))
    return both.select("ka_nr", tried.alias("r")).select("ka_nr", "r.*")


@query("x15_lexicon", f"""WITH {INQUIRIES}, {MEMBERS}, n AS (SELECT wp, fraktion, {SQL_NAME} AS nach, count(*) AS n_treffer FROM inq JOIN members USING (ka_nr) GROUP BY ALL),
o AS (SELECT a.*, coalesce((SELECT string_agg(b.fraktion, '; ' ORDER BY b.fraktion) FROM n b WHERE b.wp = a.wp AND b.nach = a.nach AND b.fraktion <> a.fraktion), '') AS frueher_fraktion FROM n a)
SELECT wp, fraktion, nach, 'Sven W.' AS vor, 'Sven W. ' || nach AS form, CAST(0 AS INTEGER) AS is_alias, frueher_fraktion, n_treffer FROM o
UNION ALL SELECT wp, fraktion, nach, 'Sven W.', 'Sven ' || nach, CAST(1 AS INTEGER), frueher_fraktion, n_treffer FROM o""")
def x15(spark, sf_dir):
    listed = F.array_join(F.transform("people", lambda n: F.concat(n, F.lit(", Sven W."))), "; ")
    return x.lexicon(_names(spark, sf_dir).select("wp", "fraktion", listed.alias("asked")), ["wp", "fraktion"], ["asked"])


@query("x18_triage", f"""WITH {INQUIRIES}, k AS (SELECT ministry AS form, q_nr, ka_nr, row_number() OVER (PARTITION BY ministry ORDER BY ka_nr) AS k FROM inq WHERE ka_nr % 3 = 0),
f AS (SELECT form, count(*) AS n, max(CASE WHEN k = 1 THEN q_nr END) AS first, coalesce(string_agg(CASE WHEN k BETWEEN 2 AND 4 THEN q_nr END, ', ' ORDER BY k), '') AS more FROM k GROUP BY form)
SELECT 'Minister ' || form || ' Kultur' AS form, n, first, more, 'MK' AS code, 'Ministerium Kultur' AS name, CAST(0.5 AS DOUBLE) AS containment, CAST(0.5 AS DOUBLE) AS jaccard FROM f""")
def x18(spark, sf_dir):
    """Log lines are rendered, read as a table, counted, and given their best guess."""
    rows = adapter.inquiries(spark, sf_dir)
    line = F.concat(F.lit("2026-01-01T00:00:00 | "), "q_nr", F.when(F.col("ka_nr") % 3 == 0, " | ministerium_form | scraped=\"Minister ").otherwise(" | other | scraped=\"Minister "), "ministry", F.lit(' Kultur"'))
    log = sources.novelty_log(rows.select("ka_nr", line.alias("value")))
    forms = k.form_frequency(log, "form", "pk", "ka_nr")
    names = spark.createDataFrame([("MK", "Ministerium Kultur"), ("FM", "Ministerium der Finanzen")], "code string, name string")
    return j.best_overlap(forms, "form", names).select("form", "n", "first", "more", "code", "name", "containment", "jaccard")


@query("src21_log_as_table", f"""WITH {INQUIRIES} SELECT q_nr AS pk, 'SPD' AS fraktion, CAST(ka_nr % 3 + 1 AS INTEGER) AS parsed, CAST(5 AS INTEGER) AS db_min, 'Muster, Eva' AS db_anfrager, 'Eva Muster' AS block FROM inq""")
def src21(spark, sf_dir):
    """Two mismatch lines for each question, of which the last counts, among other lines."""
    rows = adapter.inquiries(spark, sf_dir).withColumn("i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    parsed = F.when(F.col("i") == 0, F.lit(9)).otherwise(F.col("ka_nr") % 3 + 1)
    line = F.concat(F.lit("2026-01-01 | "), "q_nr", F.lit(" | SPD | "), F.when(F.col("i") == 2, "fine").otherwise("MISMATCH"), F.lit(" parsed="), parsed, F.lit(' db_min=5 | db_anfrager="Muster, Eva" | block="Eva Muster"'))
    return sources.mismatch_log(rows.select("i", line.alias("value")), "i")


@query("src1_keyed_scan", f"""WITH {INQUIRIES} SELECT CASE WHEN ka_nr % 4 = 0 THEN NULL ELSE wp END AS wp, q_nr AS pk, ministry AS ministerium, CAST(NULL AS VARCHAR) AS notizen FROM inq WHERE ka_nr % 10 <> 0""")
def src1(spark, sf_dir):
    """Two lines for each key, of which the last counts; a number that is none reads as null."""
    rows = adapter.inquiries(spark, sf_dir).withColumn("line", F.explode(F.array(F.lit(1), F.lit(2))))
    raw = rows.select("line", F.when(F.col("ka_nr") % 4 == 0, "x").otherwise(F.col("wp").cast("string")).alias("WP"), F.when(F.col("ka_nr") % 10 == 0, "").otherwise(F.col("q_nr")).alias("pk"), F.when(F.col("line") == 1, "old").otherwise(F.col("ministry")).alias("Ministerium"), F.lit("?").alias("unknown"))
    return sources.clean_index(raw, ["wp", "pk", "ministerium", "notizen"], "pk", "line")
