"""Worked examples of single functions and operators."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inquirylake import cli, sinks, sources, streaming
from inquirylake.functions import dates, text
from inquirylake.operators import extract, joins, keyed, quality, reconcile, stages

ONE = "SELECT 1 AS one"


def value(spark, column):
    return spark.sql(ONE).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("given_", "iso"), [("24. August 2022", "2022-08-24"), ("28.09.2022", "2022-09-28"), ("4. März 2022", "2022-03-04"), ("4. Foo 2022", ""), ("", ""), ("x", "")])
def test_german_date(spark, given_, iso):
    assert value(spark, dates.german_date(F.lit(given_))) == iso


@pytest.mark.parametrize(("given_", "year", "iso"), [("21.09.2022", None, "2022-09-21"), ("03 07.2025", None, "2025-07-03"), ("1.2.25", None, "2025-02-01"), ("1.2.0205", 2025, "2025-02-01"), ("1.2.0205", 1900, ""), ("32.1.2025", None, ""), ("1.13.2025", None, "")])
def test_footer_date(spark, given_, year, iso):
    assert value(spark, dates.footer_date(F.lit(given_), None if year is None else F.lit(year))) == iso


@pytest.mark.parametrize(("original", "issued", "healed"), [("2024-01-10", "2025-01-20", "2025-01-10"), ("2024-02-29", "2025-03-05", "2024-02-29"), ("2025-01-10", "2025-01-20", "2025-01-10"), ("", "2025-01-20", "")])
def test_heal_year(spark, original, issued, healed):
    assert value(spark, dates.heal_year(F.lit(original), F.lit(issued))) == healed


@pytest.mark.parametrize(("asked", "answered", "late"), [("2025-04-01", "2025-04-28", False), ("2025-04-01", "2025-04-29", True), ("2025-03-22", "2025-04-22", False), ("2025-03-22", "2025-04-23", True), ("2025-04-01", None, None)])
def test_lateness(spark, asked, answered, late):
    day = lambda x: None if x is None else datetime.date.fromisoformat(x)
    rows = spark.createDataFrame([(day(asked), day(answered))], "question_date date, answer_date date")
    assert dates.with_lateness(rows).first()["late"] is late


def test_easter_and_calendar(spark):
    assert value(spark, dates.easter(F.lit(2025))) == datetime.date(2025, 4, 20)
    years = spark.range(1900, 2100).select(F.col("id").cast("int").alias("y")).select("y", dates.easter(F.col("y")).alias("e")).collect()

    def gauss(year):
        a, b, c = year % 19, year // 100, year % 100
        h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
        week = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
        n = h + week - 7 * ((a + 11 * h + 22 * week) // 451) + 114
        return datetime.date(year, n // 31, n % 31 + 1)

    assert all(r["e"] == gauss(r["y"]) for r in years)
    assert dates.calendar(spark, 1999, 2001).where("workday < day or datediff(workday, day) > 4 or workday is null").count() == 0


@pytest.mark.parametrize(
    ("pdf", "db", "chosen", "flag"),
    [
        ("", "2022-01-10", "2022-01-10", ""),
        ("2022-01-10", "", "2022-01-10", ""),
        ("2022-01-10", "2022-01-10", "2022-01-10", ""),
        ("2022-02-31", "2022-03-10", "2022-03-10", ""),
        ("2205-01-01", "2022-01-10", "2022-01-10", "k"),
        ("2022-01-10", "2022-05-12", "2022-01-10", ""),
        ("2022-01-10", "2022-05-13", "2022-01-10", "k"),
        ("2022-01-24", "2022-01-10", "2022-01-24", ""),
        ("2022-01-25", "2022-01-10", "2022-01-25", "k"),
    ],
)
def test_reconcile(spark, pdf, db, chosen, flag):
    assert tuple(value(spark, reconcile.reconcile(F.lit(pdf), F.lit(db), "k"))) == (chosen, flag)


@settings(max_examples=15, deadline=None)
@given(st.dates(datetime.date(2015, 1, 1), datetime.date(2030, 12, 31)), st.dates(datetime.date(2015, 1, 1), datetime.date(2030, 12, 31)))
def test_reconcile_and_mismatch_agree(spark, pdf, db):
    a, b = F.lit(pdf.isoformat()), F.lit(db.isoformat())
    row = spark.sql(ONE).select(reconcile.reconcile(a, b, "k")["flag"].alias("f"), reconcile.mismatch(a, b).alias("m")).first()
    assert (row["f"] == "k") == row["m"]


def test_names_and_lists(spark):
    assert [tuple(x) for x in value(spark, text.askers(F.lit("Becker, Horst; Klocke, Arndt u.a.")))] == [("Becker", "Horst"), ("Klocke", "Arndt")]
    assert value(spark, text.document_name(F.lit("Berg"), F.lit("Guido van den"))) == "Guido van den Berg"
    assert value(spark, text.document_name(F.lit("Dr. Maelzer"), F.lit("Dennis"))) == "Dr. Dennis Maelzer"
    assert value(spark, text.document_names(F.lit("Tritschler"), F.lit("Sven W."))) == ["Sven W. Tritschler", "Sven Tritschler"]
    assert [value(spark, text.least_askers(F.lit(x))) for x in ("", "A, B", "A, B; C, D", "A, B; C, D u.a.")] == [0, 1, 2, 3]
    assert value(spark, text.ministry_tokens(F.lit("Justizministerium"))) == ["justiz"]
    assert [value(spark, text.faction(F.lit(x))) for x in ("BÜNDNIS 90 / DIE GRÜNEN", "FRAKTIONSLOS", "AFD")] == ["GRÜNE", "fraktionslos", "AfD"]


def test_repairs(spark):
    doubled = "LLAANNDDTTAAGG NNOORRDDRRHHEEIINN--WWEESSTTFFAALLEENN DDrruucckkssaacchhee"
    assert value(spark, text.dedouble(F.lit(doubled))) == "LANDTAG NORDRHEIN-WESTFALEN Drucksache"
    assert value(spark, text.dedouble(F.lit("LLAA"))) == "LLAA"
    for cut, whole in (("Klima-schutz", "Klimaschutz"), ("In- nern", "Innern"), ("Bundes- und Europa", "Bundes- und Europa"), ("Bundesund", "Bundes und"), ("Finanzennamens", "Finanzen namens")):
        assert value(spark, text.undo_hyphenation(F.lit(cut))) == whole
    for shut, opened in (("AnjaButschkau", "Anja Butschkau"), ("undJürgen", "und Jürgen"), ("Sven W.Tritschler", "Sven W. Tritschler")):
        assert value(spark, text.open_camel(F.lit(shut))) == opened


def test_identifiers(spark):
    assert tuple(value(spark, text.file_paper(F.lit("MMD18-1006.pdf")))) == (18, "18/1006")
    assert [value(spark, text.bucket(F.lit(n))) for n in (1006, 2000, 2001)] == ["1-2000", "1-2000", "2001-4000"]
    assert tuple(value(spark, text.paper(F.lit("x/1")))) == (None, None)


def test_page_fields_reject_cited_papers(spark):
    pages = spark.createDataFrame([("Kleine Anfrage 18/9829 vom 1. Mai 2022",), ("Kleine Anfrage 7 vom 1. Mai 2022",), ("Kleine Anfrage 7 zu",)], "page string")
    assert [(r["kleine_anfrage_nr"], r["anfragedatum"]) for r in extract.page_fields(pages, "page").collect()] == [(None, ""), (7, "2022-05-01"), (7, "")]
    assert tuple(extract.letter_date(spark.createDataFrame([("Datum des Originals: 21.09.2022/Ausgegeben: 28.09.2022",)], "page string"), "page").select("status", "original", "issued").first()) == ("ok", "2022-09-21", "2022-09-28")


def test_first_place_only_and_masking(spark):
    people = F.array(*(F.struct(F.lit(f).alias("form"), F.lit(n).alias("nach"), F.lit("V").alias("vor")) for f, n in (("Eva Muster", "Muster"), ("Eva", "Eva"))))
    found = value(spark, extract.find_names(F.lit("Eva Musterfrau und Eva Muster, Eva"), people))
    # the long form stands first within a longer word, so it doesn't count; 'Eva' does
    assert [h["nach"] for h in found["hits"]] == ["Eva"]
    found = value(spark, extract.find_names(F.lit("Eva Muster, Eva"), people))
    assert [(h["at"], h["nach"]) for h in found["hits"]] == [(1, "Muster"), (13, "Eva")]


def test_search_pages(spark):
    last = '<a class="pagination__link--next" disabled href="/x?token">'
    more = '<a class="pagination__link--next" href="/x?token">'
    assert value(spark, extract.next_page(F.lit(last))) is None
    assert value(spark, extract.next_page(F.lit(more))).endswith("/x?token")
    assert value(spark, extract.next_page(F.lit("<a href='/'>"))) is None


def test_upsert_is_idempotent_and_never_blanks(spark):
    schema = "pk string, name string, added_at string, updated_at string"
    current = spark.createDataFrame([("1/1", "old", "a", "a"), ("1/2", "kept", "a", "a")], schema)
    new = spark.createDataFrame([("1/1", "new"), ("1/2", ""), ("1/3", "added"), ("", "dropped"), (None, "dropped")], "pk string, name string")
    once = keyed.upsert(current, new, "pk", ["name"], F.lit("b"))
    assert {tuple(r) for r in once.collect()} == {("1/1", "new", "a", "b"), ("1/2", "kept", "a", "b"), ("1/3", "added", "b", "b")}
    assert {tuple(r) for r in keyed.upsert(once, new, "pk", ["name"], F.lit("b")).collect()} == {tuple(r) for r in once.collect()}


def test_stream_upserts(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "pk string, name string, added_at string, updated_at string"
    spark.createDataFrame([("18/2", "first", 1), ("18/2", "second", 2), ("18/1", "x", 1)], "pk string, name string, at int").write.parquet(source)
    run = lambda: streaming.stream_upserts(spark.readStream.schema("pk string, name string, at int").parquet(source), table, str(tmp_path / "check"), schema, "pk", ["name"], "at").awaitTermination()
    run()
    spark.createDataFrame([("18/1", "y", 3)], "pk string, name string, at int").write.mode("append").parquet(source)
    run()
    rows, number = streaming.latest(spark, table, schema)
    assert number == 1 and {(r["pk"], r["name"]) for r in rows.collect()} == {("18/1", "y"), ("18/2", "second")}


def test_sources_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("18/10", "18", "a"), ("18/9", "x", "b"), ("bad", "17", "c")], "pk string, WP string, anfrager string")
    where = sinks.save_version(rows, str(tmp_path / "t"), 3, "pk")
    read = sources.read_index(spark, where, ["pk", "wp", "anfrager", "notizen"], "pk")
    assert {tuple(r) for r in read.collect()} == {("18/10", 18, "a", None), ("18/9", None, "b", None), ("bad", 17, "c", None)}
    archive = tmp_path / "archive" / "1-2000"
    archive.mkdir(parents=True)
    (archive / "MMD18-7.pdf").write_bytes(b"%PDF x")
    (archive / "MMD18-8.md").write_text("Kopf")
    (archive / "other.txt").write_text("x")
    assert {(r["wp"], r["nr"]) for r in sources.archive(spark, str(tmp_path / "archive"), 18).collect()} == {(18, "18/7"), (18, "18/8")}
    assert sources.letter_dates(spark.createDataFrame([(1,)], "x int")).count() == 0
    sinks.save_report(rows, str(tmp_path / "r"), "WP")
    sinks.save_texts(spark.createDataFrame([(5, "t")], "n int, text string"), str(tmp_path / "x"), "n")
    assert spark.read.parquet(str(tmp_path / "x")).first()["bucket"] == "1-2000"
    sinks.append_audit(rows, str(tmp_path / "a"), F.lit("now"))
    sinks.append_audit(rows, str(tmp_path / "a"), F.lit("now"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6
    sinks.save_snapshot(rows.withColumnRenamed("WP", "wp"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).columns == ["wp", "anfrager"]


def test_dimensions(spark):
    raw = spark.createDataFrame([("MBEIM", "Ministerium für Bundes- und Europaangelegenheiten", "MCdS, X "), (None, "x", None)], "`Kürzel` string, Ministerium string, Aliases string")
    from inquirylake.operators import joins

    names = sources.ministries(raw)
    assert names.count() == 1
    assert {tuple(r) for r in joins.explode_aliases(names, "code", "aliases").collect()} == {("MCdS", "MBEIM"), ("X", "MBEIM")}
    assert sources.factions(spark.createDataFrame([("SPD",), ("SPD",), (None,)], "Fraktion string")).count() == 1
    assert sources.overrides(spark.createDataFrame([("a", "B"), ("c", None)], "Raw string, Kuerzel string")).count() == 1
    assert sources.members(spark.createDataFrame([("17", "SPD", "F V N", "N", "V"), ("17", "SPD", None, "N", "V")], "WP string, Fraktion string, PDF_Form string, Nachname string, Vorname string")).count() == 1


def test_verify_exit_code(spark):
    summary = spark.createDataFrame([("malformed", 0, ""), ("orphans", 3, "1")], "check string, total long, listed string")
    assert quality.exit_code(summary, ["malformed"], 5) == 0
    assert quality.exit_code(summary, ["malformed", "orphans"], 5) == 1
    assert quality.exit_code(summary, ["malformed"], 0) == 1


SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>WP</t></is></c><c r="D1" t="s"><v>1</v></c></row>
<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>18</v></c><c r="D2" t="str"><v>Muster, Eva</v></c></row>
<row r="4"><c r="A4" t="s"><v>2</v></c><c r="B4"><v>17.0</v></c></row><row r="5"><c r="B5"><v>3</v></c></row></sheetData></worksheet>"""


def test_spreadsheet(spark, tmp_path):
    import zipfile

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    path = tmp_path / "index.xlsx"
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets><sheet name="other" sheetId="1" r:id="r1"/><sheet name="index" sheetId="2" r:id="r2"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>pk</t></si><si><r><t>Anfra</t></r><r><t>ger</t></r></si><si><t>18/1</t></si></sst>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        book.writestr("xl/worksheets/sheet2.xml", SHEET)
    rows = sources.spreadsheet.sheet(spark, str(path), "index")
    assert rows.columns == ["_line", "pk", "WP", "Anfrager"]
    assert [tuple(r) for r in rows.orderBy("_line").collect()] == [(1, "18/1", "18", "Muster, Eva"), (3, "18/1", "17", None), (4, None, "3", None)]
    assert sources.spreadsheet.sheet(spark, str(path)).count() == 0
    whole = sources.clean_index(rows, ["wp", "pk", "anfrager"], "pk", "_line")
    assert [tuple(r) for r in whole.collect()] == [(17, "18/1", None)]


def test_lookup_and_documents(spark, tmp_path):
    for folder, name in (("1-2000", "MMD18-7.pdf"), ("moved", "MMD18-7.pdf"), ("moved", "MMD18-9.pdf"), ("1-2000", "MMD18-8.pdf")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(b"%PDF one" if name != "MMD18-8.pdf" else b"<html>")
    papers = spark.createDataFrame([(18, 7), (18, 9), (18, 10)], "wp int, n int")
    found = {r["n"]: r["path"] for r in sources.lookup(spark, str(tmp_path), papers).collect()}
    assert found[7].endswith("1-2000/MMD18-7.pdf") and found[9].endswith("moved/MMD18-9.pdf") and found[10] is None
    texts = sources.documents(spark, str(tmp_path), lambda content: content.decode()[5:]).collect()
    assert sorted((r["nr"], r["text"]) for r in texts) == [("18/7", "one"), ("18/7", "one"), ("18/8", None), ("18/9", "one")]
    assert {r["text"] for r in sources.documents(spark, str(tmp_path)).collect()} == {None}


HEAD = "LANDTAG NORDRHEIN-WESTFALEN Antwort der Landesregierung auf die Kleine Anfrage 5 vom 1. März 2022 der Abgeordneten Eva Muster und Max Neu SPD\nDrucksache 18/1\nDer Minister der Finanzen hat die Kleine Anfrage 5 mit Schreiben vom 20. März 2022 namens der Landesregierung im Einvernehmen mit dem Minister des Innern beantwortet." + " Text." * 40


def test_verbs(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    columns = "drucksache_antwort_nr string, drucksache_anfrage_nr string, wp int, kleine_anfrage_nr int, anfrager string, anfrager_alle string, anzahl_abgeordnete int, fraktion string, anfragedatum string, antwortdatum string, anfragedatum_db string, antwortdatum_db string, anfragetitel string, ministerium string, ministerium_kuerzel string, ministerium_canonical string, fraktion_canonical string, beteiligte_ministerien int, beteiligte_ministerien_kuerzel string, antworttext_status string, extract_flags string, mismatch_flags string, datenqualitaet string, notizen string"
    row = ("18/9", "18/1", 18, 5, "Muster, Eva u.a.", "", 0, "SPD", "2021-03-01", "2022-03-22", "", "", "Titel", "", "MF", "", "", 0, "MF", "extracted", "", "", "", "")
    other = ("17/9", "17/1", 17, 6, "Neu, Max", "", 0, "SPD", "2017-03-01", "2017-03-22", "", "", "Titel", "Ministerium des Innern", "", "", "", 0, "", "pending", "", "", "", "")
    spark.createDataFrame([row, other], columns).write.parquet(at("t"))
    spark.createDataFrame([("18/9", HEAD)], "drucksache_antwort_nr string, text string").write.parquet(at("texts"))
    spark.createDataFrame([("18/1", "Anfrage", "2022-03-01"), ("18/9", "Antwort", "2022-03-20")], "paper string, kind string, date string").write.parquet(at("letters"))
    spark.createDataFrame([("FM", "Ministerium der Finanzen", 1), ("IM", "Ministerium des Innern", 2)], "code string, name string, position int").write.parquet(at("ministries"))
    spark.createDataFrame([("MF", "FM")], "alias string, primary string").write.parquet(at("aliases"))
    spark.createDataFrame([], "raw string, code string").write.parquet(at("overrides"))
    spark.createDataFrame([(18, "SPD", "Eva Muster", "Muster", "Eva"), (18, "SPD", "Max Neu", "Neu", "Max")], "wp int, fraktion string, form string, nach string, vor string").write.parquet(at("lexicon"))

    def run(verb, table, out, *inputs):
        assert cli.main([verb, at(table), "--out", at(out), *(x for i in inputs for x in (f"--{i}", at(i)))]) == 0
        return spark.read.parquet(at(out))

    def one(df):
        return df.where("wp = 18").first()

    merged = one(run("merge", "t", "m", "letters", "texts"))
    # the document's date lies a year after the table's
    assert (merged["anfragedatum"], merged["anfragedatum_db"], merged["mismatch_flags"], merged["datenqualitaet"]) == ("2022-03-01", "2021-03-01", "anfragedatum", "ask_review")
    assert merged["antwortdatum"] == "2022-03-20"
    resolved = one(run("resolve", "m", "r", "letters", "texts"))
    assert (resolved["anfragedatum"], resolved["datenqualitaet"], resolved["notizen"]) == ("2021-03-01", "korrigiert", "anfragedatum:year_typo")
    normal = run("normalize", "t", "n", "ministries", "aliases", "overrides")
    assert (one(normal)["ministerium_canonical"], one(normal)["fraktion_canonical"]) == ("Ministerium der Finanzen", "SPD")
    assert normal.where("wp = 17").first()["ministerium_kuerzel"] == "IM"
    members = one(run("extract-all-anfrager", "t", "a", "texts", "lexicon"))
    assert (members["anfrager_alle"], members["anzahl_abgeordnete"], members["rest"], members["too_few"]) == ("Muster, Eva; Neu, Max", 2, "", False)
    assert run("build-abgeordnete-index", "a", "l").where("wp = 18").count() == 2
    involved = one(run("extract-multi-ministerium", "t", "x", "texts", "ministries", "aliases"))
    assert (involved["beteiligte_ministerien_kuerzel"], involved["beteiligte_ministerien"]) == ("FM,IM", 2)
    assert cli.main(["verify", at("t"), "--texts", at("texts")]) == 0
    assert cli.main(["verify", at("t")]) == 0
    spark.read.parquet(at("t")).selectExpr("*").withColumn("drucksache_antwort_nr", F.lit("18-9")).write.parquet(at("bad"))
    assert cli.main(["verify", at("bad"), "--texts", at("texts")]) == 1
    assert cli.main(["merge", at("t"), "--out", at("none"), "--letters", at("letters"), "--texts", at("texts"), "--dry-run", "--wahlperiode", "18"]) == 0
    assert not (tmp_path / "none").exists()
    twice = stages.members_to_fixed_point(spark.read.parquet(at("t")), spark.read.parquet(at("texts")))
    assert one(twice)["anfrager_alle"] == "Muster, Eva"


def test_targeted_search(spark):
    table = spark.createDataFrame([("18/1", "18/1", 18, 1, "old", "a", "a"), ("18/3", "18/3", 18, 3, "kept", "a", "a")], "pk string, q_nr string, wp int, ka_nr int, name string, added_at string, updated_at string")
    hits = spark.createDataFrame([("18/7", "18/1", 18, 1, "new", False), ("18/8", "18/3", 18, 3, "not asked for", False), (None, "18/5", 18, 5, "open", False)], "pk string, q_nr string, wp int, ka_nr int, name string, withdrawn boolean")
    out = keyed.targeted(table, hits, spark.createDataFrame([(18, 1), (18, 5)], "wp int, ka_nr int"), ["name", "wp", "ka_nr", "q_nr"], F.lit("b"))
    assert sorted((r["pk"], r["name"]) for r in out.collect()) == [("18/3", "kept"), ("18/5", "open"), ("18/7", "new")]


def test_years_apart(spark):
    assert [value(spark, dates.years_apart(F.lit(n))) for n in (700, -1096, 1800)] == [2, 3, 5]


def test_command_line(spark, tmp_path, capsys):
    assert cli.main(["run", "/root/testdata/sf0.001", "a17_sla_by_month", "--out", str(tmp_path / "o")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "o" / "a17_sla_by_month")).count() > 0


# Rows of the decision table: flags, question dates (body, footer, stored), answer dates (body,
# footer, stored), paper numbers (document, stored), question number, factions (document, stored),
# term, number found, header doubled, text there; and what comes out by that table, worked by hand.
CASES = [
    ("anfragedatum", "2205-01-01", "", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:ocr_year", "", "", True),
    ("anfragedatum", "2022-01-10", "", "", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:incomplete", "", "", True),
    ("anfragedatum", "", "", "", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "", "", "", False),
    ("anfragedatum", "2021-01-10", "", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:year_typo", "2022-01-10", "", True),
    ("anfragedatum", "2022-06-10", "2022-01-12", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:body_typo", "2022-01-12", "", True),
    ("anfragedatum", "2022-06-10", "2022-06-10", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:pdf_kept", "", "", True),
    ("antwortdatum", "", "", "", "", "2021-03-01", "2022-03-01", "", "", 1, "", "", 18, 0, 0, 0, "antwortdatum:year_typo", "", "2022-03-01", True),
    ("antwortdatum", "", "", "", "", "2022-09-01", "2022-03-01", "", "", 1, "", "", 18, 0, 0, 0, "antwortdatum:pdf_kept", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "17/675", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:wrong_term", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "18/366", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:question_number", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "18/18", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:term_header", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "18/676", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:typo +1", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "18/6755", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:doubled_digit", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "18/67", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:dropped_digit", "", "", True),
    ("drucksache_anfrage_nr", "", "", "", "", "", "", "18/657", "18/675", 366, "", "", 18, 0, 0, 0, "drucksache_anfrage_nr:digit_error -18", "", "", True),
    ("fraktion", "", "", "", "", "", "", "", "", 1, "BÜNDNIS 90/DIE GRÜNEN", "GRÜNE", 18, 0, 0, 0, "fraktion:same_faction", "", "", True),
    ("fraktion", "", "", "", "", "", "", "", "", 1, "fraktionslos", "AfD", 17, 0, 0, 0, "fraktion:left_faction", "", "", True),
    ("fraktion", "", "", "", "", "", "", "", "", 1, "SPD", "CDU", 18, 0, 0, 0, "fraktion:header_or_several", "", "", True),
    ("fraktion", "", "", "", "", "", "", "", "", 1, "", "CDU", 18, 0, 0, 0, "", "", "", False),
    ("md_kanr", "", "", "", "", "", "", "", "", 1, "", "", 18, 1, 0, 1, "md_kanr:spacing", "", "", True),
    ("md_kanr", "", "", "", "", "", "", "", "", 1, "", "", 18, 0, 1, 1, "md_kanr:doubled_header", "", "", True),
    ("md_kanr", "", "", "", "", "", "", "", "", 1, "SPD", "", 18, 0, 0, 1, "md_kanr:other_number", "", "", True),
    ("md_kanr", "", "", "", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "", "", "", False),
    ("anfragedatum_pdf_kreuz", "2021-01-10", "2022-01-10", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum_pdf_kreuz:year_typo", "2022-01-10", "", True),
    ("anfragedatum_pdf_kreuz", "2026-01-10", "2023-01-10", "2023-01-12", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum_pdf_kreuz:years_typo 3", "2023-01-12", "", True),
    ("anfragedatum_pdf_kreuz", "2022-01-10", "2022-03-10", "2022-01-12", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum_pdf_kreuz:footer_typo", "", "", True),
    ("anfragedatum_pdf_kreuz", "2022-03-10", "2022-01-10", "2022-01-12", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum_pdf_kreuz:body_typo", "2022-01-10", "", True),
    ("anfragedatum_pdf_kreuz", "2022-03-10", "2022-06-10", "2022-01-12", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "", "", "", False),
    ("antwortdatum_pdf_kreuz", "", "", "", "2022-01-10", "2022-03-10", "2022-01-12", "", "", 1, "", "", 18, 0, 0, 0, "antwortdatum_pdf_kreuz:footer_typo", "", "2022-01-10", True),
    ("antwortdatum_pdf_kreuz", "", "", "", "2022-03-10", "2022-01-10", "2022-01-12", "", "", 1, "", "", 18, 0, 0, 0, "antwortdatum_pdf_kreuz:body_typo", "", "", True),
    ("antwort_vor_anfrage", "", "", "", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "", "", "", False),
    ("anfragedatum,antwort_vor_anfrage", "2021-01-10", "", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:year_typo", "2022-01-10", "", False),
    ("anfragedatum,anfragedatum_pdf_kreuz", "2022-06-10", "2022-08-10", "2022-01-10", "", "", "", "", "", 1, "", "", 18, 0, 0, 0, "anfragedatum:see_cross", "", "", False),
]


def test_decision_table(spark):
    fields = ["question_body", "question_footer", "question_db", "answer_body", "answer_footer", "answer_db", "pdf_nr", "db_nr", "question", "pdf_faction", "faction", "wp", "number_found", "header_doubled", "text_there"]
    rows = spark.createDataFrame([(i, *case[:16]) for i, case in enumerate(CASES)], ["id", "flags", *fields])
    row = {f: F.col(f) == 1 if f in ("number_found", "header_doubled", "text_there") else F.col(f) for f in fields}
    out = rows.select("id", reconcile.classify(F.split("flags", ","), row).alias("c")).select("id", F.array_join("c.notes", ";").alias("notes"), F.coalesce("c.question_date", F.lit("")), F.coalesce("c.answer_date", F.lit("")), "c.resolved")
    assert [tuple(r)[1:] for r in out.orderBy("id").collect()] == [case[16:] for case in CASES]


@pytest.mark.parametrize(("pdf", "db", "differ"), [("2014-12-25", "2015-01-05", True), ("2022-02-31", "2022-01-05", False), ("2022-01-10", "2022-05-12", False), ("2022-01-10", "2022-05-13", True), ("2031-01-01", "2031-01-01", False), ("", "2022-01-01", False)])
def test_mismatch(spark, pdf, db, differ):
    assert value(spark, reconcile.mismatch(F.lit(pdf), F.lit(db))) is differ


def test_number_in_head(spark):
    head = "Antwort der Landesregierung in der Sache auf die Kleine Anfrage 5 vom 1. Mai 2022"
    doubled = "".join(c if c.isspace() else 2 * c for c in head)
    for text_, number, found in ((head, 5, True), (doubled, 5, True), (head, 6, False), (head, None, True), ("x" * 16000 + head, 5, False), (None, 5, False)):
        assert value(spark, reconcile.number_in(F.lit(text_).cast("string"), F.lit(number).cast("int"))) is found
    long = head + " Text." * 40
    rows = spark.createDataFrame([(1, head, 6), (2, long, 6), (3, long, 5), (4, long, None), (5, None, 6)], "id int, text string, n int")
    assert [r["id"] for r in quality.lacks_number(rows, "text", "n").collect()] == [2]


def test_malformed_papers_must_be_set(spark):
    rows = spark.createDataFrame([("18/1",), ("18-1",), ("",), (None,), ("18/1x",)], "pk string")
    assert sorted(r["pk"] for r in quality.malformed(rows, "pk").collect()) == ["18-1", "18/1x"]


def test_second_try_needs_names(spark):
    none, one, two = F.array().cast("array<string>"), F.array(F.lit("a")), F.array(F.lit("a"), F.lit("b"))
    no = F.lit(False)

    def tried(hits, cross, logged, least, listed="", n=0):
        r = value(spark, extract.remediate(hits, cross, F.lit(logged), F.lit(least), F.lit(listed), F.lit(n), no, none, F.lit(True)))
        return r["names"], r["tag"]

    assert tried(none, none, 0, 0) == ("", "anfrager_unverified")
    assert tried(one, two, 2, 1) == ("a; b", "anfrager_manual,anfrager_cross_fraktion")
    assert tried(one, two, 1, 1) == ("a", "anfrager_manual")
    assert tried(none, none, 1, 1, "A, B", 1) == ("A, B", "anfrager_manual,anfrager_from_db")


@pytest.mark.parametrize("text_", ["K&ouml;ln &#228; &szlig;", "&amp;lt; &lt;", "&#x1F600;&#128512;", "a & b &foo; &", "&copy &#0; &#150;", "&hellip;&NotEqualTilde;", "no entity", "", "&Auml;&amp;&uuml"])
def test_entities(spark, text_):
    import html

    assert value(spark, text.decode_entities(F.lit(text_))) == html.unescape(text_)


def test_members_are_cleaned(spark):
    assert value(spark, text.clean_members(F.lit("A, B , C, D SPD; E, F"))) == "A, B; C, D; E, F"


def test_long_gaps_are_cut(spark):
    rows = spark.createDataFrame([(1, 200_000), (1, 1)], "wp int, n long")
    assert quality.missing_numbers(rows, "wp", "n").agg(F.count("*"), F.min("n"), F.max("n")).first()[:] == (199_998, 2, 199_999)


def test_rejects(spark):
    assert keyed.rejects(spark.createDataFrame([("1/1",), ("",), (None,), (" ",)], "pk string"), "pk").count() == 3


def test_a_new_stream_goes_on_after_another(spark, tmp_path):
    schema, read = "pk string, name string, added_at string, updated_at string", "pk string, name string, at int"
    for n in (1, 2):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame([(f"18/{n}", "x", 1)], read).write.parquet(source)
        for _ in range(2):  # a restart without news writes nothing
            streaming.stream_upserts(spark.readStream.schema(read).parquet(source), str(tmp_path / "t"), str(tmp_path / f"check{n}"), schema, "pk", ["name"], "at").awaitTermination()
    rows, number = streaming.latest(spark, str(tmp_path / "t"), schema)
    assert number == 1 and {r["pk"] for r in rows.collect()} == {"18/1", "18/2"}


def test_snapshot_order():
    assert sinks.SNAPSHOT[9:14] == ["systematik", "schlagworte", "link_drucksache_anfrage", "link_drucksache_antwort", "ministerium_kuerzel"]


def test_look_ups_have_one_row_a_key(spark):
    """Repeated letters, texts, aliases and spellings: the last line counts, and no row is multiplied."""
    lines = spark.createDataFrame([("18/1", "Anfrage", "2020-01-01", "ok"), ("18/1", "Anfrage", "2020-02-02", "ok"), ("18/1", "Anfrage", "2020-03-03", "OK"), ("18/1", "Antwort", "", "ok")], "Drucksache_Nr string, Anfrage_oder_Antwort string, Datum_Original string, Status string").coalesce(1)
    assert [tuple(r) for r in sources.letter_dates(lines).collect()] == [("18/1", "Anfrage", "2020-02-02")]
    sheet = spark.createDataFrame([(2, "b", "B"), (1, "b", "A"), (3, "c", "")], "_line int, Raw string, Kuerzel string")
    assert [tuple(r) for r in sources.overrides(sheet).collect()] == [("b", "B")]
    assert sources.aliases(sheet).count() == 0
    twice = spark.createDataFrame([("x", "A"), ("x", "B")], "alias string, primary string")
    with pytest.raises(Exception, match="contradicting rows"):
        joins.unique(twice, "alias").collect()
    assert joins.unique(twice.withColumn("primary", F.lit("A")), "alias").count() == 1
    names = spark.createDataFrame([("A", "name of A"), ("B", "name of B")], "code string, name string")
    rows = spark.createDataFrame([("x",)], "code string")
    placed = twice.withColumn("position", F.when(F.col("primary") == "A", 2).otherwise(1))
    assert [r["name"] for r in joins.alias_name(rows, "code", names, placed).collect()] == ["name of A"]
    assert [r["name"] for r in joins.override(rows.withColumnRenamed("code", "raw"), "raw", placed.withColumnsRenamed({"alias": "raw", "primary": "code"}), names).collect()] == ["name of A"]


def test_best_overlap_meets_few_pairs(spark):
    """Against all pairs: the same names, with a tenth of the pairs that share a token."""
    import random

    dice = random.Random(9)
    words = [f"{a}{b}wort" for a in "abcdefghij" for b in "klmnopqrst"]
    draw = lambda k: " ".join(dice.choice(words[: 3 + int(97 * dice.random() ** 2)]) for _ in range(k))
    names = [(f"c{i}", draw(dice.randint(1, 5))) for i in range(600)] + [("d", "zu an")]
    values = [draw(dice.randint(1, 4)) for _ in range(150)] + ["", "unbekanntes", names[3][1], "unbekanntes " + names[5][1]]
    rows, table = spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame(names, "code string, name string")
    got = {r["value"]: (r["code"], r["name"], r["containment"], r["jaccard"]) for r in joins.best_overlap(rows, "value", table).collect()}
    shared = 0
    for value_ in set(values):
        v, best = set(value_.split()), None
        for code, name in names:
            c = {w for w in name.split() if len(w) >= 4}
            both = len(v & c)
            shared += both > 0
            if both:
                best = max(best or (0,), (both / len(v), both / len(v | c), -len(c), code, name))
        expected = (best[3], best[4], best[0], best[1]) if best else ("", "", 0.0, 0.0)
        assert got[value_][:2] == expected[:2], value_
        assert got[value_][2:] == pytest.approx(expected[2:], abs=0.006)
    parts = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    tokens = lambda c: F.array_sort(text.ministry_tokens(c))
    v = parts.select(tokens(F.col("p_name")).alias("_v")).distinct()
    c = parts.select(tokens(F.concat_ws(" ", "p_name", "p_type")).alias("_c"), F.struct(F.lit("c").alias("code"), F.lit("n").alias("name")).alias("best")).dropDuplicates(["_c"])
    met = joins.overlap_pairs(v, c).count()
    every = parts.select(F.explode(tokens(F.col("p_name"))).alias("t"), "p_name").distinct().join(parts.select(F.explode(tokens(F.concat_ws(" ", "p_name", "p_type"))).alias("t"), "p_partkey"), "t").select("p_name", "p_partkey").distinct().count()
    assert 0 < met <= every / 10
