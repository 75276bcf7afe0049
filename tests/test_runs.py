"""Runs that people have a hand in, as verbs over stored tables."""

from pyspark.sql import functions as F

from inquirylake import cli
from inquirylake.operators import runs
from inquirylake.streaming import versions

KEY = "drucksache_antwort_nr"


def test_reviews_go_on(spark):
    """Skips, quits, a note without a verdict, a second session, and rows that don't wait."""
    rows = spark.createDataFrame([(f"18/{n}", "ask_review" if n < 8 else "ok", "seen" if n == 7 else "", "a") for n in range(1, 9)], f"{KEY} string, datenqualitaet string, notizen string, aktualisiert_am string")
    schema = f"{KEY} string, session int, seq int, note string, verdict string"
    first = spark.createDataFrame([("18/1", 1, 1, "one", "k"), ("18/2", 1, 2, " ", "k"), ("18/3", 1, 3, "three", "s"), ("18/4", 1, 4, "q", ""), ("18/5", 1, 5, "not said", "k"), ("18/7", 1, 1, "no", "k"), ("18/8", 1, 1, "no", "k")], schema)
    second = spark.createDataFrame([("18/3", 2, 1, "again", "k"), ("18/5", 2, 2, "five", None), ("18/6", 2, 3, "after the end", "k")], schema)
    got = runs.reviewed(rows, first, F.lit("b"))
    shown = lambda df: {r[KEY]: (r["notizen"], r["datenqualitaet"], r["aktualisiert_am"]) for r in df.collect()}
    expected = {"18/1": ("one", "korrigiert", "b"), "18/2": ("", "ask_review", "a"), "18/3": ("three", "ask_review", "b"), "18/4": ("", "ask_review", "a"), "18/5": ("", "ask_review", "a"), "18/6": ("", "ask_review", "a"), "18/7": ("seen", "ask_review", "a"), "18/8": ("", "ok", "a")}
    assert shown(got) == expected
    later = shown(runs.reviewed(got, second, F.lit("c")))
    assert later == expected | {"18/5": ("five", "ask_review", "a")}
    assert shown(runs.reviewed(rows, first.unionByName(second), F.lit("b")))["18/5"][0] == "five"


def test_letters_are_read_once(spark):
    rows = spark.createDataFrame([(18, 1, "18/1", "18/11"), (18, 2, "18/2", "18/2")], "wp int, ka_nr int, q_nr string, pk string")
    pages = spark.createDataFrame([("18/1", "Datum des Originals: 01.02.2022/Ausgegeben: 08.02.2022"), ("18/11", "nothing")], "paper string, page string")
    none = spark.createDataFrame([], "paper string, kind string, wp int, ka_nr int, status string, original string, issued string")
    got = runs.letters(rows, pages, none)
    statuses = lambda df: {(r["paper"], r["kind"]): (r["status"], r["original"]) for r in df.collect()}
    assert statuses(got) == {("18/1", "Anfrage"): ("ok", "2022-02-01"), ("18/11", "Antwort"): ("no_match", ""), ("18/2", "Anfrage"): ("pdf_missing", "")}
    kept = got.withColumn("original", F.when(F.col("status") == "ok", "kept").otherwise(F.col("original")))
    again = statuses(runs.letters(rows, pages.withColumn("page", F.lit("Datum des Originals: 03.02.2022/Ausgegeben: 08.02.2022")), kept))
    assert again == {("18/1", "Anfrage"): ("ok", "kept"), ("18/11", "Antwort"): ("ok", "2022-02-03"), ("18/2", "Anfrage"): ("pdf_missing", "")}
    assert statuses(runs.letters(rows, pages, kept, force=True))[("18/1", "Anfrage")] == ("ok", "2022-02-01")


def test_a_second_try_over_a_table(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    columns = f"{KEY} string, wp int, fraktion string, anfrager string, anfrager_alle string, anzahl_abgeordnete int, antworttext_status string, extract_flags string"
    rows = [("18/1", 18, "AfD", "Vogel, Nic; Neppe, Frank", "", 0, "extracted", "x"), ("18/2", 18, "AfD", "Vogel, Nic", "old", 1, "extracted", "anfrager_manual"), ("18/3", 18, "AfD", "Vogel, Nic; Neppe, Frank", "", 0, "extracted", ""), ("18/4", 18, "AfD", "Vogel, Nic", "", 0, "extracted", "")]
    versions.replace(spark.createDataFrame(rows, columns), at("t"), KEY)
    line = 't | 18/{0} | AfD | MISMATCH parsed=1 db_min={1} | db_anfrager="" | block=""'
    spark.createDataFrame([(line.format(n, 2), n) for n in (1, 2, 3, 9)], "value string, position int").write.parquet(at("lines"))
    both, other = "der Abgeordneten Nic Vogel AfD und Frank Neppe FRAKTIONSLOS\nDrucksache", "des Abgeordneten Niemand AfD\nDrucksache"
    spark.createDataFrame([("18/1", both), ("18/2", both), ("18/3", other), ("18/4", both)], f"{KEY} string, text string").write.parquet(at("texts"))
    spark.createDataFrame([(18, "AfD", "Nic Vogel", "Vogel", "Nic"), (18, "fraktionslos", "Frank Neppe", "Neppe", "Frank")], "wp int, fraktion string, form string, nach string, vor string").write.parquet(at("lexicon"))
    assert cli.main(["fix-anfrager-mismatches", at("t"), "--out", at("o"), *(x for i in ("lines", "texts", "lexicon") for x in (f"--{i}", at(i)))]) == 0
    got = {r[KEY]: (r["anfrager_alle"], r["anzahl_abgeordnete"], r["extract_flags"]) for r in versions.load(spark, at("o")).collect()}
    assert got["18/1"] == ("Vogel, Nic; Neppe, Frank", 2, "anfrager_cross_fraktion,anfrager_manual,x")
    assert got["18/2"] == ("old", 1, "anfrager_manual") and got["18/4"] == ("", 0, "")
    assert got["18/3"] == ("Vogel, Nic; Neppe, Frank", 2, "anfrager_from_db,anfrager_manual")


def test_reviews_searches_and_triage_as_verbs(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    columns = f"{KEY} string, drucksache_anfrage_nr string, wp int, kleine_anfrage_nr int, anfragetitel string, antworttext_status string, datenqualitaet string, notizen string, hinzugefuegt_am string, aktualisiert_am string"
    versions.replace(spark.createDataFrame([("18/1", "18/1", 18, 5, "old", "pending", "ask_review", "", "a", "a"), ("18/9", "18/2", 18, 6, "kept", "extracted", "ok", "", "a", "a")], columns), at("t"), KEY)
    spark.createDataFrame([("18/1", 1, 1, "fine", "k")], f"{KEY} string, session int, seq int, note string, verdict string").write.parquet(at("decisions"))
    assert cli.main(["review", at("t"), "--out", at("r"), "--decisions", at("decisions")]) == 0
    assert versions.load(spark, at("r")).where("notizen = 'fine' and datenqualitaet = 'korrigiert'").count() == 1
    spark.createDataFrame([("18/20", "18/1", 18, 5, "new", ""), ("18/21", "18/2", 18, 6, "not asked for", "")], f"{KEY} string, drucksache_anfrage_nr string, wp int, kleine_anfrage_nr int, anfragetitel string, antworttext_status string").write.parquet(at("hits"))
    spark.createDataFrame([(18, 5)], "wp int, kleine_anfrage_nr int").write.parquet(at("numbers"))
    assert cli.main(["search-again", at("t"), "--out", at("s"), "--hits", at("hits"), "--numbers", at("numbers")]) == 0
    assert {(r[KEY], r["anfragetitel"], r["antworttext_status"]) for r in versions.load(spark, at("s")).collect()} == {("18/20", "new", "pending"), ("18/9", "kept", "extracted")}
    line = 't | 18/{0} | ministerium_form | scraped="Minister Innern und Kultur"'
    spark.createDataFrame([(line.format(n), n) for n in (1, 9)], "value string, position int").write.parquet(at("lines"))
    spark.createDataFrame([("IM", "Ministerium des Innern"), ("FM", "Ministerium der Finanzen")], "code string, name string").write.parquet(at("ministries"))
    assert cli.main(["build-ministerien-erkennung", at("lines"), "--ministries", at("ministries"), "--table", at("t"), "--out", at("triage")]) == 0
    row = spark.read.option("header", True).csv(at("triage")).first()
    assert (row["form"], row["n"], row["first"], row["more"], row["code"], row["kleine_anfrage_nr"]) == ("Minister Innern und Kultur", "2", "18/1", "18/9", "IM", "5")


def test_lexicon_and_extraction_reach_a_fixed_point(spark):
    """A search that finds what stands beside a known name: each pass gains one, four until none is new."""
    from inquirylake.operators import stages

    names = ["Ahorn", "Birke", "Cedern", "Distel"]
    rows = [("18/1", 18, "SPD", "Ahorn, Eva", "extracted", "")] + [(f"18/{n + 2}", 18, "SPD", "", "extracted", "") for n in range(3)] + [("18/9", 18, "CDU", "Ahorn, Eva", "extracted", "")]
    table = spark.createDataFrame(rows, f"{KEY} string, wp int, fraktion string, anfrager string, antworttext_status string, extract_flags string")
    texts = spark.createDataFrame([("18/1", "Eva Ahorn")] + [(f"18/{n + 2}", f"Eva {names[n]} und Eva {names[n + 1]}") for n in range(3)] + [("18/9", "Eva Ahorn und Eva Birke")], f"{KEY} string, text string")
    searched = []

    def step(some, from_texts, lexicon):
        searched.append(some.count())
        joined = some.drop("anfrager_alle", "anzahl_abgeordnete").join(from_texts, KEY)
        met = joined.join(lexicon.where("is_alias = 0").select("wp", "fraktion", "form"), ["wp", "fraktion"]).where("contains(text, form)").select(KEY).distinct().withColumn("met", F.lit(True))
        found = F.array_join(F.transform(F.split("text", " und "), lambda x: F.regexp_replace(x, "Eva (.*)", "$1, Eva")), "; ")
        return joined.join(met, KEY, "left").withColumns({"anfrager_alle": F.when(F.col("met") & (F.col("fraktion") == "SPD"), found).otherwise(""), "anzahl_abgeordnete": F.lit(0)}).drop("text", "met")

    out, passes = stages.fixed_point(table, texts, step=step)
    got = {r[KEY]: r["anfrager_alle"] for r in out.collect()}
    assert got == {"18/1": "Ahorn, Eva", "18/2": "Ahorn, Eva; Birke, Eva", "18/3": "Birke, Eva; Cedern, Eva", "18/4": "Cedern, Eva; Distel, Eva", "18/9": ""}
    assert passes == 4 and searched[0] == 5 and all(n <= 2 for n in searched[1:])
