"""The archive scan: a second run reads only new files, and only enriches what the table knows."""

from inquirylake import cli
from inquirylake.streaming import archive, versions

PAGE = "LANDTAG NORDRHEIN-WESTFALEN\nDrucksache 18/{0}\n\nAntwort der Landesregierung\nauf die Kleine Anfrage {1} vom 1. März 2022\ndes Abgeordneten Max Muster SPD\nDrucksache 18/{1}\n\nTitel {1}\n\nVorbemerkung der Kleinen Anfrage\nText.\n\nDer Minister der Finanzen hat die Kleine Anfrage {1} mit Schreiben vom 20. März 2022 namens der Landesregierung beantwortet."


def test_scan_archive(spark, tmp_path, capsys):
    folder, table = tmp_path / "archive" / "1-2000", str(tmp_path / "t")
    folder.mkdir(parents=True)
    row = lambda n, **more: {"drucksache_antwort_nr": f"18/{n}", "wp": 18, "kleine_anfrage_nr": n - 100, "anfrager": "kept", "antworttext_status": "pending", "extract_flags": "anfrager_manual,missing_ministerium", "added_at": "a", "updated_at": "a", **more}
    stored = [row(101), row(102, antworttext_status="anfrage_zurueckgezogen"), row(103, anfragetitel="T", ministerium="M"), row(104), row(105), row(106, antworttext_status="extract_failed")]
    assert archive.records(archive.decide(spark.createDataFrame([("a/MMD18-107.md", None), ("a/bad.md", "x")], "path string, text string"), spark.createDataFrame([], archive.SCHEMA), True)).select("drucksache_antwort_nr", "wp", "antworttext_status").collect() == [("18/107", 18, "extract_failed")]
    versions.replace(spark.createDataFrame(stored, archive.SCHEMA), table, archive.KEY)
    for n in (101, 102, 103, 106, 150):
        (folder / f"MMD18-{n}.md").write_text(PAGE.format(n, n - 100))
    (folder / "MMD18-104.md").write_text("Kleine Anfrage 4 vom 1. März 2022")
    (folder / "other.md").write_text("x")

    def run(*more):
        assert cli.main(["scan-archive", str(tmp_path / "archive"), "--table", table, "--checkpoint", str(tmp_path / "c"), "--batch", "3", *more]) == 0
        return {r["drucksache_antwort_nr"]: r for r in versions.read(spark, table).collect()}

    def actions():
        return {r["paper"]: r["action"] for r in archive.decisions(spark, str(tmp_path / "c" / "audit")).collect()}

    got = run()
    assert actions() == {"18/101": "parse", "18/102": "withdrawn", "18/103": "complete", "18/104": "no_answer", "18/106": "parse", "18/150": "unknown"}
    one = got["18/101"]
    assert (one["anfragetitel"], one["ministerium"], one["antworttext_quelle"], one["anfrager"], one["antworttext_status"], one["added_at"]) == ("Titel 1", "Minister Finanzen", "local", "kept", "pending", "a")
    assert one["extract_flags"].split(",")[0] == "anfrager_manual" and "missing_ministerium" not in one["extract_flags"] and one["updated_at"] != "a"
    assert got["18/103"]["anfragetitel"] == "T" and got["18/102"]["anfragetitel"] is None and set(got) == {f"18/{n}" for n in range(101, 107)}
    assert "parse" in capsys.readouterr().out

    before = versions.head(spark, table)[0]
    run()  # nothing new: no version
    assert versions.head(spark, table)[0] == before and len(actions()) == 6
    (folder / "MMD18-105.md").write_text(PAGE.format(999, 5))  # the page states another paper
    (folder / "MMD18-151.md").write_text(PAGE.format(151, 51))
    got = run("--allow-discovery")
    assert len(actions()) == 8 and versions.head(spark, table)[0] == before + 1
    assert got["18/105"]["anfragetitel"] == "Titel 5" and (got["18/151"]["antworttext_status"], got["18/151"]["anfrager"], got["18/151"]["kleine_anfrage_nr"]) == ("pending_enrich", "Max Muster", 51)
    pages = {r["paper"]: r["page_paper"] for r in archive.decisions(spark, str(tmp_path / "c" / "audit")).collect()}
    assert pages["18/105"] == "18/999" and pages["18/101"] == "18/101"
