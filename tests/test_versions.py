"""Tables in versions: interleaved writers, dead writers, ranges and counters."""

import os
import threading

from pyspark.sql import functions as F

from inquirylake import cli, streaming
from inquirylake.operators import stages
from inquirylake.streaming import versions

SCHEMA = "pk string, name string, added_at string, updated_at string"
READ = "pk string, name string, at int"


def rows(spark, *pairs):
    return spark.createDataFrame([(k, v, "a", "a") for k, v in pairs], SCHEMA)


def test_a_writer_that_comes_second_changes_the_new_version(spark, tmp_path):
    path, met = str(tmp_path / "t"), []
    versions.replace(rows(spark, ("18/1", "one")), path, "pk")

    def slow(stored):
        met.append(sorted(r["pk"] for r in stored.collect()))
        if len(met) == 1:  # another writer commits meanwhile
            versions.change(rows(spark, ("18/2", "two")), path, SCHEMA, "pk", lambda s: s.unionByName(rows(spark, ("18/2", "two"))))
        return stored.unionByName(rows(spark, ("18/3", "three")))

    assert versions.change(rows(spark, ("18/3", "three")), path, SCHEMA, "pk", slow) == 2
    assert met == [["18/1"], ["18/1", "18/2"]]
    assert {r["pk"] for r in versions.read(spark, path).collect()} == {"18/1", "18/2", "18/3"}
    used = {f.split("/")[1] for f in versions.head(spark, path)[1]["ranges"].values()}
    assert len(os.listdir(tmp_path / "t" / "data")) == 3 and len(used) == 1  # what the loser wrote first is gone
    assert versions.read(spark, path, number=0).count() == 1


def test_one_of_many_gets_a_number(spark, tmp_path):
    path, won = str(tmp_path / "t"), []
    claim = lambda k: won.append((k, versions._claim(spark, path, 0, {"ranges": {}, "streams": {"k": k}})))
    threads = [threading.Thread(target=claim, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [k for k, got in won if got]
    assert len(won) == 8 and len(winners) == 1
    assert versions.head(spark, path) == (0, {"ranges": {}, "streams": {"k": winners[0]}})


def test_two_streams_lose_no_key(spark, tmp_path):
    """Two streams of several batches each, at the same time, into one table."""
    path, streams = str(tmp_path / "t"), []
    for s in (1, 2):
        for b in range(6):
            spark.createDataFrame([(f"18/{100 * s + b}", f"s{s}", b), ("18/1", f"s{s} b{b}", b)], READ).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{s}"))
    for s in (1, 2):
        source = spark.readStream.schema(READ).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / f"in{s}"))
        streams.append(streaming.stream_upserts(source, path, str(tmp_path / f"c{s}"), SCHEMA, "pk", ["name"], "at"))
    for stream in streams:
        stream.awaitTermination()
    table, number = streaming.latest(spark, path, SCHEMA)
    got = {r["pk"]: r["name"] for r in table.collect()}
    assert set(got) == {"18/1"} | {f"18/{100 * s + b}" for s in (1, 2) for b in range(6)}
    assert number == 11 and all(got[f"18/{100 * s}"] == f"s{s}" for s in (1, 2))


def test_a_dead_writer_and_a_repeated_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    add = lambda stored: stored.unionByName(rows(spark, ("18/1", "x")))
    versions._write(rows(spark, ("18/9", "never committed")), path, "pk", versions.WIDTH)
    assert versions.head(spark, path)[0] == -1 and versions.read(spark, path, SCHEMA).count() == 0
    assert [versions.change(rows(spark, ("18/1", "x")), path, SCHEMA, "pk", add, ("stream", 0)) for _ in range(3)] == [0, 0, 0]
    assert versions.read(spark, path).count() == 1
    assert versions.expire(spark, path, keep=1) == 0  # it may still be written
    assert versions.expire(spark, path, keep=1, idle_hours=0) == 1 and versions.read(spark, path).count() == 1


def test_a_change_rewrites_its_ranges_only(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.replace(rows(spark, ("18/1", "a"), ("18/2000", "b"), ("18/2001", "c"), ("17/5", "d"), ("bad", "e")), path, "pk")
    before = versions.head(spark, path)[1]["ranges"]
    assert set(before) == {"18_1-2000", "18_2001-4000", "17_1-2000", "other"}
    new = rows(spark, ("18/2002", "new"))
    versions.change(new, path, SCHEMA, "pk", lambda stored: stored.unionByName(new))
    after = versions.head(spark, path)[1]["ranges"]
    assert {r for r in after if after[r] != before[r]} == {"18_2001-4000"}
    assert sorted(r["pk"] for r in versions.read(spark, path, ranges=["18_2001-4000"]).collect()) == ["18/2001", "18/2002"]
    versions.change(new, path, SCHEMA, "pk", lambda stored: stored.where("false"))  # a range that gets empty goes
    assert set(versions.head(spark, path)[1]["ranges"]) == set(before) - {"18_2001-4000"}
    assert versions.read(spark, path).count() == 4


def test_counters_need_no_run_of_their_own(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    table = spark.createDataFrame([("18/1", "ok"), ("18/2", "ask_review"), ("18/3", "strange")], "pk string, datenqualitaet string").mapInPandas(touch, "pk string, datenqualitaet string")
    counted, counts = stages.observed(table, "datenqualitaet")
    counted.write.parquet(str(tmp_path / "out"))
    assert {k: v for k, v in counts.get.items() if v} == {"rows": 3, "ok": 1, "ask_review": 1, "other": 1}
    assert runs.value == 3


def test_verbs_read_and_write_versions(spark, tmp_path, capsys):
    table = spark.createDataFrame([("18/1", 18, "SPD", "Muster, Eva")], "drucksache_antwort_nr string, wp int, fraktion string, anfrager string")
    versions.replace(table, str(tmp_path / "t"), "drucksache_antwort_nr")
    for _ in range(2):
        assert cli.main(["build-abgeordnete-index", str(tmp_path / "t"), "--out", str(tmp_path / "l")]) == 0
    assert versions.head(spark, str(tmp_path / "l"))[0] == 1 and versions.load(spark, str(tmp_path / "l")).select(F.count("*")).first()[0] == 1
    assert "rows=1" in capsys.readouterr().out


def test_questions_keep_their_identity_over_restarts(spark, tmp_path):
    """Late answers in any order, a withdrawn question, a restart; the table held two rows of one question."""
    from inquirylake.streaming.questions import SCHEMA as IDENTITIES
    from inquirylake.streaming.questions import stream_identities

    path, schema = str(tmp_path / "t"), "q_nr string, pk string, withdrawn boolean, at long"
    stored = spark.createDataFrame([(pk, q, "pending", "a", "a") for pk, q in (("18/1", "18/1"), ("18/2", "18/2"), ("18/12", "18/2"), ("18/3", "18/3"))], IDENTITIES)
    versions.replace(stored, path, "pk")

    def run(*hits):
        spark.createDataFrame(hits, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "hits"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "hits"))
        stream_identities(source, path, str(tmp_path / "c"), stored).awaitTermination()
        return {(r["q_nr"], r["pk"], r["status"]) for r in versions.read(spark, path).collect()}

    first = run(("18/1", "18/11", False, 5), ("18/1", None, False, 6), ("18/2", None, False, 1), ("18/4", None, True, 1))
    assert first == {("18/1", "18/11", "pending"), ("18/2", "18/12", "pending"), ("18/3", "18/3", "pending"), ("18/4", "18/4", "anfrage_zurueckgezogen")}
    second = run(("18/1", "18/10", False, 4), ("18/2", "18/22", False, 2), ("18/4", "18/14", False, 9), ("18/5", "18/15", False, 1))
    assert second == {("18/1", "18/11", "pending"), ("18/2", "18/22", "pending"), ("18/3", "18/3", "pending"), ("18/4", "18/14", "anfrage_zurueckgezogen"), ("18/5", "18/15", "pending")}


def test_questions_are_kept_without_python_and_only_changes_are_written(spark, tmp_path):
    from inquirylake.streaming.questions import SCHEMA as IDENTITIES
    from inquirylake.streaming.questions import stream_identities

    path, schema = str(tmp_path / "t"), "q_nr string, pk string, withdrawn boolean, at long"
    stored = spark.createDataFrame([(pk, q, "pending", "a", "a") for pk, q in (("18/11", "18/1"), ("18/2", "18/2"), ("18/12", "18/2"), ("18/3", "18/3"))], IDENTITIES)
    versions.replace(stored, path, "pk")

    def run(*hits):
        spark.createDataFrame(hits, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "hits"))
        query = stream_identities(spark.readStream.schema(schema).parquet(str(tmp_path / "hits")), path, str(tmp_path / "c"), stored)
        query.awaitTermination()
        assert [o["operatorName"] for p in query.recentProgress for o in p["stateOperators"]] == ["stateStoreSave"] * len(query.recentProgress)
        return versions.head(spark, path)[0], sorted((r["q_nr"], r["pk"], r["updated_at"] == "a") for r in versions.read(spark, path).collect())

    same = [("18/1", "18/11", True), ("18/2", "18/12", True), ("18/2", "18/2", True), ("18/3", "18/3", True)]
    assert run(("18/1", "18/11", False, 1), ("18/3", "", False, 1)) == (0, same)  # nothing that the table doesn't hold
    assert run(("18/2", None, False, 1)) == (1, [same[0], ("18/2", "18/12", False), same[3]])
    assert run(("18/3", "18/13", False, 1), ("18/1", "18/10", False, 0)) == (2, [same[0], ("18/2", "18/12", False), ("18/3", "18/13", False)])
