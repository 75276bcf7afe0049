"""One number that is an answer's and another question's own: no row is lost, doubled or mixed up."""

import duckdb
from pyspark.sql import functions as F

from inquirylake import queries, streaming
from inquirylake.functions import text
from inquirylake.operators import joins, keyed, runs
from inquirylake.streaming import versions

# question 18/1 has the answer 18/9, and 18/9 is also a question that waits for its own
STORED = [("18/1", "18/9"), ("18/9", "18/9")]
PAIR = "q_nr string, pk string"


def sets(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_letters_of_one_number_are_read_by_kind(spark):
    rows = spark.createDataFrame([(18, 1, "18/1", "18/9"), (18, 8, "18/9", "18/20")], "wp int, ka_nr long, q_nr string, pk string")
    foot = "Datum des Originals: {0}/Ausgegeben: {0}"
    pages = spark.createDataFrame([("18/9", "Antwort", foot.format("01.02.2022")), ("18/9", "Anfrage", foot.format("05.06.2022"))], "paper string, kind string, page string")
    none = spark.createDataFrame([], "paper string, kind string, wp int, ka_nr long, status string, original string, issued string")
    got = {(r["paper"], r["kind"]): r["original"] for r in runs.letters(rows, pages, none).where("status = 'ok'").collect()}
    assert got == {("18/9", "Antwort"): "2022-02-01", ("18/9", "Anfrage"): "2022-06-05"}


def test_entities_without_their_semicolon(spark, tmp_path):
    spark.createDataFrame([(1, "a&amp{b} &amp;lt; &copy &copy;")], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert queries.QUERIES["fn5_entities"](spark, str(tmp_path)).first()["plain"].startswith("a&amp{b} &lt; &copy © ")
    assert spark.range(1).select(text.decode_entities(F.lit("a&amp{b}"))).first()[0] == "a&{b}"


def test_a_placeholder_is_no_other_questions_answer(spark):
    hits = spark.createDataFrame([("18/1", "18/9", False), ("18/9", None, False)], f"{PAIR}, withdrawn boolean")
    waiting = spark.createDataFrame([("18/1", "18/1"), ("18/9", "18/9")], PAIR)
    assert sets(keyed.identity(hits, waiting), "q_nr", "disposition") == [("18/1", "migrate"), ("18/9", "update_placeholder")]
    assert sets(keyed.identity(hits, spark.createDataFrame(STORED, PAIR)), "q_nr", "disposition") == [("18/1", "update"), ("18/9", "update_placeholder")]


def test_a_real_row_is_no_placeholder_of_its_number(spark):
    table = spark.createDataFrame([("18/1", "18/9"), ("18/9", "18/20"), ("18/9", "18/9")], PAIR)
    assert sets(keyed.purge_placeholders(table), "q_nr", "pk") == [("18/1", "18/9"), ("18/9", "18/20")]


def test_letters_name_their_question(spark):
    index = spark.createDataFrame([(1, *STORED[0]), (8, *STORED[1])], f"ka_nr long, {PAIR}")
    letters = spark.createDataFrame([(1, "18/9", "Antwort", "2022-01-01", 1), (8, "18/9", "Antwort", "2022-08-08", 2)], "ka_nr long, paper string, kind string, date string, position int")
    assert sets(joins.letter_dates(index, letters, "ka_nr"), "ka_nr", "answer_letter") == [(1, "2022-01-01"), (8, "2022-08-08")]


def test_two_streams_change_each_row_of_a_number(spark, tmp_path):
    schema = "pk string, q_nr string, name string, added_at string, updated_at string, waits boolean"
    stored = [("18/9", q, "old", "a", "a", waits) for q in ("18/1", "18/9") for waits in (False, True)]
    versions.replace(spark.createDataFrame(stored, schema), str(tmp_path / "t"), "pk")
    new = spark.createDataFrame([("18/9", "18/1", "answer", 1, False), ("18/9", "18/9", "waits", 1, True)], "pk string, q_nr string, name string, at int, waits boolean")
    new.repartition(1).write.parquet(str(tmp_path / "new"))
    source = spark.readStream.schema(new.schema).parquet(str(tmp_path / "new"))
    streaming.stream_upserts(source, str(tmp_path / "t"), str(tmp_path / "c"), schema, "pk", ["name"], "at", once=["q_nr"], beside=["waits"]).awaitTermination()
    assert sets(versions.read(spark, str(tmp_path / "t")), "q_nr", "name") == [("18/1", "answer"), ("18/1", "waits"), ("18/9", "answer"), ("18/9", "waits")]


def test_a_stored_row_keeps_its_question(spark):
    current = spark.createDataFrame([("18/9", "18/1", "a", "a")], "pk string, q_nr string, added_at string, updated_at string")
    new = spark.createDataFrame([("18/9", "18/9"), ("18/3", "18/3")], "pk string, q_nr string")
    assert sets(keyed.upsert(current, new, "pk", [], F.lit("b"), once=["q_nr"]), "pk", "q_nr") == [("18/3", "18/3"), ("18/9", "18/1")]


def test_migrating_keeps_the_question_beside_an_answer(spark):
    hits = spark.createDataFrame([("18/1", "18/9", False)], f"{PAIR}, withdrawn boolean")
    table = spark.createDataFrame([("18/1", "18/1"), ("18/9", "18/9")], PAIR)
    assert sets(keyed.migrate(table, hits), "q_nr", "pk") == STORED


def test_migrating_moves_a_question_of_several_hits_once(spark):
    hits = spark.createDataFrame([("18/1", "18/9", False), ("18/1", "18/9", False), ("18/2", "18/7", False), ("18/2", "18/8", False)], f"{PAIR}, withdrawn boolean")
    table = spark.createDataFrame([("18/1", "18/1"), ("18/2", "18/2"), ("18/9", "18/9")], PAIR)
    assert sets(keyed.migrate(table, hits), "q_nr", "pk") == [("18/1", "18/9"), ("18/2", "18/8"), ("18/9", "18/9")]
    stored = table.unionByName(spark.createDataFrame([("18/2", "18/7")], PAIR))
    assert sets(keyed.migrate(stored, hits), "q_nr", "pk") == [("18/1", "18/9"), ("18/2", "18/7"), ("18/9", "18/9")]


def test_an_empty_answer_moves_no_question(spark):
    hits = spark.createDataFrame([("18/1", "", False), ("18/2", None, False)], f"{PAIR}, withdrawn boolean")
    table = spark.createDataFrame([("18/1", "18/1"), ("18/2", "18/2")], PAIR)
    assert sets(keyed.migrate(table, hits), "q_nr", "pk") == [("18/1", "18/1"), ("18/2", "18/2")]


def test_migrating_equals_its_sql_where_numbers_meet_and_orders_repeat(spark, tmp_path):
    con = duckdb.connect()
    for name in ("customer", "nation", "orders"):
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    # order n + 100000 has the number of order n's answer, and each order stands twice
    con.execute("CREATE OR REPLACE TABLE orders AS SELECT orders.* REPLACE (o_orderkey + i % 2 * 100000 AS o_orderkey) FROM orders, range(4) t(i)")
    for name in ("customer", "nation", "orders"):
        con.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet'")
    expected = con.execute(f"SELECT q_nr, pk FROM ({queries.SQL['u2_migrate']})").fetchall()
    assert sets(queries.QUERIES["u2_migrate"](spark, str(tmp_path)), "q_nr", "pk") == sorted(expected)


def test_a_streamed_answer_leaves_the_question_of_its_number(spark, tmp_path):
    from inquirylake.streaming.questions import SCHEMA, stream_identities

    stored = spark.createDataFrame([(pk, q, "pending", "a", "a") for q, pk in STORED], SCHEMA)
    versions.replace(stored, str(tmp_path / "t"), "pk")
    spark.createDataFrame([("18/1", "18/9", False, 1), ("18/9", None, True, 1)], "q_nr string, pk string, withdrawn boolean, at long").coalesce(1).write.parquet(str(tmp_path / "hits"))
    source = spark.readStream.schema("q_nr string, pk string, withdrawn boolean, at long").parquet(str(tmp_path / "hits"))
    stream_identities(source, str(tmp_path / "t"), str(tmp_path / "c"), stored).awaitTermination()
    got = sets(versions.read(spark, str(tmp_path / "t")), "q_nr", "pk", "status")
    assert got == [("18/1", "18/9", "pending"), ("18/9", "18/9", "anfrage_zurueckgezogen")]
