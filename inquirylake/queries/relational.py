"""Joins, set operations, filters, counts and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter
from ..operators import joins as j
from ..operators import keyed as k
from .common import ANSWERED, INQUIRIES, MEMBERS
from .registry import registry

QUERIES, SQL, query = registry()


@query("j1_semi_known", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def j1(spark, sf_dir):
    index = adapter.read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return j.known(adapter.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), index, "l_orderkey")


@query("j2_anti_orphans", "SELECT o_orderkey AS ka_nr FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j2(spark, sf_dir):
    lines = adapter.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("ka_nr"))
    return j.orphans(adapter.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ka_nr")), lines, "ka_nr")


# The names of nations, two of three under a code of their own and the third by an alias.
NATIONS = "n AS (SELECT n_nationkey, 'N' || n_nationkey AS code, n_name AS name FROM nation)"


@query("j3_alias_fallback", """SELECT c_custkey, 'N' || c_nationkey AS code,
    CASE WHEN c_nationkey % 3 <> 2 THEN 'NATION_' || c_nationkey WHEN c_nationkey % 2 = 1 THEN 'NATION_0' ELSE 'NATION_' || (c_nationkey - 1) END AS name FROM customer""")
def j3(spark, sf_dir):
    """Each alias stands in an early line of the first nation's and in one of its own; every other one in a third."""
    nations = adapter.read(spark, sf_dir, "nation")
    names = nations.where("n_nationkey % 3 <> 2").select(F.concat(F.lit("N"), "n_nationkey").alias("code"), F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey") + 1, F.lit(", ")).alias("aliases"))
    listed = names.where("cast(substring(code, 2) as int) % 3 = 1").withColumn("position", F.lit(1))
    early, late = listed.withColumns({"code": F.lit("N3"), "position": F.lit(0)}), listed.where("cast(substring(code, 2) as int) % 2 = 0").withColumns({"code": F.lit("N0"), "position": F.lit(2)})
    aliases = j.explode_aliases(listed.unionByName(early).unionByName(late), "code", "aliases")
    rows = adapter.read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("N"), "c_nationkey").alias("code"))
    return j.alias_name(rows, "code", names.select("code", "name"), aliases).select("c_custkey", "code", "name")


@query("j4_letter_dates_twice", f"""WITH {ANSWERED} SELECT ka_nr, CASE WHEN ka_nr % 4 <> 0 THEN strftime(question_date, '%Y-%m-%d') END AS question_letter,
    CASE WHEN ka_nr % 5 <> 0 AND answer_date IS NOT NULL THEN strftime(answer_date + CAST(CASE WHEN ka_nr % 2 = 0 THEN 1 ELSE 0 END AS INTEGER), '%Y-%m-%d') END AS answer_letter FROM ans""")
def j4(spark, sf_dir):
    """Every third question letter is preceded by another one, every other answer letter followed by one of the day after.

    An answer and a question that waits for its own may have one number, so letters name their question."""
    index = adapter.answered(spark, sf_dir)
    q = index.where("ka_nr % 4 <> 0").select("ka_nr", F.col("q_nr").alias("paper"), F.lit("Anfrage").alias("kind"), F.date_format("question_date", "yyyy-MM-dd").alias("date"))
    a = index.where("ka_nr % 5 <> 0 and answer_date is not null").select("ka_nr", F.col("pk").alias("paper"), F.lit("Antwort").alias("kind"), F.date_format("answer_date", "yyyy-MM-dd").alias("date"))
    letters = q.unionByName(a).withColumn("position", F.lit(1))
    before = index.where("ka_nr % 3 = 0 and ka_nr % 4 <> 0").select("ka_nr", F.col("q_nr").alias("paper"), F.lit("Anfrage").alias("kind"), F.lit("1999-01-01").alias("date"), F.lit(0).alias("position"))
    after = index.where("ka_nr % 5 <> 0 and answer_date is not null and ka_nr % 2 = 0").select("ka_nr", F.col("pk").alias("paper"), F.lit("Antwort").alias("kind"), F.date_format(F.date_add("answer_date", 1), "yyyy-MM-dd").alias("date"), F.lit(2).alias("position"))
    return j.letter_dates(index.select("ka_nr", "q_nr", "pk"), letters.unionByName(before).unionByName(after), "ka_nr").select("ka_nr", "question_letter", "answer_letter")


TOKENS = "SELECT p_name, list_distinct(list_filter(regexp_extract_all(lower(p_name), '[a-z]+'), lambda w: len(w) >= 4)) AS v FROM (SELECT DISTINCT p_name FROM part)"
DIM = "SELECT p_partkey AS position, 'P' || p_partkey AS code, p_name || ' ' || p_type AS name, list_distinct(list_filter(regexp_extract_all(lower(p_name || ' ' || p_type), '[a-z]+'), lambda w: len(w) >= 4)) AS c FROM part"


def _dimension(spark, sf_dir):
    """All parts as names."""
    return adapter.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("position"), F.concat(F.lit("P"), "p_partkey").alias("code"), F.concat_ws(" ", "p_name", "p_type").alias("name"))


@query("j5_subset_match", f"""WITH v AS ({TOKENS}), d AS ({DIM}),
m AS (SELECT p_name, code, name, row_number() OVER (PARTITION BY p_name ORDER BY len(c), length(name) DESC, position) AS k FROM v JOIN d ON len(v) > 0 AND len(list_intersect(v, c)) = len(v))
SELECT p_partkey, m.code, m.name FROM part LEFT JOIN m ON m.p_name = part.p_name AND k = 1""")
def j5(spark, sf_dir):
    rows = adapter.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return j.subset_match(rows, "p_name", _dimension(spark, sf_dir)).select("p_partkey", "code", "name")


@query("j6_jaccard_best", f"""WITH v AS ({TOKENS}), d AS ({DIM}),
o AS (SELECT p_name, code, name, len(c) AS c, len(list_intersect(v, c)) / len(v) AS containment, len(list_intersect(v, c)) / len(list_distinct(list_concat(v, c))) AS jaccard FROM v, d WHERE len(list_intersect(v, c)) > 0),
m AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY containment DESC, jaccard DESC, c, code DESC, name DESC) AS k FROM o)
SELECT p_partkey, coalesce(m.code, '') AS code, coalesce(m.name, '') AS name, round(coalesce(containment, 0), 2) AS containment, round(coalesce(jaccard, 0), 2) AS jaccard
FROM part LEFT JOIN m ON m.p_name = part.p_name AND k = 1""")
def j6(spark, sf_dir):
    rows = adapter.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return j.best_overlap(rows, "p_name", _dimension(spark, sf_dir).drop("position")).select("p_partkey", "code", "name", "containment", "jaccard")


@query("j9_first_example", f"""WITH {INQUIRIES}, f AS (SELECT ministry AS form, min(ka_nr) AS first FROM inq GROUP BY 1)
SELECT form, i.wp, i.ka_nr FROM f LEFT JOIN (SELECT * FROM inq WHERE ka_nr % 5 <> 0) i ON i.ka_nr = f.first""")
def j9(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir)
    forms = rows.groupBy(F.col("ministry").alias("form")).agg(F.min("ka_nr").alias("first"))
    return forms.join(rows.where("ka_nr % 5 <> 0").select("wp", "ka_nr"), F.col("first") == F.col("ka_nr"), "left").select("form", "wp", "ka_nr")


@query("j14_pending_tasks", f"""WITH {ANSWERED}, t AS (SELECT wp, ka_nr, q_nr AS paper, 'Anfrage' AS kind FROM ans UNION ALL SELECT wp, ka_nr, pk, 'Antwort' FROM ans WHERE pk <> q_nr)
SELECT * FROM t WHERE NOT (ka_nr % 3 = 0 AND kind = 'Anfrage')""")
def j14(spark, sf_dir):
    todo = j.tasks(adapter.answered(spark, sf_dir))
    done = todo.where("ka_nr % 3 = 0 and kind = 'Anfrage'")
    return j.orphans(todo, done, "paper", "kind").select("wp", "ka_nr", "paper", "kind")


@query("j16_unpivot_tasks", f"WITH {ANSWERED} SELECT wp, ka_nr, q_nr AS paper, 'Anfrage' AS kind FROM ans UNION ALL SELECT wp, ka_nr, pk, 'Antwort' FROM ans WHERE pk <> q_nr")
def j16(spark, sf_dir):
    return j.tasks(adapter.answered(spark, sf_dir))


@query("j18_faction_canonical", f"WITH {INQUIRIES} SELECT ka_nr, CASE WHEN fraktion IN ('BUILDING', 'MACHINERY') THEN fraktion ELSE '' END AS canonical FROM inq")
def j18(spark, sf_dir):
    return adapter.inquiries(spark, sf_dir).select("ka_nr", j.member("fraktion", ["BUILDING", "MACHINERY"]).alias("canonical"))


@query("j19_override", """SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN 'N' || c_nationkey WHEN c_nationkey % 4 = 1 THEN '' END AS code,
    CASE WHEN c_nationkey % 4 = 0 THEN 'NATION_' || c_nationkey WHEN c_nationkey % 4 = 1 THEN '' END AS name FROM customer""")
def j19(spark, sf_dir):
    nations = adapter.read(spark, sf_dir, "nation")
    code = F.concat(F.lit("N"), "n_nationkey").alias("code")
    lines = nations.where("n_nationkey % 4 < 2").select(F.concat(F.lit("raw "), "n_nationkey").alias("raw"), code, F.col("n_nationkey").alias("position"))
    overrides = lines.unionByName(lines.withColumns({"code": F.lit("N4"), "position": F.lit(-1)}))  # an earlier line of each says something else
    names = nations.where("n_nationkey % 4 = 0").select(code, F.col("n_name").alias("name"))
    rows = adapter.read(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("raw "), "c_nationkey").alias("spelling"))
    return j.override(rows, "spelling", overrides, names).select("c_custkey", "code", "name")


@query("j20_first_novel", """SELECT user_id, min(event_id) AS event_id FROM events WHERE user_id % 3 <> 0 GROUP BY user_id""")
def j20(spark, sf_dir):
    rows = adapter.read(spark, sf_dir, "events").select("user_id", "event_id")
    return j.first_novel(rows, "user_id", "event_id", rows.where("user_id % 3 = 0").select("user_id").distinct())


@query("a1_status_counts", f"WITH {INQUIRIES} SELECT CAST(coalesce(wp, 0) AS INTEGER) AS wp, status, count(*) AS n FROM inq GROUP BY ALL")
def a1(spark, sf_dir):
    return adapter.inquiries(spark, sf_dir).groupBy(F.coalesce("wp", F.lit(0)).alias("wp"), "status").agg(F.count("*").alias("n"))


@query("a2_novel_values", "SELECT p_name, count(*) AS n FROM part WHERE p_type NOT IN ('PROMO', 'LARGE') GROUP BY 1 ORDER BY n DESC, p_name LIMIT 10")
def a2(spark, sf_dir):
    rows = adapter.read(spark, sf_dir, "part").where(~F.col("p_type").isin("PROMO", "LARGE"))
    return rows.groupBy("p_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_name").limit(10)


@query("a5_name_counts", f"""WITH {INQUIRIES}, {MEMBERS}, u AS (SELECT wp, fraktion, member AS name FROM inq JOIN members USING (ka_nr) UNION ALL SELECT wp, fraktion, ministry FROM inq)
SELECT wp, fraktion, name, count(*) AS n FROM u GROUP BY ALL""")
def a5(spark, sf_dir):
    rows = adapter.inquiries(spark, sf_dir)
    listed = rows.join(adapter.members(spark, sf_dir), "ka_nr").select("wp", "fraktion", F.explode(F.split("members", "; ")).alias("name"))
    both = listed.unionByName(rows.select("wp", "fraktion", F.col("ministry").alias("name")))
    return both.groupBy("wp", "fraktion", "name").agg(F.count("*").alias("n"))


@query("a6_other_factions", f"""WITH {INQUIRIES}, p AS (SELECT DISTINCT ministry, fraktion FROM inq)
SELECT a.ministry, a.fraktion, coalesce((SELECT string_agg(b.fraktion, '; ' ORDER BY b.fraktion) FROM p b WHERE b.ministry = a.ministry AND b.fraktion <> a.fraktion), '') AS others FROM p a""")
def a6(spark, sf_dir):
    pairs = adapter.inquiries(spark, sf_dir).select("ministry", "fraktion").distinct()
    sets = pairs.groupBy("ministry").agg(F.collect_set("fraktion").alias("all"))
    return pairs.join(sets, "ministry").select("ministry", "fraktion", F.array_join(F.array_sort(F.array_except("all", F.array("fraktion"))), "; ").alias("others"))


@query("a7_form_frequency", f"""WITH {INQUIRIES}, k AS (SELECT ministry AS form, q_nr, ka_nr, row_number() OVER (PARTITION BY ministry ORDER BY ka_nr) AS k FROM inq)
SELECT form, count(*) AS n, max(CASE WHEN k = 1 THEN q_nr END) AS first, coalesce(string_agg(CASE WHEN k BETWEEN 2 AND 4 THEN q_nr END, ', ' ORDER BY k), '') AS more FROM k GROUP BY form""")
def a7(spark, sf_dir):
    return k.form_frequency(adapter.inquiries(spark, sf_dir), "ministry", "q_nr", "ka_nr")


@query("a8_kind_status", f"""WITH {ANSWERED}, t AS (SELECT 'Anfrage' AS kind, status FROM ans UNION ALL SELECT 'Antwort', status FROM ans WHERE pk <> q_nr) SELECT kind, status, count(*) AS n FROM t GROUP BY ALL""")
def a8(spark, sf_dir):
    index = adapter.answered(spark, sf_dir)
    rows = j.tasks(index).join(index.select("wp", "ka_nr", "status"), ["wp", "ka_nr"])
    return rows.groupBy("kind", "status").agg(F.count("*").alias("n"))


@query("p2_date_range", f"WITH {INQUIRIES} SELECT ka_nr FROM inq WHERE answer_date IS NULL OR answer_date BETWEEN DATE '2018-01-01' AND DATE '2018-12-31'")
def p2(spark, sf_dir):
    iso = F.coalesce(F.date_format("answer_date", "yyyy-MM-dd"), F.lit(""))
    return adapter.inquiries(spark, sf_dir).where((iso == "") | iso.between("2018-01-01", "2018-12-31")).select("ka_nr")


@query("p3_fetch_candidates", f"WITH {ANSWERED} SELECT ka_nr, pk FROM ans WHERE wp = 18 AND status <> 'extracted' AND pk <> q_nr")
def p3(spark, sf_dir):
    return k.fetch_candidates(adapter.answered(spark, sf_dir), wp=18).select("ka_nr", "pk")


@query("p10_adhoc_filters", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'de') AND n_chars >= 500 AND contains(text, 'reth')")
def p10(spark, sf_dir):
    docs = adapter.read(spark, sf_dir, "documents")
    return docs.where(F.col("lang").isin("en", "de") & (F.col("n_chars") >= 500) & F.coalesce(F.contains("text", F.lit("reth")), F.lit(False))).select("doc_id", "lang")


@query("s1_key_sort_topn", f"WITH {INQUIRIES} SELECT q_nr FROM inq ORDER BY CAST(split_part(q_nr, '/', 1) AS INTEGER), CAST(split_part(q_nr, '/', 2) AS INTEGER) LIMIT 100")
def s1(spark, sf_dir):
    return adapter.inquiries(spark, sf_dir).orderBy(*k.paper_order("q_nr")).limit(100).select("q_nr")


@query("json_fill_empty", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'known' ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS filled FROM events""")
def json_fill(spark, sf_dir):
    old = F.when(F.col("event_id") % 2 == 0, "known").otherwise("")
    new = F.from_json("props", "k int")["k"].cast("string")
    return adapter.read(spark, sf_dir, "events").select("event_id", F.coalesce(F.nullif(old, F.lit("")), new).alias("filled"))
