"""Reports over the question table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import adapter, streaming
from ..functions.text import clean_members, remove_first
from ..plans import reports as r
from ..plans import run
from .common import BASE, BLOCK, MEMBERS, TOPICS
from .registry import registry

QUERIES, SQL, query = registry()


@query("a10_sla_by_ministry_total", f"""WITH {BASE}
SELECT wp, CASE WHEN grouping(ministry) = 1 THEN 'LREG' ELSE ministry END AS ministry,
    CASE WHEN grouping(ministry) = 1 THEN 'LANDESREGIERUNG GESAMT' ELSE ministry END AS name, {BLOCK}
FROM base GROUP BY GROUPING SETS ((wp, ministry), (wp))""")
def a10(spark, sf_dir):
    return r.sla_with_total(adapter.base(spark, sf_dir), "ministry", "wp").orderBy("wp", F.desc("anzahl"), "ministry")


@query("a11_sla_by_faction", f"WITH {BASE} SELECT wp, fraktion, {BLOCK} FROM base GROUP BY ALL")
def a11(spark, sf_dir):
    return r.sla(adapter.base(spark, sf_dir), "wp", "fraktion").orderBy("wp", F.desc("anzahl"), "fraktion")


@query("a12_sla_by_member", f"""WITH {BASE}, {MEMBERS}
SELECT wp, member, {BLOCK}, (SELECT string_agg(f, '/' ORDER BY p) FROM (SELECT fraktion AS f, min(b2.ka_nr) AS p FROM base b2 JOIN members m2 USING (ka_nr)
    WHERE m2.member = m.member AND b2.wp = base.wp GROUP BY 1)) AS fraktionen
FROM base JOIN members m USING (ka_nr) GROUP BY wp, member""")
def a12(spark, sf_dir):
    """Lists with wrong separators, a faction that slipped in and 'u.a.' by rule, cleaned again."""
    n, listed = F.col("ka_nr"), F.col("members")
    listed = F.when(n % 5 == 0, remove_first(listed, "; ", " , ")).otherwise(listed)
    listed = F.when(n % 3 == 0, F.concat(listed, F.lit(" SPD"))).otherwise(listed)
    listed = F.when(n % 7 == 0, F.concat(listed, F.lit(" u.a."))).otherwise(listed)
    rows = adapter.base(spark, sf_dir).join(adapter.members(spark, sf_dir), "ka_nr").withColumn("members", listed)
    rows = r.separate(rows.withColumn("members", clean_members(F.col("members"))), "members", "member").withColumn("member", remove_first(F.col("member"), " u.a."))
    return r.sla_of_members(rows, "wp", "member").orderBy("wp", F.desc("anzahl"), "member")


@query("a13_topics_by_month", f"WITH {BASE}, {TOPICS} SELECT wp, periode, topic, {BLOCK} FROM base JOIN topics USING (ka_nr) GROUP BY ALL")
def a13(spark, sf_dir):
    return r.topics_by_period(_topics(spark, sf_dir), "wp")


REAGG = """CAST(sum(anzahl) AS BIGINT) AS anzahl, round(sum(zeit * anzahl) / sum(anzahl), 4) AS zeit, CAST(sum(verspaetet) AS BIGINT) AS verspaetet,
    round(100 - CAST(sum(verspaetet) AS DOUBLE) / sum(anzahl) * 100, 6) AS quote"""


@query("a14_topics_reaggregated", f"""WITH {BASE}, {TOPICS}, p AS (SELECT wp, periode, topic, {BLOCK} FROM base JOIN topics USING (ka_nr) GROUP BY ALL)
SELECT wp, topic, {REAGG} FROM p GROUP BY wp, topic""")
def a14(spark, sf_dir):
    return r.reaggregate(r.topics_by_period(_topics(spark, sf_dir), "wp"), "wp")


@query("a15_topics_by_faction_top20", f"""WITH {BASE}, {TOPICS}, p AS (SELECT wp, fraktion, periode, topic, {BLOCK} FROM base JOIN topics USING (ka_nr) GROUP BY ALL),
q AS (SELECT wp, fraktion, topic, {REAGG} FROM p GROUP BY wp, fraktion, topic)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY wp, fraktion ORDER BY anzahl DESC, topic) AS INTEGER) AS rank FROM q) WHERE rank <= 20""")
def a15(spark, sf_dir):
    rows = r.reaggregate(r.topics_by_period(_topics(spark, sf_dir), "wp", "fraktion"), "wp", "fraktion")
    return r.top(rows, 20, ["wp", "fraktion"])


@query("a16_sla_by_involved_count", f"""WITH {BASE}, {MEMBERS}, c AS (SELECT ka_nr, count(*) AS k FROM members GROUP BY 1)
SELECT wp, CAST(CASE WHEN k IS NULL THEN 1 ELSE k END AS INTEGER) AS beteiligte, {BLOCK} FROM base LEFT JOIN c USING (ka_nr) GROUP BY ALL""")
def a16(spark, sf_dir):
    rows = adapter.base(spark, sf_dir).join(adapter.members(spark, sf_dir), "ka_nr", "left")
    rows = rows.withColumn("beteiligte", r.zero_floor(F.coalesce("n_members", F.lit(0))).cast("int"))
    return r.sla(rows, "wp", "beteiligte")


@query("a17_sla_by_month", f"WITH {BASE} SELECT periode, {BLOCK} FROM base GROUP BY ALL")
def a17(spark, sf_dir):
    return r.sla(adapter.base(spark, sf_dir), "periode").orderBy("periode")


@query("a18_overview_long", f"""WITH {BASE}, s AS (SELECT wp, {BLOCK} FROM base GROUP BY wp),
s2 AS (SELECT wp, CAST(anzahl AS DOUBLE) AS anzahl, zeit, CAST(verspaetet AS DOUBLE) AS verspaetet, quote FROM s)
SELECT wp, name, wert FROM s2 UNPIVOT (wert FOR name IN (anzahl, zeit, verspaetet, quote))""")
def a18(spark, sf_dir):
    return r.overview(adapter.base(spark, sf_dir), "wp")


PIVOT = ", ".join(f"max(CASE WHEN rank = {k} THEN topic END) AS topic_{k}, max(CASE WHEN rank = {k} THEN anzahl END) AS anzahl_{k}" for k in range(1, 6))
PIVOT3 = ", ".join(PIVOT.split(", ")[:6])


@query("w1_top3_topics_pivot", f"""WITH {BASE}, {TOPICS}, n AS (SELECT wp, fraktion, periode, topic, count(*) AS anzahl FROM base JOIN topics USING (ka_nr) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY wp, fraktion, periode ORDER BY anzahl DESC, topic) AS rank FROM n)
SELECT wp, fraktion, periode, {PIVOT3} FROM k GROUP BY wp, fraktion, periode""")
def w1(spark, sf_dir):
    rows = _topics(spark, sf_dir).groupBy("wp", "fraktion", "periode", "topic").agg(F.count("*").alias("anzahl"))
    return r.pivot_ranks(r.top(rows, 3, ["wp", "fraktion", "periode"]), 3, ["wp", "fraktion", "periode"])


@query("w2_top5_topics_pivot", f"""WITH {BASE}, {TOPICS}, n AS (SELECT periode, topic, count(*) AS anzahl FROM base JOIN topics USING (ka_nr) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY periode ORDER BY anzahl DESC, topic) AS rank FROM n)
SELECT periode, {PIVOT} FROM k GROUP BY periode""")
def w2(spark, sf_dir):
    rows = _topics(spark, sf_dir).groupBy("periode", "topic").agg(F.count("*").alias("anzahl"))
    return r.pivot_ranks(r.top(rows, 5, ["periode"]), 5, ["periode"])


@query("w4_topics_with_ties", f"""WITH {BASE}, {TOPICS}, n AS (SELECT topic, count(*) AS n FROM base JOIN topics USING (ka_nr) GROUP BY ALL)
SELECT topic, n FROM (SELECT *, rank() OVER (ORDER BY n DESC) AS k FROM n) WHERE k <= 20""")
def w4(spark, sf_dir):
    return r.top_with_ties(_topics(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("n")), 20, "n")


@query("w5_extremes", f"""WITH {BASE}, k AS (SELECT ka_nr, wp, ministry, days FROM base WHERE days IS NOT NULL)
SELECT * FROM (SELECT *, 'slowest' AS kind FROM k ORDER BY days DESC, ka_nr LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'fastest' AS kind FROM k ORDER BY days, ka_nr LIMIT 5)""")
def w5(spark, sf_dir):
    return r.extremes(adapter.base(spark, sf_dir).select("ka_nr", "wp", "ministry", "days"), 5, "days", "ka_nr")


def _topics(spark, sf_dir):
    """The report's rows, one for each topic of a question."""
    return r.separate(adapter.base(spark, sf_dir).join(adapter.topics(spark, sf_dir), "ka_nr"), "topics", "topic")


def facts(spark, sf_dir):
    """The report's rows with their members and topics as lists: one scan of the questions."""
    people, names = adapter.members(spark, sf_dir), adapter.topics(spark, sf_dir)
    rows = adapter.base(spark, sf_dir).join(people, "ka_nr", "left").join(names, "ka_nr", "left")
    return rows.select("ka_nr", "wp", "fraktion", "ministry", "periode", "days", "late", F.coalesce("n_members", F.lit(0)).alias("beteiligte"), F.split("members", "; ").alias("members"), F.split("topics", "; ").alias("topics"))


@query("snk8_report_run", f"""WITH {BASE}, {MEMBERS}, {TOPICS}, c AS (SELECT ka_nr, count(*) AS k FROM members GROUP BY 1),
p AS (SELECT wp, periode, topic, {BLOCK} FROM base JOIN topics USING (ka_nr) GROUP BY ALL), pf AS (SELECT wp, fraktion, periode, topic, {BLOCK} FROM base JOIN topics USING (ka_nr) GROUP BY ALL),
qf AS (SELECT wp, fraktion, topic, {REAGG} FROM pf GROUP BY wp, fraktion, topic)
SELECT 'ministerien' AS report, wp, NULL AS fraktion, NULL AS periode, CASE WHEN grouping(ministry) = 1 THEN 'LREG' ELSE ministry END AS key, {BLOCK} FROM base GROUP BY GROUPING SETS ((wp, ministry), (wp))
UNION ALL SELECT 'parteien', wp, fraktion, NULL, NULL, {BLOCK} FROM base GROUP BY wp, fraktion
UNION ALL SELECT 'abgeordnete', wp, NULL, NULL, member, {BLOCK} FROM base JOIN members USING (ka_nr) GROUP BY wp, member
UNION ALL SELECT 'sachgebiete', wp, NULL, NULL, topic, {REAGG} FROM p GROUP BY wp, topic
UNION ALL SELECT 'sachgebiete_fraktion', wp, fraktion, NULL, topic, anzahl, zeit, verspaetet, quote FROM (SELECT *, row_number() OVER (PARTITION BY wp, fraktion ORDER BY anzahl DESC, topic) AS rank FROM qf) WHERE rank <= 20
UNION ALL SELECT 'beteiligte', wp, NULL, NULL, CAST(coalesce(k, 1) AS VARCHAR), {BLOCK} FROM base LEFT JOIN c USING (ka_nr) GROUP BY ALL
UNION ALL SELECT 'zeitreihe', NULL, NULL, periode, NULL, {BLOCK} FROM base GROUP BY periode""")
def snk8(spark, sf_dir):
    """The reports of a run that have the block, one under the other."""
    folder = streaming.scratch(spark)
    facts(spark, sf_dir).write.parquet(f"{folder}/facts")
    rows = spark.read.parquet(f"{folder}/facts")
    run.states(rows).write.parquet(f"{folder}/states")
    made, out = run.reports(spark.read.parquet(f"{folder}/states"), rows), None
    for name in ("ministerien", "parteien", "abgeordnete", "sachgebiete", "sachgebiete_fraktion", "beteiligte", "zeitreihe"):
        report = made[name].withColumnRenamed("topic", "key")
        have = lambda c, kind, report=report: (F.col(c) if c in report.columns else F.lit(None)).cast(kind).alias(c)
        one = report.select(F.lit(name).alias("report"), have("wp", "int"), have("fraktion", "string"), have("periode", "date"), have("key", "string"), "anzahl", "zeit", "verspaetet", "quote")
        out = one if out is None else out.unionByName(one)
    return out
