"""SQL texts that several oracles begin with."""

INQUIRIES = """
inq AS (
    SELECT o_orderkey AS ka_nr, CAST(17 + o_orderkey % 2 AS INTEGER) AS wp,
        (17 + o_orderkey % 2) || '/' || (o_orderkey + 1) AS q_nr,
        (17 + o_orderkey % 2) || '/' || (o_orderkey + 100001) AS a_nr,
        CAST(CAST(o_orderdate AS DATE) + INTERVAL 252 MONTH AS DATE) AS question_date,
        CASE WHEN o_orderkey % 97 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 252 MONTH AS DATE) + CAST(o_orderkey * 37 % 61 AS INTEGER) END AS answer_date,
        CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'extracted' END AS status,
        c_mktsegment AS fraktion, n_name AS ministry
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

ANSWERED = INQUIRIES + """,
ans AS (
    SELECT inq.*, CASE WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = ka_nr) THEN a_nr ELSE q_nr END AS pk FROM inq
)"""

CALENDAR = """
days AS (SELECT CAST(d AS DATE) AS day, year(d) AS y FROM generate_series(TIMESTAMP '2010-01-01', TIMESTAMP '2035-12-31', INTERVAL 1 DAY) t(d)),
e1 AS (SELECT DISTINCT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM days),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e3),
e5 AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM e4),
f AS (
    SELECT day, (isodow(day) >= 6 OR (month(day) * 100 + day(day)) IN (101, 501, 1003, 1101, 1225, 1226)
        OR (day - easter) IN (-2, 1, 39, 50, 60)) AS free, easter
    FROM days JOIN e5 USING (y)
),
cal AS (SELECT day, free, easter, min(CASE WHEN NOT free THEN day END) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS workday FROM f)"""

BASE = INQUIRIES + "," + CALENDAR + """,
base AS (
    SELECT inq.*, CAST(date_trunc('month', question_date) AS DATE) AS periode, CAST(answer_date - question_date AS DOUBLE) AS days,
        answer_date > workday AS late
    FROM inq LEFT JOIN cal ON cal.day = question_date + 27
    WHERE status NOT LIKE '%pending%' AND question_date <= DATE '2026-03-24'
)"""

BLOCK = """count(*) AS anzahl, round(avg(days), 6) AS zeit, CAST(coalesce(sum(CAST(late AS INTEGER)), 0) AS BIGINT) AS verspaetet,
    round(100 - CAST(coalesce(sum(CAST(late AS INTEGER)), 0) AS DOUBLE) / count(*) * 100, 6) AS quote"""

TOPICS = """
topics AS (SELECT l_orderkey AS ka_nr, p_name AS topic FROM lineitem JOIN part ON l_partkey = p_partkey)"""

MEMBERS = """
members AS (SELECT DISTINCT l_orderkey AS ka_nr, s_name AS member FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""
