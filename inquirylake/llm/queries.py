"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bootstrap, bpe, licenses, lloyd, minhash, multiindex, packing, periods, quality, sharding, substring, suffix, topk
from .common import table


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.token_digests(table(spark, sf_dir, "documents"), _tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents"), digest=True)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"), digest=True)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), _tokenizer_path("byte_bpe_50k.json"), public_tokenizers.PATTERN, keep_ids=False, added=True)


def op9_multiindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bootstrap.digests(bootstrap.extract(table(spark, sf_dir, "documents")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.detect(periods.planted(table(spark, sf_dir, "documents"))))


def op13_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = lloyd.encode(table(spark, sf_dir, "embeddings"))
    digest = F.lit(lloyd.codebooks_digest(books)).alias("codebooks_sha256")
    return lloyd.with_label_error(coded).select("vec_id", "code", "error", "label_error", digest)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_licenses": op3_licenses,
    "op4_suffix": op4_suffix,
    "op5_minhash": op5_minhash,
    "op6_topk": op6_topk,
    "op7_substring": op7_substring,
    "op8_packing": op8_packing,
    "op9_multiindex": op9_multiindex,
    "op10_sharding": op10_sharding,
    "op11_bootstrap": op11_bootstrap,
    "op12_runs": op12_runs,
    "op13_lloyd": op13_lloyd,
}

REACH = """reach AS (
            SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )"""

#: u of a key and a shard, greatest at the shard that wins where weights are equal.
DRAWN = "list_transform(range({0}), lambda s: CAST('0x' || substr(md5(doc_id || ':' || s), 1, 12) AS BIGINT))"

#: The CRC-32, byte by byte from its polynomial's table: of a text's hexadecimal digits and length in bytes.
CRC = "t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS crc)"
CRC_OF = "xor(list_reduce(list_transform(range({1}), lambda i: CAST('0x' || substr({0}, 2 * i + 1, 2) AS BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"

#: A round of Lloyd's: entries nearest to parts, and entries moved.
ROUND = """e{1} AS MATERIALIZED (
            SELECT vec_id, label, k, p, least_of[2] AS e, least_of[1] AS far
            FROM (SELECT v.vec_id, v.label, v.k, v.p, min([list_sum(list_transform(list_zip(v.p, b.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e]) AS least_of FROM parts v JOIN b{1} b USING (k) GROUP BY ALL)
        )"""

MOVED = """b{1} AS MATERIALIZED (
            SELECT k, e, coalesce(m.p, b.p) AS p FROM b{0} b LEFT JOIN (
                SELECT k, e, list(CAST(floor(s / n) AS HUGEINT) ORDER BY i) AS p
                FROM (SELECT k, e, i, sum(x) AS s, count(*) AS n FROM (SELECT k, e, unnest(p) AS x, unnest(range(len(p))) AS i FROM e{0}) GROUP BY k, e, i) GROUP BY k, e
            ) m USING (k, e)
        )"""

#: Matches of a pattern with what stands around them: kind, its order, the pattern, which matches count.
LOCATED = """{0} AS MATERIALIZED (
            SELECT doc_id, x, before, after, CAST(stop - length(x) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop
            FROM (
                SELECT *, sum(length(before) + length(x)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
                FROM (
                    SELECT doc_id, unnest(m) AS x, unnest(p[1 : len(m)]) AS before, unnest(p[2 :]) AS after, unnest(range(len(m))) AS i
                    FROM (SELECT doc_id, regexp_extract_all(t, '{1}') AS m, string_split_regex(t, '{1}') AS p FROM d)
                )
            )
        )"""
DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
OCTETS = "len(list_filter(string_split(x, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(p, 3) AS INTEGER) > 255)) = 0"
LUHN = f"length({DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(length({DIGITS})), lambda i: [[0, 1, 2, 3, 4, 5, 6, 7, 8, 9], [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]][i % 2 + 1][CAST(substr({DIGITS}, length({DIGITS}) - i, 1) AS INTEGER) + 1])) % 10 = 0"
PHONE = f"length({DIGITS}) BETWEEN 8 AND 15"
NEAR_WORDS = "list_filter(string_split_regex(translate({0}({1}, 40), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: A round of scoring patterns by instances and instances by patterns.
SCORED = """p{1} AS MATERIALIZED (
            SELECT pattern, kind, score // total AS confidence
            FROM (SELECT pattern, kind, sum(score) AS score, count(*) AS n FROM (SELECT pattern, coalesce(seed, kind) AS kind, CASE WHEN seed IS NULL THEN coalesce(score, 0) ELSE 1000 END AS score FROM edges LEFT JOIN i{0} USING (x)) GROUP BY pattern, kind)
            JOIN (SELECT pattern, count(*) AS total FROM edges GROUP BY pattern) USING (pattern)
            WHERE n >= 3 AND score // total >= 800 AND kind IN (SELECT kind FROM kinds WHERE sort = pattern[1])
        ), i{1} AS MATERIALIZED (
            SELECT x, arg_max(kind, 10 * confidence - o) AS kind, max(confidence) AS score FROM edges JOIN p{1} USING (pattern) JOIN kinds USING (kind) WHERE seed IS NULL GROUP BY x
        )"""

SQL: dict[str, str] = {
    "op11_bootstrap": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        kinds(kind, o, sort) AS (VALUES ('email', 0, 'a'), ('ip', 1, 'd'), ('card', 2, 'n'), ('phone', 3, 'n')),
        {LOCATED.format("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+")}, {LOCATED.format("ip", "[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)")},
        {LOCATED.format("card", "[0-9]([ -]?[0-9])+")}, {LOCATED.format("phone", "\\+[0-9][ ().0-9-]+[0-9]")},
        {LOCATED.format("mention", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)*|[0-9]+(?:\\.[0-9]+){{3,}}|[+(]?[0-9](?:[ ().-]{{0,2}}[0-9]){{5,}}")},
        base AS MATERIALIZED (
            SELECT 'email' AS kind, doc_id, start, stop FROM email UNION ALL SELECT 'ip', doc_id, start, stop FROM ip WHERE {OCTETS}
            UNION ALL SELECT 'card', doc_id, start, stop FROM card WHERE {LUHN} UNION ALL SELECT 'phone', doc_id, start, stop FROM phone WHERE {PHONE}
        ),
        m AS (
            SELECT *, {NEAR_WORDS.format("right", "before")} AS b, {NEAR_WORDS.format("left", "after")} AS a,
                CASE WHEN contains(x, '@') THEN 'a' WHEN regexp_full_match(x, '[0-9]+(\\.[0-9]+){{3,}}') THEN 'd' ELSE 'n' END AS sort,
                CASE WHEN contains(x, '@') THEN CASE WHEN regexp_matches(x, '@[A-Za-z0-9-]+\\.') THEN 'email' END
                    WHEN regexp_full_match(x, '[0-9]+(\\.[0-9]+){{3}}') THEN CASE WHEN {OCTETS} THEN 'ip' END
                    WHEN regexp_full_match(x, '\\+[0-9][ ().0-9-]+[0-9]') THEN CASE WHEN {PHONE} THEN 'phone' END
                    WHEN regexp_full_match(x, '[0-9]([ -]?[0-9])+') THEN CASE WHEN {LUHN} THEN 'card' END END AS seed
            FROM mention
        ),
        edges AS MATERIALIZED (
            SELECT DISTINCT sort || ' ' || b[-2] || ' ' || b[-1] || ' _' AS pattern, x, seed FROM m WHERE len(b) >= 2
            UNION SELECT DISTINCT sort || ' ' || b[-1] || ' _ ' || a[1], x, seed FROM m WHERE len(b) >= 1 AND len(a) >= 1
        ),
        i0 AS (SELECT '' AS x, '' AS kind, 0 AS score WHERE false), {SCORED.format(0, 1)}, {SCORED.format(1, 2)}, {SCORED.format(2, 3)},
        more AS (SELECT i3.kind, doc_id, start, stop FROM m JOIN i3 USING (x) WHERE seed IS NULL AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = m.doc_id AND base.start < m.stop AND m.start < base.stop)),
        both_kinds AS (SELECT *, true AS first FROM base UNION ALL SELECT *, false FROM more)
        SELECT doc_id, count(*) FILTER (first AND kind = 'email') AS n_email, count(*) FILTER (first AND kind = 'ip') AS n_ip, count(*) FILTER (first AND kind = 'card') AS n_card,
            count(*) FILTER (first AND kind = 'phone') AS n_phone, sha256(coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY o, start) FILTER (first), '')) AS base_sha256,
            coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY o, start), '') AS spans
        FROM d LEFT JOIN both_kinds USING (doc_id) LEFT JOIN kinds USING (kind) GROUP BY doc_id
    """,
    # twelve words of period q <= 6, or two periods, hold six words that stand q words further on as well
    "op12_runs": f"""
        WITH {CRC},
        d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, hex(encode(CAST(doc_id AS VARCHAR))) AS k FROM documents),
        h AS (SELECT doc_id, w, len(w) AS n, {CRC_OF.format("k", "len(k) // 2")} AS h FROM d, t),
        p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN h // 10 % n END AS a, h // 10 % 8 + 3 AS parts FROM h),
        x AS MATERIALIZED (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_concat(w[1 : a], list_transform(range(n - a), lambda i: w[a + i % (1 + (n - a) // parts) + 1])) END AS w FROM p),
        g AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + 6], ' ') AS g FROM (SELECT doc_id, n, w, unnest(range(n - 5)) AS i FROM x WHERE n >= 12)),
        same AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM g a JOIN g b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i AND 2 * (b.i - a.i) <= a.n),
        found AS (
            SELECT doc_id, q, min(i) AS s, count(*) + 5 + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
            GROUP BY doc_id, q, island HAVING count(*) + 5 + q >= greatest(12, 2 * q)
        ),
        runs AS MATERIALIZED (SELECT doc_id, s, l, min(q) AS q FROM found GROUP BY doc_id, s, l),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
        kept AS (
            SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (gone.i IS NULL) AS rest
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM x) x LEFT JOIN gone USING (doc_id, i) GROUP BY x.doc_id
        ),
        best AS (
            SELECT doc_id, count(*) AS n_runs, min({{'l': -l, 's': s, 'q': q}}) AS b, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, -b.l AS length, b.q AS period, 1000 * -b.l // b.q AS exponent_milli,
            sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
        FROM x LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op13_lloyd": f"""
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS c FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS MATERIALIZED (SELECT vec_id, label, k, c[k * len(c) // 8 + 1 : (k + 1) * len(c) // 8] AS p FROM v, range(8) r(k)),
        b0 AS MATERIALIZED (SELECT k, CAST(e AS HUGEINT) AS e, p FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT 16) USING (vec_id)),
        {", ".join(f"{ROUND.format('', n)}, {MOVED.format(n, n + 1)}" for n in range(6))}, {ROUND.format('', 6)},
        coded AS (SELECT vec_id, label, string_agg(lpad(lower(hex(CAST(e AS INTEGER))), 2, '0'), '' ORDER BY k) AS code, CAST(sum(far) AS BIGINT) AS error FROM e6 GROUP BY vec_id, label)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY k, e)) FROM b6) AS codebooks_sha256
        FROM coded
    """,
    "op10_sharding": f"""
        WITH {CRC},
        d AS (SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h, {DRAWN.format(8)} AS u8, {DRAWN.format(9)} AS u9 FROM documents),
        c AS (
            SELECT doc_id, n + 1 AS size, list_position(u8, list_max(u8)) - 1 AS shard, list_position(u9, list_max(u9)) - 1 AS grown_shard,
                {CRC_OF.format("h", "n")} AS text_crc32
            FROM d, t
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(grown_shard AS INTEGER) AS grown_shard,
            row_number() OVER (PARTITION BY shard ORDER BY CAST('0x' || substr(md5(doc_id || ''), 1, 12) AS BIGINT) % 1024, text_crc32 % 16, doc_id, text_crc32, size) - 1 AS slot
        FROM c
    """,
    "op4_suffix": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        s AS (SELECT doc_id, i, substr(h, 2 * i - 1, 200) AS g FROM (SELECT doc_id, h, unnest(range(1, n - 98)) AS i FROM d WHERE n >= 100)),
        later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM s) WHERE k > 1),
        edges AS (SELECT doc_id, i, coalesce(lag(i) OVER w < i - 100, true) AS fresh FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        spans AS (
            SELECT doc_id, min(i) AS a, max(i) + 100 AS b
            FROM (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM edges) GROUP BY doc_id, span
        ),
        kept AS (SELECT doc_id, a, coalesce(lag(b) OVER w, 1) AS f, b, lead(a) OVER w AS next FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
        parts AS (
            SELECT doc_id, string_agg(substr(h, 2 * f - 1, 2 * (a - f)), '' ORDER BY a) || max(CASE WHEN next IS NULL THEN substr(h, 2 * b - 1) ELSE '' END) AS rest,
                CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans
            FROM kept JOIN d USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
        FROM d LEFT JOIN parts USING (doc_id)
    """,
    "op5_minhash": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM w WHERE len(w) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        links AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
        """ + REACH + """
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
        FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
    """,
    "op7_substring": """
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), s AS (
            SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
        ), later AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS f FROM s) WHERE f < doc_id
        ), gone AS (SELECT DISTINCT doc_id, i + o AS i FROM later, range(0, 13) t(o)),
        kept AS (
            SELECT d.doc_id, count(gone.i) AS n_removed, string_agg(x, ' ' ORDER BY d.i) FILTER (gone.i IS NULL) AS rest
            FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d) d LEFT JOIN gone USING (doc_id, i) GROUP BY d.doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op9_multiindex": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ),
        """ + REACH + """
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
        FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id) LEFT JOIN (SELECT a AS vec_id, min(b) AS m FROM reach GROUP BY a) USING (vec_id)
    """,
    "op6_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.t AS DOUBLE[]), CAST(c.t AS DOUBLE[])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.t) = len(c.t)
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        WHERE rank <= 5
    """,
}
