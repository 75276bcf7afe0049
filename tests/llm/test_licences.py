"""Op 3: expressions that prose follows, families, notices, and the base columns in SQL."""

import duckdb
import pytest

from inquirylake.llm import licenses


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("SPDX-License-Identifier: GPL-2.0-or-later see COPYING", "gpl"),
        ("License: MIT. The rest of this page is prose.", "mit"),
        ("License: LGPL-2.1+ (see COPYING)", "lgpl"),
        ("License: GPL v3", "gpl"),
        ("License: GPL version 3 or later versions", "gpl"),
        ("License: BSD 3-Clause", "bsd"),
        ("License: Apache version 2.0 and/or others", "apache"),
        ("license: zlib", "zlib"),
        ("license: MIT/Apache-2.0 at your option", "apache,mit"),
        ("license: (MIT OR ISC) AND (GPL-2.0 WITH", "isc,mit"),
        ("license: ((MIT", ""),
        ("license: MIT OR", "mit"),
        ("license: OR MIT", ""),
        ("license: MIT OR AND ISC", ""),
        ("license: MIT, ISC", "mit"),
        ("one line license: MIT here license: ISC there and more", "isc,mit"),
        ("creative commons debate on public domain art", ""),
        ("dedicated to the public domain", "public-domain"),
        ("Creative Commons Attribution 4.0", "cc-by"),
    ],
)
def test_labels_of_a_line(text, labels):
    assert ",".join(sorted(licenses.scan(text).labels)) == labels


def test_prefix_is_the_longest_expression():
    """Held against the strict parser, on every prefix of tokens."""
    import random

    dice = random.Random(3)
    for _ in range(2000):
        tokens = [dice.choice(["mit", "isc", "gpl-2.0", "and", "or", "with", "(", ")"]) for _ in range(dice.randint(1, 9))]
        expected = []
        read = next((n for n in range(len(tokens)) if tokens[n] in "and or with".split() and (n == 0 or tokens[n - 1] in "( and or with".split())), len(tokens))
        for n in range(1, read + 1):
            try:
                expected = licenses.postfix(" ".join(tokens[:n]))
            except licenses.Malformed:
                continue
        got = licenses.prefix(" ".join(tokens))
        assert got == expected or read < len(tokens) and got == [], tokens


def test_many_tags_on_one_line_cost_in_proportion():
    import time

    began = time.process_time()
    for text in ("license: ((((" * 20_000, "license: mit or " * 20_000, "license: " + "(" * 100_000 + "mit"):
        licenses.scan(text)
    assert time.process_time() - began < 20


def test_base_columns_match_sql(spark):
    folder = "/root/testdata/sf0.001"
    words = "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x01-\x2f\x3a-\x60\x7b-\x7f]+'), lambda x: x <> '')"
    phrases = " UNION ALL ".join(f"SELECT '{p}' AS phrase, '{label}' AS label, {len(p.split())} AS size" for p, label in licenses.BASE.items())
    sql = f"""WITH d AS (SELECT doc_id, {words} AS w FROM '{folder}/documents.parquet'), p AS ({phrases}),
        f AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d), p WHERE array_to_string(w[i : i + size - 1], ' ') = phrase)
        SELECT doc_id, len(w), count(place), min(place), max(place), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM d LEFT JOIN f USING (doc_id) GROUP BY doc_id, w"""
    expected = sorted(duckdb.sql(sql).fetchall())
    got = licenses.scan_documents(spark.read.parquet(f"{folder}/documents.parquet"))
    assert sorted(tuple(r) for r in got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()) == expected
