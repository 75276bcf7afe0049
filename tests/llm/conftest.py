import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, anchor string, spans string, body binary, score double, shard int, start int, id string, rep long, `_row` int"
WORDS = [f"w{i}" for i in range(400)]


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and long texts, repeats, near copies, shared passages and periodic texts."""
    dice = random.Random(11)
    say = lambda n: " ".join(dice.choice(WORDS) for _ in range(n))
    base, passage = say(120), say(40)
    near = base.split()
    near[60] = "changed"
    return [
        (5, base),
        (6, base),
        (7, " ".join(near)),
        (8, base.upper()),
        (9, None),
        (10, ""),
        (11, " \n\t "),
        (12, "one"),
        (13, "one two three"),
        (14, f"{say(30)} {passage} {say(30)}"),
        (15, f"{say(20)}\n{passage}  {say(50)}"),
        (16, "ab " * 300),
        (17, "é😀" * 200 + passage),
        (18, say(4000)),
        (19, "x" * 70000),
        (20, "MIT License. Licensed under the Apache License; SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH exception\nGeneral Public-License mit license"),
        (21, "SPDX-License-Identifier: MIT OR OR\nDON'T we'll  it's\r\n  12 34\x0b²½ <|endoftext|>"),
        (22, "one two three"),
        (3, passage),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, "en", "s", None, -1, "a", "s", b"b", 9.0, 99, 7, "i", 0, 0) for i, t in edge_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that repeat, share a doc_id, or have none."""
    rows = [(1, "same text here it is"), (1, "same text here it is"), (2, "first " * 50), (2, "second " * 50), (None, "nobody's text"), (None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


def texts_of(df) -> list[tuple[int, str]]:
    return sorted((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect())
