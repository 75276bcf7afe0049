"""The pipeline, stage by stage against brute force, and on edge cases."""

import pytest

import corpus_pipeline
from inquirylake.llm import quality
from tests.llm.conftest import texts_of
from tests.llm.test_documents import SPLIT, brute_near, check_packing

FOLDER = "/root/testdata/sf0.001"


def passages(rows, width=13):
    first, out = {}, {}
    for doc_id, text in rows:
        words = SPLIT.findall(text)
        drop = [False] * len(words)
        for i in range(len(words) - width + 1):
            if first.setdefault(tuple(words[i : i + width]), doc_id) < doc_id:
                drop[i : i + width] = [True] * width
        out[doc_id] = " ".join(w for w, d in zip(words, drop, strict=True) if not d) if any(drop) else text
    return out


@pytest.mark.parametrize("name", ["small", "edge", "empty"])
def test_stages(request, spark, tmp_path, name):
    docs = request.getfixturevalue(name)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "passages", "packing"]
    before = docs
    for step, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / step)
        stage(spark, before, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        if step != "packing":
            assert after.columns == corpus_pipeline.COLUMNS
        if step == "quality":
            labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
            kept = {r["doc_id"] for r in quality.score(before, labels).where("predicted = 1").collect()}
            assert {r["doc_id"] for r in after.collect()} == kept
        elif step == "near_duplicates":
            near = brute_near(texts_of(before), 5, 80)
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(i for i, (_, _, kept) in near.items() if kept)
        elif step == "passages":
            expected = passages(texts_of(before))
            got = after.collect()
            assert {r["doc_id"]: r["text"] for r in got} == expected and len(got) == len(expected)
            original = {r["doc_id"]: r for r in before.collect()}
            assert all(r["n_chars"] == (len(r["text"]) if r["text"] != (original[r["doc_id"]]["text"] or "") else original[r["doc_id"]]["n_chars"]) for r in got)
        else:
            import public_tokenizers

            assert public_tokenizers
            check_packing(after.collect(), texts_of(before), 2048, added=True)
        before = after


def test_stages_on_odd_rows(odd, spark, tmp_path):
    """Rows that repeat, share a doc_id or have none; also clashing and missing columns' values."""
    from pyspark.sql import functions as F

    before = odd.select("*", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(None).cast("long").alias("n_chars"), F.lit(1).alias("kept_"), F.lit(2).alias("_row"))
    counts = []
    for step, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / step)
        stage(spark, before, FOLDER).write.parquet(path)
        before = spark.read.parquet(path)
        counts.append(before.count())
        if step != "packing":
            assert before.columns == corpus_pipeline.COLUMNS
    assert counts[1] <= counts[0] <= 6 and counts[2] == counts[1]
    if counts[2]:
        assert counts[3] >= counts[2]


def test_run(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.count() > 0 and "ids" in rows.columns
    assert corpus_pipeline.ORACLE_SQL is None
