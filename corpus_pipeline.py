"""A corpus pipeline: quality, near duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inquirylake.llm import minhash, packing, quality, substring
from inquirylake.llm.common import checkpoint, prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose score reaches the cut; labels teach, they don't decide.

    Null and empty texts are scored from zero features; a null doc_id, repeated rows and nulls in
    other columns change no score; equal texts share their fate.  An empty table gives no rows;
    columns that documents doesn't have are left out.
    """
    prepare(spark)
    return quality.keep(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near duplicates (five words, 0.8).

    Null, empty and wordless texts are near to nothing and stay, as do all rows of a null doc_id.
    Of rows that repeat both doc_id and text one stays; unlike texts of one doc_id count as one
    document and all stay or go.  An empty table gives no rows; other columns are left out.
    """
    prepare(spark)
    return minhash.keep_first(docs.select(COLUMNS))


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that stand in an earlier document; every document stays.

    A null text becomes empty; texts that lose nothing keep their white space and n_chars.  A null
    doc_id comes before all others; rows that share a doc_id are one document.  Repeated rows each
    stay.  An empty table gives no rows; other columns are left out.
    """
    prepare(spark)
    cut = substring.dedup(docs, carry=["lang", "source", "n_chars"])
    touched = F.col("n_removed") > 0
    return cut.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "lang",
        "source",
        F.when(touched, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 2048 tokens; one row per piece, with its ids.

    A null or empty text is packed as its end id; repeated rows are packed each; a null doc_id stays
    null.  An empty table gives no rows; columns other than doc_id and text are left out.
    """
    import public_tokenizers

    prepare(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, added=True)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("packing", packing_stage),
]

#: The classifier, the sketches and the packing aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are cut off from its plan."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
