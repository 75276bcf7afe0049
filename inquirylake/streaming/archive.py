"""The scan of an archive as a stream: only new documents are read, decided on, parsed and merged into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import file_paper, merge_flags
from ..operators.extract import is_answer, is_large_inquiry, page_fields
from ..operators.keyed import scan_status, upsert
from ..operators.quality import row_flags
from ..operators.reconcile import HEAD
from ..operators.stages import ENRICH_MASK, scan_action
from . import identity, now, versions

# Columns that a scan may write of a row that it adds.
SCAN_MASK = ["wp", "kleine_anfrage_nr", "drucksache_anfrage_nr", "anfrager", "fraktion", "anfragedatum", "anfragetitel", "antwortdatum", "ministerium", "antworttext_status", "antworttext_quelle"]
KEY = "drucksache_antwort_nr"
#: The table's columns that a scan reads or writes; a table may have more.
SCHEMA = f"{KEY} string, wp int, kleine_anfrage_nr int, drucksache_anfrage_nr string, anfrager string, fraktion string, anfragedatum string, anfragetitel string, antwortdatum string, ministerium string, ministerium_kuerzel string, ministerium_canonical string, antworttext_status string, antworttext_quelle string, extract_flags string, added_at string, updated_at string"


def documents(spark: SparkSession, folder: str, wp: int | None = None, files: int = 1000) -> DataFrame:
    """path and text of the documents below a folder that are new since the last run, so many a batch."""
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files)
    rows = reader.option("pathGlobFilter", f"MMD{wp if wp is not None else '*'}-*").load(folder)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def decide(texts: DataFrame, table: DataFrame, discovery: bool = False, force: bool = False) -> DataFrame:
    """path, paper, wp, known, action and what was parsed of each document.

    texts has path and text, null where it couldn't be read; of two files of a paper the last path
    counts.  Patterns only run over texts that are to be parsed.
    """
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.(md|txt)$", ".pdf")
    heads = texts.select("path", file_paper(name).alias("p"), F.substring("text", 1, HEAD).alias("head"))
    heads = heads.select("path", F.col("p.nr").alias("paper"), F.col("p.wp").alias("wp"), "head")
    stored = table.select(F.col(KEY).alias("paper"), F.lit(True).alias("known"), F.col("antworttext_status").alias("_status"), F.col("kleine_anfrage_nr").alias("_number"), F.col("anfragetitel").alias("_title"), F.col("ministerium").alias("_ministry"))
    rows = heads.join(stored, "paper", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    row = {"named": F.col("paper").isNotNull(), "known": F.col("known"), "status": F.col("_status"), "number": F.col("_number"), "title": F.col("_title"), "ministry": F.col("_ministry"), "text": F.col("head"), "large": is_large_inquiry(F.col("head")), "answer": is_answer(F.col("head"))}
    rows = rows.withColumn("action", scan_action(row, discovery, force))
    parsed = page_fields(rows.withColumn("_parse", F.when(F.col("action") == "parse", F.col("head"))), "_parse")
    return parsed.withColumnRenamed(KEY, "page_paper").drop("head", "_parse", "_number", "_title", "_ministry")


def records(decided: DataFrame) -> DataFrame:
    """The rows to merge: of known ones only the enriching columns say something, so nothing else is overwritten.

    The file's name is the key, whatever the page says; a document that can't be read, or has no
    question number, marks a row without a status as failed.
    """
    touched = decided.where("action in ('parse', 'unreadable')")
    numbered = F.col("kleine_anfrage_nr").isNotNull()
    read = F.col("action") == "parse"
    failed = ~read | ~numbered & (F.coalesce("_status", F.lit("")) == "")
    fresh = touched.withColumns({"_parsed": read & numbered}).withColumns({"antworttext_status": F.when(failed, "extract_failed").otherwise(scan_status("_status", "_parsed")), "antworttext_quelle": F.lit("local")})
    may = {c: F.lit(True) if c in ENRICH_MASK else ~read if c in ("antworttext_status", "wp") else F.lit(False) for c in SCAN_MASK}
    said = [F.when(~F.col("known") | may[c], F.col(c)).alias(c) for c in SCAN_MASK]
    return fresh.groupBy(F.col("paper").alias(KEY)).agg(F.max_by(F.struct(*said), "path").alias("_r")).select(KEY, "_r.*")


def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The stored rows with new ones merged in; flags of the rows that were touched are told anew, manual tags stay."""
    columns = stored.columns
    out = upsert(stored, new, KEY, SCAN_MASK, now()).join(new.select(KEY, F.lit(True).alias("_new")), KEY, "left")
    flags = merge_flags(F.col("extract_flags"), row_flags(), F.array().cast("array<string>"))
    return out.withColumn("extract_flags", F.when(F.col("_new"), flags).otherwise(F.col("extract_flags"))).select(*columns)


def scan(texts: DataFrame, table: str, checkpoint: str, audit: str, discovery: bool = False, force: bool = False, schema: str = SCHEMA, width: int = versions.WIDTH) -> StreamingQuery:
    """Scans a stream of documents (path, text) into a table in versions, until there are no new ones.

    The stream's checkpoint is the mark from which a later run goes on.  Each batch joins its few
    rows with the key ranges that they fall into, and writes what it decided on each document, with the
    paper that its page states, below audit: a folder a batch, so a batch that is repeated writes
    the same one.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, identity(batch.sparkSession, checkpoint)
        papers = batch.select(file_paper(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.(md|txt)$", ".pdf"))["nr"].alias("nr"))
        ranges = [r[0] for r in papers.select(versions.key_range(F.col("nr"), width)).distinct().collect()]  # as many as the table has at most
        decided = decide(batch, versions.read(spark, table, schema, ranges), discovery, force).persist()
        try:
            decided.select("path", "paper", "action", F.nullif("page_paper", F.lit("")).alias("page_paper")).write.mode("overwrite").parquet(f"{audit}/{name}-{number}")
            new = records(decided).persist()
            if not new.isEmpty():
                versions.change(new, table, schema, KEY, lambda stored: merged(stored, new), (name, number), width)
            new.unpersist()
        finally:
            decided.unpersist()

    return texts.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def decisions(spark: SparkSession, audit: str) -> DataFrame:
    """path, paper, action, page_paper of all batches so far."""
    return spark.read.option("recursiveFileLookup", True).schema("path string, paper string, action string, page_paper string").parquet(audit)
