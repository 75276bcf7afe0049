"""Readers: keyed tables, dimensions, letter dates, archive listings, text heads and logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.patterns import MISMATCH_LINE, NOVELTY_LINE
from ..functions.text import bucket, file_paper, ministry_tokens
from ..operators.joins import explode_aliases, unique
from .spreadsheet import sheet

#: Columns of the working table that are numbers; a value that is none reads as null.
NUMBERS = ["wp", "kleine_anfrage_nr", "beteiligte_ministerien", "anzahl_abgeordnete"]
LETTERS = StructType([StructField(c, StringType()) for c in ("drucksache_nr", "anfrage_oder_antwort", "datum_original", "status")])


def clean_index(rows: DataFrame, columns: list[str], key: str, position: str) -> DataFrame:
    """The keyed table scan (SRC-1): known columns by name, missing ones null, rows without key
    dropped, the last of equal keys kept."""
    have = {c.lower(): c for c in rows.columns}
    picked = [(F.col(have[c]).cast("string").try_cast("int") if c in NUMBERS else F.nullif(F.col(have[c]).cast("string"), F.lit(""))).alias(c) if c in have else F.lit(None).cast(IntegerType() if c in NUMBERS else StringType()).alias(c) for c in columns]
    kept = rows.select(*picked, F.col(position).alias("_position")).where(F.col(key).isNotNull())
    return kept.groupBy(key).agg(F.max_by(F.struct(*columns), "_position").alias("_r")).select("_r.*")


def read_index(spark: SparkSession, path: str, columns: list[str], key: str, form: str = "parquet") -> DataFrame:
    """A stored table (also form 'xlsx'); the order of its lines is their position."""
    if form == "xlsx":
        return clean_index(sheet(spark, path), columns, key, "_line")
    reader = spark.read.format(form)
    rows = (reader.option("header", True) if form == "csv" else reader).load(path)
    return clean_index(rows.withColumn("_line", F.monotonically_increasing_id()), columns, key, "_line")


def factions(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("Fraktion").alias("fraktion")).where("fraktion is not null and fraktion <> ''").distinct()


def ministries(rows: DataFrame) -> DataFrame:
    """code, name, tokens and the comma list of aliases (SRC-5)."""
    return rows.select(F.col("Kürzel").alias("code"), F.col("Ministerium").alias("name"), ministry_tokens(F.col("Ministerium")).alias("tokens"), F.col("Aliases").alias("aliases")).where("code is not null and name is not null")


def _line(rows: DataFrame) -> Column:
    """The place of a line: its number if the reader gives one, else the order of reading."""
    return (F.col("_line") if "_line" in rows.columns else F.monotonically_increasing_id()).alias("position")


def overrides(rows: DataFrame) -> DataFrame:
    """raw, code where both are set (SRC-7); the last line of a spelling counts."""
    return unique(rows.select(F.trim("Raw").alias("raw"), F.trim("Kuerzel").alias("code"), _line(rows)).where("raw <> '' and code <> ''"), "raw")


def aliases(rows: DataFrame) -> DataFrame:
    """alias, primary from the comma lists of the ministries' sheet (SRC-6); the last line of an alias counts."""
    if "Aliases" not in rows.columns:
        return rows.sparkSession.createDataFrame([], "alias string, primary string")
    return unique(explode_aliases(rows.select(F.col("Kürzel").alias("code"), F.col("Aliases").alias("aliases"), _line(rows)), "code", "aliases"), "alias")


def members(rows: DataFrame) -> DataFrame:
    """Member forms with every key set (SRC-8)."""
    named = rows.select(F.col("WP").cast("int").alias("wp"), F.col("Fraktion").alias("fraktion"), F.col("PDF_Form").alias("form"), F.col("Nachname").alias("nach"), F.col("Vorname").alias("vor"))
    return named.dropna()


def letter_dates(rows: DataFrame) -> DataFrame:
    """paper, kind, date of letters that were read well (SRC-9), the last line of each; a table without these columns is empty."""
    if not {f.name for f in LETTERS} <= {c.lower() for c in rows.columns}:
        return rows.sparkSession.createDataFrame([], "paper string, kind string, date string")
    read = rows.select(F.col("drucksache_nr").alias("paper"), F.col("anfrage_oder_antwort").alias("kind"), F.col("datum_original").alias("date"), "status", _line(rows))
    return unique(read.where("status = 'ok' and date <> '' and paper is not null and kind is not null").drop("status"), "paper", "kind")


def archive(spark: SparkSession, path: str, wp: int | None = None) -> DataFrame:
    """path, wp, nr of documents below a folder (SRC-10); contents aren't read."""
    pattern = f"MMD{wp if wp is not None else '*'}-*"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    paper = file_paper(F.regexp_replace(name, r"\.md$", ".pdf"))
    return files.select("path", "length", paper.alias("p")).select("path", "length", "p.wp", "p.nr").where("nr is not null")


def lookup(spark: SparkSession, path: str, papers: DataFrame) -> DataFrame:
    """Adds path, the document of each (wp, n): in its own bucket, else wherever it lies (SRC-11)."""
    listed = archive(spark, path).select("nr", F.col("path").alias("_path"))
    asked = papers.withColumns({"_nr": F.concat_ws("/", "wp", "n"), "_bucket": F.concat(F.lit("/"), bucket(F.col("n")), F.lit("/"))})
    found = asked.select("_nr", "_bucket").distinct().join(listed, F.col("_nr") == F.col("nr"))
    best = found.groupBy("_nr").agg(F.min_by("_path", F.struct(~F.contains("_path", F.col("_bucket")), F.col("_path"))).alias("path"))
    return asked.join(best, "_nr", "left").drop("_nr", "_bucket")


def documents(spark: SparkSession, path: str, extractor: Callable[[bytes], str] | None = None) -> DataFrame:
    """path, wp, nr and text of each PDF below a folder, by an extractor of the caller's (SRC-12, SRC-13).

    The extractor gets a file's bytes and gives its text, page by page as far as it likes; without
    one, or where it fails or the file is no PDF, text is null.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "MMD*.pdf").load(path)
    paper = file_paper(F.element_at(F.split("path", "/"), -1))

    def texts(batches):
        for batch in batches:
            out = []
            for content in batch["content"]:
                try:
                    out.append(extractor(content) if extractor and content[:4] == b"%PDF" else None)
                except Exception:  # noqa: BLE001  an unreadable file is a finding, not the run's end
                    out.append(None)
            yield batch.drop(columns="content").assign(text=out)

    return files.select("path", paper.alias("p"), "content").select("path", "p.wp", "p.nr", "content").where("nr is not null").mapInPandas(texts, "path string, wp int, nr string, text string")


def heads(spark: SparkSession, path: str, characters: int) -> DataFrame:
    """path and the first characters of each text below a folder (SRC-14)."""
    texts = spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(path)
    return texts.select(F.col("_metadata.file_path").alias("path"), F.substring("value", 1, characters).alias("head"))


def is_pdf(content: Column) -> Column:
    return F.startswith(content, F.lit(b"%PDF"))


def novelty_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """pk, form of a novelty log's ministry lines (SRC-21)."""
    return lines.where(F.col(line).rlike(NOVELTY_LINE)).select(*(c for c in lines.columns if c != line), F.regexp_extract(line, NOVELTY_LINE, 1).alias("pk"), F.regexp_extract(line, NOVELTY_LINE, 2).alias("form"))


def mismatch_log(lines: DataFrame, position: str, line: str = "value") -> DataFrame:
    """The last mismatch line of each pk (SRC-22)."""
    names = ["pk", "fraktion", "parsed", "db_min", "db_anfrager", "block"]
    rows = lines.where(F.col(line).rlike(MISMATCH_LINE)).select(F.col(position).alias("_p"), *(F.regexp_extract(line, MISMATCH_LINE, i + 1).alias(n) for i, n in enumerate(names)))
    rows = rows.withColumns({"parsed": F.col("parsed").cast("int"), "db_min": F.col("db_min").cast("int")})
    return rows.groupBy("pk").agg(F.max_by(F.struct(*names), "_p").alias("_r")).select("_r.*")
