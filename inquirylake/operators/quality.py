"""Row flags, normalisation against reference tables, and the checks of the verify suite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.text import CANONICAL_FACTIONS, count_listed, merge_flags
from .joins import alias_name, at, override, subset_match, unique
from .reconcile import blank, number_in

# Fields that a complete row has.
REQUIRED = ["drucksache_anfrage_nr", "anfrager", "fraktion", "anfragetitel", "ministerium", "anfragedatum"]
#: Findings of each check that a report lists.
LISTED = 10
# Fixed value: bytes that an answer's text has at least.
LEAST_TEXT = 200


def row_flags(factions: list[str] = CANONICAL_FACTIONS) -> Column:
    """missing_* and novel_fraktion of a row, in order, as an array (Q1).

    A ministry may be known in any of three columns and isn't asked for while there is no answer.
    """
    placeholder = ~blank(F.col("drucksache_antwort_nr")) & (F.col("drucksache_antwort_nr") == F.col("drucksache_anfrage_nr"))
    waived = (F.coalesce("antworttext_status", F.lit("")) == "anfrage_zurueckgezogen") | F.coalesce(placeholder, F.lit(False))
    unknown = blank(F.col("ministerium")) & blank(F.col("ministerium_canonical")) & blank(F.col("ministerium_kuerzel"))
    flags = [F.when(~waived & unknown if f == "ministerium" else blank(F.col(f)), F.lit(f"missing_{f}")) for f in REQUIRED]
    novel = F.when(~blank(F.col("fraktion")) & ~F.col("fraktion").isin(factions), F.lit("novel_fraktion"))
    return F.array_compact(F.array(*flags, novel))


def normalise(rows: DataFrame, names: DataFrame, aliases: DataFrame, overrides: DataFrame, factions: list[str] = CANONICAL_FACTIONS) -> DataFrame:
    """Canonical factions and ministries, involved ministries and rebuilt flags (Q2).

    A row's own code wins, by itself or as an alias, and stays as it is; else an override of the
    prose name, else a name that has all its tokens.  names has code, name and position.
    """
    coded = alias_name(rows, "ministerium_kuerzel", names.select("code", "name", "position"), aliases).withColumnRenamed("name", "_coded")
    by_prose = override(coded, "ministerium", overrides, names.select("code", "name", "position")).withColumnsRenamed({"code": "_o_code", "name": "_o_name"})
    matched = subset_match(by_prose, "ministerium", names).withColumnsRenamed({"code": "_s_code", "name": "_s_name"})
    has_code, has_prose, overridden = ~blank(F.col("ministerium_kuerzel")), ~blank(F.col("ministerium")), F.col("_o_code").isNotNull()
    code = F.when(has_code, F.col("ministerium_kuerzel")).when(has_prose & overridden, F.col("_o_code")).when(has_prose, F.coalesce("_s_code", F.lit(""))).otherwise(F.coalesce("ministerium_kuerzel", F.lit("")))
    name = F.when(has_code, F.coalesce("_coded", F.lit(""))).when(has_prose & overridden, F.col("_o_name")).when(has_prose, F.coalesce("_s_name", F.lit(""))).otherwise(F.coalesce("ministerium_canonical", F.lit("")))
    out = matched.withColumns({"_code": code, "_name": name}).withColumns({"ministerium_kuerzel": F.col("_code"), "ministerium_canonical": F.col("_name")})
    faction = F.when(blank(F.col("fraktion")), F.col("fraktion_canonical")).when(F.col("fraktion").isin(factions), F.col("fraktion")).otherwise("")
    involved = F.when(blank(F.col("beteiligte_ministerien_kuerzel")), F.col("_code")).otherwise(F.col("beteiligte_ministerien_kuerzel"))
    out = out.withColumns({"fraktion_canonical": faction, "beteiligte_ministerien_kuerzel": involved}).withColumn("beteiligte_ministerien", count_listed(F.col("beteiligte_ministerien_kuerzel")).cast("int"))
    none = blank(F.col("ministerium_canonical"))
    extra = F.array_compact(F.array(F.when(has_prose & none, F.lit("novel_ministerium")), F.when(~blank(F.col("ministerium_kuerzel")) & none, F.lit("unknown_ministerium_kuerzel"))))
    out = out.withColumn("extract_flags", merge_flags(F.col("extract_flags"), row_flags(factions), extra))
    return out.drop("_coded", "_o_code", "_o_name", "_s_code", "_s_name", "_code", "_name")


def gaps(rows: DataFrame, group: str, number: str) -> DataFrame:
    """Ranges (from, to) of numbers between 1 and each group's greatest that are missing (Q9).

    The next lower number tells where a gap is.  Numbers are dealt into blocks, so a group's
    numbers aren't ordered in one task; a block's lowest number meets the highest before it.
    """
    seen = rows.select(group, F.col(number).cast("long").alias("n")).where("n >= 1").distinct().withColumn("block", F.floor(F.col("n") / 65536))
    inside = Window.partitionBy(group, "block").orderBy("n")
    ends = seen.groupBy(group, "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    before = ends.select(group, "block", F.lag("high").over(Window.partitionBy(group).orderBy("block")).alias("_prior"))
    with_prior = seen.withColumn("_own", F.lag("n").over(inside)).join(before, [group, "block"])
    start = F.coalesce("_own", "_prior", F.lit(0)) + 1
    return with_prior.select(group, start.alias("from"), (F.col("n") - 1).alias("to")).where(F.col("from") <= F.col("to"))


def missing_numbers(rows: DataFrame, group: str, number: str) -> DataFrame:
    """The missing numbers one by one (SET-3); long gaps are cut first, so no row holds a whole one."""
    block = F.lit(1 << 16)
    cut = gaps(rows, group, number).select(group, "to", F.explode(F.sequence("from", "to", block)).alias("low"))
    return cut.select(group, F.explode(F.sequence("low", F.least("to", F.col("low") + block - 1))).alias(number))


def duplicates(rows: DataFrame, keys: list[str], pk: str, listed: int = LISTED) -> DataFrame:
    """Keys that several rows have: how many, and the first of their pks (Q10, A3)."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    order = Window.partitionBy(*keys).orderBy(pk)
    some = rows.join(counts.select(*keys), keys, "left_semi").withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= listed)
    return counts.join(some.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(pk)), ",").alias("pks")), keys)


def malformed(rows: DataFrame, pk: str) -> DataFrame:
    """Rows whose paper is set but is none (Q11)."""
    return rows.where(~blank(F.col(pk)) & ~F.col(pk).rlike(r"(?U)^\d+/\d+$"))


def negative_time(rows: DataFrame, asked: str, answered: str) -> DataFrame:
    """Rows answered before they were asked; unreadable dates don't count (Q12)."""
    return rows.where(F.coalesce(as_date(F.col(answered)) < as_date(F.col(asked)), F.lit(False)))


def short_texts(rows: DataFrame, texts: DataFrame, key: str, least: int = LEAST_TEXT) -> DataFrame:
    """Rows without a text or with one of fewer bytes (Q13)."""
    joined = rows.join(texts.select(key, F.octet_length("text").alias("n_bytes")), key, "left")
    return joined.where(F.coalesce(F.col("n_bytes") < least, F.lit(True)))


def lacks_number(rows: DataFrame, text: str, number: str, least: int = LEAST_TEXT) -> DataFrame:
    """Rows whose text is there and not too short, but doesn't name their number (Q14)."""
    return rows.where((F.octet_length(text) >= least) & ~number_in(F.col(text), F.col(number)))


#: Checks that make verification fail, in the order of a report.
FAILING = ["text_missing", "text_short", "number", "malformed", "duplicates", "negative_time"]


def verify(rows: DataFrame, texts: DataFrame, key: str = "drucksache_antwort_nr", status: str = "antworttext_status", asked: str = "anfragedatum", answered: str = "antwortdatum", group: str = "wp", number: str = "kleine_anfrage_nr") -> dict[str, DataFrame]:
    """The findings of each failing check, each with the key of its rows (Q10 to Q14, Q17).

    texts has the key and text; of several the last by position counts.  Texts are judged for extracted rows only; a key that several rows
    share is one finding, and its pks are listed.
    """
    sized = rows.where(F.col(status) == "extracted").join(unique(texts.select(*at(texts, key, "text")), key).withColumnRenamed("text", "_text"), key, "left").withColumn("_size", F.octet_length("_text"))
    numbered = rows.where((F.coalesce(group, F.lit(0)) != 0) & (F.coalesce(number, F.lit(0)) != 0))
    twice = duplicates(numbered, [group, number], key)
    return {
        "text_missing": sized.where("_size is null").select(key),
        "text_short": sized.where(F.col("_size") < LEAST_TEXT).select(key),
        "number": lacks_number(sized, "_text", number).select(key),
        "malformed": malformed(rows, key).select(key),
        "duplicates": twice.select(F.col("pks").alias(key)),
        "negative_time": negative_time(rows, asked, answered).select(key),
    }


def report(findings: dict[str, DataFrame], key: str, listed: int = LISTED) -> DataFrame:
    """check, total, listed: each check's number of findings and its first keys (SNK-9, L2).

    Findings are numbered within tasks first, so only a few rows of a check leave each task; checks
    without findings have no keys.
    """
    out = None
    for check, rows in findings.items():
        one = rows.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key"), F.spark_partition_id().alias("_task"))
        out = one if out is None else out.unionByName(one)
    order = Window.partitionBy("check", "_task").orderBy("key")
    counted = out.withColumn("_k", F.row_number().over(order)).groupBy("check", "_task").agg(F.count("*").alias("n"), F.collect_list(F.when(F.col("_k") <= listed, F.col("key"))).alias("keys"))
    summed = counted.groupBy("check").agg(F.sum("n").alias("total"), F.slice(F.array_sort(F.flatten(F.collect_list("keys"))), 1, listed).alias("keys"))
    names = out.sparkSession.createDataFrame([(c,) for c in findings], "check string")
    return F.broadcast(names).join(summed, "check", "left").select("check", F.coalesce("total", F.lit(0)).alias("total"), F.array_join(F.coalesce("keys", F.array().cast("array<string>")), ",").alias("listed"))


def exit_code(summary: DataFrame, failing: list[str], rows: int) -> int:
    """1 if the table is empty or a failing check has findings (Q17)."""
    total = summary.where(F.col("check").isin(failing)).agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    return int(rows == 0 or total > 0)
