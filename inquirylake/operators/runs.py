"""Runs over whole tables that people or earlier runs have a hand in: reviews, letters read again, second tries, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import askers, least_askers, sorted_flags, trimmed_parts
from ..sources import mismatch_log, novelty_log
from .extract import all_blocks, letter_date, names_found, remediate
from .joins import at, best_overlap, orphans, tasks, unique
from .keyed import form_frequency, targeted
from .reconcile import blank

# Names of the working table's columns, and what operators call them.
NAMES = {"drucksache_antwort_nr": "pk", "drucksache_anfrage_nr": "q_nr", "kleine_anfrage_nr": "ka_nr", "hinzugefuegt_am": "added_at", "aktualisiert_am": "updated_at"}


def reviewed(rows: DataFrame, decisions: DataFrame, run_at: Column, key: str = "drucksache_antwort_nr") -> DataFrame:
    """The table after a review (Q8b): notes and verdicts of decisions, in the order in which they were made.

    decisions has the key, session, seq, note and verdict.  An empty note skips a row; 'q' ends a
    session, and so does a missing verdict behind a note, which is kept.  Only rows that wait for a
    verdict and have no note are decided on, so of several notes the first counts, and a review that
    was broken off goes on later.  'k' or an empty verdict corrects a row, any other leaves it waiting.
    """
    said = decisions.select(key, "session", "seq", F.trim("note").alias("note"), F.lower(F.trim("verdict")).alias("verdict"))
    quits = F.lower("note") == "q"
    ends = said.groupBy("session").agg(F.min(F.when(quits, F.col("seq"))).alias("_quit"), F.min(F.when(~quits & ~blank(F.col("note")) & F.col("verdict").isNull(), F.col("seq"))).alias("_broke"))
    held = said.join(ends, "session").where(~blank(F.col("note")) & (F.col("_quit").isNull() | (F.col("seq") < F.col("_quit"))) & (F.col("_broke").isNull() | (F.col("seq") <= F.col("_broke"))))
    first = held.groupBy(key).agg(F.min_by(F.struct("note", "verdict"), F.struct("session", "seq")).alias("_d"))
    out = rows.join(first, key, "left")
    decided = (F.col("datenqualitaet") == "ask_review") & blank(F.trim("notizen")) & F.col("_d").isNotNull()
    columns = {"notizen": F.when(decided, F.col("_d.note")).otherwise(F.col("notizen")), "datenqualitaet": F.when(decided & F.col("_d.verdict").isin("", "k"), "korrigiert").otherwise(F.col("datenqualitaet"))}
    columns |= {c: F.when(decided & F.col("_d.verdict").isNotNull(), run_at).otherwise(F.col(c)) for c in ("aktualisiert_am", "updated_at") if c in rows.columns}
    return out.withColumns(columns).select(*rows.columns)


def searched_again(rows: DataFrame, hits: DataFrame, numbers: DataFrame, run_at: Column) -> DataFrame:
    """The table after a new search for some questions (U7): numbers has wp and kleine_anfrage_nr.

    What the hits say overwrites these rows; hits that aren't asked for stay aside.
    """
    renamed = {old: new for old, new in NAMES.items() if old in rows.columns}
    found = hits.withColumnsRenamed(NAMES)
    mask = [c for c in found.columns if c not in ("pk", "withdrawn", "hit")]
    if "withdrawn" not in found.columns:
        found = found.withColumn("withdrawn", F.col("antworttext_status") == "anfrage_zurueckgezogen")
    out = targeted(rows.withColumnsRenamed(renamed), found, numbers.withColumnsRenamed(NAMES), mask, run_at)
    return out.withColumnsRenamed({new: old for old, new in renamed.items()}).select(*rows.columns)


def letters(rows: DataFrame, pages: DataFrame, existing: DataFrame, force: bool = False) -> DataFrame:
    """paper, kind, wp, ka_nr, status, original, issued of each letter.

    rows has wp, ka_nr, q_nr and pk; pages paper and page, the first page, and kind where one number is
    an answer's and another question's; existing is what this gave before.  Letters that were read
    well stay; all others are read again, and what was known of them is superseded.
    """
    done = existing.where("status = 'ok'") if not force else existing.limit(0)
    todo = orphans(tasks(rows), done.select("paper", "kind"), "paper", "kind")
    keys = [c for c in ("paper", "kind") if c in pages.columns]
    read = letter_date(todo.join(unique(pages.select(*at(pages, *keys, "page")), *keys), keys, "left"), "page")
    columns = ["paper", "kind", "wp", "ka_nr", "status", "original", "issued"]
    return orphans(existing, todo, "paper", "kind").select(columns).unionByName(read.select(columns))


def tried_again(rows: DataFrame, lines: DataFrame, texts: DataFrame, lexicon: DataFrame, key: str = "drucksache_antwort_nr") -> DataFrame:
    """Rows of a mismatch log get a second try at their askers (X14 over a table, J8, J17).

    lines has value and position; texts the key and text; lexicon wp, fraktion, form, nach and vor.
    All blocks of a text are searched for names of the row's faction and of all factions; what a try
    gives, and what tags it sets, is the decision of remediate.  Logged keys that aren't stored are
    left aside, and rows with a tag of an earlier try stay.
    """
    logged = mismatch_log(lines, "position").select(F.col("pk").alias(key), F.col("db_min").alias("_logged"))
    blocks = unique(texts.where("text is not null").select(key, all_blocks(F.col("text")).alias("_block"), *at(texts)), key)
    tried = rows.select(key, "wp", "fraktion", "anfrager", "antworttext_status", "extract_flags").join(logged, key).join(blocks, key, "left")
    tried = tried.withColumn("_there", F.col("_block").isNotNull()).withColumn("_block", F.coalesce("_block", F.lit("")))
    names = lambda c: F.filter(F.split(c, "; "), lambda n: n != "")
    drop = ("anfrager_alle", "anzahl_abgeordnete", "rest")
    tried = tried.withColumnRenamed("_block", "_b")
    own = names_found(tried, lexicon.select("wp", "fraktion", "form", "nach", "vor"), F.col("_b"), ["wp", "fraktion"])
    own = own.withColumn("_own", names("anfrager_alle")).drop(*drop)
    both = names_found(own, lexicon.select("wp", "form", "nach", "vor").distinct(), F.col("_b"), ["wp"]).withColumn("_all", names("anfrager_alle")).drop(*drop)
    pairs = askers(F.coalesce("anfrager", F.lit("")))
    open_ended = F.endswith(F.trim("anfrager"), F.lit("u.a.")) | F.contains("anfrager", F.lit(" u.a."))
    listed = F.when(open_ended, F.col("anfrager")).otherwise(F.array_join(F.transform(pairs, lambda a: F.concat_ws(", ", a["nach"], a["vor"])), "; "))
    tags = trimmed_parts(F.col("extract_flags"))
    one = remediate(F.col("_own"), F.col("_all"), F.col("_logged"), least_askers(F.col("anfrager")), listed, F.size(pairs), F.col("antworttext_status") == "anfrage_zurueckgezogen", tags, F.col("_there"))
    result = both.select(key, one.alias("_r"))
    out = rows.join(result, key, "left")
    named, tagged = ~blank(F.col("_r.names")), ~blank(F.col("_r.tag"))
    old = {c: (F.col(c) if c in rows.columns else F.lit(None)) for c in ("anfrager_alle", "anzahl_abgeordnete")}
    out = out.withColumns(
        {
            "anfrager_alle": F.when(named, F.col("_r.names")).otherwise(old["anfrager_alle"].cast("string")),
            "anzahl_abgeordnete": F.when(named, F.size(F.split("_r.names", "; "))).otherwise(old["anzahl_abgeordnete"].cast("int")),
            "extract_flags": F.when(tagged, sorted_flags(F.concat(F.filter(trimmed_parts(F.col("extract_flags")), lambda f: f != ""), F.split("_r.tag", ",")))).otherwise(F.col("extract_flags")),
        }
    )
    return out.drop("_r")


def triage(lines: DataFrame, names: DataFrame, rows: DataFrame | None = None, key: str = "drucksache_antwort_nr") -> DataFrame:
    """The triage table of a novelty log (X18): form, n, first and next papers, and the name that overlaps most.

    lines has value and position; rows adds the first paper's term and question number.
    """
    counted = form_frequency(novelty_log(lines), "form", "pk", "position")
    out = best_overlap(counted, "form", names.select("code", "name"))
    if rows is not None:
        out = out.join(rows.select(F.col(key).alias("first"), "wp", "kleine_anfrage_nr"), "first", "left")
    return out
