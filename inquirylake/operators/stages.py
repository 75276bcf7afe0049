"""Decisions of whole stages: scanning an archive, rescuing fields, resolving and reviewing rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import dedouble, least_askers, trimmed_parts
from .extract import ALL_BLOCKS, first_block, header_fields, lexicon, minister_forms, names_found
from .joins import at, subset_match, unique
from .reconcile import HEAD, answer_before_question, blank, classify, cross_flags, header_flags, mismatch, number_in, quality, reconcile

# Columns that a scan may write of a row that is already known.
ENRICH_MASK = ["anfragetitel", "ministerium", "antworttext_quelle"]


def scan_action(row: dict[str, Column], discovery: bool = False, force: bool = False) -> Column:
    """What happens to a file of the archive, by the first rule that fits.

    row has named (the file name is a paper's), known (its key is stored), status, number, title and
    ministry as stored, text (null if it could not be read), large and answer.
    """
    complete = (F.coalesce(row["status"], F.lit("")) != "extract_failed") & ~blank(row["number"].cast("string")) & ~blank(row["title"]) & ~blank(row["ministry"])
    return (
        F.when(~row["named"], "bad_name")
        .when(~row["known"] & F.lit(not discovery), "unknown")
        .when(row["known"] & (row["status"] == "anfrage_zurueckgezogen") & F.lit(not force), "withdrawn")
        .when(row["known"] & complete & F.lit(not force), "complete")
        .when(row["text"].isNull(), "unreadable")
        .when(row["large"], "large_inquiry")
        .when(~row["answer"], "no_answer")
        .otherwise("parse")
    )


def rescue_candidates(rows: DataFrame, texts: DataFrame, key: str, wp: int | None = None) -> DataFrame:
    """Rows with open flags and a text, for a field rescue."""
    fit = (F.col("status") != "pending") & ~blank(F.col("extract_flags")) & F.col(key).rlike(r"^\d+/\d+$")
    return rows.where(fit if wp is None else fit & (F.col("wp") == wp)).join(texts.select(key), key, "left_semi")


def review_pending(rows: DataFrame) -> DataFrame:
    """Rows that wait for a verdict and have no note."""
    return rows.where((F.col("quality") == "ask_review") & blank(F.trim("note")))


def without_tag(rows: DataFrame, flags: str, tag: str) -> DataFrame:
    """Rows that a manual tag doesn't protect."""
    return rows.where(~F.array_contains(F.split(F.coalesce(F.col(flags), F.lit("")), ","), tag))


def resolve(rows: DataFrame, flags: str, row: dict[str, Column]) -> DataFrame:
    """Classifies rows that wait for a verdict; resolved ones get a note and are done.

    Dates that a flag has set count even if a later flag stays unexplained.
    """
    waits = (F.col("quality") == "ask_review") & blank(F.trim("note"))
    out = rows.withColumn("_c", classify(trimmed_parts(F.col(flags)), row))
    done = waits & F.col("_c.resolved")
    return out.withColumns(
        {
            "question_date": F.when(waits, F.coalesce("_c.question_date", "question_date")).otherwise(F.col("question_date")),
            "answer_date": F.when(waits, F.coalesce("_c.answer_date", "answer_date")).otherwise(F.col("answer_date")),
            "note": F.when(done, F.array_join("_c.notes", " | ")).otherwise(F.col("note")),
            "quality": F.when(done, "korrigiert").otherwise(F.col("quality")),
        }
    ).drop("_c")


def source_findings(asked_pdf: Column, asked_db: Column, answered_pdf: Column, answered_db: Column, nr_pdf: Column, nr_db: Column, faction_pdf: Column, faction_db: Column) -> Column:
    """Fields in which a text contradicts the table, as an array (Q15)."""
    dates = F.array_compact(F.array(F.when(mismatch(asked_pdf, asked_db), F.lit("anfragedatum")), F.when(mismatch(answered_pdf, answered_db), F.lit("antwortdatum"))))
    return F.concat(dates, header_flags(nr_pdf, nr_db, faction_pdf, faction_db, F.lit(True)))


def counters(rows: DataFrame, disposition: str) -> DataFrame:
    """How often each disposition of a run came up."""
    return rows.groupBy(disposition).agg(F.count("*").alias("n"))


#: What rows can be counted as by the verdict of a merge.
VERDICTS = ["ok", "korrigiert", "ask_review", "review", "skipped"]


def observed(rows: DataFrame, disposition: str | None, values: Sequence[str] = VERDICTS) -> tuple[DataFrame, Observation]:
    """The rows, and counters that are there once an action has run over them: no run of their own.

    Counts all rows, each of the values, and other ones together.
    """
    counts = Observation()
    each = [F.count_if(F.col(disposition) == v).alias(v) for v in values] if disposition else []
    rest = [F.count_if(~F.col(disposition).isin(*values) & (F.col(disposition) != "")).alias("other")] if disposition else []
    return rows.observe(counts, F.count(F.lit(1)).alias("rows"), *each, *rest), counts


#: Columns that merging reads or writes beside the keys.
DATES = {"anfragedatum": ("drucksache_anfrage_nr", "Anfrage"), "antwortdatum": ("drucksache_antwort_nr", "Antwort")}


def evidence(rows: DataFrame, letters: DataFrame, texts: DataFrame, key: str = "drucksache_antwort_nr") -> DataFrame:
    """Adds head and what it states (_h_*), and the dates of the letters' feet (_foot_*).

    letters has paper, kind and date; texts the key and text, which are read of extracted rows only.
    Of several letters or texts of a key the last by position counts, so rows stay as many.
    """
    heads = unique(texts.select(key, F.substring("text", 1, HEAD).alias("head"), *at(texts)), key)
    letters = unique(letters.select(*at(letters, "paper", "kind", "date")), "paper", "kind")
    parsed = header_fields(heads, "head")
    parsed = parsed.select(key, "head", *(F.col(c).alias(f"_h_{c}") for c in ("anfragedatum", "antwortdatum", "drucksache_anfrage_nr", "fraktion")))
    extracted = F.col("antworttext_status") == "extracted"
    out = rows.join(parsed, key, "left")
    out = out.withColumns({c: F.coalesce(F.when(extracted, F.col(c)), F.lit("")) for c in parsed.columns if c != key})
    for name, (paper, kind) in DATES.items():
        letter = letters.where(F.col("kind") == kind).select(F.col("paper").alias(paper), F.col("date").alias(f"_foot_{name}"))
        out = out.join(letter, paper, "left").withColumn(f"_foot_{name}", F.coalesce(f"_foot_{name}", F.lit("")))
    return out


def merge(rows: DataFrame, letters: DataFrame, texts: DataFrame, key: str = "drucksache_antwort_nr") -> DataFrame:
    """The verdict of documents and table on every row, as one plan.

    The table's dates are kept once in *_db; then the document's date counts (for a question that of
    the answer's body, else its own foot) as far as reconciling allows, but not where a manual tag
    locks it.  mismatch_flags lists what contradicts, datenqualitaet is the verdict; outcome_* tell
    how each date came about and disposition what the run counts the row as.
    """
    out = evidence(rows, letters, texts, key)
    for name in DATES:
        out = out.withColumn(f"{name}_db", F.when(blank(F.col(f"{name}_db")), F.col(name)).otherwise(F.col(f"{name}_db")))
    tags = trimmed_parts(F.col("extract_flags"))
    body = {name: F.col(f"_h_{name}") for name in DATES}
    foot = {name: F.col(f"_foot_{name}") for name in DATES}
    locked = {name: F.array_contains(tags, f"{name}_manual") for name in DATES}
    document = {"anfragedatum": F.when(blank(body["anfragedatum"]), foot["anfragedatum"]).otherwise(body["anfragedatum"]), "antwortdatum": foot["antwortdatum"]}
    for name in DATES:
        kept = F.struct(F.coalesce(name, F.lit("")).alias("chosen"), F.lit("").alias("flag"))
        out = out.withColumns({f"_pdf_{name}": document[name], f"_r_{name}": F.when(locked[name], kept).otherwise(reconcile(document[name], F.col(f"{name}_db"), name))})
    flags = [F.nullif(F.col(f"_r_{name}.flag"), F.lit("")) for name in DATES]
    flags += [cross_flags(body[name], foot[name], locked[name], f"{name}_pdf_kreuz") for name in DATES]
    flags.append(answer_before_question(F.col("_r_anfragedatum.chosen"), F.col("_r_antwortdatum.chosen")))
    header = header_flags(F.col("_h_drucksache_anfrage_nr"), F.col("drucksache_anfrage_nr"), F.col("_h_fraktion"), F.col("fraktion"), blank(F.col("head")) | number_in(F.col("head"), F.col("kleine_anfrage_nr")))
    out = out.withColumn("_flags", F.concat(F.array_compact(F.array(*flags)), header))
    verdict = quality(F.col("antworttext_status"), F.col("_flags"), F.col("notizen"), F.col("extract_flags"), F.col("datenqualitaet"))
    columns = {"mismatch_flags": F.array_join("_flags", ","), "datenqualitaet": verdict, "disposition": F.when(verdict == "", "skipped").otherwise(verdict)}
    for name in DATES:
        pdf, db = F.col(f"_pdf_{name}"), F.col(f"{name}_db")
        columns[f"outcome_{name}"] = F.when(F.col(f"_r_{name}.flag") != "", "flagged").when(~blank(pdf) & ~blank(db) & (pdf != db), "silent").when(blank(pdf) & ~blank(db), "missing").otherwise("")
    out = out.withColumns(columns).withColumns({name: F.col(f"_r_{name}.chosen") for name in DATES})
    added = ["disposition", *(f"outcome_{name}" for name in DATES)]
    return out.select(*rows.columns, *[c for c in ["mismatch_flags", "datenqualitaet", *added] if c not in rows.columns])


def resolve_auto(rows: DataFrame, letters: DataFrame, texts: DataFrame, key: str = "drucksache_antwort_nr") -> DataFrame:
    """Explains the flags of rows that wait for a verdict from their documents (Q8a over a stored table)."""
    seen = evidence(rows, letters, texts, key)
    renamed = {"anfragedatum": "question_date", "antwortdatum": "answer_date", "notizen": "note", "datenqualitaet": "quality"}
    head = F.col("head")
    row = {
        "question_body": F.col("_h_anfragedatum"),
        "question_footer": F.col("_foot_anfragedatum"),
        "question_db": F.coalesce("anfragedatum_db", F.lit("")),
        "answer_body": F.col("_h_antwortdatum"),
        "answer_footer": F.col("_foot_antwortdatum"),
        "answer_db": F.coalesce("antwortdatum_db", F.lit("")),
        "pdf_nr": F.col("_h_drucksache_anfrage_nr"),
        "db_nr": F.coalesce("drucksache_anfrage_nr", F.lit("")),
        "question": F.col("kleine_anfrage_nr"),
        "pdf_faction": F.col("_h_fraktion"),
        "faction": F.coalesce("fraktion", F.lit("")),
        "wp": F.col("wp"),
        "number_found": number_in(head, F.col("kleine_anfrage_nr")),
        "header_doubled": dedouble(head) != head,
        "text_there": head != "",
    }
    done = resolve(seen.withColumnsRenamed(renamed), "mismatch_flags", row)
    return done.withColumnsRenamed({b: a for a, b in renamed.items()}).select(*rows.columns)


def extract_members(rows: DataFrame, texts: DataFrame, lexicon: DataFrame, key: str = "drucksache_antwort_nr") -> DataFrame:
    """Fills anfrager_alle and anzahl_abgeordnete of extracted rows from their texts (X13 over a table).

    Rows with a manual tag stay.  Adds rest, what no name explains, and too_few where fewer were
    found than the table's own list tells of.  Only the blocks of askers are joined, not the texts.
    """
    mine = (F.col("antworttext_status") == "extracted") & ~F.array_contains(trimmed_parts(F.col("extract_flags")), "anfrager_manual")
    old = {c: F.col(c) for c in ("anfrager_alle", "anzahl_abgeordnete") if c in rows.columns}
    blocks = texts.where("text is not null").select(key, F.coalesce(first_block(F.col("text")), F.lit("")).alias("_asked"), *at(texts))
    kept = rows.withColumnsRenamed({c: f"_old_{c}" for c in old}).join(unique(blocks, key), key, "left")
    names = lexicon.select("wp", "fraktion", "form", "nach", "vor")
    found = names_found(kept, names, F.coalesce("_asked", F.lit("")), ["wp", "fraktion"])
    fresh = mine & F.col("_asked").isNotNull()
    out = found.withColumns({c: F.when(fresh, F.col(c)).otherwise(F.col(f"_old_{c}")) if c in old else F.when(fresh, F.col(c)) for c in ("anfrager_alle", "anzahl_abgeordnete")})
    out = out.withColumns({"rest": F.when(fresh, F.col("rest")).otherwise(""), "too_few": fresh & (F.coalesce("anzahl_abgeordnete", F.lit(0)) < least_askers(F.col("anfrager")))})
    return out.drop("_asked", *(f"_old_{c}" for c in old))


def members_to_fixed_point(rows: DataFrame, texts: DataFrame, key: str = "drucksache_antwort_nr", passes: int = 20, step: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The table of the last pass of fixed_point."""
    return fixed_point(rows, texts, key, passes, step)[0]


def fixed_point(rows: DataFrame, texts: DataFrame, key: str = "drucksache_antwort_nr", passes: int = 20, step: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] | None = None) -> tuple[DataFrame, int]:
    """Lexicon and extraction in turn until no form is new (STR-5): the table, and the number of passes.

    The first pass searches all rows.  A later one searches only rows of a term and faction that has
    gained a form, and whose block holds a word that such a form ends with; all others would find
    what they have found.  step is what searches rows, extract_members if nothing else is given.  Each
    pass is written to the scratch folder, so no plan grows and a lost executor costs one pass.
    """
    from ..streaming import scratch

    spark, folder = rows.sparkSession, scratch(rows.sparkSession)
    search = step or (lambda some, from_texts, names: extract_members(some, from_texts, names, key))
    columns = [*rows.columns, *(c for c in ("anfrager_alle", "anzahl_abgeordnete") if c not in rows.columns)]
    runs = lambda c: F.regexp_extract_all(c, F.lit(r"(\p{L}+)"), F.lit(1))
    words = texts.where("text is not null").select(key, F.explode(F.array_distinct(runs(F.substring("text", 1, ALL_BLOCKS)))).alias("_word"))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def forms(table: DataFrame) -> DataFrame:
        listed = [c for c in ("anfrager", "anfrager_alle") if c in table.columns]
        return lexicon(table.where("wp is not null and fraktion <> ''"), ["wp", "fraktion"], listed)

    known = stored(forms(rows), "forms0")
    table = stored(search(rows, texts, known).select(columns), "table0")
    for done in range(1, passes):
        now = stored(forms(table), f"forms{done}")
        new = now.join(known, ["wp", "fraktion", "form"], "left_anti").select("wp", "fraktion", F.element_at(runs("form"), -1).alias("_word")).distinct()
        if new.isEmpty():
            return table, done
        hold = words.join(new, "_word").select(key, "wp", "fraktion").distinct()
        again = table.join(hold, [key, "wp", "fraktion"], "left_semi")
        found = search(again, texts.join(again.select(key), key, "left_semi"), now).select(columns)
        table = stored(table.join(hold, [key, "wp", "fraktion"], "left_anti").select(columns).unionByName(found), f"table{done}")
        known = now
    return table, passes


def involve_ministries(rows: DataFrame, texts: DataFrame, names: DataFrame, aliases: DataFrame, key: str = "drucksache_antwort_nr") -> DataFrame:
    """Codes of all ministries that an answer names, the lead's first (X6 over a table).

    names has code, name and position; aliases alias and primary.  Forms that no name fits stay out;
    rows without a text or form keep what they have.
    """
    named = unique(minister_forms(texts.select(*at(texts, key, "text")), "text").drop("text"), key)
    forms = named.select(key, F.posexplode("forms").alias("at", "form"))
    resolved = subset_match(forms, "form", names).where("code is not null")
    listed = resolved.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda r: r["code"]).alias("_codes"))
    lead = unique(aliases.select(*at(aliases, "alias", "primary")), "alias").select(F.col("alias").alias("ministerium_kuerzel"), F.col("primary").alias("_primary"))
    out = rows.join(lead, "ministerium_kuerzel", "left").join(listed, key, "left")
    first = F.coalesce("_primary", "ministerium_kuerzel", F.lit(""))
    codes = F.array_distinct(F.filter(F.concat(F.array(first), "_codes"), lambda c: c != ""))
    changed = F.col("_codes").isNotNull()
    return out.withColumns(
        {
            "beteiligte_ministerien_kuerzel": F.when(changed, F.array_join(codes, ",")).otherwise(F.col("beteiligte_ministerien_kuerzel")),
            "beteiligte_ministerien": F.when(changed, F.size(codes)).otherwise(F.col("beteiligte_ministerien")),
        }
    ).select(*rows.columns)
