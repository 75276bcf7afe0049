"""Fields of documents, headers, search hits and logs, as expressions on text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as p
from ..functions.dates import footer_date, german_date, heal_year, part, year_of
from ..functions.text import decode_entities, dedouble, faction, open_camel, open_camel_more, residue, squish, undo_hyphenation

#: Characters of a text in which askers are looked for: in the first block, and in all blocks.
FIRST_BLOCK, ALL_BLOCKS = 5000, 8000
#: Stands for text that a name has already been found in.
MASK = "\u0001"


def page_fields(rows: DataFrame, text: str) -> DataFrame:
    """Adds what the first pages of an answer state; '' or null for what they don't.

    What the patterns find is taken out first, so that no pattern runs twice over a text.
    """
    t = F.col(text)
    found = rows.withColumns(
        {
            "drucksache_antwort_nr": F.regexp_extract(t, p.ANSWER_PAPER, 1),
            "_number": F.regexp_extract(t, p.QUESTION_NUMBER, 0),
            "_asker": F.regexp_extract(t, p.ASKER, 0),
            "drucksache_anfrage_nr": F.regexp_extract(t, p.QUESTION_PAPER, 1),
            "_issued": F.regexp_extract(t, p.ISSUED, 1),
            "_title": F.regexp_extract(t, p.TITLE, 1),
            "_ministry": F.regexp_extract(t, p.MINISTRY, 0),
        }
    )
    found = found.withColumns(
        {
            "kleine_anfrage_nr": F.nullif(F.regexp_extract("_number", r"(?U)^Kleine Anfrage\s+(\d+)", 1), F.lit("")).try_cast("int"),
            "_asked": F.regexp_extract("_number", rf"(?U)vom\s+({p.WORDED})$", 1),
            "anfrager": squish(F.regexp_extract("_asker", p.ASKER, 1)),
            "fraktion": F.regexp_extract("_asker", p.ASKER, 2),
            "anfragetitel": squish(F.col("_title")),
            "_role": F.regexp_extract("_ministry", p.MINISTRY, 1),
            "_portfolio": squish(F.regexp_extract("_ministry", p.MINISTRY, 2)),
        }
    )
    ministry = F.when(F.col("_portfolio") == "", F.col("_role")).otherwise(F.concat_ws(" ", "_role", "_portfolio"))
    out = found.withColumns({"anfragedatum": german_date(F.col("_asked")), "antwortdatum": german_date(F.col("_issued")), "ministerium": ministry})
    return out.drop("_number", "_asker", "_issued", "_title", "_ministry", "_asked", "_role", "_portfolio")


def is_answer(text: Column) -> Column:
    return text.rlike(p.ANSWER)


def is_large_inquiry(text: Column) -> Column:
    return text.rlike(p.LARGE_INQUIRY)


def minister_sentence(text: Column) -> Column:
    """The sentence that names who answers, as one line; '' if there is none."""
    return F.regexp_extract(squish(text), p.BOUNDARY, 1)


def minister_forms(rows: DataFrame, text: str, out: str = "forms") -> DataFrame:
    """Adds 'Minister Innern', ... in order; the connective is left out."""
    found = rows.withColumn("_clean", undo_hyphenation(minister_sentence(F.col(text))))
    found = found.withColumn("_matches", F.regexp_extract_all("_clean", F.lit(p.MINISTER), F.lit(0)))
    one = r"(?U)^\S+\s+(\S+)\s+(?:für|der|des)\s+(.+)$"
    forms = F.transform("_matches", lambda m: F.concat_ws(" ", F.regexp_extract(m, one, 1), F.trim(F.regexp_extract(m, one, 2))))
    return found.withColumn(out, forms).drop("_clean", "_matches")


def header_fields(rows: DataFrame, head: str) -> DataFrame:
    """Adds dates, question paper and faction of an answer's header, however it was set."""
    found = rows.withColumn("_plain", dedouble(F.col(head)))
    found = found.withColumns(
        {
            "_letter": F.regexp_extract(minister_sentence(F.col("_plain")), p.LETTER_DATE, 1),
            "_asked": F.regexp_extract("_plain", p.ASKED_ON, 1),
            "_both": F.regexp_extract("_plain", p.FACTION_AND_PAPER, 0),
        }
    )
    found = found.withColumns({"drucksache_anfrage_nr": F.regexp_extract("_both", p.FACTION_AND_PAPER, 2), "_faction": part(F.col("_both"), p.FACTION_AND_PAPER, 1)})
    out = found.withColumns({"antwortdatum": german_date(F.col("_letter")), "anfragedatum": german_date(F.col("_asked")), "fraktion": F.coalesce(faction(F.col("_faction")), F.lit(""))})
    return out.drop("_plain", "_letter", "_asked", "_both", "_faction")


def letter_date(rows: DataFrame, page: str) -> DataFrame:
    """Adds status, original and issued: the dates of a first page's foot.

    Steps are columns of their own, so that no date's expression is written out several times.
    """
    text = F.col(page)
    steps = rows.withColumns({"_o": F.regexp_extract(text, p.LETTER_FOOT, 1), "_i": F.regexp_extract(text, p.LETTER_FOOT, 2), "_found": text.rlike(p.LETTER_FOOT)})
    steps = steps.withColumn("_issued", footer_date(F.col("_i"))).withColumn("_year", year_of(F.col("_issued")))
    steps = steps.withColumn("_original", footer_date(F.col("_o"), F.col("_year"))).withColumn("_healed", heal_year(F.col("_original"), F.col("_issued")))
    status = F.when(text.isNull(), "pdf_missing").when(~F.col("_found"), "no_match").when(F.col("_original") == "", "parse_failed").otherwise("ok")
    steps = steps.withColumn("status", status)
    original = F.when(F.col("status") == "ok", F.col("_healed")).otherwise("")
    issued = F.when(F.col("status").isin("ok", "parse_failed"), F.col("_issued")).otherwise("")
    return steps.withColumns({"original": original, "issued": issued}).drop("_o", "_i", "_found", "_issued", "_year", "_original", "_healed")


def find_names(block: Column, lexicon: Column) -> Column:
    """Names of a lexicon in a block of text, longest forms first.

    lexicon is an array of (form, nach, vor) in the order in which to look.  A form counts at its
    first place if no letter stands beside it; that place is then masked, so that shorter forms
    don't find it again.  Gives hits, in order of place, and the masked text.
    """
    start = F.struct(block.alias("text"), F.array().cast("array<struct<at:int,nach:string,vor:string>>").alias("hits"))

    def look(state: Column, name: Column) -> Column:
        text, form = state["text"], name["form"]
        size = F.length(form)

        def placed(at: Column) -> Column:
            beside = F.substring(text, at - 1, F.lit(1)).rlike(r"^\p{L}$") & (at > 1) | F.substring(text, at + size, F.lit(1)).rlike(r"^\p{L}$")
            masked = F.concat(F.substring(text, F.lit(1), at - 1), F.repeat(F.lit(MASK), size), F.substring(text, at + size, F.length(text)))
            hit = F.struct(at.cast("int").alias("at"), name["nach"].alias("nach"), name["vor"].alias("vor"))
            return F.when((at > 0) & (size > 0) & ~beside, F.struct(masked.alias("text"), F.concat(state["hits"], F.array(hit)).alias("hits"))).otherwise(state)

        return F.transform(F.array(F.position(form, text)), placed)[0]  # so that the place is looked for once

    return F.aggregate(lexicon, start, look, lambda s: F.struct(F.array_sort(s["hits"]).alias("hits"), s["text"].alias("text")))


def first_block(text: Column) -> Column:
    """The first block of askers, with lost spaces put back."""
    return open_camel(squish(F.regexp_extract(F.substring(text, 1, FIRST_BLOCK), p.ASKER_BLOCK, 1)))


def all_blocks(text: Column) -> Column:
    """All blocks of askers and what a second faction adds to each."""
    head = F.substring(text, 1, ALL_BLOCKS)
    ones, twos = (F.regexp_extract_all(head, F.lit(p.BLOCK_AND_MORE), F.lit(group)) for group in (1, 2))
    both = F.flatten(F.zip_with(ones, twos, lambda a, b: F.filter(F.array(a, b), lambda x: x.isNotNull() & (x != ""))))
    return open_camel_more(F.array_join(both, " ; "))


def names_found(rows: DataFrame, lexicon: DataFrame, block: Column, keys: list[str]) -> DataFrame:
    """Adds anfrager_alle, anzahl_abgeordnete and rest by a lexicon of (keys, form, nach, vor).

    A form can only count if its last run of letters is a whole one of the block, so an equi join
    on it finds the forms that may stand in each distinct block; those that do are searched for,
    longest first.  What a longer form covers is masked, which brings no other form into the block.
    Runs are many times the rows, and a file's size tells little of them, so they are never broadcast.
    """
    with_block = rows.withColumn("_block", block)
    blocks = with_block.select(*keys, "_block").distinct()
    runs = blocks.select(*keys, "_block", F.explode_outer(F.array_distinct(F.regexp_extract_all("_block", F.lit(r"(\p{L}+)"), F.lit(1)))).alias("_run"))  # the other kind finds runs once more to filter by them
    forms = lexicon.select(*keys, "form", "nach", "vor", F.element_at(F.regexp_extract_all("form", F.lit(r"(\p{L}+)"), F.lit(1)), -1).alias("_run"))
    order = F.sort_array(F.collect_list(F.struct((-F.length("form")).alias("size"), "form", "nach", "vor")))
    listed = runs.join(forms.hint("merge"), [*keys, "_run"]).where(F.contains("_block", F.col("form"))).groupBy(*keys, "_block").agg(F.transform(order, lambda x: F.struct(x["form"].alias("form"), x["nach"].alias("nach"), x["vor"].alias("vor"))).alias("_forms"))
    found = listed.select(*keys, "_block", find_names(F.col("_block"), F.col("_forms")).alias("_found"))
    joined = with_block.join(found, [*keys, "_block"], "left")
    hits = F.coalesce("_found.hits", F.array().cast("array<struct<at:int,nach:string,vor:string>>"))
    return joined.withColumns(
        {
            "anfrager_alle": F.array_join(F.transform(hits, lambda h: F.concat_ws(", ", h["nach"], h["vor"])), "; "),
            "anzahl_abgeordnete": F.size(hits),
            "rest": residue(F.translate(F.coalesce("_found.text", "_block"), MASK, " ")),
        }
    ).drop("_block", "_found")


def lexicon(rows: DataFrame, keys: list[str], asked: list[str]) -> DataFrame:
    """The member lexicon: forms of each name with counts and other factions.

    keys are term and faction; each column of ``asked`` is a list of 'Nach, Vor' names.
    """
    from ..functions.text import askers, document_names

    names = None
    for column in asked:
        one = rows.select(*keys, F.explode(askers(F.col(column))).alias("a")).select(*keys, "a.nach", "a.vor")
        names = one if names is None else names.unionByName(one)
    counted = names.groupBy(*keys, "nach", "vor").agg(F.count("*").alias("n_treffer"))
    term, faction_column = keys
    everywhere = counted.groupBy(term, "nach", "vor").agg(F.collect_set(faction_column).alias("_all"))
    joined = counted.join(everywhere, [term, "nach", "vor"]).withColumn("frueher_fraktion", F.array_join(F.array_sort(F.array_except("_all", F.array(faction_column))), "; "))
    forms = joined.select(*keys, "nach", "vor", F.posexplode(document_names(F.col("nach"), F.col("vor"))).alias("_i", "form"), "frueher_fraktion", "n_treffer")
    return forms.select(*keys, "nach", "vor", "form", (F.col("_i") > 0).cast("int").alias("is_alias"), "frueher_fraktion", "n_treffer")


def remediate(hits: Column, cross: Column, logged: Column, least: Column, listed: Column, n_listed: Column, withdrawn: Column, tags: Column, text_there: Column) -> Column:
    """names and tag of a second try at a row whose askers were too few.

    hits and cross are arrays of names of the own faction and of all; listed are the table's names.
    The log's minimum decides whether all factions are tried, the table's whether it was enough;
    without any name a row stays unverified.
    """
    done = F.array_contains(tags, "anfrager_manual") | F.array_contains(tags, "anfrager_unverified")
    few = F.size(hits) < logged
    wider = few & (F.size(cross) > F.size(hits))
    best = F.when(wider, cross).otherwise(hits)

    def out(names: Column, *added: Column | str) -> Column:
        marks = F.array_compact(F.array(*(F.lit(a) if isinstance(a, str) else a for a in added))) if added else F.array().cast("array<string>")
        return F.struct(F.array_join(names, "; ").alias("names"), F.array_join(marks, ",").alias("tag"))

    none = F.array().cast("array<string>")
    return (
        F.when(done, out(none))
        .when(~text_there, out(none, "anfrager_unverified"))
        .when(withdrawn, out(none, "anfrager_manual"))
        .when((F.size(best) > 0) & (F.size(best) >= least), out(best, "anfrager_manual", F.when(wider, F.lit("anfrager_cross_fraktion"))))
        .when(~F.coalesce(F.contains(listed, F.lit("u.a.")), F.lit(False)) & (n_listed > 0) & (n_listed >= least), out(F.array(listed), "anfrager_manual", "anfrager_from_db"))
        .otherwise(out(best, "anfrager_unverified"))
    )


def search_hits(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row for each result of a search page, with its fields (SRC-16, X7-X12)."""
    articles = F.regexp_extract_all(F.col(html), F.lit(r'(?s)(<article[^>]*e-search-result.*?</article>)'), F.lit(1))
    hits = pages.select(*(c for c in pages.columns if c != html), F.posexplode(articles).alias("hit", "_a"))
    lines = F.regexp_replace(F.regexp_replace("_a", r"(?s)<[^>]*>", "\n"), r"\s*\n\s*", "\n")
    text = F.trim(decode_entities(lines))
    hits = hits.withColumns({"_t": F.regexp_replace(text, r"^\n+|\n+$", ""), "_links": F.regexp_extract_all("_a", F.lit(p.HIT_LINK), F.lit(1))})
    t = F.col("_t")
    papers = F.transform("_links", lambda link: F.concat_ws("/", F.regexp_extract(link, r"MMD(\d+)-(\d+)\.pdf", 1), F.regexp_extract(link, r"MMD(\d+)-(\d+)\.pdf", 2)))
    urls = F.transform("_links", lambda link: F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(p.SITE), link)).otherwise(link))
    number = part(t, p.HIT_NUMBER, 1)
    after = F.when(number.isNull(), t).otherwise(F.regexp_replace(t, rf"(?sdU)^.*?{p.HIT_NUMBER.replace('(?mdU)^', '(?m:^)').replace('$', '(?m:$)')}", ""))
    dates = F.regexp_extract_all(t, F.lit(p.HIT_DATE), F.lit(1))
    ministry = F.regexp_extract(t, p.HIT_MINISTRY, 1)

    def listed(rx: str) -> Column:
        return F.trim(F.replace(F.regexp_replace(F.regexp_extract(t, rx, 1), r"(?U)\s+", " "), F.lit(" * "), F.lit("; ")))

    return hits.select(
        *(c for c in pages.columns if c != html),
        "hit",
        squish(decode_entities(F.regexp_extract("_a", r"(?s)<(?:strong|b)>(.*?)</(?:strong|b)>", 1))).alias("anfragetitel"),
        part(F.get(papers, F.lit(0)), r"^(\d+)/", 1).cast("int").alias("wp"),
        F.get(papers, F.lit(0)).alias("drucksache_anfrage_nr"),
        F.get(urls, F.lit(0)).alias("link_drucksache_anfrage"),
        F.get(papers, F.lit(1)).alias("drucksache_antwort_nr"),
        F.get(urls, F.lit(1)).alias("link_drucksache_antwort"),
        number.try_cast("int").alias("kleine_anfrage_nr"),
        F.trim(F.regexp_extract(after, p.HIT_ASKER, 1)).alias("anfrager"),
        F.regexp_extract(after, p.HIT_ASKER, 2).alias("fraktion"),
        german_date(F.coalesce(F.get(dates, F.lit(0)), F.lit(""))).alias("anfragedatum"),
        german_date(F.coalesce(F.get(dates, F.lit(1)), F.lit(""))).alias("antwortdatum"),
        ministry.alias("ministerium_kuerzel"),
        F.when((ministry == "") & t.rlike(p.HIT_WITHDRAWN), "anfrage_zurueckgezogen").otherwise("").alias("antworttext_status"),
        listed(p.HIT_TOPICS).alias("systematik"),
        listed(p.HIT_KEYWORDS).alias("schlagworte"),
    )


def next_page(html: Column) -> Column:
    """The link to the next result page; null on the last one (SRC-17)."""
    tag = F.regexp_extract(html, r'(?s)(<a[^>]*class="[^"]*--next[^"]*"[^>]*>)', 1)
    href = part(tag, r'href="([^"]*)"', 1)
    return F.when((tag != "") & ~F.contains(tag, F.lit("disabled")), F.when(F.startswith(href, F.lit("/")), F.concat(F.lit(p.SITE), href)).otherwise(href))
