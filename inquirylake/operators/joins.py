"""Joins and lookups: membership, fallbacks, overrides, subset and best-overlap matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ministry_tokens


def unique(rows: DataFrame, *keys: str) -> DataFrame:
    """A look-up table with one row a key: the last one by column position, which is then dropped.

    Without that column, rows of a key that say the same count once, and rows that contradict each
    other raise an error, as nothing tells which one holds.  A partial aggregate on the keys that
    the look-up joins on anyway, so it adds no shuffle.
    """
    columns = [c for c in rows.columns if c not in keys and c != "position"]
    if not columns:
        return rows.select(*keys).distinct()
    values = F.struct(*columns)
    if "position" in rows.columns:
        one = F.max_by(values, "position")
    else:
        one = F.when(F.min(values).eqNullSafe(F.max(values)), F.min(values)).otherwise(F.raise_error(F.lit(f"contradicting rows of one key ({', '.join(keys)}), and no column position")))
    return rows.groupBy(*keys).agg(one.alias("_r")).select(*keys, "_r.*")


def at(rows: DataFrame, *columns: str) -> list[str]:
    """The columns, and position if the table has it."""
    return [*columns, *(c for c in ("position",) if c in rows.columns)]


def known(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key the table has."""
    return rows.join(table.select(key), key, "left_semi")


def orphans(rows: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key the table lacks."""
    return rows.join(table.select(*keys), list(keys), "left_anti")


def alias_name(rows: DataFrame, code: str, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Adds name: of the code itself, else of the code that it is an alias of.

    names has code and name; aliases has alias and primary; of repeated codes and aliases the last
    by position counts.
    """
    names = unique(names.select(*at(names, "code", "name")), "code")
    aliases = unique(aliases.select(*at(aliases, "alias", "primary")), "alias")
    direct = names.select(F.col("code").alias(code), F.col("name").alias("_direct"))
    other = aliases.join(names, F.col("primary") == F.col("code")).select(F.col("alias").alias(code), F.col("name").alias("_other"))
    joined = rows.join(direct, code, "left").join(other, code, "left")
    return joined.withColumn("name", F.coalesce("_direct", "_other")).drop("_direct", "_other")


def explode_aliases(names: DataFrame, code: str, listed: str) -> DataFrame:
    """alias, primary from a comma list (SRC-6), and position if names has it; lines without a code have none."""
    alias = F.explode(F.transform(F.split(listed, ","), lambda x: F.trim(x)))
    rows = names.where(F.col(code) != "").select(alias.alias("alias"), F.col(code).alias("primary"), *at(names))
    return rows.where("alias <> ''")


def override(rows: DataFrame, raw: str, overrides: DataFrame, names: DataFrame) -> DataFrame:
    """Adds code and name by a raw spelling; a code without name blanks both.

    Of repeated spellings and codes the last by position counts.
    """
    names = unique(names.select(*at(names, "code", "name")), "code")
    overrides = unique(overrides.select(*at(overrides, "raw", "code")), "raw")
    both = overrides.join(names, "code", "left").select(F.col("raw").alias(raw), F.when(F.col("name").isNotNull(), F.col("code")).otherwise("").alias("code"), F.coalesce("name", F.lit("")).alias("name"))
    return rows.join(both, raw, "left")


def letter_dates(index: DataFrame, dates: DataFrame, *questions: str) -> DataFrame:
    """Adds question_letter and answer_letter from (paper, kind, date) rows, one look-up each.

    Of several letters of a paper and kind the last by position counts.  questions are columns of both
    tables that tell whose letter it is, where rows of unlike questions have one number.
    """
    dates = unique(dates.select(*at(dates, *questions, "paper", "kind", "date")), *questions, "paper", "kind")
    for kind, paper, out in (("Anfrage", "q_nr", "question_letter"), ("Antwort", "pk", "answer_letter")):
        side = dates.where(F.col("kind") == kind).select(*questions, F.col("paper").alias(paper), F.col("date").alias(out))
        index = index.join(side, [*questions, paper], "left")
    return index


def tasks(index: DataFrame) -> DataFrame:
    """One row for each document of a question: (wp, ka_nr, paper, kind).

    Malformed papers and answers that are only placeholders make no task.
    """
    rows = index.select("wp", "ka_nr", F.explode(F.array(F.struct(F.lit("Anfrage").alias("kind"), F.col("q_nr").alias("paper")), F.struct(F.lit("Antwort").alias("kind"), F.when(F.col("pk") != F.col("q_nr"), F.col("pk")).alias("paper")))).alias("t"))
    return rows.select("wp", "ka_nr", "t.paper", "t.kind").where(F.col("paper").rlike(r"^\d+/\d+$"))


def subset_match(rows: DataFrame, value: str, names: DataFrame) -> DataFrame:
    """Adds code and name of the name that has all of the value's tokens.

    Ties: the fewest tokens, then the longer name, then the smaller position of the name.
    """
    v = rows.select(value).distinct().withColumn("_v", ministry_tokens(F.col(value))).where(F.size("_v") > 0)
    c = names.withColumn("_c", ministry_tokens(F.col("name")))
    tokens = c.select("code", "name", "position", "_c", F.explode("_c").alias("_token"))
    often = tokens.groupBy("_token").agg(F.count("*").alias("_n"))
    # a name with all of a value's tokens has its rarest one, so only names with that one are met
    rarest = v.select(value, "_v", F.explode("_v").alias("_token")).join(often, "_token", "left").groupBy(value, "_v").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_token")).alias("_r")).select(value, "_v", "_r._token")
    fits = rarest.join(tokens, "_token").where(F.size(F.array_except("_v", "_c")) == 0).withColumn("c", F.size("_c"))
    best = fits.groupBy(value).agg(F.min_by(F.struct("code", "name"), F.struct("c", -F.length("name"), "position")).alias("m")).select(value, "m.*")
    return rows.join(best, value, "left")


def overlap_pairs(values: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs of token sets among which each value's best name is: _v, k, _c, best, common.

    values has the distinct sets _v; names the distinct sets _c, each with its best name.  Tokens of a
    value are taken in order of rarity, those of no name aside.  A name without the first p of them
    shares at most the others; so once names with the rarest token are met and the best of these
    shares b tokens, only names with one of the tokens 2 to m - b + 1 of m can share as many.
    """
    postings = names.select("_c", "best", F.explode("_c").alias("_token"))
    often = postings.groupBy("_token").agg(F.count("*").alias("_n"))
    tokens = values.select("_v", F.explode("_v").alias("_token")).join(often, "_token")
    ranked = tokens.groupBy("_v").agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_token"))), lambda t: t["_token"]).alias("_ranked"))
    common = F.size(F.array_intersect("_v", "_c")).alias("common")
    first = ranked.withColumn("_token", F.get("_ranked", F.lit(0))).join(postings, "_token").select("_v", "_ranked", "_c", "best", common)
    reached = first.groupBy("_v", "_ranked").agg(F.max("common").alias("b"))
    more = F.slice("_ranked", F.lit(2), F.greatest(F.size("_ranked") - F.col("b"), F.lit(0)))
    rest = reached.select("_v", "_ranked", F.explode(more).alias("_token")).join(postings, "_token")
    rest = rest.where(~F.array_contains("_c", F.get("_ranked", F.lit(0)))).select("_v", "_c", "best", common)
    return first.select("_v", "_c", "best", "common").unionByName(rest)


def best_overlap(rows: DataFrame, value: str, names: DataFrame) -> DataFrame:
    """Adds code, name, containment, jaccard of the name that overlaps most.

    Ties: containment, Jaccard, fewest tokens, then the greatest (code, name).  Without any
    overlap the names are empty and the figures 0.  Values and names of equal tokens are compared once.
    """
    spelled = rows.select(value).distinct().withColumn("_v", F.array_sort(ministry_tokens(F.col(value))))
    named = names.withColumn("_c", F.array_sort(ministry_tokens(F.col("name")))).where(F.size("_c") > 0)
    sets = named.groupBy("_c").agg(F.max(F.struct("code", "name")).alias("best"))
    pairs = overlap_pairs(spelled.select("_v").where(F.size("_v") > 0).distinct(), sets)
    c, v = F.size("_c"), F.size("_v")
    pairs = pairs.select("_v", "best", c.alias("c"), (F.col("common") / v).alias("containment"), (F.col("common") / (v + c - F.col("common"))).alias("jaccard"))
    best = pairs.groupBy("_v").agg(F.max_by(F.struct("best.code", "best.name", "containment", "jaccard"), F.struct("containment", "jaccard", -F.col("c"), "best")).alias("m"))
    joined = rows.join(spelled.join(best, "_v").select(value, "m.*"), value, "left")
    blank = {c: F.coalesce(c, F.lit("")) for c in ("code", "name")} | {c: F.bround(F.coalesce(c, F.lit(0.0)), 2) for c in ("containment", "jaccard")}
    return joined.withColumns(blank)


def first_novel(rows: DataFrame, value: str, position: str, known_values: DataFrame) -> DataFrame:
    """The first row of each value that the table doesn't have yet."""
    new = rows.join(known_values.select(value), value, "left_anti")
    order = Window.partitionBy(value).orderBy(position)
    return new.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def keep_last(rows: DataFrame, position: str, *keys: str) -> DataFrame:
    """The last row of each key (W9); a partial aggregate, so hot keys cost one row a task."""
    columns = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.max_by(columns, F.col(position)).alias("_r")).select("_r.*")


def member(value: str, values: list[str]) -> Column:
    """The value if it is canonical, else '' (J18)."""
    return F.when(F.col(value).isin(values), F.col(value)).otherwise("")
