"""Keyed mutation: masked upserts, placeholder migration, deletes, and what works on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import paper


def filled(column: Column) -> Column:
    """The value, null if it is empty."""
    return F.nullif(column.cast("string"), F.lit("")).cast("string")


def upsert(current: DataFrame, new: DataFrame, key: str, mask: Sequence[str], run_at: Column, once: Sequence[str] = (), beside: Sequence[str] = ()) -> DataFrame:
    """The next version of a table (U1): masked columns of new rows, only where they say something.

    Columns outside the mask stay; rows of neither side vanish; added_at is set once, updated_at for
    each row that new touches.  Columns of once are only written in rows that are added.  Rows of
    one key are the same if they also agree in the columns beside it, where both say something.  New
    rows without a key take no part: see rejects.
    """
    new = new.where(F.col(key).isNotNull() & (F.col(key) != ""))
    old, inserted = F.col(f"c.{key}").isNotNull(), F.col(f"c.{key}").isNull()
    touched = F.col(f"n.{key}").isNotNull()
    columns = []
    for name in current.columns:
        if name == key or name in beside:
            columns.append(F.coalesce(f"c.{name}", f"n.{name}").alias(name))
        elif name == "added_at":
            columns.append(F.when(old, F.col("c.added_at")).otherwise(run_at).alias(name))
        elif name == "updated_at":
            columns.append(F.when(touched, run_at).otherwise(F.col("c.updated_at")).alias(name))
        elif name in mask or name in once:
            kind = current.schema[name].dataType
            said, kept = filled(F.col(f"n.{name}")).cast(kind), F.col(f"c.{name}")
            columns.append(F.when(inserted, said).otherwise(kept if name in once else F.coalesce(said, kept)).alias(name))
        else:
            columns.append(F.col(f"c.{name}").alias(name))
    same = F.col(f"c.{key}") == F.col(f"n.{key}")
    for name in beside:
        same &= F.coalesce(filled(F.col(f"c.{name}")) == filled(F.col(f"n.{name}")), F.lit(True))
    return current.alias("c").join(new.alias("n"), same, "full_outer").select(*columns)


def by_question(current: DataFrame, new: DataFrame, mask: Sequence[str], run_at: Column) -> DataFrame:
    """An upsert by pk in which placeholders and answers of one number are unlike rows."""
    waits = F.col("pk") == F.col("q_nr")
    return upsert(current.withColumn("_waits", waits), new.withColumn("_waits", waits), "pk", mask, run_at, beside=["_waits"]).drop("_waits")


def rejects(new: DataFrame, key: str) -> DataFrame:
    """New rows that an upsert can't take, as they have no key; a run that has any should stop or log them."""
    return new.where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == "")


def identity(hits: DataFrame, table: DataFrame) -> DataFrame:
    """Adds disposition of each search hit (J10, U2): which stored row it is and what happens.

    hits and table have q_nr and pk (a hit's pk may be null).  A placeholder is a stored row whose pk
    is its own question number.  One number may be an answer's and another question's, so an answer
    isn't told by a placeholder of its number; stored keys count once, so hits stay as many.
    """
    own = F.coalesce(F.col("pk") == F.col("q_nr"), F.lit(False))
    stored = table.groupBy(F.col("pk").alias("_pk")).agg(F.bool_or(~own).alias("_answer"), F.bool_or(own).alias("_self"))
    placeholder = table.where("pk = q_nr").select(F.col("pk").alias("_ph")).distinct()
    joined = hits.join(stored, F.col("pk") == F.col("_pk"), "left").join(placeholder, (F.col("q_nr") == F.col("_ph")) & ~own, "left")
    real = F.col("_answer") | (F.col("_self") & own)
    disposition = (
        F.when(real & F.col("_ph").isNotNull(), "drop_placeholder")
        .when(real, "update")
        .when(F.col("_ph").isNotNull() & F.col("pk").isNotNull(), "migrate")
        .when(F.col("_ph").isNotNull(), "update_placeholder")
        .when(F.col("withdrawn"), "insert_withdrawn")
        .when(F.col("pk").isNotNull(), "insert")
        .otherwise("insert_placeholder")
    )
    return joined.withColumn("disposition", disposition).drop("_pk", "_answer", "_self", "_ph")


def migrate(table: DataFrame, hits: DataFrame) -> DataFrame:
    """Re-keys placeholders whose answer has arrived, and drops those stored under both keys.

    A question may stand in several hits: it moves once, to the greatest of its answers, and goes if
    any of them is stored.  So rows never become more.  Hits without an answer (null or empty) move nothing.
    """
    answered = hits.where(filled(F.col("pk")).isNotNull())  # before the joins: those without would all meet in one task
    found = identity(answered, table).where("disposition in ('migrate', 'drop_placeholder')")
    moves = found.groupBy(F.col("q_nr").alias("_q")).agg(F.max("pk").alias("_new"), F.bool_or(F.col("disposition") == "drop_placeholder").alias("_drop"))
    joined = table.join(moves, (F.col("pk") == F.col("_q")) & (F.col("q_nr") == F.col("_q")), "left")
    kept = joined.where(~F.coalesce("_drop", F.lit(False)))
    return kept.withColumn("pk", F.coalesce("_new", "pk")).drop("_q", "_new", "_drop")


def purge_placeholders(table: DataFrame) -> DataFrame:
    """Drops placeholders whose question also has a real row (J13); real rows stay, whatever their number is beside."""
    real = table.where("pk <> q_nr").select(F.col("q_nr").alias("_q"))
    return table.join(real, (F.col("pk") == F.col("_q")) & (F.col("q_nr") == F.col("_q")), "left_anti")


def targeted(table: DataFrame, hits: DataFrame, numbers: DataFrame, mask: Sequence[str], run_at: Column) -> DataFrame:
    """The table after a new search for some questions only.

    numbers has wp and ka_nr; other hits are left aside.  Placeholders move to the answers that were
    found, then hits update or add their rows; a hit without an answer is its question's placeholder.
    """
    wanted = hits.join(numbers.select("wp", "ka_nr"), ["wp", "ka_nr"], "left_semi")
    moved = migrate(table, wanted)
    return by_question(moved, wanted.withColumn("pk", F.coalesce(filled(F.col("pk")), "q_nr")), mask, run_at)


def stale(rows: DataFrame, keys: Sequence[str], pk: str) -> DataFrame:
    """Rows whose key also stands under another pk.

    Least and greatest pk of each key tell it, so no pairs of equal keys are made.
    """
    ends = rows.groupBy(*keys).agg(F.min(pk).alias("_low"), F.max(pk).alias("_high")).where("_low <> _high").select(*keys)
    return rows.join(ends, list(keys), "left_semi")


def delete_phantoms(rows: DataFrame, phantoms: DataFrame, *keys: str) -> DataFrame:
    """Rows that no phantom matches."""
    return rows.join(phantoms.select(*keys), list(keys), "left_anti")


def preserve(original: str, kept: str) -> Column:
    """The kept value, filled once from the original."""
    return F.coalesce(filled(F.col(kept)), F.col(original).cast("string")).alias(kept)


def locked(tags: str, tag: str, old: Column, new: Column) -> Column:
    """The old value where a manual tag is set (U8)."""
    return F.when(F.array_contains(F.split(F.coalesce(F.col(tags), F.lit("")), ","), tag), old).otherwise(new)


def withdrawn(flag: str, status: str) -> Column:
    """A withdrawn question's status, whatever is stored (U4)."""
    return F.when(F.col(flag), "anfrage_zurueckgezogen").otherwise(F.col(status))


def scan_status(status: str, parsed: str) -> Column:
    """A stored status that says more is kept when a file is scanned again."""
    failed = F.when(F.col(status).isNull() | (F.col(status) == ""), "extract_failed").otherwise(F.col(status))
    kept = F.when(F.col(status).isin("extracted", "anfrage_zurueckgezogen", "no_answer_yet"), F.col(status)).otherwise("pending_enrich")
    return F.when(F.col(parsed), kept).otherwise(failed)


def fetch_candidates(rows: DataFrame, wp: int | None = None, force: bool = False) -> DataFrame:
    """Rows whose answer text is still to be fetched."""
    done = ["no_answer_yet", "anfrage_zurueckgezogen"] + ([] if force else ["extracted", "pdf_missing"])
    fit = F.col("pk").rlike(r"^\d+/\d+$") & ~F.col("status").isin(done) & (F.col("pk") != F.col("q_nr"))
    return rows.where(fit if wp is None else fit & (F.col("wp") == wp))


def paper_order(column: str) -> list[Column]:
    """Sort columns of 'wp/n' papers by number, malformed last."""
    p = paper(F.col(column))
    return [F.coalesce(p["wp"], F.lit(2**31 - 1)), F.coalesce(p["n"], F.lit(2**31 - 1))]


def form_frequency(rows: DataFrame, form: str, paper_column: str, position: str) -> DataFrame:
    """form, n, the first paper and the next three.

    Only the four first papers of each form leave a task, however often a form stands.
    """
    order = Window.partitionBy(form).orderBy(position)
    first = rows.withColumn("_k", F.row_number().over(order)).where("_k <= 4")
    listed = first.groupBy(form).agg(F.sort_array(F.collect_list(F.struct("_k", F.col(paper_column).alias("p")))).alias("l"))
    counts = rows.groupBy(form).agg(F.count("*").alias("n"))
    papers = F.transform("l", lambda x: x["p"])
    return counts.join(listed, form).select(F.col(form).alias("form"), "n", papers[0].alias("first"), F.array_join(F.slice(papers, 2, 3), ", ").alias("more"))
