"""Op 11: personal data by bootstrapped contexts, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")

# Fixed values of the contract, written so that each text is read once: matches can't start within a
# run of characters whose start has failed, and what is taken is never given back.
LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

#: What may be an identifier: addresses with or without a dotted host, dotted numbers, six digits or more.
MENTION = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+|(?<![0-9])[0-9]++(?:\.[0-9]++){{3,}}+|[+(]?+(?<![0-9])[0-9](?:[ ().-]{{0,2}}+[0-9]){{5,}}+"

#: Characters before and after a mention in which its context's words are looked for.
REACH = 40
#: Rounds of scoring; unlike known instances, and their share in a thousand, that a pattern needs.
ROUNDS, SUPPORT, CONFIDENCE = 3, 3, 800

SPANS = "array<struct<start:bigint,end:bigint,x:string,before:string,after:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _octets(x: Column) -> Column:
    return F.forall(F.split(x, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(256)) <= 255)


#: What a match of each kind must fulfil besides its pattern.
VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda x: F.lit(True),
    "ip": _octets,
    "card": lambda x: F.call_function("luhn_check", _digits(x)),
    "phone": lambda x: F.length(_digits(x)).between(8, 15),
}


def _located(parts: str, matches: str, keep: Callable[[Column], Column]) -> Column:
    """Start, end, match and text around of the matches to keep; parts stand between the matches.

    Positions are running sums of lengths, in code points, so no text is walked again for each match.
    """
    pairs = F.zip_with(F.col(parts), F.col(matches), lambda p, x: F.struct(p.alias("p"), x.alias("x")))
    items = F.zip_with(pairs, F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda i, after: F.struct(i["p"].alias("p"), i["x"].alias("x"), F.substring(after, 1, REACH).alias("after")))
    none = F.array().cast(SPANS)

    def step(done: Column, i: Column) -> Column:
        start = done["at"] + F.length(i["p"])
        end = start + F.length(F.coalesce(i["x"], F.lit("")))
        this = F.struct(start.alias("start"), end.alias("end"), i["x"].alias("x"), F.substring(i["p"], -REACH, REACH).alias("before"), i["after"].alias("after"))
        return F.struct(end.alias("at"), F.when(i["x"].isNotNull() & keep(i["x"]), F.concat(done["found"], F.array(this))).otherwise(done["found"]).alias("found"))

    found = F.aggregate(items, F.struct(F.lit(0).cast("long").alias("at"), none.alias("found")), step, lambda done: done["found"])
    return F.when(F.size(matches) > 0, found).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """row, doc_id, base spans by kind and mentions of each document; texts are read here alone, in their tasks."""
    patterns = {**BASE, "mention": MENTION}
    may = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")), "ip": F.contains("text", F.lit("."))}
    rows = common.with_text(docs).withColumn("row", F.monotonically_increasing_id())
    none = F.array().cast("array<string>")
    rows = rows.select("*", *(F.when(may.get(k, F.lit(True)), F.regexp_extract_all("text", F.lit(p), 0)).otherwise(none).alias(f"{k}_m") for k, p in patterns.items()))
    rows = rows.select("row", "doc_id", *(f"{k}_m" for k in patterns), *(F.when(F.size(f"{k}_m") > 0, F.split("text", p, -1)).alias(f"{k}_p") for k, p in patterns.items()))
    base = [F.transform(_located(f"{k}_p", f"{k}_m", VALID[k]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS]
    return rows.select("row", "doc_id", *base, _located("mention_p", "mention_m", lambda x: F.lit(True)).alias("mentions"))


def _words(text: Column) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def mentions(scanned: DataFrame) -> DataFrame:
    """row, start, end, x, seed (its kind, if x alone is one) and patterns of each mention.

    A pattern is lexical: the two words before, or the word before and the one after, beside the
    sort of mention (address, dotted number, digits), which tells what kinds it could be.
    """
    rows = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.start", "m.end", "m.x", _words(F.col("m.before")).alias("b"), _words(F.col("m.after")).alias("a"))
    x = F.col("x")
    dotted = r"^[0-9]+(?:\.[0-9]+){3}"
    sort = F.when(F.contains(x, F.lit("@")), "a").when(F.rlike(x, F.lit(dotted + r"(?:\.[0-9]+)*$")), "d").otherwise("n")
    seed = (
        F.when(F.contains(x, F.lit("@")), F.when(F.rlike(x, F.lit(r"@[A-Za-z0-9-]+\.")), "email"))
        .when(F.rlike(x, F.lit(dotted + "$")), F.when(_octets(x), "ip"))
        .when(F.rlike(x, F.lit(r"^\+[0-9][ ().0-9-]+[0-9]$")), F.when(VALID["phone"](x), "phone"))
        .when(F.rlike(x, F.lit("^[0-9](?:[ -]?+[0-9]){15,18}+$")), F.when(VALID["card"](x), "card"))
    )
    n, last = F.size("b"), F.element_at("b", -1)
    two = F.when(n >= 2, F.concat(sort, F.lit(" "), F.try_element_at("b", F.lit(-2)), F.lit(" "), last, F.lit(" _")))
    around = F.when((n >= 1) & (F.size("a") >= 1), F.concat(sort, F.lit(" "), last, F.lit(" _ "), F.get("a", F.lit(0))))
    return rows.select("row", "start", "end", "x", seed.alias("seed"), F.array_compact(F.array(two, around)).alias("patterns"))


def _may(kind: Column, pattern: Column) -> Column:
    """Whether a pattern's sort of mention can be of the kind."""
    sort = F.substring(pattern, 1, 1)
    return F.when(sort == "a", kind == "email").when(sort == "d", kind == "ip").otherwise(kind.isin("card", "phone"))


def learn(found: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: int = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Patterns (pattern, kind, confidence) and instances (x, kind, score) beyond the seeds.

    The graph joins each pattern with the unlike mentions that stand in it.  A pattern's confidence
    for a kind is the mean score, in thousandths, of all its mentions; seeds score 1000.  A pattern
    with enough known instances and confidence gives its confidence to what else stands in it, an
    instance takes the best one (ties: in order of kinds), and the next round counts it as known.
    """
    edges = common.checkpoint(found.select(F.explode("patterns").alias("pattern"), "x", "seed").groupBy("pattern", "x").agg(F.first("seed").alias("seed")))
    order = F.create_map(*(F.lit(v) for k, kind in enumerate(KINDS) for v in (kind, -k)))
    instances = None
    for _ in range(rounds):
        known = edges.select("pattern", "x", F.col("seed").alias("kind"), F.when(F.col("seed").isNotNull(), 1000).otherwise(0).cast("long").alias("score"))
        if instances is not None:
            named = instances.select("x", F.col("kind").alias("_kind"), F.col("score").alias("_score"))
            known = known.join(named, "x", "left").select("pattern", "x", F.coalesce("kind", "_kind").alias("kind"), F.when(F.col("kind").isNull(), F.coalesce("_score", F.lit(0).cast("long"))).otherwise(F.col("score")).alias("score"))
        each = known.groupBy("pattern", "kind").agg(F.sum("score").alias("score"), F.count("*").alias("n"))
        sums = each.groupBy("pattern").agg(F.sum("n").alias("total"), F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("score", "n", "kind"))).alias("kinds"))
        scored = sums.select("pattern", "total", F.explode("kinds").alias("k")).select("pattern", F.col("k.kind").alias("kind"), F.floor(F.col("k.score") / F.col("total")).alias("confidence"), F.col("k.n").alias("n"))
        patterns = common.checkpoint(scored.where((F.col("n") >= support) & (F.col("confidence") >= confidence) & _may(F.col("kind"), F.col("pattern"))).drop("n"))
        best = edges.where("seed is null").join(patterns, "pattern").groupBy("x").agg(F.max(F.struct(F.col("confidence").alias("score"), order[F.col("kind")].alias("order"), "kind")).alias("b"))
        instances = best.select("x", "b.kind", "b.score")
    return patterns, common.checkpoint(instances)


def extract(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: int = CONFIDENCE) -> DataFrame:
    """doc_id, base and found of each document: spans of kind, start, end (code points, end exclusive).

    base are the matches of the four patterns, leftmost and not overlapping within a kind; what fails
    a kind's rule is dropped and not tried again.  found are mentions that contexts tell: all
    places of an instance that has been learnt, but where a base span overlaps.  Both are in
    order of kind and start.

    Null and empty texts: no spans.  Repeated rows and rows that share a doc_id, or have none, each
    give a row.  Empty table: no rows.  Other columns are ignored.  A very long text is read by its
    task in steps in proportion to its length; spans that were kept are copied once for each.

    What is shuffled are mentions with the words around them, never texts.  A pattern or an instance
    that many rows hold is one edge for each unlike partner, counted before the shuffle; the joins
    over edges are left to the skew handling of the planner, as nothing after them needs their order.
    """
    scanned = common.checkpoint(scan(docs))
    found = mentions(scanned)
    _, instances = learn(found, rounds, support, confidence)
    places = found.where("seed is null").select("row", "start", "end", "x").join(instances, "x")
    order = F.create_map(*(F.lit(v) for k, kind in enumerate(KINDS) for v in (kind, k)))
    extra = places.groupBy("row").agg(F.collect_list(F.struct(order[F.col("kind")].alias("order"), "start", "end", "kind")).alias("extra"))
    span = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.concat(*(F.transform(k, span(k)) for k in KINDS))
    rows = scanned.drop("mentions").join(extra, "row", "left").select("doc_id", base.alias("base"), "extra")
    free = F.filter("extra", lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    listed = F.transform(F.array_sort(free), lambda e: F.struct(e["kind"].alias("kind"), e["start"].alias("start"), e["end"].alias("end")))
    return rows.select("doc_id", "base", F.coalesce(listed, F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")).alias("found"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(spans: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as one text, of extract's rows."""
    order = F.create_map(*(F.lit(v) for k, kind in enumerate(KINDS) for v in (kind, k)))
    every = F.array_sort(F.transform(F.concat("base", "found"), lambda s: F.struct(order[s["kind"]].alias("order"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    of = lambda k: lambda s: s["kind"] == k
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(every).alias("spans"))
