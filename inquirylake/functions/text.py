"""Text functions: white space, lists, identifiers, names, and repairs of extracted text."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns

from .patterns import HYPHENATION, MINISTRY_SUFFIX

# Spellings of factions in documents and what they are called in the table.
FACTIONS = {"BÜNDNIS 90/DIE GRÜNEN": "GRÜNE", "BÜNDNIS90/DIEGRÜNEN": "GRÜNE", "FRAKTIONSLOS": "fraktionslos", "AFD": "AfD", "AfD": "AfD", "SPD": "SPD", "CDU": "CDU", "FDP": "FDP", "DIE LINKE": "DIE LINKE"}
# The canonical factions.
CANONICAL_FACTIONS = ["CDU", "SPD", "GRÜNE", "FDP", "AfD", "fraktionslos"]
# Words that say nothing about which ministry is meant.
MINISTRY_STOP_WORDS = [
    "ministerium", "minister", "ministerin", "ministerpräsident", "ministerpräsidentin", "der", "des", "die", "das", "den", "dem",
    "für", "fuer", "und", "sowie", "oder", "landes", "nrw", "nordrhein-westfalen", "nordrhein", "westfalen", "namens",
    "landesregierung", "chef", "chefin", "staatskanzlei",
]
#: Numbers in one archive folder.
BUCKET = 2000
#: All named HTML entities, and what the numbers 128 to 159 stand for, as name -> characters.
ENTITIES = dict(html.entities.html5) | {f"#{n}": bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def squish(text: Column) -> Column:
    """White space runs as one space, none at the ends (FN-1)."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def split_list(text: Column, tolerant: bool = True) -> Column:
    """Parts of a '; ' list (FN-2)."""
    return F.split(text, r"\s*;\s*" if tolerant else "; ")


def trimmed_parts(text: Column) -> Column:
    """Parts of a comma list without white space around them; empty ones are dropped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda part: F.trim(part)), lambda part: part != "")


def remove_first(text: Column, literal: str, by: str = "") -> Column:
    """The text with the first occurrence of a literal taken out or replaced (FN-4)."""
    at = F.locate(literal, text)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(by), F.substring(text, at + len(literal), F.length(text)))).otherwise(text)


def clean_members(text: Column) -> Column:
    """A member list with a wrong separator mended and a faction that slipped in taken out."""
    return remove_first(remove_first(text, " , ", "; "), " SPD")


def decode_entities(text: Column, bare: bool = True) -> Column:
    """Tags dropped and all HTML entities decoded, named, decimal or hexadecimal (FN-5).

    The text is cut at its entities, so that nothing is decoded twice.  What is no entity stays, and
    without ``bare`` also what has no semicolon behind it.
    """
    plain, pattern = F.regexp_replace(text, r"<[^>]*>", ""), f"{ENTITY}?" if bare else ENTITY
    parts = F.zip_with(F.split(plain, pattern, -1), F.regexp_extract_all(plain, F.lit(pattern), F.lit(0)), lambda part, entity: F.concat(part, F.coalesce(_entity(entity), F.lit(""))))
    return F.when(F.contains(plain, F.lit("&")), F.array_join(parts, "")).otherwise(plain)


def _entity(entity: Column) -> Column:
    names = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
    name = F.substring(entity, 2, 40)
    digits = F.regexp_extract(entity, r"^&#([0-9]+)", 1)
    hexadecimal = F.regexp_extract(entity, r"^&#[xX]([0-9A-Fa-f]+)", 1)
    number = F.when(digits != "", digits.try_cast("long")).when(hexadecimal != "", F.conv(hexadecimal, 16, 10).try_cast("long"))
    broken = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    character = F.when(broken, F.lit("\ufffd")).when(number.isNotNull(), F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    return F.coalesce(F.try_element_at(names, F.when(number.isNotNull(), F.concat(F.lit("#"), number)).otherwise(name)), character, entity)


def paper(text: Column) -> Column:
    """'18/1006' as a struct of (wp, n); nulls if malformed (FN-6)."""
    rx = r"^(\d+)\s*/\s*(\d+)$"
    t = F.trim(text)
    return F.struct(*(F.nullif(F.regexp_extract(t, rx, i), F.lit("")).try_cast("int").alias(name) for i, name in ((1, "wp"), (2, "n"))))


def file_paper(name: Column) -> Column:
    """'MMD18-1006.pdf' as a struct of (wp, nr); nulls if it is no such file (FN-7)."""
    rx = r"^MMD(\d+)-(\d+)\.pdf$"
    wp, n = (F.nullif(F.regexp_extract(name, rx, i), F.lit("")) for i in (1, 2))
    return F.struct(wp.try_cast("int").alias("wp"), F.when(wp.isNotNull(), F.concat_ws("/", wp, n)).alias("nr"))


def bucket(n: Column, width: int = BUCKET) -> Column:
    """The archive folder 'lo-hi' of a number (FN-8)."""
    low = F.floor((n - 1) / width) * width + 1
    return F.concat_ws("-", low, low + width - 1)


def document_url(number: Column) -> Column:
    """The address of a paper's document; null if the paper is malformed (FN-9)."""
    p = paper(number)
    return F.when(p["n"].isNotNull(), F.concat(F.lit(patterns.DOCUMENTS), F.lit("MMD"), p["wp"], F.lit("-"), p["n"], F.lit(".pdf")))


def absolute(link: Column) -> Column:
    """A link of the site with its host; others stay (FN-9)."""
    return F.when(F.startswith(link, F.lit("/")), F.concat(F.lit(patterns.SITE), link)).otherwise(link)


def may_fetch(url: Column) -> Column:
    """Whether an address is one of a paper's document (FN-9)."""
    return F.coalesce(url.rlike(patterns.DOCUMENT_URL), F.lit(False))


def dedouble(head: Column) -> Column:
    """Repairs text in which every character is doubled (FN-10).

    It is taken to be so if at least 60 of the first 200 characters are there and at least 30 % of
    neighbours among them are equal; then each word keeps every second character.
    """
    sample = F.substring(head, 1, 200)
    n = F.length(sample)
    equal = n - F.length(F.regexp_replace(sample, r"(?s)(.)\1+", "$1"))  # each run of equal characters counts its neighbours
    return F.when((n >= 60) & (equal / (n - 1) >= 0.30), F.regexp_replace(head, r"(?U)(\S)\S", "$1")).otherwise(head)


def undo_hyphenation(text: Column) -> Column:
    """Joins words that lines or soft hyphens have cut; '... - und' stays (FN-11)."""
    for pattern, by in HYPHENATION:
        text = F.regexp_replace(text, pattern, by)
    return text


def open_camel(text: Column) -> Column:
    """A space between a small letter or dot and the capital after it (FN-12)."""
    return F.regexp_replace(text, r"([a-zäöüß.])([A-ZÄÖÜ])", "$1 $2")


def open_camel_more(text: Column) -> Column:
    """As open_camel, also after commas and before 'und' at a word's end (FN-12)."""
    return F.regexp_replace(F.regexp_replace(squish(text), r"([a-zäöüß.,])([A-ZÄÖÜ])", "$1 $2"), r"(?U)([a-zäöüß])(und)\s", "$1 $2 ")


def fold(text: Column) -> Column:
    """Lower case without umlauts (FN-13)."""
    out = F.lower(text)
    for letter, plain in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def ministry_tokens(text: Column) -> Column:
    """The set of words that name a ministry (FN-14)."""
    words = F.regexp_extract_all(fold(text), F.lit("([a-z]+)"), 1)
    bare = F.transform(words, lambda w: F.regexp_replace(w, MINISTRY_SUFFIX, "$1"))
    return F.array_distinct(F.filter(bare, lambda w: (F.length(w) >= 4) & ~w.isin(MINISTRY_STOP_WORDS)))


def askers(text: Column) -> Column:
    """'Becker, Horst; Klocke, Arndt u.a.' as an array of (nach, vor) (FN-15)."""
    parts = F.transform(F.split(text, "; "), lambda p: F.trim(F.regexp_replace(F.trim(p), r" u\.a\.$", "")))
    named = F.filter(parts, lambda p: F.contains(p, F.lit(", ")))
    return F.transform(named, lambda p: F.struct(F.trim(F.substring_index(p, ", ", 1)).alias("nach"), F.trim(F.substring(p, F.locate(", ", p) + 2, F.length(p))).alias("vor")))


TITLE = r"^((?:(?:Prof\.|Dr\.)\s+)+)(.*)$"


def document_name(nach: Column, vor: Column) -> Column:
    """The name as documents print it, titles first (FN-16)."""
    titled = F.trim(F.concat_ws(" ", F.trim(F.regexp_extract(nach, TITLE, 1)), vor, F.trim(F.regexp_extract(nach, TITLE, 2))))
    return F.when(nach.rlike(TITLE), titled).otherwise(F.concat_ws(" ", vor, nach))


def document_names(nach: Column, vor: Column) -> Column:
    """All forms of a name that documents may print, the full one first (FN-17)."""
    short = F.regexp_extract(F.trim(vor), r"^([^\s\-]*)", 1)
    shorter = (short != "") & (short != vor)
    bare = F.trim(F.regexp_extract(nach, TITLE, 2))
    titled = nach.rlike(TITLE)
    forms = F.array(
        document_name(nach, vor),
        F.when(shorter, document_name(nach, short)),
        F.when(titled, F.concat_ws(" ", vor, bare)),
        F.when(titled & shorter, F.concat_ws(" ", short, bare)),
    )
    return F.array_distinct(F.filter(forms, lambda f: f.isNotNull() & (f != "")))


def least_askers(text: Column) -> Column:
    """How many askers a list tells of at least: 'u.a.' after two names or more adds one (FN-18)."""
    n = F.size(askers(F.coalesce(text, F.lit(""))))
    return F.when((n >= 2) & F.coalesce(F.endswith(F.trim(text), F.lit("u.a.")), F.lit(False)), n + 1).otherwise(n)


def merge_flags(old: Column, base: Column, extra: Column) -> Column:
    """Kept old flags, then base and extra ones, each once, in order (FN-19)."""
    kept = F.filter(F.split(F.coalesce(old, F.lit("")), ","), lambda f: (f != "") & ~f.rlike("^(missing_|novel_|unknown_ministerium_kuerzel)"))
    return F.array_join(F.array_distinct(F.concat(kept, base, extra)), ",")


def sorted_flags(flags: Column) -> Column:
    """Flags as a sorted list (FN-20)."""
    return F.array_join(F.array_sort(F.array_distinct(flags)), ",")


def faction(token: Column) -> Column:
    """What a faction's spelling in a document is called in the table (FN-21)."""
    t = squish(token)
    tight = F.upper(F.replace(F.regexp_replace(t, r"\s*/\s*", "/"), F.lit(" "), F.lit("")))
    known = F.create_map(*[F.lit(x) for pair in FACTIONS.items() for x in pair])
    green = F.startswith(tight, F.lit("BÜNDNIS90")) | F.contains(tight, F.lit("GRÜNEN"))
    return F.when(green, "GRÜNE").otherwise(F.coalesce(F.try_element_at(known, F.upper(t)), t))


def residue(text: Column) -> Column:
    """What is left of a block besides filler words and punctuation (FN-23)."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"(?U)\b(?:und|Dr\.?|Prof\.?|Professor|Frau|Herr)\b", " "), r"(?U)[\s,;.]+", " "))


def count_listed(text: Column) -> Column:
    """Entries of a comma list that aren't blank."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x) != ""))
