"""Op 3: licence scans with an Aho-Corasick automaton and a parser of licence expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

# Fixed values of the contract: base phrases and labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Further notice phrases, as words, with the label that each one adds.
NOTICES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd",
    "3 clause bsd": "bsd",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons license": "cc",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "in the public domain": "public-domain",
    "into the public domain": "public-domain",
    "to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
    "released under the": "notice",
    "licensed under": "notice",
}

#: Identifier tags; what follows on the line is an expression.
TAGS = ("spdx-license-identifier:", "license-identifier:", "license:")

# Families of the public list of licence identifiers, each one a label; versions and
# variants follow from a rule.
FAMILIES = (
    "0bsd", "aal", "afl", "agpl", "apache", "apsl", "artistic", "beerware", "blueoak", "bsd", "bsl", "busl", "bzip2", "caldera", "catosl", "cc-by", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa",
    "cc-by-nd", "cc-by-sa", "cc0", "cddl", "cecill", "cern-ohl-p", "cern-ohl-s", "cern-ohl-w", "cnri-python", "cpal", "cpl", "cua-opl", "curl", "ecl", "efl", "entessa", "epl", "eudatagrid", "eupl",
    "fair", "frameworx", "freeimage", "fsfap", "ftl", "gfdl", "gpl", "hpnd", "icu", "ijg", "imagemagick", "intel", "ipa", "ipl", "isc", "jasper", "json", "lal", "lgpl", "libpng", "liliq-p",
    "linux-openib", "lpl", "lppl", "miros", "mit", "motosoto", "mpl", "ms-pl", "ms-rl", "mulanpsl", "multics", "naumen", "nasa", "ncsa", "ngpl", "nokia", "npl", "ntp", "oclc", "odbl", "odc-by", "ofl",
    "ogl-uk", "ogtsl", "oldap", "openssl", "osl", "pddl", "php", "postgresql", "psf", "python", "qpl", "rpl", "rpsl", "rscpl", "ruby", "simpl", "sissl", "sleepycat", "spl", "sspl", "tcl", "unicode",
    "unicode-dfs", "unlicense", "upl", "vim", "vsl", "w3c", "watcom", "wtfpl", "x11", "xnet", "zend", "zlib", "zlib-acknowledgement", "zpl",
)
#: A known identifier: a family, then perhaps a version and words that licence lists put behind it.
_KNOWN = re.compile(rf"({'|'.join(sorted(FAMILIES, key=len, reverse=True))})(?:[-v]?v?\d+(?:\.\d+)*)?(?:-(?:only|or|later|clause|patent|clear|lbnl|attribution|modern|variant|no|nuclear|license|international|igo|universal|[a-z]{{2}}))*\+?")
PERMISSIVE = {"0bsd", "apache", "artistic", "blueoak", "bsd", "bsl", "cc-by", "cc0", "curl", "hpnd", "isc", "mit", "ncsa", "openssl", "php", "postgresql", "psf", "public-domain", "python", "unlicense", "upl", "w3c", "wtfpl", "x11", "zlib"}

#: Bytes to those of normal words: A-Z to a-z, anything that is in no word to a space.
_WORD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_TOKEN = re.compile(r"\(|\)|/|[A-Za-z0-9][A-Za-z0-9.+\-]*")
#: Words behind an identifier that belong to it: GPL v3, BSD 3-Clause, Apache version 2.0.
_VERSION = re.compile(r"v?(\d+(?:\.\d+)*\+?(?:-clause)?)")
_OPERATORS = {"or": 1, "and": 2, "with": 3}


class Malformed(ValueError):
    """Not a licence expression."""


def postfix(expression: str, start: int = 0, end: int | None = None) -> list[str]:
    """The tokens of expression[start:end] in postfix order: with binds closest, then and, then or.

    Tokens are read one by one, so a text that is no expression costs only as far as its first fault.
    """
    out, stack, operand = [], [], True
    for found in _TOKEN.finditer(expression, start, len(expression) if end is None else end):
        token = found.group().lower()
        if token == "(":
            if not operand:
                raise Malformed
            stack.append(token)
        elif token == ")":
            if operand:
                raise Malformed
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise Malformed
            stack.pop()
        elif token in _OPERATORS:
            if operand:
                raise Malformed
            while stack and stack[-1] != "(" and _OPERATORS[stack[-1]] >= _OPERATORS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand:
                raise Malformed
            out.append(token)
            operand = False
    if operand or "(" in stack:
        raise Malformed
    return out + stack[::-1]


def prefix(line: str, start: int = 0, end: int | None = None) -> list[str]:
    """The tokens, in postfix order, of the longest expression that line[start:end] begins with; [] if there is none.

    What has been read is an expression whenever an identifier or a closing parenthesis ends it with
    none open; then at most one operator of each kind waits, so the state is cheap to keep.  Reading
    stops at the first fault, at any sign between tokens and behind a token that ends a sentence; an
    operator where an identifier should be, as in 'MIT OR OR', spoils the whole.
    """
    out, stack, kept = [], [], (0, [])
    operand, version, last, open_ = True, False, start, 0
    end = len(line) if end is None else end
    for found in _TOKEN.finditer(line, start, end):
        if line[last : found.start()].strip():
            break
        last, token = found.end(), found.group().lower()
        full, token = token.endswith("."), token.rstrip(".")
        token = "or" if token == "/" else token
        if token == "(" and operand:
            stack.append(token)
            open_ += 1
        elif token == ")" and not operand and open_:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            open_ -= 1
            version = False
        elif token in _OPERATORS and not operand:
            while stack and stack[-1] != "(" and _OPERATORS[stack[-1]] >= _OPERATORS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand, version = True, False
        elif operand and token not in _OPERATORS and token not in "()":
            out.append(token)
            operand = False
            version = True
        elif version and token in ("v", "version") and not full:
            continue
        elif version and (number := _VERSION.fullmatch(token)):
            out[-1] += f"-{number[1]}"
            version = False
        elif operand and found.group().lower() in _OPERATORS:
            return []
        else:
            break
        if not operand and not open_:
            kept = (len(out), [*stack], out[-1])
        if full:
            break
    if not kept[0]:
        return []
    return [*out[: kept[0] - 1], kept[2], *reversed(kept[1])]


def family(identifier: str) -> str | None:
    """The family of a known identifier, else None."""
    found = _KNOWN.fullmatch(identifier.rstrip("."))
    return found and found[1]


def evaluate(tokens: list[str]) -> tuple[set[str], bool]:
    """Families that a postfix expression names, and whether permissive terms alone meet it.

    Unknown identifiers name no family and are not permissive; so are exceptions, behind with.
    """
    named, _, permissive = _evaluate(tokens)
    return named, permissive


def _evaluate(tokens: list[str]) -> tuple[set[str], list[str], bool]:
    stack: list[tuple[set[str], list[str], bool]] = []
    for token in tokens:
        if token in _OPERATORS:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append(left)  # an exception adds rights to the licence before it
            else:
                long, short = (left[1], right[1]) if len(left[1]) >= len(right[1]) else (right[1], left[1])
                long.extend(short)  # the shorter one, so that deep expressions stay cheap
                stack.append((left[0] | right[0], long, (left[2] and right[2]) if token == "and" else (left[2] or right[2])))
        else:
            name = family(token)
            stack.append(({name} if name else set(), [] if name else [token], name in PERMISSIVE))
    return stack[0]


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Phrases between spaces, over UTF-8 bytes taken as Latin-1."""
    out = ahocorasick.Automaton()
    for phrase, label in BASE.items():
        out.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, True))
    for phrase, label in NOTICES.items():
        out.add_word(f" {phrase} ", (phrase.count(" ") + 1, label, False))
    out.make_automaton()
    return out


@lru_cache(maxsize=1)
def tags() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for tag in TAGS:
        out.add_word(tag, len(tag))
    out.make_automaton()
    return out


@dataclass
class Scan:
    n_words: int = 0
    base: list[tuple[int, str]] = field(default_factory=list)
    notices: list[tuple[int, str]] = field(default_factory=list)
    expressions: list[str] = field(default_factory=list)
    permissive: bool | None = None
    named: set[str] = field(default_factory=set)
    unknown: set[str] = field(default_factory=set)

    @property
    def base_labels(self) -> set[str]:
        return {label for _, label in self.base}

    @property
    def labels(self) -> set[str]:
        return self.base_labels | {label for _, label in self.notices} - {"notice"} | self.named

    @property
    def score(self) -> float:
        """How sure it is that the text states a licence: a parsed expression, else 1 - 2^-(places)."""
        return 1.0 if self.expressions else 1.0 - 0.5 ** min(50, len(self.base) + len(self.notices))


def scan(text: str) -> Scan:
    """All phrases with the word that each starts at, and all expressions after tags."""
    words = text.encode("utf-8").translate(_WORD).split()
    out = Scan(len(words))
    flat = f" {b" ".join(words).decode("latin-1")} "
    start = counted = 0
    hits = []
    for end, (size, label, is_base) in sorted(automaton().iter(flat), key=lambda hit: (hit[0], -hit[1][0])):
        counted += flat.count(" ", start, end)  # spaces before the phrase's closing one = words so far
        start = end
        if is_base:
            out.base.append((counted - size, label))
        else:
            hits.append((counted - size, -size, label))
    covered = 0
    for at, size, label in sorted(hits):  # a notice within a longer one is that one's
        if at - size > covered:
            covered = at - size
            out.notices.append((at, label))
    if ":" in text:
        lower = text.translate(_LOWER)
        longest: dict[int, int] = {}
        for end, size in tags().iter(lower):
            longest[end] = max(size, longest.get(end, 0))
        line_end = -1
        for end, size in longest.items():  # in the order of the text
            before = lower[end - size] if end >= size else " "
            if before.isalnum() or before in "_-":  # the end of a longer word
                continue
            if line_end <= end:
                line_end = lower.find("\n", end)
                line_end = len(lower) if line_end < 0 else line_end
            tokens = prefix(lower, end + 1, line_end)
            if not tokens:
                continue
            named, unknown, permissive = _evaluate(tokens)
            out.unknown.update(unknown)
            if named:
                out.expressions.append(" ".join(tokens))
                out.named |= named
                out.permissive = permissive if out.permissive is None else out.permissive and permissive
    return out


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permissive", "places", "unknown"]
    for batch in batches:
        found = [scan(text) for text in batch["text"].to_pylist()]
        starts = [[start for start, _ in x.base] for x in found]
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array([x.n_words for x in found], pa.int64()),
                pa.array(map(len, starts), pa.int64()),
                pa.array([min(x, default=None) for x in starts], pa.int64()),
                pa.array([max(x, default=None) for x in starts], pa.int64()),
                pa.array([",".join(sorted(x.base_labels)) for x in found], pa.string()),
                pa.array([",".join(sorted(x.labels)) for x in found], pa.string()),
                pa.array([x.score for x in found], pa.float64()),
                pa.array([x.expressions for x in found], pa.list_(pa.string())),
                pa.array([x.permissive for x in found], pa.bool_()),
                pa.array([sorted(x.base + x.notices) for x in found], pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))),
                pa.array([sorted(x.unknown) for x in found], pa.list_(pa.string())),
            ],
            names,
        )


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per row: counts, places, labels, expressions (postfix) and a score from 0 to 1.

    Null or empty text, or one without words: zero counts, null first_word and last_word, empty
    labels, score 0.  An expression is the longest one that follows a tag that begins a word, on its
    line: prose behind it, or a fault, ends it.  One without any known identifier adds nothing.  Unknown identifiers are
    no labels but stand in a column of their own.  Places overlap freely.  Repeated rows give equal
    rows; long texts and many tags take time in proportion; other columns are ignored.  A word is a
    run of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.
    """
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean, places array<struct<word:long,label:string>>, unknown array<string>"
    return common.arrow_map(common.with_text(docs), _rows, schema)
