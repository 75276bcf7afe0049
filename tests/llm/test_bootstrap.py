"""Op 11 against brute force: the four patterns, and instances that contexts tell."""

import hashlib
import random
import re

import pytest

from inquirylake.llm import bootstrap
from tests.llm.conftest import texts_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MENTION = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*|[0-9]+(?:\.[0-9]+){3,}|[+(]?[0-9](?:[ ().-]{0,2}[0-9]){5,}"
LOWER = {c: c + 32 for c in range(65, 91)}


def digits(x):
    return re.sub("[^0-9]", "", x)


def luhn(x):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits(x)))) % 10 == 0


VALID = {
    "email": lambda x: True,
    "ip": lambda x: all(int(p) <= 255 for p in x.split(".")),
    "card": lambda x: 16 <= len(digits(x)) <= 19 and luhn(x),
    "phone": lambda x: 8 <= len(digits(x)) <= 15,
}


def base(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if VALID[k](m[0])]


def seed(x):
    if "@" in x:
        return "email" if re.search(r"@[A-Za-z0-9-]+\.", x) else None
    return next((k for k in ("ip", "phone", "card") if re.fullmatch(PLAIN[k], x) and VALID[k](x)), None)


def found_by_contexts(rows, rounds=3, support=3, confidence=800):
    """The spans that contexts add, for each row, by plain loops over the graph."""
    edges, places = set(), []
    for at, text in rows:
        last, matches = 0, [*re.finditer(MENTION, text)]
        for k, m in enumerate(matches):
            words = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", t.translate(LOWER)) if w]
            before, after = words(text[last : m.start()][-40:]), words(text[m.end() : matches[k + 1].start() if k + 1 < len(matches) else None][:40])
            sort = "a" if "@" in m[0] else "d" if re.fullmatch(r"[0-9]+(\.[0-9]+){3,}", m[0]) else "n"
            if len(before) > 1:
                edges.add((f"{sort} {before[-2]} {before[-1]} _", m[0]))
            if before and after:
                edges.add((f"{sort} {before[-1]} _ {after[0]}", m[0]))
            places.append((at, m.start(), m.end(), m[0]))
            last = m.end()
    known = {x: (seed(x), 1000) for _, x in edges if seed(x)}
    fits = {"a": ("email",), "d": ("ip",), "n": ("card", "phone")}
    instances = {}
    for _ in range(rounds):
        patterns = {}
        for p in {p for p, _ in edges}:
            xs = [x for q, x in edges if q == p]
            for kind in fits[p[0]]:
                mine = [known[x][1] for x in xs if x in known and known[x][0] == kind]
                if len(mine) >= support and sum(mine) // len(xs) >= confidence:
                    patterns[p, kind] = sum(mine) // len(xs)
        instances = {}
        for (p, kind), c in patterns.items():
            for x in (x for q, x in edges if q == p and not seed(x)):
                instances[x] = max(instances.get(x, (-1, 0, "")), (c, -bootstrap.KINDS.index(kind), kind))
        known = {x: k for x, k in known.items() if seed(x)} | {x: (kind, c) for x, (c, _, kind) in instances.items()}
    out = {at: [] for at, _ in rows}
    texts = dict(rows)
    for at, a, b, x in places:
        if x in instances and not any(s < b and a < e for _, s, e in base(texts[at])):
            out[at].append((instances[x][2], a, b))
    return {at: sorted(spans, key=lambda s: (bootstrap.KINDS.index(s[0]), s[1])) for at, spans in out.items()}


def spans(row, name):
    return [(s["kind"], s["start"], s["end"]) for s in row[name]]


def planted():
    """Contexts of cards, phones and addresses that seeds share with identifiers of no base kind."""
    dice = random.Random(4)
    card = lambda: next(x for x in iter(lambda: "".join(dice.choice("0123456789") for _ in range(16)), "") if luhn(x))
    rows = [f"please charge card {card()} today" for _ in range(9)] + ["please charge card 1234567890123 today", "the number 1234567890123 once more", "an order 7654321 came in"]
    rows += [f"call me: +49 30 {dice.randint(100000, 999999)} soon" for _ in range(5)] + ["call me: (030) 123456 soon", "ring back: (030) 123456 now", "ring back: 0171 5550199 now", "ring back: 0171 5550197 now", "ring back: 0171 5550197 now"]
    rows += [f"Mail to user{i}@mail.example.org, please" for i in range(4)] + ["Mail to root@localhost please", "nobody@nowhere wrote that"]
    rows += [f"order of {dice.randint(10**6, 10**7)} pieces" for _ in range(12)] + ["host at 10.0.0.1 is up", "host at 10.0.0.2 is up", "host at 10.0.0.3 is up", "host at 10.0.0.4.5 is up", "host at 300.1.1.1 is up", "host at 10.0.0.7 is up", "host at 10.0.0.8 is up"]
    return rows


HARD = [
    "a@b.c_d@e.f g@h i@j.k.l. x.y@z-1.de,m@n@o.p",
    "1.2.3.4.5.6.7.8 300.1.1.1.1 0000255.1.1.001 1.2.3 1..2.3.4 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 1 4111111111111111 12345678901234567890 411111111111111",
    "+1 (017) 555-7713, +12, +1 2, ++49 30 1234567 +1234567890123456 +49 (30) x +4 9)))))) +12345678.",
    "é+491234567é 😀4111111111111111😀 ü@b.de 😀a@b.de 😀",
    "x" * 3000 + "@" + "y" * 3000 + ".z " + "1" * 5000 + " " + "a@" * 2000 + " " + "1 " * 4000 + "+1" + " " * 3000,
    "",
    None,
    "@", "+", ".", "a@b.", "+1-2",
]


@pytest.mark.parametrize("rows", [HARD, planted()], ids=["hard", "planted"])
def test_spans(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in bootstrap.extract(df).collect()}
    more = found_by_contexts([(i, t or "") for i, t in enumerate(rows)])
    for i, text in enumerate(rows):
        assert spans(got[i], "base") == base(text or ""), text
        assert spans(got[i], "found") == more[i], text
    if rows is not HARD:
        kinds = {(rows[i][a:b], k) for i, s in more.items() for k, a, b in s}
        assert {("1234567890123", "card"), ("(030) 123456", "phone"), ("root@localhost", "email")} <= kinds
        assert not any("order" in rows[i] for i, s in more.items() if s)


def test_random_texts(spark):
    """Short texts of the characters that the patterns are about."""
    dice = random.Random(7)
    letters = ["a", "B", "0", "1", "4", "25", "@", ".", "+", "-", " ", "  ", "(", ")", "_", "%", "é", "😀", "\n", "b@c.d", "1.2.3.4", "4111111111111111", "+4930123456"]
    rows = [(i, "".join(dice.choice(letters) for _ in range(dice.randint(0, 40)))) for i in range(1500)]
    more = found_by_contexts(rows)
    for r in bootstrap.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert spans(r, "base") == base(rows[r["doc_id"]][1]), rows[r["doc_id"]][1]
        assert spans(r, "found") == more[r["doc_id"]]


@pytest.mark.parametrize("name", ["edge", "odd", "empty", "small"])
def test_rows(request, name):
    df = request.getfixturevalue(name)
    rows = bootstrap.digests(bootstrap.extract(df)).collect()
    assert len(rows) == df.count()
    if name == "odd":
        return
    texts = dict(texts_of(df))
    for r in rows:
        spans_ = base(texts[r["doc_id"]])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans_)
        assert [r[f"n_{k}"] for k in bootstrap.KINDS] == [sum(s[0] == k for s in spans_) for k in bootstrap.KINDS]
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(r["spans"].split(","))


def test_no_python_on_the_way(spark, small, capsys):
    bootstrap.digests(bootstrap.extract(small)).explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


def test_one_context_and_one_instance_in_most_rows(spark):
    """A pattern with thousands of instances, and an instance that stands in thousands of rows."""
    rows = [(i, f"write to u{i}@mail.example.org now" if i % 3 else "write to admin@intranet now") for i in range(6000)]
    got = bootstrap.extract(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(spans(r, "found") == ([("email", 9, 23)] if r["doc_id"] % 3 == 0 else []) for r in got)
    assert sum(len(r["base"]) for r in got) == 4000
