import hashlib
import random
import re

import pytest

from sluice.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    """The contract's patterns, read plainly."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), list(PATTERNS).index(kind), m.end()))
    return sorted(out)


def test_plain_finds_match_the_patterns(documents):
    for r in documents.collect():
        assert pii.detect(r.text) == brute(r.text)


def test_random_strings_match_the_patterns():
    r = random.Random(4)
    for _ in range(20_000):
        text = "".join(r.choice("a.@-+ 1204()5") for _ in range(r.randint(0, 45)))
        assert pii.detect(text) == brute(text), text
    for _ in range(5_000):
        text = "".join(r.choice("0123456789 -.") for _ in range(60))
        assert pii.detect(text) == brute(text), text


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("mail john.doe [at] example [dot] com now", ("email", "john.doe [at] example [dot] com")),
        ("mail john (AT) mail.example (dot) org.", ("email", "john (AT) mail.example (dot) org")),
        ("write jane at mail dot example dot com, yes", ("email", "jane at mail dot example dot com")),
        ("jane arroba correo punto es", ("email", "jane arroba correo punto es")),
        ("jоhn@exаmple.com", ("email", "jоhn@exаmple.com")),
        ("ｊane＠example．com", ("email", "ｊane＠example．com")),
        ("ja​ne@exa‍mple.com!", ("email", "ja​ne@exa‍mple.com")),
        ("call plus one five five five two three four five six seven eight", ("phone", None)),
        ("ip ١٩٢.168.0.1 there", ("ip", "١٩٢.168.0.1")),
        ("ip one nine two dot one six eight dot one dot two", ("ip", "one nine two dot one six eight dot one dot two")),
        ("card four one one one one one one one one one one one one one one one end", ("card", None)),
        ("𝟒𝟏𝟏𝟏 1111 1111 1111", ("card", "𝟒𝟏𝟏𝟏 1111 1111 1111")),
    ],
)
def test_disguises_are_found_at_their_source(text, span):
    plain = pii.detect(text)
    kinds = {(pii.KINDS[k], text[a:b]) for a, k, b in pii.disguised(text, plain)}
    kind, source = span
    if source is None:
        assert [k for k, _ in kinds] == [kind]
        source = next(s for _, s in kinds)
        assert len(source.split()) >= 11
    else:
        assert (kind, source) in kinds


@pytest.mark.parametrize(
    "text",
    ["we met at noon dot", "look at this point by point", "one two buckle my shoe", "un deux trois soleil", "a [at] b", "é è ü ñ ß at the thing", "plain a@b.co stays"],
)
def test_ordinary_text_has_no_added_finds(text):
    assert pii.disguised(text, pii.detect(text)) == []


def without_hints(text, monkeypatch):
    with monkeypatch.context() as m:
        for hint in ("_has_glyphs", "_spells", "_disguises"):
            m.setattr(pii, hint, lambda _: True)
        return pii.disguised(text, pii.detect(text))


def test_hints_lose_nothing(monkeypatch):
    digits = "four nine one five one two three four five six seven".split()
    gaps = [" ", "\t", "\n", ",", ".", "-", ", ", " ,", " - ", "...", "\u00a0", "\u2003,"]
    texts = ["plus " + gap.join(digits) + " end" for gap in gaps]
    texts += [f"anna{a}at{a}firma{b}dot{b}com" for a in (" ", "\t", "\n") for b in (" ", "\t", "\n", "\u00a0")]
    texts += [f"anna@firma{a}{dot}{a}de" for a in (" ", "\n") for dot in ("dot", "punkt", "Punkt", "point", "punto", "PO\u0130NT")]
    texts += ["anna AROBASE firma point fr", "anna aroba\u017fe firma po\u0131nt fr", "+1 (four five six) 234 5678"]
    texts += ["plus " + " ".join(digits).replace("six", "\u017fix")]
    for text in texts:
        found = without_hints(text, monkeypatch)
        assert found and pii.disguised(text, pii.detect(text)) == found, text
    r = random.Random(8)
    parts = [*digits, *gaps, "plus", "dot", "punkt", "at", "arroba", "@", "a@b", "(", ")", "x", "com", "+1", "10", "/", "_"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) + r.choice(["", " ", r.choice(gaps)]) for _ in range(r.randint(3, 25)))
        assert pii.disguised(text, pii.detect(text)) == without_hints(text, monkeypatch), text


def test_long_runs_take_linear_time():
    for text in ("a" * 1_000_000, "1" * 1_000_000, "@" * 300_000, "a@" * 300_000, "+1 " * 200_000, "one " * 100_000, "at " * 200_000, "x [at] " * 50_000):
        found = pii.detect(text)
        pii.disguised(text, found)


def test_result(spark, make):
    rows = [(1, "a@b.co +1 (743) 555-3824"), (2, None), (2, ""), (None, "10.0.0.1 x [at] y [dot] org"), (3, "🙂 a@b.co")]
    docs = make(rows).withColumnRenamed("source", "spans")
    got = {(r.doc_id, r.spans): r for r in pii.personal_data(docs).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert got[2, ""].base_sha256 == empty and pii.personal_data(docs).count() == 5
    one = got[1, "email:0:6,phone:7:24"]
    assert (one.n_email, one.n_phone, one.n_ip, one.n_card, one.n_added) == (1, 1, 0, 0, 0)
    assert one.base_sha256 == hashlib.sha256(one.spans.encode()).hexdigest()
    other = got[None, "ip:0:8,email:9:27"]
    assert (other.n_ip, other.n_email, other.n_added) == (1, 0, 1)
    assert other.base_sha256 == hashlib.sha256(b"ip:0:8").hexdigest()
    assert (3, "email:2:8") in got
    assert pii.personal_data(docs.limit(0)).count() == 0
