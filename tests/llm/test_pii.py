"""Personal data: the first rules against plain Python, what is added, odd rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidelog.llm import pii as P
from tidelog.llm.queries import op12_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def numbers(text):
    return [int(c) for c in text if c in "0123456789"]


def sound_card(text):
    found = numbers(text)
    doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(found))]
    return 13 <= len(found) <= 19 and sum(doubled) % 10 == 0


def base_spans(text):
    text, spans = text or "", []
    rules = [("email", EMAIL, lambda m: True), ("ip", IP, lambda m: all(int(x) <= 255 for x in m.split(".")))]
    rules += [("card", CARD, sound_card), ("phone", PHONE, lambda m: 9 <= len(numbers(m)) <= 15)]
    for kind, rule, sound in rules:
        spans += [(kind, m.start(), m.end()) for m in rule.finditer(text) if sound(m.group())]
    return spans


CARD_NUMBER, OTHER_CARD = "4539 1488 0343 6467", "5500005555555559"
TEXTS = [
    None, "", "nothing here", "a@b.c", "x.a+b@mail7.example.com. and é34@m.de", "a@b.c%d@e.f a@b a@@b.c @b.c", "a@b.c@d.e",
    "ip 1.2.3.4 256.1.1.1 0001.02.255.0 1.2.3.4.5.6.7.8 1.2.3 1..2.3.4 300.1.2.3.4", CARD_NUMBER, f"pay {CARD_NUMBER}, 4539148803436468",
    "+1 (017) 555-7713 or +49 30 1234567, +1 23", "+1 (017) 555-7713 161.17.88.162", f"{OTHER_CARD} {OTHER_CARD}", "☃𝄞 1.2.3.4 𝄞☃ a@b.co",
    "0" * 400 + ".1.1.1", "7" * 3000, "a" * 3000 + "@", "+" * 500 + "1", "1.2.3.4 " * 700, "a.b-c@d.e-f.g " * 300, "a@" + "b." * 4000 + "c",
]


@pytest.fixture(scope="module")
def found(frame):
    rows = frame(list(enumerate(TEXTS)))
    return {r["doc_id"]: r for r in P.find_pii(rows).select("*", P.listing(F.col("spans")).alias("all")).collect()}


def test_the_first_rules(found):
    for i, text in enumerate(TEXTS):
        got = [(s["kind"], s["start"], s["end"]) for s in found[i]["spans"] if s["base"]]
        assert got == base_spans(text), text


def test_places_hold_what_was_found(found):
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        spans = found[i]["spans"]
        order = [(P.KINDS.index(s["kind"]), s["start"]) for s in spans]
        assert order == sorted(order) and found[i]["all"] == ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)
        for a, b in zip(spans, spans[1:]):
            assert a["kind"] != b["kind"] or a["end"] <= b["start"]
        assert all(0 <= s["score"] <= 1 and (s["base"] or s["score"] >= P.KEEP) for s in spans)


@pytest.mark.parametrize(
    "text, kind, span",
    [
        ("mail bob (at) example (dot) com now", "email", "bob (at) example (dot) com"),
        ("contact bob at example dot com now", "email", "bob at example dot com"),
        ("eats bob at example dot com now", "email", None),
        ("2001:0db8:85a3:0000:0000:8a2e:0370:7334", "ip", "2001:0db8:85a3:0000:0000:8a2e:0370:7334"),
        (f"x 1234567890123456 {OTHER_CARD} y", "card", OTHER_CARD),
        (f"x {CARD_NUMBER.replace(' ', '.')} y", "card", CARD_NUMBER.replace(" ", ".")),
        ("x 4539.1488.0343.6468 y", "card", None),
        ("call (212) 555-7713 today", "phone", "(212) 555-7713"),
        ("+1 (017) 555-7713 161.17.88.162", "phone", "+1 (017) 555-7713"),
        ("call 212-555-7713 today", "phone", "212-555-7713"),
        ("part 212-555-7713 today", "phone", None),
        ("to DE89 3704 0044 0532 0130 00 THEN", "iban", "DE89 3704 0044 0532 0130 00"),
        ("to GB82WEST12345698765432.", "iban", "GB82WEST12345698765432"),
        ("to DE88 3704 0044 0532 0130 00", "iban", None),
        ("SSN 123-45-6789", "ssn", "123-45-6789"),
        ("no 123-45-6789", "ssn", None),
    ],
)
def test_what_is_added(frame, text, kind, span):
    row = P.find_pii(frame([(1, text)])).first()
    got = [text[s["start"] : s["end"]] for s in row["spans"] if s["kind"] == kind and not s["base"]]
    assert got == ([span] if span else [])


def test_words_nearby_change_the_score(frame):
    rows = frame([(1, "host 1.2.3.4"), (2, "so 1.2.3.4"), (3, "version 1.2.3.4")])
    scores = {r["doc_id"]: r["spans"][0]["score"] for r in P.find_pii(rows).collect()}
    assert scores[1] > scores[2] > scores[3]


def test_odd_rows(frame, corpus):
    got = P.find_pii(frame(corpus)).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in got)) == sorted((d is None, d or 0, t or "") for d, t in corpus)
    assert P.find_pii(frame([])).count() == 0


def test_no_python_in_the_plan(frame):
    plan = P.find_pii(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_the_query(spark, frame, tmp_path):
    frame(list(enumerate(TEXTS))).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op12_pii(spark, str(tmp_path)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        spans = base_spans(TEXTS[r["doc_id"]])
        listed = [f"{kind}:{a}:{b}" for kind, a, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in P.KINDS[:4]] == [sum(s[0] == kind for s in spans) for kind in P.KINDS[:4]]
        assert set(listed) <= set(r["spans"].split(",")) | {""}
