"""Base patterns against Python's own engine, terms against plain counting."""

import hashlib
import os
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import document, table, words
from plumbline.llm import pii
from plumbline.llm.pii import base_spans, contexts, digest, personal_spans, sanitised

# The patterns of the contract (fixed values).
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(part) > 255 for part in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), rank, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aB.@-+0123456789 ()%_é,", max_size=80))
def test_base_spans(text):
    assert base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "text",
    [
        "write to a.b@c.de, a@b.c_d@e.f or @x.y and a@b", "1.2.3.4.5.6.7.8.9 256.1.1.1 0001.02.3.255",
        "4111 1111 1111 1111 and 4111-1111-1111-1112, 79927398713", "+1 (555) 123-4567 +12 +33 1 23 45 67 89)", "漢字a@b.co é+49 30 1234567",
    ],
)
def test_base_cases(text):
    assert base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+1" + " " * 200_000, "a@" * 50_000, "1 " * 100_000])
def test_long_texts_take_linear_time(text):
    import time

    begin = time.process_time()
    base_spans(text)
    assert time.process_time() - begin < 5


def expected_digest(rows):
    out = []
    for i, text in rows:
        spans = plain(text or "")
        counts = [sum(kind == k for *_, kind in spans) for k in PATTERNS]
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        out.append((i, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([(r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in df.collect()], key=str)


@pytest.fixture()
def telling(spark, files):
    """"zorbaxian" stands only near one address; "often" near it too, and in many other documents."""
    rows = []
    for i in range(12):
        rows.append(document(i, " ".join([*words(i, 6), "often", "zorbaxian", "q.w@mail.example", *words(50 + i, 6)])))
    rows += [document(100 + i, " ".join([*words(100 + i, 20), "often", *words(300 + i, 5)])) for i in range(1200)]
    rows += [document(4000, "zorbaxian alone"), document(4001, "call +49 30 1234567 or 10.0.0.1")]
    # Copies of one text: a rare word in them is not told by several contexts.
    rows += [document(5000 + i, "rareword near r.s@mail.example " + " ".join(words(7, 9))) for i in range(30)]
    return files(table(spark, rows))


def test_terms(telling):
    spans = personal_spans(telling, ["doc_id", "text"]).collect()
    told = {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["terms"] or ()] for r in spans}
    assert {i: t for i, t in told.items() if t} == {i: ["zorbaxian"] for i in range(12)}
    near = pii.occurrences(telling)
    terms = {(r["value"], r["term"]): r for r in pii.disclosing_terms(telling, near).collect()}
    assert set(terms) == {("email:q.w@mail.example", "zorbaxian")}
    row = terms["email:q.w@mail.example", "zorbaxian"]
    assert row["p"] == pytest.approx(12 / 13)


def test_copies_count_alike_above_and_below_the_line(spark, files):
    """Three texts of ten copies each tell a word; so do they if the text that has the word alone is copied."""
    texts = [" ".join([*words(i, 6), "zorbaxian", "q.w@mail.example", *words(50 + i, 6)]) for i in range(3)]
    rows = [document(100 * i + j, text) for i, text in enumerate(texts) for j in range(10)]
    rows += [document(1000 + j, "zorbaxian alone") for j in range(20)]
    rows += [document(2000 + i, " ".join(words(100 + i, 20))) for i in range(1200)]
    docs = files(table(spark, rows))
    terms = {(r["value"], r["term"]): r["p"] for r in pii.disclosing_terms(docs, pii.occurrences(docs)).collect()}
    assert terms == {("email:q.w@mail.example", "zorbaxian"): pytest.approx(3 / 4)}


def test_a_value_in_two_contexts_can_be_told(spark, files):
    rows = [document(i, " ".join([*words(i, 6), "zorbaxian", "q.w@mail.example", *words(50 + i, 6)])) for i in range(2)]
    rows += [document(10, " ".join([*words(30, 6), "vrakzenor", "r.s@mail.example", *words(80, 6)]))]
    rows += [document(2000 + i, " ".join(words(100 + i, 20))) for i in range(1200)]
    docs = files(table(spark, rows))
    terms = {(r["value"], r["term"]) for r in pii.disclosing_terms(docs, pii.occurrences(docs)).collect()}
    assert terms == {("email:q.w@mail.example", "zorbaxian")}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the tables of sf0.1")
def test_given_tables_have_terms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert personal_spans(docs).agg(F.sum(F.coalesce(F.size("terms"), F.lit(0)))).first()[0] > 0


def test_every_place_of_a_told_term(spark, files):
    """Also far from the value, beside nothing but another value, and a name of two characters."""
    rows = []
    for i in range(4):
        far = " ".join(words(90 + i, 12))
        rows.append(document(i, " ".join([*words(i, 6), "zorbaxian 王明 q.w@mail.example", far, "Zorbaxian and 王明."])))
    rows.append(document(10, " ".join(["q.w@mail.example", *words(200, 12), "zorbaxian"])))
    rows += [document(2000 + i, " ".join(words(100 + i, 20))) for i in range(1200)]
    docs = files(table(spark, rows))
    spans = personal_spans(docs, ["doc_id", "text"]).collect()
    told = {r["doc_id"]: [r["text"][s["start"] : s["end"]] for s in r["terms"]] for r in spans if r["terms"]}
    assert told == {**{i: ["zorbaxian", "王明", "Zorbaxian", "王明"] for i in range(4)}, 10: ["zorbaxian"]}
    texts = {r["doc_id"]: r["text"].lower() for r in sanitised(docs).collect()}
    assert not any("zorbaxian" in texts[i] for i in (0, 1, 2, 3, 10)) and "王明" not in texts[0]


def lettered(number, stem):
    return stem + "".join("bdfgklmnprstvz"[int(c)] + "aeiou"[int(c) % 5] for c in f"{number:03d}")


@pytest.fixture()
def planted(spark, files):
    """Addresses in three texts each with a code word far from them, domains with a project word, and chance words everywhere.

    A code word stands in no other text; a project word in all texts of its domain and some others. Every text has
    chance words of a pool in which a word stands in two or three texts.
    """
    draw = random.Random(17)
    rows, telling = [], set()
    for person in range(40):
        domain = person % 8
        value, code, project = f"{lettered(person, 'u')}@{lettered(domain, 'd')}.example", lettered(person, "code"), lettered(domain, "project")
        telling |= {(f"email:{value}", code), (f"domain:{lettered(domain, 'd')}.example", project)}
        for _ in range(3):
            text = words(len(rows), 30)
            text[3:3] = [value]
            text[16:16] = [code]
            text[25:25] = [project]
            rows.append(text)
    for domain in range(8):
        rows += [[*words(len(rows) + k, 20), lettered(domain, "project")] for k in range(5)]
    rows += [words(5000 + k, 30) for k in range(1200)]
    # One address in two texts that share a passage, and its copies: nothing is told by them.
    passage = words(9999, 30)
    rows += [[*passage, "solo@one.example", *passage[:8], lettered(k, "x")] for k in range(2)] * 3
    for row in rows:
        for _ in range(2):
            row.insert(draw.randrange(len(row)), lettered(draw.randrange(999), "chance"))
    return files(table(spark, [document(i, " ".join(row)) for i, row in enumerate(rows)], 4)), telling


def told_pairs(docs):
    frequency = pii.document_frequency(docs)
    rows = pii.disclosing_words(pii.evidence(docs), *frequency).collect()
    return {(r["entity"], r["term"]): r["p"] for r in rows}


def test_planted_words_are_told_and_chance_is_not(planted):
    docs, telling = planted
    told = told_pairs(docs)
    right = {pair for pair in told if pair in telling}
    # A code word also tells of the domain of its one value, and a project word of it may.
    beside = {(e, t) for e, t in told if e.startswith("domain:") and t.startswith("code")}
    assert len(right) / len(telling) >= 0.9
    assert len(right) / max(1, len(set(told) - beside)) >= 0.95
    assert not any(t.startswith(("chance", "x")) or "solo@" in e for e, t in told)


def test_terms_are_generalised_to_what_they_tell_of(planted):
    docs, _ = planted
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    after = {r["doc_id"]: r["text"] for r in sanitised(docs).collect()}
    first = [i for i, text in before.items() if lettered(0, "code") in text]
    assert len(first) == 3
    for i in first:
        assert lettered(0, "code") not in after[i] and "[EMAIL]" in after[i]
        assert lettered(0, "project") not in after[i] and "[ORGANISATION]" in after[i]
    # Where no address of the domain stands, the word tells nothing.
    alone = [i for i, text in before.items() if lettered(0, "project") in text and "@" not in text]
    assert alone and all(lettered(0, "project") in after[i] for i in alone)


def test_broader_entities():
    assert pii.broader("email", "A.b@Mail.Example") == "domain:mail.example"
    assert pii.broader("ip", "10.20.30.40") == "network:10.20.30"
    assert pii.broader("card", "4111 1111-1111 1111") == "issuer:411111"
    assert pii.broader("phone", "+49 30 1234567") == "exchange:4930123"


def test_a_value_in_every_text_is_told_by_nothing(spark, files):
    docs = files(table(spark, [document(i, " ".join([*words(i, 12), "a@b.example"])) for i in range(40)]))
    assert told_pairs(docs) == {}


def test_digest(telling):
    rows = [(r["doc_id"], r["text"]) for r in telling.collect()]
    result = digest(personal_spans(telling))
    assert found(result) == expected_digest(rows)
    texts = dict(rows)
    for r in result.collect():
        base = [f"{k}:{a}:{b}" for a, b, k in plain(texts[r["doc_id"]])]
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("term:")] == base
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_sanitised(telling):
    texts = {r["doc_id"]: r["text"] for r in sanitised(telling).collect()}
    assert "zorbaxian" not in texts[0] and "[EMAIL]" in texts[0]
    assert texts[4000] == "zorbaxian alone"
    assert texts[4001] == "call [PHONE] or [IP]"


def test_contexts_of_many_values_take_linear_time():
    import time

    text = "word a.b@c.de " * 20_000
    begin = time.process_time()
    assert len(list(contexts(text, base_spans(text)))) > 100_000
    assert time.process_time() - begin < 20


def test_short_words_do_not_shorten_the_reach():
    text = "one two three four five six as to a.b@c.de of in seven eight 王明 nine ten eleven"
    found_terms = [t for _, _, t, *_ in contexts(text, base_spans(text))]
    assert found_terms == "two three four five six as to of in seven eight 王明 nine ten".split()


def test_contexts_leave_values_out():
    text = "alpha beta x.y@z.com gamma u.v@w.net delta"
    found_terms = [t for _, _, t, *_ in contexts(text, base_spans(text))]
    assert found_terms == ["alpha", "beta", "gamma", "delta"] * 2


def test_odd_documents(odd, crowded, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(digest(personal_spans(crowded))) == expected_digest(rows)
    assert sanitised(crowded).count() == len(rows)
    assert personal_spans(none).count() == 0
