"""The filter audit against plain counting over every order, with full and with crowded sketches."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import document, table, words
from plumbline.llm import filter_audit
from plumbline.llm.filter_audit import audit, repeat_screen

NUMBERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def fails(text):
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        len(parts) < 100,
        100 * len(set(parts)) < 80 * len(parts),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        re.search(r"[#$%&*|]", text) is not None,
    )


def brute_force(rows, labels):
    quality, toxic = ({i for i, *values in labels if i is not None and values[k] == 1} for k in (0, 1))
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    found = Counter()
    parts = {row[2] or "" for row in rows}
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        again = text in first and (doc_id is None or doc_id > first[text])
        failed = dict(zip("ABCDE", (*fails(text), again), strict=True))
        for order in permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                key = (lang or "", "".join(order), step)
                found[(*key, "redundant")] += failed[letter] and gone
                if failed[letter] and not gone:
                    found[(*key, "removed")] += 1
                    found[(*key, "good_lost")] += doc_id in quality
                    found[(*key, "toxic_lost")] += doc_id in toxic
                    found[(lang or "", letter, "shapley")] += 1
                found[(*key, "unique_fails")] += failed[letter] and sum(failed.values()) == 1
                gone |= failed[letter]
                found[(*key, "kept")] += not gone
    rows = {}
    for part in parts:
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                key = (part, "".join(order), step)
                rows[key] = (*[found[(*key, name)] for name in NUMBERS[:-1]], found[(part, letter, "shapley")])
    return rows


def result(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[name] for name in NUMBERS) for r in df.collect()}


def as_rows(docs):
    return [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]


@pytest.fixture()
def labels(spark, files):
    rows = [(i, int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 400, 2)]
    rows += [(4, 1, 1), (4, 0, 0), (7, None, 1), (None, 1, 1)]
    return files(spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), "labels")


def as_labels(labels):
    return [tuple(r) for r in labels.collect()]


@pytest.fixture()
def corpus(spark, files):
    """A third of all rows share one text; other texts fail each filter, alone and together."""
    copied = " ".join(words(5, 150))
    rows = [document(i, copied, "en" if i % 2 else "de") for i in range(100)]
    for i in range(100, 300):
        text = " ".join(words(i % 90, 40 + i, 30 + 3 * i))
        text = text.upper() if i % 7 == 0 else text
        rows.append(document(i, text + (" | #1" if i % 4 == 0 else ""), [None, "", "en", "fr"][i % 4]))
    return files(table(spark, rows, 7))


def test_counts(corpus, labels):
    assert result(audit(corpus, labels)) == brute_force(as_rows(corpus), as_labels(labels))


def test_a_full_sketch_changes_nothing(corpus, labels, monkeypatch):
    monkeypatch.setattr(filter_audit, "LEAST_BITS", 6)
    monkeypatch.setattr(filter_audit, "MOST_BITS", 6)
    monkeypatch.setattr(filter_audit.masks, "__defaults__", (6,))
    assert result(audit(corpus, labels)) == brute_force(as_rows(corpus), as_labels(labels))


def test_odd_rows(odd, crowded, none, labels):
    expected = brute_force(as_rows(odd), as_labels(labels))
    assert result(audit(odd, labels)) == expected
    clash = crowded.withColumns({name: F.lit("x") for name in ("h", "g", "part", "mask", "n", "a.b", "odd name")})
    assert result(audit(clash, labels)) == expected
    assert audit(none, labels).count() == 0
    assert result(audit(odd, labels.limit(0))) == brute_force(as_rows(odd), [])


def test_equal_ids_and_null_ids(spark, files, labels):
    """Rows of one id do not remove each other; a null id follows all others, and is none's first."""
    rows = [document(8, "x y"), document(8, "x y", "de"), document(None, "x y"), document(None, "only null"), document(None, "only null")]
    docs = files(table(spark, rows))
    assert result(audit(docs, labels)) == brute_force(as_rows(docs), as_labels(labels))


def test_only_texts_that_may_repeat_pass_the_sketch(spark):
    once = spark.range(3000).select(F.xxhash64("id").alias("h"), F.xxhash64(F.lit(1), "id").alias("g"))
    twice = spark.range(10_000, 10_050).select(F.xxhash64("id").alias("h"), F.xxhash64(F.lit(1), "id").alias("g"))
    screen, bits = repeat_screen(once.unionByName(twice).unionByName(twice))

    def passing(df):
        rows = df.toPandas()
        return filter_audit._suspect(screen, bits, rows["h"].to_numpy(), rows["g"].to_numpy())

    assert passing(twice).all()
    assert np.mean(passing(once)) < 0.05
