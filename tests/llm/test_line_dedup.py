"""Repeated lines against a dictionary of all lines; the perfect hash on its own."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from helpers import document, table, words
from plumbline.llm import line_dedup
from plumbline.llm.line_dedup import LineIndex, PerfectHash, without_repeated_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in text.split("\n"):
            holders[line.strip(" \t\n\x0b\x0c\r").translate(LOWER)].add(float("-inf") if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        own, kept = float("-inf") if doc_id is None else doc_id, []
        for line in text.split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if len(key) < 20 or len(holders[key]) < 3 or max(holders[key]) == own:
                kept.append(line)
        count = text.count("\n") + 1
        body = "\n".join(kept)
        out.append((doc_id, count, count - len(kept), body, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"], r["kept_sha256"]) for r in df.collect()], key=str)


@pytest.fixture()
def pages(spark, files):
    """One line in a third of all documents and twice in some, lines in two and three, other case and white space, short lines."""
    rows = []
    for i in range(240):
        lines = [" ".join(words(1000 + i, 8)), "short line", ""]
        if i % 3 == 0:
            lines += ["All rights reserved by the Owner of This Page", "x"] * (1 + i % 2)
        lines += [f"shared by pairs and triples {i // 2} é", f"\t SHARED by {i // 3} Triples and More\r"]
        lines += ["漢" * 19, "字" * 20, "ÄÖÜ" * 7 if i % 2 else "äöü" * 7]
        rows.append(document(i, "\n".join(lines)))
    rows += [document(5000 + i, "\n".join(f"a page that stands five times, line {k}" for k in range(30))) for i in range(5)]
    return files(table(spark, rows, 5))


def test_lines(pages):
    result = found(without_repeated_lines(pages))
    assert result == brute_force(pages)
    assert sum(r[2] for r in result) > 300


def test_many_shards_and_bundles(pages, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 20)
    monkeypatch.setattr(line_dedup, "BUNDLE_LINES", 50)
    assert found(without_repeated_lines(pages)) == brute_force(pages)


def test_odd_rows(spark, files, odd, crowded, none):
    assert found(without_repeated_lines(odd)) == brute_force(odd)
    more = crowded.withColumns({name: crowded["source"] for name in ("lines", "bundle", "doc", "shard", "odd name", "a.b")})
    assert found(without_repeated_lines(more)) == brute_force(odd)
    assert without_repeated_lines(none).count() == 0
    # Repeated rows and rows without an id: one document each time, the null id before all others.
    line = "a line of more than twenty characters"
    rows = [document(3, line)] * 4 + [document(None, line), document(None, f"{line}\n\n")]
    docs = files(table(spark, rows), "few")
    assert found(without_repeated_lines(docs)) == brute_force(docs)
    docs = files(table(spark, [*rows, document(-5, f"{line}\nx")]), "three")
    assert found(without_repeated_lines(docs)) == brute_force(docs)
    assert sum(r["n_dropped"] for r in without_repeated_lines(docs).collect()) == 3


def test_other_limits(pages):
    result = without_repeated_lines(pages, least=5, documents=2)
    lines = {r["doc_id"]: r["kept"].split("\n") for r in result.collect()}
    assert "short line" in lines[239] and not any("short line" in lines[i] for i in range(239))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 100_000])
def test_the_hash_is_minimal_and_perfect(n):
    keys = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    places = PerfectHash.over(np.unique(keys))
    numbers = places.numbers(np.unique(keys))
    assert sorted(numbers.tolist()) == list(range(len(np.unique(keys))))
    if n >= 1000:
        assert len(places.words) * 64 < 5 * n


def test_strangers_are_told_by_their_fingerprint():
    draw = np.random.default_rng(1)
    lines = draw.integers(0, 2**64, (5000, 2), dtype=np.uint64).view(line_dedup._LINE).ravel()
    counts = np.arange(5000) % 4
    index = LineIndex.over(lines, counts, np.arange(5000) * 10, 3)
    index = LineIndex.of(dict(zip([f.split()[0] for f in LineIndex.SCHEMA.split(", ")], index.row(0), strict=True)))
    frequent, keepers = index.probe(lines)
    assert (frequent == (counts == 3)).all() and (keepers == np.flatnonzero(counts == 3) * 10).all()
    strangers = draw.integers(0, 2**64, (20_000, 2), dtype=np.uint64).view(line_dedup._LINE).ravel()
    assert not index.probe(strangers)[0].any()


def test_clashing_first_halves():
    """Keys are mixed from both halves of a line's hash, with a salt that keeps them apart."""
    lines = np.zeros(300, line_dedup._LINE)
    lines["two"] = np.arange(300, dtype=np.uint64) << np.uint64(32)
    index = LineIndex.over(lines, np.full(300, 3), np.arange(300), 3)
    frequent, keepers = index.probe(lines)
    assert frequent.all() and (keepers == np.arange(300)).all()
