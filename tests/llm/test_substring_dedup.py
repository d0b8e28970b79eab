"""Repeated passages against a dictionary of all windows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from helpers import document, table, words
from plumbline.llm.substring_dedup import Windows, _rolling, _sliding, without_repeats


def brute_force(rows, width):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, text in rows]
    counts = Counter(tuple(w[k : k + width]) for _, w in split for k in range(len(w) - width + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            if counts[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()], key=str)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture()
def passages(spark, files):
    shared, hot = words(1, 60), words(2, 50)
    rows = [document(i, " ".join([*words(10 + i, 200), *hot, *words(900 + i, 40)])) for i in range(60)]
    rows += [document(100 + i, " ".join([*words(50 + i, 30), *shared[: 30 + 2 * i], *words(80 + i, 20)])) for i in range(15)]
    rows += [document(200 + i, " ".join(words(7, 300))) for i in range(20)]
    rows += [document(300, "a " * 40), document(301, "b " * 35), document(302, "c " * 36), document(303, "d " * 34)]
    rows += [document(304, " ".join(words(5, 70) * 2)), document(305, " ".join(["x", "y", "z"] * 30))]
    return files(table(spark, rows))


@pytest.mark.parametrize("width", [35, 3, 17])
def test_removal(passages, width):
    assert found(without_repeats(passages, width)) == brute_force(rows_of(passages), width)


def test_a_full_screen_loses_nothing(passages):
    assert found(without_repeats(passages, 35, screen_bits=6)) == brute_force(rows_of(passages), 35)


def test_intervals(passages):
    for r in without_repeats(passages).collect():
        assert sum(b - a for a, b in r["intervals"]) == r["n_removed"]
        assert all(b < c for (_, b), (c, _) in zip(r["intervals"], r["intervals"][1:], strict=False))
        assert len(r["kept"].split()) == r["n_words"] - r["n_removed"]


def test_odd_documents(odd, crowded):
    assert found(without_repeats(crowded)) == brute_force(rows_of(odd), 35)


def test_no_documents(none):
    assert without_repeats(none).count() == 0


def test_rolling_hash_is_the_same_everywhere():
    values = np.random.default_rng(1).integers(0, 2**63, 50, dtype=np.uint64)
    twice = _rolling(np.concatenate([values, values[:3], values]), 7, 0x9FB21C651E98DF25)
    assert (twice[:44] == twice[53:]).all()
    assert len(set(twice.tolist())) > 50


def test_sliding_minimum():
    values = np.random.default_rng(2).integers(0, 100, 60)
    for width in (1, 2, 5, 28):
        expected = [values[i : i + width].min() for i in range(60 - width + 1)]
        assert _sliding(values, width, np.minimum).tolist() == expected


def test_windows_end_with_their_text():
    body = np.frombuffer(b"a b c" + b"d e" + b"f g h i", np.uint8)
    assert Windows(body, np.array([0, 5, 8, 15]), 3).valid.tolist() == [True, False, False, False, False, True, True]
