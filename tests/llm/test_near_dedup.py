"""Near duplicates against all pairs; the alignment against the textbook recursion."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import document, table, words
from plumbline.llm.blocks import tiles
from plumbline.llm.common import text_bytes
from plumbline.llm.graph import components
from plumbline.llm.near_dedup import (
    longest_common,
    longest_common_bits,
    near_duplicates,
    occurrence_labelled,
    shingle_hashes,
    similar,
    sketches,
    without_near_duplicates,
)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=20), st.lists(st.integers(0, 4), min_size=1, max_size=20))
def test_alignment(a, b):
    c = lcs(a, b)
    assert longest_common(np.array([a]), np.array([b]), 25)[0] == c
    s = c / (len(a) + len(b) - c)
    for similarity in (0.5, 0.8):
        assert similar([np.array(a)], [np.array(b)], similarity)[0] == (s >= similarity - 1e-9)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=40), st.lists(st.integers(0, 4), max_size=40))
def test_alignment_by_bits(a, b):
    assert longest_common_bits(np.array(a, np.int64), np.array(b, np.int64)) == lcs(a, b)


def test_very_long_reordered_texts():
    """Halves swapped, every shingle common: what the band does not decide, the bits do, in seconds."""
    a = np.random.default_rng(2).permutation(200_000)
    swapped = np.concatenate([a[100_000:], a[:100_000]])
    few = a[:40_000]
    moved = np.concatenate([few[1_000:], few[:1_000]])
    began = time.process_time()
    assert similar([a, few, a], [swapped, moved, a]).tolist() == [False, True, True]
    assert time.process_time() - began < 60
    # Few symbols, each at very many places.
    a = np.random.default_rng(3).integers(0, 3, 3000)
    b = np.roll(a, 400)
    assert longest_common_bits(a, b) == lcs(a.tolist(), b.tolist())


def test_short_texts_that_share_one_sketch_only(spark, files):
    """Texts of four and five shingles, four in common: as hard to find as any, and all links count."""
    rows, expected = [], 400
    for k in range(expected):
        text = words(k, 9, 10**9)
        rows += [document(2 * k, " ".join(text[:8])), document(2 * k + 1, " ".join(text))]
    result = near_duplicates(files(table(spark, rows)))
    linked = sum(r["doc_id"] != r["class_id"] for r in result.collect())
    assert linked >= 0.99 * expected


def test_alignment_of_long_texts():
    draw = random.Random(1)
    left, right, expected = [], [], []
    for k in range(30):
        a = [draw.randrange(10**6) for _ in range(200 + 10 * k)]
        b = list(a)
        for _ in range(k):
            place = draw.randrange(len(b))
            b[place : place + draw.randrange(3)] = [draw.randrange(10**6)] * draw.randrange(4)
        c = lcs(a, b)
        left.append(np.array(a))
        right.append(np.array(b))
        expected.append(c / (len(a) + len(b) - c) >= 0.8)
    assert similar(left, right).tolist() == expected and True in expected


def shingles_of(text):
    w = (text or "").split()
    return [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []


def classes(rows):
    """Smallest id of each document's class, from all pairs."""
    shingles = [shingles_of(text) for _, text in rows]
    bags = [Counter(s) for s in shingles]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = shingles[a], shingles[b]
            if x == y:
                near = True
            elif not x or not y or sum((bags[a] & bags[b]).values()) < 0.8 / 1.8 * (len(x) + len(y)) - 1e-9:
                near = False
            else:
                c = lcs(x, y)
                near = c / (len(x) + len(y) - c) >= 0.8 - 1e-9
            if near:
                parent[find(a)] = find(b)
    lowest = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        lowest[find(k)].append(i)
    return sorted(((i, min((x for x in lowest[find(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows)), key=str)


def found(df):
    return sorted([(r["doc_id"], r["class_id"]) for r in df.collect()], key=str)


def edited(text, seed, edits):
    draw, out = random.Random(seed), list(text)
    for _ in range(edits):
        out[draw.randrange(len(out))] = f"edit{draw.randrange(10**6)}"
    return out


@pytest.fixture()
def copies(spark, files):
    base, other, passage = words(1, 150), words(2, 300), words(3, 45)
    rows = [document(i, " ".join(edited(base, i, 1 + i % 3))) for i in range(60)]
    rows += [document(100 + i, " ".join(other)) for i in range(20)]
    rows += [document(200 + i, " ".join(edited(other, i, i))) for i in range(12)]
    # A passage that many texts share makes neighbours of none.
    rows += [document(300 + i, " ".join([*words(40 + i, 50), *passage, *words(90 + i, 20)])) for i in range(60)]
    # A chain: each is near the next only.
    chain = words(4, 200)
    for i in range(6):
        chain = edited(chain, 70 + i, 3)
        rows.append(document(400 + i, " ".join(chain)))
    rows += [document(500, "one two three"), document(501, "one  two three"), document(502, "one two")]
    return files(table(spark, rows))


def test_classes(copies):
    rows = [(r["doc_id"], r["text"]) for r in copies.collect()]
    result = near_duplicates(copies)
    assert found(result) == classes(rows)
    kept = sorted(r["doc_id"] for r in result.filter("kept").collect())
    assert kept == sorted({c for _, c in classes(rows)})
    left = without_near_duplicates(copies)
    assert left.columns == copies.columns and sorted(r["doc_id"] for r in left.collect()) == kept


def test_odd_documents(odd, crowded, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 10_000]
    short = crowded.filter("length(coalesce(text, '')) < 10000")
    assert found(near_duplicates(short)) == classes(rows)
    everything = near_duplicates(crowded).collect()
    assert len(everything) == odd.count()
    by_class = Counter(r["class_id"] for r in everything if r["kept"])
    assert max(by_class.values()) == 1
    assert without_near_duplicates(crowded).columns == crowded.columns
    assert near_duplicates(none).count() == 0


def test_shingles_and_sketches_do_not_depend_on_neighbours():
    texts = ["a b c d e f", "", "a b", "x " * 50, "a b c d e f"]
    shingles, offsets = shingle_hashes(*text_bytes(pa.array(texts)))
    assert np.diff(offsets).tolist() == [2, 0, 1, 46, 2]
    labelled = occurrence_labelled(shingles, offsets)
    assert len(set(labelled[offsets[3] : offsets[4]].tolist())) == 46
    together = sketches(labelled, offsets)
    assert (together[0] == together[4]).all() and not together[1].any()
    for i, text in enumerate(texts):
        s, o = shingle_hashes(*text_bytes(pa.array([text])))
        assert (sketches(occurrence_labelled(s, o), o)[0] == together[i]).all()


def test_tiles_give_every_pair_once():
    first, total = np.array([0, 3, 4, 9]), 11
    pairs = sorted((int(a), int(b)) for i, j in tiles(first, total) for a, b in zip(i, j, strict=True))
    groups = [range(0, 3), range(3, 4), range(4, 9), range(9, 11)]
    assert pairs == sorted((a, b) for g in groups for a in g for b in g if a < b)


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(90)]
    parent = list(range(500))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
