"""Exact duplicates against a dictionary of normalised texts; also where chunk hashes collide."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from helpers import document, table, words
from plumbline.llm import exact_dedup
from plumbline.llm.exact_dedup import chunk_ends, exact_duplicates, normalised, without_duplicates


def brute_force(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, members in groups.items():
        keep = min((i for i in members if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(members), digest) for i in members]
    return sorted(out, key=str)


def found(df):
    return sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()], key=str)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture()
def copies(spark, files):
    """A third of all rows are one long text; others repeat with other white space, or differ at one place."""
    long = words(1, 3000)
    rows = [document(i, " ".join(long)) for i in range(100)]
    rows += [document(200 + i, ("\n" if i % 2 else "  ").join(words(i % 60, 400))) for i in range(120)]
    rows += [document(400 + i, " ".join([*long[: 25 * i], "x", *long[25 * i :]])) for i in range(60)]
    rows += [document(500 + i, "a" * (40_000 + i // 2)) for i in range(10)]
    return files(table(spark, rows))


def test_groups(copies):
    result = exact_duplicates(copies)
    assert found(result) == brute_force(rows_of(copies))
    kept = result.filter("kept").collect()
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert without_duplicates(copies).columns == copies.columns
    assert sorted(r["doc_id"] for r in without_duplicates(copies).collect()) == sorted(r["doc_id"] for r in kept)


def test_colliding_hashes_are_told_apart(copies, monkeypatch):
    def few(body, ends):
        begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return (ends - begins) % 7

    monkeypatch.setattr(exact_dedup, "chunk_hashes", few)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(exact_dedup)
    try:
        assert not exact_dedup.verified(copies).isEmpty()
        assert found(exact_duplicates(copies)) == brute_force(rows_of(copies))
    finally:
        cloudpickle.unregister_pickle_by_value(exact_dedup)


def test_odd_documents(odd, crowded):
    assert found(exact_duplicates(crowded)) == brute_force(rows_of(odd))
    kept = without_duplicates(crowded)
    assert kept.columns == crowded.columns
    # One row of each text, also of repeated rows and of texts without an id.
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows_of(odd)})


def test_no_documents(none):
    assert exact_duplicates(none).count() == without_duplicates(none).count() == 0


def test_white_space_runs():
    body = np.frombuffer(b" \t a\r\n\x0bb  " + b"\n\n" + b"" + b"c", np.uint8)
    out, offsets = normalised(body, np.array([0, 10, 12, 12, 13]))
    texts = [out[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    assert texts == [b" a b ", b" ", b"", b"c"]


def test_chunk_borders_follow_content():
    draw = np.random.default_rng(3)
    tail = draw.integers(97, 122, 60_000).astype(np.uint8)
    bodies = [np.concatenate([draw.integers(97, 122, n).astype(np.uint8), tail]) for n in (0, 1, 777)]
    cuts = [set((chunk_ends(b, np.array([0, len(b)])) - (len(b) - len(tail))).tolist()) for b in bodies]
    far = [{c for c in cut if c > 40_000} for cut in cuts]
    assert far[0] == far[1] == far[2] and len(far[0]) > 5
    assert max(np.diff([0, *sorted(chunk_ends(np.zeros(100_000, np.uint8), np.array([0, 100_000])))])) <= exact_dedup.MOST_BYTES
