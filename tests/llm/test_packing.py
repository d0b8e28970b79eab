"""Packing: exact round trip through the tokenizer, whole windows, little padding."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import document, table, words
from plumbline.llm.packing import Encoder, difference, lots, pack, windows
from plumbline.llm.queries import QUERIES, tokenizer_path


def expected_ids(texts):
    found = Tokenizer.from_file(tokenizer_path()).encode_batch([text or "" for text in texts], add_special_tokens=False)
    return [[*encoding.ids, 1] for encoding in found]


def check(rows, window=2048):
    """Every sequence is filled from 0 without a gap; returns the ids of each row group by doc_id."""
    at, pieces = defaultdict(list), defaultdict(list)
    for row in rows:
        assert len(row["ids"]) == 4 * row["length"] > 0
        at[row["sequence_id"]].append((row["offset"], row["length"], row["sequence_length"]))
        pieces[row["doc_id"]].append((row["start"], list(struct.unpack(f"<{row['length']}I", bytes(row["ids"]))), row["doc_tokens"]))
    for spans in at.values():
        end = 0
        for offset, length, _ in sorted(spans):
            assert offset == end
            end += length
        assert end <= window and {total for *_, total in spans} == {end}
    return pieces, len(at)


def joined(pieces):
    pieces = sorted(pieces)
    ids = [i for _, part, _ in pieces for i in part]
    assert [start for start, *_ in pieces] == list(np.cumsum([0, *[len(part) for _, part, _ in pieces]])[:-1])
    assert {total for *_, total in pieces} == {len(ids)}
    return ids


def test_round_trip(spark, files):
    texts = {i: " ".join(words(i, 10 + 37 * i % 4000)) for i in range(300)}
    docs = files(table(spark, [document(i, text) for i, text in texts.items()]))
    rows = pack(docs, tokenizer_path(), group_windows=16).collect()
    pieces, sequences = check(rows)
    assert {i: joined(part) for i, part in pieces.items()} == dict(zip(texts, expected_ids(texts.values()), strict=True))
    total = sum(row["length"] for row in rows)
    assert sequences <= 1.06 * total / 2048 + 3


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = QUERIES["op1_packing"](spark, sf_dir).collect()
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    ids = dict(zip(texts, expected_ids(texts.values()), strict=True))
    seen = defaultdict(int)
    for row in found:
        part = ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == row["ids_crc32"]
        assert row["doc_tokens"] == len(ids[row["doc_id"]])
        seen[row["doc_id"]] += row["length"]
    assert seen == {i: len(x) for i, x in ids.items()}


def test_odd_documents(crowded, odd):
    rows = pack(crowded, tokenizer_path()).collect()
    check(rows)
    assert sum(row["start"] == 0 for row in rows) == odd.count()
    ids = expected_ids([row["text"] for row in odd.collect()])
    assert sum(row["length"] for row in rows) == sum(map(len, ids))
    assert {row["length"] for row in rows if row["doc_id"] in (1, 2)} == {1}


def test_long_white_space(spark, files):
    """Runs that one library's pattern gives up on are read by the other."""
    texts = {1: " " * 3_000_000, 2: "a" + "\n \t" * 700_000 + "b", 3: "plain"}
    rows = pack(files(table(spark, [document(i, text) for i, text in texts.items()])), tokenizer_path()).collect()
    pieces, _ = check(rows)
    assert {i: joined(part) for i, part in pieces.items()} == dict(zip(texts, expected_ids(texts.values()), strict=True))


def test_very_many_empty_texts(spark):
    """One task, one group: neighbours are put together before they are laid, and every text keeps its piece."""
    docs = spark.range(600_000).coalesce(1).selectExpr("id AS doc_id", "CAST(NULL AS string) AS text")
    found = pack(docs, tokenizer_path()).groupBy("sequence_id", "sequence_length")
    found = found.agg(F.count("*").alias("n"), F.sum("offset").alias("offsets"), F.count_distinct("doc_id").alias("ids")).collect()
    assert sum(r["n"] for r in found) == sum(r["ids"] for r in found) == 600_000
    assert all(r["n"] == r["sequence_length"] <= 2048 and r["offsets"] == r["n"] * (r["n"] - 1) // 2 for r in found)
    assert len(found) <= 1.03 * 600_000 / 2048


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 512), min_size=1, max_size=300))
def test_lots_are_bounded(sizes):
    lot = lots(np.array(sizes), 128)
    filled = np.bincount(lot, sizes)
    assert (np.diff(lot) >= 0).all() and set(lot.tolist()) == set(range(lot.max() + 1))
    assert all(n <= 128 or (lot == i).sum() == 1 for i, n in enumerate(filled))
    assert (filled[1:] + filled[:-1] > 128).all()


def plain_differencing(sizes, ways):
    """Partial partitions as sorted tuples, merged two at a time, those of the widest gap first."""
    partial = [((size, *[0] * (ways - 1)), -i) for i, size in enumerate(sizes)]
    while len(partial) > 1:
        partial.sort(key=lambda entry: entry[0][-1] - entry[0][0])
        a, b = partial.pop(0)[0], partial.pop(0)[0]
        partial.append((tuple(sorted((x + y for x, y in zip(a, reversed(b), strict=True)), reverse=True)), 1))
    return sorted(partial[0][0])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=9, unique=True), st.integers(2, 4))
def test_differencing_is_the_textbook_one(sizes, ways):
    found = np.bincount(difference(np.array(sizes), ways), sizes, ways)
    assert found.max() - found.min() == plain_differencing(sizes, ways)[-1] - plain_differencing(sizes, ways)[0]


def test_no_documents(none):
    assert pack(none, tokenizer_path()).count() == 0


def test_a_piece_must_fit(odd):
    with pytest.raises(ValueError):
        pack(odd, tokenizer_path(), window=100, piece=101)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_encoder_agrees_with_tokenizers(text):
    assert Encoder(tokenizer_path()).encode(text).tolist() == expected_ids([text])[0][:-1] if text else True


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 512), min_size=1, max_size=80))
def test_windows_hold(sizes):
    part, ways = windows(np.array(sizes), 512)
    filled = np.bincount(part, sizes, ways)
    assert filled.max() <= 512 and filled.sum() == sum(sizes)


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(1).integers(1, 513, 1000)
    filled = np.bincount(difference(sizes, 100), sizes, 100)
    assert filled.max() - filled.min() <= 64
    assert np.bincount(difference(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4]).tolist() in ([16, 14], [14, 16])
