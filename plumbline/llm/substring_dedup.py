"""Removal of repeated passages by Rabin-Karp window hashes (operator 8)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (
    map_batches,
    mixed,
    passes,
    powers,
    screen_of,
    stored,
    text_bytes,
    text_row_key,
    word_bounds,
    word_hashes,
)

WIDTH = 35
# Words of an anchor: of the word groups of this length in a window, the one with the smallest hash.
ANCHOR_WORDS = 16
# The screen of repeated anchors is this many bits (as a power of two), whatever the data: 16 MB.
SCREEN_BITS = 27

_BASES = (0x9FB21C651E98DF25, 0xD1342543DE82EF95)


def _rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """The Rabin-Karp hash, modulo 2**64, of every ``width`` values in a row."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[width:] - sums[:n]) * powers(inverse, n)


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """``choose`` (minimum or maximum) over every ``width`` values in a row."""
    step, out = 1, values
    while step * 2 <= width:
        out = choose(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return choose(out[:-rest], out[rest:]) if rest else out


class Windows:
    """The windows of a slice of texts: where they begin, their hashes, and their anchors."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, width: int, hashes: bool = True) -> None:
        anchor_words = min(ANCHOR_WORDS, width)
        begins, ends, self.first_word = word_bounds(body, offsets)
        words = word_hashes(body, begins, ends)
        n = max(0, len(words) - width + 1)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first_word))
        self.valid = text[:n] == text[width - 1 :] if n else np.zeros(0, bool)
        groups = mixed(_rolling(words, anchor_words, _BASES[0]))
        reach = width - anchor_words + 1
        self.anchors = _sliding(groups, reach, np.minimum) if n else np.zeros(0, np.uint64)
        self.text = text[:n]
        self.groups, self.reach = groups, reach
        if hashes and n:
            self.hashes = [mixed(_rolling(words if i == 0 else mixed(words), width, base)) for i, base in enumerate(_BASES)]

    def anchor_places(self) -> np.ndarray:
        """The anchor of every place that is the anchor of some window, once a place."""
        if not len(self.anchors):
            return self.anchors
        margin = np.zeros(self.reach - 1, np.uint64)
        seen = np.concatenate([margin, np.where(self.valid, self.anchors, np.uint64(0)), margin])
        return self.groups[_sliding(seen, self.reach, np.maximum) == self.groups]


def repeated_anchors(docs: DataFrame, width: int = WIDTH, screen_bits: int = SCREEN_BITS) -> np.ndarray:
    """The screen: a bit for each low part of an anchor that stands at more than one place of the corpus.

    Equal windows have equal anchors, so a window whose anchor has one place is
    unique. The screen's size is fixed. Anchors that share a bit let a few more
    windows through to the count, and lose none.
    """

    def anchors(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        places = Windows(*text_bytes(batch.column(0)), width, hashes=False).anchor_places()
        found, counts = np.unique(places, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["anchor", "n"])

    places = map_batches(docs, ["text"], anchors, "anchor long, n long")
    repeated = places.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    return screen_of(repeated, "anchor", screen_bits)


def screened_runs(docs: DataFrame, width: int = WIDTH, screen_bits: int = SCREEN_BITS) -> DataFrame:
    """Windows that may repeat, as runs of neighbours with one anchor: ``_id``, ``_body``, ``start``, ``one``, ``two``.

    ``start`` is the number of the first window's first word; ``one`` and
    ``two`` are the windows' hashes under two bases, 64 and 32 bits.
    """
    screen = docs.sparkSession.sparkContext.broadcast(repeated_anchors(docs, width, screen_bits))

    def runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        w = Windows(*text_bytes(batch.column(0)), width)
        at = np.flatnonzero(w.valid & passes(screen.value, w.anchors, screen_bits)) if len(w.anchors) else np.zeros(0, np.int64)
        opens = np.ones(len(at), bool)
        if len(at):
            opens[1:] = (np.diff(at) > 1) | (w.text[at][1:] != w.text[at][:-1]) | (w.anchors[at][1:] != w.anchors[at][:-1])
        cuts = np.append(np.flatnonzero(opens), len(at)).astype(np.int32)
        first = at[cuts[:-1]]
        text = w.text[first] if len(first) else np.zeros(0, np.int64)
        hashes = [w.hashes[i][at].view(np.int64) if len(at) else np.zeros(0, np.int64) for i in range(2)]
        hashes[1] = (hashes[1] >> 32).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(1).take(pa.array(text, pa.int64())),
                batch.column(2).take(pa.array(text, pa.int64())),
                pa.array(first - w.first_word[text]),
                *[pa.ListArray.from_arrays(pa.array(cuts), pa.array(h)) for h in hashes],
            ],
            names=["_id", "_body", "start", "one", "two"],
        )

    schema = "_id string, _body long, start long, one array<long>, two array<int>"
    return map_batches(docs, ["text", *text_row_key()], runs, schema)


def repeated_windows(docs: DataFrame, width: int = WIDTH, screen_bits: int = SCREEN_BITS) -> DataFrame:
    """For each text with repeated windows: ``_id``, ``_body``, ``marks`` (pairs of a run's start and the offsets in it).

    Equal runs are counted together before their windows are, so that a
    passage with very many copies is one row of each task; the windows of a run
    with a copy need no further look-up. Windows count as equal when both
    hashes, 96 bits together, are.
    """
    runs = screened_runs(docs, width, screen_bits)
    key = [F.xxhash64("one", "two").alias("_r"), F.xxhash64("two", F.lit(1), "one").alias("_s")]
    different = runs.groupBy("one", "two").agg(F.count("*").alias("n"))
    different = stored(different.select(*key, "n", "one", "two"), "runs")
    windows = F.explode(F.arrays_zip("one", "two")).alias("window")
    counted = different.select("n", windows).groupBy(F.col("window.one").alias("a"), F.col("window.two").alias("b"))
    counted = counted.agg(F.sum("n").alias("times")).filter("times > 1").drop("times")
    single = different.filter("n = 1").select("_r", "_s", F.posexplode(F.arrays_zip("one", "two")).alias("place", "window"))
    single = single.select("_r", "_s", "place", F.col("window.one").alias("a"), F.col("window.two").alias("b"))
    places = single.join(counted, ["a", "b"]).groupBy("_r", "_s").agg(F.collect_set("place").alias("places"))
    copied = different.filter("n > 1").select("_r", "_s", F.sequence(F.lit(0), F.size("one") - 1).alias("places"))
    marked = copied.unionByName(places)
    placed = runs.select("_id", "_body", "start", *key).join(marked, ["_r", "_s"])
    return placed.groupBy("_id", "_body").agg(F.collect_set(F.struct("start", "places")).alias("marks"))


def without_repeats(docs: DataFrame, width: int = WIDTH, screen_bits: int = SCREEN_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_removed``, ``intervals``, ``kept``, ``kept_sha256``.

    A word is removed if any window of ``width`` words over it also starts
    somewhere else, in the same document or another, copies of the whole text
    included; ``intervals`` are the maximal stretches removed (first word, word
    after the last). ``kept`` joins the other words by one space. Windows are
    judged on the input. Texts shorter than a window lose nothing, very long
    ones are read whole; null is a text without words. Rows with one ``doc_id`` are told apart by their text,
    a null ``doc_id`` is a value like others, further columns are ignored, and
    an empty table gives no rows.
    """
    marks = stored(repeated_windows(docs, width, screen_bits), "marks")
    keyed = docs.select("text", docs["doc_id"].cast("long").alias("doc_id"), *text_row_key())
    keyed = keyed.withColumn("_key", F.xxhash64("_id", "_body"))
    # Of the texts, only those with marks (and few others) move to be joined with them.
    marked = screen_of(marks.select(F.xxhash64("_id", "_body").alias("key")), "key", screen_bits)
    screen = docs.sparkSession.sparkContext.broadcast(marked)

    def to_join(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(passes(screen.value, batch.column(4).to_numpy(), screen_bits))
        yield batch.select([0, 1, 2, 3]).take(pa.array(at))

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(~passes(screen.value, batch.column(2).to_numpy(), screen_bits))
        part = batch.select([0, 1]).take(pa.array(at))
        none = pa.nulls(part.num_rows)
        yield from cut(pa.RecordBatch.from_arrays([*part.columns, none], names=["text", "doc_id", "marks"]))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        body, offsets = text_bytes(batch.column(0))
        begins, ends, first_word = word_bounds(body, offsets)
        view = body.tobytes()
        rows = []
        for i, (doc_id, marks) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            a, b = int(first_word[i]), int(first_word[i + 1])
            covered = np.zeros(b - a + 1, np.int64)
            for mark in marks or ():
                starts = mark["start"] + np.array(mark["places"], np.int64)
                np.add.at(covered, starts, 1)
                np.add.at(covered, starts + width, -1)
            removed = np.cumsum(covered[:-1]) > 0
            stay = np.flatnonzero(~removed) + a
            kept = b" ".join([view[x:y] for x, y in zip(begins[stay].tolist(), ends[stay].tolist(), strict=True)])
            edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8))).reshape(-1, 2)
            rows.append((doc_id, b - a, int(removed.sum()), edges.tolist(), kept.decode(), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string(), pa.string()]
        names = ["doc_id", "n_words", "n_removed", "intervals", "kept", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, n_words long, n_removed long, intervals array<array<long>>, kept string, kept_sha256 string"
    joined = map_batches(
        keyed, ["text", "doc_id", "_id", "_body", "_key"], to_join, "text string, doc_id long, _id string, _body long"
    ).join(marks, ["_id", "_body"], "left")
    with_marks = map_batches(joined, ["text", "doc_id", "marks"], cut, schema)
    return map_batches(keyed, ["text", "doc_id", "_key"], whole, schema).unionByName(with_marks)
