"""Near-duplicate texts by Order MinHash and banded alignment (operator 10)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.blocks import pairs_in_blocks
from plumbline.llm.common import (
    joined_to_groups,
    keep_rows,
    map_batches,
    map_in_arrow,
    mixed,
    passes,
    powers,
    row_key,
    screen_of,
    stored,
    text_bytes,
    word_bounds,
    word_hashes,
)
from plumbline.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
# Sketches of a text, each of the LENGTH occurrence-labelled shingles with the smallest hashes, in text order.
# Texts of similarity 0.8 share a sketch with probability about 0.8**LENGTH.
SKETCHES = 16
LENGTH = 3
# An alignment that this many places off the diagonal do not decide is made over all places, a row of bits at a time.
WIDE = 128
# The screen of documents that are aligned is this many bits (as a power of two), whatever the data: 16 MB.
SCREEN_BITS = 27

_BASE = 0xC2B2AE3D27D4EB4F


def shingle_hashes(body: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every ``size`` words in a row, and the number of shingles before each text.

    A text of fewer words, but not of none, has one shingle: all its words.
    """
    begins, ends, first_word = word_bounds(body, offsets)
    words = word_hashes(body, begins, ends)
    counts = np.diff(first_word)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    sums = np.zeros(len(words), np.uint64)
    scale = powers(_BASE, size)
    left = np.repeat(first_word[1:], counts) - np.arange(len(words))
    for i in range(size):
        sums += np.where(left > i, padded[i : i + len(words)] * scale[i], np.uint64(0))
    kept = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    inside = np.arange(len(words)) - np.repeat(first_word[:-1], counts) < np.repeat(kept, counts)
    return mixed(sums[inside]), np.concatenate([[0], np.cumsum(kept)])


def occurrence_labelled(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shingles mixed with how often they stood in their text before, so that each is unique there."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)).astype(np.uint64)
    own = mixed(shingles ^ (text * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(own, kind="stable")
    ordered = own[order]
    opens = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(own) else np.zeros(0, np.int64)
    number = np.arange(len(own)) - np.repeat(opens, np.diff(np.append(opens, len(own))))
    labelled = shingles.copy()
    again = number > 0
    labelled[order[again]] = mixed(shingles[order[again]] + number[again].astype(np.uint64))
    return labelled


def sketches(labelled: np.ndarray, offsets: np.ndarray, count: int = SKETCHES, length: int = LENGTH) -> np.ndarray:
    """Order MinHash: for each text (row) and sketch, a hash of the ``length`` shingles of smallest hash in text order."""
    texts = len(offsets) - 1
    out = np.zeros((texts, count), np.int64)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    if not len(filled):
        return out
    begins = offsets[:-1][filled]
    sizes = np.diff(offsets)[filled]
    place = np.arange(len(labelled))
    top = np.uint64(2**64 - 1)
    for number in range(count):
        values = mixed(labelled ^ np.uint64((number + 1) * 0xA24BAED4963EE407 % 2**64))
        chosen = []
        for step in range(length):
            least = np.minimum.reduceat(values, begins)
            # Labelled shingles differ within a text, so its least value stands at one place.
            at = np.maximum.reduceat(np.where(values == np.repeat(least, sizes), place, -1), begins)
            at = np.where(sizes > step, at, -1)
            chosen.append(at)
            values[at[at >= 0]] = top
        picked = np.sort(np.stack(chosen, axis=1), axis=1)
        code = np.full(len(filled), number, np.uint64)
        for step in range(length):
            symbol = np.where(picked[:, step] >= 0, labelled[picked[:, step]], np.uint64(0))
            code = mixed(code * np.uint64(_BASE) + symbol)
        out[filled, number] = code.view(np.int64)
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``_k``, ``_l``, ``one``, ``two``, ``n`` (hashes and number of the shingles in order), ``sketch`` (null without words)."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        shingles, offsets = shingle_hashes(*text_bytes(batch.column(0)))
        found = sketches(occurrence_labelled(shingles, offsets), offsets)
        counts = np.diff(offsets)
        digests = []
        place = np.arange(len(shingles)) - np.repeat(offsets[:-1], counts)
        for base in (_BASE, 0x27D4EB2F165667C5):
            sums = np.zeros(len(shingles) + 1, np.uint64)
            scale = powers(base, int(counts.max(initial=1)))
            np.cumsum(mixed(shingles ^ np.uint64(base)) * scale[place], out=sums[1:])
            digests.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
        whole = pa.ListArray.from_arrays(
            pa.array(np.arange(len(counts) + 1, dtype=np.int32) * SKETCHES), pa.array(found.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *map(pa.array, digests), pa.array(counts), whole],
            names=["doc_id", "_k", "_l", "one", "two", "n", "sketch"],
        )

    rows = docs.select("text", docs["doc_id"].cast("long").alias("doc_id"), *row_key())
    schema = "doc_id long, _k long, _l long, one long, two long, n long, sketch array<long>"
    return map_batches(rows, ["text", "doc_id", "_k", "_l"], run, schema)


def longest_common(a: np.ndarray, b: np.ndarray, half: int) -> np.ndarray:
    """For each row of ``a`` and ``b`` the longest common subsequence over alignments no more than ``half`` places off the diagonal.

    Rows are padded, ``a`` with -1 and ``b`` with -2. All rows advance together, one place of ``a`` at a time.
    """
    rows, width = len(a), 2 * half + 1
    padded = np.full((rows, b.shape[1] + a.shape[1] + 2 * width), -2, b.dtype)
    padded[:, half : half + b.shape[1]] = b
    best = np.zeros((rows, width + 1), np.int32)
    for i in range(a.shape[1]):
        step = best[:, :-1] + (padded[:, i : i + width] == a[:, i : i + 1])
        np.maximum(step, best[:, 1:], out=step)
        np.maximum.accumulate(step, axis=1, out=best[:, :-1])
    return best[:, :-1].max(axis=1)


def longest_common_bits(a: np.ndarray, b: np.ndarray) -> int:
    """The longest common subsequence over all alignments, with a row of the table as one long number.

    A zero bit of the row is a step up; a symbol of ``a`` moves, in each
    stretch between two steps, the step to the first place where ``b`` has the symbol.
    """
    same = min(len(a), len(b))
    differs = np.flatnonzero(a[:same] != b[:same])
    ahead = int(differs[0]) if len(differs) else same
    a, b = a[ahead:], b[ahead:]
    same = min(len(a), len(b))
    differs = np.flatnonzero(a[::-1][:same] != b[::-1][:same])
    behind = int(differs[0]) if len(differs) else same
    a, b = a[: len(a) - behind], b[: len(b) - behind]
    places: dict[int, list[int]] = {}
    for place, symbol in enumerate(b.tolist()):
        places.setdefault(symbol, []).append(place)
    frequent = {symbol: _bits_at(at) for symbol, at in places.items() if len(at) > 512}
    full = (1 << len(b)) - 1
    row = full
    for symbol in a.tolist():
        if symbol in places:
            at = frequent[symbol] if symbol in frequent else _bits_at(places[symbol])
            hit = row & at
            row = ((row + hit) | (row - hit)) & full
    return ahead + behind + len(b) - row.bit_count()


def _bits_at(places: list[int]) -> int:
    if len(places) < 64:
        return sum(1 << place for place in places)
    bits = np.zeros(places[-1] + 1, bool)
    bits[places] = True
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def similar(left: list[np.ndarray], right: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Which pairs align well: common shingles, in order, over all shingles of the two at least ``similarity``.

    Shared shingles in any order bound the common ones from above and reject
    most false candidates. For the others a band about the diagonal is doubled
    until the alignment in it reaches the similarity, or until the band is so
    wide that every alignment that does lies in it; from ``WIDE`` places on, all
    places are aligned at once.
    """
    keep = np.zeros(len(left), bool)
    open_pairs: dict[int, list[int]] = {}
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        # c / (a + b - c) >= s means c >= s (a + b) / (1 + s).
        need = similarity * (len(a) + len(b)) / (1 + similarity)
        if min(len(a), len(b)) < need - 1e-9:
            continue
        symbols, counts = np.unique(a, return_counts=True)
        at = np.searchsorted(symbols, b)
        at[at == len(symbols)] = 0
        hits = np.bincount(at[symbols[at] == b], minlength=len(symbols))
        if np.minimum(hits, counts).sum() >= need - 1e-9:
            open_pairs.setdefault(8 + 2 * abs(len(a) - len(b)), []).append(k)
    while open_pairs:
        half = min(open_pairs)
        if half > WIDE:
            for k in open_pairs.pop(half):
                total = len(left[k]) + len(right[k])
                keep[k] = longest_common_bits(left[k], right[k]) >= similarity * total / (1 + similarity) - 1e-9
            continue
        waiting = sorted(open_pairs.pop(half), key=lambda k: len(left[k]))
        while waiting:
            widest = len(left[waiting[-1]]) + len(right[waiting[-1]])
            count = max(1, min(len(waiting), 500_000 // (widest + 4 * half), 4_000_000 // (1 + widest)))
            group, waiting = waiting[-count:], waiting[:-count]
            a, b = (_padded([side[k] for k in group], pad) for side, pad in ((left, -1), (right, -2)))
            common = longest_common(a, b, half)
            for k, c in zip(group, common.tolist(), strict=True):
                total = len(left[k]) + len(right[k])
                if c >= similarity * total / (1 + similarity) - 1e-9:
                    keep[k] = True
                elif half < total * (1 - similarity) / (1 + similarity):
                    open_pairs.setdefault(2 * half, []).append(k)
    return keep


def _padded(rows: list[np.ndarray], pad: int) -> np.ndarray:
    out = np.full((len(rows), max(len(row) for row in rows)), pad, np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def verified(pairs: DataFrame, sequences: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts' shingles (``row``, ``shingles`` as 32-bit numbers) align well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            while begin < batch.num_rows:
                size, end = 0, begin
                while end < batch.num_rows and (end == begin or size < 8_000_000):
                    size += len(batch.column(2)[end].as_buffer()) + len(batch.column(3)[end].as_buffer())
                    end += 1
                part = batch.slice(begin, end - begin)
                left, right = ([_shingles(x) for x in part.column(i)] for i in (2, 3))
                keep = np.flatnonzero(similar(left, right, similarity))
                yield part.select([0, 1]).take(pa.array(keep))
                begin = end

    joined = pairs.join(sequences.withColumnsRenamed({"row": "a", "shingles": "x"}), "a")
    joined = joined.join(sequences.withColumnsRenamed({"row": "b", "shingles": "y"}), "b").select("a", "b", "x", "y")
    return map_in_arrow(joined, run, "a long, b long")


def sequences_of(docs: DataFrame, wanted: DataFrame, screen_bits: int = SCREEN_BITS) -> DataFrame:
    """``row`` and ``shingles`` of the documents in ``wanted`` (``row`` and the document's ``_k`` and ``_l``).

    A screen of fixed size goes to the tasks that read the texts; the texts of other documents move nowhere.
    """
    screen = docs.sparkSession.sparkContext.broadcast(screen_of(wanted, "_k", screen_bits))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        batch = batch.filter(pa.array(passes(screen.value, batch.column(1).to_numpy(), screen_bits)))
        shingles, offsets = shingle_hashes(*text_bytes(batch.column(0)))
        short = (shingles >> np.uint64(32)).astype("<u4")
        cut = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64) * 4), pa.py_buffer(short)]
        ).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], cut], names=["_k", "_l", "shingles"])

    found = map_batches(docs, ["text", *row_key()], run, "_k long, _l long, shingles binary")
    # Repeated rows are one.
    found = found.groupBy("_k", "_l").agg(F.first("shingles").alias("shingles"))
    return found.join(wanted, ["_k", "_l"]).select("row", "shingles")


def _shingles(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint32).astype(np.int64)


def may_be_near(columns: dict, left: slice, right: slice, similarity: float = SIMILARITY) -> np.ndarray:
    """Pairs of different classes, of like length, that share a sketch: a matrix."""
    if "_short" not in columns:
        # Sixteen bits of a sketch: a few more pairs pass, none is held back.
        flat = columns["sketch"].flatten().to_numpy().reshape(-1, SKETCHES)
        columns["_short"] = np.ascontiguousarray((flat.view(np.uint64) >> np.uint64(48)).astype(np.uint16).T)
    short = columns["_short"]
    equal = np.zeros((left.stop - left.start, right.stop - right.start), bool)
    for sketch in short:
        equal |= sketch[left][:, None] == sketch[right][None, :]
    component, lengths = columns["component"].to_numpy(), columns["length"].to_numpy()
    a, b = lengths[left][:, None], lengths[right][None, :]
    near = equal & (component[left][:, None] != component[right][None, :])
    return near & (np.minimum(a, b) >= similarity * np.maximum(a, b))


def linked_in_block(columns: dict, i: np.ndarray, j: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Which pairs of different classes align well: the cheap tests first, for all; the alignment for the few left."""
    component, key = columns["component"].to_numpy(), columns["key"].to_numpy()
    lengths = columns["length"].to_numpy()
    keep = component[i] != component[j]
    keep &= np.minimum(lengths[i], lengths[j]) >= similarity * np.maximum(lengths[i], lengths[j])
    places = np.flatnonzero(keep)
    keep[:] = False
    if not len(places):
        return keep
    flat = columns["sketch"].flatten().to_numpy().reshape(-1, SKETCHES)
    x, y = flat[i[places]], flat[j[places]]
    equal = x == y
    # A pair is taken in the first bucket the two share.
    lead = x[np.arange(len(x)), equal.argmax(axis=1)] == key[i[places]]
    places = places[lead]
    texts = columns.setdefault("_texts", {})

    def text(place: int) -> tuple[np.ndarray, Counter | set]:
        if place not in texts:
            shingles = _shingles(columns["shingles"][place])
            bag = set(shingles.tolist())
            texts[place] = (shingles, bag if len(bag) == len(shingles) else Counter(shingles.tolist()))
        return texts[place]

    left, right, pairs = [], [], []
    for place in places.tolist():
        (a, bag), (b, other) = text(int(i[place])), text(int(j[place]))
        if isinstance(bag, Counter) != isinstance(other, Counter):
            bag, other = Counter(bag), Counter(other)
        shared = bag & other
        common = shared.total() if isinstance(shared, Counter) else len(shared)
        # Shared shingles in any order bound those in order.
        if common >= similarity * (len(a) + len(b)) / (1 + similarity) - 1e-9:
            left.append(a)
            right.append(b)
            pairs.append(place)
    if pairs:
        keep[np.array(pairs)[similar(left, right, similarity)]] = True
    return keep


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id``, ``_k``, ``_l``, ``class_id``, ``kept``.

    Two texts are near when their shingles of five words, aligned in order,
    have at least ``similarity`` in common (common ones over all of both). A
    class is what is connected by near texts; ``class_id`` is its smallest
    ``doc_id``, and one row with it is kept. ``_k`` and ``_l`` are the row's
    key by content (:func:`plumbline.llm.common.row_key`).

    1. Texts with the same shingles in the same order are one from here on.
    2. Texts that share a sketch meet in its bucket. Each is first aligned with
       the bucket's first text.
    3. Where a bucket still holds several classes, the members of different
       classes meet in blocks: those that share enough
       shingles are aligned there, and only links leave the block. So a text in
       the middle of a bucket loses no neighbour, and a bucket of copies is not
       compared pair by pair.

    Texts of fewer than five words have one shingle, all their words. Very long
    texts are sketched and aligned whole. Null and
    empty texts, and texts of white space, are near each other and nothing
    else. A null ``doc_id`` comes after all others. Repeated rows are copies.
    An empty table gives no rows; further columns are ignored.
    """
    # Numbers of rows are those of the stored table; texts are found again by their content.
    prints = stored(fingerprints(docs).withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    same = ["one", "two", "n"]
    # Equal texts have equal sketches, so the sketch takes no part in which row is first.
    ahead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "sketch", "_k", "_l")).alias("first")
    groups = stored(prints.groupBy(*same).agg(ahead, F.count("*").alias("copies")), "equal-texts")
    sketched = groups.filter("n > 0").select(F.col("first.row").alias("row"), F.col("first.sketch").alias("sketch"), "n")

    buckets = sketched.select("row", F.explode("sketch").alias("key"))
    first = buckets.groupBy("key").agg(F.min("row").alias("b"), F.count("*").alias("size")).filter("size > 1")
    first = stored(first, "buckets")
    stars = joined_to_groups(buckets, first, ["key"], "size", F.col("row")).filter("row != b").select(F.col("row").alias("a"), "b").distinct()
    stars = stored(stars, "star-pairs")
    wanted = groups.select("first.row", "first._k", "first._l")
    wanted = wanted.join(stars.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "row")
    sequences = stored(sequences_of(docs, stored(wanted, "aligned")), "sequences")
    links = stored(verified(stars, sequences, similarity), "star-links")
    classes = stored(components(links).withColumnsRenamed({"node": "row"}), "classes")

    members = joined_to_groups(buckets, first, ["key"], "size", F.col("row")).select("row", "key").join(classes, "row", "left")
    members = members.withColumn("component", F.coalesce("component", "row"))
    split = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high")
    rest = members.join(split.select("key"), "key", "left_semi")
    rest = rest.join(sketched.withColumnRenamed("n", "length"), "row").join(sequences, "row")
    test, rough = (partial(f, similarity=similarity) for f in (linked_in_block, may_be_near))
    more = stored(pairs_in_blocks(rest, ["key"], "row", test, rough, spanning=True), "other-links")
    if not more.isEmpty():
        # The other links join classes: components of the classes, then of the rows.
        for side in "ab":
            more = more.join(classes.withColumnRenamed("row", side), side, "left").withColumn(side, F.coalesce("component", side))
            more = more.drop("component")
        above = components(more).select(F.col("node").alias("component"), F.col("component").alias("above"))
        lone = above.join(classes, "component", "left_anti").select(F.col("component").alias("row"), "component")
        classes = classes.unionByName(lone).join(above, "component", "left")
        classes = stored(classes.select("row", F.coalesce("above", "component").alias("component")), "classes")

    heads = groups.select(*same, "copies", F.col("first.row").alias("row"), F.struct("first.none", "first.doc_id", "first.row").alias("first"))
    classed = heads.join(classes, "row", "left").withColumn("component", F.coalesce("component", "row"))
    lowest = classed.groupBy("component").agg(F.min("first").alias("lead"))
    classed = stored(classed.join(lowest, "component").select(*same, "copies", "lead"), "classed")
    return joined_to_groups(prints, classed, same, "copies", F.col("row")).select(
        "doc_id", "_k", "_l", F.col("lead.doc_id").alias("class_id"), (F.col("row") == F.col("lead.row")).alias("kept")
    )


def without_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns, whatever their names; odd rows as in :func:`near_duplicates`."""
    return keep_rows(docs, near_duplicates(docs, similarity).select("_k", "_l", "kept"))
