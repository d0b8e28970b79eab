"""Exact duplicates by recipes of content-defined chunks (operator 2)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (
    binary_rows,
    joined_to_groups,
    keep_rows,
    map_batches,
    mixed,
    powers,
    row_key,
    stored,
    text_bytes,
    word_bounds,
)

# A chunk ends where the low bits of a hash of the last GEAR bytes are zero: after 2**CUT_BITS bytes on average.
GEAR = 32
CUT_BITS = 10
# Text without such a place is cut after this many bytes.
MOST_BYTES = 1 << 15

_GEAR_CODES = np.random.default_rng(2).integers(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_BASE = 0xA0761D6478BD642F


def normalised(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with each run of white space replaced by one space."""
    if not len(body):
        return body, offsets
    begins, ends, _ = word_bounds(body, offsets)
    solid = np.zeros(len(body) + 1, dtype=np.int8)
    solid[begins] += 1
    solid[ends] -= 1
    solid = np.cumsum(solid[:-1], dtype=np.int8).astype(bool)
    # Of a run, the first byte stays; a run may open a text.
    first = np.ones(len(body), dtype=bool)
    first[1:] = solid[:-1]
    first[offsets[:-1][offsets[:-1] < len(body)]] = True
    keep = solid | first
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return np.where(solid, body, np.uint8(0x20))[keep], kept_before[offsets]


def chunk_ends(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks end, ends of texts included; decided by the bytes before each place alone."""
    if not len(body):
        return np.zeros(0, np.int64)
    rolled = _GEAR_CODES[body]
    step = 1
    while step < GEAR:
        rolled[step:] += rolled[:-step] << np.uint32(step)
        step *= 2
    # The high bits of the sum depend on all of the last GEAR bytes.
    places = np.flatnonzero(rolled >> np.uint32(32 - CUT_BITS) == 0) + 1
    text = np.searchsorted(offsets, places, side="left") - 1
    places = places[places - offsets[text] >= GEAR]
    ends = np.union1d(places, offsets[1:][offsets[1:] > offsets[:-1]])
    begins = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - begins > MOST_BYTES)
    if len(long):
        more = [np.arange(begins[i] + MOST_BYTES, ends[i], MOST_BYTES) for i in long]
        ends = np.union1d(ends, np.concatenate(more))
    return ends


def chunk_hashes(body: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each chunk. Different chunks may share one; identifiers are verified on the bytes."""
    if not len(ends):
        return np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    lengths = ends - begins
    place = np.arange(len(body)) - np.repeat(begins, lengths)
    values = powers(_BASE, int(lengths.max()))[place]
    values *= body.astype(np.uint64) + np.uint64(1)
    return mixed(np.add.reduceat(values, begins) + lengths.astype(np.uint64)).view(np.int64)


def _chunked(batch: pa.RecordBatch):
    body, offsets = normalised(*text_bytes(batch.column(0)))
    ends = chunk_ends(body, offsets)
    return body, offsets, ends, chunk_hashes(body, ends)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    body, _, ends, hashes = _chunked(batch)
    # Copies within a slice go no further: one row of each hash and length, unless the bytes differ.
    rows = binary_rows(body, np.concatenate([[0], ends]))
    table = pa.table({"hash": hashes, "chunk": rows})
    yield from table.group_by(["hash", "chunk"], use_threads=False).aggregate([]).to_batches()


def _recipes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    body, offsets, ends, hashes = _chunked(batch)
    cuts = np.searchsorted(ends, offsets, side="right").astype(np.int32)
    view = body.tobytes()
    digests = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays(
        [
            *batch.columns[1:],
            pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes)),
            pa.array(digests),
        ],
        names=["doc_id", "_k", "_l", "recipe", "text_sha256"],
    )


def verified(docs: DataFrame) -> DataFrame:
    """Hashes that stand for more than one chunk, with their chunks and the identifier of each (``hash``, ``rank``).

    The content of every different chunk moves once, and equal chunks are
    combined before they move. A hash with one chunk is that chunk's
    identifier; the result is then empty.
    """
    chunks = map_batches(docs, ["text"], _chunks, "hash long, chunk binary")
    distinct = chunks.groupBy("hash", "chunk").agg(F.lit(1).alias("one")).drop("one")
    shared = distinct.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    shared = stored(shared, "shared-hashes")
    if shared.isEmpty():
        return shared.selectExpr("hash", "CAST(NULL AS binary) AS chunk", "CAST(NULL AS int) AS rank").limit(0)
    clashing = distinct.join(shared, "hash", "left_semi")
    return clashing.selectExpr("hash", "chunk", "row_number() OVER (PARTITION BY hash ORDER BY chunk) AS rank")


def recipes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``_k``, ``_l``, ``row``, ``recipe`` (its chunks' identifiers in order), ``text_sha256``, ``ranks``.

    ``ranks`` holds the ranks of chunks whose hash other chunks share; it is
    null for all others, which is nearly always every document. ``row`` tells
    repeated rows apart; it belongs to the stored table, another scan of the documents has none of it.
    """
    rows = docs.select("text", docs["doc_id"].cast("long").alias("doc_id"), *row_key())
    table = map_batches(
        rows, ["text", "doc_id", "_k", "_l"], _recipes, "doc_id long, _k long, _l long, recipe array<long>, text_sha256 string"
    ).withColumn("row", F.monotonically_increasing_id())
    clashes = verified(docs)
    if clashes.isEmpty():
        return stored(table.withColumn("ranks", F.lit(None).cast("array<int>")), "recipes")
    table = stored(table, "plain-recipes")
    clashes = stored(clashes, "clashes")

    def occurrences(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        body, offsets, ends, hashes = _chunked(batch)
        text = np.searchsorted(offsets, ends, side="left") - 1
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(1).take(pa.array(text)),
                pa.array(np.arange(len(ends)), pa.int64()),
                pa.array(hashes),
                binary_rows(body, np.concatenate([[0], ends])),
            ],
            names=["text_sha256", "place", "hash", "chunk"],
        )

    # Rows of one text have one rank list, so the text's own digest serves as their key.
    digest = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), 256)
    found = map_batches(docs, ["text", digest], occurrences, "text_sha256 string, place long, hash long, chunk binary")
    found = found.join(clashes, ["hash", "chunk"]).select("text_sha256", "place", "rank").distinct()
    ranks = F.array_sort(F.collect_list(F.struct("place", "rank"))).getField("rank").alias("ranks")
    found = found.groupBy("text_sha256").agg(ranks)
    return stored(table.join(found, "text_sha256", "left").select(*table.columns, "ranks"), "recipes")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``_k``, ``_l``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after each run of space, tab or
    line ends is one space. Two texts are equal exactly if the ordered lists
    of their chunks' verified identifiers are: chunk borders depend on content
    alone, and an identifier stands for one content. Documents are grouped by
    those lists, combined on the map side; long texts are not moved again.

    Of equal texts the smallest ``doc_id`` stays; of repeated rows with that
    ``doc_id``, one. A null ``doc_id`` comes after all others (and
    stays, with a null ``keep_id``, if the group has no other). Null is an
    empty text. Very long texts are cut into chunks like others. An empty table
    gives no rows; further columns are ignored. ``_k`` and ``_l`` are the row's
    key by content (:func:`plumbline.llm.common.row_key`).
    """
    table = recipes(docs)
    identity = ["recipe", "ranks"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = stored(table.groupBy(*identity).agg(first.alias("first"), F.count("*").alias("group_size")), "equal-texts")
    joined = joined_to_groups(table, groups, identity, "group_size", F.col("row"))
    return joined.select(
        "doc_id",
        "_k",
        "_l",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names; odd rows as in :func:`exact_duplicates`."""
    return keep_rows(docs, exact_duplicates(docs).select("_k", "_l", "kept"))
