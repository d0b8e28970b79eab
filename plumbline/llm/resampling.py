"""Importance resampling towards a target distribution, with hashed n-gram features (operator 13)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import map_batches, map_in_arrow, slices, stored, text_bytes, word_bounds

BUCKETS = 10_000
# Words in a row that make a feature: one to GRAMS.
GRAMS = 3
LEAST_WORDS = 20
PER_CENT = 5
SEED = 42
# Features of more bytes are few and each of another length; they go through the library's CRC one by one.
LONG = 256

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    """The CRC-32 of each byte, from the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


_CRC = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
# Between words: all of ASCII but digits and small letters (capitals are lowered before).
_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[0x30:0x3A] = _BETWEEN[0x61:0x7B] = _BETWEEN[0x80:] = False


@dataclass
class Words:
    """The words of a slice of texts, lower-case and each followed by one space."""

    body: np.ndarray
    begins: np.ndarray
    # Words before each text, and the number of all.
    first_word: np.ndarray

    @staticmethod
    def of(column: pa.Array) -> Words:
        raw, offsets = text_bytes(column)
        raw = _LOWER[raw]
        begins, ends, first_word = word_bounds(raw, offsets, _BETWEEN)
        lengths = ends - begins
        number = np.repeat(np.arange(len(begins)), lengths)
        out = np.full(int(lengths.sum()) + len(begins), 0x20, np.uint8)
        out[np.arange(len(number)) + number] = raw[~_BETWEEN[raw]]
        return Words(out, np.concatenate([[0], np.cumsum(lengths + 1)]), first_word)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of one word, two words, and so on: where each different one begins and ends in ``body``, which
        one begins at each place, and those places (numbers of words)."""
        words = len(self.begins) - 1
        text_end = np.repeat(self.first_word[1:], np.diff(self.first_word))
        place = np.arange(words)
        rows = pa.Array.from_buffers(pa.large_binary(), words, [None, pa.py_buffer(self.begins), pa.py_buffer(self.body)])
        ids = _numbers(rows)
        count = int(ids.max(initial=-1)) + 1
        which = ids
        for n in range(1, GRAMS + 1):
            if n > 1:
                # A run is the run without its last word, and that word: both are numbers here, so nothing is hashed away.
                inside = place[: len(which)] + n <= text_end[place[: len(which)]]
                place = place[: len(which)][inside]
                which = _numbers(pa.array(which[inside].astype(np.int64) * count + ids[place + n - 1]))
            if not len(place):
                return
            example = np.zeros(int(which.max()) + 1, np.int64)
            example[which[::-1]] = place[::-1]
            yield self.begins[example], self.begins[example + n] - 1, which, place


def _numbers(values: pa.Array) -> np.ndarray:
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(values) else np.zeros(0, np.int32)


def crc_of(body: np.ndarray, begins: np.ndarray, ends: np.ndarray, long: int = LONG) -> np.ndarray:
    """The CRC-32 of each stretch of ``body``.

    Stretches of one length are the rows of a matrix of bytes; all their CRCs
    take in one column of it at a time.
    """
    lengths = ends - begins
    out = np.zeros(len(begins), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for rows in np.split(order, cuts) if len(order) else ():
        length = int(lengths[rows[0]])
        if length > long:
            for row in rows.tolist():
                out[row] = zlib.crc32(body[begins[row] : ends[row]])
            continue
        matrix = body[begins[rows][:, None] + np.arange(length)]
        state = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            state = _CRC[(state & np.uint32(0xFF)) ^ column] ^ (state >> np.uint32(8))
        out[rows] = ~state
    return out


def feature_buckets(column: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each size of runs: the bucket of each different feature, which one begins at each place, the places, and
    the words before each text."""
    words = Words.of(column)
    for begins, ends, which, place in words.features():
        yield (crc_of(words.body, begins, ends) % np.uint32(buckets)).astype(np.int64), which, place, words.first_word


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: how many features of all texts (``text``) each bucket holds. A task gives one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch):
                for bucket, which, _, _ in feature_buckets(piece.column(0), buckets):
                    total += np.bincount(bucket, np.bincount(which, minlength=len(bucket)), buckets).astype(np.int64)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["bucket", "n"])

    return map_in_arrow(texts.select("text"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket floor(1000 ln of its share in the target over its share in the source), both smoothed by one."""
    counts = []
    for texts in (source, target):
        found = bucket_counts(texts, buckets).toArrow()
        table = np.zeros(buckets, np.int64)
        table[found["bucket"].to_numpy()] = found["n"].to_numpy()
        counts.append(table)
    s_total, t_total = (float(int(table.sum()) + buckets) for table in counts)
    pairs = zip(*(table.tolist() for table in counts), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_total / ((s + 1.0) * t_total))) for s, t in pairs], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, carried: list[str | Column], schema: str) -> DataFrame:
    """``carried`` columns of each document, its number of words and features, and the sum of its features' gains."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for bucket, which, place, first_word in feature_buckets(batch.column(0), len(shared.value)):
            words = np.diff(first_word)
            text = np.repeat(np.arange(batch.num_rows), words)[place]
            features += np.bincount(text, minlength=batch.num_rows)
            sums = np.concatenate([[0], np.cumsum(shared.value[bucket][which])])
            ends = np.searchsorted(text, np.arange(batch.num_rows + 1))
            weight += sums[ends[1:]] - sums[ends[:-1]]
        columns = [*batch.columns[1:], *map(pa.array, (words, features, weight))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], "n_words", "n_features", "weight"])

    return map_batches(docs, ["text", *carried], run, f"{schema}, n_words long, n_features long, weight long")


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """A Gumbel number for each id, in thousandths: the highest of weight and noise are a draw without replacement."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, share: int = PER_CENT) -> DataFrame:
    """The rows of ``scored`` with ``rank``, from 1 on, where they are among the ``share`` per cent of highest ``score``.

    Rows are dealt into ranges of the order first; a range's ranks begin after
    the number of rows in the ranges before it, so no task sees the whole order.
    Only ranges that the draw reaches are put in order.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")]
    ranges = scored.filter("eligible").repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranges = stored(ranges, "ranges")
    # One row a range: as many as there are shuffle partitions.
    sizes = sorted((r["range"], r["n"]) for r in ranges.groupBy("range").agg(F.count("*").alias("n")).collect())
    drawn = share * sum(n for _, n in sizes) // 100
    starts, before = [], 0
    for number, n in sizes:
        if before < drawn:
            starts.append((number, before))
        before += n
    starts = scored.sparkSession.createDataFrame(starts, "range int, before long")
    reached = ranges.join(starts, "range", "left")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*order))
    inside = reached.filter("before IS NOT NULL").withColumn("rank", rank)
    inside = inside.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("range", "before")
    no_rank = F.lit(None).cast("long").alias("rank")
    outside = reached.filter("before IS NULL").drop("range", "before").select("*", no_rank)
    return inside.unionByName(outside).unionByName(scored.filter("NOT eligible").select("*", no_rank))


def resampled(
    docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, share: int = PER_CENT, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if it is not drawn).

    Features are runs of one to three words (lower-case; ASCII letters, digits
    and all that is not ASCII), in buckets by CRC-32. A document weighs what its
    features are likelier in the texts of ``target`` than in ``docs``, in
    thousandths of nats, rounded down for each bucket. Of the documents with at
    least ``least_words`` words, ``share`` per cent are drawn by weight and noise.

    Null and empty texts, and texts without words, have no features and weight
    0. A null ``doc_id`` has the noise of the empty id and comes last among
    ties; repeated rows tie, and which of them is drawn first is arbitrary. Very
    long texts are read whole. Empty tables give no rows, an empty target gives
    smoothed shares. Further columns, of any name, are ignored.
    """
    gain = gains(docs, target, buckets)
    rows = weighed(docs, gain, [F.col("doc_id").cast("long").alias("doc_id")], "doc_id long")
    rows = rows.select("*", (F.col("weight") + noise("doc_id", seed)).alias("score"), (F.col("n_words") >= least_words).alias("eligible"))
    # Once stored, the number that tells repeated rows apart stays.
    rows = stored(rows.withColumn("tie", F.monotonically_increasing_id()), "scored")
    return ranked(rows, share).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
