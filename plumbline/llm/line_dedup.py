"""Removal of repeated lines by sharded minimal perfect hashing (operator 12)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches, map_in_arrow, mixed, passes, reach_workers, row_key, screen_of, slices, stored

LEAST_LENGTH = 20
DOCUMENTS = 3
# Lines that a task gathers before it hands them on, and different lines in a shard.
BUNDLE_LINES = 100_000
SHARD_LINES = 200_000
# Bits of a level of the hash for each key that is left.
LOAD = 2
# The screen of documents that lose lines is this many bits (as a power of two), whatever the data: 16 MB.
SCREEN_BITS = 27
# The place of a null id in the order of ids: before all others.
NO_ID = -(1 << 63)

_SPACES = b" \t\n\x0b\x0c\r"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LINE = np.dtype([("one", "<u8"), ("two", "<u8")])


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A to Z lowered."""
    return line.strip(_SPACES).translate(_LOWER)


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode()) >= least)


@dataclass
class PerfectHash:
    """Numbers 0 to n - 1 for n different keys, about four bits a key.

    A key that is alone at its place in the first level of bits is the bit
    there; the others try the next level. A key's number is the rank of its
    bit. A key that was not there may get any number, or none (-1).
    """

    sizes: np.ndarray
    words: np.ndarray

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        spread = mixed(keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
        return (((spread >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)

    @staticmethod
    def over(keys: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(keys):
            size = 64 * max(1, -(-LOAD * len(keys) // 64))
            at = PerfectHash._places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at]]
        return PerfectHash(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint64), *words]))

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        open_, offset = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = PerfectHash._places(keys[open_], level, size) + offset
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[here]] = before[at[here] >> 6] + below[here]
            open_, offset = open_[~here], offset + size
        return out


@dataclass
class LineIndex:
    """The lines of a shard: a minimal perfect hash, and by number a fingerprint of each and its count of documents;
    for lines in enough documents the largest id as well."""

    salt: int
    places: PerfectHash
    fingerprints: np.ndarray
    counts: np.ndarray
    keepers: np.ndarray
    documents: int

    @staticmethod
    def _keys(lines: np.ndarray, salt: int) -> np.ndarray:
        return mixed(lines["one"] ^ mixed(lines["two"] + np.uint64(salt)))

    @staticmethod
    def over(lines: np.ndarray, counts: np.ndarray, largest: np.ndarray, documents: int) -> LineIndex:
        """Of different lines, how many documents hold each (exact up to ``documents``) and the largest id of these."""
        salt = 0
        while len(np.unique(keys := LineIndex._keys(lines, salt))) < len(lines):
            salt += 1
        places = PerfectHash.over(keys)
        number = places.numbers(keys)
        fingerprints, held = np.zeros(len(lines), np.uint32), np.zeros(len(lines), np.uint8)
        ids = np.zeros(len(lines), np.int64)
        fingerprints[number] = lines["two"].astype(np.uint32)
        held[number], ids[number] = counts, largest
        return LineIndex(salt, places, fingerprints, held, ids[held >= documents], documents)

    def probe(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the lines stand in enough documents, and the largest id of each that does."""
        number = self.places.numbers(LineIndex._keys(lines, self.salt))
        known = number >= 0
        known[known] = self.fingerprints[number[known]] == lines["two"][known].astype(np.uint32)
        frequent = np.zeros(len(lines), bool)
        frequent[known] = self.counts[number[known]] >= self.documents
        rank = np.cumsum(self.counts >= self.documents) - 1
        return frequent, self.keepers[rank[number[frequent]]]

    SCHEMA = "shard int, salt long, sizes binary, words binary, fingerprints binary, counts binary, keepers binary, documents int"

    def row(self, shard: int) -> tuple:
        arrays = (self.places.sizes, self.places.words, self.fingerprints, self.counts, self.keepers)
        return (shard, self.salt, *(array.tobytes() for array in arrays), self.documents)

    @staticmethod
    def of(row: dict) -> LineIndex:
        places = PerfectHash(np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["words"], np.uint64))
        kinds = {"fingerprints": np.uint32, "counts": np.uint8, "keepers": np.int64}
        arrays = [np.frombuffer(row[name], kind) for name, kind in kinds.items()]
        return LineIndex(row["salt"], places, *arrays, row["documents"])


def _first_places(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins, for columns in order."""
    opens = np.ones(len(columns[0]), bool)
    opens[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(opens)


def _holders(number: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``most`` largest different ids of each number, in order of the numbers: number, id, and place among its ids."""
    order = np.lexsort((~ids, number))
    number, ids = number[order], ids[order]
    first = _first_places(number, ids)
    number, ids = number[first], ids[first]
    opens = _first_places(number)
    place = np.arange(len(number)) - np.repeat(opens, np.diff(np.append(opens, len(number))))
    kept = place < most
    return number[kept], ids[kept], place[kept]


BUNDLES = "bundle long, hashes binary, counts binary, ids binary, _k long, _l long, doc long, lines binary"


def bundles(docs: DataFrame, least: int = LEAST_LENGTH, documents: int = DOCUMENTS) -> DataFrame:
    """The lines of some documents at a time: one row with the different lines, and one for each document.

    The first has ``hashes`` (in order), how many ``ids`` each line has in
    ``counts`` and the ``ids`` themselves: the ``documents`` largest different
    ones of each, which is all that a count up to there and the largest need. A
    document's ``lines`` are numbers of these lines, -1 for short ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = TaskContext.get().partitionId() << 33
        numbers: dict[bytes, int] = {}
        rows: list[tuple[int, int, int, np.ndarray]] = []
        waiting = 0

        def flush() -> pa.RecordBatch:
            nonlocal bundle, numbers, rows, waiting
            hashes = np.frombuffer(b"".join(numbers), _LINE)
            order = np.lexsort((hashes["two"], hashes["one"]))
            place = np.empty(len(order) + 1, np.int32)
            place[order] = np.arange(len(order))
            place[-1] = -1
            lines = [place[row[3]] for row in rows]
            used = np.concatenate(lines)
            ids = np.repeat([row[2] for row in rows], [len(x) for x in lines])
            number, ids, _ = _holders(used[used >= 0], ids[used >= 0], documents)
            counts = np.bincount(number, minlength=len(order)).astype(np.uint8)
            head = (bundle, hashes[order].tobytes(), counts.tobytes(), ids.tobytes(), None, None, None, None)
            out = [head, *((bundle, None, None, None, *row[:3], x.tobytes()) for row, x in zip(rows, lines, strict=True))]
            bundle, numbers, rows, waiting = bundle + 1, {}, [], 0
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = [field.split()[0] for field in BUNDLES.split(", ")]
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for piece in slices(batch):
                for text, k, l, doc in zip(*(column.to_pylist() for column in piece.columns), strict=True):
                    found = []
                    for line in (text or b"").split(b"\n"):
                        key = line_key(line)
                        if long_enough(key, least):
                            digest = hashlib.blake2b(key, digest_size=_LINE.itemsize).digest()
                            found.append(numbers.setdefault(digest, len(numbers)))
                        else:
                            found.append(-1)
                    if max(found) >= 0:
                        rows.append((k, l, doc, np.array(found, np.int32)))
                        waiting += len(found)
                    if waiting >= BUNDLE_LINES:
                        yield flush()
        if rows:
            yield flush()

    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc")
    return map_in_arrow(docs.select(F.col("text").cast("binary").alias("text"), *row_key(), doc), run, BUNDLES)


def sharded(heads: DataFrame, shards: int) -> DataFrame:
    """The lines of bundles by shard: ``shard``, ``bundle``, ``base`` (number of the first line), ``hashes``, ``counts``, ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = np.frombuffer(row["hashes"], _LINE), np.frombuffer(row["counts"], np.uint8)
                ids = np.frombuffer(row["ids"], np.int64)
                shard = (((hashes["one"] >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
                opens = _first_places(shard)
                before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                ends = np.append(opens[1:], len(shard))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard[opens].astype(np.int32)),
                        pa.array(np.full(len(opens), row["bundle"], np.int64)),
                        pa.array(opens.astype(np.int32)),
                        *[
                            pa.array([array[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist(), strict=True)], pa.binary())
                            for array, low, high in ((hashes, opens, ends), (counts, opens, ends), (ids, before[opens], before[ends]))
                        ],
                    ],
                    names=["shard", "bundle", "base", "hashes", "counts", "ids"],
                )

    return map_in_arrow(heads, run, "shard int, bundle long, base int, hashes binary, counts binary, ids binary")


def line_index(shards: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """One :class:`LineIndex` a row, of all different lines of a shard."""

    def build(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        hashes, counts, ids = (
            np.frombuffer(b"".join(table[name].to_pylist()), kind) for name, kind in (("hashes", _LINE), ("counts", np.uint8), ("ids", np.int64))
        )
        order = np.lexsort((hashes["two"], hashes["one"]))
        opens = _first_places(hashes["one"][order], hashes["two"][order])
        number = np.empty(len(order), np.int64)
        number[order] = np.repeat(np.arange(len(opens)), np.diff(np.append(opens, len(order))))
        lines = hashes[order[opens]]
        held, ids, place = _holders(np.repeat(number, counts), ids, documents)
        largest = np.zeros(len(lines), np.int64)
        largest[held[place == 0]] = ids[place == 0]
        index = LineIndex.over(lines, np.bincount(held, minlength=len(lines)), largest, documents)
        columns = [[value] for value in index.row(shard)]
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.int32()]
        names = [field.split()[0] for field in LineIndex.SCHEMA.split(", ")]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    reach_workers(shards)
    return shards.groupBy("shard").applyInArrow(build, LineIndex.SCHEMA)


def answers(shards: DataFrame, index: DataFrame) -> DataFrame:
    """The lines of each bundle that stand in enough documents: ``bundle``, ``lines`` (their numbers), ``keepers`` (the largest ids)."""

    def ask(bundles_here: pa.Table, indexes: pa.Table) -> pa.Table:
        found = []
        index_here = LineIndex.of(indexes.slice(0, 1).to_pylist()[0])
        for row in bundles_here.to_pylist():
            frequent, keepers = index_here.probe(np.frombuffer(row["hashes"], _LINE))
            if frequent.any():
                lines = (np.flatnonzero(frequent) + row["base"]).astype(np.int32)
                found.append((row["bundle"], lines.tobytes(), keepers.tobytes()))
        columns = list(zip(*found, strict=True)) if found else [[]] * 3
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bundle", "lines", "keepers"])

    asked = shards.select("shard", "bundle", "base", "hashes").groupBy("shard")
    reach_workers(shards)
    return asked.cogroup(index.groupBy("shard")).applyInArrow(ask, "bundle long, lines binary, keepers binary")


def dropped_lines(members: DataFrame, found: DataFrame) -> DataFrame:
    """``_k``, ``_l``, ``dropped``: the numbers of the lines that a document loses, if it loses any."""

    def mark(rows: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        if told.num_rows:
            lines, keepers = (
                np.frombuffer(b"".join(told[name].to_pylist()), kind) for name, kind in (("lines", np.int32), ("keepers", np.int64))
            )
            frequent, keeper = np.zeros(int(lines.max()) + 1, bool), np.zeros(int(lines.max()) + 1, np.int64)
            frequent[lines], keeper[lines] = True, keepers
            for row in rows.to_pylist():
                own = np.frombuffer(row["lines"], np.int32)
                at = np.flatnonzero((own >= 0) & (own < len(frequent)))
                gone = at[frequent[own[at]] & (keeper[own[at]] != row["doc"])]
                if len(gone):
                    out.append((row["_k"], row["_l"], gone.astype(np.int32).tobytes()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 3
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["_k", "_l", "dropped"])

    reach_workers(members)
    marked = members.groupBy("bundle").cogroup(found.groupBy("bundle")).applyInArrow(mark, "_k long, _l long, dropped binary")
    # Repeated rows lose the same lines.
    return marked.groupBy("_k", "_l").agg(F.first("dropped").alias("dropped"))


def without_repeated_lines(docs: DataFrame, least: int = LEAST_LENGTH, documents: int = DOCUMENTS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept`` (its other lines) and ``kept_sha256``.

    A line's key is the line without white space at its ends, A to Z lowered.
    A key of at least ``least`` code points in at least ``documents`` documents
    loses all its lines but those of the largest ``doc_id`` that holds it.

    1. Tasks gather different lines, as hashes of 128 bits, and hand them on in
       packed rows, split into shards by hash. A line of a third of all
       documents is one entry of each such row.
    2. In each shard a minimal perfect hash over all its different lines leads
       to arrays of fingerprints, counts and largest ids. The number of shards
       follows the number of lines, so one shard has about ``SHARD_LINES``.
    3. The packed rows probe the arrays of their shard, and what they learn goes
       back to their documents as numbers of lines. Only texts that lose lines
       move (and few that a screen of fixed size takes for such).

    Null and empty texts are one empty line. Documents are told apart by
    ``doc_id``: rows that share one count once, and keep their lines together. A
    null ``doc_id`` counts as one, before all others. Very long texts are read
    whole. An empty table gives no rows; further columns, of any name, are ignored.
    """
    rows = stored(bundles(docs, least, documents), "bundles")
    heads, members = rows.filter("hashes IS NOT NULL"), rows.filter("lines IS NOT NULL")
    lines = heads.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0
    shards = sharded(heads.select("bundle", "hashes", "counts", "ids"), max(1, -(-lines // (_LINE.itemsize * SHARD_LINES))))
    index = stored(line_index(shards, documents), "line-index")
    marks = stored(dropped_lines(members.select("bundle", "_k", "_l", "doc", "lines"), answers(shards, index)), "dropped-lines")

    keyed = docs.select("text", docs["doc_id"].cast("long").alias("doc_id"), *row_key())
    screen = docs.sparkSession.sparkContext.broadcast(screen_of(marks, "_k", SCREEN_BITS))

    def losing(batch: pa.RecordBatch) -> np.ndarray:
        return passes(screen.value, batch.column(2).to_numpy(), SCREEN_BITS)

    def to_join(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(losing(batch)))

    def whole(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        part = batch.filter(pa.array(~losing(batch)))
        yield from cut(pa.RecordBatch.from_arrays([*part.columns[:2], pa.nulls(part.num_rows, pa.binary())], names=["text", "doc_id", "dropped"]))

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text, doc_id, dropped in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            text = text or ""
            count, gone = text.count("\n") + 1, ()
            if dropped is not None:
                gone = set(np.frombuffer(dropped, np.int32).tolist())
                text = "\n".join([line for i, line in enumerate(text.split("\n")) if i not in gone])
            rows.append((doc_id, count, len(gone), text, hashlib.sha256(text.encode()).hexdigest()))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        names = ["doc_id", "n_lines", "n_dropped", "kept", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, n_lines long, n_dropped long, kept string, kept_sha256 string"
    moved = map_batches(keyed, ["text", "doc_id", "_k", "_l"], to_join, "text string, doc_id long, _k long, _l long")
    moved = moved.join(marks, ["_k", "_l"], "left")
    cut_texts = map_batches(moved, ["text", "doc_id", "dropped"], cut, schema)
    return map_batches(keyed, ["text", "doc_id", "_k"], whole, schema).unionByName(cut_texts)
