"""Near duplicates among embeddings by randomly rotated binary codes (operator 5)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.blocks import Forest, folded_in_blocks
from plumbline.llm.common import joined_to_groups, map_in_arrow, stored
from plumbline.llm.graph import components

THRESHOLD = 0.93
# Bits of the codes are cut into bands; vectors that agree on a band are candidates. A band has so many bits that
# about MEMBERS unrelated vectors of a label share one, and there are so many bands that a pair at exactly the
# threshold agrees on none with this probability.
MEMBERS = 16
MISSED = 0.002
MOST_BITS = 30
# Half width of the confidence interval of an estimate, in its standard scale.
CONFIDENCE = 4.0
SEED = 5


def band_bits(vectors: int) -> int:
    """Bits of a band for a label of so many different vectors; none for a few, which all meet."""
    return min(MOST_BITS, max(0, math.ceil(math.log2(max(1, vectors) / MEMBERS))))


def band_count(bits: int, threshold: float = THRESHOLD) -> int:
    """A rotated bit of two vectors agrees with a probability of one minus their angle over half a turn."""
    agree = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return 1 if agree >= 1 else max(1, math.ceil(math.log(MISSED) / math.log(1 - agree)))


@lru_cache(maxsize=16)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng((SEED, number, dim)).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def coded(unit: np.ndarray, rotations: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of unit vectors: sign bits of all rotations, the correction factor of the first, and its coordinates in 16 bits with their scale.

    A vector o, rotated, is stored as the corner of a cube c = sign(o) / sqrt(D)
    and the factor <c, o>. For another vector q, <c, q> / <c, o> estimates
    <o, q> without bias; its error is about sqrt((1 - <c, o>**2) / (D - 1)) / <c, o>.
    """
    dim = unit.shape[1]
    turned = [unit @ rotation(dim, k) for k in range(rotations)]
    bits = np.concatenate([x > 0 for x in turned], axis=1)
    factor = np.abs(turned[0]).sum(axis=1) / np.sqrt(dim)
    scale = np.abs(turned[0]).max(axis=1) / 32767
    return bits, factor, np.rint(turned[0] / scale[:, None]).astype(np.int16), scale


def bands(bits: np.ndarray, width: int, count: int) -> np.ndarray:
    """The keys of ``count`` bands of ``width`` bits each."""
    weights = 1 << np.arange(width)
    return (bits[:, : count * width].reshape(len(bits), count, width) * weights).sum(axis=2).astype(np.int32)


def can_link() -> Column:
    """True for vectors with a label whose components are set and finite and not all zero."""
    wide = F.col("embedding").cast("array<double>")
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists(wide, lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))


def _scaled(embedding: str) -> Column:
    """Divided by the largest component's size, so that squares neither overflow nor vanish."""
    top = F.array_max(F.transform(embedding, F.abs))
    return F.transform(embedding, lambda x: x / top)


class Links:
    """What a task's pairs amount to: for each vector the copies of others it links with, links that span what they
    connect, and the pairs that the codes leave open.

    A pair counts in the first band it shares. The binary codes give an estimate
    of its cosine with a confidence bound, and pairs whose bound is below the
    threshold are out. For the others the coordinates in 16 bits give the
    cosine to within the lengths of what rounding took off, which decides all
    but those at the threshold. Rows: ``a``, ``b``, ``near``; a number for ``a``
    alone, a link with number 0, an open pair without a number.
    """

    SCHEMA = "a long, b long, near long"

    def __init__(self, columns: dict, threshold: float) -> None:
        self.columns, self.threshold = columns, threshold
        self.ids = columns["rep"].to_numpy()
        self.dims, self.band, self.copies = (columns[name].to_numpy() for name in ("dim", "band", "n"))
        self.factor, self.scale, self.rest = (columns[name].to_numpy() for name in ("factor", "scale", "rest"))
        self.forest = Forest(self.ids)
        self.near = np.zeros(len(self.ids), np.int64)
        self.links: list[np.ndarray] = []
        self.open: list[np.ndarray] = []

    def take(self, i: np.ndarray, j: np.ndarray) -> None:
        sizes = self.dims[i]
        # A table may hold groups of several dimensions and numbers of bands; pairs are of one.
        for dim in np.unique(sizes).tolist():
            for at in range(0, int((sizes == dim).sum()), step := max(1, 4_000_000 // dim)):
                part = np.flatnonzero(sizes == dim)[at : at + step]
                self._taken(i[part], j[part], dim)

    def _taken(self, a: np.ndarray, b: np.ndarray, dim: int) -> None:
        earlier = self.band[a] > 0
        if earlier.any():
            shared = np.zeros(len(a), bool)
            # Vectors of one label have equally many keys, those of another label others.
            widths = np.diff(np.frombuffer(self.columns["keys"].buffers()[1], np.int32)[self.columns["keys"].offset :][: len(self.ids) + 1])[a]
            for width in np.unique(widths[earlier]).tolist():
                part = np.flatnonzero(earlier & (widths == width))
                one, two = (_rows(self.columns["keys"], x[part], np.int32) for x in (a, b))
                shared[part] = ((one == two) & (np.arange(one.shape[1]) < self.band[a[part]][:, None])).any(axis=1)
            a, b = a[~shared], b[~shared]
        if not len(a):
            return
        corner = np.unpackbits(_rows(self.columns["code"], b, np.uint8), axis=1)[:, :dim].astype(np.float32)
        corner = (2 * corner - 1) / np.float32(np.sqrt(dim))
        query = _rows(self.columns["short"], a, np.int16) * self.scale[a][:, None]
        estimate = np.einsum("nd,nd->n", corner, query) / self.factor[b]
        spread = np.sqrt(np.maximum(0, 1 - self.factor[b] ** 2) / max(1, dim - 1)) / self.factor[b]
        likely = estimate + CONFIDENCE * spread + 0.001 >= self.threshold
        a, b, query = a[likely], b[likely], query[likely]
        if not len(a):
            return
        cosine = np.einsum("nd,nd->n", query, _rows(self.columns["short"], b, np.int16) * self.scale[b][:, None])
        slack = self.rest[a] + self.rest[b] + self.rest[a] * self.rest[b] + 1e-9
        sure = cosine - slack >= self.threshold
        open_ = ~sure & (cosine + slack >= self.threshold)
        self.open.append(np.stack([self.ids[a[open_]], self.ids[b[open_]]]))
        a, b = a[sure], b[sure]
        np.add.at(self.near, a, self.copies[b])
        np.add.at(self.near, b, self.copies[a])
        apart = self.forest.apart(a, b)
        a, b = a[apart], b[apart]
        new = self.forest.join(a, b)
        self.links.append(np.stack([self.ids[a[new]], self.ids[b[new]]]))

    def result(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.near)
        counted = np.unique(self.ids[some], return_inverse=True)
        near = np.bincount(counted[1], self.near[some], len(counted[0])).astype(np.int64)
        links = np.concatenate([np.zeros((2, 0), np.int64), *self.links], axis=1)
        open_ = np.concatenate([np.zeros((2, 0), np.int64), *self.open], axis=1)
        first = pa.array(np.concatenate([counted[0], links[0], open_[0]]))
        second = pa.chunked_array([pa.nulls(len(near), pa.int64()), links[1], open_[1]]).combine_chunks()
        number = pa.chunked_array([near, np.zeros(links.shape[1], np.int64), pa.nulls(open_.shape[1], pa.int64())]).combine_chunks()
        return pa.RecordBatch.from_arrays([first, second, number], names=["a", "b", "near"])


def coded_rows(distinct: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each band of each vector (``rep``, ``n``, ``label``, ``embedding``): its key, and the vector's codes."""
    sized = distinct.select("rep", "n", F.col("label").cast("string").alias("label"), _scaled("embedding").alias("embedding"))
    sized = sized.withColumn("dim", F.size("embedding"))
    sizes = sized.groupBy("label", "dim").agg(F.count("*").alias("vectors"))
    sized = sized.join(sizes, ["label", "dim"]).select("rep", "n", "label", "embedding", "vectors")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            flat = lists.flatten().to_numpy()
            sizes = np.diff(offsets)
            widths = np.array([band_bits(n) for n in batch.column(4).to_pylist()])
            for dim, width in sorted(set(zip(sizes.tolist(), widths.tolist(), strict=True))):
                rows = np.flatnonzero((sizes == dim) & (widths == width))
                count = band_count(width, threshold)
                step = max(1, 20_000_000 // (count * (2 * dim + 200)))
                for at in range(0, len(rows), step):
                    yield encoded(batch, rows[at : at + step], flat, offsets - offsets[0], dim, width, count)

    def encoded(batch, rows, flat, offsets, dim, width, count) -> pa.RecordBatch:
        unit = flat[offsets[rows][:, None] + np.arange(dim)]
        unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
        bits, factor, short, scale = coded(unit, max(1, -(-count * width // dim)))
        keys = bands(bits, width, count) if width else np.zeros((len(rows), 1), np.int32)
        rest = np.linalg.norm(unit @ rotation(dim, 0) - short * scale[:, None], axis=1)
        again = pa.array(np.repeat(rows, count))
        return pa.RecordBatch.from_arrays(
            [
                *[batch.column(i).take(again) for i in range(3)],
                pa.array(np.full(len(again), dim, np.int32)),
                pa.array(np.tile(np.arange(count, dtype=np.int32), len(rows))),
                pa.array(keys.ravel()),
                *[pa.array(np.repeat(x, count)) for x in (factor, scale, rest)],
                _fixed(np.packbits(bits[:, :dim], axis=1), count),
                _fixed(short, count),
                _fixed(keys, count),
            ],
            names=["rep", "n", "label", "dim", "band", "key", "factor", "scale", "rest", "code", "short", "keys"],
        )

    schema = (
        "rep long, n long, label string, dim int, band int, key int, factor double, scale double, rest double, "
        "code binary, short binary, keys binary"
    )
    return map_in_arrow(sized, encode, schema)


def links_of(distinct: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Of different vectors (``rep``, ``n``, ``label``, ``embedding``): how many others' copies each links with (``rep``,
    ``near``), and links ``a``, ``b`` that connect what all links connect.

    Vectors meet where a band of their codes agrees, in blocks, and are counted
    there (:class:`Links`). Only pairs that the codes leave open are written
    down; they are recomputed in double precision from the vectors themselves.
    """
    sink = partial(Links, threshold=threshold)
    found = stored(folded_in_blocks(coded_rows(distinct, threshold), ["label", "dim", "band", "key"], "rep", sink, Links.SCHEMA), "links")
    side = distinct.select("rep", "n", _scaled("embedding").alias("v"))
    joined = found.filter("near IS NULL").select("a", "b")
    joined = joined.join(side.withColumnsRenamed({"rep": "a", "n": "m", "v": "x"}), "a")
    joined = joined.join(side.withColumnsRenamed({"rep": "b", "v": "y"}), "b")

    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    cosine = dot("x", "y") / (F.sqrt(dot("x", "x")) * F.sqrt(dot("y", "y")))
    exact = stored(joined.filter(cosine >= threshold).select("a", "b", "m", "n"), "open-links")
    ends = F.inline(F.array(F.struct(F.col("a").alias("rep"), F.col("n").alias("near")), F.struct(F.col("b").alias("rep"), F.col("m").alias("near"))))
    counted = found.filter("b IS NULL").select(F.col("a").alias("rep"), "near").unionByName(exact.select(ends))
    counted = counted.groupBy("rep").agg(F.sum("near").alias("near"))
    return counted, found.filter("b IS NOT NULL AND near = 0").select("a", "b").unionByName(exact.select("a", "b"))


def _fixed(values: np.ndarray, repeat: int) -> pa.Array:
    """Rows of an array as binary values, each ``repeat`` times."""
    values = np.ascontiguousarray(values)
    width = values.shape[1] * values.itemsize
    data = np.repeat(values.view(np.uint8).reshape(len(values), width), repeat, axis=0)
    offsets = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _rows(column: pa.Array, places: np.ndarray, kind) -> np.ndarray:
    """The binary values at ``places``, all of one length, as rows of an array."""
    taken = column.take(pa.array(places))
    offsets = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4)
    data = np.frombuffer(taken.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.reshape(len(taken), -1).view(kind)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Equal vectors of a label are one while pairs are looked for, with their
    number: a vector links with each of its copies, and with each copy of a
    vector it is near to. Vectors that are null, zero, or hold null, NaN or
    infinite components, and vectors without a label link with nothing; so do
    vectors of different length. Rows with a null ``vec_id`` come back as they
    are, unlinked. Repeated rows are linked copies with one id. An empty table
    gives no rows; further columns are ignored.
    """
    vectors = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding", "label")
    good = vectors.filter(can_link()).withColumn("embedding", F.col("embedding").cast("array<double>"))
    # Zero has one sign here: grouping takes -0.0 and 0.0 as equal.
    distinct = good.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    # One id may stand for vectors of several labels, so each different vector gets a number; storing fixes it.
    distinct = distinct.withColumn("rep_id", F.col("rep")).withColumn("rep", F.monotonically_increasing_id())
    distinct = stored(distinct, "distinct-vectors")
    near, pairs = links_of(distinct, threshold)
    sizes = distinct.select("rep", "n", "rep_id")
    ids = pairs.join(sizes.select(F.col("rep").alias("a"), F.col("rep_id").alias("x")), "a").join(
        sizes.select(F.col("rep").alias("b"), F.col("rep_id").alias("y")), "b"
    )
    classes = components(ids.select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = sizes.join(near, "rep", "left").join(classes.withColumnRenamed("node", "rep_id"), "rep_id", "left")
    found = found.select(
        "rep",
        (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep_id").alias("component_id"),
    )
    found = distinct.select("label", "embedding", "n", "rep").join(found, "rep").select("label", "embedding", "n", "n_links", "component_id")
    members = joined_to_groups(good, stored(found, "classed"), ["label", "embedding"], "n", F.monotonically_increasing_id())
    members = members.select("vec_id", "n_links", "component_id")
    alone = vectors.filter(~can_link()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return members.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
