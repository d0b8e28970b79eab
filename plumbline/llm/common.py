"""What several operators share: reading text out of Arrow batches, words, stored tables."""

from __future__ import annotations

import atexit
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.storage import delete_folder, shared_folder

# White space as the contracts have it: space, and tab to carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"

# Text is worked on in slices of about this many bytes, whatever the batch holds.
SLICE_BYTES = 2_000_000

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# Folders of stored tables, by scope; those of no scope go when the driver's process ends.
_SCOPES: list[list[str]] = [[]]


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage and survives lost executors.

    The table lives as long as the innermost :func:`temporary_tables`, or else as the driver's process.
    """
    path = shared_folder(df.sparkSession, label)
    _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Tables stored inside are deleted at the end, also after a failure; but for those that are taken off the list."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()
        for path in paths:
            delete_folder(spark, path)


def outlives(path: str) -> None:
    """From now on the folder belongs to the scope that is open here, or to the driver's process."""
    _SCOPES[-1].append(path)


@atexit.register
def _at_exit() -> None:
    # Where the session has ended before, its folders are left to the checkpoint folder's own housekeeping.
    with suppress(Py4JError, Py4JNetworkError, AttributeError):
        spark = SparkSession.getActiveSession()
        for path in _SCOPES[0] if spark is not None else ():
            delete_folder(spark, path)


def reach_workers(df: DataFrame) -> None:
    """Put this library on the path of the Python workers that are started from now on."""
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def map_in_arrow(df: DataFrame, work: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow``, with this library on the path of the Python workers."""
    reach_workers(df)
    return df.mapInArrow(work, schema)


def map_batches(df: DataFrame, columns: list[str | Column], work: Callable, schema: str | StructType) -> DataFrame:
    """``work(batch) -> iterator of batches`` over slices of the given columns; the first is the text.

    Columns are projected by position, so clashing names in ``df`` do no harm.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                yield from work(piece)

    return map_in_arrow(df.select(*columns), run, schema)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes in the first column; a longer text is alone."""
    if batch.num_rows == 0:
        return
    offsets = text_bytes(batch.column(0))[1]
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column as one array, and where each row begins; null is empty."""
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    size = int(at[-1] - at[0])
    body = np.frombuffer(data, np.uint8, size, int(at[0])) if size else np.zeros(0, np.uint8)
    return body, at - at[0]


def word_bounds(
    body: np.ndarray, offsets: np.ndarray, between: np.ndarray = _IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in ``body``, and the number of words before each row (one more at the end).

    ``between`` says of each byte whether it stands between words.
    """
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~between[body]
    edge = np.zeros(len(body) + 1, dtype=bool)
    edge[offsets] = True
    begin = solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return begins, ends, np.searchsorted(begins, offsets)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_POWERS = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1024), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(body: np.ndarray, begins: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    out = np.zeros(len(begins), np.uint64)
    first = 0
    while first < len(begins):
        last = max(int(np.searchsorted(ends, begins[first] + block, side="right")), first + 1)
        b, e = begins[first:last], ends[first:last]
        lengths = e - b
        ends_in = np.cumsum(lengths)
        starts_in = ends_in - lengths
        inside = np.arange(ends_in[-1])
        place = inside - np.repeat(starts_in, lengths)
        values = _BYTE_CODES[body[inside + np.repeat(b - starts_in, lengths)]]
        values *= powers(0xD6E8FEB86659FD93, int(lengths.max()))[place]
        out[first:last] = np.add.reduceat(values, starts_in) + lengths.astype(np.uint64) * _ODD
        first = last
    return mixed(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def binary_rows(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of bytes cut out of one array."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())


def whole_row(docs: DataFrame) -> Column:
    """The whole row as ``document``: columns of any name are out of the way in it."""
    return F.struct(*[F.col(quoted(name)) for name in docs.columns]).alias("document")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def screen_of(values: DataFrame, value: str, bits: int) -> np.ndarray:
    """A bit for the low ``bits`` bits of each value (64-bit hashes): ``2**bits`` bits whatever the table holds.

    At most ``2**(bits - 6)`` words reach the driver. Values that share a bit
    let others pass a screen, and never hold one back.
    """
    slot = F.col(value).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(63).cast("int"))
    words = values.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    screen = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    screen[words["word"].to_numpy()] = words["bits"].to_numpy()
    return screen


def passes(screen: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    slot = values.view(np.int64) & ((1 << bits) - 1)
    return (screen[slot >> 6] >> (slot & 63)) & 1 == 1


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """``_k``, ``_l``: 128 bits that stand for a row's ``doc_id`` and text, whichever way the table is scanned."""
    parts = [F.col(doc_id).cast("string"), F.coalesce(F.col(text), F.lit(""))]
    return [F.xxhash64(*parts).alias("_k"), F.xxhash64(F.lit(1), *parts).alias("_l")]


def in_screen(df: DataFrame, screen: np.ndarray, value: Column, bits: int) -> Column:
    """Whether the screen lets ``value`` through. Python sees that column of ``df`` alone."""
    reach_workers(df)
    shared = df.sparkSession.sparkContext.broadcast(screen)

    @F.pandas_udf("boolean")
    def inside(values: pd.Series) -> pd.Series:
        return pd.Series(passes(shared.value, values.to_numpy(), bits))

    return inside(value)


# A key is hot in a join if it has more rows than this and than one in HOT_SHARE of all; there are at most HOT_SHARE such keys.
HOT_ROWS = 256
HOT_SHARE = 2000
MOST_SALTS = 256


def joined_to_groups(rows: DataFrame, groups: DataFrame, key: list[str], size: str, salt: Column) -> DataFrame:
    """``rows`` with the other columns of ``groups``, which has one row for each ``key`` and its number of rows as ``size``.

    The counts are known, so hot keys are cut before the join: their rows by
    a hash of ``salt``, and their group comes once for each salt. Null keys meet. ``groups`` should be stored: it is
    asked for its largest keys first, of which a bounded number of hashes reaches the driver.
    """
    total, most = groups.agg(F.sum(size), F.max(size)).first()
    least = max(HOT_ROWS, (total or 0) // HOT_SHARE)
    others = [name for name in groups.columns if name not in key]
    named = {name: f"_g_{name}" for name in groups.columns}
    salts = 0 if (most or 0) <= least else min(MOST_SALTS, -(-most // least))
    if salts:
        hot = [r["hash"] for r in groups.filter(F.col(size) > least).select(F.xxhash64(*key).alias("hash")).collect()]
        is_hot = F.xxhash64(*key).isin(hot)
        rows = rows.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(salt), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
        every = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        groups = groups.withColumn("_salt", F.explode(every))
        key, named = [*key, "_salt"], named | {"_salt": "_g__salt"}
    right = groups.withColumnsRenamed(named)
    same = [rows[name].eqNullSafe(right[named[name]]) for name in key]
    joined = rows.join(right, same)
    return joined.select(*[rows[name] for name in rows.columns if name != "_salt"], *[right[named[name]].alias(name) for name in others])


# The screen of rows that are dropped, or repeated, is this many bits (as a power of two), whatever the data: 16 MB.
ROW_SCREEN_BITS = 27


def row_order(docs: DataFrame) -> Column:
    """A hash of all columns of a ``document``, by which one of several rows with a key is chosen (maps take no part)."""
    return F.xxhash64(*[F.col("document").getField(f.name) for f in docs.schema if "map" not in f.dataType.simpleString()])


def one_of_each(docs: DataFrame, keys: DataFrame, screen_bits: int = ROW_SCREEN_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose key may be in ``keys`` (``_k``, ``_l``), one for each key, and all other rows.

    Both as ``document``, ``_k``, ``_l``. Of rows that share ``doc_id`` and text the one whose other columns have the
    smallest hash is taken: each task hands on one at most. A screen of fixed size tells the rows
    apart, so only rows with a key, and few others, move.
    """
    keyed = docs.select(whole_row(docs), *row_key())
    seen = in_screen(docs, screen_of(keys, "_k", screen_bits), F.col("_k"), screen_bits)
    few = keyed.filter(seen).groupBy("_k", "_l").agg(F.min_by("document", row_order(docs)).alias("document"))
    return few.select("document", "_k", "_l"), keyed.filter(~seen)


def keep_rows(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, by ``decided``: ``_k``, ``_l`` and ``kept`` for each row.

    Rows are known by their content, so the two scans need not agree on splits
    or order. If only some of the rows that share ``doc_id`` and text are kept,
    one is.
    """
    sums = decided.groupBy("_k", "_l").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).filter("kept < n")
    dropped = stored(sums.select("_k", "_l", (F.col("kept") > 0).alias("once")), "dropped-rows")
    few, others = one_of_each(docs, dropped)
    few = few.join(dropped, ["_k", "_l"], "left").filter("coalesce(once, true)")
    return others.select("document.*").unionByName(few.select("document.*"))


def text_row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Columns that tell rows of different text apart even if they share a ``doc_id``, or have none."""
    return [
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_body"),
    ]
