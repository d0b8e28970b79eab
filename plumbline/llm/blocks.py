"""Comparing the members of buckets in blocks, without sending pairs through a join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_in_arrow

# Members of a bucket that meet in one group; a larger bucket is cut, and each two parts meet.
BLOCK = 1024
# Pairs looked at together.
TILE = 50_000
# Groups of more rows are compared as matrices of so many rows at a time.
DENSE = 48
DENSE_ROWS = 256


def blocked(rows: DataFrame, keys: list[str], identity: str, block: int = BLOCK) -> DataFrame:
    """Members of buckets of two and more, with the block pair (``_s``, ``_t``) they meet in and their own block (``_own``).

    A bucket of more than ``block`` members is cut into blocks by hash, and
    its members repeated for every block they must meet.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    joined = rows.join(sizes, keys)
    parts = F.ceil(F.col("_n") / block).cast("int")
    joined = joined.withColumn("_m", parts).withColumn("_own", F.pmod(F.xxhash64(identity), F.col("_m")).cast("int"))
    joined = joined.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    return joined.select(
        *rows.columns, "_own", F.least("_own", "_with").alias("_s"), F.greatest("_own", "_with").alias("_t")
    )


def tiles(first: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within groups that begin at ``first``, some at a time."""
    ends = np.append(first[1:], total)
    group_end = np.repeat(ends, ends - first)
    step, place = 1, np.arange(total)
    while len(place := place[place + step < group_end[place]]):
        for at in range(0, len(place), TILE):
            part = place[at : at + TILE]
            yield part, part + step
        step += 1


def _roots(parent: np.ndarray) -> np.ndarray:
    while not np.array_equal(above := parent[parent], parent):
        parent = above
    return parent


class Pairs:
    """Pairs of a task's rows for which ``test(columns, i, j)`` holds.

    With ``spanning``, pairs are needed for what they connect only, and those
    that found pairs connect already are not tested.
    """

    SCHEMA = "a long, b long"

    def __init__(self, columns: dict, identity: str, test: Callable, spanning: bool = False) -> None:
        self.columns, self.test, self.spanning = columns, test, spanning
        self.ids = columns[identity].to_numpy()
        self.forest = Forest(self.ids)
        self.found: list[tuple[np.ndarray, np.ndarray]] = []

    def take(self, i: np.ndarray, j: np.ndarray) -> None:
        if self.spanning:
            apart = self.forest.apart(i, j)
            i, j = i[apart], j[apart]
        keep = self.test(self.columns, i, j)
        i, j = i[keep], j[keep]
        self.found.append((self.ids[i], self.ids[j]))
        if self.spanning:
            self.forest.join(i, j)

    def result(self) -> pa.RecordBatch | None:
        if not self.found:
            return None
        a, b = (np.concatenate(side) for side in zip(*self.found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


class Forest:
    """What the pairs of a task connect so far."""

    def __init__(self, ids: np.ndarray) -> None:
        different, self.number = np.unique(ids, return_inverse=True)
        self.parent = np.arange(len(different))

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        self.parent = _roots(self.parent)
        return self.parent[self.number[i]] != self.parent[self.number[j]]

    def join(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Joins the pairs in order; says which of them connected something."""
        new, parent = np.zeros(len(i), bool), self.parent
        for place, (x, y) in enumerate(zip(self.number[i].tolist(), self.number[j].tolist(), strict=True)):
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            new[place] = x != y
            parent[max(x, y)] = min(x, y)
        return new


def pairs_in_blocks(
    rows: DataFrame,
    keys: list[str],
    identity: str,
    test: Callable,
    rough: Callable | None = None,
    spanning: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Pairs ``a`` < ``b`` (of ``identity``) of a bucket's members for which ``test(columns, i, j)`` holds (:class:`Pairs`)."""
    sink = partial(Pairs, identity=identity, test=test, spanning=spanning)
    return folded_in_blocks(rows, keys, identity, sink, Pairs.SCHEMA, rough, block)


def folded_in_blocks(
    rows: DataFrame,
    keys: list[str],
    identity: str,
    sink: Callable,
    schema: str,
    rough: Callable | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """What ``sink(columns)`` makes of the pairs of a bucket's members: it takes places of them and gives one batch.

    ``columns`` holds the rows' columns as Arrow arrays, places are numbers in
    them; ``take(i, j)`` gets some pairs at a time, each with the smaller
    ``identity`` first. ``rough(columns, left, right)`` is a quick test that
    holds for every pair that matters: a matrix for two ranges of places, used in large groups.

    A task reads its groups one after the other in sorted order and keeps one
    block pair, at most about twice ``block`` rows.
    """
    prepared = blocked(rows, keys, identity, block)
    group = [*keys, "_s", "_t"]
    prepared = prepared.repartition(*group).sortWithinPartitions(*group)

    def candidates(columns: dict, first: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ends = np.append(first[1:], total)
        large = (ends - first > DENSE) & (rough is not None)
        small = np.repeat(~large, ends - first)
        # Rows of large groups stand alone here, and pair with none.
        yield from tiles(np.flatnonzero(~small | np.isin(np.arange(total), first)), total)
        for begin, end in zip(first[large].tolist(), ends[large].tolist(), strict=True):
            for at in range(begin, end, DENSE_ROWS):
                left, right = slice(at, min(at + DENSE_ROWS, end)), slice(at, end)
                i, j = np.nonzero(np.triu(rough(columns, left, right), 1))
                yield i + at, j + at

    def work(table: pa.Table) -> pa.RecordBatch | None:
        columns = {name: table.column(name).combine_chunks() for name in table.column_names}
        names = [columns[name].to_numpy(zero_copy_only=False) for name in group]
        total = table.num_rows
        opens = np.ones(total, bool)
        opens[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in names])
        s, t = columns["_s"].to_numpy(), columns["_t"].to_numpy()
        own, ids = columns["_own"].to_numpy(), columns[identity].to_numpy()
        taker = sink(columns)

        def take(pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
            i, j = (np.concatenate(side) for side in zip(*pairs, strict=True))
            for at in range(0, len(i), TILE):
                taker.take(i[at : at + TILE], j[at : at + TILE])

        held, waiting = [], 0
        for i, j in candidates(columns, np.flatnonzero(opens), total):
            meet = ((s[i] == t[i]) | (own[i] != own[j])) & (ids[i] != ids[j])
            i, j = i[meet], j[meet]
            swap = ids[i] > ids[j]
            held.append((np.where(swap, j, i), np.where(swap, i, j)))
            waiting += len(i)
            if waiting >= TILE:
                take(held)
                held, waiting = [], 0
        if held:
            take(held)
        return taker.result()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys_of = [batch.column(name).to_numpy(zero_copy_only=False) for name in group]
            changes = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in keys_of])) + 1
            if not len(changes):
                held.append(batch)
                continue
            cut = int(changes[-1])
            result = work(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            if result is not None:
                yield result
            held = [batch.slice(cut)]
        if held:
            result = work(pa.Table.from_batches(held))
            if result is not None:
                yield result

    return map_in_arrow(prepared, run, schema)
