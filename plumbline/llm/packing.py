"""Packing documents into training windows by Karmarkar-Karp differencing (operator 1)."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plumbline.llm.common import map_in_arrow, slices

WINDOW = 2048
# Longer documents are cut: windows are near equal only if a piece is small beside a window.
PIECE = 512
# Windows that are filled together. Bounds the memory of a task and the length of a differencing step.
GROUP_WINDOWS = 256
# Small pieces are laid into windows in lots of at most this many tokens, so that a group holds a bounded number of lots:
# two neighbours have more than this together.
LOT = 128
END_ID = 1
# The pattern of byte-level vocabularies (fixed value).
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(others)}


class Encoder:
    """Token ids of texts by a byte-level BPE file of the ``tokenizers`` library.

    The ids are those of ``tokenizers`` (``add_special_tokens=False``). Texts
    go through ``tiktoken``, built from the same file and several times as
    fast; a text that holds the string of a special token goes through
    ``tokenizers`` itself, and so does one that the splitting of ``tiktoken``
    gives up on (a million spaces in a row). Only a file whose ids are its merge
    order can be read as ranks; for any other, ``tokenizers`` does all.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        special = [token["content"] for token in held.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special)) if special else r"(?!)")
        model, splitter = held["model"], held.get("pre_tokenizer") or {}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        merged = [model["vocab"].get(left + right) for left, right in merges]
        plain = (
            model.get("type") in (None, "BPE")
            and splitter.get("type") == "ByteLevel"
            and not splitter.get("add_prefix_space")
            and splitter.get("use_regex", True)
            and held.get("normalizer") is None
            and merged == list(range(256, 256 + len(merged)))
        )
        self.fast = None
        if plain:
            codes = _byte_of_character()
            ranks = {bytes(codes[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
            self.fast = tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.fast is not None and not self.special.search(text):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except ValueError:  # the pattern's backtracking is bounded
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


@cache
def encoder_of(path: str) -> Encoder:
    """One per Python worker; its tasks share it."""
    return Encoder(path)


def difference(sizes: np.ndarray, ways: int) -> np.ndarray:
    """Part (0 to ``ways`` - 1) of each size, by multiway differencing.

    Every size begins as a partial partition of its own: one filled part, the
    others empty. The two partial partitions with the widest gap between their
    largest and smallest part are merged again and again, the largest part of
    one with the smallest of the other, so that their imbalances cancel.
    """
    n = len(sizes)
    if ways <= 1 or n == 0:
        return np.zeros(n, dtype=np.int64)
    # Items of a part form a chain; a partial partition holds the head and tail of each chain.
    following = np.full(n, -1, dtype=np.int64)
    heap: list = []
    for item in np.argsort(-sizes, kind="stable"):
        heap.append((-int(sizes[item]), int(item), None))
    heapq.heapify(heap)
    stamp = n

    def opened(entry):
        gap, item, state = entry
        if state is not None:
            return state
        sums = np.zeros(ways, dtype=np.int64)
        heads = np.full(ways, -1, dtype=np.int64)
        sums[0], heads[0] = -gap, item
        return sums, heads, heads.copy()

    while len(heap) > 1:
        a_sums, a_heads, a_tails = opened(heapq.heappop(heap))
        b_sums, b_heads, b_tails = opened(heapq.heappop(heap))
        b_sums, b_heads, b_tails = b_sums[::-1], b_heads[::-1], b_tails[::-1]
        both = (a_heads >= 0) & (b_heads >= 0)
        following[a_tails[both]] = b_heads[both]
        sums = a_sums + b_sums
        heads = np.where(a_heads >= 0, a_heads, b_heads)
        tails = np.where(b_heads >= 0, b_tails, a_tails)
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        stamp += 1
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), stamp, (sums, heads[order], tails[order])))
    _, heads, _ = opened(heap[0])
    part = np.zeros(n, dtype=np.int64)
    at, here = heads.copy(), np.arange(ways)
    while (live := at >= 0).any():
        at, here = at[live], here[live]
        part[at] = here
        at = following[at]
    return part


def windows(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """A window for each size, and how many there are: one more as long as a window exceeds ``capacity``."""
    ways = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        part = difference(sizes, ways)
        if np.bincount(part, sizes, ways).max() <= capacity:
            return part, ways
        ways += 1


def lots(sizes: np.ndarray, most: int) -> np.ndarray:
    """The lot of each size, in order from 0: neighbours are put together as long as they have ``most`` together."""
    lot, filled, out = -1, most, np.zeros(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        if filled + size > most:
            lot, filled = lot + 1, 0
        filled += size
        out[i] = lot
    return out


SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, sequence_length long, ids binary"
)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    piece: int = PIECE,
    group_windows: int = GROUP_WINDOWS,
    end_id: int = END_ID,
) -> DataFrame:
    """Documents (``doc_id``, ``text``) as pieces laid into windows of at most ``window`` tokens.

    One row per piece: ``doc_id``, ``start`` (the document's ids before it),
    ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence,
    ``sequence_length`` and the ``ids`` as little-endian unsigned 32-bit numbers.

    Each task cuts its documents into pieces of at most ``piece`` ids as they
    stream past, and fills ``group_windows`` windows at a time: nothing is
    shuffled, a long document spans as many windows as it needs, and a task
    holds one group. Neighbouring small pieces are one until they are laid, so
    that very many of them need no more memory than few. A retried task reads the same split and so repeats its
    sequences.

    Null and empty texts are one piece, the end id alone. A null ``doc_id`` and
    repeated rows are packed like any other row; other columns are ignored.
    An empty table gives no rows. Ties between sizes are decided by arrival.
    """
    if not 0 < piece <= window:
        raise ValueError("a piece must fit a window")
    budget = window * group_windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        sequence = TaskContext.get().partitionId() << 33
        end = np.array([end_id], dtype="<u4").tobytes()
        held: list[tuple[int | None, int, int, int, bytes]] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, sequence, total
            sizes = np.array([row[2] for row in held], dtype=np.int64)
            lot = lots(sizes, min(LOT, piece))
            part, ways = windows(np.bincount(lot, sizes).astype(np.int64), window)
            part = part[lot]
            order = np.argsort(part, kind="stable")
            filled = np.bincount(part, sizes, ways).astype(np.int64)
            before = np.cumsum(sizes[order]) - sizes[order]
            offsets = before - (np.cumsum(filled) - filled)[part[order]]
            numbers = np.cumsum(filled > 0) - 1
            rows = [held[i] for i in order]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([row[0] for row in rows], pa.int64()),
                    pa.array([row[1] for row in rows], pa.int64()),
                    pa.array(sizes[order]),
                    pa.array([row[3] for row in rows], pa.int64()),
                    pa.array(sequence + numbers[part[order]]),
                    pa.array(offsets),
                    pa.array(filled[part[order]]),
                    pa.array([row[4] for row in rows], pa.binary()),
                ],
                names=[field.split()[0] for field in SCHEMA.split(", ")],
            )
            sequence += int(numbers[-1]) + 1
            held, total = [], 0
            return out

        for batch in batches:
            for part in slices(batch):
                texts = [text or "" for text in part.column(0).to_pylist()]
                for doc_id, text in zip(part.column(1).to_pylist(), texts, strict=True):
                    ids = encoder.encode(text).tobytes() + end
                    count = len(ids) // 4
                    for start in range(0, count, piece):
                        cut = ids[4 * start : 4 * (start + piece)]
                        held.append((doc_id, start, len(cut) // 4, count, cut))
                        total += len(cut) // 4
                        if total >= budget:
                            yield flush()
        if held:
            yield flush()

    return map_in_arrow(docs.select("text", docs["doc_id"].cast("long").alias("doc_id")), run, SCHEMA)
