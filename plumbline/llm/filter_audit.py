"""What each of several filters removes, in every order of them (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import map_batches, map_in_arrow, passes, screen_of, stored

# Counters of the sketch for each text, and counters that a text is counted in.
COUNTERS = 16
PROBES = 3
# The sketch is asked as one bit for each counter, at most 2**MOST_BITS of them: 32 MB. A fuller sketch clears fewer texts.
LEAST_BITS = 16
MOST_BITS = 28

DUPLICATE = "E"


def text_filters(text: str = "text") -> dict[str, Column]:
    """True where a text fails: A under 100 words, B few different words, C many capitals, D signs of markup or tables."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")
    count, different = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    return {
        "A": count < 100,
        "B": 100 * different < 80 * count,
        "C": 100 * F.regexp_count(body, F.lit("[A-Z]")).cast("long") > 10 * F.length(body).cast("long"),
        "D": body.rlike("[#$%&*|]"),
    }


def _slots(bits: int) -> list[Column]:
    """The counters of a text, from its two hashes."""
    mask = F.lit((1 << bits) - 1).cast("long")
    return [F.col("h").bitwiseAND(mask), F.col("g").bitwiseAND(mask), F.shiftrightunsigned("h", 64 - bits)][:PROBES]


def repeat_screen(prints: DataFrame, most_bits: int = MOST_BITS) -> tuple[np.ndarray, int]:
    """The counting Bloom sketch of the texts (hashes ``h``, ``g``): a bit for each counter that counted more than one.

    Every task counts its own rows, and the counters are added up. A text with
    a counter of one is the only one of its kind; what reaches the driver is
    bounded by ``most_bits``, whatever the table holds.
    """
    wanted = max(1, prints.count()) * COUNTERS
    bits = min(max(wanted.bit_length(), LEAST_BITS), most_bits)
    counters = prints.select(F.explode(F.array(*_slots(bits))).alias("slot")).groupBy("slot").agg(F.count("*").alias("n"))
    return screen_of(counters.filter("n > 1"), "slot", bits), bits


def _suspect(screen: np.ndarray, bits: int, h: np.ndarray, g: np.ndarray) -> np.ndarray:
    slots = [h, g, (h.view(np.uint64) >> np.uint64(64 - bits)).view(np.int64)][:PROBES]
    return np.logical_and.reduce([passes(screen, slot, bits) for slot in slots])


def masks(docs: DataFrame, filters: dict[str, Column], part: Column, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id``, ``part``, ``mask``, ``n``: rows by the filters they fail.

    Bit i of ``mask`` stands for filter i of ``filters``, the next one for a
    text that a row with a smaller ``doc_id`` has as well.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = [F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")]
    failed = [F.when(F.coalesce(fails, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, fails in enumerate(filters.values())]
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    mask = sum(failed, F.lit(0)).cast("int").alias("mask")
    flags = docs.select(doc_id, F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask, *hashes)
    flags = stored(flags, "flags")

    screen, bits = repeat_screen(flags, most_bits)
    shared = docs.sparkSession.sparkContext.broadcast(screen)

    def repeats(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h, g = (batch.column(i).to_numpy() for i in (2, 3))
        yield batch.filter(pa.array(_suspect(shared.value, bits, h, g)))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, g = (batch.column(name).to_numpy() for name in ("h", "g"))
            found = pa.array(_suspect(shared.value, bits, h, g))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "suspect"])

    # Only texts that may repeat move, one copy of each from a task.
    texts = map_batches(docs, [text.alias("text"), doc_id, *hashes], repeats, "text string, doc_id long, h long, g long")
    firsts = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.first("h").alias("h"), F.first("g").alias("g"))
    firsts = firsts.select("doc_id", "h", "g", F.lit(True).alias("first"))

    flags = map_in_arrow(flags, marked, "doc_id long, part string, mask int, h long, g long, suspect boolean")
    # Repeated rows are one with a number before they meet the smallest ids: no key is left that many rows share.
    rows = flags.groupBy(*flags.columns).agg(F.count("*").alias("n"))
    same = rows["doc_id"].eqNullSafe(firsts["doc_id"]) & (rows["h"] == firsts["h"]) & (rows["g"] == firsts["g"])
    suspects = rows.filter("suspect").join(firsts, same, "left").select(rows["doc_id"], "part", "mask", "n", "first")
    unique = rows.filter("not suspect").select("doc_id", "part", "mask", "n", F.lit(True).alias("first"))
    again = F.when(F.col("first"), F.lit(0)).otherwise(F.lit(1 << len(filters)))
    return unique.unionByName(suspects).select("doc_id", "part", (F.col("mask") + again).cast("int").alias("mask"), "n")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask``, ``n``, ``good``, ``toxic``: documents, and those labelled, of each mask.

    Of several labels of a ``doc_id`` the highest counts. Only labelled rows are joined; the counts are then added.
    """
    rows = stored(rows, "masks")
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id")
    known = known.agg(*[F.coalesce(F.max(c) == 1, F.lit(False)).cast("long").alias(c) for c in ("quality", "toxic")])
    labelled = rows.join(known.filter("quality + toxic > 0"), "doc_id")
    labelled = labelled.select("part", "mask", F.lit(0).cast("long").alias("n"), (F.col("quality") * F.col("n")).alias("good"), (F.col("toxic") * F.col("n")).alias("toxic"))
    none = [F.lit(0).cast("long").alias(name) for name in ("good", "toxic")]
    added = rows.select("part", "mask", "n", *none).unionByName(labelled)
    return added.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def interactions(counts: DataFrame, letters: Sequence[str]) -> DataFrame:
    """For each part, order of the filters and step of it: what its filter finds, of the documents there and of those gone before.

    The 32 masks of a part at most are all that is multiplied by the orders.
    """
    letters = "".join(letters)
    orders = ",".join("".join(order) for order in permutations(sorted(letters)))

    def bit(step: int | str) -> Column:
        return F.expr(f"shiftleft(1, locate(substr(filter_order, {step}, 1), '{letters}') - 1)")

    before = sum((F.when(F.col("step") > k, bit(k)).otherwise(F.lit(0)) for k in range(1, len(letters))), F.lit(0))
    rows = counts.select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    rows = rows.withColumns({"bit": bit("step"), "before": before})
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, number: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(number)).otherwise(F.lit(0))).cast("long")

    found = rows.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "bit")).alias("shapley")
    return found.select("*", shapley).drop("bit")


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, part: Column | None = None) -> DataFrame:
    """One row per part, order of the filters and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost``, ``shapley``.

    ``filters`` (by letter, true where a text fails; by default those of
    :func:`text_filters`) are judged on each document alone. The last one,
    ``E``, finds texts that a smaller ``doc_id`` has as well, in the whole
    table: a counting Bloom sketch first clears the texts that stand once; the
    others are grouped by their full text for its smallest id. Parts are the
    values of ``part`` (``lang``), null is the empty one.

    Null is an empty text. A null ``doc_id`` comes after all others and has no
    label; rows that share text and ``doc_id`` do not remove each other. Very
    long texts are read whole. An empty table gives no rows, without labels the
    labelled counts are 0. Further columns, of any name, are ignored.
    """
    filters = text_filters() if filters is None else filters
    part = F.col("lang") if part is None else part
    counts = stored(mask_counts(masks(docs, filters, part), labels), "mask-counts")
    return interactions(counts, [*filters, DUPLICATE])
