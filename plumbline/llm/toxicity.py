"""Toxicity by class-conditional Kneser-Ney models (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches, stored, word_bounds

# Grams are of this many bytes; with 8 bytes at most, one is a number and its count exact.
ORDER = 5
DISCOUNT = 0.75
# Likelihoods are compared over the whole text, over its passages of this many bytes, and over its words, of which the
# so many most toxic count: a single rare expression vanishes in a mean.
PASSAGE = 24
TOP_WORDS = 3
FEATURES = 2 + 2 * TOP_WORDS
# Bound of the sample that sets the threshold: about this many rows of each label.
CALIBRATION_ROWS = 3000

_SPREAD = 0x9E3779B97F4A7C15
# All of ASCII but small letters (texts are lower-case).
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[0x61:0x7B] = _NO_LETTER[0x80:] = False


def framed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case texts as bytes, each between two zero bytes, and where each begins."""
    parts = [f"\0{text.lower()}\0".encode() if text else b"\0\0" for text in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def grams(body: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every ``order`` bytes in a row as a number (the last byte lowest), and whether they are of one text."""
    n = len(body) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    values = np.zeros(n, np.uint64)
    for i in range(order):
        values <<= np.uint64(8)
        values |= body[i : i + n]
    inside = np.ones(n, bool)
    for offset in offsets[1:-1].tolist():
        inside[max(0, offset - order + 1) : offset] = False
    return values, inside


def gram_counts(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram``, ``toxic``, ``ordinary``: how often each gram stands in texts (``text``, ``toxic``) of either label."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        body, offsets = framed(batch.column(0))
        values, inside = grams(body, offsets, order)
        toxic = np.repeat(batch.column(1).to_numpy(zero_copy_only=False) == 1, np.diff(offsets))[: len(values)]
        found, which = np.unique(values[inside], return_inverse=True)
        columns = [np.bincount(which[mask], minlength=len(found)) for mask in (toxic[inside], ~toxic[inside])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), *map(pa.array, columns)], names=["gram", "toxic", "ordinary"]
        )

    counts = map_batches(labelled, ["text", "toxic"], count, "gram long, toxic long, ordinary long")
    return counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _suffix(n: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << (8 * n)) - 1))


def _small(table: DataFrame, size: int) -> DataFrame:
    """There are at most 65,536 grams of two bytes: a table of them, or of shorter ones, is broadcast."""
    return F.broadcast(table) if size <= 2 else table


def _shared_backoff(counts: DataFrame, order: int, discount: float) -> DataFrame:
    """``gram`` (of ``order`` - 1 bytes) and ``p``: interpolated Kneser-Ney on continuation counts of both classes together."""
    levels = {}
    above = counts
    for n in range(order - 1, 0, -1):
        levels[n] = above = above.groupBy(_suffix(n).alias("gram")).agg(F.count("*").alias("c"))
    total = levels[1].agg(F.sum("c").alias("c"), F.count("*").alias("kinds")).first()
    rest = discount * total["kinds"] / 256
    p = levels[1].select("gram", ((F.greatest(F.col("c") - discount, F.lit(0.0)) + rest) / total["c"]).alias("p"))
    for n in range(2, order):
        level = levels[n].withColumn("context", F.shiftright("gram", 8)).withColumn("tail", _suffix(n - 1))
        contexts = _small(level.groupBy("context").agg(F.sum("c").alias("total"), F.count("*").alias("kinds")), n - 1)
        below = _small(p.select(F.col("gram").alias("tail"), F.col("p").alias("below")), n - 1)
        joined = level.join(contexts, "context").join(below, "tail")
        spare = discount * F.col("kinds") / F.col("total") * F.col("below")
        p = joined.select("gram", (F.greatest(F.col("c") - discount, F.lit(0.0)) / F.col("total") + spare).alias("p"))
    return p


def log_ratios(counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """Log ratio of the classes' probabilities for each gram seen, and for a new gram after each context seen.

    Each class discounts its own counts and gives what it saves to the backoff
    that both share; so a gram neither class knows differs only by how much
    they save. Returns (``key``, ``value``, ``weight``) twice.
    """
    level = counts.withColumn("context", F.shiftright("gram", 8)).withColumn("tail", _suffix(order - 1))
    sums = [F.sum(c).alias(f"{c}_total") for c in ("toxic", "ordinary")]
    kinds = [F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in ("toxic", "ordinary")]
    contexts = level.groupBy("context").agg(*sums, *kinds)
    backoff = _shared_backoff(counts, order, discount).select(F.col("gram").alias("tail"), F.col("p").alias("shared"))
    joined = level.join(contexts, "context").join(backoff, "tail")

    def spare(name: str) -> Column:
        total = F.col(f"{name}_total")
        return F.when(total > 0, discount * F.col(f"{name}_kinds") / total).otherwise(F.lit(1.0))

    def probability(name: str) -> Column:
        total = F.col(f"{name}_total")
        own = F.when(total > 0, F.greatest(F.col(name) - discount, F.lit(0.0)) / total).otherwise(F.lit(0.0))
        return own + spare(name) * F.col("shared")

    seen = joined.select(
        F.col("gram").alias("key"),
        F.log(probability("toxic") / probability("ordinary")).alias("value"),
        (F.col("toxic") + F.col("ordinary")).alias("weight"),
    )
    new = contexts.select(
        F.col("context").alias("key"),
        F.log(spare("toxic") / spare("ordinary")).alias("value"),
        (F.col("toxic_total") + F.col("ordinary_total")).alias("weight"),
    )
    return seen, new


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(_SPREAD)) >> np.uint64(64 - bits)).astype(np.int64)


def keyed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and their values by slot, NaN where none is: at most half of the places are filled, the next free one is taken."""
    bits = max(4, int(2 * len(keys) - 1).bit_length()) if len(keys) else 4
    table, key_of = np.full(1 << bits, np.nan, np.float32), np.zeros(1 << bits, np.uint64)
    order = np.argsort(keys)
    keys, values = keys[order], values[order].astype(np.float32)
    at = slots(keys, bits)
    while len(keys):
        first = np.zeros(len(keys), bool)
        first[np.unique(at, return_index=True)[1]] = True
        first &= np.isnan(table[at])
        table[at[first]], key_of[at[first]] = values[first], keys[first]
        keys, values, at = keys[~first], values[~first], (at[~first] + 1) & ((1 << bits) - 1)
    return table, key_of


def look_up(keys: np.ndarray, table: np.ndarray, key_of: np.ndarray | None) -> np.ndarray:
    """The value of each key, NaN for a key that is not there; without ``key_of`` a place answers for every key."""
    bits = len(table).bit_length() - 1
    at = slots(keys, bits)
    out = table[at]
    if key_of is None:
        return out
    open_ = np.flatnonzero((key_of[at] != keys) & ~np.isnan(out))
    at = at[open_]
    while len(open_):
        at = (at + 1) & (len(table) - 1)
        out[open_] = table[at]
        further = (key_of[at] != keys[open_]) & ~np.isnan(out[open_])
        open_, at = open_[further], at[further]
    return out


def _table(ratios: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios by slot, and the gram of each: exact, and as large as there are grams."""
    found = ratios.select("key", F.col("value").cast("float")).toArrow()
    return keyed(found["key"].to_numpy().view(np.uint64), found["value"].to_numpy())


@dataclass
class Model:
    order: int = ORDER
    bits: int = 4
    seen: np.ndarray | None = None
    new: np.ndarray | None = None
    # The gram, and the context, of each place.
    seen_keys: np.ndarray | None = None
    new_keys: np.ndarray | None = None
    # Of the features, and the constant.
    weights: np.ndarray = field(default_factory=lambda: np.array([*[0.0] * FEATURES, -30.0]))

    def __getstate__(self) -> dict:
        """Travels as the places that are filled, at most as much as the tables themselves."""
        state = dict(self.__dict__)
        for name in ("seen", "new"):
            if (table := state[name]) is not None:
                filled = np.flatnonzero(~np.isnan(table))
                keys = state[f"{name}_keys"]
                state[f"{name}_keys"] = None
                state[name] = (len(table), filled, table[filled], None if keys is None else keys[filled])
        return state

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        for name in ("seen", "new"):
            if state[name] is not None:
                size, filled, values, keys = state[name]
                table = np.full(size, np.nan, np.float32)
                table[filled] = values
                setattr(self, name, table)
                if keys is not None:
                    key_of = np.zeros(size, np.uint64)
                    key_of[filled] = keys
                    setattr(self, f"{name}_keys", key_of)

    def features(self, column: pa.Array) -> np.ndarray:
        """For each text its mean log ratio a byte, that of its most toxic passage, and the log ratios of its most toxic
        words, once whole and once a byte (0 where there are fewer words)."""
        body, offsets = framed(column)
        values, inside = grams(body, offsets, self.order)
        out = np.zeros((len(column), FEATURES))
        if self.seen is None or not len(values):
            return out
        ratio = look_up(values, self.seen, self.seen_keys)
        missing = np.flatnonzero(np.isnan(ratio))
        ratio[missing] = look_up(values[missing] >> np.uint64(8), self.new, self.new_keys)
        ratio = np.where(inside, np.nan_to_num(ratio), 0.0)
        ratio = np.concatenate([ratio, np.zeros(self.order - 1)])  # as many places as bytes
        sums = np.concatenate([[0.0], np.cumsum(ratio)])
        lengths = np.diff(offsets)
        out[:, 0] = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(1, lengths - self.order + 1)
        # A passage may reach past the end of a short text, over places that count as zero.
        padded = np.concatenate([sums, np.full(PASSAGE, sums[-1])])
        last = np.repeat(sums[offsets[1:]], lengths)
        reach = np.arange(len(body)) + PASSAGE
        ends = np.repeat(offsets[1:], lengths)
        passages = np.where(reach <= ends, padded[PASSAGE : PASSAGE + len(body)], last) - sums[:-1]
        out[:, 1] = np.maximum.reduceat(passages, offsets[:-1]) / PASSAGE
        begins, ends, first_word = word_bounds(body, offsets, _NO_LETTER)
        if len(begins):
            # The grams that end in a word or right after it.
            totals = sums[np.maximum(0, ends + 2 - self.order)] - sums[np.maximum(0, begins + 1 - self.order)]
            text = np.repeat(np.arange(len(column)), np.diff(first_word))
            out[:, 2 : 2 + TOP_WORDS] = _largest(totals, text, first_word)
            out[:, 2 + TOP_WORDS :] = _largest(totals / (ends - begins + 1), text, first_word)
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        x = self.features(column) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _largest(values: np.ndarray, text: np.ndarray, first: np.ndarray, count: int = TOP_WORDS) -> np.ndarray:
    """The largest values of each text, in falling order; 0 where it has fewer."""
    order = np.lexsort((-values, text))
    out = np.zeros((len(first) - 1, count))
    for place in range(count):
        some = np.flatnonzero(np.diff(first) > place)
        out[some, place] = values[order[first[some] + place]]
    return out


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> np.ndarray:
    """Weights and constant of a logistic regression (Newton steps)."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``toxic`` of the documents with a label; of several labels the highest counts.

    Labels grow with the documents, so they are merged and not broadcast at any size.
    """
    known = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").join(known.hint("merge"), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, part: Column, order: int = ORDER) -> Model:
    """A model from labelled documents; ``part`` numbers them 1 to 4 (learn) or otherwise (never looked at).

    Grams of all of parts 1 to 3 are counted in Spark. Part 4 gives a bounded
    sample to set the weights. With one label only, or none, every score is
    next to zero.
    """
    learn = with_labels(docs.filter(part.isin(1, 2, 3)), labels)
    counts = stored(gram_counts(learn, order), "gram-counts")
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).first()
    model = Model(order)
    if not totals["toxic"] or not totals["ordinary"]:
        return model
    seen, new = log_ratios(counts, order)
    model.seen, model.seen_keys = _table(seen)
    model.new, model.new_keys = _table(new)
    model.bits = len(model.seen).bit_length() - 1

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    sample = with_labels(docs.filter(part == 4), labels)
    sizes = {row["toxic"]: row["n"] for row in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0.0)
    for label in (0, 1):
        # A fifth of the labelled rows is in part 4.
        share = min(1.0, 5 * CALIBRATION_ROWS / max(1, sizes.get(label, 0)))
        rate = F.when(F.col("toxic") == label, F.lit(share)).otherwise(rate)
    sample = sample.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < rate)

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = shared.value.features(batch.column(0))
        lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * FEATURES, found.ravel())
        yield pa.RecordBatch.from_arrays([lists, batch.column(1)], names=["features", "toxic"])

    rows = map_batches(sample, ["text", F.col("toxic").cast("int")], measure, "features array<double>, toxic int").toArrow()
    y = rows["toxic"].to_numpy()
    if len(set(y.tolist())) == 2:
        x = rows["features"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
        # Sums depend on the order of the rows; theirs is that of their values.
        order_of = np.lexsort((*x.T, y))
        model.weights = _logistic(x[order_of], y[order_of])
    return model


def score(docs: DataFrame, model: Model, carried: list[str | Column] | None = None, schema: str = "") -> DataFrame:
    """``carried`` columns of each document with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    The score compares the two models' log-likelihoods a byte, over the whole
    text, over its most toxic passage and over its most toxic words. Null and empty texts are scored as a
    text without grams; equal texts get equal scores; an empty table gives no
    rows. Very long texts are scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = shared.value.scores(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            names=[*batch.schema.names[1:], "score", "predicted"],
        )

    carried = ["doc_id"] if carried is None else carried
    return map_batches(docs, ["text", *carried], run, f"{schema or 'doc_id long'}, score double, predicted int")


def learning_part(doc_id: str = "doc_id") -> Column:
    """0 for rows held out (and rows without an id), 1 to 4 for the others."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(0))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
