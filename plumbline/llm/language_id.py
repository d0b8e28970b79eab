"""Language identification by a bidirectional GRU over bytes (operator 4)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from plumbline.llm.common import map_batches, text_bytes, whole_row

# Width of the recurrent state in each direction.
HIDDEN = 8
# The network reads a text in stretches of this many bytes, each from a fresh state.
STRETCH = 128
# Stretches that run side by side.
LANES = 4096
# Bound of the training sample: about this many documents of a language, stretches of a document, bytes of each.
SAMPLE_DOCS = 1000
SAMPLE_STRETCHES = 4
SAMPLE_BYTES = 64
# Steps of training, whatever the sample holds, and stretches in each.
STEPS = 375
BATCH = 256
UNKNOWN = "und"

# What may be a letter: signs such as ² and Ⅷ are among these, too.
_MAY_BE_LETTER = re.compile(r"[^\W\d_]")
PAD = 0


def has_letter(text: str) -> bool:
    """Whether any character is of a Unicode letter class (Lu, Ll, Lt, Lm, Lo)."""
    return any(found.group().isalpha() for found in _MAY_BE_LETTER.finditer(text))


@dataclass
class Network:
    """Weights by name: ``x`` the input tables (256 x 3H), ``u`` the recurrent ones (H x 3H), ``b`` of the
    candidate, ``v`` the output (H x K), each for both directions, and the output bias ``c``. Gates are
    ordered update, reset, candidate."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(languages: list[str], hidden: int, seed: int) -> Network:
        draw = np.random.default_rng(seed)
        weights = {"c": np.zeros(len(languages))}
        for way in "fb":
            weights["x" + way] = draw.normal(0, 0.3, (256, 3 * hidden))
            weights["u" + way] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
            weights["b" + way] = np.zeros(hidden)
            weights["v" + way] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, len(languages)))
        return Network(languages, {name: w.astype(np.float32) for name, w in weights.items()})


def _run(w: dict[str, np.ndarray], way: str, bytes_in: np.ndarray, real: np.ndarray | None = None, keep: bool = False):
    """States of one direction after each step of ``bytes_in`` (time x lanes), as time x H x lanes; with what training needs.

    Where ``real`` (0 or 1, time x lanes) is 0 there is no text, and the state is fresh.
    """
    x, u, b = w["x" + way].T.copy(), w["u" + way].T.copy(), w["b" + way][:, None]
    steps, lanes = bytes_in.shape
    hidden = u.shape[1]
    gates = 2 * hidden
    # sigmoid(a) = (1 + tanh(a / 2)) / 2: half the gates' weights here, and one tanh does.
    x[:gates] *= 0.5
    u[:gates] *= 0.5
    states = np.empty((steps, hidden, lanes), np.float32)
    kept = []
    order = range(steps) if way == "f" else range(steps - 1, -1, -1)
    state = np.zeros((hidden, lanes), np.float32)
    entered = np.empty((3 * hidden, lanes), np.float32)
    mixed = np.empty((3 * hidden, lanes), np.float32)
    for t in order:
        np.take(x, bytes_in[t], axis=1, out=entered, mode="clip")
        np.matmul(u, state, out=mixed)
        opened, candidate, recalled = entered[:gates], entered[gates:], mixed[gates:]
        opened += mixed[:gates]
        np.tanh(opened, out=opened)
        opened *= 0.5
        opened += 0.5
        recalled += b
        candidate += opened[hidden:] * recalled
        np.tanh(candidate, out=candidate)
        after = states[t]
        np.subtract(state, candidate, out=after)
        after *= opened[:hidden]
        after += candidate
        if real is not None:
            after *= real[t]
        if keep:
            kept.append((t, state, opened.copy(), recalled.copy(), candidate.copy()))
        state = after
    return states, kept


def _position_probabilities(w: dict[str, np.ndarray], ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Time x K x lanes."""
    scores = np.matmul(w["vf"].T, ahead)
    scores += np.matmul(w["vb"].T, back)
    scores += w["c"][:, None]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _gradients(w: dict[str, np.ndarray], bytes_in: np.ndarray, labels: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradients of the mean cross entropy over all positions, by backpropagation through time."""
    real = bytes_in != PAD
    there = real.astype(np.float32)
    runs = {way: _run(w, way, bytes_in, there, keep=True) for way in "fb"}
    error = _position_probabilities(w, runs["f"][0], runs["b"][0])
    lanes, count = np.arange(len(labels)), max(1, int(real.sum()))
    loss = float(-np.log(error[:, labels, lanes][real] + 1e-9).sum() / count)
    error[:, labels, lanes] -= 1
    error *= (real / count).astype(np.float32)[:, None]
    found = {"c": error.sum(axis=(0, 2))}
    for way, (states, kept) in runs.items():
        u = w["u" + way]
        hidden = u.shape[0]
        found["v" + way] = np.matmul(states, error.transpose(0, 2, 1)).sum(axis=0)
        from_above = np.matmul(w["v" + way], error)
        dx, du, db = np.zeros_like(w["x" + way]), np.zeros_like(u), np.zeros(hidden, np.float32)
        carried = np.zeros_like(states[0])
        for t, state, opened, recalled, candidate in reversed(kept):
            update, reset = opened[:hidden], opened[hidden:]
            d = (carried + from_above[t]) * there[t]
            d_candidate = d * (1 - update) * (1 - candidate * candidate)
            d_recalled = d_candidate * reset
            d_update = d * (state - candidate) * update * (1 - update)
            d_reset = d_candidate * recalled * reset * (1 - reset)
            d_mixed = np.concatenate([d_update, d_reset, d_recalled])
            du += state @ d_mixed.T
            db += d_recalled.sum(axis=1)
            np.add.at(dx, bytes_in[t], np.concatenate([d_update, d_reset, d_candidate]).T)
            carried = d * update + u @ d_mixed
        found |= {"x" + way: dx, "u" + way: du, "b" + way: db}
    return found, loss


def train(
    stretches: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 4
) -> Network:
    """A network from stretches (rows of bytes, padded with 0) and the language number of each (Adam, fixed seed)."""
    network = Network.fresh(languages, hidden, seed)
    w, draw = network.weights, np.random.default_rng(seed)
    first = {name: np.zeros_like(x) for name, x in w.items()}
    second = {name: np.zeros_like(x) for name, x in w.items()}
    step, order = 0, np.zeros(0, np.int64)
    while step < steps:
        while len(order) < BATCH:
            order = np.concatenate([order, draw.permutation(len(labels))])
        pick, order = order[:BATCH], order[BATCH:]
        found, _ = _gradients(w, np.ascontiguousarray(stretches[pick].T), labels[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
        step += 1
        rate = 0.02 * (1 - 0.9 * step / steps)
        for name, g in found.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
            w[name] -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return network


def pooled(network: Network, body: np.ndarray, offsets: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """For each text the mean of its positions' probabilities (all zero for an empty text)."""
    lengths = np.diff(offsets)
    parts = -(-lengths // stretch)
    text = np.repeat(np.arange(len(lengths)), parts)
    begins = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    begins = begins * stretch + np.repeat(offsets[:-1], parts)
    sizes = np.minimum(np.repeat(offsets[1:], parts) - begins, stretch)
    sums = np.zeros((len(lengths), len(network.languages)))
    w = network.weights
    # Whole stretches first; the others by length: few steps without text.
    order = np.argsort(-sizes, kind="stable")
    whole = int((sizes == stretch).sum())
    groups = [order[at : min(at + LANES, whole)] for at in range(0, whole, LANES)]
    groups += [order[at : at + LANES] for at in range(whole, len(order), LANES)]
    for lanes in groups:
        steps = np.arange(int(sizes[lanes[0]]))[:, None]
        real = steps < sizes[lanes]
        bytes_in = np.where(real, body[np.minimum(begins[lanes] + steps, len(body) - 1)], np.uint8(PAD))
        there = None if real.all() else real.astype(np.float32)
        ahead, back = (_run(w, way, bytes_in, there)[0] for way in "fb")
        probabilities = _position_probabilities(w, ahead, back)
        probabilities *= real[:, None]
        np.add.at(sums, text[lanes], probabilities.sum(axis=0, dtype=np.float64).T)
    return sums / np.maximum(lengths, 1)[:, None]


def training_sample(labelled: DataFrame, docs_per_language: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded sample of labelled texts (``text``, ``lang``, ``doc_id``): stretches, their language numbers, the languages.

    Rows are drawn by hash, with a rate for each language from its count, so
    that about ``docs_per_language`` documents of each give at most
    ``SAMPLE_STRETCHES`` stretches of ``SAMPLE_BYTES`` bytes. The number of
    languages bounds what reaches the driver.
    """
    counts = {row["lang"]: row["n"] for row in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return np.zeros((0, SAMPLE_BYTES), np.uint8), np.zeros(0, np.int64), []
    rates = F.lit(0.0)
    for language, n in counts.items():
        rates = F.when(F.col("lang") == language, F.lit(min(1.0, docs_per_language / n))).otherwise(rates)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30) < rates

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        body, offsets = text_bytes(batch.column(0))
        picked, whose = [], []
        for row, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            places = np.linspace(begin, max(begin, end - SAMPLE_BYTES), min(SAMPLE_STRETCHES, -(-(end - begin) // SAMPLE_BYTES)))
            for place in places.astype(int):
                picked.append(body[place : min(place + SAMPLE_BYTES, end)].tobytes().ljust(SAMPLE_BYTES, b"\0"))
                whose.append(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1).take(pa.array(whose, pa.int64())), pa.array(picked, pa.binary())], names=["lang", "bytes"]
        )

    rows = map_batches(labelled.filter(drawn), ["text", "lang"], cut, "lang string, bytes binary").collect()
    rows = sorted((row["lang"], bytes(row["bytes"])) for row in rows)
    stretches = np.frombuffer(b"".join(row[1] for row in rows), np.uint8).reshape(-1, SAMPLE_BYTES)
    numbers = {language: i for i, language in enumerate(languages)}
    return stretches, np.array([numbers[row[0]] for row in rows], np.int64), languages


def fit(docs: DataFrame, learn_from: Column, docs_per_language: int = SAMPLE_DOCS) -> Network:
    """A network from the rows where ``learn_from`` holds and ``lang`` is not null."""
    labelled = docs.select("doc_id", "text", "lang").filter(learn_from & F.col("lang").isNotNull() & (F.length("text") > 0))
    stretches, labels, languages = training_sample(labelled, docs_per_language)
    return train(stretches, labels, languages) if len(labels) else Network(languages, {})


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(
    docs: DataFrame, network: Network, carried: list[str | Column] | None = None, schema: str | StructType = "doc_id long"
) -> DataFrame:
    """``carried`` columns (of ``schema``) of each document with ``lang_pred`` and ``score``, the pooled probability of that language.

    Every byte of a text is labelled, of very long texts as well, and the labels' probabilities are
    averaged. ``und`` with score 0 if the text is null or has no letter, or if
    there was nothing to learn from. Of languages with equal probability the
    first in the alphabet is taken. An empty table gives no rows; equal texts
    get equal results wherever they stand.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        body, offsets = text_bytes(batch.column(0))
        view = body.tobytes()
        letters = [
            has_letter(view[a:b].decode())
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        ]
        known = np.array(letters, dtype=bool) & bool(network.languages)
        names, scores = [UNKNOWN] * len(known), np.zeros(len(known))
        if known.any():
            probabilities = pooled(network, body, offsets)
            best = np.round(probabilities, 4).argmax(axis=1)
            names = [network.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist(), strict=True)]
            # The last digits depend on which texts are computed together.
            scores = np.where(known, np.clip(np.round(probabilities.max(axis=1), 4), 0, 1), 0.0)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(names, pa.string()), pa.array(scores)],
            names=[*batch.schema.names[1:], "lang_pred", "score"],
        )

    carried = ["doc_id"] if carried is None else carried
    fields = StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
    told = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return map_batches(docs, ["text", *carried], run, StructType([*fields, *told]))


def confident(score: Column, languages: int, share: float) -> Column:
    """Scores that are at least ``share`` of the way from chance (all languages alike) to certainty."""
    return score >= (1 + share * (languages - 1)) / max(1, languages)


def with_predicted_language(docs: DataFrame, network: Network, share: float) -> DataFrame:
    """The documents whose language is told, with all their columns; ``lang`` is the predicted one.

    Documents without a letter go, and those whose best language is hardly
    likelier than chance (:func:`confident`). Columns of any name, ``lang_pred``
    and ``score`` too, come back as they are. An empty table gives no rows.
    """
    whole = whole_row(docs)
    told = identify(docs, network, [whole], docs.select(whole).schema)
    sure = (F.col("lang_pred") != UNKNOWN) & confident(F.col("score"), len(network.languages), share)
    language = F.col("lang_pred").alias("lang")
    return told.filter(sure).select(
        *[language if name == "lang" else F.col("document").getField(name).alias(name) for name in docs.columns]
    )
