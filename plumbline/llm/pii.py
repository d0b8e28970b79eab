"""Personal data: base patterns, and terms that reveal a protected value (operator 6)."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import map_batches, map_in_arrow, passes, screen_of, slices, stored, text_row_key

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# Words on either side of a protected value that are its context; two letters of a script with spaces
# are not counted among them, though they can be a term.
REACH = 5
# A term discloses a value if the value is at least this likely where the term stands, ...
DISCLOSURE = 0.5
# ... this many bits likelier than anywhere, and in this many different contexts: most values stand in few,
# and one word beside the same value twice is no chance at these shares. A single context shows nothing:
# every word that stands once in the corpus would tell of the value it stands beside.
BITS = 6.0
SUPPORT = 2
# A term that goes with a value, or with the broader entity it belongs to, anywhere in a document is told too if chance
# makes any such pair of the corpus with a probability of one in two to this power at most. Shares are smoothed by one
# text of the entity's own share, so that a rare value needs more than one text.
CHANCE_BITS = 7.0
# Far from a value only words of this many letters are terms (two in scripts without spaces): shorter ones are mostly
# particles, which a name beside the value can do without.
FAR_LETTERS = 4
SMOOTHING = 1.0
# Terms this certain are removed; others are generalised to what they tell of.
REMOVE_FROM = 0.9
# The broader entity of a value, and the words that stand for a term that tells of either.
BROADER = {"email": "domain", "ip": "network", "card": "issuer", "phone": "exchange"}
GENERAL = {
    "email": "[PERSON]", "phone": "[PERSON]", "card": "[ACCOUNT HOLDER]", "ip": "[MACHINE]",
    "domain": "[ORGANISATION]", "network": "[NETWORK]", "issuer": "[BANK]", "exchange": "[PLACE]",
}
# Texts that may stand more than once are found by a screen of 2**SCREEN_BITS bits (4 MB) whatever the corpus.
SCREEN_BITS = 25

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{2,}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches, found from each ``@``: linear whatever the text."""
    begin, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > begin and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        begin = found.end() if found else at + 1
        at = text.find("@", begin)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Of numbers joined by points, each four in a row; the four must be at most 255."""
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        numbers = list(_NUMBER.finditer(text, chain.start(), chain.end()))
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            if all(len(n.group().lstrip("0")) <= 3 and int(n.group().lstrip("0") or 0) <= 255 for n in four):
                yield four[0].start(), four[3].end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the protected values, by start, then kind as listed; code points, end exclusive."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        found += [(a, b, "ip") for a, b in addresses(text)]
        for match in _CARD.finditer(text):
            digits = _digits(match.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((*match.span(), "card"))
        for match in _PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(_digits(match.group())) <= 15:
                found.append((*match.span(), "phone"))
    return sorted(found, key=lambda span: (span[0], KINDS.index(span[2])))


def covered(spans: list[tuple[int, int, str]]) -> Callable[[int, int], bool]:
    """Whether a stretch of the text shares a place with one of the spans (in order of their starts)."""
    begins, ends = [], []
    for start, end, _ in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(start)
            ends.append(end)

    def taken(start: int, end: int) -> bool:
        i = bisect_left(begins, end) - 1
        return i >= 0 and ends[i] > start

    return taken


def _counts(word: str, letters: int = 3) -> bool:
    """Scripts from Thai on (CJK among them) are mostly written without spaces: two characters can be a name."""
    return len(word) >= letters or word[0] >= "\u0e00"


def broader(kind: str, value: str) -> str:
    """The entity a value belongs to: an address's domain, the first three numbers, the issuer's digits, all but the last four digits."""
    if kind == "email":
        part = value.rsplit("@", 1)[1].lower()
    elif kind == "ip":
        part = value.rsplit(".", 1)[0]
    else:
        part = _digits(value)[:6] if kind == "card" else _digits(value)[:-4]
    return f"{BROADER[kind]}:{part}"


def surroundings(
    text: str, spans: list[tuple[int, int, str]], reach: int = REACH
) -> Iterator[tuple[str, str, str, list[re.Match]]]:
    """(value, broader entity, context, the words near it) of each protected value, parts of values left out."""
    taken = covered(spans)
    for start, end, kind in spans:
        # Words are looked for near the value only: a window of characters that doubles until it holds enough.
        before, after = [], []
        width = 64
        while True:
            low = max(0, start - width)
            before = [m for m in _WORD.finditer(text, low, start) if m.start() > low or low == 0]
            counted = [i for i, m in enumerate(before) if _counts(m.group())]
            if len(counted) >= reach or low == 0:
                break
            width *= 2
        left = reach
        for match in _WORD.finditer(text, end):
            after.append(match)
            left -= _counts(match.group())
            if left == 0:
                break
        near = before[counted[-reach] if len(counted) >= reach else 0 :] + after
        near = [m for m in near if not taken(m.start(), m.end())]
        around = [m.group().lower() for m in near if _counts(m.group())] or [m.group().lower() for m in near]
        around = hashlib.md5(" ".join(around).encode()).hexdigest()
        yield f"{kind}:{text[start:end].lower()}", broader(kind, text[start:end]), around, near


def contexts(text: str, spans: list[tuple[int, int, str]], reach: int = REACH) -> Iterator[tuple[str, str, str, int, int]]:
    """(value, context, term, start, end) of the words around each protected value."""
    for value, _, around, near in surroundings(text, spans, reach):
        for m in near:
            yield value, around, m.group().lower(), m.start(), m.end()


def joined_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SPANS = "array<struct<start: bigint, end: bigint, kind: string>>"
ENTITIES = "array<struct<value: string, broad: string, context: string>>"
EVIDENCE = f"_id string, _body long, base {SPANS}, entities {ENTITIES}, near array<struct<value: string, context: string, term: string>>, words array<string>"


def evidence(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Of each document with protected values: its key (``_id``, ``_body``), the ``base`` spans, the ``entities`` (value,
    broader entity, context), the words ``near`` each value, and its different longer ``words`` outside of values.

    The only pass that looks for values in all texts.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text, doc_id, body in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            spans = base_spans(text or "")
            if not spans:
                continue
            found = list(surroundings(text, spans, reach))
            entities = {(value, broad, around) for value, broad, around, _ in found}
            near = [{"value": v, "context": c, "term": m.group().lower()} for v, _, c, words in found for m in words]
            taken = covered(spans)
            words = {m.group().lower() for m in _WORD.finditer(text) if _counts(m.group(), FAR_LETTERS) and not taken(*m.span())}
            rows.append(
                (
                    doc_id,
                    body,
                    [{"start": a, "end": b, "kind": k} for a, b, k in spans],
                    [{"value": v, "broad": b, "context": c} for v, b, c in sorted(entities)],
                    near,
                    sorted(words),
                )
            )
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        text_fields = [pa.list_(pa.struct([(name, pa.string()) for name in names])) for names in (("value", "broad", "context"), ("value", "context", "term"))]
        base = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        kinds = [pa.string(), pa.int64(), base, *text_fields, pa.list_(pa.string())]
        names = ["_id", "_body", "base", "entities", "near", "words"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    found = map_batches(docs, ["text", *text_row_key()], run, EVIDENCE)
    # Repeated rows are one.
    first = F.first(F.struct("base", "entities", "near", "words")).alias("found")
    return found.groupBy("_id", "_body").agg(first).select("_id", "_body", "found.*")


def occurrences(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Words near protected values: ``_id``, ``_body``, ``value``, ``context``, ``term``."""
    return evidence(docs, reach).select("_id", "_body", F.inline("near"))


def document_frequency(docs: DataFrame) -> tuple[DataFrame, int]:
    """``term``, ``df``: the different texts of the whole corpus that hold each term; and how many texts there are.

    Terms are combined in each task first. Only texts that stand more than once
    (and a few that a screen takes for such) move, one copy from each task.
    """
    copies = docs.select(text_row_key()[1]).groupBy("_body").agg(F.count("*").alias("n"))
    total = copies.count()
    screen = docs.sparkSession.sparkContext.broadcast(screen_of(copies.filter("n > 1"), "_body", SCREEN_BITS))

    def copied(batch: pa.RecordBatch) -> pa.Array:
        return pa.array(passes(screen.value, batch.column(1).to_numpy(), SCREEN_BITS))

    def run(batches: Iterator[pa.RecordBatch], once: bool) -> Iterator[pa.RecordBatch]:
        def rows(counter: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counter), pa.string()), pa.array(list(counter.values()), pa.int64())], names=["term", "n"]
            )

        counter: Counter = Counter()
        for batch in batches:
            for piece in slices(batch):
                texts = piece.filter(pc.invert(copied(piece))) if once else piece
                for text in texts.column(0).to_pylist():
                    if text:
                        counter.update(set(_WORD.findall(text.lower())))
                if len(counter) > 400_000:
                    yield rows(counter)
                    counter = Counter()
        yield rows(counter)

    def suspects(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(copied(batch))

    one_each = map_batches(docs, ["text", text_row_key()[1]], suspects, "text string, _body long").groupBy("_body").agg(F.first("text").alias("text"))
    once = map_in_arrow(docs.select("text", text_row_key()[1]), lambda batches: run(batches, True), "term string, n long")
    rest = map_in_arrow(one_each.select("text"), lambda batches: run(batches, False), "term string, n long")
    return once.unionByName(rest).groupBy("term").agg(F.sum("n").alias("df")), total


def disclosing_terms(
    docs: DataFrame,
    near: DataFrame,
    disclosure: float = DISCLOSURE,
    bits: float = BITS,
    support: int = SUPPORT,
    frequency: tuple[DataFrame, int] | None = None,
) -> DataFrame:
    """``value``, ``term``, ``p``, ``pmi``: terms that reveal a protected value.

    Shares are of different texts, so copies of a text count as one wherever they
    are counted: ``p`` is the share of the texts with the term in which the value
    stands near it, ``pmi`` how many bits that is above the value's share of all
    texts. Support is the number of different contexts, so copies of a passage
    in different texts do not add up.
    """
    pairs = near.groupBy("value", "term").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("_body").alias("n"))
    values = near.groupBy("value").agg(F.count_distinct("_body").alias("of_value"))
    frequency, total = document_frequency(docs) if frequency is None else frequency
    found = pairs.filter(F.col("contexts") >= support).join(values, "value").join(frequency, "term")
    p = F.least(F.col("n") / F.col("df"), F.lit(1.0))
    found = found.withColumn("p", p).withColumn("pmi", F.log2(p * total / F.col("of_value")))
    return found.filter((F.col("p") >= disclosure) & (F.col("pmi") >= bits)).select("value", "term", "p", "pmi")


def disclosing_words(
    found: DataFrame, frequency: DataFrame, total: int, disclosure: float = DISCLOSURE, support: int = SUPPORT, chance_bits: float = CHANCE_BITS
) -> DataFrame:
    """``entity``, ``term``, ``p``: words anywhere in a document that reveal a value of it, or the broader entity of one.

    ``found`` is what :func:`evidence` gives. Texts are counted once, however
    often they are copied. ``p`` is the share of the texts with the term that
    hold the entity, smoothed towards the entity's share of all texts. A pair
    counts only if chance is no explanation: the probability that so many of
    the term's texts hold the entity by chance (a bound of the binomial tail by
    relative entropy), times the number of pairs looked at. Texts with the
    same context of the entity weigh as one in that bound, so copies of a
    passage, and texts edited elsewhere, add nothing.
    """
    texts = stored(found.groupBy("_body").agg(F.first("entities").alias("entities"), F.first("words").alias("words")), "told-texts")
    entity = F.explode(F.array("entity.value", "entity.broad")).alias("entity")
    held = texts.select("_body", F.explode("entities").alias("entity")).select("_body", "entity.context", entity).distinct()
    held = stored(held, "entities")
    frequent = held.groupBy("entity").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("_body").alias("m"))
    # An entity that is nearly everywhere is told by nothing.
    held = held.join(frequent.filter((F.col("contexts") >= support) & (F.col("m") < total)).drop("contexts"), "entity")
    most = held.groupBy("_body").agg(F.max("m").alias("most"))
    # A term of which half the texts hold an entity of m texts is in twice as many at most; one text shows nothing.
    bound = F.ceil(F.col("m") / disclosure)
    words = texts.join(most, "_body").select("_body", "most", F.explode("words").alias("term"))
    words = words.join(frequency.filter("df > 1"), "term").filter(F.col("df") <= F.ceil(F.col("most") / disclosure)).drop("most")
    pairs = words.join(held, "_body").filter(F.col("df") <= bound).groupBy("entity", "term").agg(
        F.count_distinct("_body").alias("n"), F.count_distinct("context").alias("contexts"), F.first("df").alias("df"), F.first("m").alias("m")
    )
    pairs = stored(pairs, "told-pairs")
    looked_at = pairs.count()
    base = F.col("m") / float(max(1, total))
    share = F.least(F.col("n") / F.col("df"), F.lit(1.0))
    away = F.when(share >= 1, F.lit(0.0)).otherwise((1 - share) * F.log2((1 - share) / (1 - base)))
    surprise = F.col("df") * F.least(F.col("contexts") / F.col("n"), F.lit(1.0)) * (share * F.log2(share / base) + away)
    p = (F.col("n") + SMOOTHING * base) / (F.col("df") + SMOOTHING)
    sure = surprise >= F.log2(F.lit(float(max(1, looked_at)))) + chance_bits
    return pairs.withColumn("p", p).filter((F.col("contexts") >= support) & (share > base) & (F.col("p") >= disclosure) & sure).select("entity", "term", "p")


TERMS = "array<struct<start: bigint, end: bigint, p: double, about: string>>"


def told_spans(docs: DataFrame, told: DataFrame) -> DataFrame:
    """``_id``, ``_body``, ``terms``: all places of its terms in each document of ``told`` (``_id``, ``_body``, ``told``: term, ``p``, ``about``).

    Only these documents' texts move (and a few that a screen takes for them), equal rows as one.
    """
    screen = docs.sparkSession.sparkContext.broadcast(screen_of(told, "_body", SCREEN_BITS))

    def held(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(passes(screen.value, batch.column(2).to_numpy(), SCREEN_BITS)))

    texts = map_batches(docs, ["text", *text_row_key()], held, "text string, _id string, _body long")
    texts = texts.groupBy("_id", "_body").agg(F.first("text").alias("text")).join(told, ["_id", "_body"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for text, told_here in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
            share = {t["term"]: t for t in told_here}
            taken = covered(base_spans(text))
            words = ((m, share.get(m.group().lower())) for m in _WORD.finditer(text))
            rows.append(
                [
                    {"start": m.start(), "end": m.end(), "p": told["p"], "about": told["about"]}
                    for m, told in words
                    if told is not None and not taken(*m.span())
                ]
            )
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64()), ("about", pa.string())]))
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(rows, kind)], names=["_id", "_body", "terms"])

    schema = f"_id string, _body long, terms {TERMS}"
    return map_batches(texts, ["text", "_id", "_body", "told"], run, schema)


def personal_spans(docs: DataFrame, carried: list[str | Column] | None = None) -> DataFrame:
    """``carried`` columns of each document, its ``base`` spans, and the ``terms`` spans (with ``p``, and what they tell of).

    Base spans follow the patterns for email, ip, card and phone, leftmost and
    non-overlapping for each kind. A word that corpus co-occurrence says to
    reveal a value, near it (:func:`disclosing_terms`) or anywhere in the
    document (:func:`disclosing_words`, also for the value's domain, network,
    issuer or exchange), is a term span wherever it stands in a document that
    holds the value. Null is an empty text, very long texts are read whole;
    rows that share a ``doc_id`` are told apart by their text; equal rows get
    equal spans; an empty table gives no rows.
    """
    found = stored(evidence(docs), "evidence")
    frequency, total = document_frequency(docs)
    frequency = stored(frequency, "term-frequency")
    near = found.select("_id", "_body", F.inline("near"))
    told = disclosing_terms(docs, near, frequency=(frequency, total)).select(F.col("value").alias("entity"), "term", "p")
    told = told.unionByName(disclosing_words(found, frequency, total))
    told = stored(told.groupBy("entity", "term").agg(F.max("p").alias("p")), "disclosing-terms")
    entity = F.explode(F.array_union(F.transform("entities", lambda e: e["value"]), F.transform("entities", lambda e: e["broad"])))
    told = found.select("_id", "_body", entity.alias("entity")).join(told, "entity")
    # What a term tells of most surely, a value before a broader entity.
    about = F.max_by(F.substring_index("entity", ":", 1), F.struct("p", F.substring_index("entity", ":", 1).isin(*KINDS), "entity")).alias("about")
    told = told.groupBy("_id", "_body", "term").agg(F.max("p").alias("p"), about)
    told = stored(told.groupBy("_id", "_body").agg(F.collect_list(F.struct("term", "p", "about")).alias("told")), "told-terms")
    spans = found.select("_id", "_body", "base").join(told_spans(docs, told), ["_id", "_body"], "left")
    carried = ["doc_id"] if carried is None else carried
    keyed = docs.select(*carried, *text_row_key()).join(spans, ["_id", "_body"], "left")
    none = F.array().cast(SPANS)
    return keyed.withColumn("base", F.coalesce("base", none)).drop("_id", "_body")


def sanitised(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with base values generalised to ``[KIND]``; revealing terms are removed or, if they are less
    certain, generalised to what they tell of (``[PERSON]``, ``[ORGANISATION]``)."""
    spans = personal_spans(docs, ["doc_id", "text"])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = []
        for text, base, terms in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            marks = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base or ()]
            marks += [(s["start"], s["end"], "" if s["p"] >= REMOVE_FROM else GENERAL[s["about"]]) for s in terms or ()]
            out, at = [], 0
            for start, end, sign in sorted(marks):
                if end > at:
                    out += [text[at:start] if start > at else "", sign]
                    at = end
            texts.append("".join([*out, (text or "")[at:]]) if text is not None else None)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(spans, ["text", "doc_id", "base", "terms"], run, "doc_id long, text string")


def digest(spans: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each base kind, ``base_sha256`` and all ``spans`` as text."""
    written = F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    def ordered(base: Column, terms: Column) -> Column:
        ranks = F.array(*[F.lit(kind) for kind in (*KINDS, TERM)])
        entries = F.concat(
            F.transform(base, lambda s: F.struct(s["start"], F.array_position(ranks, s["kind"]), s["end"], s["kind"].alias("kind"))),
            F.transform(
                F.coalesce(terms, F.array().cast(TERMS)),
                lambda s: F.struct(s["start"], F.lit(len(KINDS) + 1).cast("bigint"), s["end"], F.lit(TERM).alias("kind")),
            ),
        )
        return F.transform(F.array_sort(entries), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(F.concat_ws(",", written), 256).alias("base_sha256"),
        F.concat_ws(",", ordered(F.col("base"), F.col("terms"))).alias("spans"),
    )
