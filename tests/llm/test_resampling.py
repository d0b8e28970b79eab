"""Importance resampling against zlib, dictionaries and a plain sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import document, table, words
from plumbline.llm.queries import op13_resampling
from plumbline.llm.resampling import bucket_counts, crc_of, ranked, resampled

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    parts = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(parts[i : i + n]) for n in (1, 2, 3) for i in range(len(parts) - n + 1)]
    return len(parts), Counter(zlib.crc32(run.encode()) % 10_000 for run in runs)


def brute_force(docs, target):
    own = [(doc_id, *features(text)) for doc_id, text in docs]
    source, wanted = Counter(), Counter()
    for _, _, counts in own:
        source.update(counts)
    for text in target:
        wanted.update(features(text)[1])
    s_all, t_all = source.total() + 10_000, wanted.total() + 10_000
    rows = []
    for doc_id, n_words, counts in own:
        weight = sum(
            n * math.floor(1000 * math.log(float(wanted[b] + 1) * s_all / (float(source[b] + 1) * t_all))) for b, n in counts.items()
        )
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, counts.total(), weight, score, n_words, None])
    fit = sorted((row for row in rows if row[4] >= 20), key=lambda row: (-row[3], row[0] is None, row[0] or 0))
    for rank, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[5] = rank
    return sorted([(*row[:4], row[5]) for row in rows], key=str)


def found(df):
    return sorted([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()], key=str)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_the_query(spark, sf_dir):
    docs = pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    expected = brute_force(docs, target)
    assert found(op13_resampling(spark, sf_dir)) == expected
    assert max(row[4] or 0 for row in expected) >= 5


@pytest.fixture()
def target(spark, files):
    return files(spark.createDataFrame([(i, " ".join(words(i, 60, 400))) for i in range(20)] + [(99, None)], "item_id long, text string"), "target")


def test_skew_and_long_texts(spark, files, target):
    """A third of all rows are copies of one text; features of very many bytes; no words; other scripts."""
    rows = [document(i, " ".join(words(1, 200, 300))) for i in range(200)]
    rows += [document(200 + i, (", " if i % 2 else "\t").join(words(i, 5 + i, 500)).upper()) for i in range(400)]
    rows += [document(700 + i, "é" * (300 + i) + " B2b-" + "x" * 9000) for i in range(8)]
    rows += [document(800, "漢字 " * 40_000), document(801, "... --- ..."), document(802, "a\x7fb`c{d")]
    docs = files(table(spark, rows, 6))
    assert found(resampled(docs, target)) == brute_force(pairs(docs), [r["text"] for r in target.collect()])


def test_odd_rows(spark, files, odd, crowded, none, target):
    texts = [r["text"] for r in target.collect()]
    expected = brute_force(pairs(odd), texts)
    assert found(resampled(odd, target)) == expected
    more = crowded.withColumns({name: F.lit(1) for name in ("tie", "rank", "weight", "range", "odd name", "a.b")})
    assert found(resampled(more, target)) == expected
    assert resampled(none, target).count() == 0
    assert found(resampled(odd, target.limit(0))) == brute_force(pairs(odd), [])
    # Repeated rows tie: as many as the draw has room for are ranked.
    docs = files(table(spark, [document(1, " ".join(words(3, 30)))] * 60), "same")
    assert sorted(r["rank"] for r in resampled(docs, target).collect() if r["rank"]) == [1, 2, 3]


def test_ranks_over_many_ranges(spark):
    scored = spark.range(5000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 7).alias("score"), (F.col("id") % 10 != 0).alias("eligible"), F.col("id").alias("tie")
    )
    rows = ranked(scored, 30).collect()
    order = sorted((r["doc_id"] for r in rows if r["eligible"]), key=lambda i: (-(i % 7), i))
    assert {r["doc_id"]: r["rank"] for r in rows if r["rank"]} == {i: n for n, i in enumerate(order[: 4500 * 30 // 100], 1)}
    assert len(rows) == 5000


def test_crc_of_stretches():
    draw = np.random.default_rng(3)
    body = draw.integers(0, 256, 50_000, dtype=np.uint8)
    begins = draw.integers(0, 40_000, 3000)
    ends = begins + np.where(np.arange(3000) % 100, draw.integers(0, 40, 3000), draw.integers(200, 900, 3000))
    expected = [zlib.crc32(body[a:b]) for a, b in zip(begins, ends, strict=True)]
    assert crc_of(body, begins, ends).tolist() == expected
    assert crc_of(body, begins[:0], ends[:0]).tolist() == []
    # Whichever way a stretch is taken.
    assert crc_of(body, begins, ends, long=10).tolist() == expected == crc_of(body, begins, ends, long=2000).tolist()


def test_counts_add_up(spark):
    texts = spark.createDataFrame([("a b c a b",), (None,), ("",), ("A",)], "text string")
    counts = {r["bucket"]: r["n"] for r in bucket_counts(texts).collect()}
    expected = Counter()
    for text in ("a b c a b", "A"):
        expected.update(features(text)[1])
    assert counts == expected
