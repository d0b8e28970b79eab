"""Small tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENT = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def words(seed: int, n: int, vocabulary: int = 3000) -> list[str]:
    draw = random.Random(seed)
    syllables = ["ba", "do", "ki", "lu", "me", "no", "ra", "si", "te", "vu", "zé", "ñu"]
    return ["".join(syllables[int(c) % 12] for c in str(draw.randrange(vocabulary))) for _ in range(n)]


def document(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def table(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, DOCUMENT).repartition(parts)


def stored(df, path):
    """Row numbers follow the scan, so operators are tested on files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


ODD = [
    document(None, None),
    document(None, "no id"),
    document(1, None),
    document(2, ""),
    document(3, " \t\r\n"),
    document(4, "same  text"),
    document(4, "same  text"),
    document(5, "same\ttext"),
    document(6, "word " * 30_000),
    document(7, "é" * 50_000),
    document(8, "漢字かな" * 10),
    document(9, "<|endoftext|> it's   odd\n\n", None, None),
]
