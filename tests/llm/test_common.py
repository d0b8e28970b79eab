"""What the operators share: joins of hot keys, rows kept by their content."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import document, table
from plumbline.llm import common
from plumbline.llm.common import joined_to_groups, keep_rows, row_key


@pytest.fixture()
def skewed(spark, files):
    """One key in a third of all rows, a null one in many, others in few."""
    draw = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{draw.randrange(3000)}", None) for i in range(12_000)]
    return files(spark.createDataFrame(rows, "row long, key string, other string").repartition(6), "rows")


def test_hot_keys_are_cut(spark, files, skewed):
    groups = files(skewed.groupBy("key", "other").agg(F.count("*").alias("n"), F.min("row").alias("first")), "groups")
    joined = joined_to_groups(skewed, groups, ["key", "other"], "n", F.col("row"))
    assert joined.columns == ["row", "key", "other", "n", "first"]
    same = skewed["key"].eqNullSafe(groups["key"])
    expected = skewed.join(groups, same).select(skewed["*"], "n", "first")
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    # No task of the join has more than twice the rows of the median one.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joined_to_groups(skewed, groups, ["key", "other"], "n", F.col("row"))
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_without_hot_keys_nothing_is_cut(spark, files, skewed, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10**6)
    groups = files(skewed.groupBy("key").agg(F.count("*").alias("n")), "groups")
    joined = joined_to_groups(skewed, groups, ["key"], "n", F.col("row"))
    assert "pmod(" not in joined._jdf.queryExecution().toString()
    assert joined.count() == skewed.count()
    assert joined_to_groups(skewed.limit(0), groups.limit(0), ["key"], "n", F.col("row")).count() == 0


def test_rows_are_kept_by_content(odd, files):
    decided = odd.select(*row_key(), F.expr("doc_id > 4 OR doc_id IS NULL").alias("kept"))
    left = keep_rows(odd, files(decided, "decided"))
    assert left.columns == odd.columns
    expected = [r for r in odd.collect() if r["doc_id"] is None or r["doc_id"] > 4]
    assert sorted(left.collect(), key=str) == sorted(expected, key=str)


def test_one_of_repeated_rows_is_kept(spark, files):
    docs = files(table(spark, [document(1, "a")] * 50 + [document(2, "b")] * 3 + [document(3, None)], 5))
    rows = [*[(1, "a", i == 0) for i in range(50)], *[(2, "b", True)] * 3, (3, None, False)]
    decided = spark.createDataFrame(rows, "doc_id long, text string, kept boolean").select(*row_key(), "kept")
    assert sorted(r["doc_id"] for r in keep_rows(docs, files(decided, "decided")).collect()) == [1, 2, 2, 2]
