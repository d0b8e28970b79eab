"""Duplicate rows under skew: same rows as brute force, and no task that holds a hot key alone."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plumbline.operators import duplicate_groups, duplicate_rows, flatten, invalid_records, null_records
from plumbline.operators import routing
from plumbline.plans.catalog import QUERIES, review_collection
from samples import documents, review


@pytest.fixture()
def merged(spark):
    """Both sides of every join are shuffled, partitions stay as they are."""
    given = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in given}
    for name, value in given.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def skewed_rows(n=3000):
    """A third of all rows share a key, a sixth has none, some keys repeat, some ids too."""
    generator = random.Random(3)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind in (0, 1):
            key = {"customer_id": "hot", "app_version": "1", "rating": "5"}
        elif kind == 2:
            key = {"customer_id": None}
        else:
            key = {"customer_id": str(generator.randint(0, n)), "rating": generator.choice(["1", "2", None])}
        rows.append(review(f"r{generator.randint(0, n)}", **key))
    return rows


def brute_force(frame):
    rows = [tuple(row) for row in frame.collect()]
    at = [frame.columns.index(name) for name in ("customer_id", "app_version", "rating")]
    keys = Counter(tuple(row[i] for i in at) for row in rows)
    return Counter(row for row in rows if None not in (key := tuple(row[i] for i in at)) and keys[key] > 1)


@pytest.mark.parametrize("hot_rows", [1, 2, 10, 10_000])
@pytest.mark.parametrize("salt_bits", [1, 22])
def test_same_rows_for_every_threshold(spark, merged, monkeypatch, hot_rows, salt_bits):
    monkeypatch.setattr(routing, "SALT_BITS", salt_bits)
    frame = flatten(documents(spark, skewed_rows()), "app-x").repartition(8, "id")
    expected = brute_force(frame)
    assert Counter(map(tuple, duplicate_rows(frame, hot_rows=hot_rows).collect())) == expected
    assert sum(expected.values()) > 1000

    nulls = Counter(map(tuple, null_records(frame).collect()))
    both = Counter({(*row, "duplicate"): n for row, n in expected.items()}) + Counter(
        {(*row, "null"): n for row, n in nulls.items()}
    )
    assert Counter(map(tuple, invalid_records(frame, hot_rows=hot_rows).collect())) == both


def test_stored_groups_give_the_same_rows(spark, tmp_path):
    frame = flatten(documents(spark, skewed_rows()), "app-x")
    path = str(tmp_path / "groups")
    duplicate_groups(frame).write.parquet(path)
    stored = duplicate_rows(frame, spark.read.parquet(path), hot_rows=50)
    assert Counter(map(tuple, stored.collect())) == brute_force(frame)


def test_colliding_hashes_lose_no_row(spark, merged, monkeypatch):
    """All keys share one hash: every group is repeated, no row is lost or doubled."""
    monkeypatch.setattr(routing.F, "xxhash64", lambda *columns: F.lit(1).cast("bigint") + F.lit(0) * F.length(columns[-1]))
    frame = flatten(documents(spark, skewed_rows(600)), "app-x").repartition(4, "id")
    assert Counter(map(tuple, duplicate_rows(frame, hot_rows=20).collect())) == brute_force(frame)


def test_every_hot_key_is_salted(spark, merged):
    """However many there are; and the table of salts has one row for each place."""
    keys = 12_000
    rows = spark.range(3 * keys).selectExpr("CAST(id % 12000 AS string) AS customer_id", "'1' AS app_version", "'5' AS rating")
    groups = rows.groupBy("customer_id", "app_version", "rating").count()
    salts = routing._salts_per_slot(groups, 2)
    assert salts.count() == salts.select(routing._SLOT).distinct().count() <= keys
    records = flatten(documents(spark, [review("x")]), "app-x")
    _, salted = routing._salted(records, groups, 2, None)
    assert salted.groupBy("customer_id").agg(F.countDistinct(routing._SALT).alias("n")).filter("n < 2").count() == 0
    assert salted.select("customer_id").distinct().count() == keys


def test_unmatched_rows_stay_out_of_the_exchange(spark):
    """Few groups with long keys, too large to broadcast: only rows that may match are shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
    try:
        customer = F.concat(F.lit("c" * 60), F.col("id").cast("string"))
        keys = spark.range(400_000).select(customer.alias("customer_id"))
        groups = keys.withColumns({"app_version": F.lit("1"), "rating": F.lit("5"), "count": F.lit(2).cast("bigint")})
        shaped = flatten(documents(spark, [review("x")]), "app-x")
        single = spark.range(500_000, 550_000).select(customer.alias("customer_id"), F.col("id").cast("string").alias("id"))
        columns = [F.col(c) if c in ("customer_id", "id") else F.lit("5" if c == "rating" else "1").alias(c) for c in shaped.columns]
        records = single.select(*columns)
        match = spark.range(1).select(customer.alias("customer_id"), F.lit("match").alias("id")).select(*columns)
        passed = routing._screened(records.unionByName(match), groups)
        assert passed.count() <= 200
        found = duplicate_rows(records.unionByName(match), groups)
        assert [row["id"] for row in found.collect()] == ["match"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bits", [6, 8, 28])
def test_screen_loses_no_row(spark, merged, monkeypatch, bits):
    """A crowded screen lets other rows through, never the wrong way."""
    monkeypatch.setattr(routing, "SCREEN_BITS", bits)
    frame = flatten(documents(spark, skewed_rows()), "app-x").repartition(8, "id")
    expected = brute_force(frame)
    assert Counter(map(tuple, duplicate_rows(frame).collect())) == expected
    assert Counter(map(tuple, invalid_records(frame).collect())).total() == (
        expected.total() + null_records(frame).count()
    )


def test_screen_keeps_other_rows_out_of_the_shuffle(spark):
    rows = [review(f"r{i}", customer_id=str(i)) for i in range(2000)] + [review("x", customer_id="7")]
    frame = flatten(documents(spark, rows), "app-x")
    passed = routing._screened(frame, duplicate_groups(frame))
    assert {row["id"] for row in passed.collect()} == {"r7", "x"}


def _largest_share(frame):
    sizes = [row["count"] for row in frame.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_key_is_spread(spark, merged):
    frame = flatten(documents(spark, skewed_rows(6000)), "app-x").repartition(4, "id")
    assert _largest_share(duplicate_rows(frame, hot_rows=10**9)) > 0.4
    assert _largest_share(duplicate_rows(frame, hot_rows=20)) < 0.15
    assert _largest_share(invalid_records(frame, hot_rows=20)) < 0.15


def test_rows_without_a_key_are_spread(spark, merged):
    rows = [review(f"r{i}", customer_id=None if i % 3 else str(i)) for i in range(3000)]
    frame = flatten(documents(spark, rows), "app-x").repartition(4, "id")
    found = invalid_records(frame)
    assert found.count() == 2000
    assert _largest_share(found) < 0.15


def test_exact_copies_are_spread_over_tasks(spark, merged):
    rows = [review("same", customer_id="hot")] * 2000 + [review(f"r{i}") for i in range(1000)]
    frame = flatten(documents(spark, rows), "app-x").repartition(16)
    found = duplicate_rows(frame, hot_rows=100)
    assert found.count() == 2000
    assert _largest_share(found) < 0.5


@pytest.mark.parametrize("bits", [6, 10, 28])
@pytest.mark.parametrize("given", [False, True])
def test_in_place_gives_the_same_rows(spark, merged, monkeypatch, tmp_path, bits, given):
    """Also where every place of the screen, or many of them, are disputed."""
    monkeypatch.setattr(routing, "SCREEN_BITS", bits)
    rows = skewed_rows() + [review(f"n{i}", comment=None, customer_id=str(i % 40)) for i in range(60)]
    path = str(tmp_path / "source")
    documents(spark, rows).write.parquet(path)
    frame = flatten(spark.read.parquet(path), "app-x")
    groups = duplicate_groups(frame) if given else None
    assert Counter(map(tuple, duplicate_rows(frame, groups, 50, in_place=True).collect())) == brute_force(frame)
    found = Counter(map(tuple, invalid_records(frame, groups, 50, in_place=True).collect()))
    assert found == Counter(map(tuple, invalid_records(frame, groups, 50).collect()))
    assert found.total() == brute_force(frame).total() + null_records(frame).count()


def test_in_place_holds_with_colliding_hashes(spark, merged, monkeypatch):
    monkeypatch.setattr(routing.F, "xxhash64", lambda *columns: F.lit(1).cast("bigint") + F.lit(0) * F.length(columns[-1]))
    frame = flatten(documents(spark, skewed_rows(600)), "app-x").repartition(4, "id")
    assert Counter(map(tuple, duplicate_rows(frame, hot_rows=20, in_place=True).collect())) == brute_force(frame)


ROUTED = ["duplicate_rows", "duplicate_rows_skewed", "duplicate_rows_merged"]
ROUTED += ["invalid_records", "invalid_records_screened", "invalid_records_merged"]


@pytest.mark.parametrize("name", ROUTED)
def test_queries_leave_the_texts_in_place(spark, merged, sf_dir, name):
    """Most reviews are duplicates; as no place is disputed here, all come out in the partitions of the source."""
    frame = QUERIES[name](spark, sf_dir)
    given = review_collection(spark, sf_dir).read(spark).rdd.getNumPartitions()
    used = frame.select(F.spark_partition_id().alias("p")).distinct().count()
    assert frame.count() > 300
    assert used <= given < 32
