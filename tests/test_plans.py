"""The shape of the plans: what reaches the scan, what is shuffled, what must not occur."""

import re

import pytest
from pyspark.sql import functions as F

from plumbline.operators import duplicate_groups, duplicate_rows, flatten, normalize, null_profile, profile, valid_records
from plumbline.plans.catalog import QUERIES, review_collection
from plumbline.sources import since


def plan(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


def tree(frame):
    return plan(frame).split("\n\n\n")[0]


def read_schemas(text):
    return re.findall(r"ReadSchema: struct<(.*)>", text)


@pytest.fixture(scope="module")
def source(spark, sf_dir):
    return review_collection(spark, sf_dir).read(spark)


@pytest.fixture(scope="module")
def records(source):
    return flatten(source, "app-x")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"ingest_two_days"}))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_flatten_prunes_columns(records):
    assert "ip_address" not in plan(records)


def test_valid_filter_reaches_the_scan(records):
    text = plan(normalize(valid_records(records)))
    for column in ("customer_id", "rating", "comment", "app_version", "cpf", "os", "os_version", "timestamp"):
        assert f"IsNotNull({column})" in text
    assert "Exchange" not in text


def test_incremental_filter_reaches_the_scan(source):
    assert "GreaterThanOrEqual(timestamp,2024-01-30T00:00:00)" in plan(since(source, "2024-01-30T00:00:00"))


def test_groups_read_the_key_only_and_combine_first(records):
    text = plan(duplicate_groups(records))
    assert read_schemas(text) == ["customer_id:string,rating:string,app_version:string"]
    assert tree(duplicate_groups(records)).count("Exchange") == 1
    assert tree(duplicate_groups(records)).count("HashAggregate") == 2


def test_null_profile_is_one_pass(records):
    text = tree(null_profile(records))
    assert text.count("Scan parquet") == 1


def test_profile_shuffles_no_text(records):
    text = plan(profile(records))
    assert len(read_schemas(text)) == 2
    assert not re.search(r"hashpartitioning\([^)]*comment", text)


def test_duplicate_rows_push_the_key_filter_and_share_the_groups(spark, records):
    found = duplicate_rows(records)
    assert found.count() > 0
    text = plan(found)
    assert "IsNotNull(customer_id)" in text and "IsNotNull(app_version)" in text and "IsNotNull(rating)" in text

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        merged = duplicate_rows(records)
        merged.collect()
        final = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in final
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+, app_version#\d+, rating#\d+, \d+\)", final)) <= 2
    assert "ReusedExchange" in final


@pytest.mark.parametrize("name", ["duplicate_rows_merged", "invalid_records_merged"])
def test_merged_queries_shuffle_on_the_salt(spark, sf_dir, name):
    frame = QUERIES[name](spark, sf_dir)
    assert frame.count() > 0
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in final
    assert re.search(r"Exchange hashpartitioning\([^)]*_salt#", final)


def test_landed_days_are_pruned(spark, sf_dir):
    QUERIES["landed_read"](spark, sf_dir)
    landed = QUERIES["landed_read"](spark, sf_dir).filter(F.col("odate") == "20240129")
    assert "PartitionFilters" in plan(landed)
    assert {name.split("odate=")[1].split("/")[0] for name in landed.inputFiles()} >= {"20240129"}
    mark = QUERIES["high_water_mark"](spark, sf_dir)
    assert read_schemas(plan(mark)) == [""]


def test_stages_stay_in_generated_code(records):
    frame = normalize(valid_records(records))
    assert re.search(r"\* Project", tree(frame)) and re.search(r"\* Filter", tree(frame))
