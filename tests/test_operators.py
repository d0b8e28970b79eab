from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from plumbline.operators import (
    conform,
    duplicate_groups,
    duplicate_rows,
    flatten,
    invalid_records,
    normalize,
    null_profile,
    null_records,
    process,
    profile,
    quality_report,
    type_failures,
    valid_records,
)
from plumbline.schema import COLUMNS, PROFILED_COLUMNS, TARGET
from samples import documents, nine, review


def records(spark, rows):
    return flatten(documents(spark, rows), "app-x")


def test_flatten_projects_in_order(spark):
    frame = records(spark, [review("r1"), review(None)])
    assert frame.columns == COLUMNS
    assert {row["id"] for row in frame.collect()} == {"r1", None}
    assert {row["app"] for row in frame.collect()} == {"app-x"}


def test_process_folds_three_columns_only(spark):
    row = process(documents(spark, [review("é", comment="Não é", os="iOS ß", country="São", cpf="ç")]), "ação").first()
    assert (row["comment"], row["os"], row["country"]) == ("NAO E", "IOS SS", "SAO")
    assert (row["id"], row["cpf"], row["app"]) == ("é", "ç", "ação")


def test_normalize_keeps_nulls(spark):
    row = normalize(records(spark, [review("r1", comment=None)])).first()
    assert row["comment"] is None


def test_normalize_and_routing_commute(spark):
    rows = records(spark, nine() + [review("n1", os=None), review("n2", comment=None)])
    for route in (valid_records, null_records, duplicate_rows, invalid_records):
        after = Counter(map(tuple, normalize(route(rows)).collect()))
        before = Counter(map(tuple, route(normalize(rows)).collect()))
        assert after == before


def test_nine_reviews(spark):
    frame = records(spark, nine())
    counts = profile(frame).first()
    assert (counts["total_records"], counts["duplicate_groups"], counts["duplicate_rows"]) == (9, 1, 2)
    assert (counts["null_rows"], counts["type_failures"]) == (0, 0)
    assert valid_records(frame).count() == 9
    assert invalid_records(frame).count() == 2


def test_valid_records_have_the_target_layout(spark):
    frame = conform(valid_records(records(spark, nine())))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in TARGET]


def test_null_keys_group_but_never_match(spark):
    frame = records(spark, [review("a", customer_id=None), review("b", customer_id=None)])
    assert [row["count"] for row in duplicate_groups(frame).collect()] == [2]
    assert duplicate_rows(frame).count() == 0
    assert [row["reason"] for row in invalid_records(frame).collect()] == ["null", "null"]


def test_row_with_null_and_duplicate_appears_twice(spark):
    frame = records(spark, [review("a", customer_id="k"), review("b", customer_id="k", cpf=None)])
    found = Counter((row["id"], row["reason"]) for row in invalid_records(frame).collect())
    assert found == Counter({("a", "duplicate"): 1, ("b", "duplicate"): 1, ("b", "null"): 1})


def test_triple_is_one_group_of_three(spark):
    frame = records(spark, [review(i, customer_id="k") for i in "abc"])
    assert duplicate_groups(frame).count() == 1
    assert {row["id"] for row in duplicate_rows(frame).collect()} == {"a", "b", "c"}


def test_invalid_rows_keep_their_columns(spark):
    frame = records(spark, [review("a", customer_id="k"), review("b", customer_id="k")])
    row = invalid_records(frame).filter("id = 'a'").first()
    assert (row["id"], row["customer_id"], row["app_version"], row["rating"]) == ("a", "k", "2.1.0", "4")


@pytest.mark.parametrize("column", PROFILED_COLUMNS)
def test_each_required_column(spark, column):
    frame = records(spark, [review("a", **{column: None}), review("b")])
    assert [row["id"] for row in valid_records(frame).collect()] == ["b"]
    assert [row["id"] for row in null_records(frame).collect()] == ["a"]
    assert [tuple(row) for row in null_profile(frame).collect()] == [(column, 1)]


@pytest.mark.parametrize("column", ["votes_count", "country", "age"])
def test_other_columns_may_be_null(spark, column):
    frame = records(spark, [review("a", **{column: None})])
    assert valid_records(frame).count() == 1
    assert null_profile(frame).count() == 0


def test_missing_app_is_invalid_but_not_profiled(spark):
    frame = records(spark, [review("a")]).withColumn("app", F.lit(None).cast("string"))
    assert null_records(frame).count() == 1
    assert null_profile(frame).count() == 0
    report = {row["check"]: row["status"] for row in quality_report(profile(frame)).collect()}
    assert report["null_check"]


def test_type_check(spark):
    ratings = ["abc", None, "3", "3.7", " 4 "]
    frame = records(spark, [review(str(i), rating=rating) for i, rating in enumerate(ratings)])
    assert {row["id"] for row in type_failures(frame).collect()} == {"0", "1"}
    assert {row["id"] for row in valid_records(frame).collect()} == {"0", "2", "3", "4"}
    assert {row["rating"] for row in conform(frame).collect()} == {None, 3, 4}


def test_type_check_on_numbers(spark):
    frame = records(spark, [review("a", rating="4"), review("b", rating=None)])
    for kind in ("int", "bigint", "double"):
        assert type_failures(frame.withColumn("rating", F.col("rating").cast(kind))).count() == 1


def test_report_texts(spark):
    bad = records(spark, [review("a", customer_id="k", os=None), review("b", customer_id="k", cpf=None, os=None)])
    found = {row["check"]: row for row in quality_report(profile(bad)).collect()}
    assert found["duplicate_check"]["message"] == "Registros duplicados encontrados: 1 registros com base no 'id'."
    assert found["null_check"]["message"] == "Valores nulos encontrados nas colunas: {'cpf': 1, 'os': 2}."
    assert [found[c]["code"] for c in ("duplicate_check", "null_check", "type_consistency_check")] == [409, 400, 200]

    good = {row["check"]: row for row in quality_report(profile(records(spark, [review("a")]))).collect()}
    assert all(row["status"] and row["code"] == 200 for row in good.values())
    assert good["duplicate_check"]["message"] == "Nenhum registro duplicado encontrado."


def test_empty_frame(spark):
    frame = records(spark, [])
    counts = profile(frame).first().asDict()
    assert set(counts.values()) == {0}
    assert invalid_records(frame).count() == 0
    assert all(row["status"] for row in quality_report(profile(frame)).collect())


def test_profile_equals_the_single_checks(spark):
    rows = nine() + [review("x", customer_id=None), review("y", rating="abc"), review("y", rating="abc", os=None)]
    frame = records(spark, rows)
    counts = profile(frame).first()
    assert counts["total_records"] == frame.count()
    assert counts["duplicate_groups"] == duplicate_groups(frame).count()
    assert counts["duplicate_rows"] == duplicate_rows(frame).count()
    assert counts["null_rows"] == null_records(frame).count()
    assert counts["type_failures"] == type_failures(frame).count()
    nulls = {row["column_name"]: row["null_count"] for row in null_profile(frame).collect()}
    assert nulls == {c[5:]: n for c, n in counts.asDict().items() if c.startswith("null_") and c != "null_rows" and n}


def test_conform_casts_and_drops(spark):
    schema = StructType(
        [StructField("a", IntegerType()), StructField("b", StringType()), StructField("c", DoubleType())]
    )
    frame = spark.sql("SELECT 5 AS b, '2.5' AS c, '7.9' AS a, 'x' AS extra")
    found = conform(frame, schema)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("a", "int"), ("b", "string"), ("c", "string")]
    assert tuple(found.first()) == (7, "5", "2.5")


def test_conform_of_wide_numbers(spark):
    schema = StructType([StructField("a", IntegerType())])
    frame = spark.sql("SELECT * FROM VALUES (1L), (99999999999L), (NULL) AS t(a)")
    assert {row["a"] for row in conform(frame, schema).collect()} == {1, None}
    assert conform(spark.sql("SELECT 2.9D AS a"), schema).first()["a"] == 2
    assert conform(spark.sql("SELECT 3 AS a"), schema).first()["a"] == 3


def test_conform_needs_every_column(spark):
    with pytest.raises(AnalysisException):
        conform(spark.sql("SELECT 1 AS id"))
