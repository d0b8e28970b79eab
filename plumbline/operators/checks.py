"""Quality checks: duplicate groups, null profile, type consistency and their verdicts."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from plumbline.functions import safe_int
from plumbline.schema import DUPLICATE_KEY, PROFILED_COLUMNS, REQUIRED_COLUMNS

# Check names, result codes and report texts.
DUPLICATE_CHECK = "duplicate_check"
NULL_CHECK = "null_check"
TYPE_CHECK = "type_consistency_check"
CODE_OK = 200
CODE_BAD_DATA = 400
CODE_CONFLICT = 409
DUPLICATES_FOUND = ("Registros duplicados encontrados: ", " registros com base no 'id'.")
DUPLICATES_NONE = "Nenhum registro duplicado encontrado."
NULLS_FOUND = ("Valores nulos encontrados nas colunas: {", "}.")
NULLS_NONE = "Nenhum valor nulo encontrado nas colunas criticas."
TYPES_FOUND = "Valores não numéricos encontrados na coluna 'rating'."
TYPES_NONE = "Consistencia dos tipos de dados verificada com sucesso."

CHECKS = [DUPLICATE_CHECK, NULL_CHECK, TYPE_CHECK]


def has_null() -> Column:
    """True where a required column is NULL; such a row is invalid."""
    return reduce(or_, [F.col(name).isNull() for name in REQUIRED_COLUMNS])


def _not_an_int(records: DataFrame) -> Column:
    rating = F.col("rating")
    text = isinstance(records.schema["rating"].dataType, StringType)
    return (safe_int(rating) if text else rating.try_cast("int")).isNull()


def duplicate_groups(records: DataFrame) -> DataFrame:
    """Keys held by more than one row, with their row count. NULL keys form groups too.

    The count is combined on the map side, so a key that holds a large share of
    all rows arrives at its reducer as one partial count per task.
    """
    return records.groupBy(*DUPLICATE_KEY).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def null_counts(records: DataFrame) -> DataFrame:
    """NULLs per profiled column, one row."""
    return records.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in PROFILED_COLUMNS])


def null_profile(records: DataFrame) -> DataFrame:
    """One row per profiled column that has NULLs."""
    counts = null_counts(records).unpivot([], PROFILED_COLUMNS, "column_name", "null_count")
    return counts.filter(F.col("null_count") > 0)


def type_failures(records: DataFrame) -> DataFrame:
    """Rows whose rating is not an integer; a NULL rating counts as a failure."""
    return records.filter(_not_an_int(records))


def row_counters(records: DataFrame) -> dict[str, Column]:
    """Aggregates that need no grouping, usable in ``agg`` as well as in ``observe``."""
    counters = {"total_records": F.count(F.lit(1))}
    counters |= {f"null_{name}": F.count_if(F.col(name).isNull()) for name in PROFILED_COLUMNS}
    counters["null_rows"] = F.count_if(has_null())
    counters["type_failures"] = F.count_if(_not_an_int(records))
    return counters


def group_counters() -> dict[str, Column]:
    """Aggregates over :func:`duplicate_groups`. Rows with a NULL in the key are never duplicates."""
    keyed = F.when(~reduce(or_, [F.col(name).isNull() for name in DUPLICATE_KEY]), F.col("count"))
    return {
        "duplicate_groups": F.count(F.lit(1)),
        "duplicate_rows": F.coalesce(F.sum(keyed), F.lit(0)),
    }


def profile(records: DataFrame) -> DataFrame:
    """All counters of all checks in one row.

    Two aggregates, each over a pruned scan: one without a shuffle of rows for
    the per-row counters, one on the three key columns for the groups. Keeping
    them apart leaves the text column out of the keyed shuffle.
    """
    rows = row_counters(records)
    groups = group_counters()
    per_row = records.agg(*[column.alias(name) for name, column in rows.items()])
    per_group = duplicate_groups(records).agg(*[column.alias(name) for name, column in groups.items()])
    parts = per_row.unionByName(per_group, allowMissingColumns=True)
    return parts.agg(*[F.sum(name).alias(name) for name in [*rows, *groups]])


def _verdict(bad: Column, code: int, found: Column, none: str) -> Column:
    return F.struct(
        F.when(bad, found).otherwise(F.lit(none)).alias("message"),
        (~bad).alias("status"),
        F.when(bad, F.lit(code)).otherwise(F.lit(CODE_OK)).alias("code"),
    )


def verdicts() -> dict[str, Column]:
    """Message, status and code per check, over a :func:`profile` row."""
    nulls = [
        F.when(F.col(f"null_{name}") > 0, F.concat(F.lit(f"'{name}': "), F.col(f"null_{name}")))
        for name in PROFILED_COLUMNS
    ]
    any_null = reduce(or_, [F.col(f"null_{name}") > 0 for name in PROFILED_COLUMNS])
    groups = F.col("duplicate_groups")
    return {
        DUPLICATE_CHECK: _verdict(
            groups > 0,
            CODE_CONFLICT,
            F.concat(F.lit(DUPLICATES_FOUND[0]), groups.cast("string"), F.lit(DUPLICATES_FOUND[1])),
            DUPLICATES_NONE,
        ),
        NULL_CHECK: _verdict(
            any_null,
            CODE_BAD_DATA,
            F.concat(F.lit(NULLS_FOUND[0]), F.concat_ws(", ", *nulls), F.lit(NULLS_FOUND[1])),
            NULLS_NONE,
        ),
        TYPE_CHECK: _verdict(F.col("type_failures") > 0, CODE_BAD_DATA, F.lit(TYPES_FOUND), TYPES_NONE),
    }


def quality_report(profiled: DataFrame) -> DataFrame:
    """One row per check, from a :func:`profile` row."""
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            verdict["status"].alias("status"),
            verdict["code"].alias("code"),
            verdict["message"].alias("message"),
            F.col("total_records"),
        )
        for check, verdict in verdicts().items()
    ]
    return profiled.select(F.inline(F.array(*rows)))
