"""Random small collections against the definitions, written out in plain Python."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plumbline.operators import conform, duplicate_groups, flatten, invalid_records, profile, valid_records
from plumbline.schema import COLUMNS, DUPLICATE_KEY, PROFILED_COLUMNS, REQUIRED_COLUMNS
from samples import documents, review

few = st.sampled_from
rows = st.lists(
    st.builds(
        review,
        few(["a", "b", "c", None]),
        customer_id=few(["1", "2", None]),
        rating=few(["1", "2.5", "x", None]),
        app_version=few(["1", None]),
        comment=few(["ok", None]),
        os=few(["iOS", None]),
        age=few(["30", "old", None]),
    ),
    max_size=25,
)


def as_int(text):
    found = re.fullmatch(r"\s*([+-]?\d+)(\.\d*)?\s*", text or "")
    return int(found[1]) if found else None


def as_records(collection):
    names = ["customer_id", "rating", "comment", "timestamp", "app_version", "country", "cpf", "age", "votes_count"]
    names += ["ip_address", "os", "os_version"]
    for given_id, *fields in collection:
        record = dict(zip(names, fields, strict=True), id=given_id and given_id[0], app="app-x")
        yield {name: record[name] for name in COLUMNS}


def key(record):
    return tuple(record[name] for name in DUPLICATE_KEY)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(collection=rows)
def test_definitions(spark, collection):
    frame = flatten(documents(spark, collection), "app-x")
    records = list(as_records(collection))
    copies = Counter(map(key, records))
    nulls = [r for r in records if any(r[name] is None for name in REQUIRED_COLUMNS)]
    valid = [r for r in records if r not in nulls]
    duplicates = [r for r in records if None not in key(r) and copies[key(r)] > 1]

    counts = profile(frame).first()
    assert counts["total_records"] == len(records)
    assert counts["null_rows"] == len(nulls)
    assert counts["duplicate_rows"] == len(duplicates)
    assert counts["duplicate_groups"] == sum(n > 1 for n in copies.values())
    assert counts["type_failures"] == sum(as_int(r["rating"]) is None for r in records)
    for name in PROFILED_COLUMNS:
        assert counts[f"null_{name}"] == sum(r[name] is None for r in records)

    groups = {tuple(row)[:3]: row["count"] for row in duplicate_groups(frame).collect()}
    assert groups == {k: n for k, n in copies.items() if n > 1}

    expected = Counter(
        tuple(as_int(r[c]) if c in ("votes_count", "age", "rating") else r[c] for c in COLUMNS) for r in valid
    )
    assert Counter(map(tuple, conform(valid_records(frame)).collect())) == expected

    reasons = [(*r.values(), "null") for r in nulls] + [(*r.values(), "duplicate") for r in duplicates]
    assert Counter(map(tuple, invalid_records(frame, hot_rows=2).collect())) == Counter(reasons)
