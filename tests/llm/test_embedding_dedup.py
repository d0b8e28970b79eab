"""Links and components against the full matrix of cosines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import embedding_dedup
from plumbline.llm.common import stored
from plumbline.llm.embedding_dedup import band_bits, band_count, coded, coded_rows, near_vectors, rotation

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, threshold=0.93):
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float), label) for i, v, label in rows if i is not None and usable(v, label)]
    links, parent = {k: 0 for k in range(len(good))}, list(range(len(good)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(good)):
        for b in range(a):
            (i, u, s), (j, v, t) = good[a], good[b]
            if s == t and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                if good[x][0] > good[y][0]:
                    x, y = y, x
                parent[y] = x
    out = [(good[k][0], links[k], good[find(k)][0]) for k in range(len(good))]
    out += [(i, 0, i) for i, v, label in rows if i is None or not usable(v, label)]
    return sorted(out, key=str)


def found(df):
    return sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in df.collect()], key=str)


def test_links(spark, files):
    draw = np.random.default_rng(1)
    rows = [(i, draw.normal(size=64).astype(np.float32).tolist(), i % 3) for i in range(300)]
    hot = draw.normal(size=64)
    rows += [(1000 + i, hot.astype(np.float32).tolist(), 1) for i in range(200)]
    rows += [(2000 + i, (3 * hot + draw.normal(size=64) * 0.3).astype(np.float32).tolist(), 1) for i in range(80)]
    for c in range(20):
        centre = draw.normal(size=64)
        rows += [(3000 + 10 * c + i, (centre + draw.normal(size=64) * 0.2).astype(np.float32).tolist(), c % 4) for i in range(6)]
    rows += [(5000 + i, (10.0**i * np.array([1, 2, 3])).tolist(), 7) for i in range(-20, 20)]
    frame = files(spark.createDataFrame(rows, SCHEMA).repartition(4), "vectors")
    result = near_vectors(frame)
    assert found(result) == brute_force(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in result.collect())


def test_odd_vectors(spark, files):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [1.0, 0.0], None),
        (7, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [1.0, 0.0], 2), (10, [1.0, 0.0, 0.0], 1), (11, [-1.0, 0.0], 1),
        (12, [-0.0, 1.0], 1), (13, [0.0, 1.0], 1), (14, [], 1), (15, [2.0], 1), (16, [5.0], 1), (17, [-5.0], 1), (None, [1.0, 0.0], 1),
    ]
    frame = files(spark.createDataFrame(rows, SCHEMA).repartition(2), "odd-vectors")
    crowded = frame.withColumns({name: frame["label"] for name in ("rep", "n", "a", "b", "component", "key")})
    assert found(near_vectors(crowded)) == brute_force(rows)
    assert near_vectors(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(4)
    base = draw.normal(size=(400, 64))
    other = base + draw.normal(size=(400, 64)) * draw.uniform(0, 1, (400, 1))
    u, v = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (base, other))
    bits, factor, _, _ = coded(u, 1)
    query = v @ rotation(64, 0)
    estimate = ((2 * bits - 1) / 8 * query).sum(axis=1) / factor
    true = (u * v).sum(axis=1)
    spread = np.sqrt((1 - factor**2) / 63) / factor
    assert abs((estimate - true).mean()) < 0.02
    assert (np.abs(estimate - true) <= 4 * spread).all()


def test_recall_at_the_threshold(spark, files):
    """Pairs of a cosine just above the threshold, the hardest: at least 0.9 are found."""
    draw = np.random.default_rng(6)
    rows = []
    for i in range(300):
        u = draw.normal(size=64)
        u /= np.linalg.norm(u)
        w = draw.normal(size=64)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        c = 0.931
        rows += [(2 * i, u.tolist(), 0), (2 * i + 1, (c * u + np.sqrt(1 - c * c) * w).tolist(), 0)]
    result = near_vectors(files(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "pairs"))
    assert sum(r["n_links"] for r in result.collect()) >= 0.98 * 600


def test_short_vectors_near_the_threshold_are_found(spark, files):
    draw = np.random.default_rng(8)
    rows, pairs = [], 200
    for dim in (8, 16):
        for k in range(pairs):
            u, w = np.linalg.qr(draw.normal(size=(dim, 2)))[0].T
            v = 0.935 * u + np.sqrt(1 - 0.935**2) * w
            rows += [(len(rows), u.tolist(), k % 50 + dim * 100), (len(rows) + 1, v.tolist(), k % 50 + dim * 100)]
    docs = files(spark.createDataFrame(rows, SCHEMA), "vectors")
    linked = {r["vec_id"] for r in near_vectors(docs).collect() if r["n_links"]}
    assert len(linked) >= 0.97 * len(rows)


def vectors(spark, draw, n, dim, labels=1):
    rows = [(i, draw.normal(size=dim).astype(np.float32).tolist(), i % labels) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def distinct(frame):
    wide = F.col("embedding").cast("array<double>").alias("embedding")
    return frame.select(F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("n"), "label", wide)


def test_bands_follow_the_size():
    assert [band_bits(n) for n in (0, 1, 16, 17, 1000, 10**6, 10**12)] == [0, 0, 0, 1, 6, 16, 30]
    assert band_count(0) == 1
    angle = np.arccos(0.93) / np.pi
    for bits in (1, 6, 12, 16, 24):
        assert (1 - (1 - angle) ** bits) ** band_count(bits) <= 0.002


@pytest.mark.parametrize("dim", [64, 384, 768])
def test_codes_are_a_few_times_the_vectors(spark, dim):
    rows = coded_rows(distinct(vectors(spark, np.random.default_rng(dim), 300, dim)))
    size = sum((F.octet_length(name) for name in ("code", "short", "keys")), F.lit(80))
    total, count = rows.agg(F.sum(size), F.count("*")).first()
    assert count == 300 * band_count(5)
    # A label of 1,000 has ten bands instead of eight.
    assert total * band_count(6) / band_count(5) <= (14 if dim == 64 else 10) * 300 * 4 * dim


def test_no_table_of_pairs(spark, files, monkeypatch):
    """Where all vectors of a group are linked, what is stored grows with the vectors."""
    draw = np.random.default_rng(9)
    centre = draw.normal(size=64)
    tables = {}

    def watched(df, label):
        tables[label] = stored(df, label)
        return tables[label]

    monkeypatch.setattr(embedding_dedup, "stored", watched)
    for n in (300, 900):
        rows = [(i, (centre + draw.normal(size=64) * 0.1).astype(np.float32).tolist(), 1) for i in range(n)]
        result = near_vectors(files(spark.createDataFrame(rows, SCHEMA), f"dense-{n}")).collect()
        assert {r["n_links"] for r in result} == {n - 1} and {r["component_id"] for r in result} == {0}
        assert tables["links"].count() <= 30 * n and tables["open-links"].count() <= n


def test_pairs_at_the_threshold_are_left_open(spark, files, monkeypatch):
    """Cosines within rounding of the threshold are decided by the vectors themselves."""
    opened = []

    def watched(df, label):
        out = stored(df, label)
        if label == "links":
            opened.append(out.filter("near IS NULL").count())
        return out

    monkeypatch.setattr(embedding_dedup, "stored", watched)
    draw, rows = np.random.default_rng(10), []
    for k in range(40):
        u, w = np.linalg.qr(draw.normal(size=(16, 2)))[0].T
        c = 0.93 + (1e-12 if k % 2 else -1e-12)
        rows += [(2 * k, u.tolist(), k), (2 * k + 1, (c * u + np.sqrt(1 - c * c) * w).tolist(), k)]
    frame = files(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "edge")
    assert found(near_vectors(frame)) == brute_force(rows)
    assert opened == [40]


def test_recall_in_a_large_label(spark, files):
    """Bands of several bits: pairs just above the threshold among many others."""
    draw = np.random.default_rng(11)
    rows = [(10**6 + i, draw.normal(size=48).tolist(), 0) for i in range(3000)]
    for i in range(250):
        u, w = np.linalg.qr(draw.normal(size=(48, 2)))[0].T
        rows += [(2 * i, u.tolist(), 0), (2 * i + 1, (0.9301 * u + np.sqrt(1 - 0.9301**2) * w).tolist(), 0)]
    result = near_vectors(files(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), "many"))
    assert sum(r["n_links"] for r in result.filter("vec_id < 1000000").collect()) >= 0.98 * 500


def test_rotations_are_orthogonal():
    for dim in (1, 2, 64):
        q = rotation(dim, 3)
        assert q @ q.T == pytest.approx(np.eye(dim), abs=1e-9)
