"""Budgets against a recursive division, selections against a plain loop, the whole table against SQL."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import document, table, words
from plumbline.llm.mixing import Level, budgets, by_choice, mixed_documents, selection
from plumbline.llm.queries import mixture



def levels():
    return [
        Level("domain", F.substring("source", 1, 1), by_choice("domain", {"a": 3, "b": 1})),
        Level("lang", F.col("lang"), by_choice("lang", {"en": 2})),
        Level("source", F.col("source"), F.lit(1.0)),
    ]


def divided(tree, weights, total):
    """Water filling, one level after the other; ``tree`` maps paths of leaves to capacities."""

    def share(paths, budget, depth):
        if depth == 3:
            return {paths[0]: min(budget, tree[paths[0]])}
        children = defaultdict(list)
        for path in paths:
            children[path[depth]].append(path)
        capacity = {c: sum(tree[p] for p in ps) for c, ps in children.items()}
        weight = {c: weights(depth, c) for c in children}
        given, open_children, left = {}, set(children), budget
        while open_children:
            rest = sum(weight[c] for c in open_children)
            full = {c for c in open_children if capacity[c] <= left * weight[c] / rest}
            if not full:
                given |= {c: left * weight[c] / rest for c in open_children}
                break
            given |= {c: capacity[c] for c in full}
            left -= sum(capacity[c] for c in full)
            open_children -= full
        out = {}
        for c, ps in children.items():
            out |= share(ps, given[c], depth + 1)
        return out

    return share(list(tree), total, 0)


@pytest.mark.parametrize("total", [10, 500, 2000, 5000, 100_000])
def test_budgets(spark, total):
    leaves = {("a", "en", "a1"): 50, ("a", "en", "a2"): 400, ("a", "de", "a1"): 10, ("b", "en", "b1"): 900, ("b", "fr", "b1"): 5}
    frame = spark.createDataFrame([(*path, n) for path, n in leaves.items()], "domain string, lang string, source string, tokens long")
    found = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in budgets(frame, levels(), total, 3).collect()}

    def weights(depth, key):
        return ({"a": 3}, {"en": 2}, {})[depth].get(key, 1)

    expected = divided({p: 3 * n for p, n in leaves.items()}, weights, total)
    assert found == {p: pytest.approx(b, abs=1) for p, b in expected.items()}
    if total >= 3 * sum(leaves.values()):
        assert found == {p: 3 * n for p, n in leaves.items()}


def test_a_weight_of_zero_takes_nothing(spark):
    frame = spark.createDataFrame([("a", "en", "a1", 10), ("b", "en", "b1", 10)], "domain string, lang string, source string, tokens long")
    without = [Level("domain", F.lit(""), by_choice("domain", {"a": 0})), *levels()[1:]]
    assert [(r["domain"], r["budget"]) for r in budgets(frame, without, 20, 3).collect()] == [("b", 20)]


def expected_selection(rows, budget_of, seed=7):
    """rows: (doc_id, leaf, tokens)."""
    out, leaves = [], defaultdict(list)
    for doc_id, leaf, tokens in rows:
        leaves[leaf].append((doc_id, tokens))
    for leaf, members in leaves.items():
        total = sum(t for _, t in members)
        if not total or leaf not in budget_of:
            continue
        passes, rest = divmod(budget_of[leaf], total)
        out += [(d, leaf, e) for d, _ in members for e in range(1, passes + 1)]
        used = 0
        order = sorted(members, key=lambda m: (hashlib.md5(f"{seed}:{passes + 1}:{m[0]}".encode()).hexdigest(), m[0]))
        for d, t in order:
            if used < rest and used + t <= rest:
                out.append((d, leaf, passes + 1))
            used += t
            if used >= rest:
                break
    return sorted(out)


@pytest.mark.parametrize("fraction", [0.1, 0.7, 1.5, 10.0])
def test_selection(spark, files, fraction):
    rows = []
    for i in range(700):
        source = "a1" if i % 3 == 0 else f"{'ab'[i % 2]}{i % 5}"
        rows.append(document(i, " ".join(words(i, i % 60)), ["en", "en", "de"][i % 3], source))
    docs = files(table(spark, rows))
    found = selection(docs, levels(), fraction=fraction).collect()
    plain = [(r[0], (r[3][0], r[2], r[3]), len(r[1].split())) for r in rows]
    leaves = defaultdict(int)
    for _, leaf, tokens in plain:
        leaves[leaf] += tokens
    frame = spark.createDataFrame([(*p, n) for p, n in leaves.items()], "domain string, lang string, source string, tokens long")
    plan = budgets(frame, levels(), sum(leaves.values()) * fraction, 3).collect()
    budget_of = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in plan}
    got = sorted((r["doc_id"], (r["domain"], r["lang"], r["source"]), r["epoch"]) for r in found)
    assert got == expected_selection(plain, budget_of)
    mixed = mixed_documents(docs, levels(), fraction=fraction)
    assert mixed.columns == docs.columns
    assert sorted(r["doc_id"] for r in mixed.collect()) == [d for d, *_ in got]


def test_odd_documents(odd, crowded, none):
    found = selection(crowded, mixture(), fraction=3.0).collect()
    assert {r["lang"] for r in found} == {"en", "(none)"}
    assert mixed_documents(crowded, mixture(), fraction=3.0).columns == crowded.columns
    assert sum(r["tokens"] for r in found) == 3 * sum(len((r["text"] or "").split()) for r in odd.collect() if r["text"])
    assert selection(none, mixture()).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for frame in (selection(docs, mixture()), mixed_documents(docs, mixture())):
        text = frame._jdf.queryExecution().toString()
        assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text
