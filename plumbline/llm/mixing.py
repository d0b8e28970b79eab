"""Mixing sources to target weights by hierarchical budgets (operator 3). DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import joined_to_groups, row_key, row_order, stored, whole_row

# A leaf is repeated at most this often.
MAX_EPOCHS = 3
SEED = 7
# Buckets of the order of an epoch: hexadecimal digits of a hash.
PREFIX_DIGITS = 3
NO_VALUE = "(none)"

_WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Level:
    """A level of the tree: its name, the key of a document on it, and the weight of a node (over the names of the levels)."""

    name: str
    key: Column
    weight: Column


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")


def _shared_out(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Divide each parent's ``budget`` by ``weight``; no child gets more than its ``capacity``.

    What a child cannot take goes to its siblings by weight: children in the
    order of capacity over weight fill up while the rest could not take as much
    for their weight. Only what all of them cannot take was held back above,
    since a parent's capacity is the sum of its children's.
    """
    ratio = F.col("capacity") / F.col("weight")
    order = Window.partitionBy(*(parent or [F.lit(0)])).orderBy(ratio, name)
    before = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    children = children.withColumn("_full", ratio * rest + before <= F.col("budget"))
    whole = Window.partitionBy(*(parent or [F.lit(0)]))
    taken = F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole)
    part = F.when(F.col("_full"), F.col("capacity").cast("double"))
    return children.withColumn("budget", part.otherwise((F.col("budget") - taken) * F.col("weight") / open_weight)).drop("_full")


def budgets(leaves: DataFrame, levels: Sequence[Level], total: float, max_epochs: int) -> DataFrame:
    """Leaves (level names, ``tokens``) with ``budget``: whole tokens, at most ``tokens * max_epochs``."""
    names = [level.name for level in levels]
    weighed = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    for level in levels:
        weighed = weighed.withColumn(f"_w_{level.name}", level.weight.cast("double"))
    # A node with a weight of zero, and all below it, is left out.
    for level in levels:
        weighed = weighed.filter(F.col(f"_w_{level.name}") > 0)
    given = None
    for depth, level in enumerate(levels, 1):
        path, parent = names[:depth], names[: depth - 1]
        children = weighed.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.max(f"_w_{level.name}").alias("weight"))
        if given is None:
            children = children.withColumn("budget", F.lit(float(total)))
        else:
            children = children.join(given, parent)
        given = _shared_out(children, parent, level.name).select(*path, "budget")
    return leaves.join(given, names).withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("long"))


def decisions(
    docs: DataFrame,
    levels: Sequence[Level],
    fraction: float = 1.0,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    tokens: Column | None = None,
) -> DataFrame:
    """Every document that a leaf has tokens for, with ``times``, how often it is taken; as :func:`selection` says.

    ``doc_id``, ``_k``, ``_l`` (its key by content), the levels' keys, ``tokens``, ``times``.
    """
    names = [level.name for level in levels]
    keys = [F.coalesce(level.key.cast("string"), F.lit(NO_VALUE)).alias(level.name) for level in levels]
    count = (word_count() if tokens is None else tokens).cast("long").alias("tokens")
    # Numbers of rows are those of the stored table, and break ties in it alone.
    row = F.monotonically_increasing_id().alias("row")
    table = docs.select(row, docs["doc_id"].cast("long").alias("doc_id"), *row_key(), *keys, count)
    table = stored(table, "leaf-tokens")

    leaves = table.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    available = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = budgets(leaves, levels, available * fraction, max_epochs).filter("tokens > 0")
    whole = F.expr("budget DIV tokens").cast("int")
    plan = plan.select(*names, whole.alias("passes"), (F.col("budget") % F.col("tokens")).alias("rest"))
    plan = stored(plan, "budgets")

    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("passes") + 1).cast("string"), F.col("doc_id").cast("string")))
    rows = table.join(plan, names).withColumn("_order", drawn).withColumn("_bucket", F.substring("_order", 1, PREFIX_DIGITS))
    buckets = rows.groupBy(*names, "_bucket").agg(F.sum("tokens").alias("_sum"), F.max("rest").alias("rest"))
    up_to = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = buckets.withColumn("_end", F.sum("_sum").over(up_to))
    where = F.when(F.col("_end") < F.col("rest"), F.lit("all"))
    where = where.when(F.col("_end") - F.col("_sum") < F.col("rest"), F.lit("cut")).otherwise(F.lit("none"))
    buckets = buckets.select(*names, "_bucket", (F.col("_end") - F.col("_sum")).alias("_begin"), where.alias("_where"))
    rows = stored(rows.join(buckets, [*names, "_bucket"]).drop("_bucket"), "bucketed")

    up_to = Window.partitionBy(*names).orderBy("_order", "doc_id", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = rows.filter("_where = 'cut'").withColumn("_end", F.col("_begin") + F.sum("tokens").over(up_to))
    cut = cut.withColumn("_last", (F.col("_end") <= F.col("rest")) & (F.col("_end") - F.col("tokens") < F.col("rest"))).drop("_end")
    others = rows.filter("_where != 'cut'").withColumn("_last", F.col("_where") == "all")
    times = (F.col("passes") + F.col("_last").cast("int")).alias("times")
    return cut.unionByName(others).select("doc_id", "_k", "_l", *names, "tokens", times)


def selection(docs: DataFrame, levels: Sequence[Level], **settings) -> DataFrame:
    """The selected documents: ``doc_id``, the levels' keys, ``tokens`` and ``epoch``, a row for each time one is taken.

    ``fraction`` of all tokens is budgeted down the tree of ``levels``. A leaf
    gives whole passes over its documents and then a prefix of one more, in the
    order of a hash of seed, epoch and ``doc_id``: the documents that begin
    before the budget is spent and end within it. The prefix is found from sums
    over hash buckets; only the bucket where the budget ends is put in order.
    Further ``settings`` are those of :func:`decisions`.

    A null key is a leaf of its own, ``(none)``. Null and empty texts count no
    tokens, very long texts count whole. Of documents whose order ties (repeated
    rows) any may be the last that is taken. An empty table, or one without
    tokens, gives no rows. Other columns are ignored.
    """
    taken = decisions(docs, levels, **settings).filter("times > 0")
    names = [level.name for level in levels]
    return taken.select("doc_id", *names, "tokens", F.explode(F.sequence(F.lit(1), "times")).alias("epoch"))


def mixed_documents(docs: DataFrame, levels: Sequence[Level], **settings) -> DataFrame:
    """The documents with all their columns, whatever their names, each as often as it is selected.

    Documents are found again by their content. Rows that share ``doc_id`` and
    text are one here: one of them comes as often as all of them are selected.
    """
    chosen = decisions(docs, levels, **settings).groupBy("_k", "_l").agg(F.count("*").alias("n"), F.sum("times").cast("int").alias("times"))
    chosen = stored(chosen.filter("times > 0"), "chosen")
    again = F.explode(F.sequence(F.lit(1), "times"))
    keys = ["_k", "_l"]
    keyed = docs.select(whole_row(docs), *row_key())
    taken = keyed.join(chosen.filter("n = 1"), keys).select("document", again)
    repeated = chosen.filter("n > 1")
    if not repeated.isEmpty():
        # Very many rows of one key are cut before the join, and one of each task's goes on.
        rows = joined_to_groups(keyed, repeated, keys, "n", F.monotonically_increasing_id())
        rows = rows.groupBy(*keys).agg(F.min_by("document", row_order(docs)).alias("document"), F.max("times").alias("times"))
        taken = taken.unionByName(rows.select("document", again))
    return taken.select("document.*")


def by_choice(name: str, weights: dict[str, float], other: float = 1.0) -> Column:
    """The weight of a node from its key on level ``name``."""
    chosen = F.lit(float(other))
    for key, weight in weights.items():
        chosen = F.when(F.col(name) == key, F.lit(float(weight))).otherwise(chosen)
    return chosen
