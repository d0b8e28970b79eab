"""Sharding by balanced label propagation (operator 9). DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import stored

SHARDS = 8
ROUNDS = 6
# Links that a linked group looks along for the one it begins with.
GATHER_STEPS = 4
# Ranks are counted by so many bits of the hashes of groups, and of the rows within a group.
GROUP_BITS = 12
ROW_BITS = 12
# Places in the order of admission, over all pairs of shards.
ADMISSION_BUCKETS = 1 << 16


def nodes(docs: DataFrame) -> DataFrame:
    """``row``, ``doc_id``, ``size``, ``text_crc32``, ``group`` (a hash of the text) of each document; one pass over the texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )


def merged(table: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``group``, ``label``, ``n``: the rows of a group that begin under a label (by a hash of the row) are one node."""
    label = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("label")
    return table.select("group", label).groupBy("group", "label").agg(F.count("*").alias("n"))


def group_links(table: DataFrame, links: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``n``, both ways: the links (``a``, ``b``: ``doc_id``) between different groups."""
    known = table.filter("doc_id IS NOT NULL").groupBy("doc_id", "group").agg(F.lit(1).alias("one")).drop("one")
    ends = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    for side, name in (("a", "src"), ("b", "dst")):
        ends = ends.join(known.withColumnsRenamed({"doc_id": side, "group": name}), side)
    ends = ends.filter("src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    return ends.unionByName(ends.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def wants(state: DataFrame, links: DataFrame | None) -> DataFrame:
    """``group``, ``at``, ``to``, ``n``: the nodes that are not where most of their neighbours are.

    The rows of a group are neighbours of each other; a linked group adds its
    links, dealt by where its rows are. Of labels with equally many, the lowest.
    """
    votes = state.select("group", "label", F.col("n").cast("double").alias("votes"))
    if links is not None:
        total = Window.partitionBy("group")
        shares = state.select(F.col("group").alias("dst"), "label", (F.col("n") / F.sum("n").over(total)).alias("share"))
        near = links.join(shares, "dst").select(F.col("src").alias("group"), "label", (F.col("n") * F.col("share")).alias("votes"))
        votes = votes.unionByName(near).groupBy("group", "label").agg(F.sum("votes").alias("votes"))
    best = votes.groupBy("group").agg(F.max_by("label", F.struct("votes", -F.col("label"))).alias("to"))
    return state.join(best, "group").filter("label != to").select("group", F.col("label").alias("at"), "to", "n")


def admitted(asked: DataFrame, loads: dict[int, int], quota: int, shards: int) -> DataFrame:
    """The moves (as of :func:`wants`) that go, ``n`` rows of each, so that no shard grows beyond ``quota``.

    From one shard to another go as many rows as come back, and an equal part
    of the room there. They go in the order of their groups, found from prefix
    sums of their sizes; the last one goes in part.
    """
    buckets = max(1, ADMISSION_BUCKETS // (shards * shards))
    asked = asked.withColumn("bucket", F.pmod("group", F.lit(buckets)).cast("int"))
    sums = stored(asked.groupBy("at", "to", "bucket").agg(F.sum("n").alias("n")), "asked")
    flows = sums.groupBy("at", "to").agg(F.sum("n").alias("n"))
    back = flows.select(F.col("at").alias("to"), F.col("to").alias("at"), F.col("n").alias("back"))
    room = F.element_at(F.array(*[F.lit(max(0, quota - loads.get(k, 0)) // max(1, shards - 1)) for k in range(shards)]), F.col("to") + 1)
    allowed = F.least("n", F.coalesce("back", F.lit(0)) + room).alias("allowed")
    flows = flows.join(back, ["at", "to"], "left").select("at", "to", allowed)
    before = Window.partitionBy("at", "to").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("at", "to", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("at", "to", "bucket").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = asked.join(sums.join(flows, ["at", "to"]), ["at", "to", "bucket"])
    placed = placed.withColumn("n", F.least("n", F.col("allowed") - ahead))
    return placed.filter("n > 0").select("group", "at", "to", "n")


def _loads(state: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in state.groupBy("label").agg(F.sum("n").alias("n")).collect()}


def _ahead(table: DataFrame, key: str) -> DataFrame:
    """With ``ahead``: the sum of ``n`` of all rows before one, in the order of buckets of ``key``, then of ``key``."""
    table = table.withColumn("bucket", F.pmod(key, F.lit(ADMISSION_BUCKETS)).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = table.groupBy("bucket").agg(F.sum("n").alias("n"))
    sums = sums.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    table = table.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return table.join(sums, "bucket").withColumn("ahead", F.col("before") + F.col("inside")).drop("bucket", "before", "inside")


def gathered(state: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``group``, ``label``, ``n``: as ``state``, but groups that links bring near begin together.

    A group's leader is the smallest one within ``GATHER_STEPS`` links. Groups of
    one leader are one node, of the sum of their rows, and nodes are dealt to the shards by
    prefix sums of their sizes. Nodes larger than a quarter of a shard, around hubs, are
    left as they begin: the rounds draw on them under quotas.
    """
    least = -(-(state.agg(F.sum("n")).first()[0] or 0) // (4 * shards))
    led = state.groupBy("group").agg(F.sum("n").alias("n")).join(links.select(F.col("src").alias("group")), "group", "left_semi")
    led = led.withColumn("leader", F.col("group"))
    for _ in range(GATHER_STEPS):
        near = links.join(led.select(F.col("group").alias("dst"), "leader"), "dst")
        near = near.groupBy(F.col("src").alias("group")).agg(F.min("leader").alias("near"))
        led = stored(led.join(near, "group", "left").select("group", "n", F.least("leader", "near").alias("leader")), "led")
    clusters = stored(led.groupBy("leader").agg(F.sum("n").alias("n")).filter(F.col("n") <= least), "clusters")
    total = clusters.agg(F.sum("n")).first()[0] or 1
    label = F.expr(f"CAST(ahead * {shards} DIV {total} AS INT)").alias("label")
    begin = stored(led.join(_ahead(clusters, "leader").select("leader", label), "leader").select("group", "label", "n"), "gathered")
    return state.join(begin, "group", "left_anti").unionByName(begin)


def filled(free: DataFrame, loads: dict[int, int], quota: int, shards: int) -> DataFrame:
    """``group``, ``label``, ``n``: single rows that nothing draws, put where the others leave room below ``quota``.

    In the order of their groups, found from prefix sums over buckets, they fill one shard after the other.
    """
    ends, end = [], 0
    for k in range(shards - 1):
        end += max(0, quota - loads.get(k, 0))
        ends.append(F.lit(end).cast("long"))
    full = F.size(F.filter(F.array(*ends).cast("array<bigint>"), lambda e: e <= F.col("ahead")))
    return _ahead(free, "group").select("group", full.cast("int").alias("label"), "n")


def propagated(state: DataFrame, links: DataFrame | None = None, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``group``, ``label``, ``n`` after ``rounds`` of moves towards the shard where most neighbours are.

    Nodes are the rows of a group under one label, so a group of very many
    copies is at most ``shards`` rows here. Groups that nothing draws anywhere are
    left out of the rounds; those of several rows keep their label and count in the
    quotas, single rows fill in the end what the others leave (:func:`filled`).
    """
    quota = -(-sum(_loads(state).values()) // shards)
    drawn = state.groupBy("group").agg(F.count("*").alias("labels")).filter("labels > 1").select("group")
    if links is not None:
        drawn = drawn.union(links.select("src")).distinct()
    moving = stored(state.join(drawn, "group", "left_semi"), "moving")
    still = state.join(drawn, "group", "left_anti")
    staying = still.filter("n > 1")
    loads = _loads(staying.unionByName(moving))
    for _ in range(rounds):
        moves = stored(admitted(stored(wants(moving, links), "wants"), loads, quota, shards), "moves")
        if moves.isEmpty():
            break
        gone = moves.select("group", F.col("at").alias("label"), (-F.col("n")).alias("n"))
        come = moves.select("group", F.col("to").alias("label"), "n")
        changes = gone.unionByName(come)
        for label, n in _loads(changes).items():
            loads[label] = loads.get(label, 0) + n
        moving = moving.unionByName(changes).groupBy("group", "label").agg(F.sum("n").alias("n")).filter("n > 0")
        moving = stored(moving, "moving")
    return staying.unionByName(moving).unionByName(filled(still.filter("n = 1"), loads, quota, shards))


def ranked(table: DataFrame, labels: DataFrame) -> DataFrame:
    """``rank`` (gapless from 0) by ``label`` (of a ``group``), then group, then a hash of ``row``.

    Counted in three steps, so that no task sees more than a bucket: counts of
    group buckets are summed up over at most ``shards << GROUP_BITS`` rows;
    within one, counts of the groups' row buckets; within one of those, rows. A group
    meets its label as such counts, and its rows meet them by row bucket: a
    group of a third of all rows is spread over ``1 << ROW_BITS`` keys.
    """
    table = table.withColumn("rh", F.xxhash64("row")).withColumn("rb", F.shiftrightunsigned("rh", 64 - ROW_BITS).cast("int"))
    fine = table.groupBy("group", "rb").agg(F.count("*").alias("n")).join(labels, "group")
    fine = fine.withColumn("gb", F.shiftrightunsigned("group", 64 - GROUP_BITS).cast("int"))
    coarse = fine.groupBy("label", "gb").agg(F.sum("n").alias("n"))
    before = Window.orderBy("label", "gb").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.select("label", "gb", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("label", "gb").orderBy("group", "rb").rowsBetween(Window.unboundedPreceding, -1)
    fine = fine.withColumn("above", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    fine = fine.join(coarse, ["label", "gb"]).select("group", "rb", (F.col("base") + F.col("above")).alias("first"))
    order = Window.partitionBy("group", "rb").orderBy("rh", "row")
    numbered = table.withColumn("place", F.row_number().over(order) - 1)
    return numbered.join(fine, ["group", "rb"]).withColumn("rank", F.col("first") + F.col("place"))


def shard(docs: DataFrame, links: DataFrame | None = None, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    The law is ``rows``: shard sizes differ by one row at most. Documents of
    equal text are linked, and so are those that ``links`` (``a``, ``b``:
    ``doc_id``) names; the latter begin together in nodes of near ones. Label
    propagation draws them together under quotas; a group of equal texts that ends under several labels takes the one of most of
    its rows. The labels' order, and within a label the groups, then put every
    row at a rank, and shards are equal stretches of ranks: a group is cut only
    where a stretch ends, and one larger than a shard has to be.

    Null is an empty text (size 1), very long texts are hashed whole. Null and
    repeated ``doc_id`` and repeated rows are separate rows, the order of equal
    rows is arbitrary. An empty table gives no rows. Further columns, of any name, are ignored.
    """
    table = stored(nodes(docs), "nodes")
    between = None if links is None else stored(group_links(table, links), "links")
    state = stored(merged(table, shards), "merged")
    if between is not None:
        state = stored(gathered(state, between, shards), "begin")
    state = propagated(state, between, shards, rounds)
    labels = state.groupBy("group").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("label"))
    total = table.count()
    placed = ranked(table, labels)
    # Shard s holds the ranks from floor(s * total / shards) on.
    number = F.expr(f"((rank + 1) * {shards} - 1) DIV {max(1, total)}")
    placed = placed.withColumn("shard", number.cast("int"))
    first = F.expr(f"(CAST(shard AS BIGINT) * {total}) DIV {shards}")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
