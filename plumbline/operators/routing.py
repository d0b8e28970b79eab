"""Row routing: valid rows, rows with a NULL, duplicate rows, invalid rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.checks import duplicate_groups, has_null
from plumbline.schema import COLUMNS, DUPLICATE_KEY

REASON = "reason"
REASON_NULL = "null"
REASON_DUPLICATE = "duplicate"

# A key with more rows than this is spread over several reducers.
HOT_ROWS = 200_000
# The spreading table has a place for each value of this many bits of the key
# hash. It is broadcast: at most 2**22 pairs of integers, whatever the data, and
# no hot key is left out. Keys that share a place share the larger number of salts.
SALT_BITS = 22

# Rows without a full key match no group; any number of salts serves to spread them.
LOOSE_SALTS = 1 << 20

# The screen is a bit per hash value of this many bits. As 64-bit words with
# their numbers it is a broadcast of at most 2**22 rows (160 MB), whatever the data.
SCREEN_BITS = 28

_SLOT = "_slot"
_SALT = "_salt"
_SALTS = "_salts"
_SHARED = "_shared"
_WORD = "_word"
_BITS = "_bits"
_OTHERS = "_others"
_DISPUTED = "_disputed"


def valid_records(records: DataFrame) -> DataFrame:
    """Rows with every required column set. Duplicates and non-numeric ratings stay in."""
    return records.select(*COLUMNS).filter(~has_null())


def null_records(records: DataFrame) -> DataFrame:
    """The complement of :func:`valid_records`."""
    return records.select(*COLUMNS).filter(has_null())


def _keyed() -> Column:
    """True where the whole key is set. Separate conditions, so that each reaches the scan."""
    return reduce(and_, [F.col(name).isNotNull() for name in DUPLICATE_KEY])


def _slot() -> Column:
    return F.shiftrightunsigned(F.xxhash64(*DUPLICATE_KEY), 64 - SALT_BITS).cast("int").alias(_SLOT)


def _salts_per_slot(groups: DataFrame, hot_rows: int) -> DataFrame:
    """The number of salts of each place that a hot key falls on; all others have one."""
    salts = F.max(F.ceil(F.col("count") / hot_rows)).cast("int")
    return groups.filter(F.col("count") > hot_rows).groupBy(_slot()).agg(salts.alias(_SALTS))


def _salted(
    records: DataFrame, groups: DataFrame, hot_rows: int, strategy: str | None, columns: Sequence[str] = COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Rows (``columns`` of them) and group keys, both with the salt they are to be joined on.

    Both sides look the number of salts up by key hash, so keys on one place
    cost a few repeated groups and never a row. A row's salt comes from its id
    and the number of the task that read it: exact copies spread too, and a
    retried task gives the same salt. Rows without a full key match nothing and
    are simply spread.
    """
    groups = groups.filter(_keyed())
    salts = F.broadcast(_salts_per_slot(groups, hot_rows))

    rows = records.select(*columns, _slot()).join(salts, _SLOT, "left")
    choices = F.when(_keyed(), F.coalesce(_SALTS, F.lit(1))).otherwise(F.lit(LOOSE_SALTS))
    rows = rows.withColumn(_SALT, F.pmod(F.xxhash64(F.spark_partition_id(), F.col("id")), choices).cast("int"))

    keys = groups.drop("count").withColumn(_SLOT, _slot()).join(salts, _SLOT, "left")
    keys = keys.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)))
    keys = keys.drop(_SLOT, _SALTS)
    return rows.drop(_SLOT, _SALTS), keys.hint(strategy) if strategy else keys


def _place() -> tuple[Column, Column]:
    """Where a key stands on the screen: the number of its word, and its bit there."""
    slot = F.shiftrightunsigned(F.xxhash64(*DUPLICATE_KEY), 64 - SCREEN_BITS)
    return F.shiftright(slot, 6), slot.bitwiseAND(63).cast("int")


def _mask(when: Column) -> Column:
    """The bits of one word of the screen, of the rows where ``when`` holds."""
    return F.bit_or(F.when(when, F.call_function("shiftleft", F.lit(1).cast("bigint"), _place()[1])))


def _on(name: str) -> Column:
    """True where the bit of the row's key is set in its word, never NULL."""
    return F.coalesce(F.bit_get(name, _place()[1]) == 1, F.lit(False))


def _screened(records: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with a NULL, and rows that may share their key: all that do, and a few that do not.

    The share of other rows that slip through is at most the number of groups
    over ``2**SCREEN_BITS``; the join that follows sorts them out.
    """
    word = _place()[0].alias(_WORD)
    words = groups.filter(_keyed()).groupBy(word).agg(_mask(F.lit(True)).alias(_BITS))
    looked_up = records.select(*COLUMNS, word).join(F.broadcast(words), _WORD, "left")
    return looked_up.filter(has_null() | _on(_BITS)).select(*COLUMNS)


def _told(records: DataFrame, groups: DataFrame, hot_rows: int, strategy: str | None) -> DataFrame:
    """Every row, with what a screen says of it: ``_SHARED`` and ``_DISPUTED``, never both.

    Keys alone are joined with the groups. The screen, a table of fixed size,
    has two bits for each place: one if keys that match fall on it, one if others
    do. Rows on a place of matching keys only share their key; rows on a place
    with both bits are disputed, and all others are alone with their key.
    """
    word = _place()[0].alias(_WORD)
    rows, keys = _salted(records.filter(_keyed()), groups, hot_rows, strategy, [*DUPLICATE_KEY, "id"])
    matched = rows.join(keys.withColumn(_SHARED, F.lit(True)), [*DUPLICATE_KEY, _SALT], "left")
    shared = F.col(_SHARED).isNotNull()
    screen = matched.groupBy(word).agg(_mask(shared).alias(_BITS), _mask(~shared).alias(_OTHERS))
    looked_up = records.select(*COLUMNS, word).join(F.broadcast(screen), _WORD, "left")
    said = {_SHARED: _keyed() & _on(_BITS) & ~_on(_OTHERS), _DISPUTED: _keyed() & _on(_BITS) & _on(_OTHERS)}
    return looked_up.withColumns(said).select(*COLUMNS, *said)


def duplicate_rows(
    records: DataFrame,
    groups: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    strategy: str | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Every row whose key another row shares. Rows with a NULL in the key never match.

    ``groups`` takes a stored result of :func:`duplicate_groups`; its known size
    then lets the optimizer broadcast it when it is small, and no row is moved.
    Otherwise both sides are shuffled on the key: of the rows, those that pass
    the screen, which is nearly none that share no key. A key with more than
    ``hot_rows`` rows is cut into salts: its rows are spread over them, its
    group is repeated once per salt. ``strategy`` is a join hint for the groups,
    such as ``merge``.

    ``in_place`` moves keys in place of rows: rows stay in the task that read them,
    in the order of the source, and only disputed ones (:func:`_told`) are shuffled.
    For the price of two more scans, one of them of the key, the texts shuffled do
    not grow with the duplicates; ``records`` must be the same each time they are read.
    """
    if groups is None:
        groups = duplicate_groups(records)
    if not in_place:
        rows, keys = _salted(_screened(records.filter(_keyed()), groups), groups, hot_rows, strategy)
        return rows.join(keys, [*DUPLICATE_KEY, _SALT], "left_semi").select(*COLUMNS)
    told = _told(records.filter(_keyed()), groups, hot_rows, strategy)
    rows, keys = _salted(told.filter(_DISPUTED), groups, hot_rows, strategy)
    matched = rows.join(keys, [*DUPLICATE_KEY, _SALT], "left_semi")
    return told.filter(_SHARED).select(*COLUMNS).unionByName(matched.select(*COLUMNS))


def invalid_records(
    records: DataFrame,
    groups: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    strategy: str | None = None,
    in_place: bool = False,
) -> DataFrame:
    """Rows with a NULL and duplicate rows, each with its reason; a row that is both appears twice.

    One scan finds both kinds: rows are marked by an outer join with the groups
    and repeated once per reason. Other rows stop at the screen. With ``in_place``
    the screens mark all rows but the disputed, as in :func:`duplicate_rows`.
    """
    if groups is None:
        groups = duplicate_groups(records)
    if not in_place:
        return _reasoned(_screened(records, groups), groups, hot_rows, strategy)
    told = _told(records, groups, hot_rows, strategy)
    settled = told.filter(~F.col(_DISPUTED) & (has_null() | F.col(_SHARED)))
    return _with_reasons(settled).unionByName(_reasoned(told.filter(_DISPUTED), groups, hot_rows, strategy))


def _reasoned(records: DataFrame, groups: DataFrame, hot_rows: int, strategy: str | None) -> DataFrame:
    rows, keys = _salted(records, groups, hot_rows, strategy)
    return _with_reasons(rows.join(keys.withColumn(_SHARED, F.lit(True)), [*DUPLICATE_KEY, _SALT], "left"))


def _with_reasons(marked: DataFrame) -> DataFrame:
    reasons = F.array_compact(
        F.array(F.when(has_null(), F.lit(REASON_NULL)), F.when(F.col(_SHARED), F.lit(REASON_DUPLICATE)))
    )
    return marked.select(*COLUMNS, F.explode(reasons).alias(REASON))
