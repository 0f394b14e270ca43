"""Deduplication: tagged rows, then repeated match keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.text import match_key
from tallygrove.operators.joins import LOOKUP_SALTS, slots_of
from tallygrove.rules import DEFAULT_RULES, CleaningRules


def is_tagged(pk: str, tag: str) -> Column:
    return F.coalesce(F.col(pk).cast("string").contains(tag), F.lit(False))


def drop_tagged(df: DataFrame, pk: str, tag: str = DEFAULT_RULES.duplicate_tag) -> DataFrame:
    """Drop rows whose key carries the duplicate tag."""
    return df.filter(~is_tagged(pk, tag))


def _keys(df: DataFrame, match_columns: Sequence[str]) -> list[Column]:
    return [match_key(F.col(c).cast("string")) for c in match_columns if c in df.columns]


def first_per_key(
    df: DataFrame, match_columns: Sequence[str], pk: str, arrival: Sequence[str] = ()
) -> DataFrame:
    """Keep the first row per normalised key tuple; NULL keys equal each other.

    "First" is by ``arrival`` columns if given, then by primary key.  The
    remaining columns break ties between rows with an equal primary key, so
    that a re-run task picks the same row.  The filter on the rank lets Spark
    cut every key to one row per map task before the shuffle
    (``WindowGroupLimit``), so a key that holds a third of all rows sends one
    row per task and no more.
    """
    keys = _keys(df, match_columns)
    if not keys:
        return df
    rest = [c for c in df.columns if c != pk and c not in arrival]
    order = [F.col(c) for c in (*arrival, pk, *rest)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def deduplicate(
    df: DataFrame,
    table: str,
    pk: str,
    rules: CleaningRules = DEFAULT_RULES,
    arrival: Sequence[str] = (),
) -> DataFrame:
    """Drop tagged rows, then rows that repeat a match key; ``arrival`` tells which is first."""
    untagged = drop_tagged(df, pk, rules.duplicate_tag)
    known = [c for c in arrival if c in df.columns]
    return first_per_key(untagged, rules.match_keys.get(table, ()), pk, known)


# Slots that fit the bits of a number.
_MOST_SLOTS = 62

# Repeats of one row that are spelt out at once.
_COPIES = 10_000


def spread(rows: DataFrame, n: str, copy: str) -> DataFrame:
    """Each row as many times as its count says, numbered from 1 in ``copy``.

    Counts are cut into parts first, so that no task holds a list as long as a
    hot count.
    """
    last = F.floor((F.col(n) - 1) / _COPIES)
    parts = rows.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("__part") * _COPIES
    numbers = F.sequence(start + 1, F.least(start + _COPIES, F.col(n)))
    return parts.withColumn(copy, F.explode(numbers)).drop("__part")


def key_repeats(df: DataFrame, match_columns: Sequence[str], pk: str) -> DataFrame:
    """A row (primary key, first key of the group) for each one that deduplication drops.

    Groups with their first primary key (NULL first, as in :func:`first_per_key`)
    are found by one aggregate that leaves each task with a row per match key.
    The rows meet the repeated groups, dealt to slots by primary key; a group is
    copied only to the slots its rows are in.  Rows with equal keys meet in one
    slot, so they are counted where they are; a count is spelt out as that many
    rows, one less for the first primary key, whose first row stays.
    """
    keys = _keys(df, match_columns)
    if not keys:
        return df.select(pk, F.col(pk).alias("first_id")).filter(F.lit(False))
    salts = min(slots_of(df, LOOKUP_SALTS, 16), _MOST_SLOTS)
    slot = F.pmod(F.xxhash64(pk), F.lit(salts)).cast("int")
    # Within a struct NULLs equal each other.
    keyed = df.select(pk, F.struct(*keys).alias("__key"), slot.alias("__slot"))
    firsts = (
        keyed.groupBy(F.col("__key").alias("__repeated"))
        .agg(
            F.min(F.struct(F.col(pk).isNotNull(), F.col(pk).alias("id"))).alias("__first"),
            F.bit_or(F.expr("shiftleft(1L, __slot)")).alias("__slots"),
            F.count("*").alias("__rows"),
        )
        .filter("__rows > 1")
    )
    used = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.getbit("__slots", i) == 1)
    copied = firsts.select("__repeated", F.col("__first.id").alias("first_id"), F.explode(used).alias("__copy"))
    met = keyed.join(copied, (F.col("__key") == F.col("__repeated")) & (F.col("__slot") == F.col("__copy")))
    counted = met.groupBy("__key", "__slot", pk, "first_id").agg(F.count("*").alias("__all"))
    kept = F.col(pk).eqNullSafe(F.col("first_id")).cast("int")
    dropped = counted.select(pk, "first_id", (F.col("__all") - kept).alias("__n")).filter("__n > 0")
    return spread(dropped, "__n", "__copy").select(pk, "first_id")
