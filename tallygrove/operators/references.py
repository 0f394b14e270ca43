"""Reference checks: values without a parent become NULL, rows stay."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, Side, lookup_join, measured
from tallygrove.operators.staging import Stage, as_is

STEP = "referential_integrity"
_NULL_SLICES = 256

# A key as a text and a whole number without leading zeros: two keys are equal if both parts are.
_NUMBERED = r"(?s)^(.*?)(0|[1-9][0-9]{0,17})$"


class ParentKeys(NamedTuple):
    """The keys of a parent; ``small`` only if they have been counted to be."""

    df: DataFrame
    pk: str
    small: bool = False

    @classmethod
    def of(cls, parent: DataFrame | ParentKeys, pk: str) -> ParentKeys:
        """As they are, or keys of a table whose size is not known."""
        return cls(parent, pk) if isinstance(parent, DataFrame) else parent

    @staticmethod
    def size(key: Column) -> Column:
        """The bytes of a parent's keys, to be counted while it is written."""
        return F.coalesce(F.sum(F.coalesce(F.octet_length(key.cast("string")), F.lit(0)) + 8), F.lit(0))

    @classmethod
    def counted(cls, df: DataFrame, pk: str, found: Mapping[str, int]) -> ParentKeys:
        small = found["__rows"] <= MAX_BROADCAST_ROWS and found["__bytes"] <= MAX_BROADCAST_BYTES
        return cls(df, pk, small)


def parent_keys(parent: DataFrame, pk: str) -> DataFrame:
    return parent.select(F.col(pk).cast("string").alias("parent_key")).filter(
        "parent_key is not null"
    )


def _place(key: Column) -> list[Column]:
    """Prefix, bucket and bit of a numbered key; NULL where a key is not numbered."""
    number = F.regexp_extract(key, _NUMBERED, 2).try_cast("bigint")
    prefix = F.when(number.isNotNull(), F.regexp_extract(key, _NUMBERED, 1))
    return [
        prefix.alias("__prefix"),
        F.bitmap_bucket_number(number).alias("__bucket"),
        F.bitmap_bit_position(number).alias("__bit"),
    ]


def key_bitmaps(parent: DataFrame, pk: str) -> DataFrame:
    """The numbered keys of a parent as bitmaps of 4 KB, one per prefix and 32,768 numbers.

    Prefix, bucket and bit give the key back, so a set bit is a key and not
    just a likely one.
    """
    keys = parent_keys(parent, pk).select(*_place(F.col("parent_key"))).filter("__bucket is not null")
    return keys.groupBy("__prefix", "__bucket").agg(F.bitmap_construct_agg("__bit").alias("__bits"))


def _set(bits: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set; NULL without a bitmap."""
    byte = F.hex(F.substring(bits, F.shiftright(bit, 3).cast("int") + 1, F.lit(1)))
    return F.getbit(F.conv(byte, 16, 10).cast("bigint"), F.pmod(bit, F.lit(8)).cast("int")) == 1


def unknown_keys(used: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The ``orphan_key`` values that no bitmap vouches for; ``bitmaps`` must be small."""
    placed = used.select("orphan_key", *_place(F.col("orphan_key")))
    same = ["__prefix", "__bucket"]
    met = placed.join(F.broadcast(bitmaps), same, "left")
    known = F.coalesce(_set(F.col("__bits"), F.col("__bit")), F.lit(False))
    return met.filter(~known).select("orphan_key")


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, pk: str, stage: Stage = as_is, name: str = ""
) -> DataFrame:
    """Distinct values of a reference that no parent row carries.

    With staging, and where all parent keys are numbered, these are written as
    bitmaps; if the bitmaps are few (a key takes one bit where numbers are
    dense) they go to every task, child keys with their bit set are left where
    they are, and what remains is broken.  Otherwise, and without staging,
    distinct values meet the parent's keys in a join: ``distinct`` is reduced
    before its shuffle, so a value that a third of the rows carry leaves every
    task once.
    """
    used = child.select(F.col(column).cast("string").alias("orphan_key")).filter("orphan_key is not null")
    keys = parent_keys(parent, pk)
    if stage is not as_is and keys.filter(_place(F.col("parent_key"))[1].isNull()).isEmpty():
        bitmaps = stage(key_bitmaps(parent, pk), f"{name}/bitmaps")
        if measured({"bitmaps": bitmaps}, at_once=True)["bitmaps"].small:
            unknown = stage(unknown_keys(used, bitmaps), f"{name}/unknown")
            return unknown if unknown.isEmpty() else unknown.distinct()
    used = used.distinct()
    return used.join(keys, used.orphan_key == keys.parent_key, "left_anti")


def spread_key(column: str, row_key: str) -> Column:
    """The reference as join key; NULLs are spread over keys that match nothing."""
    slot = F.pmod(F.xxhash64(F.col(row_key)), F.lit(_NULL_SLICES)).cast("string")
    return F.coalesce(F.col(column).cast("string"), F.concat(F.lit("\0"), slot))


def flag_orphans(child: DataFrame, column: str, parent: ParentKeys, flag: str | None = None) -> DataFrame:
    """NULL the reference where a small parent has no such key; the keys are broadcast."""
    key = f"__parent_{column}"
    # A key that occurs several times must not repeat the child's rows.
    keys = parent_keys(parent.df, parent.pk).distinct().select(F.col("parent_key").alias(key))
    value = F.col(column).cast("string")
    joined = child.join(F.broadcast(keys), value == F.col(key), "left")
    broken = value.isNotNull() & F.col(key).isNull()
    columns = {column: F.when(~broken, F.col(column))}
    if flag:
        columns[flag] = broken
    return joined.withColumns(columns).drop(key)


def null_orphans(
    child: DataFrame, column: str, orphans: Side, row_key: str, flag: str | None = None
) -> DataFrame:
    """NULL the reference where its value is among ``orphans``.

    The lookup holds the broken values only, so it is often small enough to
    broadcast, in which case the child is not shuffled at all.
    """
    # Renamed per use: several references of one child have the same lookup shape.
    key = f"__orphan_{column}"
    lookup = Side(orphans.df.select(F.col("orphan_key").alias(key)), orphans.small)
    same = [spread_key(column, row_key) == F.col(key)]
    joined = lookup_join(child, lookup, same, row_key, "left")
    broken = F.col(key).isNotNull()
    columns = {column: F.when(~broken, F.col(column))}
    if flag:
        columns[flag] = broken
    return joined.withColumns(columns).drop(key)


def orphan_side(orphans: DataFrame, stage: Stage, name: str) -> Side:
    """The broken values as lookup; measured where they have been written.

    Measuring runs the search for them, so without staging it would run twice.
    """
    written = stage(orphans, name)
    if written is orphans:
        return Side(orphans, small=False)
    return measured({name: written}, at_once=True)[name]


def check_reference(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    pk: str,
    row_key: str,
    stage: Stage = as_is,
) -> DataFrame:
    """Reference check of one column against one parent table.

    With staging the parent's keys are written and counted.  A small parent is
    broadcast; keys of a larger one are compared as bitmaps where they are
    numbered, and the rest by distinct values (see :func:`orphan_keys`), so the
    rows of the child are shuffled only where very many values are broken.
    Without staging they are shuffled.
    """
    name = f"orphans_{column}"
    if stage is as_is:
        orphans = orphan_keys(child, column, parent, pk)
        return null_orphans(child, column, orphan_side(orphans, stage, name), row_key)
    keys = stage(parent.select(pk), f"{name}/parents")
    parents = ParentKeys(keys, pk, measured({name: keys}, at_once=True)[name].small)
    if parents.small:
        return flag_orphans(child, column, parents)
    side = orphan_side(orphan_keys(child, column, keys, pk, stage, name), stage, f"{name}/broken")
    return null_orphans(child, column, side, row_key)
