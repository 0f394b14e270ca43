"""Joins to dimensions and full grids of two key sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove import model

# Well below the executor memory of any cluster and Spark's own 8 GB limit.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

LOOKUP_SALTS = 16


def slots_of(df: DataFrame, least: int, share: int) -> int:
    """Slots for dealing rows: one for every ``share`` shuffle partitions, ``least`` at least."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, partitions // share)


def _sizes(dims: Mapping[str, DataFrame], bytes_too: bool) -> dict[str, tuple[int, int]]:
    """(rows, bytes) per dimension, from one job; bytes are 0 unless asked for."""
    if not dims:
        return {}
    parts = []
    for name, df in dims.items():
        total = F.lit(0).cast("bigint")
        if bytes_too:
            widths = [
                F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8
                for c in df.columns
            ]
            total = F.coalesce(F.sum(reduce(lambda a, b: a + b, widths)), total)
        parts.append(
            df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), total.alias("size"))
        )
    return {row.name: (row.n, row.size) for row in reduce(DataFrame.unionByName, parts).collect()}


class Side(NamedTuple):
    """The one-side of a many-to-one join; ``small`` only if it was measured so.

    Where it was not measured, Catalyst decides by the size it knows.
    """

    df: DataFrame
    small: bool


def measured(
    dims: Mapping[str, DataFrame], at_once: bool = False, most_bytes: int | None = None
) -> dict[str, Side]:
    """Measure which dimensions are small enough to broadcast.

    Rows are counted first, which reads no columns; bytes are summed only
    where there are few rows.  ``at_once`` takes both from one job, for narrow
    tables that have been written.
    """
    most_bytes = MAX_BROADCAST_BYTES if most_bytes is None else most_bytes
    short = dims
    if not at_once:
        rows = _sizes(dims, bytes_too=False)
        short = {name: dims[name] for name, (n, _) in rows.items() if n <= MAX_BROADCAST_ROWS}
    small = {
        name
        for name, (n, size) in _sizes(short, bytes_too=True).items()
        if n <= MAX_BROADCAST_ROWS and size <= most_bytes
    }
    return {name: Side(df, name in small) for name, df in dims.items()}


def join_dimension(
    rows: DataFrame, side: Side, key: str, dim_key: str, how: str = "left"
) -> DataFrame:
    """Many-to-one join to a dimension whose key has another name.

    A small side is broadcast.  Otherwise both sides are shuffled afresh on
    the key and its hash: adaptive execution splits a hot key only where both
    inputs of the join come straight from a shuffle, which a dimension that
    was just aggregated by its key would not.
    """
    same = F.col(key) == F.col(dim_key)
    if side.small:
        return rows.join(F.broadcast(side.df), same, how)
    return rows.join(side.df, same & (F.xxhash64(key) == F.xxhash64(dim_key)), how)


def lookup_join(
    rows: DataFrame,
    side: Side,
    same: Sequence[Column],
    row_key: str,
    how: str,
    salts: int | None = None,
) -> DataFrame:
    """Join rows to the few keys that need attention, such as broken references.

    A small side is broadcast.  Otherwise the rows of a key are dealt to
    ``salts`` slots and the lookup is copied to each, so that a hot key is
    spread even before adaptive execution splits it further.  By default the
    slots follow the number of shuffle partitions.
    """
    if side.small:
        return rows.join(F.broadcast(side.df), list(same), how)
    salts = salts or slots_of(rows, LOOKUP_SALTS, 16)
    slot = F.pmod(F.xxhash64(row_key), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    meet = [*same, F.col("__slot") == F.col("__copy")]
    joined = rows.withColumn("__slot", slot).join(side.df.withColumn("__copy", copies), meet, how)
    return joined.drop("__slot", "__copy")


def grid(
    left: DataFrame, right: DataFrame, left_key: str, slots: int | None = None
) -> DataFrame:
    """Every left row with every right row, as an equi-join.

    Left rows are dealt to ``slots`` by key, the (few) right rows are copied to
    every slot, and the two meet on the slot.  The work is spread over the
    slots and neither side passes through the driver or one task.
    """
    slots = slots or slots_of(left, 64, 1)
    dealt = left.withColumn("__slot", F.pmod(F.xxhash64(left_key), F.lit(slots)).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    copied = right.withColumn("__slot", copies)
    return dealt.join(copied, "__slot").drop("__slot")


def star_join(tables: Mapping[str, DataFrame], fact: str) -> DataFrame:
    """A fact with the columns of all its dimensions.

    Columns of a dimension other than its key are prefixed with its name.
    """
    df = tables[fact]
    edges = [e for e in model.star_edges_of(fact) if e.dimension in tables]
    dims = {}
    for edge in edges:
        pk, dim = model.PRIMARY_KEY[edge.dimension], tables[edge.dimension]
        names = [
            F.col(c).alias(f"__{edge.dimension}_key" if c == pk else f"{edge.dimension}_{c}")
            for c in dim.columns
        ]
        dims[edge.dimension] = dim.select(*names)
    sides = measured(dims)
    for edge in edges:
        dim_key = f"__{edge.dimension}_key"
        df = join_dimension(df, sides[edge.dimension], edge.column, dim_key, edge.how).drop(dim_key)
    return df


def repeated_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows, distinct keys and keys that occur more than once."""
    checks = [
        df.groupBy(F.col(model.PRIMARY_KEY[name]).alias("key"))
        .agg(F.count("*").alias("n"))
        .agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count("key").alias("n_keys"),
            F.count_if(F.col("n") > 1).alias("n_repeated"),
        )
        for name, df in tables.items()
        if name in model.PRIMARY_KEY
    ]
    return reduce(DataFrame.unionByName, checks)
