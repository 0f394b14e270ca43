"""What the operators of this subpackage have in common."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.operators.joins import Side, join_dimension, lookup_join, measured
from tallygrove.session import scratch_path

# Fixed by the contract: what separates words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that a Python worker takes at once.
PIECE_BYTES = 2 << 20
# Rows with whole texts that Spark sends to a Python worker at once.
TEXT_ROWS = 1000
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Text widths of a table that is broadcast: while the driver builds and sends it, its heap
# takes about ten times the bytes of the rows.
MOST_BROADCAST = 8 << 20


def text_of(df: DataFrame, column: str) -> Column:
    """A text column where null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """Names a document by id and content, also where ids are null or repeat.

    Rows equal in id and text have one key and share their fate.
    """
    known = F.coalesce(F.concat(F.lit("i"), df[id_col].cast("string")), F.lit("n"))
    return F.concat_ws(":", F.hex(F.xxhash64(text_of(df, text_col))), known)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and go on from the files.

    Cuts the lineage, so that lost executors re-read files, and lets several
    uses share one computation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_of(table: DataFrame, grows: bool = False) -> Side:
    """A written table as the one-side of a join: broadcast if it is small, else never.

    Without the hint Spark would go by the size of the files, which says
    little about the rows, and nothing about their copies in ``lookup_join``.
    A table that ``grows`` as the documents do is shuffled at every size.
    """
    small = not grows and measured({"table": table}, at_once=True, most_bytes=MOST_BROADCAST)["table"].small
    return Side(table if small else table.hint("merge"), small)


def look_up(
    rows: DataFrame, keys: DataFrame, on: list[str], spread_by: str, how: str, grows: bool = False
) -> DataFrame:
    """Join rows to a table that has each key once.

    The table must be written already: it is measured, and broadcast only
    where it is small (see ``side_of``); otherwise hot keys of the rows are salted.
    """
    renamed = keys.select(*(F.col(c).alias(f"__k_{c}") if c in on else F.col(c) for c in keys.columns))
    same = [F.col(c) == F.col(f"__k_{c}") for c in on]
    joined = lookup_join(rows, side_of(renamed, grows), same, spread_by, how)
    return joined.drop(*(f"__k_{c}" for c in on))


def without(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents whose ``row_key`` is not among the ``key`` column of ``keys``."""
    dropped = staged(keys.select(F.col("key").alias("__of")).distinct(), "dropped")
    whole = F.struct(*(docs[c] for c in docs.columns))
    rows = docs.select(row_key(docs, id_col, text_col).alias("__key"), whole.alias("__row"))
    return join_dimension(rows, side_of(dropped), "__key", "__of", "left_anti").select("__row.*")


def map_texts(
    rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` over rows with whole texts, in batches of few rows.

    Spark bounds a batch by rows alone, and the default is meant for narrow
    rows; the session's setting is lowered where it is higher.
    """
    conf = rows.sparkSession.conf
    if int(conf.get(BATCH_ROWS)) > TEXT_ROWS:
        conf.set(BATCH_ROWS, str(TEXT_ROWS))
    return rows.mapInArrow(run, schema)


def in_pieces(
    batches: Iterator[pa.RecordBatch], column: int, limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


Span = tuple[str, int, int, bool]

SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def scan(
    docs: DataFrame,
    find: Callable[[list[str]], list[list[Span]]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id`` and ``spans`` of every document; ``find`` maps texts to (kind, start, end, base).

    Starts and ends count code points, ends are exclusive.
    """
    item = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 1):
            found = find(piece.column(1).to_pylist())
            flat = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for row in found for s in row]
            ends = pa.array(np.cumsum([0] + [len(row) for row in found]).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(flat, item))
            yield pa.RecordBatch.from_arrays([piece.column(0), lists], ["id", "spans"])

    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    return map_texts(rows, run, f"id {type_of(docs, id_col)}, spans {SPANS}")


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, overlapping ones made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def touches(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether [start, end) overlaps one of the merged spans."""
    i = bisect_left(spans, (end,)) - 1
    return i >= 0 and spans[i][1] > start


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
