"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrove.llm.components import components
from tallygrove.llm.shared import in_pieces, look_up, map_texts, row_key, side_of, staged, text_of, type_of, without
from tallygrove.operators.joins import join_dimension

SEED = 42
RADIUS = 3
BITS = 64
# Fingerprints of a bucket that are compared at once; larger buckets are divided by further masks.
BUCKET = 1024

_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMN = (np.arange(8, dtype=np.int64) * 256)[None, :]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the ASCII-lower-cased words, by shingles with repeats; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], dtype=">u8")
    counts = np.zeros((8, 256), dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8) + _COLUMN
        counts += np.bincount(part.ravel(), minlength=2048).reshape(8, 256)
    ones = counts @ _BIT_OF_BYTE
    return int.from_bytes(np.packbits((2 * ones > len(hashes)).ravel()).tobytes(), "big")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """``key``, ``id`` and ``fp`` (the fingerprint as a signed long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 2):
            found = [fingerprint(t, shingle) for t in piece.column(2).to_pylist()]
            signed = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), signed], ["key", "id", "fp"])

    rows = docs.select(
        row_key(docs, id_col, text_col).alias("key"), docs[id_col].alias("id"), text_of(docs, text_col).alias("text")
    )
    return map_texts(rows, run, f"key string, id {type_of(docs, id_col)}, fp bigint")


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``bits`` such that bits that differ in ``radius`` places agree under some mask.

    Bit i gets a nonzero vector of radius + 1 binary places.  A mask belongs to
    each nonzero vector v and holds the bits whose vector has an odd product
    with v.  For any ``radius`` vectors some v is orthogonal to all, so its
    mask leaves those bits out.
    """
    vectors = range(1, 1 << (radius + 1))
    turn = [vectors[i % len(vectors)] for i in range(len(bits))]
    return [
        sum(1 << b for b, phi in zip(bits, turn, strict=True) if (phi & v).bit_count() % 2)
        for v in vectors
    ]


def _deeper(masks: list[int]) -> list[int]:
    """Every mask joined with the covering masks over the bits that it leaves out."""
    return [
        mask | more
        for mask in masks
        for more in covering_masks([b for b in range(BITS) if not mask >> b & 1])
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def spanning_edges(fps: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that connect the fingerprints linked within a bucket; at most one for each."""
    order = np.sort(np.asarray(fps, dtype=np.int64))
    bits = order.view(np.uint64)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    label = np.arange(len(order))
    while True:
        low = np.where(near, label[None, :], len(order)).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    return [(int(order[i]), int(order[k])) for i, k in enumerate(label) if i != k]


_EDGES = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


@F.pandas_udf(_EDGES)
def _bucket_edges(members: pd.Series) -> pd.Series:
    return members.map(lambda m: [{"a": a, "b": b} for a, b in spanning_edges(m)])


def _bucket_rows(fps: DataFrame, masks: list[int], fan: int) -> DataFrame:
    """One row for each fingerprint and table below its place ``at``: (at, key, fp)."""
    table = F.array(*(F.lit(_signed(m)) for m in masks))
    below = F.sequence(F.col("at") * fan, F.col("at") * fan + (fan - 1))
    rows = fps.select("fp", F.explode(below).alias("at"))
    return rows.select("at", F.col("fp").bitwiseAND(F.get(table, F.col("at"))).alias("key"), "fp")


def linked(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within the radius.

    ``fps`` holds distinct fingerprints in a column ``fp``.  They are dealt to
    one bucket per covering mask.  Buckets of two are compared by a column
    expression, larger ones in one array; buckets of over ``bucket`` members
    are dealt anew under masks over their remaining bits.  Three levels leave
    at most 8 bits open, so no group is larger than that and no pair is lost.
    """
    level, masks, fan, parts = 1, covering_masks(list(range(BITS))), 15, []
    rest = fps.select("fp", F.lit(0).alias("at"))
    while True:
        rows = _bucket_rows(rest, masks, fan)
        counted = rows.groupBy("at", "key").agg(
            F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
        )
        shared = staged(counted.filter("n > 1"), "buckets")
        near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
        parts.append(shared.filter("n = 2").filter(near).select("a", "b"))
        last = max(BITS - m.bit_count() for m in masks)
        most = max(bucket, 1 << last) if last <= 8 else bucket
        keys = shared.filter(f"n > 2 and n <= {most}").select("at", "key")
        groups = look_up(rows, keys, ["at", "key"], "fp", "left_semi").groupBy("at", "key")
        found = groups.agg(F.collect_list("fp").alias("fps"))
        parts.append(found.select(F.inline(_bucket_edges("fps"))))
        large = shared.filter(f"n > {most}").select("at", "key")
        if large.isEmpty():
            break
        rest = staged(look_up(rows, large, ["at", "key"], "fp", "left_semi").select("fp", "at"), "large")
        level, masks = level + 1, _deeper(masks)
    edges = parts[0]
    for part in parts[1:]:
        edges = edges.unionAll(part)
    return edges.distinct()


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """Per document: ``key``, ``id``, ``fp``, ``label`` (of its component) and ``component`` (least id)."""
    marked = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    groups = staged(marked.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n")), "groups")
    labels = components(linked(groups.select("fp")))
    placed = groups.join(labels, F.col("fp") == F.col("node"), "left")
    several = placed.filter("node is not null or n > 1").withColumn("label", F.coalesce("label", "fp"))
    several = staged(several.select("fp", "first", "label"), "several")
    least = several.groupBy(F.col("label").alias("of")).agg(F.min("first").alias("component"))
    known = several.join(least, F.col("label") == F.col("of")).select("fp", "label", "component")
    met = look_up(marked, staged(known, "components"), ["fp"], "key", "left")
    return met.select(
        "key", "id", "fp", F.coalesce("label", "fp").alias("label"), F.coalesce("component", "id").alias("component")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints that differ in at most 3 bits are linked; the component is
    named by the smallest id that links reach.  Null texts count as empty, and
    empty texts share fingerprint zero.  Repeated rows stay; a null id names a
    component only if it has no other.  Other columns are ignored.
    """
    return grouped(docs, id_col, text_col, shingle).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without all but one of each component; columns and texts stay.

    The document of the smallest id stays; of several with that id, the one
    with the least text hash, and of rows equal in id and text one.
    """
    marked = staged(grouped(docs, id_col, text_col), "grouped")
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("key"))
    firsts = marked.groupBy("label").agg(F.min(rank)["key"].alias("kept"), F.count("*").alias("n"))
    several = staged(firsts.filter("n > 1").drop("n"), "several")
    beside = look_up(marked, several, ["label"], "key", "inner")
    rest = without(docs, beside.filter("key != kept").select("key"), id_col, text_col)
    equal = staged(beside.filter("key = kept").groupBy("key").count().filter("count > 1").select("key"), "equal")
    if equal.isEmpty():
        return rest
    whole = F.struct(*(docs[c] for c in docs.columns))
    rows = docs.select(row_key(docs, id_col, text_col).alias("__key"), whole.alias("__row"))
    once = join_dimension(rows, side_of(equal), "__key", "key", "left_semi")
    once = once.groupBy("__key").agg(F.first("__row").alias("__row"))
    return without(rest, equal, id_col, text_col).unionAll(once.select("__row.*"))
