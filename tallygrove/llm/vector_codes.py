"""Vector codes: a codebook per part of a vector, nearest entries found in a GNAT over the entries."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import look_up, staged, type_of

# Fixed by the contract.
SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2

# Split points of a node, and entries from which a node is divided further.
DEGREE, LEAF = 6, 8
# Far above the relative error of a few double operations.
_SLACK = 2.0**-48


class Node(NamedTuple):
    """Split points, and for each pair (i, j) the distances of split i to all entries of child j.

    Child j holds the entries that are nearer to split j than to any other;
    its ranges from the other splits hold split j too.  ``low`` is rounded
    down and ``high`` up.
    """

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[Node | None]


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    away = a - b
    return np.einsum("ij,ij->i", away, away)


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node | None:
    """The tree over rows of an integer array; small nodes have each member as a split point."""
    members = np.arange(len(entries)) if members is None else members
    if not len(members):
        return None
    points = entries[members]
    if len(members) <= LEAF:
        chosen = list(range(len(members)))
    else:
        # Each next split point is the farthest from those chosen.
        chosen, near = [0], _squared(points, points[:1])
        while len(chosen) < DEGREE and near.any():
            chosen.append(int(near.argmax()))
            near = np.minimum(near, _squared(points, points[chosen[-1:]]))
        # Equal entries can't be divided.
        chosen = sorted(chosen) if len(chosen) > 1 else list(range(len(members)))
    apart = np.stack([_squared(points, points[i : i + 1]) for i in chosen])
    owner = apart.argmin(axis=0)
    owner[chosen] = np.arange(len(chosen))
    split = np.zeros(len(members), dtype=bool)
    split[chosen] = True
    k = len(chosen)
    low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    roots = np.sqrt(apart.astype(np.float64))
    for i in range(k):
        for j in range(k):
            held = (owner == j) & ~split if i == j else owner == j
            if held.any():
                low[i, j] = roots[i, held].min() * (1 - _SLACK)
                high[i, j] = roots[i, held].max() * (1 + _SLACK)
    children = [build(entries, members[(owner == j) & ~split]) for j in range(k)]
    return Node(members[chosen], low, high, children)


def nearest(tree: Node, entries: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each query's nearest entry, ties to the lower index.

    Squared distances are integers and decide; roots only rule out children.
    A child goes only if even the least distance that its range allows, made
    smaller by more than any rounding, is strictly above the best one so far.
    """
    best = np.full(len(queries), np.iinfo(np.int64).max)
    index = np.full(len(queries), len(entries))

    def visit(node: Node, rows: np.ndarray) -> None:
        bound = np.zeros((len(rows), len(node.splits)))
        for i, entry in enumerate(node.splits):
            here = np.flatnonzero(bound[:, i] <= np.sqrt(best[rows]) * (1 + _SLACK))
            if not len(here):
                continue
            at = rows[here]
            apart = _squared(queries[at], entries[entry : entry + 1])
            closer = (apart < best[at]) | ((apart == best[at]) & (entry < index[at]))
            best[at[closer]], index[at[closer]] = apart[closer], entry
            root = np.sqrt(apart.astype(np.float64))[:, None]
            beyond = root * (1 - _SLACK) - node.high[i]
            before = node.low[i] - root * (1 + _SLACK)
            away = np.maximum(beyond, before) - _SLACK * root
            # Split i itself has just been compared, so its own range speaks for its child alone.
            bound[here] = np.maximum(bound[here], away)
        for j, child in enumerate(node.children):
            if child is not None:
                left = bound[:, j] <= np.sqrt(best[rows]) * (1 + _SLACK)
                if left.any():
                    visit(child, rows[left])

    visit(tree, np.arange(len(queries)))
    return index, best


class _Parts:
    """The codebooks of all parts with their trees."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.trees = [build(book) for book in books]

    def assign(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: the rows' values, their entries and squared distances."""
        width = self.books.shape[2]
        for p, tree in enumerate(self.trees):
            values = np.ascontiguousarray(vectors[:, p * width : (p + 1) * width])
            yield values, *nearest(tree, self.books[p], values)


def integers(column: pa.Array, dimension: int) -> np.ndarray:
    """Vectors as rows of floor(256 x); another length, or numbers too large for exact sums, are an error."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes != dimension).any():
        raise ValueError(f"vectors must all have {dimension} components, as the first one has")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(values * SCALE)
    # Then the squares of differences over all components fit into 63 bits.
    if len(scaled) and np.abs(scaled).max() >= np.sqrt(2.0**60 / max(dimension, 1)):
        raise ValueError("vector components are too large for exact 64-bit distances")
    return scaled.astype(np.int64).reshape(len(column), dimension)


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id``, ``label`` and ``vector`` of rows whose vector has components, all of them finite."""
    vector = vectors[vector_col]
    if type_of(vectors, vector_col) != "array<float>":
        vector = vector.cast("array<double>")
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = vectors.select(
        vectors[id_col].alias("id"), vectors[label_col].alias("label"), vector.alias("vector"), finite.alias("finite")
    )
    return rows.filter("finite and size(vector) > 0").drop("finite")


def _first(rows: DataFrame, entries: int, parts: int) -> np.ndarray:
    """Codebooks of the vectors with the smallest ids, ties by the vector, null ids last."""
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    taken = [r.vector for r in rows.select("id", "vector").orderBy(*order).limit(entries).collect()]
    if not taken:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    dimension = len(taken[0])
    if dimension % parts:
        raise ValueError(f"{dimension} components can't be cut into {parts} equal parts")
    whole = integers(pa.array(taken, pa.list_(pa.float64())), dimension)
    return whole.reshape(len(taken), parts, dimension // parts).transpose(1, 0, 2)


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """Sum and count per part, entry and place: one row for each of them and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, width = _Parts(books), books.shape[2]
        sums, counts = np.zeros(books.shape, dtype=np.int64), np.zeros(books.shape[:2], dtype=np.int64)
        for batch in batches:
            vectors = integers(batch.column(0), len(books) * width)
            for p, (values, index, _) in enumerate(parts.assign(vectors)):
                np.add.at(sums[p], index, values)
                counts[p] += np.bincount(index, minlength=books.shape[1])
        p, e, place = (x.ravel() for x in np.indices(books.shape))
        used = counts[p, e] > 0
        columns = [x[used] for x in (p, e, place, sums.ravel(), counts[p, e])]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["part", "entry", "place", "total", "n"])

    found = rows.select("vector").mapInArrow(run, "part long, entry long, place long, total long, n long")
    wide = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    return found.groupBy("part", "entry", "place").agg(wide, F.sum("n").alias("n"))


def train(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, place) of ``usable`` rows.

    Each round gives every part its nearest entry and moves an entry to the
    floor of the mean of its parts.  Tasks return sums; the driver sees one
    number per place of a codebook, however many vectors there are.
    """
    books = _first(rows, entries, parts)
    for _ in range(rounds if books.size else 0):
        moved = books.copy()
        for r in _sums(rows, books).collect():
            moved[r.part, r.entry, r.place] = int(r.total) // r.n
        books = moved
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``id``, ``label``, ``code`` (an entry per part) and ``error`` (their squared distances, added up)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _Parts(books)
        for batch in batches:
            vectors = integers(batch.column(2), books.shape[0] * books.shape[2])
            codes, errors = np.empty((len(vectors), len(books)), dtype=np.int32), np.zeros(len(vectors), dtype=np.int64)
            for p, (_, index, apart) in enumerate(parts.assign(vectors)):
                codes[:, p] = index
                errors += apart
            ends = np.arange(len(vectors) + 1, dtype=np.int32) * len(books)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), lists, pa.array(errors)], ["id", "label", "code", "error"]
            )

    schema = f"id {type_of(rows, 'id')}, label {type_of(rows, 'label')}, code array<int>, error bigint"
    return rows.select("id", "label", "vector").mapInArrow(run, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all rows of the label, null labels together.

    ``coded`` must be written already.  Errors are added per label first; the
    rows meet the sums by broadcast where these are few, else with salt.
    """
    name = F.coalesce(F.concat(F.lit("l"), F.col("label").cast("string")), F.lit("n"))
    sums = coded.groupBy(name.alias("group")).agg(F.sum("error").alias("label_error"))
    return look_up(coded.withColumn("group", name), staged(sums, "label_errors"), ["group"], "id", "left").drop("group")


class Compressed(NamedTuple):
    rows: DataFrame
    books: np.ndarray


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    entries: int = ENTRIES,
    parts: int = PARTS,
    rounds: int = ROUNDS,
) -> Compressed:
    """``rows`` (id, label, code, error, label_error) of every vector with numbers, and the ``books``.

    Rows whose vector is null, empty, or has a null or infinite component are
    left out.  Codebooks start from the vectors of the smallest ids (fewer,
    where there are fewer), equal ids in the order of their vectors, null ids
    last; repeated rows count as often as they occur.  All vectors must have
    one length, a multiple of ``parts``; an empty table has empty codebooks.
    Entries that are nearest to no part stay.  Other columns are ignored.
    Rows are written to the shared folder before each use, so a lost executor
    only re-reads files; sums are exact, so a repeated run gives equal codes.
    """
    rows = staged(usable(vectors, id_col, vector_col, label_col), "vectors")
    books = train(rows, entries, parts, rounds)
    coded = staged(encode(rows, books), "codes")
    return Compressed(with_label_errors(coded), books)


def restored(code: Column, books: np.ndarray) -> Column:
    """The vector that a code stands for, from the codebooks: entry by entry, scaled back."""
    table = F.array(*(F.array(*(F.array(*(F.lit(int(x)) for x in e)) for e in book)) for book in books))
    entry = F.transform(code, lambda e, p: F.get(F.get(table, p), e))
    return F.transform(F.flatten(entry), lambda x: (x + F.lit(0.5)) / F.lit(float(SCALE)))


def hex_codes(code: Column) -> Column:
    """Two lower-case hex digits for each part."""
    return F.array_join(F.transform(code, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
