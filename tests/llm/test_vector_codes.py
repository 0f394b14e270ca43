"""Vector codes against plain numpy, and the tree against all distances."""

import hashlib

import numpy as np
import pytest

from tallygrove.llm import vector_codes
from tallygrove.llm.queries import QUERIES
from tests.conftest import SMALL


def coded(vectors, entries=64, parts=16, rounds=2):
    """vectors: (id, floats, label) in the order of ids -> codes, errors, books."""
    whole = np.floor(np.array([v for _, v, _ in vectors], dtype=np.float64) * 256).astype(np.int64)
    split = np.stack(np.split(whole, parts, axis=1))
    books = split[:, :entries].copy()

    def assign():
        apart = ((split[:, :, None] - books[:, None]) ** 2).sum(3)
        return apart.argmin(2), apart.min(2)

    for _ in range(rounds):
        codes, _ = assign()
        for p in range(parts):
            for e in set(codes[p]):
                own = split[p][codes[p] == e]
                books[p, e] = [int(s) // len(own) for s in own.sum(0)]
    codes, apart = assign()
    return codes.T.tolist(), apart.sum(0).tolist(), books


@pytest.mark.parametrize("scale", [2, 6, 60, 10**6])
def test_nearest_by_the_tree(scale):
    """Small scales give ties and equal entries; the lower index wins."""
    rng = np.random.default_rng(scale)
    for _ in range(40):
        n, width = int(rng.integers(1, 90)), int(rng.integers(1, 6))
        entries, queries = rng.integers(-scale, scale + 1, (n, width)), rng.integers(-scale, scale + 1, (200, width))
        apart = ((queries[:, None] - entries[None]) ** 2).sum(2)
        index, best = vector_codes.nearest(vector_codes.build(entries), entries, queries)
        assert (index == apart.argmin(1)).all() and (best == apart.min(1)).all()


def test_tree_leaves_out_subtrees():
    """Far clusters are never compared member by member."""
    rng = np.random.default_rng(1)
    entries = np.concatenate([rng.integers(0, 50, (30, 3)) + 100_000 * k for k in range(6)])
    tree = vector_codes.build(entries)
    calls = []
    plain = vector_codes._squared

    def counted(a, b):
        calls.append(len(a))
        return plain(a, b)

    vector_codes._squared = counted
    try:
        vector_codes.nearest(tree, entries, entries[:30])
    finally:
        vector_codes._squared = plain
    assert sum(calls) < 0.5 * 30 * len(entries)


def test_equal_entries_make_a_tree():
    entries = np.zeros((3000, 2), dtype=np.int64)
    index, best = vector_codes.nearest(vector_codes.build(entries), entries, entries[:3] + 1)
    assert index.tolist() == [0, 0, 0] and best.tolist() == [2, 2, 2]


def result(spark, rows, **options):
    schema = "vec_id long, embedding array<float>, label int, id long, code string, error int, group int"
    full = [(*r, 1, "c", 2, 3) for r in rows]
    out = vector_codes.compress(spark.createDataFrame(full, schema), **options)
    return out.rows.collect(), out.books


def test_random_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.02, 32).astype(np.float32)], int(i % 3)) for i in range(300)]
    got, books = result(spark, rows)
    codes, errors, wanted = coded(rows)
    assert (books == wanted).all()
    assert {r.id: (r.code, r.error) for r in got} == {v[0]: (c, e) for v, c, e in zip(rows, codes, errors, strict=True)}
    sums = {k: sum(e for v, e in zip(rows, errors, strict=True) if v[2] == k) for k in range(3)}
    assert all(r.label_error == sums[r.label] for r in got)


def test_odd_rows(spark):
    """Null and infinite components go; null ids and labels, repeated rows, ties, few rows, no rows."""
    nan, inf = float("nan"), float("inf")
    good = [float(x) / 100 for x in range(16)]
    rows = [
        (1, None, 0), (2, [nan, *good[1:]], 0), (3, [*good[1:], inf], 0), (4, [*good[1:], None], 0), (5, [], 0),
        (7, good, None), (6, good, 1), (6, good, 1), (None, good[::-1], None), (8, [-x for x in good], 2),
    ]
    got, books = result(spark, rows)
    kept = [rows[6], rows[7], rows[5], rows[9], rows[8]]
    codes, errors, wanted = coded(kept)
    assert (books == wanted).all()
    key = lambda x: str(x)
    assert sorted(((r.id, r.label, r.code, r.error) for r in got), key=key) == sorted(
        ((v[0], v[2], c, e) for v, c, e in zip(kept, codes, errors, strict=True)), key=key
    )
    for r in got:
        assert r.label_error == sum(e for v, e in zip(kept, errors, strict=True) if v[2] == r.label)
    none, books = result(spark, rows[:5])
    assert none == [] and books.size == 0


def test_other_lengths_and_sizes_are_an_error(spark):
    with pytest.raises(ValueError, match="16 equal"):
        result(spark, [(1, [0.5] * 15, 0)])
    with pytest.raises(Exception, match="must all have 16"):
        result(spark, [(1, [0.5] * 16, 0), (2, [0.5] * 32, 0)])
    with pytest.raises(Exception, match="too large"):
        result(spark, [(1, [0.5] * 16, 0), (2, [1e30] * 16, 0)])


def test_query_against_numpy(spark):
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    codes, errors, books = coded([(r.vec_id, r.embedding, r.label) for r in table])
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    got = {r.vec_id: r for r in QUERIES["op12_vector_codes"](spark, SMALL).collect()}
    assert len(got) == len(table)
    for r, code, error in zip(table, codes, errors, strict=True):
        assert got[r.vec_id].code == "".join(f"{e:02x}" for e in code)
        assert got[r.vec_id].error == error and got[r.vec_id].codebooks_sha256 == digest
    back = spark.createDataFrame([(codes[0],)], "code array<int>").select(vector_codes.restored(F.col("code"), books)).first()[0]
    # Each integer stands for the middle of its 1/256.
    assert back == [(books[p][e][k] + 0.5) / 256 for p, e in enumerate(codes[0]) for k in range(books.shape[2])]
    away = sum((int(np.floor(a * 256)) - int(np.floor(b * 256))) ** 2 for a, b in zip(table[0].embedding, back, strict=True))
    assert away == errors[0]
