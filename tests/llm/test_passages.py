"""Repeated passages that begin and end inside lines."""

import re

import numpy as np
import pytest

from tallygrove.llm import passage_dedup
from tallygrove.llm.queries import QUERIES
from tests.conftest import SMALL, plan_of
from tests.llm import brute

PASSAGE = " ".join(f"p{i}" for i in range(55))


def cut(docs, min_words):
    """docs: (id, text) with distinct ids -> {id: (words left, words gone)}."""
    first, out = {}, {}
    for i, text in sorted(docs):
        words, gone = brute.words(text), set()
        for a in range(len(words) - min_words + 1):
            if first.setdefault(tuple(words[a : a + min_words]), (i, a)) != (i, a):
                gone.update(range(a, a + min_words))
        out[i] = ([w for k, w in enumerate(words) if k not in gone], len(gone))
    return out


def answer(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return passage_dedup.passage_dedup(docs, **options)


def test_passage_inside_lines(spark):
    broken = PASSAGE.replace("p20 ", "p20\n")
    rows = [
        (1, f"one two {PASSAGE} three"), (2, f"first\nfour {PASSAGE} five\nlast "), (3, f"six {broken} seven"),
        (4, " ".join(PASSAGE.split()[:49])), (5, None), (6, ""), (7, " ".join(["q"] * 70)),
    ]
    got = {r.doc_id: (r.text, r.n_removed_words) for r in answer(spark, rows).collect()}
    assert got == {
        1: (rows[0][1], 0), 2: ("first\nfour five\nlast ", 55), 3: ("six\n seven", 55),
        4: (rows[3][1], 0), 5: (None, 0), 6: ("", 0), 7: ("q", 69),
    }


@pytest.mark.parametrize("seed, min_words", [(0, 12), (1, 5), (2, 23)])
def test_passages_random(spark, seed, min_words):
    """Few words and pieces, so that windows overlap, repeat inside a document and in others."""
    rng = np.random.default_rng(seed)
    pool = [" ".join(rng.choice(["a", "b", "c\n", "d"], int(n))) for n in rng.integers(1, 30, 30)]
    rows = [(i, " ".join(rng.choice(pool, int(rng.integers(0, 12))))) for i in range(40)]
    got = {r.doc_id: (brute.words(r.text), r.n_removed_words) for r in answer(spark, rows, min_words=min_words).collect()}
    assert got == cut(rows, min_words)


def test_passage_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    out = QUERIES["op1_passage_dedup"](spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", plan_of(out))
    got = {r.doc_id: (brute.words(r.text), r.n_removed_words) for r in out.collect()}
    assert got == cut([(r.doc_id, r.text) for r in docs], 50)
