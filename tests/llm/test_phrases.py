"""Phrase mining against plain counting, and the index against its text."""

import re
from collections import Counter

import numpy as np
import pytest

from tallygrove.llm import phrases
from tallygrove.llm.phrases import Index, Words, numbered
from tests.llm.brute import ascii_lower


def pieces(text):
    parts = re.split("[.,;:!?\n\x0b\x0c\r]", ascii_lower(text))
    return [p for p in (re.findall("[^ \t]+", x) for x in parts) if p]


def mined(rows, least, first):
    """rows: (lang, text) -> the rows that ``phrases`` returns."""
    out = []
    counts, sizes = {}, Counter()
    for lang, text in rows:
        for words in pieces(text):
            sizes[lang or "und"] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(words[i : i + k])] += 1
    for lang, f in counts.items():
        n, found = sizes[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = {
            (p[i : i + k], a)
            for p, a in candidates.items()
            for k in range(2, len(p))
            for i in range(len(p) - k + 1)
        }
        for p, a in candidates.items():
            if (p, a) in hidden:
                continue
            score, _, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("sent", [1_000_000, 0])
@pytest.mark.parametrize("seed", range(3))
def test_phrases_random(spark, seed, sent):
    """Few words, many shards; both ways of telling shards which pairs are frequent."""
    rng = np.random.default_rng(seed)
    pool = ["Ab", "é", "c", "C", "d\x1c", "ß", ".", ",", "\n", "\t", " ", "x y z"]
    rows = [(rng.choice(["en", "de"]) if i % 7 else None, " ".join(rng.choice(pool, 60))) for i in range(120)]
    docs = spark.createDataFrame([(str(a) if a else None, b) for a, b in rows], "lang string, text string").repartition(5)
    wanted = mined(rows, 6, 40)
    assert len(wanted) > 60
    got = phrases.phrases(docs, least=6, first=40, shard_words=200, most_sent=sent)
    assert as_rows(got) == wanted


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows, ties, clashing names, no rows."""
    schema = "doc_id long, text string, lang string, shard string, pair int, n int, words string, rank int"
    long = "one two three " * 40_000
    rows = [(1, None, "en"), (2, "", None), (None, " .,\n", "en"), (3, "a b. a b", None), (3, "a b. a b", "und"), (4, long, "xx"), (5, "q" * 100_000, "en")]
    docs = spark.createDataFrame([(*r, "s", 1, 2, "w", 3) for r in rows], schema)
    got = as_rows(phrases.phrases(docs, least=4))
    assert got == mined([(lang, text or "") for _, text, lang in rows], 4, 2000)
    assert ("und", 1, "a b", 4, 4, 4, 8, 2000) in got
    assert phrases.phrases(docs.limit(0)).count() == 0


def test_ties_go_by_bytes(spark):
    text = " . ".join(["ä b", "z b", "Z c", "𝒳 d", "豈 d"] * 3)
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    assert as_rows(phrases.phrases(docs, least=3)) == mined([("en", text)], 3, 2000)


def test_index_extends_both_ways():
    """Every n-gram has its count and, in both transforms, the rows of its occurrences."""
    rng = np.random.default_rng(8)
    words = Words()
    symbols = np.concatenate([numbered(" ".join(rng.choice(list("abc."), 50)), words) for _ in range(4)])
    index = Index.of(symbols)
    grams = index.single()
    for length, side in enumerate(("left", "right", "right", "left"), start=2):
        grams = index.extend(grams, side)
        plain = Counter(
            w for i in range(len(symbols)) if 0 not in (w := tuple(int(symbols[(i + k) % len(symbols)]) for k in range(length)))
        )
        assert {tuple(map(int, w)): int(n) for w, n in zip(grams.words, grams.count, strict=True)} == plain
        for back, low, turned in ((False, grams.low, symbols), (True, grams.low_back, symbols[::-1])):
            order = phrases._sorted_suffixes(turned)
            for w, at, n in zip(grams.words, low, grams.count, strict=True):
                pattern = list(w[::-1] if back else w)
                starts = order[at : at + n]
                assert all([int(turned[(s + k) % len(turned)]) for k in range(length)] == pattern for s in starts)


def test_hot_pair_and_language(spark):
    """One pair is a third of all words in one language that holds almost all rows."""
    rng = np.random.default_rng(2)
    rows = [("en" if i % 50 else "fr", "hot pair " * 20 + " ".join(rng.choice(list("klmnop"), 80))) for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert as_rows(phrases.phrases(docs, least=100, shard_words=500)) == mined(rows, 100, 2000)
