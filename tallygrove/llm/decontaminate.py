"""Benchmark decontamination by winnowed word k-grams.

Words are hashed in numpy, many documents at once.  Of every sliding window of
k-gram hashes the least is a fingerprint, on both sides, so that each shared
span as long as the shortest benchmark window gives at least one common
fingerprint.  Fingerprints are joined; around each hit the full windows are
spelt out and joined as text, so hashes only nominate and never decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrove.llm.shared import in_pieces, look_up, map_texts, row_key, side_of, staged, text_of, type_of, without
from tallygrove.operators.joins import join_dimension

WINDOW = 13
GRAM = 5
# Benchmark fingerprints that may travel to the workers (8 bytes each); more are joined only.
MOST_SENT = 1_000_000

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IN_WORD = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _IN_WORD[_low : _high + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
# Odd multipliers of the rolling hashes; any would do.
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BLOCK = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_STEP)
    return x ^ (x >> np.uint64(29))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in lower-cased bytes, and where each begins.

    Letters are weighted by powers of an odd base, so that a word's sum is the
    difference of two prefix sums, moved to its first letter by the inverse.
    """
    edge = np.diff(_IN_WORD[data].view(np.int8), prepend=0, append=0)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.empty(len(starts), dtype=np.uint64)
    up = down = np.empty(0, np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(stops, starts[i] + _BLOCK, side="right")))
        low, high = starts[i], stops[j - 1]
        if high - low > len(up):
            up = _powers(_BASE, int(high - low))
            down = _powers(pow(_BASE, -1, 1 << 64), int(high - low))
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(data[low:high].astype(np.uint64) * up[: high - low], out=sums[1:])
        first, end = starts[i:j] - low, stops[i:j] - low
        out[i:j] = (sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64)
        i = j
    return _mixed(out), starts


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k following word hashes; position i holds words i to i + k - 1."""
    n = max(0, len(words) - k + 1)
    total = words[:n].copy()
    for j in range(1, k):
        total = (total * np.uint64(_STEP)) ^ words[j : j + n]
    return _mixed(total)


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the position of the least; the first of equals."""
    n = max(0, len(grams) - width + 1)
    best, least = np.arange(n), grams[:n].copy()
    for j in range(1, width):
        better = np.flatnonzero(grams[j : j + n] < least)
        best[better] = better + j
        least[better] = grams[better + j]
    return best


def plan_of(lengths: list[int], window: int = WINDOW, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(length, k, width) per window length: width k-grams span exactly ``length`` words."""
    return [(m, min(gram, m), m - min(gram, m) + 1) for m in sorted({min(x, window) for x in lengths})]


def _winnowed(
    texts: list[bytes], plan: list[tuple[int, int, int]], whole: bool
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text; then text number, hash, word position and window length of each fingerprint.

    ``whole``: only windows that are a whole text.
    """
    data = _LOWER[np.frombuffer(b" ".join(texts), dtype=np.uint8)]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    words, starts = word_hashes(data)
    text = np.searchsorted(begins, starts, side="right") - 1
    n_words = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    found = [[np.empty(0, np.int64)] * 4]
    for length, k, width in plan:
        best = winnow(gram_hashes(words, k), width)
        inside = text[: len(best)] == text[length - 1 :] if len(best) else np.empty(0, bool)
        if whole:
            inside &= n_words[text[: len(best)]] == length
        at = np.unique(best[inside])
        prints = (gram_hashes(words, k)[at] ^ np.uint64(length)).view(np.int64)
        found.append([text[at], prints, at - first[text[at]], np.full(len(at), length)])
    columns = [np.concatenate(x) for x in zip(*found, strict=True)]
    order = np.argsort(columns[0], kind="stable")
    return n_words, [x[order] for x in columns]


def _fingerprints(
    texts: DataFrame, plan: list[tuple[int, int, int]], sent: np.ndarray | None, whole: bool
) -> DataFrame:
    """(key, id, n_words, prints, places, lengths) per row of (key, id, text).

    ``sent``: the sorted fingerprints of interest, if they are few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 2):
            n_words, found = _winnowed(piece.column(2).cast(pa.binary()).to_pylist(), plan, whole)
            if sent is not None:
                near = np.minimum(np.searchsorted(sent, found[1]), len(sent) - 1)
                hit = sent[near] == found[1] if len(sent) else np.zeros(len(found[1]), bool)
                found = [x[hit] for x in found]
            ends = pa.array(np.searchsorted(found[0], np.arange(len(n_words) + 1)).astype(np.int32))
            kinds = (pa.int64(), pa.int32(), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x).cast(t)) for x, t in zip(found[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(n_words, pa.int64()), *lists],
                ["key", "id", "n_words", "prints", "places", "lengths"],
            )

    return map_texts(
        texts,
        run,
        f"key string, id {type_of(texts, 'id')}, n_words bigint, prints array<bigint>, "
        "places array<int>, lengths array<int>",
    )


def _flat(prints: DataFrame) -> DataFrame:
    each = F.explode(F.arrays_zip("prints", "places", "lengths")).alias("x")
    return prints.select("key", each).select(
        "key", F.col("x.prints").alias("print"), F.col("x.places").alias("place"), F.col("x.lengths").alias("length")
    )


def _windows_around(texts: DataFrame, gram: int) -> DataFrame:
    """(key, start, length, window): every window that holds the k-gram of a hit, spelt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 1):
            keys, starts, lengths, windows = [], [], [], []
            rows = zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True)
            for key, text, hits in rows:
                words = words_of(text)
                wanted = set()
                for hit in hits:
                    place, length = hit["place"], hit["length"]
                    first = max(0, place + min(gram, length) - length)
                    wanted.update((s, length) for s in range(first, min(place, len(words) - length) + 1))
                for start, length in sorted(wanted):
                    keys.append(key)
                    starts.append(start)
                    lengths.append(length)
                    windows.append(b" ".join(words[start : start + length]).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(windows, pa.string())],
                ["key", "start", "length", "window"],
            )

    return map_texts(texts, run, "key string, start bigint, length bigint, window string")


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item, window): the distinct windows of every item, spelt out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in in_pieces(batches, 1):
            names, windows = [], []
            for name, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                words = words_of(text)
                length = min(window, len(words))
                found = {b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)} if words else ()
                for x in found:
                    names.append(name)
                    windows.append(x.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(windows, pa.string())], ["item", "window"])

    return map_texts(items, run, "item string, window string").distinct()


def _covered(hits: DataFrame) -> DataFrame:
    """(key, n_hit): words covered by the hit windows of a document."""
    each = hits.select("key", "start", "length").distinct()
    spans = each.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("stop")))).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        fresh = F.greatest(x["stop"] - F.greatest(x["start"], acc["reach"]), F.lit(0))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["reach"], x["stop"]).alias("reach"))

    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("reach"))
    return spans.select("key", F.aggregate("spans", zero, step, lambda acc: acc["n"]).alias("n_hit"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """One row per document: key, id, n_words, n_hit, n_items, items, contaminated.

    A word is hit if it lies in an occurrence of ``window`` following words of
    an item; an item of fewer words is one window.  ``items`` lists the items
    found, sorted as strings.  A document is contaminated if a word is hit and
    at least a twentieth of its words are.  Null and empty texts have no
    words; items without words are found nowhere.  An item with a null id hits
    words like any other, but has no place in the list of ids.  Equal rows
    return equal results.
    """
    items = benchmark.select(benchmark[item_col].cast("string").alias("item"), text_of(benchmark, item_text_col).alias("text"))
    wanted = staged(_item_windows(items, window), "item_windows")
    sizes = wanted.select((F.length("window") - F.length(F.replace("window", F.lit(" "))) + 1).alias("m")).distinct()
    plan = plan_of([r.m for r in sizes.collect()], window, gram)  # at most ``window`` lengths

    texts = docs.select(
        row_key(docs, id_col, text_col).alias("key"), docs[id_col].alias("id"), text_of(docs, text_col).alias("text")
    )
    spelt = wanted.select(F.col("window").alias("key"), F.lit(None).cast("string").alias("id"), F.col("window").alias("text"))
    known = staged(_flat(_fingerprints(spelt, plan, None, True)).select("print").distinct(), "item_prints")
    few = known.limit(most_sent + 1).count() <= most_sent
    sent = np.sort(np.array([r["print"] for r in known.collect()], dtype=np.int64)) if few else None
    prints = staged(_fingerprints(texts, plan, sent, False), "prints")
    met = look_up(_flat(prints), known, ["print"], "key", "left_semi")
    hits = met.groupBy(F.col("key").alias("at")).agg(F.collect_set(F.struct("place", "length")).alias("hits"))
    hits = staged(hits, "hits")
    nominated = join_dimension(texts.select("key", "text"), side_of(hits), "key", "at", "inner")
    around = staged(_windows_around(nominated.select("key", "text", "hits"), gram).distinct(), "windows")
    found = staged(around.join(wanted.withColumnRenamed("window", "of"), F.col("window") == F.col("of")).select("key", "start", "length", "item"), "found")
    listed = found.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    facts = staged(_covered(found).join(listed, "key").select(F.col("key").alias("at"), "n_hit", "items"), "facts")
    out = prints.select("key", "id", "n_words").join(facts, F.col("key") == F.col("at"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    found_items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "key", "id", "n_words", n_hit.alias("n_hit"), F.size(found_items).cast("bigint").alias("n_items"),
        found_items.alias("items"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The documents without the contaminated ones; columns and texts stay."""
    found = contamination(docs, benchmark, id_col, text_col, **options)
    return without(docs, found.filter("contaminated").select("key"), id_col, text_col)
