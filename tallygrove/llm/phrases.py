"""Phrase mining: an FM-index per shard, read both ways, gives n-grams with their counts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.llm.shared import in_pieces, look_up, map_texts, scratch_path, side_of, staged, text_of
from tallygrove.operators.joins import join_dimension

# Fixed by the contract.
SHORTEST, LONGEST, LEAST, FIRST = 2, 5, 100, 2000
NO_LANGUAGE = "und"

# Words from which a shard is closed.
SHARD_WORDS = 1 << 19
# Hashes of frequent pairs that go to every worker at once; more of them are joined to the shards.
MOST_SENT = 1_000_000
# A row holds a whole index: the writer looks at sizes after each row.
_FEW_ROWS = {"parquet.block.size": str(32 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}

# Byte classes: no UTF-8 text holds 0xFF, so it can stand for the end of a piece.
_END = b"\xff"
_BYTES = bytes(_END[0] if chr(b) in ".,;:!?\n\v\f\r" else b for b in range(256))

INDEX = "shard string, lang string, n_words bigint, words array<string>, before binary, after binary"


class Words(dict):
    """Numbers for words in the order they come; 0 is the end of a piece."""

    def __init__(self):
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def numbered(text: str, words: Words) -> np.ndarray:
    """The words of a text, lower-cased in A-Z, as numbers; each piece begins with 0."""
    raw = text.encode("utf-8", "surrogatepass").lower().translate(_BYTES)
    found = raw.replace(_END, b" \xff ").split()
    out = np.fromiter(map(words.__getitem__, found), np.int32, len(found))
    return np.concatenate([np.zeros(1, np.int32), out])


def _sorted_suffixes(symbols: np.ndarray) -> np.ndarray:
    """Places of the cyclic text in the order of the ``LONGEST`` symbols from there on."""
    wide = symbols.astype(np.int64)
    ahead = [np.roll(wide, -k) for k in range(LONGEST)]
    bits = int(wide.max()).bit_length() + 1
    keys, key, used = [], ahead[0], bits
    for part in ahead[1:]:
        if used + bits > 63:
            keys.append(key)
            key, used = part, bits
        else:
            key, used = key << bits | part, used + bits
    return np.lexsort([key, *reversed(keys)])


def transform(symbols: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform, rows ordered by their first ``LONGEST`` symbols.

    Rows that agree in more symbols than that are never told apart, because no
    longer pattern is asked for; intervals of patterns up to that length are
    the same as in the full order.
    """
    return symbols[_sorted_suffixes(symbols) - 1]


class Grams(NamedTuple):
    """Distinct n-grams of a shard: their words, and their rows in both transforms."""

    words: np.ndarray
    low: np.ndarray
    low_back: np.ndarray
    count: np.ndarray


class Index:
    """A text of numbered words as two transforms: ``before`` gives left neighbours, ``after`` right ones.

    ``after`` is the transform of the reversed text.  A pattern is a range of
    rows in ``before`` and, reversed, one of equal length in ``after``.
    """

    def __init__(self, before: np.ndarray, after: np.ndarray):
        self.sides = {"left": before, "right": after}
        self.counts = np.bincount(before)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self._places: dict[str, np.ndarray] = {}

    @classmethod
    def of(cls, symbols: np.ndarray) -> Index:
        return cls(transform(symbols), transform(symbols[::-1]))

    def _place(self, side: str) -> np.ndarray:
        """Per row: where the row with its neighbour put in front is, C[c] + occ(c, row)."""
        if side not in self._places:
            order = np.argsort(self.sides[side], kind="stable")
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            self._places[side] = place
        return self._places[side]

    def single(self) -> Grams:
        """All words (not the ends of pieces)."""
        words = np.flatnonzero(self.counts[1:]) + 1
        low = self.starts[words]
        return Grams(words[:, None], low, low.copy(), self.counts[words])

    def extend(self, grams: Grams, side: str, pair=None) -> Grams:
        """The n-grams one word longer on a side, with counts and both ranges.

        The neighbours in a gram's rows are its extensions.  On this side the
        longer gram's rows begin where its first row is mapped to; on the other
        they follow those of smaller neighbours.  With ``pair``, only words for
        which ``pair`` of (gram, word) holds are taken.
        """
        low, back = (grams.low, grams.low_back) if side == "left" else (grams.low_back, grams.low)
        owner = np.repeat(np.arange(len(low)), grams.count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(grams.count) - grams.count, grams.count)
        row = low[owner] + offset
        word = self.sides[side][row].astype(np.int64)
        order = np.argsort(owner * np.int64(len(self.counts)) + word, kind="stable")
        owner, word, row = owner[order], word[order], row[order]
        new = np.ones(len(owner), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (word[1:] != word[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(owner)))
        owner, word, row = owner[first], word[first], row[first]
        # Rows are in the order of owner and word: what lies between is smaller neighbours.
        smaller = first - (np.cumsum(grams.count) - grams.count)[owner]
        keep = word > 0
        if pair is not None:
            keep &= pair(grams.words[owner, 0 if side == "left" else -1], word)
        owner, word, row = owner[keep], word[keep], row[keep]
        here, there = self._place(side)[row].astype(np.int64), back[owner] + smaller[keep]
        both = [word[:, None], grams.words[owner]]
        longer = np.concatenate(both if side == "left" else both[::-1], axis=1)
        ranges = (here, there) if side == "left" else (there, here)
        return Grams(longer, *ranges, count[keep])


def _word_hashes(lang: str, words: list[str]) -> np.ndarray:
    """A 64-bit hash for each word of a language; 0 for the end of a piece."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([0, *(xxhash.xxh64_intdigest(w.encode(), seed) for w in words)], dtype=np.uint64)


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def index_shards(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", shard_words: int = SHARD_WORDS
) -> DataFrame:
    """One row per shard: its language, number of words, distinct words and both transforms.

    A shard holds consecutive texts of a language in one task, up to about
    ``shard_words`` words (a single text is not divided).  The row is the whole
    index; the texts are not read again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, tuple[Words, list[np.ndarray]]] = {}
        sizes: dict[str, int] = {}
        task, closed = TaskContext.get().partitionId(), 0

        def close(lang: str) -> pa.RecordBatch:
            nonlocal closed
            words, parts = open_shards.pop(lang)
            symbols = np.concatenate(parts)
            index = Index.of(symbols)
            name, closed = f"{task}-{closed}", closed + 1
            row = {
                "shard": name, "lang": lang, "n_words": int((symbols > 0).sum()),
                "words": [w.decode("utf-8", "surrogatepass") for w in words if w != _END],
                "before": index.sides["left"].tobytes(), "after": index.sides["right"].tobytes(),
            }
            sizes.pop(lang)
            return pa.RecordBatch.from_pylist([row])

        for piece in in_pieces(batches, 1):
            for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                words, parts = open_shards.setdefault(lang, (Words(), []))
                parts.append(numbered(text, words))
                sizes[lang] = sizes.get(lang, 0) + len(parts[-1])
                if sum(sizes.values()) >= 2 * shard_words:
                    yield close(max(sizes, key=sizes.get))
                elif sizes[lang] >= shard_words:
                    yield close(lang)
        for lang in list(open_shards):
            yield close(lang)

    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANGUAGE))
    return map_texts(docs.select(lang.alias("lang"), text_of(docs, text_col).alias("text")), run, INDEX)


def _shards(batch: pa.RecordBatch) -> Iterator[tuple[str, str, list[str], Index, int]]:
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k] for name in ("shard", "lang", "words", "before", "after")}
        before, after = (np.frombuffer(row[s].as_buffer(), dtype=np.int32) for s in ("before", "after"))
        yield row["shard"].as_py(), row["lang"].as_py(), row["words"].as_py(), Index(before, after), k


def pair_counts(index: DataFrame) -> DataFrame:
    """``pair`` (a hash of language and two words), ``shard`` and the pair's count in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, words, found, _ in _shards(batch):
                hashes = _word_hashes(lang, words)
                pairs = found.extend(found.single(), "left")
                keys = _pair_hash(hashes[pairs.words[:, 0]], hashes[pairs.words[:, 1]])
                columns = [pa.array(keys), pa.array([shard] * len(keys)), pa.array(pairs.count)]
                yield pa.RecordBatch.from_arrays(columns, ["pair", "shard", "n"])

    return index.mapInArrow(run, "pair bigint, shard string, n bigint")


def counted_grams(index: DataFrame, sent: np.ndarray | None = None, longest: int = LONGEST) -> DataFrame:
    """(lang, length, phrase, n) of each shard's words, and of its longer grams of frequent pairs.

    ``sent`` holds the hashes of pairs that may be frequent; without it, the
    column ``pairs`` of ``index`` has those that occur in the shard.  A phrase
    is as rare as its rarest pair, so longer ones are reached from these alone,
    by turns on the left and on the right.
    """
    everywhere = None if sent is None else index.sparkSession.sparkContext.broadcast(np.sort(sent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, lang, words, found, k in _shards(batch):
                hashes = _word_hashes(lang, words)
                if everywhere is not None:
                    known = everywhere.value
                else:
                    listed = batch.column("pairs")[k].values
                    known = np.zeros(0, np.int64) if listed is None else np.sort(listed.to_numpy())
                names = np.array(["", *words], dtype=object)

                def among(keys: np.ndarray, known=known) -> np.ndarray:
                    at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                    return known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)

                def right(last, word, hashes=hashes, among=among):
                    return among(_pair_hash(hashes[last], hashes[word]))

                def left(first, word, hashes=hashes, among=among):
                    return among(_pair_hash(hashes[word], hashes[first]))

                grams = found.single()
                for length in range(1, longest + 1):
                    if length > 1:
                        side = "left" if length % 2 == 0 else "right"
                        grams = found.extend(grams, side, pair=left if side == "left" else right)
                    if not len(grams.count):
                        break
                    phrases = names[grams.words[:, 0]]
                    for column in range(1, length):
                        phrases = phrases + " " + names[grams.words[:, column]]
                    n = len(phrases)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * n), pa.array(np.full(n, length, np.int32)), pa.array(phrases, pa.string()), pa.array(grams.count)],
                        ["lang", "length", "phrase", "n"],
                    )

    return index.mapInArrow(run, "lang string, length int, phrase string, n bigint")


def frequent_grams(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    shard_words: int = SHARD_WORDS,
    most_sent: int = MOST_SENT,
) -> tuple[DataFrame, DataFrame]:
    """Grams (lang, length, phrase, f) of up to ``LONGEST`` words with f >= ``least``, and words per lang."""
    index = index_shards(docs, text_col, lang_col, shard_words)
    path = scratch_path(docs.sparkSession, "shards")
    index.write.options(**_FEW_ROWS).parquet(path)
    index = docs.sparkSession.read.schema(index.schema).parquet(path)
    pairs = pair_counts(index)
    total = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    # Hashes only nominate: a pair that shares its hash with another is counted as text below.
    nominated = staged(total.filter(F.col("n") >= least).select("pair"), "pairs")
    if nominated.count() <= most_sent:
        # Eight bytes each on the way through the driver, where a million rows took 200 MB.
        sent = nominated.toArrow().column("pair").to_numpy()
        counts = counted_grams(index, sent)
    else:
        per_shard = look_up(pairs.select("pair", "shard"), nominated, ["pair"], "shard", "left_semi")
        own = per_shard.groupBy(F.col("shard").alias("of")).agg(F.collect_list("pair").alias("pairs"))
        counts = counted_grams(index.join(own, F.col("shard") == F.col("of"), "left").drop("of"))
    counted = counts.groupBy("lang", "length", "phrase").agg(F.sum("n").alias("f"))
    grams = staged(counted.filter(F.col("f") >= least), "grams")
    words = index.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return grams, staged(words, "languages")


def _cut_scores(grams: DataFrame, words: DataFrame) -> DataFrame:
    """The lowest-scoring cut of each candidate: (lang, phrase, a, l, r, n, score)."""
    candidates = grams.filter(F.col("length") >= SHORTEST)
    parts = F.split("phrase", " ")
    cut = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "length",
        F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("tail"),
    )
    for part, name in (("head", "l"), ("tail", "r")):
        side = grams.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("f").alias(name))
        # Grams grow with the corpus; the driver must not build them because their files are small.
        side = side.hint("merge")
        met = (F.col("lang") == F.col("__lang")) & (F.col(part) == F.col("__part"))
        cut = cut.join(side, met).drop("__lang", "__part")
    sums = words.select(F.col("lang").alias("__lang"), "n")
    cut = join_dimension(cut, side_of(sums), "lang", "__lang", "inner").drop("__lang")
    whole = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r", "n")}
    # Products take up to 38 digits; `div` of decimals is exact and goes down.
    cut = cut.withColumns({f"__{c}": x for c, x in whole.items()})
    cut = cut.withColumn("score", F.expr("(1000 * __a * __n) div (__l * __r)").cast("bigint"))
    best = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    return cut.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def _contained(grams: DataFrame) -> DataFrame:
    """Candidates that occur only inside one that is a word longer, as (lang, inner).

    If a candidate is as frequent as a longer one around it, so is every one
    between them; extensions by one word therefore decide.
    """
    longer = grams.filter(F.col("length") > SHORTEST)
    parts = F.split("phrase", " ")
    inner = F.array(*(F.array_join(F.slice(parts, F.lit(at), F.col("length") - 1), " ") for at in (1, 2)))
    spread = longer.select("lang", F.explode(inner).alias("inner"), "f")
    return spread.groupBy("lang", "inner").agg(F.max("f").alias("most"))


def phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    first: int = FIRST,
    shard_words: int = SHARD_WORDS,
    most_sent: int = MOST_SENT,
) -> DataFrame:
    """The ``first`` phrases of each language by score: lang, rank, phrase, a, l, r, n, score.

    A phrase is 2 to 5 words of one piece that occur ``least`` times or more in
    the language; a null language is ``und``, null texts are empty.  Its score
    compares its count with those of its two parts at the worst cut.  Ties go
    by count, then by the phrase's bytes.  Repeated rows count as often as they
    occur; other columns are ignored; an empty table gives no rows.

    Each shard's counts come from its index; only (phrase, count) rows are
    shuffled, reduced per task first.  Counts are exact: hashes of word pairs
    decide which grams a shard lists, phrases are summed as text.  Up to
    ``most_sent`` of these hashes (8 bytes each) go to every worker; more are
    joined to the shards, with the same result.
    """
    grams, words = frequent_grams(docs, text_col, lang_col, least, shard_words, most_sent)
    scored = _cut_scores(grams, words)
    around = _contained(grams).select(F.col("lang").alias("__lang"), "inner", "most")
    inside = (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("inner")) & (F.col("most") >= F.col("a"))
    left = scored.join(around.hint("merge"), inside, "left_anti")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
