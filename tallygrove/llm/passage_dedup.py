"""Deduplication of repeated passages of words, wherever in a line they begin and end.

Word hashes are joined to hashes of longer spans by doubling.  Of each window
of ``min_words`` words the least hash of its k-grams is the fingerprint, so
equal windows have equal ones; following windows with one fingerprint are a
run.  Only runs whose fingerprint is met at two places are spelt out into
window hashes, which are compared with their earliest equal in the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.llm.line_dedup import MIN_WORDS
from tallygrove.llm.shared import SPACE, WORD, let, look_up, row_key, side_of, staged, text_of
from tallygrove.operators.joins import join_dimension

GRAM = 8


def _paired(values: Column, shift: int, both: Callable[[Column, Column], Column]) -> Column:
    """``both`` of each value and the one ``shift`` places on."""

    def pairs(v: Column) -> Column:
        n = F.greatest(F.size(v) - shift, F.lit(0))
        return F.zip_with(F.slice(v, F.lit(1), n), F.slice(v, F.lit(shift + 1), n), lambda x, y: both(x, y))

    return let(values, pairs)


def _spanned(values: Column, width: int, both: Callable[[Column, Column], Column]) -> Column:
    """``both`` over each ``width`` following values: by doubling, then two spans that overlap."""
    n = 1
    while 2 * n <= width:
        values, n = _paired(values, n, both), 2 * n
    return values if n == width else _paired(values, width - n, both)


def _word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _runs(texts: DataFrame, min_words: int) -> DataFrame:
    """(id, key, f, from, to, own): fingerprint and the first and last window start of each run.

    ``own``: the k-gram is met twice inside the run, so that its windows may equal each other.
    """
    gram = min(GRAM, min_words)
    width = min_words - gram + 1
    grams = texts.select("id", "key", _spanned(_word_hashes(F.col("text")), gram, F.xxhash64).alias("grams"))
    twice = F.size(F.array_distinct("grams")) < F.size("grams")
    least = grams.select(
        "id", "key", F.when(twice, F.col("grams")).alias("grams"), _spanned(F.col("grams"), width, F.least).alias("least")
    ).filter("size(least) > 0")
    # The place before the first window and after the last are edges as well.
    n = F.size("least")
    edges = F.filter(
        F.sequence(F.lit(0), n), lambda i: (i == 0) | (i == n) | (F.get("least", i) != F.get("least", i - 1))
    )
    opened = least.select("id", "key", "grams", "least", edges.alias("edges"))

    def run(e: Column, k: Column) -> Column:
        f, past = F.get("least", e), F.get("edges", k + 1)
        met = F.filter(F.slice("grams", e + 1, past - e + width - 1), lambda g: g == f)
        own = F.when(F.col("grams").isNull(), False).otherwise(F.size(met) > 1)
        return F.struct(f.alias("f"), e.alias("from"), (past - 1).alias("to"), own.alias("own"))

    each = F.transform(F.slice("edges", F.lit(1), F.size("edges") - 1), run)
    return opened.select("id", "key", F.explode(each).alias("run")).select("id", "key", "run.*")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Word ranges to delete: (key, first, last), words counted from 0, disjoint within a document."""
    key = F.xxhash64(row_key(docs, id_col, text_col))
    texts = docs.select(docs[id_col].alias("id"), key.alias("key"), text_of(docs, text_col).alias("text"))
    # Rows equal in id and text give equal runs.
    runs = staged(_runs(texts, min_words).dropDuplicates(["key", "from"]), "passage_runs")
    place = F.xxhash64("key", "from")
    met = runs.groupBy("f").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("own").alias("own"))
    met = staged(met.filter("a != b or own").select("f"), "passage_met")
    candidates = look_up(runs, met, ["f"], "key", "left_semi")
    by_text = candidates.groupBy(F.col("key").alias("of")).agg(F.collect_list(F.struct("f", "from", "to")).alias("runs"))
    hit = join_dimension(texts, side_of(staged(by_text, "passage_candidates")), "key", "of", "inner")
    hashed = hit.select("id", "key", _word_hashes(F.col("text")).alias("words"), "runs")
    cut = hashed.select(
        "id", "key",
        F.explode(F.transform("runs", lambda r: F.struct(
            r["f"].alias("f"), r["from"].alias("from"),
            F.slice("words", r["from"] + 1, r["to"] - r["from"] + min_words).alias("words"),
        ))).alias("run"),
    )
    spelt = cut.select(
        "id", "key", "run.f", "run.from", F.posexplode(_spanned(F.col("run.words"), min_words, F.xxhash64)).alias("k", "r")
    )
    windows = staged(spelt.select("id", "key", "f", "r", (F.col("from") + F.col("k")).alias("at")), "passage_windows")
    # Equal rows spell equal windows out; their positions are the same.
    position = F.struct("id", "key", "at")
    equal = windows.groupBy("f", "r").agg(F.min(position).alias("origin"), F.max(position).alias("other"))
    earliest = staged(equal.filter("not (origin <=> other)").drop("other"), "passage_earliest")
    later = look_up(windows, earliest, ["f", "r"], "key", "inner").filter(~position.eqNullSafe(F.col("origin")))
    by_place = Window.partitionBy("key").orderBy("at")
    opens = F.col("at") - F.lag("at").over(by_place) > min_words
    island = F.sum(F.coalesce(opens.cast("int"), F.lit(1))).over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    return later.select("key", "at").distinct().withColumn("island", island).groupBy("key", "island").agg(
        F.min("at").alias("first"), (F.max("at") + min_words - 1).alias("last")
    ).drop("island")


def _without(text: Column, ranges: Column) -> Column:
    """The text without the words in the ascending, disjoint ranges and the space before each.

    A range that goes on from one line to another leaves a line break behind.
    """

    def rest(words: Column) -> Column:
        def piece(k: Column) -> Column:
            begin = F.when(k == 0, 0).otherwise(F.get(ranges, k - 1)["last"] + 1)
            stop = F.coalesce(F.get(ranges, k)["first"], F.size(words))
            kept = F.array_join(F.slice(words, begin + 1, stop - begin), "")
            start = F.get(ranges, k - 1)["first"]
            gone = F.array_join(F.slice(words, start + 1, begin - start), "")
            broken = (k > 0) & F.contains(gone, F.lit("\n")) & ~kept.rlike(r"^[\x20\x09-\x0D]*\n")
            return F.concat(F.when(broken & (kept != ""), "\n").otherwise(""), kept)

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(ranges)), piece), "")

    tail = F.regexp_extract(text, rf"({SPACE})?\z", 1)
    tokens = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*+" + WORD), F.lit(0))
    return F.when(ranges.isNull(), text).otherwise(F.concat(let(tokens, rest), tail))


def passage_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents with repeated passages deleted, and ``n_removed_words``.

    A word is deleted if it lies in ``min_words`` following words that also
    begin earlier: in a document of smaller id (null ids first), or further up
    in its own.  Lines and sentences play no part.  Texts without repeats, null
    and empty ones return unchanged.  Rows equal in id and text are one
    document and return equal.  All columns are kept; only the text changes
    (and a column named like the count, which it replaces).
    """
    ranges = repeated_passages(docs, id_col, text_col, min_words)
    cut = ranges.groupBy(F.col("key").alias("__of")).agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__ranges"),
        F.sum(F.col("last") - F.col("first") + 1).alias("__cut"),
    )
    whole = F.struct(*(docs[c] for c in docs.columns))
    rows = docs.select(F.xxhash64(row_key(docs, id_col, text_col)).alias("__key"), whole.alias("__row"))
    met = join_dimension(rows, side_of(staged(cut, "passage_ranges")), "__key", "__of", "left")
    made = {
        text_col: _without(F.col("__row")[text_col].cast("string"), F.col("__ranges")),
        "n_removed_words": F.coalesce("__cut", F.lit(0)).cast("bigint"),
    }
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in made]
    return met.select(*kept, *(v.alias(c) for c, v in made.items()))
