"""Line deduplication by winnowed fingerprints of line hashes.

The lines of a document that hold words form a sequence.  For each line, the
window is the shortest run from it that has ``min_words`` words; the line of
least hash in it is its fingerprint.  A run of ``min_words`` words or more that
occurs twice holds the window of its first line both times, so both copies
choose the same fingerprint.  Occurrences of repeated fingerprints are joined;
around each, the runs that reach forward and backward from it are compared with
their earliest equal in the corpus, and later copies are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.llm.shared import WORD, let, look_up, row_key, side_of, staged, text_of
from tallygrove.operators.joins import join_dimension

MIN_WORDS = 50


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, at, n, h, g, start, end): lines with words and the words before and up to them."""
    rows = docs.select(
        docs[id_col].alias("id"),
        row_key(docs, id_col, text_col).alias("key"),
        F.posexplode(F.split(text_of(docs, text_col), "\n", -1)).alias("at", "line"),
    )
    counted = rows.select(
        "id", "key", "at", F.regexp_count("line", F.lit(WORD)).alias("n"),
        F.xxhash64("line").alias("h"), F.hash("line").alias("g"),
    ).filter("n > 0")
    # Rows equal in id and text are one document; dealing by key serves this and all windows.
    once = counted.repartition("key").groupBy("key", "at").agg(
        F.first("id").alias("id"), F.first("n").alias("n"), F.first("h").alias("h"), F.first("g").alias("g")
    )
    so_far = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("n").over(so_far)
    return once.withColumn("end", end).withColumn("start", F.col("end") - F.col("n"))


def _runs(lines: DataFrame, min_words: int) -> DataFrame:
    """Candidate runs of every document with the fingerprint ``f`` (at line ``f_at``) inside.

    A line lies in a repeated run of ``min_words`` words if and only if it lies
    in a repeated window from some line (forward), or if the shortest such run
    that ends with it is repeated (backward).
    """
    line = F.struct("at", "h", "g", "start", "end")
    ahead = Window.partitionBy("key").orderBy("start").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("key").orderBy("end").rangeBetween(-(min_words - 1), 0)
    seen = lines.select(
        "id", "key", F.collect_list(line).over(ahead).alias("forward"),
        F.collect_list(line).over(behind).alias("backward"),
    )
    words = F.element_at("backward", -1)["end"] - F.col("backward")[0]["start"]
    longer = F.element_at("backward", -1)["start"] - F.col("backward")[0]["start"] >= min_words
    full = F.element_at("forward", -1)["end"] - F.col("forward")[0]["start"] >= min_words
    # A backward run that is no longer than needed is the forward window of its first line.
    each = F.array(F.when(full, F.col("forward")), F.when((words >= min_words) & longer, F.col("backward")))
    runs = seen.select("id", "key", F.explode(F.filter(each, lambda r: r.isNotNull())).alias("run"))
    origin = F.col("run")[0]["start"]
    window = F.filter("run", lambda x: x["start"] - origin < min_words)
    least = F.array_min(F.transform(window, lambda x: F.struct(x["h"].alias("h"), x["at"].alias("at"))))
    last = F.element_at("run", -1)
    return runs.select(
        "id", "key",
        F.col("run")[0]["at"].alias("first"), last["at"].alias("last"),
        origin.alias("start"), last["end"].alias("end"),
        least["h"].alias("f"), least["at"].alias("f_at"),
        F.xxhash64(F.transform("run", lambda x: x["h"])).alias("r1"),
        F.hash(F.transform("run", lambda x: x["g"])).alias("r2"),
    )


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Line ranges to delete: (key, first, last, start, end), disjoint within a document.

    ``first`` and ``last`` are line numbers from 0, ``start`` and ``end`` count
    the words before and up to them.
    """
    runs = staged(_runs(_lines(docs, id_col, text_col), min_words), "runs")
    place = F.xxhash64("key", "f_at")
    met = runs.groupBy("f").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a != b")
    candidates = staged(look_up(runs, staged(met.select("f"), "repeated"), ["f"], "key", "left_semi"), "candidates")
    position = F.struct("id", "key", "first")
    equal = candidates.groupBy("r1", "r2").agg(F.min(position).alias("origin"), F.count("*").alias("times"))
    earliest = staged(equal.filter("times > 1").drop("times"), "earliest")
    later = look_up(candidates, earliest, ["r1", "r2"], "key", "inner", grows=True)
    later = later.filter(~position.eqNullSafe(F.col("origin")))
    by_place = Window.partitionBy("key").orderBy("first", "last")
    reach = F.max("last").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("first") > reach).cast("int"), F.lit(1))
    island = F.sum("opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0))
    numbered = later.withColumn("opens", opens).withColumn("island", island)
    return numbered.groupBy("key", "island").agg(
        F.min("first").alias("first"), F.max("last").alias("last"),
        F.min("start").alias("start"), F.max("end").alias("end"),
    ).drop("island")


def _without(text: Column, ranges: Column) -> Column:
    """The text without the lines in the ascending, disjoint ranges."""

    def rest(lines: Column) -> Column:
        def piece(k: Column) -> Column:
            begin = F.when(k == 0, 0).otherwise(F.get(ranges, k - 1)["last"] + 1)
            stop = F.coalesce(F.get(ranges, k)["first"], F.size(lines))
            return F.slice(lines, begin + 1, stop - begin)

        pieces = F.transform(F.sequence(F.lit(0), F.size(ranges)), piece)
        return F.array_join(F.flatten(pieces), "\n")

    return F.when(ranges.isNull(), text).otherwise(let(F.split(text, "\n", -1), rest))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The documents with repeated runs deleted, and ``n_removed_lines``, ``n_removed_words``.

    A line is deleted if it lies in a run of consecutive lines, of ``min_words``
    words or more, that also begins earlier: in a document of smaller id (null
    ids first), or further up in its own.  Lines without words are no part of
    the sequence; those inside a deleted run go with it and are counted.  Texts
    without repeats, null and empty ones return unchanged.  Rows equal in id
    and text are one document and return equal.  All columns are kept; only
    the text changes (and columns named like the two counts, which they replace).
    """
    ranges = repeated_runs(docs, id_col, text_col, min_words)
    cut = ranges.groupBy(F.col("key").alias("__of")).agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("__ranges"),
        F.sum(F.col("last") - F.col("first") + 1).alias("__lines_cut"),
        F.sum(F.col("end") - F.col("start")).alias("__words_cut"),
    )
    whole = F.struct(*(docs[c] for c in docs.columns))
    rows = docs.select(row_key(docs, id_col, text_col).alias("__key"), whole.alias("__row"))
    met = join_dimension(rows, side_of(staged(cut, "ranges")), "__key", "__of", "left")
    made = {
        text_col: _without(F.col("__row")[text_col], F.col("__ranges")),
        "n_removed_lines": F.coalesce("__lines_cut", F.lit(0)).cast("bigint"),
        "n_removed_words": F.coalesce("__words_cut", F.lit(0)).cast("bigint"),
    }
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in made]
    return met.select(*kept, *(v.alias(c) for c, v in made.items()))
