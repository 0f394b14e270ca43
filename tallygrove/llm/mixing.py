"""Mix sources to target weights: hash-random order, prefix sums of words, exact cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.llm.shared import WORD, look_up, row_key, side_of, staged, text_of
from tallygrove.operators.joins import join_dimension

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = 17
# Equal rows that are spelt out at once.
COPIES = 10_000


def _prefix_sums(rows: DataFrame, group: str, bucket: str, order: list[str], values: list[str]) -> DataFrame:
    """Adds ``before_<value>``: the sum of the rows of the group before this row.

    ``bucket`` ascends with ``order`` within a group.  Sums of buckets are
    added up first, then rows within a bucket, so that no task orders a group.
    """
    sums = rows.groupBy(group, bucket).agg(*(F.sum(v).alias(f"__sum_{v}") for v in values))
    earlier = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col(group).alias("__group"), F.col(bucket).alias("__bucket"),
        *(F.coalesce(F.sum(f"__sum_{v}").over(earlier), F.lit(0)).alias(f"__start_{v}") for v in values),
    )
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumns(
        {f"__in_{v}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}
    )
    met = summed.join(starts, (F.col(group) == F.col("__group")) & (F.col(bucket) == F.col("__bucket")))
    return met.select(
        *rows.columns, *((F.col(f"__start_{v}") + F.col(f"__in_{v}")).alias(f"before_{v}") for v in values)
    )


def _dealt(rows: DataFrame, n: str) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``copy``; no array holds more than ``COPIES`` numbers."""
    last = F.floor((F.col(n) - 1) / COPIES)
    parts = rows.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("__part") * COPIES
    numbers = F.sequence(start, F.least(start + COPIES, F.col(n)) - 1)
    return parts.withColumn("copy", F.explode(numbers)).drop("__part")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """``source``, ``source_size``, ``n_rows`` with the words to take, ``target``.

    Weights repeat over the sources by code point, null last, and share the
    total of all sizes.  No target exceeds ``most`` times its source; what is
    over goes to the others by weight.  With sources by size per weight, there
    is one level below which all are capped: a source is uncapped if what the
    smaller ones leave, shared by the remaining weight, fits into it.  These
    windows run over one row per source, not over documents.
    """
    everything = F.lit(0)
    by_name = Window.partitionBy(everything).orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(place, F.lit(len(weights))))
    weighed = sizes.withColumn("__w", weight).withColumn("__most", most * F.col("source_size"))
    ratio = F.col("__most") / F.col("__w")
    all_rows = Window.partitionBy(everything)
    before = Window.partitionBy(everything).orderBy(ratio, F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("__most").over(before), F.lit(0))
    open_weight = F.sum("__w").over(all_rows) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    level = weighed.withColumn("__level", left / open_weight).withColumn("__ratio", ratio)
    fits = F.when(F.col("__level") <= F.col("__ratio"), F.col("__level"))
    # The first source in this order that is not capped gives the level of all.
    order = F.struct(F.col("__ratio"), F.col("source").isNull(), F.col("source"))
    first = F.min_by(fits, F.when(fits.isNotNull(), order)).over(all_rows)
    found = level.withColumn("__share", first)
    target = F.least(F.coalesce(F.col("__share") * F.col("__w"), F.col("__most")), F.col("__most"))
    return found.select("source", "source_size", "n_rows", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: key, id, source, size, source_size, target and ``taken``.

    Documents of a source are ordered by a hash of their id and text.  The
    words of that order are taken as many whole times as the target holds the
    source, then once more up to the budget; the document at the cut is taken
    in part, so each source gives exactly its target, rounded to words.  Equal
    documents of a source stand together, each in a place of its own.  Empty and null
    texts have size 0; null is a source of its own.  Results depend on ids and
    texts alone, not on partitions.  A source's rows are dealt to as many
    buckets as the root of its rows, in the order of the hash.
    """
    words = F.regexp_count(text_of(docs, text_col), F.lit(WORD)).cast("bigint")
    key = row_key(docs, id_col, text_col)
    sized = staged(
        docs.select(key.alias("key"), docs[id_col].alias("id"), docs[source_col].cast("string").alias("source"), words.alias("size")),
        "sizes",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    plan = staged(targets(totals, weights, most).withColumn("group", F.xxhash64("source", F.col("source").isNull())), "targets")
    random = F.xxhash64(F.lit(seed), F.col("key"))
    rows = sized.withColumns({"group": F.xxhash64("source", F.col("source").isNull()), "random": random})
    rows = look_up(rows, plan.select("group", "source_size", "n_rows", "target"), ["group"], "key", "left")
    # Rows equal in id, text and source are interchangeable: they are counted, ordered as one and dealt out again.
    equal = rows.groupBy("key", "id", "source", "group", "random", "size", "source_size", "n_rows", "target").agg(F.count("*").alias("copies"))
    equal = equal.withColumn("words", F.col("size") * F.col("copies"))
    n_buckets = F.ceil(F.sqrt("n_rows"))
    share = F.shiftrightunsigned("random", 1).cast("double") / F.lit(float(1 << 63))
    # The hash is ordered as unsigned by its upper 63 bits; equal ones by the whole key.
    equal = equal.withColumn("bucket", F.least(F.floor(share * n_buckets), n_buckets - 1))
    equal = equal.withColumn("place", F.shiftrightunsigned("random", 1))
    summed = _prefix_sums(equal, "group", "bucket", ["place", "key"], ["words"])
    each = _dealt(summed, "copies")
    budget = F.round("target").cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.expr("least(cast(round(target) as bigint) div source_size, %d)" % most)).otherwise(0)
    before = F.col("before_words") + F.col("copy") * F.col("size")
    rest = F.least(F.greatest(budget - whole * F.col("source_size") - before, F.lit(0)), F.col("size"))
    taken = whole * F.col("size") + F.when(whole < most, rest).otherwise(0)
    return each.select(
        "key", "id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken")
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents of which the mix takes words, with size, source_size, target and taken.

    A document taken more than once appears once; ``taken`` counts repeats.
    Columns of those four names are replaced.
    """
    made = ("size", "source_size", "target", "taken")

    def keyed(key: Column, source: Column) -> Column:
        return F.concat_ws(":", key, F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n")))

    mixed = mix(docs, id_col, text_col, source_col, **options)
    mixed = staged(mixed.select(keyed(F.col("key"), F.col("source")).alias("key"), *made), "mixed")
    whole = F.struct(*(docs[c] for c in docs.columns if c not in made))
    rows = docs.select(keyed(row_key(docs, id_col, text_col), docs[source_col]).alias("__key"), whole.alias("__row"))
    # Rows equal in id, text and source are interchangeable: one of them stands for every place they hold.
    repeated = staged(mixed.groupBy("key").count().filter("count > 1").select("key"), "repeated")
    if not repeated.isEmpty():
        side = side_of(repeated)
        once = join_dimension(rows, side, "__key", "key", "left_semi")
        once = once.groupBy("__key").agg(F.first("__row").alias("__row"))
        rows = join_dimension(rows, side, "__key", "key", "left_anti").unionAll(once)
    return join_dimension(rows, side_of(mixed.filter("taken > 0"), grows=True), "__key", "key", "inner").select("__row.*", *made)
