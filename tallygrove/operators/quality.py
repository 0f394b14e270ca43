"""Issue detection over raw tables, in the shape of the issue log.

Row-wise detectors put their findings of a row into one array and spread it,
so a table is scanned once however many columns are watched.

Fixed values: issue type names and the layout of the log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove import model
from tallygrove.functions.text import ISO_DATE, canonical, match_key, parse_date, strip
from tallygrove.operators.dedup import deduplicate, drop_tagged, is_tagged, key_repeats, spread
from tallygrove.operators.joins import Side, lookup_join, measured
from tallygrove.operators.references import ParentKeys, orphan_keys, orphan_side, parent_keys
from tallygrove.operators.staging import Stage, as_is
from tallygrove.operators.standardise import outside_bounds
from tallygrove.rules import DEFAULT_RULES, CleaningRules

MISSING = "missing_value"
DATE_FORMAT = "inconsistent_date_format"
CASING = "inconsistent_casing"
OUTLIER = "outlier"
DUPLICATE = "duplicate_entry"
ORPHAN = "orphan_reference"
NAME_VARIANT = "transliteration_variant"

ROW_WISE = (MISSING, DATE_FORMAT, CASING, OUTLIER)


def _found(condition: Column, column: str, kind: str, description: Column) -> Column:
    issue = F.struct(
        F.lit(column).alias("column_name"),
        F.lit(kind).alias("issue_type"),
        description.alias("description"),
    )
    return F.when(condition, issue)


def _row_issues(
    df: DataFrame, table: str, rules: CleaningRules, kinds: Sequence[str]
) -> list[Column]:
    issues = []
    if MISSING in kinds:
        for c in rules.monitored_nulls.get(table, ()):
            if c in df.columns:
                issues.append(
                    _found(F.col(c).isNull(), c, MISSING, F.lit(f"NULL in '{c}'"))
                )
    if DATE_FORMAT in kinds:
        for c in rules.date_columns.get(table, ()):
            if c in df.columns:
                odd = ~F.col(c).rlike(ISO_DATE) & parse_date(F.col(c)).isNotNull()
                text = F.concat(F.lit("Date written as '"), F.col(c), F.lit("'"))
                issues.append(_found(odd, c, DATE_FORMAT, text))
    if CASING in kinds:
        for c, mapping in rules.value_maps(table).items():
            if c in df.columns:
                mapped = canonical(F.col(c), mapping)
                text = F.concat(
                    F.lit("'"), F.col(c), F.lit("' stands for '"), mapped, F.lit("'")
                )
                issues.append(_found(mapped != F.col(c), c, CASING, text))
    if OUTLIER in kinds:
        for c in rules.bounds:
            if c in df.columns:
                text = F.concat(F.lit("Value out of range: "), F.col(c).cast("string"))
                issues.append(_found(outside_bounds(df, c, rules), c, OUTLIER, text))
    return issues


def row_issues(
    df: DataFrame,
    table: str,
    rules: CleaningRules = DEFAULT_RULES,
    kinds: Sequence[str] = ROW_WISE,
) -> DataFrame:
    """Missing values, odd date spellings, odd casing and outliers, in one scan."""
    issues = _row_issues(df, table, rules, kinds)
    if not issues:
        return _nothing(df)
    pk = model.PRIMARY_KEY[table]
    return (
        df.select(F.col(pk).cast("string").alias("record_id"), F.explode(F.array(*issues)).alias("i"))
        .filter("i is not null")
        .select(F.lit(table).alias("table_name"), "i.column_name", "record_id", "i.issue_type", "i.description")
    )


def _issue_rows(
    df: DataFrame, table: str, column: Column, kind: str, record: Column, description: Column
) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"),
        column.cast("string").alias("column_name"),
        record.cast("string").alias("record_id"),
        F.lit(kind).alias("issue_type"),
        description.alias("description"),
    )


def _nothing(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [],
        "table_name string, column_name string, record_id string, issue_type string, "
        "description string",
    )


def duplicate_issues(
    df: DataFrame, table: str, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """Tagged rows, and untagged rows that repeat the match key of an earlier one."""
    pk = model.PRIMARY_KEY[table]
    tagged = _issue_rows(
        df.filter(is_tagged(pk, rules.duplicate_tag)),
        table, F.lit(None), DUPLICATE, F.col(pk), F.lit("Key carries the duplicate tag"),
    )
    keys = rules.match_keys.get(table, ())
    if not any(c in df.columns for c in keys):
        return tagged
    repeats = key_repeats(drop_tagged(df, pk, rules.duplicate_tag), keys, pk)
    repeated = _issue_rows(
        repeats, table, F.lit(None), DUPLICATE, F.col(pk),
        F.concat(F.lit("Repeats '"), F.col("first_id").cast("string"), F.lit("'")),
    )
    return tagged.unionByName(repeated)


def orphan_issues(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame | ParentKeys,
    parent_pk: str,
    stage: Stage = as_is,
) -> DataFrame:
    """Rows whose reference has no parent among those that cleaning leaves.

    ``parent`` holds these keys (see :func:`surviving_keys`).  Keys that are
    known to be few are broadcast.  Otherwise the broken values are found first,
    with ``stage`` by bitmaps of numbered keys, else among distinct values; the
    rows then meet only those.
    """
    pk, keys = model.PRIMARY_KEY[table], ParentKeys.of(parent, parent_pk)
    rows = child.select(F.col(pk), F.col(column).cast("string").alias("value")).filter("value is not null")
    if keys.small:
        known = F.broadcast(parent_keys(keys.df, parent_pk))
        broken = rows.join(known, F.col("value") == F.col("parent_key"), "left_anti")
    else:
        name = f"issues/{table}_{column}"
        orphans = orphan_keys(child, column, keys.df, parent_pk, stage, name)
        side = orphan_side(orphans, stage, f"{name}/broken")
        broken = lookup_join(rows, side, [F.col("value") == F.col("orphan_key")], pk, "inner")
    text = F.concat(F.lit("No parent for '"), F.col("value"), F.lit("'"))
    return _issue_rows(broken, table, F.lit(column), ORPHAN, F.col(pk), text)


# -- names -------------------------------------------------------------------


def _common_length(one: Column, other: Column) -> Column:
    """The number of characters with which both texts begin."""
    upto = F.sequence(F.lit(0), F.length(one))
    return F.size(F.filter(upto, lambda i: F.left(one, i) == F.left(other, i))) - 1


def _cores(spellings: DataFrame) -> DataFrame:
    """Spellings with their ``core``: without what all texts of their block begin and end with.

    Texts are as many edits apart as their cores.  ``lengths`` are those of the
    cores of the block.
    """
    text = F.col("spelling")
    back = F.reverse(text)
    ends = spellings.groupBy("block").agg(
        _common_length(F.min(text), F.max(text)).alias("front"),
        _common_length(F.min(back), F.max(back)).alias("back"),
        F.min(F.length(text)).alias("least"),
        F.collect_set(F.length(text)).alias("lengths"),
    )
    back = F.least("back", F.col("least") - F.col("front"))
    lengths = F.transform("lengths", lambda n: n - F.col("front") - back)
    ends = ends.select(
        F.col("block").alias("of_block"), "front", back.alias("back"), lengths.alias("lengths")
    )
    met = lookup_join(
        spellings, Side(ends, small=False), [F.col("block") == F.col("of_block")], "spelling", "inner"
    )
    core = F.substr(text, F.col("front") + 1, F.length(text) - F.col("front") - F.col("back"))
    return met.select("block", "spelling", "first_id", core.alias("core"), "lengths")


def _edited(spellings: DataFrame, distance: int) -> DataFrame:
    """A row per spelling and way to mask and leave out up to ``distance`` characters.

    ``form`` is what is left, with the places of its masks before it; ``masked``
    and ``left_out`` are numbers of characters.  Ways that no other length of
    the block can meet are left out.
    """
    df = spellings.select(
        "*", F.lit("").alias("done"), F.col("core").alias("rest"), F.lit("").alias("places"),
        F.lit(0).alias("masked"), F.lit(0).alias("left_out"),
    )
    rest, at = F.col("rest"), F.col("at")
    for _ in range(distance):
        # Positive: mask that character; negative: leave it out; zero: no further edit.
        # Of equal characters in a row only the first is left out.
        again = (at < -1) & (F.substr(rest, -at, F.lit(1)) == F.substr(rest, -at - 1, F.lit(1)))
        df = df.withColumn("at", F.explode(F.sequence(-F.length(rest), F.length(rest)))).filter(~again)
        done = F.concat("done", F.when(at == 0, rest).otherwise(F.left(rest, F.abs(at) - 1)))
        df = df.withColumns({
            "done": done,
            "rest": F.when(at == 0, "").otherwise(F.substr(rest, F.abs(at) + 1)),
            "places": F.when(at > 0, F.concat("places", F.length(done).cast("string"), F.lit(","))).otherwise(F.col("places")),
            "masked": F.col("masked") + (at > 0).cast("int"),
            "left_out": F.col("left_out") + (at < 0).cast("int"),
        })
    used = F.col("masked") + F.col("left_out")
    # The length of a text that meets this one with ``i`` characters left out itself.
    length = F.length("core") - F.col("left_out")
    meets = [
        (used + i <= distance) & (used + i > 0) & F.array_contains("lengths", length + i)
        for i in range(distance + 1)
    ]
    return df.filter(reduce(Column.__or__, meets)).select(
        "block", "spelling", "first_id", "masked", "left_out",
        F.concat("places", F.lit(":"), "done", "rest").alias("form"),
    )


def _nearest_earlier(spellings: DataFrame, distance: int) -> DataFrame:
    """Per spelling and way to edit it, the earliest text of the block that is met so.

    Two texts are ``n`` edits apart if and only if masking the characters that
    are replaced, and leaving out those that only one of them has, makes them
    equal with ``n`` masks and left-out characters in all.  Of the texts with
    one form only the earliest per number of left-out characters can be the
    answer for any other, so none are paired: the rows grow with the spellings,
    however many of them are near each other.  A row may name a text that is
    nearer than its ``edits``; that text then has a row with fewer, which wins.
    """
    tasks = int(spellings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Every spelling grows to many forms, so they are dealt out evenly first;
    # adaptive coalescing would pack them by their small size.
    forms = _edited(_cores(spellings).repartition(tasks, "spelling"), distance)
    alike = Window.partitionBy("key", "form", "block")
    one = F.struct(F.col("first_id").alias("near_id"), F.col("spelling").alias("near_spelling"))
    firsts = {f"__first_{i}": F.min(F.when(F.col("left_out") == i, one)).over(alike) for i in range(distance + 1)}
    met = forms.withColumn("key", F.xxhash64("block", "form")).withColumns(firsts)

    def found(i: int) -> Column:
        first, edits = F.col(f"__first_{i}"), F.col("masked") + F.col("left_out") + i
        earlier = (first["near_id"] < F.col("first_id")) & edits.between(1, distance)
        return F.when(earlier, F.struct(edits.alias("edits"), first["near_id"].alias("near_id"), first["near_spelling"].alias("near_spelling")))

    best = F.least(*map(found, range(distance + 1)))
    return met.select("block", "spelling", best.alias("best")).filter("best is not null")


def _piece(text: Column, length: Column, i: Column, pieces: int, shift: Column) -> Column:
    """Hash of piece ``i`` of a text of that length cut evenly, read ``shift`` further on."""
    start = (length * i / pieces).cast("int")
    size = (length * (i + 1) / pieces).cast("int") - start
    return F.xxhash64(length, i, F.substr(text, start + 1 + shift, size))


def _own_pieces(text: Column, distance: int) -> Column:
    at = F.sequence(F.lit(0), F.lit(distance))
    return F.transform(at, lambda i: _piece(text, F.length(text), i, distance + 1, F.lit(0)))


def _pieces_looked_for(text: Column, distance: int) -> Column:
    """Pieces that a text within ``distance`` edits may have, wherever they moved to."""
    around = F.sequence(F.lit(-distance), F.lit(distance))
    at = F.sequence(F.lit(0), F.lit(distance))

    def for_length(longer: Column) -> Column:
        length = F.length(text) + longer

        def for_piece(i: Column) -> Column:
            return F.transform(around, lambda shift: _piece(text, length, i, distance + 1, shift))

        return F.flatten(F.transform(at, for_piece))

    return F.array_distinct(F.flatten(F.transform(around, for_length)))


# Declared width of a name.
FORMS_UP_TO = 128


def _long_candidates(spellings: DataFrame, distance: int, forms_up_to: int) -> DataFrame:
    """Pairs of an over-long spelling and an earlier one that may be near, within a block.

    The number of forms grows with the square of the length, so over-long texts
    are cut in ``distance + 1`` pieces, one of which must be untouched.  The
    keys are hashes: they only propose a pair.
    """
    def keyed(df: DataFrame, keys: Column) -> DataFrame:
        # Dealt out evenly first, as in :func:`_nearest_earlier`.
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(tasks, "spelling").select(
            F.explode(keys).alias("key"), "block", "spelling", "first_id"
        ).withColumn("key", F.xxhash64("block", "key"))

    text = F.col("spelling")
    # Shorter ones by up to ``distance`` may be near to one that is over-long.
    long = spellings.filter(F.length(text) > forms_up_to - distance)
    looked_for = keyed(long, _pieces_looked_for(text, distance))
    # Catalyst does not see how far the keys multiply; the hint keeps it from
    # broadcasting them.
    earlier = keyed(long, _own_pieces(text, distance)).toDF("near_key", "near_block", "near_spelling", "near_id")
    return looked_for.join(earlier.hint("merge"), F.col("key") == F.col("near_key")).filter(
        "block = near_block and near_id < first_id"
    )


def name_variants(
    df: DataFrame,
    pk: str,
    name: str,
    block: str,
    distance: int = 2,
    forms_up_to: int = FORMS_UP_TO,
) -> DataFrame:
    """Records whose name is nearly that of an earlier record in their block.

    "Earlier" is by the least primary key that carries a spelling; a name is
    reported once per record with its nearest earlier spelling (ties to the
    earliest), never once per pair of records.  Equal names are reduced to one
    row per (block, spelling) before anything is compared.  Names up to the
    declared width meet by their forms (see :func:`_nearest_earlier`), longer
    ones in pairs that share a piece.
    """
    keyed = df.select(
        F.col(pk).cast("string").alias("record_id"),
        F.coalesce(F.col(block).cast("string"), F.lit("")).alias("block"),
        match_key(F.col(name)).alias("spelling"),
    ).filter("spelling is not null")
    spellings = keyed.groupBy("block", "spelling").agg(F.min("record_id").alias("first_id"))
    near = F.levenshtein(F.col("spelling"), F.col("near_spelling"), distance)
    long = (
        _long_candidates(spellings, distance, forms_up_to)
        .withColumn("edits", near)
        .filter(F.col("edits").between(1, distance))
        .select("block", "spelling", F.struct("edits", "near_id", "near_spelling").alias("best"))
    )
    short = _nearest_earlier(spellings.filter(F.length("spelling") <= forms_up_to), distance)
    best = short.unionByName(long).groupBy("block", "spelling").agg(F.min("best").alias("best"))
    found = best.toDF("near_block", "near_of", "best")
    same = [F.col("block") == F.col("near_block"), F.col("spelling") == F.col("near_of")]
    return lookup_join(keyed, Side(found, small=False), same, "record_id", "inner").select(
        "record_id",
        "block",
        "spelling",
        F.col("best.near_spelling").alias("near_spelling"),
        F.col("best.near_id").alias("near_id"),
        F.col("best.edits").alias("edits"),
    )


def name_issues(df: DataFrame, table: str, rules: CleaningRules = DEFAULT_RULES) -> DataFrame:
    name, block = rules.name_columns[table]
    found = name_variants(df, model.PRIMARY_KEY[table], name, block)
    text = F.concat(F.lit("Near '"), F.col("near_spelling"), F.lit("' of '"), F.col("near_id"), F.lit("'"))
    return _issue_rows(found, table, F.lit(name), NAME_VARIANT, F.col("record_id"), text)


# -- log ---------------------------------------------------------------------


def surviving_keys(
    parent: DataFrame, table: str, rules: CleaningRules = DEFAULT_RULES
) -> DataFrame:
    """The primary keys that cleaning leaves: without duplicates, stripped of blanks."""
    pk = model.PRIMARY_KEY[table]
    needed = dict.fromkeys((pk, *rules.match_keys.get(table, ())))
    rows = parent.select(*(c for c in needed if c in parent.columns))
    return deduplicate(rows, table, pk, rules).select(strip(F.col(pk)).alias(pk))


def all_issues(
    tables: Mapping[str, DataFrame],
    rules: CleaningRules = DEFAULT_RULES,
    stage: Stage = as_is,
    copy_raw: bool = False,
) -> DataFrame:
    """Issues of every kind in every table, without log columns.

    With ``stage`` the keys of parents are written and counted, which tells
    how references are best compared.  ``copy_raw`` writes each table first,
    so that the detectors do not parse a raw text file again and again;
    columnar input is read by each with the columns that it needs.
    """
    known = {n: df for n, df in tables.items() if n in model.CLEANING_ORDER}
    tables = {n: stage(df, f"issues/{n}") for n, df in known.items()} if copy_raw else known
    parents = {r.parent for t in tables for r in model.references_of(t) if r.parent in tables}
    keys = {
        name: ParentKeys(stage(surviving_keys(tables[name], name, rules), f"issues/{name}_keys"), model.PRIMARY_KEY[name])
        for name in sorted(parents)
    }
    if stage is not as_is:
        sides = measured({name: k.df for name, k in keys.items()}, at_once=True)
        keys = {name: k._replace(small=sides[name].small) for name, k in keys.items()}
    parts: list[DataFrame] = []
    for table in model.CLEANING_ORDER:
        if table not in tables:
            continue
        df = tables[table]
        if _row_issues(df, table, rules, ROW_WISE):
            parts.append(row_issues(df, table, rules))
        parts.append(duplicate_issues(df, table, rules))
        for ref in model.references_of(table):
            if ref.parent in tables and ref.column in df.columns:
                parent_pk = model.PRIMARY_KEY[ref.parent]
                parts.append(orphan_issues(df, table, ref.column, keys[ref.parent], parent_pk, stage))
        if set(rules.name_columns.get(table, ("\0",))) <= set(df.columns):
            parts.append(name_issues(df, table, rules))
    return reduce(DataFrame.unionByName, parts)


def issue_log(
    tables: Mapping[str, DataFrame],
    detected: dt.date,
    rules: CleaningRules = DEFAULT_RULES,
    stage: Stage = as_is,
    copy_raw: bool = False,
) -> DataFrame:
    """All issues as log rows, each with an id of its own.

    The id is a hash of what the row says and of its number among rows that say
    the same, as repeated keys make them.  Such rows are reduced to one with a
    count and spread again, so they need no window, no global numbering, and
    get the same ids when a task or the whole run is repeated.
    """
    columns = ("table_name", "column_name", "record_id", "issue_type", "description")
    place = F.concat_ws(
        "|",
        F.col("table_name"),
        F.coalesce("column_name", F.lit("")),
        F.coalesce("record_id", F.lit("")),
        F.col("issue_type"),
        F.col("description"),
        F.col("copy"),
    )
    counted = all_issues(tables, rules, stage, copy_raw).groupBy(*columns).agg(F.count("*").alias("n"))
    each = spread(counted, "n", "copy")
    return each.select(
        F.concat(F.lit("DQL-"), F.sha2(place, 256)).alias("log_id"),
        "table_name",
        "column_name",
        "record_id",
        "issue_type",
        "description",
        F.lit(detected).alias("detected_date"),
        F.lit(0).alias("resolved"),
    )


def merge_log(previous: DataFrame, current: DataFrame) -> DataFrame:
    """The log after a further run: what is new is added, what is gone is resolved.

    Both are logs of :func:`issue_log`, ``previous`` perhaps the result of an
    earlier merge.  An issue that is still there keeps the date on which it was
    first found; one that had been resolved and is back gets the new date.
    Issues that are gone stay, with ``resolved`` 1.  The id says what an issue
    is about, so the two meet on it in one join, and no row is compared with
    any other; merging the same run twice changes nothing.
    """
    names = previous.columns
    # The hash of an id takes half the room as bytes; ids of another form stay texts.
    ours = F.col("log_id").rlike("^DQL-[0-9a-f]{64}$")
    digest = F.when(ours, F.unhex(F.substr("log_id", F.lit(5)))).otherwise(F.lit(b""))
    other = F.when(ours, "").otherwise(F.col("log_id"))
    rest = F.struct(*(c for c in names if c != "log_id"))

    def packed(log: DataFrame, side: str) -> DataFrame:
        return log.select(digest.alias(f"{side}_hash"), other.alias(f"{side}_other"), rest.alias(side))

    old, new = packed(previous, "__old"), packed(current.select(*names), "__new")
    same = [F.col(f"__new_{part}") == F.col(f"__old_{part}") for part in ("hash", "other")]
    met = new.join(old, same, "full")
    gone, open_before = F.col("__new").isNull(), F.col("__old.resolved") == 0
    merged = (
        F.when(gone, F.col("__old").withField("resolved", F.lit(1)))
        .when(open_before, F.col("__old"))
        .otherwise(F.col("__new"))
    )
    hashed, plain = (F.when(gone, F.col(f"__old_{part}")).otherwise(F.col(f"__new_{part}")) for part in ("hash", "other"))
    log_id = F.when(F.length(hashed) > 0, F.concat(F.lit("DQL-"), F.lower(F.hex(hashed)))).otherwise(plain)
    return met.select(log_id.alias("log_id"), merged.alias("__row")).select("log_id", "__row.*").select(*names)
