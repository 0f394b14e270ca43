"""The cleaning run over all tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallygrove import model
from tallygrove.functions.text import strip
from tallygrove.operators import audit as auditing
from tallygrove.operators import standardise
from tallygrove.operators.dedup import deduplicate
from tallygrove.operators.edits import FLAG_PREFIX, apply_edits, drop_flags
from tallygrove.operators.impute import fill_edits
from tallygrove.operators.references import ParentKeys, flag_orphans, null_orphans, orphan_keys, orphan_side
from tallygrove.operators.staging import Stage, as_is, written_stage
from tallygrove.rules import DEFAULT_RULES, CleaningRules
from tallygrove.sources.csv_dir import RESCUED

# Tables that are worked on at the same time; each waits for its parents.
AT_ONCE = 6


class CleanTable(NamedTuple):
    df: DataFrame
    # The primary keys that are left, for the reference checks of other tables:
    # without the work of later steps, or read from the written table.
    keys: DataFrame
    audit: Callable[[], DataFrame]


class _Done(NamedTuple):
    """A clean table, its keys with what is known of their size, and its audit rows."""

    df: DataFrame
    keys: ParentKeys
    rows: Callable[[], list[auditing.Row]]


def _audit_table(spark: SparkSession, rows: list[auditing.Row]) -> DataFrame:
    return spark.createDataFrame(rows, auditing.AUDIT_SCHEMA).coalesce(1)


@dataclass(frozen=True)
class CleanResult:
    """Clean tables and the audit."""

    tables: dict[str, DataFrame]
    audit_of: Callable[[], DataFrame]

    @property
    def audit(self) -> DataFrame:
        """One row per table and step; counted when asked for, unless the run was staged."""
        return self.audit_of()


def clean_table(
    table: str,
    raw: DataFrame,
    parents: Mapping[str, DataFrame | ParentKeys],
    rules: CleaningRules = DEFAULT_RULES,
    stage: Stage = as_is,
    approximate: bool = False,
    arrival: Sequence[str] = (),
    copy_raw: bool = False,
) -> CleanTable:
    """Run all steps on one table; ``parents`` give the keys of clean parents.

    ``arrival`` columns, where present, order the rows of a duplicate group and
    are dropped then.
    """
    done = _clean_table(table, raw, parents.get, rules, stage, approximate, arrival, copy_raw)
    return CleanTable(done.df, done.keys.df, lambda: _audit_table(raw.sparkSession, done.rows()))


def _clean_table(
    table: str,
    raw: DataFrame,
    keys_of: Callable[[str], DataFrame | ParentKeys | None],
    rules: CleaningRules,
    stage: Stage,
    approximate: bool,
    arrival: Sequence[str],
    copy_raw: bool,
    beside: Callable[[Callable[[], dict]], Callable[[], dict]] = lambda work: work,
) -> _Done:
    """Run all steps on one table.

    ``keys_of`` gives the keys of a parent, or nothing where it is not there;
    it is asked as late as possible, because it may have to wait for them.
    ``beside`` may start work whose result is needed only at the end.
    """
    pk = model.PRIMARY_KEY[table]
    written = stage is not as_is
    if copy_raw:
        raw = stage(raw, f"{table}/raw")
    types = {f.name: f.dataType for f in model.clean_schema(table)}
    log = auditing.TableAudit(table, raw, pk, rules)

    df = deduplicate(raw.drop(RESCUED), table, pk, rules, arrival).drop(*arrival)

    edits = standardise.date_edits(df, rules.date_columns.get(table, ()))
    df = apply_edits(df, edits, keep_flags=True)
    log.dates(edits)

    categories = standardise.category_edits(df, table, rules)
    df = apply_edits(df, categories, keep_flags=True)
    outliers = standardise.outlier_edits(df, rules)
    df = apply_edits(df, outliers, keep_flags=True)
    strategies = rules.fill.get(table, {})
    # Has every value of a reference that the cleaned table has, at the cost of one column.
    values = raw
    if table in rules.match_keys and (categories or {"median", "mode"} & set(strategies.values())):
        # The search for medians, modes and unmapped texts would repeat the shuffle of the repeated keys.
        df = stage(df, f"{table}/standardised")
        values = df if written else raw
    log.categories(categories, partial(standardise.unmapped_values, df, table, rules))
    log.outliers(outliers)
    before = beside(log.before)
    keys = df.select(strip(F.col(pk)).alias(pk))

    fills = fill_edits(df, strategies, approximate)
    df = apply_edits(df, fills, keep_flags=True)
    log.fills(fills)

    for ref in model.references_of(table):
        found = keys_of(ref.parent) if ref.column in raw.columns else None
        if found is None:
            continue
        parent = ParentKeys.of(found, model.PRIMARY_KEY[ref.parent])
        flag = f"{FLAG_PREFIX}orphan__{ref.column}"
        if parent.small:
            df = flag_orphans(df, ref.column, parent, flag)
        else:
            name = f"{table}/orphans_{ref.column}"
            broken = orphan_keys(values, ref.column, parent.df, parent.pk, stage, name)
            side = orphan_side(broken, stage, f"{name}/broken")
            df = null_orphans(df, ref.column, side, pk, flag)
        log.reference(ref.column, flag)

    casts = standardise.cast_edits(df, rules, types)
    log.types(casts)
    if not written:
        df = apply_edits(df, casts)
        return _Done(drop_flags(df), ParentKeys(keys, pk), lambda: log.rows(df.agg(*log.measures()).first(), before()))

    # Nothing is shuffled between here and the files, and the tasks that write
    # count once however often they are tried.  Rows are counted before their
    # types are cast, so that Spark compiles the two halves of the steps apart:
    # the JVM leaves methods of more than 8,000 bytes uncompiled.
    counts = Observation(f"{table} audit")
    seen = df.observe(counts, *log.measures(), ParentKeys.size(strip(F.col(pk))).alias("__bytes"))
    df = stage(drop_flags(apply_edits(seen, casts)), f"{table}/clean")
    found = counts.get
    return _Done(df, ParentKeys.counted(df.select(pk), pk, found), lambda: log.rows(found, before()))


def clean(
    tables: Mapping[str, DataFrame],
    rules: CleaningRules = DEFAULT_RULES,
    stage_dir: str | None = None,
    approximate: bool = False,
    arrival: Sequence[str] = (),
    copy_raw: bool = False,
) -> CleanResult:
    """Clean every known table that is there, parents before children.

    Without ``stage_dir`` rows stay a lazy plan, but for the few numbers that
    medians are found by.  With it (a folder every executor can reach) each
    table is written once, clean, and its audit is counted while it is written.
    Where repeated keys meet medians or categories, the table is also written
    after its row-wise steps, so that the keys are shuffled once.  Tables that do not
    depend on each other are cleaned at the same time.  ``copy_raw`` writes the
    input first: use it for CSV or costly views, whose rows would otherwise be
    parsed again for the audit's raw counts and unmapped texts.
    ``arrival`` names columns that hold the order in which rows came (see
    ``load_csv_tables(arrival=True)``); without, the primary key decides.
    """
    present = [t for t in model.CLEANING_ORDER if t in tables]
    if not present:
        raise ValueError("none of the known tables is present")
    stage = written_stage(stage_dir) if stage_dir else as_is
    spark = tables[present[0]].sparkSession
    settings = (rules, stage, approximate, arrival, copy_raw)
    done: dict[str, _Done] = {}
    if stage_dir:
        # Parents are submitted first, so whoever waits for one waits for a running table.
        started: dict[str, Future[_Done]] = {}

        def wait_for(table: str) -> ParentKeys | None:
            return started[table].result().keys if table in started else None

        threaded = inheritable_thread_target(spark)
        with ThreadPoolExecutor(AT_ONCE) as side, ThreadPoolExecutor(AT_ONCE) as pool:

            def beside(work: Callable[[], dict]) -> Callable[[], dict]:
                return side.submit(threaded(work)).result

            for table in present:
                work = partial(_clean_table, table, tables[table], wait_for, *settings, beside)
                started[table] = pool.submit(threaded(work))
            done = {table: future.result() for table, future in started.items()}
            rows = [row for table in done.values() for row in table.rows()]
        written = stage(_audit_table(spark, rows), "audit")

        def audit_of() -> DataFrame:
            return written

    else:
        for table in present:
            known = {name: one.keys for name, one in done.items()}
            done[table] = _clean_table(table, tables[table], known.get, *settings)

        def audit_of() -> DataFrame:
            return _audit_table(spark, [row for table in done.values() for row in table.rows()])

    cleaned = {name: one.df for name, one in done.items()}
    if model.PASS_THROUGH in tables:
        cleaned[model.PASS_THROUGH] = tables[model.PASS_THROUGH]
    return CleanResult(cleaned, audit_of)
