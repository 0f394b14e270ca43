"""All twelve cleaned tables with all their columns: raw views and the DuckDB cleaner.

The raw views run unchanged in Spark and DuckDB.  The cleaner is written from
the rules alone, one common table expression per table and step.
"""

from __future__ import annotations

from tallygrove import model
from tallygrove.rules import COLUMN_BOUNDS, DEFAULT_RULES

RULES = DEFAULT_RULES


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _gap(key: str, n: int, value: str) -> str:
    return f"case when {key}%{n}=0 then null else {value} end"


def _pick(key: str, values: list[str]) -> str:
    whens = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {key}%{len(values)} {whens} end"


def _date(key: str) -> str:
    yy, mm, dd = f"{_text(f'2019+{key}%6')}", f"lpad({_text(f'1+{key}%12')},2,'0')", f"lpad({_text(f'1+{key}%28')},2,'0')"
    short = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec',cast({mm} as int)*3-2,3)"
    return _pick(
        key,
        [
            f"{yy}||'-'||{mm}||'-'||{dd}", f"{dd}||'/'||{mm}||'/'||{yy}", f"{dd}||'-'||{short}||'-'||substr({yy},3,2)",
            f"{yy}||'/'||{mm}||'/'||{dd}", f"{yy}||{mm}||{dd}", "'soon'", "null",
        ],
    )


def _ref(prefix: str, key: str, count: int, orphan: int = 53, gap: int = 59) -> str:
    value = f"'{prefix}'||{_text(f'1+{key}%{count}')}"
    return f"case when {key}%{gap}=0 then null when {key}%{orphan}=0 then '{prefix}none' else {value} end"


_STATUS = ["'on track'", "' At Risk'", "'OFF TRACK'", "'Achieved'", "'exceeded '", "'paused'"]


def _view(table: str, source: str, columns: dict[str, str]) -> str:
    declared = [f.name for f in model.clean_schema(table)]
    assert list(columns) == declared, (table, declared)
    return "select " + ", ".join(f"{x} {c}" for c, x in columns.items()) + f" from {source}"


def _program(key: str) -> str:
    return _ref("PRG-", key, 25)


def _twice(source: str, key: str, every: int) -> str:
    """The rows of a table, some of them again with a tagged key (``tag``)."""
    return f"(select *, '' tag from {{{source}}} union all select *, '-DUP' from {{{source}}} where {key}%{every}=0) x"


VIEWS: dict[str, str] = {
    "regions": _view("regions", "{nation}", {
        "region_id": f"' REG-'||{_text('1+n_nationkey')}||' '", "state": "n_name", "district": "'D '||n_name",
        "block": _gap("n_nationkey", 4, "'B'"), "region_type": "'Rural'",
        "latitude": _pick("n_nationkey", ["'10.5'", "'north'", "null", f"{_text('n_nationkey')}||'.25'"]),
        "longitude": f"{_text('n_nationkey')}||'.75'",
    }),
    "donors": _view("donors", _twice("supplier", "s_suppkey", 9), {
        "donor_id": f"'DON-'||{_text('1+s_suppkey')}||tag", "donor_name": "s_name||' '", "donor_type": "'Trust'",
        "country": "'India'", "contact_email": _gap("s_suppkey", 5, "'a@b.org'"), "onboarded_date": _date("s_suppkey"),
    }),
    "impact_indicators": _view("impact_indicators", "{nation}", {
        "indicator_id": f"'IND-'||{_text('1+n_nationkey')}", "iris_id": "'PI'||n_name", "indicator_name": "n_name",
        "category": "'Output'", "unit": "' People'", "sector": "'Health'",
    }),
    "programs": _view("programs", "{nation}", {
        "program_id": f"'PRG-'||{_text('1+n_nationkey')}", "program_name": "'P '||n_name", "sector": "'Health'",
        "start_date": _date("n_nationkey"), "end_date": _date("(n_nationkey+3)"),
        "target_beneficiaries": _pick("n_nationkey", ["'100.5'", "'many'", "'7'", "null"]),
        "region_id": _ref("REG-", "(n_nationkey+1)", 25, 7), "status": _pick("n_nationkey", _STATUS),
    }),
    "staff": _view("staff", _twice("supplier", "s_suppkey", 7), {
        "staff_id": f"'STF-'||{_text('1+s_suppkey')}||tag",
        "full_name": _pick("s_suppkey", ["s_name", "'  Ana  Roy '", "'ANA  ROY'", "s_name"]), "role": "'Field'",
        "region_id": _ref("REG-", "s_suppkey", 25), "hire_date": _date("s_suppkey"),
        "phone": _gap("s_suppkey", 3, f"'+91'||{_text('s_suppkey%4')}"), "email": _gap("s_suppkey", 4, "'x@y.org'"),
        "is_active": _pick("s_suppkey", ["'1'", "'0'", "'1.0'", "'yes'"]),
    }),
    "funding": _view("funding", _twice("orders", "o_orderkey", 101), {
        "funding_id": f"'FND-'||{_text('o_orderkey')}||tag", "donor_id": _ref("DON-", "o_custkey", 10),
        "program_id": _program("o_orderkey"),
        "amount_inr": _pick("o_orderkey", [_text("o_orderkey*10"), "'99'", "'200000000'", "'12,5'", f"{_text('o_orderkey*3')}||'.25'"]),
        "currency": "'INR'", "disbursement_date": _date("o_orderkey"), "fiscal_year": "'FY2023-24'",
        "grant_type": _gap("o_orderkey", 6, "' Core'"),
    }),
    "interventions": _view("interventions", "{part}", {
        "intervention_id": f"'INT-'||{_text('p_partkey')}", "program_id": _program("p_partkey"),
        "intervention_type": "'Camp'", "title": "'T '||p_brand", "scheduled_date": _date("p_partkey"),
        "actual_date": _date("(p_partkey+5)"), "staff_id": _ref("STF-", "p_partkey", 10), "region_id": _ref("REG-", "p_partkey", 25),
        "planned_attendance": _pick("p_partkey", ["'30'", "'-1'", "'1001'", "'30.5'", "null"]),
        "actual_attendance": _pick("(p_partkey+1)", ["'29'", "'1000'", "'none'", "'0'"]),
    }),
    "beneficiaries": _view("beneficiaries", _twice("customer", "c_custkey", 31), {
        "beneficiary_id": f"'BEN-'||{_text('c_custkey')}||tag", "full_name": _pick("c_custkey", ["c_name", "c_name||' '", "'Same Name'"]),
        "age": _pick("c_custkey", ["'30'", "'111'", "'x'", "null", _text("c_custkey%95")]),
        "gender": _pick("c_custkey", ["'male'", "' F'", "'NB'", "'p'", "'other'", "null"]),
        "phone": _gap("c_custkey", 7, _text("c_custkey%90")), "education_level": _gap("c_custkey", 12, "c_mktsegment"),
        "income_bracket": _gap("c_custkey", 5, "'LIG '"), "region_id": _ref("REG-", "c_custkey", 25),
        "registration_date": _date("c_custkey"), "program_id": _program("c_custkey"),
        "household_size": _pick("c_custkey", ["'4'", "'0'", "'21'", "null", "'5.5'"]),
        "is_disabled": _pick("c_custkey", ["'1'", "null", "'0'"]),
    }),
    "service_delivery": _view("service_delivery", _twice("orders", "o_orderkey", 77), {
        "delivery_id": f"'DLV-'||{_text('o_orderkey')}||tag",
        "beneficiary_id": f"case when o_orderkey%41=0 then null when o_orderkey%43=0 then 'BEN-x' else 'BEN-'||{_text('o_custkey')} end",
        "intervention_id": _ref("INT-", "o_orderkey", 150), "delivery_date": _date("o_orderkey"),
        "status": _pick("o_orderkey", ["'completed'", "'C'", "'no show'", "' Canceled'", "'odd'", "'Scheduled'", "null"]),
        "dosage": _pick("o_orderkey", ["'3'", "'51'", "null", "'2'", "'two'"]),
        "notes": _gap("o_orderkey", 3, "'first'||chr(10)||'second, \"quoted\"'"),
    }),
    "assessments": _view("assessments", "{events}", {
        "assessment_id": f"'ASM-'||{_text('event_id')}",
        "beneficiary_id": f"case when event_id%47=0 then null when event_id%49=0 then 'BEN-x' else 'BEN-'||{_text('user_id')} end",
        "intervention_id": _ref("INT-", "event_id", 150),
        "assessment_type": _pick("event_id", ["'pre-test'", "'PRE TEST'", "'posttest '", "'Spot Check'", "'follow up interview'", "'P'"]),
        "assessment_date": _date("event_id"),
        "score": _pick("event_id", ["'50'", "'101'", "'-1'", "null", "'77.5'", "'1e999'"]),
        "max_score": _pick("event_id", ["'100'", "'100'", "'100'", "'100'", "'100'", "null"]),
        "assessor_staff_id": _ref("STF-", "event_id", 10), "remarks": _gap("event_id", 2, "' ok '"),
    }),
    "outcome_tracking": _view("outcome_tracking", "{orders}", {
        "outcome_id": f"'OUT-'||{_text('o_orderkey')}", "program_id": _program("o_custkey"), "indicator_id": _ref("IND-", "o_orderkey", 25),
        "reporting_period": "'Q1-FY2023-24'", "target_value": _pick("o_orderkey", ["'10'", "'20.25'", "null", "'n/a'"]),
        "actual_value": _text("o_orderkey%500"), "status": _pick("o_orderkey", _STATUS),
        "data_source": _gap("o_orderkey", 8, "'MIS'"), "verified_by": _ref("STF-", "o_orderkey", 10),
    }),
    "expenses": _view("expenses", "{lineitem}", {
        "expense_id": f"'EXP-'||{_text('l_orderkey')}||'-'||{_text('l_linenumber')}", "program_id": _program("l_partkey"),
        "category": "'Personnel '", "amount_inr": _pick("l_partkey", ["'5000'", "'99.99'", "'123.456'", "'-7'", "null"]),
        "expense_date": _date("l_orderkey"), "fiscal_year": "'FY2023-24'", "approved_by": _ref("STF-", "l_suppkey", 10),
        "receipt_available": _pick("l_orderkey", ["'1'", "'0'", "null"]),
    }),
}


# A column of each dimension that is never missing.
LABEL = {
    "regions": "state", "programs": "program_name", "donors": "donor_name", "staff": "full_name",
    "beneficiaries": "full_name", "interventions": "title", "impact_indicators": "indicator_name",
}


def star_sql() -> str:
    """Rows and matched dimension rows of every fact."""
    parts = []
    for fact in dict.fromkeys(e.fact for e in model.STAR_EDGES):
        edges = model.star_edges_of(fact)
        joins = " ".join(
            f"{e.how} join {e.dimension}_raw d{i} on f.{e.column} = d{i}.{model.PRIMARY_KEY[e.dimension]}"
            for i, e in enumerate(edges)
        )
        matched = " + ".join(f"count(d{i}.{LABEL[e.dimension]})" for i, e in enumerate(edges))
        parts.append(
            f"select '{fact}' fact, count(*) n_rows, {matched} n_matched from {fact}_raw f {joins}"
        )
    return " union all ".join(parts)


def keys_sql() -> str:
    return " union all ".join(
        f"""select '{t}' table_name, cast(sum(n) as bigint) n_rows, count(k) n_keys,
          count(*) filter (where n > 1) n_repeated
        from (select {model.PRIMARY_KEY[t]} k, count(*) n from {t}_raw group by 1) x"""
        for t in VIEWS
    )


# -- the cleaner in SQL ------------------------------------------------------


def number(x: str) -> str:
    return f"(case when abs(try_cast({x} as double)) < cast('inf' as double) then try_cast({x} as double) end)"


def _edited(table: str, column: str, to_date, mapped) -> str:
    """A column after dates, categories and bounds."""
    if column in RULES.date_columns.get(table, ()):
        return to_date(column)
    maps = RULES.value_maps(table)
    if column in maps:
        return f"coalesce({mapped(column, maps[column])}, {column})"
    if column in RULES.bounds:
        low, high = RULES.bounds[column]
        tests = [f"{number(column)}<{low}"] + ([f"{number(column)}>{high}"] if high is not None else [])
        if column in COLUMN_BOUNDS:
            tests.append(f"{number(column)}>{number(COLUMN_BOUNDS[column])}")
        return f"case when not coalesce({' or '.join(f'coalesce({t}, false)' for t in tests)}, false) then {column} end"
    return column


def _final(table: str, column: str, kind: str) -> str:
    """A column after fills, references and casts."""
    how = RULES.fill.get(table, {}).get(column)
    x = column
    if how == "median":
        x = f"coalesce({number(x)}, (select median({number(x)}) from {table}_s))"
    elif how == "unknown":
        x = f"coalesce({x}, 'Unknown')"
    elif how == "zero":
        x = f"coalesce({x}, '0')"
    for ref in model.references_of(table):
        if ref.column == column:
            x = f"case when {x} in (select trim({model.PRIMARY_KEY[ref.parent]}) from {ref.parent}_d) then {x} end"
    if kind == "date":
        return x
    if column in RULES.integer_columns:
        return f"cast(floor({number(x)}+0.5) as int)"
    if column in RULES.float_columns:
        return f"cast({number(x)} as decimal(15,2))" if kind.startswith("decimal") else number(x)
    return f"trim({x})"


def clean_sql(deduped, to_date, mapped) -> tuple[str, list[str]]:
    """Query and CTEs: every cell as (table_name, record_id, column_name, value)."""
    steps, cells = [], []
    for table in model.CLEANING_ORDER:
        fields = [(f.name, f.dataType.simpleString()) for f in model.clean_schema(table)]
        pk, keys = model.PRIMARY_KEY[table], RULES.match_keys.get(table, ())
        if keys:
            steps.append(deduped(f"{table}_d", f"{table}_raw", pk, keys))
        else:
            steps.append(f"{table}_d as (select * from {table}_raw where not contains({pk}, '-DUP'))")
        edited = ", ".join(f"{_edited(table, c, to_date, mapped)} {c}" for c, _ in fields)
        steps.append(f"{table}_s as (select {edited} from {table}_d)")
        for c, kind in fields:
            value = f"cast({_final(table, c, kind)} as varchar)"
            cells.append(
                f"select '{table}' table_name, trim({pk}) record_id, '{c}' column_name, {value} \"value\" from {table}_s"
            )
    return " union all ".join(cells), steps


def _affected(table: str, columns: list[str], to_date, mapped) -> list[tuple[str, str]]:
    """The steps after deduplication with the SQL of what they count."""

    def n(condition: str, source: str) -> str:
        return f"(select count(*) from {source} where {condition})"

    d, s = f"{table}_d", f"{table}_s"
    maps = [n(f"{mapped(c, m)} <> {c}", d) for c, m in RULES.value_maps(table).items() if c in columns]
    outside = []
    for c in (c for c in RULES.bounds if c in columns):
        low, high = RULES.bounds[c]
        tests = [f"{number(c)}<{low}"] + ([f"{number(c)}>{high}"] if high is not None else [])
        if COLUMN_BOUNDS.get(c) in columns:
            tests.append(f"{number(c)}>{number(COLUMN_BOUNDS[c])}")
        outside.append(n(" or ".join(f"coalesce({t}, false)" for t in tests), d))
    fills = [
        n(f"{c} is null" if how != "median" else f"{c} is null and (select median({number(c)}) from {s}) is not null", s)
        for c, how in RULES.fill.get(table, {}).items()
        if c in columns and how != "skip"
    ]
    broken = [
        n(f"{r.column} is not null and {r.column} not in (select trim({model.PRIMARY_KEY[r.parent]}) from {r.parent}_d)", s)
        for r in model.references_of(table)
    ]
    typed = sum(c in RULES.integer_columns or c in RULES.float_columns for c in columns)
    dates = sum(c in columns for c in RULES.date_columns.get(table, ()))
    return [
        ("date_normalisation", str(dates)),
        ("categorical_standardisation", " + ".join(maps) or "0"),
        ("outlier_treatment", " + ".join(outside) or "0"),
        ("imputation", " + ".join(fills) or "0"),
        *(("referential_integrity", b) for b in broken),
        ("type_casting", str(typed)),
    ]


def audit_sql(to_date, mapped) -> str:
    """The audit of all twelve tables, over the steps of :func:`clean_sql`."""
    rows = []
    for table in model.CLEANING_ORDER:
        columns = [f.name for f in model.clean_schema(table)]
        before, after = f"(select count(*) from {table}_raw)", f"(select count(*) from {table}_d)"
        steps = [("deduplication", before, f"{before} - {after}")]
        steps += [(name, after, found) for name, found in _affected(table, columns, to_date, mapped)]
        rows += [
            f"select '{table}' table_name, cast({i} as int) step_no, '{name}' step, {had} rows_before, "
            f"{after} rows_after, cast({found} as bigint) rows_affected"
            for i, (name, had, found) in enumerate(steps, 1)
        ]
    return " union all ".join(rows)
