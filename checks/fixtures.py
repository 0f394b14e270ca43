"""Views over the given tables that have the schemas of :mod:`tallygrove.model`.

One SQL text per view, run unchanged by Spark and by DuckDB; ``{name}`` marks
a table of the test data.  See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks import whole

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def fy(x: str) -> str:
    return (
        f"(case when month({x})>=4 then 'FY'||cast(year({x}) as string)||'-'||"
        f"substr(cast(year({x})+1 as string),3,2) else 'FY'||cast(year({x})-1 as string)"
        f"||'-'||substr(cast(year({x}) as string),3,2) end)"
    )


def quarter(x: str) -> str:
    return (
        f"(case when month({x}) between 4 and 6 then '1' when month({x}) between 7 and 9 "
        f"then '2' when month({x})>=10 then '3' else '4' end)"
    )


_YEAR = "cast(2021+c_custkey%4 as string)"
_MONTH = "lpad(cast(1+c_custkey%12 as string),2,'0')"
_DAY = "lpad(cast(1+c_custkey%28 as string),2,'0')"

# Nine letters for each month.
_MONTH_NAME = (
    "trim(substr('January  February March    April    May      June     July     August   "
    "SeptemberOctober  November December ',cast(mm as int)*9-8,9))"
)

VIEWS: dict[str, str] = {
    "regions": """
        select n_nationkey region_id, r_name state, n_name district,
          case n_nationkey%4 when 0 then 'Urban' when 1 then 'Semi-Urban'
            when 2 then 'Rural' else 'Tribal' end region_type
        from {nation} join {region} on n_regionkey=r_regionkey""",
    "programs": """
        select p_brand program_id, 'Programme '||p_brand program_name,
          'Sector '||cast(cast(substr(p_brand,7) as int)%10 as string) sector,
          cast(substr(p_brand,7) as int)-1 region_id,
          case when cast(substr(p_brand,7) as int)%3=0 then 'Completed' else 'Active' end status
        from (select distinct p_brand from {part}) b""",
    "impact_indicators": """
        select p_type indicator_id, 'IND-'||p_type iris_id, p_type indicator_name,
          'Count' unit,
          case when p_type in ('SMALL','PROMO') then 'Output' else 'Outcome' end category
        from (select distinct p_type from {part}) b""",
    "outcome_tracking": f"""
        select p_brand||'|'||p_type||'|'||rp outcome_id, p_brand program_id,
          p_type indicator_id, rp reporting_period, cast(count(*)*26 as double) target_value,
          sum(l_quantity) actual_value,
          case when count(*)%3=0 then 'MIS Database' else 'Field Survey' end data_source,
          case when count(*)%5=0 then null else 'STF-1' end verified_by
        from (select p_brand, p_type, l_quantity,
                'Q'||{quarter('l_shipdate')}||'-'||{fy('l_shipdate')} rp
              from {{lineitem}} join {{part}} on l_partkey=p_partkey) x
        group by p_brand, p_type, rp""",
    "expenses": f"""
        select cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||
            cast(l_partkey as string)||'-'||cast(l_suppkey as string) expense_id,
          p_brand program_id,
          case l_returnflag||l_linestatus when 'AF' then 'Personnel'
            when 'AO' then 'Travel & Field' when 'NF' then 'Monitoring & Evaluation'
            when 'NO' then 'Administrative Overhead' when 'RF' then 'Infrastructure'
            else 'Materials & Supplies' end category,
          l_extendedprice amount_inr, {fy('l_shipdate')} fiscal_year
        from {{lineitem}} join {{part}} on l_partkey=p_partkey""",
    "funding": f"""
        select o_orderkey funding_id, o_custkey donor_id,
          'Brand#'||cast(o_orderkey%25+1 as string) program_id, o_totalprice amount_inr,
          {fy('o_orderdate')} fiscal_year
        from {{orders}}""",
    "beneficiaries": """
        select c_custkey beneficiary_id, c_name full_name,
          case when c_custkey%17=0 then null else cast((c_custkey*7)%95 as int) end age,
          case c_custkey%5 when 0 then 'Male' when 1 then 'Female' when 2 then 'Female'
            when 3 then 'Unknown' else null end gender,
          c_mktsegment education_level,
          case when c_acctbal<1000 then 'BPL (Below 1 lakh)' when c_acctbal<5000 then 'LIG'
            when c_acctbal<9000 then 'MIG' else 'HIG' end income_bracket,
          c_nationkey region_id, 'Brand#'||cast(c_custkey%26+1 as string) program_id,
          cast(c_custkey%9+1 as int) household_size,
          case when c_custkey%11=0 then null when c_custkey%8=0 then 1 else 0 end is_disabled
        from {customer}""",
    "service_delivery": """
        select o_orderkey delivery_id, o_custkey beneficiary_id,
          o_orderkey%150 intervention_id, cast(o_orderdate as date) delivery_date
        from {orders} where o_orderstatus='F'""",
    "assessments": """
        select event_id assessment_id,
          case when event_id%53=0 then null else user_id end beneficiary_id,
          case event_type when 'view' then 'Pre-Test' when 'purchase' then 'Post-Test'
            else 'Spot Check' end assessment_type,
          cast(ts as date) assessment_date, value score, cast(500 as double) max_score
        from {events}""",
    "beneficiaries_dirty": f"""
        select id beneficiary_id, nm full_name,
          case c_custkey%50 when 0 then '999' when 1 then '-5' when 2 then 'abc'
            when 3 then null else cast((c_custkey*7)%95 as string) end age,
          case c_custkey%9 when 0 then 'male' when 1 then 'MALE' when 2 then 'M'
            when 3 then 'Female ' when 4 then ' f' when 5 then 'nb' when 6 then 'other'
            when 7 then 'prefer not to say' else null end gender,
          case when c_custkey%7=0 then null
            else '+91-'||cast(6000000000+c_custkey as string) end phone,
          case when c_custkey%41=0 then '99' else cast(c_nationkey as string) end region_id,
          case c_custkey%8 when 0 then yy||'-'||mm||'-'||dd when 1 then dd||'/'||mm||'/'||yy
            when 2 then dd||'-'||substr('JanFebMarAprMayJunJulAugSepOctNovDec',
              cast(mm as int)*3-2,3)||'-'||substr(yy,3,2)
            when 3 then mm||'-'||dd||'-'||yy when 4 then dd||'.'||mm||'.'||yy
            when 5 then yy||'/'||mm||'/'||dd when 6 then
              case c_custkey%5 when 0 then 'not a date' when 1 then yy||mm||dd
                when 2 then dd||' '||{_MONTH_NAME}||' '||yy
                when 3 then {_MONTH_NAME}||' '||dd||', '||yy else yy||'.'||mm||'.'||dd end
            else null end registration_date,
          case when c_custkey%23=0 then '0' when c_custkey%29=0 then '40'
            when c_custkey%31=0 then null else cast(c_custkey%9+1 as string) end household_size,
          case when c_custkey%12=0 then null else c_mktsegment end education_level
        from (
          select c.*, {_YEAR} yy, {_MONTH} mm, {_DAY} dd,
            'BEN-'||cast(c_custkey as string) id, c_name nm from {{customer}} c
          union all
          select c.*, {_YEAR}, {_MONTH}, {_DAY},
            'BEN-'||cast(c_custkey as string)||'-DUP', c_name
          from {{customer}} c where c_custkey%33=0
          union all
          select c.*, {_YEAR}, {_MONTH}, {_DAY},
            'BEN-'||cast(c_custkey as string)||'-DUP', c_name
          from {{customer}} c where c_custkey%99=0
          union all
          select c.*, {_YEAR}, {_MONTH}, {_DAY}, 'BEN-'||cast(c_custkey as string), c_name
          from {{customer}} c where c_custkey%70=5
          union all
          select c.*, {_YEAR}, {_MONTH}, {_DAY}, 'BEN-'||cast(c_custkey as string), c_name
          from {{customer}} c where c_custkey%140=5
          union all
          select c.*, {_YEAR}, {_MONTH}, {_DAY},
            'BEN-'||cast(c_custkey+1000000 as string), ' '||upper(c_name)
          from {{customer}} c where c_custkey%50=4) x""",
    "service_delivery_dirty": """
        select cast(o_orderkey as string) delivery_id,
          'BEN-'||cast(case when o_orderkey%97=0 then 9999999 else o_custkey end as string)
            beneficiary_id,
          case o_orderkey%7 when 0 then 'completed' when 1 then 'C' when 2 then 'no show'
            when 3 then 'n' when 4 then ' Canceled' when 5 then 'P' else 'Scheduled' end status,
          case when o_orderkey%13=0 then null when o_orderkey%37=0 then '75'
            else cast(o_orderkey%6 as string) end dosage
        from {orders}""",
    "assessments_dirty": """
        select cast(event_id as string) assessment_id,
          'BEN-'||cast(user_id as string) beneficiary_id,
          case event_id%6 when 0 then 'pre-test' when 1 then 'PRE TEST' when 2 then 'posttest '
            when 3 then 'Post-Test' when 4 then 'P' else 'Spot Check' end assessment_type,
          case when event_id%50=0 then '9999' when event_id%50=1 then '-1'
            when event_id%50=2 then null else cast(value as string) end score,
          '100' max_score
        from {events}""",
    "regions_dirty": """
        select cast(n_nationkey as string) region_id, r_name state, n_name district
        from {nation} join {region} on n_regionkey=r_regionkey""",
}

VIEWS |= {f"{name}_raw": text for name, text in whole.VIEWS.items()}

CLEAN_TABLES = (
    "regions", "programs", "impact_indicators", "outcome_tracking", "expenses", "funding",
    "beneficiaries", "service_delivery", "assessments",
)
DIRTY_TABLES = ("regions", "beneficiaries", "service_delivery", "assessments")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = [t for t in BASE_TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: base_table(spark, sf_dir, t) for t in used})


class Sample(dict):
    """Tables by name, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, suffix: str = "", names=CLEAN_TABLES):
        super().__init__()
        self.spark, self.sf_dir, self.suffix, self.names = spark, sf_dir, suffix, names
        # Dates and quarters must not depend on where the session runs.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        self[name] = view(self.spark, self.sf_dir, name + self.suffix)
        return self[name]

    def all(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in self.names}


def clean_sample(spark: SparkSession, sf_dir: str) -> Sample:
    return Sample(spark, sf_dir)


def dirty_sample(spark: SparkSession, sf_dir: str) -> Sample:
    return Sample(spark, sf_dir, "_dirty", DIRTY_TABLES)


def raw_sample(spark: SparkSession, sf_dir: str) -> Sample:
    """All twelve tables as text, with every declared column."""
    return Sample(spark, sf_dir, "_raw", tuple(whole.VIEWS))


def duckdb_views(names: list[str] | tuple[str, ...]) -> str:
    """The views as the CTE list of a DuckDB query."""
    tables = {t: t for t in BASE_TABLES}
    return ",\n".join(f"{name} as ({VIEWS[name].format(**tables)})" for name in names)
