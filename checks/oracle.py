"""DuckDB SQL for every registered query, over the whole given tables.

The texts take the plain road (one branch per dimension, windows and
self-joins, all pairs of a block) where the library takes the scalable one.
"""

from __future__ import annotations

from checks import whole
from checks.fixtures import CLEAN_TABLES, duckdb_views, fy, quarter
from tallygrove import model
from tallygrove.rules import (
    ASSESSMENT_TYPES,
    GENDERS,
    MATCH_KEYS,
    MONITORED_NULLS,
    SERVICE_STATUSES,
)

ORACLE: dict[str, str] = {}


def with_views(names: str, body: str, *more: str) -> str:
    parts = [duckdb_views(names.split())] + list(more)
    return "with " + ",\n".join(p for p in parts if p) + "\n" + body


def R(x: str, n: int) -> str:
    return f"(sign({x})*floor(abs({x})*1e{n}+0.5)/1e{n}+0.0)"


def T(x: str) -> str:
    return f"cast(sign({x})*floor(abs({x})*1e1+0.5) as bigint)"


def ratio(a: str, b: str) -> str:
    return f"(cast({a} as double)/nullif(cast({b} as double),0))"


def pct(a: str, b: str) -> str:
    return f"(cast({a} as double)*1e2/nullif(cast({b} as double),0))"


def money(x: str) -> str:
    return f"(cast(sum(cast(round({x}*1e2) as bigint)) as bigint)/1e2)"


def money_when(p: str, x: str) -> str:
    return f"(cast(sum(case when {p} then cast(round({x}*1e2) as bigint) else 0 end) as bigint)/1e2)"


def mean_tenths(t: str) -> str:
    return R(f"(cast(sum({t}) as double)/nullif(count({t})*1e1,0))", 1)


def n_where(p: str) -> str:
    return f"cast(count(*) filter (where {p}) as bigint)"


def light(x: str, green: float, amber: float) -> str:
    return f"case when {x}>={green} then 'GREEN' when {x}>={amber} then 'AMBER' else 'RED' end"


# -- flat views --------------------------------------------------------------

SPEND = f"""spend as (
  select program_id, fiscal_year, {money('amount_inr')} total_spend_inr,
    {money_when("category='Personnel'", 'amount_inr')} personnel_inr,
    {money_when("category='Monitoring & Evaluation'", 'amount_inr')} me_inr
  from expenses group by program_id, fiscal_year)"""
OUTCOMES = f"""outcomes as (
  select program_id, indicator_id, substr(reporting_period,4) fiscal_year,
    sum(target_value) total_target, sum(actual_value) total_actual,
    {R(pct('sum(actual_value)', 'sum(target_value)'), 1)} achievement_pct
  from outcome_tracking where actual_value is not null and actual_value>0
  group by program_id, indicator_id, substr(reporting_period,4))"""
V_COST = f"""v_cost_per_impact as (
  select p.program_id, p.program_name, p.sector, p.status program_status, r.state, r.district,
    r.region_type, ii.iris_id, ii.indicator_name, ii.unit indicator_unit,
    ii.category indicator_category, po.fiscal_year, po.total_target, po.total_actual,
    po.achievement_pct, ps.total_spend_inr,
    {R(ratio('ps.total_spend_inr', 'po.total_actual'), 2)} cost_per_unit_inr,
    {R(pct('ps.personnel_inr', 'ps.total_spend_inr'), 1)} personnel_pct,
    {R(pct('ps.me_inr', 'ps.total_spend_inr'), 1)} me_investment_pct,
    cast(dense_rank() over (partition by ii.iris_id
      order by {ratio('ps.total_spend_inr', 'po.total_actual')} nulls first) as int) efficiency_rank
  from outcomes po join programs p on po.program_id=p.program_id
    join impact_indicators ii on po.indicator_id=ii.indicator_id
    left join spend ps on po.program_id=ps.program_id and po.fiscal_year=ps.fiscal_year
    left join regions r on p.region_id=r.region_id
  where ps.total_spend_inr is not null and po.total_actual>0)"""
COST = (SPEND, OUTCOMES, V_COST)
COST_TABLES = "regions programs impact_indicators outcome_tracking expenses"

_Q = "cast(substr(reporting_period,2,1) as int)"
_F = "substr(reporting_period,4)"
_ASC = f"(partition by ot.program_id, ot.indicator_id order by {_F} nulls first, {_Q} nulls first, outcome_id)"
_DESC = (
    f"(partition by ot.program_id, ot.indicator_id order by {_F} desc nulls last, "
    f"{_Q} desc nulls last, outcome_id desc)"
)
_ROWS = _ASC[:-1] + " rows between unbounded preceding and current row)"
V_PROGRESS = f"""v_programme_progress as (
  select ot.outcome_id, p.program_id, p.program_name, p.sector, p.status program_status,
    r.state, r.region_type, ii.iris_id, ii.indicator_name, ii.category indicator_category,
    ot.reporting_period, {_Q} quarter_num, {_F} fiscal_year, ot.target_value, ot.actual_value,
    {R(pct('ot.actual_value', 'ot.target_value'), 1)} achievement_pct,
    lag(ot.actual_value) over {_ASC} prev_quarter_actual,
    sum(ot.actual_value) over {_ROWS} cumulative_actual,
    sum(ot.target_value) over {_ROWS} cumulative_target,
    {light(pct('ot.actual_value', 'ot.target_value'), 90, 70)} rag_status,
    case when ot.verified_by is not null then 'Verified' else 'Unverified' end verification_status,
    ot.data_source, cast(row_number() over {_DESC} as int) recency_rank
  from outcome_tracking ot join programs p on ot.program_id=p.program_id
    join impact_indicators ii on ot.indicator_id=ii.indicator_id
    left join regions r on p.region_id=r.region_id
  where ot.actual_value is not null)"""
PROGRESS_TABLES = "regions programs impact_indicators outcome_tracking"

COHORT = """case when age is null then 'Unknown' when age<6 then '0-5 (Early Childhood)'
  when age between 6 and 14 then '6-14 (School Age)' when age between 15 and 24 then '15-24 (Youth)'
  when age between 25 and 44 then '25-44 (Working Age)'
  when age between 45 and 59 then '45-59 (Middle Age)' else '60+ (Senior)' end"""
STAGE = """case when age is null then 'Unknown' when age<15 then 'Child (0-14)'
  when age between 15 and 24 then 'Youth (15-24)' when age between 25 and 59 then 'Adult (25-59)'
  else 'Senior (60+)' end"""
DISABILITY = """case when is_disabled=1 then 'Person with Disability'
  when is_disabled=0 then 'No Disability' else 'Not Recorded' end"""

V_PEOPLE = f"""v_beneficiary_360 as (
  select b.beneficiary_id, b.full_name, b.age, {COHORT} age_cohort, b.gender, b.education_level,
    b.income_bracket, b.household_size, {DISABILITY} disability_status,
    cast(null as date) registration_date, p.program_id, p.program_name, p.sector, r.state,
    r.district, r.region_type, coalesce(s.n,0) services_received, coalesce(s.u,0) unique_interventions,
    case when coalesce(s.n,0)>0 then 'Active' else 'Registered Only' end beneficiary_status,
    coalesce(a.n,0) assessments_taken, a.best latest_score_pct
  from beneficiaries b left join programs p on b.program_id=p.program_id
    left join regions r on b.region_id=r.region_id
    left join (select beneficiary_id, count(delivery_id) n, count(distinct intervention_id) u
               from service_delivery group by beneficiary_id) s on b.beneficiary_id=s.beneficiary_id
    left join (select beneficiary_id, count(assessment_id) n,
                 {R('max(case when score is not null and max_score>0 then score*1e2/max_score end)', 1)} best
               from assessments group by beneficiary_id) a on b.beneficiary_id=a.beneficiary_id)"""
PEOPLE_TABLES = "regions programs beneficiaries service_delivery assessments"

PAIRS = f"""pre as (
  select beneficiary_id, assessment_id, assessment_date d, {T('score*1e2/nullif(max_score,0)')} t,
    row_number() over (partition by beneficiary_id order by assessment_date nulls first, assessment_id) rn
  from assessments where assessment_type='Pre-Test' and score is not null and max_score>0),
post as (
  select beneficiary_id, assessment_id, assessment_date d, {T('score*1e2/nullif(max_score,0)')} t,
    row_number() over (partition by beneficiary_id order by assessment_date desc nulls last, assessment_id) rn
  from assessments where assessment_type='Post-Test' and score is not null and max_score>0),
pairs as (
  select pre.beneficiary_id, pre.d pre_date, pre.t pre_t, post.d post_date, post.t post_t,
    post.t-pre.t gain_t, {T('(cast((post.t-pre.t)*100 as double)/nullif(pre.t,0))')} effect_t,
    cast(date_diff('day', pre.d, post.d) as int) days_between_tests,
    case when post.t>pre.t then 'Improved' when post.t=pre.t then 'No Change'
      else 'Declined' end outcome_direction
  from pre join post on pre.beneficiary_id=post.beneficiary_id
  where pre.rn=1 and post.rn=1 and post.d>pre.d)"""
V_PAIRS = """v_outcome_effectiveness as (
  select m.beneficiary_id, b.full_name, b.gender, b.age, b.income_bracket,
    case when b.is_disabled=1 then 'PwD' else 'No' end is_pwd, p.program_id, p.program_name,
    p.sector, r.state, r.region_type, pre_date, pre_t/1e1 pre_score_pct, post_date,
    post_t/1e1 post_score_pct, gain_t/1e1 improvement_pct, effect_t/1e1 effect_size_pct,
    days_between_tests, outcome_direction
  from pairs m join beneficiaries b on m.beneficiary_id=b.beneficiary_id
    left join programs p on b.program_id=p.program_id
    left join regions r on b.region_id=r.region_id)"""
PAIR_TABLES = "regions programs beneficiaries assessments"

V_FINANCE = f"""v_financial_overview as (
  select p.program_id, p.program_name, p.sector, p.status program_status, r.state, r.region_type,
    fy.fiscal_year, coalesce(f.total,0.0) total_funding_inr, coalesce(f.donors,0) donor_count,
    coalesce(e.total,0.0) total_expense_inr,
    {R('(coalesce(f.total,0.0)-coalesce(e.total,0.0))', 2)} net_balance_inr,
    {R(pct('coalesce(e.total,0.0)', 'coalesce(f.total,0.0)'), 1)} burn_rate_pct,
    coalesce(e.personnel,0.0) personnel_inr, coalesce(e.field,0.0) field_inr,
    coalesce(e.me,0.0) me_inr, coalesce(e.overhead,0.0) overhead_inr
  from programs p left join regions r on p.region_id=r.region_id
    cross join (select distinct fiscal_year from expenses
                union select distinct fiscal_year from funding) fy
    left join (select program_id, fiscal_year, {money('amount_inr')} total,
                 count(distinct donor_id) donors from funding group by program_id, fiscal_year) f
      on p.program_id=f.program_id and fy.fiscal_year=f.fiscal_year
    left join (select program_id, fiscal_year, {money('amount_inr')} total,
        {money_when("category='Personnel'", 'amount_inr')} personnel,
        {money_when("category='Travel & Field'", 'amount_inr')} field,
        {money_when("category='Monitoring & Evaluation'", 'amount_inr')} me,
        {money_when("category='Administrative Overhead'", 'amount_inr')} overhead
      from expenses group by program_id, fiscal_year) e
      on p.program_id=e.program_id and fy.fiscal_year=e.fiscal_year)"""
FINANCE_TABLES = "regions programs expenses funding"


def from_cost(body: str) -> str:
    return with_views(COST_TABLES, body, *COST)


def from_progress(body: str) -> str:
    return with_views(PROGRESS_TABLES, body, V_PROGRESS)


def from_people(body: str) -> str:
    return with_views(PEOPLE_TABLES, body, V_PEOPLE)


def from_pairs(body: str) -> str:
    return with_views(PAIR_TABLES, body, PAIRS, V_PAIRS)


def from_finance(body: str) -> str:
    return with_views(FINANCE_TABLES, body, V_FINANCE)


ORACLE["v_cost_per_impact"] = from_cost("select * from v_cost_per_impact")
ORACLE["v_programme_progress"] = from_progress("select * from v_programme_progress")
ORACLE["v_beneficiary_360"] = from_people("select * from v_beneficiary_360")
ORACLE["v_outcome_effectiveness"] = from_pairs("select * from v_outcome_effectiveness")
ORACLE["v_financial_overview"] = from_finance("select * from v_financial_overview")

_SHAPES = {
    "v_cost_per_impact": 20,
    "v_programme_progress": 23,
    "v_beneficiary_360": 21,
    "v_outcome_effectiveness": 19,
    "v_financial_overview": 16,
}
ORACLE["view_catalog"] = with_views(
    " ".join(CLEAN_TABLES),
    " union all ".join(
        f"select '{v}' view_name, count(*) n_rows, cast({n} as int) n_columns from {v}"
        for v, n in _SHAPES.items()
    ),
    *COST, V_PROGRESS, V_PEOPLE, PAIRS, V_PAIRS, V_FINANCE,
)

# -- KPI reports -------------------------------------------------------------

ORACLE["kpi1_cost_per_impact"] = from_cost(
    """select program_name, sector, fiscal_year, iris_id, indicator_name, indicator_unit,
    total_target, total_actual, achievement_pct, total_spend_inr, cost_per_unit_inr,
    personnel_pct, me_investment_pct, efficiency_rank from v_cost_per_impact"""
)
MOMENTUM = """case when prev_quarter_actual is null then 'N/A (First Quarter)'
  when actual_value>prev_quarter_actual then '↑ Improving'
  when actual_value=prev_quarter_actual then '→ Stable' else '↓ Declining' end"""
ORACLE["kpi2_programme_progress"] = from_progress(
    f"""select program_name, sector, program_status, iris_id, indicator_name, indicator_category,
    reporting_period, fiscal_year, quarter_num, target_value, actual_value, achievement_pct,
    cumulative_target, cumulative_actual,
    {R(pct('cumulative_actual', 'cumulative_target'), 1)} cumulative_achievement_pct,
    prev_quarter_actual,
    {R(pct('(actual_value-prev_quarter_actual)', 'prev_quarter_actual'), 1)} qoq_growth_pct,
    {MOMENTUM} momentum, rag_status, verification_status, data_source, recency_rank
  from v_programme_progress"""
)


def _reach(dimension: str, column: str, shown: str) -> str:
    return f"""select '{dimension}' dimension, {shown} dimension_value, count(*) registered,
      cast(sum(active) as bigint) active,
      {R('(cast(sum(case when active=1 then n end) as double)/nullif(sum(active),0))', 1)} avg_n,
      {R('(cast(sum(case when active=1 then u end) as double)/nullif(sum(active),0))', 1)} avg_u
    from person group by {column}"""


_REACH = " union all ".join(
    _reach(d, c, s)
    for d, c, s in (
        ("Gender", "gender", "coalesce(gender,'Unknown')"),
        ("Age Cohort", "age_cohort", "age_cohort"),
        ("Income Bracket", "income_bracket", "coalesce(income_bracket,'Unknown')"),
        ("Region Type", "region_type", "coalesce(region_type,'Unknown')"),
        ("Disability Status", "is_disabled", DISABILITY),
        ("Education Level", "education_level", "coalesce(education_level,'Unknown')"),
        ("Program Sector", "sector", "coalesce(sector,'Unassigned')"),
        ("State", "state", "coalesce(state,'Unknown')"),
    )
)
ORACLE["kpi3_demographic_reach"] = with_views(
    "regions programs beneficiaries service_delivery",
    f"""select dimension, dimension_value, registered total_registered, active total_active,
      {R(pct('active', 'registered'), 1)} activation_rate_pct, avg_n avg_services_per_active,
      avg_u avg_unique_interventions,
      {R(pct('registered', 'sum(registered) over (partition by dimension)'), 1)} pct_of_total
    from stacked""",
    f"""person as (
      select b.beneficiary_id, b.gender, b.income_bracket, b.education_level, b.is_disabled,
        r.region_type, r.state, p.sector, {COHORT} age_cohort, count(sd.delivery_id) n,
        count(distinct sd.intervention_id) u,
        case when count(sd.delivery_id)>0 then 1 else 0 end active
      from beneficiaries b left join service_delivery sd on b.beneficiary_id=sd.beneficiary_id
        left join regions r on b.region_id=r.region_id
        left join programs p on b.program_id=p.program_id
      group by b.beneficiary_id, b.gender, b.income_bracket, b.education_level, b.is_disabled,
        r.region_type, r.state, p.sector, b.age)""",
    f"stacked as ({_REACH})",
)
ORACLE["kpi4_outcome_effectiveness"] = with_views(
    "programs beneficiaries assessments",
    f"""select coalesce(program_name,'All Programs') program_name,
      coalesce(sector,'All Sectors') sector, count(*) matched_pairs_count,
      {mean_tenths('gain_t')} avg_improvement_pct, {mean_tenths('pre_t')} avg_baseline_score,
      {mean_tenths('post_t')} avg_endline_score, {mean_tenths('effect_t')} avg_effect_size_pct,
      {n_where("outcome_direction='Improved'")} n_improved,
      {n_where("outcome_direction='Declined'")} n_declined,
      {n_where("outcome_direction='No Change'")} n_no_change,
      {R(pct(n_where("outcome_direction='Improved'"), 'count(*)'), 1)} pct_improved,
      {R('(cast(sum(days_between_tests) as double)/count(*))', 0)} avg_days_between_tests,
      {n_where("gender='Female'")} female_count, {n_where('is_disabled=1')} pwd_count,
      {n_where("income_bracket ilike 'BPL%'")} bpl_count
    from pairs m join beneficiaries b on m.beneficiary_id=b.beneficiary_id
      left join programs p on b.program_id=p.program_id
    group by program_name, sector""",
    PAIRS,
)

# -- dashboard ---------------------------------------------------------------

ORACLE["dash_filter"] = with_views(
    COST_TABLES,
    """select 'latest year' as "filter", outcome_id from v_programme_progress
       where fiscal_year=(select max(fiscal_year) from v_cost_per_impact)
    union all select 'all four', outcome_id from v_programme_progress
       where fiscal_year='FY1996-97' and program_name in ('Programme Brand#3','Programme Brand#13')
         and state='EUROPE' and sector='Sector 3'
    union all select 'sector', outcome_id from v_programme_progress where sector='Sector 3'""",
    *COST, V_PROGRESS,
)
ORACLE["star_join"] = with_views(
    "beneficiaries programs regions",
    """select beneficiary_id, p.program_name programs_program_name, p.sector programs_sector,
      p.status programs_status, r.state regions_state, r.district regions_district,
      r.region_type regions_region_type
    from beneficiaries b left join programs p on b.program_id=p.program_id
      left join regions r on b.region_id=r.region_id""",
)
ORACLE["star_join_inner"] = with_views(
    "beneficiaries service_delivery",
    """select delivery_id, delivery_date, gender beneficiaries_gender,
      income_bracket beneficiaries_income_bracket
    from service_delivery s join beneficiaries b on s.beneficiary_id=b.beneficiary_id""",
)
ORACLE["star_keys"] = with_views(
    "regions programs impact_indicators beneficiaries",
    " union all ".join(
        f"""select '{t}' table_name, cast(sum(n) as bigint) n_rows, count(k) n_keys,
          {n_where('n>1')} n_repeated
        from (select {model.PRIMARY_KEY[t]} k, count(*) n from {t} group by 1) x"""
        for t in ("regions", "programs", "impact_indicators", "beneficiaries")
    ),
)
ORACLE["dash_card_cost"] = from_cost(
    f"""select fiscal_year, {R('c', 2)} cost_per_impact, {R(pct('(c-prior)', 'prior'), 1)} change_pct,
      case when c<=200 then 'GREEN' when c<=500 then 'AMBER' else 'RED' end rag_status
    from (select fiscal_year, c, lag(c) over (order by fiscal_year nulls first) prior from (
      select fiscal_year, {ratio(money('total_spend_inr'), 'sum(total_actual)')} c
      from v_cost_per_impact group by fiscal_year) x) y"""
)
_QUARTERS = """(select fiscal_year, quarter_num, reporting_period, sum(actual_value) a,
  sum(target_value) t from v_programme_progress group by fiscal_year, quarter_num, reporting_period)"""
ORACLE["dash_card_achievement"] = from_progress(
    f"""select fiscal_year, reporting_period, {R('s', 1)} achievement_pct,
      {R('(s-prior)', 1)} change_pp, {light('s', 90, 70)} rag_status
    from (select fiscal_year, reporting_period, s, lag(s) over (order by fiscal_year, quarter_num) prior from (
      select *, coalesce({pct('a', 't')},0.0) s from {_QUARTERS} q) x) y"""
)
ORACLE["dash_card_reach"] = from_people(
    f"""select reached, registered, {R('s', 1)} activation_pct, {light('s', 80, 60)} rag_status
    from (select *, coalesce({pct('reached', 'registered')},0.0) s from (
      select {n_where("beneficiary_status='Active'")} reached, count(*) registered
      from v_beneficiary_360) x) y"""
)
ORACLE["dash_card_improved"] = from_pairs(
    f"""select {R('s', 1)} pct_improved, n_pairs, avg_improvement_pp, {light('s', 70, 50)} rag_status
    from (select *, coalesce({pct('i', 'n_pairs')},0.0) s from (
      select {n_where("outcome_direction='Improved'")} i, count(*) n_pairs,
        {mean_tenths(T('improvement_pct'))} avg_improvement_pp
      from v_outcome_effectiveness) x) y"""
)
ORACLE["dash_qoq"] = from_progress(
    f"""select fiscal_year, reporting_period, a total_actual, prior prior_actual,
      {R(pct('(a-prior)', 'prior'), 1)} qoq_growth_pct
    from (select *, lag(a) over (order by fiscal_year, quarter_num) prior from {_QUARTERS} q) x"""
)
ORACLE["dash_burn_rate"] = from_finance(
    f"""select e total_expense_inr, f total_funding_inr, coalesce({R(pct('e', 'f'), 1)},0.0) burn_rate_pct
    from (select {money('total_expense_inr')} e, {money('total_funding_inr')} f
      from v_financial_overview) x"""
)
ORACLE["dash_cost_bars"] = from_cost(
    f"""select program_name, sector, s total_spend_inr, a total_actual,
      {R(pct('a', 't'), 1)} achievement_pct, {R(ratio('s', 'a'), 2)} cost_per_unit_inr,
      {R(f"(select {ratio(money('total_spend_inr'), 'sum(total_actual)')} from v_cost_per_impact)", 2)}
        portfolio_cost_inr
    from (select program_name, sector, {money('total_spend_inr')} s, sum(total_actual) a,
      sum(total_target) t from v_cost_per_impact group by program_name, sector) x"""
)
_BEFORE = "lag(total_actual) over (partition by line order by fiscal_year, quarter_num)"
ORACLE["dash_trend_top5"] = from_progress(
    f"""select *, {R(pct(f'(total_actual-{_BEFORE})', _BEFORE), 1)} qoq_growth_pct,
      case when {_BEFORE} is null then 'N/A (First Quarter)' when total_actual>{_BEFORE} then '↑ Improving'
        when total_actual={_BEFORE} then '→ Stable' else '↓ Declining' end momentum from (
    select coalesce(b.program_name,'Other') line, fiscal_year, quarter_num, reporting_period,
      sum(actual_value) total_actual, sum(target_value) total_target,
      {R(pct('sum(actual_value)', 'sum(target_value)'), 1)} achievement_pct,
      {light(pct('sum(actual_value)', 'sum(target_value)'), 90, 70)} rag_status
    from v_programme_progress v left join (
      select program_name from v_programme_progress group by program_name
      order by sum(actual_value) desc, sum(target_value), program_name limit 5) b on v.program_name=b.program_name
    group by coalesce(b.program_name,'Other'), fiscal_year, quarter_num, reporting_period) x"""
)
_SHARE = " union all ".join(
    f"""select '{d}' dimension, coalesce({d},'Unknown') dimension_value, count(*) n,
      {n_where("beneficiary_status='Active'")} a from v_beneficiary_360 group by {d}"""
    for d in ("gender", "income_bracket", "region_type", "disability_status")
)
ORACLE["dash_demographic_share"] = from_people(
    f"""select dimension, dimension_value, n total_count,
      {R(pct('n', 'sum(n) over (partition by dimension)'), 1)} pct_of_total,
      {R(pct('a', 'n'), 1)} activation_rate_pct from ({_SHARE}) x"""
)
ORACLE["dash_outcome_heatmap"] = from_pairs(
    f"""select *, case when improvement_pp>10 then 'Green' when improvement_pp>0 then 'Yellow'
        else 'Red' end improvement_class,
      case when pct_improved>70 then 'Green' when pct_improved>=50 then 'Amber'
        else 'Red' end improved_class
    from (select program_name, sector, count(*) matched_pairs,
      {mean_tenths(T('pre_score_pct'))} baseline_score, {mean_tenths(T('post_score_pct'))} endline_score,
      {mean_tenths(T('improvement_pct'))} improvement_pp,
      {R(pct(n_where("outcome_direction='Improved'"), 'count(*)'), 1)} pct_improved,
      {R('(cast(sum(days_between_tests) as double)/count(*))', 0)} avg_days
      from v_outcome_effectiveness group by program_name, sector) x"""
)
ORACLE["dash_detail_page"] = from_people(
    """select beneficiary_id, full_name, age_cohort, gender, income_bracket, region_type,
      program_name, sector, services_received, beneficiary_status
    from v_beneficiary_360 where contains(lower(full_name), 'customer#0')
    order by services_received desc, beneficiary_id limit 20 offset 40"""
)
ORACLE["dash_activation_distinct"] = from_people(
    """select a active_people, n people, cast(a as double)/nullif(n,0) activation from (
      select count(distinct case when beneficiary_status='Active' then beneficiary_id end) a,
        count(distinct beneficiary_id) n from v_beneficiary_360) x"""
)

# -- relational constructs ---------------------------------------------------

ORACLE["rel_scan_project"] = with_views(
    "expenses", "select expense_id, program_id program, amount_inr/1e3 amount_thousands from expenses"
)
ORACLE["rel_filter"] = with_views(
    "assessments",
    """select assessment_id, beneficiary_id, score from assessments
    where score is not null and max_score>0 and assessment_type='Pre-Test'""",
)
ORACLE["rel_between_bucket"] = with_views(
    "beneficiaries",
    f"select beneficiary_id, {COHORT} age_cohort, {STAGE} life_stage from beneficiaries",
)
ORACLE["rel_like"] = with_views(
    "beneficiaries",
    "select beneficiary_id, income_bracket from beneficiaries where income_bracket ilike 'BPL%'",
)
ORACLE["rel_cte"] = with_views(
    "expenses outcome_tracking",
    """select o.program_id, indicator_id, o.fiscal_year, total_actual, achievement_pct, total_spend_inr
    from outcomes o join spend s on o.program_id=s.program_id and o.fiscal_year=s.fiscal_year""",
    SPEND, OUTCOMES,
)
ORACLE["join_inner"] = with_views(
    "outcome_tracking programs impact_indicators",
    """select outcome_id, program_name, indicator_name, actual_value from outcome_tracking o
    join programs p on o.program_id=p.program_id
    join impact_indicators i on o.indicator_id=i.indicator_id""",
)
ORACLE["join_left"] = with_views(
    "beneficiaries programs regions",
    """select beneficiary_id, program_name, state, region_type from beneficiaries b
    left join programs p on b.program_id=p.program_id
    left join regions r on b.region_id=r.region_id""",
)
ORACLE["join_left_multikey"] = with_views(
    "outcome_tracking funding",
    f"""select o.program_id, o.fiscal_year, indicator_id, total_actual, f.total total_funding_inr
    from outcomes o left join (select program_id, fiscal_year, {money('amount_inr')} total
      from funding group by program_id, fiscal_year) f
    on o.program_id=f.program_id and o.fiscal_year=f.fiscal_year""",
    OUTCOMES,
)
ORACLE["join_left_preagg"] = with_views(
    "beneficiaries assessments",
    f"""select b.beneficiary_id, n assessments_taken, best latest_score_pct from beneficiaries b
    left join (select beneficiary_id, count(assessment_id) n,
        {R('max(case when score is not null and max_score>0 then score*1e2/max_score end)', 1)} best
      from assessments group by beneficiary_id) a on b.beneficiary_id=a.beneficiary_id""",
)
ORACLE["join_cross"] = with_views(
    "programs expenses funding",
    """select program_id, sector, fiscal_year from programs cross join
    (select fiscal_year from expenses union select fiscal_year from funding) f""",
)
ORACLE["join_pair_after"] = with_views(
    "assessments",
    """select beneficiary_id, pre_date, pre_t/1e1 pre_score_pct, post_date,
    post_t/1e1 post_score_pct from pairs""",
    PAIRS,
)
ORACLE["join_fanout_agg"] = with_views(
    "beneficiaries service_delivery",
    """select b.beneficiary_id, count(delivery_id) services_received,
      count(distinct intervention_id) unique_interventions,
      cast(case when count(delivery_id)>0 then 1 else 0 end as int) is_active_beneficiary
    from beneficiaries b left join service_delivery s on b.beneficiary_id=s.beneficiary_id
    group by b.beneficiary_id""",
)
ORACLE["agg_sum_group"] = with_views(
    "expenses",
    f"""select program_id, fiscal_year, {money('amount_inr')} total_spend_inr
    from expenses group by program_id, fiscal_year""",
)
ORACLE["agg_count"] = with_views(
    "beneficiaries",
    """select income_bracket, count(*) n_rows, count(age) n_age, count(gender) n_gender
    from beneficiaries group by income_bracket""",
)
ORACLE["agg_count_distinct"] = with_views(
    "funding",
    """select program_id, fiscal_year, count(distinct donor_id) donor_count
    from funding group by program_id, fiscal_year""",
)
ORACLE["agg_avg"] = with_views(
    "assessments",
    f"""select assessment_type, {mean_tenths(T(pct('score', 'max_score')))} avg_score_pct
    from assessments group by assessment_type""",
)
ORACLE["agg_max_case"] = with_views(
    "assessments",
    """select beneficiary_id, max(case when assessment_type='Post-Test' then score end)
    best_post_score from assessments group by beneficiary_id""",
)
ORACLE["agg_conditional_sum"] = with_views(
    "expenses",
    f"""select fiscal_year, {money_when("category='Personnel'", 'amount_inr')} personnel_inr,
      {money_when("category='Monitoring & Evaluation'", 'amount_inr')} me_inr,
      {n_where("category='Travel & Field'")} n_field
    from expenses group by fiscal_year""",
)
ORACLE["agg_conditional_avg"] = with_views(
    "beneficiaries",
    f"""select gender, {R('avg(case when is_disabled=1 then household_size end)', 1)} avg_household_pwd
    from beneficiaries group by gender""",
)
ORACLE["agg_group_by_expr"] = with_views(
    "outcome_tracking",
    """select substr(reporting_period,4) fiscal_year, sum(actual_value) total_actual,
    count(*) n_rows from outcome_tracking group by substr(reporting_period,4)""",
)
ORACLE["agg_multi_dimension"] = with_views(
    "beneficiaries",
    " union all ".join(
        f"""select '{d}' dimension, cast({c} as varchar) raw_value, count(*) n,
        cast(sum(household_size) as bigint) household_size from beneficiaries group by {c}"""
        for d, c in (("Gender", "gender"), ("Income Bracket", "income_bracket"), ("Disability", "is_disabled"))
    ),
)
ORACLE["win_lag"] = from_progress(
    "select outcome_id, actual_value, prev_quarter_actual from v_programme_progress"
)
ORACLE["win_running_sum"] = from_progress(
    "select outcome_id, cumulative_actual, cumulative_target from v_programme_progress"
)
ORACLE["win_partition_total"] = with_views(
    "beneficiaries",
    f"""select region_id, gender, n, {R(pct('n', 'sum(n) over (partition by region_id)'), 1)} share
    from (select region_id, gender, count(*) n from beneficiaries group by region_id, gender) x""",
)
ORACLE["win_dense_rank"] = from_cost(
    "select program_id, iris_id, fiscal_year, efficiency_rank from v_cost_per_impact"
)
ORACLE["win_row_number_desc"] = from_progress(
    "select outcome_id, recency_rank from v_programme_progress"
)
ORACLE["win_first_last_per_key"] = with_views(
    "assessments",
    " union all ".join(
        f"""select beneficiary_id, assessment_type, assessment_id, assessment_date, score from (
        select *, row_number() over (partition by beneficiary_id
          order by assessment_date {order}, assessment_id) rn
        from assessments where assessment_type='{kind}') x where rn=1"""
        for kind, order in (("Pre-Test", "asc nulls first"), ("Post-Test", "desc nulls last"))
    ),
)
ORACLE["sort_multi"] = with_views(
    "funding",
    """select fiscal_year, amount_inr, funding_id from funding
    order by fiscal_year nulls first, amount_inr desc nulls last, funding_id""",
)
ORACLE["set_union_all"] = with_views(
    "expenses funding",
    """select 'out' flow, program_id, fiscal_year, amount_inr from expenses
    union all select 'in', program_id, fiscal_year, amount_inr from funding""",
)
ORACLE["set_union_distinct"] = with_views(
    "expenses funding",
    "select distinct fiscal_year from expenses union select distinct fiscal_year from funding",
)
ORACLE["set_distinct"] = with_views(
    "expenses", "select distinct fiscal_year, category from expenses"
)

# -- scalar functions --------------------------------------------------------

ORACLE["fn_substr"] = with_views(
    "outcome_tracking",
    """select outcome_id, substr(reporting_period,4) fiscal_year,
    substr(reporting_period,2,1) quarter_text from outcome_tracking""",
)
ORACLE["fn_cast_int"] = with_views(
    "outcome_tracking",
    "select outcome_id, try_cast(substr(reporting_period,2,1) as int) quarter_num from outcome_tracking",
)
_V = "(l_extendedprice*(1e0-l_discount)-3e4)"
ORACLE["fn_round"] = f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  {R(_V, 2)} rounded_2, {R(f'({_V}/1e2)', 1)} rounded_1, {R(f'({_V}/1e2)', 0)} rounded_0 from lineitem"""
ORACLE["fn_safe_ratio"] = """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  l_quantity/nullif(l_discount*1e2,0) ratio from lineitem"""
ORACLE["fn_coalesce"] = with_views(
    "beneficiaries",
    "select beneficiary_id, coalesce(gender,'Unknown') gender, coalesce(age,0) age from beneficiaries",
)
ORACLE["fn_days_between"] = with_views(
    "assessments", "select beneficiary_id, days_between_tests from pairs", PAIRS
)
ORACLE["fn_rag"] = with_views(
    "outcome_tracking",
    f"""select outcome_id, {light(pct('actual_value', 'target_value'), 90, 70)} rag_status
    from outcome_tracking""",
)
ORACLE["fn_momentum"] = from_progress(
    f"select outcome_id, {MOMENTUM} momentum from v_programme_progress"
)
ORACLE["fn_outcome_direction"] = with_views(
    "assessments", "select beneficiary_id, outcome_direction from pairs", PAIRS
)
ORACLE["fn_flag_labels"] = with_views(
    "beneficiaries outcome_tracking",
    f"""select cast(beneficiary_id as varchar) record_id, {DISABILITY} as "label",
      case when is_disabled=1 then 'PwD' else 'No' end flag from beneficiaries
    union all select outcome_id, case when verified_by is not null then 'Verified'
      else 'Unverified' end, null from outcome_tracking""",
)
ORACLE["fn_lower_trim"] = with_views(
    "beneficiaries_dirty",
    """select beneficiary_id, lower(trim(full_name)) name_key, lower(trim(gender)) gender_key
    from beneficiaries_dirty""",
)
ORACLE["fn_fiscal_year"] = f"select o_orderkey, {fy('o_orderdate')} fiscal_year from orders"
ORACLE["fn_reporting_period"] = f"""with calendar as (
  select 'Q'||cast(q as varchar)||'-FY'||cast(y as varchar)||'-'||substr(cast(y+1 as varchar),3,2)
      reporting_period,
    'FY'||cast(y as varchar)||'-'||substr(cast(y+1 as varchar),3,2) fiscal_year,
    cast(q as int) quarter_num
  from range(1991,2000) a(y) cross join range(1,5) b(q))
select c.reporting_period, fiscal_year, quarter_num, coalesce(n,0) n_orders from calendar c
left join (select 'Q'||{quarter('o_orderdate')}||'-'||{fy('o_orderdate')} reporting_period, count(*) n
  from orders group by 1) o on c.reporting_period=o.reporting_period"""
ORACLE["fn_outcome_status"] = with_views(
    "outcome_tracking",
    """select outcome_id, case when r>=1.1 then 'Exceeded' when r>=1.0 then 'Achieved'
      when r>=0.8 then 'On Track' when r>=0.5 then 'At Risk' else 'Off Track' end status
    from (select outcome_id, case when target_value>0 then actual_value/target_value else 0 end r
      from outcome_tracking) x""",
)
ORACLE["fn_program_status"] = """select o_orderkey, case when e is null or e>date '1995-01-01'
  then 'Active' else 'Completed' end status
from (select o_orderkey, case when o_orderstatus='F' then cast(o_orderdate as date) end e from orders) x"""

# -- cleaning ----------------------------------------------------------------


def is_number(x: str) -> str:
    return f"try_cast({x} as double)"


def mapped(x: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items())
    return f"(case lower(trim({x})) {whens} end)"


DATE_FORMATS = (
    "%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%d-%b-%y", "%m-%d-%Y",
    "%m/%d/%Y", "%m.%d.%Y", "%Y%m%d", "%d %B %Y", "%B %d, %Y", "%Y.%m.%d",
)


def to_date(x: str) -> str:
    tries = ", ".join(f"try_strptime(trim({x}), '{f}')" for f in DATE_FORMATS)
    return f"cast(coalesce({tries}) as date)"


def outside(x: str, low, high) -> str:
    return f"coalesce({is_number(x)}<{low} or {is_number(x)}>{high}, false)"


def deduped(name: str, table: str, pk: str, keys: tuple[str, ...]) -> str:
    norm = ", ".join(f"lower(trim({k}))" for k in keys)
    return f"""{name} as (select * from (select *, row_number() over (partition by {norm} order by {pk}) rn
      from {table} where not contains({pk}, '-DUP')) x where rn=1)"""


_CSV_CELLS = {
    "beneficiaries": "beneficiary_id full_name age gender phone region_id registration_date household_size education_level",
    "service_delivery": "delivery_id beneficiary_id status dosage",
    "assessments": "assessment_id beneficiary_id assessment_type score max_score",
    "regions": "region_id state district",
}


def _csv_cells(table: str, source: str, columns: list[str], rescued: str, where: str) -> str:
    return " union all ".join(
        f"select '{table}' table_name, {columns[0]} record_id, {rescued} rescued, '{c}' column_name, {c} \"value\" "
        f"from {source} where {where}"
        for c in columns
    )


ORACLE["src_csv_dir"] = with_views(
    "beneficiaries_dirty service_delivery_dirty assessments_dirty regions_dirty",
    " union all ".join(
        [_csv_cells(t, f"{t}_dirty", c.split(), "cast(null as varchar)", "true") for t, c in _CSV_CELLS.items()]
        + [
            _csv_cells(
                "longer", "regions_dirty", _CSV_CELLS["regions"].split(),
                "region_id||','||state||','||district||',surplus'", "cast(region_id as int) % 2 = 0",
            )
        ]
    ),
)
ORACLE["sink_csv"] = with_views(
    "funding beneficiaries",
    f"""select fiscal_year grp, count(*) n_rows, {money('amount_inr')} total from funding group by 1
    union all select income_bracket, count(*), cast(sum(household_size) as double)
    from beneficiaries group by 1""",
)
ORACLE["sink_tables"] = with_views(
    "expenses funding regions beneficiaries",
    f"""select 'expenses' table_name, fiscal_year grp, count(*) n_rows, {money('amount_inr')} total from expenses group by 2
    union all select 'funding', fiscal_year, count(*), {money('amount_inr')} from funding group by 2
    union all select 'regions', region_type, count(*), cast(sum(region_id) as double) from regions group by 2
    union all select 'beneficiaries', gender, count(*), cast(sum(household_size) as double) from beneficiaries group by 2""",
)

_DIRTY = "beneficiaries_dirty service_delivery_dirty assessments_dirty regions_dirty"


def _schema_rows(table: str, raw: bool = False) -> str:
    view = f"{table}_raw" if raw else f"{table}_dirty"
    is_number = whole.number if raw else globals()["is_number"]
    present = [f.name for f in model.clean_schema(table)] if raw else {
        "beneficiaries": "beneficiary_id full_name age gender phone region_id registration_date "
        "household_size education_level",
        "service_delivery": "delivery_id beneficiary_id status dosage",
        "assessments": "assessment_id beneficiary_id assessment_type score max_score",
    }[table].split()
    pk = model.PRIMARY_KEY[table]
    rows = []
    for f in model.clean_schema(table):
        kind, here = f.dataType.simpleString(), f.name in present
        nulls = f"count(*) filter (where {f.name} is null)" if here else "cast(null as bigint)"
        if not here:
            bad = "cast(null as bigint)"
        elif kind == "string":
            bad = "cast(0 as bigint)"
        elif kind == "date":
            bad = f"count(*) filter (where {f.name} is not null and {to_date(f.name)} is null)"
        elif kind == "int":
            bad = (
                f"count(*) filter (where {f.name} is not null and "
                f"coalesce({is_number(f.name)}<>floor({is_number(f.name)}), true))"
            )
        else:
            bad = f"count(*) filter (where {f.name} is not null and {is_number(f.name)} is null)"
        broken = "cast(0 as bigint)" if f.nullable else nulls
        extra = f"count({pk})-count(distinct {pk})" if here and f.name == pk else "cast(0 as bigint)"
        rows.append(
            f"select '{table}' table_name, '{f.name}' column_name, '{kind}' declared_type, "
            f"cast({int(f.nullable)} as int) is_nullable, cast({int(here)} as int) is_present, "
            f"count(*) n_rows, {nulls} n_null, {broken} n_null_violations, {bad} n_uncastable, "
            f"{extra} n_repeated_keys from {view}"
        )
    return " union all ".join(rows)


ORACLE["schema_check"] = with_views(
    _DIRTY,
    " union all ".join(_schema_rows(t) for t in ("beneficiaries", "service_delivery", "assessments")),
)
_WHOLE = " ".join(f"{t}_raw" for t in whole.VIEWS)
ORACLE["schema_check_whole"] = with_views(
    _WHOLE, " union all ".join(_schema_rows(t, raw=True) for t in whole.VIEWS)
)
ORACLE["star_keys_whole"] = with_views(_WHOLE, whole.keys_sql())
ORACLE["star_join_whole"] = with_views(_WHOLE, whole.star_sql())
ORACLE["clean_drop_tagged_dups"] = with_views(
    "beneficiaries_dirty",
    """select beneficiary_id, full_name, phone from beneficiaries_dirty
    where beneficiary_id not like '%-DUP%'""",
)
ORACLE["clean_dedup_keys"] = with_views(
    "beneficiaries_dirty",
    """select beneficiary_id, full_name, phone, region_id from (select *, row_number() over (
      partition by lower(trim(full_name)), lower(trim(phone)), lower(trim(region_id))
      order by beneficiary_id) rn from beneficiaries_dirty) x where rn=1""",
)
ORACLE["clean_dates"] = with_views(
    "beneficiaries_dirty",
    f"select beneficiary_id, {to_date('registration_date')} registration_date from beneficiaries_dirty",
)
_CATS = (
    ("beneficiaries", "beneficiary_id", "gender", GENDERS),
    ("service_delivery", "delivery_id", "status", SERVICE_STATUSES),
    ("assessments", "assessment_id", "assessment_type", ASSESSMENT_TYPES),
)
ORACLE["clean_categoricals"] = with_views(
    _DIRTY,
    " union all ".join(
        f"""select '{t}' table_name, {pk} record_id, coalesce({mapped(c, m)}, {c}) as "value"
        from {t}_dirty"""
        for t, pk, c, m in _CATS
    ),
)
ORACLE["clean_unmapped_report"] = with_views(
    _DIRTY,
    " union all ".join(
        f"""select '{t}' table_name, '{c}' column_name, count(distinct trim({c})) n_unmapped,
          array_to_string(list_slice(list_sort(list(distinct trim({c}))), 1, 5), '|') sample
        from {t}_dirty where {c} is not null and {mapped(c, m)} is null having count(*)>0"""
        for t, pk, c, m in _CATS
    ),
)
ORACLE["clean_outliers"] = with_views(
    _DIRTY,
    f"""select beneficiary_id record_id,
      case when not {outside('age', 0, 110)} then age end age,
      case when not {outside('household_size', 1, 20)} then household_size end household_size,
      null dosage from beneficiaries_dirty
    union all select delivery_id, null, null,
      case when not {outside('dosage', 0, 50)} then dosage end from service_delivery_dirty""",
)
ORACLE["clean_outliers_cross"] = with_views(
    "assessments_dirty",
    f"""select assessment_id, case when not coalesce({is_number('score')}>{is_number('max_score')}, false)
      then {is_number('score')} end score from assessments_dirty""",
)
_INBOUNDS = f"""inbounds as (select *,
    case when not {outside('age', 0, 110)} then age end a,
    case when not {outside('household_size', 1, 20)} then household_size end h
  from beneficiaries_dirty)"""
ORACLE["impute_median"] = with_views(
    "beneficiaries_dirty",
    f"""select beneficiary_id,
      coalesce({is_number('a')}, (select median({is_number('a')}) from inbounds)) age,
      coalesce({is_number('h')}, (select median({is_number('h')}) from inbounds)) household_size
    from inbounds""",
    _INBOUNDS,
)


def mode_of(c: str, table: str) -> str:
    return f"(select {c} from {table} where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"


ORACLE["impute_mode"] = with_views(
    "beneficiaries_dirty",
    f"""select beneficiary_id,
      coalesce(education_level, {mode_of('education_level', 'beneficiaries_dirty')}) education_level,
      coalesce(gender, {mode_of('gender', 'beneficiaries_dirty')}) gender
    from beneficiaries_dirty""",
)
ORACLE["impute_unknown"] = with_views(
    "beneficiaries_dirty",
    """select beneficiary_id, coalesce(gender,'Unknown') gender,
    coalesce(education_level,'Unknown') education_level from beneficiaries_dirty""",
)
ORACLE["impute_zero"] = with_views(
    "service_delivery_dirty",
    "select delivery_id, coalesce(dosage,'0') dosage from service_delivery_dirty",
)
ORACLE["impute_skip"] = with_views(
    "beneficiaries_dirty",
    """select 'phone' column_name, count(*)-count(phone) n_kept from beneficiaries_dirty
    union all select 'registration_date', count(*)-count(registration_date) from beneficiaries_dirty""",
)
_PEOPLE_D = deduped("people_d", "beneficiaries_dirty", "beneficiary_id", MATCH_KEYS["beneficiaries"])
ORACLE["clean_fk"] = with_views(
    _DIRTY,
    """select delivery_id, case when beneficiary_id in (select beneficiary_id from people_d)
      then beneficiary_id end beneficiary_id from service_delivery_dirty""",
    _PEOPLE_D,
)
_INT = "cast(floor({x}+0.5) as int)"
ORACLE["clean_cast"] = with_views(
    "beneficiaries_dirty",
    f"""select beneficiary_id, trim(full_name) full_name, {_INT.format(x=is_number('age'))} age,
      trim(gender) gender, {_INT.format(x=is_number('household_size'))} household_size
    from beneficiaries_dirty""",
)

# The whole run, step by step.  Only the columns present in the views matter.
_STEPS = (
    _PEOPLE_D,
    f"""people_s as (select *, {to_date('registration_date')} dt,
        coalesce({mapped('gender', GENDERS)}, gender) g,
        coalesce({mapped('gender', GENDERS)}<>gender, false) g_changed,
        case when not {outside('age', 0, 110)} then age end a, {outside('age', 0, 110)} a_out,
        case when not {outside('household_size', 1, 20)} then household_size end h,
        {outside('household_size', 1, 20)} h_out,
        coalesce(region_id not in (select region_id from regions_dirty), false) orphan
      from people_d)""",
    f"""people_c as (select beneficiary_id, trim(full_name) full_name, dt registration_date,
        trim(coalesce(g,'Unknown')) gender, trim(coalesce(education_level,'Unknown')) education_level,
        case when not orphan then region_id end region_id,
        {_INT.format(x=f"coalesce({is_number('a')}, (select median({is_number('a')}) from people_s))")} age,
        {_INT.format(x=f"coalesce({is_number('h')}, (select median({is_number('h')}) from people_s))")} household_size
      from people_s)""",
    deduped("services_d", "service_delivery_dirty", "delivery_id", ("beneficiary_id",)),
    f"""services_s as (select *, coalesce({mapped('status', SERVICE_STATUSES)}, status) st,
        coalesce({mapped('status', SERVICE_STATUSES)}<>status, false) st_changed,
        case when not {outside('dosage', 0, 50)} then dosage end d, {outside('dosage', 0, 50)} d_out,
        coalesce(beneficiary_id not in (select beneficiary_id from people_c), false) orphan
      from services_d)""",
    deduped("tests_d", "assessments_dirty", "assessment_id", ("beneficiary_id", "assessment_type")),
    f"""tests_s as (select *, coalesce({mapped('assessment_type', ASSESSMENT_TYPES)}, assessment_type) ty,
        coalesce({mapped('assessment_type', ASSESSMENT_TYPES)}<>assessment_type, false) ty_changed,
        coalesce({is_number('score')}<0 or {is_number('score')}>{is_number('max_score')}, false) s_out,
        coalesce(beneficiary_id not in (select beneficiary_id from people_c), false) orphan
      from assessments_dirty_d)""".replace("assessments_dirty_d", "tests_d"),
)
ORACLE["clean_all_tables"] = with_views(
    _DIRTY,
    f"""select 'beneficiaries' table_name, beneficiary_id record_id, region_id reference,
      gender category, cast(age as double) number, full_name, registration_date, education_level,
      household_size from people_c
    union all select 'service_delivery', delivery_id, case when not orphan then beneficiary_id end,
      trim(st), cast({_INT.format(x=f"coalesce({is_number('d')}, (select median({is_number('d')}) from services_s))")} as double),
      null, null, null, null from services_s
    union all select 'assessments', assessment_id, case when not orphan then beneficiary_id end,
      trim(ty), case when not s_out then {is_number('score')} end, null, null, null, null from tests_s""",
    *_STEPS,
)

_CELLS, _CELL_STEPS = whole.clean_sql(deduped, to_date, mapped)
ORACLE["clean_whole_schema"] = with_views(
    _WHOLE, _CELLS, *_CELL_STEPS
)
ORACLE["clean_audit_whole"] = with_views(_WHOLE, whole.audit_sql(to_date, mapped), *_CELL_STEPS)


def n_if(p: str, table: str) -> str:
    return f"(select count(*) from {table} where {p})"


def say(n: str, text: str) -> str:
    """``text`` with ``#`` for the number, left out where the number is 0."""
    before, after = text.replace("'", "''").split("#", 1)
    return f"case when {n}>0 then '{before}'||{n}||'{after}' end"


def _audit(table: str, raw: str, done: str, pk: str, keys: tuple[str, ...], steps) -> str:
    total = f"(select count(*) from {raw})"
    tagged = n_if(f"contains({pk}, '-DUP')", raw)
    after = f"(select count(*) from {done})"
    listed = "[" + ", ".join(f"'{k}'" for k in keys) + "]"
    first = (
        f"{total}-{after}",
        [
            say(tagged, "# rows dropped whose key has the duplicate tag"),
            say(f"({total}-{tagged}-{after})", f"# rows dropped that repeat the key of an earlier one: {listed}"),
        ],
        "deduplication",
        total,
    )
    names = (
        "date_normalisation", "categorical_standardisation", "outlier_treatment", "imputation",
        "referential_integrity", "type_casting",
    )
    rows = [first] + [(n, texts, name, after) for name, (n, texts) in zip(names, steps)]
    return " union all ".join(
        f"""select '{table}' table_name, cast({i} as int) step_no, '{name}' step,
          cast({before} as bigint) rows_before, cast({after} as bigint) rows_after,
          cast({n} as bigint) rows_affected, concat_ws(' | ', {', '.join(texts) or 'null'}) details"""
        for i, (n, texts, name, before) in enumerate(rows, start=1)
    )


def median_text(column: str, x: str, table: str) -> str:
    n = n_if(f"{x} is null", table)
    value = f"(select printf('%.1f', median({is_number(x)})) from {table})"
    return f"case when {n}>0 then '{column}: '||{n}||' gaps got the median '||{value} end"


def fill_text(column: str, x: str, table: str, tail: str) -> str:
    return say(n_if(f"{x} is null", table), f"{column}: # gaps {tail}")


_P, _S, _A = "people_s", "services_s", "tests_s"
_UNKNOWN, _SKIP = "got the text Unknown", "left as they are"
_AUDIT_SQL = " union all ".join(
    (
        _audit(
            "beneficiaries", "beneficiaries_dirty", _P, "beneficiary_id", MATCH_KEYS["beneficiaries"],
            (
                (
                    "1",
                    [
                        say(
                            n_if("registration_date is not null and dt is null", _P),
                            "registration_date: # texts are no date, now NULL",
                        ),
                        say(
                            n_if("dt is not null", _P),
                            "registration_date: # values are dates now",
                        ),
                    ],
                ),
                (
                    n_if("g_changed", _P),
                    [
                        say(n_if("g_changed", _P), "gender: # spellings replaced"),
                        "'gender: 1 texts have no standard spelling: [''other'']'",
                    ],
                ),
                (
                    f"{n_if('a_out', _P)}+{n_if('h_out', _P)}",
                    [
                        say(n_if("a_out", _P), "age: # values outside 0 to 110, now NULL"),
                        say(
                            n_if("h_out", _P),
                            "household_size: # values outside 1 to 20, now NULL",
                        ),
                    ],
                ),
                (
                    "+".join(n_if(f"{c} is null", _P) for c in ("a", "g", "education_level", "h")),
                    [
                        median_text("age", "a", _P),
                        fill_text("gender", "g", _P, _UNKNOWN),
                        fill_text("phone", "phone", _P, _SKIP),
                        fill_text("education_level", "education_level", _P, _UNKNOWN),
                        median_text("household_size", "h", _P),
                        fill_text("registration_date", "dt", _P, _SKIP),
                    ],
                ),
                (
                    n_if("orphan", _P),
                    [say(n_if("orphan", _P), "region_id: # references without a parent, now NULL")],
                ),
                (
                    "2",
                    ["'age: now bigint'", "'household_size: now bigint'"],
                ),
            ),
        ),
        _audit(
            "service_delivery", "service_delivery_dirty", _S, "delivery_id", ("beneficiary_id",),
            (
                ("0", []),
                (
                    n_if("st_changed", _S),
                    [
                        say(n_if("st_changed", _S), "status: # spellings replaced"),
                        "'status: 1 texts have no standard spelling: [''P'']'",
                    ],
                ),
                (
                    n_if("d_out", _S),
                    [say(n_if("d_out", _S), "dosage: # values outside 0 to 50, now NULL")],
                ),
                (n_if("d is null", _S), [median_text("dosage", "d", _S)]),
                (
                    n_if("orphan", _S),
                    [say(n_if("orphan", _S), "beneficiary_id: # references without a parent, now NULL")],
                ),
                ("1", ["'dosage: now bigint'"]),
            ),
        ),
        _audit(
            "assessments", "assessments_dirty", _A, "assessment_id", ("beneficiary_id", "assessment_type"),
            (
                ("0", []),
                (
                    n_if("ty_changed", _A),
                    [
                        say(n_if("ty_changed", _A), "assessment_type: # spellings replaced"),
                        "'assessment_type: 1 texts have no standard spelling: [''P'']'",
                    ],
                ),
                (
                    n_if("s_out", _A),
                    [say(n_if("s_out", _A), "score: # values outside 0.0 to inf, now NULL")],
                ),
                (
                    "0",
                    [say(n_if("score is null or s_out", _A), f"score: # gaps {_SKIP}")],
                ),
                (
                    n_if("orphan", _A),
                    [say(n_if("orphan", _A), "beneficiary_id: # references without a parent, now NULL")],
                ),
                (
                    "2",
                    ["'score: now double'", "'max_score: now double'"],
                ),
            ),
        ),
        "select 'regions', cast(i as int), s, n, n, 0, '' from (select count(*) n from regions_dirty) c, "
        "(values (1,'deduplication'), (2,'date_normalisation'), (3,'categorical_standardisation'), "
        "(4,'outlier_treatment'), (5,'imputation'), (6,'type_casting')) v(i, s)",
    )
)
ORACLE["clean_audit"] = with_views(_DIRTY, _AUDIT_SQL, *_STEPS)
ORACLE["sink_audit"] = with_views(
    _DIRTY,
    f"select table_name, step_no, step, rows_before, rows_after, rows_affected, coalesce(details, '') details from ({_AUDIT_SQL}) x",
    *_STEPS,
)
ORACLE["clean_summary"] = with_views(
    _DIRTY,
    f"""select table_name, min_by(rows_before, step_no) initial_rows,
      max_by(rows_after, step_no) final_rows, cast(sum(rows_affected) as bigint) total_changes,
      count(*) n_steps from ({_AUDIT_SQL}) x group by table_name""",
    *_STEPS,
)

# -- issue log ---------------------------------------------------------------


def issue(table: str, column: str | None, pk: str, kind: str, text: str, source: str, where: str) -> str:
    shown = f"'{column}'" if column else "cast(null as varchar)"
    return (
        f"select '{table}' table_name, {shown} column_name, {pk} record_id, '{kind}' issue_type, "
        f"{text} description from {source} where {where}"
    )


_PRESENT = {
    "beneficiaries": ("phone", "age", "education_level"),
    "service_delivery": ("dosage",),
    "assessments": ("score",),
}
_MISSING = " union all ".join(
    issue(t, c, model.PRIMARY_KEY[t], "missing_value", f"'NULL in ''{c}'''", f"{t}_dirty", f"{c} is null")
    for t in _PRESENT
    for c in MONITORED_NULLS[t]
    if c in _PRESENT[t]
)
_DATE_FORMAT = issue(
    "beneficiaries", "registration_date", "beneficiary_id", "inconsistent_date_format",
    "'Date written as '''||registration_date||''''", "beneficiaries_dirty",
    f"not regexp_matches(registration_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') "
    f"and {to_date('registration_date')} is not null",
)
_CASING = " union all ".join(
    issue(
        t, c, pk, "inconsistent_casing",
        f"''''||{c}||''' stands for '''||{mapped(c, m)}||''''", f"{t}_dirty", f"{mapped(c, m)}<>{c}",
    )
    for t, pk, c, m in _CATS
)
_RANGES = (
    ("beneficiaries", "age", outside("age", 0, 110)),
    ("beneficiaries", "household_size", outside("household_size", 1, 20)),
    ("service_delivery", "dosage", outside("dosage", 0, 50)),
    ("assessments", "score",
     f"coalesce({is_number('score')}<0 or {is_number('score')}>{is_number('max_score')}, false)"),
)
_OUTLIER = " union all ".join(
    issue(t, c, model.PRIMARY_KEY[t], "outlier", f"'Value out of range: '||{c}", f"{t}_dirty", p)
    for t, c, p in _RANGES
)


def duplicates(table: str, pk: str, keys: tuple[str, ...]) -> str:
    norm = ", ".join(f"lower(trim({k}))" for k in keys)
    # Rows that are equal in all columns are repeats too.
    firsts = f"""(select {pk}, first_value({pk}) over (partition by {norm} order by {pk}) f,
        row_number() over (partition by {norm} order by {pk}) rn
      from {table}_dirty where not contains({pk}, '-DUP')) x"""
    return (
        issue(table, None, pk, "duplicate_entry", "'Key carries the duplicate tag'", f"{table}_dirty",
              f"contains({pk}, '-DUP')")
        + " union all "
        + issue(table, None, pk, "duplicate_entry", "'Repeats '''||f||''''", firsts, "rn>1")
    )


_DUPLICATE = duplicates("beneficiaries", "beneficiary_id", MATCH_KEYS["beneficiaries"])


def orphan(table: str, pk: str, column: str, parent: str, parent_pk: str) -> str:
    return issue(
        table, column, pk, "orphan_reference", f"'No parent for '''||{column}||''''", f"{table}_dirty",
        f"{column} is not null and {column} not in (select trim({parent_pk}) from {parent})",
    )


_ORPHAN = " union all ".join(
    (
        orphan("service_delivery", "delivery_id", "beneficiary_id", "people_d", "beneficiary_id"),
        orphan("beneficiaries", "beneficiary_id", "region_id", "regions_dirty", "region_id"),
        orphan("assessments", "assessment_id", "beneficiary_id", "people_d", "beneficiary_id"),
    )
)
_NAMES = """keyed as (select beneficiary_id record_id, coalesce(region_id,'') block,
    lower(trim(full_name)) spelling from beneficiaries_dirty where full_name is not null),
  spellings as (select block, spelling, min(record_id) first_id from keyed group by block, spelling),
  near as (select a.block, a.spelling, b.spelling near_spelling, b.first_id near_id,
      cast(levenshtein(a.spelling, b.spelling) as int) edits
    from spellings a join spellings b on a.block=b.block and b.first_id<a.first_id
    where levenshtein(a.spelling, b.spelling) between 1 and 2),
  ranked as (select *, row_number() over (partition by block, spelling
    order by edits, near_id, near_spelling) rn from near),
  variants as (select k.record_id, k.block, k.spelling, near_spelling, near_id, edits
    from keyed k join ranked r on k.block=r.block and k.spelling=r.spelling where rn=1)"""
ORACLE["dq_missing"] = with_views(_DIRTY, _MISSING)
ORACLE["dq_date_format"] = with_views(_DIRTY, _DATE_FORMAT)
ORACLE["dq_casing"] = with_views(_DIRTY, _CASING)
ORACLE["dq_outlier"] = with_views(_DIRTY, _OUTLIER)
ORACLE["dq_duplicate"] = with_views(_DIRTY, _DUPLICATE)
ORACLE["dq_orphan"] = with_views(_DIRTY, _ORPHAN, _PEOPLE_D)
ORACLE["dq_name_variant"] = with_views(_DIRTY, "select * from variants", _NAMES)
_NAME_ISSUES = issue(
    "beneficiaries", "full_name", "record_id", "transliteration_variant",
    "'Near '''||near_spelling||''' of '''||near_id||''''", "variants", "true",
)
_ALL = " union all ".join(
    (
        _MISSING, _DATE_FORMAT, _CASING, _OUTLIER, _DUPLICATE,
        duplicates("service_delivery", "delivery_id", ("beneficiary_id",)),
        duplicates("assessments", "assessment_id", ("beneficiary_id", "assessment_type")),
        _ORPHAN,
        _NAME_ISSUES,
    )
)
ORACLE["dq_log"] = with_views(
    _DIRTY,
    f"""select 'DQL-'||sha256(concat_ws('|', table_name, coalesce(column_name,''),
        coalesce(record_id,''), issue_type, description, cast(row_number() over (partition by
        table_name, column_name, record_id, issue_type, description) as varchar))) log_id,
      table_name, column_name, record_id, issue_type, description,
      date '2025-06-12' detected_date, cast(0 as int) resolved from ({_ALL}) x""",
    _NAMES,
    _PEOPLE_D,
)

_TWO = ("service_delivery", "assessments")
_RUN = " union all ".join(
    (
        *(
            issue(t, c, model.PRIMARY_KEY[t], "missing_value", f"'NULL in ''{c}'''", f"{t}_dirty", f"{c} is null")
            for t in _TWO
            for c in _PRESENT[t]
        ),
        *(
            issue(
                t, c, pk, "inconsistent_casing",
                f"''''||{c}||''' stands for '''||{mapped(c, m)}||''''", f"{t}_dirty", f"{mapped(c, m)}<>{c}",
            )
            for t, pk, c, m in _CATS
            if t in _TWO
        ),
        *(
            issue(t, c, model.PRIMARY_KEY[t], "outlier", f"'Value out of range: '||{c}", f"{t}_dirty", w)
            for t, c, w in _RANGES
            if t in _TWO
        ),
        duplicates("service_delivery", "delivery_id", ("beneficiary_id",)),
        duplicates("assessments", "assessment_id", ("beneficiary_id", "assessment_type")),
    )
)


def _log_of(issues: str, day: str) -> str:
    return f"""select 'DQL-'||sha256(concat_ws('|', table_name, coalesce(column_name,''),
        coalesce(record_id,''), issue_type, description, cast(row_number() over (partition by
        table_name, column_name, record_id, issue_type, description) as varchar))) log_id,
      table_name, column_name, record_id, issue_type, description, date '{day}' detected_date from ({issues}) x"""


ORACLE["dq_log_rerun"] = with_views(
    "service_delivery_dirty assessments_dirty",
    """select coalesce(a.log_id, b.log_id) log_id, coalesce(a.table_name, b.table_name) table_name,
      coalesce(a.column_name, b.column_name) column_name, coalesce(a.record_id, b.record_id) record_id,
      coalesce(a.issue_type, b.issue_type) issue_type, coalesce(a.description, b.description) description,
      coalesce(a.detected_date, b.detected_date) detected_date,
      cast(case when b.log_id is null then 1 else 0 end as int) resolved
    from run_1 a full join run_2 b on a.log_id = b.log_id""",
    f"run_1 as ({_log_of(_RUN, '2025-06-12')})",
    "service_delivery_dirty2 as (select * from service_delivery_dirty where cast(delivery_id as bigint) % 4 <> 0)",
    """assessments_dirty2 as (select * replace (case when cast(assessment_id as bigint) % 50 <> 1 then score end as score)
      from assessments_dirty)""",
    f"run_2 as ({_log_of(_RUN.replace('_dirty', '_dirty2'), '2025-06-19')})",
)
