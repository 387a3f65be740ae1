"""Building blocks of the DuckDB checks: named CTEs, assembled on demand.

The checks restate each result in plain set-based SQL (cubes, self-joins, distinct counts),
so that they do not share the engine's plan shapes. Only the derivation of the source tables
from the test data is shared. Amounts are added as decimals, so totals are exact here too.
"""

from __future__ import annotations

import re

from tidemark.sources.fixtures import SQL, TABLES

CTES: dict[str, str] = {}
NAME = re.compile(r"\bx_\w+\b")

START, END, CUTOVER = "1995-01-01", "2024-12-31", "2024-01-16"


def cte(name: str, sql: str) -> str:
    assert name.startswith("x_"), name
    CTES[name] = sql.strip()
    return name


def assemble(final: str) -> str:
    """``final`` with the CTEs it needs, dependencies first."""
    done: dict[str, str] = {}

    def visit(sql: str):
        for name in NAME.findall(sql):
            if name in CTES and name not in done:
                visit(CTES[name])
                done[name] = CTES[name]

    visit(final)
    if not done:
        return final
    parts = ",\n".join(f"{name} as materialized ({sql})" for name, sql in done.items())
    return f"with {parts}\n{final}"


def dec(x: str, scale: int = 7) -> str:
    """A double as the decimal it prints as; a direct cast multiplies as a double and adds noise."""
    return f"cast(cast({x} as varchar) as decimal(28,{scale}))"


def total(x: str) -> str:
    """Exact sum of a double amount, kept as a decimal."""
    return f"sum(cast({x} as decimal(18,7)))"


def exact(x: str) -> str:
    """A decimal as the nearest double; through text, as a direct cast rounds twice above 2**53 units."""
    return f"cast(cast({x} as varchar) as double)"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def div(num: str, den: str) -> str:
    """Unguarded ratio: nothing for a zero denominator."""
    return f"(cast({num} as double) / nullif(cast({den} as double), 0))"


def div0(num: str, den: str, otherwise: str = "0e0") -> str:
    return f"(case when ({den}) > 0 then cast({num} as double) / cast({den} as double) else {otherwise} end)"


def round4(x: str) -> str:
    return f"cast(round(cast({x} as decimal(38,9)), 4) as double)"


def money4(x: str) -> str:
    return f"cast(round({x}, 4) as double)"


def pick(name: str, pl: str = "product_pl") -> str:
    return f"(case when {pl} = 'UK' or {pl} is null then {name}_gbp else {name}_eur end)"


def fan(pl: str, region: str, alias: str = "rm") -> str:
    return (
        f"join x_region_map {alias} on coalesce({pl}, '(null)') = {alias}.input_product_pl "
        f"and coalesce({region}, '(null)') = {alias}.input_region"
    )


OUT = "rm.output_product_pl as product_pl, rm.output_region as region"
MART_COLUMNS = (
    "date_scope, financial_year, week_number, year_month_day, week_commencing_date, product_pl, region, "
    "category, sub_category, metric_name, metric_value"
)


def longform(source: str, keys: str, metrics: dict[str, str] | list[tuple[str, str]], where: str = "metric_value is not null") -> str:
    """Metric rows as a union of one select per metric. List entries give literal label columns."""
    pairs = [(f"'{n}' as metric_name", v) for n, v in metrics.items()] if isinstance(metrics, dict) else metrics
    union = " union all ".join(f"select {keys}, {label}, cast({v} as double) as metric_value from {source}" for label, v in pairs)
    return f"select * from ({union}) u where {where}"


def mart_rows(rows: str, scope: str) -> str:
    """Attach the calendar and drop incomplete rows."""
    if scope == "FYtD":
        dated = f"select 'FYtD' as date_scope, r.*, r.week_commencing_date as year_month_day from ({rows}) r"
    elif scope == "WEEK":
        dated = (
            "select 'WEEK' as date_scope, r.*, c.financial_year, c.week_number, r.week_commencing_date as year_month_day "
            f"from ({rows}) r join x_calendar c on c.date_scope = 'WEEK' and c.week_commencing_date = r.week_commencing_date"
        )
    else:
        dated = (
            "select 'DAY' as date_scope, r.*, c.financial_year, c.week_number, c.week_commencing_date "
            f"from ({rows}) r join x_calendar c on c.date_scope = 'DAY' and c.year_month_day = r.year_month_day"
        )
    whole = " and ".join(f"{c.strip()} is not null" for c in MART_COLUMNS.split(","))
    return f"select {MART_COLUMNS} from ({dated}) d where {whole}"


for _name, _sql in SQL.items():
    cte(f"x_{_name}", _sql.format(**{t: t for t in TABLES}))

cte("x_calendar", """
select s.scope as date_scope, y.fy as financial_year, cast((y.wk - y.first_sunday) // 7 + 1 as integer) as week_number,
  y.wk as week_commencing_date, y.day as year_month_day
from (select day, wk, fy, make_date(fy, 3, 1) + cast((7 - dayofweek(make_date(fy, 3, 1))) % 7 as integer) as first_sunday
      from (select day, wk, cast(year(wk) - case when month(wk) < 3 then 1 else 0 end as integer) as fy
            from (select day, day - cast(dayofweek(day) as integer) as wk
                  from (select cast(unnest(generate_series(date '1995-01-01', date '2025-12-31', interval 1 day)) as date) as day) a) b) c) y
join (values ('DAY'), ('WEEK')) as s(scope) on s.scope = 'DAY' or y.day = y.wk""")
cte("x_plan_calendar", """
select year_month_day as report_date, week_commencing_date as report_week_commencing, week_commencing_date + 6 as report_week_ending,
  cast(dayofweek(year_month_day) as integer) + 1 as day_of_reporting_week, cast(day(year_month_day) as integer) as day_of_month, week_number as week_in_fin_year
from x_calendar where date_scope = 'DAY'""")
cte("x_region_map", """
select * from (values
 ('UK','United Kingdom','UK','United Kingdom'),('UK','United Kingdom','UK & EU','Total'),
 ('EU','France','EU','France'),('EU','France','UK & EU','Total'),
 ('EU','Germany','EU','Germany'),('EU','Germany','UK & EU','Total'),
 ('EU','Inbound','EU','Inbound'),('EU','Inbound','EU','Foreign Travel'),('EU','Inbound','UK & EU','Total'),
 ('EU','RoE','EU','RoE'),('EU','RoE','EU','Foreign Travel'),('EU','RoE','UK & EU','Total'),
 ('EU','United Kingdom','EU','UK>EU'),('EU','United Kingdom','EU','Foreign Travel'),('EU','United Kingdom','UK & EU','Total'),
 ('INT','United Kingdom','EU','UK>EU'),('INT','United Kingdom','EU','Foreign Travel'),('INT','United Kingdom','UK & EU','Total'),
 ('EU','Unknown','EU','France'),('EU','Unknown','UK & EU','Total'),
 ('(null)','(null)','EU','France'),('(null)','(null)','UK & EU','Total')
) as m(input_product_pl, input_region, output_product_pl, output_region)""")
cte("x_countries", """
select * from (values ('GB','United Kingdom','UK','United Kingdom'),('FR','France','EU','France'),('IT','Italy','EU','RoE'),
 ('CY','Cyprus','EU','RoE'),('GE','Georgia','EU','Inbound'),('KR','South Korea','EU','Inbound')) as c(country_code, country_name, product_pl, region)""")
cte("x_country_names", """
select * from (values ('United Kingdom','GB'),('France','FR'),('Korea, Republic of','KR'),('Georgia','GE')) as c(country_lookup_value, country_code)""")
cte("x_fx_rates", """
select * from (values (timestamp '2024-01-01 00:00:00',timestamp '2024-01-23 23:59:59','EUR','GBP',0.85e0),
 (timestamp '2024-01-24 00:00:00',timestamp '2024-12-31 23:59:59','EUR','GBP',0.86e0),
 (timestamp '2024-01-01 00:00:00',timestamp '2024-12-31 23:59:59','USD','GBP',0.79e0),
 (timestamp '2024-01-01 00:00:00',timestamp '2024-12-31 23:59:59','USD','EUR',0.92e0)) as r(valid_from, valid_to, base_currency, target_currency, rate)""")
cte("x_lines", f"""
select * from x_order_lines where order_business_channel_code = 'Leisure' and order_managed_group_id in ('20','42')
 and upper(product_type_code) in ('TRAVEL','SEASONS','SEASONS_FLEXI','RAILCARD') and source_system in ('25KV','SEASONS','SGP','TRACS')
 and year_month_day <= date '{END}' and year_month_day >= date '{START}' - 45""")
