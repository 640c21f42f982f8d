"""Raw source tables derived from the given tables.

Each raw table is one SELECT in SQL that Spark and DuckDB both understand, with ``{table}`` in
place of the tables it reads and ``EACH(...)`` for one row per listed value, so both sides start
from the same all-string rows. Defects come from key arithmetic over the whole tables: late copies,
bad dates, unknown codes, shared phones.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import compiled, spread
from tallyline.sources.store import scratch_root

TABLES = ("customer", "orders", "lineitem", "events", "nation", "region", "supplier", "part")

NBSP = "\u00a0"


def _pick(index: str, *values: str) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {index} % {len(values)} {cases} end"


def _text(expr: str) -> str:
    return f"cast({expr} as string)"


def _two(expr: str) -> str:
    return f"lpad({_text(expr)}, 2, '0')"


_LETTERS = f"translate({_text('k')}, '0123456789', 'abcdefghij')"
_FIRST = _pick("k", "Hawa", "Abdi", "José", "Grace", "Amina", "Jean-Paul", "O''''Neil", "Tesfaye")
_FIRST = _FIRST.replace("''''", "''")
_BORN_ISO = f"{_text('1950 + k % 65')} || '-' || {_two('1 + k % 12')} || '-' || {_two('1 + k % 28')}"
_BORN_DAY = f"{_two('1 + k % 28')} || '/' || {_two('1 + k % 12')} || '/' || {_text('1950 + k % 65')}"
_SHARED = f"lpad({_text('cast(floor(k / 50) as bigint)')}, 7, '0')"
_PHONE = (
    f"case when k % 9 = 0 then null when k % 10 in (1, 2, 5) then '0700-' || {_SHARED} "
    f"else '+254 (7) ' || {_text('k')} end"
)

RAW: dict[str, str] = {}

RAW["raw_ims_clients"] = f"""
select
    case when k % 97 = 0 then '' when k % 193 = 0 then null
         when k % 5 = 0 then '  C' || {_text('k')} || ' ' else 'C' || {_text('k')} end as ims_client_id,
    case when k % 31 = 0 then '  ' when k % 4 = 0 then upper({_FIRST}) else {_FIRST} end as first_name,
    case when k % 3 = 0 then 'Noor' end as middle_name,
    case when k % 62 = 0 then '' when k % 3 = 0 then '  ' || {_LETTERS} || ' ' else {_LETTERS} end as last_name,
    {_pick('k', 'M', 'female', 'Male ', 'F', 'X', '')} as sex,
    case when v = 2 then 'unknown' when k % 29 = 0 then {_text('1950 + k % 65')} when k % 37 = 0 then ''
         when k % 3 = 0 then {_BORN_DAY} else {_BORN_ISO} end as date_of_birth,
    {_PHONE} as phone_1,
    case when k % 2 = 0 then '07 ' || {_text('k')} else 'none' end as phone_2,
    case when k % 41 = 0 then 'Atlantis' when k % 43 = 0 then ' ' when k % 47 = 0 then null
         when k % 5 = 0 then {_pick('k', 'Ethiopia', 'ETH', 'et', 'ethiopia')}
         when k % 5 = 1 then {_pick('k', 'Kenya ', 'KEN', 'ke', 'Kenya' + NBSP)}
         when k % 5 = 2 then {_pick('k', 'Rwanda', 'rwa', 'RW', ' rwanda')}
         when k % 5 = 3 then {_pick('k', 'S. Sudan', 'South Sudan', 'SSD', 'ss')}
         else {_pick('k', 'Tchad', 'TCD', 'td', 'Chad')} end as country,
    'Village ' || {_text('k % 100')} as location,
    'H' || {_text('cast(floor(k / 4) as bigint)')} as household_id,
    {_pick('k', 'Head', 'SPOUSE', ' child ', '')} as relationship_to_head,
    case when k % 5 < 3 then 'Refugee card' end as id_document_type,
    case when k % 35 = 2 then 'FAR 24 ' || lpad({_text('k - 1')}, 6, '0')
         when k % 5 < 3 then 'FAR-24-' || lpad({_text('k')}, 6, '0')
         when k % 5 = 3 then '  ' end as id_document_number,
    '2024-' || {_text('1 + k % 12')} || '-' || {_text('1 + k % 28')} as registration_date,
    'Retail' as business_sector,
    'agent ' || {_text('k % 7')} as registered_by,
    ' F1 ' as source_form,
    case when v = 0 then '2026-03-' || {_two('1 + k % 28')} || 'T10:00:00Z'
         when v = 1 then '2025-11-05 08:15' else '2026-05-01T23:59:59+03:00' end as updated_at,
    '' as notes
from (
    select k, case when copy = 3 then 0 else copy end as v
    from (select c_custkey as k, EACH(0, 1, 2, 3) as copy from {{customer}}) as made
    where copy = 0 or (copy = 1 and k % 13 = 0) or (copy = 2 and k % 39 = 0) or (copy = 3 and k % 101 = 0)
) as copies
"""

RAW["raw_cbs_borrowers"] = f"""
select
    case when k % 211 = 0 then null when k % 223 = 0 then ' ' else 'B' || {_text('k')} end as borrower_id,
    case when k % 103 = 0 then '' else upper({_LETTERS}) || '  ' || {_FIRST} end as full_name,
    {_pick('k', 'Male', 'f', 'unknown')} as gender,
    case when k % 47 = 0 then {_BORN_DAY} when k % 6 = 2 then ''
         when k % 15 = 1 then '1948-01-' || {_two('1 + k % 28')} else {_BORN_ISO} end as date_of_birth,
    {_PHONE} as mobile_no,
    'National id' as id_type,
    case when k % 5 < 2 then 'far24' || lpad({_text('k')}, 6, '0') when k % 5 = 3 then '--' end as id_number,
    case when k % 53 = 0 then 'XX' when k % 59 = 0 then null
         else {_pick('k', 'ET', ' ke', 'RW ', 'ss', 'TD')} end as country,
    'Branch ' || {_text('k % 12')} as branch,
    {_text('k % 12')} as office_id,
    case when v = 1 then '2024-01-05' when k % 7 = 0 then '2025/02/03'
         when k % 7 = 1 then '2025-02-03 10:30:00' when k % 7 = 2 then '2025' when k % 7 = 3 then '2025-02-31'
         else '2025-' || {_text('1 + k % 12')} || '-' || {_text('1 + k % 28')} end as created_on
from (select c_custkey as k, EACH(0, 1) as v from {{customer}}) as copies
where v = 0 or k % 34 = 0
"""

_WHOLE = "cast(floor(o_totalprice) as bigint)"
_THOUSANDS = _text(f"cast(floor({_WHOLE} / 1000) as bigint)")
_LAST_THREE = f"lpad({_text(f'{_WHOLE} % 1000')}, 3, '0')"

RAW["raw_cbs_loans"] = f"""
select
    case when k % 331 = 0 then '' when k % 337 = 0 then null when k % 6 = 0 then ' L' || {_text('k')}
         else 'L' || {_text('k')} end as loan_id,
    case when k % 149 = 0 then null when k % 101 = 0 then 'BX' || {_text('o_custkey')}
         when k % 50 <> 0 and o_custkey % 3 = 0 then 'B' || {_text('o_custkey + 1')}
         else 'B' || {_text('o_custkey')} end as borrower_id,
    case when k % 89 = 0 then null when k % 107 = 0 then 'Kenya' else {_pick('k', 'ET', 'ke ', 'RW', 'SS', 'td')} end as country,
    {_pick('k', 'North', ' ', 'South')} as branch,
    'Working capital' as product,
    case when k % 71 = 0 then 'USD' when k % 83 = 0 then null
         else {_pick('k', 'etb', 'Ksh', 'RWF ', 'SSP', 'XAF')} end as currency,
    case when k % 61 = 0 then 'n/a' when k % 67 = 0 then '-' || {_text(_WHOLE)} when k % 109 = 0 then '0'
         when k % 113 = 0 then '1.2e3' when k % 7 = 0 then {_THOUSANDS} || ',' || {_LAST_THREE} || '.50'
         when k % 7 = 1 then {_THOUSANDS} || ' ' || {_LAST_THREE}
         else {_text('cast(o_totalprice as decimal(18,2))')} end as principal,
    case when k % 73 = 0 then 'soon' when k % 4 = 0 then {_text('cast(o_orderdate as date)')}
         else {_text('cast(o_orderdate as date)')} || 'T' || {_two('(k + v * 3) % 24')} || ':30:00'
              || {_pick('k', 'Z', '+02:00', '+03:00', '')} end as disbursed_at,
    case when k % 17 = 0 then '12.5' when k % 19 = 0 then 'a year' else {_text('6 + k % 30')} end as term_months,
    case when k % 5 = 0 then '12.5%' else '18.25' end as interest_rate_pct,
    case when k % 79 = 0 then 'written off'
         else {_pick('k', 'ACTIVE', ' Active', 'Closed (obligations met)', 'closed')} end as status,
    case when k % 5 <> 1 then '55.5' end as cbs_fx_rate,
    case when k % 5 <> 1 then '1,000.25' end as principal_usd_cbs,
    'Officer ' || {_text('k % 40')} as loan_officer
from (select o_orderkey as k, EACH(0, 1) as v, o_custkey, o_totalprice, o_orderdate from {{orders}}) as copies
where v = 0 or k % 23 = 0
"""

_TXN_ID = f"""case when l_partkey % 499 = 0 then null
         else 'TX' || {_text('l_orderkey')} || '-' || {_text('l_linenumber')} end"""

RAW["raw_cbs_repayments"] = f"""
select
    {_TXN_ID} as txn_id,
    case when l_partkey % 397 = 0 then '' when l_partkey % 389 = 0 then null else 'L' || {_text('l_orderkey')} end as loan_id,
    case when l_partkey % 307 = 0 then '2026-02-30T10:00:00Z'
         else {_text('cast(l_shipdate as date)')} || 'T' || {_two('l_partkey % 24')} || ':' || {_two('l_suppkey % 60')}
              || {_pick('l_partkey', ':00Z', ':30+02:00', ':15', '')} end as paid_at,
    case when l_partkey % 211 = 0 then '0.00' when l_partkey % 223 = 0 then 'paid'
         when l_suppkey % 19 = 0 then '-' || {_text('cast(l_extendedprice as decimal(18,2))')}
         else {_text('cast(l_extendedprice as decimal(18,2))')} end as amount,
    case when l_partkey % 401 = 0 then 'EUR' else {_pick('l_orderkey', 'ETB', 'KSH', 'rwf', 'SSP', ' XAF')} end as currency,
    {_pick('l_suppkey', 'Bank', 'M-Pesa', ' ')} as channel,
    case when l_suppkey % 19 = 0 and l_partkey % 2 = 0
         then 'TX' || {_text('l_orderkey')} || '-0' else '' end as reversal_of
from {{lineitem}}
"""

RAW["raw_fx_rates"] = f"""
select
    case when mk % 113 = 0 then 'GBP' else {_pick('idx', 'ETB', 'KSH', 'rwf', 'SSP', 'XAF')} end as currency,
    case when mk % 127 = 0 then 'today' when mk % 3 = 0 then replace({_text('d')}, '-', '/')
         else {_text('d')} end as rate_date,
    case when v = 1 then ' Parallel' when mk % 131 = 0 or d < cast(first_day as date) then 'street' else 'Official' end as rate_type,
    case when mk % 37 = 0 then '0' when mk % 41 = 0 then ''
         else {_text('50 + mk % 977 + v')} || '.' || {_two('mk % 100')} end as units_per_usd,
    'central bank' as source,
    {_text('d')} || 'T0' || {_text('v')} || ':00:00' as published_at
from (select idx, d, mk, case when idx = 3 then '1996-06-01' else '1995-03-01' end as first_day, EACH(0, 1, 2) as v
      from {{rate_days}}) as copies
where v = 0 or (v = 1 and mk % 2 = 0) or (v = 2 and mk % 11 = 0)
"""
RATE_DAYS = """
select o_orderkey % 5 as idx, cast(o_orderdate as date) as d, min(o_orderkey) as mk
from {orders}
group by o_orderkey % 5, cast(o_orderdate as date)
"""

RAW["raw_cbs_control_totals"] = f"""
select
    case when m = '1997-03' then 'Atlantis'
         else {_pick('idx', 'Ethiopia', 'Kenya ', 'RWA', 's. sudan', 'Tchad')} end as country,
    case when m = '1997-04' or (v = 0 and m like '%-07') then replace(m, '-', '/') else m end as month,
    case when m = '1997-02' then 'GBP' else {_pick('idx', 'ETB', 'Ksh', 'RWF', 'ssp', 'XAF')} end as currency,
    case when m = '1997-06' then '-1' when m like '%-05' then {_text('n_loans * 2')} || '.4' else {_text('n_loans')} end as loans_disbursed_count,
    case when m = '1997-01' then 'n/a' when m like '%-08' then {_text('loans * 1.1')} else {_text('loans')} end as loans_disbursed_amount,
    case when m = '1997-12' then '-3' else {_text('n_paid + v')} end as repayments_count,
    case when m = '1997-11' then 'many' else {_text('paid')} end as repayments_amount
from (select idx, m, n_loans, loans, n_paid, paid, EACH(0, 1) as v from {{control_months}}) as copies
where v = 0 or m like '%-09'
"""
CONTROL_MONTHS = """
select idx, m, sum(n_loans) as n_loans, sum(loans) as loans, sum(n_paid) as n_paid, sum(paid) as paid
from (
    select o_orderkey % 5 as idx, substr(cast(cast(o_orderdate as date) as string), 1, 7) as m,
           case when sound then 1 else 0 end as n_loans,
           case when sound then cast(o_totalprice as decimal(18,2)) else cast(0 as decimal(18,2)) end as loans,
           0 as n_paid, cast(0 as decimal(18,2)) as paid
    from (select o_orderkey, o_orderdate, o_totalprice, o_orderkey % 61 <> 0 and o_orderkey % 67 <> 0
                 and o_orderkey % 73 <> 0 and o_orderkey % 79 <> 0 as sound from {orders}) as every_order
    union all
    select l_orderkey % 5 as idx, substr(cast(cast(l_shipdate as date) as string), 1, 7) as m,
           0 as n_loans, cast(0 as decimal(18,2)) as loans, case when sound then 1 else 0 end as n_paid,
           case when sound then cast(l_extendedprice as decimal(18,2)) else cast(0 as decimal(18,2)) end as paid
    from (select l_orderkey, l_shipdate, l_extendedprice, l_partkey % 211 <> 0 and l_suppkey % 19 <> 0
                 and l_linenumber <= 4 as sound from {lineitem}) as every_line
) as facts
group by idx, m
"""

DERIVED = {"rate_days": RATE_DAYS, "control_months": CONTROL_MONTHS, **RAW}
SOURCES = ("ims_clients", "cbs_borrowers", "cbs_loans", "cbs_repayments", "fx_rates", "cbs_control_totals")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name))


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``DERIVED`` as a DataFrame over the tables of ``sf_dir``."""
    sql = DERIVED[name]
    inputs = {
        t: derived(spark, sf_dir, t) if t in DERIVED else _spread_table(spark, sf_dir, t)
        for t in (*TABLES, *DERIVED) if f"{{{t}}}" in sql
    }
    return spark.sql(re.sub(r"EACH\(([^)]*)\)", r"explode(array(\1))", sql), **inputs)


def raw(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    compiled(spark)
    return derived(spark, sf_dir, f"raw_{source}")


def raw_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw repayments with the rows of a key in one task, as an export would send them. The given rows are dealt and then
    rendered, which is less to shuffle."""
    compiled(spark)
    lines = table(spark, sf_dir, "lineitem").repartition(F.expr(_TXN_ID))
    return spark.sql(DERIVED["raw_cbs_repayments"], lineitem=lines)


def raw_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s: raw(spark, sf_dir, s) for s in SOURCES}


def plain_sql(name: str) -> str:
    """The same SELECT for DuckDB, reading views and CTEs by name."""
    sql = DERIVED[name]
    for t in (*TABLES, *DERIVED):
        sql = sql.replace(f"{{{t}}}", t)
    return re.sub(r"EACH\(([^)]*)\)", r"unnest([\1])", sql).strip()


def scratch(spark: SparkSession) -> str:
    """A new folder for what a query has to write."""
    return scratch_root(spark)
