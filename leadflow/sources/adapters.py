"""Lead-shaped projections of star-schema tables. Each is one SQL text that any engine can run.

On a session, `source(spark, folder, name)` reads only the table and columns that the text needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.functions.text import hmac_sha256, normal_phone, normal_postcode


def _q(k: str, n: int) -> str:
    return f"cast(floor(({k})/{n}) as bigint)"


def _s(x: str) -> str:
    return f"cast({x} as string)"


def _area(k: str) -> str:
    return f"trim(substr('UBW HATWSWSL', cast(2*(({k})%6)+1 as int), 2))"


def _letter(i: str) -> str:
    return f"substr('ABDEFGHJLNPQRSTUWXYZ', cast(({i})%20+1 as int), 1)"


def _postcode(k: str) -> str:
    return f"{_area(k)} || {_s(_q(k, 6) + '%9+1')} || ' ' || {_s(_q(k, 54) + '%9+1')} || {_letter(_q(k, 486))} || {_letter(_q(k, 9720))}"


def _w1(i: str) -> str:
    return f"trim(substr('GoldenRoyal Flame Urban CrispySpicy Prime ', cast(({i})*6+1 as int), 6))"


def _w2(i: str) -> str:
    return f"trim(substr('Grill  ChickenBurger Kebab  Pizza  Wings  Noodle ', cast(({i})*7+1 as int), 7))"


def _name(k: str) -> str:
    return f"{_w1(f'({k})%7')} || ' ' || {_w2(_q(k, 7) + '%7')} || ' ' || {_s(f'({k})%97')}"


def _address(k: str) -> str:
    return f"{_s(f'({k})%200+1')} || ' ' || {_w1(_q(k, 200) + '%7')} || ' Road'"


def _phone(k: str) -> str:
    return f"'07' || lpad({_s(f'({k})%1000000000')}, 9, '0')"


_K = "(case when o_orderkey%5=0 then o_custkey+100000 else o_custkey end)"
# Keys under which the odd customers and some parts trade: no row is left out, but these meet no premises.
_C = "(case when c_custkey%2=0 then c_custkey else c_custkey+500000 end)"
_P8 = "(case when p_partkey%8<>0 then p_partkey else p_partkey+500000 end)"
_P9 = "(case when p_partkey%9<>0 then p_partkey else p_partkey+500000 end)"
_DISTRICT = f"{_area(_K)} || {_s(_q(_K, 6) + '%9+1')}"
_N = "cast(floor(o_totalprice) as bigint)"
# Figures of filed accounts; the same names with c_ and p_ in front are those of the current and the prior year.
FIGURES = ("total_assets", "fixed_assets", "current_assets", "cash_at_bank", "debtors", "creditors", "current_liabilities", "net_assets", "equity", "turnover", "gross_profit", "net_profit", "employees")
_REGISTRATION = f"""{_name(_P9)} || ' Foods' as operator_name, {_address(_P9)} as address, {_postcode(_P9)} as postcode, p_type as business_type, cast(p_size%6 as bigint) as hygiene, cast(p_partkey%400 as bigint) as days_since_registration,
  cast(p_size*10 as bigint) as last_inspection_age, cast('51.' || lpad({_s('p_partkey%10000')}, 4, '0') as decimal(8,4)) as lat, cast('-0.' || lpad({_s('p_partkey*3%10000')}, 4, '0') as decimal(8,4)) as lng from part"""

_COMPANY = f"""{_name(_P8)} || ' Foods' as company_name, {_address(_P8)} as address, {_postcode(_P8)} as postcode, case when p_partkey%4=3 then '47110' else '56103' end as sic_code, p_partkey%13=0 as charges, p_partkey%17=0 as strike_off"""

SQL: dict[str, tuple[str, str]] = {
    "listings": (
        "orders",
        f"""select o_orderkey as listing_id, {_K} as premises_no,
  case o_orderkey%3 when 0 then 'justeat' when 1 then 'ubereats' else 'deliveroo' end as platform,
  (case when o_orderkey%7=0 then {_name(_K + '+13')} else {_name(_K)} end) || (case when o_orderkey%4=0 then ' Ltd' else '' end) as brand_name,
  {_address(_K)} as address, {_postcode(_K)} as postcode, {_phone(_K)} as phone,
  cast(floor(o_totalprice/100) as bigint) as reviews, cast(10+o_orderkey%41 as bigint) as rating_tenths, cast(o_orderdate as date) as listed_on,
  'https://p' || {_s('o_orderkey%3')} || '.example/' || {_s('o_orderkey')} as url, {_w2(_q(_K, 7) + '%7')} as cuisine_type, 199501+{_K}%12 as run_no
from orders""",
    ),
    "customers": (
        "customer",
        f"""select 'A' || {_s('c_custkey')} as account_code, c_custkey as customer_no, {_name(_C)} as name, {_address(_C)} as address,
  {_postcode(_C)} as postcode, {_phone(_C)} as phone, case when c_custkey%3=0 then 'inactive' else 'active' end as status,
  cast(c_custkey%4 as bigint) as rep_no from customer""",
    ),
    "registrations": (
        "part",
        f"""select fsa_id, operator_name, address, postcode, business_type, hygiene, days_since_registration, last_inspection_age, lat, lng from (
  select p_partkey as fsa_id, {_REGISTRATION}
  union all
  select p_partkey+1000000, {_REGISTRATION} where p_partkey%11=0) r""",
    ),
    "companies": (
        "part",
        f"""select ch_number, company_name, address, postcode, ch_status, sic_code, age_days, case when ch_status='Dissolved' then gone end as dissolved_age, charges, strike_off from (
  select lpad({_s(_P8)}, 8, '0') as ch_number, {_COMPANY}, case p_partkey%10 when 0 then 'Dissolved' when 1 then 'In Administration' else 'Active' end as ch_status, cast(p_partkey%700 as bigint) as age_days, cast(p_partkey%350 as bigint) as gone from part
  union all select 'X' || lpad({_s(_P8)}, 7, '0'), {_COMPANY}, 'Dissolved', cast(900+p_partkey%50 as bigint), cast(p_partkey%701+p_partkey%3-1 as bigint) from part where p_partkey%6=1
  union all select 'Y' || lpad({_s(_P8)}, 7, '0'), {_COMPANY}, 'Dissolved', cast(950 as bigint), cast(p_partkey%701+p_partkey%5-1 as bigint) from part where p_partkey%12=1) c""",
    ),
    "officers": (
        "part",
        f"""select lpad({_s(_P8)}, 8, '0') as ch_number, case p_partkey%4 when 0 then 'Mr Dir Person' || {_s('p_partkey%300')} when 1 then 'PERSON' || {_s('p_partkey%300')} || ', Dir' else 'dir  person' || {_s('p_partkey%300')} end as person_name,
  {_s('p_partkey%300%12+1')} as birth_month, 'director' as kind, 'Director' as role, cast(p_partkey*7%900 as bigint) as appointed_age from part
  union all select lpad({_s(_P8)}, 8, '0'), 'Other ' || lpad({_s('(case when p_partkey%50=0 then p_partkey+1 else p_partkey end)%300')}, 3, '0'), null, 'director', 'Director', cast(p_partkey*13%900 as bigint) from part where p_partkey%2=0 or p_partkey%50=1
  union all select lpad({_s(_P8)}, 8, '0'), 'Psc ' || lpad({_s(_P8)}, 8, '0'), null, 'psc', '', cast(p_partkey*11%900 as bigint) from part""",
    ),
    "filings": (
        "orders",
        f"""select lpad({_s('o_custkey')}, 8, '0') as ch_number, o_orderkey as filing_id, cast(o_orderdate as date) as period_end, case when o_orderkey%23=0 then 'Dormant' when o_orderkey%2=0 then 'Micro' else 'Small' end as accounts_type,
  {_q(_N, 3)}+{_q(_N, 2)} as total_assets, {_q(_N, 3)} as fixed_assets, {_q(_N, 2)} as current_assets, {_q(_N, 7)} as cash_at_bank, {_q(_N, 5)} as debtors, cast(o_orderkey%90000 as bigint) as creditors, cast(o_orderkey%50000 as bigint) as current_liabilities,
  {_N}-150000 as net_assets, {_N}-149000 as equity, {_N}*4 as turnover, {_N} as gross_profit, {_q(_N, 9)}-1000 as net_profit, cast(o_orderkey%60 as bigint) as employees from orders""",
    ),
    "place_lookups": (
        "customer",
        f"""select c_custkey as premises_no, 'P' || {_s('c_custkey')} as place_id, cast(30+c_custkey%20 as bigint) as rating_tenths, cast(c_custkey%900 as bigint) as reviews, '020' || lpad({_s('c_custkey')}, 8, '0') as phone, {_address('c_custkey')} as address, cast(c_custkey%100 as bigint) as looked_up_age from customer""",
    ),
    "signals": (
        "events",
        """select user_id as lead_no, case event_type when 'signup' then 'new_fsa' when 'purchase' then 'ownership_change' else 'review_complaint' end as trigger_type, ts
from events where event_type in ('signup', 'purchase', 'error')""",
    ),
    "runs": (
        "orders",
        """select run_id, run_id as run_no, run_id%5 as territory_no, 'weekly' as run_type, case when run_id%7=0 then 'failed' else 'complete' end as status, discovered, cost, last_day from (
  select year(o_orderdate)*100+month(o_orderdate) as run_id, count(*) as discovered, cast(count(*)%900 as double)/100 as cost, max(cast(o_orderdate as date)) as last_day from orders group by year(o_orderdate)*100+month(o_orderdate)) r""",
    ),
    "territory": (
        "orders",
        f"""select distinct 'outer_code' as item_type, {_DISTRICT} as value, cast(null as string) as source_file_id, false as is_expansion from orders where {_q(_K, 6)}%9+1<>8""",
    ),
    "boundary": (
        "orders",
        f"""select distinct {_DISTRICT} as code, case when {_area(_K)}='SL' then 'expansion' else 'in_area' end as membership from orders where {_area(_K)}<>'SW'""",
    ),
    "denied": (
        "customer",
        f"""select 'phone' as match_type, {_phone('c_custkey')} as match_value, case when c_custkey%100=0 then 'withdrawn' else 'active' end as status from customer where c_custkey%50=0
  union all select 'postcode', {_postcode('c_custkey')}, 'active' from customer where c_custkey%90=0
  union all select 'phone', '020' || lpad({_s('c_custkey')}, 8, '0'), 'active' from customer where c_custkey%70=0""",
    ),
    "erased": ("customer", f"""select {_phone('c_custkey')} as subject, case when c_custkey%2=0 then 'import' else 'marketing' end as scope from customer where c_custkey%45=0"""),
    "batches": (
        "orders",
        """select distinct (year(o_orderdate)*100+month(o_orderdate))%4 as batch_id, case (year(o_orderdate)*100+month(o_orderdate))%4 when 0 then 'draft' else 'approved' end as status from orders""",
    ),
    "reviews": (
        "documents",
        """select doc_id%997 as premises_no, source, text || case doc_id%11 when 0 then ' The order was late again and late once more.' when 1 then ' Not late this time, but the food was cold.' when 2 then ' All sold before noon, they had no stock.' when 3 then ' Never stale, always in stock.'
  when 4 then ' Wrong items twice and it never arrived hot.' when 5 then ' Quality varies; bread not very fresh.' else '' end as text, doc_id%200 as age_days from documents""",
    ),
    "raw_pages": ("pages", "select page_id, url, html from pages"),
}


def projected(spark: SparkSession, name: str, table: DataFrame) -> DataFrame:
    """A projection of a table that is at hand, a stream, too."""
    of, text = SQL[name]
    return spark.sql(text.replace(f"from {of}", "from {t}"), t=table)


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return projected(spark, name, spark.read.parquet(f"{folder}/{SQL[name][0]}.parquet"))


# Mapping table of the CRM file: (layout field, target field, transform, verified), and the fields that each batch uses.
MAPPINGS = (("Primary_Brand_Name", "name", "upper", True), ("Lead_Score", "score", "none", True), ("Phone_Mobile_1", "phone", "digits", True), ("Priority_Tier", "tier", "none", False))
PEPPER = "pepper"  # of these projections only; a run over landed files is given its own


def tables(spark: SparkSession, folder: str, pepper: str) -> Callable[[str], DataFrame]:
    """The tables of a lead run from a folder of star-schema tables. Suppressed and erased subjects are
    hashed here, as they would be when they are entered."""
    value = F.when(F.col("match_type") == "phone", normal_phone(F.col("match_value"))).when(F.col("match_type") == "postcode", normal_postcode(F.col("match_value"))).otherwise(F.lower("match_value"))

    def table(name: str) -> DataFrame:
        if name == "suppression":
            return source(spark, folder, "denied").select("match_type", hmac_sha256(value, pepper).alias("match_hmac"), "status").distinct()
        if name == "tombstones":
            return source(spark, folder, "erased").select(hmac_sha256(normal_phone(F.col("subject")), pepper).alias("subject_hmac"), "scope").distinct()
        if name == "territory_files":
            return spark.createDataFrame([], "file_id string, code string")
        if name == "mappings":
            return spark.createDataFrame(list(MAPPINGS), "internal_field string, target_field string, transform string, is_verified boolean")
        if name == "batch_fields":  # batches 0 and 1 use verified mappings only, batch 2 one that is not, batch 3 none
            fields = [(k, m[0]) for k in range(3) for m in MAPPINGS if m[3] or k == 2]
            return spark.createDataFrame(fields, "batch_id bigint, internal_field string")
        return source(spark, folder, name)

    return table
