"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadflow.config import DEFAULT as C
from leadflow.config import ENUMS
from leadflow.functions import text as T
from leadflow.operators import accounts, compliance, contacts, export, matching, premises, quality, reporting, routing, scoring, territory, triggers
from leadflow.plans.leads import lead_run
from leadflow.plans.oracles import AS_OF, CTES, akey, by_level, hmac, oracle, parts, ratio, sorted_tokens
from leadflow.sources import files
from leadflow.sources.adapters import FIGURES, MAPPINGS, PEPPER, projected
from leadflow.streaming import same_day

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_CASTS = {"d": ("string", "varchar"), "n": ("bigint", "bigint"), "s": ("string", "varchar")}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [tuple((c + ":").split(":")[:2]) for c in spec.split()]  # type: ignore[misc]


def query(name: str, spec: str, sql: str | None, extra: dict[str, str] | None = None):
    """Register a function of a lead run; spec: columns, with :d for dates as text, :n for numbers."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(lead_run(spark, sf_dir))
            return df.select(*[F.col(c).cast(_CASTS[k][0]).alias(c) if k else F.col(c) for c, k in _columns(spec)])

        QUERIES[name] = run
        if sql is not None:
            cols = ", ".join(f"cast({c} as {_CASTS[k][1]}) as {c}" if k else c for c, k in _columns(spec))
            body = sql if sql.startswith("select") else f"select * from {sql}"
            ORACLES[name] = oracle(f"select {cols} from ({body}) answer", extra)
        return fn

    return add


# A. Sources and sinks
@query("listings_union", "listing_id platform brand_name postcode reviews:n listed_on:d", "listings")
def _(r):
    return files.union_listings([r.listings.filter(F.col("platform") == p) for p in premises.PLATFORMS])


# Customers land as a CSV file in which each 50th line has a representative that is no number.
@query("customers_load", "account_code name address postcode phone status rep_no:n corrupt", "select account_code, name, address, postcode, phone, status, case when customer_no%50<>0 then rep_no end as rep_no, customer_no%50=0 as corrupt from customers")
def _(r):
    folder = f"{r.work}/landed-customers"
    rep = F.when(F.col("customer_no") % 50 == 0, "none").otherwise(F.col("rep_no").cast("string"))
    r.table("customers").select("account_code", "name", "address", "postcode", "phone", "status", rep.alias("rep_no")).write.mode("overwrite").option("header", True).csv(folder)
    return files.load_customers(r.spark, folder).withColumn("corrupt", F.col("_corrupt").isNotNull())


_RAW = "select case when customer_no%7=0 then null when customer_no%11=0 then lower(postcode)||'  ' when customer_no%13=0 then 'N/A' else postcode end as postcode from customers"


def _raw_postcodes(r) -> DataFrame:
    k = F.col("customer_no")
    return r.table("customers").select(F.when(k % 7 == 0, None).when(k % 11 == 0, F.concat(F.lower("postcode"), F.lit("  "))).when(k % 13 == 0, "N/A").otherwise(F.col("postcode")).alias("postcode"))


@query("import_postcodes", "rows_total:n rows_missing:n status", f"select count(*) as rows_total, count(*) filter (unit is null) as rows_missing, case when count(*)=count(*) filter (unit is null) then 'failed' else 'parsed' end as status from (select {parts()} from rawp)", {"rawp": _RAW})
def _(r):
    return territory.import_postcodes(_raw_postcodes(r))


_BCODES = "select distinct case k when 0 then district when 1 then sector else unit end as code, case when area='SL' then 'expansion' else 'in_area' end as membership from (select *, premises_no%3 as k from lp) where area<>'SW'"


def _boundary_list(r) -> DataFrame:
    k = F.col("premises_no") % 3
    raw = r.keyed.filter("area <> 'SW'").select(F.when(k == 0, F.lower("district")).when(k == 1, F.col("sector")).otherwise(F.col("unit")).alias("code"), F.when(F.col("area") == "SL", "expansion").otherwise("in_area").alias("membership"))
    return territory.import_boundary(raw.distinct())


@query("import_boundary", "code granularity membership", "select code, case when length(split_part(code,' ',2))=0 then 'district' when length(split_part(code,' ',2))=1 then 'sector' else 'unit' end as granularity, membership from bcodes", {"bcodes": _BCODES})
def _(r):
    return _boundary_list(r)


@query("boundary_counts", "codes:n in_area:n expansion:n status", "select count(*) as codes, count(*) filter (membership='in_area') as in_area, count(*) filter (membership='expansion') as expansion, 'parsed' as status from bcodes", {"bcodes": _BCODES})
def _(r):
    return territory.boundary_counts(_boundary_list(r))


# The files that one table was landed in, a line a customer; sizes and hashes are those of the text itself.
_LINES = "select customer_no%5 as part, string_agg(customer_no||chr(10), '' order by customer_no) as body, count(*) as row_count from customers group by 1"


@query("file_manifest", "file row_count:n length:n sha256", f"select 'part'||part||'.txt' as file, row_count, octet_length(encode(body)) as length, sha256(body) as sha256 from ({_LINES}) f")
def _(r):
    folder = f"{r.work}/landed-lines"
    lines = r.table("customers").select((F.col("customer_no") % 5).alias("part"), F.col("customer_no"))
    lines.repartition("part").sortWithinPartitions("part", "customer_no").select(F.col("customer_no").cast("string").alias("value"), "part").write.mode("overwrite").partitionBy("part").text(folder)
    got = files.file_manifest(r.spark, f"{folder}/*/*.txt", r.spark.read.text(f"{folder}/*/*.txt"))
    return got.select(F.concat(F.lit("part"), F.regexp_extract("path", "part=([0-9]+)", 1), F.lit(".txt")).alias("file"), "row_count", "length", "sha256")


_TAG = "'<ix:nonFraction {a}>'||{v}||'</ix:nonFraction>'"
_CONTEXT = "'<xbrli:context id=\"{i}\"><xbrli:entity><xbrli:identifier>1</xbrli:identifier>{m}</xbrli:entity><xbrli:period>{p}</xbrli:period></xbrli:context>'"
_INSTANT, _SPAN = "<xbrli:instant>#{d}</xbrli:instant>", "<xbrli:startDate>2000-01-01</xbrli:startDate><xbrli:endDate>#{d}</xbrli:endDate>"
_MEMBER = "<xbrli:segment><xbrldi:explicitMember dimension=\"d\">m</xbrldi:explicitMember></xbrli:segment>"
# Contexts with ids that differ from filing to filing: instants and spans of this year, last year and the year
# before, and one of a part of the company. Attributes in any order, amounts in thousands, negative amounts by
# attribute and by parentheses, an unknown tag, facts of contexts that are not the company's two years.
_BODY = " || ' ' || ".join([
    *(_CONTEXT.format(i=i, m=m, p=p) for i, m, p in (("p@", "", _INSTANT.format(d="P")), ("c@i", "", _INSTANT.format(d="C")), ("@d", "", _SPAN.format(d="C")), ("o@", "", _INSTANT.format(d="O")), ("s@", _MEMBER, _INSTANT.format(d="C")))),
    *(_TAG.format(a=a, v=v) for a, v in (
        ('name="uk:NetAssets" contextRef="c@i" unitRef="GBP"', "cast(net_assets as string)"),
        ('contextRef="p@" decimals="0" name="uk:NetAssets"', "cast(net_assets-filing_id%1000 as string)"),
        ('contextRef="o@" name="uk:NetAssets"', "'77'"),
        ('name="uk:NetAssets" contextRef="s@"', "'999999999'"),
        ('name="uk:CashBankOnHand" contextRef="c@i"', "'1,'||lpad(cast(filing_id%1000 as string), 3, '0')"),
        ('scale="3" contextRef="c@i" name="core:Debtors"', "cast(filing_id%70 as string)"),
        ('name="core:Creditors" sign="-" contextRef="c@i"', "cast(creditors as string)"),
        ('name="core:NetProfit" contextRef="@d"', "'('||cast(filing_id%90 as string)||')'"),
        ('name="core:Other" contextRef="c@i"', "'5'"),
    )),
])


def _filed(r) -> DataFrame:
    body = F.expr(_BODY)
    for mark, value in (("@", "cast(filing_id%90 as string)"), ("#C", "cast(period_end as string)"), ("#P", "cast(date_sub(period_end, 365) as string)"), ("#O", "cast(date_sub(period_end, 730) as string)")):
        body = F.replace(body, F.lit(mark), F.expr(value))
    tasks = int(r.spark.conf.get("spark.sql.shuffle.partitions"))
    filings = r.table("filings").repartition(tasks, "filing_id")  # a file of one row group is read by one task; the steps behind shuffle no more
    return filings.select("filing_id", body.alias("body"))


@query("filing_facts", "filing_id tag current_amount:n prior_amount:n", "select filing_id, 'NetAssets' as tag, net_assets as current_amount, net_assets-filing_id%1000 as prior_amount from filings union all select filing_id, 'CashBankOnHand', 1000+filing_id%1000, null from filings union all select filing_id, 'Debtors', 1000*(filing_id%70), null from filings union all select filing_id, 'Creditors', -creditors, null from filings union all select filing_id, 'NetProfit', -(filing_id%90), null from filings")
def _(r):
    out = accounts.extract_filing_facts(_filed(r))
    return out.withColumnsRenamed({"current": "current_amount", "prior": "prior_amount"})


@query("filing_figures", "filing_id net_assets:n cash_at_bank:n debtors:n creditors:n net_profit:n turnover:n", "select filing_id, net_assets, 1000+filing_id%1000 as cash_at_bank, 1000*(filing_id%70) as debtors, -creditors as creditors, -(filing_id%90) as net_profit, null as turnover from filings")
def _(r):
    return accounts.facts_wide(accounts.extract_filing_facts(_filed(r)))


_EXPORTED = "select 'crm' as output, count(*) as rows_written from routed where route='export' and run_no%4=1 union all select 'ignored_log', count(*) from routed where route='ignored' union all select 'reactivation', count(*) from routed where route='reactivation' union all select 'expansion', count(*) from routed where route='expansion' union all select 'telemetry', 10"


@query("outputs_roundtrip", "output run_id:n rows_written:n", f"select *, 199501 as run_id from ({_EXPORTED}) o")
def _(r):
    outputs = {
        "crm": export.mapped_snapshot(_flat(r, r.cleared).select("Lead_ID", *[m[0] for m in MAPPINGS]), r.table("mappings")),
        "ignored_log": routing.ignored_log(r.routed),
        "reactivation": routing.reactivation(r.routed, _last_orders(r)),
        "expansion": routing.expansion(r.routed),
        "telemetry": _telemetry(r),
    }
    paths = files.write_outputs(outputs, f"{r.work}/outputs", 199501)
    schemas = {name: df.withColumn("run_id", F.lit(0).cast("bigint")).schema for name, df in outputs.items()}
    read = [r.spark.read.schema(schemas[name]).parquet(path).filter("run_id = 199501").agg(F.count("*").alias("rows_written")).select(F.lit(name).alias("output"), F.lit(199501).alias("run_id"), "rows_written") for name, path in paths.items()]
    return reduce(DataFrame.unionByName, read)


# B. Territory
@query("postcode_parts", "listing_id area district sector unit", "lp")
def _(r):
    return T.with_postcode_parts(r.listings)


@query("postcode_explode", "listing_id code granularity", "select * from (" + by_level("listing_id", "lp") + ")")
def _(r):
    return territory.explode_granularity(T.with_postcode_parts(r.listings))


_ITEMS = {
    "titems": "select 'outer_code' as item_type, district as value, null as source_file_id, false as is_expansion from lp where premises_no%9=0 union select 'pasted_list', lower(sector)||', '||district, null, false from lp where premises_no%10=0 union select 'expansion_list', null, 'F1', true from lp",
    "tfiles": "select distinct 'F1' as file_id, sector as code from cust where customer_no%5=0",
    "tcodes": "select value as code, is_expansion from titems where item_type='outer_code' union all select upper(trim(unnest(string_split(value, ',')))), is_expansion from titems where item_type='pasted_list' union all select code, is_expansion from titems join tfiles on source_file_id=file_id",
    "tres": "select code, case when contains(code, ' ') then 'sector' else 'district' end as granularity, bool_or(is_expansion) as is_expansion from tcodes group by code",
}


def _territory(r) -> DataFrame:
    lp = T.with_postcode_parts(r.listings)
    none = F.lit(None).cast("string")
    row = lambda df, t, v, f, e: df.select(F.lit(t).alias("item_type"), v.alias("value"), f.alias("source_file_id"), F.lit(e).alias("is_expansion")).distinct()
    items = row(lp.filter("premises_no % 9 = 0"), "outer_code", F.col("district"), none, False)
    items = items.unionByName(row(lp.filter("premises_no % 10 = 0"), "pasted_list", F.concat(F.lower("sector"), F.lit(", "), "district"), none, False))
    items = items.unionByName(row(lp, "expansion_list", none, F.lit("F1"), True))
    listed = r.customers.filter("customer_no % 5 = 0").select(F.lit("F1").alias("file_id"), F.col("sector").alias("code")).distinct()
    return territory.resolve_territory(items, listed)


@query("territory_resolve", "code granularity is_expansion", "tres", _ITEMS)
def _(r):
    return _territory(r)


@query("territory_snapshot", "run_no:n code granularity postcodes:n", f"select 199501 as run_no, t.code, t.granularity, coalesce(p.n, 0) as postcodes from tres t left join (select code, granularity, count(distinct unit) as n from lpx group by code, granularity) p on t.code=p.code and t.granularity=p.granularity", _ITEMS | {"lpx": by_level("unit", "lp")})
def _(r):
    return territory.snapshot_territory(199501, _territory(r), r.keyed)


@query("territory_filter", "listing_id unit", "select listing_id, unit from lp where district in (select code from tres where granularity='district') or sector in (select code from tres where granularity='sector')", _ITEMS)
def _(r):
    return territory.filter_territory(r.keyed, _territory(r))


_MIXED = {"mixed": "select code, granularity, membership from boundary union all select distinct sector, 'sector', 'expansion' from lp where premises_no%17=0"}


@query("delivery_class", "lead_key membership", "select p.lead_key, coalesce(s.membership, d.membership, 'outside') as membership from prem p left join mixed s on s.granularity='sector' and s.code=p.sector left join mixed d on d.granularity='district' and d.code=p.district", _MIXED)
def _(r):
    extra = r.keyed.filter("premises_no % 17 = 0").select(F.col("sector").alias("code"), F.lit("sector").alias("granularity"), F.lit("expansion").alias("membership")).distinct()
    return territory.classify_delivery(r.premises, r.boundary.unionByName(extra))


@query("boundary_current", "owner boundary_id:n n_current:n ok", "select run_no%100 as owner, max(case when run_no%5=0 then run_no end) as boundary_id, count(*) filter (run_no%5=0) as n_current, count(*) filter (run_no%5=0)=1 as ok from runs group by run_no%100")
def _(r):
    return territory.current_boundary(r.table("runs").select((F.col("run_no") % 100).alias("owner"), F.col("run_no").alias("boundary_id"), (F.col("run_no") % 5 == 0).alias("is_current")))


@query("roads_select", "road road_class", "select s_name as road, case s_suppkey%3 when 0 then 'feeder' when 1 then 'primary' else 'other' end as road_class from supplier where s_suppkey%3=1")
def _(r):
    s = r.spark.read.parquet(f"{r.folder}/supplier.parquet")
    k = F.col("s_suppkey") % 3
    roads = s.select(F.col("s_name").alias("road"), F.when(k == 0, "feeder").when(k == 1, "primary").otherwise("other").alias("class"))
    config = r.spark.read.parquet(f"{r.folder}/nation.parquet").select((F.col("n_nationkey") == 3).alias("is_default"), F.lit("primary").alias("mode"), F.array("n_name").alias("custom"))
    return territory.select_roads(roads, config).withColumnRenamed("class", "road_class")


_OVERLAY = {"custx": by_level("account_code", "cust"), "lpc": "select distinct code, granularity from (" + by_level("listing_id", "lp") + ")"}


@query("overlay_customers", "code granularity points:n", "select c.code, c.granularity, coalesce(p.n, 0) as points from lpc c left join (select code, granularity, count(*) as n from custx group by code, granularity) p on c.code=p.code and c.granularity=p.granularity", _OVERLAY)
def _(r):
    coverage = territory.explode_granularity(r.keyed).select("code", "granularity").distinct()
    return territory.overlay(coverage, r.customers)


_ROADS = "select s_name as road, case s_suppkey%3 when 0 then 'feeder' when 1 then 'primary' else 'other' end as road_class, s_suppkey%7=0 as listed from supplier"


# Every mode of the configuration: the custom list holds each seventh road.
@query("roads_modes", "mode road road_class", "select 'all' as mode, road, road_class from roads union all select 'primary', road, road_class from roads where road_class='primary' union all select 'feeder', road, road_class from roads where road_class='feeder' union all select 'custom', road, road_class from roads where listed", {"roads": _ROADS})
def _(r):
    k = F.col("s_suppkey")
    s = r.spark.read.parquet(f"{r.folder}/supplier.parquet").select(F.col("s_name").alias("road"), F.when(k % 3 == 0, "feeder").when(k % 3 == 1, "primary").otherwise("other").alias("class"), (k % 7 == 0).alias("listed"))
    out = []
    for mode in ("all", "primary", "feeder", "custom"):
        config = s.agg(F.collect_set(F.when(F.col("listed"), F.col("road"))).alias("custom")).select(F.lit(True).alias("is_default"), F.lit(mode).alias("mode"), "custom")  # a configured list
        out.append(territory.select_roads(s, config).select(F.lit(mode).alias("mode"), "road", F.col("class").alias("road_class")))
    return reduce(DataFrame.unionByName, out)


# C. Premises and contacts
@query("address_key", "listing_id address_key", f"select listing_id, {akey('addr')} as address_key from (select listing_id, case when listing_id%3=0 then replace(address, 'Road', 'Rd.') else upper(address) end as addr from listings)")
def _(r):
    addr = F.when(F.col("listing_id") % 3 == 0, F.replace("address", F.lit("Road"), F.lit("Rd."))).otherwise(F.upper("address"))
    return premises.with_address_key(r.listings.withColumn("address", addr))


@query("premises_group", "lead_key primary_brand all_brands brand_count:n platforms_count:n reviews:n rating_tenths:n phone listings:n multi_brand cuisines", "prem")
def _(r):
    return r.premises


# Listings of which some have no usable postcode or address.
_BAD = {"lpbad": f"select *, {parts()}, {akey()} as address_key from (select * replace (case when listing_id%89=0 then 'N/A' when listing_id%97=0 then null else postcode end as postcode, case when listing_id%83=0 then null else address end as address) from listings)"}
_BAD["prembad"] = CTES["prem"].replace("from lp)", "from lpbad)")


def _bad_premises(r) -> DataFrame:
    k = F.col("listing_id")
    bad = r.listings.withColumn("postcode", F.when(k % 89 == 0, "N/A").when(k % 97 != 0, F.col("postcode"))).withColumn("address", F.when(k % 83 != 0, F.col("address")))
    return premises.group_premises(bad)


@query("premises_malformed", "lead_key primary_brand brand_count:n listings:n unit", "prembad", _BAD)
def _(r):
    return _bad_premises(r)


@query("lead_id_malformed", "lead_key lead_id", "select lead_key, 'LD-'||coalesce(area, 'ZZ')||'-'||lpad(cast(row_number() over (partition by coalesce(area, 'ZZ') order by coalesce(sector, '~'||substr(md5(lead_key), 1, 2)), unit nulls first, address_key nulls first, lead_key) as varchar), 5, '0') as lead_id from prembad", _BAD)
def _(r):
    return premises.assign_lead_id(_bad_premises(r).withColumn("tenant", F.lit(None).cast("bigint")), C.prefix)


_SPLIT = {"split": "select p.*, coalesce(n.registrations, 0) as registrations, r.fsa_id as tenant from prem p left join regn n on p.address_key=n.address_key and p.unit=n.unit left join regk r on n.registrations>1 and r.address_key=p.address_key and r.unit=p.unit"}


@query("premises_split", "lead_key tenant registrations:n", "split", _SPLIT)
def _(r):
    return premises.split_multi_tenant(r.premises, r.table("registrations"))


@query("lead_id", "lead_key tenant lead_id", "select *, 'LD-'||area||'-'||lpad(cast(row_number() over (partition by area order by sector, unit, address_key, lead_key, coalesce(tenant, 0)) as varchar), 5, '0') as lead_id from split", _SPLIT)
def _(r):
    return premises.assign_lead_id(premises.split_multi_tenant(r.premises, r.table("registrations")), C.prefix)


@query("lead_brands", "address_key unit pos:n brand is_primary", "select address_key, unit, i-1 as pos, b[i] as brand, b[i]=primary_brand as is_primary from (select *, string_split(all_brands, ' | ') as b, unnest(range(1, brand_count+1)) as i from prem)")
def _(r):
    return premises.lead_brands(r.premises)


_PROFILES = {"profiles": "select address_key, unit, platform, max(rating_tenths) as rating, max(reviews) as reviews, first(url order by listing_id) as url from lp group by address_key, unit, platform"}
_WIDE = "select address_key, unit, " + ", ".join(f"max(case when platform='{p}' then {c} end) as {p}_{c}" for p in premises.PLATFORMS for c in ("rating", "reviews", "url")) + " from profiles group by address_key, unit"


@query("platform_pivot", "address_key unit justeat_rating:n justeat_reviews:n ubereats_rating:n ubereats_reviews:n deliveroo_rating:n deliveroo_reviews:n", _WIDE, _PROFILES)
def _(r):
    return premises.pivot_platforms(premises.platform_profiles(r.keyed))


@query("platform_unpivot", "address_key unit platform rating:n reviews:n", "profiles", _PROFILES)
def _(r):
    return premises.unpivot_platforms(premises.pivot_platforms(premises.platform_profiles(r.keyed)))


_CONTACTS = {
    "rawc": """select lead_key, phone, 4 as priority, 'listing' as source from leads union all select l.lead_key, case when customer_no%3=0 then '+44 '||substr(c.phone, 2) else c.phone end, 5, 'customer' from leads l join cust c on l.address_key=c.address_key and l.unit=c.unit
  union all select lead_key, '020'||lpad(cast(premises_no%10000000 as varchar), 8, '0'), 3, 'place' from leads where premises_no%4=0
  union all select lead_key, case when premises_no%2=0 then '0161'||lpad(cast(premises_no%1000000 as varchar), 7, '0') else '' end, 2, 'website' from leads
  union all select lead_key, '0113 '||lpad(cast(premises_no%1000000 as varchar), 7, '0'), 2, 'website' from leads where premises_no%8=0 union all select lead_key, '079'||lpad(cast(premises_no%1000000 as varchar), 8, '0'), 1, 'whatsapp' from leads where premises_no%5=0""",
    "normc": "select lead_key, case when regexp_matches(d, '^44[0-9]{10}$') then '0'||substr(d, 3) else nullif(d, '') end as phone, priority, source from (select *, regexp_replace(phone, '[^0-9]', '', 'g') as d from rawc)",
    "allc": "select lead_key, phone, case when starts_with(phone, '07') then 'mobile' else 'landline' end as kind, min(priority) as priority, first(source order by priority) as source from normc where phone is not null group by lead_key, phone",
}


def _contacts(r) -> DataFrame:
    p, c = r.leads, r.customers
    made = lambda every, start, width: p.filter(F.col("premises_no") % every == 0).select("lead_key", F.concat(F.lit(start), F.lpad((F.col("premises_no") % 1000000).cast("string"), width, "0")).alias("phone"))
    site = p.filter("premises_no % 2 <> 0").select("lead_key", F.lit("").alias("phone")).unionByName(made(2, "0161", 7)).unionByName(made(8, "0113 ", 7))
    near = p.select("lead_key", "address_key", "unit").join(c.select("address_key", "unit", "customer_no", "phone"), ["address_key", "unit"])
    place = p.filter("premises_no % 4 = 0").select("lead_key", F.concat(F.lit("020"), F.lpad((F.col("premises_no") % 10000000).cast("string"), 8, "0")).alias("phone"))
    return contacts.collect_contacts({
        "listing": p.select("lead_key", "phone"),
        "customer": near.select("lead_key", F.when(F.col("customer_no") % 3 == 0, F.concat(F.lit("+44 "), F.substr("phone", F.lit(2), F.lit(20)))).otherwise(F.col("phone")).alias("phone")),
        "place": place,
        "website": site,
        "whatsapp": made(5, "079", 8),
    })


@query("contacts_collect", "lead_key phone kind priority:n source", "allc", _CONTACTS)
def _(r):
    return _contacts(r)


_SLOT = "select lead_key, " + ", ".join(f"max(case when kind='{k}' and r={i} then phone end) as {k}_{i}" for k, n in (("mobile", 2), ("landline", 3)) for i in range(1, n + 1)) + ", array_to_string(list_sort(list(upper(substr(kind, 1, 1))||r||'='||source)), ' | ') as sources from (select *, row_number() over (partition by lead_key, kind order by priority, phone) as r from allc) where r<=case kind when 'mobile' then 2 else 3 end group by lead_key"


@query("contact_slots", "lead_key mobile_1 mobile_2 landline_1 landline_2 landline_3 sources", _SLOT, _CONTACTS)
def _(r):
    return contacts.contact_slots(_contacts(r))


def _linked_pages(r) -> DataFrame:
    number = F.lpad(F.col("page_id").cast("string"), 8, "0")
    links = F.concat(F.when(F.col("page_id") % 3 == 0, F.concat(F.lit(" wa.me/+0044"), number)).otherwise(""), F.when(F.col("page_id") % 5 == 0, F.concat(F.lit(' <a href="tel:+44 '), number, F.lit('">'))).otherwise(""))
    return r.table("raw_pages").withColumn("html", F.concat("html", links))


@query("page_contacts", "page_id kind value", "select distinct page_id, 'mail' as kind, unnest(regexp_extract_all(html, '([A-Za-z0-9._]+@[A-Za-z0-9.]+\\.com)', 1)) as value from pages union select page_id, 'whatsapp', '0044'||lpad(cast(page_id as varchar), 8, '0') from pages where page_id%3=0 union select page_id, 'tel', '+44 '||lpad(cast(page_id as varchar), 8, '0') from pages where page_id%5=0")
def _(r):
    return contacts.extract_page_contacts(_linked_pages(r))


_SUPP = {"supp": f"select distinct {hmac('phone')} as h from listings where premises_no%50=0"}


def _suppression(r) -> DataFrame:
    p = r.listings.filter("premises_no % 50 = 0").select(T.hmac_sha256(F.col("phone"), PEPPER).alias("match_hmac")).distinct()
    return p.select(F.lit("phone").alias("match_type"), "match_hmac", F.lit("active").alias("status"))


@query("safe_contact", "lead_key phone kind source", f"select * from (select *, row_number() over (partition by lead_key order by case kind when 'mobile' then 0 else 1 end, priority, phone) as r from allc where {hmac('phone')} not in (select h from supp)) where r=1", _CONTACTS | _SUPP)
def _(r):
    return contacts.safe_contact(_contacts(r), _suppression(r), PEPPER)


@query("paid_lookup_plan", "day:n lead_key reviews:n rank:n", "select * from (select premises_no%7 as day, lead_key, reviews, row_number() over (partition by premises_no%7 order by reviews desc, lead_key) as rank from prem where rating_tenths<45 and premises_no%3<>0) where rank<=100")
def _(r):
    leads = r.premises.select((F.col("premises_no") % 7).alias("day"), "lead_key", "reviews", (F.col("rating_tenths") < 45).alias("has_gap"))
    return contacts.plan_paid_lookups(leads, r.premises.filter("premises_no % 3 = 0").select("lead_key"), C.daily_cap, C.unit_cost)


@query("fallback_fill", "lead_key phone address rating:n filled", "select lead_key, case when premises_no%6=0 then '020' else phone end as phone, address, case when premises_no%4=0 then case when premises_no%2=0 then 30 end else rating_tenths end as rating, case when premises_no%6=0 then 'phone' else '' end||case when premises_no%6=0 and premises_no%4=0 then ',' else '' end||case when premises_no%4=0 then 'rating' else '' end as filled from prem")
def _(r):
    k = F.col("premises_no")
    leads = r.premises.select("lead_key", F.when(k % 6 != 0, F.col("phone")).alias("phone"), "address", F.when(k % 4 != 0, F.col("rating_tenths")).alias("rating"))
    found = r.premises.filter("premises_no % 2 = 0").select("lead_key", F.lit("020").alias("phone"), F.lit("x").alias("address"), F.lit(30).cast("bigint").alias("rating"))
    return contacts.apply_fallback(leads, found)


# D. Matching
@query("match_candidates", "lead_key account_code", "pairs")
def _(r):
    return r.pairs


@query("similarity", "lead_key account_code edit:n sorted:n token_set:n", f"select p.lead_key, p.account_code, {ratio('l.primary_brand', 'c.name')} as edit, {ratio(sorted_tokens('l.primary_brand'), sorted_tokens('c.name'))} as sorted, cast(floor(100.0*len(list_intersect(list_distinct(string_split(lower(l.primary_brand), ' ')), list_distinct(string_split(lower(c.name), ' '))))/len(list_distinct(list_concat(string_split(lower(l.primary_brand), ' '), string_split(lower(c.name), ' '))))+0.5) as bigint) as token_set from pairs p join leads l on p.lead_key=l.lead_key join cust c on p.account_code=c.account_code")
def _(r):
    return matching.similarities(r.leads, r.customers)


@query("match_score", "lead_key account_code name_score:n match_pct:n matched_fields", "scored")
def _(r):
    return r.scored


@query("match_best", "lead_key account_code status match_pct:n", "best")
def _(r):
    return r.best


@query("match_class", "lead_key account_code match_pct:n match_class match_colour", "classified")
def _(r):
    return r.classified


@query("registration_match", "lead_key fsa_id operator_name hygiene:n days_since_registration:n how:n registrations:n", "regm")
def _(r):
    return r.registrations


@query("company_match", "lead_key ch_number company_name ch_status sic_code how:n", "compm")
def _(r):
    return r.companies


_PERSON = "trim(regexp_replace(regexp_replace(lower(case when contains(person_name, ',') then split_part(person_name, ',', 2)||' '||split_part(person_name, ',', 1) else person_name end), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
_TRACE = {
    "links": f"select distinct ch_number, regexp_replace({_PERSON}, '^({'|'.join(matching.TITLES)}) ', '')||'|'||coalesce(birth_month, '') as person from officers where kind='director'",
    "reached": "select distinct ch_number, ch_number as other from links union select r.ch_number, b.ch_number from reached r join links a on r.other=a.ch_number join links b on a.person=b.person",
    "chained": "select ch_number, min(other) as chain from reached group by ch_number",
    "traced": "select c.ch_number, k.chain, count(o.ch_number) as others, coalesce(array_to_string(list_sort(list(o.ch_number) filter (o.ch_number is not null))[1:5], ' | '), '') as other_list, count(o.ch_number)>0 as flag from companies c left join chained k on c.ch_number=k.ch_number left join (select x.ch_number, y.chain from companies x join chained y on x.ch_number=y.ch_number where x.sic_code like '56%') o on k.chain=o.chain and o.ch_number<>c.ch_number group by c.ch_number, k.chain",
}


@query("director_chains", "ch_number chain", "chained", _TRACE)
def _(r):
    return r.chains


@query("director_trace", "ch_number chain others:n other_list flag", "traced", _TRACE)
def _(r):
    return matching.trace_directors(r.table("companies"), r.chains)


@query("ownership_change", "ch_number unit reason changed_on:d predecessor", "owner")
def _(r):
    return r.owners


@query("reincorporation", "ch_number predecessor dissolved_on:d changed_on:d", "moved")
def _(r):
    return matching.reincorporations(r.table("companies"), C)


@query("red_flags", "ch_number red_flags", "select ch_number, case when charges and strike_off then 'Charges / Strike-off' when charges then 'Charges' when strike_off then 'Strike-off' else 'None' end as red_flags from companies")
def _(r):
    return matching.red_flags(r.table("companies"))


_PEOPLE = {"people": "select ch_number, min(person_name) filter (kind='director') as director_1, 'Director' as director_1_role, case when count(*) filter (kind='director')>1 then max(person_name) filter (kind='director') end as director_2, case when count(*) filter (kind='director')>1 then 'Director' end as director_2_role, min(person_name) filter (kind='psc') as psc_1 from officers group by ch_number"}


@query("people_slots", "ch_number director_1 director_1_role director_2 director_2_role psc_1", "people", _PEOPLE)
def _(r):
    return matching.people_slots(matching.people_json(r.table("officers")))


# E. Accounts
@query("accounts_cp", "ch_number accounts_type accounts_date:d p_period_end:d " + " ".join(f"c_{x}:n p_{x}:n" for x in FIGURES), "acp")
def _(r):
    return accounts.current_and_prior(r.table("filings"))


@query("net_assets_growth", "ch_number c_net_assets:n p_net_assets:n net_assets_growth:n", "acg")
def _(r):
    return r.accounts


@query("financial_label", "ch_number net_assets_growth:n financial_label", "acl")
def _(r):
    return r.accounts


@query("verify_state", "lead_key verify_state", "enriched")
def _(r):
    return r.enriched


@query("confidence", "lead_key legitimacy_pct:n uniqueness_pct:n", "routed")
def _(r):
    return accounts.confidence(r.enriched)


# F. Triggers
@query("trigger_new_business", "fsa_id days_since_registration:n new_business", f"select *, days_since_registration<{C.new_days} as new_business from registrations")
def _(r):
    return triggers.new_business(r.table("registrations"))


@query("trigger_reviews", "premises_no hits:n source review_date:d terms supply:n stock:n quality:n consistency:n", "hits")
def _(r):
    return triggers.mine_reviews(r.table("reviews"))


@query("trigger_snippet", "premises_no snippet", "snippets")
def _(r):
    return triggers.review_snippet(triggers.mine_reviews(r.table("reviews")))


@query("lead_triggers", "lead_key trigger_type snippet trigger_date:d", "trig")
def _(r):
    return r.triggers


@query("trigger_bonus", "lead_key bonus:n", "bonus")
def _(r):
    return r.bonus


_DAY = "2024-01-31"


@query("same_day_queue", "lead_no trigger_type age_days:n urgency", f"select lead_no, trigger_type, age_days, case when age_days<={C.urgent_days} then 'high' when age_days<={C.medium_days} then 'medium' else 'low' end as urgency from (select *, date_diff('day', cast(ts as date), date '{_DAY}') as age_days, row_number() over (partition by lead_no order by ts desc, trigger_type) as r from signals where lead_no is not null) where r=1")
def _(r):
    return triggers.same_day_queue(r.table("signals"), _DAY)


# Signals land twice: all but each 17th event, then the others, of which those behind the watermark (a day
# before the latest signal that was there) are dropped. Days that the watermark has passed are closed: one
# row a lead and day, its first signal. The stream stops in between and goes on from its checkpoint.
_STREAM = {
    "timed": "select event_id, user_id as lead_no, case event_type when 'signup' then 'new_fsa' when 'purchase' then 'ownership_change' else 'review_complaint' end as trigger_type, ts from events where event_type in ('signup', 'purchase', 'error') and user_id is not null and ts is not null",
    "mark": "select max(ts) filter (event_id%17<>0) - interval 1 day as first_mark, max(ts) - interval 1 day as last_mark from timed",
    "accepted": "select * from timed cross join mark where event_id%17<>0 or ts>=first_mark",
}


@query("same_day_stream", "day:d lead_no trigger_type first_ts:s n:n", "select cast(ts as date) as day, lead_no, first(trigger_type order by ts, trigger_type) as trigger_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_ts, count(*) as n from accepted where cast(ts as date)+interval 1 day<=last_mark group by cast(ts as date), lead_no", _STREAM)
def _(r):
    folder = f"{r.work}/same-day-{uuid.uuid4().hex}"
    events = r.spark.read.parquet(f"{r.folder}/events.parquet")
    for late in (False, True):  # what has landed is drained, then the rest lands
        events.filter((F.col("event_id") % 17 == 0) == late).write.mode("append").parquet(f"{folder}/landed")
        landed = r.spark.readStream.schema(events.schema).parquet(f"{folder}/landed")
        out = same_day.drain(r.spark, projected(r.spark, "signals", landed), folder)
    files.remove_folder(r.spark, f"{folder}/landed")
    return out.withColumn("first_ts", F.date_format("first_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


# G. Scoring
@query("size_proxy", "lead_key size_reviews:n size_class", "sized")
def _(r):
    return r.enriched


@query("base_score", "lead_key base:n breakdown", "base")
def _(r):
    return r.base


@query("final_tier", "lead_key base:n bonus:n score:n tier", "final")
def _(r):
    return r.final


_ORDERS = {"co": "select o_custkey as customer_no, cast(floor(o_totalprice*100+0.5) as bigint) as pence, cast(o_orderdate as date) as day from orders"}


def _orders(r) -> DataFrame:
    o = r.spark.read.parquet(f"{r.folder}/orders.parquet")
    return o.select(F.col("o_custkey").alias("customer_no"), F.floor(F.col("o_totalprice") * 100 + 0.5).cast("bigint").alias("pence"), F.to_date("o_orderdate").alias("day"))


@query("icp_customers", "account_code orders:n weekly_spend:n weekly_orders_x100:n fits", f"select *, weekly_spend>={C.icp_weekly} and weekly_orders_x100>={100 * C.icp_orders_a_week} and phone is not null as fits from (select account_code, phone, orders, cast(floor(pence/100.0/weeks+0.5) as bigint) as weekly_spend, cast(floor(100.0*orders/weeks+0.5) as bigint) as weekly_orders_x100 from (select c.account_code, c.phone, count(*) as orders, cast(sum(pence) as bigint) as pence, greatest(1.0::double, date_diff('day', min(day), max(day))/7.0::double) as weeks from customers c join co on c.customer_no=co.customer_no group by c.account_code, c.phone))", _ORDERS)
def _(r):
    return scoring.icp_customers(r.table("customers"), _orders(r))


@query("recalibration", "factor value leads:n converted:n conversion_pct:n lift_pct:n", "select factor, value, count(*) as leads, count(*) filter (converted) as converted, cast(floor(100.0::double*count(*) filter (converted)/count(*)+0.5) as bigint) as conversion_pct, cast(floor(10000.0::double*count(*) filter (converted)/count(*)/(select 100.0::double*count(*) filter (premises_no%5<2)/count(*) from sized)+0.5) as bigint) as lift_pct from (select f.*, s.premises_no%5<2 as converted from facts f join sized s on f.lead_key=s.lead_key) group by factor, value")
def _(r):
    outcomes = r.leads.select("lead_key", (F.col("premises_no") % 5 < 2).alias("converted"))
    return scoring.recalibrate(scoring.factors(r.enriched), outcomes)


_SPANS = _ORDERS | {"spans": f"select account_code, rep_no, date_diff('day', min(day), max(day)) as days, date_diff('day', max(day), {AS_OF})>180 as churned from customers c join co on c.customer_no=co.customer_no group by account_code, rep_no"}


def _spans(r) -> DataFrame:
    return scoring.lifespans(r.table("customers"), _orders(r), C.as_of)


@query("retention", "customers:n median_days:n churn_pct:n", "select count(*) as customers, quantile_disc(days, 0.5) as median_days, cast(floor(100.0::double*count(*) filter (churned)/count(*)+0.5) as bigint) as churn_pct from spans", _SPANS)
def _(r):
    return scoring.retention(_spans(r))


@query("churn_by_rep", "rep_no:n customers:n churned:n churn_pct:n", "select rep_no, count(*) as customers, count(*) filter (churned) as churned, cast(floor(100.0::double*count(*) filter (churned)/count(*)+0.5) as bigint) as churn_pct from spans group by rep_no", _SPANS)
def _(r):
    return scoring.churn_by_rep(_spans(r))


# H. Routing
@query("route", "lead_key route reason", "routed")
def _(r):
    return r.routed


_DETAIL = "case reason when 'ACTIVE_MATCH' then match_pct||'% match to active customer' when 'DISSOLVED' then 'Company at the address is dissolved' when 'OUT_OF_AREA' then district||' is outside the delivery area' when 'NOT_FOOD' then 'Registration or trade code is not food' when 'LOW_SCORE' then 'Score '||score||' is below the lowest tier' end"


@query("ignored_log", "lead_key reason_code reason_detail account_code match_pct:n ch_status", f"select lead_key, reason as reason_code, {_DETAIL} as reason_detail, case when reason='ACTIVE_MATCH' then account_code end as account_code, match_pct, ch_status from routed where route='ignored'")
def _(r):
    return routing.ignored_log(r.routed)


@query("reactivation", "lead_key account_code match_pct:n last_order:d", "select r.lead_key, r.account_code, r.match_pct, l.last_order from routed r left join (select account_code, max(day) as last_order from customers c join co on c.customer_no=co.customer_no group by account_code) l on r.account_code=l.account_code where route='reactivation'", _ORDERS)
def _(r):
    return routing.reactivation(r.routed, _last_orders(r))


def _last_orders(r) -> DataFrame:
    return _orders(r).groupBy("customer_no").agg(F.max("day").alias("last_order")).join(r.table("customers"), "customer_no").select("account_code", "last_order")


@query("expansion", "lead_key district membership verify_state held_reason", "select *, 'Held: '||district||' is '||membership as held_reason from routed where route='expansion'")
def _(r):
    return routing.expansion(r.routed)


_REPS = {"repmap": "select district, 'REP-'||substr(district, 1, 2) as rep from (select distinct district, area from lp) where area in ('TW', 'UB')", "reps": "select p.*, coalesce(m.rep, 'REP-'||(premises_no%3+1)) as rep from leads p left join repmap m on p.district=m.district"}


def _with_reps(r) -> DataFrame:
    m = r.keyed.filter("area in ('TW', 'UB')").select("district").distinct().withColumn("rep", F.concat(F.lit("REP-"), F.substring("district", 1, 2)))
    return routing.assign_reps(r.leads, m, ["REP-1", "REP-2", "REP-3"])


@query("assign_reps", "lead_key district rep", "reps", _REPS)
def _(r):
    return _with_reps(r)


@query("food_flag", "lead_key is_food", "enriched")
def _(r):
    return r.enriched


@query("lead_trail", "lead_key step:n stage value reason", "select lead_key, 1 as step, 'match' as stage, match_class as value, matched_fields as reason from routed union all select lead_key, 2, 'verify', verify_state, ch_status from routed union all select lead_key, 3, 'score', cast(score as varchar), breakdown from routed union all select lead_key, 4, 'route', route, reason from routed")
def _(r):
    t = r.routed
    pick = lambda v, why: t.select("lead_key", F.col(v).alias("value"), F.col(why).alias("reason"))
    return routing.lead_trail([(1, "match", pick("match_class", "matched_fields")), (2, "verify", pick("verify_state", "ch_status")), (3, "score", pick("score", "breakdown")), (4, "route", pick("route", "reason"))])


# I. Export
def _outgoing(r) -> DataFrame:
    """Numbers of the leads that may leave: neither suppressed nor erased."""
    phone = F.col("phone")
    return compliance.mark_denied(_contacts(r), r.table("suppression"), r.table("tombstones"), {"phone": phone}, phone, "import", PEPPER).filter(F.size("denied") == 0).drop("denied")


def _flat(r, rows: DataFrame | None = None) -> DataFrame:
    """The flat layout of all leads, or of the rows given."""
    slots = contacts.contact_slots(_outgoing(r))
    wide = premises.pivot_platforms(premises.platform_profiles(r.scoped)).withColumn("premises_key", F.concat_ws("|", "address_key", "unit")).drop("address_key", "unit")
    traced = matching.trace_directors(r.table("companies"), r.chains).select("ch_number", "other_list", F.col("flag").alias("other_flag"))
    owner = r.owners.select("ch_number", "changed_on", F.lit(True).alias("ownership_flag"))
    hits = triggers.review_snippet(triggers.mine_reviews(r.table("reviews"))).select("premises_no", "snippet", F.col("source").alias("review_source"), "review_date", F.lit(True).alias("review_flag"))
    ids = premises.assign_lead_id(r.leads, C.prefix).select("lead_key", "lead_id")
    flags, people = matching.red_flags(r.table("companies")), matching.people_slots(matching.people_json(r.table("officers")))
    day = lambda age: F.date_sub(F.lit(C.as_of).cast("date"), F.col(age).cast("int"))
    place = r.table("place_lookups").select("premises_no", "place_id", F.col("rating_tenths").alias("google_rating"), F.col("reviews").alias("google_reviews"), F.col("phone").alias("google_phone"), F.col("address").alias("google_address"), day("looked_up_age").alias("google_looked_up"))
    of_kind = lambda k: F.min(F.when(F.col("kind") == k, F.col("value")))
    page = contacts.extract_page_contacts(_linked_pages(r)).groupBy(F.col("page_id").alias("premises_no")).agg(of_kind("whatsapp").alias("whatsapp"), of_kind("tel").alias("website_phone"), of_kind("profile").alias("facebook_url"))
    out = r.routed if rows is None else rows
    for table, key in ((ids, "lead_key"), (slots, "lead_key"), (wide, "premises_key"), (_with_reps(r).select("lead_key", "rep"), "lead_key"), (r.accounts, "ch_number"), (traced, "ch_number"), (owner, "ch_number"), (flags, "ch_number"), (people, "ch_number"), (hits, "premises_no"), (place, "premises_no"), (page, "premises_no")):
        out = out.join(table, key, "left")
    shown = F.col("match_pct") < C.active_threshold
    out = compliance.hide_denied(out, ["google_phone", "website_phone", "whatsapp"], r.table("suppression"), r.table("tombstones"), "import", PEPPER)
    return export.flatten_layout(out.withColumns({
        "new_business": F.col("days_since_registration") < C.new_days, "shown_match_pct": F.when(shown, F.col("match_pct")), "shown_fields": F.when(shown, F.col("matched_fields")),
        "run_date": F.lit(C.as_of), "search_code": F.col("district"), "lead_status": F.lit("new"), "last_inspection": day("last_inspection_age"), "incorporated_on": day("company_age"),
    }))


def _flat_sql() -> str:
    """A text column per layout column; the expression of each in terms of the joined tables."""
    yes = lambda c: f"case when coalesce({c}, false) then 'Yes' else 'No' end"
    tenths = lambda c: f"{c}//10||'.'||{c}%10"
    day = lambda c: f"{AS_OF}-cast({c} as int)"
    shown = lambda c: f"case when r.match_pct<{C.active_threshold} then {c} end"
    own = {
        "Lead_ID": "i.lead_id", "Last_Inspection_Date": day("r.last_inspection_age"), "Incorporation_Date": day("r.company_age"), "Red_Flags": "f.red_flags", "Directors_Other_Food_Companies": yes("t.flag"), "Directors_Other_Companies_List": "t.other_list",
        "Multi_Brand_Flag": yes("r.multi_brand"), "New_Business_Flag": yes(f"r.days_since_registration<{C.new_days}"), "Recent_Ownership_Change_Flag": yes("o.reason is not null"), "Ownership_Change_Date": "o.changed_on", "Review_Trigger_Flag": yes("h.snippet is not null"),
        "Review_Trigger_Snippet": "h.snippet", "Review_Trigger_Source": "h.source", "Review_Trigger_Date": "h.review_date", "Match_Pct": shown("r.match_pct"), "Matched_Fields": shown("r.matched_fields"), "Run_Date": f"'{C.as_of}'", "Search_Code": "r.district", "Lead_Status": "'new'",
        "Google_Place_ID": "g.place_id", "Google_Rating": tenths("g.rating_tenths"), "Google_Reviews": "g.reviews", "Google_Phone": "case when g.phone not in (select match_value from denied_phones) then g.phone end", "Google_Address": "g.address", "Google_Lookup_Date": day("g.looked_up_age"),
        "WhatsApp_Link_Number": "case when v.page_id%3=0 then '0044'||lpad(cast(v.page_id as varchar), 8, '0') end", "Website_Phone": "case when v.page_id%5=0 then '+44 '||lpad(cast(v.page_id as varchar), 8, '0') end", "Facebook_URL": "null", "Assigned_Rep": "p.rep",
    }
    of = {"mobile_": "s", "landline_": "s", "sources": "s", "justeat_": "w", "ubereats_": "w", "deliveroo_": "w", "c_": "a", "p_net": "a", "net_assets": "a", "accounts_": "a", "financial_": "a", "director_": "d", "psc_": "d"}
    made = []
    for name, kind, src in export.LAYOUT:
        at = next((f"{t}.{src}" for prefix, t in of.items() if src and src.startswith(prefix)), f"r.{src}" if src else "null")
        made.append(f'cast({own.get(name) or (tenths(at) if kind == "d" else at)} as varchar) as "{name}"')
    joins = "left join slots s on r.lead_key=s.lead_key left join wide w on r.premises_key=w.address_key||'|'||w.unit left join acl a on r.ch_number=a.ch_number left join traced t on r.ch_number=t.ch_number left join owner o on r.ch_number=o.ch_number left join snippets h on r.premises_no=h.premises_no"
    joins += " left join flags f on r.ch_number=f.ch_number left join people d on r.ch_number=d.ch_number left join place_lookups g on r.premises_no=g.premises_no left join raw_pages v on r.premises_no=v.page_id join reps p on r.lead_key=p.lead_key"
    return f"select {', '.join(made)}, r.route from routed r join ids i on r.lead_key=i.lead_key {joins}"


_FLAGS = "select ch_number, case when charges and strike_off then 'Charges / Strike-off' when charges then 'Charges' when strike_off then 'Strike-off' else 'None' end as red_flags from companies"
_FLAT = _CONTACTS | _PROFILES | _PEOPLE | _REPS | _TRACE | {
    "outc": "select * from allc where phone not in (select match_value from denied_phones)",
    "profiles": _PROFILES["profiles"].replace("from lp", "from scoped"),
    "slots": _SLOT.replace("from allc", "from outc"),
    "wide": _WIDE,
    "ids": "select lead_key, 'LD-'||area||'-'||lpad(cast(row_number() over (partition by area order by sector, unit, address_key, lead_key, coalesce(tenant, 0)) as varchar), 5, '0') as lead_id from leads",
    "flags": _FLAGS,
    "flat": _flat_sql(),
}


@query("flat_layout", " ".join(name for name, _, _ in export.LAYOUT), "flat", _FLAT)
def _(r):
    return _flat(r)


@query("field_mapping", "Lead_ID mapped_values", """select "Lead_ID", '{"name":"'||upper("Primary_Brand_Name")||'","phone":"'||coalesce("Phone_Mobile_1", '')||'","score":"'||"Lead_Score"||'"}' as mapped_values from flat""", _FLAT)
def _(r):
    return export.mapped_snapshot(_flat(r).select("Lead_ID", *[m[0] for m in MAPPINGS]), r.table("mappings"))


_ITEMS2 = {"items": "select lead_key, run_no%4 as batch_id from routed where route='export'", "batches": "select distinct run_no%4 as batch_id, case run_no%4 when 0 then 'draft' else 'approved' end as status from runs"}


# Batches 0 and 1 use verified mappings only, batch 2 one that is not verified, batch 3 none.
@query("export_gate", "batch_id:n status items:n verified may_export", "select b.batch_id, b.status, coalesce(i.n, 0) as items, b.batch_id<2 as verified, b.status='approved' and coalesce(i.n, 0)>0 and b.batch_id<2 as may_export from batches b left join (select batch_id, count(*) as n from items group by batch_id) i on b.batch_id=i.batch_id", _ITEMS2)
def _(r):
    return r.gate


@query("export_batch", "batch_id:n lead_count:n", "select batch_id, count(*) as lead_count from items group by batch_id", _ITEMS2)
def _(r):
    return export.build_batch(r.routed.filter("route = 'export'"), F.col("run_no") % 4)[1]


_SAFE = {"safe": f"select * from (select *, row_number() over (partition by lead_key order by case kind when 'mobile' then 0 else 1 end, priority, phone) as r from allc where {hmac('phone')} not in (select h from supp)) where r=1"}


def _telesales(r) -> DataFrame:
    leads = r.routed.join(_with_reps(r).select("lead_key", "rep"), "lead_key")
    return export.telesales_rows(r.items, leads, contacts.safe_contact(_contacts(r), _suppression(r), PEPPER), r.table("batches").filter("status = 'approved'"), r.triggers, C.as_of)


_TELE = _ITEMS2 | _CONTACTS | _SUPP | _SAFE | _REPS | {
    "why": "select lead_key, array_to_string(list_sort(list(distinct trigger_type)), ', ') as trigger_reason from trig group by lead_key",
    "tele": f"select i.batch_id, r.lead_key, r.primary_brand as business_name, r.address as trading_address, r.unit as postcode, s.phone as safe_phone, r.tier, p.rep, 'new' as lead_status, y.trigger_reason, 'open' as worked_status, cast(null as varchar) as outcome_notes, {AS_OF} as assigned_at from items i join routed r on i.lead_key=r.lead_key join reps p on r.lead_key=p.lead_key left join safe s on r.lead_key=s.lead_key left join why y on r.lead_key=y.lead_key where i.batch_id>0",
}
_TELE_COLUMNS = "batch_id:n lead_key business_name trading_address postcode safe_phone tier rep lead_status trigger_reason worked_status outcome_notes:s assigned_at:d"


@query("telesales_rows", _TELE_COLUMNS, "tele", _TELE)
def _(r):
    return _telesales(r)


# The leads of the export, and all leads of the run as a set that must not go out.
@query("contamination", "item_set items:n contaminated:n", "select 'export' as item_set, count(*) as items, count(*) filter (match_class='active_match') as contaminated from routed where route='export' union all select 'all_leads', count(*), count(*) filter (match_class='active_match') from routed", _ITEMS2)
def _(r):
    export_set = r.items.select("lead_key", F.lit("export").alias("item_set"))
    return export.contamination(export_set.unionByName(r.routed.select("lead_key", F.lit("all_leads").alias("item_set"))), r.classified)


@query("apply_outcomes", "lead_key rep worked_status lead_status outcome_notes rejected", "select lead_key, rep, case when premises_no%3=1 then 'contacted' else 'open' end as worked_status, case when premises_no%3=1 and premises_no%2=0 then 'contacted' else 'new' end as lead_status, case when premises_no%3=1 then 'called' end as outcome_notes, premises_no%3=2 as rejected from reps", _REPS)
def _(r):
    a = _with_reps(r).join(r.leads.select("lead_key", "premises_no"), "lead_key").withColumns({"worked_status": F.lit("open"), "lead_status": F.lit("new"), "outcome_notes": F.lit(None).cast("string")})
    k = F.col("premises_no") % 3
    updates = a.filter(k != 0).select(
        "lead_key", F.when(k == 1, F.col("rep")).otherwise("NOBODY").alias("rep"), F.lit("contacted").alias("worked_status"),
        F.when(F.col("premises_no") % 2 == 0, "contacted").alias("lead_status"), F.lit("called").alias("outcome_notes"),
    )
    return export.apply_outcomes(a, updates)


# J. Compliance and quality
@query("hmac", "lead_key h", f"select lead_key, {hmac('phone')} as h from prem")
def _(r):
    return r.premises.select("lead_key", T.hmac_sha256(F.col("phone"), PEPPER).alias("h"))


@query("suppress", "lead_key", f"select lead_key from prem where {hmac('phone')} not in (select h from supp) and area||'x'<>'x' and unit not in (select unit from lp where premises_no%90=0)", _SUPP)
def _(r):
    codes = r.keyed.filter("premises_no % 90 = 0").select(F.lit("postcode").alias("match_type"), T.hmac_sha256(F.col("unit"), PEPPER).alias("match_hmac"), F.lit("active").alias("status")).distinct()
    old = codes.limit(0).unionByName(r.listings.filter("premises_no % 91 = 0").select(F.lit("brand").alias("match_type"), T.hmac_sha256(F.lower("brand_name"), PEPPER).alias("match_hmac"), F.lit("withdrawn").alias("status")))
    return compliance.suppress(r.premises, _suppression(r).unionByName(codes).unionByName(old), PEPPER)


_HEAD = "select 'head' as stage, 'suppressed' as reason, 'phone' as match_type, {p} as match_hmac, count(*) as n from lp where phone in (select match_value from denied where match_type='phone' and status='active') group by phone union all select 'head', 'suppressed', 'postcode', {u}, count(*) from lp where unit in (select match_value from denied where match_type='postcode') group by unit union all select 'head', 'erased', 'import', {p}, count(*) from lp where phone in (select subject from erased where scope='import') group by phone"


@query("deny_stage", "stage reason match_type match_hmac n:n", _HEAD.format(p=hmac("phone"), u=hmac("unit")))
def _(r):
    return r.removed


@query("erasure_block", "account_code", "select account_code from customers where customer_no%19<>0")
def _(r):
    c = r.table("customers")
    stone = lambda df, scope: df.select(T.hmac_sha256(F.col("account_code"), PEPPER).alias("subject_hmac"), F.lit(scope).alias("scope"))
    stones = stone(c.filter("customer_no % 19 = 0"), "import").unionByName(stone(c.filter("customer_no % 23 = 0"), "marketing"))
    return compliance.block_erased(c, stones, "account_code", "import", PEPPER)


@query("retention_purge", "listing_id", f"select listing_id from listings where not listed_on<date '1998-01-01'")
def _(r):
    return compliance.retain(r.listings.withColumn("retention_until", F.col("listed_on")), "1998-01-01", "purge", [])


@query("retention_anonymise", "listing_id phone address", "select listing_id, case when not listed_on<date '1998-01-01' then phone end as phone, case when not listed_on<date '1998-01-01' then address end as address from listings")
def _(r):
    return compliance.retain(r.listings.withColumn("retention_until", F.col("listed_on")), "1998-01-01", "anonymise", ["phone", "address"])


def _snapshots(r) -> tuple[DataFrame, DataFrame]:
    c = r.table("customers").select("account_code", "customer_no", "status", "phone")
    k = F.col("customer_no")
    after = c.filter("customer_no % 14 <> 0").withColumn("status", F.when(k % 10 == 0, "closed").otherwise(F.col("status"))).withColumn("phone", F.when(k % 22 == 0, None).otherwise(F.col("phone")))
    return c.filter("customer_no % 26 <> 0"), after


_AUDIT = {
    "bef": "select account_code, customer_no, status, phone from customers where customer_no%26<>0",
    "aft": "select account_code, customer_no, case when customer_no%10=0 then 'closed' else status end as status, case when customer_no%22=0 then null else phone end as phone from customers where customer_no%14<>0",
    "audit": """select coalesce(a.account_code, b.account_code) as entity_id, case when b.account_code is null then 'insert' when a.account_code is null then 'delete' else 'update' end as action, case when b.account_code is not null then '{"status":"'||b.status||'"}' end as before, case when a.account_code is not null then '{"status":"'||a.status||'"}' end as after from bef b full outer join aft a on a.account_code=b.account_code where a.account_code is null or b.account_code is null or a.status is distinct from b.status or a.phone is distinct from b.phone""",
}


@query("audit_safe", "entity_id action before after", "audit", _AUDIT)
def _(r):
    return compliance.audit_safe(*_snapshots(r), "account_code", ["status"])


@query("audit_min", "entity_id action", "audit", _AUDIT)
def _(r):
    return compliance.audit_min(*_snapshots(r), "account_code")


@query("append_only", "entity_id action", "select * from audit where action<>'insert'", _AUDIT)
def _(r):
    return compliance.check_append_only(*_snapshots(r), "account_code")


@query("unique_check", "address postcode n:n", "select address, postcode, count(*) as n from registrations group by address, postcode having count(*)>1")
def _(r):
    return quality.check_unique(r.table("registrations"), ["address", "postcode"])


@query("append_new", "account_code", "select account_code from customers where customer_no%4=0 or customer_no%6=0")
def _(r):
    c = r.table("customers")
    new = c.filter("customer_no % 6 = 0")
    return quality.append_new(c.filter("customer_no % 4 = 0"), new.unionByName(new), ["account_code"])


@query("role_view_mgmt", "run_no:n status", "select run_no, status from runs")
def _(r):
    return compliance.role_view(r.table("runs"), "pipeline_runs", "management")


@query("role_view_telesales", _TELE_COLUMNS, "select * from tele where rep='REP-UB'", _TELE)
def _(r):
    return compliance.role_view(_telesales(r), "telesales_assignments", "telesales", "REP-UB")


_PROFILE_SQL = "select s_suppkey as user_id, case s_suppkey%3 when 0 then 'owner' when 1 then 'management' else 'telesales' end as role, 'REP-'||s_suppkey as rep_code from supplier"


# What the owner, the manager 4 and the developer 5 see of the user profiles.
@query("role_view_profiles", "viewer user_id:n role rep_code", "select 'owner' as viewer, * from profiles_of union all select 'management', * from profiles_of where user_id=4 union all select 'developer', * from profiles_of where user_id=5", {"profiles_of": _PROFILE_SQL})
def _(r):
    k = F.col("s_suppkey")
    users = r.spark.read.parquet(f"{r.folder}/supplier.parquet").select(k.alias("user_id"), F.when(k % 3 == 0, "owner").when(k % 3 == 1, "management").otherwise("telesales").alias("role"), F.concat(F.lit("REP-"), k.cast("string")).alias("rep_code"))
    views = [compliance.role_view(users, "user_profiles", viewer, user=user).withColumn("viewer", F.lit(viewer)) for viewer, user in (("owner", "3"), ("management", "4"), ("developer", "5"))]
    return reduce(DataFrame.unionByName, views)


_RULES = "case when run_no%9=0 then 'run_type' end, case when not cost<=8 then 'cost' end"


@query("validate_split", "part run_no:n failed:s", f"select case when failed='' then 'good' else 'quarantine' end as part, run_no, nullif(failed, '') as failed from (select run_no, array_to_string(list_filter([{_RULES}], lambda x: x is not null), ',') as failed from runs) v")
def _(r):
    df = r.table("runs").withColumn("run_type", F.when(F.col("run_no") % 9 == 0, "daily").otherwise(F.col("run_type")))
    good, bad = quality.split_valid(df, {"run_type": quality.in_enum("run_type", ENUMS["run_type"]), "cost": F.col("cost") <= 8})
    none = F.lit(None).cast("string")
    return good.select(F.lit("good").alias("part"), "run_no", none.alias("failed")).unionByName(bad.select(F.lit("quarantine").alias("part"), "run_no", "failed"))


@query("validate", "run_no:n failed", "select run_no, array_to_string(list_filter([case when run_no%9=0 then 'run_type' end, case when status not in ('queued','running','complete','failed','blocked','archived') then 'status' end, case when not cost<=8 then 'cost' end], lambda x: x is not null), ',') as failed from runs")
def _(r):
    df = r.table("runs").withColumn("run_type", F.when(F.col("run_no") % 9 == 0, "daily").otherwise(F.col("run_type")))
    return quality.validate(df, {"run_type": quality.in_enum("run_type", ENUMS["run_type"]), "status": quality.in_enum("status", ENUMS["run_status"]), "cost": F.col("cost") <= 8})


@query("orphans", "filing_id ch_number", "select filing_id, ch_number from filings where ch_number not in (select ch_number from companies where ch_status='Active')")
def _(r):
    return quality.check_refs(r.table("filings"), r.table("companies").filter("ch_status = 'Active'"), "ch_number", "ch_number")


# K. Reporting
_STEPS = {"keyed": "lp", "marked": "lp", "territory": "territory", "leads": "leads", "classified": "classified", "registrations": "regm", "companies": "compm", "boundary": "boundary", "enriched": "sized", "routed": "routed"}


def _telemetry(r) -> DataFrame:
    """The log of the run up to the routed leads."""
    _ = r.routed
    return r.telemetry({"companies": C.unit_cost}).filter(F.col("stage").isin(list(_STEPS)))


# Seconds differ from run to run and are left out.
@query("telemetry", "stage n:n pence:n failed", " union all ".join(f"select '{k}' as stage, count(*) as n, {round(100 * C.unit_cost) if k == 'companies' else 0} as pence, false as failed from {v}" for k, v in _STEPS.items()))
def _(r):
    return _telemetry(r).select("stage", "n", T.percent(F.col("cost") * 100).alias("pence"), F.col("failure").isNotNull().alias("failed"))


@query("stage_map", "stages pence:n failed:n", "select '{'||string_agg('\"'||stage||'\":'||n, ',' order by stage)||'}' as stages, " + f"{round(100 * C.unit_cost)} as pence, 0 as failed from (" + " union all ".join(f"select '{k}' as stage, count(*) as n from {v}" for k, v in _STEPS.items()) + ") s")
def _(r):
    return reporting.stage_maps(_telemetry(r)).select(F.to_json("stages").alias("stages"), T.percent(F.col("cost") * 100).alias("pence"), "failed")


@query("run_coverage", "run_no:n code granularity found:n ignored:n exported:n reactivation:n", "units")
def _(r):
    return r.units


@query("coverage_summary", "code granularity runs:n first_run:d last_run:d found:n ignored:n exported:n reactivation:n membership boundary_version:n", "summary")
def _(r):
    return r.summary


# Units of even runs first, then those of odd runs merged into the stored summary: the same as one rebuild.
@query("coverage_merge", "code granularity runs:n first_run:d last_run:d found:n ignored:n exported:n reactivation:n membership boundary_version:n", "summary")
def _(r):
    even = F.col("run_no") % 2 == 0
    first = reporting.rebuild_summary(r.units.filter(even), r.table("runs"), r.boundary)
    return reporting.merge_summary(first, r.units.filter(even), r.units.filter(~even), r.table("runs"), r.boundary)


@query("coverage_stale", "code granularity", "select code, granularity from summary where code like 'TW%'")
def _(r):
    s = r.summary.withColumn("boundary_version", F.when(F.col("code").startswith("TW"), 1).otherwise(2))
    return reporting.stale_coverage(s, 2)


@query("coverage_level", "code granularity level:n is_gap is_expansion", "select code, granularity, case when runs<=0 then 0 when runs=1 then 1 when runs<=3 then 2 when runs=4 then 3 else 4 end as level, runs=0 as is_gap, membership='expansion' as is_expansion from summary")
def _(r):
    return r.summary.select("code", "granularity", reporting.coverage_level(F.col("runs")).alias("level"), (F.col("runs") == 0).alias("is_gap"), (F.col("membership") == "expansion").alias("is_expansion"))


@query("coverage_progress", "total:n targeted:n gaps:n expansion_held:n pct:n", "select *, cast(floor(100.0::double*targeted/total+0.5) as bigint) as pct from (select count(*) filter (b.membership='in_area') as total, count(*) filter (b.membership='in_area' and coalesce(s.runs,0)>0) as targeted, count(*) filter (b.membership='in_area' and not coalesce(s.runs,0)>0) as gaps, count(*) filter (b.membership='expansion') as expansion_held from boundary b left join (select * from summary where granularity='district') s on b.code=s.code)")
def _(r):
    return reporting.coverage_progress(r.summary, r.boundary)


@query("ignored_summary", "reason n:n", "select reason, count(*) as n from routed where route='ignored' group by reason")
def _(r):
    return r.routed.filter("route = 'ignored'").groupBy("reason").agg(F.count("*").alias("n"))


@query("overview", "leads:n ready:n export_ready:n telesales_open:n tier_a:n ignored:n held:n gaps:n", "select count(*) as leads, count(*) filter (route='export') as ready, count(*) filter (route='export' and run_no%4=1) as export_ready, (select count(*) from tele where worked_status='open') as telesales_open, count(*) filter (route='export' and tier='A') as tier_a, count(*) filter (route='ignored') as ignored, count(*) filter (route='expansion') as held, (select count(*) from summary where granularity='district' and membership='in_area' and runs=0) as gaps from routed", _TELE)
def _(r):
    return reporting.overview(r.routed, r.cleared, _telesales(r), r.summary)


@query("budget", "run_no:n last_day:d pence:n day_pence:n over_cap over_target", f"select run_no, last_day, pence, cast(sum(pence) over (partition by last_day order by run_no) as bigint) as day_pence, sum(pence) over (partition by last_day order by run_no)>{100 * C.daily_cap} as over_cap, pence>{100 * C.district_target} as over_target from (select *, cast(floor(cost*100+0.5) as bigint) as pence from runs)")
def _(r):
    return reporting.budget(r.table("runs"))


@query("pending", "lead_key", "select lead_key from prem where premises_no%3<>0 and premises_no%5<>0")
def _(r):
    p = r.premises
    return reporting.pending(p.select("lead_key"), p.filter("premises_no % 3 = 0").select("lead_key"), p.filter("premises_no % 5 = 0").select("lead_key"))


@query("search", "lead_key primary_brand tier", "select lead_key, primary_brand, tier from routed where (contains(lower(primary_brand), 'kebab') or contains(lower(unit), 'kebab')) and tier='B'")
def _(r):
    return reporting.search(r.routed, "KeBab", ["primary_brand", "unit"], ("tier", "B"))


@query("search_counts", "shown:n total:n", "select count(*) filter ((contains(lower(primary_brand), 'kebab') or contains(lower(unit), 'kebab')) and tier='B') as shown, count(*) as total from routed")
def _(r):
    return reporting.search_counts(r.routed, "KeBab", ["primary_brand", "unit"], ("tier", "B"))


@query("status_class", "run_no:n status status_class", "select run_no, status, case when contains(status, 'complete') then 'complete' else 'draft' end as status_class from runs")
def _(r):
    return reporting.with_status_class(r.table("runs"))


@query("run_history", "run_no:n territory run_type last_day:d pence:n discovered:n deduplicated:n status status_class", "select r.run_no, t.r_name as territory, run_type, last_day, cast(floor(cost*100+0.5) as bigint) as pence, d.n as discovered, p.n as deduplicated, status, case when status='complete' then 'complete' else 'draft' end as status_class from runs r left join region t on r.territory_no=t.r_regionkey left join (select run_no, count(*) as n from listings group by 1) d on r.run_no=d.run_no left join (select run_no, count(*) as n from prem group by 1) p on r.run_no=p.run_no")
def _(r):
    n = lambda df, s: df.groupBy("run_no").agg(F.count("*").alias("n")).withColumn("stage", F.lit(s))
    sets = r.spark.read.parquet(f"{r.folder}/region.parquet").select(F.col("r_regionkey").alias("territory_no"), F.col("r_name").alias("territory"))
    out = reporting.run_history(r.table("runs"), n(r.listings, "discovered").unionByName(n(r.premises, "deduplicated")), sets)
    return out.withColumn("pence", T.percent(F.col("cost") * 100))


@query("territory_overview", "territory_set items:n mix postcodes:n last_used:d", "select area as territory_set, count(distinct district) as items, 'outer_code' as mix, count(distinct unit) as postcodes, max(listed_on) as last_used from lp group by area")
def _(r):
    lp = r.keyed
    items = lp.select(F.col("area").alias("territory_set"), F.lit("outer_code").alias("item_type"), "district").distinct()
    resolved = lp.groupBy(F.col("area").alias("territory_set"), "district").agg(F.countDistinct("unit").alias("postcodes"))
    return reporting.territory_overview(items, resolved, lp.select(F.col("area").alias("territory_set"), F.col("listed_on").alias("used_on")))
