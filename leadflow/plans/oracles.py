"""The same stages as common table expressions in SQL, written on their own."""

from __future__ import annotations

import re

from leadflow.config import DEFAULT as C
from leadflow.sources.adapters import FIGURES, SQL

UNIT = "^([A-Z]{1,2})([0-9][0-9A-Z]?) ([0-9])([A-Z]{2}|[A-Z])$"
PEPPER = "pepper"


def parts(p: str = "postcode") -> str:
    x = f"trim(regexp_replace(upper({p}), '\\s+', ' ', 'g'))"
    ok = f"case when regexp_matches({x}, '{UNIT}') then"
    g = lambda i: f"regexp_extract({x}, '{UNIT}', {i})"
    return f"{ok} {g(1)} end as area, {ok} {g(1)}||{g(2)} end as district, {ok} {g(1)}||{g(2)}||' '||{g(3)} end as sector, {ok} {g(1)}||{g(2)}||' '||{g(3)}||{g(4)} end as unit"


def akey(a: str = "address") -> str:
    s = f"trim(regexp_replace(regexp_replace(lower({a}), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
    for short, full in (("rd", "road"), ("st", "street"), ("ave", "avenue"), ("ln", "lane")):
        s = f"regexp_replace({s}, '\\b{short}\\b', '{full}', 'g')"
    return s


def ratio(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return f"case when {m}=0 then 100 else cast(floor(100.0*({m}-levenshtein({a}, {b}))/{m}+0.5) as bigint) end"


def sorted_tokens(x: str) -> str:
    return f"array_to_string(list_sort(string_split(lower({x}), ' ')), ' ')"


def hmac(v: str) -> str:
    key = PEPPER.encode().ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in key).hex() for x in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({v}))))"


def by_level(cols: str, table: str) -> str:
    return " union all ".join(f"select {cols}, {g} as code, '{g}' as granularity from {table} where {g} is not null" for g in ("area", "district", "sector", "unit"))


AS_OF = f"date '{C.as_of}'"
POINTS = f"case trigger_type when 'new_fsa' then {C.points_new} when 'ownership_change' then {C.points_ownership} else {C.points_review} end"

CTES: dict[str, str] = {name: text for name, (_, text) in SQL.items()}
CTES |= {
    "lp": f"select *, {parts()}, {akey()} as address_key from listings",
    "prem": """select address_key, unit, sector, district, area, first(brand_name order by reviews desc, listing_id) as primary_brand, first(address order by reviews desc, listing_id) as address,
  first(premises_no order by reviews desc, listing_id) as premises_no, first(run_no order by reviews desc, listing_id) as run_no, array_to_string(list_sort(list(distinct brand_name)), ' | ') as all_brands, count(distinct brand_name) as brand_count, count(distinct platform) as platforms_count,
  cast(sum(reviews) as bigint) as reviews, max(rating_tenths) as rating_tenths, first(phone order by reviews desc, listing_id) as phone, count(*) as listings, count(distinct brand_name)>1 as multi_brand, array_to_string(list_sort(list(distinct cuisine_type)), ' | ') as cuisines,
  coalesce(address_key, '')||'|'||coalesce(unit, '')||coalesce('|#'||solo, '') as lead_key
  from (select *, case when unit is null or coalesce(address_key, '')='' then listing_id end as solo from lp) keyed group by address_key, unit, sector, district, area, solo""",
    "denied_phones": "select match_value from denied where match_type='phone' and status='active' union select subject from erased where scope='import'",
    "scoped": "select * from lp where district in (select value from territory) and phone not in (select match_value from denied_phones) and unit not in (select match_value from denied where match_type='postcode' and status='active')",
    "cust": f"select *, {parts()}, {akey()} as address_key from customers",
    "pairs": """select l.lead_key, c.account_code from leads l join cust c on l.sector=c.sector union select l.lead_key, c.account_code from leads l join cust c on l.phone=c.phone
  union select l.lead_key, c.account_code from leads l join cust c on l.address_key=c.address_key""",
    "named": f"""select p.lead_key, p.account_code, c.status, coalesce(l.phone=c.phone, false) as same_phone, coalesce(l.unit=c.unit, false) as same_unit,
  greatest({ratio('lower(l.primary_brand)', 'lower(c.name)')}, {ratio(sorted_tokens('l.primary_brand'), sorted_tokens('c.name'))}) as name_score
  from pairs p join leads l on p.lead_key=l.lead_key join cust c on p.account_code=c.account_code""",
    "scored": f"""select lead_key, account_code, status, name_score, cast(floor({C.name_weight}*name_score+{C.phone_weight}*(case when same_phone then 100.0 else 0.0 end)+{C.postcode_weight}*(case when same_unit then 100.0 else 0.0 end)+0.5) as bigint) as match_pct,
  (case when same_phone then 'Phone exact, ' else '' end)||(case when same_unit then 'Postcode exact, ' else '' end)||'Name '||name_score||'%' as matched_fields from named""",
    "best": "select * exclude r from (select *, row_number() over (partition by lead_key order by match_pct desc, account_code) as r from scored) where r=1",
    "classified": f"""select *, case when match_class in ('none','partial') then case when match_pct>={C.amber_from} then 'Amber' else 'Green' end end as match_colour from (
  select l.*, b.account_code, b.status as match_status, b.match_pct, b.matched_fields, case when b.status='active' and b.match_pct>={C.active_threshold} then 'active_match' when b.status='inactive' and b.match_pct>={C.inactive_threshold} then 'inactive_match' when b.match_pct is null then 'none' else 'partial' end as match_class
  from leads l left join best b on l.lead_key=b.lead_key)""",
    "regk": f"select *, {parts()}, {akey()} as address_key from registrations",
    "regn": "select address_key, unit, count(*) as registrations from regk group by address_key, unit",
    "regexact": "select l.lead_key, l.address_key, l.unit, r.fsa_id, r.operator_name, r.business_type, r.hygiene, r.days_since_registration, r.last_inspection_age, r.lat, r.lng, 1 as how, 100 as likeness from leads l join regk r on l.address_key=r.address_key and l.unit=r.unit and (l.tenant is null or l.tenant=r.fsa_id)",
    "regnear": f"""select l.lead_key, l.address_key, l.unit, r.fsa_id, r.operator_name, r.business_type, r.hygiene, r.days_since_registration, r.last_inspection_age, r.lat, r.lng, 2 as how, {ratio(sorted_tokens('l.primary_brand'), sorted_tokens('r.operator_name'))} as likeness
  from leads l join regk r on l.unit=r.unit where l.lead_key not in (select lead_key from regexact)""",
    "regm": """select m.lead_key, fsa_id, operator_name, business_type, hygiene, days_since_registration, last_inspection_age, lat, lng, cast(how as bigint) as how, coalesce(n.registrations, 0) as registrations from (
  select *, row_number() over (partition by lead_key order by how, likeness desc, fsa_id) as k from (select * from regexact union all select * from regnear where likeness>=80)) m left join regn n on m.address_key=n.address_key and m.unit=n.unit where k=1""",
    "compk": f"select *, {parts()}, {akey()} as address_key from companies",
    "compm": """select lead_key, ch_number, company_name, ch_status, sic_code, age_days, cast(how as bigint) as how from (select *, row_number() over (partition by lead_key order by how, ch_number) as r from (
  select l.lead_key, c.ch_number, c.company_name, c.ch_status, c.sic_code, c.age_days, 1 as how from leads l join regm r on l.lead_key=r.lead_key join compk c on r.operator_name=c.company_name and l.unit=c.unit
  union all select l.lead_key, c.ch_number, c.company_name, c.ch_status, c.sic_code, c.age_days, 2 from leads l join compk c on l.address_key=c.address_key and l.unit=c.unit
  union all select l.lead_key, c.ch_number, c.company_name, c.ch_status, c.sic_code, c.age_days, 3 from leads l join compk c on l.sector=c.sector and lower(l.primary_brand||' Foods')=lower(c.company_name))) where r=1""",
    "boundary": "select distinct district as code, 'district' as granularity, case when area='SL' then 'expansion' else 'in_area' end as membership from lp where area<>'SW'",
    "enriched": f"""select c.*, r.fsa_id, r.operator_name, r.business_type, r.hygiene, r.days_since_registration, r.last_inspection_age, r.lat, r.lng, r.registrations, m.ch_number, m.company_name, m.ch_status, m.sic_code, m.age_days as company_age,
  coalesce(b.membership, 'outside') as membership, case when m.ch_status='Dissolved' then 'rejected' when r.fsa_id is not null and m.ch_status is not null then 'fsa_ch' when r.fsa_id is not null then 'fsa_only' else 'unverified' end as verify_state,
  not (coalesce(r.business_type='{C.not_food_types[0]}', false) or coalesce(not starts_with(m.sic_code, '{C.food_sic}'), false)) as is_food,
  case when c.reviews<500 then greatest(c.reviews, coalesce(g.place_reviews, 0)) else c.reviews end as size_reviews
  from classified c left join regm r on c.lead_key=r.lead_key left join compm m on c.lead_key=m.lead_key left join boundary b on c.district=b.code left join (select premises_no, max(reviews) as place_reviews from place_lookups group by premises_no) g on c.premises_no=g.premises_no""",
    "sized": "select *, case when size_reviews>=15000 and rating_tenths>=30 then 'large' when size_reviews>=5000 then 'medium' else 'small' end as size_class from enriched",
    "moved": f"""select b.ch_number, d.ch_number as predecessor, {AS_OF}-cast(d.dissolved_age as int) as dissolved_on, {AS_OF}-cast(b.age_days as int) as changed_on from compk b join compk d on b.address_key=d.address_key and b.sector=d.sector
  where b.ch_status='Active' and d.ch_status='Dissolved' and d.dissolved_age>=b.age_days qualify row_number() over (partition by b.ch_number order by d.dissolved_age, d.ch_number desc)=1""",
    "changes": f"""select ch_number, 're-incorporated' as reason, changed_on, predecessor from moved
  union all select ch_number, 'appointment', max({AS_OF}-cast(appointed_age as int)), null from officers where appointed_age<{C.window_days} group by ch_number""",
    "owner": "select o.ch_number, c.address_key, c.unit, first(o.reason order by o.changed_on desc, o.reason desc) as reason, max(o.changed_on) as changed_on, first(o.predecessor order by o.changed_on desc, o.reason desc) as predecessor from changes o join compk c on o.ch_number=c.ch_number group by o.ch_number, c.address_key, c.unit",
    "lexicon": f"select * from (values {', '.join(f"('{t}','{c}',{str(n).lower()})" for t, c, n in C.lexicon)}) t(term, category, negated)",
    "seen": f"select distinct premises_no, source, text, age_days from reviews where age_days<{C.window_days}",
    "reviewwords": "select *, row_number() over () as review, list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z'']+'), lambda x: x<>'') as w from seen",
    "termrows": f"select premises_no, source, {AS_OF}-cast(age_days as int) as day, review, w[i] as term, len(list_intersect(w[greatest(i-{C.negation_window}, 1):i-1], [{', '.join("'" + n.replace("'", "''") + "'" for n in C.negations)}]))>0 as negated from (select *, unnest(range(1, len(w)+1)) as i from reviewwords) x where w[i] in (select term from lexicon)",
    "complained": "select distinct premises_no, source, day, review, category, h.term from termrows h join lexicon l on h.term=l.term and h.negated=l.negated",
    "hits": "select premises_no, count(distinct review) as hits, first(source order by day desc, source desc) as source, max(day) as review_date, array_to_string(list_sort(list(distinct term)), ',') as terms, count(distinct review) filter (category='supply') as supply, count(distinct review) filter (category='stock') as stock, count(distinct review) filter (category='quality') as quality, count(distinct review) filter (category='consistency') as consistency from complained group by premises_no",
    "snippets": "select *, substr(hits||' recent review(s) complain: '||concat_ws(', ', case when supply>0 then 'supply '||supply end, case when stock>0 then 'stock '||stock end, case when quality>0 then 'quality '||quality end, case when consistency>0 then 'consistency '||consistency end), 1, 200) as snippet from hits",
    "trig": f"""select lead_key, 'new_fsa' as trigger_type, 'Registered recently' as snippet, {AS_OF}-cast(days_since_registration as int) as trigger_date from regm where days_since_registration<{C.new_days}
  union all select m.lead_key, 'ownership_change', o.reason, o.changed_on from compm m join owner o on m.ch_number=o.ch_number
  union all select p.lead_key, 'review_complaint', h.snippet, h.review_date from leads p join snippets h on p.premises_no=h.premises_no""",
    "bonus": f"select lead_key, cast(sum({POINTS}) as bigint) as bonus from (select distinct lead_key, trigger_type from trig) group by lead_key",
    "facts": """select lead_key, 'type' as factor, case when multi_brand then 'multi' else 'single' end as value from sized union all select lead_key, 'area', area from sized union all
  select lead_key, 'phone', case when starts_with(phone, '07') then 'mobile' else 'landline' end from sized union all select lead_key, 'size', size_class from sized union all select lead_key, 'verified', verify_state from sized""",
    "rules": "select * from (values ('type','multi',8),('type','single',4),('area','TW',20),('area','UB',15),('area','HA',10),('phone','mobile',15),('size','large',28),('size','medium',18),('size','small',8),('verified','fsa_ch',12),('verified','fsa_only',6)) t(factor, value, points)",
    "base": """select s.lead_key, cast(coalesce(sum(points), 0) as bigint) as base, coalesce(string_agg(f.value||' +'||points, '; ' order by f.factor), '') as breakdown
  from sized s left join (select facts.lead_key, facts.factor, facts.value, points from facts join rules on facts.factor=rules.factor and facts.value=rules.value) f on s.lead_key=f.lead_key group by s.lead_key""",
    "final": f"""select *, case when score>={C.tier_a} then 'A' when score>={C.tier_b} then 'B' when score>={C.tier_low} then 'Low' else 'Ignore' end as tier from (
  select b.lead_key, base, breakdown, coalesce(bonus, 0) as bonus, base+coalesce(bonus, 0) as score from base b left join bonus x on b.lead_key=x.lead_key)""",
    "routed": f"""select *, case rule when 1 then 'ignored' when 2 then 'reactivation' when 3 then 'ignored' when 4 then 'ignored' when 5 then 'expansion' when 6 then 'ignored' when 7 then 'manual_review' when 8 then 'ignored' else 'export' end as route,
  case rule when 1 then 'ACTIVE_MATCH' when 2 then 'INACTIVE_MATCH' when 3 then 'NOT_FOOD' when 4 then 'DISSOLVED' when 5 then 'HELD_OUT_OF_AREA' when 6 then 'OUT_OF_AREA' when 7 then 'NO_FSA' when 8 then 'LOW_SCORE' else 'OK' end as reason from (
  select s.*, f.base, f.bonus, f.score, f.tier, f.breakdown, case when match_class='active_match' then 1 when match_class='inactive_match' then 2 when not is_food then 3 when verify_state='rejected' then 4
  when membership<>'in_area' and verify_state in ('fsa_ch','fsa_only') then 5 when membership<>'in_area' then 6 when fsa_id is null then 7 when tier='Ignore' then 8 else 9 end as rule,
  (case when fsa_id is not null then 50 else 0 end)+(case when ch_status='Active' then 30 else 0 end)+(case when hygiene>=3 then 10 else 0 end)+(case when phone is not null then 10 else 0 end) as legitimacy_pct,
  case when match_class='active_match' then 0 else 100-cast(floor(coalesce(match_pct,0)/2.0+0.5) as bigint) end as uniqueness_pct from sized s join final f on s.lead_key=f.lead_key)""",
    "routedx": by_level("run_no, route", "routed"),
    "units": """select run_no, code, granularity, count(*) as found, count(*) filter (route='ignored') as ignored, count(*) filter (route='export') as exported, count(*) filter (route='reactivation') as reactivation
  from routedx group by run_no, code, granularity""",
    "summary": """select coalesce(u.code, b.code) as code, coalesce(u.granularity, b.granularity) as granularity, coalesce(runs, 0) as runs, first_run, last_run, coalesce(found, 0) as found, coalesce(ignored, 0) as ignored, coalesce(exported, 0) as exported,
  coalesce(reactivation, 0) as reactivation, coalesce(b.membership, 'outside') as membership, 1 as boundary_version from (
  select code, granularity, count(distinct u.run_no) as runs, min(last_day) as first_run, max(last_day) as last_run, cast(sum(found) as bigint) as found, cast(sum(ignored) as bigint) as ignored, cast(sum(exported) as bigint) as exported, cast(sum(reactivation) as bigint) as reactivation
  from units u left join runs r on u.run_no=r.run_no group by code, granularity) u full outer join boundary b on u.code=b.code and u.granularity=b.granularity""",
    "acp": f"""select ch_number, accounts_type, period_end as accounts_date, {', '.join(f'{x} as c_{x}, p_{x}' for x in FIGURES)}, p_period_end from (select *, {', '.join(f'lag({x}) over w as p_{x}' for x in (*FIGURES, 'period_end'))},
  row_number() over (partition by ch_number order by period_end desc, filing_id desc) as r from filings window w as (partition by ch_number order by period_end, filing_id)) where r=1""",
    "acg": "select *, case when p_net_assets<>0 then cast(floor(100.0*(c_net_assets-p_net_assets)/p_net_assets+0.5) as bigint) end as net_assets_growth from acp",
    "acl": f"""select *, case when accounts_type='Dormant' then 'Dormant' when c_net_assets is null then 'No-Data' when c_net_assets<0 then 'Insolvency-Flag' when c_net_assets<{C.thin_below} then 'Thin' when net_assets_growth>={C.growing_from} then 'Solvent-Growing' else 'Solvent-Stable' end as financial_label from acg""",
}



# Leads of a run: premises in scope, split by tenant.
CTES["tenanted"] = CTES["prem"].replace("from lp)", "from scoped)")
CTES["leads"] = "select p.* replace (p.lead_key||coalesce('|T'||r.fsa_id, '') as lead_key), p.lead_key as premises_key, r.fsa_id as tenant from tenanted p left join regn n on p.address_key=n.address_key and p.unit=n.unit left join regk r on n.registrations>1 and r.address_key=p.address_key and r.unit=p.unit"


def oracle(body: str, extra: dict[str, str] | None = None) -> str:
    """A query with all the expressions that it needs in front, each after those it uses."""
    known = CTES | (extra or {})
    order: list[str] = []

    def add(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"(?:from|join)\s+\(?\s*([a-z_]\w*)", text)):
            if name in known and name not in order:
                own = known[name]
                if not re.search(rf"from\s+{name}\b", own) or name not in SQL:
                    add(re.sub(rf"\b(from|join)\s+{name}\b", "", own))  # one that calls itself stands once
                if name not in order:
                    order.append(name)

    add(body)
    head = ",\n".join(f"{n} as ({known[n]})" for n in order)
    kind = "with recursive" if any(re.search(rf"\b(from|join)\s+{n}\b", known[n]) for n in order if n not in SQL) else "with"
    return (f"{kind} {head}\n" if head else "") + body
