"""Blocked matching of leads with customers, registrations, companies and directors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.config import DEFAULT, Config
from leadflow.functions.text import edit_ratio, percent, set_ratio, token_set, token_sort_ratio, with_postcode_parts
from leadflow.operators.premises import with_address_key
from leadflow.operators.territory import is_small

EXACT_LENGTH = 50  # names below it with one difference have a score below 99
SECTOR_PART = 2_000  # customers of a sector that one task joins


def customer_keys(customers: DataFrame) -> DataFrame:
    return with_address_key(with_postcode_parts(customers))


def block_sizes(leads: DataFrame, cust: DataFrame, key: str) -> DataFrame:
    """Pairs per block of a key, for the report on oversize blocks."""
    a = leads.groupBy(key).agg(F.count("*").alias("leads"))
    b = cust.groupBy(key).agg(F.count("*").alias("customers"))
    return a.join(b, key).withColumn("pairs", F.col("leads") * F.col("customers"))


def block(leads: DataFrame, cust: DataFrame) -> DataFrame:
    """Candidate pairs (lead_key, account_code): same sector, phone, or address key, of sectors of any size."""
    pairs = blocked(leads, cust).select("lead_key", "account_code")
    return pairs if _named_once(leads, cust) else pairs.distinct()


def _named_once(leads: DataFrame, cust: DataFrame) -> bool:
    """Whether each lead key and each account code names one row."""
    return all(df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty() for df, key in ((leads, "lead_key"), (cust, "account_code")))


def blocked(leads: DataFrame, cust: DataFrame, of_lead: tuple[Column, ...] = (), of_customer: tuple[Column, ...] = ()) -> DataFrame:
    """The candidate pairs with columns of both sides. A pair is made by the first key that it shares, so
    pairs are written as they are joined, without a shuffle of them all; only where a lead key or an
    account code names several rows are pairs made distinct and the columns joined to them."""
    l = leads.select("lead_key", "sector", "phone", "address_key", *of_lead)
    c = cust.select("account_code", F.col("sector").alias("c_sector"), F.col("phone").alias("c_phone"), F.col("address_key").alias("c_address"), *of_customer)
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    own = [*l.columns, *c.columns]
    found = sector_pairs(l, c).select(own)
    found = found.unionByName(l.join(c, (F.col("phone") == F.col("c_phone")) & ~same("sector", "c_sector")).select(own))
    tasks = int(l.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.unionByName(l.repartition(tasks, "address_key").join(c.repartition(tasks, "c_address"), (F.col("address_key") == F.col("c_address")) & ~same("sector", "c_sector") & ~same("phone", "c_phone")).select(own))
    if _named_once(leads, cust):
        return found
    return found.select("lead_key", "account_code").distinct().join(l, "lead_key").join(c, "account_code").select(own)


def sector_pairs(l: DataFrame, c: DataFrame, part: int = SECTOR_PART) -> DataFrame:
    """All pairs of one sector. A sector with more customers than `part` is dealt over as many tasks as
    it needs: its customers by salt, its leads to each salt; other sectors are joined as they are."""
    hot = c.groupBy("c_sector").agg(F.count("*").alias("n")).filter(F.col("n") > part).select("c_sector", F.ceil(F.col("n") / part).cast("int").alias("salts"))
    hot = F.broadcast(hot) if is_small(hot) else hot
    c = c.join(hot, "c_sector", "left").withColumn("c_salt", F.pmod(F.xxhash64("account_code"), F.coalesce("salts", F.lit(1)))).drop("salts")
    l = l.join(hot.withColumnRenamed("c_sector", "sector"), "sector", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.coalesce("salts", F.lit(1)) - 1).cast("bigint")))).drop("salts")
    # small inputs make many pairs, so the number of tasks is set, not left to the size of the inputs
    tasks = int(l.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return l.repartition(tasks, "sector", "salt").join(c.repartition(tasks, "c_sector", "c_salt"), (F.col("sector") == F.col("c_sector")) & (F.col("salt") == F.col("c_salt")))


def score_pairs(pairs: DataFrame, leads: DataFrame, cust: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds name score, match percent and the text of matched fields."""
    l = leads.select("lead_key", F.col("primary_brand").alias("brand"), F.col("phone").alias("l_phone"), F.col("unit").alias("l_unit"))
    c = cust.select("account_code", "name", "status", F.col("phone").alias("c_phone"), F.col("unit").alias("c_unit"))
    return _scored(pairs.join(l, "lead_key").join(c, "account_code"), cfg)


def _sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(F.trim(F.lower(c)), " +")), " ")


def scored_pairs(leads: DataFrame, cust: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """score_pairs(block(leads, cust), leads, cust) in one pass: what the score needs travels with the
    pair, names are lowered and their words sorted once a row, not once a pair."""
    of_lead = (F.lower("primary_brand").alias("brand"), _sorted_words(F.col("primary_brand")).alias("words"), F.col("unit").alias("l_unit"))
    of_customer = (F.lower("name").alias("name"), _sorted_words(F.col("name")).alias("c_words"), "status", F.col("unit").alias("c_unit"))
    pairs = blocked(leads, cust, of_lead, of_customer).withColumnRenamed("phone", "l_phone")
    return _with_percent(pairs, F.greatest(edit_ratio(F.col("brand"), F.col("name")), edit_ratio(F.col("words"), F.col("c_words"))), cfg)


def similarities(leads: DataFrame, cust: DataFrame) -> DataFrame:
    """(lead_key, account_code, edit, sorted, token_set) of all candidate pairs."""
    of_lead = (F.col("primary_brand").alias("brand"), _sorted_words(F.col("primary_brand")).alias("words"), token_set(F.col("primary_brand")).alias("tokens"))
    of_customer = ("name", _sorted_words(F.col("name")).alias("c_words"), token_set(F.col("name")).alias("c_tokens"))
    pairs = blocked(leads, cust, of_lead, of_customer)
    return pairs.select("lead_key", "account_code", edit_ratio(F.col("brand"), F.col("name")).alias("edit"), edit_ratio(F.col("words"), F.col("c_words")).alias("sorted"), set_ratio(F.col("tokens"), F.col("c_tokens")).alias("token_set"))


def _scored(out: DataFrame, cfg: Config) -> DataFrame:
    return _with_percent(out, F.greatest(edit_ratio(F.lower("brand"), F.lower("name")), token_sort_ratio(F.col("brand"), F.col("name"))), cfg)


def _with_percent(out: DataFrame, name: Column, cfg: Config) -> DataFrame:
    out = out.withColumn("name_score", name).withColumn("same_phone", F.coalesce(F.col("l_phone") == F.col("c_phone"), F.lit(False))).withColumn("same_unit", F.coalesce(F.col("l_unit") == F.col("c_unit"), F.lit(False)))
    one = lambda c: F.when(c, 100.0).otherwise(0.0)
    pct = percent(cfg.name_weight * F.col("name_score") + cfg.phone_weight * one(F.col("same_phone")) + cfg.postcode_weight * one(F.col("same_unit")))
    text = F.concat_ws(", ", F.when(F.col("same_phone"), "Phone exact"), F.when(F.col("same_unit"), "Postcode exact"), F.concat(F.lit("Name "), F.col("name_score").cast("string"), F.lit("%")))
    return out.withColumn("match_pct", pct).withColumn("matched_fields", text).select("lead_key", "account_code", "status", "name_score", "match_pct", "matched_fields")


def best_match(scored: DataFrame) -> DataFrame:
    order = W.partitionBy("lead_key").orderBy(F.desc("match_pct"), "account_code")
    return scored.withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r")


def best_customers(leads: DataFrame, cust: DataFrame, cfg: Config = DEFAULT, counts: dict | None = None, written=lambda name, df: df) -> DataFrame:
    """The rows of best_match(score_pairs(block(...))) without joining whole sectors or addresses.

    A pair's percent is bounded by what it shares: with neither phone nor unit postcode it cannot pass
    the weight of the name. So pairs are taken in the order of their bounds: first those that share a
    phone or a unit, and those whose names have the same words in the same sector or at the same address,
    the best that such a pair can reach. A lead whose best of these passes every other bound is done
    (ties included: shorter names than EXACT_LENGTH with one difference stay below a full score). The
    others are compared by name only, and by distinct name: each name of a sector or address once with
    each distinct name of customers there whose length lets it reach the lead's best so far. counts, if
    given, receives the number of pairs compared in both steps (as data frames); written, if given,
    writes the first step's result, which the second reads several times."""
    l = leads.select("lead_key", F.col("primary_brand").alias("brand"), "sector", "address_key", F.col("phone").alias("l_phone"), F.col("unit").alias("l_unit"))
    c = cust.select("account_code", "name", "status", F.col("sector").alias("c_sector"), F.col("address_key").alias("c_address"), F.col("phone").alias("c_phone"), F.col("unit").alias("c_unit"))
    lw, cw = l.withColumn("words", _sorted_words(F.col("brand"))), c.withColumn("c_words", _sorted_words(F.col("name")))
    same_words = F.col("words") == F.col("c_words")
    firm = [
        l.join(c, F.col("l_phone") == F.col("c_phone")),
        l.join(c, (F.col("l_unit") == F.col("c_unit")) & (F.col("sector") == F.col("c_sector"))),
    ]
    for own, other in (("sector", "c_sector"), ("address_key", "c_address")):
        # of equal names in a block only the first account can be the best of those without phone or unit
        first = cw.groupBy(other, "c_words").agg(F.min("account_code").alias("account_code"))
        firm.append(lw.join(first.join(c.drop(other), "account_code"), (F.col(own) == F.col(other)) & same_words).drop("words", "c_words"))
    cols = ["lead_key", "account_code", "brand", "name", "status", "l_phone", "c_phone", "l_unit", "c_unit"]
    pairs = reduce(DataFrame.unionByName, [f.select(cols) for f in firm])
    found = written("best-firm", best_match(_scored(pairs, cfg)))
    most = percent(F.lit(100.0 * cfg.name_weight))
    sure = (F.col("match_pct") > most) | ((F.col("match_pct") == most) & (F.col("name_score") == 100) & (F.length("brand") < EXACT_LENGTH))
    so_far = l.join(found.select("lead_key", "match_pct", "name_score"), "lead_key", "left")
    open_ = so_far.filter(~F.coalesce(sure, F.lit(False)))
    near = []
    for own, other in (("sector", "c_sector"), ("address_key", "c_address")):
        names = c.filter(F.col(other).isNotNull()).groupBy(other, F.lower("name").alias("n")).agg(F.min("account_code").alias("account_code"), F.min("name").alias("name"))
        brands = open_.filter(F.col(own).isNotNull()).groupBy(own, "brand").agg(F.min(F.coalesce("match_pct", F.lit(-1))).alias("so_far"))
        reach = lambda a, b: 100.0 * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))
        bound = percent(cfg.name_weight * percent(F.greatest(reach("brand", "n"), reach(_sorted_words(F.col("brand")), _sorted_words(F.col("n"))))))
        met = brands.join(names, (F.col(own) == F.col(other)) & (bound >= F.col("so_far")))
        score = F.greatest(edit_ratio(F.lower("brand"), F.col("n")), token_sort_ratio(F.col("brand"), F.col("n")))
        # one pass over the pairs: the smallest account of each percent, then that of the best
        by_pct = met.withColumn("pct", percent(cfg.name_weight * score)).groupBy(own, "brand", "pct").agg(F.min("account_code").alias("account_code"), F.count("*").alias("compared"))
        first = by_pct.groupBy(own, "brand").agg(F.max_by("account_code", "pct").alias("account_code"))
        if counts is not None:
            counts[own] = by_pct.agg(F.sum("compared").alias("n"))
        near.append(open_.join(first, [own, "brand"]).select("lead_key", "account_code", "brand", "l_phone", "l_unit"))
    if counts is not None:
        counts["firm"] = pairs.agg(F.count("*").alias("n"))
    rest = reduce(DataFrame.unionByName, near).join(c.select("account_code", "name", "status", "c_phone", "c_unit"), "account_code").select(cols)
    return best_match(found.unionByName(_scored(rest, cfg)))


def match_class(pct: Column, status: Column, cfg: Config = DEFAULT) -> Column:
    return (
        F.when((status == "active") & (pct >= cfg.active_threshold), "active_match")
        .when((status == "inactive") & (pct >= cfg.inactive_threshold), "inactive_match")
        .when(pct.isNull(), "none")
        .otherwise("partial")
    )


def classify_match(leads: DataFrame, best: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds match class and colour to every lead."""
    out = leads.join(best.drop("name_score").withColumnRenamed("status", "match_status"), "lead_key", "left")
    pct = F.col("match_pct")
    out = out.withColumn("match_class", match_class(pct, F.col("match_status"), cfg))
    colour = F.when(F.col("match_class").isin("none", "partial"), F.when(pct >= cfg.amber_from, "Amber").otherwise("Green"))
    return out.withColumn("match_colour", colour)


def match_registrations(leads: DataFrame, regs: DataFrame, least: int = 80) -> DataFrame:
    """Registration of each lead: by address and postcode (its own one for the lead of a tenant), else by
    name within the postcode."""
    more = [c for c in ("last_inspection_age", "lat", "lng") if c in regs.columns]
    r = with_address_key(with_postcode_parts(regs)).select("address_key", "unit", "fsa_id", "operator_name", "business_type", "hygiene", "days_since_registration", *more)
    tenant = F.col("tenant") if "tenant" in leads.columns else F.lit(None).cast("bigint")
    l = leads.select("lead_key", "address_key", "unit", "primary_brand", tenant.alias("tenant"))
    exact = l.join(r, ["address_key", "unit"]).filter("tenant is null or tenant = fsa_id").withColumn("how", F.lit(1)).withColumn("likeness", F.lit(100).cast("bigint"))
    n = r.groupBy("address_key", "unit").agg(F.count("*").alias("registrations"))
    rest = l.join(exact.select("lead_key"), "lead_key", "left_anti").join(r.drop("address_key"), "unit")
    near = rest.withColumn("how", F.lit(2)).withColumn("likeness", token_sort_ratio(F.col("primary_brand"), F.col("operator_name"))).filter(F.col("likeness") >= least)
    order = W.partitionBy("lead_key").orderBy("how", F.desc("likeness"), "fsa_id")
    cols = ["lead_key", "address_key", "unit", "fsa_id", "operator_name", "business_type", "hygiene", "days_since_registration", *more, "how", "likeness"]
    best = exact.select(cols).unionByName(near.select(cols)).withColumn("k", F.row_number().over(order)).filter("k = 1")
    out = best.join(n, ["address_key", "unit"], "left").withColumn("registrations", F.coalesce("registrations", F.lit(0)))
    return out.select("lead_key", "fsa_id", "operator_name", "business_type", "hygiene", "days_since_registration", *more, F.col("how").cast("bigint").alias("how"), "registrations")


def match_companies(leads: DataFrame, regs: DataFrame, companies: DataFrame) -> DataFrame:
    """Company of each lead: registered operator, then address, then brand name in the sector.
    regs: the result of match_registrations."""
    more = ["age_days"] if "age_days" in companies.columns else []
    c = with_address_key(with_postcode_parts(companies)).select("address_key", "unit", "sector", "ch_number", "company_name", "ch_status", "sic_code", *more)
    l = leads.join(regs.select("lead_key", "operator_name"), "lead_key", "left").select("lead_key", "address_key", "unit", "sector", "primary_brand", "operator_name")
    d = c.drop("address_key", "sector")
    by_operator = l.join(d, (l["operator_name"] == d["company_name"]) & (l["unit"] == d["unit"])).select("lead_key", *[d[x] for x in d.columns if x != "unit"]).withColumn("how", F.lit(1))
    by_address = l.join(c.drop("sector"), ["address_key", "unit"]).select("lead_key", "ch_number", "company_name", "ch_status", "sic_code", *more).withColumn("how", F.lit(2))
    e = c.select("sector", F.lower("company_name").alias("n"), "ch_number", "company_name", "ch_status", "sic_code", *more)
    by_name = l.withColumn("n", F.lower(F.concat("primary_brand", F.lit(" Foods")))).join(e, ["sector", "n"]).select("lead_key", "ch_number", "company_name", "ch_status", "sic_code", *more).withColumn("how", F.lit(3))
    order = W.partitionBy("lead_key").orderBy("how", "ch_number")
    every = by_operator.unionByName(by_address).unionByName(by_name)
    return every.withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r").withColumn("how", F.col("how").cast("bigint"))


# Titles in front of names.
TITLES = ("mr", "mrs", "ms", "miss", "dr", "sir", "dame", "prof")


def person_key(name: Column, birth_month: Column) -> Column:
    """One key for the forms of a person's name ("SURNAME, First", titles, case, spaces) and the birth
    month where it is given; null for an empty name."""
    turned = F.when(F.contains(name, F.lit(",")), F.concat_ws(" ", F.split_part(name, F.lit(","), F.lit(2)), F.split_part(name, F.lit(","), F.lit(1)))).otherwise(name)
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower(turned), "[^a-z0-9 ]", " "), " +", " "))
    bare = F.regexp_replace(plain, f"^({'|'.join(TITLES)}) ", "")
    return F.concat(F.nullif(bare, F.lit("")), F.lit("|"), F.coalesce(birth_month, F.lit(""))).alias("person")


def linked_companies(officers: DataFrame, written) -> DataFrame:
    """(ch_number, chain): companies that share a director, directly or over others, have one chain, named
    by its smallest company. Labels go from companies to persons and back, then each company takes the
    label of its label, so a chain of n companies needs about log n rounds. Each round is written by
    `written(name, df)`, so lineage stays short; a person of very many companies is one row a round."""
    links = officers.filter("kind = 'director'").select("ch_number", person_key(F.col("person_name"), F.col("birth_month")).alias("person")).filter("person is not null and ch_number is not null").distinct()
    links = written("links", links)
    labels = links.select("ch_number").distinct().withColumn("chain", F.col("ch_number"))
    turn = 0
    while True:
        labels = written(f"chain-{turn}", labels)
        of_person = links.join(labels, "ch_number").groupBy("person").agg(F.min("chain").alias("chain"))
        heard = links.join(of_person, "person").groupBy("ch_number").agg(F.min("chain").alias("least"))
        jumped = labels.select(F.col("ch_number").alias("chain"), F.col("chain").alias("further"))
        new = labels.join(heard, "ch_number").join(jumped, "chain", "left").select("ch_number", F.col("chain").alias("old"), F.least("chain", "least", "further").alias("chain"))
        new = written(f"turn-{turn}", new)
        if new.filter("chain <> old").isEmpty():
            return new.select("ch_number", "chain")
        labels, turn = new.select("ch_number", "chain"), turn + 1


def trace_directors(companies: DataFrame, chains: DataFrame, prefix: str = DEFAULT.food_sic, listed: int = 5) -> DataFrame:
    """Per company: number of other food companies on its chain of shared directors and the first of
    them. A chain's list is cut to what is shown before it is grouped."""
    c = companies.select("ch_number", F.coalesce(F.col("sic_code").startswith(prefix), F.lit(False)).alias("food")).join(chains, "ch_number", "left")
    food = c.filter("food and chain is not null").select("chain", "ch_number")
    counts = food.groupBy("chain").agg(F.count("*").alias("n"))
    first = food.withColumn("r", F.row_number().over(W.partitionBy("chain").orderBy("ch_number"))).filter(F.col("r") <= listed + 1)
    lists = first.groupBy("chain").agg(F.array_sort(F.collect_list("ch_number")).alias("all"))
    out = c.join(counts, "chain", "left").join(lists, "chain", "left")
    others = F.slice(F.filter(F.coalesce("all", F.array().cast("array<string>")), lambda x: x != F.col("ch_number")), 1, listed)
    n = F.coalesce("n", F.lit(0)) - F.when(F.col("food") & F.col("chain").isNotNull(), 1).otherwise(0)
    return out.select("ch_number", "chain", n.alias("others"), F.array_join(others, " | ").alias("other_list")).withColumn("flag", F.col("others") > 0)


def _days_ago(age: Column, cfg: Config) -> Column:
    return F.date_sub(F.lit(cfg.as_of).cast("date"), age.cast("int"))


def reincorporations(companies: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(ch_number, predecessor, dissolved_on, changed_on): for each live company the last dissolution at
    its address (key and sector) on or before its incorporation, an as-of join: dissolutions and
    incorporations of an address in one order, the last dissolution carried forward. On one day
    dissolutions come first; of several the largest number is the last."""
    c = companies if {"address_key", "sector"} <= set(companies.columns) else with_address_key(with_postcode_parts(companies))
    c = c.filter("address_key <> '' and sector is not null")
    ended = c.filter("ch_status = 'Dissolved' and dissolved_age is not null").select("address_key", "sector", "ch_number", _days_ago(F.col("dissolved_age"), cfg).alias("day"), F.lit(0).alias("kind"))
    begun = c.filter("ch_status = 'Active' and age_days is not null").select("address_key", "sector", "ch_number", _days_ago(F.col("age_days"), cfg).alias("day"), F.lit(1).alias("kind"))
    w = W.partitionBy("address_key", "sector").orderBy("day", "kind", "ch_number").rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("kind") == 0, F.struct("ch_number", "day")), ignorenulls=True).over(w)
    out = ended.unionByName(begun).withColumn("last", last).filter("kind = 1 and last is not null")
    return out.select("ch_number", F.col("last.ch_number").alias("predecessor"), F.col("last.day").alias("dissolved_on"), F.col("day").alias("changed_on"))


def ownership_changes(companies: DataFrame, officers: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Companies with a director or owner appointed within the window, or incorporated at an address
    after another one was dissolved there; the latest change of each, with the predecessor."""
    c = with_address_key(with_postcode_parts(companies))
    moved = reincorporations(c, cfg).select("ch_number", F.lit("re-incorporated").alias("reason"), "changed_on", "predecessor")
    recent = officers.filter(F.col("appointed_age") < cfg.window_days).groupBy("ch_number").agg(F.max(_days_ago(F.col("appointed_age"), cfg)).alias("changed_on"))
    both = moved.unionByName(recent.select("ch_number", F.lit("appointment").alias("reason"), "changed_on", F.lit(None).cast("string").alias("predecessor")))
    last = both.groupBy("ch_number").agg(F.max(F.struct("changed_on", "reason", "predecessor")).alias("x"))
    return c.select("ch_number", "address_key", "unit").join(last, "ch_number").select("ch_number", "address_key", "unit", "x.reason", "x.changed_on", "x.predecessor")


def red_flags(companies: DataFrame) -> DataFrame:
    text = F.concat_ws(" / ", F.when(F.col("charges"), "Charges"), F.when(F.col("strike_off"), "Strike-off"))
    return companies.select("ch_number", F.coalesce(F.nullif(text, F.lit("")), F.lit("None")).alias("red_flags"))


def people_json(officers: DataFrame) -> DataFrame:
    """(ch_number, people): the officers of each company as one JSON list."""
    person = F.struct(F.col("person_name").alias("name"), "kind", "role")
    return officers.groupBy("ch_number").agg(F.to_json(F.array_sort(F.collect_list(person))).alias("people"))


def people_slots(profiles: DataFrame) -> DataFrame:
    """Two director slots and one PSC slot from a JSON list of people per company."""
    people = F.from_json("people", "array<struct<name:string,kind:string,role:string,since:string>>")
    pick = lambda kind: F.array_sort(F.filter(people, lambda p: p["kind"] == kind))
    slot = lambda kind, i, f: F.get(pick(kind), F.lit(i))[f]
    return profiles.select(
        "ch_number", slot("director", 0, "name").alias("director_1"), slot("director", 0, "role").alias("director_1_role"),
        slot("director", 1, "name").alias("director_2"), slot("director", 1, "role").alias("director_2_role"), slot("psc", 0, "name").alias("psc_1"),
    )
