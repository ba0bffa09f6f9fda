"""Filed accounts: facts from inline XBRL text, current and prior year, growth, labels, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.config import DEFAULT, Config
from leadflow.functions.text import percent

FACT = r"<ix:nonFraction\b([^>]*)>([^<]*)<"
# Tags of filed accounts and the figures they stand for.
TAGS = {
    "TotalAssets": "total_assets", "FixedAssets": "fixed_assets", "CurrentAssets": "current_assets", "CashBankOnHand": "cash_at_bank", "Debtors": "debtors", "Creditors": "creditors",
    "CurrentLiabilities": "current_liabilities", "NetAssets": "net_assets", "Equity": "equity", "Turnover": "turnover", "GrossProfit": "gross_profit", "NetProfit": "net_profit", "Employees": "employees",
}


CONTEXT = r"(?s)<(?:\w+:)?context\b[^>]*?\bid\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</(?:\w+:)?context>"
PERIOD_END = r"<(?:\w+:)?(?:instant|endDate)[^>]*>\s*([0-9]{4}-[0-9]{2}-[0-9]{2})"


def extract_filing_facts(filings: DataFrame) -> DataFrame:
    """(filing_id, tag, current, prior) of the known facts in the body of each filing.

    A fact's contextRef is resolved within its document: the context's instant or end date is the fact's
    date; the latest date of known facts is the current period, the one before it the prior. Contexts of
    a part of the company (with a dimension member) and facts of undefined contexts are left out, but a
    document that defines none may name its contexts `current` and `prior`. Attributes may stand in any
    order; scale is a power of ten; a sign attribute, a minus or parentheses make the amount negative;
    decimals says how exact it is and changes nothing."""
    group = lambda p, i: F.regexp_extract_all("body", F.lit(p), i)
    pairs = F.arrays_zip(group(CONTEXT, 1).alias("id"), group(CONTEXT, 2).alias("inner"))
    whole = F.filter(pairs, lambda c: ~c["inner"].rlike(r"(?:explicit|typed)Member\b"))
    ends = F.transform(whole, lambda c: F.struct(c["id"].alias("id"), F.regexp_extract(c["inner"], PERIOD_END, 1).try_cast("date").alias("end")))
    undefined = F.when(F.size("pairs") == 0, F.array(*[F.struct(F.lit(n).alias("id"), F.lit(d).cast("date").alias("end")) for n, d in (("current", "9999-12-31"), ("prior", "9999-12-30"))]))
    docs = filings.select("filing_id", "body", pairs.alias("pairs"), ends.alias("defined")).select("filing_id", F.coalesce(undefined, "defined").alias("contexts"), F.arrays_zip(group(FACT, 1).alias("attributes"), group(FACT, 2).alias("shown")).alias("f"))
    # the outer form, since the filter that Spark infers from the other one cuts out all facts once more
    facts = docs.select("filing_id", F.col("contexts.id").alias("ids"), F.col("contexts.end").alias("ends"), F.explode_outer("f").alias("f")).select("filing_id", "ids", "ends", "f.attributes", "f.shown")
    attribute = lambda name: F.regexp_extract("attributes", rf"(?:^|\s){name}\s*=\s*[\"']([^\"']*)[\"']", 1)
    size = F.regexp_replace("shown", "[^0-9.]", "").try_cast("decimal(20,4)")
    scaled = size * F.pow(F.lit(10), F.coalesce(attribute("scale").try_cast("int"), F.lit(0))).cast("decimal(18,6)")
    negative = (attribute("sign") == "-") | F.col("shown").rlike(r"^\s*[-(]")
    amount = F.when(negative, -scaled).otherwise(scaled).cast("decimal(18,2)")
    named = facts.select("filing_id", "ids", "ends", F.regexp_extract(attribute("name"), "([A-Za-z]+)$", 1).alias("tag"), attribute("contextRef").alias("context"), amount.alias("amount")).filter(F.col("tag").isin(list(TAGS)))
    end = F.get("ends", (F.array_position("ids", F.col("context")) - 1).cast("int"))
    # not "is not null": Spark infers from it that the contexts are not null, and cuts them out once more as it reads the file
    none = F.lit("0001-01-01").cast("date")
    dated = named.select("filing_id", "tag", "amount", F.coalesce(end, none).alias("end")).filter(F.col("end") > none)
    w = W.partitionBy("filing_id").orderBy(F.desc("end"))
    ranked = dated.withColumn("r", F.dense_rank().over(w))
    at = lambda r: F.max(F.when(F.col("r") == r, F.col("amount")))
    return ranked.filter("r <= 2").groupBy("filing_id", "tag").agg(at(1).alias("current"), at(2).alias("prior"))


def facts_wide(facts: DataFrame) -> DataFrame:
    """One row per filing with a column per figure, from the current amounts."""
    return facts.groupBy("filing_id").agg(*[F.max(F.when(F.col("tag") == tag, F.col("current"))).alias(figure) for tag, figure in TAGS.items()])


def current_and_prior(filings: DataFrame) -> DataFrame:
    """All figures of the latest accounts of each company as c_*, those of the ones before as p_*."""
    w = W.partitionBy("ch_number").orderBy("period_end", "filing_id")
    last = W.partitionBy("ch_number").orderBy(F.desc("period_end"), F.desc("filing_id"))
    figures = [f for f in TAGS.values() if f in filings.columns]
    prior = {f"p_{f}": F.lag(f).over(w) for f in (*figures, "period_end")}
    out = filings.withColumns(prior).withColumn("r", F.row_number().over(last)).filter("r = 1")
    return out.select("ch_number", "accounts_type", F.col("period_end").alias("accounts_date"), *[F.col(f).alias(f"c_{f}") for f in figures], *prior)


def growth(current: Column, prior: Column) -> Column:
    return F.when(prior != 0, percent(100.0 * (current - prior) / prior))


def net_assets_growth(df: DataFrame) -> DataFrame:
    return df.withColumn("net_assets_growth", growth(F.col("c_net_assets"), F.col("p_net_assets")))


def financial_label(df: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    net, up = F.col("c_net_assets"), F.col("net_assets_growth")
    label = (
        F.when(F.col("accounts_type") == "Dormant", "Dormant")
        .when(net.isNull(), "No-Data")
        .when(net < 0, "Insolvency-Flag")
        .when(net < cfg.thin_below, "Thin")
        .when(up >= cfg.growing_from, "Solvent-Growing")
        .otherwise("Solvent-Stable")
    )
    return df.withColumn("financial_label", label)


def verify_state(leads: DataFrame) -> DataFrame:
    """From the registration and company matches (fsa_id, ch_status)."""
    state = (
        F.when(F.col("ch_status") == "Dissolved", "rejected")
        .when(F.col("fsa_id").isNotNull() & F.col("ch_status").isNotNull(), "fsa_ch")
        .when(F.col("fsa_id").isNotNull(), "fsa_only")
        .otherwise("unverified")
    )
    return leads.withColumn("verify_state", state)


def confidence(leads: DataFrame) -> DataFrame:
    """Legitimacy: registration 50, company 30, rating 10, phone 10. Uniqueness: 100 less half the
    match percent, none at a match of a current customer."""
    part = lambda c, n: F.when(c, n).otherwise(0)
    legit = part(F.col("fsa_id").isNotNull(), 50) + part(F.col("ch_status") == "Active", 30) + part(F.col("hygiene") >= 3, 10) + part(F.col("phone").isNotNull(), 10)
    unique = F.when(F.col("match_class") == "active_match", 0).otherwise(100 - percent(F.coalesce("match_pct", F.lit(0)) / 2.0))
    return leads.withColumns({"legitimacy_pct": legit.cast("bigint"), "uniqueness_pct": unique.cast("bigint")})
