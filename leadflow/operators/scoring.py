"""Scores, tiers, ideal customers, recalibration and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.config import DEFAULT, Config
from leadflow.functions.text import percent

RULES = (("type", "multi", 8), ("type", "single", 4), ("area", "TW", 20), ("area", "UB", 15), ("area", "HA", 10), ("phone", "mobile", 15), ("size", "large", 28), ("size", "medium", 18), ("size", "small", 8), ("verified", "fsa_ch", 12), ("verified", "fsa_only", 6))


def size_proxy(leads: DataFrame) -> DataFrame:
    """Size by reviews (the fallback's where platform reviews are thin) and rating."""
    n = F.when(F.col("reviews") < 500, F.greatest("reviews", F.coalesce("place_reviews", F.lit(0)))).otherwise(F.col("reviews"))
    size = F.when((n >= 15000) & (F.col("rating_tenths") >= 30), "large").when(n >= 5000, "medium").otherwise("small")
    return leads.withColumn("size_class", size).withColumn("size_reviews", n.cast("bigint"))


def rule_table(spark) -> DataFrame:
    return spark.createDataFrame(list(RULES), "factor string, value string, points int")


def factors(leads: DataFrame) -> DataFrame:
    """Long form (lead_key, factor, value) of what the rules look at."""
    pair = lambda f, v: F.struct(F.lit(f).alias("factor"), v.alias("value"))
    made = F.array(
        pair("type", F.when(F.col("multi_brand"), "multi").otherwise("single")),
        pair("area", F.col("area")),
        pair("phone", F.when(F.col("phone").startswith("07"), "mobile").otherwise("landline")),
        pair("size", F.col("size_class")),
        pair("verified", F.col("verify_state")),
    )
    return leads.select("lead_key", F.explode(made).alias("x")).select("lead_key", "x.*")


def base_score(leads: DataFrame, rules: DataFrame) -> DataFrame:
    """Sum of points and a readable trail in order of factor."""
    hit = factors(leads).join(F.broadcast(rules), ["factor", "value"])  # the rule table is fixed and short
    line = F.struct("factor", F.concat(F.col("value"), F.lit(" +"), F.col("points").cast("string")).alias("t"))
    out = hit.groupBy("lead_key").agg(F.sum("points").alias("base"), F.array_sort(F.collect_list(line)).alias("l"))
    return leads.select("lead_key").join(out, "lead_key", "left").select("lead_key", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce(F.array_join(F.transform("l", lambda x: x["t"]), "; "), F.lit("")).alias("breakdown"))


def final_score(base: DataFrame, bonus: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    out = base.join(bonus, "lead_key", "left").withColumn("bonus", F.coalesce("bonus", F.lit(0)))
    out = out.withColumn("score", F.col("base") + F.col("bonus"))
    s = F.col("score")
    return out.withColumn("tier", F.when(s >= cfg.tier_a, "A").when(s >= cfg.tier_b, "B").when(s >= cfg.tier_low, "Low").otherwise("Ignore"))


def icp_customers(customers: DataFrame, orders: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Weekly spend and orders over the span of a customer's orders, and whether they fit."""
    o = orders.groupBy("customer_no").agg(F.sum("pence").alias("pence"), F.count("*").alias("orders"), F.min("day").alias("first"), F.max("day").alias("last"))
    weeks = F.greatest(F.lit(1.0), F.datediff("last", "first") / 7.0)
    out = customers.join(o, "customer_no").withColumn("weekly_spend", F.floor(F.col("pence") / 100.0 / weeks + 0.5).cast("bigint")).withColumn("weekly_orders_x100", percent(100.0 * F.col("orders") / weeks))
    fit = (F.col("weekly_spend") >= cfg.icp_weekly) & (F.col("weekly_orders_x100") >= 100 * cfg.icp_orders_a_week) & F.col("phone").isNotNull()
    return out.select("account_code", "orders", "weekly_spend", "weekly_orders_x100", fit.alias("fits"))


def recalibrate(scored: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Conversion and lift (percent of the overall rate) per factor value."""
    done = scored.join(outcomes, "lead_key")
    total = done.select("lead_key", "converted").distinct().agg((100.0 * F.count_if("converted") / F.count("*")).alias("rate"))
    per = done.groupBy("factor", "value").agg(F.count("*").alias("leads"), F.count_if("converted").alias("converted"))
    out = per.crossJoin(F.broadcast(total))  # one row
    return out.select("factor", "value", "leads", "converted", percent(100.0 * F.col("converted") / F.col("leads")).alias("conversion_pct"), F.when(F.col("rate") > 0, percent(10000.0 * F.col("converted") / F.col("leads") / F.col("rate"))).alias("lift_pct"))


def lifespans(customers: DataFrame, orders: DataFrame, as_of: str, churn_days: int = 180) -> DataFrame:
    o = orders.groupBy("customer_no").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    gone = F.datediff(F.lit(as_of).cast("date"), F.col("last")) > churn_days
    return customers.join(o, "customer_no").select("account_code", "rep_no", F.datediff("last", "first").cast("bigint").alias("days"), gone.alias("churned"))


def retention(spans: DataFrame) -> DataFrame:
    return spans.agg(F.count("*").alias("customers"), F.expr("percentile_disc(0.5) within group (order by days)").alias("median_days"), percent(100.0 * F.count_if("churned") / F.count("*")).alias("churn_pct"))


def churn_by_rep(spans: DataFrame) -> DataFrame:
    return spans.groupBy("rep_no").agg(F.count("*").alias("customers"), F.count_if("churned").alias("churned"), percent(100.0 * F.count_if("churned") / F.count("*")).alias("churn_pct"))
