"""Routes, ignored log, reactivation, expansion, reps and the decision trail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.config import DEFAULT, Config


def food_flag(leads: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Not food if the registration type is excluded or the company's SIC code is of another trade."""
    bad = F.coalesce(F.col("business_type").isin(list(cfg.not_food_types)), F.lit(False)) | F.coalesce(~F.col("sic_code").startswith(cfg.food_sic), F.lit(False))
    return leads.withColumn("is_food", ~bad)


def route(leads: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds route and reason: the first rule that applies."""
    out_of_area = F.col("membership") != "in_area"
    rules = [
        (F.col("match_class") == "active_match", "ignored", "ACTIVE_MATCH"),
        (F.col("match_class") == "inactive_match", "reactivation", "INACTIVE_MATCH"),
        (~F.col("is_food"), "ignored", "NOT_FOOD"),
        (F.col("verify_state") == "rejected", "ignored", "DISSOLVED"),
        (out_of_area & F.col("verify_state").isin("fsa_ch", "fsa_only"), "expansion", "HELD_OUT_OF_AREA"),
        (out_of_area, "ignored", "OUT_OF_AREA"),
        (F.col("fsa_id").isNull(), "manual_review", "NO_FSA"),
        (F.col("tier") == "Ignore", "ignored", "LOW_SCORE"),
    ]
    to, why = F.lit("export"), F.lit("OK")
    for test, r, reason in reversed(rules):
        to, why = F.when(test, r).otherwise(to), F.when(test, reason).otherwise(why)
    return leads.withColumn("route", to).withColumn("reason", why)


def ignored_log(routed: DataFrame) -> DataFrame:
    detail = (
        F.when(F.col("reason") == "ACTIVE_MATCH", F.format_string("%d%% match to active customer", "match_pct"))
        .when(F.col("reason") == "DISSOLVED", F.lit("Company at the address is dissolved"))
        .when(F.col("reason") == "OUT_OF_AREA", F.format_string("%s is outside the delivery area", "district"))
        .when(F.col("reason") == "NOT_FOOD", F.lit("Registration or trade code is not food"))
        .when(F.col("reason") == "LOW_SCORE", F.format_string("Score %d is below the lowest tier", "score"))
    )
    rows = routed.filter("route = 'ignored'")
    return rows.select("lead_key", "primary_brand", "unit", F.col("reason").alias("reason_code"), detail.alias("reason_detail"), F.when(F.col("reason") == "ACTIVE_MATCH", F.col("account_code")).alias("account_code"), "match_pct", "matched_fields", "ch_status")


def reactivation(routed: DataFrame, last_orders: DataFrame) -> DataFrame:
    rows = routed.filter("route = 'reactivation'").select("lead_key", "primary_brand", "account_code", "match_pct")
    return rows.join(last_orders, "account_code", "left").select("lead_key", "primary_brand", "account_code", "match_pct", "last_order")


def expansion(routed: DataFrame) -> DataFrame:
    return routed.filter("route = 'expansion'").select("lead_key", "primary_brand", "district", "membership", "verify_state", F.concat(F.lit("Held: "), F.col("district"), F.lit(" is "), F.col("membership")).alias("held_reason"))


def assign_reps(leads: DataFrame, districts: DataFrame, reps: list[str]) -> DataFrame:
    """Rep by district map (a bounded list of districts), else by lead number over the active reps."""
    spare = F.element_at(F.array(*map(F.lit, reps)), (F.pmod("premises_no", F.lit(len(reps))) + 1).cast("int"))
    out = leads.join(districts, "district", "left")
    return out.withColumn("rep", F.coalesce("rep", spare)).select("lead_key", "district", "rep")


def lead_trail(stages: list[tuple[int, str, DataFrame]]) -> DataFrame:
    """Long form of decisions; each stage has lead_key, value, reason."""
    rows = [df.select("lead_key", F.lit(i).cast("bigint").alias("step"), F.lit(n).alias("stage"), F.col("value").cast("string").alias("value"), F.col("reason").cast("string").alias("reason")) for i, n, df in stages]
    return reduce(lambda a, b: a.unionByName(b), rows)
