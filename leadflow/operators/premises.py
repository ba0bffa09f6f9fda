"""Premises, brands, platforms and lead ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.functions.text import address_key, with_postcode_parts

PLATFORMS = ("justeat", "ubereats", "deliveroo")


def with_address_key(df: DataFrame) -> DataFrame:
    return df.withColumn("address_key", address_key(F.col("address")))


def with_keys(listings: DataFrame) -> DataFrame:
    """Postcode parts, address key and `solo`: the listing's own id where address or postcode is
    missing or malformed, so that such listings are not taken for one premises."""
    keyed = listings if {"unit", "address_key"} <= set(listings.columns) else with_address_key(with_postcode_parts(listings))
    unknown = F.col("unit").isNull() | (F.coalesce("address_key", F.lit("")) == "")
    return keyed.withColumn("solo", F.when(unknown, F.col("listing_id")))


def group_premises(listings: DataFrame) -> DataFrame:
    """One row per address key and unit postcode; listings without either stand alone."""
    best = F.struct("reviews", (-F.col("listing_id")).alias("first"))
    brands = F.array_sort(F.collect_set("brand_name"))
    extra = [F.array_join(F.array_sort(F.collect_set("cuisine_type")), " | ").alias("cuisines")] if "cuisine_type" in listings.columns else []
    extra += [F.max_by("run_no", best).alias("run_no")] if "run_no" in listings.columns else []
    grouped = with_keys(listings).groupBy("address_key", "unit", "sector", "district", "area", "solo").agg(
        F.max_by("brand_name", best).alias("primary_brand"),
        F.max_by("address", best).alias("address"),
        F.max_by("premises_no", best).alias("premises_no"),
        F.array_join(brands, " | ").alias("all_brands"),
        F.size(F.collect_set("brand_name")).cast("bigint").alias("brand_count"),
        F.size(F.collect_set("platform")).cast("bigint").alias("platforms_count"),
        F.sum("reviews").alias("reviews"),
        F.max("rating_tenths").alias("rating_tenths"),
        F.max_by("phone", best).alias("phone"),
        F.count("*").alias("listings"),
        *extra,
    )
    key = F.concat(F.coalesce("address_key", F.lit("")), F.lit("|"), F.coalesce("unit", F.lit("")), F.coalesce(F.concat(F.lit("|#"), F.col("solo").cast("string")), F.lit("")))
    return grouped.withColumns({"multi_brand": F.col("brand_count") > 1, "lead_key": key}).drop("solo")


def split_multi_tenant(premises: DataFrame, registrations: DataFrame) -> DataFrame:
    """One lead per registration where an address has more than one, else one per premises."""
    regs = with_address_key(with_postcode_parts(registrations)).select("address_key", "unit", "fsa_id")
    n = regs.groupBy("address_key", "unit").agg(F.count("*").alias("registrations"))
    many = n.filter("registrations > 1").join(regs, ["address_key", "unit"]).select("address_key", "unit", F.col("fsa_id").alias("tenant"))
    out = premises.join(n, ["address_key", "unit"], "left").join(many, ["address_key", "unit"], "left")
    return out.withColumn("registrations", F.coalesce("registrations", F.lit(0)))


def leads_of(premises: DataFrame, registrations: DataFrame) -> DataFrame:
    """The leads of a run: premises, split by tenant where several are registered at the address. The
    lead key of a tenant names its registration; premises_key is the key of the premises."""
    split = split_multi_tenant(premises, registrations).drop("registrations").withColumn("premises_key", F.col("lead_key"))
    return split.withColumn("lead_key", F.concat("lead_key", F.coalesce(F.concat(F.lit("|T"), F.col("tenant").cast("string")), F.lit(""))))


def assign_lead_id(leads: DataFrame, prefix: str) -> DataFrame:
    """PREFIX-AREA-00001 in order of sector, address and tenant. Numbers are made per sector and
    shifted by the count of the sectors before it, so no task holds a whole area. Leads without a
    sector have ids, too: area ZZ, in groups by a hash of their key."""
    area, sector = F.coalesce("area", F.lit("ZZ")), F.coalesce("sector", F.concat(F.lit("~"), F.substring(F.md5("lead_key"), 1, 2)))
    keyed = leads.withColumns({"_area": area, "_sector": sector})
    own = W.partitionBy("_area", "_sector").orderBy("unit", "address_key", "lead_key", F.coalesce("tenant", F.lit(0)))
    counts = keyed.groupBy("_area", "_sector").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_area").orderBy("_sector").rowsBetween(W.unboundedPreceding, -1))
    shift = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    out = keyed.withColumn("_i", F.row_number().over(own)).join(shift, ["_area", "_sector"])
    number = F.lpad((F.col("_i") + F.col("_before")).cast("string"), 5, "0")
    return out.withColumn("lead_id", F.concat_ws("-", F.lit(prefix), "_area", number)).drop("_i", "_before", "_area", "_sector")


def lead_brands(leads: DataFrame) -> DataFrame:
    b = leads.select("address_key", "unit", "primary_brand", F.posexplode(F.split("all_brands", " \\| ")).alias("pos", "brand"))
    return b.select("address_key", "unit", F.col("pos").cast("bigint").alias("pos"), "brand", (F.col("brand") == F.col("primary_brand")).alias("is_primary"))


def platform_profiles(listings: DataFrame) -> DataFrame:
    """Per premises and platform: best rating, most reviews, and the link of the first listing."""
    extra = [F.min_by("url", "listing_id").alias("url")] if "url" in listings.columns else []
    return with_keys(listings).filter("solo is null").groupBy("address_key", "unit", "platform").agg(F.max("rating_tenths").alias("rating"), F.max("reviews").alias("reviews"), F.min("listing_id").alias("first_listing"), *extra)


def pivot_platforms(profiles: DataFrame) -> DataFrame:
    shown = [c for c in ("rating", "reviews", "url") if c in profiles.columns]
    return profiles.groupBy("address_key", "unit").pivot("platform", list(PLATFORMS)).agg(*[F.first(c).alias(c) for c in shown])


def unpivot_platforms(wide: DataFrame) -> DataFrame:
    """Back to long form; absent platforms are dropped."""
    pairs = [F.struct(F.lit(p).alias("platform"), F.col(f"{p}_rating").alias("rating"), F.col(f"{p}_reviews").alias("reviews")) for p in PLATFORMS]
    return wide.select("address_key", "unit", F.explode(F.array(*pairs)).alias("x")).select("address_key", "unit", "x.*").filter("rating is not null or reviews is not null")
