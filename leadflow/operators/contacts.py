"""Phones from all sources, contact slots, page contacts, paid lookups and gap filling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.functions.text import hmac_sha256, normal_phone, phone_kind

# Sources of numbers in order of trust.
PRIORITY = {"whatsapp": 1, "website": 2, "place": 3, "listing": 4, "customer": 5}


def collect_contacts(sources: dict[str, DataFrame]) -> DataFrame:
    """sources: name -> (lead_key, phone). One row per lead and number, best source kept."""
    rows = reduce(lambda a, b: a.unionByName(b), [df.select("lead_key", normal_phone(F.col("phone")).alias("phone"), F.lit(PRIORITY[s]).alias("priority"), F.lit(s).alias("source")) for s, df in sources.items()])
    rows = rows.filter("phone is not null").groupBy("lead_key", "phone").agg(F.min(F.struct("priority", "source")).alias("s"))
    return rows.select("lead_key", "phone", phone_kind(F.col("phone")).alias("kind"), "s.priority", "s.source")


def contact_slots(contacts: DataFrame) -> DataFrame:
    """Two mobiles and three landlines per lead by source priority, with a map of sources."""
    order = W.partitionBy("lead_key", "kind").orderBy("priority", "phone")
    r = contacts.withColumn("r", F.row_number().over(order)).filter("r <= case kind when 'mobile' then 2 else 3 end")
    slot = lambda kind, i: F.max(F.when((F.col("kind") == kind) & (F.col("r") == i), F.col("phone")))
    label = F.concat(F.when(F.col("kind") == "mobile", "M").otherwise("L"), F.col("r").cast("string"), F.lit("="), "source")
    return r.groupBy("lead_key").agg(
        slot("mobile", 1).alias("mobile_1"), slot("mobile", 2).alias("mobile_2"),
        slot("landline", 1).alias("landline_1"), slot("landline", 2).alias("landline_2"), slot("landline", 3).alias("landline_3"),
        F.array_join(F.array_sort(F.collect_list(label)), " | ").alias("sources"),
    )


def extract_page_contacts(pages: DataFrame) -> DataFrame:
    """(page_id, kind, value) of wa.me numbers, tel: links, mail links and profile links in a page."""
    patterns = {"whatsapp": r"wa\.me/\+?([0-9]{7,15})", "tel": r"""href=["']tel:([+0-9 ()-]{7,20})["']""", "mail": r"([A-Za-z0-9._]+@[A-Za-z0-9.]+\.com)", "profile": r"(facebook\.com/[A-Za-z0-9.]+)"}
    found = F.concat(*[F.transform(F.regexp_extract_all("html", F.lit(p), 1), (lambda k: lambda v: F.struct(F.lit(k).alias("kind"), v.alias("value")))(k)) for k, p in patterns.items()])
    return pages.select("page_id", F.explode(found).alias("x")).select("page_id", "x.kind", "x.value").distinct()


def safe_contact(contacts: DataFrame, suppressed: DataFrame, pepper: str) -> DataFrame:
    """One number per lead that is not on the suppression list (phone hashes, active entries)."""
    active = suppressed.filter("match_type = 'phone' and status = 'active'").select(F.col("match_hmac").alias("h")).distinct()
    ok = contacts.withColumn("h", hmac_sha256(F.col("phone"), pepper)).join(active, "h", "left_anti")
    order = W.partitionBy("lead_key").orderBy(F.when(F.col("kind") == "mobile", 0).otherwise(1), "priority", "phone")
    return ok.withColumn("r", F.row_number().over(order)).filter("r = 1").select("lead_key", "phone", "kind", "source")


def plan_paid_lookups(leads: DataFrame, cache: DataFrame, cap: float, unit_cost: float) -> DataFrame:
    """Leads with gaps that are not cached, in order of reviews, while the day's budget lasts.
    leads: (day, lead_key, reviews, has_gap). Ranks are made per day in buckets of reviews and
    shifted by the counts of the buckets before, so no task holds a whole day."""
    want = leads.filter("has_gap").join(cache.select("lead_key"), "lead_key", "left_anti")
    bucket = (F.floor(F.log2(F.col("reviews") + 1.0) * 4)).cast("int")
    want = want.withColumn("b", bucket)
    counts = want.groupBy("day", "b").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("day").orderBy(F.desc("b")).rowsBetween(W.unboundedPreceding, -1))
    shift = counts.withColumn("before", F.coalesce(before, F.lit(0))).drop("n")
    most = int(round(cap / unit_cost))
    within = W.partitionBy("day", "b").orderBy(F.desc("reviews"), "lead_key")
    ranked = want.withColumn("i", F.row_number().over(within)).join(shift, ["day", "b"])
    return ranked.withColumn("rank", (F.col("i") + F.col("before")).cast("bigint")).filter(F.col("rank") <= most).select("day", "lead_key", "reviews", "rank")


def apply_fallback(leads: DataFrame, lookups: DataFrame) -> DataFrame:
    """Fill missing phone, address and rating from looked-up records; both keyed by lead_key."""
    l = lookups.select("lead_key", *[F.col(c).alias(f"_{c}") for c in ("phone", "address", "rating")])
    out = leads.join(l, "lead_key", "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in ("phone", "address", "rating")}
    used = F.concat_ws(",", *[F.when(F.col(c).isNull() & F.col(f"_{c}").isNotNull(), c) for c in ("phone", "address", "rating")])
    return out.withColumn("filled", used).withColumns(filled).drop("_phone", "_address", "_rating")
