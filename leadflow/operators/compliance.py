"""Suppression, erasure, retention, audit and role views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadflow.functions.text import hmac_sha256, normal_phone
from leadflow.operators.territory import is_small

DENIED = "array<struct<reason:string,match_type:string,match_hmac:string>>"


def suppress(leads: DataFrame, listed: DataFrame, pepper: str) -> DataFrame:
    """Leads none of whose brand, phone or postcode is on the list (active entries)."""
    active = listed.filter("status = 'active'").select("match_type", "match_hmac").distinct()
    keys = F.array(F.struct(F.lit("brand").alias("match_type"), F.lower("primary_brand").alias("v")), F.struct(F.lit("phone").alias("match_type"), F.col("phone").alias("v")), F.struct(F.lit("postcode").alias("match_type"), F.col("unit").alias("v")))
    long = leads.select("lead_key", F.explode(keys).alias("k")).select("lead_key", "k.match_type", "k.v").filter("v is not null")
    hit = long.withColumn("match_hmac", hmac_sha256(F.col("v"), pepper)).join(active, ["match_type", "match_hmac"], "left_semi").select("lead_key").distinct()
    return leads.join(hit, "lead_key", "left_anti")


def block_erased(df: DataFrame, tombstones: DataFrame, subject: str, scope: str, pepper: str) -> DataFrame:
    t = tombstones.filter(F.col("scope") == scope).select(F.col("subject_hmac").alias("_h")).distinct()
    return df.withColumn("_h", hmac_sha256(F.col(subject), pepper)).join(t, "_h", "left_anti").drop("_h")


def listing_subjects(df: DataFrame) -> dict[str, Column]:
    """What a listing or lead is suppressed by: brand, phone and unit postcode in normal form."""
    brand = "primary_brand" if "primary_brand" in df.columns else "brand_name"
    return {"brand": F.lower(brand), "phone": normal_phone(F.col("phone")), "postcode": F.col("unit")}


def mark_denied(df: DataFrame, listed: DataFrame, tombstones: DataFrame, subjects: dict[str, Column], erased: Column, scope: str, pepper: str) -> DataFrame:
    """Adds `denied`: (reason, match_type, match_hmac) of every key of a row that is on the suppression
    list (active entries; subjects: match type -> value) or erased for the scope. Null keys match nothing."""
    active = listed.filter("status = 'active'").select("match_type", "match_hmac").distinct()
    gone = tombstones.filter(F.col("scope") == scope).select("subject_hmac").distinct()
    parts = [("suppressed", t, c, active.filter(F.col("match_type") == t).select(F.col("match_hmac"))) for t, c in subjects.items()]
    parts.append(("erased", scope, erased, gone.select(F.col("subject_hmac"))))
    small = is_small(active) and is_small(gone)
    out, marks = df, []
    for i, (reason, match_type, value, hashes) in enumerate(parts):
        key, hit = f"_deny{i}", f"_deny{i}_hit"
        hashes = hashes.toDF(key).withColumn(hit, F.lit(True))
        out = out.withColumn(key, hmac_sha256(value, pepper)).join(F.broadcast(hashes) if small else hashes, key, "left")
        marks.append(F.when(F.col(hit), F.struct(F.lit(reason).alias("reason"), F.lit(match_type).alias("match_type"), F.col(key).alias("match_hmac"))))
    return out.withColumn("denied", F.array_compact(F.array(*marks)).cast(DENIED)).select(*df.columns, "denied")


def removed_keys(marked: DataFrame, stage: str) -> DataFrame:
    """The record of a deny stage: rows removed by each key, by its hash and scope; no value is kept."""
    return marked.select(F.explode("denied").alias("d")).select("d.*").groupBy("reason", "match_type", "match_hmac").agg(F.count("*").alias("n")).withColumn("stage", F.lit(stage))


def hide_denied(df: DataFrame, columns: list[str], listed: DataFrame, tombstones: DataFrame, scope: str, pepper: str) -> DataFrame:
    """Empties the phone columns whose number is suppressed or erased; other numbers of the row stay."""
    out = df
    for c in columns:
        phone = normal_phone(F.col(c))
        out = mark_denied(out, listed, tombstones, {"phone": phone}, phone, scope, pepper)
        out = out.withColumn(c, F.when(F.size("denied") == 0, F.col(c))).drop("denied")
    return out


def retain(df: DataFrame, as_of: str, mode: str, personal: list[str], until: str = "retention_until") -> DataFrame:
    """mode purge: drop rows past their date; anonymise: empty their personal columns."""
    over = F.coalesce(F.col(until) < F.lit(as_of).cast("date"), F.lit(False))
    if mode == "purge":
        return df.filter(~over)
    return df.withColumns({c: F.when(~over, F.col(c)) for c in personal})


def _diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    cols = [c for c in before.columns if c != key]
    b = before.select(F.col(key).alias("_bk"), F.struct(*cols).alias("b"))
    a = after.select(F.col(key).alias("_ak"), F.struct(*cols).alias("a"))
    out = b.join(a, F.col("_bk") == F.col("_ak"), "full_outer")
    action = F.when(F.col("_bk").isNull(), "insert").when(F.col("_ak").isNull(), "delete").when(~F.col("a").eqNullSafe(F.col("b")), "update")
    return out.withColumn("action", action).filter("action is not null").withColumn("entity_id", F.coalesce("_ak", "_bk"))


def audit_safe(before: DataFrame, after: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Changed rows with the allowed columns before and after as JSON objects (null: no such row)."""
    shown = lambda side: F.when(F.col(side).isNotNull(), F.to_json(F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols]), {"ignoreNullFields": "false"}))
    return _diff(before, after, key).select("entity_id", "action", shown("b").alias("before"), shown("a").alias("after"))


def audit_min(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    return _diff(before, after, key).select("entity_id", "action")


def check_append_only(before: DataFrame, after: DataFrame, key: str, mode: str = "no_write") -> DataFrame:
    """Rows that broke the rule: changed or removed (no_write), removed (no_delete)."""
    bad = ["update", "delete"] if mode == "no_write" else ["delete"]
    return audit_min(before, after, key).filter(F.col("action").isin(bad))


# Who reads which rows of which tables. A rule is `all`, `own_rep` (rows of the reader's
# rep code) or `own_user` (the reader's own row); columns None are all of them. Roles and tables that are
# not listed see nothing; owner and admin see every table but the server-side ones.
MANAGED = (
    "app_settings integration_status road_display_configs map_assets uploaded_files customer_postcode_imports delivery_boundary_imports territory_sets territory_items "
    "delivery_boundaries delivery_boundary_items pipeline_runs run_territory_items run_coverage_units coverage_summary discovered_leads lead_brands lead_contacts registration_matches "
    "company_profiles company_financials platform_profiles lead_scores lead_triggers ignored_leads_audit reactivation_leads expansion_leads same_day_trigger_queue crm_field_mappings "
    "crm_export_batches crm_export_items telesales_assignments suppression_list"
).split()
SERVER_ONLY = ("existing_customers", "erasure_tombstones")
_ROW = "table string, role string, rule string, columns array<string>"


def policies() -> list[tuple]:
    """(table, role, rule, columns) of every pair of role and table that may read."""
    out: list[tuple] = []
    for role in ("owner", "admin"):
        out += [(t, role, "all", None) for t in [*MANAGED, "user_profiles", "audit_logs"]]
    out += [(t, "management", "all", None) for t in MANAGED]
    out += [("user_profiles", role, "own_user", None) for role in ("management", "telesales", "developer")]
    out.append(("telesales_assignments", "telesales", "own_rep", None))
    return out


def policy_table(spark) -> DataFrame:
    return spark.createDataFrame(policies(), _ROW)


def role_view(df: DataFrame, table: str, role: str, rep: str | None = None, user: str | None = None, policy: list[tuple] | None = None) -> DataFrame:
    """The rows and columns of a table that a role sees under a policy: the rules that apply become one
    filter (a row is seen if any rule shows it) and one projection (columns that any of them shows)."""
    rules = [(rule, cols) for t, r, rule, cols in (policies() if policy is None else policy) if t == table and r == role]
    if not rules or table in SERVER_ONLY:
        return df.limit(0)
    test = {
        "all": lambda: F.lit(True),
        "own_rep": lambda: F.coalesce(F.col("rep") == rep, F.lit(False)),
        "own_user": lambda: F.coalesce(F.col("user_id").cast("string") == user, F.lit(False)),
    }
    seen = reduce(lambda a, b: a | b, [test[rule]() for rule, _ in rules])
    shown = df.columns if any(cols is None for _, cols in rules) else [c for c in df.columns if any(c in cols for _, cols in rules)]
    return df.filter(seen).select(*shown)
