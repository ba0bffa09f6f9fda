"""Flat layout, field mappings, export batches and telesales rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name, kind and source column of the flat layout, in order. Kinds: s text, n number,
# d decimal of tenths, t date, y yes/no, p percent. A source of None stays empty: no landed table
# holds it (town, website, profile links of people, profile phone).
LAYOUT: tuple[tuple[str, str, str | None], ...] = (
    ("Lead_ID", "s", "lead_id"),
    ("Primary_Brand_Name", "s", "primary_brand"),
    ("All_Brand_Names", "s", "all_brands"),
    ("Brand_Count", "n", "brand_count"),
    ("Trading_Address", "s", "address"),
    ("Town", "s", None),
    ("Postcode", "s", "unit"),
    ("Outer_Code", "s", "district"),
    ("Inner_Code", "s", "sector"),
    ("Latitude", "s", "lat"),
    ("Longitude", "s", "lng"),
    ("Phone_Mobile_1", "s", "mobile_1"),
    ("Phone_Mobile_2", "s", "mobile_2"),
    ("Phone_Landline_1", "s", "landline_1"),
    ("Phone_Landline_2", "s", "landline_2"),
    ("Phone_Landline_3", "s", "landline_3"),
    ("Phone_Sources", "s", "sources"),
    ("Website_URL", "s", None),
    ("JustEat_URL", "s", "justeat_url"),
    ("UberEats_URL", "s", "ubereats_url"),
    ("Deliveroo_URL", "s", "deliveroo_url"),
    ("FSA_ID", "n", "fsa_id"),
    ("FSA_Operator_Name", "s", "operator_name"),
    ("FSA_Business_Type", "s", "business_type"),
    ("Hygiene_Rating", "n", "hygiene"),
    ("Last_Inspection_Date", "t", "last_inspection"),
    ("FSA_Registrations_At_Address", "n", "registrations"),
    ("CH_Company_Name", "s", "company_name"),
    ("CH_Number", "s", "ch_number"),
    ("CH_Status", "s", "ch_status"),
    ("Incorporation_Date", "t", "incorporated_on"),
    ("SIC_Code", "s", "sic_code"),
    ("Red_Flags", "s", "red_flags"),
    ("Director_1_Name", "s", "director_1"),
    ("Director_1_Role", "s", "director_1_role"),
    ("Director_1_LinkedIn", "s", None),
    ("Director_2_Name", "s", "director_2"),
    ("Director_2_Role", "s", "director_2_role"),
    ("Director_2_LinkedIn", "s", None),
    ("PSC_1_Name", "s", "psc_1"),
    ("PSC_1_LinkedIn", "s", None),
    ("Directors_Other_Food_Companies", "y", "other_flag"),
    ("Directors_Other_Companies_List", "s", "other_list"),
    ("Accounts_Type", "s", "accounts_type"),
    ("Accounts_Date", "t", "accounts_date"),
    ("c_Total_Assets", "n", "c_total_assets"),
    ("c_Fixed_Assets", "n", "c_fixed_assets"),
    ("c_Current_Assets", "n", "c_current_assets"),
    ("c_Cash_At_Bank", "n", "c_cash_at_bank"),
    ("c_Debtors", "n", "c_debtors"),
    ("c_Creditors", "n", "c_creditors"),
    ("c_Current_Liabilities", "n", "c_current_liabilities"),
    ("c_Net_Assets", "n", "c_net_assets"),
    ("p_Net_Assets", "n", "p_net_assets"),
    ("c_Equity", "n", "c_equity"),
    ("c_Turnover", "n", "c_turnover"),
    ("c_Gross_Profit", "n", "c_gross_profit"),
    ("c_Net_Profit", "n", "c_net_profit"),
    ("Employee_Count", "n", "c_employees"),
    ("Net_Assets_Growth", "p", "net_assets_growth"),
    ("Financial_Label", "s", "financial_label"),
    ("Platforms_Count", "n", "platforms_count"),
    ("JustEat_Rating", "d", "justeat_rating"),
    ("JustEat_Reviews", "n", "justeat_reviews"),
    ("UberEats_Rating", "d", "ubereats_rating"),
    ("UberEats_Reviews", "n", "ubereats_reviews"),
    ("Deliveroo_Rating", "d", "deliveroo_rating"),
    ("Deliveroo_Reviews", "n", "deliveroo_reviews"),
    ("Cuisine_Type", "s", "cuisines"),
    ("Multi_Brand_Flag", "y", "multi_brand"),
    ("Google_Place_ID", "s", "place_id"),
    ("Google_Rating", "d", "google_rating"),
    ("Google_Reviews", "n", "google_reviews"),
    ("Google_Phone", "s", "google_phone"),
    ("Google_Address", "s", "google_address"),
    ("Google_Lookup_Date", "t", "google_looked_up"),
    ("WhatsApp_Link_Number", "s", "whatsapp"),
    ("Website_Phone", "s", "website_phone"),
    ("Facebook_URL", "s", "facebook_url"),
    ("Facebook_Phone", "s", None),
    ("Days_Since_FSA_Registration", "n", "days_since_registration"),
    ("New_Business_Flag", "y", "new_business"),
    ("Recent_Ownership_Change_Flag", "y", "ownership_flag"),
    ("Ownership_Change_Date", "t", "changed_on"),
    ("Review_Trigger_Flag", "y", "review_flag"),
    ("Review_Trigger_Snippet", "s", "snippet"),
    ("Review_Trigger_Source", "s", "review_source"),
    ("Review_Trigger_Date", "t", "review_date"),
    ("Trigger_Score_Bonus", "n", "bonus"),
    ("Lead_Score", "n", "score"),
    ("Priority_Tier", "s", "tier"),
    ("Uniqueness_Pct", "p", "uniqueness_pct"),
    ("Legitimacy_Pct", "p", "legitimacy_pct"),
    ("Match_Flag_Colour", "s", "match_colour"),
    ("Matched_Account_Code", "s", "account_code"),
    ("Match_Pct", "p", "shown_match_pct"),
    ("Matched_Fields", "s", "shown_fields"),
    ("Score_Breakdown", "s", "breakdown"),
    ("Run_Date", "t", "run_date"),
    ("Search_Code", "s", "search_code"),
    ("Assigned_Rep", "s", "rep"),
    ("Lead_Status", "s", "lead_status"),
)


def _shown(kind: str, c: Column) -> Column:
    if kind == "y":
        return F.when(F.coalesce(c.cast("boolean"), F.lit(False)), "Yes").otherwise("No")
    if kind == "d":
        return F.when(c.isNotNull(), F.concat(F.floor(c / 10).cast("string"), F.lit("."), (c % 10).cast("string")))
    return c.cast("string")


def flatten_layout(leads: DataFrame) -> DataFrame:
    """The 102 columns in their order and formats from a table with one row per lead."""
    return leads.select(*[(_shown(kind, F.col(src)) if src else F.lit(None).cast("string")).alias(name) for name, kind, src in LAYOUT])


TRANSFORMS = {"upper": F.upper, "trim": F.trim, "none": lambda c: c, "digits": lambda c: F.regexp_replace(c, "[^0-9]", "")}


def mapped_snapshot(flat: DataFrame, mappings: DataFrame, key: str = "Lead_ID") -> DataFrame:
    """(key, mapped_values) for each row of the flat layout: one JSON object of the verified mappings'
    values, transformed by name, in order of field; a missing value is an empty text. A row is mapped
    by itself, so rows whose keys agree stay apart and none is shuffled."""
    names = [c for c in flat.columns if c != key]
    used = mappings.filter(F.col("is_verified") & F.col("internal_field").isin(names))
    rules = used.agg(F.array_sort(F.collect_list(F.struct("target_field", "internal_field", "transform"))).alias("_rules"))  # one row, a mapping per layout column at most

    def value(m: Column) -> Column:
        raw = F.lit(None).cast("string")
        for n in names:
            raw = F.when(m["internal_field"] == n, F.col(n).cast("string")).otherwise(raw)
        out = raw
        for t, f in TRANSFORMS.items():
            out = F.when(m["transform"] == t, f(raw)).otherwise(out)
        return F.coalesce(out, F.lit(""))

    pairs = F.transform("_rules", lambda m: F.struct(m["target_field"].alias("target_field"), value(m).alias("value")))
    return flat.crossJoin(F.broadcast(rules)).select(key, F.to_json(F.map_from_entries(pairs)).alias("mapped_values"))


def build_batch(leads: DataFrame, batch: Column) -> tuple[DataFrame, DataFrame]:
    """(items, batches): a lead at most once in a batch, and the count per batch."""
    items = leads.select(batch.alias("batch_id"), "lead_key").dropDuplicates(["batch_id", "lead_key"])
    return items, items.groupBy("batch_id").agg(F.count("*").alias("lead_count"))


def export_gate(batches: DataFrame, items: DataFrame, used: DataFrame, mappings: DataFrame) -> DataFrame:
    """Whether each batch may be exported: approved, not empty, and every mapping that it uses, one at
    least, is verified. used: (batch_id, internal_field); a field without a mapping is not verified."""
    known = mappings.select("internal_field", "is_verified")
    per = used.join(F.broadcast(known), "internal_field", "left").groupBy("batch_id").agg(F.bool_and(F.coalesce("is_verified", F.lit(False))).alias("verified"))
    n = items.groupBy("batch_id").agg(F.count("*").alias("items"))
    out = batches.join(n, "batch_id", "left").join(per, "batch_id", "left")
    verified = F.coalesce("verified", F.lit(False))
    ok = (F.col("status") == "approved") & (F.coalesce("items", F.lit(0)) > 0) & verified
    return out.select("batch_id", "status", F.coalesce("items", F.lit(0)).alias("items"), verified.alias("verified"), ok.alias("may_export"))


def telesales_rows(items: DataFrame, leads: DataFrame, contacts: DataFrame, approved: DataFrame, triggers: DataFrame, assigned_on: str) -> DataFrame:
    """Assignment rows for reps: allowed columns only, of approved batches, with a safe phone and the
    kinds of trigger; a new assignment is open, its lead new, and it has no notes yet."""
    rows = items.join(approved.select("batch_id"), "batch_id", "left_semi").join(leads, "lead_key").join(contacts.select("lead_key", F.col("phone").alias("safe_phone")), "lead_key", "left")
    why = triggers.groupBy("lead_key").agg(F.array_join(F.array_sort(F.collect_set("trigger_type")), ", ").alias("trigger_reason"))
    none = F.lit(None).cast("string")
    return rows.join(why, "lead_key", "left").select(
        "batch_id", "lead_key", F.col("primary_brand").alias("business_name"), F.col("address").alias("trading_address"), F.col("unit").alias("postcode"), "safe_phone", "tier", "rep",
        F.lit("new").alias("lead_status"), "trigger_reason", F.lit("open").alias("worked_status"), none.alias("outcome_notes"), F.lit(assigned_on).cast("date").alias("assigned_at"),
    )


def contamination(items: DataFrame, matches: DataFrame) -> DataFrame:
    """Items per set that are matches of current customers: none may be in an export."""
    bad = matches.filter("match_class = 'active_match'").select("lead_key", F.lit(1).alias("bad"))
    return items.join(bad, "lead_key", "left").groupBy("item_set").agg(F.count("*").alias("items"), F.count("bad").alias("contaminated"))


def apply_outcomes(assignments: DataFrame, updates: DataFrame) -> DataFrame:
    """Worked status, lead status and notes of a rep's own rows; other updates change nothing and are
    marked as rejected."""
    fields = ("worked_status", "lead_status", "outcome_notes")
    u = updates.select("lead_key", F.col("rep").alias("u_rep"), *[F.col(f).alias(f"u_{f}") for f in fields])
    out = assignments.join(u, "lead_key", "left")
    own = F.col("u_rep") == F.col("rep")
    made = [F.when(own, F.coalesce(f"u_{f}", f)).otherwise(F.col(f)).alias(f) for f in fields]
    return out.select("lead_key", "rep", *made, F.coalesce(F.col("u_rep").isNotNull() & ~own, F.lit(False)).alias("rejected"))
