"""Operators on inline rows, invariants of a run, streaming and plans."""

import datetime as dt
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries as entry_queries
from leadflow.functions.text import hmac_sha256, normal_phone, with_postcode_parts
from leadflow.operators import accounts, compliance, contacts, export, matching, premises, quality, reporting, routing, territory, triggers
from leadflow.plans.leads import TABLES, LeadRun, lead_run
from leadflow.sources import files
from leadflow.streaming import same_day

SF = "/root/testdata/sf0.001"


def test_layout_has_102_columns():
    assert len(export.LAYOUT) == 102 and len({n for n, _, _ in export.LAYOUT}) == 102


def test_premises_ties_and_nulls(spark):
    rows = [(2, 1, "justeat", "B", "1 High St", "TW3 4AS", "07", 5, 10), (1, 1, "ubereats", "A", "1 HIGH street", "tw3 4as", "07", 5, 20), (3, 2, "justeat", "C", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "listing_id bigint, premises_no bigint, platform string, brand_name string, address string, postcode string, phone string, reviews bigint, rating_tenths bigint")
    got = {r.premises_no: r for r in premises.group_premises(df).collect()}
    assert got[1].primary_brand == "A" and got[1].all_brands == "A | B" and got[1].brand_count == 2 and got[1].multi_brand
    assert got[2].unit is None
    assert premises.group_premises(df.limit(0)).count() == 0


def test_lead_ids_count_on_over_sectors(spark):
    rows = [("k", f"TW3 {s}AA", f"TW3 {s}", "TW", str(i)) for s in (1, 2) for i in range(3)]
    df = spark.createDataFrame(rows, "x string, unit string, sector string, area string, address_key string").withColumn("lead_key", F.col("address_key")).withColumn("tenant", F.lit(None).cast("bigint"))
    ids = [r.lead_id for r in premises.assign_lead_id(df, "LD").orderBy("sector", "address_key").collect()]
    assert ids == [f"LD-TW-{i:05d}" for i in range(1, 7)]


def test_huge_sectors_keep_all_pairs(spark):
    l = spark.createDataFrame([(f"l{i}", "S 1", f"S 1A{i % 2}", f"p{i}", f"a{i}") for i in range(300)], "lead_key string, sector string, unit string, phone string, address_key string")
    c = spark.createDataFrame([(f"c{i}", "S 1", f"S 1A{i % 2}", f"q{i}", f"b{i}") for i in range(200)], "account_code string, sector string, unit string, phone string, address_key string")
    assert matching.block(l, c).count() == 60_000
    assert matching.block_sizes(l, c, "sector").head().pairs == 60_000


def test_malformed_codes_stay_apart_and_have_ids(spark):
    rows = [(i, 1, "justeat", "B", None, "N/A", "07", 5, 10) for i in range(3)] + [(9, 2, "justeat", "C", "1 High St", "TW3 4AS", "07", 5, 10)]
    df = spark.createDataFrame(rows, "listing_id bigint, premises_no bigint, platform string, brand_name string, address string, postcode string, phone string, reviews bigint, rating_tenths bigint")
    ids = premises.assign_lead_id(premises.group_premises(df).withColumn("tenant", F.lit(None).cast("bigint")), "LD").collect()
    assert len({r.lead_id for r in ids}) == len({r.lead_key for r in ids}) == 4 and sum("-ZZ-" in r.lead_id for r in ids) == 3


def test_gate_needs_every_mapping_verified(spark):
    batches = spark.createDataFrame([(k, "approved") for k in range(4)], "batch_id int, status string")
    items = spark.createDataFrame([(k, f"l{k}") for k in range(3)], "batch_id int, lead_key string")
    used = spark.createDataFrame([(0, "a"), (1, "a"), (1, "b"), (3, "a")], "batch_id int, internal_field string")
    maps = spark.createDataFrame([("a", True), ("b", False)], "internal_field string, is_verified boolean")
    assert {r.batch_id: r.may_export for r in export.export_gate(batches, items, used, maps).collect()} == {0: True, 1: False, 2: False, 3: False}


def test_a_failed_run_goes_on_where_it_stopped(spark, tmp_path):
    star, folder = lead_run(spark, SF), str(tmp_path / "run")
    tables = {name: star.table(name) for name in TABLES}
    broken = {**tables, "registrations": tables["registrations"].withColumn("operator_name", F.raise_error(F.lit("lost")).cast("string"))}
    first = LeadRun(spark, broken, pepper=star.pepper, resume=folder)
    first.__dict__["inputs"] = "same"  # the failure is the machine's, not the table's
    with pytest.raises(Exception, match="lost"):
        _ = first.routed
    failed = [e["stage"] for e in first.log if e["failure"]]
    assert failed == ["registrations"] and {"keyed", "marked", "territory", "leads"} <= set(first.stage_map)
    second = LeadRun(spark, tables, pepper=star.pepper, resume=folder)
    second.__dict__["inputs"] = "same"
    n = second.routed.count()
    over = {e["stage"] for e in second.log if e["taken_over"]}
    assert "leads" in over and not {"registrations", "routed"} & over
    for stage, count in second.stage_map.items():
        assert spark.read.parquet(f"{folder}/{stage}").count() == count
    got = second.telemetry({"routed": 0.5}).collect()
    assert [(r.stage, r.n) for r in got] == [(e["stage"], e["n"]) for e in second.log] and sum(r.cost for r in got) == 0.5
    third = LeadRun(spark, tables, pepper="other", resume=folder)  # another pepper: nothing is taken over
    assert third.territory.count() and not third.log[-1]["taken_over"]
    again = LeadRun(spark, tables, pepper="other", resume=folder)
    assert again.territory.count() and again.log[-1]["taken_over"] and n == star.routed.count()
    row = reporting.stage_maps(first.telemetry()).head()
    assert row.stages == first.stage_map and row.failed == len(failed)


def test_filing_facts_of_any_form(spark):
    body = """<ix:nonFraction contextRef='current' scale="3" name="uk:Debtors"> 1,234 </ix:nonFraction><ix:nonFraction name="uk:Equity" sign="-" contextRef="prior">7.5</ix:nonFraction><ix:nonFraction name="uk:Unknown" contextRef="current">1</ix:nonFraction><ix:nonFraction name="uk:Turnover" contextRef="current">-</ix:nonFraction>"""
    got = {r.tag: (r.current, r.prior) for r in accounts.extract_filing_facts(spark.createDataFrame([(1, body), (2, None), (3, "")], "filing_id int, body string")).collect()}
    assert {k: tuple(None if x is None else float(x) for x in v) for k, v in got.items()} == {"Debtors": (1234000.0, None), "Equity": (None, -7.5), "Turnover": (None, None)}


def test_match_percent_golden(spark):
    l = spark.createDataFrame([("k", "abcdefg", "07", "TW3 4AS")], "lead_key string, primary_brand string, phone string, unit string")
    c = spark.createDataFrame([("A1", "abcdexy", "active", "07", "TW3 4AS")], "account_code string, name string, status string, phone string, unit string")
    r = matching.score_pairs(spark.createDataFrame([("k", "A1")], "lead_key string, account_code string"), l, c).head()
    assert r.name_score == 71 and r.match_pct == 88 and r.matched_fields == "Phone exact, Postcode exact, Name 71%"


def test_page_contacts(spark):
    d = spark.createDataFrame([(1, '<a href="https://wa.me/447700900123">x</a><a href="tel:+44 20 8555 1234">'), (2, None), (3, "")], "page_id int, html string")
    assert sorted(map(tuple, contacts.extract_page_contacts(d).collect())) == [(1, "tel", "+44 20 8555 1234"), (1, "whatsapp", "447700900123")]


def test_territory_of_mixed_items(spark):
    items = spark.createDataFrame([("pasted_list", "tw3; UB1 1,\nbad!", None, False), ("expansion_list", None, "f", True)], "item_type string, value string, source_file_id string, is_expansion boolean")
    codes = spark.createDataFrame([("f", "TW3"), ("g", "HA1")], "file_id string, code string")
    assert sorted(map(tuple, territory.resolve_territory(items, codes).collect())) == [("TW3", "district", True), ("UB1 1", "sector", False)]


def test_quality(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "k int, v string")
    once = quality.append_new(old, new, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c")] == sorted(map(tuple, quality.append_new(once, new, ["k"]).collect()))
    assert compliance.check_append_only(old, new.filter("k = 2"), "k", "no_delete").count() == 1
    assert quality.check_unique(new, ["k"]).count() == 1


def test_role_views(spark):
    d = spark.createDataFrame([("l", "R1"), ("m", "R2")], "lead_key string, rep string")
    assert compliance.role_view(d, "telesales_assignments", "telesales", "R1").count() == 1
    users = spark.createDataFrame([("u1", "management"), ("u2", "owner")], "user_id string, role string")
    assert [compliance.role_view(users, "user_profiles", role, user="u1").count() for role in ("owner", "management", "developer", "telesales")] == [2, 1, 1, 1]
    assert compliance.role_view(d, "existing_customers", "owner").count() == 0
    assert compliance.role_view(d, "discovered_leads", "developer").count() == 0
    assert compliance.role_view(d, "audit_logs", "management").count() == 0 and compliance.role_view(d, "audit_logs", "owner").count() == 2


def test_search_is_case_blind_and_all_is_no_facet(spark):
    d = spark.createDataFrame([("LD-1041", "UB1 1AA", "A"), ("LD-1049", "ub1 2BB", "B"), ("LD-1", None, "A")], "id string, postcode string, tier string")
    assert reporting.search(d, "ub1", ["id", "postcode"], ("tier", "All")).count() == 2
    assert reporting.search(d, "ub1", ["id", "postcode"], ("tier", "B")).count() == 1
    assert reporting.search(d, " ", ["id"]).count() == 3


def test_run_invariants(spark):
    run = lead_run(spark, SF)
    routed = run.routed.select("lead_key", "route", "match_class", "unit").cache()
    assert routed.count() == run.leads.count() == routed.select("lead_key").distinct().count()
    assert routed.filter("route = 'export' and match_class = 'active_match'").count() == 0
    units, summary = run.units, run.summary
    assert units.agg(F.sum("found")).head()[0] == summary.agg(F.sum("found")).head()[0] == 4 * routed.filter("unit is not null").count()
    codes = {r.code for r in run.territory.collect()}
    assert {r.district for r in run.leads.select("district").distinct().collect()} <= codes
    gaps = summary.filter("runs = 0")
    assert gaps.count() > 0 and gaps.join(run.boundary, ["code", "granularity"], "left_anti").count() == 0


def test_plans_stay_native_and_without_cartesian_products(spark):
    plan = lead_run(spark, SF).best._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_files(spark, tmp_path):
    row = {"listing_id": 1, "platform": None, "brand_name": "B", "address": "a", "postcode": "p", "phone": "1", "reviews": 2, "rating_tenths": 3, "listed_on": "2020-01-02"}
    (tmp_path / "a.json").write_text(json.dumps(row) + "\n")
    (tmp_path / "b.csv").write_text("listing_id,platform,brand_name,address,postcode,phone,reviews,rating_tenths,listed_on\n2,,C,a,p,1,2,3,2020-01-02\n")
    got = files.load_listings(spark, {"justeat": str(tmp_path / "a.json"), "ubereats": str(tmp_path / "b.csv")})
    assert sorted((r.listing_id, r.platform) for r in got.collect()) == [(1, "justeat"), (2, "ubereats")]
    (tmp_path / "c.csv").write_text("account_code,name,address,postcode,phone,status,rep_no\nA1,n,a,p,1,active,2\nA2,n,a,p,1,active,xx\n")
    got = files.load_customers(spark, str(tmp_path / "c.csv")).collect()
    assert [r._corrupt is not None for r in got] == [False, True]
    assert files.file_manifest(spark, str(tmp_path / "*.csv")).count() == 2


def test_outputs_are_replaced_by_run(spark, tmp_path):
    d = spark.createDataFrame([(1,)], "x int")
    for _ in range(2):
        files.write_outputs({"crm": d, "ignored": d}, str(tmp_path), 7)
    files.write_outputs({"ignored": d}, str(tmp_path), 8)
    assert spark.read.parquet(str(tmp_path / "ignored")).count() == 2


STREAM = "lead_no bigint, trigger_type string, ts timestamp"


def land(spark, path, rows):
    spark.createDataFrame(rows, STREAM).coalesce(1).write.mode("append").parquet(str(path))


def test_stream_is_the_same_in_one_batch_and_in_many(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    rows = [(i % 5, f"t{i % 3}", base + dt.timedelta(hours=7 * (i // 2))) for i in range(60)]
    want = {}
    for lead, kind, ts in rows:
        first, n = want.get((ts.date(), lead), ((ts, kind), 0))
        want[ts.date(), lead] = (min(first, (ts, kind)), n + 1)
    for name, files_per_batch in (("one", 100), ("many", 1)):
        src = tmp_path / f"in-{name}"
        for k in range(4):
            land(spark, src, rows[15 * k : 15 * k + 15])
        land(spark, src, [(99, "end", base + dt.timedelta(days=60)), (None, "x", base), (1, "x", None)])
        out = same_day.run_once(spark, str(src), spark.read.parquet(str(src)).schema, str(tmp_path / name), files_per_batch)
        assert {(r.day, r.lead_no): ((r.first_ts, r.trigger_type), r.n) for r in out.collect()} == want
        again = same_day.run_once(spark, str(src), spark.read.parquet(str(src)).schema, str(tmp_path / name), files_per_batch)
        assert again.count() == len(want)


def test_stream_drops_late_signals(spark, tmp_path):
    base, src = dt.datetime(2024, 1, 1, 12), tmp_path / "in"
    run = lambda: same_day.run_once(spark, str(src), spark.read.parquet(str(src)).schema, str(tmp_path / "q"))
    land(spark, src, [(1, "a", base), (2, "a", base + dt.timedelta(days=5))])
    assert [(r.lead_no, r.n) for r in run().collect()] == [(1, 1)]
    land(spark, src, [(1, "late", base + dt.timedelta(hours=1)), (3, "late", base + dt.timedelta(days=2)), (2, "b", base + dt.timedelta(days=5, hours=-1)), (9, "end", base + dt.timedelta(days=9))])
    assert sorted((r.lead_no, r.trigger_type, r.n) for r in run().collect()) == [(1, "a", 1), (2, "b", 2)]


def test_append_batch_is_idempotent(spark, tmp_path):
    write = same_day.append_batch(str(tmp_path / "q"), ["k"], "k")
    d = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    write(d, 0)
    write(d, 0)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2


def test_urgency_and_triggers(spark):
    d = spark.createDataFrame([(1, "a", "2024-01-30 10:00:00"), (1, "b", "2024-01-01 10:00:00"), (None, "c", "2024-01-30 10:00:00")], "lead_no int, trigger_type string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert [tuple(r) for r in triggers.same_day_queue(d, "2024-01-31").collect()] == [(1, "a", 1, "high")]


def test_reps_fall_back_by_number(spark):
    leads = spark.createDataFrame([("a", "TW3", 4), ("b", "XX1", 4)], "lead_key string, district string, premises_no bigint")
    m = spark.createDataFrame([("TW3", "T")], "district string, rep string")
    assert sorted((r.lead_key, r.rep) for r in routing.assign_reps(leads, m, ["r1", "r2", "r3"]).collect()) == [("a", "T"), ("b", "r2")]


CUSTOMERS = "account_code string, name string, status string, phone string, address string, postcode string"
LEADS = "lead_key string, primary_brand string, phone string, address string, postcode string"


def keyed(df):
    return premises.with_address_key(with_postcode_parts(df))


def test_best_customers_are_those_of_all_pairs(spark):
    rnd = random.Random(5)
    words = ["golden", "royal", "grill", "pizza", "kebab", "spice", "house", "the", "golden  grill", "gril"]
    name = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 4))).title()
    where = lambda: (f"{rnd.randrange(1, 4)} High St", rnd.choice(["TW3 4AA", "TW3 4AB", "TW3 5AA", "UB1 1AA", None]))
    phone = lambda: rnd.choice([None, *[f"07{i}" for i in range(30)]])
    cust = keyed(spark.createDataFrame([(f"A{i:03d}", name(), rnd.choice(["active", "inactive"]), phone(), *where()) for i in range(120)], CUSTOMERS))
    leads = keyed(spark.createDataFrame([(f"k{i}", name(), phone(), *where()) for i in range(80)], LEADS))
    want = matching.best_match(matching.score_pairs(matching.block(leads, cust), leads, cust))
    cols = ["lead_key", "account_code", "status", "name_score", "match_pct", "matched_fields"]
    got = matching.best_customers(leads, cust)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_best_customers_in_one_sector_compare_few_pairs(spark):
    names = [f"Shop {a} {b}" for a in ("grill", "pizza", "kebab", "wings") for b in ("one", "two", "three")]
    compared = {}
    for n in (400, 1600):
        cust = keyed(spark.createDataFrame([(f"A{i:05d}", names[i % 12], "active", f"07{i}", f"{i} High St", "TW3 4AA") for i in range(n)], CUSTOMERS)).withColumn("unit", F.lit(None).cast("string"))
        leads = keyed(spark.createDataFrame([(f"k{i}", names[(i * 5) % 12] + ("" if i % 2 else "s"), f"07{3 * i}", f"{i} Low St", "TW3 4AA") for i in range(n)], LEADS)).withColumn("unit", F.lit(None).cast("string"))
        counts = {}
        assert matching.best_customers(leads, cust, counts=counts).count() == n
        compared[n] = sum(df.head()[0] or 0 for df in counts.values())
    assert compared[1600] <= 4.5 * compared[400] and compared[1600] < 5 * 1600  # all pairs: 2,560,000


def test_hot_sectors_are_dealt_and_stay_whole(spark):
    c = spark.createDataFrame([(f"A{i}", "S1" if i % 10 else "S2") for i in range(100)], "account_code string, c_sector string")
    l = spark.createDataFrame([(f"k{i}", "S1" if i % 2 else "S2") for i in range(20)], "lead_key string, sector string")
    got = matching.sector_pairs(l, c, part=20)
    assert got.count() == got.select("lead_key", "account_code").distinct().count() == 10 * 90 + 10 * 10


def test_deny_stage_keeps_hashes_only(spark):
    rows = spark.createDataFrame([(1, "Brand A", "07 1", "TW3 4AA"), (2, "Brand B", "+447000000001", "TW3 4AB"), (3, "Brand C", "072", "TW3 4AC"), (4, None, None, None), (5, "brand a", "073", None)], "id int, brand_name string, phone string, unit string")
    h = lambda v: hmac_sha256(F.lit(v), "p")
    listed = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(t).alias("match_type"), h(v).alias("match_hmac"), F.lit(s).alias("status")) for t, v, s in (("brand", "brand a", "active"), ("phone", "07000000001", "active"), ("postcode", "TW3 4AC", "withdrawn"))])).alias("x")).select("x.*")
    stones = spark.range(1).select(h("073").alias("subject_hmac"), F.lit("import").alias("scope"))
    m = compliance.mark_denied(rows, listed, stones, compliance.listing_subjects(rows), normal_phone(F.col("phone")), "import", "p")
    assert {r.id: sorted((d.reason, d.match_type) for d in r.denied) for r in m.collect()} == {1: [("suppressed", "brand")], 2: [("suppressed", "phone")], 3: [], 4: [], 5: [("erased", "import"), ("suppressed", "brand")]}
    log = compliance.removed_keys(m, "head").collect()
    assert {(r.match_type, r.n) for r in log} == {("brand", 2), ("phone", 1), ("import", 1)} and all(len(r.match_hmac) == 64 for r in log)
    assert compliance.mark_denied(rows, listed, stones, {}, normal_phone(F.col("phone")), "marketing", "p").filter(F.size("denied") > 0).count() == 0
    hidden = compliance.hide_denied(rows.select("id", "phone"), ["phone"], listed, stones, "import", "p")
    assert {r.id: r.phone for r in hidden.collect()} == {1: "07 1", 2: None, 3: "072", 4: None, 5: None}


def test_no_denied_key_in_any_output(spark):
    out = entry_queries()["outputs_roundtrip"](spark, SF)
    assert {r.output for r in out.collect()} == {"crm", "ignored_log", "reactivation", "expansion", "telemetry"}
    run = lead_run(spark, SF)
    hashes = {r.match_hmac for r in run.table("suppression").filter("status = 'active'").collect()} | {r.subject_hmac for r in run.table("tombstones").filter("scope = 'import'").collect()}
    assert hashes and run.removed.count() > 0
    for name in ("crm", "ignored_log", "reactivation", "expansion", "telemetry"):
        if not list(pathlib.Path(run.work.removeprefix("file:"), "outputs", name).rglob("*.parquet")):
            assert name == "crm"  # no batch may leave on the smallest tables
            continue
        df = spark.read.parquet(f"{run.work}/outputs/{name}")
        words = df.select(F.explode(F.split(F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns]), r"[^0-9+]+")).alias("w")).distinct()
        units = df.select(F.explode(F.regexp_extract_all(F.concat_ws(" ", *[F.col(c).cast("string") for c in df.columns]), F.lit("[A-Z]{1,2}[0-9]{1,2} [0-9][A-Z]{2}"), 0)).alias("w")).distinct()
        seen = words.unionByName(units).select(hmac_sha256(normal_phone(F.col("w")), run.pepper).alias("a"), hmac_sha256(F.col("w"), run.pepper).alias("b")).collect()
        assert not hashes & {x for r in seen for x in r}


def test_a_run_over_landed_files(spark, tmp_path):
    star, base = lead_run(spark, SF), tmp_path / "landed"
    for platform in premises.PLATFORMS:
        star.table("listings").filter(F.col("platform") == platform).write.parquet(str(base / f"listings/{platform}.parquet"))
    star.table("customers").select("account_code", "name", "address", "postcode", "phone", "status", "rep_no").write.option("header", True).csv(str(base / "customers.csv"))
    for name in TABLES:
        if name not in ("listings", "customers"):
            star.table(name).write.parquet(str(base / f"{name}.parquet"))
    run = LeadRun(spark, files.landed(spark, str(base)), pepper=star.pepper)
    cols = ["lead_key", "route", "reason", "score", "tier", "membership", "account_code", "match_pct", "fsa_id", "ch_number"]
    assert sorted(map(repr, run.routed.select(cols).collect())) == sorted(map(repr, star.routed.select(cols).collect()))
    run.release()


def test_tenants_of_one_address_are_leads_of_their_own(spark):
    p = keyed(spark.createDataFrame([("a|u", "1 High St", "TW3 4AA", "B")], "lead_key string, address string, postcode string, primary_brand string"))
    regs = spark.createDataFrame([(i, f"op{i}", "1 High Street", "TW3 4AA", "x", 5, 10) for i in (7, 8)], "fsa_id bigint, operator_name string, address string, postcode string, business_type string, hygiene int, days_since_registration int")
    leads = premises.leads_of(p, regs)
    got = matching.match_registrations(leads, regs)
    assert sorted((r.lead_key, r.fsa_id, r.registrations) for r in got.collect()) == [("a|u|T7", 7, 2), ("a|u|T8", 8, 2)]
    assert {r.premises_key for r in leads.collect()} == {"a|u"}


def test_merged_coverage_equals_a_rebuild(spark):
    unit = lambda run, code, n: (run, code, "district", n, 1, 1, 0)
    schema = "run_no bigint, code string, granularity string, found bigint, ignored bigint, exported bigint, reactivation bigint"
    parts = [[unit(1, "TW3", 5), unit(1, "UB1", 2)], [unit(2, "TW3", 7)], [unit(3, "HA1", 1), unit(2, "TW3", 9)]]
    frames = [spark.createDataFrame(p, schema) for p in parts]
    runs = spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in (1, 2, 3)], "run_no bigint, last_day date")
    boundary = spark.createDataFrame([("TW3", "district", "in_area"), ("ZZ9", "district", "in_area"), ("HA1", "district", "expansion")], "code string, granularity string, membership string")
    first = reporting.rebuild_summary(frames[0], runs, boundary)
    second = reporting.merge_summary(first, frames[0], frames[1], runs, boundary)
    third = reporting.merge_summary(second, frames[0].unionByName(frames[1]), frames[2], runs, boundary)
    now = spark.createDataFrame([*parts[0], *parts[2]], schema)  # the unit that came again replaced the old one
    want = reporting.rebuild_summary(now, runs, boundary)
    assert sorted(map(repr, third.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    got = {r.code: (r.runs, r.found, r.membership) for r in third.collect()}
    assert got == {"TW3": (2, 14, "in_area"), "UB1": (1, 2, "outside"), "HA1": (1, 1, "expansion"), "ZZ9": (0, 0, "in_area")}


def test_director_chains_equal_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(f"C{rnd.randrange(60):02d}", rnd.choice(["Mr Jo Person{}", "PERSON{}, Jo", "jo  person{}."]).format(rnd.randrange(70)), None if rnd.random() < 0.8 else "3", "director") for _ in range(75)]
    rows += [("C98", "", None, "director"), ("C99", None, "1", "director"), ("C97", "Jo Person1", None, "psc"), (None, "Jo Person2", None, "director")]
    people = {}
    for c, name, month, kind in rows:
        if c and name and kind == "director":
            n = int("".join(filter(str.isdigit, name)))
            people.setdefault((n, month), set()).add(c)
    comp = {c: c for s in people.values() for c in s}
    for _ in range(100):
        for s in people.values():
            low = min(comp[c] for c in s)
            comp |= {c: low for c in s}
    step = iter(range(1000))

    def written(name, df):
        path = str(tmp_path / f"{name}-{next(step)}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    got = matching.linked_companies(spark.createDataFrame(rows, "ch_number string, person_name string, birth_month string, kind string"), written)
    assert {r.ch_number: r.chain for r in got.collect()} == comp


def test_reincorporation_takes_the_last_dissolution_before(spark):
    a, b = "1 High St", "TW3 4AA"
    rows = [("D1", a, b, "Dissolved", 900, 400), ("D2", a, b, "Dissolved", 900, 200), ("D3", a, b, "Dissolved", 900, 200), ("L1", a, b, "Active", 200, None), ("L2", a, b, "Active", 300, None), ("L3", a, b, "Active", 500, None), ("L4", "2 High St", b, "Active", 1, None), ("L5", None, None, "Active", 1, None), ("D5", None, None, "Dissolved", 9, 5)]
    df = spark.createDataFrame(rows, "ch_number string, address string, postcode string, ch_status string, age_days bigint, dissolved_age bigint")
    assert {r.ch_number: r.predecessor for r in matching.reincorporations(df).collect()} == {"L1": "D3", "L2": "D1"}


def test_complaints_and_their_negations(spark):
    text = {1: "Food was COLD, not late; never fresh", 2: "not at all really late", 3: "it wasn't cold. No stock, no stock", 4: None, 5: "", 6: "late late late", 7: "chocolate plated coldest"}
    df = spark.createDataFrame([(k, "s", t, 1) for k, t in text.items()] + [(6, "s", "old and late", 500), (6, "s", "late late late", 1)], "premises_no int, source string, text string, age_days int")
    got = {r.premises_no: (r.hits, r.terms, r.supply, r.stock, r.quality, r.consistency) for r in triggers.mine_reviews(df).collect()}
    assert got == {1: (1, "cold,fresh", 0, 0, 1, 0), 2: (1, "late", 1, 0, 0, 0), 3: (1, "stock", 0, 1, 0, 0), 6: (1, "late", 1, 0, 0, 0)}
    assert not {"the", "a", "and", "it"} & {t for t, _, _ in triggers.lexicon_table(spark).collect()}


def test_filing_contexts_are_resolved_in_the_document(spark):
    ctx = lambda i, end, member="", tag="instant": f'<xbrli:context id="{i}"><e>{member}</e><xbrli:period><xbrli:{tag}>{end}</xbrli:{tag}></xbrli:period></xbrli:context>'
    fact = lambda c, v, n="NetAssets": f'<ix:nonFraction name="u:{n}" contextRef="{c}">{v}</ix:nonFraction>'
    member = '<xbrldi:explicitMember dimension="x">y</xbrldi:explicitMember>'
    body = ctx("q", "2021-12-31") + ctx("z9", "2022-12-31") + ctx("m", "2022-12-31", member) + ctx("f", "2030-01-01") + ctx("s", "2022-12-31", tag="endDate")
    body += fact("q", 5) + fact("z9", 7) + fact("m", 99) + fact("nowhere", 98) + fact("s", 3, "Turnover") + fact("f", 1, "Unknown")
    got = {(r.filing_id, r.tag): tuple(None if x is None else int(x) for x in (r.current, r.prior)) for r in accounts.extract_filing_facts(spark.createDataFrame([(1, body), (2, fact("current", 4) + fact("prior", 2))], "filing_id int, body string")).collect()}
    assert got == {(1, "NetAssets"): (7, 5), (1, "Turnover"): (3, None), (2, "NetAssets"): (4, 2)}


def test_roles_by_tables(spark):
    d = spark.createDataFrame([("l", "R1", "u1"), ("m", "R2", "u2")], "lead_key string, rep string, user_id string")
    roles = ("owner", "admin", "management", "telesales", "developer")
    want = {"discovered_leads": (2, 2, 2, 0, 0), "telesales_assignments": (2, 2, 2, 1, 0), "user_profiles": (2, 2, 1, 1, 1), "audit_logs": (2, 2, 0, 0, 0), "existing_customers": (0,) * 5, "erasure_tombstones": (0,) * 5, "suppression_list": (2, 2, 2, 0, 0), "same_day_trigger_queue": (2, 2, 2, 0, 0), "no_such_table": (0,) * 5}
    assert {t: tuple(compliance.role_view(d, t, r, "R1", "u1").count() for r in roles) for t in want} == want
    own = [("t", "clerk", "own_rep", ["lead_key"]), ("t", "clerk", "own_user", ["rep"])]
    got = compliance.role_view(d, "t", "clerk", "R1", "u2", own)
    assert got.columns == ["lead_key", "rep"] and got.count() == 2


def test_audit_payload_is_json(spark):
    before = spark.createDataFrame([(1, 'a,"b"', None)], "k int, v string, w string")
    after = spark.createDataFrame([(1, "c=d", "x")], "k int, v string, w string")
    r = compliance.audit_safe(before, after, "k", ["v", "w"]).head()
    assert json.loads(r.before) == {"v": 'a,"b"', "w": None} and json.loads(r.after) == {"v": "c=d", "w": "x"}


def test_mapping_keeps_leads_whose_ids_agree(spark):
    flat = spark.createDataFrame([("LD-TW-10000", "a b", "07 1"), ("LD-TW-10000", "c", None)], "Lead_ID string, brand string, phone string")
    maps = spark.createDataFrame([("brand", "name", "upper", True), ("phone", "phone", "digits", True), ("phone", "raw", "none", False), ("absent", "x", "none", True)], "internal_field string, target_field string, transform string, is_verified boolean")
    got = sorted((r.Lead_ID, r.mapped_values) for r in export.mapped_snapshot(flat, maps).collect())
    assert got == [("LD-TW-10000", '{"name":"A B","phone":"071"}'), ("LD-TW-10000", '{"name":"C","phone":""}')]


def test_filing_facts_are_cut_out_once_and_in_every_task(spark):
    run = lead_run(spark, SF)
    plan = entry_queries()["filing_figures"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan.split("RepartitionByExpression")[1]  # nothing is cut out ahead of the deal over tasks
    bodies = run.table("filings").select("filing_id", F.lit('<xbrli:context id="a"><xbrli:instant>2001-01-01</xbrli:instant></xbrli:context><ix:nonFraction name="NetAssets" contextRef="a">5</ix:nonFraction>').alias("body"))
    physical = accounts.facts_wide(accounts.extract_filing_facts(bodies.repartition(3, "filing_id")))._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange") == 1


def test_pairs_come_once_without_a_shuffle_of_pairs(spark):
    shape = "string, sector string, unit string, phone string, address_key string"
    l = spark.createDataFrame([("l1", "S 1", "S 1A", "p1", "a1", "Big Grill"), ("l2", None, None, None, "a1", "Grill big"), ("l3", "S 2", "S 2A", "p1", None, None)], f"lead_key {shape}, primary_brand string")
    c = spark.createDataFrame([("c1", "S 1", "S 1A", "p1", "a1", "big grill", "active"), ("c2", "S 2", "S 2B", "p1", "a1", "Grill", "active"), ("c3", None, None, None, None, "x", "inactive")], f"account_code {shape}, name string, status string")
    pairs = matching.block(l, c)
    assert sorted(tuple(r) for r in pairs.collect()) == [("l1", "c1"), ("l1", "c2"), ("l2", "c1"), ("l2", "c2"), ("l3", "c1"), ("l3", "c2")]
    assert "Aggregate [lead_key" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    same = lambda df: sorted(map(str, df.collect()))
    assert same(matching.scored_pairs(l, c)) == same(matching.score_pairs(pairs, l, c))
    twice = c.union(c.withColumn("sector", F.lit("S 1")))  # codes that name two rows
    assert same(matching.scored_pairs(l, twice)) == same(matching.score_pairs(matching.block(l, twice), l, twice)) and matching.block(l, twice).count() == 7
