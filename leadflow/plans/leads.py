"""The lead run as one lazy plan over named tables; each property is a stage.

Order of stages: listings, keys, deny list (suppressed and erased subjects leave, by hash), territory,
premises, leads (split by tenant), matches, registrations, companies, delivery class, triggers, score,
route, coverage. At export the deny list is applied again, and only items of batches that the gate lets
through leave.
"""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import json
import time
from collections.abc import Callable
from functools import cached_property

from py4j.protocol import Py4JNetworkError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadflow.config import DEFAULT, Config
from leadflow.functions.text import normal_phone, with_postcode_parts
from leadflow.operators import accounts, compliance, export, matching, premises, reporting, routing, scoring, territory, triggers
from leadflow.sources import adapters
from leadflow.sources.files import file_states, read_texts, remove_folder, work_folder, write_text


# The tables that a run reads, by name; `sources.files.landed` reads them from landed files.
TABLES = (
    "listings", "customers", "registrations", "companies", "officers", "filings", "place_lookups", "reviews", "runs", "boundary", "territory", "territory_files", "suppression", "tombstones", "batches",
    "mappings", "batch_fields",
)


def stage(make: Callable) -> cached_property:
    """A property of a run that is written as a stage under its name."""

    def get(self):
        return self.kept(make.__name__, lambda: make(self))

    get.__doc__ = make.__doc__
    return cached_property(get)


class LeadRun:
    """A run over `tables`: a function from a name of TABLES to a DataFrame, or a dictionary. The pepper
    is the key of the hashes on the suppression list and the tombstones; it is given at run time. resume:
    a folder that all executors share, in which stages and their manifest stay; a later run over the same
    inputs goes on behind the stages that were finished there."""

    def __init__(self, spark: SparkSession, tables: Callable[[str], DataFrame] | dict[str, DataFrame], cfg: Config = DEFAULT, *, pepper: str, folder: str = "", resume: str | None = None):
        self.spark, self.cfg, self.pepper, self.folder, self.resume = spark, cfg, pepper, folder, resume
        self.log: list[dict] = []
        self.table: Callable[[str], DataFrame] = tables.__getitem__ if isinstance(tables, dict) else tables

    @cached_property
    def work(self) -> str:
        return self.resume or work_folder(self.spark, "lead-run")

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.work}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.work}/{name}")

    def kept(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A stage that later stages read: written once, so later plans begin at its table and a lost
        executor costs no stage again. Its rows are counted as they are written. A run that resumes takes
        over a finished stage of the same inputs without planning it."""
        done = self.manifest.get(name)
        if done and done["failure"] is None and done["inputs"] == self.inputs:
            self.log.append({**done, "taken_over": True})
            return self.spark.read.schema(StructType.fromJson(json.loads(done["schema"]))).parquet(f"{self.work}/{name}")
        entry: dict = {"stage": name, "n": None, "schema": None, "failure": None, "inputs": self.inputs, "taken_over": False}
        df = make()  # stages that this one waits for have entries of their own
        seen, start = Observation(), time.monotonic()
        try:
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{self.work}/{name}")
            entry |= {"n": seen.get["n"], "schema": df.schema.json()}
        except Exception as e:
            entry["failure"] = f"{type(e).__name__}: {str(e).strip().splitlines()[0]}"
            raise
        finally:
            entry["seconds"] = time.monotonic() - start
            self.log.append(entry)
            if self.resume:
                with contextlib.suppress(Py4JNetworkError):  # the session is gone: its failure is on its way
                    write_text(self.spark, f"{self.work}/manifest/{name}.json", json.dumps(entry))
        return self.spark.read.schema(df.schema).parquet(f"{self.work}/{name}")

    @cached_property
    def manifest(self) -> dict[str, dict]:
        """The stages that a former run left in the folder to resume from."""
        return {e["stage"]: e for e in map(json.loads, read_texts(self.spark, f"{self.work}/manifest"))} if self.resume else {}

    @cached_property
    def inputs(self) -> str:
        """A fingerprint of what the run reads: names, sizes and times of the input files (the rows of a
        table without files), the configuration and the pepper. Only a run that may resume takes it."""
        if not self.resume:
            return ""
        seen = [repr(self.cfg), self.pepper]
        for name in TABLES:
            df = self.table(name)
            files = file_states(self.spark, df.inputFiles())
            seen.append(f"{name}:{df.schema.simpleString()}:{files or df.select(F.count('*'), F.bit_xor(F.xxhash64(*df.columns))).head()}")
        return hashlib.sha256("\n".join(seen).encode()).hexdigest()

    @property
    def stage_map(self) -> dict[str, int]:
        """Rows of each stage that is finished."""
        return {e["stage"]: e["n"] for e in self.log if e["failure"] is None}

    def telemetry(self, costs: dict[str, float] | None = None) -> DataFrame:
        """A row for each stage of the run so far, from its log."""
        return reporting.telemetry(self.spark, self.log, costs or {})

    def release(self) -> None:
        """Delete the written stages."""
        if "work" in self.__dict__:
            remove_folder(self.spark, self.work)
        self.__dict__ = {k: v for k, v in self.__dict__.items() if k in ("spark", "folder", "cfg", "pepper", "table", "resume")} | {"log": []}

    @cached_property
    def listings(self) -> DataFrame:
        return self.table("listings")

    @stage
    def keyed(self) -> DataFrame:
        """Listings with postcode parts and address key, parsed once."""
        return premises.with_address_key(with_postcode_parts(self.listings))

    @stage
    def premises(self) -> DataFrame:
        return premises.group_premises(self.keyed)

    @stage
    def territory(self) -> DataFrame:
        """The codes that the run covers."""
        return territory.resolve_territory(self.table("territory"), self.table("territory_files"))

    @stage
    def marked(self) -> DataFrame:
        """Keyed listings with the suppressed or erased keys of each."""
        k = self.keyed
        erased = normal_phone(F.col("phone"))
        return compliance.mark_denied(k, self.table("suppression"), self.table("tombstones"), compliance.listing_subjects(k), erased, "import", self.pepper)

    @cached_property
    def scoped(self) -> DataFrame:
        """Listings of the territory without a suppressed or erased key."""
        return territory.filter_territory(self.marked.filter(F.size("denied") == 0).drop("denied"), self.territory)

    @stage
    def leads(self) -> DataFrame:
        """Premises in scope, one lead for each tenant where several are registered."""
        return premises.leads_of(premises.group_premises(self.scoped), self.table("registrations"))

    @cached_property
    def customers(self) -> DataFrame:
        return matching.customer_keys(self.table("customers"))

    @cached_property
    def pairs(self) -> DataFrame:
        """All candidate pairs: the report; the run itself takes the best ones without them."""
        return matching.block(self.leads, self.customers)

    @cached_property
    def scored(self) -> DataFrame:
        return matching.scored_pairs(self.leads, self.customers, self.cfg)

    @cached_property
    def best(self) -> DataFrame:
        return matching.best_customers(self.leads, self.customers, self.cfg, written=self._written)

    @stage
    def classified(self) -> DataFrame:
        return matching.classify_match(self.leads, self.best, self.cfg)

    @stage
    def registrations(self) -> DataFrame:
        return matching.match_registrations(self.leads, self.table("registrations"))

    @stage
    def companies(self) -> DataFrame:
        return matching.match_companies(self.leads, self.registrations, self.table("companies"))

    @stage
    def boundary(self) -> DataFrame:
        return territory.import_boundary(self.table("boundary"))

    @cached_property
    def owners(self) -> DataFrame:
        return matching.ownership_changes(self.table("companies"), self.table("officers"), self.cfg)

    @stage
    def chains(self) -> DataFrame:
        """Companies linked by directors."""
        return matching.linked_companies(self.table("officers"), lambda name, df: self._written(f"directors-{name}", df))

    @cached_property
    def accounts(self) -> DataFrame:
        a = accounts.current_and_prior(self.table("filings"))
        return accounts.financial_label(accounts.net_assets_growth(a), self.cfg)

    @stage
    def enriched(self) -> DataFrame:
        """One row per lead with matches, delivery class, verification, food flag and size."""
        r = self.registrations.withColumnRenamed("how", "reg_how")
        c = self.companies.withColumnsRenamed({"how": "company_how", "age_days": "company_age"})
        out = self.classified.join(r, "lead_key", "left").join(c, "lead_key", "left")
        out = territory.classify_delivery(out, self.boundary)
        out = routing.food_flag(accounts.verify_state(out), self.cfg)
        place = self.table("place_lookups").groupBy("premises_no").agg(F.max("reviews").alias("place_reviews"))
        return scoring.size_proxy(out.join(place, "premises_no", "left"))

    @cached_property
    def triggers(self) -> DataFrame:
        day = lambda age: F.date_sub(F.lit(self.cfg.as_of).cast("date"), age.cast("int"))
        new = self.registrations.filter(F.col("days_since_registration") < self.cfg.new_days).select("lead_key", F.lit("Registered recently").alias("snippet"), day(F.col("days_since_registration")).alias("trigger_date"))
        changed = self.companies.select("lead_key", "ch_number").join(self.owners, "ch_number").select("lead_key", F.col("reason").alias("snippet"), F.col("changed_on").alias("trigger_date"))
        hits = triggers.review_snippet(triggers.mine_reviews(self.table("reviews"), self.cfg))
        complaint = self.leads.select("lead_key", "premises_no").join(hits, "premises_no").select("lead_key", "snippet", F.col("review_date").alias("trigger_date"))
        return triggers.lead_triggers(new, changed, complaint)

    @cached_property
    def bonus(self) -> DataFrame:
        return triggers.trigger_bonus(self.triggers, cfg=self.cfg)

    @cached_property
    def base(self) -> DataFrame:
        return scoring.base_score(self.enriched, scoring.rule_table(self.spark))

    @cached_property
    def final(self) -> DataFrame:
        return scoring.final_score(self.base, self.bonus, self.cfg)

    @stage
    def routed(self) -> DataFrame:
        out = accounts.confidence(self.enriched.join(self.final, "lead_key"))
        return routing.route(out, self.cfg)

    @cached_property
    def items(self) -> DataFrame:
        """(batch_id, lead_key) of the leads for export: the batches of a run are numbered by its number."""
        return export.build_batch(self.routed.filter("route = 'export'"), F.col("run_no") % 4)[0]

    @cached_property
    def gate(self) -> DataFrame:
        return export.export_gate(self.table("batches"), self.items, self.table("batch_fields"), self.table("mappings"))

    @cached_property
    def export_marked(self) -> DataFrame:
        """Leads of the items that the gate lets through, with suppressed and erased keys as the lists
        are at the time of export."""
        open_ = self.gate.filter("may_export").select("batch_id")
        leads = self.routed.join(self.items.join(open_, "batch_id", "left_semi").select("lead_key").distinct(), "lead_key", "left_semi")
        return compliance.mark_denied(leads, self.table("suppression"), self.table("tombstones"), compliance.listing_subjects(leads), normal_phone(F.col("phone")), "import", self.pepper)

    @cached_property
    def cleared(self) -> DataFrame:
        return self.export_marked.filter(F.size("denied") == 0).drop("denied")

    @cached_property
    def removed(self) -> DataFrame:
        """Rows that the two deny stages removed, by hash and scope."""
        return compliance.removed_keys(self.marked, "head").unionByName(compliance.removed_keys(self.export_marked, "export"))

    @cached_property
    def units(self) -> DataFrame:
        return reporting.run_coverage(self.routed)

    @cached_property
    def summary(self) -> DataFrame:
        return reporting.rebuild_summary(self.units, self.table("runs"), self.boundary)


_RUNS: dict[tuple, LeadRun] = {}


def lead_run(spark: SparkSession, folder: str) -> LeadRun:
    """The run over a folder in this session, planned once for all queries that ask for it. A run over
    another folder takes its place, and its written stages go."""
    key = (spark.sparkContext.applicationId, id(spark), folder)
    if key not in _RUNS:
        for old in [k for k in _RUNS if k[:2] == key[:2]]:
            _RUNS.pop(old).release()
        _RUNS[key] = LeadRun(spark, adapters.tables(spark, folder, adapters.PEPPER), pepper=adapters.PEPPER, folder=folder)
    return _RUNS[key]


@atexit.register
def _release_all() -> None:
    for run in _RUNS.values():
        with contextlib.suppress(Exception):  # the session may have ended
            run.release()
