"""Runs, coverage, budgets and dashboard tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.config import DEFAULT, Config
from leadflow.functions.text import percent, status_class
from leadflow.operators.territory import explode_granularity


def telemetry(spark: SparkSession, log: list[dict], costs: dict[str, float]) -> DataFrame:
    """A row for each stage of a run's log, in order: count, seconds, cost, failure. Counts were observed
    while the stage's rows were written, so this reads nothing again."""
    rows = [(i, e["stage"], e["n"], e["seconds"], float(costs.get(e["stage"], 0.0)), e["failure"]) for i, e in enumerate(log)]
    return spark.createDataFrame(rows, "step bigint, stage string, n bigint, seconds double, cost double, failure string")


def stage_maps(telemetry_rows: DataFrame) -> DataFrame:
    """One row: the map of finished stages to their counts, as it is stored on a run, and what they cost."""
    done = F.col("failure").isNull()
    pairs = F.array_sort(F.collect_list(F.when(done, F.struct("stage", "n"))))
    return telemetry_rows.agg(F.map_from_entries(pairs).alias("stages"), F.sum("cost").alias("cost"), F.count_if(~done).alias("failed"))


def run_coverage(routed: DataFrame) -> DataFrame:
    """Per run, code and level: found, ignored, exported."""
    is_route = lambda r: F.count_if(F.col("route") == r)
    return explode_granularity(routed).groupBy("run_no", "code", "granularity").agg(F.count("*").alias("found"), is_route("ignored").alias("ignored"), is_route("export").alias("exported"), is_route("reactivation").alias("reactivation"))


_TOTALS = ("found", "ignored", "exported", "reactivation")


def _summed(units: DataFrame, runs: DataFrame) -> DataFrame:
    """Per code and level over its units (one row a run, code and level)."""
    dated = units.join(runs.select("run_no", "last_day"), "run_no", "left")
    return dated.groupBy("code", "granularity").agg(F.count("*").alias("runs"), F.min("last_day").alias("first_run"), F.max("last_day").alias("last_run"), *[F.sum(c).alias(c) for c in _TOTALS])


def _with_boundary(summed: DataFrame, boundary: DataFrame, version: int) -> DataFrame:
    """Delivery flag and version; codes of the boundary without a run come with zero runs."""
    out = summed.join(boundary.select("code", "granularity", "membership"), ["code", "granularity"], "full_outer")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("runs", *_TOTALS)}
    return out.withColumns({**zero, "membership": F.coalesce("membership", F.lit("outside")), "boundary_version": F.lit(version).cast("bigint")})


def rebuild_summary(units: DataFrame, runs: DataFrame, boundary: DataFrame, version: int = 1) -> DataFrame:
    """Cumulative coverage per code and level with delivery flag and boundary version, the codes of the
    boundary that had no run included."""
    return _with_boundary(_summed(units, runs), boundary, version)


def merge_summary(summary: DataFrame, old_units: DataFrame, new_units: DataFrame, runs: DataFrame, boundary: DataFrame, version: int = 1) -> DataFrame:
    """The stored summary after new units: only codes that they touch are summed again (a unit of a run
    that is there already takes the place of the old one); all flags follow the boundary at hand."""
    key = ["run_no", "code", "granularity"]
    touched = new_units.select("code", "granularity").distinct()
    kept = old_units.join(touched, ["code", "granularity"], "left_semi").join(new_units.select(key), key, "left_anti")
    again = _summed(kept.unionByName(new_units), runs)
    rest = summary.filter("runs > 0").join(touched, ["code", "granularity"], "left_anti").select(again.columns)
    return _with_boundary(rest.unionByName(again), boundary, version)


def stale_coverage(summary: DataFrame, current_version: int) -> DataFrame:
    return summary.filter(~F.col("boundary_version").eqNullSafe(F.lit(current_version)))


def coverage_level(runs: Column) -> Column:
    return F.when(runs <= 0, 0).when(runs == 1, 1).when(runs <= 3, 2).when(runs == 4, 3).otherwise(4).cast("bigint")


def coverage_progress(summary: DataFrame, boundary: DataFrame) -> DataFrame:
    """Districts of the boundary that had a run, percent, gaps and districts held for expansion."""
    d = boundary.filter("granularity = 'district'").select("code", "membership").join(summary.filter("granularity = 'district'").select("code", "runs"), "code", "left")
    inside, done = F.col("membership") == "in_area", F.coalesce("runs", F.lit(0)) > 0
    out = d.agg(F.count_if(inside).alias("total"), F.count_if(inside & done).alias("targeted"), F.count_if(inside & ~done).alias("gaps"), F.count_if(F.col("membership") == "expansion").alias("expansion_held"))
    return out.withColumn("pct", F.when(F.col("total") > 0, percent(100.0 * F.col("targeted") / F.col("total"))))


def budget(runs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Running cost per day, whether the cap is passed, and whether a run is over its target."""
    w = W.partitionBy("last_day").orderBy("run_no").rowsBetween(W.unboundedPreceding, 0)
    out = runs.withColumn("pence", percent(F.col("cost") * 100)).withColumn("day_pence", F.sum("pence").over(w))
    return out.select("run_no", "last_day", "pence", "day_pence", (F.col("day_pence") > 100 * cfg.daily_cap).alias("over_cap"), (F.col("pence") > 100 * cfg.district_target).alias("over_target"))


def pending(entered: DataFrame, done: DataFrame, failed: DataFrame) -> DataFrame:
    return entered.join(done, "lead_key", "left_anti").join(failed, "lead_key", "left_anti")


def search(df: DataFrame, q: str, keys: list[str], facet: tuple[str, str] | None = None) -> DataFrame:
    """Rows with the text in any key column, case-blind, and the facet's value; 'All' is no facet."""
    return df.filter(_hit(q, keys, facet))


def _hit(q: str, keys: list[str], facet: tuple[str, str] | None) -> Column:
    text = F.lit(q.lower())
    hit = F.lit(True) if not q.strip() else reduce(lambda a, b: a | b, [F.lower(F.coalesce(F.col(k).cast("string"), F.lit(""))).contains(text) for k in keys])
    if facet and facet[1] != "All":
        hit = hit & (F.coalesce(F.col(facet[0]).cast("string"), F.lit("")) == facet[1])
    return hit


def search_counts(df: DataFrame, q: str, keys: list[str], facet: tuple[str, str] | None = None) -> DataFrame:
    """One row: rows shown and rows in all, from one pass."""
    return df.agg(F.count_if(_hit(q, keys, facet)).alias("shown"), F.count("*").alias("total"))


def overview(routed: DataFrame, cleared: DataFrame, telesales: DataFrame, summary: DataFrame) -> DataFrame:
    """One row of figures: leads by route, leads that may leave, open telesales rows, delivery gaps."""
    n, route = F.count_if, F.col("route")
    leads = routed.agg(F.count("*").alias("leads"), n(route == "export").alias("ready"), n((route == "export") & (F.col("tier") == "A")).alias("tier_a"), n(route == "ignored").alias("ignored"), n(route == "expansion").alias("held"))
    gaps = n((F.col("granularity") == "district") & (F.col("membership") == "in_area") & (F.col("runs") == 0))
    for one in (cleared.agg(F.count("*").alias("export_ready")), telesales.agg(n(F.col("worked_status") == "open").alias("telesales_open")), summary.agg(gaps.alias("gaps"))):
        leads = leads.crossJoin(one)  # one row each
    return leads


def with_status_class(df: DataFrame, col: str = "status") -> DataFrame:
    return df.withColumn("status_class", status_class(F.col(col)))


def run_history(runs: DataFrame, telemetry_rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Runs with their territory (sets: territory_no, territory), date, cost and counts of two stages."""
    wide = telemetry_rows.groupBy("run_no").pivot("stage", ["discovered", "deduplicated"]).agg(F.sum("n"))
    return runs.select("run_no", "territory_no", "run_type", "last_day", "cost", "status").join(wide, "run_no", "left").join(sets, "territory_no", "left").withColumn("status_class", status_class(F.col("status")))


def territory_overview(items: DataFrame, resolved: DataFrame, uses: DataFrame) -> DataFrame:
    mix = items.groupBy("territory_set").agg(F.count("*").alias("items"), F.array_join(F.array_sort(F.collect_set("item_type")), "+").alias("mix"))
    codes = resolved.groupBy("territory_set").agg(F.sum("postcodes").alias("postcodes"))
    last = uses.groupBy("territory_set").agg(F.max("used_on").alias("last_used"))
    return mix.join(codes, "territory_set", "left").join(last, "territory_set", "left")
