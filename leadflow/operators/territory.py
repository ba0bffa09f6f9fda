"""Territories, delivery boundaries, roads and overlays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadflow.functions.text import granularity_of, normal_postcode, with_postcode_parts

LEVELS = ("area", "district", "sector", "unit")
SMALL = 200_000


def is_small(df: DataFrame, limit: int = SMALL) -> bool:
    """Whether a code list is short enough to be broadcast; a longer one joins by shuffle."""
    return df.limit(limit + 1).count() <= limit


def explode_granularity(df: DataFrame) -> DataFrame:
    """One row per level: adds code and granularity to a table with postcode parts."""
    pairs = F.array(*[F.struct(F.col(level).alias("code"), F.lit(level).alias("granularity")) for level in LEVELS])
    return df.withColumn("g", F.explode(pairs)).select("*", "g.code", "g.granularity").drop("g").filter("code is not null")


def import_postcodes(raw: DataFrame, col: str = "postcode") -> DataFrame:
    parts = with_postcode_parts(raw, col)
    total, missing = F.count("*"), F.count_if(F.col("unit").isNull())
    return parts.agg(total.alias("rows_total"), missing.alias("rows_missing"), F.when(total == missing, "failed").otherwise("parsed").alias("status"))


def import_boundary(raw: DataFrame) -> DataFrame:
    """Distinct (code, granularity, membership) from a list of codes."""
    code = normal_postcode(F.col("code"))
    return raw.select(code.alias("code"), granularity_of(code).alias("granularity"), "membership").filter("granularity is not null").dropDuplicates(["code", "granularity"])


def boundary_counts(boundary: DataFrame) -> DataFrame:
    """One row: the codes of an imported boundary in the area and held for expansion, and its status."""
    kind = lambda m: F.count_if(F.col("membership") == m)
    return boundary.agg(F.count("*").alias("codes"), kind("in_area").alias("in_area"), kind("expansion").alias("expansion")).withColumn("status", F.when(F.col("codes") > 0, "parsed").otherwise("failed"))


def resolve_territory(items: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct (code, granularity, is_expansion) of a mixed set of items; files: (file_id, code)."""
    listed = ["delivery_boundary_upload", "expansion_list"]
    typed = items.filter(~F.col("item_type").isin(listed)).select(F.explode(F.split("value", r"[,;\n]+")).alias("code"), "is_expansion")
    uploaded = items.filter(F.col("item_type").isin(listed)).join(files, items["source_file_id"] == files["file_id"]).select("code", "is_expansion")
    code = normal_postcode(F.col("code"))
    rows = typed.unionByName(uploaded).select(code.alias("code"), granularity_of(code).alias("granularity"), "is_expansion").filter("granularity is not null")
    return rows.groupBy("code", "granularity").agg(F.bool_or("is_expansion").alias("is_expansion"))


def snapshot_territory(run_no: int, resolved: DataFrame, universe: DataFrame) -> DataFrame:
    """Items of a run with the number of unit postcodes each resolves to."""
    units = explode_granularity(universe)
    counted = units.groupBy("code", "granularity").agg(F.countDistinct("unit").alias("postcodes"))
    return resolved.join(counted, ["code", "granularity"], "left").select(F.lit(run_no).cast("bigint").alias("run_no"), "code", "granularity", F.coalesce("postcodes", F.lit(0)).alias("postcodes"))


def _by_level(df: DataFrame, codes: DataFrame, value: str) -> DataFrame:
    """Joins codes to the level that each belongs to: adds m_area ... m_unit. The list is counted once."""
    small = is_small(codes)
    for level in LEVELS:
        part = codes.filter(F.col("granularity") == level).select(F.col("code").alias(level), F.col(value).alias(f"m_{level}"))
        df = df.join(F.broadcast(part) if small else part, level, "left")
    return df


def filter_territory(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Rows with any of their levels in the codes; the table is read once and rows are not repeated."""
    found = _by_level(df, codes.select("code", "granularity", F.lit(True).alias("hit")).distinct(), "hit")
    return found.filter(F.coalesce(*[F.col(f"m_{level}") for level in LEVELS], F.lit(False))).drop(*[f"m_{level}" for level in LEVELS])


def classify_delivery(df: DataFrame, boundary: DataFrame) -> DataFrame:
    """Adds membership: in_area, expansion or outside; the finest level that is listed wins."""
    found = F.coalesce(*[F.col(f"m_{level}") for level in reversed(LEVELS)], F.lit("outside"))
    return _by_level(df, boundary, "membership").withColumn("membership", found).drop(*[f"m_{level}" for level in LEVELS])


def current_boundary(boundaries: DataFrame) -> DataFrame:
    """The current boundary per owner with the count of current ones; ok only if it is one."""
    return boundaries.groupBy("owner").agg(
        F.max(F.when(F.col("is_current"), F.col("boundary_id"))).alias("boundary_id"),
        F.count_if("is_current").alias("n_current"),
    ).withColumn("ok", F.col("n_current") == 1)


def select_roads(roads: DataFrame, config: DataFrame) -> DataFrame:
    """Roads by the mode of the default config: all, primary, feeder or custom (a list)."""
    one = F.broadcast(config.filter("is_default").limit(1).select("mode", "custom"))  # one row
    keep = (F.col("mode") == "all") | ((F.col("mode") == "custom") & F.array_contains("custom", F.col("road"))) | (F.col("mode") == F.col("class"))
    return roads.join(one, keep, "left_semi")


def overlay(coverage: DataFrame, points: DataFrame) -> DataFrame:
    """Number of overlay points per coverage code; points have postcode parts."""
    counts = explode_granularity(points).groupBy("code", "granularity").agg(F.count("*").alias("points"))
    return coverage.join(counts, ["code", "granularity"], "left").withColumn("points", F.coalesce("points", F.lit(0)))
