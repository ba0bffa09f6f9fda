"""Landed files in, output files out."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadflow.operators.premises import PLATFORMS

LISTING_SCHEMA = "listing_id bigint, premises_no bigint, platform string, brand_name string, address string, postcode string, phone string, reviews bigint, rating_tenths bigint, listed_on date, url string, cuisine_type string, run_no bigint"
CUSTOMER_SCHEMA = "account_code string, name string, address string, postcode string, phone string, status string, rep_no bigint, _corrupt string"


def load_listings(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Union of landed listings; paths: platform -> path ending in .json, .csv or .parquet. Columns are
    found by name; one that a file lacks is null, and so is a value that does not fit its type."""
    wanted = StructType.fromDDL(LISTING_SCHEMA)
    frames = []
    for platform, path in sorted(paths.items()):
        kind = path.rstrip("/").rsplit(".", 1)[-1]
        read = spark.read.option("header", True).csv(path) if kind == "csv" else spark.read.schema(wanted).format(kind).load(path)
        have = {c.lower(): c for c in read.columns}
        cols = [(F.col(have[f.name]).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]
        frames.append(read.select(cols).withColumn("platform", F.coalesce("platform", F.lit(platform))))
    return union_listings(frames)


def union_listings(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_customers(spark: SparkSession, path: str) -> DataFrame:
    """Customer master from CSV; lines that do not fit the schema keep their text in _corrupt."""
    return spark.read.schema(CUSTOMER_SCHEMA).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path)


def landed(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """The tables of a lead run from landed files: listings/<platform>.<json|csv|parquet>, customers.csv
    (lines that do not fit the schema are left out here; they keep their text in load_customers), and
    <name>.parquet for all others. Listings are found by their platform's file, whatever its format."""
    base = folder.rstrip("/")

    def exists(path: str) -> bool:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)

    def table(name: str) -> DataFrame:
        if name == "listings":
            paths = {p: f"{base}/listings/{p}.{kind}" for p in PLATFORMS for kind in ("json", "csv", "parquet") if exists(f"{base}/listings/{p}.{kind}")}
            if not paths:
                raise FileNotFoundError(f"no landed listings in {base}/listings")
            return load_listings(spark, paths)
        if name == "customers":
            return load_customers(spark, f"{base}/customers.csv").filter("_corrupt is null").drop("_corrupt")
        return spark.read.parquet(f"{base}/{name}.parquet")

    return table


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written stages where all executors see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in any store that Spark reaches."""
    fs, at = _at(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_texts(spark: SparkSession, folder: str) -> list[str]:
    """The small text files of a folder; none if there is no such folder."""
    fs, at = _at(spark, folder)
    if not fs.exists(at):
        return []
    return [row.value for row in spark.read.option("wholetext", True).text(folder).collect()]


def file_states(spark: SparkSession, paths: list[str]) -> str:
    """A digest of names, sizes and times of files."""
    states = []
    for path in sorted(paths):
        fs, at = _at(spark, path)
        s = fs.getFileStatus(at)
        states.append(f"{path}:{s.getLen()}:{s.getModificationTime()}")
    return hashlib.sha256("\n".join(states).encode()).hexdigest() if states else ""


def file_manifest(spark: SparkSession, path: str, rows: DataFrame | None = None) -> DataFrame:
    """Path, name, size, hash and row count per file. rows: the same files read as a table, whatever
    their columns; each row names its file, so one read counts them all."""
    plain = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")  # noqa: E731  # one form for both readers
    files = spark.read.format("binaryFile").load(path).select(plain(F.col("path")).alias("path"), F.regexp_extract("path", "[^/]+$", 0).alias("file"), "length", F.sha2("content", 256).alias("sha256"))
    if rows is None:
        return files
    n = rows.select(plain(F.col("_metadata.file_path")).alias("path")).groupBy("path").agg(F.count("*").alias("row_count"))
    return files.join(n, "path", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0)))


def write_outputs(outputs: dict[str, DataFrame], base: str, run_id: int) -> dict[str, str]:
    """One dataset per output, partitioned by run; a rerun replaces its own run only. The CRM file is
    written as CSV, too, from its dataset."""
    paths = {}
    for name, df in outputs.items():
        paths[name] = f"{base.rstrip('/')}/{name}"
        dated = df.withColumn("run_id", F.lit(run_id).cast("bigint"))
        dated.write.partitionBy("run_id").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(paths[name])
        if name == "crm":
            written = df.sparkSession.read.schema(dated.schema).parquet(paths[name]).filter(F.col("run_id") == run_id)
            written.select(*df.columns).write.mode("overwrite").option("header", True).csv(f"{paths[name]}_csv/run_id={run_id}")
    return paths
