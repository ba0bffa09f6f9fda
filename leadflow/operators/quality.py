"""Validation, uniqueness, references and idempotent appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: list[str], where: str = "true") -> DataFrame:
    return df.filter(where).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def append_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows and the incoming rows with keys that are not there yet, once each."""
    return existing.unionByName(incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti").select(*existing.columns))


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds failed: the names of the rules that a row breaks (null counts as broken), joined."""
    names = [F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]
    return df.withColumn("failed", F.concat_ws(",", *names))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows with the columns of df, quarantined rows with the names of the rules they break)."""
    checked = validate(df, rules)
    return checked.filter("failed = ''").drop("failed"), checked.filter("failed <> ''")


def in_enum(col: str, values: tuple[str, ...]) -> Column:
    return F.col(col).isin(*values)


def check_refs(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose key is set and has no parent."""
    return child.filter(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")
