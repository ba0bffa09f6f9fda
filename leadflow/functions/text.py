"""Column functions: postcodes, address keys, phones, similarities, keyed hashes, status classes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = r"^([A-Z]{1,2})([0-9][0-9A-Z]?) ([0-9])([A-Z]{2}|[A-Z])$"
# Street words and their short forms.
STREET_WORDS = {"rd": "road", "st": "street", "ave": "avenue", "ln": "lane"}


def normal_postcode(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.upper(c), r"\s+", " "))


def with_postcode_parts(df: DataFrame, col: str = "postcode") -> DataFrame:
    """Add area, district, sector, unit (null where the code is malformed). One match, then parts by place."""
    unit = F.nullif(F.regexp_extract(normal_postcode(F.col(col)), UNIT, 0), F.lit(""))
    out = df.withColumn("unit", unit)
    outward, inward = F.split_part("unit", F.lit(" "), F.lit(1)), F.split_part("unit", F.lit(" "), F.lit(2))
    return out.withColumns({"area": F.regexp_extract(outward, "^[A-Z]+", 0), "district": outward, "sector": F.concat_ws(" ", outward, F.left(inward, F.lit(1)))}).withColumn("sector", F.when(F.col("unit").isNotNull(), F.col("sector")))


def granularity_of(code: Column) -> Column:
    """The granularity that the form of a code shows; null if it has none."""
    return (
        F.when(code.rlike("^[A-Z]{1,2}$"), "area")
        .when(code.rlike("^[A-Z]{1,2}[0-9][0-9A-Z]?$"), "district")
        .when(code.rlike("^[A-Z]{1,2}[0-9][0-9A-Z]? [0-9]$"), "sector")
        .when(code.rlike(UNIT), "unit")
    )


def address_key(address: Column) -> Column:
    """House number (with letter) and street, lower-case, without punctuation, street words in full."""
    s = F.trim(F.regexp_replace(F.regexp_replace(F.lower(address), "[^a-z0-9 ]", " "), " +", " "))
    for short, full in STREET_WORDS.items():
        s = F.regexp_replace(s, rf"\b{short}\b", full)
    return s


def normal_phone(c: Column) -> Column:
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(digits.rlike("^44[0-9]{10}$"), F.concat(F.lit("0"), F.substr(digits, F.lit(3), F.lit(20)))).otherwise(F.nullif(digits, F.lit("")))


def phone_kind(c: Column) -> Column:
    return F.when(c.rlike("^07"), "mobile").otherwise("landline")


def percent(x: Column) -> Column:
    """Rounded half up, as a whole number."""
    return F.floor(x + 0.5).cast("bigint")


def edit_ratio(a: Column, b: Column) -> Column:
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(100).cast("bigint")).otherwise(percent(100.0 * (longest - F.levenshtein(a, b)) / longest))


def _tokens(c: Column) -> Column:
    return F.array_sort(F.split(F.trim(F.lower(c)), " +"))


def token_sort_ratio(a: Column, b: Column) -> Column:
    return edit_ratio(F.array_join(_tokens(a), " "), F.array_join(_tokens(b), " "))


def token_set(c: Column) -> Column:
    return F.array_distinct(_tokens(c))


def set_ratio(x: Column, y: Column) -> Column:
    """Likeness of two sets of tokens."""
    common = F.size(F.array_intersect(x, y))
    return percent(100.0 * common / (F.size(x) + F.size(y) - common))


def token_set_ratio(a: Column, b: Column) -> Column:
    return set_ratio(token_set(a), token_set(b))


def hmac_sha256(value: Column, pepper: str) -> Column:
    """HMAC-SHA-256 of a string in hexadecimal digits; the pepper is given at run time."""
    import hashlib

    key = pepper.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)
    first = F.sha2(F.concat(F.lit(inner), value.cast("binary")), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(first)), 256)


def status_class(status: Column) -> Column:
    """Badge class by the first rule whose word occurs."""
    s = F.lower(status)
    has = lambda *words: reduce(lambda x, y: x | y, [s.contains(w) for w in words])
    return (
        F.when(has("mock"), "mock")
        .when(has("complete", "contacted", "done"), "complete")
        .when(has("export"), "exported")
        .when(has("block"), "blocked")
        .when(has("warn", "pending", "ready", "review"), "warning")
        .when(has("run", "progress", "active"), "running")
        .otherwise("draft")
    )
