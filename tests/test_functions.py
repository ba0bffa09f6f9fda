"""Column functions on inline rows: goldens, nulls, malformed values."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from leadflow.functions import text as T
from leadflow.operators import accounts, reporting


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_postcode_parts(spark):
    df = spark.createDataFrame([("TW3 4AS",), (" tw3  4as ",), ("N/A",), (None,), ("",)], "postcode string")
    rows = T.with_postcode_parts(df).select("area", "district", "sector", "unit").collect()
    assert tuple(rows[0]) == tuple(rows[1]) == ("TW", "TW3", "TW3 4", "TW3 4AS")
    assert all(tuple(r) == (None,) * 4 for r in rows[2:])


def test_granularity(spark):
    assert one(spark, ["TW", "TW3", "TW3 4", "TW3 4AS", "?"], T.granularity_of) == ["area", "district", "sector", "unit", None]


def test_address_key(spark):
    assert one(spark, ["179A Kingsley Rd.", "179a  KINGSLEY road", None], T.address_key) == ["179a kingsley road"] * 2 + [None]


def test_phones(spark):
    assert one(spark, ["+44 7700 900123", "020 8555 1234", "", None], T.normal_phone) == ["07700900123", "02085551234", None, None]


def test_hmac(spark):
    for pepper in ("pepper", "k" * 100):
        want = [hmac.new(pepper.encode(), v.encode(), hashlib.sha256).hexdigest() for v in ("", "a", "07700900123")]
        assert one(spark, ["", "a", "07700900123"], lambda c, p=pepper: T.hmac_sha256(c, p)) == want


def test_similarities(spark):
    df = spark.createDataFrame([("abc", "abd"), ("", ""), ("grill royal", "Royal Grill")], "a string, b string")
    r = df.select(T.edit_ratio(F.col("a"), F.col("b")), T.token_sort_ratio(F.col("a"), F.col("b")), T.token_set_ratio(F.col("a"), F.col("b"))).collect()
    assert r[0][0] == 67 and r[1][0] == 100 and r[2][1] == 100 and r[2][2] == 100


@pytest.mark.parametrize("status,want", [("CH pending", "warning"), ("In progress", "running"), ("Exported", "exported"), ("Draft", "draft"), ("Mock done", "mock"), ("blocked", "blocked")])
def test_status_class(spark, status, want):
    assert one(spark, [status], T.status_class) == [want]


def test_growth_and_label(spark):
    df = spark.createDataFrame([("Micro", 23000, 15000), ("Micro", 23000, None), ("Dormant", 1, 1), ("Small", None, 5), ("Small", -1, 5), ("Small", 10, 0)], "accounts_type string, c_net_assets bigint, p_net_assets bigint")
    rows = accounts.financial_label(accounts.net_assets_growth(df)).collect()
    assert [r.net_assets_growth for r in rows] == [53, None, 0, None, -120, None]
    assert [r.financial_label for r in rows] == ["Solvent-Growing", "Solvent-Stable", "Dormant", "No-Data", "Insolvency-Flag", "Thin"]


def test_coverage_level(spark):
    assert one(spark, [0, 1, 2, 3, 4, 5, 9], reporting.coverage_level, "int") == [0, 1, 2, 2, 3, 4, 4]
