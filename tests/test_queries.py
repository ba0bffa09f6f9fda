"""Registry and a sample of queries against their SQL in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = "listings_union import_postcodes import_boundary filing_facts postcode_explode territory_resolve delivery_class premises_group lead_id contact_slots match_class registration_match company_match director_trace financial_label route coverage_summary audit_safe retention icp_customers run_history validate".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)]
    text = lambda v: str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)  # noqa: E731  # whole numbers with nulls come as floats
    return sorted(tuple(map(text, r)) for r in df.astype(object).where(df.notna(), None).itertuples(index=False))


def test_registry():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert all(n.islower() for n in q)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    got = rows(entry.queries()[name](spark, SF).toPandas())
    assert got and got == rows(duck.execute(entry.oracle_sql()[name]).df())
