"""Retail operators: cleaning edge cases and the fan-out joins (D12, D13) vs a literal join."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import retail as R

from conftest import rows

RAW_SCHEMA = ("InvoiceNo long, StockCode long, Description string, Quantity int, InvoiceDate string, "
              "UnitPrice decimal(18,2), CustomerID long, Country string, LineNo int")


@pytest.fixture(scope="module")
def raw(spark):
    data = [
        # customer 1 buys in two countries (D12): every join repeats its lines twice
        (100, 1, "cup", 2, "13/12/2010 9:09", Decimal("1.50"), 1, "UK", 1),
        (100, 2, "pot", 1, "13/12/2010 9:09", Decimal("10.00"), 1, "UK", 2),
        (101, 1, "cup", 5, "1/2/2011 10:30", Decimal("1.50"), 1, "FR", 1),
        (102, 3, "pan", 3, "2/2/2011 8:00", Decimal("7.25"), 2, "FR", 1),
        (103, 3, "pan", 1, "not a date", Decimal("7.25"), 3, "DE", 1),
        (104, 4, "jar", 9, "5/3/2011 12:00", Decimal("2.00"), None, "UK", 1),  # anonymous
    ]
    return spark.createDataFrame(data, RAW_SCHEMA)


@pytest.fixture(scope="module")
def lines(raw):
    return R.clean_lines(raw, "UK")


def test_clean_drops_anonymous_and_flips_dates(lines):
    got = {(r.InvoiceNo, r.LineNo): r for r in lines.collect()}
    assert (104, 1) not in got
    assert got[(100, 1)].InvoiceDate == dt.datetime(2010, 12, 13, 9, 9)
    assert got[(101, 1)].InvoiceDate == dt.datetime(2011, 2, 1, 10, 30)
    assert got[(103, 1)].InvoiceDate is None  # unparsable -> NULL, not an error
    assert got[(100, 2)].TotalPrice == Decimal("10.00")
    assert (got[(100, 1)].IsUK, got[(102, 1)].IsUK) == (1, 0)


def test_customer_transactions_fan_out(lines):
    out = R.customer_transactions(lines, R.distinct_customers(lines))
    per_customer = {r.CustomerID: r["count"] for r in out.groupBy("CustomerID").count().collect()}
    assert per_customer == {1: 6, 2: 1, 3: 1}  # customer 1: 3 lines x 2 countries


def test_customer_summary_equals_literal_join(lines):
    literal = (R.customer_transactions(lines, R.distinct_customers(lines))
               .groupBy("CustomerID", "Country")
               .agg(F.sum("TotalPrice").cast("double").alias("total_spent"),
                    F.count("InvoiceNo").alias("purchase_count")))
    assert rows(R.customer_summary_fanned(lines)) == rows(literal)
    assert rows(R.customer_summary(lines, R.distinct_customers(lines))) == rows(literal)


def test_country_summary_equals_literal_self_join(lines):
    r, c = lines.alias("r"), lines.alias("c")
    literal = (
        r.join(c, F.col("r.CustomerID") == F.col("c.CustomerID"))
        .groupBy(F.col("c.Country").alias("Country"))
        .agg(F.count_distinct(F.col("r.InvoiceNo")).alias("invoice_count"),
             F.round(F.sum(F.col("r.Quantity") * F.col("r.UnitPrice")), 2).cast("double")
             .alias("total_revenue"))
    )
    expected = rows(literal)
    assert rows(R.country_summary(lines, lines)) == expected
    assert rows(R.country_summary_self(lines)) == expected
    # UK: customer 1 has 2 UK lines, so its revenue (3 + 10 + 7.5) counts twice
    assert dict((k, v) for k, _, v in expected)["UK"] == 41.0


def test_direct_country_summary_is_not_inflated(lines):
    got = {r.Country: (r.invoice_count, r.total_revenue) for r in R.country_summary(lines).collect()}
    assert got == {"UK": (1, 13.0), "FR": (2, 29.25), "DE": (1, 7.25)}


def test_customer_patterns_having(lines):
    got = rows(R.customer_patterns(lines, 1), "CustomerID", "unique_products")
    assert got == [(1, 2)]


def test_monthly_revenue_skips_nothing_but_null_dates(lines):
    got = rows(R.monthly_revenue(lines), "year", "month", "monthly_revenue")
    assert got == sorted([(2010, 12, 13.0), (2011, 2, 29.25), (None, None, 7.25)], key=repr)


# -- E1 equals the literal join on random data, and survives a hot customer -----

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

LINE = st.tuples(
    st.integers(1, 6),                     # invoice
    st.integers(1, 4),                     # customer
    st.sampled_from(["UK", "FR", "DE"]),   # country
    st.integers(1, 5),                     # quantity
    st.sampled_from([Decimal("1.25"), Decimal("2.50"), Decimal("9.99")]),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(LINE, min_size=1, max_size=25))
def test_e1_rewrites_equal_literal_joins(spark, data):
    df = spark.createDataFrame(
        [(inv, cust, country, q, p, q * p) for inv, cust, country, q, p in data],
        "InvoiceNo long, CustomerID long, Country string, Quantity int, UnitPrice decimal(18,2), "
        "TotalPrice decimal(29,2)")
    r, c = df.alias("r"), df.alias("c")
    literal_country = (
        r.join(c, F.col("r.CustomerID") == F.col("c.CustomerID"))
        .groupBy(F.col("c.Country").alias("Country"))
        .agg(F.count_distinct(F.col("r.InvoiceNo")).alias("invoice_count"),
             F.round(F.sum(F.col("r.Quantity") * F.col("r.UnitPrice")), 2).cast("double").alias("total_revenue")))
    assert rows(R.country_summary_self(df, share_base=False)) == rows(literal_country)
    literal_customer = (R.customer_transactions(df, R.distinct_customers(df))
                        .groupBy("CustomerID", "Country")
                        .agg(F.sum("TotalPrice").cast("double").alias("total_spent"),
                             F.count("InvoiceNo").alias("purchase_count")))
    assert rows(R.customer_summary_fanned(df)) == rows(literal_customer)


def test_hot_customer_third_of_lines(spark, scratch):
    """A third of all lines on one customer: E1 stays linear and exact.

    The literal self-join would emit (lines of the hot customer)^2 rows (about
    400 million here); the rewrite is checked against a DuckDB closed form.
    """
    import duckdb

    from ledgerlens.plans import catalogue as C

    lines = C.retail_lines(spark, "/root/testdata/sf0.01")
    hot_countries = [f"NATION_{i}" for i in range(8)]
    skewed = lines.withColumn(
        "CustomerID", F.when(F.col("Country").isin(hot_countries), F.lit(-1)).otherwise(F.col("CustomerID")))
    total = skewed.count()
    hot = skewed.filter(F.col("CustomerID") == -1).count()
    assert hot * 4 > total  # the hot customer holds over a quarter of all lines
    path = f"{scratch}/skewed.parquet"
    skewed.select("InvoiceNo", "CustomerID", "Country", "Quantity", "UnitPrice").write.parquet(path)
    got = rows(R.country_summary_self(spark.read.parquet(path)))
    con = duckdb.connect()
    want = con.execute(f"""
        WITH l AS (SELECT * FROM read_parquet('{path}/*.parquet')),
        rev AS (SELECT CustomerID, SUM(Quantity * UnitPrice) AS r FROM l GROUP BY 1),
        n AS (SELECT CustomerID, Country, COUNT(*) AS n FROM l GROUP BY 1, 2),
        inv AS (SELECT DISTINCT CustomerID, InvoiceNo FROM l)
        SELECT a.Country, a.invoice_count, b.total_revenue FROM
          (SELECT n.Country, COUNT(DISTINCT inv.InvoiceNo) AS invoice_count
           FROM n JOIN inv ON n.CustomerID = inv.CustomerID GROUP BY 1) a
        JOIN (SELECT n.Country, CAST(ROUND(SUM(n.n * rev.r), 2) AS DOUBLE) AS total_revenue
              FROM n JOIN rev ON n.CustomerID = rev.CustomerID GROUP BY 1) b ON a.Country = b.Country
    """).fetchall()
    assert got == sorted(want, key=repr)
