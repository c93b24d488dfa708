"""Sales operators: golden values on the reference's orders sample + invariants."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import sales as S
from ledgerlens.sources import read_csv

# An invented orders file; the golden values below are worked out by hand from it.
ORDERS_CSV = os.path.join(os.path.dirname(os.path.abspath(__file__)), "orders_sample.csv")


@pytest.fixture(scope="module")
def orders(spark):
    df = read_csv(spark, ORDERS_CSV)
    return df.select(
        F.col("order_id"), F.to_date("order_date").alias("order_date"), "city", "customer_segment",
        "product_name", "category", F.col("quantity").cast("int").alias("quantity"), "channel",
        F.col("sales_amount_krw").cast("decimal(18,4)").alias("sales_amount"), "returned",
        F.col("rating").cast("int").alias("rating"),
    )


def test_golden_row_and_null_counts(orders):
    r = S.missing_counts(orders, ["rating"]).first()
    assert (r.total_rows, r.missing_ratings) == (8, 2)
    assert orders.filter(F.col("returned") == "Yes").count() == 2
    assert orders.filter(F.col("product_name") == "Cable, long").count() == 1


def test_golden_category_summary_and_return_rate(orders):
    summary = {r.category: r for r in S.category_summary(orders).collect()}
    assert {k: (v.number_of_orders, v.total_units, v.total_sales_krw) for k, v in summary.items()} == {
        "Home": (3, 4, 1251.0), "Office": (3, 20, 68.0), "Tech": (2, 4, 1260.0)}
    rates = {r.category: (r.returned_orders, r.return_rate_percent)
             for r in S.rate_by(orders, "category", F.col("returned") == "Yes").collect()}
    assert rates == {"Home": (1, 33.33), "Office": (1, 33.33), "Tech": (0, 0.0)}
    unreturned = {r.category: r.revenue_krw
                  for r in S.revenue_by(orders, "category", F.col("returned") == "No").collect()}
    assert unreturned == {"Home": 1000.0, "Office": 50.0, "Tech": 1260.0}


def test_golden_bands_months_cities(orders):
    bands = ((500, "High value"), (50, "Medium value"))
    counts = {r.order_value_group: r.orders for r in S.band_counts(orders, bands, "Low value").collect()}
    assert counts == {"High value": 2, "Medium value": 3, "Low value": 3}
    months = {r.order_month.strftime("%Y-%m"): r.monthly_revenue_krw
              for r in S.monthly_trend(orders).collect()}
    assert months == {"2025-01": 381.0, "2025-02": 938.0, "2025-03": 1260.0}
    top = [(r.city, r.revenue_krw) for r in S.top_by_revenue(orders, "city", 3).collect()]
    assert [c for c, _ in top] == ["Southgate", "Eastby", "Northam"]


def test_share_sums_to_hundred(orders):
    shares = S.share_of_total(orders.filter(F.col("returned") == "No"), "category", "sales_amount")
    total = sum(r.revenue_share_percent for r in shares.collect())
    assert abs(total - 100.0) <= 0.1


def test_rank_keeps_ties_and_starts_at_one(spark):
    df = spark.createDataFrame(
        [("a", "x1", Decimal("5")), ("a", "x2", Decimal("5")), ("a", "x3", Decimal("4")),
         ("a", "x4", Decimal("3")), ("b", "y1", Decimal("1"))],
        "category string, product_name string, sales_amount decimal(18,4)",
    ).withColumn("order_id", F.monotonically_increasing_id())
    out = S.rank_in_category(df, 2).collect()
    ranks = sorted((r.category, r.product_name, r.rank_within_category) for r in out)
    # x1/x2 tie at rank 1, x3 is rank 3 (> 2) and dropped
    assert ranks == [("a", "x1", 1), ("a", "x2", 1), ("b", "y1", 1)]
    no_ties = S.top_per_group(df, "category", F.col("sales_amount").desc(), 2, "rk", ties=False)
    assert no_ties.filter(F.col("category") == "a").count() == 2


def test_value_band_order_is_first_match(spark):
    df = spark.createDataFrame([(Decimal("50"),), (Decimal("20"),), (Decimal("5"),), (None,)],
                               "sales_amount decimal(18,4)")
    from ledgerlens.functions.cleaning import value_band
    got = [r[0] for r in df.select(value_band("sales_amount", [(40, "H"), (10, "M")], "L")).collect()]
    assert got == ["H", "M", "L", "L"]


def test_star_join_uses_dimensions(spark):
    fact = spark.createDataFrame(
        [(1, 1, 10, 2, Decimal("3.5"), "2026-01-02"), (2, 2, 11, 1, Decimal("1.0"), "2026-01-01"),
         (3, 9, 10, 1, Decimal("2.0"), "2026-01-03")],
        "order_id long, customer_id long, product_id long, quantity int, sales_amount decimal(18,4), "
        "order_date string",
    ).withColumn("order_date", F.to_date("order_date"))
    cust = spark.createDataFrame([(1, "Seoul", "Premium"), (2, "Busan", "Basic")],
                                 "customer_id long, home_city string, segment_from_dim string")
    prod = spark.createDataFrame([(10, "Laptop", "Electronics"), (11, "Desk", "Furniture")],
                                 "product_id long, product_name_dim string, category_from_dim string")
    joined = S.star_join(fact, [(cust, "customer_id"), (prod, "product_id")])
    out = [(r.order_id, r.home_city, r.product_name_dim) for r in S.star_preview(joined, 20).collect()]
    assert out == [(2, "Busan", "Desk"), (1, "Seoul", "Laptop")]  # order 3 has no customer
