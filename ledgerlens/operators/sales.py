"""Order-line analytics: the orders notebook of the reference as DataFrame functions.

Input is an order-line frame with (a subset of) the columns of
``ledgerlens.plans.bindings.SALES_COLUMNS``.  Money (``sales_amount``) is a
decimal so sums are exact and independent of row order; results are cast to
double at the very end.  Every limit orders by a unique key so the returned
set is deterministic.

Scale: all aggregates are hash aggregates with map-side partial aggregation,
so a category holding a third of all lines costs one partial row per task, not
a hot reducer.  Top-k queries plan as ``TakeOrderedAndProject`` (per-partition
top-k, then a k-row merge); top-k-per-group plans with ``WindowGroupLimit``
before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import money_sum, round_mean, round_sum, value_band

# Unique key of an order line: (order_id, line_number) alone repeats in the driver data.
LINE_KEY = ("order_id", "line_number", "product_id", "supplier_id", "ext_price", "ship_date")


def _line_order(df: DataFrame) -> list[Column]:
    return [F.col(c).asc() for c in LINE_KEY if c in df.columns]


def category_summary(df: DataFrame) -> DataFrame:
    """Orders, units, revenue and mean order value per category (A3)."""
    return df.groupBy("category").agg(
        F.count(F.lit(1)).alias("number_of_orders"),
        F.sum("quantity").cast("bigint").alias("total_units"),
        round_sum("sales_amount", 0).alias("total_sales_krw"),
        round_mean("sales_amount", 0).alias("avg_order_value_krw"),
    )


def segment_channel(df: DataFrame) -> DataFrame:
    """Orders and revenue per (segment, channel) (A4)."""
    return df.groupBy("customer_segment", "channel").agg(
        F.count(F.lit(1)).alias("orders"),
        round_sum("sales_amount", 0).alias("revenue_krw"),
    )


def monthly_trend(df: DataFrame) -> DataFrame:
    """Orders and revenue per calendar month (A13); the month is a timestamp."""
    month = F.date_trunc("month", F.col("order_date").cast("timestamp_ntz")).cast("timestamp_ntz")  # date or timestamp input
    return df.groupBy(month.alias("order_month")).agg(
        F.count(F.lit(1)).alias("orders"),
        round_sum("sales_amount", 0).alias("monthly_revenue_krw"),
    )


def top_n(df: DataFrame, order: Sequence[Column], n: int, tie_break: Sequence[Column] = ()) -> DataFrame:
    """First ``n`` rows by ``order`` then ``tie_break`` (O5, a TakeOrderedAndProject)."""
    return df.orderBy(*order, *tie_break).limit(n)


def filtered_top(df: DataFrame, category: str, returned: str, n: int = 10) -> DataFrame:
    """Lines of a category with a returned flag, largest first (F2 + O5)."""
    picked = df.filter((F.col("category") == category) & (F.col("returned") == returned))
    return top_n(picked, [F.col("sales_amount").desc()], n, _line_order(df)).select(
        "order_id", "order_date", "city", "product_name", "category", "quantity",
        F.col("sales_amount").cast("double").alias("sales_amount_krw"),
    )


def value_bands(df: DataFrame, bands: Sequence[tuple[object, str]], otherwise: str, n: int | None = 15) -> DataFrame:
    """Each line with its value band; the ``n`` largest when ``n`` is given (P9 + O5)."""
    out = df.select(
        "order_id", "product_name", "sales_amount",
        value_band("sales_amount", bands, otherwise).alias("order_value_group"),
        *[c for c in LINE_KEY if c in df.columns and c != "order_id"],
    )
    if n is not None:
        out = top_n(out, [F.col("sales_amount").desc()], n, _line_order(out))
    return out.select(
        "order_id", "product_name",
        F.col("sales_amount").cast("double").alias("sales_amount_krw"),
        "order_value_group",
    )


def band_counts(df: DataFrame, bands: Sequence[tuple[object, str]], otherwise: str) -> DataFrame:
    """Lines per value band."""
    return df.groupBy(value_band("sales_amount", bands, otherwise).alias("order_value_group")).agg(
        F.count(F.lit(1)).alias("orders"))


def missing_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and NULL count per column in one pass (A7 + A10)."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}s") for c in cols],
    )


def null_filled(df: DataFrame, col: str, fill, n: int | None = 10) -> DataFrame:
    """Rows where ``col`` is NULL, with the value filled (F6 + P10); first ``n`` by line key."""
    out = df.filter(F.col(col).isNull())
    if n is not None:
        out = top_n(out, [], n, _line_order(df))
    return out.select(
        "order_id", "product_name", F.col(col),
        F.coalesce(F.col(col), F.lit(fill)).alias(f"{col}_filled_with_zero"),
    )


def star_join(fact: DataFrame, dimensions: list[tuple[DataFrame, str]]) -> DataFrame:
    """Fact inner-joined to each (dimension, key) in turn.

    The planner/AQE broadcasts a dimension when its size is under the broadcast
    threshold and shuffles otherwise.  A dimension of a dimension is best joined to
    it first, so that the fact is shuffled once per key of its own.
    """
    for dimension, key in dimensions:
        fact = fact.join(dimension, key, "inner")
    return fact


def star_preview(joined: DataFrame, n: int | None = 20) -> DataFrame:
    """The public columns of the star join, earliest ``n`` lines first."""
    if n is not None:
        joined = top_n(joined, [F.col("order_date").asc()], n, _line_order(joined))
    return joined.select(
        "order_id", "order_date", "home_city", "segment_from_dim", "product_name_dim",
        "category_from_dim", "quantity",
        F.col("sales_amount").cast("double").alias("sales_amount_krw"),
    )


def share_of_total(df: DataFrame, key: str, value: str, value_name: str = "revenue_krw",
                   share_name: str = "revenue_share_percent") -> DataFrame:
    """Sum per key and its percentage of the grand total.

    The grand total is the sum of the (small) per-key aggregate, attached as a
    scalar subquery: no join, and the per-key exchange is shared by the
    subquery and the main plan under AQE.
    """
    per_key = df.groupBy(key).agg(F.sum(value).cast("decimal(24,4)").alias("_v"))
    total = per_key.agg(F.sum("_v").cast("decimal(24,4)").alias("_t")).scalar()
    # decimal(24,4) operands keep 10 exact decimals in the quotient before rounding
    share = F.round(F.lit(100).cast("decimal(3,0)") * F.col("_v") / total, 2)
    return per_key.select(
        key,
        F.round("_v", 0).cast("double").alias(value_name),
        share.cast("double").alias(share_name),
    )


def top_per_group(df: DataFrame, key: str, order: Column, k: int, rank_name: str = "rank_within_category",
                  ties: bool = True) -> DataFrame:
    """Rows ranked within their group, kept while rank <= k (W1 + W2, QUALIFY).

    ``ties=True`` uses ``rank`` (ties at the border are all kept), otherwise
    ``row_number`` with the line key as tie-break.  The plain ``rank <= k``
    filter lets the planner insert a partial ``WindowGroupLimit`` before the
    shuffle, so a hot group ships at most k rows per task.
    """
    if ties:
        w = Window.partitionBy(key).orderBy(order)
        r = F.rank().over(w)
    else:
        w = Window.partitionBy(key).orderBy(order, *_line_order(df))
        r = F.row_number().over(w)
    return df.withColumn(rank_name, r).filter(F.col(rank_name) <= k).withColumn(
        rank_name, F.col(rank_name).cast("bigint"))


def rank_in_category(df: DataFrame, k: int = 3) -> DataFrame:
    """Top ``k`` lines per category by amount, ties kept."""
    ranked = top_per_group(df, "category", F.col("sales_amount").desc(), k)
    return ranked.select(
        "order_id", "category", "product_name",
        F.col("sales_amount").cast("double").alias("sales_amount_krw"),
        "rank_within_category",
    )


def revenue_by(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Exact revenue per key, optionally filtered (F1 + aggregate)."""
    if where is not None:
        df = df.filter(where)
    return df.groupBy(key).agg(money_sum("sales_amount").alias("revenue_krw"))


def top_by_revenue(df: DataFrame, key: str, n: int) -> DataFrame:
    """Top ``n`` keys by rounded revenue, key as tie-break."""
    agg = df.groupBy(key).agg(round_sum("sales_amount", 0).alias("revenue_krw"))
    return top_n(agg, [F.col("revenue_krw").desc()], n, [F.col(key).asc()])


def rate_by(df: DataFrame, key: str, cond: Column, total_name: str = "total_orders",
            hit_name: str = "returned_orders", rate_name: str = "return_rate_percent") -> DataFrame:
    """Count, conditional count and percentage per key (A7 + A8), fractional as in Spark.

    The percentage is rounded half-up in decimal arithmetic, so it is exact.
    """
    hits = F.count_if(cond)
    total = F.count(F.lit(1))
    rate = F.round(
        F.lit(100).cast("decimal(3,0)") * hits.cast("decimal(18,0)") / total.cast("decimal(20,0)"), 2)
    return df.groupBy(key).agg(
        total.alias(total_name), hits.alias(hit_name), rate.cast("double").alias(rate_name))
