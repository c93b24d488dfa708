"""Retail-line analytics: the online-retail notebook as DataFrame functions.

Input columns: InvoiceNo, StockCode, Description, Quantity, InvoiceDate (day-
first text), UnitPrice (decimal), CustomerID (nullable), Country, plus the line
key of ``ledgerlens.plans.bindings.RETAIL_KEY`` for deterministic limits.

Two notebook queries join the lines with themselves on the customer (D12,
D13).  Written literally, a customer with m lines produces m x m rows - at
scale one hot customer makes that quadratic.  ``country_summary`` and
``customer_summary`` therefore aggregate *below* the join (eager
aggregation): per-customer partial results are joined instead of lines, which
gives exactly the same numbers (the sums are decimal) with no fan-out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import flag, flip_day_month, mean_of, parse_ts, round_mean, to_number
from ledgerlens.session import materialize

RETAIL_KEY = ("InvoiceNo", "LineNo", "StockCode", "SupplierNo", "LineAmount", "ShipDate")


def _key_order(df: DataFrame) -> list[Column]:
    return [F.col(c).asc() for c in RETAIL_KEY if c in df.columns]


def clean_lines(df: DataFrame, home_country: str) -> DataFrame:
    """Drop anonymous lines, repair day-first dates, add TotalPrice and IsUK.

    ``13/12/2010 9:09`` becomes ``12/13/2010 9:09`` and is parsed with
    ``M/d/yyyy H:mm``, without a time zone; text that still does not parse becomes
    NULL.  Columns whose sources are absent are left out.
    """
    out = df.filter(F.col("CustomerID").isNotNull())
    has = set(df.columns)
    if "InvoiceDate" in has:
        out = out.withColumn("InvoiceDate", parse_ts(flip_day_month("InvoiceDate"), "M/d/yyyy H:mm"))
    if {"Quantity", "UnitPrice"} <= has:
        out = out.withColumn("TotalPrice", F.col("Quantity") * F.col("UnitPrice"))
    if "Country" in has:
        out = out.withColumn("IsUK", flag(F.col("Country") == home_country))
    return out


def load_lines(df: DataFrame) -> DataFrame:
    """Typed retail lines of an untyped load.

    The customer key becomes an integer (``17850.0`` is 17850; unreadable or missing:
    NULL); quantities and prices that cannot be read become 0, fractions of a
    quantity are cut off.
    """
    return df.withColumns({
        "CustomerID": to_number("CustomerID", "bigint"),
        "Quantity": to_number("Quantity", "int", 0),
        "UnitPrice": to_number("UnitPrice", "double", 0.0),
    })


def as_reported(df: DataFrame) -> DataFrame:
    """Public columns of cleaned lines with money as double."""
    return df.select(
        "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate",
        F.col("UnitPrice").cast("double").alias("UnitPrice"), "CustomerID", "Country",
        F.col("TotalPrice").cast("double").alias("TotalPrice"), "IsUK",
    )


def high_value(df: DataFrame, min_total, min_qty) -> DataFrame:
    """Lines above both thresholds."""
    return df.filter((F.col("TotalPrice") > min_total) & (F.col("Quantity") > min_qty))


def high_value_top(df: DataFrame, min_total, min_qty, n: int = 50) -> DataFrame:
    """The ``n`` largest high-value lines, TotalPrice rounded to cents (F3 + O5)."""
    top = high_value(df, min_total, min_qty).orderBy(F.col("TotalPrice").desc(), *_key_order(df)).limit(n)
    return top.select(
        "InvoiceNo", "StockCode", "Description", "Quantity",
        F.col("UnitPrice").cast("double").alias("UnitPrice"),
        F.round("TotalPrice", 2).cast("double").alias("TotalPrice"), "CustomerID", "Country",
    )


def product_stats(df: DataFrame) -> DataFrame:
    """Units, mean line value and line count per product (A2)."""
    return df.groupBy("StockCode", "Description").agg(
        F.sum("Quantity").cast("bigint").alias("total_quantity"),
        mean_of("TotalPrice").alias("avg_price"),
        F.count("InvoiceNo").alias("transaction_count"),
    )


def product_stats_top(df: DataFrame, n: int = 20) -> DataFrame:
    """Products by units, mean rounded to cents, top ``n`` (A3 + O5)."""
    agg = df.groupBy("StockCode", "Description").agg(
        F.sum("Quantity").cast("bigint").alias("total_quantity"),
        round_mean("TotalPrice", 2).alias("avg_price"),
        F.count("InvoiceNo").alias("transaction_count"),
    )
    return agg.orderBy(F.col("total_quantity").desc(), "StockCode", "Description").limit(n)


def distinct_customers(df: DataFrame) -> DataFrame:
    """Distinct (CustomerID, Country) pairs."""
    return df.select("CustomerID", "Country").distinct()


def customer_transactions(lines: DataFrame, customers: DataFrame) -> DataFrame:
    """Lines joined with the customer list minus Country.

    As in the reference, a customer listed with k countries has every line
    repeated k times; the output is as large as that, by definition.
    """
    ids = customers.select([c for c in customers.columns if c != "Country"])
    return lines.join(ids, "CustomerID", "inner")


def transactions_preview(df: DataFrame, n: int = 50) -> DataFrame:
    """First ``n`` lines by customer, money rounded."""
    top = df.orderBy("CustomerID", *_key_order(df)).limit(n)
    return top.select(
        "CustomerID", "InvoiceNo", "StockCode", "Description", "Quantity",
        F.round("UnitPrice", 2).cast("double").alias("UnitPrice"),
        F.round("TotalPrice", 2).cast("double").alias("TotalPrice"), "Country",
    )


def customer_summary(lines: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Spend and purchase count per (customer, country) (J1 + A2).

    With ``customers`` this equals aggregating ``customer_transactions`` (each
    line counted once per listed country of its customer), computed as
    per-(customer, country) aggregates multiplied by the customer's number of
    listed countries - no line is repeated.  Without ``customers``, lines are
    aggregated directly (the display variant).  When ``customers`` is the
    distinct pairs of the same lines, use ``customer_summary_fanned``.
    """
    agg = lines.groupBy("CustomerID", "Country").agg(
        F.sum("TotalPrice").alias("_spent"), F.count("InvoiceNo").alias("_n"))
    if customers is None:
        return agg.select("CustomerID", "Country", F.col("_spent").cast("double").alias("total_spent"),
                          F.col("_n").alias("purchase_count"))
    k = customers.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("_k"))
    return agg.join(k, "CustomerID", "inner").select(
        "CustomerID", "Country",
        (F.col("_spent") * F.col("_k")).cast("double").alias("total_spent"),
        (F.col("_n") * F.col("_k")).alias("purchase_count"),
    )


def customer_summary_fanned(lines: DataFrame) -> DataFrame:
    """``customer_summary(lines, distinct_customers(lines))`` from a single pass.

    The per-(customer, country) aggregate is computed once; its pairs are
    exactly the distinct pairs, so the number of countries of a customer is a
    window count over that aggregate.  A window group holds one row per
    country of the customer - bounded by the number of countries, however
    many lines a hot customer has.
    """
    agg = lines.groupBy("CustomerID", "Country").agg(
        F.sum("TotalPrice").alias("_spent"), F.count("InvoiceNo").alias("_n"))
    per_customer = Window.partitionBy("CustomerID")
    return agg.withColumn("_k", F.count(F.lit(1)).over(per_customer)).select(
        "CustomerID", "Country",
        (F.col("_spent") * F.col("_k")).cast("double").alias("total_spent"),
        (F.col("_n") * F.col("_k")).alias("purchase_count"),
    )


def customer_summary_top(lines: DataFrame, n: int = 20) -> DataFrame:
    """Customers by spend rounded to cents, top ``n`` (A3 + O5)."""
    agg = lines.groupBy("CustomerID", "Country").agg(
        F.round(F.sum("TotalPrice"), 2).cast("double").alias("total_spent"),
        F.count("InvoiceNo").alias("purchase_count"))
    return agg.orderBy(F.col("total_spent").desc(), "CustomerID", "Country").limit(n)


def bulk_orders(df: DataFrame, min_qty) -> DataFrame:
    """Lines with a large quantity, largest first (F4 + O1)."""
    return df.filter(F.col("Quantity") > min_qty).select(
        "CustomerID", "Description", "Quantity",
        F.col("UnitPrice").cast("double").alias("UnitPrice"),
    ).orderBy(F.col("Quantity").desc())


def country_summary(lines: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Distinct invoices and revenue per country (J2 + A5 + A14).

    With ``customers`` (the reference's ``retail r JOIN customers c ON
    r.CustomerID = c.CustomerID``, where ``customers`` holds lines too), every
    line of a customer is counted once per customer line in each country, as
    written (D13).  Computed by eager aggregation (E1):

    * revenue(country)  = sum over customers of n(customer, country) x R(customer)
    * invoices(country) = distinct invoices of customers having lines there

    where R is the customer's line revenue and n the customer's line count in
    the country.  Without ``customers`` it is the plain per-country summary.
    """
    amount = F.col("Quantity") * F.col("UnitPrice")
    if customers is None:
        return lines.groupBy("Country").agg(
            F.count_distinct("InvoiceNo").alias("invoice_count"),
            F.round(F.sum(amount), 2).cast("double").alias("total_revenue"))
    rev = lines.groupBy("CustomerID").agg(F.sum(amount).alias("_r"))
    inv = lines.select("CustomerID", "InvoiceNo").distinct()
    n = customers.groupBy("CustomerID", "Country").agg(F.count(F.lit(1)).alias("_n"))
    return _country_summary_from(rev, inv, n)


def country_summary_self(lines: DataFrame, share_base: bool = True) -> DataFrame:
    """``country_summary(lines, lines)`` with the lines read and shuffled once.

    One aggregate per (customer, country, invoice) carries revenue and line
    count; revenue per customer, line count per (customer, country) and the
    distinct (customer, invoice) pairs are all re-aggregations of it.  It is
    written once to the shared checkpoint folder (``materialize``), so the
    lines are scanned, joined and shuffled once instead of once per branch.
    ``share_base=False`` skips the write and lets each branch recompute it -
    cheaper only when the input is small.
    """
    amount = F.col("Quantity") * F.col("UnitPrice")
    base = lines.groupBy("CustomerID", "Country", "InvoiceNo").agg(
        F.sum(amount).alias("_r"), F.count(F.lit(1)).alias("_c"))
    if share_base:
        base = materialize(base, "country-summary-base")
    rev = base.groupBy("CustomerID").agg(F.sum("_r").alias("_r"))
    inv = base.select("CustomerID", "InvoiceNo").distinct()
    n = base.groupBy("CustomerID", "Country").agg(F.sum("_c").alias("_n"))
    return _country_summary_from(rev, inv, n)


def _country_summary_from(rev: DataFrame, inv: DataFrame, n: DataFrame) -> DataFrame:
    revenue = n.join(rev, "CustomerID", "inner").groupBy("Country").agg(
        F.round(F.sum(F.col("_n") * F.col("_r")), 2).cast("double").alias("total_revenue"))
    invoices = (
        inv.join(n.select("CustomerID", "Country"), "CustomerID", "inner")
        .groupBy("Country").agg(F.count_distinct("InvoiceNo").alias("invoice_count"))
    )
    return invoices.join(revenue, "Country", "inner").select("Country", "invoice_count", "total_revenue")


def customer_patterns(df: DataFrame, min_products: int) -> DataFrame:
    """Customers buying more than ``min_products`` distinct products."""
    return (
        df.groupBy("CustomerID")
        .agg(F.count_distinct("StockCode").alias("unique_products"),
             F.avg("Quantity").alias("avg_quantity"))
        .filter(F.col("unique_products") > min_products)
    )


def monthly_revenue(df: DataFrame) -> DataFrame:
    """Revenue per (year, month) of the invoice date."""
    return df.groupBy(
        F.year("InvoiceDate").cast("bigint").alias("year"),
        F.month("InvoiceDate").cast("bigint").alias("month"),
    ).agg(F.sum("TotalPrice").cast("double").alias("monthly_revenue"))


def distinct_by_bitmap(df: DataFrame, key: str, id_col: str, name: str) -> DataFrame:
    """Exact distinct counts of an integer id per key, by bitmaps (A5): (key, <name>).

    An id is a bit of a bucket's bitmap (32,768 ids, 4 kB); tasks build the bitmaps of
    their rows and only these are shuffled and or-ed, so a key with any number of rows
    sends one row per task and bucket, and no set of ids is built.  Null ids count as
    none; negative ids have buckets of their own.
    """
    value = F.col(id_col).cast("long")
    bitmaps = df.groupBy(key, F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
    return bitmaps.groupBy(key).agg(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits")).otherwise(0)).alias(name))
