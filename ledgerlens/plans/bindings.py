"""Bindings of the reference's data model onto the driver tables.

The reference works on a 120-row orders CSV, a retail-lines CSV and two text
files.  Here the same queries run on the TPC-H-like parquet tables:

* ``sales``  - one row per order line (the reference's ``orders`` grain).
* ``retail`` - one row per invoice line (the reference's ``Online_Retail``).
* ``documents`` - ``(doc_id, text)``; a document plays the role of a text file.

Scale notes
-----------
The fact is ``lineitem``; every dimension is joined with a LEFT join on its
primary key (``o_orderkey``, ``c_custkey``, ``n_nationkey``, ``p_partkey``).
A left join on a unique key never adds or removes fact rows, so a dimension
whose columns a query does not use can be left out without changing any
result.  ``sales(..., cols)`` therefore joins only the dimensions the requested
columns need: a per-category summary is ``lineitem LEFT JOIN part`` and never
shuffles the fact on the order or customer key.  Join sides are left to the
planner and AQE, which broadcast a side only below
``spark.sql.autoBroadcastJoinThreshold`` (static estimate) or its adaptive
twin (measured shuffle size); no side is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import money
from ledgerlens.operators.retail import RETAIL_KEY  # noqa: F401  (re-exported with LINE_KEY)
from ledgerlens.operators.sales import LINE_KEY

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (parquet; filters and projections push into the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_with_dims(spark: SparkSession, sf_dir: str, with_customer: bool, with_nation: bool) -> DataFrame:
    """``orders``, LEFT-joined with customer and nation where asked for.

    The dimensions of an order are joined to the orders (a quarter of the fact)
    and the fact is joined to the result once, so it is shuffled by the order
    key only.  All joins are on unique keys.
    """
    orders = table(spark, sf_dir, "orders")
    if not with_customer:
        return orders
    cust = table(spark, sf_dir, "customer")
    if with_nation:
        nation = table(spark, sf_dir, "nation")
        cust = cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
    return orders.join(cust, orders.o_custkey == cust.c_custkey, "left")


def with_dims(spark: SparkSession, sf_dir: str, dims: set[str]) -> DataFrame:
    """``lineitem`` LEFT-joined with the dimensions named: o(rders), c(ustomer), n(ation), p(art)."""
    fact = table(spark, sf_dir, "lineitem")
    if "o" in dims:
        orders = orders_with_dims(spark, sf_dir, "c" in dims, "n" in dims)
        fact = fact.join(orders, fact.l_orderkey == orders.o_orderkey, "left")
    if "p" in dims:
        part = table(spark, sf_dir, "part")
        fact = fact.join(part, fact.l_partkey == part.p_partkey, "left")
    return fact


def _pick(spark: SparkSession, sf_dir: str, spec: dict[str, tuple[str, Column]], wanted: list[str]) -> DataFrame:
    """The wanted columns of a binding, joining only the dimensions they need."""
    unknown = [c for c in wanted if c not in spec]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    dims: set[str] = set()
    for c in wanted:
        d = spec[c][0]
        while d:
            dims.add(d)
            d = _DIM_PARENT[d]
    return with_dims(spark, sf_dir, dims).select(*[spec[c][1].alias(c) for c in wanted])


# --------------------------------------------------------------------------
# SALES: the orders data set of the reference, one row per order line
# --------------------------------------------------------------------------

# Line key (LINE_KEY): (l_orderkey, l_linenumber) is not unique in the driver
# data; the six lineitem columns of LINE_KEY together are.  Every top-k / limit
# orders by them last.

# dimension -> dimensions it needs first
_DIM_PARENT = {"o": None, "c": "o", "n": "c", "p": None}


def _sales_columns() -> dict[str, tuple[str, Column]]:
    qty = F.col("l_quantity").cast("int")
    price = money("p_retailprice", 2)
    disc = F.col("l_discount").cast("decimal(4,2)")
    return {
        "order_id": ("", F.col("l_orderkey")),
        "line_number": ("", F.col("l_linenumber")),
        "product_id": ("", F.col("l_partkey")),
        "supplier_id": ("", F.col("l_suppkey")),
        "ext_price": ("", F.col("l_extendedprice")),
        "ship_date": ("", F.col("l_shipdate")),
        # the source keeps order dates as timestamps at midnight; kept as such
        "order_date": ("o", F.col("o_orderdate")),
        "customer_id": ("o", F.col("o_custkey")),
        "city": ("n", F.col("n_name")),
        "customer_segment": ("c", F.col("c_mktsegment")),
        "product_name": ("p", F.col("p_name")),
        "category": ("p", F.col("p_type")),
        "quantity": ("", qty),
        "unit_price": ("p", price),
        "discount_rate": ("", disc),
        "sales_amount": ("p", (qty * price * (F.lit(1) - disc)).cast("decimal(18,4)")),
        "channel": ("o", F.col("o_orderpriority")),
        "payment_method": ("", F.col("l_linestatus")),
        "returned": ("", F.when(F.col("l_returnflag") == "R", "Yes").otherwise("No")),
        "return_flag": ("", F.col("l_returnflag")),
        # rating 3/4/5 by part size band; parts above size 40 are unrated (NULL)
        "rating": ("p", F.when(F.col("p_size") <= 15, 3).when(F.col("p_size") <= 30, 4)
                   .when(F.col("p_size") <= 40, 5)),
    }


SALES_COLUMNS = (
    "order_id", "line_number", "product_id", "supplier_id", "ext_price", "ship_date",
    "order_date", "customer_id", "city", "customer_segment", "product_name", "category",
    "quantity", "unit_price", "discount_rate", "sales_amount", "channel", "payment_method",
    "returned", "return_flag", "rating",
)


def sales(spark: SparkSession, sf_dir: str, cols: Iterable[str] | None = None) -> DataFrame:
    """The order-line fact with the requested columns (all when ``cols`` is None).

    The line-key columns are always present (Catalyst prunes them when unused).
    """
    wanted = list(dict.fromkeys([*(cols or SALES_COLUMNS), *LINE_KEY]))
    return _pick(spark, sf_dir, _sales_columns(), wanted)


def sales_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SALES rendered as strings, the way a header-only CSV read would give it."""
    s = sales(spark, sf_dir)
    out = [F.col(c) for c in LINE_KEY]
    out.append(F.date_format("order_date", "yyyy-MM-dd").alias("order_date"))
    for c in ("customer_id", "city", "customer_segment", "product_id",
              "product_name", "category", "quantity", "unit_price", "discount_rate",
              "sales_amount", "channel", "payment_method", "returned", "rating"):
        if c in LINE_KEY:
            continue
        out.append(F.col(c).cast("string").alias(c))
    return s.select(*out)


def messy_sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SALES as text with the defects a hand-kept CSV has.

    Rules (all derived from the data, none drop rows): open lines carry a unit
    suffix on the quantity (``"12 pcs"``), other second, third and fourth lines went
    through a float column (``"12.0"``, ``"12.7"``, ``"12e2"``); returned lines lost their unit
    price (empty cell); undiscounted lines say ``"none"``; lines with return
    flag ``A`` have no returned value; low-priority orders have the date
    ``"unknown"``; a missing rating is an empty cell.
    """
    s = sales(spark, sf_dir, ["order_date", "quantity", "unit_price", "discount_rate",
                              "sales_amount", "returned", "return_flag", "rating",
                              "payment_method", "channel", "category"])
    return s.select(
        *[F.col(c) for c in LINE_KEY],
        F.col("category"),
        F.when(F.col("channel") == "5-LOW", F.lit("unknown"))
        .otherwise(F.date_format("order_date", "yyyy-MM-dd")).alias("order_date"),
        F.when(F.col("payment_method") == "O", F.concat(F.col("quantity").cast("string"), F.lit(" pcs")))
        .when(F.col("line_number") == 2, F.concat(F.col("quantity").cast("string"), F.lit(".0")))
        .when(F.col("line_number") == 3, F.concat(F.col("quantity").cast("string"), F.lit(".7")))
        .when(F.col("line_number") == 4, F.concat(F.col("quantity").cast("string"), F.lit("e2")))
        .otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.when(F.col("returned") == "Yes", F.lit(""))
        .otherwise(F.col("unit_price").cast("string")).alias("unit_price"),
        F.when(F.col("discount_rate") == 0, F.lit("none"))
        .otherwise(F.col("discount_rate").cast("string")).alias("discount_rate"),
        F.col("sales_amount").cast("string").alias("sales_amount"),
        F.when(F.col("return_flag") != "A", F.col("returned")).alias("returned"),
        F.coalesce(F.col("rating").cast("string"), F.lit("")).alias("rating"),
    )


# --------------------------------------------------------------------------
# RETAIL: the online-retail lines of the reference
# --------------------------------------------------------------------------

def _retail_columns() -> dict[str, tuple[str, Column]]:
    return {
        "InvoiceNo": ("", F.col("l_orderkey")),
        "StockCode": ("", F.col("l_partkey")),
        "Description": ("p", F.col("p_name")),
        "Quantity": ("", F.col("l_quantity").cast("int")),
        "InvoiceDate": ("o", F.date_format("o_orderdate", "d/M/yyyy H:mm")),
        "UnitPrice": ("p", money("p_retailprice", 2)),
        "CustomerID": ("c", F.when(F.col("c_acctbal") >= 0, F.col("o_custkey"))),
        "Country": ("n", F.col("n_name")),
        "LineNo": ("", F.col("l_linenumber")),
        "SupplierNo": ("", F.col("l_suppkey")),
        "LineAmount": ("", F.col("l_extendedprice")),
        "ShipDate": ("", F.col("l_shipdate")),
    }


def retail_raw(spark: SparkSession, sf_dir: str, cols: Iterable[str] | None = None) -> DataFrame:
    """Retail lines as loaded, before cleaning: the columns asked for (default all).

    ``CustomerID`` (always there: cleaning drops lines without it) is NULL for
    customers whose account is in debit (``c_acctbal < 0``) - the anonymous lines
    the reference drops first.  ``InvoiceDate`` is the day-first text
    ``d/M/yyyy H:mm`` of the source.  The line-key columns are always present.
    """
    spec = _retail_columns()
    return _pick(spark, sf_dir, spec, list(dict.fromkeys([*(cols or spec), "CustomerID", *RETAIL_KEY])))


def retail_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail lines as the untyped file has them: numbers as text, some unreadable.

    A file with missing customer keys holds the others as ``17850.0``; third lines
    say ``2 for 1`` for the quantity, fourth lines have it as ``1.2e1``-style text,
    and lines returned have an empty price.
    """
    spec = _retail_columns()
    lines = with_dims(spark, sf_dir, {"o", "c", "p"})
    keys = [spec[c][1].alias(c) for c in RETAIL_KEY]
    quantity = F.col("l_quantity").cast("int")
    text = (
        F.when(F.col("l_linenumber") == 3, F.lit("2 for 1"))
        .when(F.col("l_linenumber") == 4, F.concat(quantity.cast("string"), F.lit("e1")))
        .when(F.col("l_linenumber") == 5, F.concat(quantity.cast("string"), F.lit(".7")))
        .otherwise(quantity.cast("string"))
    )
    return lines.select(
        *keys,
        F.concat(spec["CustomerID"][1].cast("string"), F.lit(".0")).alias("CustomerID"),
        text.alias("Quantity"),
        F.when(F.col("l_returnflag") == "R", F.lit("")).otherwise(spec["UnitPrice"][1].cast("string")).alias("UnitPrice"),
    )


# RETAIL_KEY (imported) is the line key of RETAIL, the order of every limit on it.

# The country flagged by IsUK (the reference's "United Kingdom").
HOME_COUNTRY = "NATION_0"


# --------------------------------------------------------------------------
# Text
# --------------------------------------------------------------------------

def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``: one document per row; it replaces the text files."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")
