"""Row cleaning of loaded order lines: typed refinement and lenient coercion.

``typed_orders`` is the notebook's refinement of a text-typed load (P6): plain
casts, which fail loudly under ANSI mode on malformed input.  ``lenient_orders``
is the forgiving variant (P11-P14): malformed numbers become 0 (or NULL for
the rating, which stays a floating-point column as in the web app's loader),
a missing returned flag becomes ``"No"`` and dates are normalised to
``yyyy-MM-dd`` with unparsable text as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.cleaning import date_parts, fill_default, to_day_string, to_number, trunc_to


def typed_orders(df: DataFrame) -> DataFrame:
    """Text columns to their types: date, int, double."""
    return (
        df.withColumn("order_date", F.to_date("order_date"))
        .withColumn("quantity", F.col("quantity").cast("int"))
        .withColumn("unit_price", F.col("unit_price").cast("double"))
        .withColumn("discount_rate", F.col("discount_rate").cast("double"))
        .withColumn("sales_amount", F.col("sales_amount").cast("double"))
        .withColumn("rating", F.col("rating").cast("int"))
    )


def lenient_orders(df: DataFrame) -> DataFrame:
    """Forgiving load of hand-kept order lines."""
    out = df.select(
        *[c for c in df.columns if c not in
          ("order_date", "quantity", "unit_price", "discount_rate", "sales_amount", "returned", "rating")],
        to_day_string("order_date").alias("order_date"),
        to_number("quantity", "int", 0).alias("quantity"),
        to_number("unit_price", "double", 0.0).alias("unit_price"),
        to_number("discount_rate", "double", 0.0).alias("discount_rate"),
        to_number("sales_amount", "double", 0.0).alias("sales_amount"),
        F.col("returned"),
        to_number("rating", "double").alias("rating"),  # numeric or NULL, like a float column
    )
    return fill_default(out, {"returned": "No"})


def lenient_date_parts(df: DataFrame, col: str) -> DataFrame:
    """Year, month and month/year/day starts of a date text; bad text gives NULLs."""
    year, month, month_start = date_parts(col)
    return df.select(
        *[c for c in df.columns if c != col], F.col(col),
        year.alias("year"), month.alias("month"), month_start.alias("month_start"),
        trunc_to("year", col).alias("year_start"), trunc_to("day", col).alias("day_start"),
    )


# What counts as text of a type in a profile (an integer is a number too).
INTEGER_TEXT = r"^[+-]?[0-9]{1,18}$"
NUMBER_TEXT = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,2})?$"
DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def type_profile(df: DataFrame, columns: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """Which type each text column has, from one aggregation over the rows.

    One row per column: filled and empty (null or blank) cells, how many filled cells read as
    an integer, a number, a date (a day of the calendar written yyyy-MM-dd), the type chosen
    and its bad cells.  A column is of the narrowest type that all filled cells have; a
    dirty one of the widest type that more than ``least`` of them have, the others being
    its bad cells; text otherwise.  Unlike schema inference, one odd cell does not turn a
    column into text, and the table says how many odd cells there are.
    """
    columns = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    text = {c: F.trim(F.col(c)) for c in columns}
    filled = {c: F.col(c).isNotNull() & (t != "") for c, t in text.items()}
    kinds = {c: {"integers": t.rlike(INTEGER_TEXT), "numbers": t.rlike(NUMBER_TEXT), "dates": t.rlike(DATE_TEXT) & t.try_cast("date").isNotNull()} for c, t in text.items()}
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(filled[c]).alias(f"filled{i}") for i, c in enumerate(columns)],
        *[F.count_if(filled[c] & is_kind).alias(f"{kind}{i}") for i, c in enumerate(columns) for kind, is_kind in kinds[c].items()],
    )
    one = [F.struct(F.lit(c).alias("column"), F.col(f"filled{i}").alias("filled"), (F.col("n") - F.col(f"filled{i}")).alias("empty"),
                    *[F.col(f"{kind}{i}").alias(kind) for kind in ("integers", "numbers", "dates")]) for i, c in enumerate(columns)]
    rows = counted.select(F.explode(F.array(*one)).alias("c")).select("c.*")
    some, bar = F.col("filled") > 0, F.col("filled") * least
    chosen = (
        F.when(some & (F.col("integers") == F.col("filled")), "integer").when(some & (F.col("numbers") == F.col("filled")), "number")
        .when(some & (F.col("dates") == F.col("filled")), "date").when(F.col("numbers") > bar, "number").when(F.col("dates") > bar, "date").otherwise("text")
    )
    good = F.when(F.col("type") == "integer", F.col("integers")).when(F.col("type") == "number", F.col("numbers")).when(F.col("type") == "date", F.col("dates")).otherwise(F.col("filled"))
    return rows.withColumn("type", chosen).withColumn("bad", F.col("filled") - good)
