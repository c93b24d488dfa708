"""Scans (S1-S9): catalog tables, CSV, text lines, whole documents, inline rows.

All readers are lazy; nothing here runs a job except CSV schema inference
(``infer=True``), which Spark implements as an extra pass over the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table or view."""
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             encoding: str = "UTF-8", header: bool = True, multi_line: bool = False,
             null_value: str | None = None) -> DataFrame:
    """Scan CSV (S2, S3).

    With ``schema`` the types are fixed and no inference pass runs (the right
    choice at scale); without it Spark infers types with one extra pass.  An empty
    cell is NULL, a quoted empty cell is empty text; ``null_value`` is a text that
    is NULL as well.  ``multi_line`` reads cells with line breaks, at the price of
    one task per file.
    """
    reader = (spark.read.option("header", header).option("encoding", encoding)
              .option("escape", '"').option("multiLine", multi_line)
              .option("emptyValue", "").option("nullValue", "\u0000" if null_value is None else null_value))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str, column: str = "line") -> DataFrame:
    """Scan text files as one row per line, ``(doc_id, <column>)`` (S4); splittable at scale.

    ``doc_id`` is the file path.  The text operators take such a frame with
    ``text_col="line"``; each line then is a text of its own.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias(column))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Scan each text file as one document ``(doc_id, text)``.

    ``doc_id`` is the file path.  A whole file becomes one row, so this suits
    collections of documents; one very large file is better read with
    ``read_lines``.
    """
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def inline(spark: SparkSession, rows, schema) -> DataFrame:
    """Rows given in code with an explicit ``StructType`` or a list of names."""
    return spark.createDataFrame(rows, schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto an explicit schema: same names, order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register a session view (S8) and return the frame unchanged."""
    df.createOrReplaceTempView(name)
    return df
