"""Dataset catalogue (K10): name, size, rows, columns and status per dataset.

Sizes come from a ``binaryFile`` listing with only ``path``/``length``
selected (file contents are never read); row counts are ``count`` jobs that
parquet answers from row-group metadata; columns come from the file footers.
A path that does not exist is reported as ``Missing`` instead of failing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

CATALOG_SCHEMA = StructType([
    StructField("name", StringType(), False),
    StructField("size_mb", DoubleType(), True),
    StructField("row_count", LongType(), True),
    StructField("columns", ArrayType(StringType()), True),
    StructField("status", StringType(), False),
])


def dataset_catalog(spark: SparkSession, datasets: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """One row per dataset: ``name, size_mb, row_count, columns, status``.

    Each dataset is one global aggregate (its count, answered from file footers)
    with the size of its own files as a scalar subquery: no dataset sees another's
    files, however their paths relate.  Nothing is joined.
    """
    rows: list[DataFrame] = []
    missing: list[str] = []
    for name, path in datasets.items():
        try:
            data = spark.read.format(fmt).load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        size = files.select("length").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).scalar()
        rows.append(data.agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
            F.lit(name).alias("name"),
            F.round(size / F.lit(1024 * 1024), 2).cast("double").alias("size_mb"),
            "row_count",
            F.array(*[F.lit(c) for c in data.columns]).cast("array<string>").alias("columns"),
            F.lit("Ready").alias("status"),
        ))
    if missing:
        rows.append(spark.createDataFrame([(m, 0.0, 0, [], "Missing") for m in missing], CATALOG_SCHEMA))
    if not rows:
        return spark.createDataFrame([], CATALOG_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), rows)
