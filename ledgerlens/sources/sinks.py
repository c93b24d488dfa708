"""Sinks and actions.

Writes run jobs and go to paths the caller supplies (shared storage on a cluster);
nothing is collected to the driver except the single number of a preview and the
names of a table's version folders.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import materialize, own_path


def write_csv(df: DataFrame, path: str, header: bool = True, null_value: str | None = None,
              mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """Write a CSV directory (K1, K2, K5, K6).

    Cells containing the separator, a quote or a line break are quoted and embedded
    quotes are doubled (RFC 4180); white space is kept.  Empty text is written as a
    quoted empty cell and NULL as an empty one (or as ``null_value``, which text
    must not equal).  ``sources.read_csv`` with the same ``null_value`` reads the same
    rows back, with ``multi_line`` if cells hold line breaks.
    """
    writer = (df.write.mode(mode).option("header", header).option("encoding", encoding).option("escape", '"').option("emptyValue", '""')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                path: str | None = None) -> None:
    """Save as a catalog table (K3, K4).

    ``mode`` follows ``DataFrameWriter``: ``overwrite`` is drop-and-create,
    ``ignore`` is CREATE TABLE IF NOT EXISTS.  ``fmt="delta"`` works where
    Delta is installed; parquet is the default.  ``path`` makes it an external
    table at a shared location.
    """
    writer = df.write.mode(mode).format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str, mode: str = "error") -> DataFrame:
    """Save as a catalog table dealt into ``buckets`` by ``keys``, sorted by them, and read it back (K3).

    Tables with equal keys and numbers of buckets join on the keys without a shuffle, as
    often as they are read.  The rows are shuffled once here, to one task and one file a
    bucket; choose ``buckets`` so that one holds 100 to 200 MB.  All rows of a key lie in
    its bucket, so the keys should be ones without hot values, as an order's number is.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def co_partitioned(frames: list[DataFrame], keys: list[str], label: str, buckets: int | None = None) -> list[DataFrame]:
    """The frames, stored with ``write_bucketed`` under names of their own in the shared folder.

    ``buckets``: by default the session's shuffle partitions, which should suit the largest frame.
    """
    out = []
    for frame in frames:
        spark = frame.sparkSession
        path = own_path(spark, "tables", label)
        name = path.rsplit("/", 1)[-1].replace("-", "_")
        out.append(write_bucketed(frame, name, keys, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), path))
    return out


def write_ranked_csv(df: DataFrame, path: str, order: list[tuple[str, bool]], header: bool = True) -> None:
    """Write a CSV whose part files, in the order of their numbers, are one sorted list (K5, K6).

    ``order``: (column, ascending).  The header is a row before all others, so it stands at the
    top of the first part only; rows are range-sorted.  ``_manifest`` under ``path``
    (which readers of the folder skip) lists the parts in order with their lines.
    ``operators.ordered.read_ranked_csv`` reads the list back with its ranks.
    """
    spark = df.sparkSession
    line = F.to_csv(F.struct(*df.columns), {"emptyValue": '""', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    rows = df.select(F.lit(1).alias("below"), *[F.col(c).alias(f"key{i}") for i, (c, _) in enumerate(order)], line.alias("value"))
    if header:
        names = spark.range(1).select(F.lit(0).alias("below"), F.to_csv(F.struct(*[F.lit(c).alias(c) for c in df.columns])).alias("value"))
        rows = rows.unionByName(names, allowMissingColumns=True)
    keys = [F.col(f"key{i}").asc() if up else F.col(f"key{i}").desc() for i, (_, up) in enumerate(order)]
    rows.orderBy("below", *keys).select("value").write.mode("overwrite").text(path)
    parts = spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("part")).agg(F.count(F.lit(1)).alias("lines"))
    number = F.regexp_extract("part", r"^part-(\d+)", 1).cast("long")
    parts.orderBy(number).coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")


def write_version(df: DataFrame, name: str, base: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Save as a catalog table whose versions are folders under ``base`` (K3, K4); returns the folder.

    The rows are written to a folder of their own and the table then points there, which
    is one step in the catalogue.  A frame opened before keeps reading the folder it was
    planned on, and two writers leave two whole versions of which the later one is the
    table.  ``ignore`` writes nothing where the table exists.  Old folders stay until
    ``release_versions``.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if exists and mode == "ignore":
        return table_location(spark, name)
    folder = f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    df.write.format(fmt).save(folder)
    if not exists:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} LOCATION '{folder}'")
    if table_location(spark, name) != folder:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return folder


def table_location(spark: SparkSession, name: str) -> str:
    """The folder that a saved table points to."""
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return re.sub("^file:/+", "/", row["data_type"])


def release_versions(spark: SparkSession, name: str, base: str) -> list[str]:
    """Delete the folders of a table's earlier versions, which no frame may read any more; returns them."""
    jvm, current = spark._jvm, table_location(spark, name).rsplit("/", 1)[-1]
    root = jvm.org.apache.hadoop.fs.Path(base)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [f.getPath() for f in files.listStatus(root) if f.getPath().getName().startswith("v-") and f.getPath().getName() != current]
    for path in old:
        files.delete(path, True)
    return sorted(p.getName() for p in old)


def preview_once(df: DataFrame, order: list[Column], n: int = 1000) -> DataFrame:
    """The first ``n`` rows by ``order`` with the full row count, from one pass over the input (K7).

    The rows are counted while they go into the top ``n``, which are stored (a job).
    """
    seen = Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("total_rows"))
    first = materialize(rows.orderBy(*order).limit(n), "preview")
    return first.withColumn("total_rows", F.lit(seen.get["total_rows"]))


def preview(df: DataFrame, n: int = 1000) -> tuple[DataFrame, int]:
    """The first ``n`` rows (lazy) and the full row count (one count job) (K7)."""
    return df.limit(n), df.count()


def preview_with_total(df: DataFrame, order, n: int = 1000) -> DataFrame:
    """The first ``n`` rows by ``order`` with the full row count as a column (K7).

    The count is a scalar subquery (one global aggregate, no join); the rows
    are a ``TakeOrderedAndProject``.
    """
    total = df.agg(F.count(F.lit(1)).alias("total_rows")).scalar()
    return df.orderBy(*order).limit(n).withColumn("total_rows", total)


def chart_series(df: DataFrame, label: str, value: str) -> DataFrame:
    """Chart-ready (label, value): label as text with ``NULL``, value numeric with 0."""
    return df.select(
        F.coalesce(F.col(label).cast("string"), F.lit("NULL")).alias("label"),
        F.coalesce(F.col(value).try_cast("double"), F.lit(0.0)).alias("value"),
    )
