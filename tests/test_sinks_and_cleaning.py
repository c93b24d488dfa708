"""Sinks (CSV, tables, preview, catalogue, chart data) and lenient cleaning."""

from __future__ import annotations

import csv
import datetime as dt
import glob
import os

from pyspark.sql import functions as F

import pytest

from ledgerlens.functions.cleaning import date_parts, fill_default, to_day_string, to_number, trunc_to
from ledgerlens.operators.catalog import dataset_catalog
from ledgerlens.session import NoSharedFolder, checkpoint_dir
from ledgerlens.sources import conform, inline, read_csv, read_documents, read_lines, read_table, register_view
from ledgerlens.sources import sinks


def read_back(path):
    out = []
    for f in sorted(glob.glob(os.path.join(path, "part-*.csv"))):
        with open(f, newline="", encoding="utf-8") as fh:
            out.extend(csv.reader(fh))
    return out


def test_write_csv_header_null_and_quoting(spark, scratch):
    df = spark.createDataFrame([("a,b", 1), ('say "hi"', None), (None, 3)], "label string, n int")
    path = os.path.join(scratch, "out")
    sinks.write_csv(df.coalesce(1), path, header=True, null_value="NULL")
    got = read_back(path)
    assert got[0] == ["label", "n"]
    assert sorted(got[1:]) == sorted([["a,b", "1"], ['say "hi"', "NULL"], ["NULL", "3"]])
    again = read_csv(spark, path, "label string, n int")
    assert again.count() == 3


def test_csv_round_trip_keeps_breaks_blanks_and_nulls(spark, scratch):
    data = [("two\nlines", 1), ("", 2), (None, 3), ("  spaced ", None), ('q"uote, comma', 5), ("NULL", 6)]
    df = spark.createDataFrame(data, "label string, n int")
    for i, header in enumerate((True, False)):
        path = os.path.join(scratch, f"rt{i}")
        sinks.write_csv(df, path, header=header)
        again = read_csv(spark, path, df.schema, header=header, multi_line=True)
        assert sorted(map(tuple, again.collect()), key=repr) == sorted(data, key=repr)


def test_csv_in_latin_1_with_inferred_types(spark, scratch):
    path = os.path.join(scratch, "latin.csv")
    with open(path, "w", encoding="iso-8859-1") as fh:
        fh.write("city,n\nMálaga,3\nGöteborg,4\n")
    got = read_csv(spark, path, encoding="ISO-8859-1")
    assert got.dtypes == [("city", "string"), ("n", "int")]
    assert [tuple(r) for r in got.orderBy("n").collect()] == [("Málaga", 3), ("Göteborg", 4)]


def test_views_tables_and_inline_rows_by_name(spark, scratch):
    df = inline(spark, [(1, "a"), (2, "b")], ["k", "v"])
    assert df.columns == ["k", "v"]
    assert register_view(df, "ll_view") is df
    assert spark.sql("SELECT v FROM ll_view WHERE k = 2").first().v == "b"
    assert read_table(spark, "ll_view").count() == 2
    spark.catalog.dropTempView("ll_view")


def test_intermediate_tables_need_a_shared_folder():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Cluster:
        conf = Conf({"spark.master": "spark://host:7077"})
        _sc = None

    with pytest.raises(NoSharedFolder):
        checkpoint_dir(Cluster())
    Cluster.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert checkpoint_dir(Cluster()) == "hdfs:///shared"


def test_category_revenue_keeps_one_table(spark):
    from ledgerlens.plans.catalogue import QUERIES

    from conftest import SF_SMALL
    first = [tuple(r) for r in QUERIES["category_revenue"](spark, SF_SMALL).collect()]
    assert [tuple(r) for r in QUERIES["category_revenue"](spark, SF_SMALL).collect()] == first
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("category_revenue")]
    assert names == ["category_revenue_summary"]


def test_write_table_modes(spark, scratch):
    df = spark.range(3).withColumnRenamed("id", "x")
    path = os.path.join(scratch, "tbl")
    sinks.write_table(df, "ll_test_tbl", mode="overwrite", path=path)
    sinks.write_table(spark.range(10).withColumnRenamed("id", "x"), "ll_test_tbl", mode="ignore", path=path)
    assert spark.table("ll_test_tbl").count() == 3  # ignore = CREATE IF NOT EXISTS
    sinks.write_table(spark.range(5).withColumnRenamed("id", "x"), "ll_test_tbl", mode="overwrite", path=path)
    assert spark.table("ll_test_tbl").count() == 5  # overwrite = drop + create
    spark.sql("DROP TABLE ll_test_tbl")


def test_preview_and_chart_series(spark):
    df = spark.range(2500)
    head, total = sinks.preview(df, 1000)
    assert head.count() == 1000 and total == 2500
    with_total = sinks.preview_with_total(df, [F.col("id").desc()], 3).collect()
    assert [(r.id, r.total_rows) for r in with_total] == [(2499, 2500), (2498, 2500), (2497, 2500)]
    s = spark.createDataFrame([("a", "1.5"), (None, "x"), ("c", None)], "k string, v string")
    got = sorted(tuple(r) for r in sinks.chart_series(s, "k", "v").collect())
    assert got == [("NULL", 0.0), ("a", 1.5), ("c", 0.0)]


def test_dataset_catalog_reports_missing(spark, scratch):
    path = os.path.join(scratch, "t.parquet")
    longer = os.path.join(scratch, "t.parquet2")  # a name with the first one as prefix
    spark.range(7).withColumn("y", F.lit("a")).write.parquet(path)
    spark.range(3000).withColumn("z", F.sha2(F.col("id").cast("string"), 512)).repartition(3).write.parquet(longer)
    cat = {r.name: r for r in dataset_catalog(
        spark, {"t": path, "t2": longer, "gone": os.path.join(scratch, "nope")}).collect()}
    assert cat["t"].status == "Ready" and cat["t"].row_count == 7 and cat["t"].columns == ["id", "y"]
    assert (cat["t2"].row_count, cat["t2"].columns) == (3000, ["id", "z"])

    def mb(p):
        files = [f for f in glob.glob(os.path.join(p, "*")) if not os.path.basename(f).startswith(("_", "."))]
        return round(sum(os.path.getsize(f) for f in files) / (1024 * 1024), 2)

    assert (cat["t"].size_mb, cat["t2"].size_mb) == (mb(path), mb(longer))
    assert cat["t2"].size_mb > 0.1 and cat["t"].size_mb < 0.1  # nothing of t2 counted under t
    assert cat["gone"].status == "Missing" and cat["gone"].row_count == 0


def test_dataset_catalog_nested_and_partitioned_roots(spark, scratch):
    outer, inner = os.path.join(scratch, "data", "x"), os.path.join(scratch, "mnt", "data", "x")
    spark.range(10).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(outer)
    spark.range(2000).withColumn("z", F.sha2(F.col("id").cast("string"), 512)).withColumn("q", F.col("id") % 3).write.partitionBy("q").parquet(inner)
    cat = {r.name: r for r in dataset_catalog(spark, {"outer": outer, "inner": inner}).collect()}
    assert (cat["outer"].row_count, cat["inner"].row_count) == (10, 2000)
    assert cat["inner"].size_mb > 0.1 > cat["outer"].size_mb


def test_text_readers(spark, scratch):
    p = os.path.join(scratch, "doc.txt")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("first line.\nsecond line")
    assert [r.line for r in read_lines(spark, p).collect()] == ["first line.", "second line"]
    docs = read_documents(spark, p).collect()
    assert len(docs) == 1 and docs[0].text == "first line.\nsecond line"


def test_inline_and_conform(spark):
    from ledgerlens.plans.catalogue import people_schema
    schema = people_schema()
    row = (1, "Ann", "Lee", "a@example.com", "1", "Main St", "X", "Y", "0", "Z", "F", "1990-01-01")
    df = inline(spark, [row], schema)
    assert df.schema == schema
    loose = spark.createDataFrame([(2, "Bo")], "customerID long, first_name string")
    for f in schema.fields[2:]:
        loose = loose.withColumn(f.name, F.lit(None))
    assert conform(loose, schema).schema.simpleString() == schema.simpleString()


def test_lenient_integers_cut_fractions(spark):
    cells = {"12": 12, "12.0": 12, "12.7": 12, "-3.9": -3, "1e2": 100, " 7 ": 7, "12 pcs": 0, "": 0, "NaN": 0,
             "9007199254740993": 9007199254740993}
    df = spark.createDataFrame([(c,) for c in cells], "a string").withColumn("n", to_number("a", "bigint", 0))
    assert {r.a: r.n for r in df.collect()} == cells


def test_retail_dates_do_not_shift_with_the_session_zone(spark):
    from ledgerlens.operators.retail import clean_lines
    lines = spark.createDataFrame([("13/3/2011 2:30", 1), ("30/10/2011 1:30", 2), ("31/31/2011 1:00", 3)], "InvoiceDate string, CustomerID long")
    saved = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r.CustomerID: r.InvoiceDate for r in clean_lines(lines, "X").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    assert got == {1: dt.datetime(2011, 3, 13, 2, 30), 2: dt.datetime(2011, 10, 30, 1, 30), 3: None}


def test_lenient_numbers_dates_and_defaults(spark):
    df = spark.createDataFrame(
        [("12", "9.5", None, "2026-01-04"), ("12 pcs", "", "Yes", "unknown"), (None, "x", None, "")],
        "q string, p string, returned string, d string")
    out = fill_default(df.select(
        to_number("q", "int", 0).alias("q"), to_number("p", "double", 0.0).alias("p"),
        to_number("p", "double").alias("p_null"), "returned", to_day_string("d").alias("d")),
        {"returned": "No"}).collect()
    assert [(r.q, r.p, r.p_null, r.returned, r.d) for r in out] == [
        (12, 9.5, 9.5, "No", "2026-01-04"), (0, 0.0, None, "Yes", None), (0, 0.0, None, "No", None)]
    y, m, start = date_parts(F.col("d"))
    parts = df.select(y.alias("y"), m.alias("m"), start.alias("s"), trunc_to("year", F.col("d")).alias("ys")).collect()
    assert (parts[0].y, parts[0].m, parts[0].s, parts[0].ys) == (
        2026, 1, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 1))
    assert (parts[1].y, parts[2].m) == (None, None)
