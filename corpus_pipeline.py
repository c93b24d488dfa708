"""The corpus pipeline: from raw documents to a deduplicated, decontaminated mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.  The output of a stage is written as Parquet and read
again as the next one's ``docs``:

1. documents that the quality classifier scores below 0.7 go;
2. of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the
   document with the smallest id stays;
3. passages of 50 bytes or more that a document with a smaller id has too are cut out;
4. documents that hold a benchmark passage go;
5. the sources are mixed to their target weights: a row for each time that a document
   is taken, with its pass, shard and place in the shard's order.

A stage's definitions for nulls, empty and very long texts, ties, repeated rows, empty
tables and clashing columns are those of its operator, named in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.llm import query, workers_import
from ledgerlens.llm.bottomk import drop_near_duplicates
from ledgerlens.llm.decontam import decontaminate
from ledgerlens.llm.mixing import mix
from ledgerlens.llm.quality import GOOD, score, train
from ledgerlens.llm.suffix_dedup import drop_repeats
from ledgerlens.llm.tables import drop_table
from ledgerlens.session import own_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier (``llm.quality``) accepts; trained on these documents' labels."""
    workers_import(spark)
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, weights).where(F.col("score") >= GOOD).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (``llm.bottomk``)."""
    workers_import(spark)
    return drop_near_duplicates(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of earlier documents (``llm.suffix_dedup``); every row stays."""
    workers_import(spark)
    left = drop_repeats(docs)
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage (``llm.decontam``)."""
    workers_import(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix (``llm.mixing``): the columns of documents, pass, shard and shard_order."""
    workers_import(spark)
    return mix(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_copies),
    ("suffix-array dedup", drop_passages),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


@query
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored in the shared folder before the next.

    A stage's table goes once the next one is stored; the last stage's input stays, as
    the result reads it.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = own_path(spark, "tables", f"stage{number}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
            if before is not None:
                drop_table(spark, before)
            before = path
    return docs
