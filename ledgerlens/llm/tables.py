"""Tables in the shared folder, whole groups from sorted partitions, and components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm import kernels as K
from ledgerlens.session import own_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again (cuts the lineage)."""
    spark = df.sparkSession
    path = own_path(spark, "tables", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark, path: str) -> None:
    """Delete a stored table that no frame reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def whole_groups(batches, *keys: str, rows: int = 20000, size: int = 32 << 20):
    """Tables of whole groups from batches sorted by ``keys`` (binary or number columns).

    Each table has about ``rows`` rows or ``size`` bytes, or one group if that is larger.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows and sum(b.nbytes for b in held) < size:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = int(np.flatnonzero(K.group_starts(*(table.column(k).to_numpy() for k in keys)))[-1])
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Forest:
    """Union-find over whatever is hashable and ordered; the least member is the root."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def _contract(batches):
    """The edges of one partition as stars around the least member of each local group.

    Long partitions are contracted in pieces, so that memory stays bounded.
    """
    for batch in batches:
        forest = Forest()
        columns = [batch.column(c) for c in ("a", "b")]
        for x, y in zip(*(zip(*(f.to_pylist() for f in c.flatten())) if pa.types.is_struct(c.type) else c.to_pylist() for c in columns)):
            forest.join(x, y)
        pairs = [(x, forest.root(x)) for x in forest.up]
        make = (lambda v: dict(zip((f.name for f in columns[0].type), v))) if pa.types.is_struct(columns[0].type) else (lambda v: v)
        yield pa.RecordBatch.from_arrays([pa.array([make(p[k]) for p in pairs], columns[0].type) for k in (0, 1)], names=["a", "b"])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of (a, b) edges between vertices (longs or structs of longs): (a, root).

    Alternating large-star and small-star steps; every vertex ends up pointing at the
    least vertex of its component, after a number of rounds about logarithmic in the
    longest path.  Each round is stored, so a lost executor repeats one round at most;
    the least neighbours are stored too, so that the join with them, which may have a
    hot vertex, has a plain shuffle on either side that Spark can split.  Roots
    themselves are not listed.
    """
    edges = edges.select("a", "b")
    now = stored(edges.mapInArrow(_contract, edges.schema), label)
    state = None
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), label)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        parent = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(parent, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(moved.unionAll(parent.select("a", F.col("m").alias("b"))).distinct(), label)
        after = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == after:
            return now.select("a", F.col("b").alias("root"))
        state = after
