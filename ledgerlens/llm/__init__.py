"""Training-data operators: formatting, scoring, mixing, filtering and deduplication.

Nothing outside this subpackage imports it (``__spark_entry__`` and
``corpus_pipeline`` register its queries).  Operators take DataFrames and plain
parameters and return DataFrames; each module documents its method and what it
does with nulls, empty and very long texts, ties, repeated rows and empty tables.
"""

import os
from functools import wraps

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of an Arrow batch, where the session has Spark's default of 64 MB: either side holds a few batches.
BATCH_BYTES = "1m"


def workers_import(spark) -> None:
    """Let Python workers import this package where it lies at the same path as here.

    On a cluster the package is installed or sent with ``--py-files``; this only saves
    local runs started from another folder from having to set PYTHONPATH.  Also bounds
    the bytes of Arrow batches unless the session has a bound of its own.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size) in ("67108864b", "64m", "64MB"):
        spark.conf.set(size, BATCH_BYTES)
    context = getattr(spark, "_sc", None)
    if context is not None:
        paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
        if _ROOT not in paths:
            context.environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def query(function):
    """A registered query: (spark, sf_dir) -> DataFrame."""

    @wraps(function)
    def run(spark, sf_dir):
        workers_import(spark)
        return function(spark, sf_dir)

    return run
