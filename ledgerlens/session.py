"""Session construction and the shared folder for intermediate tables.

On a cluster the session comes from the platform; ``build_session`` is what the
tests and the bench use on ``local[N]``.  The settings that matter at scale are
the same in both places: AQE on (runtime coalescing of shuffle partitions,
skew-join splitting, broadcast conversion from measured sizes), the session
time zone pinned to UTC, and ANSI mode left on (leniency only via ``try_*``).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Spark's own size check for broadcast joins.  Dimension sides below this are
# broadcast by the planner (static estimate) or by AQE (measured shuffle
# size); anything larger stays a shuffled sort-merge join.
BROADCAST_THRESHOLD_BYTES = 64 * 1024 * 1024


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "ledgerlens",
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a session with the settings this library assumes.

    Master, shuffle partitions and driver memory are set only where the caller
    gives them.
    """
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_THRESHOLD_BYTES),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_THRESHOLD_BYTES),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    spark = builder.config(map={**conf, **(extra or {})}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


class NoSharedFolder(RuntimeError):
    """Raised where an intermediate table has no folder that all executors reach."""


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    It is what the session has in ``spark.checkpoint.dir`` or as its checkpoint
    folder.  Where neither is set, a session whose executors are threads of this
    very process (``local`` or ``local[N]``, as in tests) gets a temporary folder
    that goes when the process ends; any other session is an error, because its
    executors would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = getattr(spark, "_sc", None)
    if not configured and context is not None:
        configured = context.getCheckpointDir()
    if not configured:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise NoSharedFolder(
                "spark.checkpoint.dir is not set: intermediate tables need a folder that the driver and all executors share"
            )
        configured = _local_folder()
    if context is not None and not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="ledgerlens-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def own_path(spark: SparkSession, kind: str, label: str) -> str:
    """A new path in the shared folder, ``<kind>/<application id>/<label>-<unique>``: no call meets another's files."""
    app = spark.conf.get("spark.app.id", "app")
    return f"{checkpoint_dir(spark)}/{kind}/{app}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Used where one intermediate result feeds several branches of a plan and
    recomputing it per branch would re-read the input (Spark reuses an
    exchange only between identical subplans, and column pruning makes the
    branches differ).  The write cuts lineage, so a lost executor does not
    force the upstream stages to rerun.  This runs a job immediately; the tables
    of a session lie together under ``tables/<application id>``.
    """
    spark = df.sparkSession
    path = own_path(spark, "tables", label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
