"""Spark session settings shared by the jobs, the tests and the benchmark.

The library never creates a cluster session of its own when one already
exists: ``getOrCreate`` returns the caller's session and only the settings
below that are safe to change at runtime are applied.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results.
#  * session zone UTC: the stored timestamps are UTC instants; REP012 converts
#    to Europe/London explicitly, REP000 uses the session zone.
#  * ANSI mode (Spark 4 default) keeps bad casts loud, as in PostgreSQL.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A broadcast is only planned by AQE from measured sizes; the static
    # threshold stays at Spark's 10 MB default so nothing that grows with the
    # data is broadcast from a guess.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # The JVM never compiles a method of more than 8,000 bytes of code.  A stage whose
    # generated method is larger (tables of 50 columns) runs as separate operators,
    # whose expressions Spark splits into methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The shuffle files of a query go when it ends, not when the driver happens to
    # collect its garbage; a stage that needs them again is run again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune_for_input(spark: SparkSession, input_bytes: int,
                   target_partition_bytes: int = 128 * 1024 ** 2) -> dict:
    """Size shuffles and scan splits for a run over ``input_bytes`` of input.

    AQE starts from ``initialPartitionNum`` shuffle partitions of about
    ``target_partition_bytes`` each and coalesces the small ones, so a
    partition fits in an executor's memory at full scale (at 100 TB: ~800k
    partitions of 128 MB before coalescing) while a small run is not split
    into thousands of empty tasks.  Settings a deployment already fixed are
    left alone."""
    partitions = max(200, min(1_000_000, -(-input_bytes // target_partition_bytes)))
    wanted = {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * target_partition_bytes),
    }
    applied = {}
    for key, value in wanted.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` is set by the deployment and points
    at shared storage; it is only filled in here when unset (local tests).
    """
    sc = spark.sparkContext
    conf_dir = (spark.conf.get("spark.checkpoint.dir", None)
                or sc.getConf().get("spark.checkpoint.dir", None)
                or sc.getCheckpointDir())
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="claimsflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "claimsflow") -> SparkSession:
    """Session for tests and the local benchmark (single JVM)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CLAIMSFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
