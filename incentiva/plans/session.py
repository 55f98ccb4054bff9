"""Session settings and the shared folder for staged tables.

``local_session`` is for tests and the bench only. On a cluster the session
comes from the platform; ``CLUSTER_CONF`` lists the settings this job relies on.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale (100 TB of sales, ~1000 executors):
# * AQE re-plans at run time: coalesces small shuffle partitions, splits skewed
#   join partitions, turns shuffle joins into broadcast joins when a side turns
#   out small.
# * shuffle partitions start high and are coalesced by AQE to ~128 MB each;
#   the month filter leaves a few TB of sales lines, whose partial aggregate is
#   what gets shuffled.
# * broadcasts: the static planner's size estimate comes from compressed file
#   sizes and can be several times below the in-memory size, so it is switched
#   off; the job broadcasts what it has measured (Params.broadcast_max_bytes),
#   and AQE may still turn a shuffle join into a broadcast join at run time,
#   from the measured size of a finished shuffle.
# * session time zone is irrelevant to results (wall-clock timestamp_ntz) but
#   fixed to UTC for reproducible logs.
CLUSTER_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a measured-skewed join partition even when the aggregate after it then
    # needs its own shuffle (the salted buyer join with one very hot known buyer)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def apply_cluster_conf(spark: SparkSession, conf: dict[str, str] | None = None) -> None:
    """Set the runtime SQL settings of ``CLUSTER_CONF`` (or ``conf``) on a session."""
    for k, v in (conf or CLUSTER_CONF).items():
        spark.conf.set(k, v)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "incentiva",
                  event_log_dir: str | None = None) -> SparkSession:
    """A ``local[cpus]`` session for tests and the bench (UI off, AQE on)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
             .config("spark.eventLog.compress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for staged tables (``spark.checkpoint.dir``).

    Read from the session; only when it is unset (local tests) a folder of our
    own is created and registered as the checkpoint directory.
    """
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share; "
                           "a machine-local temporary folder does not survive a lost executor")
    d = tempfile.mkdtemp(prefix="incentiva-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir().rstrip("/")
