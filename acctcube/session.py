"""Session settings and the shared folder that survives executor loss."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "acctcube", **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    ANSI mode stays on: the operators use try_cast / try_divide where the data
    may be bad.  On a cluster pass ``spark.checkpoint.dir`` (a shared folder) and
    leave the master to spark-submit.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # no call-site capture per column expression: plans here have hundreds
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # a cohort of a few million keys becomes a bloom filter of at most 8 MB on the
        # scan of the attempts, where that scan is over 10 GB
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
        "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
        "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    if not sc.master.startswith("local"):
        if sc.getCheckpointDir():
            return sc.getCheckpointDir()
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="acctcube-")
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
