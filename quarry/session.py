"""Session set-up, checkpoint location and lineage cuts.

Cluster rule: the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir``.  Only when nothing is set (unit tests, local
runs) do we fall back to a scratch folder, and we say so in the log.
"""

from __future__ import annotations

import logging
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings applied to sessions this package creates.  An existing session
# (the cluster's) is never reconfigured beyond what a query needs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "quarry",
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading it from the session.

    Order: the SparkContext's own setting, then ``spark.checkpoint.dir``.
    A scratch folder is created only when neither is set and all tasks run
    on this machine (tests); on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="quarry-ckpt-")
        log.warning("spark.checkpoint.dir unset; using local scratch %s "
                    "(one machine only)", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike localCheckpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over: it does
    so when the driver's garbage collector finds that nothing refers to them."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, placed under the shared checkpoint
    location so that every executor sees it."""
    base = checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "quarry-tables", name)


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it by
    ``sys.path`` alone: its folder goes on their PYTHONPATH.  Executors on
    other machines need it installed or sent along (--py-files), as usual."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


TEXT_PARTITIONS = "spark.quarry.textPartitions"


def text_partitions(spark: SparkSession) -> int | None:
    """How many partitions heavy text work is dealt to before it begins;
    unset (the default), texts stay as ``spark.sql.files.maxPartitionBytes``
    splits them.  Worth a shuffle only where a small table is one file."""
    value = spark.conf.get(TEXT_PARTITIONS, None)
    return int(value) if value else None


def spread(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """``df`` dealt by ``key`` to ``partitions``, or as it is (None)."""
    return df if partitions is None else df.repartition(partitions, key)
