"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours wants. AQE re-plans joins from runtime
# sizes (broadcast only when the measured side is small), coalesces tiny
# shuffle partitions and splits skewed ones; the session time zone is pinned
# so TIMESTAMP_NTZ columns cast to TIMESTAMP without a shift.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # a join on (field, term, url) may use postings bucketed by (field, term)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # state of streams may outgrow memory; transformWithState needs it
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Builder used by tests, the bench and the examples.

    On a cluster the submitter supplies master, memory and
    ``spark.checkpoint.dir``; only the SQL settings above are forced.
    """
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (driver-made)."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # static or locked settings stay as given
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it with the context.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    from the session. Only a local-mode session without the setting (tests,
    the bench) gets a fresh folder of its own. A cluster session without it
    is an error: a machine-local folder would not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no driver-side context (remote session): server decides
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder "
            "(HDFS/object store) for iterative jobs")
    path = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder below the checkpoint root for tables written to cut lineage."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tables", name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours, by Spark's own file system access."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable on every executor's Python workers (pandas
    UDFs and ``applyInPandas`` functions are pickled by module reference):
    zip the package once per application and ``addPyFile`` it."""
    import zipfile

    import quarry
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server side provides the package
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(quarry.__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="quarry-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
