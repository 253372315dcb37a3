"""Session and storage settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale as much as in tests.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # and turn a sort-merge join into a broadcast join when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.exchange.reuse": "true",
    # No broadcast from static size estimates (a parquet file's size says little
    # about its decoded size): a side is broadcast when AQE has *measured* it small,
    # or when it is a one-row aggregate.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # When AQE demotes a sort-merge join to a broadcast join, read the already
    # written shuffle by reducer partition (balanced, coalesced) rather than by
    # mapper: a few large map tasks would otherwise fix the parallelism of
    # everything downstream.
    "spark.sql.adaptive.localShuffleReader.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Wide projections (28+ columns with nested CASE/cast chains) generate Java
    # methods above HotSpot's 8 KB JIT limit; without this flag they would run
    # interpreted, several times slower.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}
#: HotSpot's limit, in bytes, for methods that it compiles without that flag
HUGE_METHOD = "8000"


def get_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                app: str = "aloft", extra: dict | None = None) -> SparkSession:
    """``shuffle_partitions``: 8 on one machine; on a cluster the caller's or the cluster's own setting."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    if master.startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        # one machine: favour parallelism over partition size
        conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "128KB"
        cores = master[len("local["):-1] if master.startswith("local[") else "1"
        cores = os.cpu_count() if cores == "*" else int(cores)
        conf["spark.sql.adaptive.coalescePartitions.minPartitionNum"] = str(2 * cores)
    else:
        # a busy cluster: fewer, larger post-shuffle partitions (~128 MB each)
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = "128MB"
        if shuffle_partitions is not None:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A folder of our own is only created when the setting is absent *and* the
    session runs in local mode (tests, the benchmark).  On a cluster the setting
    must point at shared storage; a machine-local folder would not survive the
    loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    path = tempfile.mkdtemp(prefix="aloft-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def compile_in_parts(spark: SparkSession) -> None:
    """For sessions that others started, without the flag above: a stage whose one generated method HotSpot would leave to its
    interpreter is generated as a method for each operator and group of columns instead.  Results do not depend on
    it.  A limit that the session was given stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) in (None, "65535"):
        spark.conf.set(key, HUGE_METHOD)


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/aloft-{spark.sparkContext.applicationId}"


_RELEASE_AT_EXIT: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder for staged tables, in this application's own part of the shared checkpoint folder.

    Staged tables back the frames that were built on them, so they stay until
    ``release_scratch`` or the end of the driver process.
    """
    root = _scratch_root(spark)
    if root not in _RELEASE_AT_EXIT:
        _RELEASE_AT_EXIT.add(root)
        atexit.register(_release_quietly, spark)
    return f"{root}/{name}"


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's staged tables (and nothing else in the checkpoint folder)."""
    delete_path(spark, _scratch_root(spark))


def _release_quietly(spark: SparkSession) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            release_scratch(spark)
    except Exception:  # the driver is going down: the gateway may be gone already
        pass


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
