"""Session construction and shared-storage helpers.

Library code never builds its own session: every operator takes DataFrames
(or a session handed in by the caller). ``build_session`` is what tests, the
bench and command-line entry points use.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every clickflow job relies on. Shuffle width is left to the caller
# (cluster default + AQE coalescing); tests pass a small number.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Large keyed state (dedup sets, click caps) lives off-heap in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "clickflow", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and staged tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only in local mode (tests), when neither is set, is a fresh scratch
    folder created and registered; on a cluster a missing setting is an
    error, so lineage-cutting ``checkpoint()`` calls and stream checkpoints
    always land on storage every executor can reach.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
            d = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def workers_find_package(spark: SparkSession) -> None:
    """Put this package's folder on the Python workers' path, where they see
    the same folder (one machine, or an installation at the same place). A
    cluster without that needs the package installed or in ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def sub_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the shared folder (used for stream checkpoints, staging)."""
    base = shared_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def scale_conf(input_bytes: int, split_bytes: int = 512 << 20,
               reducer_input_bytes: int = 1 << 30, max_reducers: int = 100_000
               ) -> dict[str, str]:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    Scans split at ``split_bytes`` (100 TB -> ~200k map tasks). The initial
    shuffle width gives each reducer about ``reducer_input_bytes`` of *input*
    -- after map-side combining an aggregate's shuffle is a fraction of that
    -- capped at ``max_reducers`` so maps x reducers stays manageable; AQE
    then coalesces towards 128 MB and splits skewed join partitions (over 4x
    the median and 512 MB). Automatic broadcasts stay under 64 MB.
    Pass the result as ``build_session(extra=...)`` or set it at submit time.
    """
    parts = min(max(200, -(-input_bytes // reducer_input_bytes)), max_reducers)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
