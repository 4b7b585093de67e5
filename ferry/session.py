"""Session defaults and the shared scratch area.

Everything that has to survive an executor loss (materialised small sides,
landing directories of a queue hop, sink outputs of a run) is written below
the directory the cluster names in ``spark.checkpoint.dir``. Only when no
such directory is configured (a laptop, a unit test) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the engine relies on; applied by ``get_session`` and
# checked by ``configure`` for sessions created elsewhere.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast conversion is a size check made on real shuffle
    # output, so it is safe for sides whose size we cannot bound up front.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state (dedup) off the JVM heap, checkpointed as changelogs.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "ferry", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session and make
    the package importable by executor Python workers."""
    for k, v in DEFAULT_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave as is
            pass
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per SparkContext (what
    ``--py-files`` does at submit time), so Arrow functions and the file
    data source defined here can be unpickled there."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: ship the package with the client's artifacts instead
        return
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="ferry-pyfiles-")
    archive = shutil.make_archive(os.path.join(out_dir, "ferry"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialised tables and run directories.

    Uses the checkpoint directory of the session (``spark.checkpoint.dir``
    or one set with ``setCheckpointDir``). A private directory is created
    and registered only when the session has none, which is the test case.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ferry-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused directory below the scratch root."""
    root = scratch_root(spark).rstrip("/")
    return f"{root}/ferry/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def ensure_dir(path: str) -> str:
    p = local_path(path)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)
    return path
