"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that every loomstar job relies on.  AQE re-plans joins and
# coalesces shuffle partitions from runtime statistics; the broadcast
# threshold is the size check that guards every hash-broadcast join.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    # Generated methods above 8 KB of bytecode are not JIT-compiled by the JVM;
    # such stages run faster on Spark's expression interpreter.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "loomstar",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with loomstar's defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is used as
    is (and must be set).  Only for a local master with the setting unset
    (tests) is a private folder created.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to other executors
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="loomstar-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


# Folders handed out inside open ``scratch_scope`` blocks, innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A fresh, never-reused folder under the shared checkpoint directory.

    Inside a ``scratch_scope`` the folder goes when the scope ends, unless ``keep``.
    """
    path = f"{ensure_checkpoint_dir(spark)}/loomstar/{name}-{uuid.uuid4().hex}"
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders made inside the block when it ends.

    DataFrames built inside read these folders, so use up or write out the result
    before leaving.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for made in _SCOPES.pop():
            path = hadoop.Path(made)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
