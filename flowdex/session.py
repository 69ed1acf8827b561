"""Session helpers (settings the operators rely on) and the shared work folder.

The engine never picks a machine-local folder on a cluster: every staged file,
state table and index directory lives under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local runs, tests)
is a fresh temporary folder created and registered as the checkpoint dir.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every operator expects.  LAST_WIN makes ``map_concat``
# behave like ``m ++ Map(...)`` (right side wins) and lets duplicate JSON keys
# collapse to the last value instead of raising DUPLICATED_MAP_KEY; the variant
# setting does the same for objects that schema inference reads.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "flowdex",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    ``master`` is left to the caller / cluster manager when None.  The UI stays
    off: batch jobs here never need it and it would open a port.
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_map_policy(spark: SparkSession) -> None:
    """Fail early where duplicate map keys wouldn't resolve last-wins: documents would raise or lose members later.

    The caller's session isn't changed here; :func:`configure` sets everything the operators need.
    """
    if spark.conf.get("spark.sql.mapKeyDedupPolicy", None) != "LAST_WIN":
        raise RuntimeError("spark.sql.mapKeyDedupPolicy must be LAST_WIN: call flowdex.session.configure(spark)")


def ensure_duplicate_keys(spark: SparkSession) -> None:
    """Fail early where schema inference would leave out objects that repeat a key."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        raise RuntimeError("spark.sql.variant.allowDuplicateKeys must be true: call flowdex.session.configure(spark)")


_LOCAL_ROOT: str | None = None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temp folder only when unset."""
    global _LOCAL_ROOT
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
        root = sc.getCheckpointDir()
    except Exception:  # no SparkContext on this client
        sc = None
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder on the cluster's "
                           "shared filesystem (a machine-local folder is invisible to executors)")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="flowdex-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(_LOCAL_ROOT)
    return _LOCAL_ROOT


def _is_local(spark: SparkSession) -> bool:
    """Whether the master is known to be local; one that can't be read is taken for a cluster's."""
    try:
        master = spark.conf.get("spark.master", None)
    except Exception:
        return False
    return master is not None and re.fullmatch(r"local(\[.*\])?", master) is not None


def named_dir(spark: SparkSession, *parts: str) -> str:
    """A stable sub-folder of the checkpoint root (same path on every run).

    Use it for a deployed stream's checkpoint and state, which must survive
    restarts; :func:`work_dir` is for one-off runs that must not see old files.
    """
    if not parts:
        raise ValueError("name the folder")
    return "/".join([checkpoint_root(spark), "flowdex", *parts])


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one operator."""
    return "/".join([checkpoint_root(spark), "flowdex", uuid.uuid4().hex, *parts])
