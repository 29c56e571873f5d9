"""Session construction and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  UTC makes timestamp text
# stable across machines; ANSI mode makes malformed casts fail loudly (the
# warehouse semantics); AQE re-plans joins/partition counts at runtime and
# splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    # No broadcast from static size estimates (not a proven bound): only
    # explicit hints behind a measured size (operators/joins.py), and
    # AQE's conversion, which uses the measured size of a finished stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partition folder values stay text ("0022400001", "2024-25")
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "panelforge",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the package defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    ``local[N]`` with shuffle partitions about the core count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in {**BASE_CONF, **(overrides or {})}.items():
        if spark.conf.isModifiable(k):  # others are fixed when the application starts
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    The cluster names it in ``spark.checkpoint.dir``; that setting wins.  When
    it is unset, a private folder is created for a local master (one machine);
    on a cluster, where executors would not see it, this fails.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        configured = tempfile.mkdtemp(prefix="panelforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/panelforge-scratch/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def purge_scratch(spark: SparkSession, older_than_hours: float = 24.0, prefix: str = "",
                  dry_run: bool = False) -> list[str]:
    """Delete this package's scratch folders (``<checkpoint>/panelforge-scratch``)
    whose last change is older than ``older_than_hours`` and whose name starts
    with ``prefix``.  Returns the affected paths; ``dry_run`` only lists them.
    Run it between jobs: a running job may still read its scratch tables."""
    import time

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/panelforge-scratch"
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    cutoff_ms = (time.time() - older_than_hours * 3600) * 1000
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(prefix) and st.getModificationTime() < cutoff_ms:
            out.append(st.getPath().toString())
            if not dry_run:
                fs.delete(st.getPath(), True)
    return out
