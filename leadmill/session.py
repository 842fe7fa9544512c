"""Session helpers: building a session for local runs and finding the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE does the runtime broadcast switch (its size check is the
# measured shuffle output), coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",     # else one listing task per folder
    "spark.sql.files.openCostInBytes": "131072",      # by the default of 4 MB a task gets four small files of 16 MB, not a hundred
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "leadmill",
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above. Cluster jobs pass their own master."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings above to a session we did not build (driver-provided)."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, landing zones and table snapshots.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset (local tests) do we
    create one under the system temp folder and register it, so later calls agree.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        d = tempfile.mkdtemp(prefix="leadmill-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():   # set once; each call would add a folder
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of the path's own file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the work folder (never reused between runs)."""
    base = work_dir(spark)
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``leadmill`` importable in Python workers (its ``mapInPandas`` functions are pickled
    by reference): zip the package into the work folder and ``addPyFile`` it, once per
    application. Skipped when the work folder is remote; such jobs pass ``--py-files``."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    base = work_dir(spark)
    if "://" in base and not base.startswith("file:"):
        _SHIPPED.add(app)
        return
    import zipfile
    local = base[5:] if base.startswith("file:") else base
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(local, f"leadmill-{app}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
