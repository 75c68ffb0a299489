"""Session defaults and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Sizing for a large cluster (applied when spark-submit picks the master).
# Shuffles start wide and AQE coalesces them to ~128 MB partitions, so a
# whole-store aggregate never puts hundreds of GB in one reduce task while a
# three-hour report still ends up with few partitions; REBALANCE writes split
# at the same advisory size; scans read 256 MB splits (counter rows are wide,
# projections narrow). The cluster's own settings (spark-defaults, --conf) win.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.5",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def get_session(master: str | None = None, app: str = "cellkpi",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if not master:
        given = spark.sparkContext.getConf()
        for k, v in CLUSTER_CONF.items():
            if not given.contains(k) and k not in (conf or {}):
                spark.conf.set(k, v)          # only where the cluster set nothing
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; only when nothing is configured (local
    tests) a fresh folder is created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="cellkpi-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/cellkpi/{name}-{uuid.uuid4().hex[:12]}"


def compile_wide_plans(spark: SparkSession) -> None:
    """The JVM never compiles a method of more than 8000 bytes, and stages of hundreds of columns are
    such methods: let Spark run these without whole-stage code, from projections it splits."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def write_text_file(spark: SparkSession, path: str, text: str) -> str:
    """A small file (schema, feature file) in whatever store ``path`` names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    out.write(text.encode())
    out.close()
    return path


def arrow_batches(spark: SparkSession, rows: int = 128) -> None:
    """Bound the rows of one Arrow batch: texts are long, so Spark's default of
    10,000 rows could make a batch of hundreds of MB in a Python worker. Also
    makes sure that workers can import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send the package to the workers if they would not find it by themselves
    (run from another folder without PYTHONPATH, --py-files or an installation)."""
    sc = spark.sparkContext
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if any(os.path.realpath(p or ".") == os.path.realpath(PACKAGE_ROOT) for p in paths) or not os.path.isdir(PACKAGE_ROOT):
        return
    name = f"cellkpi-{sc.applicationId}.zip"
    if any(str(f).endswith(name) for f in sc.listFiles):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="cellkpi-package-"), name)     # on the driver; Spark sends it on
    with zipfile.ZipFile(path, "w") as z:
        for at, _, files in os.walk(os.path.join(PACKAGE_ROOT, "cellkpi")):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(at, f), os.path.relpath(os.path.join(at, f), PACKAGE_ROOT))
    sc.addPyFile(path)
