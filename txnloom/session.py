"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stopGracefullyOnShutdown": "true",
    "spark.sql.streaming.minBatchesToRetain": "20",
    "spark.sql.streaming.schemaInference": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get a UTC session; ``spark-submit`` decides the master unless one is given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, which the cluster names in ``spark.checkpoint.dir``.

    Only a local session that has none falls back to a temporary folder of this machine.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir"))
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="txnloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The JVM, a path in it and the file system that holds the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows fixed in the shared folder, so that every later use sees the same ones."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


_PACKAGE_ZIP = "txnloom.zip"


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run; done once per context.

    Only the few streaming operators with Python state functions need it.
    """
    sc = spark.sparkContext
    if _PACKAGE_ZIP in sc._python_includes:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="txnloom-")) / _PACKAGE_ZIP
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(target))
