"""Customer profile documents: a JSON array or newline-delimited JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PROFILE
from .tables import SourceError


def _is_array(spark: SparkSession, path: str) -> bool:
    """Look at the first character only; the files themselves stay on the executors."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    statuses = fs.globStatus(root)
    if statuses is None or len(statuses) == 0:
        raise SourceError(f"no documents at {path}")
    files = fs.listFiles(statuses[0].getPath(), True)
    while files.hasNext():
        status = files.next()
        if status.getLen() == 0 or status.getPath().getName().startswith(("_", ".")):
            continue
        stream = fs.open(status.getPath())
        try:
            byte = stream.read()
            while byte in (9, 10, 13, 32, 0xEF, 0xBB, 0xBF):
                byte = stream.read()
        finally:
            stream.close()
        return byte == ord("[")
    return False


def read_profiles(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Profiles with a fixed schema.

    A file that is one JSON array cannot be split, so a large collection should
    be stored as newline-delimited JSON; both are read.
    """
    if multi_line is None:
        multi_line = _is_array(spark, path)
    return spark.read.schema(PROFILE).option("multiLine", multi_line).json(path)


def latest_profiles(df: DataFrame) -> DataFrame:
    """Projection used by the reports; the stored composite keeps its own name."""
    return df.withColumn("profile_composite_risk", F.col("composite_risk_score")).drop(
        "composite_risk_score")
