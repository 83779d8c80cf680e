"""Batch outputs: Parquet, CSV directories, one CSV file, catalog objects."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.checks import missing_columns
from ..session import exists, hadoop_path
from ..sources.tables import SourceError
from .versions import BatchLog


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (),
                  mode: str = "overwrite") -> None:
    """Written by all tasks in parallel.

    Partitioned output is rebalanced first: rows of one folder come together in few
    files, and a folder with very many rows is still split over several tasks.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append churn alerts under the date on which their window ends."""
    write_parquet(alerts.withColumn("alert_date", F.to_date("window_end")), path,
                  ("alert_date",), mode="append")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header at exactly ``path``, which is replaced in one step.

    One task writes the file, so this is for reports whose rows are bounded by
    what they group by, not for results that grow with the customers.
    """
    spark = df.sparkSession
    jvm, target, fs = hadoop_path(spark, path)
    draft = f"{path}.{uuid.uuid4().hex}"
    df.coalesce(1).write.option("header", True).csv(draft)
    written = fs.globStatus(jvm.org.apache.hadoop.fs.Path(draft, "part-*"))[0].getPath()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        written.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(written, fs.makeQualified(target), options)
    fs.delete(jvm.org.apache.hadoop.fs.Path(draft), True)


# -- catalog ------------------------------------------------------------------

def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT 'transaction analytics'{where}")


def folder_column(spark: SparkSession, location: str) -> str | None:
    """Name of the column that the sub-folders ``name=value`` of a location stand for."""
    _, root, fs = hadoop_path(spark, location)
    if not fs.exists(root):
        return None
    names = (s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    return next((n.split("=", 1)[0] for n in names if "=" in n), None)


def external_table(spark: SparkSession, name: str, columns: str, location: str,
                   comment: str = "") -> None:
    """Table over Parquet files that another job writes; dropping it keeps the files.

    Files in folders ``step=1`` or ``day=2023-01-01`` may lack that column: then the
    table is partitioned by it. Files that hold all columns are read as they are,
    whatever their folders are called.
    """
    by = folder_column(spark, location)
    if by and by in spark.read.option("recursiveFileLookup", True).parquet(location).columns:
        by = None
    fields = StructType.fromDDL(columns)
    kinds = {f.name: f.dataType.simpleString() for f in fields.fields}
    inside = StructType([f for f in fields.fields if f.name != by]).toDDL()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if by is None:
        layout = f"({inside}) USING parquet OPTIONS (recursiveFileLookup 'true')"
    else:
        kind = kinds.get(by, "date" if by == "day" else "string")
        layout = f"({inside}, {by} {kind}) USING parquet PARTITIONED BY ({by})"
    spark.sql(f"CREATE TABLE {name} {layout} COMMENT '{comment}' LOCATION '{location}'")
    # What a stream landed has a log of its files, from which Spark finds folders and columns itself.
    if by and any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def batch_table(spark: SparkSession, name: str, log: BatchLog, comment: str = "") -> list[str]:
    """Table over a log of batches, kept across runs; returns the folders that this run added.

    Its partitions are those of the folders that the log lists now. Only folders that are new since the last
    run are listed from the file system, and folders that a compaction replaced are taken out.
    """
    by, kinds = log.partition_by[0], {f.name: f.dataType.simpleString() for f in log.schema.fields}
    inside = StructType([f for f in log.schema.fields if f.name != by]).toDDL()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({inside}, log string, {by} {kinds[by]}) USING parquet "
              f"PARTITIONED BY (log, {by}) COMMENT '{comment}' LOCATION '{log.path}'")
    wanted = {f.rsplit("log=", 1)[1]: f for f in log.folders(spark)}
    held = [[v.split("=", 1)[1] for v in r[0].split("/")] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    new = sorted(wanted.keys() - {k for k, _ in held})
    gone = [f"PARTITION (log='{k}', {by}='{v}')" for k, v in held if k not in wanted]
    added = [f"PARTITION (log='{k}', {by}='{v}')" for k in new for v in log.parts(spark, wanted[k])]
    # Many folders go to the catalog in calls of bounded size; old ones leave only when the new ones are in.
    for i in range(0, len(added), 500):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[i:i + 500])}")
    for i in range(0, len(gone), 500):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone[i:i + 500])}")
    spark.catalog.refreshTable(name)
    return [wanted[k] for k in new]


def fraud_view_over(spark: SparkSession, view: str, table: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table} WHERE isFraud = 1")


def overwrite_table(df: DataFrame, name: str) -> None:
    """Managed table with exactly these rows, created on first use."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    else:
        df.write.format("parquet").saveAsTable(name)


def analyze(spark: SparkSession, table: str, columns: bool = False) -> None:
    """Statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{' FOR ALL COLUMNS' if columns else ''}")


# -- exports ------------------------------------------------------------------

def export_datasets(datasets: Mapping[str, DataFrame | None], root: str,
                    list_only: bool = False) -> list[tuple[str, str, str]]:
    """Every given dataset as a flat CSV directory.

    Returns (name, status, detail): ``OK``, ``SKIP`` where the input is missing,
    or ``BAD`` where a dataset lacks columns its readers need.
    """
    report = []
    for name, df in datasets.items():
        if df is None:
            report.append((name, "SKIP", "no input"))
            continue
        lacking = missing_columns(df, name)
        if lacking:
            report.append((name, "BAD", f"missing column(s): {', '.join(lacking)}"))
            continue
        if not list_only:
            flat = df.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c)
                               for c, t in df.dtypes])
            write_csv(flat, f"{root.rstrip('/')}/{name}")
        report.append((name, "OK", f"{len(df.columns)} columns"))
    return report


def _whole(value: Column) -> Column:
    """A double without a fraction as an exact number, also beyond 2^53; NULL if it is not finite.

    A plain cast to decimal goes by the shortest text of the double and puts zeros for its last digits.
    """
    high = (value / 2.0 ** 62).try_cast("long")
    low = (value - high.cast("double") * 2.0 ** 62).try_cast("long")
    return (high.cast("decimal(19,0)") * F.lit(2 ** 62).cast("decimal(19,0)") + low.cast("decimal(19,0)")).cast("decimal(38,0)")


def content_sums(df: DataFrame) -> DataFrame:
    """(rows, content): the row count and a sum over rows that no order changes.

    A row counts as 48 bits of the digest of its columns in their order. Fractions are taken in whole
    millionths, other values as text, missing ones as a mark of their own.
    """
    def shown(c: str, kind: str) -> Column:
        value = F.col(f"`{c}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            value = _whole(F.round(value.cast("double") * 1_000_000))
        return F.coalesce(value.cast("string"), F.lit("\x00"))

    text = F.concat_ws("\x1f", *[shown(c, kind) for c, kind in df.dtypes])
    part = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("decimal(20,0)")
    return df.select(part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("part"), F.lit(0)).cast("decimal(38,0)").alias("content"))


def export_manifest(spark: SparkSession, report: list[tuple[str, str, str]], root: str,
                    schemas: Mapping[str, StructType], columns: Mapping[str, list[str]] | None = None) -> DataFrame:
    """(dataset, status, rows, content) of an export as it lies in its folders, read with the datasets' types.

    ``columns`` says which columns count, by default all. Datasets that were not written have no sums. Lists were written as text and count as such.
    """
    out = spark.createDataFrame([(n, s) for n, s, _ in report if s != "OK"], "dataset string, status string").select(
        "dataset", "status", F.lit(None).cast("long").alias("rows"), F.lit(None).cast("decimal(38,0)").alias("content"))
    for name, status, _ in report:
        if status != "OK":
            continue
        flat = ", ".join(f"`{f.name}` {'string' if f.dataType.typeName() == 'array' else f.dataType.simpleString()}" for f in schemas[name].fields)
        written = spark.read.schema(flat).option("header", True).csv(f"{root.rstrip('/')}/{name}")
        written = written.select(*(columns or {}).get(name, written.columns))
        out = out.unionByName(content_sums(written).select(F.lit(name).alias("dataset"), F.lit("OK").alias("status"), "rows", "content"))
    return out


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


def require(df: DataFrame | None, name: str) -> DataFrame:
    if df is None:
        raise SourceError(f"{name} has not been built yet")
    return df
