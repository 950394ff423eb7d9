"""Tables kept as one parquet directory per snapshot.

A table that is being read cannot be overwritten, so every result goes to a new
directory; pointing the catalog table at it publishes it in one step.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

SHARED_DIR_SETTING = "spark.checkpoint.dir"
COMPRESSION = "zstd"  # of row hashes as text it leaves half, where snappy leaves all


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share, as the session names it.

    Only where the setting is missing, as on a developer's machine, does it fall
    back to a temporary folder.
    """
    root = spark.conf.get(SHARED_DIR_SETTING, None)
    root = root or spark.sparkContext.getConf().get(SHARED_DIR_SETTING, None)
    root = root or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SHARED_DIR_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="rollforward-")
    return f"{root.rstrip('/')}/rollforward/{name}-{uuid.uuid4().hex}"


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The table, or no rows of ``schema`` before the first load: one path for both."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def publish(df: DataFrame, table: str, root: str) -> None:
    """Write ``df`` as the next snapshot under ``root`` and point ``table`` at it."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.option("compression", COMPRESSION).parquet(path)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=path, source="parquet")


def current_location(spark: SparkSession, table: str) -> str | None:
    """Where the table's snapshot is, None if there is no table."""
    return table_location(spark, table) if spark.catalog.tableExists(table) else None


def require_location(spark: SparkSession, table: str, location: str | None) -> None:
    """Raise if another load has published ``table`` since its location was read."""
    if current_location(spark, table) != location:
        raise RuntimeError(f"{table} was changed by another load; load again")


def append(df: DataFrame, table: str, root: str) -> None:
    """Append to a table; a new one is kept under ``root``."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    path = table_location(spark, table) if exists else f"{root.rstrip('/')}/{table}"
    df.write.mode("append").parquet(path)
    if not exists:
        spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.refreshTable(table)


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a folder; False where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_partitions(df: DataFrame, table: str, partition_by: str, root: str) -> None:
    """Write partitions of a table, replacing those that ``df`` holds rows for.

    A new table is kept under ``root``. Doing the same write again changes nothing.
    """
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    path = table_location(spark, table) if exists else f"{root.rstrip('/')}/{table}"
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(partition_by)
        .parquet(path)
    )
    if not exists:
        columns = [f for f in df.schema.fields if f.name != partition_by]
        spark.catalog.createTable(table, path=path, source="parquet", schema=_nullable(
            [*columns, df.schema[partition_by]]
        ))
    spark.catalog.refreshTable(table)


def drop_partitions(spark: SparkSession, table: str, partition_by: str, low: int, high: int) -> None:
    """Delete the partitions of a table from ``low`` to ``high``, both included.

    Folders are listed, so the work grows with the partitions and not with their rows.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(table_location(spark, table))
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if name == partition_by and value.lstrip("-").isdigit() and low <= int(value) <= high:
            system.delete(status.getPath(), True)
    spark.catalog.refreshTable(table)


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def _nullable(fields: list[StructField]) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in fields])
