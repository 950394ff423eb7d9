"""The control tables a pipeline starts with."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.changes import empty_watermark
from ..operators.files import empty_load_log
from ..sources.snapshots import append, publish


def create_control_tables(
    spark: SparkSession, log_table: str, watermark_table: str, root: str
) -> None:
    """Create the load log and the version watermark where they are missing.

    The pipelines treat a missing table as an empty one, so this is a convenience for
    those who want to query the tables before the first load.
    """
    if not spark.catalog.tableExists(log_table):
        append(empty_load_log(spark), log_table, root)
    if not spark.catalog.tableExists(watermark_table):
        publish(empty_watermark(spark), watermark_table, f"{root}/{watermark_table}")
