"""Change feeds between snapshots, version ranges and the version watermark."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions.columns import any_null, as_list, quoted
from .merge import update_all

# Columns and types of the watermark table.
WATERMARK_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("last_processed_version", LongType(), False),
        StructField("last_updated", TimestampType(), True),
    ]
)
NEVER_PROCESSED = -1
ROW_STATES = ("insert", "update_postimage")


def empty_watermark(spark: SparkSession) -> DataFrame:
    """The state before any run; also the way to reset and replay everything."""
    return spark.createDataFrame([], WATERMARK_SCHEMA)


def change_feed(
    old: DataFrame, new: DataFrame, keys: str | Iterable[str], *, hash_column: str = "row_hash"
) -> DataFrame:
    """Rows of ``new`` and ``old`` that differ, with ``_change_type``.

    Only keys and hashes are compared across the whole snapshots; whole rows are
    fetched for the keys that changed. Keys are unique per snapshot. A NULL key never
    matches, so such rows are deleted from ``old`` and inserted from ``new``.
    """
    keys = as_list(keys)
    both = [quoted(k) for k in keys]
    null_key = any_null(keys)
    left = old.filter(~null_key).select(*both, quoted(hash_column).alias("__old"))
    right = new.filter(~null_key).select(*both, quoted(hash_column).alias("__new"))
    kind = (
        F.when(F.col("__old").isNull(), F.lit("insert"))
        .when(F.col("__new").isNull(), F.lit("delete"))
        .when(F.col("__old") != F.col("__new"), F.lit("update"))
    )
    moved = left.join(right, keys, "full_outer").select(*both, kind.alias("__kind"))
    moved = moved.filter(F.col("__kind").isNotNull())

    def rows(side: DataFrame, alone: str, image: str) -> DataFrame:
        wanted = moved.filter(F.col("__kind").isin(alone, "update"))
        label = F.when(F.col("__kind") == alone, F.lit(alone)).otherwise(F.lit(image))
        matched = side.join(wanted, keys).withColumn("_change_type", label)
        unkeyed = side.filter(null_key).withColumn("_change_type", F.lit(alone))
        names = [quoted(c) for c in side.columns]
        return matched.select(*names, "_change_type").unionByName(unkeyed)

    return rows(old, "delete", "update_preimage").unionByName(
        rows(new, "insert", "update_postimage")
    )


def change_range(
    feed: DataFrame, start: int, end: int | None = None, *, version: str = "version"
) -> DataFrame:
    """Versions from ``start`` to ``end``, both included; open-ended without ``end``."""
    picked = feed.filter(quoted(version) >= F.lit(start))
    return picked if end is None else picked.filter(quoted(version) <= F.lit(end))


def changes_since(feed: DataFrame, last_version: int, *, version: str = "version") -> DataFrame:
    """The versions after ``last_version``."""
    return change_range(feed, last_version + 1, version=version)


def row_states(feed: DataFrame, change_types: Iterable[str] | None = ROW_STATES) -> DataFrame:
    """Feed rows that state what a row is now; ``None`` lets every change type pass."""
    if change_types is None:
        return feed
    return feed.filter(F.col("_change_type").isin(*change_types))


def latest_version(
    feed: DataFrame, by: str | Iterable[str] = (), *, version: str = "version"
) -> DataFrame:
    """The newest version, per table if ``by`` names the table column."""
    newest = F.max(quoted(version)).cast("bigint").alias("current_version")
    return feed.groupBy(*[quoted(b) for b in as_list(by)]).agg(newest)


def pending_versions(current: DataFrame, watermark: DataFrame) -> DataFrame:
    """Per table the last processed version, -1 if there was none, and the newest."""
    last = F.coalesce("last_processed_version", F.lit(NEVER_PROCESSED).cast("bigint"))
    seen = watermark.groupBy("table_name").agg(
        F.max("last_processed_version").alias("last_processed_version")
    )
    return current.join(seen, "table_name", "left").select(
        "table_name", last.alias("last_processed_version"), "current_version"
    )


def last_processed(watermark: DataFrame, table_name: str) -> int:
    """One table's watermark, -1 if it has none."""
    own = watermark.filter(F.col("table_name") == F.lit(table_name))
    version = own.agg(F.max("last_processed_version")).first()[0]
    return NEVER_PROCESSED if version is None else version


def advance_watermark(
    watermark: DataFrame, table_name: str | Column, version: int | Column, time: Column
) -> DataFrame:
    """The watermark with one table moved to ``version``."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    moved = watermark.sparkSession.range(1).select(
        as_column(table_name).alias("table_name"),
        as_column(version).cast("bigint").alias("last_processed_version"),
        time.cast("timestamp").alias("last_updated"),
    )
    return update_all(watermark, moved, "table_name")
