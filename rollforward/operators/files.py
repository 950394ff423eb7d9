"""File fingerprints, the load log, and which files are new."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from ..functions.columns import as_list, quoted
from ..functions.hashing import digest_of_sums, digest_terms
from .first import keep_first

# Columns and types of the load log.
LOAD_LOG_SCHEMA = StructType(
    [
        StructField("file_name", StringType(), False),
        StructField("file_hash", StringType(), False),
        StructField("load_time", TimestampType(), True),
    ]
)


def empty_load_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LOAD_LOG_SCHEMA)


def _digest(rows: DataFrame, by: list[str], hash_column: str, alias: str) -> DataFrame:
    terms = digest_terms(hash_column)
    sums = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in terms]
    summed = (
        rows.select(*[quoted(b) for b in by], *[c.alias(n) for n, c in terms.items()])
        .groupBy(*[quoted(b) for b in by])
        .agg(F.count(F.lit(1)).alias("__n"), *sums)
    )
    digest = digest_of_sums(F.col("__n"), [F.col(name) for name in terms])
    return summed.select(*[quoted(b) for b in by], digest.alias(alias))


def fingerprint(rows: DataFrame, hash_column: str = "row_hash") -> DataFrame:
    """One row with the ``file_hash`` of all rows; works on no rows as well."""
    return _digest(rows, [], hash_column, "file_hash")


def file_fingerprints(
    rows: DataFrame,
    file_columns: str | Iterable[str] = "file_name",
    hash_column: str = "row_hash",
    files: DataFrame | None = None,
) -> DataFrame:
    """``file_hash`` per file: a digest of the multiset of its row hashes.

    Row hashes are cut into integer terms and summed, so the digest ignores row
    order and partitioning, counts copies, and combines on the map side: a task
    sends one fixed-size row per file, whatever the size of the file. ``files``
    lists the files that should come out even when they hold no row.
    """
    by = as_list(file_columns)
    digests = _digest(rows, by, hash_column, "file_hash")
    if files is None:
        return digests
    nothing = F.sha2(F.lit(""), 256)
    return (
        files.select(*[quoted(b) for b in by])
        .distinct()
        .join(digests, by, "left")
        .withColumn("file_hash", F.coalesce("file_hash", nothing))
    )


def new_files(
    fingerprints: DataFrame, log: DataFrame, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Files whose content is not in the log, by content hash only.

    With ``order``, of several files with one content only the first stays. The log
    grows with the data, so its join strategy is left to Spark's size estimate.
    """
    unseen = fingerprints.join(log.select("file_hash"), "file_hash", "left_anti")
    unseen = unseen.select(*fingerprints.columns)
    return unseen if order is None else keep_first(unseen, "file_hash", order)


def is_loaded(log: DataFrame, file_hash: str) -> bool:
    """Whether one content hash is in the log."""
    return not log.filter(F.col("file_hash") == F.lit(file_hash)).isEmpty()


def log_rows(accepted: DataFrame, load_time: Column, file_column: str = "file_name") -> DataFrame:
    """The log rows of accepted files."""
    return accepted.select(
        quoted(file_column).alias("file_name"),
        F.col("file_hash"),
        load_time.cast("timestamp").alias("load_time"),
    )
