"""Exact deduplication against a persistent index of text digests.

The index is a parquet table bucketed and sorted by digest, with one partition per
batch. A batch is first reduced to one row per digest (on the map side, so a group of
copies of any size reaches the exchange as one row per task), then joined against the
index with a sort-merge anti-join that reads the index without an exchange, and its new
digests are appended.

Defined results: a NULL text counts as empty, so NULL and blank texts are copies of one
another. Of rows that tie in length, the smallest id stays, NULL ids last; of rows that
tie in both, exactly one. An empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, stage


def normalised(text: Column) -> Column:
    """The text without the white space ``[\\x20\\x09-\\x0D]``."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """The digests of all batches admitted so far, kept in ``path``.

    ``buckets`` is fixed when the index is made; choose it so that a bucket fits a task.
    """

    COLUMNS = "digest BINARY, keep_id BIGINT, keep_row BIGINT, copies BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.path, self.buckets = spark, name, path, buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self.COLUMNS}) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        spark.sql(f"MSCK REPAIR TABLE {name}")  # batches of earlier sessions

    def entries(self) -> DataFrame:
        """All entries; reading them for a join on the digest needs no exchange."""
        return self.spark.table(self.name)

    def admit(self, candidates: DataFrame, batch: str) -> None:
        """Append the candidates whose digest no other batch holds.

        Admitting a batch again replaces what it wrote before, so a broken-off run can
        be repeated.
        """
        others = self.entries().filter(F.col("batch") != batch).select("digest")
        new = candidates.join(others.hint("merge"), "digest", "left_anti")
        new = stage(new.select("digest", "keep_id", "keep_row", "copies"), "new-digests")
        new = new.repartition(self.buckets, "digest")
        new.createOrReplaceTempView(view := f"{self.name}_new")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{batch}') SELECT * FROM {view}"
        )
        self.spark.catalog.dropTempView(view)


def digest_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One narrow, stored row per document: key, length, digest, row number."""
    return stage(
        docs.select(
            F.col(key).cast("long").alias("doc_id"),
            F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
            digest(F.col(text)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def representatives(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays and the number of copies."""
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "row")
    best = rows.groupBy("digest").agg(F.min(order).alias("best"), F.count("*").alias("copies"))
    return best.select(
        "digest",
        F.col("best.doc_id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
        "copies",
    )


def deduplicate(rows: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Admit a batch of :func:`digest_rows` to the index and say what became of each row.

    ``keep_id`` is the document that stands for the text in the index, ``group_size`` the
    number of copies in the batch that brought it. A row is kept if its own batch brought
    its text and it is the row that stays.
    """
    index.admit(representatives(rows), batch)
    # by path, not by table: with both sides exchanged, a hot digest's rows can be split
    known = index.spark.read.schema(index.COLUMNS).parquet(index.path).select(
        "digest", "keep_id", "keep_row", "copies", "batch"
    )
    return rows.join(known.hint("merge"), "digest").select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        ((F.col("batch") == batch) & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = deduplicate(digest_rows(docs), index, batch).filter("kept")
    identity = lambda digest: F.concat_ws(" ", digest, F.col("doc_id"))
    kept = kept.select(identity(F.col("text_sha256")).alias("_key"))
    # one row for each id and text, combined below the exchange: of rows equal in both,
    # which differ in white space at most, the longest stays
    length = F.length(F.coalesce(F.col("text"), F.lit("")))
    once = docs.groupBy(identity(F.sha2(normalised(F.col("text")), 256)).alias("_key")).agg(
        F.max_by(F.struct(*docs.columns), length).alias("_doc")
    )
    stays = once.join(kept.hint("merge"), "_key", "left_semi")
    return stays.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
