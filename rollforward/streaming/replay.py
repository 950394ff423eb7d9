"""The versioned replay as a stream over the files of a change feed.

The kept state is the rollup per (entity, version, date). Parts of it combine in any
order, so the result does not depend on how files fall into micro-batches, nor on the
order they arrive in: it equals the batch replay of the same feed, as long as the rules'
key stands for the row. Rules by which a later row can undo what an earlier micro-batch
kept (an order, or ``drop_all``) are refused.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions.columns import quoted
from ..functions.hashing import packed
from ..operators.quality import DROP_ALL, DUPLICATE_KEY, Rules, judged
from ..operators.rollup import Rollup, newest_part, recombine, rollup_by_date
from ..plans.ingest import Staging
from ..sources.snapshots import COMPRESSION


@dataclass(frozen=True)
class StreamReplay:
    """One replay with its folders, all below ``out``.

    ``accepted/batch=N`` holds the clean rows of micro-batch N, ``rejects/batch=N`` the
    others, ``state/batch=N`` the rollup after it. A micro-batch reads only earlier
    ones and overwrites its own, so running it again gives the same result.
    """

    out: str
    spec: Rollup
    rules: Rules
    version: str = "version"

    def __post_init__(self):
        if self.rules.order or self.rules.full_duplicates == DROP_ALL:
            raise ValueError("rules with an order or drop_all need the batch replay")

    def start(
        self,
        spark: SparkSession,
        feed_dir: str,
        schema: StructType,
        *,
        files_per_batch: int | None = None,
        bytes_per_batch: int | None = None,
    ) -> StreamingQuery:
        """Process the files that are there and stop; a later start resumes.

        A micro-batch may be bounded by the number or the size of its files.
        """
        reader = spark.readStream.schema(schema)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        if bytes_per_batch is not None:
            reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
        return (
            reader.parquet(feed_dir)
            .writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.out}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        row_key = [*dict.fromkeys([self.version, *self.rules.key])]
        accepted_dir = f"{self.out}/accepted/batch={batch_id}"
        with Staging(spark) as staging:
            found = staging.table(judged(batch, self.rules), "judged")
            kept = found.filter(F.col("reject_reason").isNull()).drop("reject_reason")
            refused = found.filter(F.col("reject_reason").isNotNull())
            schema = kept.schema
            if batch_id > 0:
                # a version may reach over several batches: its keys count only once
                versions = kept.select(self.version).distinct()
                seen = (
                    spark.read.schema(_with_batch(schema)).parquet(f"{self.out}/accepted")
                    .filter(F.col("batch") < batch_id)
                    .join(versions, self.version, "left_semi")
                )
                # keys alone are compared; whole rows meet only those keys that come again
                again = staging.table(_joined(_keys(kept, row_key), _keys(seen, row_key), "left_semi"), "again")
                keyed = kept.withColumns({f"__key{i}": key for i, key in enumerate(_short(kept, row_key))})
                columns = [quoted(c) for c in schema.names]
                repeated = _joined(keyed, again, "left_semi").select(*columns)
                refused = refused.unionByName(repeated.withColumn("reject_reason", F.lit(DUPLICATE_KEY)))
                kept = _joined(keyed, again, "left_anti").select(*columns)
            kept.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(self.version).parquet(accepted_dir)
            refused.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{self.out}/rejects/batch={batch_id}")

        accepted = spark.read.schema(schema).parquet(accepted_dir)
        parts = rollup_by_date(accepted, self.spec, [self.version])
        if batch_id > 0:
            prior = spark.read.schema(parts.schema).parquet(self._state_dir(batch_id - 1))
            parts = recombine(prior.unionByName(parts), self.spec, [self.version])
        state = newest_part(parts, self.spec, [self.version])
        state.write.mode("overwrite").option("compression", COMPRESSION).parquet(self._state_dir(batch_id))

    def _state_dir(self, batch_id: int) -> str:
        return f"{self.out}/state/batch={batch_id}"

    def result(self, spark: SparkSession) -> DataFrame:
        """The rollup after the last micro-batch, with the version each row came from."""
        states = spark.read.parquet(f"{self.out}/state")
        last = states.agg(F.max("batch")).first()[0]
        return states.filter(F.col("batch") == last).select(self.version, *self.spec.outputs)


def _short(rows: DataFrame, names: list[str]) -> list[Column]:
    """Columns as keys that an exchange moves; text in its short form."""
    types = {f.name.lower(): f.dataType for f in rows.schema.fields}
    return [packed(quoted(n)) if types[n.lower()] == StringType() else quoted(n) for n in names]


def _keys(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*[key.alias(f"__key{i}") for i, key in enumerate(_short(rows, names))])


def _joined(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """A join on ``__key`` columns of which NULLs are equal."""
    renamed = keys.toDF(*[f"__seen{i}" for i in range(len(keys.columns))])
    same = [F.col(f"__key{i}").eqNullSafe(F.col(f"__seen{i}")) for i in range(len(keys.columns))]
    return rows.join(renamed, reduce(and_, same), how)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch", LongType())])
