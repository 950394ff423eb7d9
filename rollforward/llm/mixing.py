"""Mix sources to target weights by hash thresholds.

Every document has a fixed hash. Each source takes all its documents as often as its
target holds its size, and once more those whose hash lies below a threshold. Thresholds
are found in histograms: token sums per source and hash bucket, then, for the one bucket
of each source that the budget ends in, sums over the buckets inside it, and so on. The
documents are filtered by threshold and never sorted. A larger budget has a higher
threshold, so mixes are nested.

Defined results: a NULL text has size 0. A NULL source is a source of its own, the last
in order. Rows equal in id and text have one hash and are taken alike. Sources without
words, and empty tables, take nothing. What the last histogram cannot divide (one bucket
in 2**40, in most cases one document) is taken if that comes closer to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stage, with_rank

HASH_BITS = 60
STEP_BITS = 10  # 1024 buckets for each source and histogram
STEPS = 4


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(key: str = "doc_id", text: str = "text") -> Column:
    """60 bits of a digest of id and text, the same in every run and engine."""
    both = F.concat(
        F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(F.col(text), F.lit(""))
    )
    return F.conv(F.substring(F.md5(both), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """One narrow, stored row per document: id, source, words, hash."""
    return stage(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            words(F.col(text)).alias("size"),
            document_hash(key, text).alias("hash"),
        ),
        "sized",
    )


def weighted_targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """Per source: size, weight and target.

    Sources in code point order weigh ``weights``, repeating, and share ``share`` of all
    words. No target exceeds ``most`` times its source's size: what is above is shared
    by the others by weight, until none is above.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = with_rank(sizes, "_rank", F.col("source").asc_nulls_last()).withColumn("weight", place)
    sources = stage(ranked.drop("_rank"), "sources")

    limit = most * F.col("source_size")
    level, capped = 0.0, None
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while True:  # each round caps at least one source more
        above = limit < F.col("weight") * F.lit(level)
        n, full, open_weight = sources.agg(
            F.count_if(above), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not open_weight:
            break
        level, capped = (share * total - (full or 0)) / open_weight, n
    target = F.least(F.col("weight") * F.lit(level), limit.cast("double"))
    return sources.withColumn("target", target)


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: how often all is taken, and the hash below which once more."""
    fits = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("times", fits.cast("long")).withColumn(
        "rest", F.col("target") - F.col("times") * F.col("source_size")
    )
    state = state.withColumn("whole", F.col("rest") <= 0)
    state = state.withColumn("bucket", F.lit(0).cast("long"))
    per_source = Window.partitionBy("source").orderBy("bucket")
    for step in range(1, STEPS + 1):
        width, above = HASH_BITS - step * STEP_BITS, HASH_BITS - (step - 1) * STEP_BITS
        sums = rows.select(
            "source", "size", F.shiftright("hash", width).alias("bucket"), F.shiftright("hash", above).alias("inside")
        )
        if step > 1:  # only the bucket that the budget ends in
            ends = state.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"))
            here = F.col("source").eqNullSafe(F.col("_source")) & (F.col("inside") == F.col("_bucket"))
            sums = sums.join(ends, here).drop("_source", "_bucket")
        sums = sums.groupBy("source", "bucket").agg(F.sum("size").alias("tokens"))
        sums = sums.withColumn("upto", F.sum("tokens").over(per_source)).withColumnRenamed("source", "_source")
        left = state.drop("bucket")
        found = left.join(sums, left["source"].eqNullSafe(sums["_source"])).filter(
            (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("tokens") <= F.col("rest"))
        )
        state = found.withColumn("rest", F.col("rest") - (F.col("upto") - F.col("tokens"))).select(
            *[c for c in left.columns], "bucket", "tokens"
        )
        if step < STEPS:  # written, as the next step reads it twice: the plan would double with each
            state = stage(state.drop("tokens"), "bucket-ends")
    closer = F.col("tokens") - F.col("rest") < F.col("rest")
    end = F.shiftleft(F.col("bucket") + closer.cast("long"), HASH_BITS - STEPS * STEP_BITS)
    end = F.when(F.col("whole"), 0).otherwise(end)  # also of documents without a word none is taken once more
    return state.select(F.col("source").alias("_source"), F.col("times").alias("_times"), end.alias("below"))


def mix_plan(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """One stored row per source: size, target, whole times and threshold."""
    targets = stage(weighted_targets(rows, weights, share, most), "targets")
    ends = thresholds(rows, targets)
    plan = targets.join(ends, targets["source"].eqNullSafe(ends["_source"]), "left")
    return stage(
        plan.select(
            F.col("source").alias("_source"),
            "source_size",
            "target",
            F.coalesce("_times", F.lit(0)).alias("_times"),
            F.coalesce("below", F.lit(0)).alias("_below"),
        ),
        "mix-plan",
    )


def times() -> Column:
    return F.col("_times") + (F.col("_hash") < F.col("_below")).cast("long")


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """One row per document: id, size, its source's size and target, times it is taken."""
    rows = sized(docs)
    plan = mix_plan(rows, **options)
    mixed = rows.withColumnRenamed("hash", "_hash").join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return mixed.select("doc_id", "size", "source_size", "target", times().alias("times"))


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    plan = mix_plan(sized(docs), **options).drop("source_size", "target")
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), document_hash().alias("_hash"), "source")
    mixed = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).filter(times() > 0)
    again = mixed.select("_doc", F.explode(F.sequence(F.lit(1), times().cast("int"))))
    return again.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
