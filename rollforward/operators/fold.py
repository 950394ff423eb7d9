"""Folding many loads into one merge source, in one job.

The result equals merging the loads one after the other in ``seq`` order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import any_null, as_list, quoted
from ..functions.hashing import packed, unpacked
from .first import keep_first, total_order


def fold_keyed(
    loads: DataFrame,
    keys: str | Iterable[str],
    seq: str,
    *,
    hash_column: str = "row_hash",
    force: str = "rewritten",
) -> DataFrame:
    """Per key the row of its last changed load, with ``load_seq`` and ``updated_seq``.

    A load changes a key when its hash differs from the key's previous load. Keys are
    unique within a load, so a group has at most one row per load. Rows with a NULL
    key never match and all stay. ``force`` is true where the key changed more than
    once: such a row must update the target even if it went back to the target's hash.

    Changes are found on keys, ``seq`` and hashes alone; whole rows move once, to be
    joined with the one load per key that won. ``loads`` is read twice: store it first
    where it is costly to compute.
    """
    keys = as_list(keys)
    null_key = any_null(keys)
    keyed, whole = loads.filter(~null_key), {}
    if (hash_column, "string") in loads.dtypes:  # moved in its short form
        keyed = keyed.withColumn(hash_column, packed(quoted(hash_column)))
        whole = {hash_column: unpacked(quoted(hash_column))}
    winners = _last_changes(keyed, keys, seq, hash_column, force)
    same = quoted(seq) == F.col("updated_seq")
    for key in keys:
        same = same & (quoted(key) == quoted(f"__k_{key}"))
    folded = keyed.join(winners, same).select(*[quoted(c) for c in loads.columns], "load_seq", "updated_seq", quoted(force))
    folded = folded.withColumns(whole)
    unkeyed = loads.filter(null_key).withColumns(
        {"load_seq": quoted(seq), "updated_seq": quoted(seq), force: F.lit(False)}
    )
    return folded.unionByName(unkeyed)


def _last_changes(keyed: DataFrame, keys: list[str], seq: str, hash_column: str, force: str) -> DataFrame:
    """Per key its first load, its last change, and whether it changed more than once."""
    names = [f"__k_{k}" for k in keys]
    narrow = keyed.select(
        *[quoted(k).alias(n) for k, n in zip(keys, names)], quoted(seq).alias("__seq"), quoted(hash_column).alias("__hash")
    )
    columns = [quoted(n) for n in names]
    previous = F.lag("__hash").over(Window.partitionBy(*columns).orderBy("__seq"))
    changed = F.col("__previous").isNull() | (F.col("__previous") != F.col("__hash"))
    return narrow.withColumn("__previous", previous).groupBy(*columns).agg(
        F.min("__seq").alias("load_seq"),
        F.max(F.when(changed, F.col("__seq"))).alias("updated_seq"),
        (F.count_if(changed) > 1).alias(force),
    )


def fold_insert_only(loads: DataFrame, seq: str, *, hash_column: str = "row_hash") -> DataFrame:
    """Per hash its row from the first load that has it, with ``load_seq``."""
    first = keep_first(loads, hash_column, total_order(loads, [seq]))
    return first.withColumn("load_seq", quoted(seq))
