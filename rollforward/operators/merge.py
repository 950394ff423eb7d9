"""Merges as functions of two DataFrames; the caller writes the result.

None of them moves the target when the source is small enough for Spark to
broadcast: the target is always on the streamed side of its join. With a large
source the same plans become sort-merge joins on keys that are unique per side. A
NULL in a key never matches: such source rows are inserted and such target rows are
kept, both past the joins, so any number of them does no harm.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import any_null, as_list, quoted
from ..functions.hashing import packed, unpacked


def _unmatched(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows without a partner in the target.

    The target's keys are first cut down to those the source has. That intermediate
    is no larger than the source, so a small source keeps the whole plan free of a
    target shuffle, which a direct anti join against the target would need.
    """
    columns = [quoted(k) for k in keys]
    null_key = any_null(keys)
    keyed = source.filter(~null_key)
    present = target.filter(~null_key).select(*columns)
    shared = present.join(keyed.select(*columns), keys, "left_semi").distinct()
    unmatched = keyed.join(shared, keys, "left_anti")
    return unmatched.select(*[quoted(c) for c in source.columns]).unionByName(
        source.filter(null_key)
    )


def _matched(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    hash_column: str,
    force: str | None,
    how: str,
) -> tuple[DataFrame, Column]:
    """Keyed target rows with their source columns as ``__s_<name>``, and the update test."""
    renamed = source.select(*[quoted(c).alias(f"__s_{c}") for c in source.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & (quoted(key) == quoted(f"__s_{key}"))
    joined = target.filter(~any_null(keys)).join(renamed, condition, how)
    changed = quoted(hash_column) != quoted(f"__s_{hash_column}")
    if force is not None:
        changed = changed | quoted(f"__s_{force}")
    # an unmatched row has NULL source columns, and an unknown test updates nothing
    return joined, F.coalesce(changed, F.lit(False))


INSERT, UPDATE = "insert", "update"


def _short(df: DataFrame, hash_column: str) -> Column:
    """A hash as it is compared: text in half its length."""
    text = df.select(quoted(hash_column)).schema[0].dataType == StringType()
    return packed(quoted(hash_column)) if text else quoted(hash_column)


def _with_short_hash(
    target: DataFrame, source: DataFrame, hash_column: str
) -> tuple[DataFrame, DataFrame, dict[str, Column]]:
    """Both sides with the hash as it is moved, and the column that makes it whole again."""
    if any((hash_column, "string") not in df.dtypes for df in (target, source)):
        return target, source, {}
    short = {hash_column: packed(quoted(hash_column))}
    return target.withColumns(short), source.withColumns(short), {hash_column: unpacked(quoted(hash_column))}


def kinds_of_change(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str],
    *,
    hash_column: str = "row_hash",
    force: str | None = None,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Keys that :func:`upsert_changed` would insert or update, with their ``kind``.

    Only keys and hashes are read of the target, and ``carry`` of the source besides.
    """
    keys = as_list(keys)
    null_key = any_null(keys)
    columns, carried = [quoted(k) for k in keys], [quoted(c) for c in carry]
    asked = quoted(force) if force is not None else F.lit(False)
    new, known = (_short(df, hash_column) for df in (source, target))
    given = source.select(*columns, *carried, new.alias("__new"), asked.alias("__force"))
    keyed = given.filter(~null_key)
    old = target.filter(~null_key).select(*columns, known.alias("__old"))
    old = old.join(keyed.select(*columns), keys, "left_semi")  # no larger than the source
    kind = F.when(F.col("__old").isNull(), F.lit(INSERT)).when(
        (F.col("__old") != F.col("__new")) | F.col("__force"), F.lit(UPDATE)
    )
    moved = keyed.join(old, keys, "left").withColumn("kind", kind).filter(F.col("kind").isNotNull())
    unkeyed = given.filter(null_key).withColumn("kind", F.lit(INSERT))
    return moved.select(*columns, *carried, "kind").unionByName(unkeyed.select(*columns, *carried, "kind"))


def upsert_changed(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str],
    *,
    hash_column: str = "row_hash",
    keep: Iterable[str] = ("load_datetime",),
    force: str | None = None,
) -> DataFrame:
    """Update matched rows whose hash differs, insert unmatched source rows.

    An update takes every source column except those in ``keep``. ``force`` names a
    boolean source column that asks for the update even when the hashes agree.
    """
    keys = as_list(keys)
    target, source, whole = _with_short_hash(target, source, hash_column)
    joined, changed = _matched(target, source, keys, hash_column, force, "left")
    taken = {c for c in source.columns if c != force} - set(keep) - set(keys)
    merged = joined.select(
        *[
            F.when(changed, quoted(f"__s_{c}")).otherwise(quoted(c)).alias(c)
            if c in taken
            else quoted(c)
            for c in target.columns
        ]
    )
    inserts = _unmatched(source, target, keys)
    merged = merged.unionByName(target.filter(any_null(keys)))
    return merged.unionByName(inserts.drop(force) if force else inserts).withColumns(whole)


def upsert_changes(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str],
    *,
    hash_column: str = "row_hash",
    keep: Iterable[str] = ("load_datetime",),
    force: str | None = None,
) -> DataFrame:
    """The change rows :func:`upsert_changed` causes, without comparing snapshots."""
    keys = as_list(keys)
    keep = set(keep) | set(keys)
    target, source, whole = _with_short_hash(target, source, hash_column)
    joined, changed = _matched(target, source, keys, hash_column, force, "inner")
    names = [c for c in target.columns]
    before = F.struct(*[quoted(c) for c in names], F.lit("update_preimage").alias("_change_type"))
    after = F.struct(
        *[(quoted(c) if c in keep else quoted(f"__s_{c}")).alias(c) for c in names],
        F.lit("update_postimage").alias("_change_type"),
    )
    updates = joined.filter(changed).select(F.explode(F.array(before, after)).alias("__row"))
    inserts = _unmatched(source, target, keys).select(*[quoted(c) for c in names])
    moved = updates.select("__row.*").unionByName(inserts.withColumn("_change_type", F.lit("insert")))
    return moved.withColumns(whole)


def insert_only(target: DataFrame, source: DataFrame, hash_column: str = "row_hash") -> DataFrame:
    """The target plus the source rows whose hash it does not have."""
    return target.unionByName(_unmatched(source, target, [hash_column]))


def insert_only_changes(
    target: DataFrame, source: DataFrame, hash_column: str = "row_hash"
) -> DataFrame:
    """The change rows :func:`insert_only` causes."""
    return _unmatched(source, target, [hash_column]).withColumn("_change_type", F.lit("insert"))


def update_all(target: DataFrame, source: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Replace matched target rows as a whole, NULLs included; insert the rest."""
    keys = as_list(keys)
    null_key = any_null(keys)
    replaced = source.filter(~null_key).select(*[quoted(k) for k in keys])
    kept = target.filter(~null_key).join(replaced, keys, "left_anti")
    return (
        kept.select(*[quoted(c) for c in target.columns])
        .unionByName(target.filter(null_key))
        .unionByName(source)
    )
