"""Change feeds between snapshots that are kept in parts by key.

Each part of a snapshot has a digest of the multiset of its (key, hash) pairs. Parts with
equal digests hold the same rows, so only the others are read in full. A snapshot's digests
may be stored when it is written; comparing it with the next one then reads nothing of it
but the parts that differ.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null, as_list, quoted
from ..functions.hashing import digest_of_sums, digest_terms, row_hash_null_safe
from .changes import change_feed


def part_digests(
    snapshot: DataFrame, keys: str | Iterable[str], *, part: str, hash_column: str = "row_hash"
) -> DataFrame:
    """One row per part: ``part``, ``digest``, and ``unkeyed``, the rows with a NULL key.

    Reads keys and hashes only. The sums are combined below the exchange, so a part with
    most of the rows reaches it as one row per task.
    """
    keys = as_list(keys)
    unkeyed = any_null(keys)
    pair = row_hash_null_safe([*keys, hash_column])
    pairs = snapshot.select(quoted(part).alias("part"), unkeyed.alias("__unkeyed"), pair.alias("__pair"))
    terms = digest_terms("__pair")
    sums = [F.sum(term).alias(name) for name, term in terms.items()]
    found = pairs.groupBy("part").agg(F.count("*").alias("__n"), F.count_if("__unkeyed").alias("unkeyed"), *sums)
    return found.select("part", digest_of_sums(F.col("__n"), [F.col(t) for t in terms]).alias("digest"), "unkeyed")


def changed_parts(old: DataFrame, new: DataFrame) -> DataFrame:
    """The parts of two sets of :func:`part_digests` that a change feed has to read.

    Those are parts with another digest, parts that one side lacks, and parts with NULL keys,
    whose rows never match.
    """
    left = old.select("part", F.col("digest").alias("__old"), F.col("unkeyed").alias("__old_unkeyed"))
    right = new.select("part", F.col("digest").alias("__new"), F.col("unkeyed").alias("__new_unkeyed"))
    differ = ~F.col("__old").eqNullSafe(F.col("__new"))
    unmatched = (F.col("__old_unkeyed") > 0) | (F.col("__new_unkeyed") > 0)
    return left.join(right, "part", "full_outer").filter(differ | F.coalesce(unmatched, F.lit(False))).select("part")


def change_feed_by_parts(
    old: DataFrame,
    new: DataFrame,
    keys: str | Iterable[str],
    *,
    part: str,
    hash_column: str = "row_hash",
    old_digests: DataFrame | None = None,
    new_digests: DataFrame | None = None,
) -> DataFrame:
    """The rows of :func:`~rollforward.operators.changes.change_feed`, from the parts that differ.

    Both snapshots are cut into parts by the same function of the key, in the column
    ``part``. The numbers of the parts that differ, at most as many as there are parts,
    become a filter of both scans; on a table partitioned by ``part`` other parts are not read.
    """
    mine = old_digests if old_digests is not None else part_digests(old, keys, part=part, hash_column=hash_column)
    theirs = new_digests if new_digests is not None else part_digests(new, keys, part=part, hash_column=hash_column)
    parts = sorted(r["part"] for r in changed_parts(mine, theirs).collect())
    touched = quoted(part).isin(parts) if parts else F.lit(False)
    return change_feed(old.filter(touched), new.filter(touched), keys, hash_column=hash_column)
