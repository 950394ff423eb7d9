"""Splitting rows into clean and rejected ones, and primary-key checks."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import any_null, as_list, quoted
from ..functions.hashing import packed, unpacked
from .first import (
    by_heat,
    by_repeats,
    counted_per_key,
    flag_first,
    keep_first,
    one_per_key,
    total_order,
)

# What stands in ``reject_reason``.
NULL_PREFIX = "null:"
FULL_DUPLICATE = "full_duplicate"
DUPLICATE_KEY = "duplicate_key"
CLEAN = "clean"

KEEP_ONE, DROP_ALL, OFF = "keep_one", "drop_all", "off"


@dataclass(frozen=True)
class Rules:
    """What makes a row clean.

    ``required`` columns hold no NULL; of rows with one ``key`` the first in
    ``order`` stays (ties are settled by a hash of the row). ``full_duplicates``:
    ``keep_one`` rejects all but one copy of equal rows; ``drop_all`` takes every
    copy out of the clean rows and rejects one; ``off`` has no such rule, so copies
    count as key duplicates. ``identity`` names columns that stand for the full row.
    """

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    full_duplicates: str = KEEP_ONE
    identity: tuple[str, ...] = ()

    def __post_init__(self):
        if self.full_duplicates not in (KEEP_ONE, DROP_ALL, OFF):
            raise ValueError(f"unknown full_duplicates: {self.full_duplicates}")

    def within(self, column: str) -> Rules:
        """The same rules among rows of one value of ``column``."""
        return self if column in self.key else replace(self, key=(column, *self.key))

    def row_identity(self, df: DataFrame) -> list[str]:
        """The key belongs to it: equal ``identity`` under two keys is no copy."""
        return list(dict.fromkeys([*self.key, *self.identity])) if self.identity else df.columns


def null_reason(required: Iterable[str]) -> Column:
    """``null:<col>`` for the first required column that is NULL, else NULL."""
    tests = [F.when(quoted(c).isNull(), F.lit(NULL_PREFIX + c)) for c in required]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def null_rejects(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows with a NULL in a required column, each once, with its reason."""
    required = list(required)
    return df.filter(any_null(required)).withColumn("reject_reason", null_reason(required))


def not_null(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows without such a NULL; copies stay copies."""
    return df.filter(~any_null(required))


def unduplicated(df: DataFrame, identity: Iterable[str] = ()) -> DataFrame:
    """Rows that occur once; every copy of a repeated row is gone."""
    counted = counted_per_key(df, list(identity) or df.columns, "__n")
    return counted.filter(F.col("__n") == 1).drop("__n")


def duplicated(df: DataFrame, identity: Iterable[str] = ()) -> DataFrame:
    """One copy of each row that occurs more than once."""
    counted = counted_per_key(df, list(identity) or df.columns, "__n")
    return counted.filter(F.col("__n") > 1).drop("__n")


def clean(df: DataFrame, rules: Rules, columns: Iterable[str] | None = None) -> DataFrame:
    """The rows to keep; ``columns`` says which of their columns are needed."""
    columns = list(columns) if columns is not None else df.columns
    kept = not_null(df, rules.required)
    if rules.full_duplicates == DROP_ALL:
        kept = unduplicated(kept, rules.row_identity(df))
    if not rules.order:
        return one_per_key(kept, rules.key, columns)
    first = keep_first(kept, rules.key, total_order(kept, rules.order))
    return first.select(*[quoted(c) for c in columns])


def judged(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows of :func:`clean` with a NULL ``reject_reason``, and those of :func:`rejected` with theirs.

    A row that is alone under its key is clean and not moved.
    """
    alone, again = by_repeats(not_null(df, rules.required), rules.key)
    rest, hot = by_heat(again, rules.key)
    names = [*[quoted(c) for c in df.columns], F.col("reject_reason")]
    found = _judged_together(rest, rules).unionByName(_judged_apart(hot, rules).select(*names))
    found = found.unionByName(alone.withColumn("reject_reason", F.lit(None).cast("string")))
    return null_rejects(df, rules.required).unionByName(found)


def rejected(df: DataFrame, rules: Rules) -> DataFrame:
    """The rows to set aside, with ``reject_reason``."""
    return judged(df, rules).filter(F.col("reject_reason").isNotNull())


def _judged_together(rows: DataFrame, rules: Rules) -> DataFrame:
    """:func:`judged` for rows of which all with one key meet in a task: they move once."""
    texts = [f.name for f in rows.schema.fields if f.dataType == StringType()]
    moved = rows.withColumns({t: packed(quoted(t)) for t in texts}) if texts else rows
    moved = moved.repartition(*[quoted(k) for k in rules.key])
    text_of = {t.lower(): unpacked(quoted(t)) for t in texts}
    tie = F.xxhash64(*[text_of.get(c.lower(), quoted(c)) for c in rows.columns])  # as row_tie, but not moved
    order = [*[text_of.get(o.lower(), quoted(o)) for o in rules.order], tie]
    # a row's identity holds its key, so its copies are where the rows of its key are
    key = Window.partitionBy(*[quoted(k) for k in rules.key])
    copies = Window.partitionBy(*[quoted(c) for c in rules.row_identity(rows)])
    if rules.full_duplicates == OFF:
        marked = moved.withColumn("__first", F.row_number().over(key.orderBy(*order)))
        reason = F.when(F.col("__first") > 1, DUPLICATE_KEY)
    elif rules.full_duplicates == KEEP_ONE:
        # copies in the order of their key, so that the first of a key is the first of its copies, too
        marked = moved.withColumn("__first", F.row_number().over(key.orderBy(*order)))
        marked = marked.withColumn("__one", F.row_number().over(copies.orderBy("__first")))
        reason = F.when(F.col("__one") > 1, FULL_DUPLICATE).when(F.col("__first") > 1, DUPLICATE_KEY)
    else:
        marked = moved.withColumn("__one", F.row_number().over(copies.orderBy(tie)))
        marked = marked.withColumn("__n", F.count(F.lit(1)).over(copies))
        alone = F.col("__n") == 1
        marked = marked.filter(alone | (F.col("__one") == 1))
        marked = marked.withColumn("__first", F.row_number().over(key.orderBy(alone.desc(), *order)))
        reason = F.when(~alone, FULL_DUPLICATE).when(F.col("__first") > 1, DUPLICATE_KEY)
    columns = [unpacked(quoted(c)).alias(c) if c in texts else quoted(c) for c in rows.columns]
    return marked.select(*columns, F.coalesce(reason, F.lit(None).cast("string")).alias("reject_reason"))


def _judged_apart(rows: DataFrame, rules: Rules) -> DataFrame:
    """:func:`judged` in more rounds, in which no task gets all the rows of a key."""
    order, identity = total_order(rows, rules.order), rules.row_identity(rows)
    gone = None
    if rules.full_duplicates == DROP_ALL:
        gone = duplicated(rows, identity).withColumn("reject_reason", F.lit(FULL_DUPLICATE))
        rows = unduplicated(rows, identity)
    if rules.full_duplicates == KEEP_ONE:
        marked = flag_first(rows, identity, order, "__one")
        marked = flag_first(marked, rules.key, [F.col("__one").desc(), *order], "__first")
        reason = F.when(~F.col("__one"), FULL_DUPLICATE).when(~F.col("__first"), DUPLICATE_KEY)
    else:
        marked = flag_first(rows, rules.key, order, "__first")
        reason = F.when(~F.col("__first"), DUPLICATE_KEY)
    marked = marked.withColumn("reject_reason", reason).drop("__one", "__first")
    return marked if gone is None else marked.unionByName(gone)


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """``(clean, rejected)``; with ``keep_one`` or ``off`` every row is in one of them."""
    return clean(df, rules), rejected(df, rules)


def summary(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows per ``outcome``, by counting alone: no row is numbered or sorted.

    Counts per (key, row) are combined on the map side, then per key, then overall,
    so neither a hot key nor a group of copies meets in one task.
    """
    reason = null_reason(rules.required)
    identity = rules.row_identity(df) if rules.full_duplicates != OFF else list(rules.key)
    keys = [f"__k{i}" for i in range(len(rules.key))]
    cells = [f"__c{i}" for i in range(len(identity))]
    keyed = df.select(
        reason.alias("__reason"),
        *[F.when(reason.isNull(), quoted(k)).alias(a) for k, a in zip(rules.key, keys)],
        *[F.when(reason.isNull(), quoted(c)).alias(a) for c, a in zip(identity, cells)],
    )
    rows = keyed.groupBy("__reason", *keys, *cells).agg(F.count(F.lit(1)).alias("__n"))
    per_key = rows.groupBy("__reason", *keys).agg(
        F.sum("__n").alias("__rows"),
        F.count(F.lit(1)).alias("__ids"),
        F.count_if(F.col("__n") == 1).alias("__single"),
    )
    if rules.full_duplicates == DROP_ALL:
        first = F.least(F.col("__single"), F.lit(1))
        copies = F.col("__ids") - F.col("__single")
        others = F.col("__single") - first
    elif rules.full_duplicates == KEEP_ONE:
        first, copies = F.lit(1), F.col("__rows") - F.col("__ids")
        others = F.col("__ids") - 1
    else:
        first, copies, others = F.lit(1), F.lit(0), F.col("__rows") - 1
    totals = per_key.groupBy("__reason").agg(
        F.sum("__rows").alias("__rows"),
        F.sum(first).alias("__first"),
        F.sum(copies).alias("__copies"),
        F.sum(others).alias("__others"),
    )
    pair = lambda name, n: F.struct(F.lit(name).alias("outcome"), F.col(n).alias("n"))
    passed = F.array(
        pair(CLEAN, "__first"), pair(FULL_DUPLICATE, "__copies"), pair(DUPLICATE_KEY, "__others")
    )
    failed = F.array(F.struct(F.col("__reason").alias("outcome"), F.col("__rows").alias("n")))
    outcomes = totals.select(
        F.explode(F.when(F.col("__reason").isNull(), passed).otherwise(failed)).alias("__o")
    )
    return outcomes.select("__o.outcome", "__o.n").filter(F.col("n") > 0)


def pk_violations(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Keys that are NULL or occur more than once, with their row count ``n``."""
    keys = as_list(keys)
    is_null = any_null(keys)
    kind = F.when(is_null, F.lit("null_key")).otherwise(F.lit("duplicate_key"))
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(is_null | (F.col("n") > 1)).select(
        kind.alias("violation"), *[quoted(k) for k in keys], "n"
    )


def validate_primary_key(df: DataFrame, keys: str | Iterable[str]) -> None:
    """Raise ``ValueError`` if a key is NULL or repeated; NULLs are named first."""
    found = pk_violations(df, keys).select("violation").distinct().collect()  # two rows at most
    kinds = {row["violation"] for row in found}
    if "null_key" in kinds:
        raise ValueError("Found NULL primary keys")
    if "duplicate_key" in kinds:
        raise ValueError("Duplicate primary keys detected")
