"""Replaying versioned changes into a rollup, all pending versions in one job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import quoted
from ..functions.conform import rename_cast
from ..operators.changes import (
    ROW_STATES,
    WATERMARK_SCHEMA,
    advance_watermark,
    change_range,
    empty_watermark,
    last_processed,
    latest_version,
    row_states,
)
from ..operators.merge import update_all
from ..operators.quality import Rules, clean, judged, rejected
from ..operators.rollup import Rollup, newest_part, rollup_by_date
from ..sources.snapshots import (
    current_location,
    drop_partitions,
    publish,
    replace_partitions,
    require_location,
    table_or_empty,
)
from .circuits import CIRCUIT_ROLLUP, CIRCUIT_RULES, RAW_MAPPING
from .ingest import Staging, replace_in_table


def replay(
    feed: DataFrame,
    spec: Rollup,
    rules: Rules,
    *,
    version: str = "version",
    after: int = -1,
    until: int | None = None,
    target: DataFrame | None = None,
) -> DataFrame:
    """The rollup after all versions above ``after``, merged into ``target``.

    Each version is cleaned and rolled up from its own rows, and a later version
    replaces an entity's row as a whole, even with an older date. So the result per
    entity is the rollup of its greatest version, which needs no loop over versions.
    """
    pending = change_range(feed, after + 1, until, version=version)
    rolled = _rolled(clean(pending, rules.within(version), [version, *spec.inputs]), spec, version)
    return rolled if target is None else update_all(target, rolled, spec.keys)


def _rolled(kept: DataFrame, spec: Rollup, version: str = "version") -> DataFrame:
    """Per entity the rollup of its greatest version."""
    parts = rollup_by_date(kept, spec, [version])
    return newest_part(parts, spec, [version]).select(version, *spec.outputs)


def _judged(typed: DataFrame, rules: Rules, needed: Iterable[str]) -> DataFrame:
    """The judged rows; of clean ones only the ``needed`` columns are kept."""
    found, kept = judged(typed, rules), {c.lower() for c in needed}
    refused = F.col("reject_reason").isNotNull()
    return found.withColumns({c: F.when(refused, quoted(c)) for c in typed.columns if c.lower() not in kept})


def run(
    spark: SparkSession,
    feed_table: str,
    target_table: str,
    watermark_table: str,
    rejects_table: str,
    root: str,
    *,
    spec: Rollup = CIRCUIT_ROLLUP,
    rules: Rules = CIRCUIT_RULES,
    mapping: Mapping[str, tuple[str, str]] = RAW_MAPPING,
    change_types: Iterable[str] | None = ROW_STATES,
    now: datetime | None = None,
    parts: int | None = None,
) -> None:
    """Bring ``target_table`` up to the newest version of ``feed_table``.

    The pending versions are judged once, clean rows and rejects together. Of the target only the parts of the entities
    they hold are read and written. Rejects of these versions that an earlier run left are
    cleared first, new ones replace the partitions of the versions they belong to, and the
    watermark is moved last, so a run that breaks off is repeated without doubling anything.
    A run that another one overtakes is an error: it changes neither target nor watermark.
    """
    feed = spark.table(feed_table)
    mark = current_location(spark, watermark_table)
    after = read_watermark(spark, watermark_table, feed_table)
    until = latest_version(change_range(feed, after + 1)).first()[0]  # prunes partitions
    if until is None:
        return

    with Staging(spark) as staging:
        pending = row_states(change_range(feed, after + 1, until), change_types)
        typed = rename_cast(pending, mapping)
        if rules.within("version") == rules:  # clean rows and rejects are two sides of one choice
            found = staging.table(_judged(typed, rules, ["version", *spec.inputs]), "judged")
            refused = found.filter(F.col("reject_reason").isNotNull())
            rolled = _rolled(found.filter(F.col("reject_reason").isNull()), spec)
        else:
            typed = staging.table(typed, "pending")
            refused = rejected(typed, rules)
            rolled = replay(typed, spec, rules, after=after, until=until)
        rolled = staging.table(rolled, "rolled")
        require_location(spark, watermark_table, mark)  # else another run has taken these versions
        replace_in_table(rolled, target_table, root, keys=spec.keys, parts=parts)
        if spark.catalog.tableExists(rejects_table):
            drop_partitions(spark, rejects_table, "version", after + 1, until)
        replace_partitions(refused, rejects_table, "version", root)
        require_location(spark, watermark_table, mark)
        move_watermark(spark, watermark_table, feed_table, until, root, now=now)


def read_watermark(spark: SparkSession, watermark_table: str, table: str) -> int:
    """The last processed version of ``table``, -1 before the first run."""
    return last_processed(table_or_empty(spark, watermark_table, WATERMARK_SCHEMA), table)


def move_watermark(
    spark: SparkSession,
    watermark_table: str,
    table: str,
    version: int,
    root: str,
    *,
    now: datetime | None = None,
) -> None:
    """Set the last processed version of ``table``."""
    watermark = table_or_empty(spark, watermark_table, WATERMARK_SCHEMA)
    time = F.lit(now or datetime.now(timezone.utc))
    moved = advance_watermark(watermark, table, version, time)
    publish(moved, watermark_table, f"{root}/{watermark_table}")


def reset(spark: SparkSession, watermark_table: str, root: str) -> None:
    """Forget what was processed; the next :func:`run` replays from the first version."""
    publish(empty_watermark(spark), watermark_table, f"{root}/{watermark_table}")
