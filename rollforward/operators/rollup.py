"""Rolling rows up to one row per entity, from the entity's latest date."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_list, quoted
from .first import keep_first

COMBINE = {"max": F.max, "min": F.min, "sum": F.sum}


@dataclass(frozen=True)
class Rollup:
    """``measures`` are ``(output, "max" | "min" | "sum", input)`` over the rows that
    carry the latest ``date`` of their ``keys``; the date comes out as ``date_as``."""

    keys: tuple[str, ...]
    date: str
    measures: tuple[tuple[str, str, str], ...]
    date_as: str

    def aggregates(self) -> list[Column]:
        return [COMBINE[how](quoted(name)).alias(out) for out, how, name in self.measures]

    def recombined(self) -> list[Column]:
        """The same measures over already aggregated rows."""
        return [COMBINE[how](quoted(out)).alias(out) for out, how, _ in self.measures]

    @property
    def inputs(self) -> list[str]:
        names = [*self.keys, self.date, *[name for _, _, name in self.measures]]
        return list(dict.fromkeys(names))

    @property
    def outputs(self) -> list[str]:
        return [*self.keys, *[out for out, _, _ in self.measures], self.date_as]


def latest_with_ties(df: DataFrame, keys: str | Iterable[str], date: str) -> DataFrame:
    """All rows that carry the latest date of their key; rows without a date go.

    The latest dates are aggregated first and joined back on key *and* date, so rows
    of a hot key are spread by date, and a hot (key, date) is left to the skew split
    of adaptive execution. A window would put the whole key into one task.
    """
    keys = as_list(keys)
    dated = df.filter(quoted(date).isNotNull())
    newest = dated.groupBy(*[quoted(k).alias(f"__k_{k}") for k in keys]).agg(
        F.max(quoted(date)).alias("__newest")
    )
    same = quoted(date) == F.col("__newest")
    for key in keys:
        same = same & quoted(key).eqNullSafe(quoted(f"__k_{key}"))
    return dated.join(newest, same).select(*[quoted(c) for c in df.columns])


def rollup_by_date(df: DataFrame, spec: Rollup, extra: Iterable[str] = ()) -> DataFrame:
    """Measures per key and date (and ``extra`` columns), combined on the map side."""
    keys = [*extra, *spec.keys]
    dated = df.filter(quoted(spec.date).isNotNull())
    return dated.groupBy(
        *[quoted(k) for k in keys], quoted(spec.date).alias(spec.date_as)
    ).agg(*spec.aggregates())


def single_parts(df: DataFrame, spec: Rollup, extra: Iterable[str] = ()) -> DataFrame:
    """:func:`rollup_by_date` of each row by itself, to be recombined: no row moves."""
    keys = [*extra, *spec.keys]
    types = {f.name: f.dataType for f in rollup_by_date(df, spec, extra).schema.fields}
    return df.filter(quoted(spec.date).isNotNull()).select(
        *[quoted(k).alias(k) for k in keys],
        quoted(spec.date).alias(spec.date_as),
        *[quoted(name).cast(types[out]).alias(out) for out, _, name in spec.measures],
    )


def recombine(parts: DataFrame, spec: Rollup, extra: Iterable[str] = ()) -> DataFrame:
    """Merge several :func:`rollup_by_date` results into one."""
    keys = [*extra, *spec.keys, spec.date_as]
    return parts.groupBy(*[quoted(k) for k in keys]).agg(*spec.recombined())


def newest_part(parts: DataFrame, spec: Rollup, extra: Iterable[str] = ()) -> DataFrame:
    """Per key the part with the greatest ``extra`` columns, then the latest date."""
    order = [quoted(c).desc() for c in [*extra, spec.date_as]]
    return keep_first(parts, spec.keys, order)


def latest_rollup(df: DataFrame, spec: Rollup) -> DataFrame:
    """One row per key over its latest rows.

    Aggregating per key and date before choosing the date means raw rows are never
    sorted or shuffled: a hot key reaches the second step as one row per date.
    """
    return newest_part(rollup_by_date(df, spec), spec).select(*spec.outputs)
