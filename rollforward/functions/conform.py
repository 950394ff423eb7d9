"""Load stamps, positional renames with casts, and schema conformance."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructField, StructType

from .columns import quoted

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def stamp(time: Column) -> Column:
    """A timestamp as the text kept in ``load_datetime`` / ``updated_datetime``."""
    return F.date_format(time, STAMP_FORMAT)


def with_load_stamps(df: DataFrame, time: Column | None = None) -> DataFrame:
    """Add both stamps. Pass ``time`` to make a load repeatable."""
    text = stamp(F.current_timestamp() if time is None else time)
    return df.withColumns({"load_datetime": text, "updated_datetime": text})


def rename_cast(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rename and type columns by ``{old: (new, type)}``; others pass through.

    A value that does not parse becomes NULL, for the null check to reject.
    """
    return df.select(
        *[
            quoted(name).try_cast(mapping[name][1]).alias(mapping[name][0])
            if name in mapping
            else quoted(name)
            for name in df.columns
        ]
    )


def _sources(df: DataFrame, schema: StructType) -> list[tuple[StructField, str | None]]:
    """The fields of ``schema``, each with the column of ``df`` of its name in any case."""
    present = {name.lower(): name for name in df.columns}
    return [(field, present.get(field.name.lower())) for field in schema.fields]


def lost_value(df: DataFrame, schema: StructType) -> Column:
    """The first column of which a value does not survive :func:`conform_schema`, else NULL.

    A value is lost if it turns NULL, or if a number turns into another one.
    """
    tests = [F.lit(None).cast("string")]
    for field, source in _sources(df, schema):
        if source is None or df.schema[source].dataType == field.dataType:
            continue
        given, kept = quoted(source), quoted(source).try_cast(field.dataType)
        lost = given.isNotNull() & kept.isNull()
        if isinstance(df.schema[source].dataType, NumericType) and isinstance(field.dataType, NumericType):
            lost = lost | (kept.try_cast(df.schema[source].dataType) != given)
        tests.append(F.when(lost, F.lit(field.name)))
    return F.coalesce(*tests)


def conform_schema(df: DataFrame, schema: StructType, more: Iterable[Column] = ()) -> DataFrame:
    """Exactly the columns and types of ``schema``; missing columns become NULL.

    NOT NULL is not asserted here: rows that break it belong in the rejects, see
    :func:`required_columns` and the null check. ``more`` columns are computed on ``df``
    and put last.
    """
    more = list(more)
    columns = []
    for field, source in _sources(df, schema):
        value = F.lit(None) if source is None else quoted(source)
        columns.append(value.try_cast(field.dataType).alias(field.name))
    result = df.select(*columns, *more)
    extra = result.schema.fields[len(columns) :]
    return result.to(
        StructType([StructField(f.name, f.dataType, True) for f in [*schema.fields, *extra]])
    )


def required_columns(schema: StructType) -> list[str]:
    """The NOT NULL columns of a schema, as the list the null check takes."""
    return [field.name for field in schema.fields if not field.nullable]
