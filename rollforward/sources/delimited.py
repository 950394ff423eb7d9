"""Delimited files, with the identity of the file each row came from.

Files with a header are read as lines of text in one scan, whatever their headers: each
file's header becomes a list of places, one per wanted column, that its lines are joined to,
and every line is parsed on its own and its fields picked by place. Only Spark opens files,
so any path that Spark reads will do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from ..functions.columns import quoted

INDEX_COLUMN = "_c0"
END = "\u0001"  # put after a header line to find the number of its fields

# Types that text is tried for, narrowest first; text that fits none stays text.
TRIED_TYPES = {
    "int": r"^[+-]?[0-9]{1,10}$",
    "bigint": r"^[+-]?[0-9]{1,19}$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(NaN|Infinity|Inf)$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}",
    "boolean": r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$",
}

Stage = Callable[[DataFrame, str], DataFrame]


def read_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    *,
    schema: StructType | str | None = None,
    infer_schema: bool = True,
    header: bool = True,
    delimiter: str = ",",
    drop_index_column: bool = False,
    with_file: bool = False,
    order: Iterable[str] = (),
    stage: Stage | None = None,
) -> DataFrame:
    """Scan any number of files at once.

    A ``schema`` spares the extra pass of type inference and keeps row hashes from
    depending on what else a file holds (``1`` or ``1.0``). Short rows are padded with
    NULL, surplus fields are dropped, an empty field is NULL, as is a value that does not fit
    its type. ``drop_index_column`` drops ``_c0``: the first column without a header, or one
    with an empty header. ``with_file`` adds ``file_name`` and ``file_time`` (the file's
    modification time).

    With a ``header`` columns go by name, in any case, and a column that a file does not
    have is NULL there; a line that repeats its file's header is no row. Columns come in the
    order of ``schema``, else of ``order``, else of the first header. A schema that has no
    name in common with a header names its columns by position. A field ends with its
    line, quoted or not. ``stage`` writes the headers, one row per file, to a table: then
    Spark knows their size and need not move the lines to join them.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if header:
        text, data = _by_header(spark, paths, schema, delimiter, list(order), stage)
    else:
        reader = spark.read.option("sep", delimiter)
        text = (reader.schema(as_text(schema)) if schema is not None else reader.option("inferSchema", False)).csv(paths)
        data = text.columns
        text = text.select(*[quoted(c) for c in data], *_file_columns())
    wanted = [c for c in data if not (drop_index_column and c == INDEX_COLUMN)]
    if schema is not None:
        types = {f.name: f.dataType for f in schema.fields}
    else:
        types = inferred_types(text, wanted) if infer_schema else {}
    columns = [typed(quoted(c), types.get(c, StringType())).alias(c) for c in wanted]
    return text.select(*columns, *(["file_name", "file_time"] if with_file else []))


def as_text(schema: StructType) -> StructType:
    """The same columns, all of them text."""
    text = StructType()
    for name in schema.names:
        text.add(name, StringType())
    return text


def typed(value: Column, kind: DataType | str) -> Column:
    """Text as another type, NULL where it does not fit."""
    return value if kind == StringType() else value.try_cast(kind)


def inferred_types(text: DataFrame, columns: Iterable[str]) -> dict[str, DataType]:
    """The narrowest type that holds all values of each column, from one pass over them."""
    columns = list(columns)
    if not columns:
        return {}

    def fits(column: Column, kind: str, pattern: str) -> Column:
        return F.coalesce(F.bool_and(column.rlike(pattern) & column.try_cast(kind).isNotNull()), F.lit(False))

    tests = [
        fits(quoted(c), kind, pattern).alias(f"{i}_{kind}")
        for i, c in enumerate(columns)
        for kind, pattern in TRIED_TYPES.items()
    ]
    found = text.agg(*tests).first()
    kinds = [next((k for k in TRIED_TYPES if found[f"{i}_{k}"]), "string") for i in range(len(columns))]
    fields = StructType.fromDDL(", ".join(f"c{i} {kind}" for i, kind in enumerate(kinds))).fields
    return {name: field.dataType for name, field in zip(columns, fields)}


def _file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    ]


def _fields(line: Column, n: int, delimiter: str) -> Column:
    """The first ``n`` fields of a line, as an array of text."""
    struct = F.from_csv(line, ", ".join(f"f{i} string" for i in range(n)), {"sep": delimiter})
    return F.array(*[struct[f"f{i}"] for i in range(n)])


def first_lines(lines: DataFrame) -> DataFrame:
    """``file_name, file_time, header``: each file's first line that is not blank.

    Combined on the map side: a task sends one row per file.
    """
    placed = lines.withColumn("at", F.monotonically_increasing_id())
    first = F.min_by("value", F.struct("block", "at")).alias("header")
    return placed.groupBy("file_name").agg(F.min("file_time").alias("file_time"), first)


def header_names(first: DataFrame, delimiter: str) -> Column:
    """The names in each header: an empty one becomes ``_c<place>``, repeated ones get their place."""
    widest = first.agg(F.max(F.size(F.split("header", _literal(delimiter))))).first()[0] or 0
    marked = _fields(F.concat(F.col("header"), F.lit(delimiter + END)), widest + 1, delimiter)
    cells = F.slice(marked, F.lit(1), F.greatest(F.array_position(marked, END) - 1, F.lit(0)).cast("int"))
    cells = F.transform(cells, lambda c: F.coalesce(c, F.lit("")))
    low = F.transform(cells, F.lower)

    def named(cell: Column, i: Column) -> Column:
        again = F.size(F.filter(low, lambda other: other == F.lower(cell))) > 1
        numbered = F.concat(cell, i.cast("string"))
        return F.when(cell == "", F.concat(F.lit("_c"), i.cast("string"))).when(again, numbered).otherwise(cell)

    return F.transform(cells, named)


def _literal(delimiter: str) -> str:
    return "\\Q" + delimiter + "\\E"


def _by_header(
    spark: SparkSession, paths: list[str], schema: StructType | None, delimiter: str, order: list[str], stage: Stage | None
) -> tuple[DataFrame, list[str]]:
    """The rows of files with a header as text columns, and the names of these."""
    lines = spark.read.text(paths).select(
        "value", *_file_columns(), F.col("_metadata.file_block_start").alias("block")
    )
    lines = lines.filter(F.trim("value") != "")
    first = first_lines(lines)
    if stage is not None:
        first = stage(first, "headers")
    known = first.withColumn("names", header_names(first, delimiter))
    # one row per column name, and the widest header
    seen = known.select("file_time", "file_name", F.posexplode("names").alias("at", "name"))
    each = seen.groupBy(F.lower("name").alias("low")).agg(
        F.min(F.struct("file_time", "file_name", "at", "name")).alias("first"), F.max("at").alias("at")
    )
    found = sorted(each.collect(), key=lambda r: r["first"])
    width = max((r["at"] + 1 for r in found), default=1)
    present = {r["low"]: r["first"]["name"] for r in found}
    if schema is not None:
        data = schema.names
    else:
        ordered = {name.lower(): name for name in order if name.lower() in present}
        data = list({**present, **ordered}[low] for low in [*ordered, *[p for p in present if p not in ordered]])
    low = F.transform("names", F.lower)
    places = F.array(*[F.array_position(low, name.lower()).cast("int") for name in data])
    if schema is not None:
        by_position = F.array(*[F.when(F.size("names") >= i, F.lit(i)).otherwise(F.lit(0)) for i in range(1, len(data) + 1)])
        places = F.when(F.exists(places, lambda p: p > 0), places).otherwise(by_position)
    placed = known.select(F.col("file_name").alias("_file"), "header", places.alias("_places"))
    joined = lines.join(placed, F.col("file_name") == F.col("_file")).filter(F.col("value") != F.col("header"))
    parsed = joined.select(_fields(F.col("value"), width, delimiter).alias("_fields"), "_places", "file_name", "file_time")
    picked = [
        F.when(F.col("_places")[i] > 0, F.get("_fields", F.col("_places")[i] - 1)).alias(name) for i, name in enumerate(data)
    ]
    return parsed.select(*picked, "file_name", "file_time"), list(data)


def list_files(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``file_name`` and ``file_time`` of every file, also of files without rows."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select(
        F.col("_metadata.file_path").alias("file_name"),
        F.col("modificationTime").alias("file_time"),
    )


def write_csv(df: DataFrame, path: str, *, header: bool = True, delimiter: str = ",") -> None:
    df.write.option("header", header).option("sep", delimiter).csv(path)
