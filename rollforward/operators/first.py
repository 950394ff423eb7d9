"""Keeping, or marking, the first row of each key group."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.columns import as_list, quoted
from ..functions.hashing import packed, unpacked


# Spark types whose values an aggregation buffer can hold in place.
FIXED_WIDTH = {
    "boolean", "byte", "short", "integer", "long", "float", "double",
    "date", "timestamp", "timestamp_ntz",
}


def row_tie(df: DataFrame) -> Column:
    """A number that settles between rows of one key; equal rows have equal ones."""
    return F.xxhash64(*[quoted(c) for c in df.columns])


def total_order(df: DataFrame, order: Sequence[str | Column] = ()) -> list[Column]:
    """``order``, then the hash of the whole row, so that only equal rows tie."""
    return [*[quoted(o) if isinstance(o, str) else o for o in order], row_tie(df)]


def keep_first(df: DataFrame, keys: str | Iterable[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in ``order``; NULL keys form one group.

    Spark turns ``row_number() = 1`` into a group limit below the exchange, so each
    task sends at most one row per key, however many rows the key has.
    """
    window = Window.partitionBy(*[quoted(k) for k in as_list(keys)]).orderBy(*order)
    numbered = df.withColumn("__rank", F.row_number().over(window))
    return numbered.filter(F.col("__rank") == 1).drop("__rank")


def flag_first(
    df: DataFrame, keys: str | Iterable[str], order: Sequence[str | Column], flag: str
) -> DataFrame:
    """Every row, with ``flag`` true on the first row of each key group.

    The losers have to come out as well, so a group limit does not help and one
    window per key would put a hot key into one task. The contest runs in two
    rounds: rows of a key first compete inside their input partition, then only
    the winners of each partition meet, while the losers stay spread by partition.
    Rows that tie in ``order`` should be equal, else the choice is arbitrary.
    """
    keys = [quoted(k) for k in as_list(keys)]
    local = Window.partitionBy(*keys, "__part").orderBy(*order)
    final = Window.partitionBy(*keys, "__lane").orderBy(*order)
    won = F.col("__local") == 1
    return (
        df.withColumn("__part", F.spark_partition_id())
        .withColumn("__local", F.row_number().over(local))
        .withColumn("__lane", F.when(won, F.lit(-1)).otherwise(F.col("__part")))
        .withColumn("__final", F.row_number().over(final))
        .withColumn(flag, won & (F.col("__final") == 1))
        .drop("__part", "__local", "__lane", "__final")
    )


def repeated(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """The rows whose key occurs more than once.

    Keys are counted first, which combines on the map side and moves keys only. The
    rows then move once, and whatever follows handles the repeated ones alone. The join
    also compares a hash of the key, so that the counted keys need an exchange of their
    own, without which adaptive execution could not split the rows of a hot key.
    """
    keys = as_list(keys)
    hashed = F.xxhash64(*[quoted(k) for k in keys])
    counts = df.groupBy(*[quoted(k).alias(f"__k_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("__n")
    )
    again = counts.filter(F.col("__n") > 1).withColumn(
        "__right", F.xxhash64(*[quoted(f"__k_{k}") for k in keys])
    )
    same = F.col("__left") == F.col("__right")
    for key in keys:
        same = same & quoted(key).eqNullSafe(quoted(f"__k_{key}"))
    return df.withColumn("__left", hashed).join(again, same, "left_semi").drop("__left")


HOT_ROWS = 1_000_000  # rows of one bucket of keys that a single task may get
BUCKETS = 1 << 16


def by_heat(df: DataFrame, keys: str | Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """``(rest, hot)``: rows whose key falls into a bucket of at most ``HOT_ROWS`` rows, and the others.

    What counts the buckets sends at most ``BUCKETS`` numbers per task, and so many are broadcast at
    most. Rows of one key are all on the same side, and those of ``rest`` may meet in one task.
    """
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(*[quoted(k) for k in as_list(keys)]), F.lit(BUCKETS)).cast("int"))
    counted = dealt.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    hot = F.broadcast(counted.filter(F.col("__n") > HOT_ROWS).select("__bucket"))
    sides = [dealt.join(hot, "__bucket", how).drop("__bucket") for how in ("left_anti", "left_semi")]
    return sides[0], sides[1]


MARKS = 1 << 27  # bits in which keys that may repeat are noted: 16 MB to broadcast at most


def by_repeats(
    df: DataFrame, keys: str | Iterable[str], others: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(alone, again)``: rows whose key occurs once, and all rows whose key may occur again.

    Only hashes of keys move, combined on the map side. Those that occur twice, here or in the
    columns ``keys`` of ``others``, are noted in bitmaps of a bounded size. A key that shares its
    bit with one of them is in ``again``, too, so that side needs an exact test; the more keys
    repeat, the more rows it has, up to all. Rows of one key are all on the same side.
    """
    return by_marks(df, keys, repeated_marks(df, keys, others))


def _hashed(keys: Iterable[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in keys])


def repeated_marks(df: DataFrame, keys: str | Iterable[str], others: DataFrame | None = None) -> DataFrame:
    """The bitmaps of :func:`by_repeats`, for :func:`by_marks`."""
    hashed = _hashed(as_list(keys))
    marks = df.select(hashed.alias("__mark"))
    if others is not None:
        marks = marks.unionAll(others.select(hashed.alias("__mark")))
    return _noted(marks.groupBy("__mark").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1))


def key_marks(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Bitmaps of all keys, for :func:`by_marks`."""
    return _noted(df.select(_hashed(as_list(keys)).alias("__mark")))


def _noted(marks: DataFrame) -> DataFrame:
    found = F.pmod(F.col("__mark"), F.lit(MARKS)) + 1
    return marks.groupBy(F.bitmap_bucket_number(found).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(found)).alias("__bits")
    )


def by_marks(df: DataFrame, keys: str | Iterable[str], noted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(others, near)``: rows whose key is surely not noted, and rows whose key shares its bit with a noted one."""
    place = F.pmod(_hashed(as_list(keys)), F.lit(MARKS)) + 1
    position = F.bitmap_bit_position(place)
    byte = F.substring("__bits", F.shiftright(position, 3).cast("int") + 1, F.lit(1))
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), position.bitwiseAND(F.lit(7)).cast("int") + 1)
    is_noted = (F.bitmap_bucket_number(place) == F.col("__bucket")) & (
        F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0
    )
    others, near = (df.join(F.broadcast(noted), is_noted, how) for how in ("left_anti", "left_semi"))
    return others, near


def all_but_first(
    df: DataFrame, keys: str | Iterable[str], order: Sequence[str | Column]
) -> DataFrame:
    """The rows that :func:`keep_first` leaves out."""
    marked = flag_first(repeated(df, keys), keys, order, "__first")
    return marked.filter(~F.col("__first")).drop("__first")


def one_per_key(
    df: DataFrame, keys: str | Iterable[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """:func:`keep_first` for the order of :func:`total_order` alone.

    ``columns`` are those to return. If they have a fixed width, apart from the keys, a
    hash aggregate that combines on the map side does it without sorting.
    """
    keys = as_list(keys)
    names = list(columns) if columns is not None else df.columns
    rest = [c for c in names if c not in keys]
    carried = df.select(*[quoted(c) for c in rest]).schema
    if any(field.dataType.typeName() not in FIXED_WIDTH for field in carried):
        first = keep_first(df, keys, total_order(df))
    else:
        first = _min_by_tie(df, keys, rest)
    return first.select(*[quoted(c) for c in names])


def counted_per_key(df: DataFrame, keys: str | Iterable[str], count_as: str) -> DataFrame:
    """The same row per key, with all columns and the number of rows the key had."""
    keys = as_list(keys)
    rest = [c for c in df.columns if c not in keys]
    counted = _min_by_tie(df, keys, rest, F.count(F.lit(1)).alias(count_as))
    return counted.select(*[quoted(c) for c in df.columns], count_as)


def _min_by_tie(df: DataFrame, keys: list[str], rest: list[str], *more: Column) -> DataFrame:
    texts = [k for k in keys if df.select(quoted(k)).schema[0].dataType == StringType()]
    tied = df.withColumn("__tie", row_tie(df))
    grouped = tied.groupBy(*[(packed(quoted(k)) if k in texts else quoted(k)).alias(k) for k in keys])
    firsts = [F.min_by(quoted(c), F.col("__tie")).alias(c) for c in rest]
    found = grouped.agg(*(firsts + list(more) or [F.count(F.lit(1))]))
    return found.select(*[unpacked(quoted(c)).alias(c) if c in texts else quoted(c) for c in found.columns])


def dedup_by_hash(
    df: DataFrame, hash_column: str = "row_hash", order: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per hash. Rows that share a hash but differ are settled by ``order``."""
    if order:
        return keep_first(df, hash_column, total_order(df, order))
    return one_per_key(df, hash_column)
