"""Row hashes and order-insensitive digests of many row hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import quoted

# They decide every stored hash, so changing one means reloading.
SEPARATOR = "||"
NULL_MARK = "N"
EMPTY_DIGEST_INPUT = ""
# The 64 hex digits of a row hash are cut into slices of 15 (60 bits), the last of which
# has 4 (16 bits), and each slice into parts of 20 bits. Sums of such parts fit a bigint
# up to 2**43 rows.
HASH_DIGITS = 64
SLICE_DIGITS = 15
SLICE_STARTS = (1, 16, 31, 46, 61)
PART_BITS = 20
PART_SHIFTS = (0, 20, 40)
LAST_SHIFTS = (0,)
# The first byte of a packed text.
HASH_MARK, TEXT_MARK = bytearray(b"\x01"), bytearray(b"\x00")


def row_hash(names: Iterable[str], values: Iterable[Column] | None = None) -> Column:
    """sha256 over the columns joined by ``||``; NULLs are skipped.

    ``(a, NULL, b)`` and ``(a, b, NULL)`` hash alike, and so does a value that
    contains the separator; :func:`row_hash_null_safe` keeps them apart. ``values`` are
    hashed instead of the columns of these names, where given.
    """
    return F.sha2(F.concat_ws(SEPARATOR, *_values(names, values)), 256)


def _values(names: Iterable[str], values: Iterable[Column] | None) -> list[Column]:
    return list(values) if values is not None else [quoted(n) for n in names]


def row_hash_null_safe(names: Iterable[str], values: Iterable[Column] | None = None) -> Column:
    """sha256 over length-prefixed columns, with a mark for NULL."""
    texts = [v.cast("string") for v in _values(names, values)]
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit(NULL_MARK)) for t in texts]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def with_row_hash(
    df: DataFrame,
    names: Iterable[str] | None = None,
    *,
    null_safe: bool = False,
    alias: str = "row_hash",
) -> DataFrame:
    """Add the hash of ``names`` (all columns, in order, by default)."""
    names = list(names) if names is not None else df.columns
    return df.withColumn(alias, (row_hash_null_safe if null_safe else row_hash)(names))


def packed(text: Column) -> Column:
    """Text as bytes that an exchange moves: row hashes take half their length, others one byte more.

    Different texts have different bytes, see :func:`unpacked`.
    """
    digest = F.unhex(text)
    is_hash = (F.length(text) == HASH_DIGITS) & (F.lower(F.hex(digest)) == text)
    return F.when(is_hash, F.concat(F.lit(HASH_MARK), digest)).otherwise(F.concat(F.lit(TEXT_MARK), text.cast("binary")))


def unpacked(packed_text: Column) -> Column:
    """The text that :func:`packed` was given."""
    rest = F.substring(packed_text, 2, 2**31 - 1)
    mark = F.substring(packed_text, 1, 1)
    return F.when(mark == F.lit(HASH_MARK), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def hash_slices(row_hash_column: str) -> list[Column]:
    """Five integers that together are the whole row hash."""
    return [
        F.conv(F.substring(row_hash_column, start, SLICE_DIGITS), 16, 10).cast("bigint")
        for start in SLICE_STARTS
    ]


def digest_terms(row_hash_column: str) -> dict[str, Column]:
    """Integer terms of one row hash, all its bits, to be summed per group."""
    mask = (1 << PART_BITS) - 1
    terms = {}
    for s, slice_ in enumerate(hash_slices(row_hash_column)):
        for p, shift in enumerate(PART_SHIFTS if s < len(SLICE_STARTS) - 1 else LAST_SHIFTS):
            terms[f"__d{s}{p}"] = F.shiftright(slice_, shift).bitwiseAND(F.lit(mask))
    return terms


def digest_of_sums(count: Column, sums: Iterable[Column]) -> Column:
    """sha256 over the row count and the summed terms; of no rows: sha256 of nothing."""
    text = F.concat_ws(SEPARATOR, count, *sums)
    return F.sha2(F.when(count > 0, text).otherwise(F.lit(EMPTY_DIGEST_INPUT)), 256)
