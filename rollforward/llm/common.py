"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.snapshots import shared_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder that all executors share, and read it from there.

    What follows no longer depends on the executors that computed it, and values such
    as row numbers keep what was written.
    """
    return staged(df, name)[0]


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`stage`, and the folder, for :func:`~rollforward.sources.snapshots.discard` after its last use."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Number the rows from 0 in a global order without sorting them in one task.

    Rows are dealt by range and written; only the count of each range, one number per
    partition, passes through the driver.
    """
    n = shuffle_partitions(df.sparkSession)
    dealt = stage(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "rank")
    counts = sorted(tuple(r) for r in dealt.groupBy("_range").count().collect())
    before = accumulate((c for _, c in counts), initial=0)
    pairs = [F.lit(x) for (part, _), start in zip(counts, before) for x in (part, start)]
    offset = F.element_at(F.create_map(*pairs), F.col("_range")) if pairs else F.lit(0)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn(name, (place + offset).cast("long")).drop("_range")


def row_key(key: str = "doc_id", text: str = "text") -> Column:
    """A key for rows that differ in id or text."""
    both = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(F.col(text), F.lit("")))
    return F.unhex(F.md5(both))


# ---- inside Python tasks ------------------------------------------------------------


def as_bytes(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column in UTF-8; NULL counts as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def release_memory() -> None:
    """Give freed memory back to the system.

    A Python worker lives on, idle, beside the next stages of its executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class WordHashes(dict):
    """64-bit hash per word, remembered up to a bounded number of words."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = found
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15  # any odd number


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive items: a polynomial built by doubling, then mixed."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    done, total, power = 0, None, hashes  # power: windows of `width` items
    width = 1
    while True:
        if k & width:
            if total is None:
                total = power
            else:
                total = total[: len(power) - done] * np.uint64(pow(BASE, width, 1 << 64)) + power[done:]
            done += width
        if done == k:
            return mixed(total + np.uint64(k))
        shift = np.uint64(pow(BASE, width, 1 << 64))
        power = power[:-width] * shift + power[width:]
        width *= 2


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    done = 1
    while 2 * done <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
