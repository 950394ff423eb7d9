"""Remove long passages that repeat, by compaction of the de Bruijn graph of word windows.

Nodes of the graph are sequences of ``window - 1`` words, and each window of ``window``
words is an edge. The edges of a text are grouped into paths: consecutive windows that
share a minimiser, the smallest hash among their inner k-mers. Equal windows have equal
minimisers at equal places, so an edge can only repeat where its minimiser does.

* A minimiser that occurs once: none of its edges repeats.
* One that always occurs in the same path does not branch: the whole path repeats, and is
  settled as one row. Nearly all repeated text is settled here.
* One that occurs in different paths branches: its paths are opened into edges, and the
  edges are counted.

Minimisers, paths and edges are counted by hash below the exchange, so a passage that a
third of all documents share reaches it as one row per task. Repeated edges return to
their source coordinates (row key, place in the text) and cover the words to remove.

Hashes: a path is known by its minimiser and a hash of its words, an edge likewise, 128
bits in all. Defined results: NULL and blank texts have no words, remove nothing and keep
the empty text. Rows equal in id and text are repeats of one another. Texts are read
whole, in any length; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import discard
from .common import WordHashes, as_bytes, mixed, row_key, signed, sliding_minimum, stage, staged, window_hashes

WINDOW = 35
K = 8  # words of a k-mer

_HASHES = WordHashes()  # per Python worker


def minimisers(hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each stretch of windows with one minimiser: first window, count, minimiser.

    ``hashes`` are those of the words. Of equal minima the first counts; a stretch is
    where the minimum's place stays the same.
    """
    kmers = window_hashes(hashes, k)
    width = window - k + 1
    low = sliding_minimum(kmers, width)
    n = len(low)
    # the place of each minimum: the first k-mer at or after the window's start that equals
    # it; found by marking, for every k-mer, the windows whose minimum it is
    places = np.arange(len(kmers))
    place = np.full(n, -1)
    for shift in range(width - 1, -1, -1):
        hit = kmers[shift : shift + n] == low
        place[hit] = places[shift : shift + n][hit]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, n])
    return first, count, low[first]


def path_hashes(hashes: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A hash of the words of each path, from prefix sums of a polynomial."""
    powers = _powers(len(hashes))
    sums = np.r_[np.uint64(0), np.cumsum(mixed(hashes) * powers[: len(hashes)], dtype=np.uint64)]
    part = sums[first + words] - sums[first]
    # brought to the same exponent, whatever the place in the text
    return mixed(part * _inverse_powers(len(hashes))[first] + words.astype(np.uint64))


_STEP = 0xD1342543DE82EF95
_BACK = pow(_STEP, -1, 1 << 64)
_TABLES: dict[int, np.ndarray] = {}


def _table(step: int, n: int) -> np.ndarray:
    table = _TABLES.get(step)
    if table is None or len(table) < n:
        size = max(n, 4096) * 2
        table = np.cumprod(np.r_[np.uint64(1), np.full(size, step, np.uint64)], dtype=np.uint64)
        if n <= 1 << 20:
            _TABLES[step] = table
    return table


def _powers(n: int) -> np.ndarray:
    return _table(_STEP, n + 1)


def _inverse_powers(n: int) -> np.ndarray:
    return _table(_BACK, n + 1)


def paths(keyed: DataFrame, window: int, k: int) -> DataFrame:
    """One row per path: row key, first window, windows, minimiser, hash of its words."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column(0), []
            for i, text in enumerate(as_bytes(batch.column(1))):
                words = text.split()
                if len(words) < window:
                    continue
                hashes = _HASHES.of(words)
                first, count, low = minimisers(hashes, window, k)
                content = path_hashes(hashes, first, count + window - 1)
                found.append((np.full(len(first), i), first, count, signed(low), signed(content)))
            if found:
                row, first, count, low, content = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(row)).cast(pa.binary()),
                        pa.array(first.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(low),
                        pa.array(content),
                    ],
                    names=["key", "first", "count", "minimiser", "content"],
                )

    schema = "key binary, first int, count int, minimiser long, content long"
    return keyed.mapInArrow(split, schema)


def repeated_paths(found: DataFrame) -> DataFrame:
    """The paths whose minimiser occurs more than once, and whether it branches."""
    seen = found.groupBy("minimiser").agg(
        F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high")
    )
    seen = seen.filter("n > 1").select("minimiser", (F.col("low") != F.col("high")).alias("branches"))
    return stage(found.join(seen.hint("merge"), "minimiser"), "repeated-paths")


def edges(keyed: DataFrame, branching: DataFrame, window: int) -> DataFrame:
    """The windows of branching paths, one stored row each: key, place, minimiser, hash."""
    stretches = branching.groupBy("key").agg(
        F.collect_set(F.struct("first", "count", "minimiser")).alias("paths")
    )
    texts = keyed.join(stretches.hint("merge"), "key")

    def open_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, found = batch.column("key"), []
            opened = batch.column("paths").to_pylist()
            for i, text in enumerate(as_bytes(batch.column("text"))):
                hashes = window_hashes(_HASHES.of(text.split()), window)
                for path in opened[i]:
                    place = np.arange(path["first"], path["first"] + path["count"])
                    same = np.full(len(place), path["minimiser"])
                    found.append((np.full(len(place), i), place, same, signed(hashes[place])))
            if found:
                row, place, low, edge = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(row)).cast(pa.binary()),
                        pa.array(place.astype(np.int32)),
                        pa.array(low),
                        pa.array(edge),
                    ],
                    names=["key", "first", "minimiser", "edge"],
                )

    schema = "key binary, first int, minimiser long, edge long"
    return stage(texts.mapInArrow(open_paths, schema), "edges")


def repeated_windows(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Stretches of windows that occur elsewhere too: row key, first window, count."""
    keyed = docs.select(row_key().alias("key"), F.col("text"))
    found, folder = staged(paths(keyed, window, k), "paths")
    repeated = repeated_paths(found)
    discard(docs.sparkSession, folder)  # a few of the paths are repeated, and stored again
    settled = repeated.filter(~F.col("branches")).select("key", "first", "count")
    opened = edges(keyed, repeated.filter("branches"), window)
    counted = opened.groupBy("minimiser", "edge").agg(F.count("*").alias("n")).filter("n > 1")
    counted = stage(counted, "repeated-edges")  # read again, its side of the join has an exchange that can be split
    again = opened.join(counted.drop("n").hint("merge"), ["minimiser", "edge"])
    return settled.unionByName(again.select("key", "first", F.lit(1).alias("count")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """Each document with its words, the words removed, and the text that is left."""
    spans = repeated_windows(docs, window, k).groupBy("key").agg(
        F.collect_set(F.struct("first", "count")).alias("spans")
    )
    keyed = docs.select(row_key().alias("key"), F.col("text"), F.col("doc_id"))
    texts = keyed.join(spans.hint("merge"), "key", "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            spans = batch.column("spans")
            for i, text in enumerate(as_bytes(batch.column("text"))):
                words = text.split()
                n_words.append(len(words))
                found = spans[i].as_py()
                if found:
                    edge = np.zeros(len(words) + 1, np.int32)
                    for span in found:
                        edge[span["first"]] += 1
                        edge[span["first"] + span["count"] + window - 1] -= 1
                    words = [w for w, covers in zip(words, np.cumsum(edge).tolist()) if not covers]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_removed long, kept_text string, kept_sha256 string"
    return texts.mapInArrow(cut, schema)
