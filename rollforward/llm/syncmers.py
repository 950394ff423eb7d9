"""Document fingerprints from closed syncmers, and their likeness by position.

A k-mer of characters is a closed syncmer if the smallest hash of its inner s-mers stands
at its first or last place. Whether it is one depends on the k-mer alone, so an edit
elsewhere in the text neither adds nor removes anchors. A fingerprint keeps the
``ANCHORS`` anchors with the smallest hashes, each with its first place in the text.

Likeness is the share of anchors that two fingerprints have in common, among the smallest
of both, counting only those whose shift between the texts lies near the usual shift.

Defined results: NULL text counts as empty. An empty text has the empty fingerprint, which
is like another empty one and like nothing else. A text without a syncmer (short, or by
chance) has one anchor, its own hash. Places above 2**32 - 1 count as that. Equal texts
have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, sliding_minimum, stage, window_hashes

K, S = 12, 8
ANCHORS = 40
NEAR = 64  # characters that a shift may differ from the usual one

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def anchors(text: str) -> np.ndarray:
    """Sorted numbers: a 32-bit hash above the anchor's place."""
    if not text:
        return np.zeros(0, np.uint64)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(codes) >= K:
        inner = window_hashes(codes, S)
        width = K - S + 1
        low = sliding_minimum(inner, width)
        n = len(low)
        places = np.flatnonzero((inner[:n] == low) | (inner[width - 1 : width - 1 + n] == low))
        hashes = window_hashes(codes, K)[places] >> np.uint64(32)
        if len(places) > 4 * ANCHORS:  # the smallest distinct ones, without sorting all
            cut = np.partition(hashes, 4 * ANCHORS)[4 * ANCHORS]
            few = hashes <= cut
            if len(np.unique(hashes[few])) >= ANCHORS:
                hashes, places = hashes[few], places[few]
        hashes, first = np.unique(hashes, return_index=True)
        if len(hashes):
            at = np.minimum(places[first[:ANCHORS]], 0xFFFFFFFF).astype(np.uint64)
            return (hashes[:ANCHORS] << np.uint64(32)) | at
    return np.array([xxhash.xxh3_64_intdigest(text.encode()) & ~0xFFFFFFFF], np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    high = np.uint64(32)
    union = np.union1d(a >> high, b >> high)[:ANCHORS]
    shared, at_a, at_b = np.intersect1d(a >> high, b >> high, assume_unique=True, return_indices=True)
    seen = shared <= union[-1]
    if not seen.any():
        return 0.0
    low = np.uint64(0xFFFFFFFF)
    shift = (b[at_b[seen]] & low).astype(np.int64) - (a[at_a[seen]] & low).astype(np.int64)
    return float((np.abs(shift - np.median(shift)) <= NEAR).sum() / len(union))


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the start of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _result(doc_id: int | None, text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    changed = edited(text, following)
    other = anchors(changed)
    return (
        doc_id,
        len(text),
        hashlib.sha256(changed.encode()).hexdigest(),
        own.astype(">u8").tobytes(),
        other.astype(">u8").tobytes(),
        likeness(own, other),
        likeness(own, theirs),
    )


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(), "int": pa.int32()}


def _columns(schema: str) -> tuple[list[pa.DataType], list[str]]:
    pairs = [c.split() for c in schema.split(", ")]
    return [_TYPES[t] for _, t in pairs], [n for n, _ in pairs]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint each text, its edited form, and compare it with both that and the next text.

    The next document is that with the next smaller id (ties by a hash of the text, NULL
    ids last), the first again after the last. Texts move once, dealt by range; each task
    walks its range in order. The last document of a range meets the first of the next
    range in a second step, which holds two texts per partition.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = texts.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    schema = f"{RESULT}, part int, edge string, text string"
    types, names = _columns(schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        edge = lambda kind, doc_id, text, own: (
            doc_id, None, None, own.astype(">u8").tobytes(), None, None, None, part, kind, text
        )
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = anchors(text)
                if last:
                    rows.append((*_result(*last, text, own), part, None, None))
                else:
                    rows.append(edge("first", doc_id, text, own))
                last = doc_id, text, own
            yield _batch(rows, types, names)
        if last:
            yield _batch([edge("last", *last)], types, names)

    walked = stage(ranged.mapInArrow(walk, schema), "fingerprints")
    columns = [c.split()[0] for c in RESULT.split(", ")]
    inside = walked.filter(F.col("edge").isNull()).select(*columns)

    parts = sorted(r[0] for r in walked.filter("edge = 'first'").select("part").collect())
    following = [F.lit(x) for pair in zip(parts, parts[1:] + parts[:1]) for x in pair]
    lasts = walked.filter("edge = 'last'").select("doc_id", "text", "fingerprint", "part")
    firsts = walked.filter("edge = 'first'").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    after = F.element_at(F.create_map(*following), F.col("part")) if parts else F.lit(0)
    pairs = lasts.withColumn("next_part", after).join(firsts, "next_part").select(
        "doc_id", "text", "fingerprint", "next_text", "next_fingerprint"
    )
    own_types, own_names = _columns(RESULT)

    def join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda b: np.frombuffer(b, ">u8").astype(np.uint64)
        for batch in batches:
            rows = [
                _result(doc_id, text, numbers(own), following, numbers(theirs))
                for doc_id, text, own, following, theirs in zip(*(c.to_pylist() for c in batch.columns))
            ]
            yield _batch(rows, own_types, own_names)

    return inside.unionByName(pairs.mapInArrow(join_edges, RESULT))
