"""Near-duplicate detection with b-bit MinHash.

A document's set is its distinct word shingles. Per set, 128 minima of independent hashes
give 32 band keys of four minima each, and a packed signature of the low two bits of every
minimum. Two sets of similarity 0.8 miss each other in all bands with probability 5e-8.

1. Documents with equal sets form a class, combined below the exchange; from here on a
   class is one row, so groups of copies of any size cost nothing.
2. Classes that share a band key are candidates. Each is first compared with one hub per
   bucket: the class whose buckets are fullest, which is the least edited one of a group of
   near copies. The share of equal bits, corrected for chance (two unequal minima agree in
   two bits once in four), estimates the similarity and drops clearly different pairs; the
   rest is confirmed on the full sets. Linked classes form components.
3. Classes of one bucket that are still in different components can only be linked if they
   have enough in common outside the hub: a set shares with any other set of the bucket at
   most what it shares with the hub, plus those of its other shingles that the other set
   has too, which a few marked bits per set bound. Pairs within that bound, the length
   bound and the estimate, all inside the join, are confirmed on the full sets, and
   components are formed again.

So every pair of a bucket is confirmed, refused, or already connected, and the independent
edits of a large group do not meet in pairs. The estimate drops a pair of similarity 0.8
with probability below 1e-9 (at least 80 of 128 two-bit minima must agree; 109 are
expected).

Defined results: NULL and blank texts have empty sets and link with nothing. Texts shorter
than a shingle are one shingle. NULL ids count as largest; rows equal in id and text share
all results, and ``keep`` says which single row of a component to keep. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, as_bytes, mixed, release_memory, row_key, signed, stage, window_hashes

BANDS, ROWS, BITS = 32, 4, 2
LEAST_EQUAL = 80
MARKS = 4  # 64-bit numbers that mark a set's shingles outside the hub
LARGE = 32  # sets around a hub from which on the bound of step 3 is worth its cost
SLICE = 8192  # shingles hashed at once; bounds the memory for long texts

_HASHES = WordHashes()  # per Python worker
_RANDOM = np.random.default_rng(20260101)
FACTORS = _RANDOM.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles, A-Z lower-cased."""
    words = text.lower().split()  # of bytes: both look at ASCII only
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(_HASHES.of(words), min(k, len(words))))


def minima(items: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, np.uint32(0xFFFFFFFF))
    for start in range(0, len(items), SLICE):
        part = (items[start : start + SLICE] >> np.uint64(32)).astype(np.uint32)
        low = np.minimum(low, (FACTORS[:, None] * part + SHIFTS[:, None]).min(axis=1))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        key = mixed(key + rows[:, row])
    return key


def packed(low: np.ndarray) -> np.ndarray:
    """The low two bits of each minimum: four 64-bit numbers."""
    lanes = (low & np.uint32(3)).astype(np.uint64).reshape(-1, 32)
    places = np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(lanes << places, axis=1)


def sketches(keyed: DataFrame, k: int) -> DataFrame:
    """One stored row per document: row key, id, set size, set hash, signature, band keys."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, signs, bands = [], [], [], []
            for text in as_bytes(batch.column(2)):
                items = shingles(text, k)
                sizes.append(len(items))
                if len(items) == 0:
                    nodes.append(None)
                    signs.append(None)
                    bands.append(None)
                    continue
                halves = np.array([items.sum(), mixed(items ^ np.uint64(len(items))).sum()])
                nodes.append(mixed(halves).tobytes())
                low = minima(items)
                signs.append(signed(packed(low)))
                bands.append(signed(band_keys(low)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.binary()),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(signs, pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["key", "doc_id", "n", "node", "sign", "bands"],
            )
        _HASHES.clear()
        release_memory()

    schema = "key binary, doc_id long, n long, node binary, sign array<long>, bands array<long>"
    return stage(keyed.select("key", "doc_id", "text").mapInArrow(sketch, schema), "sketches")


def equal_minima(a: Column, b: Column) -> Column:
    """Of all minima those whose kept bits agree, by bit counts."""
    unequal = F.lit(0)
    for i in range(BANDS * ROWS * BITS // 64):
        differ = a[i].bitwiseXOR(b[i])
        lanes = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))
        unequal = unequal + F.bit_count(lanes)
    return F.lit(BANDS * ROWS) - unequal


def estimate(a: Column, b: Column) -> Column:
    """Similarity from the share of equal bits, less what chance gives."""
    chance = 2.0**-BITS
    return (equal_minima(a, b) / (BANDS * ROWS) - chance) / (1 - chance)


def components(edges: DataFrame) -> DataFrame:
    """Per node of an edge list (a, b) the smallest node it is connected with.

    Large-star and small-star steps in turn; each step is written, and only a count and a
    checksum of the edges pass through the driver. A plan reads what was written before it
    twice: if a turn were one plan, that would double with every step in it, and the driver
    keeps, rewrites and logs all of it whenever a stage ends.
    """
    edges = edges.filter("a != b")
    before = None
    while True:
        both = star(edges, F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stage(large.distinct(), "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low.hint("merge"), "a")
        small = star(small, *[F.struct(F.col(c).alias("a"), F.col("low").alias("b")) for c in "ba"])
        edges = stage(small.filter("a != b").distinct(), "edges")
        after = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def star(rows: DataFrame, *edges: Column) -> DataFrame:
    """Several edges (a, b) of each row, in one pass over the rows."""
    return rows.select(F.explode(F.array(*edges)).alias("edge")).select("edge.a", "edge.b")


def compared(pairs: DataFrame, classes: DataFrame, keyed: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) of classes with their full sets ``x`` and ``y`` and what is common."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = ends.join(classes.select("node", "key"), "node")
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"))  # rows of one key are equal

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(shingles(t, k)) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.binary()), pa.array(found, pa.list_(pa.int64()))], names=["node", "items"]
            )
        _HASHES.clear()
        release_memory()

    needed = texts.join(wanted.hint("merge"), "key").select("node", "text")
    sets = stage(needed.mapInArrow(sets_of, "node binary, items array<long>"), "sets")
    sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")).hint("merge"), "a")
    sides = sides.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")).hint("merge"), "b")
    return sides.withColumn("common", F.size(F.array_intersect("x", "y")))


def least_common(n_a: Column, n_b: Column, percent: int) -> Column:
    """The smallest intersection that links sets of these sizes."""
    return F.ceil(percent * (n_a + n_b) / F.lit(100 + percent))


def around_hubs(stars: DataFrame) -> DataFrame:
    """Per class what its set shares with a hub, and marks of what others around it have too.

    ``stars``: a, hub, common, rest (the shingles that the hub does not have). Of the hubs
    that a class was compared with, the one with the most others around it counts.
    """
    sizes = stars.groupBy("hub").agg(F.count("*").alias("size")).filter(F.col("size") >= LARGE)
    around = stage(
        stars.join(sizes.hint("merge"), "hub").groupBy("a").agg(
            F.max(F.struct("size", "hub", "common", "rest")).alias("best")
        ).select("a", "best.hub", "best.common", "best.rest"),
        "around",
    )
    others = around.select("a", "hub", F.explode("rest").alias("item"))
    shared = others.groupBy("hub", "item").count().filter("count > 1").select("hub", "item")
    mark = F.expr("shiftleft(1L, cast(item & 63 as int))")
    place = F.shiftrightunsigned("item", 62)
    marks = [F.coalesce(F.bit_or(F.when(place == i, mark)), F.lit(0)) for i in range(MARKS)]
    counts = others.join(shared.hint("merge"), ["hub", "item"]).groupBy("a").agg(
        F.array(*marks).alias("marks"), F.count("*").alias("shared")
    )
    counts = counts.withColumn("spare", F.col("shared") - sum(F.bit_count(F.col("marks")[i]) for i in range(MARKS)))
    return around.select("a", "hub", "common").join(counts, "a", "left").select(
        F.col("a").alias("node"),
        "hub",
        "common",
        F.coalesce("marks", F.array(*[F.lit(0).cast("long")] * MARKS)).alias("marks"),
        F.coalesce("spare", F.lit(0)).alias("spare"),
    )


def most_common() -> Column:
    """The most that two sets around one hub can have in common.

    In the hub: no more than either shares with it. Outside: one item for each mark that
    both have, and for each item of one of them that fell on a mark of another item.
    """
    both = sum(F.bit_count(F.col("marks_a")[i].bitwiseAND(F.col("marks_b")[i])) for i in range(MARKS))
    return F.least("common_a", "common_b") + both + F.least("spare_a", "spare_b")


def near_duplicates(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """Each document with its set size, component, and whether it is the row to keep.

    ``component_id`` is the smallest id reachable over links; links join sets whose
    intersection is at least ``percent`` % of their union, that is, at least
    ``percent / (100 + percent)`` of the sum of their sizes.
    """
    keyed = docs.select(row_key().alias("key"), F.col("doc_id").cast("long"), F.col("text"))
    rows = sketches(keyed, k)
    classes = rows.filter("n > 0").groupBy("node").agg(
        F.first("n").alias("n"),
        F.first("sign").alias("sign"),
        F.first("bands").alias("bands"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"),
    )
    classes = classes.select("node", "n", "sign", "bands", "first", F.col("first.key").alias("key"))
    classes = stage(classes, "classes")

    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    members = stage(banded.join(shared.hint("merge"), "band"), "members")
    fullness = members.groupBy("node").agg(F.sum("size").alias("fullness"))
    hubs = members.join(fullness.hint("merge"), "node").groupBy("band").agg(
        F.max(F.struct("fullness", "node")).alias("hub")
    )
    members = stage(
        members.join(hubs.hint("merge"), "band").select("band", "node", F.col("hub.node").alias("hub")), "starred"
    )

    signs = classes.select("node", "n", "sign")
    left, right = (signs.select(*[F.col(c).alias(f"{c}_{s}") for c in signs.columns]) for s in "ab")
    similar = (
        (100 * F.col("n_a") >= percent * F.col("n_b"))
        & (100 * F.col("n_b") >= percent * F.col("n_a"))
        & (equal_minima(F.col("sign_a"), F.col("sign_b")) >= LEAST_EQUAL)
    )
    stars = members.filter("node != hub").select(F.col("node").alias("node_a"), F.col("hub").alias("node_b")).distinct()
    stars = stars.join(left, "node_a").join(right, "node_b").filter(similar)
    tested = stage(stars.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")), "tested")
    stars = compared(tested, classes, keyed, k)
    linked = F.col("common") >= least_common(F.size("x"), F.size("y"), percent)
    stars = stage(
        stars.select("a", F.col("b").alias("hub"), "common", F.array_except("x", "y").alias("rest"), linked.alias("linked")),
        "stars",
    )
    links = stars.filter("linked").select("a", F.col("hub").alias("b"))
    roots = components(links)
    bounds = around_hubs(stars.drop("linked"))

    # buckets whose members are still in different components
    placed = members.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    open_bands = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_bands = open_bands.filter("low != high").select("band")
    still = placed.join(open_bands, "band", "left_semi").join(signs, "node").join(bounds, "node", "left")
    still = stage(still, "open-buckets")
    a, b = (
        still.select("band", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "root", "n", "sign", *bounds.columns[1:])]) for s in "ab"
    )
    need = least_common(F.col("n_a"), F.col("n_b"), percent)
    # the bound holds among sets that were compared with the same hub
    bounded = F.coalesce(F.col("hub_a") == F.col("hub_b"), F.lit(False))
    within = ~bounded | (most_common() >= need)
    apart = (F.col("node_a") > F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    across = a.join(b.hint("merge"), (a["band"] == b["band"]) & apart & within & similar)
    across = across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    both_ways = tested.select("a", "b").unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = stage(across.join(both_ways, ["a", "b"], "left_anti"), "across")
    more = compared(across, classes, keyed, k)
    linked = F.col("common") >= least_common(F.size("x"), F.size("y"), percent)
    more = stage(more.filter(linked).select("a", "b"), "more-links")
    # the new links join whole components
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    named = classes.select("node", "first").join(roots, "node", "left")
    named = named.select("node", F.coalesce("root", "node").alias("root"), F.col("first").alias("own"))
    first = named.groupBy("root").agg(F.min("own").alias("first"))
    named = stage(
        named.join(first, "root").select(
            "node", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("first_key")
        ),
        "components",
    )
    found = rows.select("key", "doc_id", "n", "node").join(named.hint("merge"), "node", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        ((F.col("n") == 0) | (F.col("key") == F.col("first_key"))).alias("keep"),
        "key",
    )


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one per component, with all their columns.

    Rows are dealt by their key once; of rows equal in id and text one stays.
    """
    kept = near_duplicates(docs, k, percent).filter("keep").select("key")
    once = docs.groupBy(row_key().alias("key")).agg(F.first(F.struct(*docs.columns)).alias("_doc"))
    stays = once.join(kept.hint("merge"), "key", "left_semi")
    return stays.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
