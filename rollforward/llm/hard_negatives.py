"""Hard negatives by angular triangle filtering.

Every row stores the angles between its vector and a few reference directions. Two vectors
whose angles to a direction are a and b are between ``|a - b|`` and ``min(a + b, 2 pi - a -
b)`` apart. Over all directions this gives an interval of their cosine; multiplied by the
norms, and widened by more than rounding can amount to, it bounds their inner product.
Rows of a block are sorted by nearest direction and angle and cut into tiles, so a tile has
narrow ranges of angles. An anchor is scored, by integer inner products, only against
tiles whose score window overlaps one that it still looks for.

Vectors become integers ``floor(256 * x)``, and all scores are exact inner products of these.
Positives are the best rows of the anchor's label; negatives are the best rows of other
labels whose score lies within a positive's window.

Anchors and rows meet in blocks of bounded size: each side is dealt to chunks, and a task
holds one chunk of each. Rows are sent once for every ``ANCHORS`` anchors.

Defined results: rows with a NULL label, vector or component, or a component that is not
finite, take no part, so an empty table or one without anchors gives no rows. A row with a
NULL id is no anchor; among equal scores it comes last. Repeated ids are rows of their
own, also as partners of each other. A shorter vector counts as padded with zeros; a vector
of zeros scores 0 with all. Equal scores are settled by the smaller id, then by a hash of the
vector. Other columns are not looked at. A score beyond 64 bits counts as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory, stage

SCALE = 256
REFERENCES = 16  # directions
REFERENCE_SAMPLE = 2000  # rows, those with the smallest hashes, that directions are taken from
ANCHORS, ROWS = 8192, 16384  # in a block, on average
TILE = 256
SLACK = 1e-5  # radians; more than angles lose as 32-bit numbers and near 0
NO_ID = np.iinfo(np.int64).max

INDEX = "row long, vec_id long, label long, norm double, vector binary, angles binary"
FOUND = "anchor long, slot int, row long, vec_id long, score long"


# ---- inside Python tasks ------------------------------------------------------------


def integers(vectors: pa.ListArray) -> np.ndarray:
    """A matrix of ``floor(256 * x)``, shorter vectors padded with zeros."""
    lengths = vectors.value_lengths().to_numpy()
    out = np.zeros((len(vectors), lengths.max(initial=0)))
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = vectors.flatten().to_numpy()
    return np.floor(out * SCALE)


def angles_to(vectors: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles between rows and unit directions; a vector of zeros is at a right angle."""
    width = min(vectors.shape[1], directions.shape[1])
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    beyond = vectors[:, :width] @ directions[:, :width].T
    return np.arccos(np.clip(beyond / np.where(norms == 0, 1, norms), -1, 1))


def pick_directions(vectors: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors far from each other: each is the row farthest from those before."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = (vectors / np.where(norms == 0, 1, norms))[norms[:, 0] > 0]
    if not len(unit):
        return np.zeros((0, vectors.shape[1]))
    picked, nearest = [0], unit @ unit[0]
    while len(picked) < min(n, len(unit)):
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[picked[-1]])
    return unit[picked]


class Block:
    """The rows of a group as arrays."""

    def __init__(self, rows: pa.Table):
        self.row = rows["row"].to_numpy()
        self.vec_id = rows["vec_id"].fill_null(NO_ID).to_numpy()
        self.label = rows["label"].to_numpy()
        self.norm = rows["norm"].to_numpy()
        self.vector = _matrix(rows["vector"], np.float64)
        self.angles = _matrix(rows["angles"], np.float32)

    def __len__(self) -> int:
        return len(self.row)

    def order(self, by: np.ndarray) -> None:
        for name in ("row", "vec_id", "label", "norm", "vector", "angles"):
            setattr(self, name, getattr(self, name)[by])


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    parts = [np.frombuffer(v.as_py(), kind) for v in column]
    width = max(map(len, parts), default=0)
    out = np.zeros((len(parts), width), kind)
    for i, part in enumerate(parts):
        out[i, : len(part)] = part
    return out


class Tiles:
    """Rows in order of nearest direction and angle, cut into tiles with ranges of angles."""

    def __init__(self, rows: Block):
        if rows.angles.shape[1]:
            near = rows.angles.argmin(axis=1)
            rows.order(np.lexsort((rows.row, rows.angles[np.arange(len(rows)), near], near)))
        self.rows = rows
        self.starts = np.arange(0, len(rows), TILE)
        self.low, self.high = (f.reduceat(rows.angles, self.starts, axis=0) for f in (np.minimum, np.maximum))
        self.norm = np.maximum.reduceat(rows.norm, self.starts), np.minimum.reduceat(rows.norm, self.starts)

    def bounds(self, anchors: Block) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest score of each anchor with the rows of each tile."""
        near = np.zeros((len(anchors), len(self.starts)))
        far = np.full_like(near, np.pi)
        for i in range(anchors.angles.shape[1]):
            own = anchors.angles[:, i, None].astype(np.float64)
            low, high = self.low[None, :, i], self.high[None, :, i]
            np.maximum(near, np.maximum(low - own, own - high), out=near)
            past = np.where(own + low >= np.pi, 2 * np.pi - own - low, np.pi)
            np.minimum(far, np.where(own + high <= np.pi, own + high, past), out=far)
        least, greatest = self.cosines(near, far)
        big, small = (anchors.norm[:, None] * n[None, :] for n in self.norm)
        upper = np.where(greatest >= 0, greatest * big, greatest * small)
        lower = np.where(least >= 0, least * small, least * big)
        room = 1 + 1e-9 * big
        limits = np.iinfo(np.int64)  # scores are cut there, too
        return tuple(np.clip(b, limits.min, limits.max) for b in (np.floor(lower - room), np.ceil(upper + room)))

    @staticmethod
    def cosines(near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cos(np.minimum(far + SLACK, np.pi)), np.cos(np.maximum(near - SLACK, 0))

    def tile(self, t: int) -> slice:
        return slice(self.starts[t], self.starts[t] + TILE)


class Scores:
    """Exact inner products of integer vectors, by the fastest type that holds them."""

    def __init__(self, anchors: Block, rows: Block):
        width = min(anchors.vector.shape[1], rows.vector.shape[1])
        self.a, self.b = anchors.vector[:, :width], rows.vector[:, :width]
        largest = width * (np.abs(self.a).max(initial=0) * np.abs(self.b).max(initial=0))
        if largest < 1 << 24:
            self.a, self.b = self.a.astype(np.float32), self.b.astype(np.float32)
        elif largest >= 1 << 53:
            self.a, self.b = (_whole(x) for x in (self.a, self.b))

    def of(self, some: np.ndarray, tile: slice) -> np.ndarray:
        product = self.a[some] @ self.b[tile].T
        if product.dtype == object:
            limits = np.iinfo(np.int64)
            product = np.clip(product, limits.min, limits.max)
        return product.astype(np.int64)


def _whole(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out[...] = [[int(v) for v in line] for line in x]
    return out


LOWEST = np.iinfo(np.int64).min


def kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th greatest of each line, the lowest number where a line is shorter."""
    if scores.shape[1] < k:
        return np.full(len(scores), LOWEST)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


class Best:
    """The ``k`` best rows per (anchor, slot): higher score, then smaller id, then row."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots = k, slots
        self.found = tuple(np.zeros(0, np.int64) for _ in range(4))  # place, score, id, row
        self.least = np.full((anchors, slots), LOWEST)

    def add(self, places: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        place, score, vec_id, row = (np.concatenate(p) for p in zip(self.found, (places, scores, ids, rows)))
        by = np.lexsort((row, vec_id, -score, place))
        place = place[by]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, int)
        rank = np.arange(len(place)) - np.repeat(first, np.diff(np.r_[first, len(place)]))
        kept = rank < self.k
        self.found = tuple(x[kept] for x in (place, score[by], vec_id[by], row[by]))
        last = rank == self.k - 1
        self.least.reshape(-1)[place[last]] = score[by][last]

    def rows(self, anchors: np.ndarray) -> pa.Table:
        place, score, vec_id, row = self.found
        columns = [
            pa.array(anchors[place // self.slots]),
            pa.array((place % self.slots).astype(np.int32)),
            pa.array(row),
            pa.array(vec_id, mask=vec_id == NO_ID),
            pa.array(score),
        ]
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])


def best_of_label(anchors: Block, rows: Block, k: int) -> pa.Table:
    """Per anchor its ``k`` best other rows; all rows have the anchors' label."""
    tiles, best = Tiles(rows), Best(len(anchors), 1, k)
    scores, (_, upper) = Scores(anchors, rows), tiles.bounds(anchors)
    for t in np.argsort(-upper.max(axis=0), kind="stable"):
        some = np.flatnonzero(upper[:, t] >= best.least[:, 0])
        if not len(some):
            continue
        tile = tiles.tile(t)
        found = scores.of(some, tile)
        own = anchors.row[some, None] == rows.row[None, tile]
        found[own] = LOWEST
        least = np.maximum(best.least[some, 0], kth_best(found, k))
        i, j = np.nonzero((found >= least[:, None]) & ~own)
        best.add(some[i], found[i, j], rows.vec_id[tile][j], rows.row[tile][j])
    return best.rows(anchors.row)


def best_in_windows(anchors: Block, rows: Block, low: np.ndarray, high: np.ndarray, k: int) -> pa.Table:
    """Per anchor and window its ``k`` best rows of other labels with a score from ``low`` to ``high``."""
    slots = low.shape[1]
    tiles, best = Tiles(rows), Best(len(anchors), slots, k)
    scores, (lower, upper) = Scores(anchors, rows), tiles.bounds(anchors)
    for t in np.argsort(-upper.max(axis=0), kind="stable"):
        wanted = np.maximum(low, best.least)  # an equal score may still win by its id
        open_ = (upper[:, t, None] >= wanted) & (lower[:, t, None] <= high)
        some = np.flatnonzero(open_.any(axis=1))
        if not len(some):
            continue
        tile = tiles.tile(t)
        found = scores.of(some, tile)
        other = anchors.label[some, None] != rows.label[None, tile]
        parts = []
        for slot in range(slots):
            inside = other & (found >= wanted[some, slot, None]) & (found <= high[some, slot, None])
            lines = np.flatnonzero(inside.any(axis=1))
            if not len(lines):
                continue
            kth = kth_best(np.where(inside[lines], found[lines], LOWEST), k)
            i, j = np.nonzero(inside[lines] & (found[lines] >= kth[:, None]))
            i = lines[i]
            parts.append((some[i] * slots + slot, found[i, j], rows.vec_id[tile][j], rows.row[tile][j]))
        if parts:
            best.add(*(np.concatenate(p) for p in zip(*parts)))
    return best.rows(anchors.row)


# ---- on Spark -----------------------------------------------------------------------


def taking_part(vectors: DataFrame) -> DataFrame:
    """Rows with a label and a vector of finite numbers, and their columns alone."""
    whole = F.col("embedding").isNotNull() & F.col("label").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(whole & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding"
    )


def build_index(vectors: DataFrame) -> DataFrame:
    """Integer vectors, norms and angles to directions, written once; ``row`` tells rows apart."""
    rows = taking_part(vectors)
    few = rows.orderBy(F.xxhash64("embedding"), "embedding").limit(REFERENCE_SAMPLE).select("embedding")
    sample = pa.array([r[0] for r in few.collect()], pa.list_(pa.float64()))
    directions = pick_directions(integers(sample), REFERENCES)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch.column(3))
            angles = angles_to(whole, directions).astype(np.float32)
            columns = [
                *batch.columns[:3],
                pa.array(np.linalg.norm(whole, axis=1)),
                pa.array([v.tobytes() for v in whole], pa.binary()),
                pa.array([a.tobytes() for a in angles], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in INDEX.split(", ")])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding")
    return stage(numbered.mapInArrow(prepare, INDEX), "vectors")


def chunks(n: Column, size: int) -> Column:
    return F.greatest(F.ceil(n / F.lit(size)), F.lit(1)).cast("int")


def dealt(n: Column) -> Column:
    return F.pmod(F.xxhash64("row"), n).cast("int")


def every(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def positives_of(index: DataFrame, is_anchor: Column, k: int) -> DataFrame:
    """Per anchor its ``k`` best other rows of its label: ``anchor, row, vec_id, score, slot``."""
    counted = index.groupBy("label").agg(
        chunks(F.count_if(is_anchor), ANCHORS).alias("a_chunks"),
        chunks(F.count(F.lit(1)), ROWS).alias("r_chunks"),
        F.count_if(is_anchor).alias("n"),
    )
    sized = index.join(counted.filter("n > 0").drop("n"), "label")
    names = [F.col(c).alias(c) for c in index.columns]  # new columns for each side of the meeting
    anchors = sized.filter(is_anchor).select(*names, dealt(F.col("a_chunks")).alias("a"), every(F.col("r_chunks")).alias("r"))
    rows = sized.select(*names, dealt(F.col("r_chunks")).alias("r"), every(F.col("a_chunks")).alias("a"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _nothing()
        found = best_of_label(Block(left), Block(right), k)
        release_memory()
        return found

    keys = ["label", "a", "r"]
    found = anchors.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(meet, FOUND)
    return best_rows(found, ["anchor"], k).withColumn("slot", F.col("rank") - 1).drop("rank")


def _nothing() -> pa.Table:
    return Best(0, 1, 1).rows(np.zeros(0, np.int64))


def best_rows(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of what the blocks found, numbered by ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of its label, the ``negatives``
    best rows of other labels that score at most as high as that positive, and at least
    ``percent`` of it.

    ``is_anchor`` is a condition on ``vec_id`` and ``label``.
    """
    index = build_index(vectors)
    is_anchor = F.coalesce(is_anchor, F.lit(False))
    partners = stage(positives_of(index, is_anchor, positives), "positives")
    wanted = partners.filter("score >= 0").groupBy("anchor").agg(  # a window below 0 is empty
        F.sort_array(F.collect_list(F.struct("slot", "score"))).alias("windows")
    )
    n_rows, n_anchors = index.count(), wanted.count()
    r_chunks, a_chunks = (F.lit(max(1, -(-n // size))) for n, size in ((n_rows, ROWS), (n_anchors, ANCHORS)))
    anchors = index.join(wanted, index["row"] == wanted["anchor"]).drop("anchor").select(
        "*", dealt(a_chunks).alias("a"), every(r_chunks).alias("r")
    )
    rows = index.select(*[F.col(c).alias(c) for c in index.columns], dealt(r_chunks).alias("r"), every(a_chunks).alias("a"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return _nothing()
        low = np.full((len(left), positives), np.iinfo(np.int64).max)
        high = np.full((len(left), positives), LOWEST)
        for i, windows in enumerate(left["windows"].to_pylist()):
            for w in windows:
                low[i, w["slot"]], high[i, w["slot"]] = -(-percent * w["score"] // 100), w["score"]
        found = best_in_windows(Block(left), Block(right), low, high, negatives)
        release_memory()
        return found

    found = anchors.groupBy("a", "r").cogroup(rows.groupBy("a", "r")).applyInArrow(meet, FOUND)
    ranked = best_rows(found, ["anchor", "slot"], negatives)
    named = index.filter(is_anchor).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    known = partners.select(
        "anchor", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return ranked.join(known, ["anchor", "slot"]).join(named, "anchor").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
