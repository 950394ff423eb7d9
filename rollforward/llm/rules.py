"""Document quality by a sparse ensemble of rules.

Each text is described by statistics over all of it. Shallow trees are grown on a sample of
labelled texts; every path from a root to a node is a rule, a conjunction of comparisons of
statistics with thresholds. A logistic regression with an L1 penalty (lasso) gives the rules
weights, most of them zero. The others become one Spark column expression, so scoring is
plain arithmetic on the statistics.

Learning uses at most ``LABELLED`` labelled rows, those with the smallest hashes of id and
text; everything else reads all rows.

Defined results: NULL text counts as empty; an empty text has all statistics 0 and a score
like any other. Labels other than 0 and 1, NULL ids and labels without a document are not
learned from; a document with several labels is learned from once for each different one.
With labels of one kind only, all scores are that label; without any, 0.5. An empty table
gives no rows. Repeated rows are scored alike. Other columns of documents keep their names
and values, also those that clash with names used here, but for ``score``, which is replaced.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import release_memory, stage

LABELLED = 20_000  # rows to learn from, at most
TREES, DEPTH = 40, 3
PENALTY = 0.002
ITERATIONS, TOLERANCE = 5000, 1e-5
SEED = 17

STATISTICS = (
    "characters", "words", "word_length", "distinct_words", "commonest_word", "echoed_words", "single_letters",
    "letters", "capitals", "digits", "spaces", "stops", "shouts", "symbols", "marked_words", "lines",
    "line_words", "repeated_lines", "sentence_words",
)
PREFIX = "_stat_"


# ---- statistics ---------------------------------------------------------------------

_byte = np.arange(256)
_of = lambda chars: np.isin(_byte, np.frombuffer(chars, np.uint8))
CAPITAL = (_byte >= ord("A")) & (_byte <= ord("Z"))
LETTER = CAPITAL | ((_byte >= ord("a")) & (_byte <= ord("z"))) | (_byte >= 0xC0)  # a character's first byte counts
DIGIT = (_byte >= ord("0")) & (_byte <= ord("9"))
SPACE = _of(b" \t\n\r\x0b\x0c")
STOP, SHOUT, QUIET = _of(b"."), _of(b"!?"), _of(b".,;:'\"-()!?")
FOLLOWING = (_byte >= 0x80) & (_byte < 0xC0)
SYMBOL = ~(LETTER | DIGIT | SPACE | QUIET | FOLLOWING)
KINDS = np.stack([~FOLLOWING, LETTER, CAPITAL, DIGIT, SPACE, STOP, SHOUT, SYMBOL]).astype(np.int64)
ENDING = b".,;:!?'\"()"
MARK = bytes(_byte[SYMBOL | SHOUT].astype(np.uint8))


def describe(text: bytes) -> tuple[float, ...]:
    """The statistics of one text, in the order of ``STATISTICS``."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    chars, letters, capitals, digits, spaces, stops, shouts, symbols = map(
        int, KINDS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    )
    n = len(words)
    counts = Counter(words)
    unmarked = text.translate(None, MARK).split()
    lines = [line for line in text.split(b"\n") if line]
    return (
        math.log1p(chars),
        math.log1p(n),
        (chars - spaces) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        sum(c for w, c in counts.items() if len(w.strip(ENDING)) == 1) / n,
        letters / chars,
        capitals / max(letters, 1),
        digits / chars,
        spaces / chars,
        stops / n,
        shouts / n,
        symbols / chars,
        1 - sum((Counter(unmarked) & counts).values()) / n,
        math.log1p(len(lines)),
        math.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        math.log1p(n / (stops + shouts + 1)),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows without their text, as a struct ``row``, and their statistics."""
    names = [PREFIX + s for s in STATISTICS]
    rest = [c for c in docs.columns if c != "text"]
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = StructType([packed.schema["row"], *[StructField(c, DoubleType()) for c in names]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [describe(text.as_py()) for text in batch.column(1).cast(pa.binary())]
            values = np.array(found).reshape(len(found), len(names)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values)], names=["row", *names])
        release_memory()

    return packed.mapInArrow(read, schema)


# ---- rules --------------------------------------------------------------------------


@dataclass(frozen=True, order=True)
class Condition:
    """``statistic > threshold``, or not above it."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(PREFIX + self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def simplified(conditions: list[Condition]) -> Rule:
    """Of comparisons in one direction the strictest is enough."""
    strictest: dict[tuple[str, bool], float] = {}
    for c in conditions:
        known = strictest.get((c.statistic, c.above), c.threshold)
        strictest[c.statistic, c.above] = max(known, c.threshold) if c.above else min(known, c.threshold)
    return tuple(sorted(Condition(*key, threshold) for key, threshold in strictest.items()))


def holds(rule: Rule) -> Column:
    return reduce(operator.and_, [c.column() for c in rule])


def paths(node, before: list[Condition] | None = None) -> Iterator[Rule]:
    """A rule for each node below ``node``, a node of a fitted tree."""
    before = before or []
    if before:
        yield simplified(before)
    if node.subtreeDepth() > 0:
        split = node.split()
        statistic = STATISTICS[split.featureIndex()]
        for above, child in ((False, node.leftChild()), (True, node.rightChild())):
            yield from paths(child, [*before, Condition(statistic, above, split.threshold())])


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules; the score is the logistic function of their sum and an intercept."""

    intercept: float
    weights: dict[Rule, float]

    def column(self) -> Column:
        terms = [F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.weights.items()]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(operator.add, terms, F.lit(self.intercept))))


def grow_rules(rows: DataFrame) -> list[Rule]:
    """The paths of trees grown on bootstrap samples of ``rows``, each once."""
    forest = RandomForestClassifier(
        labelCol="quality", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5
    )
    found: dict[Rule, None] = {}
    for tree in forest.fit(rows).trees:
        found.update(dict.fromkeys(paths(tree._java_obj.rootNode())))
    return list(found)


def fit(labelled: DataFrame) -> Ensemble:
    """Rules and weights from rows of statistics and ``quality``, 0 or 1; bounded by the caller."""
    kinds = {r["quality"]: r["count"] for r in labelled.groupBy("quality").count().collect()}  # two rows
    if len(kinds) < 2:
        sure = math.inf if 1.0 in kinds else -math.inf
        return Ensemble(sure if kinds else 0.0, {})
    statistics = VectorAssembler(inputCols=[PREFIX + s for s in STATISTICS], outputCol="features")
    rules = grow_rules(statistics.transform(labelled).select("quality", "features"))
    if not rules:  # all texts look alike
        share = kinds[1.0] / sum(kinds.values())
        return Ensemble(math.log(share / (1 - share)), {})
    matched = labelled.select("quality", *[holds(r).alias(f"rule{i}") for i, r in enumerate(rules)])
    table = matched.toArrow()  # one bit per rule and row, LABELLED rows at most
    matches = np.stack([table.column(i + 1).to_numpy() for i in range(len(rules))], axis=1).astype(np.float64)
    _, first = np.unique(matches, axis=1, return_index=True)  # of rules that match alike one is enough
    first.sort()
    intercept, weights = lasso(matches[:, first], table.column(0).to_numpy(), PENALTY)
    return Ensemble(intercept, {rules[i]: float(w) for i, w in zip(first, weights) if w != 0})


def lasso(x: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Intercept and weights of a logistic regression with an L1 penalty on the weights.

    Accelerated proximal gradient steps, until none moves a weight by more than ``TOLERANCE``.
    """
    n = len(y)
    x = np.hstack([np.ones((n, 1)), x])
    step = 4 / np.linalg.eigvalsh(x.T @ x / n)[-1]
    threshold = step * penalty * np.r_[0.0, np.ones(x.shape[1] - 1)]
    w = ahead = np.zeros(x.shape[1])
    momentum = 1.0
    for _ in range(ITERATIONS):
        slope = x.T @ (1 / (1 + np.exp(-np.clip(x @ ahead, -500, 500))) - y) / n
        moved = ahead - step * slope
        moved = np.sign(moved) * np.maximum(np.abs(moved) - threshold, 0)
        following = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead = moved + (momentum - 1) / following * (moved - w)
        change, w, momentum = np.abs(moved - w).max(), moved, following
        if change < TOLERANCE:
            break
    return float(w[0]), w[1:]


# ---- documents ----------------------------------------------------------------------


def learning_rows(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """Statistics and labels of at most ``LABELLED`` rows, written once.

    Ids are matched first; texts are read of the matched rows only and do not move.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("quality"))
    known = known.filter(F.col("quality").isin(0.0, 1.0) & F.col("id").isNotNull())
    allowed = docs.filter(F.coalesce(training, F.lit(False))).select("doc_id", "text")
    ids = allowed.select(F.col("doc_id").alias("id")).distinct()
    few = known.distinct().join(ids, "id").orderBy(F.xxhash64("id"), "id", "quality").limit(LABELLED)
    few = stage(few, "labels")  # so that its size is known
    rows = allowed.join(few, F.col("doc_id") == F.col("id"))
    rows = rows.withColumn("order", F.xxhash64("doc_id", "text")).select("quality", "order", "text")
    described = stage(with_statistics(rows).select("row.*", *[PREFIX + s for s in STATISTICS]), "labelled")
    # ids may be repeated among documents
    return described.orderBy("order", "quality").limit(LABELLED).drop("order")


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> Ensemble:
    """An ensemble from the labelled documents for which ``training`` holds."""
    rows = stage(learning_rows(docs, labels, training), "learning")
    return fit(rows)


def score(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """Every row of ``docs`` without its text, with ``score``, the chance of label 1.

    ``labels`` has ``doc_id`` and ``quality``; ``training`` is a condition on ``docs``.
    """
    ensemble = learn(docs, labels, training)
    kept = docs.drop("score")
    return with_statistics(kept).select("row.*", ensemble.column().alias("score"))
