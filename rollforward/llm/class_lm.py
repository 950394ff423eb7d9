"""A class-based bigram language model after Brown et al., and document scores under it.

Every word belongs to a class; a text's probability is the product of class transitions
and of word emissions, ``P(class | class before) * P(word | class)``.

* Word counts come from all training texts, combined in each task before the shuffle.
* Exchange clustering moves every word of the training texts between classes as long as the
  likelihood rises. The ``ITEM_WORDS`` most frequent ones move one after the other on the driver,
  by counts of the classes left and right of them over the whole training corpus; these
  tables, bounded by items times classes, are all that the driver sees. All other words move in
  tasks in every other round, each by the list of its neighbours, with the class bigrams of the
  round's start.
* The classes of the ``COMMON`` most frequent words are sent to all tasks. A rarer word sends
  its class to its neighbours, which sum up what they get, in one exchange a move; the lists
  are stored by word and stay where they are. Rare words enter in the first round.
* Emission ``(c + 1) / (N_class + V_class + 1)`` leaves one count to words not seen. Such a word
  takes the class that most training words with its ending have.
  Transitions are smoothed towards the class frequencies with ``PRIOR`` counts.
* The counts of the ``COMMON`` most frequent words are sent to all tasks; counts and classes of all
  other words meet their tokens in a join. No word is left out.

Defined results: NULL texts count as empty and have one token, the end. NULL ids count as
the empty text in the training split. Without training texts, N and V are 0. Rows equal in
id and text are scored each for itself. An empty table gives no rows. Rare words of one 63-bit
hash would move together; their counts stay apart.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.snapshots import discard, shared_dir
from .common import as_bytes, release_memory, shuffle_partitions, stage, staged

CLASSES = 24  # besides that of the end mark, which is 0
N = CLASSES + 1
UNKNOWN = N  # stands where a rare word's class would
ITEM_WORDS = 8192
ENDING = 4  # bytes
ROUNDS = 5
COMMON = 200_000
PRIOR = 20.0
FLUSH = 300_000  # distinct words that a task counts before it passes them on
CHUNK = 1 << 21  # tokens that a task sorts, and messages that it sums, at once
COUNTED = 1 << 18  # tokens that it counts at once
STEPS_PER_DOUBLING = 64
BEFORE, AFTER = 0, 1  # where a message's sender stands


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: both look at ASCII only


def word_counts(training: DataFrame) -> DataFrame:
    """One stored row per distinct word of ``text``: word, count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                counts.update(tokens(text))
                if len(counts) > FLUSH:
                    yield rows()
                    counts.clear()
        yield rows()

    found = training.select("text").mapInArrow(count, "word binary, n long")
    return stage(found.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")


def most_frequent(counts: DataFrame, item: str, most: int) -> DataFrame:
    """At most ``most`` items: all those above a count, found in a histogram of log counts."""
    step = F.floor(F.log2("n") * STEPS_PER_DOUBLING).cast("long")
    sizes = counts.groupBy(step.alias("step")).count().collect()  # 64 rows per doubling at most
    least, total = None, 0
    for level, size in sorted(map(tuple, sizes), reverse=True):
        total += size
        if total > most:
            break
        least = level
    return counts.filter(F.lit(False) if least is None else step >= least).select(item, "n")


def rare_key(word: bytes) -> int:
    """A negative number for a rare word, as :func:`rare_key_of` gives it."""
    return (xxhash.xxh64_intdigest(word, 42) | 1 << 63) - (1 << 64)


def rare_key_of(word: str) -> Column:
    return F.xxhash64(word).bitwiseOR(F.lit(-(1 << 63)))


def numbered(words: list[bytes]) -> dict[bytes, int]:
    """Common words count from 1; 0 is the end. All others are ``len(words) + 1``."""
    return {w: i for i, w in enumerate(words, 1)}


def encoded(training: DataFrame, words: list[bytes]) -> tuple[DataFrame, str]:
    """The training texts as stored numbers of words, an end after each text, and the keys of rare words; their path."""
    sent = training.sparkSession.sparkContext.broadcast(words)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rare = numbered(sent.value), len(sent.value) + 1
        for batch in batches:
            rows, keys = [], []
            for text in as_bytes(batch.column(0)):
                found = tokens(text)
                ids = np.fromiter(map(number.get, found, repeat(rare)), np.int32, len(found))
                rows.append(np.append(ids, np.int32(0)).tobytes())
                keys.append(np.array([rare_key(found[i]) for i in np.flatnonzero(ids == rare)], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(keys, pa.binary())], names=["ids", "keys"])

    return staged(training.select("text").mapInArrow(encode, "ids binary, keys binary"), "encoded")


def sequences(batch: pa.RecordBatch, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts in a row, the end mark before the first, and the keys of the rare words in them."""
    ids, keys, size = [np.zeros(1, np.int32).tobytes()], [], 0
    for text, rare in zip(batch.column(0), batch.column(1)):
        ids.append(text.as_py())
        keys.append(rare.as_py())
        size += len(ids[-1]) // 4
        if size >= most:
            yield np.frombuffer(b"".join(ids), np.int32), np.frombuffer(b"".join(keys), np.int64)
            ids, keys, size = ids[:1], [], 0
    yield np.frombuffer(b"".join(ids), np.int32), np.frombuffer(b"".join(keys), np.int64)


# ---- lists of neighbours, stored by word ----------------------------------------------


class Bucketed:
    """Rows stored by their ``key``: joins on it read them without an exchange."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, shared_dir(df.sparkSession, name)
        self.name = f"rollforward_{name}_{uuid.uuid4().hex}"
        write = df.write.bucketBy(shuffle_partitions(self.spark), "key").sortBy("key")
        write.format("parquet").option("path", self.path).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        discard(self.spark, self.path)


def neighbour_lists(ids: DataFrame, n_items: int, rare: int) -> Bucketed:
    """Per word from number ``n_items`` on the numbers of the words before and after it.

    Rare words, whose number is ``rare``, have keys instead, and the keys of rare neighbours.
    """

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, keys in sequences(batch, CHUNK):
                key = text.astype(np.int64)
                key[text == rare] = keys
                at = np.flatnonzero(text >= n_items)
                if not len(at):
                    continue
                at = at[np.argsort(key[at], kind="stable")]
                starts = np.flatnonzero(np.r_[True, key[at[1:]] != key[at[:-1]]])
                cuts = np.r_[starts, len(at)]
                columns = [pa.array(key[at[starts]])]
                for near in (at - 1, at + 1):
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(text[near])))
                for near in (at - 1, at + 1):
                    both = (text[at] == rare) & (text[near] == rare)
                    ends = np.r_[0, np.cumsum(both)][cuts]
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[near[both]])))
                yield pa.RecordBatch.from_arrays(columns, names=["key", *LISTS])
        release_memory()

    shape = "key long, before array<int>, after array<int>, rare_before array<long>, rare_after array<long>"
    found = ids.mapInArrow(lists, shape).groupBy("key")
    return Bucketed(found.agg(*[F.flatten(F.collect_list(c)).alias(c) for c in LISTS]), "lists")


LISTS = ["before", "after", "rare_before", "rare_after"]


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of the lists and the row of each."""
    lengths = np.diff(np.asarray(column.offsets))
    return np.repeat(np.arange(len(column)), lengths), np.asarray(column.flatten())


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def best_classes(key: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """The class where each word's own counts add most to the likelihood, the other words as they are.

    A word's counts are part of its ``own`` class's, if that is not -1. Where classes are equally
    good, as empty ones are, the key decides.
    """
    n, rows = len(bigrams), np.arange(len(own))
    gain, stay = np.zeros((len(own), n)), np.zeros(len(own))
    at_home = np.maximum(own, 0)
    for counts, table in ((after, bigrams), (before, bigrams.T)):
        row, near = np.nonzero(counts)  # few, for most words
        if len(row):
            found = counts[row, near].astype(float)
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            beside = table.T[near]
            gain[row[starts]] += np.add.reduceat(xlogx(beside + found[:, None]) - xlogx(beside), starts)
            beside = table[at_home[row], near]
            stay += np.bincount(row, xlogx(beside) - xlogx(np.maximum(beside - found, 0)), len(own))
        total, sums = counts.sum(axis=1), table.sum(axis=1)
        gain -= xlogx(sums + total[:, None]) - xlogx(sums)
        stay -= xlogx(sums[at_home]) - xlogx(np.maximum(sums[at_home] - total, 0))
    placed = own >= 0
    gain[rows[placed], own[placed]] = stay[placed]
    gain += 1e-9 * ((np.arange(n) + key[:, None]) % n)
    gain[:, 0] = -np.inf  # the end mark's own class
    return gain.argmax(axis=1)


def move_listed(lists: Bucketed, inbox: Bucketed | None, classes: np.ndarray, bigrams: np.ndarray) -> Bucketed:
    """Move the words that have lists; what every word is told of its class and of its rare neighbours'.

    A row of ``codes`` and ``counts`` per word: ``-1 - class`` once if it has a list, else where a
    sender stands times ``N`` plus the sender's class. Rare words are the senders.
    """
    spark, common = lists.spark, len(classes) - 1  # the last number stands for all rare words
    sent = spark.sparkContext.broadcast((classes, bigrams))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bigrams = sent.value
        waiting: list[np.ndarray] = []

        def told(key: np.ndarray, code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(code, pa.int32()), pa.array(n, pa.int64())], names=["key", "code", "n"])

        def summed() -> pa.RecordBatch:
            both, n = np.unique(np.concatenate(waiting or [np.zeros(0, np.int64)]), return_counts=True)
            waiting.clear()
            return told(both >> 6, both & 63, n)

        for batch in batches:
            key = np.asarray(batch.column(0))
            lists = {c: flat(batch.column(i)) for i, c in enumerate(LISTS, 1)}
            row, codes = flat(batch.column(5))
            counts = flat(batch.column(6))[1]
            own = np.full(len(key), -1)
            own[key >= 0] = classes[key[key >= 0]]
            own[row[codes < 0]] = -1 - codes[codes < 0]
            around = []
            for side, name in ((BEFORE, "before"), (AFTER, "after")):
                owner, ids = lists[name]
                seen = np.bincount(owner * (N + 1) + classes[ids], minlength=len(key) * (N + 1)).astype(float)
                heard = (codes >= 0) & (codes // N == side)
                seen += np.bincount(row[heard] * (N + 1) + codes[heard] % N, counts[heard], len(seen))
                around.append(seen.reshape(len(key), N + 1)[:, :N])
            own = best_classes(key, own, *around, bigrams)
            yield told(key, -1 - own, np.ones(len(key), np.int64))
            for side, name in ((AFTER, "before"), (BEFORE, "after")):  # the sender is after the word before it
                owner, ids = lists[name]
                picked = (key[owner] < 0) & (ids < common)
                waiting.append(ids[picked].astype(np.int64) << 6 | side * N + own[owner[picked]])
                owner, keys = lists[f"rare_{name}"]
                yield told(keys, side * N + own[owner], np.ones(len(keys), np.int64))
            if sum(map(len, waiting)) > CHUNK:
                yield summed()
        yield summed()
        release_memory()

    rows = lists.rows()
    if inbox is None:
        nothing = F.array()
        rows = rows.withColumns({"codes": nothing.cast("array<int>"), "counts": nothing.cast("array<long>")})
    else:
        rows = rows.join(inbox.rows().hint("merge"), "key")
    found = rows.select("key", *LISTS, "codes", "counts").mapInArrow(move, "key long, code int, n long")
    return Bucketed(found.groupBy("key").agg(F.collect_list("code").alias("codes"), F.collect_list("n").alias("counts")), "inbox")


def told_class() -> Column:
    """The class in an inbox's row."""
    return (-1 - F.array_min("codes")).alias("class")


# ---- counts over the corpus -------------------------------------------------------------


def neighbour_counts(
    ids: DataFrame, inbox: Bucketed | None, classes: np.ndarray, n_items: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per item, how often each class stands before it and after it; how often each class follows each."""
    sent = ids.sparkSession.sparkContext.broadcast(classes)
    width = N + 1

    def rows(both: np.ndarray, bigrams: np.ndarray) -> pa.RecordBatch:
        table = both.reshape(2, n_items, width)
        seen = np.flatnonzero(table.any(axis=(0, 2)))
        pairs = bigrams.reshape(width, width)
        counts = np.r_[np.concatenate(table[:, seen], axis=1), np.c_[pairs, np.zeros_like(pairs)]].astype(np.int64)
        items = np.r_[seen, -1 - np.arange(width)]
        return pa.RecordBatch.from_arrays(
            [pa.array(items, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(len(items) + 1) * 2 * width, pa.int32()), pa.array(counts.ravel()))],
            names=["item", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        both, bigrams = np.zeros((2, n_items * width), np.int64), np.zeros(width * width, np.int64)
        for batch in batches:
            for text, _ in sequences(batch, COUNTED):
                place = classes[text]
                item = np.minimum(text, n_items) * width  # all others count as one, which is left out
                bigrams += np.bincount(place[:-1] * width + place[1:], minlength=len(bigrams))
                for side, found in ((BEFORE, item[1:] + place[:-1]), (AFTER, item[:-1] + place[1:])):
                    both[side] += np.bincount(found, minlength=both.shape[1] + width)[: both.shape[1]]
        yield rows(both, bigrams)
        release_memory()

    def heard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        both, bigrams = np.zeros((2, n_items * width)), np.zeros(width * width)
        for batch in batches:
            key = np.asarray(batch.column(0))
            row, codes = flat(batch.column(1))
            n = flat(batch.column(2))[1]
            own = np.zeros(len(key), np.int64)
            own[key >= 0] = classes[key[key >= 0]]
            own[row[codes < 0]] = -1 - codes[codes < 0]
            for side in (BEFORE, AFTER):
                told = (codes >= 0) & (codes // N == side)
                # of two rare words each hears of the other: that counts once
                pair = told & ((side == BEFORE) | (key[row] >= 0))
                a, b = codes[pair] % N, own[row[pair]]
                a, b = (a, b) if side == BEFORE else (b, a)
                bigrams += np.bincount(a * width + b, n[pair], len(bigrams))
                item = told & (key[row] >= 0) & (key[row] < n_items)
                both[side] += np.bincount(key[row[item]] * width + codes[item] % N, n[item], both.shape[1])
        yield rows(both, bigrams)

    found = ids.mapInArrow(count, "item long, counts array<long>")
    if inbox is not None:
        found = found.unionAll(inbox.rows().mapInArrow(heard, "item long, counts array<long>"))
    summed = found.groupBy("item").agg(*[F.sum(F.col("counts")[i]) for i in range(2 * width)])
    before, after, bigrams = np.zeros((n_items, width)), np.zeros((n_items, width)), np.zeros((width, width))
    for row in summed.collect():  # one row per item and class, of which there is a fixed number
        if row[0] < 0:
            bigrams[-1 - row[0]] = row[1 : width + 1]
        else:
            before[row[0]], after[row[0]] = row[1 : width + 1], row[width + 1 :]
    return before[:, :N], after[:, :N], bigrams[:N, :N]


def exchange(
    classes: np.ndarray, bigrams: np.ndarray, before: np.ndarray, after: np.ndarray, movable: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Move each item to the class where the likelihood of the class bigrams is highest.

    Items move one after the other, frequent ones first; the class bigram counts follow each
    move. Counts of the items' neighbours are those of the round's start.
    """
    classes, bigrams = classes.copy(), bigrams.copy()
    order = movable[np.argsort(-after[movable].sum(axis=1), kind="stable")]
    for item in order:
        own, left, right = classes[item], before[item], after[item]
        count = right.sum()
        if not count:
            continue
        bigrams[own] = np.maximum(bigrams[own] - right, 0)
        bigrams[:, own] = np.maximum(bigrams[:, own] - left, 0)
        sums_out, sums_in = bigrams.sum(axis=1), bigrams.sum(axis=0)
        gain = (xlogx(bigrams + right) - xlogx(bigrams)).sum(axis=1)
        gain += (xlogx(bigrams.T + left) - xlogx(bigrams.T)).sum(axis=1)
        gain -= xlogx(sums_out + count) - xlogx(sums_out) + xlogx(sums_in + count) - xlogx(sums_in)
        gain[0] = -np.inf  # the end mark's own class
        best = int(gain.argmax())
        classes[item] = best
        bigrams[best] += right
        bigrams[:, best] += left
    return classes, bigrams


def cluster(ids: DataFrame, n_words: int, n_common: int) -> tuple[np.ndarray, Bucketed | None, np.ndarray]:
    """A class per common word, what rare words are told of theirs, and the class bigram counts."""
    rare, n_items = n_common + 1, min(ITEM_WORDS, n_common) + 1
    lists = neighbour_lists(ids, n_items, rare) if n_words >= n_items else None
    # at first the most frequent words stand for themselves, the rest is one class
    classes = np.full(rare + 1, CLASSES)
    classes[0], classes[rare] = 0, UNKNOWN
    alone = min(n_common, CLASSES - 1)
    classes[1 : alone + 1] = np.arange(1, alone + 1)
    items, inbox = np.arange(1, n_items), None
    for turn in range(ROUNDS):
        before, after, bigrams = neighbour_counts(ids, inbox, classes, n_items)
        # halves in turn, so that neighbours do not all move on the same counts
        movable = items if turn == 0 else items[items % 2 == turn % 2]
        classes, bigrams = exchange(classes, bigrams, before, after, movable)
        if lists is None or turn % 2:  # each word moves three times, as items do
            continue
        heard, inbox = inbox, move_listed(lists, inbox, classes, bigrams)
        if heard is not None:
            heard.drop()
        listed = inbox.rows().filter((F.col("key") >= n_items) & (F.col("key") < rare)).select("key", told_class()).toArrow()
        classes[listed.column("key").to_numpy()] = listed.column("class").to_numpy()
    if lists is not None:
        lists.drop()
    return classes, inbox, neighbour_counts(ids, inbox, classes, n_items)[2]


def class_of_words(vocabulary: DataFrame, words: list[bytes], classes: np.ndarray, inbox: Bucketed | None) -> DataFrame:
    """Every word of the training texts, stored: word, n, class."""
    sent = vocabulary.sparkSession.sparkContext.broadcast((words, classes))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, classes = numbered(sent.value[0]), sent.value[1]
        rare = len(classes) - 1
        for batch in batches:
            found = batch.column(0).to_pylist()
            ids = np.fromiter(map(number.get, found, repeat(rare)), np.int64, len(found))
            own = pa.array(classes[ids], pa.int32(), mask=ids == rare)
            yield pa.RecordBatch.from_arrays([*batch.columns, own], names=["word", "n", "class"])

    found = vocabulary.select("word", "n").mapInArrow(label, "word binary, n long, class int")
    if inbox is not None:
        common = found.filter(F.col("class").isNotNull())
        told = inbox.rows().filter(F.col("key") < 0).select("key", told_class())
        rare = found.filter(F.col("class").isNull()).select("word", "n", rare_key_of("word").alias("key"))
        found = common.unionByName(rare.join(told.hint("merge"), "key").drop("key"))
    return stage(found, "words")


def ending() -> Column:
    return F.expr(f"substring(word, -{ENDING}, {ENDING})").alias("ending")


def unseen_words(words: DataFrame, found: DataFrame, otherwise: int) -> DataFrame:
    """The words of ``found`` that are not in the training texts, with the class of their ending."""
    sizes = words.groupBy(ending(), "class").count()
    most = sizes.groupBy("ending").agg(F.max_by("class", F.struct("count", -F.col("class"))).alias("class"))
    unseen = found.distinct().join(words.select("word").hint("merge"), "word", "left_anti")
    unseen = unseen.select("word", ending()).join(most, "ending", "left")
    return unseen.select("word", F.lit(0).cast("long").alias("n"), F.coalesce("class", F.lit(otherwise)).alias("class"))


def transition_logs(bigrams: np.ndarray, types: np.ndarray) -> np.ndarray:
    """log10 of P(class | class before) over the emission's denominator, per class pair."""
    words = bigrams.sum(axis=0)
    spare = np.r_[0.0, np.ones(len(types) - 1)]  # the end mark's class has no unseen words
    mass = words + types + spare
    share = mass / mass.sum()
    given = (bigrams + PRIOR * share) / (bigrams.sum(axis=1, keepdims=True) + PRIOR)
    return np.log10(given) - np.log10(mass)


def score(docs: DataFrame, held_out: object) -> DataFrame:
    """Train on the rows that ``held_out`` (a boolean column) is not true for; score all rows."""
    spark = docs.sparkSession
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    training = flagged.filter(~F.col("held_out"))
    vocabulary = word_counts(training)
    common = sorted(((bytes(w), n) for w, n in most_frequent(vocabulary, "word", COMMON).collect()), key=lambda r: (-r[1], r[0]))
    common_words = [w for w, _ in common]
    ids, ids_path = encoded(training, common_words)
    n_texts = ids.count()
    n_types, n_words = vocabulary.agg(F.count("*"), F.sum("n")).first()
    classes, inbox, bigrams = cluster(ids, n_types, len(common))
    n_tokens, n_types = (n_words or 0) + n_texts, n_types + (n_texts > 0)
    words = class_of_words(vocabulary, common_words, classes, inbox)
    discard(spark, ids_path)
    if inbox is not None:
        inbox.drop()

    types = np.zeros(N)
    for place, n in words.groupBy("class").count().collect():  # a row per class
        types[place] = n
    types[0] = 1
    logs = np.zeros((N + 1, N + 1))  # steps to and from rare words count later
    logs[:N, :N] = transition_logs(bigrams, types)
    counted = np.log10(np.array([1, *[n + 1 for _, n in common], 1], float))
    sent = spark.sparkContext.broadcast((common_words, classes, logs, counted))
    end = float(np.log10(n_texts + 1))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_words, classes, logs, counted = sent.value
        number, rare = numbered(common_words), len(common_words) + 1
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n, known, counts, steps = [], [], [], []
            cuts, at, lost, left, right = [0], [], [], [], []
            for text in as_bytes(batch.column(1)):
                found = tokens(text)
                ids = np.fromiter(map(number.get, found, repeat(rare)), np.int64, len(found))
                path = np.zeros(len(found) + 2, np.int64)
                path[1:-1] = classes[ids]
                steps.append(logs[path[:-1], path[1:]].sum())
                places = np.flatnonzero(ids == rare)
                n.append(len(found) + 1)
                known.append(len(found) - len(places) + (n_texts > 0))
                counts.append(counted[ids].sum() + end)
                lost += [found[i] for i in places]
                at.append(places)
                left.append(path[places])
                right.append(path[places + 2])
                cuts.append(cuts[-1] + len(places))
            one = lambda parts: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int32())
            tokens_apart = pa.StructArray.from_arrays(
                [one(at), pa.array(lost, pa.binary()), one(left), one(right)], names=["place", "word", "left", "right"]
            )
            rows = pa.array(range(row, row + len(n)), pa.int64())
            row += len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    rows,
                    batch.column(0),
                    batch.column(2),
                    pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(counts, pa.float64()),
                    pa.array(steps, pa.float64()),
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), tokens_apart),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "known", "counts", "steps", "rare"],
            )

    walked = stage(
        flagged.mapInArrow(
            walk,
            "row long, doc_id long, held_out boolean, n_tokens long, known long, counts double, "
            "steps double, rare array<struct<place:int,word:binary,left:int,right:int>>",
        ),
        "walked",
    )
    # only texts that were not learned from can have words that are not known
    others = walked.filter(F.coalesce("held_out", F.lit(True))).select(F.explode("rare.word").alias("word"))
    words = words.unionByName(unseen_words(words, others, int(types[1:].argmax()) + 1))
    table = F.array(*[F.lit(float(x)) for x in logs.ravel()])
    step = lambda a, b: F.element_at(table, a * (N + 1) + b + 1)
    place = F.struct("place", "class")
    rare = walked.select("row", F.inline("rare")).join(words.hint("merge"), "word")
    rare = rare.groupBy("row").agg(
        F.count_if(F.col("n") > 0).alias("rare_known"),
        F.sum(F.log10(F.col("n") + 1)).alias("rare_counts"),
        F.sum(step(F.col("left"), F.col("class")) + step(F.col("class"), F.col("right"))).alias("rare_steps"),
        F.sort_array(F.collect_list(F.when((F.col("left") == UNKNOWN) | (F.col("right") == UNKNOWN), place))).alias("places"),
    )
    # steps between two rare words
    following = F.slice("places", F.lit(2), F.size("places"))
    pair = lambda a, b: F.when(b["place"] == a["place"] + 1, step(a["class"], b["class"])).otherwise(0.0)
    between = F.aggregate(F.zip_with("places", following, pair), F.lit(0.0), lambda x, y: x + y)
    found = walked.drop("rare").join(rare.withColumn("rare_steps", F.col("rare_steps") + between), "row", "left")
    counts = F.col("counts") + F.coalesce("rare_counts", F.lit(0.0))
    base = float(np.log10(n_tokens + 1 * (n_types + 1)))
    return found.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (counts - F.col("n_tokens") * base).alias("base_score"),
        (counts + F.col("steps") + F.coalesce("rare_steps", F.lit(0.0))).alias("score"),
    )
