"""Language identification by words first, shorter and shorter character n-grams next.

A word that the training texts hold scores by its log frequency in each language. A word
they do not hold is scored by its longest n-grams if any is known, else by shorter ones,
down to single characters. A text's scores add up over its words; their softmax gives the
prediction and its score.

The model is fitted on a bounded sample of labelled rows: of each language the
``PER_LANGUAGE`` different training texts with the smallest hash, texts of more than
``LONGEST_TEXT`` characters aside. Its tables hold no more than the sample, so they may be
sent to every task. All texts are scored whole.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is every
text if no labelled rows exist. Languages that tie go by name. Rows with NULL language or
NULL text are not learned from. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import stage

PER_LANGUAGE = 300  # labelled texts to learn from
LONGEST_TEXT = 20_000  # characters of one of them
LONGEST = 4  # characters of an n-gram
BACKOFF = 0.4  # weight of an n-gram's evidence against a whole word's
UNKNOWN = "und"
SALTS = 64  # groups that a language's hashes are dealt to before the smallest are taken


def letters(word: str) -> str:
    """A word without what is not a letter, in lower case."""
    return word.lower() if word.isalpha() else "".join(filter(str.isalpha, word)).lower()


def grams(word: str, n: int) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


class Model:
    """Log frequencies per language of words and n-grams; unseen ones get the floor.

    Tokens that were met keep their row of evidence, up to a bounded number of tokens; row
    0 is that of tokens without a letter. New tokens are looked up together.
    """

    CACHE = 300_000
    SLICE = 100_000  # words of a text looked at together

    def __init__(self, texts: dict[str, list[str]]):
        self.languages = sorted(texts)
        words = {name: Counter(filter(None, map(letters, " ".join(texts[name]).split()))) for name in texts}
        self.words = self._logs(words)
        self.grams = {}
        for n in range(LONGEST, 0, -1):
            counted = {}
            for name in self.languages:
                counted[name] = Counter()
                for word, times in words[name].items():
                    for gram in grams(word, n):
                        counted[name][gram] += times
            self.grams[n] = self._logs(counted)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1, len(self.languages)), np.float32)
        self.used = 1

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "rows", "used")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _logs(self, counts: dict[str, Counter]) -> tuple[dict[str, int], np.ndarray]:
        """A row number per item, and rows of log frequencies, 0 for the best language."""
        every = sorted(set().union(*counts.values())) if counts else []
        table = np.array([[counts[name][item] for name in self.languages] for item in every], float)
        table = table.reshape(len(every), len(self.languages))
        logs = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * max(1, len(every)))
        best = logs.max(axis=1, keepdims=True) if self.languages else 0
        return {item: i for i, item in enumerate(every)}, (logs - best).astype(np.float32)

    def evidence(self, words: list[str]) -> np.ndarray:
        """A row per word: its own if it is known, else the mean of its longest known n-grams."""
        found = np.zeros((len(words), len(self.languages)), np.float32)
        places, logs = self.words
        at = [places.get(word, -1) for word in words]
        whole = [i for i, place in enumerate(at) if place >= 0]
        found[whole] = logs[[at[i] for i in whole]]
        todo = [i for i, place in enumerate(at) if place < 0]
        for n in range(LONGEST, 0, -1):
            places, logs = self.grams[n]
            owners, starts, rows, left = [], [], [], []
            for i in todo:
                start = len(rows)
                rows += [place for gram in grams(words[i], n) if (place := places.get(gram)) is not None]
                if len(rows) > start:
                    owners.append(i)
                    starts.append(start)
                else:
                    left.append(i)
            if owners:
                times = np.diff([*starts, len(rows)])
                found[owners] = BACKOFF * np.add.reduceat(logs[rows], starts, axis=0) / times[:, None]
            todo = left
        return found

    def _learn(self, new: set[str], part: list[str]) -> None:
        if len(self.known) + len(new) > self.CACHE:
            self._forget()
            new = set(part)
        tokens = list(new)
        words = [letters(token) for token in tokens]
        spelled = [i for i, word in enumerate(words) if word]
        need = self.used + len(spelled)
        if need > len(self.rows):
            more = np.zeros((max(need, 2 * len(self.rows)) - len(self.rows), len(self.languages)), np.float32)
            self.rows = np.concatenate([self.rows, more])
        self.rows[self.used : need] = self.evidence([words[i] for i in spelled])
        self.known.update(dict.fromkeys(tokens, 0))
        self.known.update(zip([tokens[i] for i in spelled], range(self.used, need)))
        self.used = need

    def scores(self, text: str) -> tuple[str, float]:
        if not self.languages:
            return UNKNOWN, 0.0
        total, any_letter = np.zeros(len(self.languages)), False
        words = text.split()
        for start in range(0, len(words), self.SLICE):
            part = words[start : start + self.SLICE]
            new = set(part).difference(self.known)
            if new:
                self._learn(new, part)
            rows = np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))
            any_letter = any_letter or bool(rows.any())
            total += self.rows[rows].sum(axis=0, dtype=float)
        if not any_letter:
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Of each language the ``per_language`` different texts with the smallest hash.

    The limits are found on hashes alone; only the texts below them move.
    """
    usable = F.col("lang").isNotNull() & (F.length("text") <= LONGEST_TEXT)
    hashed = docs.filter(usable).select("lang", "text", F.xxhash64("text").alias("hash"))
    first = hashed.select("lang", "hash").distinct()
    salt = F.pmod(F.col("hash"), F.lit(SALTS))
    for dealt in (["lang", salt], ["lang"]):  # the second round sees SALTS * per_language rows at most
        place = F.row_number().over(Window.partitionBy(*dealt).orderBy("hash"))
        first = first.withColumn("place", place).filter(F.col("place") <= per_language).drop("place")
    limits = stage(first.groupBy("lang").agg(F.max("hash").alias("limit")), "language-limits")
    below = hashed.join(limits, "lang").filter(F.col("hash") <= F.col("limit"))
    return below.groupBy("lang", "hash").agg(F.first("text").alias("text")).select("lang", "text")


def fit(training: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model from a bounded number of labelled rows (``text``, ``lang``)."""
    texts: dict[str, list[str]] = {}
    for lang, text in sample(training, per_language).collect():
        texts.setdefault(lang, []).append(text)
    return Model(texts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, in place of columns of these names.

    Only the text is looked at.
    """
    docs = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")
    schema = StructType([*docs.schema, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            found = [model.scores(v.as_py() or "") for v in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=schema.names,
            )

    return docs.mapInArrow(predict, schema)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with a score of ``least`` or more."""
    found = identify(docs.select(F.struct(*docs.columns).alias("_doc"), "text"), model)
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*[F.col("_doc")[c].alias(c) for c in docs.columns])
