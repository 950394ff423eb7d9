"""Phrase collocations by vertical partitioning of word suffixes.

Every word of a piece of text starts a suffix, cut after ``LONGEST`` words. A phrase is a
prefix of as many suffixes as it has occurrences, so counting phrases is counting leaves
below nodes of the suffix tree. The tree is never built as a whole: prefixes are grouped so
that the suffixes of a group fit a memory budget, a prefix with more suffixes than the
budget being extended by its next word until none is, and each group builds its own subtrees by
sorting, independent of the others, and reads counts from the totals of their leaves.

A phrase is as frequent as asked for only if each of its words and pairs of neighbours is. A
first pass therefore counts words and pairs in hashed cells. Cells can only count too much,
so a cell below the threshold proves its pairs to be rare, and suffixes end where a
rare pair begins: what remains is short and mostly alike, and equal suffixes of a stretch of
text are sent as one. A crowded table of cells only lets more through; the counts stay exact.
The same pass counts prefixes in buckets by hash, for the grouping: a bucket is never split
between groups, so suffixes with a common prefix meet. A stretch sends each group one
compressed block with the words it uses and its suffixes as numbers.

Defined results: NULL text counts as empty, NULL language as ``und``. A table without words
gives no rows. Repeated rows count each time. Texts are read whole, however long; a stretch
is a number of whole texts, or one text longer than that. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE, mixed, release_memory, stage

LONGEST = 4
STRETCH = 1 << 23  # bytes of text handled together
BUDGET = 2_000_000  # occurrences of the prefixes of a group, on average; equal ones of a stretch are sent as one
BUCKETS = 14  # power of two of buckets of prefixes of a length
CELLS = 20, 28  # least and greatest power of two of cells
BLOCK = 1 << 16  # cells sent together
HITS = 1 << 23  # words and pairs counted together
SALTS = 8

# What ends a piece, what separates words, and the letters to lower.
ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # no byte of UTF-8
FOLD = bytes.maketrans(
    ENDS + b"\t" + bytes(range(ord("A"), ord("Z") + 1)),
    BREAK * len(ENDS) + b" " + bytes(range(ord("a"), ord("z") + 1)),
)
BLOCKS = "grp long, lang string, block binary, words long"
NODES = "lang string, phrase string, words int, f long"


# ---- inside Python tasks ------------------------------------------------------------


def stretches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Per language the words of some texts; ``BREAK`` stands between pieces."""
    waiting: dict[str, list[bytes]] = {}

    def tokens(texts: list[bytes]) -> pa.Array:
        joined = BREAK.join([b"", *texts, b""]).translate(FOLD)
        return pa.array(joined.replace(BREAK, b" " + BREAK + b" ").split(), pa.binary())

    total = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = text.as_py()
            if not text:
                continue
            waiting.setdefault(lang, []).append(text)
            total += len(text)
            if total >= STRETCH:
                for name, texts in waiting.items():
                    yield name, tokens(texts)
                waiting, total = {}, 0
    for name, texts in waiting.items():
        yield name, tokens(texts)


class Stretch:
    """Words as numbers; 0 marks the end of a piece."""

    def __init__(self, lang: str, words: pa.Array):
        coded = words.dictionary_encode()
        self.names = coded.dictionary
        self.ids = coded.indices.to_numpy().astype(np.int64)
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        hashes = [xxhash.xxh3_64_intdigest(w.as_py(), seed) for w in self.names]
        self.hash = np.array(hashes, np.uint64)
        self.is_word = np.ones(len(self.ids), bool)
        breaks = pc.index(self.names, pa.scalar(BREAK, pa.binary())).as_py()
        if breaks >= 0:
            self.is_word = self.ids != breaks

    def cells(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each word, and of each place's word with the next one."""
        shift = np.uint64(64 - bits)
        single = (mixed(self.hash) >> shift).astype(np.int64)[self.ids]
        ahead = self.hash[self.ids]
        pair = mixed(ahead[:-1] * np.uint64(BASE) + ahead[1:] + np.uint64(1)) >> shift
        return single, pair.astype(np.int64)

    @property
    def is_pair(self) -> np.ndarray:
        return self.is_word[:-1] & self.is_word[1:]


def hit_cells(stretch: Stretch, bits: int) -> np.ndarray:
    """The cells of all words and pairs, with repetitions."""
    single, pair = stretch.cells(bits)
    return np.concatenate([single[stretch.is_word], pair[stretch.is_pair]]).astype(np.uint32)


def count_cells(hits: list[np.ndarray], least: int) -> pa.RecordBatch:
    """Counts of cells, at most ``least`` each, in blocks of places and counts."""
    cells, counts = np.unique(np.concatenate(hits), return_counts=True)
    counts = np.minimum(counts, least)
    blocks, starts = np.unique(cells // BLOCK, return_index=True)
    ends = np.r_[starts[1:], len(cells)]
    place = (cells % BLOCK).astype("<u2")
    columns = [
        pa.array(blocks, pa.int64()),
        pa.array([place[s:e].tobytes() for s, e in zip(starts, ends)], pa.binary()),
        pa.array([_narrow(counts[s:e], least) for s, e in zip(starts, ends)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "places", "counts"])


def _width(least: int) -> str:
    return "<u1" if least < 1 << 8 else "<u4"


def _narrow(counts: np.ndarray, least: int) -> bytes:
    return counts.astype(_width(least)).tobytes()


def full_cells(rows: pa.Table, least: int) -> pa.Table:
    """One bit per cell of a block: it was hit ``least`` times."""
    total = np.zeros(BLOCK, np.uint64)
    for place, count in zip(rows["places"], rows["counts"]):
        total[np.frombuffer(place.as_py(), "<u2")] += np.frombuffer(count.as_py(), _width(least))
    bits = np.packbits(total >= least, bitorder="little").tobytes()
    return pa.table({"block": rows["block"][:1], "bits": pa.array([bits], pa.binary())})


class Grouping:
    """Which group a suffix belongs to, from the numbers of occurrences of prefixes by bucket.

    ``counts[d]`` holds them for prefixes of d + 1 words. A bucket above the budget passes its
    suffixes on to the buckets of prefixes one word longer; neighbouring buckets that stay below
    share a group up to the budget. Of longer prefixes only a share is passed on, so as many
    more buckets share a group.
    """

    def __init__(self, counts: np.ndarray, budget: int):
        self.bits = counts.shape[1].bit_length() - 1
        self.groups, start, passed = [], 0, counts[0].sum()
        for level in counts:
            crowded = level > budget  # these lie below crowded ones of the level before
            on = level[crowded].sum()
            share = max(passed - on, 1) / max(level.sum() - on, 1)
            before = np.cumsum(np.where(crowded, 0, level)) - level
            group = start + (np.maximum(before, 0) * share / budget).astype(np.int64)
            self.groups.append(np.where(crowded, -1, group))
            start, passed = int(group.max(initial=start)) + 1, on
        self.last = start, int(passed // budget) + 1

    def of(self, prefixes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Group and length of the prefix of suffixes, from the hashes of their prefixes."""
        start, n = self.last
        group = start + (prefixes[-1] % np.uint64(n)).astype(np.int64)
        length = np.full(len(group), LONGEST)
        for depth in range(len(self.groups) - 1, -1, -1):
            found = self.groups[depth][bucket(prefixes[depth], self.bits)]
            group, length = np.where(found >= 0, found, group), np.where(found >= 0, depth + 1, length)
        return group, length


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def prefix_hashes(hashes: np.ndarray, words: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of the prefixes of suffixes given as columns of word numbers, -1 past their end."""
    out, total = [], np.zeros(len(words[0]), np.uint64)
    for word in words:
        own = np.where(word < 0, np.uint64(0), hashes[word])
        total = mixed(total * np.uint64(BASE) + own + np.uint64(1))
        out.append(total)
    return out


def prefix_counts(stretch: Stretch, bits: int) -> np.ndarray:
    """Occurrences of prefixes of one word less than a suffix, and of shorter ones, by bucket."""
    places = np.flatnonzero(stretch.is_word)
    here, words = np.ones(len(places), bool), []
    for depth in range(LONGEST - 1):
        at = np.minimum(places + depth, len(stretch.ids) - 1)
        here = here & (places + depth < len(stretch.ids)) & stretch.is_word[at]
        words.append(np.where(here, stretch.ids[at], -1))
    hashed = prefix_hashes(stretch.hash, words)
    return np.stack([np.bincount(bucket(h, bits), minlength=1 << bits) for h in hashed])


def suffixes(stretch: Stretch, bits: int, full: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct suffixes of a stretch, as columns of word numbers, and how often they occur."""
    single, pair = stretch.cells(bits)
    often = lambda cell: (full[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
    goes_on = np.r_[stretch.is_pair & often(pair), False]
    places = np.flatnonzero(stretch.is_word & often(single))
    here, held, rank = np.ones(len(places), bool), [], np.zeros(len(places), np.int64)
    for depth in range(LONGEST):
        if depth:
            here = here & goes_on[np.minimum(places + depth - 1, len(goes_on) - 1)]
        word = np.where(here, stretch.ids[np.minimum(places + depth, len(stretch.ids) - 1)], -1)
        held.append(word)
        _, rank = np.unique(rank * (len(stretch.names) + 1) + word + 1, return_inverse=True)
    _, first, n = np.unique(rank, return_index=True, return_counts=True)
    return [word[first] for word in held], n


def blocks(lang: str, words: pa.Array, bits: int, full: np.ndarray, grouping: Grouping) -> pa.RecordBatch:
    """The suffixes of a stretch, one block per group, and the number of words of the language."""
    stretch = Stretch(lang, words)
    columns, n = suffixes(stretch, bits, full)
    group, length = grouping.of(prefix_hashes(stretch.hash, columns))
    by = np.lexsort((*columns[::-1], group))
    group = group[by]
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    packed = [
        pack(stretch.names, np.stack([c[part] for c in columns]), n[part], length[part])
        for part in np.split(by, starts[1:])
        if len(part)
    ]
    total = int(np.count_nonzero(stretch.is_word))
    arrays = [
        pa.array([*group[starts].tolist(), None], pa.int64()),
        pa.array([lang] * (len(packed) + 1), pa.string()),
        pa.array([*packed, None], pa.binary()),
        pa.array([0] * len(packed) + [total], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["grp", "lang", "block", "words"])


def pack(names: pa.Array, ids: np.ndarray, n: np.ndarray, length: np.ndarray) -> bytes:
    """The words that suffixes use, and the suffixes as their places, in Arrow's own format."""
    used, places = np.unique(ids, return_inverse=True)
    some = used[used >= 0]
    places = places.reshape(ids.shape) - (len(used) - len(some))  # -1 stays -1
    kind = np.int16 if len(some) < 1 << 15 else np.int32
    table = pa.table(
        {f"w{i}": places[i].astype(kind) for i in range(LONGEST)} | {"n": n.astype(np.int64), "prefix": length.astype(np.int8)}
    )
    used_words = pa.table({"word": names.take(pa.array(some))})
    sink = pa.BufferOutputStream()
    for part in (used_words, table):
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(part)
    return sink.getvalue().to_pybytes()


def unpack(block: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    source = pa.BufferReader(block)
    words = pa.ipc.open_stream(source).read_all()["word"].combine_chunks()
    table = pa.ipc.open_stream(source).read_all()
    ids = np.stack([table[f"w{i}"].to_numpy().astype(np.int64) for i in range(LONGEST)])
    return words, ids, table["n"].to_numpy(), table["prefix"].to_numpy()


def subtree(rows: pa.Table, least: int) -> pa.Table:
    """The nodes below the prefixes of a group: phrase, depth, occurrences.

    Suffixes are sorted, so a node is a run of them and its total a sum over the run. A node
    above its prefix's end holds a part of its total only, and is returned however small it is.
    """
    langs, blocks_ = rows["lang"].to_pylist(), [unpack(b.as_py()) for b in rows["block"]]
    codes = pa.chunked_array([b[0] for b in blocks_], pa.binary()).combine_chunks().dictionary_encode()
    names, coded = codes.dictionary.cast(pa.string()), codes.indices.to_numpy().astype(np.int64)
    known = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
    columns, start = [], 0
    for lang, (words, ids, _, _) in zip(langs, blocks_):
        own = np.r_[coded[start : start + len(words)], -1]  # place -1 is the last
        columns.append(np.vstack([np.full(ids.shape[1], known[lang]), own[ids]]))
        start += len(words)
    ids = np.concatenate(columns, axis=1)
    n, whole = (np.concatenate([b[i] for b in blocks_]) for i in (2, 3))
    by = np.lexsort(ids[::-1])
    ids, n, whole = ids[:, by], n[by], whole[by]
    new = np.ones(len(by), bool)
    new[1:] = ids[0, 1:] != ids[0, :-1]
    lang_names, parts = pa.array(list(known), pa.string()), []
    for depth in range(1, LONGEST + 1):
        new[1:] |= ids[depth, 1:] != ids[depth, :-1]
        starts = np.flatnonzero(new)
        total = np.add.reduceat(n, starts)
        kept = (ids[depth, starts] >= 0) & ((total >= least) | (whole[starts] > depth))
        at = starts[kept]
        texts = pc.binary_join_element_wise(*[names.take(pa.array(ids[i, at])) for i in range(1, depth + 1)], " ")
        parts.append(
            pa.table([lang_names.take(pa.array(ids[0, at])), texts, pa.array(np.full(len(at), depth, np.int32)), pa.array(total[kept])],
                     names=[c.split()[0] for c in NODES.split(", ")])
        )
    release_memory()
    return pa.concat_tables(parts)


# ---- on Spark -----------------------------------------------------------------------


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )


def cell_bits(texts: DataFrame) -> int:
    """Twice as many cells as there may be words, within fixed bounds."""
    length = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    low, high = CELLS
    return min(max(int(length // 3).bit_length(), low), high)


def first_pass(texts: DataFrame, bits: int, least: int, budget: int) -> tuple[np.ndarray, Grouping]:
    """A bit per cell, and the grouping of prefixes.

    Both come to the driver and go to each executor: 2 ** (bits - 3) bytes, 32 MB at most, and
    ``LONGEST - 1`` times 2 ** ``BUCKETS`` numbers, whatever the size of the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, n, prefixes = [], 0, 0
        for lang, words in stretches(batches):
            stretch = Stretch(lang, words)
            prefixes = prefixes + prefix_counts(stretch, BUCKETS)
            hits.append(hit_cells(stretch, bits))
            n += len(hits[-1])
            if n >= HITS:
                yield count_cells(hits, least)
                hits, n = [], 0
        if n:
            yield count_cells(hits, least)
        if not isinstance(prefixes, int):
            dense = pa.array([p.astype("<i8").tobytes() for p in prefixes], pa.binary())
            levels = pa.array(range(-len(prefixes), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([levels, dense, dense], names=["block", "places", "counts"])
        release_memory()

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        if key[0].as_py() >= 0:
            return full_cells(rows, least)
        total = sum(np.frombuffer(p.as_py(), "<i8") for p in rows["places"])
        return pa.table({"block": rows["block"][:1], "bits": pa.array([total.tobytes()], pa.binary())})

    counted = texts.mapInArrow(count, "block long, places binary, counts binary")
    added = counted.groupBy("block").applyInArrow(add, "block long, bits binary")
    full = np.zeros(1 << (bits - 3), np.uint8)
    counts = np.zeros((LONGEST - 1, 1 << BUCKETS), np.int64)
    size = BLOCK >> 3
    for block, line in added.collect():
        if block < 0:
            counts[block] = np.frombuffer(line, "<i8")
        else:
            full[block * size : (block + 1) * size] = np.frombuffer(line, np.uint8)
    return full, Grouping(counts, budget)


def grouped_suffixes(texts: DataFrame, least: int, budget: int) -> DataFrame:
    """Blocks of suffixes by group, written once; rows without a group count a language's words."""
    bits = cell_bits(texts)
    known = texts.sparkSession.sparkContext.broadcast(first_pass(texts, bits, least, budget))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, grouping = known.value
        for lang, words in stretches(batches):
            yield blocks(lang, words, bits, full, grouping)
        release_memory()

    return stage(texts.mapInArrow(cut, BLOCKS), "suffixes")


def frequent_phrases(rows: DataFrame, least: int) -> DataFrame:
    """All phrases that occur at least ``least`` times: ``lang, phrase, words, f``."""
    groups = rows.filter(F.col("grp").isNotNull()).groupBy("grp")
    nodes = groups.applyInArrow(lambda table: subtree(table, least), NODES)
    summed = nodes.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return stage(summed.filter(F.col("f") >= least), "phrases")


def part_of_phrase(start: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, n), " ")


def score_of(a: Column, both: Column) -> Column:
    """``floor(2000000 * a / both)``, exact beyond 64 bits."""
    wide = (a.cast("decimal(20,0)") * F.lit(2_000_000).cast("decimal(18,0)")).alias("x")
    return F.call_function("div", wide, both.cast("decimal(20,0)")).cast("long")


def weakest_cut(phrases: DataFrame) -> DataFrame:
    """Candidates with the counts of the two parts at the lowest-scoring cut.

    A part is looked up among the frequent phrases. One word may be a part of many, so
    words are dealt by a salt as well.
    """
    salts = F.when(F.col("words") == 1, F.array(*map(F.lit, range(SALTS)))).otherwise(F.array(F.lit(0)))
    salted = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"), F.explode(salts).alias("salt"))
    cuts = (
        phrases.filter("words > 1")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    )
    k, rest = F.col("k"), F.col("words") - F.col("k")
    salt = lambda n: F.when(n == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")
    sides = F.array(
        F.struct(F.lit(True).alias("first"), part_of_phrase(1, k).alias("part"), salt(k)),
        F.struct(F.lit(False).alias("first"), part_of_phrase(k + 1, rest).alias("part"), salt(rest)),
    )
    looked_up = cuts.withColumn("side", F.explode(sides)).select("*", "side.*").drop("side").join(salted, ["lang", "part", "salt"])
    scored = (
        looked_up.groupBy("lang", "phrase", "words", F.col("f").alias("a"), "k")
        .agg(F.max(F.when(F.col("first"), F.col("of_part"))).alias("l"), F.max(F.when(~F.col("first"), F.col("of_part"))).alias("r"))
        .withColumn("score", score_of(F.col("a"), F.col("l") + F.col("r")))
    )
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def not_covered(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that no longer one holds in ``percent`` of 100 of their occurrences."""
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("words") - 1),
                lambda n: F.transform(
                    F.sequence(F.lit(1), F.col("words") - n + 1), lambda at: part_of_phrase(at, n)
                ),
            )
        )
    )
    longer = candidates.filter("words > 2").select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * percent
    return candidates.join(most, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(docs: DataFrame, *, least: int = 30, percent: int = 80, most: int = 2000, budget: int = BUDGET) -> DataFrame:
    """Each language's ``most`` best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is the number of occurrences, ``l`` and ``r`` those of the two parts of its weakest
    cut, ``n`` the number of words of the language.
    """
    rows = grouped_suffixes(texts_of(docs), least, budget)
    phrases = frequent_phrases(rows, least)
    sizes = rows.filter(F.col("grp").isNull()).groupBy("lang").agg(F.sum("words").alias("n"))
    candidates = not_covered(weakest_cut(phrases), percent)
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = candidates.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
