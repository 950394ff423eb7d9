"""Pack documents into sequences by Karmarkar-Karp multiway differencing.

One pass over the texts cuts each document's tokens into pieces: whole sequences from its
start, and a rest, which is cut again at multiples of 1024 so that the rests can be
balanced. Only numbers leave that pass. The rests are dealt at random to blocks
of a bounded number of tokens. In a block, partial partitions of the rests are merged, the
largest sums of one with the smallest of the other, always the two with the largest
imbalance first; this gives windows of nearly equal length. If a window exceeds the
capacity, the block gets one window more and starts again.

Defined results: NULL text counts as empty; a document without tokens of its own still
has the end mark, one piece of length 1. NULL and repeated ids make no difference, since
pieces are told apart by where they were read. Sequence ids are unique, not consecutive:
even for windows, odd for whole sequences. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import os
import string
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, release_memory, stage

REST = 1024  # the longest piece of a rest
BLOCK_TOKENS = 2_000_000  # of rests; bounds what one task packs at once
BLOCK_PIECES = 20_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, piece long"
)


MARKS = ".,;:!?*#$%&"
JOINED = 1_000  # words that go through the tokenizer as one text
PROBED = 2_000  # words of the vocabulary that tell whether letters need no preparation
GROUP_BYTES = 8 << 20  # of texts whose new words are learned together
GROUP_TEXTS = 200_000
OUT_ROWS = 10_000  # of pieces that leave a task at once


def split_words(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words in lower case, and apart the marks at their ends, which the tokenizer takes apart anyway.

    A letter that a combining mark follows keeps its case: some pairs compose in one case only.
    Marks stay where no letter comes before them.
    """
    raw = words.cast(pa.binary())
    cased = pc.or_(pc.match_substring(raw, b"\xcc"), pc.match_substring(raw, b"\xcd"))
    words = pc.if_else(cased, words, pc.ascii_lower(words))
    cores = pc.ascii_rtrim(words, characters=MARKS)
    size = pc.binary_length(cores)
    trimmed = pc.and_(pc.greater(size, 0), pc.less(size, pc.binary_length(words)))
    at = np.flatnonzero(trimmed.to_numpy(zero_copy_only=False))
    ends = np.full(len(words), "", object)
    apart = np.zeros(len(words), bool)
    pairs = zip(cores.take(pa.array(at)).to_pylist(), words.take(pa.array(at)).to_pylist())
    for i, (core, word) in zip(at.tolist(), pairs):
        if ends_in_letter(core):
            apart[i], ends[i] = True, word[len(core) :]
    return pc.if_else(pa.array(apart), cores, words), pa.array(ends, pa.string())


def ends_in_letter(word: str) -> bool:
    """Whether it still does as the tokenizer reads it: some letters become a letter and a mark."""
    last = word[-1]
    if last.isascii():
        return last.isalpha()
    return unicodedata.normalize("NFC", last).lower()[-1].isalpha()


def joined_array(arrays: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([pa.array([], kind), *arrays])


class WordIds:
    """Token ids, as little-endian unsigned 32-bit numbers, of words between ASCII white space.

    The tokenizer never looks across white space, so a text's ids are those of its words. The
    distinct words of a group of texts are looked up together; words are remembered up to a
    bounded number and size, then those of the last group alone.
    """

    LIMIT = 500_000
    BYTES = 64 << 20  # of words and ids

    def __init__(self, tokenizer_file: str):
        self.file, self.tokenizer = tokenizer_file, None
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _load(self) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        # a task has one core: threads for a handful of words cost more than the words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(self.file)
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.is_end[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # the same model without preparation, for words that preparation leaves as they are
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        words = sorted(token.removesuffix(suffix or "") for token in vocabulary)
        words = [w for w in words if w.isascii() and w.isalpha() and w.islower()]
        probe = " ".join([*string.ascii_lowercase, string.ascii_lowercase, *words[:: len(words) // PROBED + 1]])
        if self.plain.encode(probe, add_special_tokens=False).ids != self._whole(probe):
            self.plain = self.tokenizer

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode(self, words: list[str]) -> pa.Array:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return pa.array([np.array(f.ids, "<u4").tobytes() for f in found], pa.large_binary())

    def _encode_joined(self, tokenizer, words: pa.Array) -> Iterator[pa.Array]:
        """Ids of words of letters: as one text, cut where a token ends a word.

        Each word gives one such token or more. If there are more of them than words, the
        tokenizer has taken a word apart, and the words are encoded one by one.
        """
        for start in range(0, len(words), JOINED):
            part = words.slice(start, JOINED).to_pylist()
            found = tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                yield self._encode(part)
                continue
            offsets = np.concatenate([[0], ends]).astype(np.int64) * 4
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
            yield pa.Array.from_buffers(pa.large_binary(), len(part), buffers)

    def _learn(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words."""
        place = pc.index_in(words, value_set=self.words)
        new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        place = place.fill_null(0).to_numpy().astype(np.int64)
        unknown = words.take(pa.array(new))
        letters = pc.utf8_is_alpha(unknown).to_numpy(zero_copy_only=False)
        plain = letters & pc.and_(pc.string_is_ascii(unknown), pc.ascii_is_lower(unknown)).to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(kind) for kind in (plain, letters & ~plain, ~letters)])
        groups = np.cumsum([np.count_nonzero(plain), np.count_nonzero(letters & ~plain)])
        simple, other, rest = (unknown.take(pa.array(at)) for at in np.split(order, groups))
        found = [
            *self._encode_joined(self.plain, simple),
            *self._encode_joined(self.tokenizer, other),
            self._encode(rest.to_pylist()),
        ]
        place[new[order]] = len(self.words) + np.arange(len(new))
        self.words = joined_array([self.words, simple, other, rest], pa.string())
        self.ids = joined_array([self.ids, *found], pa.large_binary())
        ids = self.ids.take(pa.array(place))
        if len(self.words) > self.LIMIT or self.words.nbytes + self.ids.nbytes > self.BYTES:
            self.words, self.ids = words, ids
        return ids

    def of(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text; new words of a group of texts are learned together."""
        if self.tokenizer is None:
            self._load()
        group: list[bytes] = []
        held = 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= GROUP_BYTES or len(group) >= GROUP_TEXTS:
                found = self._of_group(pa.array(group, pa.string()))
                group, held = [], 0
                yield from found
        if group:
            yield from self._of_group(pa.array(group, pa.string()))

    def _of_group(self, texts: pa.Array) -> Iterator[bytes]:
        """Texts that hold a special token, in any case, are left to the tokenizer as a whole."""
        lowered, special = pc.ascii_lower(texts), pa.array(np.zeros(len(texts), bool))
        for token in self.special:
            special = pc.or_(special, pc.match_substring(lowered, token))
        left = {i: texts[i].as_py() for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist()}
        if left:
            texts = pc.if_else(special, "", texts)
        del lowered
        split = pc.ascii_split_whitespace(texts)
        del texts  # and what else is large, once it is used
        words, bounds = split.flatten().dictionary_encode(), split.offsets.to_numpy()
        del split
        words, distinct = words.indices, words.dictionary
        parts, n = pa.concat_arrays(split_words(distinct)).dictionary_encode(), len(distinct)
        del distinct
        ids = self._learn(parts.dictionary).take(parts.indices)
        del parts
        ids = pc.binary_join_element_wise(ids[:n], ids[n:], pa.scalar(b"", pa.large_binary())).take(words)
        del words
        _, starts, data = ids.buffers()
        bounds = np.frombuffer(starts, np.int64)[bounds].tolist()
        del starts, ids
        data = memoryview(data or b"")
        for i, (start, stop) in enumerate(pairwise(bounds)):
            if i in left:
                yield np.array(self._whole(left[i]), "<u4").tobytes()
            else:
                yield data[start:stop].tobytes()


_IDS: dict[str, WordIds] = {}  # per Python worker


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int) -> DataFrame:
    """Cut each document's tokens into whole sequences and a rest; one stored row per piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _IDS.setdefault(tokenizer_file, WordIds(tokenizer_file))
        end = np.array([end_id], "<u4").tobytes()
        part, piece = TaskContext.get().partitionId(), 0
        doc_ids: deque[int | None] = deque()  # of texts that were read and not cut yet

        def texts() -> Iterator[bytes]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                    doc_ids.append(doc_id)
                    yield text

        def rows() -> Iterator[tuple]:
            for ids in ids_of.of(texts()):
                doc_id = doc_ids.popleft()
                ids += end
                n = len(ids) // 4
                whole = n - n % capacity
                for start in [*range(0, whole, capacity), *range(whole, n, REST)]:
                    stop = min(n, start + (capacity if start < whole else REST))
                    piece_ids = ids[4 * start : 4 * stop]
                    yield doc_id, start, stop - start, zlib.crc32(piece_ids), n

        found = rows()
        while out := list(islice(found, OUT_ROWS)):
            n = len(out)
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(v, pa.int64()) for v in zip(*out)],
                    pa.array([part] * n, pa.int32()),
                    pa.array(range(piece, piece + n), pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "piece"],
            )
            piece += n
        release_memory()

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return stage(columns.mapInArrow(cut, PIECES), "pieces")


def karmarkar_karp(sizes: list[int], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin of each item and each bin's sum, by largest differencing in ``bins`` ways.

    A partial partition holds its non-empty bins only, largest first. Two bins that are
    put together become a node with two children, so that no lists of items are copied.
    """
    left, right = [-1] * len(sizes), [-1] * len(sizes)
    heap = [(-int(x), i, np.array([x]), np.array([i])) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - bins)  # bins that hold items of either
        keep = len(a) - both
        top = len(b) - both
        if both:  # the smallest sums of one meet those of the other, in opposite order
            met = a[keep:] + b[top:][::-1]
            nodes = np.arange(len(left), len(left) + both)
            left.extend(a_nodes[keep:].tolist())
            right.extend(b_nodes[top:][::-1].tolist())
            sums = np.concatenate([a[:keep], met, b[:top]])
            ids = np.concatenate([a_nodes[:keep], nodes, b_nodes[:top]])
        else:
            sums, ids = np.concatenate([a, b]), np.concatenate([a_nodes, b_nodes])
        order = np.argsort(-sums, kind="stable")
        sums, ids = sums[order], ids[order]
        imbalance = sums[0] - (sums[-1] if len(sums) == bins else 0)
        heapq.heappush(heap, (-int(imbalance), made, sums, ids))
        made += 1
    bin_of = np.zeros(len(sizes), np.int64)
    sums, ids = heap[0][2:] if heap else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for number, node in enumerate(ids.tolist()):
        todo = [node]
        while todo:
            node = todo.pop()
            if left[node] < 0:
                bin_of[node] = number
            else:
                todo += (left[node], right[node])
    return bin_of, sums


def windows(sizes: list[int], capacity: int) -> np.ndarray:
    """A window for each item, none above ``capacity``; as few windows as differencing allows."""
    bins = max(1, -(-sum(sizes) // capacity))
    while True:
        bin_of, sums = karmarkar_karp(sizes, bins)
        if len(sums) == 0 or sums[0] <= capacity:
            return bin_of
        bins += 1


def pack(
    docs: DataFrame, tokenizer_file: str, end_id: int = 2, capacity: int = 4096
) -> DataFrame:
    """One row per piece: document, place in it, checksum of its ids, sequence and place there."""
    pieces = token_pieces(docs, tokenizer_file, end_id, capacity)
    rests = pieces.filter(F.col("length") < capacity)
    tokens, n = rests.agg(F.sum("length"), F.count("*")).first()
    blocks = max(1, -(-(tokens or 0) // BLOCK_TOKENS), -(-n // BLOCK_PIECES))

    def pack_block(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["part", "piece"], ignore_index=True)
        window = windows(block["length"].tolist(), capacity)
        block = block.assign(sequence_id=((int(key[0]) << 31) + window) * 2)
        block["offset"] = block.groupby("sequence_id")["length"].cumsum() - block["length"]
        return block[[*RESULT]]

    block = F.pmod(F.xxhash64("part", "piece"), F.lit(blocks))
    packed = rests.groupBy(block.alias("block")).applyInPandas(pack_block, RESULT_SCHEMA)
    own = F.shiftleft(F.col("part").cast("long"), 40) + F.col("piece")
    whole = pieces.filter(F.col("length") == capacity).select(
        *[c for c in RESULT if c not in ("sequence_id", "offset")],
        (own * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(whole)


RESULT = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
RESULT_SCHEMA = ", ".join(f"{c} long" for c in RESULT)
