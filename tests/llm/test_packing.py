"""Packing: exact token ids, no piece lost, windows within the capacity."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, normalizers

from rollforward.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    (1, "Hello, World!! it's don't 'tis ... a*** b&&& É, été!! 日本! x…!! '!!"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (None, "same"),
    (5, "same"),
    (5, "same"),
    (6, "<|endoftext|> tail"),
    (6, "New<|EndOfText|>york, a<|startoftext|><|endoftext|>b <| endoftext |>"),
    (7, "word " * 9000),
    (8, "a b ́c é!"),
]


def test_pieces_hold_all_ids(documents):
    found = packing.pack(documents(TEXTS), FILE, capacity=4096).collect()
    tokenizer = Tokenizer.from_file(FILE)
    pieces = defaultdict(list)
    for r in found:
        pieces[(r["doc_id"], r["start"], r["length"], r["ids_crc32"])].append(r)
    for doc_id, text in TEXTS:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        while at < len(ids):
            options = [k for k in pieces if k[0] == doc_id and k[1] == at and pieces[k]
                       and zlib.crc32(ids[at : at + k[2]].tobytes()) == k[3] and pieces[k][0]["doc_tokens"] == len(ids)]
            pieces[options[0]].pop()
            at += options[0][2]
    assert not any(pieces.values())
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_words_learned_together_have_the_ids_of_the_text():
    tokenizer = Tokenizer.from_file(FILE)
    # pairs that compose in lower case only, marks, letters that lower-case to two signs
    signs = ["J\u030c", "T\u0308", "\u0130", "\u00df", "a", "Z", "'s", "1", ".", "!?", "\u65e5", "\u3000", "\x1c", "\u0340"]
    random = np.random.default_rng(3)
    texts = ["".join(random.choice([*signs, " ", "\n"], 40)) for _ in range(300)]
    ids = packing.WordIds(FILE)
    ids.LIMIT = 400  # forgets between groups
    for group in (texts[:150], texts[150:], []):
        expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in group]
        assert list(ids.of(t.encode() for t in group)) == expected


def expected_ids(tokenizer, texts):
    return [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


class Prepared:
    """A tokenizer that counts the words it prepares."""

    def __init__(self, tokenizer):
        self.tokenizer, self.words = tokenizer, 0

    def encode(self, text, **options):
        self.words += len(text.split())
        return self.tokenizer.encode(text, **options)

    def encode_batch_fast(self, texts, **options):
        self.words += sum(len(t.split()) for t in texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_words_that_need_no_preparation_get_none():
    tokenizer = Tokenizer.from_file(FILE)
    texts = ["Plain words, of letters! \xc9t\xe9 \xe9t\xe9", "plain Words of\x0bletters\x1c again... it's"]
    ids = packing.WordIds(FILE)
    assert list(ids.of([b""])) == [b""]
    ids.tokenizer = Prepared(ids.tokenizer)
    assert list(ids.of(t.encode() for t in texts)) == expected_ids(tokenizer, texts)
    others = {"\xc9t\xe9", "\xe9t\xe9", "letters\x1c", "it's", ",", "!", "..."}
    assert 0 < ids.tokenizer.words <= len(others)
    done = ids.tokenizer.words  # words of an earlier group are known
    assert list(ids.of(t.upper().encode() for t in texts)) == expected_ids(tokenizer, [t.upper() for t in texts])
    assert ids.tokenizer.words <= done + len(others)
    again = ids.tokenizer.words
    list(ids.of(t.encode() for t in texts))
    assert ids.tokenizer.words == again


def test_a_tokenizer_that_changes_letters_prepares_all_words(tmp_path):
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.normalizer = normalizers.Sequence([tokenizer.normalizer, normalizers.Replace("q", "k")])
    tokenizer.save(str(tmp_path / "changed.json"))
    texts = ["quick queen", "a quiet, Quick q"]
    ids = packing.WordIds(str(tmp_path / "changed.json"))
    assert list(ids.of(t.encode() for t in texts)) == expected_ids(tokenizer, texts)


def test_groups_of_texts_may_end_anywhere(monkeypatch):
    tokenizer = Tokenizer.from_file(FILE)
    texts = [text or "" for _, text in TEXTS] * 3
    for size, count in ((1, 100), (40, 100), (1 << 20, 1), (1 << 20, 4)):
        monkeypatch.setattr(packing, "GROUP_BYTES", size)
        monkeypatch.setattr(packing, "GROUP_TEXTS", count)
        ids = packing.WordIds(FILE)
        assert list(ids.of(t.encode() for t in texts)) == expected_ids(tokenizer, texts)


def test_words_are_forgotten_by_number_and_by_size():
    for name, limit in (("LIMIT", 4), ("BYTES", 300)):
        ids = packing.WordIds(FILE)
        setattr(ids, name, limit)
        for text in ("one two three", "four five six " + "x" * 100, "seven", "one"):
            assert list(ids.of([text.encode()])) == expected_ids(Tokenizer.from_file(FILE), [text])
        assert "two" not in ids.words.to_pylist()


def test_pieces_over_several_batches(documents):
    """More rows than one batch carries, from the task to it and back, keep id and text together."""
    rows = [(i, f"{'word ' * (i % 7)}end{i % 13}") for i in range(25_000)]
    tokenizer = Tokenizer.from_file(FILE)
    lengths = {text: len(tokenizer.encode(text, add_special_tokens=False).ids) + 1 for _, text in rows}
    found = packing.token_pieces(documents(rows).coalesce(1), FILE, 2, 4096).collect()
    assert sorted((r["doc_id"], r["length"]) for r in found) == [(i, lengths[t]) for i, t in rows]
    assert sorted(r["piece"] for r in found) == list(range(25_000))


def test_differencing_balances():
    sizes = np.random.default_rng(1).integers(1, 1025, 2000).tolist()
    bins, sums = packing.karmarkar_karp(sizes, 250)
    assert np.array_equal(np.sort(np.bincount(bins, weights=sizes)), np.sort(sums))
    assert sums.max() - sums.min() <= 0.01 * sums.mean()
    window = packing.windows(sizes, 4096)
    assert np.bincount(window, weights=sizes).max() <= 4096
    assert window.max() + 1 <= -(-sum(sizes) // 4096) + 1


def test_window_count_rises():
    assert packing.windows([4000] * 5, 4096).max() == 4
    assert len(packing.windows([], 4096)) == 0


def test_empty_table(documents):
    assert packing.pack(documents([]), FILE).count() == 0
