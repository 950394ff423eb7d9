"""Each stage of the corpus pipeline, on what its predecessor kept."""

import random
import re

import corpus_pipeline
import pytest

WORDS = {
    "en": "the a of and house river dog green walks under bridge stone light over water small tall north wind table".split(),
    "fr": "le la de et maison fleuve chien vert marche sous pont pierre sur eau petit grand nord vent lampe jardin".split(),
}


def texts():
    draw = random.Random(5)
    rows = [
        (lang, " ".join(draw.choice(WORDS[lang]) for _ in range(40)))
        for lang in WORDS
        for _ in range(30)
    ]
    english = rows[0][1]
    near = english.split()
    near[-1] = "changed"
    return rows + [("en", english + "\n"), ("en", " ".join(near)), ("en", rows[1][1]), (None, None), ("fr", ""), ("en", "12 34")]


@pytest.fixture(scope="module")
def stages(documents, tmp_path_factory):
    """The rows after each stage, from a table with nulls, empty texts, copies and clashing names."""
    rows = [(i, text, lang, ("a", "b", None)[i % 3]) for i, (lang, text) in enumerate(texts())]
    docs = documents([*rows, rows[5], (None, rows[7][1], "en", "b")])
    found = {"": docs}
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        function(docs.sparkSession, docs, "").write.parquet(path)
        docs = docs.sparkSession.read.parquet(path)
        found[name] = docs
    return found


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_columns_stay(stages):
    names = list(corpus_pipeline.STAGES)
    assert [n for n, _ in names] == ["language_id", "exact_dedup", "minhash_near_dedup", "source_mixing", "packing"]
    for name, _ in names[:-1]:
        assert stages[name].columns == stages[""].columns


def test_language_drops_what_has_no_letter(stages):
    kept = [r["text"] for r in stages["language_id"].collect()]
    assert sorted(kept) == sorted(r["text"] for r in stages[""].collect() if r["text"] and re.search("[a-z]", r["text"]))


def test_one_of_equal_texts_stays(stages):
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    before = [r["text"] for r in stages["language_id"].collect()]
    after = [r["text"] for r in stages["exact_dedup"].collect()]
    assert len(after) == len(set(map(plain, after))) and set(map(plain, after)) == set(map(plain, before))
    assert any(t.endswith("\n") for t in after)  # the longest of them


def test_one_of_near_copies_stays(stages):
    before = [r["text"] for r in stages["exact_dedup"].collect()]
    after = [r["text"] for r in stages["minhash_near_dedup"].collect()]
    groups = []
    for text in before:
        own = shingles(text)
        near = [g for g in groups if any(10 * len(own & s) >= 8 * len(own | s) for s in g)]
        groups = [g for g in groups if g not in near] + [[own, *(s for g in near for s in g)]]
    assert len(groups) == len(before) - 1 == len(after)
    assert {frozenset(shingles(t)) for t in after} <= {frozenset(shingles(t)) for t in before}


def test_mix_takes_documents_at_most_three_times(stages):
    before = {(r["doc_id"], r["text"]) for r in stages["minhash_near_dedup"].collect()}
    taken = [(r["doc_id"], r["text"]) for r in stages["source_mixing"].collect()]
    assert taken and set(taken) <= before and max(map(taken.count, taken)) <= 3


def test_pieces_hold_each_taken_document_whole(stages):
    taken = [r["doc_id"] for r in stages["source_mixing"].collect()]
    pieces = stages["packing"].collect()
    spans, heads = {}, []
    for p in pieces:
        spans.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        heads += [p["doc_id"]] if p["start"] == 0 else []
    assert sorted(map(str, heads)) == sorted(map(str, taken))
    for found in spans.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 4096
    assert sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)


def test_an_empty_table_passes_all_stages(spark, documents, tmp_path):
    documents([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
