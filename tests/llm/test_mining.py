"""Collocations, quality rules and hard negatives against brute force and held-out labels."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollforward.llm import hard_negatives, phrases, rules

# ---- phrases ------------------------------------------------------------------------


def collocations_by_hand(rows, least, percent, most):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in frequent.items():
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in frequent.items()
                if len(q) > len(p)
            )
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], start=1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def phrase_rows(seed=3):
    random.seed(seed)
    words = ["New", "york", "City", "the", "of", "é\x1cx", "in", "a", "İx", "\x00"]
    texts = [
        "".join(random.choice(words) + random.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for _ in range(60))
        for _ in range(80)
    ]
    rows = [(i, t, random.choice(["en", "fr", None, "und"]), None) for i, t in enumerate(texts)]
    return rows + [(900, None, "en", None), (901, "", None, None), (902, "...", "xx", None), (903, "the of in " * 3000, "en", None)]


@pytest.mark.parametrize("budget", [100_000, 100, 3])
def test_collocations_equal_brute_force(documents, budget):
    rows = phrase_rows()
    found = phrases.collocations(documents(rows), least=5, percent=80, most=50, budget=budget)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == collocations_by_hand(rows, 5, 80, 50)


def test_stretches_and_crowded_cells_change_nothing(documents, monkeypatch):
    rows = phrase_rows(5)
    expected = collocations_by_hand(rows, 5, 80, 50)
    monkeypatch.setattr(phrases, "STRETCH", 300)
    monkeypatch.setattr(phrases, "cell_bits", lambda texts: 16)
    monkeypatch.setattr(phrases, "HITS", 1000)
    found = phrases.collocations(documents(rows), least=5, most=50)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_prefixes_stay_together_and_groups_near_the_budget(documents):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in np.minimum(rng.zipf(1.3, 60_000), 400)]
    stretch = phrases.Stretch("en", phrases.pa.array([w.encode() for w in words], phrases.pa.binary()))
    budget = 400
    grouping = phrases.Grouping(phrases.prefix_counts(stretch, phrases.BUCKETS), budget)
    full = np.full(1 << 17, 255, np.uint8)
    columns, n = phrases.suffixes(stretch, 20, full)
    group, length = grouping.of(phrases.prefix_hashes(stretch.hash, columns))
    assert n.sum() == len(words) and set(length) == {1, 2, 3, 4}
    groups_of, size_of = defaultdict(set), Counter()
    for line, g, k, times in zip(np.stack(columns).T.tolist(), group, length, n):
        prefix = tuple(line[:k])
        groups_of[prefix].add(g)
        size_of[prefix] += times
    assert all(len(g) == 1 for g in groups_of.values())
    assert all(s <= budget for p, s in size_of.items() if len(p) < 4)
    sizes = Counter()
    for g, times in zip(group, n):
        sizes[g] += times
    assert np.mean(list(sizes.values())) < budget and max(sizes.values()) < 3 * budget


def test_scores_are_exact_beyond_64_bits(spark):
    a, both = 9_000_000_000_000_000, 18_000_000_000_000_001
    row = spark.createDataFrame([(a, both)], "a long, both long").select(phrases.score_of(F.col("a"), F.col("both")))
    assert row.first()[0] == 2000000 * a // both


def test_no_words_no_phrases(documents):
    assert phrases.collocations(documents([])).count() == 0
    assert phrases.collocations(documents([(1, None), (2, " .\n")])).count() == 0


# ---- hard negatives -----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row string, angles string, score int"


def negatives_by_hand(rows, positives=5, negatives=5, percent=80):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    place = lambda i: (i is None, i or 0)
    out = []
    for i, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % 10:
            continue
        scored = [(-dot(v, w), place(o), o, other) for j, (o, w, other) in enumerate(kept) if j != i]
        same = sorted(s for s in scored if s[3] == label)[:positives]
        for p, _, positive, _ in same:
            inside = sorted(s for s in scored if s[3] != label and percent * -p <= 100 * -s[0] <= 100 * -p)
            for rank, (s, _, o, _) in enumerate(inside[:negatives], start=1):
                out.append((anchor, positive, rank, o, -p, -s))
    return Counter(out)


def vector_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(n):
        v = centres[i % 6] + rng.normal(size=12) * (0.1 if i % 3 else 1)
        rows.append((i, (v * rng.choice([0.1, 1, 4])).tolist(), int(rng.integers(0, 4))))
    bad = [
        (1001, None, 1), (1010, [1.0] * 12, None), (1020, [None, 1.0], 1), (1030, [math.nan, 1.0], 1),
        (1040, [math.inf], 1), (1050, [], 2), (1060, [0.0] * 12, 1), (1070, [1.0, 2.0], 3), (None, [1.0] * 12, 2),
    ]
    ties = [(2000 + i, [0.5] * 12, i % 2) for i in range(40)]
    again = [(10, rows[10][1], rows[10][2]), (2000, [0.5] * 12, 0)]
    return [(*r, "x", "y", 1) for r in rows + bad + ties + again]


@pytest.mark.parametrize("blocks", [(8192, 16384, 256), (7, 31, 5)])
def test_negatives_equal_brute_force(spark, monkeypatch, blocks):
    for name, size in zip(("ANCHORS", "ROWS", "TILE"), blocks):
        monkeypatch.setattr(hard_negatives, name, size)
    rows = vector_rows(260)
    found = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(tuple(r) for r in found.select(*columns).collect()) == negatives_by_hand(rows)


def test_bounds_hold_and_leave_tiles_out():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 16)) * 2

    def block(n):
        whole = np.floor((centres[rng.integers(0, 5, n)] + rng.normal(size=(n, 16)) * 0.05) * 256)
        made = object.__new__(hard_negatives.Block)
        made.row, made.vec_id, made.label = np.arange(n), np.arange(n), np.zeros(n, int)
        made.vector, made.norm = whole, np.linalg.norm(whole, axis=1)
        made.angles = hard_negatives.angles_to(whole, directions).astype(np.float32)
        return made

    directions = hard_negatives.pick_directions(np.floor(centres * 256), 5)
    anchors, rows = block(20), block(5000)
    tiles = hard_negatives.Tiles(rows)
    lower, upper = tiles.bounds(anchors)
    scores = anchors.vector @ rows.vector.T
    for t in range(len(tiles.starts)):
        part = scores[:, tiles.tile(t)]
        assert (part.min(axis=1) >= lower[:, t]).all() and (part.max(axis=1) <= upper[:, t]).all()
    fifth = np.sort(scores, axis=1)[:, -5]
    assert (upper < fifth[:, None]).mean() > 0.5


def test_scores_of_large_components_are_exact(spark):
    big = [(0, [3e6, 1.0], 0), (1, [3e6, 1.25], 0), (2, [3e6, 1.0], 1), (3, [2.9e6, 7.0], 1)]
    huge = [(10, [1e30], 0), (11, [1e30], 0), (12, [1e30], 1)]
    frame = spark.createDataFrame([(*r, "", "", 0) for r in big], VECTORS)
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0).collect()
    assert Counter(tuple(r) for r in found) == negatives_by_hand(big)
    frame = spark.createDataFrame([(*r, "", "", 0) for r in huge], VECTORS)
    assert hard_negatives.hard_negatives(frame, F.col("vec_id") % 10 == 0).first()["negative_score"] == 2**63 - 1


def test_no_vectors_no_negatives(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0], 1, "", "", 0)], VECTORS)
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 10 == 0).count() == 0


# ---- quality ------------------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int"


def quality_rows(n, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
        good = i % 4 > 0
        if not good:
            words = [w + "$$$" for w in words] if i % 8 else [words[0]] * len(words)
        rows.append((i, " ".join(words) + ".", "en", "q"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_of_held_out_rows(spark, documents):
    rows, labels = quality_rows(400)
    docs = documents(rows + [(1000, None), (1001, ""), (1002, "x " * 200_000), (None, "no id"), (5, rows[5][1])])
    labels += [(5, None, 0), (None, 1, 1), (77, 1, 0), (99999, 0, 0), (6, 7, 0)]
    training = F.col("doc_id") % 3 != 1
    found = rules.score(docs, spark.createDataFrame(labels, LABELS), training)
    assert found.columns == [c for c in docs.columns if c not in ("text", "score")] + ["score"]
    got = [(r["doc_id"], r["score"]) for r in found.collect()]
    assert len(got) == docs.count() and all(0 <= s <= 1 for _, s in got)
    held_out = [(i, s) for i, s in got if i is not None and i < 400 and i % 3 == 1]
    assert sum((s >= 0.5) == (i % 4 > 0) for i, s in held_out) / len(held_out) > 0.97


def test_the_column_equals_the_rules(spark):
    c = rules.Condition
    model = rules.Ensemble(0.25, {(c("words", True, 1.0),): 1.5, (c("digits", False, 0.1), c("lines", True, 0.5)): -2.0})
    rows = [(0.5, 0.0, 1.0), (2.0, 0.1, 0.5), (2.0, 0.05, 0.6)]
    frame = spark.createDataFrame(rows, ", ".join(f"{rules.PREFIX}{n} double" for n in ("words", "digits", "lines")))
    got = [r[0] for r in frame.select(model.column()).collect()]
    want = [0.25 + 1.5 * (w > 1) - 2 * (d <= 0.1 and n > 0.5) for w, d, n in rows]
    assert got == pytest.approx([1 / (1 + math.exp(-x)) for x in want])


def test_conditions_are_merged():
    c = rules.Condition
    got = rules.simplified([c("words", True, 1.0), c("words", True, 2.0), c("words", False, 5.0), c("words", False, 4.0)])
    assert got == (c("words", False, 4.0), c("words", True, 2.0))


def test_lasso_meets_its_optimality_conditions():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (500, 12)).astype(float)
    y = (rng.random(500) < 1 / (1 + np.exp(-(2 * x[:, 0] - 3 * x[:, 1])))).astype(float)
    intercept, w = rules.lasso(x, y, 0.02)
    slope = x.T @ (1 / (1 + np.exp(-(x @ w + intercept))) - y) / 500
    assert np.abs(slope[w == 0]).max() <= 0.0201
    assert slope[w != 0] == pytest.approx(-0.02 * np.sign(w[w != 0]), abs=1e-3)
    assert 0 < (w != 0).sum() < 12


def test_statistics_of_a_text():
    got = dict(zip(rules.STATISTICS, rules.describe("Ab ab ab 12 É$\nAb ab ab 12 É$\n!".encode())))
    assert got["characters"] == pytest.approx(math.log1p(31)) and got["words"] == pytest.approx(math.log1p(11))
    assert got["distinct_words"] == pytest.approx(5 / 11) and got["commonest_word"] == pytest.approx(4 / 11)
    assert got["echoed_words"] == pytest.approx(2 / 11) and got["repeated_lines"] == pytest.approx(1 / 3)
    assert got["letters"] == pytest.approx(14 / 31) and got["digits"] == pytest.approx(4 / 31)
    assert got["symbols"] == pytest.approx(2 / 31) and got["marked_words"] == pytest.approx(3 / 11)


@pytest.mark.parametrize("quality, score", [([], 0.5), ([1, 1], 1.0), ([0], 0.0)])
def test_labels_of_one_kind(spark, documents, quality, score):
    docs = documents([(0, "a b"), (1, "c"), (2, None)])
    labels = spark.createDataFrame([(i, x, 0) for i, x in enumerate(quality)], LABELS)
    assert [r["score"] for r in rules.score(docs, labels, F.lit(True)).collect()] == [score] * 3
    assert rules.score(documents([]), labels, F.lit(True)).count() == 0


def test_texts_that_look_alike(spark, documents):
    docs = documents([(i, "same text") for i in range(8)])
    labels = spark.createDataFrame([(i, int(i < 6), 0) for i in range(8)], LABELS)
    assert {round(r["score"], 6) for r in rules.score(docs, labels, F.lit(True)).collect()} == {0.75}
