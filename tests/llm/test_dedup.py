"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollforward.llm import exact_dedup, minhash, substring_dedup
from rollforward.sources.snapshots import shared_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [
    (None, None),
    (7, None),
    (8, ""),
    (9, " \t\n"),
    (10, "one"),
    (10, "one"),
    (None, "one"),
    (11, "ONE"),
    (12, "a b c"),
    (13, "a  b c"),
    (14, "é x"),
]


def corpus(seed, docs=60, vocabulary=300):
    """Random texts with copies, edited copies and passages that several texts share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(docs):
        text = [rng.choice(words) for _ in range(rng.randint(1, 160))]
        kind = rng.random()
        if rows and kind < 0.3:
            text = rng.choice(rows)[1].split()
            for _ in range(rng.choice((0, 0, 1, 2, 6))):
                text[rng.randrange(len(text))] = rng.choice(words)
        elif kind < 0.5:
            at = rng.randint(0, len(text))
            text[at:at] = passage[: rng.randint(30, 60)]
        elif kind < 0.55:
            text = ["same"] * rng.randint(30, 90)
        rows.append((100 + i, " ".join(text)))
    return rows


@pytest.fixture
def index(spark):
    return exact_dedup.DigestIndex(spark, f"index_{uuid.uuid4().hex}", shared_dir(spark, "index"), 4)


def exact(docs, index, batch="b"):
    found = exact_dedup.deduplicate(exact_dedup.digest_rows(docs), index, batch)
    return [tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]


def test_exact_dedup_equals_brute_force(documents, index):
    rows = EDGE + corpus(1) + [(500 + i, t + " ") for i, t in corpus(1)[:20]]
    found = exact(documents(rows), index)
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    expected = Counter()
    for t, members in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        best = min(members)
        for place, member in enumerate(sorted(members)):
            expected[(member[3], best[3], len(members), place == 0, sha)] += 1
    assert Counter(found) == expected


def test_index_remembers_batches_and_repeats_them(documents, index):
    first = exact(documents([(1, "a"), (2, "b")]), index, "one")
    second = [(3, "b "), (4, "c"), (5, "c")]
    once = exact(documents(second), index, "two")
    assert sorted(r[:4] for r in first) == [(1, 1, 1, True), (2, 2, 1, True)]
    assert sorted(r[:4] for r in once) == [(3, 2, 1, False), (4, 4, 2, True), (5, 4, 2, False)]
    assert sorted(exact(documents(second), index, "two")) == sorted(once)
    assert index.entries().count() == 3


def test_index_is_read_without_exchange(documents, index, spark):
    exact(documents([(1, "a")]), index, "one")
    candidates = exact_dedup.representatives(exact_dedup.digest_rows(documents([(2, "b")])))
    plan = candidates.join(index.entries().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("SortMergeJoin") :]
    assert below.count("Exchange") == 1


def test_drop_copies_keeps_columns(documents, index):
    docs = documents(EDGE)
    kept = exact_dedup.drop_copies(docs, index, "b")
    assert kept.columns == docs.columns
    texts = [re.sub(r"\s", "", r["text"] or "") for r in kept.collect()]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in EDGE} - {"é x"} | {"éx"})


def near_brute(rows, k, percent):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for _, t in rows:
        words = WORD.findall(lower(t))
        n = min(k, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(doc_id, ids.get(find(i), doc_id))
    return [
        (rows[i][0], len(sets[i]), ids.get(find(i)) if sets[i] else rows[i][0]) for i in range(len(rows))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(documents, seed):
    rows = EDGE + corpus(seed, 150)
    # a chain of edits: neighbours are alike, the ends are not
    chain = [f"c{i}" for i in range(100)]
    for i in range(30):
        chain[3 * i] = f"d{i}"
        rows.append((1000 + i, " ".join(chain)))
    found = minhash.near_duplicates(documents(rows), 4, 80)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == Counter(near_brute(rows, 4, 80))


def test_large_groups_of_edited_copies_equal_brute_force(documents, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows, origin = [], [rng.choice(words) for _ in range(90)]
    for i in range(120):
        text = list(rows[rng.randrange(len(rows))][1].split() if rows and rng.random() < 0.2 else origin)
        for _ in range(rng.choice((0, 1, 2, 3, 4, 5, 8))):
            text[rng.randrange(len(text))] = rng.choice(words[:6])
        rows.append((i, " ".join(text[: len(text) - rng.choice((0, 0, 0, 5, 12))])))
    found = minhash.near_duplicates(documents(rows), 4, 80)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert got == Counter(near_brute(rows, 4, 80))


def test_drop_near_copies_keeps_one_of_each(documents):
    rows = EDGE + corpus(3)
    docs = documents(rows)
    kept = minhash.drop_near_copies(docs, 5, 80)
    assert kept.columns == docs.columns
    brute = near_brute(rows, 5, 80)
    full = [(b[2], None) if b[1] else ("empty", r) for b, r in zip(brute, rows)]
    assert kept.count() == len(set(full))


def test_components_are_the_smallest_nodes_and_plans_stay_small(spark, monkeypatch):
    """No plan reads what was written before it more than a few times."""
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 330)]
    edges += edges[:20] + [(b, a) for a, b in edges[20:40]]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    leaves, write = [], minhash.stage

    def counted(df, name):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return write(df, name)

    monkeypatch.setattr(minhash, "stage", counted)
    found = {r["node"]: r["root"] for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in root if find(n) != n}
    assert leaves and max(leaves) <= 2


def test_estimate_is_corrected_for_chance(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 1 << 63, 4000, np.uint64), rng.integers(0, 1 << 63, 4000, np.uint64)
    half = np.concatenate([a[:2000], b[:2000]])
    signs = [minhash.packed(minhash.minima(x)).view(np.int64).tolist() for x in (a, b, half)]
    row = spark.createDataFrame([signs], "a array<long>, b array<long>, h array<long>")
    same, none, third = row.select(
        minhash.estimate(F.col("a"), F.col("a")),
        minhash.estimate(F.col("a"), F.col("b")),
        minhash.estimate(F.col("a"), F.col("h")),
    ).first()
    assert same == 1 and abs(none) < 0.2 and abs(third - 1 / 3) < 0.2


def repeats_brute(rows, window):
    texts = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window,k", [(35, 8), (12, 5)])
def test_repeats_equal_brute_force(documents, window, k):
    rows = EDGE + corpus(4, 120) + [(900, " ".join(f"x{i % 50}" for i in range(5000)))]
    found = substring_dedup.remove_repeats(documents(rows), window, k).drop("kept_text")
    assert Counter(map(tuple, found.collect())) == repeats_brute(rows, window)


def test_empty_tables(documents, index):
    docs = documents([])
    assert exact(docs, index) == []
    assert minhash.near_duplicates(docs).count() == 0
    assert substring_dedup.remove_repeats(docs).count() == 0
