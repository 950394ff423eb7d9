"""Language, mixing, extraction, archives, language model and fingerprints."""

import hashlib
import html
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rollforward.llm import class_lm, html_text, language_id, mixing, syncmers, warc

ROWS = [
    (1, "the cat and the dog", "en", "a"),
    (2, "the dog is in the house", "en", "b"),
    (3, "le chat et le chien", "fr", "a"),
    (4, "le chien est dans la maison", "fr", None),
    (5, None, "en", None),
    (6, "", None, "c"),
    (7, "123 !!", "en", "a"),
    (8, "the the the", None, "a"),
    (8, "the the the", None, "a"),
    (None, "maisonette", None, "b"),
]


def test_language_words_then_grams(documents):
    docs = documents(ROWS)
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    predicted = [(r["doc_id"], r["lang_pred"]) for r in found]
    assert Counter(predicted) == Counter(
        [(1, "en"), (2, "en"), (3, "fr"), (4, "fr"), (5, "und"), (6, "und"), (7, "und"), (8, "en"), (8, "en"), (None, "fr")]
    )
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = language_id.keep_identified(docs, language_id.fit(docs))
    assert kept.columns == docs.columns and kept.count() == 7
    assert language_id.identify(docs, language_id.Model({})).filter("lang_pred != 'und'").count() == 0


def test_language_scores_equal_a_word_by_word_sum():
    model = language_id.Model({"a": ["ab abc bca, cab", "xyz ab"], "b": ["bb bcd dcb zyx 1x"], "c": ["qq"]})
    model.CACHE, model.SLICE = 7, 5  # the cache is emptied in between

    def row(word):
        for (places, logs), items, weight in [
            (model.words, [word], 1),
            *[(model.grams[n], language_id.grams(word, n), language_id.BACKOFF) for n in (4, 3, 2, 1)],
        ]:
            found = [logs[places[i]] for i in items if i in places]
            if found:
                return weight * sum(found) / len(found)
        return [0, 0, 0]

    for text in ["ab ab, AB q 12", "bcd " * 9 + "zz abcd x1y é ñé", "Éé 99", "a b c d e f g h i j k l m n o p q", " "]:
        words = [w for w in map(language_id.letters, text.split()) if w]
        total = [sum(float(row(w)[i]) for w in words) for i in range(3)]
        name, score = model.scores(text)
        if not words:
            assert (name, score) == ("und", 0.0)
        else:
            assert name == "abc"[total.index(max(total))]
            assert score == pytest.approx(1 / sum(math.exp(t - max(total)) for t in total), rel=1e-4)


def test_language_sample_takes_the_smallest_hashes(documents):
    rows = [(i, f"text {i % 70}", "en" if i % 3 else "fr", None) for i in range(300)]
    docs = documents(rows)
    hashes = {r[0]: r[1] for r in docs.select("text", F.xxhash64("text")).distinct().collect()}
    for lang in ("en", "fr"):
        texts = {t for _, t, name, _ in rows if name == lang}
        expected = sorted(texts, key=hashes.get)[:9]
        found = language_id.sample(docs, 9).filter(F.col("lang") == lang).collect()
        assert sorted(r["text"] for r in found) == sorted(expected)


def test_mix_meets_targets(documents):
    rows = [(i, "w " * (1 + i % 7), None, "abc"[min(2, i % 20 // 9)]) for i in range(2000)]
    found = mixing.mix(documents(rows)).collect()
    taken, target = Counter(), {}
    for r in found:
        assert 0 <= r["times"] <= 3
        taken[r["source_size"]] += r["times"] * r["size"]
        target[r["source_size"]] = r["target"]
    for size, words in taken.items():
        assert abs(words - target[size]) <= 4
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in found))


def test_plans_of_a_mix_stay_small(documents, monkeypatch):
    """A step's plan does not hold those of the steps before it."""
    leaves, write = [], mixing.stage

    def counted(df, name):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return write(df, name)

    monkeypatch.setattr(mixing, "stage", counted)
    found = mixing.mix(documents([(i, "w " * (1 + i % 7), None, "ab"[i % 2]) for i in range(50)]))
    assert found.count() == 50 and max(leaves) <= 4


def test_mix_defined_results(documents):
    docs = documents(ROWS)
    assert mixing.mix(docs).count() == len(ROWS)
    assert mixing.mix(documents([])).count() == 0
    assert max(r["times"] for r in mixing.mix(docs, most=2).collect()) <= 2
    mixed = mixing.mixed_documents(docs)
    assert mixed.groupBy(*docs.columns).count().agg(F.max("count")).first()[0] <= 6  # two equal rows
    times = sum(r["times"] for r in mixing.mix(docs).collect())
    assert mixed.columns == docs.columns and mixed.count() == times


PAGE = (
    "<html><head><title>no</title><script>var x='<p>no</p>'</script></head><body><nav><a href=/>no</a></nav>"
    "<div class='cookie-notice'>no</div><article><h1>Head &amp; line</h1><p>One  two<br>three <b>fo</b>ur"
    "<p>Five &lt; 6 &#233;<form><input name=q>no</form><p>seven<!-- no --></article>"
    "<section id=comments><p>no no no</p></section><footer>no</footer></body></html>"
)


def test_main_text(pages):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "plain a < b"), (5, "u", PAGE.replace("article", "div")), (5, "u", "<p")]
    found = defaultdict(list)
    for r in html_text.extract(pages(rows)).collect():
        found[r["page_id"]].append(r["text"])
    text = "Head & line\n\nOne two three four\n\nFive < 6 é\n\nseven"
    assert found[1] == [text] and found[2] == [""] and found[3] == [""] and found[4] == ["plain a < b"]
    assert text in found[5]
    assert html_text.extract(pages([])).count() == 0


MENU = "<div class=q1><ul><li><a href=/a>Home page</a></li><li><a href=/b>All the news</a></li></ul></div>"
STORY = "<h1>A title</h1>" + "".join(
    f"<p>Part {i} tells <a href=/x>something</a> about rivers, <b>bridges</b> and the towns beside them.</p>" for i in range(6)
)
TOLD = "A title\n\n" + "\n\n".join(f"Part {i} tells something about rivers, bridges and the towns beside them." for i in range(6))


def page_of(content, label="article"):
    """A page whose boilerplate has one told class, `zz`, and otherwise no telling name."""
    return (
        f"<html><head><title>t</title></head><body>{MENU}<div class=zz>Buy seven of these now</div>"
        f"<{label}>{content}</{label}><div class=zz><p>All rights stay with us</p></div></body></html>"
    )


def word_scores(found, expected):
    shared = sum((Counter(found.split()) & Counter(expected.split())).values())
    return shared / max(len(found.split()), 1), shared / len(expected.split())


def test_main_text_learns_what_is_aside():
    labelled = [page_of(f"<h1>Some title</h1><p>{'word ' * n}</p><p>{'more ' * n}</p>") for n in range(5, 45)]
    weights = html_text.fit(labelled)
    assert weights.names["a"] < 0 and weights.names[".zz"] < 0 and "div" not in weights.names
    for label in ("article", "section"):  # also where no element tells the content
        assert html_text.main_text(page_of(STORY, label), weights) == TOLD
    inner = STORY.replace("<p>Part 3", "<div class='b zz'>Buy two</div><p>Part 3")
    assert html_text.main_text(page_of(inner), weights) == TOLD
    for flat in (html_text.Weights(names={}), html_text.Weights(names={}, tags=weights.tags)):
        assert html_text.main_text(page_of(inner), flat) != TOLD  # names and tags are learned, both needed


def test_main_text_on_held_out_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    pages = [r[0] for r in rows if r[0] and "<article>" in r[0]]
    weights, flat = html_text.fit(pages[::2]), html_text.Weights(names={})
    learned, plain = [], []
    for page in pages[1::2]:
        inside = re.search("<article>(.*)</article>", page, re.S)[1]
        expected = html.unescape(re.sub("<[^>]*>", " ", inside))
        learned.append(word_scores(html_text.main_text(page, weights), expected))
        plain.append(word_scores(html_text.main_text(page, flat), expected))
    assert min(min(x) for x in learned) >= 0.95
    assert min(p for p, _ in plain) < 0.95


@pytest.mark.parametrize(
    "kept",
    [
        '<h2 id="related-work">kept words</h2>',
        '<section id="search-methods"><p>kept words</p></section>',
        '<p data-id="share">kept words</p>',
        '<p title="hidden gem">kept words</p>',
        "<p data-note=hidden>kept words</p>",
        '<div class="story social-science"><p>kept words</p></div>',
        "<header><p>kept words</p></header>",
        "<ul><li>kept</li><li>words</li></ul>",
        "<p><a href=/x>kept words</a></p>",
    ],
)
def test_main_text_keeps_what_looks_like_an_aside(kept):
    weights = html_text.fit([page_of(STORY)] * 6)
    found = html_text.main_text(page_of(STORY + kept + STORY), weights)
    assert found.startswith(TOLD) and found.endswith(TOLD)
    assert found[len(TOLD) : -len(TOLD)].split() == ["kept", "words"]


@pytest.mark.parametrize("teaser", ["<div class=teaser><p>" + "Read more of it " * 20 + "</p></div>", MENU])
def test_main_text_stays_inside_its_edges(teaser):
    weights = html_text.fit([page_of(STORY)] * 6)
    for page in (teaser + f"<article>{STORY}</article>", f"<article>{STORY}</article>" + teaser):
        assert html_text.main_text(f"<body>{page}</body>", weights) == TOLD


@pytest.mark.parametrize("part", ["<a ", '<a b="', "<!x", "<div>", "<script", "<!--", "</p>", "<a href=x>"])
def test_main_text_of_hostile_pages_takes_linear_time(part):
    def took(n):
        page, start = part * (n // len(part)), time.process_time()
        html_text.main_text(page, html_text.Weights())
        return time.process_time() - start

    took(10_000)
    assert took(800_000) < 60 * max(took(80_000), 0.02)
    assert html_text.main_text("<a b='<p>text", html_text.Weights()).startswith("<a b='")


def test_archives_round_trip(pages):
    rows = [(1, "http://a/ b", "é" * 50), (2, None, "é" * 50), (3, "u", None), (4, "u", ""), (None, "u", "é" * 50), (9, "u", "x\r\n\r\ny")]
    index = warc.write_archives(pages(rows))
    found = {r["page_id"]: r for r in warc.read_records(index).collect()}
    assert all(r["intact"] for r in found.values())
    assert found[2]["html"] == "é" * 50 and found[9]["html"] == "x\r\n\r\ny" and found[4]["html"] == ""
    assert [found[i]["refers_to"] for i in (1, None, 3)] == [2, 2, 4]
    assert found[1]["payload_bytes"] == 100 and found[1]["record_type"] == "revisit"
    some = warc.read_records(index.filter("page_id = 9")).collect()
    assert [r["page_id"] for r in some] == [9]
    assert warc.write_archives(pages([])).count() == 0


def test_ranges_join_neighbours():
    assert list(warc.ranges([0, 10, 10_000_000], [10, 5, 7])) == [(0, 15, [0, 1]), (10_000_000, 10_000_007, [2])]


def test_language_model(documents, monkeypatch):
    monkeypatch.setattr(class_lm, "COMMON", 3)  # the other words go through the join
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    rows = [(i, "The cat saw a dog" if i % 2 else "le chien voit un Chat", None, None) for i in range(60)] + ROWS
    found = class_lm.score(documents(rows), held_out).collect()
    counts, n = Counter(), 0
    for i, text, *_ in rows:
        if zlib.crc32(str(i).encode() if i is not None else b"") % 7 != 2:
            words = (text or "").lower().split() + [0]
            counts.update(words)
            n += len(words)
    expected = Counter()
    for i, text, *_ in rows:
        words = (text or "").lower().split() + [0]
        base = sum(math.log10((counts[w] + 1) / (n + len(counts) + 1)) for w in words)
        expected[(i, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6))] += 1
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found)
    assert got == expected
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)


def test_rare_words_have_classes_of_their_own(documents, monkeypatch):
    monkeypatch.setattr(class_lm, "ITEM_WORDS", 2)
    monkeypatch.setattr(class_lm, "COMMON", 3)
    # both kinds of words end alike, and only their neighbours tell them apart
    texts = [f"the a{i}xing is b{j}xing" for i in range(6) for j in range(6)]
    rows = [(i, t, None, None) for i, t in enumerate([*texts, "the a1xing is b2xing", "the b2xing is a1xing"])]
    found = {r["doc_id"]: r for r in class_lm.score(documents(rows), F.col("doc_id") >= len(texts)).collect()}
    like, unlike = found[len(texts)], found[len(texts) + 1]
    assert abs(like["base_score"] - unlike["base_score"]) < 1e-9
    assert like["score"] > unlike["score"] + 0.5


def test_language_model_scores_as_its_classes_say(documents, monkeypatch):
    monkeypatch.setattr(class_lm, "ITEM_WORDS", 3)
    monkeypatch.setattr(class_lm, "COMMON", 9)
    monkeypatch.setattr(class_lm, "CHUNK", 50)
    made = {}

    def kept(name):
        original = getattr(class_lm, name)

        def wrapped(*args):
            made[name] = args, original(*args)
            return made[name][1]

        monkeypatch.setattr(class_lm, name, wrapped)

    for name in ("cluster", "class_of_words", "transition_logs"):
        kept(name)
    texts = [" ".join(f"w{min(i * j % 41, (i + j) % 17)}" for j in range(1, i % 13 + 2)) for i in range(80)]
    rows = [(i, t, None, None) for i, t in enumerate(["", None, *texts, "w1 news w2 olds w1news"])]
    found = class_lm.score(documents(rows), F.col("doc_id") > 70).collect()
    words = {bytes(r["word"]): (r["n"], r["class"]) for r in made["class_of_words"][1].collect()}
    bigrams, counts = Counter(), Counter()
    for i, text, *_ in rows[:71]:
        path = [0, *[words[w.encode()][1] for w in (text or "").split()], 0]
        bigrams.update(zip(path, path[1:]))
        counts.update((text or "").split())
    assert {w: n for w, (n, _) in words.items()} == {w.encode(): n for w, n in counts.items()}
    table = made["cluster"][1][2]
    assert {(a, b): table[a, b] for a, b in zip(*table.nonzero())} == bigrams
    assert len({c for _, c in words.values()}) > 3
    logs, otherwise = made["transition_logs"][1], made["transition_logs"][0][1][1:].argmax() + 1
    by_ending = {}
    for word, (_, c) in words.items():
        by_ending.setdefault(word[-4:], Counter())[c] += 1
    for row in found:
        path, emitted = [0], math.log10(71 + 1)
        for w in (rows[row["doc_id"]][1] or "").encode().split():
            n, c = words.get(w, (0, None))
            if c is None:
                seen = by_ending.get(w[-4:], {otherwise: 1})
                c = min(seen, key=lambda x: (-seen[x], x))
            emitted += math.log10(n + 1)
            path.append(c)
        expected = emitted + sum(logs[a, b] for a, b in zip(path, [*path[1:], 0]))
        assert abs(row["score"] - expected) < 1e-6, row


def test_language_model_on_nothing(documents):
    assert class_lm.score(documents([]), F.lit(False)).count() == 0


def test_fingerprints_follow_the_order(documents):
    rows = [(5, "abc def ghi jkl mno pqr"), (3, None), (3, "zz"), (9, "xy" * 3000), (None, "last one"), (1, "xy" * 3000)]
    found = syncmers.fingerprints(documents(rows)).collect()
    ordered = [9, 5, 3, 3, 1, None]
    by_id = {r["doc_id"]: r for r in found}
    assert sorted(map(str, ordered)) == sorted(str(r["doc_id"]) for r in found)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert by_id[9]["edited_sha256"] == sha("xy" * 1500 + "abc def ghi jkl mno pqr")
    assert by_id[1]["edited_sha256"] == sha("xy" * 1500 + "last one")
    assert by_id[None]["edited_sha256"] == sha("lastxyxy")
    assert by_id[9]["fingerprint"] == by_id[1]["fingerprint"]
    assert syncmers.fingerprints(documents([])).count() == 0


def test_syncmers_do_not_depend_on_context():
    text = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(400))
    a, b = syncmers.anchors(text), syncmers.anchors("prefix " + text)
    assert syncmers.likeness(a, b) > 0.8 and syncmers.likeness(a, a) == 1
    assert syncmers.likeness(a, syncmers.anchors("")) == 0
