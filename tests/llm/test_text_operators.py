"""Toxicity, quality, extraction, fingerprints, decontamination: small fixtures and brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.llm import decontaminate, fingerprint, html_extract, quality, toxicity

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def words():
    rng = np.random.default_rng(5)
    return ["".join(rng.choice(list("abcdefghijklmnoprstu"), rng.integers(3, 9))) for _ in range(400)]


def test_lexicon_folds_spares_and_normalises():
    lexicon = toxicity.Lexicon({toxicity.fold("idiot"): 5.0, toxicity.fold("clown"): 4.0, toxicity.fold("vequ") + "*": 3.0}, [toxicity.fold("clown fish")])
    assert lexicon.hits("An 1d10t, an IDІOT and an idiot.") == (15.0, 3)
    assert lexicon.hits("a clown fish swims") == (0, 0)
    assert lexicon.hits("clown fishing") == (4.0, 1)
    assert lexicon.hits("idiotic antivequ vequété") == (3.0, 1)
    assert lexicon.score(None) == lexicon.score("") < 0.5
    short, long = lexicon.score("idiot here"), lexicon.score("idiot here" + " word" * 500)
    assert short > long


def test_toxicity_learns_held_out_words(spark, words):
    rng = np.random.default_rng(1)
    bad = ["grimbo", "slarty", "vexu"]
    rows, labels = [], []
    for i in range(400):
        text = list(rng.choice(words, 60))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                b = str(rng.choice(bad))
                text[rng.integers(0, 60)] = b + (str(rng.choice(words)) if b == "vexu" else "")
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic), 1))
    rows += [(400, None), (401, ""), (402, "x " * 50_000)]
    docs, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    fold = toxicity.hashed_remainder("doc_id", 5)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, lab, train=fold != 0)).collect()}
    held = [r["doc_id"] for r in lab.filter(fold == 0).collect()]
    assert np.mean([(scored[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.97
    assert scored[400] == scored[401] < 0.5 and all(0 <= s <= 1 for s in scored.values())
    assert toxicity.fit(docs, lab.filter("toxic = 2")).entries == {}


def test_network_gradient_and_accuracy(spark, words):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(300):
        text = " ".join(rng.choice(words, rng.integers(1, 200)))
        if i % 3 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(i % 3 != 0)))
    docs, lab = spark.createDataFrame(rows + [(300, None), (301, ""), (302, "A" * 300_000)], DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    net = quality.fit(docs, lab, keep=F.col("doc_id") % 4 != 2)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, net).collect()}
    assert np.mean([(scored[i] >= 0.5) == (i % 3 != 0) for i in range(2, 300, 4)]) > 0.95
    assert scored[300] == scored[301] and all(0 <= s <= 1 for s in scored.values())


@pytest.mark.parametrize("order", ["first", "shares"])
def test_both_labels_have_their_bytes(spark, order, monkeypatch):
    """A text over the budget that comes first in the order, and a rare label among many longer texts."""
    ids = [r["i"] for r in spark.range(140).select(F.col("id").alias("i")).orderBy(F.xxhash64("i")).collect()]
    texts = {i: "text " * 60 for i in ids}
    if order == "first":
        texts[ids[0]] = "long " * 5000
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    labels = spark.createDataFrame([(i, int(n < 120)) for n, i in enumerate(ids)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 20_000)
    real = quality.train
    monkeypatch.setattr(quality, "train", lambda t, y: seen.append((t, y)) or real(t[:4], y[:4], epochs=1))
    quality.fit(docs, labels)
    (used, y), = seen
    assert sum(map(len, used)) <= 20_000 and max(map(len, used)) == 300
    assert (y == 0).sum() == 20 and (y == 1).sum() == 14000 // 300


def test_chunks_cover_the_whole_text():
    data = np.frombuffer(("a" * 5000 + "!!!!!!!!").encode(), np.uint8)
    net = quality.Network(np.zeros((quality.WIDTH, 64, quality.FILTERS), np.float32), np.zeros(quality.FILTERS, np.float32), np.ones(quality.FILTERS, np.float32), 0.0)
    net.weights[:, quality.CLASS[ord("!")]] = 1
    chunk, _ = quality.pooled(net, quality.layout(data, np.array([0, len(data)])))
    assert chunk[-1].max() >= 6 and chunk[0].max() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no";</script></head><body><nav><ul><li><a href="/x">Home</a></li></ul></nav>
<div class="ad">Buy {n} things now please</div><article><h1>Head &amp; tail</h1><p><b>First   part<br>goes on.<p>Second &#233; part{n}.</p><aside>not this</aside></article><div class="comments"><p>nice post</p></div><footer>&copy; us</footer></body></html>"""


def test_extraction_finds_the_article(spark):
    pages = spark.createDataFrame([(i, "u", PAGE.replace("{n}", str(i))) for i in range(6)] + [(6, "u", None), (7, "u", ""), (8, "u", "<p>loose words only</p>"), (9, "u", "<!-- open")], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages, html_extract.fit(pages)).collect()}
    assert got[3] == "Head & tail\n\nFirst part goes on.\n\nSecond é part3."
    assert got[6] == got[7] == got[9] == "" and got[8] == "loose words only"


def test_best_region_is_the_brute_force_one():
    rng = np.random.default_rng(0)
    weights = html_extract.Weights({"w": 1.0}, {"open t": 1.5})
    for _ in range(200):
        page = [("words", "w", "x " * rng.integers(1, 4)) if rng.random() < 0.5 else ("open", "t", "t") for _ in range(rng.integers(1, 12))]
        value = [weights.of(*t) for t in page]
        best = max(sum(value[i:j]) for i in range(len(page)) for j in range(i, len(page) + 1))
        i, j = html_extract.region(page, weights)
        assert sum(value[i:j]) == pytest.approx(max(best, 0))


def test_fingerprints(spark):
    texts = {1: "One. Two three. Four!\nFive six seven. Eight.", 5: "One. Two three. Four!\nFive six seven. Eight.", 70: None, 900: "", 901: "ö" * 1000, 5000: "Nine ten."}
    docs = spark.createDataFrame([(k, v, "x") for k, v in texts.items()] + [(5000, "A twin id.", "x")], DOCS + ", next_text string")
    got = sorted(fingerprint.compare_edited(docs).collect(), key=lambda r: (r["doc_id"], r["n_chars"]))
    rows = [(k, texts[k] or "") for k in sorted(texts)]
    rows.insert(5, (5000, "A twin id."))
    for i, (k, t) in enumerate(rows):
        follow = rows[(i + 1) % len(rows)][1]
        h = len(t) // 2
        own = [r for r in got if r["doc_id"] == k and r["n_chars"] == len(t)]
        assert hashlib.sha256((t[: len(t) - h] + follow[:h]).encode()).hexdigest() in {r["edited_sha256"] for r in own}
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in own)
    prints = {r["doc_id"]: r for r in got}
    assert prints[1]["fingerprint"] == prints[5]["fingerprint"] and prints[1]["near_next"] == 1.0
    assert prints[70]["fingerprint"] == prints[900]["fingerprint"] != prints[901]["fingerprint"]


def test_edits_are_located(spark):
    a = "".join(f"Sentence number {i} stands here. " for i in range(60))
    b = a.replace("number 31 stands", "number 31 falls")
    df = spark.createDataFrame([(a, b)], "a string, b string").select(*[fingerprint.fingerprint(fingerprint.paragraphs(F.col(c))).alias(c) for c in "ab"])
    row = df.select(fingerprint.edits(F.col("a"), F.col("b")).alias("e"), fingerprint.edits(F.col("a"), F.col("a")).alias("same")).first()
    assert row["e"] == [31] and row["same"] == []


def test_decontamination_tolerates_substitutions(spark, words):
    rng = np.random.default_rng(3)
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate((40, 25, 15, 9, 6))] + [(5, None), (6, "")]
    rows, expect = [], set()
    for d in range(60):
        text = list(rng.choice(words, 120))
        if d % 3 == 0:
            i = d // 3 % 5
            passage = items[i][1].split()
            if i < 3:
                for p in range(4, len(passage), 7):
                    passage[p] = "swap"
            text[30 : 30 + len(passage)] = passage
            expect.add((d, i))
        rows.append((d, " ".join(text).title() if d % 2 else ", ".join(text), "z"))
    rows += [(60, None, "z"), (61, "", "z"), (62, " ".join(rng.choice(words, 30_000)), "z"), (0, rows[0][1], "z")]
    docs = spark.createDataFrame(rows, DOCS + ", start string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expect
    assert {r["start"] for r in got} == {30}
    decontaminate.MOST_SEEDS, kept = -1, decontaminate.MOST_SEEDS
    try:
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == expect
    finally:
        decontaminate.MOST_SEEDS = kept
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {r[0] for r in rows} - {d for d, _ in expect}
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0 and decontaminate.overlaps(docs.limit(0), bench).count() == 0


def test_an_item_in_the_middle_of_nothing_alike_is_left_alone(spark, words):
    bench = spark.createDataFrame([(0, " ".join(words[:40]))], "item_id long, text string")
    docs = spark.createDataFrame([(0, " ".join(words[:8] + words[100:140])), (1, " ".join(words[40:90]))], DOCS)
    assert decontaminate.overlaps(docs, bench).count() == 0


def unseen(least, masks, most=None):
    """Equal (1) and other (0) tokens of a segment that counts with least equal ones, of at most most tokens, where no mask
    lies upon equal ones alone; None if there is no such segment. All substitutions are gone through as states of the score,
    its maximum, the equal tokens and the last tokens; what stands before a segment can only add seeds."""
    shapes = [(int(m, 2), len(m)) for m in masks]
    width = max(n for _, n in shapes)
    seen, states = set(), [(0, 0, 0, 0, 0, "")]
    while states:
        score, best, equal, last, n, path = states.pop()
        for x in (0, 1) if n != most else ():
            s, e, bits, size = score + (1 if x else -2), min(least, equal + x), (last << 1 | x) & ((1 << width) - 1), n + 1
            if s <= 0 or any(size >= k and bits & m == m for m, k in shapes):
                continue
            if s > best and e >= least:
                return path + str(x)
            state = (s, max(best, s), e, bits, size if most else min(size, width))
            if state not in seen:
                seen.add(state)
                states.append((*state, path + str(x)))
    return None


def test_no_overlap_is_without_a_seed():
    assert unseen(13, ("1101100111", "1110011011"))  # the search finds what is missed
    span = max(map(len, decontaminate.MASKS))
    for n in range(span, 16):
        assert unseen(-(-4 * n // 5), decontaminate.MASKS, n) is None
    assert unseen(13, decontaminate.MASKS) is None


def test_decontamination_finds_regular_substitutions(spark, words):
    items = [(0, words[:50]), (1, words[50:60]), (2, words[60:75]), (3, words[75:85])]
    swaps = [(0, range(k, 50, 5)) for k in range(5)] + [(1, [0]), (1, [9]), (2, [4, 6]), (3, [3, 6]), (3, [0, 5]), (3, [2, 5])]
    rows = [(d, " ".join(words[200:220] + ["swap" if p in at else w for p, w in enumerate(items[i][1])] + words[230:250])) for d, (i, at) in enumerate(swaps)]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == {(d, i) for d, (i, _) in enumerate(swaps)}


@pytest.mark.parametrize("n", range(1, 17))
def test_every_substitution_leaves_a_seed(n):
    """Items of up to 16 tokens: whichever tokens are others, as long as enough are equal, a mask shows only equal ones."""
    from itertools import combinations

    equal = min(decontaminate.LEAST, -(-n * 8 // 10))
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.masks_for(n)]
    for gone in combinations(range(n), n - equal):
        assert any(all(p + i < n and p + i not in gone for i in ones) for ones in masks for p in range(n - max(ones)))


def test_decontamination_is_brute_force(spark, words, monkeypatch):
    rng = np.random.default_rng(8)
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate([1, 3, 5, 7, 9, 10, 11, 12, 14, 15, 16])] + [(None, " ".join(rng.choice(words, 12))), (4, " ".join(rng.choice(words, 13)))]
    docs = []
    for i in range(300):
        t = [str(x) for x in rng.choice(words, 30)]
        own = items[rng.integers(0, len(items))][1].split()
        for at in rng.integers(0, len(own), rng.integers(0, 4)):
            own[at] = "other"
        at = rng.integers(0, 20)
        docs.append((i if i % 50 else None, " ".join(t[:at] + own + t[at:]) if i % 4 else " ".join(t), i))
    docs += [(500, None, 500), (501, "", 501)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _rid int")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def best(text, item):
        a, b = (text or "").split(), item.split()
        return max((sum(0 <= s + j < len(a) and a[s + j] == w for j, w in enumerate(b)) for s in range(-len(b), len(a))), default=0)

    need = lambda b: min(13, -(-len(b.split()) * 8 // 10))
    want = sorted((str(d), str(i), best(t, b)) for d, t, _ in docs for i, b in items if best(t, b) >= need(b))
    for most in (decontaminate.MOST_SEEDS, 0):
        monkeypatch.setattr(decontaminate, "MOST_SEEDS", most)
        assert sorted((str(r["doc_id"]), str(r["item_id"]), r["n_equal"]) for r in decontaminate.overlaps(frame, bench).collect()) == want
    hit = {k for d, t, k in docs if any(best(t, b) >= need(b) for _, b in items)}
    kept = decontaminate.decontaminate(frame, bench)
    assert kept.columns == frame.columns and {r["_rid"] for r in kept.collect()} == {k for _, _, k in docs} - hit
    assert decontaminate.overlaps(frame.limit(0), bench).count() == decontaminate.overlaps(frame, bench.limit(0)).count() == 0


def test_extraction_loses_nothing_of_an_article(spark):
    rng = np.random.default_rng(12)
    say = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(n))
    asides = ['<div class="ad">{}</div>', '<aside>{}</aside>', '<div class="cookie-notice"><p>{}</p></div>', '<form><label>{}</label></form>', '<script>var x="{}";</script>', '<!-- {} -->', '<section id="comments"><p>{}</p></section>']
    held = ['<div class="share-prices"><p>{}</p></div>', '<blockquote class="notice-of-meeting">{}</blockquote>', "<p>{}</p>", "<ul><li>{}</li></ul>", "<h2>{} &amp; more</h2>"]
    pages, expect = [], []
    for i in range(120):
        body, blocks = "", []
        for _ in range(rng.integers(2, 7)):
            if rng.random() < 0.3:
                body += asides[rng.integers(0, len(asides))].format(say(rng.integers(1, 9)))
            text = say(rng.integers(3, 70))
            kind = held[rng.integers(0, len(held))]
            body += kind.format(text)
            blocks.append(text + (" & more" if "&amp;" in kind else ""))
        top = f"<header><a>{say(3)}</a></header><nav><ul><li><a>{say(1)}</a></li></ul></nav>" + (f'<div class="box7">{say(8)}</div>' if i % 2 else "")
        pages.append((i, f"<html><head><title>{say(3)}</title></head><body>{top}<article>{body}</article><div class=\"box7\">{say(5)}</div><footer>{say(6)}</footer></body></html>"))
        expect.append("\n\n".join(blocks))
    pages += [(200, None), (201, ""), (202, "<p>"), (203, pages[0][1])]
    frame = spark.createDataFrame(pages, "page_id long, html string").repartition(3)
    weights = html_extract.fit(frame)
    assert "box7" in weights.asides
    got = {r["page_id"]: r["text"] for r in html_extract.extract(frame, weights).collect()}
    assert got == {**dict(enumerate(expect)), 200: "", 201: "", 202: "", 203: expect[0]}
    assert html_extract.extract(frame.limit(0), html_extract.fit(frame.limit(0))).count() == 0


@pytest.mark.parametrize("step", [1, 3, 100_003])
def test_next_texts(spark, step):
    texts = [f"t{i}" if i % 7 else None for i in range(700)]
    docs = spark.createDataFrame([(step * i - 50, t) for i, t in enumerate(texts)], DOCS).repartition(3)
    got = {r["doc_id"]: r["next_text"] for r in fingerprint.with_next(docs).collect()}
    assert got == {step * i - 50: texts[(i + 1) % 700] or "" for i in range(700)}


def test_near_values_are_brute_force(spark):
    rng = np.random.default_rng(6)
    lines = ["".join(rng.choice(list("abcdef "), 30)) + "." for _ in range(40)]
    texts = ["".join(rng.choice(lines, rng.integers(0, 12))) for _ in range(60)] + ["", "x", "x"]
    rows = {r["doc_id"]: r for r in fingerprint.compare_edited(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}

    def leaves(t):
        import re

        return re.findall(r"[^.!?\n]{1,64}[.!?\n]*|[.!?\n]+", t)

    def like(a, b):
        if leaves(a) == leaves(b):
            return 1.0
        x, y = set(leaves(a)), set(leaves(b))
        weigh = lambda s: sum(min(len(v), 255) for v in s)
        return 2 * weigh(x & y) / (weigh(x) + weigh(y))

    for i, t in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        r = rows[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_next"] == pytest.approx(like(t, after)) and r["near_edited"] == pytest.approx(like(t, edited))
    assert rows[61]["fingerprint"] == rows[62]["fingerprint"] != rows[60]["fingerprint"]
