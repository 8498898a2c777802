import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import messy, nothing, prose, rows_of  # noqa: F401
from pyspark.sql import functions as F

from simsearch.llm import decontamination, html_text, language_id, lm_scoring, lm_words, mixing, token_counts
from simsearch.llm.words import Words, mix
from simsearch.llm.workload import remainder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

tokenizers = pytest.mark.skipif(
    not __import__("os").path.isdir(token_counts.TOKENIZERS), reason="no tokenizer files"
)


# token counts


@tokenizers
def test_histogram_answers_every_limit(messy, nothing):
    encoding = token_counts._encoding(*token_counts.load_vocabulary())
    lengths = sorted(len(encoding.encode_ordinary(t or "")) for _, t in rows_of(messy))
    histogram = token_counts.length_histogram(messy)
    rows = {r.n_tokens: r for r in histogram.collect()}
    assert sum(([n] * rows[n].documents for n in sorted(rows)), []) == lengths
    for n, r in rows.items():
        longer = [x for x in lengths if x >= n]
        assert (r.documents_at_least, r.tokens_at_least) == (len(longer), sum(longer))
        assert r.truncated_tokens == sum(min(x, n) for x in lengths)
        assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    for r in token_counts.at_limits(histogram, [0, 17, 128, 10**6]).collect():
        assert r.tokens_kept == sum(min(x, r.limit) for x in lengths)
        assert r.tokens_lost == sum(max(0, x - r.limit) for x in lengths)
        assert (r.documents_fit, r.documents_cut) == (
            sum(x <= r.limit for x in lengths), sum(x > r.limit for x in lengths))
    assert token_counts.length_histogram(nothing).count() == 0


def test_suffix_sums_over_many_blocks(spark):
    counts = [(n * 37, n % 5 + 1) for n in range(400)]
    frame = spark.createDataFrame([(n, d, n * d) for n, d in counts], "n_tokens long, documents long, tokens long")
    got = {r.n_tokens: (r.documents_at_least, r.tokens_at_least) for r in
           token_counts.with_suffix_sums(frame).collect()}
    assert got == {n: (sum(d for m, d in counts if m >= n), sum(m * d for m, d in counts if m >= n))
                   for n, _ in counts}


@tokenizers
@pytest.mark.parametrize("char", [" ", "\t", "\r", "\n", "\u00a0", "\u3000"])
def test_long_white_space(char):
    encoding = token_counts._encoding(*token_counts.load_vocabulary())
    for n in (1000, 1001, 5000):
        for text in (f"ab{char * n}cd", f"{char * n}cd", f"ab{char * n}", char * n, f"a {char * n}, {char * n}b"):
            assert token_counts.encoded_length(encoding, text) == len(encoding.encode_ordinary(text))
    mixed = "one" + " \n" * 3000 + "\t two"
    assert token_counts.encoded_length(encoding, mixed) == len(encoding.encode_ordinary(mixed))
    # As long a run is one piece, encoded by itself: its last character goes with what follows.
    run, long = 3_000_000, encoding._encode_single_piece
    want = len(long(("x" * 3).encode())) + len(long((char * (run - 1)).encode()))
    want += len(encoding.encode_ordinary(char + "yes"))
    assert token_counts.encoded_length(encoding, "xxx" + char * run + "yes") == want


# language model


def base_by_hand(rows):
    tokens = [WORD.findall((t or "").translate(LOWER)) + [None] for _, t in rows]
    held = [d is None or zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (d, h, len(ws), sum(counts[w] > 0 for w in ws), total,
         round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws), 6))
        for (d, _), h, ws in zip(rows, held, tokens)
    ]


@pytest.mark.parametrize("head", [1 << 20, 50, 0])
def test_base_scores_equal_brute_force(messy, monkeypatch, head):
    monkeypatch.setattr(lm_scoring, "HEAD", head)
    got = lm_scoring.score_texts(messy, remainder(10) == 0).collect()
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(rows, key=repr) == sorted(base_by_hand(rows_of(messy)), key=repr)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 for r in got)


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = [(i, prose(i, 150, ["en", "de", "es"][i % 3])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [r for r in lm_scoring.score_texts(docs, remainder(10) == 0).collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.1 * sum(r.n_tokens for r in got)


def test_class_probabilities_add_up():
    weights = lm_scoring.Weights()
    weights.table[:] = np.random.default_rng(0).normal(size=weights.table.shape)
    rows = weights.log_probabilities(np.arange(0, lm_scoring.CLASSES**2, 777))
    assert np.allclose(np.exp(rows).sum(axis=1), 1)


def spread(x):
    return int(mix(np.array([x % 2**64], np.uint64))[0])


def score_by_hand(rows, held, classes, weights, model, total):
    """Scores with one Python loop per decision, counts in dictionaries, from the trained weights."""
    odd = int(lm_words._ODD)
    end, own = int(lm_scoring.END), lm_scoring.END_CLASS
    bits = lm_words.table_bits(total)

    def tokens_of(text):
        found = []
        for word in WORD.findall((text or "").translate(LOWER)):
            one = Words(pa.array([word]))
            k = int(classes(one.hashes(), lm_scoring._endings(one))[0])
            found.append((int(one.hashes()[0]), k))
        return [*found, (end, own)]

    def decisions(tokens, i):
        (word, k), (one, _), (two, _) = tokens[i], tokens[i - 1] if i else (end, 0), tokens[i - 2] if i > 1 else (end, 0)
        keys = [spread(one + odd), spread(two + int(lm_words._EVEN)), spread(one * odd + spread(two))]
        yield 0, [key >> (64 - bits[0]) for key in keys], k
        if k > own:
            low = word % 256
            for number, context, outcome in ((1, 17 * k, low % 16), (2, 17 * k + 1 + low % 16, low // 16)):
                yield number, [spread(key + odd * context) >> (64 - bits[1]) for key in keys], outcome

    texts = [tokens_of(t) for _, t in rows]
    words, seen = Counter(), Counter()
    for tokens, out in zip(texts, held):
        if not out:
            words.update(tokens)
            for i in range(len(tokens)):
                for number, places, outcome in decisions(tokens, i):
                    seen.update((min(number, 1), place, outcome) for place in places)
    within = {(k, low): 0.1 + sum(c + 0.1 for (w, j), c in words.items() if j == k and w % 256 == low)
              for k in range(own + 1, lm_scoring.CLASSES) for low in range(256)}
    scores = []
    for tokens in texts:
        score = 0.0
        for i, (word, k) in enumerate(tokens):
            before = [tokens[j][1] if j >= 0 else own for j in (i - 1, i - 2)]
            for number, places, outcome in decisions(tokens, i):
                if number == 0:
                    history = np.array([before[0] * lm_scoring.CLASSES + before[1]])
                    base = list(np.exp(weights.log_probabilities(history)[0]))
                elif number == 1:
                    sums = [sum(within[k, d + 16 * e] for e in range(16)) for d in range(16)]
                    base = [x / sum(sums) for x in sums]
                else:
                    sums = [within[k, word % 16 + 16 * e] for e in range(16)]
                    base = [x / sum(sums) for x in sums]
                likely = [math.log(b) for b in base]
                for f, place in enumerate(places):
                    counts = [seen[min(number, 1), place, x] for x in range(len(base))]
                    alpha = model.alpha[number, f, min(sum(counts).bit_length(), lm_words.BINS - 1)]
                    for x, (c, b) in enumerate(zip(counts, base)):
                        likely[x] += alpha * math.log((c / b + lm_words.TAU) / (sum(counts) + lm_words.TAU))
                score += (likely[outcome] - math.log(sum(map(math.exp, likely)))) / math.log(10)
            if k > own:
                score += math.log10((words[word, k] + 0.1) / within[k, word % 256])
        scores.append(score)
    return scores


def test_scores_equal_brute_force(spark, monkeypatch):
    kept, original = [], lm_scoring.Scorer.__init__

    def spy(self, *parts):
        kept.extend(parts)
        original(self, *parts)

    monkeypatch.setattr(lm_scoring.Scorer, "__init__", spy)
    monkeypatch.setattr(lm_scoring, "HEAD", 40)
    rows = [(i, prose(i % 20, 40, ["en", "de"][i % 2])) for i in range(40)] + [(90, None), (91, "  "), (92, "Solo")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    losses = []
    got = {r.doc_id: r for r in lm_scoring.score_texts(docs, remainder(10) == 0, losses).collect()}
    classes, weights, model = kept[:3]
    assert len(losses) == lm_words.STEPS and np.abs(model.alpha).max() > 0.05
    want = score_by_hand(rows, [got[d].held_out for d, _ in rows], classes, weights, model, got[90].train_tokens)
    assert [got[d].score for d, _ in rows] == pytest.approx(want, abs=1e-3, rel=1e-4)


def test_word_features_tell_what_classes_cannot(spark):
    """Pairs of words with equal endings: only the words themselves say which comes next."""
    rng = np.random.default_rng(5)
    follows = rng.permutation(300)
    rows = []
    for i in range(300):
        some = rng.integers(0, 300, 60)
        rows.append((i, " ".join(f"w{a}xing w{follows[a]}xing" for a in some)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    losses = []
    got = [r for r in lm_scoring.score_texts(docs, remainder(10) == 0, losses).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    # Every second word follows from the one before: at least half of what that can gain is gained.
    gained = sum(r.score for r in got) / tokens - sum(r.base_score for r in got) / tokens
    assert gained > 0.5 * 0.5 * math.log10(300)
    assert losses[-1] > losses[0] + 0.5


def test_rows_of_word_counts_keep_their_shape_when_scaled():
    def one(counts):
        return pa.RecordBatch.from_pydict({
            "number": pa.array([1], pa.int32()), "slice": pa.array([0], pa.int32()),
            "cells": pa.array([lm_words._encode(np.array([3, 4, 700]))], pa.binary()),
            "counts": pa.array([np.array(counts, np.uint32).tobytes()], pa.binary()),
        })

    [batch] = lm_words._merge(128)(iter([one([2**31, 2**30, 7]), one([2**31, 2**30, 9])]))
    cells = np.frombuffer(batch.column("cells")[0].as_py(), np.uint16)
    assert cells[3] == 2 * cells[4] > 2**14 and cells[700] == 16


@pytest.mark.parametrize("most, alpha", [(4, 1), (400, 1), (400, 60)])
def test_blocks_of_decisions_equal_a_plain_softmax(monkeypatch, most, alpha):
    """Rows of few and many counts, blocks of both, and weights whose odds leave single precision."""
    monkeypatch.setattr(lm_words, "BLOCK", 16 * 20)
    rng, n = np.random.default_rng(most), 100
    table = rng.integers(0, most, (50, 16)).astype(np.uint16)
    base = np.log(rng.dirichlet(np.ones(16), 7)).astype(np.float32)
    weights = alpha * rng.uniform(-0.2, 0.5, (lm_words.FEATURES, lm_words.BINS))
    rows, place, outcome = rng.integers(0, 50, (3, n)), rng.integers(0, 7, n), rng.integers(0, 16, n)
    table[rows, outcome] += 1
    for own in (False, True):
        decision = lm_words._Decision(
            weights, table, table.sum(axis=1, dtype=np.int32), lm_words.with_odds(base), place, rows, outcome, own
        )
        got = np.empty(n)
        for s, at, _, _, score, odds, sums in decision.blocks():
            got[decision.order[s]] = score.reshape(-1)[at] - np.log(sums)
            assert len(score) <= 20 and np.allclose(odds.sum(axis=1), sums, rtol=1e-5)
        for i in range(n):
            score = base[place[i]].astype(float)
            for f in range(lm_words.FEATURES):
                counts = table[rows[f, i]].astype(float)
                counts[outcome[i]] -= own
                weight = weights[f, min(int(counts.sum()).bit_length(), lm_words.BINS - 1)]
                score += weight * np.log((counts / np.exp(base[place[i]]) + lm_words.TAU) / (counts.sum() + lm_words.TAU))
            want = score[outcome[i]] - score.max() - np.log(np.exp(score - score.max()).sum())
            assert got[i] == pytest.approx(want, abs=1e-3, rel=1e-4)


def test_gradients_by_run_equal_plain_sums(monkeypatch):
    """Sums over runs of tokens that weigh alike, in blocks that end within a run, equal those token by token."""
    monkeypatch.setattr(lm_words, "BLOCK", 16 * 7)
    rng, n = np.random.default_rng(3), 60
    tables = [rng.integers(0, 5, (16, 16)).astype(np.uint16) for _ in range(2)]
    tables[0][:4] *= 60
    class_base = np.log(rng.dirichlet(np.ones(16), 4)).astype(np.float32)
    model = lm_words.WordModel(tables, np.ones((1, 16, 16)), 16, (4, 4))
    model.alpha = rng.uniform(-0.2, 0.5, model.alpha.shape)
    d = lm_words.Decisions(
        rng.integers(0, 16, n), rng.integers(0, 4, n), rng.integers(0, 2**62, n).astype(np.uint64),
        np.array([0, 25, n]), 16, np.uint64(7), (4, 4),
    )
    for rows in d.class_rows:
        np.add.at(tables[0], (rows, d.classes), 1)
    base = lm_words.with_odds(class_base)
    _, decision = next(model.decisions(d, base, own=True))
    weighs = decision.bins[np.searchsorted(decision.ends, np.arange(n), "right")]
    for f, rows in enumerate(decision.rows):
        totals = tables[0][rows].sum(axis=1, dtype=int) - 1
        assert weighs[:, f].tolist() == [min(int(x).bit_length(), lm_words.BINS - 1) for x in totals]
    for s, *_ in decision.blocks():
        covered = [(a, b) for a, b, _ in decision.runs(s)]
        assert covered[0][0] == 0 and covered[-1][1] == s.stop - s.start <= 7
        assert all(x[1] == y[0] for x, y in zip(covered, covered[1:]))

    size = lm_words.FEATURES * lm_words.BINS
    sums, loss = np.zeros((3, 1 + size, size)), np.zeros(2)
    model.gradient(d, base, sums, loss)
    want, lost = np.zeros((1 + size, size)), 0.0
    for i in range(n):
        score, values, places = class_base[d.history[i]].astype(float), [], []
        for f in range(lm_words.FEATURES):
            counts = tables[0][d.class_rows[f][i]].astype(float)
            counts[d.classes[i]] -= 1
            values.append(np.log(counts / np.exp(class_base[d.history[i]]) + lm_words.TAU))
            places.append(f * lm_words.BINS + min(int(counts.sum()).bit_length(), lm_words.BINS - 1))
            score += model.alpha[0].reshape(-1)[places[-1]] * values[-1]
        likely = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
        lost += np.log(likely[d.classes[i]])
        for f, value in enumerate(values):
            want[0, places[f]] += value[d.classes[i]] - likely @ value
            for g, other in enumerate(values):
                want[1 + places[f], places[g]] += likely @ (value * other) - (likely @ value) * (likely @ other)
    assert loss == pytest.approx([lost, n], rel=1e-4)
    assert np.allclose(sums[0], want, rtol=1e-3, atol=1e-3) and not sums[1:].any()


def test_histories_are_counted_with_the_word_features():
    """One pass over the texts counts both."""
    tokens, hashes = np.array([3, 70, 63]), np.array([5, 6, 7], np.uint64)
    history = np.array([63 * 128 + 63, 3 * 128 + 63, 70 * 128 + 3])
    bits = lm_words.table_bits(3)
    d = lm_words.Decisions(tokens, history, hashes, np.array([0, 3]), 64, np.uint64(7), bits)
    merged = lm_words._merge(128)(lm_words.count(iter([d, d]), 128, bits))
    found = [b for b in merged if b.column("number")[0].as_py() == lm_words.HISTORIES]
    rows = [r for b in lm_words._of_histories(128)(iter(found)) for r in b.to_pylist()]
    want = [(int(h), int(k), 2) for h, k in zip(history, tokens)]
    assert sorted((r["history"], r["cls"], r["c"]) for r in rows) == sorted(want)


def test_scores_without_training(spark, nothing):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = sorted(lm_scoring.score_texts(docs, F.lit(True)).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0), (1, 0, 0, 0)]
    assert got[1].score == pytest.approx(-math.log10(lm_scoring.CLASSES))
    assert lm_scoring.score_texts(nothing, F.lit(False)).count() == 0


# html


PAGE = """<!doctype html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header class="site"><h1>Site name, with, commas</h1></header>
<div class="cookie-notice">We use cookies, many of them, all the time, for everything you do here.</div>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Something, else, entirely, and long</a></li></ul></nav>
<div id="main"><article><header><h1>The title</h1></header>
<p>First &amp; foremost,   this is a paragraph
with <b>bold</b> text, and a <a href="x">link</a>, as such.<p>Second one, never closed, with &eacute;&#233; and&nbsp;so on.
<form><input name="q"><p>Subscribe now, please, it is free of charge and quick.</p></form>
<table><tr><td>cell one</td><td>cell two</td></tr></table>
<ul><li>item one<li>item two</ul>
<p>Short.</p></article>
<section class="comments"><p>Great article, I think, thanks a lot for writing it, really.</p></section></div>
<aside><p>Related things, that nobody, ever, asked to see on this page.</p></aside>
<footer>&copy; somebody, somewhere</footer></body></html>"""
TEXT = """The title
First & foremost, this is a paragraph with bold text, and a link, as such.
Second one, never closed, with éé and so on.
cell one
cell two
item one
item two
Short."""


def test_article_is_found_in_a_page():
    assert html_text.main_text(PAGE) == TEXT


def test_article_is_found_without_article_element():
    page = PAGE.replace("<article>", '<div class="x">').replace("</article>", "</div>")
    page = page.replace("<header><h1>", "<h1>").replace("</h1></header>\n<p>First", "</h1>\n<p>First")
    assert html_text.main_text(page) == TEXT


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p", ""), ("plain words", "plain words"), ("<html><body></body></html>", ""),
    ("<nav><a>Menu</a></nav>", ""), ("<article><p>a < b &lt; c</p></article>", "a < b < c"),
    ("<article><h1>T</h1><p>x</p><p>cut of", "T\nx\ncut of"), ("<!-- only", ""),
    ("<article><p>one</p><script>never closed <p>two", "one"),
    ("<article><p title='a>b'>quoted</p><p hidden>gone</p></article>", "quoted"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
])
def test_odd_pages(page, text):
    assert html_text.main_text(page) == text


LONGER = "<p>" + "A paragraph of the body, as long as they are, with a comma or two in it. " * 4 + "</p>"


@pytest.mark.parametrize("name", [
    "class='has-sidebar'", "class='layout no-sidebar'", "class='with-banner'", "id='header-fixed-page'",
    "class='sidebar'", "class='discussion'",
])
@pytest.mark.parametrize("tag", ["div", "form"])
def test_names_and_forms_around_the_page_keep_it(name, tag):
    inside = f"<h1>Title</h1>{LONGER * 3}"
    want = html_text.main_text(f"<body>{inside}</body>")
    assert want.count("\n") == 3
    for body in (inside, f"<article>{inside}</article>"):
        assert html_text.main_text(f"<body><{tag} {name}>{body}</{tag}></body>") == want


@pytest.mark.parametrize("name", ["post-header", "section-discussion", "legal-analysis"])
def test_names_of_parts_of_an_article_keep_their_paragraphs(name):
    page = f"<body><div><h1>Title</h1>{LONGER * 9}<div class='{name}'>{LONGER}</div>{LONGER}</div></body>"
    assert html_text.main_text(page).count("\n") == 11


def test_named_parts_are_still_left_out():
    comments = f"<ol class='comment-list'><li><article class='comment-body'>{LONGER * 4}</article></li></ol>"
    page = f"""<body><div><h1>Title</h1>{LONGER * 2}<p>Text <span class="ad">gone</span> goes on.</p></div>
        <div class="related"><p>Gone, too, as nobody asked for it.</p></div>{comments}</body>"""
    got = html_text.main_text(page)
    assert got.count("\n") == 3 and got.endswith("Text goes on.")


@pytest.mark.parametrize("wrap", ["{}", "<div>{}</div>", "<div><section>{}</section></div>"])
def test_a_body_split_over_siblings_is_kept_whole(wrap):
    section = "<section><p>" + "One paragraph with, say, four, commas, and " + "some more words " * 19 + "</p></section>"
    links = "<div>" + "<a href='/x'>A long, long link to another page</a> " * 3 + "</div>"
    page = f"""<body>{links}<h1>Title</h1><p>The lead.</p>{wrap.format("<div>" + LONGER * 20 + "</div>")}
        {section}<ul><li>item</li></ul>Text of the body's own, here.{links}</body>"""
    got = html_text.main_text(page).split("\n")
    assert got[:2] == ["Title", "The lead."] and len(got) == 25
    assert got[22].startswith("One paragraph") and got[23:] == ["item", "Text of the body's own, here."]


@pytest.mark.parametrize("levels", [10, 600, 30_000])
def test_deep_elements_are_told_apart(levels):
    page = "<article><h1>Title</h1>" + "<div>" * levels + f"{LONGER}<nav>Gone</nav><aside>{LONGER}</aside>"
    page += "<div><div>" + LONGER + "</div></div>" * 2 + "</article><section><p>Not in the article.</p></section>"
    got = html_text.main_text("<div>" + page + "</div>")
    assert got.count("\n") == 2 and "Gone" not in got and got.startswith("Title\nA paragraph")


def test_deep_pages_take_no_square_of_their_depth():
    started = time.process_time()
    page = "".join(f"<section>{LONGER if i % 10 == 0 else 'some words'}</i></b>" for i in range(30_000))
    assert html_text.main_text(page).count("A paragraph") == 12_000
    assert time.process_time() - started < 20


def test_pages_keep_their_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = sorted(map(tuple, html_text.extract_text(pages).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)], key=repr)
    assert html_text.extract_text(pages.limit(0)).count() == 0


PARAGRAPHS = "".join(f"<p>Paragraph {i} of the article, which is long enough to count, and ends.</p>" for i in "12")
SAID = "I think that this is wrong, for more than one reason, and I will say why."


def said(tag, n=25, byline=True):
    by = "<b>Anna</b> <time>2024-01-05</time>" if byline else ""
    return "".join(f"<{tag}>{by}<p>{SAID} {i}</p></{tag}>" for i in range(n))


@pytest.mark.parametrize("body", [
    f"<article><h1>T</h1>{PARAGRAPHS}</article><div class='comments'>{said('div', byline=False)}</div>",
    f"<article><h1>T</h1>{PARAGRAPHS}<div class='comments'>{said('div', byline=False)}</div></article>",
    f"<div><h1>T</h1>{PARAGRAPHS}</div><div class='comments'>{said('div', byline=False)}</div>",
    f"<article><h1>T</h1>{PARAGRAPHS}</article><div id='responses'>{said('div')}<form><textarea></textarea></form></div>",
    f"<article><h1>T</h1>{PARAGRAPHS}</article><ul class='reader-feedback'>{said('li')}</ul>",
    f"<div><h1>T</h1>{PARAGRAPHS}</div><ol class='xyz'>{said('li')}</ol>",
    f"<article><h1>T</h1>{PARAGRAPHS}<section id='talkback'><h3>25 voices</h3>{said('div')}</section></article>",
    f"<div class='post'><h1>T</h1>{PARAGRAPHS}</div><div class='xyz'>{said('section', 2)}</div>",
])
def test_comments_go_however_many_they_are(body):
    assert html_text.main_text(f"<body>{body}</body>") == (
        "T\n" + "\n".join(f"Paragraph {i} of the article, which is long enough to count, and ends." for i in "12"))


@pytest.mark.parametrize("name", ["comments", "has-comments", "comment-page discussion", "post-comments"])
def test_a_wrapper_named_after_comments_keeps_the_article(name):
    text = html_text.main_text(f"<body><div class='{name}'><h1>T</h1>{PARAGRAPHS * 3}</div></body>")
    assert text.count("\n") == 6


def test_dated_sections_of_an_article_stay():
    entry = "<section><h2>At noon</h2><p>Something happened, as was expected, and went on for long.</p></section>"
    dated = entry.replace("<p>", "<p><time>12:00</time> ")
    text = html_text.main_text(f"<body><article><h1>T</h1>{PARAGRAPHS}{dated * 3}</article></body>")
    assert text.count("Something happened") == 3


# decontamination


def test_planted_items_are_found_and_others_left(spark, messy, nothing):
    items = [(i, prose(1000 + i, 20 + i)) for i in range(40)] + [(40, "Short one here."), (41, None), (42, "")]
    items += [(43, items[3][1])]
    texts = dict(items)
    planted = [(900, prose(1, 60) + " " + texts[3] + "!! " + prose(2, 400)),
               (901, texts[7].upper()), (902, prose(3, 5000) + "\n" + texts[20]),
               (903, "so: (short) ONE here, then"), (904, " ".join(texts[5].split()[:12]))]
    docs = messy.select("doc_id", "text").unionByName(
        spark.createDataFrame(planted, "doc_id long, text string")).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(900, 3), (900, 43), (901, 7), (902, 20), (903, 40)}
    got = decontamination.contaminated(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
    kept = decontamination.decontaminate(docs, bench)
    assert kept.count() == docs.count() - 4
    assert decontamination.decontaminate(messy, bench).dtypes == messy.dtypes
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(nothing, bench).count() == 0


def test_chunks_of_items_give_the_same_hits(spark, monkeypatch):
    items = [(i, prose(1000 + i, 25)) for i in range(30)]
    docs = spark.createDataFrame([(i, prose(i, 50) + " " + t) for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "CHUNK_BYTES", 1500)
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} == {
        (i, i) for i in range(30)}


def test_retrieval_equals_scoring_everything():
    import pyarrow as pa

    items = [(i, prose(i % 25, 30, "en") + " " + prose(i, 10)) for i in range(60)]
    texts = [prose(100 + i, 120) + " " + items[i % 60][1] + " " + prose(200 + i, 40) for i in range(40)]
    words = decontamination._words(pa.array([t for _, t in items]))
    hashes = words.hashes()
    sets = [set(hashes[a:b].view(np.int64).tolist()) for a, b in zip(words.first, words.first[1:])]
    df = Counter(t for s in sets for t in s)
    index = decontamination.Index(items, df, len(items), float(words.counts.mean()))
    docs = decontamination._words(pa.array(texts))
    numbers = docs.hashes()
    row, item, score = decontamination.retrieve(index, docs, numbers)
    got = {(r, i): round(s, 9) for r, i, s in zip(row.tolist(), item.tolist(), score.tolist())}
    term = index.terms
    impact = np.zeros((len(term), len(items)))
    cells = np.repeat(np.arange(len(index.start) - 1), np.diff(index.start))
    impact[index.cells[cells] // index.blocks, index.item] = index.impact
    want = {}
    for r in range(len(texts)):
        own = numbers[docs.first[r]:docs.first[r + 1]]
        for start in range(0, max(1, -(-len(own) // index.longest) - 1)):
            part = np.unique(own[start * index.longest:(start + 2) * index.longest])
            total = impact[np.isin(term, part)].sum(axis=0)
            for i in np.flatnonzero(total >= decontamination.RETRIEVE - 1e-9):
                want[r, int(i)] = max(want.get((r, int(i)), 0), round(float(total[i]), 9))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


# language


def test_languages_are_told_apart(spark, messy, nothing):
    rows = [(i, prose(i, 40, ["en", "de", "es"][i % 3]), ["en", "de", "es"][i % 3]) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    profiles = language_id.learn_profiles(docs.where(remainder(3) != 1))
    assert sorted(profiles) == ["de", "en", "es"]
    got = language_id.predict_language(docs.where(remainder(3) == 1), profiles, ["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    odd = language_id.predict_language(messy, profiles, ["doc_id"]).collect()
    und = sorted(r.doc_id for r in odd if r.lang_pred == "und")
    assert und == [4, 5, 6, 20] and len(odd) == messy.count()
    kept = language_id.keep_known(messy, profiles)
    chars = {r.doc_id: len(r.text or "") for r in messy.collect()}
    none = {r.doc_id for r in odd if r.score < language_id.LEAST_SCORE and chars[r.doc_id] >= language_id.JUDGED_CHARS}
    assert none <= {16, 19}  # one syllable or one letter over and over
    assert kept.dtypes == messy.dtypes and {r.doc_id for r in kept.collect()} == set(chars) - none - {4, 5, 6, 20}
    assert language_id.keep_known(messy, {}).count() == messy.count() - 4
    assert language_id.learn_profiles(nothing) == {}
    assert language_id.predict_language(nothing, profiles, ["doc_id"]).count() == 0


def test_a_text_vector_is_the_bundle_of_its_trigrams():
    letters = language_id._Letters(5)
    texts = ["Ab, c", None, "", "ab c\n", "日本 x" * 3]
    got, has = language_id.text_vectors(texts, letters)
    assert has.tolist() == [True, False, False, True, True]

    def by_hand(text):
        points = [ord(c) if c.isalpha() else 0 for c in (text or "").lower()]
        points = [0, *points, 0]
        points = [p for i, p in enumerate(points) if p or i in (0, len(points) - 1) or points[i - 1]]
        total = np.zeros(language_id.DIMENSIONS)
        for a, b, c in zip(points, points[1:], points[2:]):
            if a or b:
                total += np.roll(letters.vector(a), 2) * np.roll(letters.vector(b), 1) * letters.vector(c)
        return total

    for text, vector, ok in zip(texts, got, has):
        if ok:
            assert np.allclose(vector, by_hand(text)), text


# mixing


def mixed(docs):
    sized, taken = mixing.mix(docs)
    rows = {(r._k1, r._k2): r for r in sized.collect()}
    return rows, taken.collect()


def test_mix_meets_its_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), str(rng.choice(["a", "b", "c", "d", "é"])))
            for i in range(3000)]
    rows += [(5000 + i, "w " * 30, None) for i in range(40)] + [(6000, "w " * 900, "huge")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    sized, taken = mixed(docs)
    draws = Counter((r._k1, r._k2) for r in taken)
    total = sum(r.size * r.copies for r in sized.values())
    sources = {}
    for key, r in sized.items():
        s = sources.setdefault(r.source, [r.source_size, r.target, 0])
        s[2] += draws[key] * r.size * r.copies
        assert draws[key] <= mixing.LIMIT
    order = sorted((s for s in sources if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    assert sum(t for _, t, _ in sources.values()) == pytest.approx(1.5 * total)
    level = max(sources[s][1] / weight[s] for s in order if sources[s][1] < 2 * sources[s][0] - 1e-6)
    for s in order:
        size, target, got = sources[s]
        assert target == pytest.approx(min(2 * size, level * weight[s]))
        assert abs(got - target) <= max(20, 0.001 * target), s
    again = Counter((r._k1, r._k2, r.shard, r["pass"]) for r in mixed(docs.repartition(7))[1])
    assert again == Counter((r._k1, r._k2, r.shard, r["pass"]) for r in taken)


def test_shards_get_fair_shares_of_every_source(spark):
    quotas = spark.createDataFrame([(0, 4000), (1, 900), (2, 1)], "number long, draws long")
    shards = 33
    own = mixing.split_quotas(quotas, shards, 3).collect()
    for number, total in ((0, 4000), (1, 900), (2, 1)):
        spans = sorted((r.start, r.quota, r.shard) for r in own if r.number == number)
        assert [s for s, _, _ in spans] == list(np.cumsum([0] + [q for _, q, _ in spans])[:-1])
        assert sum(q for _, q, _ in spans) == total
    per_shard = Counter()
    for r in own:
        per_shard[r.shard] += r.quota
    assert len(per_shard) == shards and max(per_shard.values()) - min(per_shard.values()) <= 6
    first = [r.quota for r in own if r.number == 0]
    assert 90 < min(first) and max(first) < 150


def test_mix_of_troubled_rows(messy, nothing):
    out = mixing.mixed_documents(messy)
    assert [c for c, _ in out.dtypes if c not in ("shard", "place")] == [
        c for c in messy.columns if c != "shard"]
    draws = Counter(r.doc_id for r in out.collect())
    assert not {4, 5, 6} & set(draws)
    rows, taken = mixed(nothing)
    assert not rows and not taken
    assert mixing.mixed_documents(nothing).count() == 0


def test_a_full_chunk_of_items_stays_small():
    rng = np.random.default_rng(6)
    vocabulary = np.array([f"w{i:06d}" for i in range(200_000)])
    size = decontamination.CHUNK_BYTES // 240
    texts = [" ".join(row) for row in vocabulary[rng.integers(0, len(vocabulary), (size, 30))]]
    words = decontamination._words(decontamination.pa.array(texts, decontamination.pa.large_string()))
    df = Counter(words.hashes().view(np.int64).tolist())
    index = decontamination.Index(list(enumerate(texts)), df, size, 30.0)
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray))
    assert held + sum(h.nbytes for h in index.hashes) < 150 << 20
    own = decontamination._words(decontamination.pa.array(["some words", "and " + texts[17] + " more", texts[-1]]))
    rows, items, _ = decontamination.retrieve(index, own, own.hashes())
    assert {(1, 17), (2, size - 1)} <= set(zip(rows.tolist(), items.tolist()))
