import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import messy, nothing, prose, rows_of  # noqa: F401

from simsearch.llm import collocations, fingerprints, hard_negatives

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# fingerprints


def entropy_by_hand(window: bytes) -> float:
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


@pytest.mark.parametrize("window", [8, 32])
def test_entropies(window):
    raw = np.frombuffer((prose(1, 60) + "x" * 50 + prose(2, 20)).encode(), np.uint8)
    got = fingerprints.entropy_bins(raw, window)
    want = [entropy_by_hand(raw[i:i + window].tobytes()) / math.log2(window) * fingerprints.BINS
            for i in range(len(raw) - window + 1)]
    assert np.abs(got - np.floor(want)).max() <= 1
    assert len(fingerprints.entropy_bins(raw[:window - 1], window)) == 0
    assert fingerprints.entropy_bins(np.zeros(window, np.uint8), window).tolist() == [0]


def features_by_hand(raw: bytes, ranks, scale) -> set[bytes]:
    windows = [raw[i:i + scale.window] for i in range(len(raw) - scale.window + 1)]
    if not windows:
        return {raw} if raw else set()
    if scale.run == 1:
        return set(windows)
    bins = fingerprints.entropy_bins(np.frombuffer(raw, np.uint8), scale.window)
    wins = Counter()
    for i in range(len(windows) - scale.run + 1):
        wins[min(range(i, i + scale.run), key=lambda k: (ranks[bins[k]], k))] += 1
    good = [k for k, n in wins.items() if n >= scale.wins]
    return {windows[k] for k in good or [min(wins, key=lambda k: (-wins[k], k))]}


def test_features_do_not_depend_on_neighbours():
    rng = np.random.default_rng(3)
    ranks = rng.permutation(fingerprints.BINS + 1)
    texts = [prose(i, n) for i, n in enumerate([300, 60, 1, 2, 700])] + ["", "abc", "x" * 2000, prose(1, 60)]
    got = fingerprints.fingerprints(texts, ranks)
    for text, (name, chain) in zip(texts, got):
        scale = fingerprints.SHORT_SCALE if len(text.encode()) < fingerprints.SHORT else fingerprints.LONG_SCALE
        assert name == scale.name
        alone = fingerprints.fingerprints([text], ranks)[0]
        assert np.array_equal(alone[1], chain)
        number = len(features_by_hand(text.encode(), ranks, scale))
        assert len(chain) == -(-number // fingerprints.FILTER_FEATURES)
        bits = int(np.bitwise_count(chain).sum())
        assert bits <= number * fingerprints.BITS_SET and (bits > 0) == (number > 0)
        assert np.array_equal(fingerprints.read(fingerprints.spelt((name, chain)))[1], chain)
    assert np.array_equal(got[1][1], got[-1][1])


def test_likeness():
    ranks = np.arange(fingerprints.BINS + 1)
    base = prose(1, 400)
    texts = [base, base[: len(base) * 3 // 4] + prose(2, 100), prose(3, 400, "de"), "", "ab", base[:200], prose(5, 20_000)]
    found = fingerprints.fingerprints(texts, ranks)
    for f in found:
        assert fingerprints.likeness(f, f) == 1.0
    near, far = fingerprints.likeness(found[0], found[1]), fingerprints.likeness(found[0], found[2])
    assert 0.5 < near < 1 and far < 0.15
    assert fingerprints.likeness(found[0], found[3]) == 0.0 == fingerprints.likeness(found[4], found[3])
    assert fingerprints.likeness(found[0], found[6]) == fingerprints.likeness(found[6], found[0]) < 0.15


@pytest.mark.parametrize("parts", [1, 7])
def test_every_text_meets_the_next(messy, nothing, monkeypatch, parts):
    monkeypatch.setattr(fingerprints, "PART_BYTES", 1 << (40 if parts == 1 else 15))
    got = fingerprints.edited_fingerprints(messy).collect()
    rows = rows_of(messy)
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(d) for d, _ in rows)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(r.fingerprint, []).append(r)
    # Rows of one id have an order of their own: every edited text must be that of some next row.
    ids = sorted({d for d, _ in rows}, key=lambda d: (d is not None, d or 0))
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(t or "")
    for r in got:
        after = ids[(ids.index(r.doc_id) + 1) % len(ids)]
        following = texts[after] + (texts[r.doc_id] if len(texts[r.doc_id]) > 1 else [])
        own = [t for t in texts[r.doc_id] if len(t) == r.n_chars]
        assert r.edited_text in {fingerprints.edited(t, f) for t in own for f in following}
    firsts = Counter(r.doc_id for r in got)
    assert firsts == Counter(d for d, _ in rows)
    assert fingerprints.edited_fingerprints(nothing).count() == 0
    assert fingerprints.fingerprint_texts(nothing).count() == 0


def test_a_single_row_follows_itself(messy):
    one = messy.where("doc_id = 3")
    row = fingerprints.edited_fingerprints(one).first()
    text = one.first().text
    assert row.edited_text == fingerprints.edited(text, text)
    same = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint_texts(messy).collect() if r.doc_id in (1, 2)}
    assert same[1] == same[2]


# hard negatives


def negatives_by_hand(rows, every, positives, negatives):
    kept = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in whole) >= 2**62:
            continue
        kept[vec_id] = min(kept.get(vec_id, (label, whole)), (label, whole))
    out = []
    for anchor, (label, vector) in kept.items():
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, la) for i, (la, v) in kept.items() if i != anchor]
        scored.sort()
        for p, positive, _ in [x for x in scored if x[2] == label][:positives]:
            band = [(n, i) for n, i, la in scored if la != label and 50 * -p <= -100 * n <= 95 * -p]
            out += [(anchor, positive, k + 1, i, -p, -n) for k, (n, i) in enumerate(band[:negatives])]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 4)), rng.normal(size=12).astype(np.float32).tolist()) for i in range(180)]
    rows += [(500 + i, i % 3, rows[0][2]) for i in range(30)]  # a very common vector
    rows += [(i, 1, rows[7][2]) for i in (25, 30)] + [(600, 2, [0.0] * 12), (605, 2, [])]  # repeated ids, zeros
    rows += [(610, None, rows[1][2]), (615, 1, None), (620, 1, [None] * 12), (625, 1, [float("nan")] * 12),
             (630, 1, [float("inf")] * 12), (635, 1, [3e38] * 12), (None, 1, rows[2][2]), (640, 1, rows[3][2][:5]),
             (-10, 1, rows[4][2]), (645, 0, [2e6] * 12), (650, 1, [1.9e6] * 12)]
    return rows


@pytest.mark.parametrize("anchor_bytes, few", [(1 << 20, 0.05), (2000, 1.1)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, anchor_bytes, few):
    monkeypatch.setattr(hard_negatives, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(hard_negatives, "_FEW", few)
    rows = vector_rows()
    table = spark.createDataFrame(
        [(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, rank string"
    ).repartition(3)
    got = hard_negatives.hard_negatives(table, every=5, anchor_bytes=anchor_bytes)
    want = negatives_by_hand(rows, 5, 5, 3)
    found = sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
                   for r in got.collect())
    assert found == want and len(want) > 100
    assert hard_negatives.hard_negatives(table.limit(0)).count() == 0


@pytest.mark.parametrize("few", [0.0, 0.2, 1.1])
def test_pairs_above_loses_none(monkeypatch, few):
    monkeypatch.setattr(hard_negatives, "_FEW", few)
    rng = np.random.default_rng(8)
    scale = np.linspace(300, 1, 40).astype(int)
    matrix = (rng.normal(size=(90, 40)) * scale).astype(np.int64)
    ids = np.arange(90)
    rows = hard_negatives.Vectors(ids, ids % 3, matrix)
    anchors = rows.take(np.arange(10))
    scores = matrix[:10] @ matrix.T
    for quantile in (0.0, 0.5, 0.97):
        floor = np.quantile(scores, quantile, axis=1).astype(np.int64)
        q, x, s = hard_negatives.pairs_above(anchors, rows, floor)
        want = {(i, j, int(scores[i, j])) for i, j in zip(*np.nonzero(scores >= floor[:, None]))}
        assert set(zip(q.tolist(), x.tolist(), s.tolist())) == want and len(q) == len(want)


# collocations


def phrases_by_hand(rows, least, keep_below, top):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        held = set()
        for g, c in f.items():
            if len(g) == 3 and c >= least:
                held |= {p for p in (g[:2], g[1:]) if 100 * c >= keep_below * f[p]}
        found = []
        for g, a in f.items():
            if len(g) > 1 and a >= least and g not in held:
                score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.mark.parametrize("most_words, top", [(collocations.MOST_WORDS, 2000), (0, 2000), (collocations.MOST_WORDS, 3)])
def test_collocations_equal_brute_force(spark, messy, nothing, most_words, top):
    rng = np.random.default_rng(4)
    some = ["New", "york", "city", "the", "a", "of", "ÄÖ", "日本", "x"]
    rows = [(r.lang, r.text) for r in messy.select("lang", "text").collect()]
    rows += [("en", " ".join(rng.choice(some, 60)) + ". new York city, of new york\tcity!") for _ in range(20)]
    rows += [(None, "one two three four; one two three four"), ("und", "one two three four one")] * 3
    rows += [("x y", "Repeated passage without any stop that is very long " * 3)] * 4
    docs = spark.createDataFrame([(*r, 1) for r in rows], "lang string, text string, s1 int").repartition(3)
    got = collocations.collocations(docs, least=3, top=top, most_words=most_words)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = phrases_by_hand(rows, 3, 50, top)
    assert sorted(map(tuple, got.select(*columns).collect())) == want and len(want) > 10
    assert collocations.collocations(nothing).count() == 0


def test_paths_hold_every_edge_once(spark):
    text = "a b c d e f. " * 5 + "x b c d y. " * 3 + "q q q q q. " * 4 + "a b, c d e. " * 2
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    edges, words, _ = collocations.word_graph(docs, 2)
    name = {r.s: r.word for r in words.collect()}
    pairs = {(r.s1, r.s2): r.f for r in collocations.pair_counts(edges).collect()}
    ready = edges.where("s3 > 1 and w >= 2").collect()
    rows = [(*r, pairs[r.s1, r.s2], pairs[r.s2, r.s3]) for r in ready]
    fields = "s1 long, s2 long, s3 long, w long, f_first long, f_last long"
    paths = collocations.compact_paths(spark.createDataFrame(rows, fields)).collect()
    unfolded = [(*p.path[i:i + 3], p.w) for p in paths for i in range(len(p.path) - 2)]
    assert sorted(unfolded) == sorted((r.s1, r.s2, r.s3, r.w) for r in ready)
    spelt = {tuple(name[s] for s in p.path): p.w for p in paths}
    assert spelt[tuple("bcd")] == 8 and spelt[tuple("qqq")] == 12
    assert max(len(p.path) for p in paths) <= 6
    for p in paths:
        assert (p.f_first, p.f_last) == (pairs[tuple(p.path[:2])], pairs[tuple(p.path[-2:])])
        assert all(pairs[tuple(p.path[i:i + 2])] == p.w for i in range(1, len(p.path) - 2))
