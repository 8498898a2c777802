import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from simsearch.llm import exact_dedup, jaccard_join, line_dedup, substring_dedup
from llm_rows import messy, nothing, rows_of  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ordered(rows):
    return sorted(rows, key=repr)


# exact duplicates


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(i)
    out = []
    for text, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0))
        keep = rows[best][0]
        alike = sum(rows[i] == rows[best] or (rows[i][0] == keep and len(rows[i][1] or "") ==
                    len(rows[best][1] or "")) for i in members)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(rows[i][0], keep, len(members), digest) for i in members]
        assert alike >= 1
    return out


def test_exact_groups_equal_brute_force(messy):
    rows = rows_of(messy)
    got = exact_dedup.exact_groups(messy).collect()
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(
        exact_by_hand(rows))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in got})


def test_exact_filter_keeps_one_row_and_all_columns(messy, nothing):
    kept = exact_dedup.drop_exact_duplicates(messy)
    assert kept.dtypes == messy.dtypes
    texts = [re.sub(r"\s", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub(r"\s", "", t or "") for _, t in rows_of(messy)})
    assert exact_dedup.drop_exact_duplicates(nothing).count() == 0
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_chunks_are_set_by_content():
    rng = np.random.default_rng(1)
    long = rng.integers(33, 127, 200_000).astype(np.uint8)
    moved = np.concatenate([rng.integers(33, 127, 777).astype(np.uint8), long])

    def chunks(raw):
        return [raw[a:b].tobytes() for a, b in exact_dedup.cut(0, len(raw), exact_dedup.boundaries(raw))]

    first, second = chunks(long), chunks(moved)
    assert b"".join(first) == long.tobytes() and b"".join(second) == moved.tobytes()
    assert len(set(first) & set(second)) > 0.9 * len(first)
    assert max(map(len, first)) <= exact_dedup.LARGEST
    # The cuts of a text do not depend on what lies before it.
    both = np.concatenate([moved, long])
    own = exact_dedup.cut(len(moved), len(both), exact_dedup.boundaries(both))
    assert [both[a:b].tobytes() for a, b in own] == first


# lines


def lines_by_hand(rows, threshold):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < threshold]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_lines_equal_brute_force(spark, messy, threshold):
    extra = spark.createDataFrame(
        [(30, "Common line\nown 30\n\n"), (31, " common LINE\x0c\ncommon line"), (32, "\ncommon line\n"),
         (33, "COMMON É\ncommon é"), (34, None), (34, "a\r\nb")], "doc_id long, text string")
    docs = messy.select("doc_id", "text").unionByName(extra)
    got = line_dedup.drop_common_lines(docs, threshold).collect()
    assert ordered(map(tuple, got)) == ordered(lines_by_hand(rows_of(docs), threshold))


def test_no_lines(nothing):
    assert line_dedup.drop_common_lines(nothing).count() == 0


# passages


def passages_by_hand(rows, length):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        keep = [True] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                keep[i:i + length] = [False] * length
        kept = [x for x, k in zip(w, keep) if k]
        out.append((doc, len(w), len(w) - len(kept), " ".join(kept)))
    return out


@pytest.mark.parametrize("grouped", [200, substring_dedup._GROUPED])
def test_passages_equal_brute_force(messy, nothing, monkeypatch, grouped):
    monkeypatch.setattr(substring_dedup, "_GROUPED", grouped)
    got = substring_dedup.remove_repeats(messy).collect()
    assert ordered(map(tuple, got)) == ordered(passages_by_hand(rows_of(messy), 35))
    assert substring_dedup.remove_repeats(nothing).count() == 0


# Jaccard join


def components_by_hand(rows, n, percent):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(d, len(s), least.get(find(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed=4):
    """Chains and clusters of edited copies, of sizes on both sides of the pairing limit."""
    from llm_rows import prose

    rng, rows = np.random.default_rng(seed), []
    for cluster, size in enumerate([1, 2, 3, 40, 30]):
        base = prose(cluster + 100, 120).split()
        for _ in range(size):
            words = list(base)
            for place in rng.integers(0, len(words), int(rng.integers(0, 5))):
                words[place] = f"edit{rng.integers(1_000_000)}"
            rows.append((len(rows) + 50, " ".join(words)))
    step = prose(500, 150).split()
    for i in range(12):  # a chain: neighbours are linked, the ends are not
        rows.append((len(rows) + 50, " ".join(step[3 * i:3 * i + 100])))
    common = prose(501, 60)  # a passage that many otherwise different texts share
    rows += [(len(rows) + 50 + i, common + " " + prose(600 + i, 40)) for i in range(30)]
    return rows


@pytest.mark.parametrize("n,percent,paired", [(4, 85, 16), (5, 80, 16), (4, 85, 2), (4, 60, 4)])
def test_components_equal_brute_force(spark, messy, monkeypatch, n, percent, paired):
    monkeypatch.setattr(jaccard_join, "PAIRED", paired)
    docs = messy.select("doc_id", "text").unionByName(
        spark.createDataFrame(near_copies(), "doc_id long, text string")).repartition(4)
    got = jaccard_join.similar_components(docs, n, percent)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()]
    assert ordered(got) == ordered(components_by_hand(rows_of(docs), n, percent))


def test_similar_filter(spark, messy, nothing):
    kept = jaccard_join.drop_similar(messy)
    assert kept.dtypes == messy.dtypes
    by_hand = components_by_hand(rows_of(messy), 4, 85)
    empty = sum(size == 0 for _, size, _ in by_hand)
    assert kept.count() == empty + len({c for _, size, c in by_hand if size}) + 2  # two have a null id, two the id 12
    assert jaccard_join.drop_similar(nothing).count() == 0
    assert jaccard_join.similar_components(nothing).count() == 0


def test_trie_walk_equals_intersections():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(300, rng.integers(1, 200), replace=False)) for _ in range(60)]
    sets += [sets[0][:50], sets[0], sets[1][:64], sets[1][:65]]
    query = np.sort(rng.choice(300, 150, replace=False))
    for share in (0, 0.3, 0.6):
        needed = [int(share * len(s)) for s in sets]
        want = {i: int(np.isin(s, query).sum()) for i, s in enumerate(sets)}
        got = dict(jaccard_join.Trie(sets).walk(query, needed))
        assert got == {i: o for i, o in want.items() if o >= needed[i]}
