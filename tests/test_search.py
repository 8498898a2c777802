import math

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from simsearch.operators import index, search
from simsearch.operators.analysis import analyze_queries
from simsearch.plans.joins import lookup_join
from simsearch.plans.storage import materialize

QUERY = "love night night zebra"
GOLDEN = [
    (0, 0.045488723, 0.720454215), (2, 0.022744361, 0.360227107), (1, 0.014350094, 0.227278000),
]


@pytest.fixture(scope="module")
def built(songs):
    return index.build_index(songs, lang_col=None, stem=False, stopword_lists={})


def ask(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "qid long, text string")


def test_golden_scores(spark, built):
    weights = search.query_weights(built, analyze_queries(ask(spark, QUERY), stem=False))
    norm = weights.first().norm
    assert norm == pytest.approx(0.224497337 * 0.281245876, rel=1e-7)
    rows = search.score(built, weights).orderBy(F.col("similarity").desc()).collect()
    for row, (doc, dot, similarity) in zip(rows, GOLDEN, strict=True):
        assert row.doc_id == doc
        assert row.dot == pytest.approx(dot, rel=1e-6)
        assert row.similarity == pytest.approx(similarity, rel=1e-6)


@pytest.mark.parametrize("broadcast", [True, False])
def test_broadcast_and_shuffle_agree(spark, built, broadcast):
    terms = analyze_queries(ask(spark, QUERY, "train song", "blue"), stem=False)
    weights = search.query_weights(built, terms, broadcast=broadcast)
    got = search.score(built, weights, broadcast=broadcast)
    rows = {(r.qid, r.doc_id): r.similarity for r in got.collect()}
    assert set(rows) == {
        (0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (1, 3), (1, 4), (2, 3)
    }
    assert rows[0, 0] == pytest.approx(0.720454215, rel=1e-6)
    assert rows[2, 3] == pytest.approx(1.0)


def test_queries_that_find_nothing(spark, built):
    queries = ask(spark, "zebra", "", "the of", QUERY)
    got = search.search_top_k(built, queries, 2, stem=False)
    assert tuples(got.select("qid", "rank", "doc_id")) == [(3, 1, 0), (3, 2, 2)]


def test_term_in_every_document_scores_zero_in_id_order(spark):
    docs = spark.createDataFrame([(i, "train") for i in (4, 2, 9)], "doc_id long, text string")
    built = index.build_index(docs, lang_col=None, stem=False)
    got = search.search_top_k(built, ask(spark, "train"), 2, stem=False)
    assert tuples(got) == [(0, 1, 2, 0.0), (0, 2, 4, 0.0)]


def test_k_over_rows_and_bad_k(spark, built):
    assert search.search_top_k(built, ask(spark, QUERY), 50, stem=False).count() == 3
    with pytest.raises(ValueError):
        search.search_top_k(built, ask(spark, QUERY), 0, stem=False)


def test_idf(spark):
    terms = spark.createDataFrame([("a", 1), ("b", 10)], "term string, df long")
    assert tuples(search.idf(terms, 10).select("term", "idf")) == [("a", 1.0), ("b", 0.0)]


def test_lookup_of_absent_term(spark, built):
    words = spark.createDataFrame([("love",), ("zebra",), ("love",)], "term string")
    assert tuples(search.lookup_terms(built, words)) == [("love", 2, 0, 2), ("love", 2, 1, 1)]


def test_metadata_says_unknown(spark):
    hits = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "qid long, doc_id long")
    meta = spark.createDataFrame([(5, "Ana"), (7, "Eva")], "doc_id long, name string")
    want = [(1, 5, "Ana"), (1, 6, "Unknown"), (2, 5, "Ana")]
    for small in (True, False, None):
        got = search.attach_metadata(hits, meta, {"artist": "name"}, small=small)
        assert tuples(got) == want


def test_liketo(spark, songs):
    table = songs.withColumn("track_name", F.concat(F.lit("t"), "doc_id")).withColumn(
        "other", F.lit("zebra")
    )
    got = search.liketo(table, "text", "love", lang_col=None, stem=False).collect()
    assert got[0].asDict() == {
        "doc_id": 0, "title": "t0", "artist": "Unknown", "album": "Unknown",
        "release_date": "Unknown", "similarity": pytest.approx(got[0].similarity),
    }
    assert [r.doc_id for r in got] == [0, 1]
    narrow = search.liketo(table, "text", "train", ["title", "doc_id"], 2, lang_col=None)
    assert narrow.columns == ["title", "doc_id"] and narrow.count() == 2
    assert search.liketo(table, "other", "love", lang_col=None).count() == 0
    with pytest.raises(ValueError, match="unknown columns"):
        search.liketo(table, "text", "love", ["rating"])
    with pytest.raises(ValueError, match="unknown field"):
        search.liketo(table, "lyrics", "love")


def test_a_stored_index_gives_the_same_answers(spark, songs, tmp_path):
    from simsearch.operators.index import build_index
    from simsearch.sources import index_store

    path = str(tmp_path / "idx")
    index_store.write_index(build_index(songs, lang_col=None), path)
    stored = index_store.read_index(spark, path)
    for text in ("love trains", "zebra", ""):
        plain, held = (
            search.liketo(songs, "text", text, limit=3, lang="en", lang_col=None, index=i).collect()
            for i in (None, stored)
        )
        assert plain == held
    queries = ask(spark, "loved nights!", "zebra", "trains")
    for limit in (None, 2):
        assert tuples(search.match_any(None, "text", queries, limit, index=stored)) == tuples(
            search.match_any(songs, "text", queries, limit))


def test_match_any(spark, songs):
    queries = ask(spark, "loved nights!", "zebra", "trains")
    assert tuples(search.match_any(songs, "text", queries)) == [
        (0, 0), (0, 1), (0, 2), (2, 2), (2, 3), (2, 4)
    ]
    assert tuples(search.match_any(songs, "text", queries, 1)) == [(0, 0), (2, 2)]


def test_corpus_size_is_n(spark, songs):
    part = search.with_corpus(songs, 3, lang_col=None, stem=False)
    assert part.n_docs == 3
    assert part.postings.agg(F.max("doc_id")).first()[0] == 2
    assert search.with_corpus(songs, None, lang_col=None, stem=False).n_docs == 5


def test_salted_join_of_one_hot_key(spark):
    big = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    lookup = spark.createDataFrame([("hot", 1), ("7", 2), ("none", 3)], "k string, v int")
    plain = big.join(lookup, "k")
    for how, want in (("inner", plain), ("left", big.join(lookup, "k", "left")),
                      ("left_semi", big.join(lookup, "k", "left_semi")),
                      ("left_anti", big.join(lookup, "k", "left_anti"))):
        got = lookup_join(big, lookup, ["k"], how, broadcast=False)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hot = lookup_join(big, lookup, ["k"], broadcast=False).where("k = 'hot'")
    assert hot.count() == math.ceil(5_000 / 3)


def test_few_terms_reach_the_scan(spark, built, tmp_path):
    from simsearch.sources.index_store import read_index, write_index

    write_index(built, str(tmp_path / "i"))
    stored = read_index(spark, str(tmp_path / "i"))
    words = [f"w{i}" for i in range(20)] + ["lo\\ve'", QUERY]
    terms = analyze_queries(ask(spark, " ".join(words)), stem=False)
    narrowed = search.narrow(stored, terms)
    plan = narrowed.postings._jdf.queryExecution().toString()
    assert "PushedFilters: [In(term, [lo\\ve'" in plan
    assert narrowed.postings.count() == 4
    assert search.narrow(stored, terms, most=5).postings.count() == 10
    got = search.search_top_k(stored, None, 5, query_terms=terms)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [0, 2, 1]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A stored index of many documents: one word in all of them, rare ones in a few blocks."""
    import numpy as np

    from simsearch.sources.index_store import read_index, write_index

    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        words = ["all"] * int(rng.integers(1, 4)) + [f"w{w}" for w in rng.zipf(1.4, 12) if w < 400]
        rows.append((i - 50, " ".join(words + ["rare"] * (9 if i in (77, 300, 301) else i % 97 == 0))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path_factory.mktemp("skewed") / "i")
    write_index(index.build_index(docs, lang_col=None, stem=False), path, span=16)
    return read_index(spark, path)


def test_blocks_are_scored_where_they_were_dealt(spark, skewed, monkeypatch):
    """The scores of the wanted blocks, without a shuffle of pairs or of whole lists of block maxima."""
    queries = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w3 w5")], "qid long, text string")
    terms = analyze_queries(queries, stem=False)
    weights = materialize(search.query_weights(skewed, terms), "weights")
    wanted = search.block_bounds(skewed, weights).where("(block + qid) % 2 = 0").select("qid", "block").distinct()
    wanted = materialize(wanted, "wanted")
    found = search.score_blocks(skewed, weights, wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(block" in plan and "hashpartitioning(qid" not in plan
    blocks = {tuple(r) for r in wanted.collect()}
    want = [
        (r.qid, r.doc_id, round(r.similarity, 9)) for r in search.score(skewed, weights).collect()
        if (r.qid, r.doc_id // skewed.span) in blocks
    ]
    assert want and sorted((r.qid, r.doc_id, round(r.similarity, 9)) for r in found.collect()) == sorted(want)
    monkeypatch.setattr(index, "MAXIMA_ROWS", 500)
    maxima = index.block_maxima(skewed.postings, skewed.span)
    assert maxima.rdd.getNumPartitions() == math.ceil(skewed.postings.count() / 500) > 4
    assert sorted(maxima.collect()) == sorted(skewed.blocks.select(*maxima.columns).collect())
    assert "hashpartitioning" not in maxima._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("listed", [0, 1000])
def test_many_queries_are_not_listed_by_block(spark, skewed, monkeypatch, listed):
    monkeypatch.setattr(search, "LISTED_QUERIES", listed)
    queries = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w3 w5"), (3, "absent")], "qid long, text string")
    plain = tuples(search.search_top_k(skewed, queries, 3, stem=False, by_blocks=False))
    assert plain and tuples(search.search_top_k(skewed, queries, 3, stem=False, by_blocks=True)) == plain


@pytest.mark.parametrize("k", [1, 3, 10, 700])
def test_block_maxima_change_no_answer(spark, skewed, k):
    queries = ask(spark, "rare all", "w1 w2 w3 all", "w7 rare rare w50", "all", "absent", "w399 w1")
    plain = tuples(search.search_top_k(skewed, queries, k, stem=False, by_blocks=False))
    got = tuples(search.search_top_k(skewed, queries, k, stem=False, by_blocks=True))
    assert [r[:3] for r in got] == [r[:3] for r in plain]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in plain])


def test_blocks_that_cannot_answer_are_not_read(spark, skewed):
    terms = analyze_queries(ask(spark, "rare all", "w50 w60 w2"), stem=False)
    weights = search.query_weights(skewed, terms)
    judged = search.needed_blocks(skewed, weights, 3)
    total, read = judged.agg(F.sum("df"), F.sum(F.when(F.col("needed"), F.col("df")))).first()
    assert total == weights.agg(F.sum("df")).first()[0] and read < 0.5 * total


def test_pairs_before_a_limit_stay_few(spark):
    docs = spark.createDataFrame([(i, "train train love") for i in range(200)], "doc_id long, text string")
    queries = ask(spark, "train love", "train", "zebra")
    got = tuples(search.match_any(docs, "text", queries, 3, stem=False))
    assert got == [(q, d) for q in (0, 1) for d in range(3)]
    with pytest.raises(ValueError):
        search.match_any(docs, "text", queries, 0, stem=False)
    plan = search.match_any(docs, "text", queries, 3, stem=False)._jdf.queryExecution().toString()
    assert "WindowGroupLimit [term" in plan


@pytest.mark.parametrize("blocks, ranges", [(10**6, 10**6), (5, 40)])
def test_cells_of_queries_and_documents(spark, skewed, monkeypatch, blocks, ranges):
    from simsearch.operators import product

    monkeypatch.setattr(product, "_PAIRS", 50)
    texts = [f"w{i} w{i % 7} rare all" for i in range(12)] + ["absent", "all", "w1 w1 w2"]
    terms = analyze_queries(ask(spark, *texts), stem=False)
    weights = search.query_weights(skewed, terms, broadcast=True)
    want = search.score(skewed, weights, True)
    got = product.blocked_scores(skewed, weights, None, blocks, ranges)
    assert [(r[0], r[1]) for r in tuples(got)] == [(r[0], r[1]) for r in tuples(want)]
    assert [r[3] for r in tuples(got)] == pytest.approx([r[3] for r in tuples(want)])
    best = product.blocked_scores(skewed, weights, 4, blocks, ranges)
    plan = best._jdf.queryExecution().toString()
    assert "hashpartitioning(qid" not in plan
    key = ["qid", "rank", "doc_id"]
    assert tuples(search.top_k(best, 4).select(*key)) == tuples(search.top_k(want, 4).select(*key))
