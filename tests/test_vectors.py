import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import tuples
from simsearch.functions.vectors import l2_distance
from simsearch.operators import distribution, lsh, neighbours
from simsearch.plans.selection import order_statistics


@pytest.fixture(scope="module")
def points(spark):
    rows = [(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [-3.0, 4.0]), (4, [6.0, 8.0]), (5, [1.0, 0.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.fixture(scope="module")
def origin(spark):
    return spark.createDataFrame([(0, [0.0, 0.0])], "qid long, q array<float>")


@pytest.fixture(scope="module")
def cloud(spark):
    """Random vectors of which a third are copies of one of them."""
    rng = np.random.RandomState(7)
    matrix = rng.normal(size=(300, 12)).astype(np.float32)
    matrix[::3] = matrix[0]
    ids = rng.permutation(300)
    df = spark.createDataFrame(
        [(int(i), m.tolist()) for i, m in zip(ids, matrix)], "vec_id long, embedding array<float>"
    ).repartition(5)
    queries = spark.createDataFrame(
        [(int(i), matrix[i].tolist()) for i in range(9)], "qid long, q array<float>"
    )
    return ids, matrix.astype(np.float64), df, queries


def brute(ids, matrix, query):
    distance = np.sqrt(((matrix - matrix[query]) ** 2).sum(axis=1))
    return sorted(zip(distance, ids))


PATHS = pytest.mark.parametrize("query_bytes", [1 << 25, 0], ids=["shared", "blocks"])


def test_goldens(points, origin):
    near = neighbours.knn(points, origin, 3)
    assert tuples(near) == [(0, 1, 1, 0.0), (0, 2, 5, 1.0), (0, 3, 2, 5.0)]
    assert neighbours.knn(points, origin, 10).count() == 5
    ties = neighbours.knn_with_ties(points, origin, 3)
    assert sorted(r.vec_id for r in ties.collect()) == [1, 2, 3, 5]
    within = neighbours.range_search(points, origin, 5)
    assert sorted(r.vec_id for r in within.collect()) == [1, 2, 3, 5]
    assert [r.vec_id for r in neighbours.range_search(points, origin, 0).collect()] == [1]
    every = neighbours.distances(points, origin)
    assert [r.distance for r in every.orderBy("vec_id").collect()] == [0, 5, 5, 10, 1]


BAD = {
    "nan": [float("nan")] * 12, "null": [None] + [0.0] * 11, "infinite": [float("inf")] + [0.0] * 11,
    "huge": [3e38] * 12,
}


@PATHS
@pytest.mark.parametrize("kind", list(BAD))
def test_a_bad_vector_takes_no_other_with_it(spark, cloud, query_bytes, kind):
    _, _, df, queries = cloud
    bad = spark.createDataFrame([(10_000, BAD[kind])], "vec_id long, embedding array<float>")
    mixed = df.unionByName(bad).coalesce(1)
    asked = queries.unionByName(bad.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q")))
    for found in (
        lambda v, q: neighbours.knn(v, q, 5, query_bytes=query_bytes),
        lambda v, q: neighbours.range_search(v, q, 4.0, query_bytes=query_bytes),
        lambda v, q: neighbours.knn_with_ties(v, q, 5, query_bytes=query_bytes),
    ):
        good = [r for r in tuples(found(mixed, asked)) if r[0] != 10_000]
        assert good == tuples(found(df, queries))
    near = [r for r in tuples(neighbours.distances(mixed, queries)) if r[1] != 10_000]
    assert near == tuples(neighbours.distances(df, queries))


@PATHS
def test_knn_is_exact(cloud, query_bytes):
    ids, matrix, df, queries = cloud
    got = neighbours.knn(df, queries, 7, query_bytes=query_bytes).orderBy("qid", "rank").collect()
    assert len(got) == 9 * 7
    for q in range(9):
        want = brute(ids, matrix, q)[:7]
        mine = [r for r in got if r.qid == q]
        assert [r.vec_id for r in mine] == [i for _, i in want]
        assert np.allclose([r.distance for r in mine], [d for d, _ in want], atol=1e-12)


@PATHS
def test_range_and_ties_are_exact(cloud, query_bytes):
    ids, matrix, df, queries = cloud
    near = tuples(neighbours.range_search(df, queries, 4.0, query_bytes=query_bytes))
    want = [(q, i) for q in range(9) for d, i in brute(ids, matrix, q) if d <= 4.0]
    assert [(q, i) for q, i, _ in near] == sorted(want)
    ties = tuples(neighbours.knn_with_ties(df, queries, 4, query_bytes=query_bytes))
    want = []
    for q in range(9):
        ranked = brute(ids, matrix, q)
        want += [(q, i) for d, i in ranked if d <= ranked[3][0]]
    assert [(q, i) for q, i, _ in ties] == sorted(want)
    assert len(ties) > 3 * 100


def test_knn_lies_within_its_last_distance(cloud):
    _, _, df, queries = cloud
    one = queries.where("qid = 1")
    near = neighbours.knn(df, one, 5)
    radius = near.agg(F.max("distance")).first()[0]
    found = {r.vec_id for r in neighbours.range_search(df, one, radius).collect()}
    assert {r.vec_id for r in near.collect()} <= found


def test_no_queries_no_rows(points, origin):
    assert neighbours.knn(points, origin.where("false"), 3).count() == 0


def test_wrong_length_raises(spark, points):
    query = spark.createDataFrame([(0, [1.0])], "qid long, q array<float>")
    with pytest.raises(Exception, match="vectors of different length: 2 and 1"):
        neighbours.knn(points, query, 1).collect()
    pair = spark.createDataFrame([([1.0], [1.0, 2.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="vectors of different length: 1 and 2"):
        pair.select(l2_distance(F.col("a"), F.col("b"))).collect()


def test_bad_arguments(points, origin):
    for call in (neighbours.knn, lsh.knn_lsh):
        with pytest.raises(ValueError):
            call(points, origin, 0)
    with pytest.raises(ValueError):
        neighbours.range_search(points, origin, -1)


@pytest.mark.parametrize("nbits", [8, 64, 130])
def test_signatures(cloud, nbits):
    ids, matrix, df, _ = cloud
    signed = {r.vec_id: r.signature for r in lsh.lsh_signature(df, nbits).collect()}
    planes = lsh.hyperplanes(nbits, 12)
    assert set(np.unique(planes)) == {-1, 1}
    for i, row in zip(ids, matrix):
        bits = sum(1 << b for b, p in enumerate(planes) if p @ row >= 0)
        words = [(bits >> (64 * w)) & (2**64 - 1) for w in range(-(-nbits // 64))]
        assert [s & (2**64 - 1) for s in signed[int(i)]] == words


@PATHS
def test_hamming_and_rerank(cloud, query_bytes):
    ids, matrix, df, queries = cloud
    signed = lsh.lsh_signature(df, 64)
    asked = lsh.lsh_signature(queries, 64, id_col="qid", vector_col="q")
    codes = lsh.hamming_top_k(signed, asked, 5, query_bytes)
    planes = lsh.hyperplanes(64, 12)
    signs = matrix @ planes.T >= 0
    want = []
    for q in range(9):
        order = sorted(zip((signs != signs[q]).sum(axis=1), ids))[:5]
        want += [(q, rank + 1, int(i), int(h)) for rank, (h, i) in enumerate(order)]
    assert tuples(codes) == want
    ranked = lsh.knn_lsh(df, queries, 5, 64, query_bytes=query_bytes)
    assert {(r.qid, r.vec_id) for r in ranked.collect()} == {(q, i) for q, _, i, _ in want}
    stored = lsh.knn_lsh(df, queries, 5, 64, signatures=signed, query_bytes=query_bytes)
    for a, b in zip(tuples(ranked), tuples(stored), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert all(r.hamming == 0 for r in ranked.where("rank = 1").collect())


@PATHS
@pytest.mark.parametrize("kind", list(BAD))
def test_bad_vectors_have_no_signature(spark, cloud, query_bytes, kind):
    _, _, df, queries = cloud
    bad = spark.createDataFrame([(10_000, BAD[kind])], "vec_id long, embedding array<float>")
    mixed = df.unionByName(bad)
    asked = queries.unionByName(bad.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q")))
    signed = lsh.lsh_signature(mixed, 32)
    direct = lsh.knn_lsh(mixed, asked, 7, 32, query_bytes=query_bytes)
    stored = lsh.knn_lsh(mixed, asked, 7, 32, signatures=signed, query_bytes=query_bytes)
    for a, b in zip(tuples(direct), tuples(stored), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    if kind != "huge":
        assert signed.count() == df.count() and direct.where("qid = 10000 or vec_id = 10000").count() == 0


def test_lsh_on_a_small_collection(points, origin):
    assert lsh.knn_lsh(points, origin, 10, 16).count() == 5


def test_recall_rises_with_bits(cloud):
    _, _, df, queries = cloud
    true = {(r.qid, r.vec_id) for r in neighbours.knn(df, queries, 5).collect()}
    recall = [
        len(true & {(r.qid, r.vec_id) for r in lsh.knn_lsh(df, queries, 5, n).collect()})
        for n in (8, 512)
    ]
    assert recall[0] < recall[1]


@pytest.mark.parametrize("exact_rows", [1_000_000, 0])
def test_percentiles(spark, exact_rows):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "distance double")
    got = tuples(distribution.distance_percentiles(df, (10, 90), exact_rows=exact_rows))
    assert got == [(10.0, pytest.approx(1.2)), (90.0, pytest.approx(3.6))]


@pytest.mark.parametrize("ranges", [1, 7])
def test_order_statistics_with_hot_value(spark, ranges):
    values = [5] * 400 + list(range(800))
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(4)
    ranks = [0, 4, 5, 300, 405, 406, 1199]
    assert order_statistics(df, "x", ranks, ranges) == [sorted(values)[r] for r in ranks]
    with pytest.raises(ValueError):
        order_statistics(df, "x", [1200], ranges)


def test_order_statistics_keep_large_ids(spark):
    base = 2**60
    df = spark.range(base, base + 1000)
    assert order_statistics(df, "id", [0, 501], 5) == [base, base + 501]


def test_histogram(spark):
    values = [0.0, 0.1, 0.5, 0.99, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "distance double")
    rows = distribution.distance_histogram(df, 4).orderBy("bin").collect()
    assert [r.n for r in rows] == np.histogram(values, 4)[0].tolist()
    assert rows[-1].high == pytest.approx(1.0)
    same = distribution.distance_histogram(df.where("distance = 1"), 3)
    assert same.agg(F.sum("n")).first()[0] == 1
    assert distribution.distance_histogram(df.where("false"), 3).count() == 0


def test_tracks_keep_rank(spark):
    hits = spark.createDataFrame([(0, 1, "037156", 0.5)], "qid long, rank long, vec_id string, distance double")
    tracks = spark.createDataFrame([(37156, "Song")], "track_id long, track_title string")
    got = neighbours.attach_tracks(hits, tracks, "track_id", ["track_title"])
    assert tuples(got) == [(0, 1, "037156", 0.5, "Song")]
