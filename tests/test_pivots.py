import numpy as np
import pyarrow as pa
import pytest

from conftest import tuples
from simsearch.operators import neighbours, pivots
from simsearch.operators.blocks import Best, Screen, lengths


def frames(spark, matrix, queries, bad=()):
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)] + [(10_000 + i, v) for i, v in enumerate(bad)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    asked = [(i, v.tolist()) for i, v in enumerate(queries)] + [(20_000 + i, v) for i, v in enumerate(bad)]
    return vectors, spark.createDataFrame(asked, "qid long, q array<float>").repartition(3)


def clusters(seed, rows, centres=20, width=6, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width)) * 3
    return (middle[rng.integers(0, centres, rows)] + rng.normal(size=(rows, width)) * spread).astype(np.float32)


BAD = [[float("nan")] * 6, [None] + [0.0] * 5, [float("inf")] + [0.0] * 5, [3e38] * 6]


@pytest.fixture(params=["clusters", "uniform", "hot", "few"])
def tables(request, spark, monkeypatch):
    # Groups far smaller than cells and visits, so that both are split.
    monkeypatch.setattr(pivots, "GROUP_ROWS", 7)
    monkeypatch.setattr(pivots, "GROUP_QUERIES", 5)
    rng = np.random.default_rng(2)
    if request.param == "few":
        matrix, queries = rng.normal(size=(4, 6)).astype(np.float32), rng.normal(size=(9, 6)).astype(np.float32)
    elif request.param == "uniform":
        matrix, queries = rng.random((300, 6), np.float32), rng.random((40, 6), np.float32)
    else:
        matrix, queries = clusters(1, 300), clusters(1, 330)[290:]
    if request.param == "hot":  # a third of the vectors and of the queries are one
        matrix[::3], queries[::3] = matrix[0], matrix[0]
    return frames(spark, matrix, queries, BAD)


def test_cells_give_what_a_scan_gives(tables):
    vectors, queries = tables
    small = {"query_bytes": 0, "cell_rows": 12}
    for k in (5, 400):
        assert tuples(neighbours.knn(vectors, queries, k, **small)) == tuples(neighbours.knn(vectors, queries, k))
    for radius in (0.0, 0.3):
        got = tuples(neighbours.range_search(vectors, queries, radius, **small))
        assert got == tuples(neighbours.range_search(vectors, queries, radius))
    got = tuples(neighbours.knn_with_ties(vectors, queries, 5, **small))
    assert got == tuples(neighbours.knn_with_ties(vectors, queries, 5))


def test_most_pairs_are_not_compared(spark):
    matrix, queries = clusters(4, 3000, centres=60), clusters(4, 3400, centres=60)[3000:]
    vectors, asked = frames(spark, matrix, queries)
    hits, compared = pivots.nearest(vectors, asked, 5, cell_rows=20)
    assert hits is not None and compared < 0.1 * len(matrix) * len(queries)
    bounded = asked.selectExpr("qid", "q", "0.3D as radius")
    hits, compared = pivots.within(vectors, bounded, cell_rows=20)
    assert hits.count() and compared < 0.1 * len(matrix) * len(queries)
    # Where little can be left out a scan is better, and says so.
    none, compared = pivots.nearest(vectors, asked, 5, most_share=0.001, cell_rows=20)
    assert none is None and compared > 0.001 * len(matrix) * len(queries)


def test_nothing_to_compare(spark):
    vectors, queries = frames(spark, np.zeros((0, 6)), np.zeros((0, 6)), BAD[:3])
    some, asked = frames(spark, clusters(1, 20), clusters(2, 3))
    for left, right in ((vectors, asked), (some, queries), (vectors, queries)):
        assert neighbours.knn(left, right, 3, query_bytes=0).count() == 0
        assert neighbours.range_search(left, right, 1.0, query_bytes=0).count() == 0


def test_width_mismatch_is_an_error(spark):
    vectors, _ = frames(spark, clusters(1, 20), clusters(2, 3))
    asked = spark.createDataFrame([(1, [0.0, 1.0])], "qid long, q array<float>")
    with pytest.raises(Exception, match="different length"):
        neighbours.knn(vectors, asked, 3, query_bytes=0).count()


def test_a_query_travels_once_to_a_bin_in_small_batches():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(1024, 64))
    rows = np.full(1024, 100)
    bins = pivots._bins(rows, pivots.GROUP_ROWS)
    assert max(np.bincount(bins, weights=rows)) <= pivots.GROUP_ROWS and len(set(bins)) == 7
    # Uniform vectors: every cell has to be seen.
    cells = pivots.Cells(points, np.ones((1024, 1024)), rows, np.zeros(1024), np.full(1024, 9.0), 100.0, bins)

    class Shared:
        value = cells

    queries = rng.normal(size=(10_000, 64))
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(10_000)), pa.array(list(queries)), pa.array(np.full(10_000, 99.0)),
            pa.array([[0, 1]] * 10_000, pa.list_(pa.int32())),
        ],
        names=["qid", "_q", "radius", "homes"],
    )
    found = list(pivots._visiting(Shared, pivots._rest)(iter([batch])))
    assert sum(b.num_rows for b in found) == 7 * 10_000
    assert max(b.get_total_buffer_size() for b in found) < 16_000_000
    seen = sum(int(np.unpackbits(np.frombuffer(x, np.uint8)).sum()) for b in found for x in b["bits"].to_pylist())
    assert seen == 1022 * 10_000


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e4, 1), (0, 1e18), (0, 1e-18), (0, 1e60)])
def test_single_precision_leaves_nothing_out(shift, scale):
    rng = np.random.default_rng(6)
    vectors = (rng.normal(size=(3000, 8)) + shift) * scale
    queries = vectors[:40] + rng.normal(size=(40, 8)) * scale * 0.01
    exact = np.stack([lengths(vectors - q) for q in queries])
    limit = np.sort(exact, axis=1)[:, 7]
    among = rng.random(exact.shape) < 0.5
    for mask in (None, among):
        got = {(a, b, d) for q, v, x in Screen(vectors).near(queries, limit, mask) for a, b, d in zip(q, v, x)}
        rows, columns = np.nonzero((exact <= limit[:, None]) & (True if mask is None else mask))
        assert got == {(a, b, exact[a, b]) for a, b in zip(rows, columns)}
        best = Best(40, 5)
        for q, v, x in Screen(vectors).near(queries, best.key[:, -1], mask, 5):
            best.add(q, x, v, x)
        nearest = np.sort(exact if mask is None else np.where(mask, exact, np.inf), axis=1)[:, :5]
        assert (best.key == nearest).all()
