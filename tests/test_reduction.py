import numpy as np
import pytest

from conftest import tuples
from simsearch.operators import neighbours, reduction


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.RandomState(3)
    matrix = rng.normal(size=(200, 6)) * [5, 3, 1, 0.5, 0.2, 0.1] + 10
    df = spark.createDataFrame(
        [(i, m.tolist()) for i, m in enumerate(matrix)], "vec_id long, embedding array<double>"
    )
    return matrix, df


def test_matches_eigenvectors(data):
    matrix, df = data
    model = reduction.fit_pca(df, 3)
    centred = matrix - matrix.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(centred.T))
    order = values.argsort()[::-1]
    for i in range(3):
        want = vectors[:, order[i]]
        want = want * np.sign(want[np.abs(want).argmax()])
        assert np.allclose(model.components[:, i], want, atol=1e-8)
    got = reduction.reduce_vectors(model, df).orderBy("vec_id").collect()
    assert np.allclose([r.embedding for r in got], centred @ model.components, atol=1e-8)


def test_variance_and_choice(data):
    matrix, df = data
    variance = reduction.explained_variance(df)
    rows = variance.orderBy("component").collect()
    values = np.sort(np.linalg.eigvalsh(np.cov(matrix.T)))[::-1]
    assert np.allclose([r.ratio for r in rows], values / values.sum(), atol=1e-9)
    assert rows[-1].cumulative == pytest.approx(1.0)
    want = int(np.argmax(np.cumsum(values / values.sum()) >= 0.985)) + 1
    assert reduction.choose_components(variance).first().components == want


def test_full_rank_keeps_neighbours(data):
    _, df = data
    queries = df.where("vec_id < 5").selectExpr("vec_id AS qid", "embedding AS q")
    model = reduction.fit_pca(df)
    near = neighbours.knn(
        reduction.reduce_vectors(model, df), reduction.reduce_queries(model, queries), 4
    )
    plain = neighbours.knn(df, queries, 4)
    for a, b in zip(tuples(near), tuples(plain), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-6)


def test_bad_component_count(data):
    with pytest.raises(ValueError):
        reduction.fit_pca(data[1], 7)
