import math

import numpy as np
import pytest

from snapweave.llm import bidiagonal, whitening, workload

SCHEMA = "vec_id long, embedding array<float>, label int, length string, whitened string, n int"


def exact(vectors):
    """Integer vectors, their covariance's eigenvalues and eigenvectors by numpy, exact deviations."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [[n * c - s for c, s in zip(v, sums)] for v in x]
    centred = np.array(deviations, float) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return n, [sum(d * d for d in v) for v in deviations], centred, values[::-1], directions[:, ::-1]


def checked(got, vectors, most=8):
    """Rows for ``(vec_id, vector)`` pairs against numpy; vectors of one length, ids unique."""
    ids = [i for i, _ in vectors]
    n, deviations, centred, values, directions = exact([v for _, v in vectors])
    count = min(most, len(values))
    assert len(got) == n * count
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    by = {(r.vec_id, r.component): r for r in got}
    for k in range(count):
        rows = [by[i, k + 1] for i in ids]
        assert [r.deviation for r in rows] == [d if d < 1 << 63 else None for d in deviations]
        assert all(abs(r.explained - values[k] / values.sum()) < 1e-9 for r in rows)
        mine = np.array([r.whitened for r in rows])
        want = centred @ directions[:, k] / np.sqrt(values[k])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7
    assert got[0].identity_error < 1e-9


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    made = (rng.normal(size=(300, 24)) @ np.diag(1.2 ** -np.arange(24.0)) * 0.3 + 0.1).astype(np.float32)
    return [(i, v.tolist()) for i, v in enumerate(made)]


@pytest.mark.parametrize("parts", [1, 40])
def test_against_numpy(spark, vectors, parts, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    monkeypatch.setattr(whitening, "_BLOCK", 500)
    odd = [(900, None, 1, "a", "b", 2), (901, [1.0] * 23 + [None], 1, "a", "b", 2)]
    odd += [(902, [float("nan")] * 24, 1, "a", "b", 2), (903, [float("inf")] * 24, None, None, None, None), (904, [3e38] * 24, 1, "", "", 0)]
    table = spark.createDataFrame([(i, v, 1, "x", "y", 3) for i, v in vectors] + odd, SCHEMA).repartition(parts)
    checked(whitening.components(table).collect(), vectors)


def test_hot_vector_and_repeats(spark, vectors):
    """A third of the rows one vector, with and without an id: each row counts."""
    hot = vectors[:60] + [(1000 + i, vectors[3][1]) for i in range(30)]
    table = spark.createDataFrame([(i, v, 1, "x", "y", 3) for i, v in hot], SCHEMA)
    checked(whitening.components(table).collect(), hot)
    doubled = whitening.components(table.union(table)).collect()
    assert len(doubled) == 2 * 90 * 8 and doubled[0].n == 180
    assert whitening.components(table.limit(20).union(spark.createDataFrame([(None, vectors[5][1], 1, "", "", 0)], SCHEMA))).filter("vec_id is null").count() == 8


def test_lengths_apart(spark):
    rng = np.random.default_rng(8)
    short, long = [(i, rng.normal(size=3).tolist()) for i in range(40)], [(100 + i, rng.normal(size=9).tolist()) for i in range(50)]
    table = spark.createDataFrame([(i, v, 1, "", "", 0) for i, v in short + long + [(500, [])]], SCHEMA.replace("float", "double"))
    got = whitening.components(table).collect()
    checked([r for r in got if r.vec_id < 100], short)
    checked([r for r in got if 100 <= r.vec_id < 500], long)
    assert not [r for r in got if r.vec_id == 500]
    assert whitening.whiten(table).filter("vec_id = 500").count() == 1


def test_without_variance(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0, float(i % 2)], 1, "", "", 0) for i in range(6)], SCHEMA)
    got = whitening.components(table).collect()
    assert sorted({(r.component, r.whitened is None, round(r.explained, 9)) for r in got}) == [(1, False, 1.0), (2, True, 0.0), (3, True, 0.0)]
    one = whitening.components(table.limit(1)).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation, r.n) for r in one] == [(None, None, None, 0, 1)] * 3


def test_beyond_64_bits(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.normal(size=2) * 10.0 ** (i % 12)).tolist()) for i in range(64)]
    table = spark.createDataFrame([(i, v, 1, "", "", 0) for i, v in vectors], SCHEMA.replace("float", "double"))
    checked(whitening.components(table).collect(), vectors)


def test_query(spark, tmp_path, empty_folder):
    rng = np.random.default_rng(6)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 16)).astype(np.float32))]
    spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    checked(workload.op11_whitening(spark, str(tmp_path)).collect(), vectors)
    assert workload.op11_whitening(spark, empty_folder).count() == 0


def shapes():
    rng = np.random.default_rng(1)
    turned = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    wilkinson = np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1) + 2 * np.eye(21)
    yield from [rng.normal(size=(50, 50)), np.diag(2.0 ** -np.arange(40.0)) @ turned, np.eye(9), np.zeros((5, 5)), np.ones((7, 7))]
    yield from [np.diag([3.0] * 5 + [2] * 3 + [1] * 32) @ turned, np.diag([3, 3 + 1e-9, 3 + 1e-12] + [2.0] * 37) @ turned]
    yield from [np.linalg.cholesky(wilkinson).T, np.array([[2.0]]), np.vstack([rng.normal(size=(4, 12)), np.zeros((8, 12))])]
    for _ in range(60):
        size = int(rng.integers(1, 30))
        yield rng.normal(size=(size, size)) * 10.0 ** rng.integers(-8, 8, size=size)


def test_solver():
    """Values and vectors of plain, graded, clustered, singular and badly scaled matrices."""
    for a in shapes():
        count = min(8, len(a))
        squares, vectors = bidiagonal.right_vectors(a, count)
        want = np.linalg.svd(a, compute_uv=False)[:count] ** 2
        top = max(want[0], 1e-300)
        assert np.abs(squares - want).max() <= 1e-12 * top
        assert np.abs(vectors @ vectors.T - np.eye(count)).max() < 1e-9
        assert np.abs(a.T @ (a @ vectors.T) - vectors.T * squares).max() <= 1e-11 * top


def test_small_values_are_accurate():
    """dqds finds the tiny values of a graded bidiagonal matrix to many digits of their own."""
    size = 30
    a, b = 10.0 ** -np.arange(size), 10.0 ** -np.arange(size - 1.0) * 0.5
    got = sorted(bidiagonal.dqds(a**2, b**2))
    # the product of all is the determinant, whose factors are known
    assert abs(sum(map(math.log, got)) - 2 * sum(map(math.log, a.tolist()))) < 1e-10
