import math
import random

import numpy as np
import pytest

import cases
from snapweave.llm import vafile, workload


def rows_of(seed, n, dim=12, spread=1.0):
    rng = random.Random(seed)
    return [(i, [float(np.float32(rng.gauss(0, spread))) for _ in range(dim)], None) for i in range(n)]


def brute(rows, k=5):
    whole = {}
    for vec_id, x, _ in rows:
        if vec_id is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            whole[vec_id] = [math.floor(256 * c) for c in x]
    out = []
    for q, v in whole.items():
        if q % 50 == 0:
            scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in whole.items() if i != q and len(w) == len(v)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def answer(spark, path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    got = workload.op1_exact_top_k(spark, str(path))
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("block, query_block", [(8192, 2048), (60, 4)])
def test_odd_vectors(spark, tmp_path, monkeypatch, block, query_block):
    """Ties, a vector shared by a third of the rows, outliers, other lengths, rows that take no part."""
    monkeypatch.setattr(vafile, "BLOCK", block)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", query_block)
    rows = rows_of(1, 420)
    rows = [(i, rows[0][1], None) if i % 3 == 0 else (i, x, l) for i, x, l in rows]
    rows[100] = (100, [float(np.float32(c * 5000)) for c in rows[101][1]], None)
    rows[7] = (7, [float(np.float32(c * 5000)) for c in rows[8][1]], None)
    rows += [(500, [1.0, 2.0], 1), (501, [0.5, -2.0], 1), (550, [], 1), (551, [], 1), (600, [0.0] * 12, 1)]
    rows += [(650, None, 1), (651, [math.nan] * 12, 1), (700, [None] + [1.0] * 11, 1), (701, [math.inf] * 12, 2)]
    rows += [(None, rows[1][1], 1), rows[50], rows[50], rows[51]]
    assert answer(spark, tmp_path, rows) == brute(rows)


def test_blocks_are_not_broadcast(spark, tmp_path, monkeypatch):
    """The files of a few queries are small, their copies for every block of vectors are not."""
    monkeypatch.setattr(vafile, "BLOCK", 20)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 16)
    rows = rows_of(3, 600, dim=2048)
    limits = {"spark.sql.autoBroadcastJoinThreshold": "10m", "spark.sql.maxBroadcastTableSize": "6m"}
    usual = {name: spark.conf.get(name) for name in limits}
    try:
        for name, value in limits.items():
            spark.conf.set(name, value)
        assert answer(spark, tmp_path, rows) == brute(rows)
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def test_few_candidates(spark, tmp_path):
    rows = rows_of(2, 3)
    assert answer(spark, tmp_path, rows) == brute(rows)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    v = np.vstack([rng.integers(-s, s + 1, (50, 9)) for s in (1, 100, 127, 128, 129, 5000, 1 << 20)])
    q = rng.integers(-300, 300, (20, 9))
    cells, shifts = vafile.approximate(v)
    lowest = cells.astype(np.int64) << shifts[:, None].astype(np.int64)
    assert ((lowest <= v) & (v < lowest + (1 << shifts[:, None].astype(np.int64)))).all()
    low, high = vafile.bounds(cells, shifts, q)
    exact = v @ q.T
    assert ((low <= exact) & (exact <= high)).all()
    assert ((high - low)[:100] < 5).all()


def test_huge_components_do_not_crash(spark, tmp_path):
    rows = rows_of(5, 60) + [(100, [1e30] * 12, 1), (101, [-1e30] * 12, 1)]
    got = answer(spark, tmp_path, rows)
    assert len({g[0] for g in got}) >= 2


def test_empty_table(spark, empty_folder):
    assert workload.op1_exact_top_k(spark, empty_folder).count() == 0
