"""Whitening against exact sums and a library's eigenvectors."""

from fractions import Fraction

import numpy as np
import pytest

from scholarmill.llm import eigen, whitening


def test_eigenvectors_of_hard_matrices():
    draw = np.random.default_rng(0)
    turn = np.linalg.qr(draw.normal(size=(40, 40)))[0]
    size = 21
    beside = np.diag(np.ones(size - 1), 1)
    cases = [np.cov(draw.normal(size=(30, 300))), np.eye(5), np.ones((6, 6)), np.zeros((4, 4)), np.array([[2.0]]), np.array([[2.0, 1], [1, 2]]),
             np.diag([3.0, 3, 3, 2, 2, 1]), turn @ np.diag(np.r_[np.full(15, 5.0), np.full(25, 1.0)]) @ turn.T,
             turn @ np.diag(np.logspace(0, -12, 40)) @ turn.T, np.diag(np.abs(np.arange(size) - 10.0)) + beside + beside.T,
             1e200 * np.cov(draw.normal(size=(8, 50))), -np.eye(3), np.diag([0.0, 0.0, 7.0])]
    for matrix in cases:
        for wanted in (1, len(matrix), 100):
            values, vectors = eigen.leading(matrix, wanted)
            scale = np.abs(matrix).max() or 1.0
            expected = np.linalg.eigvalsh(matrix)[::-1][:wanted]
            assert len(values) == len(vectors) == min(wanted, len(matrix))
            assert np.allclose(values, expected, rtol=0, atol=1e-14 * scale * len(matrix))
            assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-13
            assert np.abs(matrix @ vectors.T - vectors.T * values).max() < 1e-13 * scale * len(matrix)
    assert eigen.leading(np.zeros((0, 0)), 3)[1].shape == (0, 0)


def brute(rows, components=32):
    """Exact sums and covariance as fractions; the eigenvectors are the library's."""
    rows = [(k, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for k, v in rows]
    n, size = len(rows), len(rows[0][1])
    total = [sum(x[i] for _, x in rows) for i in range(size)]
    off = [[Fraction(x[i]) - Fraction(total[i], n) for i in range(size)] for _, x in rows]
    spread = np.array([[float(sum(o[i] * o[j] for o in off) / n) for j in range(size)] for i in range(size)])
    values, axes = np.linalg.eigh(spread)
    values, axes = values[::-1][:components], axes.T[::-1][:components]
    deviation = [sum((n * x[i] - total[i]) ** 2 for i in range(size)) for _, x in rows]
    return n, deviation, values, (np.array(off, dtype=float) @ axes.T) / np.sqrt(values), values / np.trace(spread)


def check(out, rows):
    n, deviation, values, whitened, explained = brute(rows)
    found = {}
    for r in out:
        found.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(found) == sorted(k for k, _ in rows)
    for at, (key, _) in enumerate(rows):
        own = found[key]
        assert sorted(own) == list(range(1, len(values) + 1))
        assert {(r.n, r.deviation) for r in own.values()} == {(n, deviation[at])}
        assert np.allclose([abs(own[c].whitened) for c in sorted(own)], np.abs(whitened[at]), rtol=1e-9, atol=1e-9)
        assert np.allclose([own[c].explained for c in sorted(own)], explained, rtol=1e-9)
        assert {r.identity_error for r in own.values()} == {out[0].identity_error} and out[0].identity_error < 1e-9
    signs = np.array([[np.sign(found[k][c + 1].whitened * whitened[i, c]) for c in range(len(values))] for i, (k, _) in enumerate(rows)])
    assert all(len(set(s) - {0}) == 1 for s in signs.T)


def test_equals_brute_force(spark):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(160, 7)) * np.array([9, 5, 3, 2, 1.2, .7, .4])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base.astype("float32"))]
    odd = [(900, None), (901, [1.0] * 6 + [None]), (902, [float("nan")] * 7), (903, [float("inf")] + [0.0] * 6), (904, []), (905, [1.0, 2.0]),
           (906, [1e38] * 7)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS vector", "2 AS n", "3 AS component", "4 AS whitened").repartition(5)
    check(whitening.whiten(frame).collect(), rows)


def test_partitions_and_large_entries_change_no_digit(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(draw.normal(size=(60, 3)) * [1e9, 4e6, 1.0] + [7e11, 0.0, -3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one, five = (sorted(map(tuple, whitening.whiten(f, components=2).drop("identity_error").collect())) for f in (frame.coalesce(1), frame.repartition(5)))
    assert one == five
    n, deviation, _, whitened, _ = brute(rows, 2)
    assert [r[3] for r in one[::2]] == deviation and max(deviation) > 1 << 62
    assert np.allclose(np.abs([[a[4], b[4]] for a, b in zip(one[::2], one[1::2])]), np.abs(whitened), rtol=1e-7)
    assert {r.deviation for r in whitening.digests(whitening.whiten(frame)).filter("vec_id = 0").collect()} == {
        deviation[0] if deviation[0] < 1 << 63 else None}


def test_rank_repeats_and_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [None])], schema)).collect() == []
    # one vector alone, or the same one over and over, has no variance
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 4, schema)).collect() == []
    # two of three dimensions agree: two components are left; a repeated row and a null id count
    rows = [(1, [1.0, 1.0, 5.0]), (2, [2.0, 2.0, 1.0]), (2, [2.0, 2.0, 1.0]), (None, [7.0, 7.0, 0.0]), (3, [0.0, 0.0, 0.0])]
    out = whitening.whiten(spark.createDataFrame(rows, schema)).collect()
    assert {r.component for r in out} == {1, 2} and len(out) == 10 and out[0].n == 5 and out[0].identity_error < 1e-9
    assert sum(r.vec_id is None for r in out) == 2


def test_query_returns_the_contract(spark):
    pytest.importorskip("public_tokenizers")
    from scholarmill.llm.queries import QUERIES

    out = QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    n = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()
    assert out.count() == 32 * out.first().n and out.first().n <= n and out.first().identity_error < 1e-9
