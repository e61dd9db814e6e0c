import numpy as np
import pytest

from flowmart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, v string, n int"


def table(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", "v", 3) for k, v in rows], SCHEMA)


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, dim)) * spread**np.arange(dim)).astype(np.float32)


def brute(rows, k):
    sound = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(np.int64) + 10**6) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    fit = np.unique(np.array([x for _, x in sound]), axis=0)
    n, s = len(fit), [int(c) for c in fit.sum(axis=0)]
    c = (fit - 10**6) - (np.array(s) - n * 10**6) / n
    values, base = np.linalg.eigh(c.T @ c / n)
    values, base = values[::-1][:k], base[:, ::-1][:, :k]
    out = {}
    for i, x in sound:
        far = sum((n * int(a) - b) ** 2 for a, b in zip(x, s))
        w = ((x - 10**6) - (np.array(s) - n * 10**6) / n) @ base / np.sqrt(values)
        out.setdefault(i, []).append((far, w))
    return out, values / np.trace(c.T @ c / n), n


@pytest.mark.parametrize("dim, spread, seed", [(64, 1.0, 1), (90, 0.9, 2), (64, 0.5, 3), (5, 1.0, 4), (1, 1.0, 5)])
def test_equals_the_full_decomposition(spark, dim, spread, seed):
    data = [(i, v.tolist()) for i, v in enumerate(vectors(400, dim, seed, spread) * 3)]
    data += [(1000 + i, data[0][1]) for i in range(50)] + [(5, data[7][1]), (None, data[8][1]), (6, None), (7, [None] * dim), (8, [float("nan")] * dim), (9, [float("inf")] * dim)]
    got = whitening.whiten(table(spark, data)).collect()
    want, shares, n = brute(data, 16)
    k = int((shares > 1e-12 * shares[0]).sum())
    assert len(got) == sum(map(len, want.values())) * k
    assert all(r.n == n and r.identity_error < 1e-8 and r.residual <= 1e-11 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[(int(r.deviation), r.component)] = r
        assert abs(r.explained - shares[r.component - 1]) < 1e-9 * shares[r.component - 1]
    turn = np.ones(k)
    for i, found in want.items():
        assert {d for d, _ in by[i]} == {d for d, _ in found}
    for c in range(k):  # either sign, the same for all rows
        pairs = [(by[i][(d, c + 1)].whitened, w[c]) for i, found in want.items() for d, w in found]
        turn[c] = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - turn[c] * b) for a, b in pairs) < 1e-7


def test_equal_vectors_empty_tables_and_odd_lengths(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [])])).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_directions_without_variance_have_no_rows(spark):
    data = [(i, [float(i), float(i), 5.0, 0.0]) for i in range(40)]
    got = whitening.whiten(table(spark, data)).collect()
    assert {r.component for r in got} == {1} and len(got) == 40 and abs(got[0].explained - 1) < 1e-12


def test_eigenpairs_of_hard_spectra():
    rng = np.random.default_rng(0)
    for values in (np.geomspace(1e8, 1e-3, 200), 1 + 1e-3 * rng.random(150), np.r_[1e6, 1e6, np.linspace(2, 1, 118)], np.r_[[5.0] * 3, [0.0] * 97]):
        base = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
        matrix = (base * values) @ base.T
        found, vectors, worst = whitening.eigenpairs(lambda q: matrix @ q, len(values), 16)
        want = np.sort(values)[::-1][:16]
        assert np.abs(found - want).max() <= 1e-12 * want[0] * len(values)
        assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() <= 1e-10 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12
