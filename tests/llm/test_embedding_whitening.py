import math

import numpy as np
import pytest

from atende.llm import embedding_whitening as w


def scatter(x):
    c = x - x.mean(0)
    return c.T @ c


def same(s, x):
    assert s.n == len(x) and np.allclose(s.mean, x.mean(0))
    back = s.vectors * s.values @ s.vectors.T
    exact = scatter(x)
    assert np.abs(back - exact).max() <= 1e-11 * max(1.0, np.abs(exact).max())
    assert np.abs(s.vectors.T @ s.vectors - np.eye(x.shape[1])).max() < 1e-11
    assert (np.diff(s.values) >= 0).all()


def cases():
    r = np.random.default_rng(0)
    yield r.normal(size=(200, 12))
    yield np.repeat(r.normal(size=(5, 8)), 4, 0)  # repeated vectors, low rank
    yield np.ones((6, 3))
    yield np.eye(9)  # equal eigenvalues
    yield np.vstack([np.eye(7) * 1e6, -np.eye(7) * 1e-6, np.eye(7)])
    yield r.normal(size=(60, 10)) * 10.0 ** np.arange(-8, 2)
    yield np.round(r.normal(size=(300, 5)) * 2)
    yield r.normal(size=(30, 1))


@pytest.mark.parametrize("x", list(cases()))
def test_rank_one_updates(x):
    s = w.Spectrum(x.shape[1])
    for row in x:
        s.add(row)
    same(s, x)


@pytest.mark.parametrize("x", list(cases()))
def test_spectra_combine(x):
    parts = []
    for own in np.array_split(x, 4):
        parts.append(w.Spectrum(x.shape[1]))
        for row in own:
            parts[-1].add(row)
    for p in parts[1:]:
        parts[0].merge(p)
    same(parts[0], x)


def test_secular_roots():
    r = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        d, z = np.sort(r.normal(size=k) * 5), r.normal(size=k)
        away, roots = w.secular_roots(d, z, 0.7)
        assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + 0.7 * np.outer(z, z)), rtol=1e-12, atol=1e-12)
        assert np.allclose(away, d - roots[:, None])


def brute(rows, components=16):
    """{(position, component): values} with numpy on the whole list."""
    sound = [i for i, v in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v)]
    out = {}
    for dim in {len(rows[i]) for i in sound}:
        own = [i for i in sound if len(rows[i]) == dim]
        x = {i: tuple(math.floor(64 * c) + 1_000_000 for c in rows[i]) for i in own}
        fit = sorted(set(x.values()))
        n, sums = len(fit), [sum(v) for v in zip(*fit)]
        c = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
        e, u = np.linalg.eigh(c.T @ c / n)
        rank = [k for k in np.argsort(-e)[:components] if e[k] > 1e-12 * e.max()]
        for i in own:
            deviation = sum((n * a - s) ** 2 for a, s in zip(x[i], sums))
            off = np.array([(n * a - s) / n for a, s in zip(x[i], sums)])
            for k, at in enumerate(rank, 1):
                out[i, k] = (n, deviation, off @ u[:, at] / math.sqrt(e[at]), e[at] / e.sum())
    return out


def check(got, expected):
    assert {(r.vec_id, r.component) for r in got} == set(expected) and len(got) == len(expected)
    sign = {}
    for r in got:
        n, deviation, whitened, explained = expected[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and math.isclose(r.explained, explained, rel_tol=1e-9)
        assert math.isclose(abs(r.whitened), abs(whitened), rel_tol=1e-7, abs_tol=1e-8) and r.identity_error < 1e-9
        if abs(whitened) > 1e-6:
            assert sign.setdefault((n, r.component), r.whitened * whitened > 0) == (r.whitened * whitened > 0)


def test_given_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = {r.vec_id: list(r.embedding) for r in table.collect()}
    assert sorted(rows) == list(range(len(rows)))
    check(w.whiten(table.repartition(5)).collect(), brute([rows[i] for i in range(len(rows))]))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(2)
    rows = [None, [], [1.0, nan], [inf, 1.0], [1.0, None], [0.0, 0.0], [1.5, -2.25], [1.5, -2.25], [-3.0, 1.0], [0.0, 7.0], [1.0, 2.0, 3.0], [4.0, 4.0, 4.5], [9.0]]
    rows += r.normal(size=(40, 20)).tolist() + [[1e9 * k, 1e7, -1e9 * k * k, 0.1 * k] for k in range(5)]
    df = spark.createDataFrame([(i, v, "x") for i, v in enumerate(rows)], "vec_id long, embedding array<double>, n string")
    expected = brute(rows)
    for key, (n, deviation, a, b) in expected.items():
        expected[key] = (n, deviation if deviation < 1 << 63 else None, a, b)
    assert any(x[1] is None for x in expected.values())
    check(w.whiten(df.repartition(7)).collect(), expected)
    assert w.whiten(df.where("vec_id < 5")).count() == 0 and w.whiten(df.where("vec_id = 12")).count() == 0
    again = spark.createDataFrame([(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [3.0, 2.0]), (2, [1e300, 0.0])], "vec_id long, embedding array<double>")
    assert sorted((x.vec_id or 0, x.component, x.n, x.deviation) for x in w.whiten(again).collect()) == [(0, 1, 2, 128**2), (1, 1, 2, 128**2), (1, 1, 2, 128**2)]
