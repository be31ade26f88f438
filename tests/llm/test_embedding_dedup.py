import numpy as np

from atende.llm import embedding_dedup as e


def brute(ids, x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    root = np.arange(len(ids))
    while True:
        new = np.array([min([root[i], *root[near[i]]]) for i in range(len(ids))])
        if (new == root).all():
            return near.sum(1), root
        root = new


def test_links_are_exact_and_recall_is_high(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(150, 64))
    noise = rnd.normal(size=(150, 64))
    noise *= (np.linalg.norm(base, axis=1) / np.linalg.norm(noise, axis=1) * 0.31)[:, None]  # cosine about 0.955
    rows += [(10_000 + i, v.tolist()) for i, v in enumerate([*base, *(base + noise), *base[:5], *(base[5:10] * 3)])]
    got = {r.vec_id: r for r in e.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    x = np.array([v for _, v in rows], np.float32).astype(float)
    n_links, _ = brute([i for i, _ in rows], x)
    ours = np.array([got[i].n_links for i, _ in rows])
    assert (ours <= n_links).all() and ours.sum() >= 0.9 * n_links.sum()
    exact = [k for k in range(len(rows)) if ours[k] == n_links[k]]
    assert len(exact) >= 0.9 * len(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, nan], 0), (5, [inf, 1.0], 0), (6, [1.0, None], 0), (7, [1.0, 0.0], 0),
            (8, [1.0, -0.0], 1), (9, [2.0, 0.1], 2), (9, [2.0, 0.1], 2), (None, [1.0, 0.0], 0), (11, [1.0, 0.0, 0.0], 0), (12, [1e300, 0.0, 1e290], 0), (13, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in e.embedding_dedup(df).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6)]
    assert got == [(0, 4, 7, False), *alone, (7, 4, 7, True), (8, 4, 7, False), (9, 4, 7, False), (9, 4, 7, False), (11, 1, 11, True), (12, 1, 11, False), (13, 0, 13, True)]
    assert e.embedding_dedup(df.where("false")).count() == 0
