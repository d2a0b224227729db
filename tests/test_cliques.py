import numpy as np

from inkwell.operators import cliques


def vectors(spark, x):
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, v array<float>")


def brute(x, k):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    return s, np.argsort(-s, axis=1, kind="stable")[:, :k]


def test_nearest_and_packing(spark):
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(40, 16))[rng.integers(0, 40, 160)] + 0.25 * rng.normal(size=(160, 16))).astype(np.float32)
    df = vectors(spark, x)
    near = cliques.nearest(df, "id", "v", 3)
    sims, top = brute(x.astype(np.float64), 3)
    got = {(r.src, r["rank"]): r.dst for r in near.collect()}
    assert all(got[(i, j + 1)] == top[i, j] for i in range(160) for j in range(3))
    cands = cliques.candidates(df, "id", "v", near, 3, 0.75)
    taken = {tuple(r.members) for r in cliques.pack(cands).collect()}
    # The sequential choice.
    used, want = set(), set()
    order = sorted(range(160), key=lambda i: (-near_sim(sims, top, i), i))
    for i in order:
        group = (i, *top[i])
        pairs = [sims[a, b] for n, a in enumerate(group) for b in group[n + 1 :]]
        if min(pairs) >= 0.75 and not used & set(group):
            used |= set(group)
            want.add(tuple(int(g) for g in group))
    assert taken == want and want


def near_sim(sims, top, i):
    return sims[i, top[i, 0]]


def test_keep_first(spark, rows_of):
    x = np.array([[1, 0], [1, 0.05], [1, 0.1], [0, 1], [0, 1], [0.02, 1], [-1, 0]], dtype=np.float32)
    df = vectors(spark, x)
    links = cliques.similar(df, "id", "v", 0.9985)
    assert rows_of(cliques.keep_first(df, links, "id")) == [(0, True), (1, False), (2, True), (3, True), (4, False), (5, False), (6, True)]
    assert cliques.keep_first(df, links.filter("false"), "id").filter("kept").count() == 7


def test_empty(spark):
    df = vectors(spark, np.zeros((2, 2)))
    assert cliques.nearest(df, "id", "v", 2).count() == 0
    assert cliques.pack(cliques.candidates(df, "id", "v", cliques.nearest(df, "id", "v", 1), 1, 0.5)).count() == 0


def test_long_chains_settle(spark):
    """A chain of links in key order takes as many rounds as it is long, and ends."""
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    rows = spark.createDataFrame([(i,) for i in range(41)], "id bigint")
    assert sorted(r.id for r in cliques.keep_first(rows, links, "id").filter("kept").collect()) == list(range(0, 41, 2))


def test_cells_find_near_rows(spark):
    """With few cells all are searched and the result is exact; with more, nearly."""
    from inkwell.operators import cells

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 16))
    x = (centres[rng.integers(0, 60, 1_500)] + 0.3 * rng.normal(size=(1_500, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(9_000, None), (9_001, [0.0] * 16)], "id bigint, v array<float>")
    exact = {tuple(r) for r in cliques.nearest(df, "id", "v", 3).select("src", "dst").collect()}
    assert {tuple(r) for r in cliques.nearest(df, "id", "v", 3, probes=1_000).select("src", "dst").collect()} == exact
    some = {tuple(r) for r in cliques.nearest(df, "id", "v", 3, probes=6).select("src", "dst").collect()}
    assert len(some & exact) >= 0.9 * len(exact) and len(some) == len(exact)
    assert cliques.nearest(df.filter("false"), "id", "v", 3, probes=4).count() == 0
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    pairs = {(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.95, 1)))}
    got = {(r.a, r.b) for r in cliques.similar(df.filter("id < 9000"), "id", "v", 0.95, probes=1_000).collect()}
    assert got == pairs
    two = cells.Cells(unit[:40], unit[[0, 20]], np.array([0, 20, 40]))
    found = two.nearest(unit[:5], 8)
    assert found.shape == (5, 8) and (found[:, 0] == np.arange(5)).all()


def test_two_levels_of_cells(spark, monkeypatch):
    from inkwell.operators import cells

    monkeypatch.setattr(cells, "COARSE", 6)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3_000, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, row.tobytes()) for i, row in enumerate(x)], "id bigint, vec binary")
    fitted = cells.fit_cells(df, "id", "vec", 3_000, 8)
    assert fitted.coarse is not None and len(fitted.centres) >= 30 and fitted.begins[-1] == len(fitted.centres)
    assert np.allclose(np.linalg.norm(fitted.centres, axis=1), 1)
