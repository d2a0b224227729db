import numpy as np
import pytest

from inkwell.llm import clusters, knn, vectors

DIMS = 32


def table(spark, x, extra=()):
    rows = [(int(i), None if v is None else [float(a) for a in v], "t") for i, v in [*enumerate(x), *extra]]
    return spark.createDataFrame(rows, "row_id bigint, embed array<float>, rep string")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(60, DIMS))
    x = np.concatenate([c + 0.15 * rng.normal(size=(s, DIMS)) for c, s in zip(centres, rng.integers(1, 30, 60))]).astype(np.float32)
    return x[rng.permutation(len(x))]


BAD = [(5_000, None), (5_001, [1.0] * 5), (5_002, [0.0] * DIMS), (5_003, [float("nan")] * DIMS), (5_004, [float("inf")] + [1.0] * (DIMS - 1)), (5_005, [])]


def brute(x):
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    return s


def test_recall_and_pairs(spark, data):
    near = knn.nearest_rows(table(spark, data, BAD), dims=DIMS).cache()
    sims = brute(data)
    top = np.argsort(-sims, axis=1, kind="stable")[:, :5]
    got = {(r.row_id, r.neighbour) for r in near.collect()}
    want = {(i, int(j)) for i in range(len(data)) for j in top[i]}
    assert len(got & want) >= 0.95 * len(want)
    assert near.groupBy("row_id").count().filter("count <> 5").count() == 0
    assert {a for a, _ in got} == set(range(len(data)))
    close = {tuple(r) for r in knn.similar_pairs(near).collect()}
    exact = {(min(i, int(j)), max(i, int(j))) for i in range(len(data)) for j in top[i] if sims[i, j] >= 0.75}
    assert len(close & exact) >= 0.99 * len(exact) and len(close - exact) <= 0.01 * len(exact)


def test_copies_and_ties(spark, rows_of):
    x = np.eye(4, DIMS, dtype=np.float32)
    rows = np.concatenate([np.repeat(x[:1], 30, axis=0), x[1:]])
    near = knn.nearest_rows(table(spark, rows), dims=DIMS)
    got = {}
    for r in near.orderBy("rank").collect():
        got.setdefault(r.row_id, []).append(r.neighbour)
    # Of equal cosines the smaller key, the row itself left out, whatever the size of the group.
    assert got[0] == [1, 2, 3, 4, 5] and got[3] == [0, 1, 2, 4, 5] and got[29] == [0, 1, 2, 3, 4]
    assert len(got) == 33
    assert near.filter("row_id = 29").select("cosine").distinct().collect()[0][0] == 1.0
    few = knn.nearest_rows(table(spark, x[:2]), dims=DIMS)
    assert rows_of(few.select("row_id", "rank", "neighbour")) == [(0, 1, 1), (1, 1, 0)]
    assert knn.nearest_rows(table(spark, x).filter("false"), dims=DIMS).count() == 0
    many = knn.nearest_rows(table(spark, rows), dims=DIMS, k=20)
    assert [r.neighbour for r in many.filter("row_id = 3").orderBy("rank").collect()] == [i for i in range(21) if i != 3]
    with pytest.raises(ValueError):
        knn.nearest_rows(table(spark, x), dims=DIMS, k=0)


def test_more_neighbours_and_two_levels(spark, data, monkeypatch):
    """Any number of neighbours; and with a second level of cells, as large tables have, the recall holds."""
    from inkwell.operators import cells

    sims = brute(data)
    for k, coarse in ((12, 10_000), (5, 6)):
        monkeypatch.setattr(cells, "COARSE", coarse)
        got = {(r.row_id, r.neighbour) for r in knn.nearest_rows(table(spark, data), dims=DIMS, k=k).collect()}
        top = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        want = {(i, int(j)) for i in range(len(data)) for j in top[i]}
        assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_small_blocks(spark, data, monkeypatch):
    """Hot cells are cut on both sides without losing a neighbour."""
    whole = {(r.row_id, r.neighbour) for r in knn.nearest_rows(table(spark, data), dims=DIMS).collect()}
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "QUERIES", 32)
    cut = {(r.row_id, r.neighbour) for r in knn.nearest_rows(table(spark, data), dims=DIMS).collect()}
    assert len(whole & cut) >= 0.98 * len(whole)


def test_anisotropic_codes_prefer_the_direction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, DIMS))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    books = vectors.fit_books(x, x)
    codes = vectors.assign_codes(x, x, books)
    nearest = np.stack([((x.reshape(500, -1, vectors.SUB)[:, s, None] - books[s][None]) ** 2).sum(2).argmin(1) for s in range(len(books))], 1)

    def parallel(c):
        error = x - books[np.arange(len(books))[None], c].reshape(500, DIMS)
        return np.abs((error * x).sum(1)).mean()

    assert parallel(codes) < 0.6 * parallel(nearest)


def test_clusters(spark, rows_of):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, DIMS))
    groups = [c + 0.12 * rng.normal(size=(s, DIMS)) for c, s in zip(centres, (3, 5, 9, 2, 40, 3, 4, 1, 1, 7, 6, 2))]
    copies = np.repeat(rng.normal(size=(1, DIMS)), 3, axis=0)
    x = np.concatenate([*groups, copies]).astype(np.float32)
    sims = brute(x)
    owner = np.repeat(np.arange(13), [*map(len, groups), 3])
    want = set()
    for g in range(13):
        members = np.flatnonzero(owner == g)
        if len(members) >= 3:
            assert (sims[np.ix_(members, members)] + 9 * 2 * np.eye(len(members))).min() >= 0.75
            want |= {(int(members[0]), int(m)) for m in members}
    out = clusters.similarity_clusters(table(spark, x, BAD), dims=DIMS).cache()
    assert {(r.cluster_id, r.row_id) for r in out.collect()} == want
    sizes = {r.cluster_id: r.n for r in out.groupBy("cluster_id").agg({"row_id": "count"}).withColumnRenamed("count(row_id)", "n").collect()}
    assert all(sizes[r.cluster_id] == r.size for r in out.collect())
    big = out.filter("size = 40").orderBy("typical").collect()
    assert [r.typical for r in big] == list(range(1, 41)) and big[0].affinity >= big[-1].affinity
    assert clusters.similarity_clusters(table(spark, x).filter("false"), dims=DIMS).count() == 0


def test_chain_is_divided(spark):
    """Rows that hang together without being all similar are no cluster as a whole."""
    angles = np.deg2rad([0, 5, 10, 40, 45, 80, 85, 90])
    x = np.zeros((8, DIMS), dtype=np.float32)
    x[:, 0], x[:, 1] = np.cos(angles), np.sin(angles)
    got = clusters.similarity_clusters(table(spark, x), dims=DIMS).collect()
    sims = brute(x)
    members: dict[int, list[int]] = {}
    for r in got:
        members.setdefault(r.cluster_id, []).append(r.row_id)
    assert members
    rows = [m for group in members.values() for m in group]
    assert len(rows) == len(set(rows))
    for group in members.values():
        assert len(group) >= 3 and all(sims[a, b] >= 0.75 for a in group for b in group if a != b)


def test_large_clusters_of_tight_parts(spark):
    """A cluster of more rows than the graph has neighbours is one, however its rows are bunched; bunches that are no cluster together stay apart."""
    rng = np.random.default_rng(4)

    def bunch(centre, n):
        return centre + 0.01 * rng.normal(size=(n, DIMS))

    def group(parts, n):
        base = 2 * rng.normal(size=DIMS)
        return np.concatenate([bunch(base + 0.6 * rng.normal(size=DIMS), n) for _ in range(parts)])

    near = np.zeros((3, DIMS))
    near[:, 0], near[:, 1] = np.cos(np.deg2rad([0, 30, 60])), np.sin(np.deg2rad([0, 30, 60]))
    chain = np.concatenate([bunch(20 * c, n) for c, n in zip(near, (90, 80, 70))])
    x = np.concatenate([group(5, 80), group(60, 5), chain, rng.normal(size=(40, DIMS))]).astype(np.float32)
    owner = np.repeat([0, 1, 2, 3, 4], [400, 300, 170, 70, 40])
    sims = brute(x) + 10 * np.eye(len(x))
    for g in range(3):
        assert sims[np.ix_(owner == g, owner == g)].min() >= 0.75
    assert sims[np.ix_(owner < 2, owner > 1)].max() < 0.75 and sims[np.ix_(owner == 0, owner == 1)].max() < 0.75
    got = clusters.similarity_clusters(table(spark, x), dims=DIMS).collect()
    members: dict[int, set[int]] = {}
    for r in got:
        members.setdefault(r.cluster_id, set()).add(r.row_id)
    assert sorted(map(len, members.values())) == [70, 170, 300, 400]
    assert {frozenset(m) for m in members.values()} == {frozenset(np.flatnonzero(owner == g).tolist()) for g in range(4)}
