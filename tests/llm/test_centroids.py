"""Equal-average equal-variance search and the clusters it gives."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("low,high,k", [(-3, 4, 2), (-64, 65, 8), (-(2**20), 2**20, 64), (0, 1, 5), (-(2**26), 2**26, 64)])
def test_nearest_is_that_of_all_distances(low, high, k):
    random = np.random.default_rng(5)
    x, c = random.integers(low, high, (400, k)), random.integers(low, high, (37, k))
    c[5], x[:20] = c[30], c[:20]
    number, distance, computed = centroids.Search(c).nearest(x)
    every = np.square(x[:, None, :] - c[None, :, :]).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert computed <= every.size


def test_inequalities_reject_most_centroids():
    random = np.random.default_rng(6)
    middle = random.integers(-2000, 2000, 100)[:, None]
    x, c = middle + random.integers(-5, 6, (100, 16)), middle + random.integers(-5, 6, (100, 16))
    assert centroids.Search(c).nearest(x)[2] < 100 * 10


def plain(vectors, clusters, rounds):
    import hashlib

    kept = [(i, np.floor(np.array(v, np.float64) * 64).astype(np.int64)) for i, v in vectors]
    order = sorted(range(len(kept)), key=lambda j: (hashlib.sha256(f"1:{'' if kept[j][0] is None else kept[j][0]}".encode()).hexdigest(), kept[j][1].tolist()))
    c = np.array([kept[j][1] for j in order[:clusters]])
    x = np.array([v for _, v in kept])
    for step in range(rounds + 1):
        d = np.square(x[:, None, :] - c[None, :, :]).sum(axis=2)
        near = d.argmin(axis=1)
        if step < rounds:
            c = np.array([x[near == i].sum(axis=0) // (near == i).sum() if (near == i).any() else c[i] for i in range(len(c))])
    return sorted((repr(kept[j][0]), int(near[j]), int(d[j].min())) for j in range(len(kept)))


def test_clusters_of_odd_rows(spark):
    random = np.random.default_rng(7)
    rows = [(i, [float(v) for v in np.float32(random.normal(size=4))]) for i in range(60)]
    rows += [(3, rows[3][1]), (3, [9.0, 9.0, 9.0, 9.0]), (None, rows[4][1]), (None, rows[4][1]), (70, [0.0] * 4), (71, [-0.001, 0.0, 1e-9, -0.0])]
    odd = [(80, None), (81, []), (82, [1.0] * 3), (83, [1.0] * 5), (84, [None, 1.0, 1.0, 1.0]), (85, [float("nan")] * 4), (86, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], SCHEMA)
    found = centroids.clustered(df, clusters=5, dimension=4).collect()
    assert sorted((repr(r.vec_id), r.cluster, r.distance) for r in found) == plain(rows, 5, 3)
    assert {r.inertia for r in found} == {sum(r.distance for r in found)}
    for r in found:
        assert r.cluster_inertia == sum(s.distance for s in found if s.cluster == r.cluster)
    assert len({r.centroid_sha256 for r in found}) == len({r.cluster for r in found})


def test_few_and_no_vectors(spark):
    two = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)
    found = centroids.clustered(two, clusters=9, dimension=2).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in found] == [(0, 0, 0)] * 2  # the smaller number of two alike
    assert centroids.clustered(two.limit(0), dimension=2).count() == 0
    assert centroids.clustered(two, dimension=3).count() == 0


def test_clashing_names_and_sizes(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0)], SCHEMA).withColumns({"cluster": F.lit("mine"), "_found": F.lit("kept"), "strange.name": F.lit("kept"), "vector": F.lit("x")})
    (row,) = centroids.assign(df, np.array([[64, 128], [0, 0]]), dimension=2).collect()
    assert (row.cluster, row.distance, row["_found"], row["strange.name"]) == (0, 0, "kept", "kept")
    assert centroids.clustered(df, dimension=2).count() == 1
    with pytest.raises(ValueError):
        centroids.fit(df, clusters=1 << 20, dimension=64)
    with pytest.raises(Exception, match="squared distances"):
        centroids.clustered(spark.createDataFrame([(1, [1e30, 0.0], 0)], SCHEMA), dimension=2).count()
