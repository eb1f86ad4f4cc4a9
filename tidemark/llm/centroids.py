"""K-means on integer vectors by equal-average equal-variance search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Query, own_names, settled, table

DIMENSION, CLUSTERS, ROUNDS, SCALE, SEED = 64, 16, 3, 64.0, 1
#: Components of all centroids together: they are held by every worker, and their sums come to the driver once a round.
MOST_COMPONENTS = 1 << 22
#: A squared distance of so many components of this size fits in a long.
_LARGEST = 1 << 27
_MARGIN = 1.0 - 1e-9  # of bounds in floating point, so that they never exceed the true bound


class Search:
    """Centroids sorted by component sum, with what the two inequalities need of each.

    For vectors x, c of k components with sums S and deviations V = sqrt(k |x|^2 - S^2), the squared distance times k is at
    least (S_x - S_c)^2 + (V_x - V_c)^2. Looking outward from the sum of x on both sides, a side ends when the first term alone
    exceeds the best distance so far, and a centroid is passed over when both terms do. Distances are computed in whole numbers.
    """

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.lexsort((np.arange(len(centroids)), sums))
        self.vectors = centroids[self.number]
        self.sums = sums[self.number]
        self.deviations = _deviations(self.vectors, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid (the smaller of two as near) and squared distance of each row; distances computed."""
        n, k = x.shape
        sums = x.sum(axis=1)
        deviations = _deviations(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.sums))
        rows, computed = np.arange(n), 0
        while len(rows):
            low, high = left[rows], right[rows]
            below = np.where(low >= 0, (sums[rows] - self.sums[np.maximum(low, 0)]).astype(np.float64), np.inf)
            above = np.where(high < len(self.sums), (self.sums[np.minimum(high, len(self.sums) - 1)] - sums[rows]).astype(np.float64), np.inf)
            gap, take_low = np.minimum(below, above), below <= above
            # The nearer side decides for both: if it is too far by its mean, so is all that lies beyond on either side.
            going = gap * gap * _MARGIN <= best[rows] * float(k)
            going &= np.isfinite(gap)
            rows, gap, at = rows[going], gap[going], np.where(take_low, low, high)[going]
            left[rows] -= take_low[going]
            right[rows] += ~take_low[going]
            apart = deviations[rows] - self.deviations[at]
            near = (gap * gap + apart * apart) * _MARGIN - _slack(deviations[rows], self.deviations[at]) <= best[rows] * float(k)
            r, c = rows[near], at[near]
            distance = np.square(x[r] - self.vectors[c]).sum(axis=1)
            computed += len(r)
            closer = (distance < best[r]) | ((distance == best[r]) & (self.number[c] < number[r]))
            best[r[closer]], number[r[closer]] = distance[closer], self.number[c[closer]]
        return number, best, computed


def _deviations(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    total = v.shape[1] * np.einsum("ij,ij->i", v, v) - np.square(sums.astype(np.float64))
    return np.sqrt(np.maximum(total, 0.0))


def _slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than rounding can add to the square of a difference of two deviations."""
    return 1e-6 * (1.0 + np.square(np.maximum(a, b)))


def _whole(column: pa.Array | pa.ChunkedArray, dimension: int, scale: float) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, dimension)
    if len(values) and np.abs(values).max() > _LARGEST:
        raise ValueError(f"scaled components beyond {_LARGEST} have squared distances that no long can hold")
    return values.astype(np.int64)


def usable(vector: Column | str, dimension: int) -> Column:
    """True for arrays of exactly `dimension` numbers, none null, NaN or infinite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(math.inf), F.lit(False)))
    return F.coalesce((F.size(v) == dimension) & fine, F.lit(False))


def first_centroids(vectors: DataFrame, clusters: int, dimension: int, scale: float, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of `seed:vec_id`, in that order; of equal ids that with the smaller components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(name.alias("h"), F.transform("vector", lambda x: F.floor(x.cast("double") * scale)).alias("v")).orderBy("h", "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64).reshape(-1, dimension)


def _named(vectors: DataFrame, vec_id: str, vector: str, dimension: int) -> DataFrame:
    return vectors.filter(usable(f"`{vector}`", dimension)).select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("vector"))


def _sums(vectors: DataFrame, centroids: np.ndarray, dimension: int, scale: float) -> np.ndarray:
    """Count and component sums of each cluster: added up inside each task, then by cluster."""
    search, fields = Search(centroids), [f"s{i}" for i in range(dimension)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), dimension + 1), np.int64)
        for batch in batches:
            x = _whole(batch.column(0), dimension, scale)
            number, _, _ = search.nearest(x)
            order = np.argsort(number, kind="stable")
            found, starts = np.unique(number[order], return_index=True)
            if len(found):
                total[found] += np.add.reduceat(np.column_stack((np.ones(len(x), np.int64), x))[order], starts)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32())] + [pa.array(total[used, i]) for i in range(dimension + 1)], ["cluster", "n", *fields])

    kinds = "cluster int, n long, " + ", ".join(f"{f} long" for f in fields)
    parts = vectors.select("vector").mapInArrow(run, kinds)
    out = np.zeros((len(centroids), dimension + 1), np.int64)
    for r in parts.groupBy("cluster").agg(*[F.sum(f).alias(f) for f in ("n", *fields)]).collect():
        out[r[0]] = r[1:]
    return out


def fit(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS,
        dimension: int = DIMENSION, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """The centroids after `rounds` of k-means over all usable vectors, each component x taken as floor(scale * x).

    Every round assigns each vector to its nearest centroid (ties: the smaller number) and replaces each non-empty centroid by
    its vectors' componentwise floor(sum / count). What comes to the driver is one row of sums for each cluster.
    Fewer usable vectors than `clusters` give fewer centroids; none give none.
    """
    if clusters * (dimension + 1) > MOST_COMPONENTS:
        raise ValueError(f"clusters times dimension must stay under {MOST_COMPONENTS}")
    kept = _named(vectors, vec_id, vector, dimension)
    centroids = first_centroids(kept, clusters, dimension, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        sums = _sums(kept, centroids, dimension, scale)
        filled = sums[:, 0] > 0
        centroids = centroids.copy()
        centroids[filled] = np.floor_divide(sums[filled, 1:], sums[filled, :1])
    return centroids


def assign(vectors: DataFrame, centroids: np.ndarray, vector: str = "embedding", dimension: int = DIMENSION, scale: float = SCALE) -> DataFrame:
    """The usable rows of `vectors` with `cluster int` and `distance long` (squared); columns of those names are replaced.

    Rows whose array is null, of another length or holds a null, NaN or infinite number are left out. Repeated rows and rows
    with a null id are vectors like others. Map-only: every worker holds the centroids. An empty table gives no rows.
    """
    search = Search(centroids.reshape(-1, dimension))

    @F.pandas_udf("cluster int, distance long")
    def near(values):
        import pandas as pd

        # Vectors left out by the filter may still pass here; they get no cluster.
        fine = [i for i, v in enumerate(values) if v is not None and len(v) == dimension and np.isfinite(np.asarray(v, np.float64)).all()]
        number, distance = np.full(len(values), -1), np.full(len(values), -1, np.int64)
        if fine:
            x = _whole(pa.array([values.iloc[i] for i in fine], pa.list_(pa.float64())), dimension, scale)
            number[fine], distance[fine], _ = search.nearest(x)
        return pd.DataFrame({"cluster": number.astype(np.int32), "distance": distance})

    found = own_names(vectors, "_found")[0]
    given = [F.col(f"`{c}`") for c in vectors.columns if c.lower() not in ("cluster", "distance")]
    fine = vectors.filter(usable(f"`{vector}`", dimension)).withColumn(found, near(F.col(f"`{vector}`")))
    return fine.select(*given, F.col(f"{found}.cluster").alias("cluster"), F.col(f"{found}.distance").alias("distance"))


def clustered(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", **settings) -> DataFrame:
    """`(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)` for every usable vector.

    The inertias are the sums of squared distances over the cluster and over all; the digest is that of the centroid's
    components as decimal numbers joined by commas. One row for each cluster is joined back, as a table of bounded size.
    """
    spark = vectors.sparkSession
    dimension, scale = settings.get("dimension", DIMENSION), settings.get("scale", SCALE)
    centroids = fit(vectors, vec_id, vector, **settings)
    slim = _named(vectors, vec_id, vector, dimension)
    held = settled(assign(slim, centroids, "vector", dimension, scale).select("vec_id", "cluster", "distance"), "centroids-assigned")
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = {r[0]: r[1] for r in held.groupBy("cluster").agg(F.sum("distance")).collect()}
    totals = spark.createDataFrame([(c, s, sum(sums.values())) for c, s in sorted(sums.items())], "cluster int, cluster_inertia long, inertia long")
    return held.join(F.broadcast(totals.join(names, "cluster")), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_centroid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of k-means with 16 centroids over all embeddings."""
    return clustered(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {"op11_centroid_search": op11_centroid_search}


def _sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, dimension: int = DIMENSION, scale: float = SCALE, seed: int = SEED) -> str:
    views = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, list_transform(embedding, lambda x: floor({int(scale)} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dimension}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))) = {dimension})""",
        f"x AS MATERIALIZED (SELECT rid, unnest(v) AS value, unnest(generate_series(1, {dimension})) AS i FROM kept)",
        f"""c0 AS MATERIALIZED (
  SELECT (rank - 1)::INTEGER AS cluster, i, value FROM x JOIN (
    SELECT rid, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id::VARCHAR)) AS rank FROM kept) USING (rid)
  WHERE rank <= {clusters})""",
    ]
    for r in range(rounds + 1):
        views.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, cluster, distance FROM (
    SELECT rid, cluster, distance, row_number() OVER (PARTITION BY rid ORDER BY distance, cluster) AS place FROM (
      SELECT x.rid, c.cluster, sum((x.value - c.value) * (x.value - c.value))::BIGINT AS distance
      FROM x JOIN c{r} c ON x.i = c.i GROUP BY 1, 2))
  WHERE place = 1)""")
        if r < rounds:
            views.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce(m.value, c.value) AS value FROM c{r} c LEFT JOIN (
    SELECT cluster, i, CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END AS value FROM (
      SELECT a.cluster, x.i, sum(x.value)::BIGINT AS s, count(*) AS n FROM a{r} a JOIN x ON a.rid = x.rid GROUP BY 1, 2)
  ) m ON c.cluster = m.cluster AND c.i = m.i)""")
    return "WITH " + ",\n".join(views) + f"""
SELECT k.vec_id, a.cluster, a.distance, t.cluster_inertia, (SELECT sum(distance)::BIGINT FROM a{rounds}) AS inertia, d.centroid_sha256
FROM a{rounds} a JOIN kept k ON a.rid = k.rid
JOIN (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY 1) t ON a.cluster = t.cluster
JOIN (SELECT cluster, sha256(string_agg(value::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY 1) d ON a.cluster = d.cluster"""


SQL: dict[str, str] = {"op11_centroid_search": _sql()}
