"""Centroid clustering of integer vectors with expressions alone.

A vector is an array of integers. Its distance to a centroid, a literal array, is `aggregate` over `zip_with` of
the two, `array_min` over (distance, number) structs chooses the cluster, and sums of the components as columns,
grouped by cluster, give the next centroids. Sums are combined before the shuffle, so each task sends at most one
row for each cluster however the vectors are spread, and the driver gets as many rows as there are clusters. A
round that moves no centroid ends the work, since all further rounds would repeat it.

Vectors of another length, null ones and ones with a null or non-finite component are left out. Repeated rows
each count. Ties between centroids go to the smaller number. Rows of null id are clustered, but seed only behind
all others. With fewer vectors than clusters there are as many clusters as vectors; an empty table gives an empty
result. Only the two named columns are read, so others cannot clash. A squared distance must fit a long, that is
components within about 2**27 after scaling; beyond that the arithmetic stops with an error.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from billflow.workspace import written

Centroids = list[list[int]]


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, size: int, scale: int) -> DataFrame:
    """vec_id and x, the components as floor(scale * component), of the vectors that qualify."""
    values = F.col(vector).cast("array<double>")
    usable = (F.size(values) == size) & F.forall(values, lambda v: v.isNotNull() & (
        F.abs(v) < F.lit(float("inf"))))  # NaN is greater than all numbers here
    return rows.where(usable).select(
        F.col(vec_id).alias("vec_id"),
        F.transform(values, lambda v: F.floor(v * F.lit(float(scale)))).alias("x"))


def seeds(vectors: DataFrame, n_clusters: int, salt: str) -> Centroids:
    """The vectors of the smallest hashed ids, in order of the hash (repeated ids: in order of their components).
    What is gathered: `n_clusters` vectors."""
    chosen = vectors.orderBy(
        F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).asc_nulls_last(),
        "x").limit(n_clusters).collect()
    return [list(r["x"]) for r in chosen]


def distance(x: Column, centroid: list[int]) -> Column:
    """The squared Euclidean distance to a literal centroid."""
    literal = F.expr(f"array({', '.join(f'{c}L' for c in centroid)})")
    squares = F.zip_with(x, literal, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, s: total + s)


def nearest(x: Column, centroids: Centroids) -> Column:
    """(distance, cluster) of the nearest centroid."""
    return F.array_min(F.array(*[F.struct(distance(x, c).alias("distance"), F.lit(k).alias("cluster"))
                                 for k, c in enumerate(centroids)]))


def moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Each centroid replaced by the floor of its vectors' mean; one without vectors stays."""
    size = len(centroids[0])
    own = vectors.select("x", nearest(F.col("x"), centroids)["cluster"].alias("cluster"))
    sums = own.groupBy("cluster").agg(F.expr("count(1) AS n"), *[
        F.expr(f"sum(get(x, {k})) AS s{k}") for k in range(size)]).collect()
    after = list(centroids)
    for row in sums:  # as many rows as clusters
        after[row["cluster"]] = [row[f"s{k}"] // row["n"] for k in range(size)]
    return after


def clustered(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = 64,
              scale: int = 1024, n_clusters: int = 8, rounds: int = 10, salt: str = "3:"
              ) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, distance) of each vector after the rounds, and the final centroids."""
    vectors = written(integer_vectors(rows, vec_id, vector, size, scale), "vectors")
    centroids = seeds(vectors, n_clusters, salt)
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"),
                              F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        after = moved(vectors, centroids)
        if after == centroids:
            break
        centroids = after
    return vectors.select("vec_id", nearest(F.col("x"), centroids).alias("_n")).select(
        "vec_id", "_n.cluster", "_n.distance"), centroids


def with_inertia(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """The rows of `clustered` with the summed distances of their cluster and of all, and a digest of the
    cluster's centroid. The sums, one for each cluster, come back as literals."""
    assigned = written(assigned, "assigned")
    sums = {r["cluster"]: r["s"] for r in
            assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}

    def of_cluster(values: dict[int, object], kind: str) -> Column:
        cases = [(F.col("cluster") == k, F.lit(v)) for k, v in values.items()]
        chain = reduce(lambda c, case: c.when(*case), cases, F.when(F.lit(False), F.lit(None)))
        return chain.cast(kind)

    digests = {k: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
               for k, c in enumerate(centroids)}
    return assigned.select(
        "*", of_cluster(sums, "bigint").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        of_cluster(digests, "string").alias("centroid_sha256"))


def oracle(size: int = 64, scale: int = 1024, n_clusters: int = 8, rounds: int = 10,
           salt: str = "3:") -> str:
    """The same as SQL over the table `embeddings`."""
    near = """SELECT v.vec_id, v.x, arg_min(c.k, (d.d, c.k)) AS cluster, min(d.d) AS distance
    FROM v, {c} c, LATERAL (SELECT CAST(list_sum(list_transform(list_zip(v.x, c.x),
      lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d) d GROUP BY v.place, v.vec_id, v.x"""
    parts = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS place, vec_id,
    list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE len(embedding) = {size}
      AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {size})""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS k, x FROM (
    SELECT sha256('{salt}' || vec_id) AS h, x FROM v ORDER BY h LIMIT {n_clusters}))"""]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(c=f'c{r}')})")
        parts.append(f"""m{r} AS MATERIALIZED (SELECT cluster, list(mean ORDER BY i) AS x FROM (
    SELECT cluster, i, CAST((s - ((s % n) + n) % n) / n AS BIGINT) AS mean FROM (
      SELECT cluster, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n
      FROM a{r}, range(1, {size + 1}) g(i) GROUP BY cluster, i)) GROUP BY cluster)""")
        parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, coalesce(m.x, c.x) AS x
    FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.k)""")
    parts.append(f"f AS MATERIALIZED ({near.format(c=f'c{rounds}')})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INT) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM f JOIN c{rounds} c ON c.k = f.cluster"""
