"""Centroid clustering with lower bounds from Ptolemy's inequality.

A few pivots are fixed before the first round: of the first centroids, picked
one after the other, always the one farthest from those picked.  Every vector's
distances to the pivots are computed once and stored beside it, in blocks, in
the shared folder.  For a pivot pair (p, s), a vector o and a centroid c,
Ptolemy's inequality gives

    d(c, o) * d(p, s) >= |d(c, p) * d(o, s) - d(c, s) * d(o, p)|,

so the greatest of these bounds over all pairs, made smaller by more than any
rounding, is below the true distance.  A vector meets its centroids by growing
bound: each is compared exactly, in integers, until the next bound exceeds the
least distance so far; the others are never touched.  Ties go to the smaller
number.  A round's tasks emit one sum for each centroid they fed; only the
centroids (k rows) reach the driver.

Edge cases: vectors of another length, null, or holding null or non-finite
components are dropped; repeated rows count as often as they occur; rows
without an id come last in the order of first centroids; with fewer vectors
than centroids there is one centroid a vector; equal first centroids stay
apart, and the later ones, which win no vector, stay as they are; scaled
components are held within +-2^27, so that distances fit 64 bits; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.text import map_arrow
from tastemap.llm.vector_codes import finite, scaled
from tastemap.sources.files import materialize

DIM, CENTROIDS, ROUNDS, SCALE, PIVOTS = 64, 16, 3, 64, 6
OUT = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
SLACK = 1e-12       # relative, far above the roundings of a bound


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of x to all rows of y."""
    return np.sqrt(np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1).astype(np.float64))


class Pivots:
    """Fixed pivots and their pairs of different points."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        far = distances(points, points)
        picked = [0]
        while len(picked) < min(most, len(points)):
            nearest = far[:, picked].min(axis=1)
            if not nearest.max() > 0:
                break
            picked.append(int(nearest.argmax()))
        self.points = points[picked]
        apart = far[np.ix_(picked, picked)]
        self.pairs = [(p, s, apart[p, s]) for p, s in itertools.combinations(range(len(picked)), 2)]

    def bounds(self, cached: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of vectors (by their cached pivot
        distances) to all centroids."""
        own = distances(centroids, self.points)
        out = np.zeros((len(cached), len(centroids)))
        for p, s, apart in self.pairs:
            a, b = np.outer(cached[:, s], own[:, p]), np.outer(cached[:, p], own[:, s])
            np.maximum(out, (np.abs(a - b) - SLACK * (a + b)) / apart * (1 - SLACK), out=out)
        return out


def assign(x: np.ndarray, bounds: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, exact comparisons)."""
    order = np.argsort(bounds, axis=1, kind="stable")
    best, label = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
    alive, looked = np.arange(len(x)), 0
    for j in range(len(centroids)):
        c = order[alive, j]
        near = bounds[alive, c] <= np.sqrt(best[alive].astype(np.float64)) * (1 + SLACK)
        alive, c = alive[near], c[near]             # bounds grow, so a row that stops has stopped
        if not len(alive):
            break
        looked += len(alive)
        dist = ((x[alive] - centroids[c]) ** 2).sum(axis=1)
        wins = (dist < best[alive]) | ((dist == best[alive]) & (c < label[alive]))
        best[alive[wins]], label[alive[wins]] = dist[wins], c[wins]
    return label, best, looked


def store(rows: DataFrame, pivots: Pivots, dim: int) -> DataFrame:
    """Blocks of vectors with their pivot distances: a row for each batch."""
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), batch.column("vec_id")),
                 pa.array([x.astype("<i4").tobytes()], pa.binary()),
                 pa.array([distances(x, pivots.points).astype("<f8").tobytes()], pa.binary())], ["ids", "data", "cached"])

    return materialize(map_arrow(rows, run, f"ids array<{id_type}>, data binary, cached binary"), "pivot-blocks")


def blocks(batch: pa.RecordBatch, dim: int):
    """(ids, vectors, cached pivot distances) of every block of an Arrow batch."""
    for ids, data, cached in zip(batch.column("ids"), batch.column("data").to_pylist(), batch.column("cached").to_pylist()):
        x = np.frombuffer(data, "<i4").astype(np.int64).reshape(-1, dim)
        yield ids.values, x, np.frombuffer(cached, "<f8").reshape(len(x), -1)


def one_round(stored: DataFrame, pivots: Pivots, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    dim, k = centroids.shape[1], len(centroids)

    def run(batches):
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x, cached in blocks(batch, dim):
                label, _, _ = assign(x, pivots.bounds(cached, centroids), centroids)
                np.add.at(total, label, x)
                count += np.bincount(label, minlength=k)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(used, pa.int32()), "n": pa.array(count[used]),
                                          "sums": pa.array(total[used].tolist(), pa.list_(pa.int64()))})

    told = map_arrow(stored, run, "cluster int, n long, sums array<long>")
    zeros = F.array_repeat(F.lit(0).cast("long"), dim)
    summed = told.groupBy("cluster").agg(
        F.sum("n").alias("n"),
        F.aggregate(F.collect_list("sums"), zeros, lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("sums"))
    moved = centroids.copy()
    for r in summed.collect():                                   # k rows
        moved[r["cluster"]] = np.array(r["sums"], np.int64) // r["n"]
    return moved


def final(stored: DataFrame, pivots: Pivots, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    dim = centroids.shape[1]

    def run(batches):
        for batch in batches:
            for ids, x, cached in blocks(batch, dim):
                label, best, _ = assign(x, pivots.bounds(cached, centroids), centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(label, pa.int32()), pa.array(best)],
                                                 ["vec_id", "cluster", "distance"])

    id_type = stored.schema["ids"].dataType.elementType.simpleString()
    return map_arrow(stored, run, f"vec_id {id_type}, cluster int, distance long")


def cluster(df: DataFrame, dim: int = DIM, k: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
            salt: str = "1") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256
    over vec_id, embedding."""
    out_type = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    rows = (df.filter(finite(F.col("embedding")) & (F.size("embedding") == dim))
            .select("vec_id", scaled(F.col("embedding"), scale).alias("v")))
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(drawn.asc_nulls_last(), "v").limit(k).select("v").collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dim)
    if not len(centroids):
        id_type = df.schema["vec_id"].dataType.simpleString()
        return df.sparkSession.createDataFrame([], f"vec_id {id_type}, distance long, {out_type}").select(*OUT)
    pivots = Pivots(centroids)
    stored = store(rows, pivots, dim)
    for _ in range(rounds):
        centroids = one_round(stored, pivots, centroids)
    found = materialize(final(stored, pivots, centroids), "pivot-clusters")
    inertia = {r["cluster"]: r["inertia"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = [(c, inertia[c], sum(inertia.values()), digests[c]) for c in sorted(inertia)]    # k rows at most
    return (found.join(F.broadcast(df.sparkSession.createDataFrame(told, out_type)), "cluster")
            .select(*OUT))


def _sql(rounds: int = ROUNDS) -> str:
    head = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {DIM}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1)::INTEGER AS cluster, x AS c FROM v
  QUALIFY cluster < {CENTROIDS})"""
    for r in range(rounds + 1):
        head += f""",
a{r} AS MATERIALIZED (
  SELECT rid, (best % {CENTROIDS})::INTEGER AS cluster, best // {CENTROIDS} AS distance FROM (
    SELECT rid, min((list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT
                    * {CENTROIDS} + cluster) AS best FROM v, c{r} GROUP BY rid))"""
        if r < rounds:
            head += f""",
c{r + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT cluster, list(m ORDER BY pos) AS c FROM (
      SELECT cluster, pos, floor(sum(y) / count(*)) AS m FROM (
        SELECT cluster, unnest(x) AS y, generate_subscripts(x, 1) AS pos FROM a{r} JOIN v USING (rid))
      GROUP BY cluster, pos) GROUP BY cluster) n USING (cluster))"""
    return head + f"""
SELECT vec_id, cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c, lambda y: y::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} USING (cluster)"""


SQL = _sql()
