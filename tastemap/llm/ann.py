"""Approximate nearest neighbours by an adaptive dimension scan.

Index: unit vectors are turned by a random rotation, so that every leading
block of dimensions is a random sample of the distance, and dealt into lists
by their nearest centroid (spherical k-means fitted on a bounded sample of
different vectors, drawn by the vector, so repeats can't fill it; every vector
is indexed).  Vectors of each length have lists of their own; the sample is one
share of all vectors, and a length without a sampled one has its least vector as
its centroid.  A list larger than ``block_rows`` is dealt into
several tiles by a hash of the id, so no hot list is one task.

Search: a query probes its ``probe`` share of nearest lists.  Within a tile
the vectors lie in column blocks.  The squared distance grows block by block,
and after each block a hypothesis test drops the candidates whose scaled
partial distance exceeds the k-th best distance so far by more than the
factor (1 + epsilon / sqrt(d)) squared, d dimensions having been read.
Survivors get their exact cosine, in double precision on the original vectors.
Tiles' bests are merged per query.  A query whose probed lists hold fewer than k
candidates (where most of them are repeats of its own row, say) is searched
again in all lists.

The probe share is high since isotropic random vectors, which have no
clusters, are the hardest case; recall is measured in the tests.

Edge cases: vectors null, empty, zero, or holding null or non-finite
components take no part; vectors of different lengths never meet; exact repeats of a row count once; rows with the query's id are
no candidates; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.llm.vectors import KEY_LIMIT, best, distinct_rows, matrix, usable_rows
from tastemap.sources.files import materialize

SAMPLE_ROWS = 20_000    # rows that the centroids are fitted on, about
MAX_LISTS = 256
LIST_ROWS = 16          # rows of a list, about, while there are fewer than MAX_LISTS
PROBE = 0.65            # share of the lists that a query probes
BLOCK_ROWS = 4096
BLOCK_DIMS = 16
EPSILON = 2.1
ROUNDS = 8


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over their norm, safe for very large and very small components."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_lists(sample: np.ndarray, lists: int, seed: int = 7) -> np.ndarray:
    """Spherical k-means centroids of unit vectors."""
    rng = np.random.default_rng(seed)
    cent = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        near = (sample @ cent.T).argmax(axis=1)
        sums = np.zeros_like(cent)
        np.add.at(sums, near, sample)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        cent = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), cent)
    return cent


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = 11) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The exact measure: row by row, so equal rows get equal scores."""
    big, small = np.abs(x).max(axis=1), np.abs(q).max()
    x, q = x / big[:, None], q / small
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


class Lists(NamedTuple):
    """The lists of the vectors of one length."""

    cent: np.ndarray
    begin: int              # number of the first list
    probes: int             # lists that a query probes


def by_length(vectors: pd.Series, lists: dict):
    """(positions, unit vectors, lists) of the vectors of each length."""
    lengths = vectors.map(len).to_numpy()
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield at, unit(matrix(vectors.iloc[at])), lists[dim]


class Tile:
    """Rotated unit vectors of one tile in column blocks."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, turn: np.ndarray, block: int = BLOCK_DIMS):
        self.x, self.ids = x, ids
        turned = unit(x) @ turn
        self.cuts = list(range(0, x.shape[1], block)) + [x.shape[1]]
        self.blocks = [np.ascontiguousarray(turned[:, a:b]) for a, b in zip(self.cuts, self.cuts[1:])]

    def search(self, q: np.ndarray, turned: np.ndarray, own: int, k: int, eps: float = EPSILON):
        alive = np.flatnonzero(self.ids != own)
        if not len(alive):
            return alive, np.empty(0)
        dims = self.cuts[-1]
        seeds = alive[:4 * k]                         # a first threshold
        dist = sum(((b[seeds] - turned[a:a + b.shape[1]]) ** 2).sum(axis=1)
                   for a, b in zip(self.cuts, self.blocks))
        limit = np.partition(dist, min(k, len(dist)) - 1)[min(k, len(dist)) - 1] if len(dist) >= k else np.inf
        part = np.zeros(len(alive))
        for a, b in zip(self.cuts, self.blocks):
            part += ((b[alive] - turned[a:a + b.shape[1]]) ** 2).sum(axis=1)
            read = a + b.shape[1]
            if read < dims:
                keep = part * (dims / read) <= limit * (1 + eps / np.sqrt(read)) ** 2
            elif len(part) > 4 * k:                   # rounding may part equal cosines
                keep = part <= np.partition(part, k - 1)[k - 1] + 1e-9
            else:
                break
            alive, part = alive[keep], part[keep]
        score = cosines(self.x[alive], q)
        at = best(self.ids[alive], score, k)
        return alive[at], score[at]


def nearest(df: DataFrame, k: int = 5, every: int = 50, probe: float = PROBE, sample_rows: int = SAMPLE_ROWS,
            list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score (cosine) over vec_id, embedding."""
    out_type = "query_id long, rank int, vec_id long, score double"
    rows = usable_rows(df).filter(F.exists("embedding", lambda x: x != 0))
    sizes = {r["dim"]: r for r in rows.groupBy(F.size("embedding").alias("dim")).agg(
        F.count("*").alias("n"), F.min("embedding").alias("least")).orderBy("dim").collect()}     # a row per length
    if not sizes:
        return df.sparkSession.createDataFrame([], out_type)
    kinds = rows.agg(F.approx_count_distinct(F.xxhash64("embedding"), 0.02)).first()[0]
    share = min(KEY_LIMIT, -(-KEY_LIMIT * sample_rows // max(1, kinds)))
    sample = rows.select("embedding").filter(F.pmod(F.xxhash64("embedding", F.lit("sample")), F.lit(KEY_LIMIT)) < share)
    sample = sample.distinct().sort("embedding").toPandas()["embedding"]
    lengths, lists, begin = sample.map(len).to_numpy(), {}, 0
    for dim, r in sizes.items():
        fitted = matrix(sample[lengths == dim])
        if not len(fitted):
            fitted = matrix(pd.Series([r["least"]]))
        cent = fit_lists(unit(fitted), max(1, min(max_lists, r["n"] // list_rows)))
        lists[dim] = Lists(cent, begin, max(1, int(np.ceil(probe * len(cent)))))
        begin += len(cent)

    def assign(frames):
        for f in frames:
            f = f.iloc[_first_rows(f)].reset_index(drop=True)     # exact repeats count once; those in one batch go here
            if len(f):
                f["list"] = 0
                for at, x, own in by_length(f["embedding"], lists):
                    f.iloc[at, f.columns.get_loc("list")] = own.begin + (x @ own.cent.T).argmax(axis=1)
                yield f

    indexed = materialize(rows.mapInPandas(assign, "vec_id long, embedding array<double>, list int"), "ann-lists")
    tiles = np.ones(begin, np.int64)
    for r in indexed.groupBy("list").count().collect():        # at most max_lists rows a length
        tiles[r["list"]] = -(-r["count"] // block_rows)

    def route(every_list):
        def run(frames):
            for f in frames:
                for at, x, own in by_length(f["embedding"], lists):
                    probes = len(own.cent) if every_list else own.probes
                    near = own.begin + np.argsort(-(x @ own.cent.T), axis=1, kind="stable")[:, :probes]
                    spread = [[(li, t) for li in some for t in range(tiles[li])] for some in near.tolist()]
                    at = np.repeat(at, [len(s) for s in spread])
                    pairs = np.array([p for s in spread for p in s])
                    yield pd.DataFrame({"vec_id": f["vec_id"].to_numpy()[at],
                                        "embedding": f["embedding"].to_numpy()[at],
                                        "list": pairs[:, 0], "tile": pairs[:, 1]})
        return run

    queries = (indexed.filter(F.col("vec_id") % every == 0).groupBy("vec_id", F.size("embedding").alias("dim"))
               .agg(F.min("embedding").alias("embedding")).select("vec_id", "embedding"))
    per_list = F.element_at(F.lit(tiles.tolist()), F.col("list") + 1)
    dealt = indexed.withColumn("tile", F.pmod(F.xxhash64("vec_id"), per_list).cast("int"))

    def search(key, vectors, queries):
        out = []
        if len(vectors) and len(queries):
            x, ids = matrix(vectors["embedding"]), vectors["vec_id"].to_numpy()
            keep, turn = distinct_rows(ids, x), rotation(x.shape[1])
            tile, q = Tile(x[keep], ids[keep], turn), matrix(queries["embedding"])
            for own, row, turned in zip(queries["vec_id"].to_numpy(), q, unit(q) @ turn):
                at, score = tile.search(row, turned, own, k)
                out.append(pd.DataFrame({"query_id": own, "vec_id": tile.ids[at], "score": score}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return pd.concat(out) if out else empty.astype({"query_id": "int64", "vec_id": "int64"})

    by = ["list", "tile"]

    def look(asked, every_list):
        wanted = asked.mapInPandas(route(every_list), "vec_id long, embedding array<double>, list int, tile int")
        found = dealt.groupBy(*by).cogroup(wanted.groupBy(*by)).applyInPandas(search, "query_id long, vec_id long, score double")
        best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    found = materialize(look(queries, False), "ann-found")
    sizes_found = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    short = queries.join(sizes_found, F.col("vec_id") == F.col("query_id"), "left_anti")
    if all(own.probes >= len(own.cent) for own in lists.values()) or short.isEmpty():
        return found
    short = materialize(short, "ann-short")
    again = look(short, True)
    kept = found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*found.columns)
    return kept.unionByName(again)


def _first_rows(f: pd.DataFrame) -> np.ndarray:
    """Positions of the first of each set of exact repeats (id and vector)."""
    seen: set = set()
    return np.array([i for i, key in enumerate(zip(f["vec_id"].tolist(), (v.tobytes() for v in f["embedding"])))
                     if not (key in seen or seen.add(key))], np.int64)
