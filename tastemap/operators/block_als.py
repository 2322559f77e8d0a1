"""Alternating least squares for many parameter points over one rating layout.

The ratings are laid out once for each side: blocks of about ``per_block``
ratings, each stored as one row of arrays (ids, where each id's ratings start,
the other side's ids, values), beside a table of which blocks need each id of
the other side.  A half step ships the other side's factor rows to the blocks
that need them, many in one row, and solves every id's normal equations there,
for all points at once: a factor row holds the factors of all points, one after
the other, so a grid of points costs the shuffles of one fit.

Hot ids: an id of more than ``per_id`` ratings is dealt over many blocks.  Each
of them emits partial normal equations; these are added up in groups of
``FAN`` and solved once, so no task holds all ratings of an id.

Implicit points of more factors than an id has ratings: its equations are the
gram matrix plus few outer products, so they are solved in the space of its
ratings (``solve_few``), not by factoring a matrix as wide as its factors.

Every half step's factors are written to the shared folder, which cuts the
lineage.  First factors depend on the id and the seed alone, so neither the
number of blocks nor that of tasks changes a result beyond rounding.

The objectives are those of ``pyspark.ml``'s ALS: squared errors (or, implicit,
confidences 1 + alpha |r| on preferences r > 0) with regularisation times the
number of ratings (implicit: of positive ones) of each id.

Edge cases: rows with a null id or rating are left out; repeated pairs count
each; an empty table gives empty factors.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.params import ALS_SEED
from tastemap.sources.files import materialize

BLOCK_BYTES = 48 << 20      # of shipped factors that a block receives, at most about
FEWEST, MOST = 1024, 131_072    # ratings of a block
SHIP_BYTES = 16 << 20       # of factors dealt to blocks at once
FAN = 16                    # partial equations added up in one group
OUTER = 16                  # ranks up to this are built from outer products at once
CHUNK_CELLS = 4 << 20       # numbers held by a batch of equations
STEADY = 1e-10              # least eigenvalue for the greatest, where a matrix counts as far from singular
_GOLD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Point:
    """One parameter point of a fit."""

    rank: int
    reg: float
    implicit: bool = False
    alpha: float = 1.0
    nonnegative: bool = False


def slices_of(points: list[Point]) -> list[slice]:
    """Where each point's factors lie in a factor row."""
    ends = np.cumsum([p.rank for p in points]).tolist()
    return [slice(e - p.rank, e) for p, e in zip(points, ends)]


class Layout(NamedTuple):
    """Ratings by the blocks of one side."""

    blocks: DataFrame       # block, ids, starts, others, ratings, hot (binary arrays)
    needs: DataFrame        # other, blocks: the blocks that meet an id of the other side
    ids: DataFrame          # id, n: every id of this side
    hot_parts: int          # blocks that a hot id may lie in; 0 without hot ids


def block_size(points: list[Point]) -> int:
    """Ratings of a block, so that its shipped factors stay within ``BLOCK_BYTES``."""
    return max(FEWEST, min(MOST, BLOCK_BYTES // (4 * sum(p.rank for p in points))))


def lay_out(ratings: DataFrame, own: str, other: str, rating: str, per_block: int, per_id: int | None = None) -> Layout:
    """The layout of ``ratings`` by the blocks of the ids in ``own``."""
    per_id = per_id or max(1, per_block // 4)
    rows = ratings.select(F.col(own).cast("long").alias("id"), F.col(other).cast("long").alias("other"),
                          F.col(rating).cast("double").alias("rating")).dropna()
    ids = materialize(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "als-ids")
    total, most = ids.agg(F.sum("n"), F.max("n")).first()
    n_blocks = max(1, -(-(total or 0) // per_block))
    hot = (most or 0) > per_id
    marked = rows.withColumn("hot", F.lit(False))
    if hot:
        heavy = ids.filter(F.col("n") > per_id).select("id", F.lit(True).alias("heavy"))
        marked = rows.join(heavy, "id", "left").select("id", "other", "rating", F.coalesce("heavy", F.lit(False)).alias("hot"))
    key = F.when(F.col("hot"), F.xxhash64("id", "other")).otherwise(F.xxhash64("id"))
    dealt = marked.withColumn("block", F.pmod(key, F.lit(n_blocks)).cast("int"))

    def pack(key, f):
        f = f.sort_values(["id", "other", "rating"])
        own_ids, starts = np.unique(f["id"].to_numpy(np.int64), return_index=True)
        hot_ids = f["hot"].to_numpy(bool)[starts]
        return pd.DataFrame({"block": [key[0]], "ids": [own_ids.tobytes()], "starts": [starts.astype(np.int64).tobytes()],
                             "others": [f["other"].to_numpy(np.int64).tobytes()],
                             "ratings": [f["rating"].to_numpy(np.float64).tobytes()], "hot": [hot_ids.tobytes()]})

    blocks = materialize(dealt.groupBy("block").applyInPandas(
        pack, "block int, ids binary, starts binary, others binary, ratings binary, hot binary"), "als-blocks")
    return Layout(blocks, needed(blocks, "others"), ids, n_blocks if hot else 0)


def needed(blocks: DataFrame, column: str) -> DataFrame:
    """other, blocks: for the ids in a column of the blocks, the blocks that hold them, each once."""
    def run(frames):
        for f in frames:
            for block, data in zip(f["block"], f[column]):
                some = np.unique(np.frombuffer(data, np.int64))
                yield pd.DataFrame({"block": np.full(len(some), block, np.int32), "other": some})

    pairs = blocks.select("block", column).mapInPandas(run, "block int, other long")
    return materialize(pairs.groupBy("other").agg(F.sort_array(F.collect_list("block")).alias("blocks")), "als-needs")


def shipments(needs: DataFrame, factors: DataFrame, width: int) -> DataFrame:
    """block, others, vecs: the factor rows (id, vec) that each block needs, many in a row."""
    most = max(1, SHIP_BYTES // (4 * width))                   # pairs of a block and an id at once

    def run(frames):
        for f in frames:
            ids, x = f["other"].to_numpy(np.int64), factor_matrix(f["vec"], width)
            ends = np.cumsum([len(b) for b in f["blocks"]])
            for lo in range(0, int(ends[-1]) if len(ends) else 0, most):
                first, last = np.searchsorted(ends, [lo, min(lo + most, ends[-1]) - 1], "right")
                own, start = np.concatenate(f["blocks"].iloc[first:last + 1].to_list()), ends[first] - len(f["blocks"].iloc[first])
                row = np.repeat(np.arange(first, last + 1), np.diff(ends[first:last + 1], prepend=start))
                own, row = own[lo - start:lo - start + most], row[lo - start:lo - start + most]
                order = np.lexsort((ids[row], own))
                own, row = own[order], row[order]
                cuts = np.append(np.flatnonzero(np.diff(own, prepend=-1)), len(own)).tolist()
                yield pd.DataFrame({"block": own[cuts[:-1]].astype(np.int32), "others": [planes(ids[row[i:j]]) for i, j in zip(cuts, cuts[1:])],
                                    "vecs": [planes(x[row[i:j]]) for i, j in zip(cuts, cuts[1:])]})

    met = needs.join(factors.withColumnRenamed("id", "other"), "other").select("other", "blocks", "vec")
    return met.mapInPandas(run, "block int, others binary, vecs binary")


def planes(x: np.ndarray) -> bytes:
    """Numbers by their first bytes, then their second ones, and so on, which shuffles compress better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def unplaned(data: list[bytes], kind: type) -> np.ndarray:
    """The numbers of ``planes``, one after the other."""
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(np.frombuffer(b, np.uint8).reshape(size, -1).T.tobytes() for b in data), kind)


def first_factors(ids: DataFrame, points: list[Point], seed: int = ALS_SEED) -> DataFrame:
    """id, vec: unit vectors of normal numbers drawn from the id and the seed."""
    widest = max(p.rank for p in points)

    def run(frames):
        for f in frames:
            x = _normal(f["id"].to_numpy(np.int64), widest, seed)
            yield pd.DataFrame({"id": f["id"], "vec": _bytes(np.hstack([unit_vectors(x[:, :p.rank], p) for p in points]))})

    return materialize(ids.select("id").mapInPandas(run, "id long, vec binary"), "als-factors")


def unit_vectors(x: np.ndarray, p: Point) -> np.ndarray:
    own = np.abs(x) if p.nonnegative else x
    return own / np.maximum(np.sqrt((own * own).sum(axis=1, keepdims=True)), 1e-12)


def _normal(ids: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Normal numbers by id and column (Box and Muller over mixed integers)."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64)[:, None] * _GOLD + (np.arange(2 * width, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    u = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
    return np.sqrt(-2 * np.log(u[:, ::2])) * np.cos(2 * np.pi * u[:, 1::2])     # the first columns are the same for any width


def _bytes(x: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(x, "<f4")]


def factor_matrix(vecs, width: int) -> np.ndarray:
    """Factor rows (binary) as a matrix of 32-bit numbers."""
    return np.frombuffer(b"".join(vecs), "<f4").reshape(-1, width)


def grams(factors: DataFrame, points: list[Point]) -> list[np.ndarray]:
    """Sum of outer products of all factor rows, for each implicit point."""
    at, width = slices_of(points), sum(p.rank for p in points)

    def run(frames):
        total = [np.zeros((p.rank, p.rank)) if p.implicit else np.zeros((0, 0)) for p in points]
        for f in frames:
            x = factor_matrix(f["vec"], width)
            for g, p, s in zip(total, points, at):
                if p.implicit:
                    y = x[:, s].astype(np.float64)
                    g += y.T @ y
        yield pd.DataFrame({"part": [np.concatenate([g.ravel() for g in total]).tobytes()]})

    def add(key, f):
        return pd.DataFrame({"part": [sum(np.frombuffer(b) for b in f["part"]).tobytes()]})

    if not any(p.implicit for p in points):
        return [np.zeros((p.rank, p.rank)) for p in points]
    told = factors.select("vec").mapInPandas(run, "part binary").withColumn("group", F.spark_partition_id() % FAN)
    parts = [np.frombuffer(r["part"]) for r in told.groupBy("group").applyInPandas(add, "part binary").collect()]   # FAN at most
    flat = sum(parts) if parts else np.zeros(sum(p.rank ** 2 for p in points if p.implicit))
    out, spot = [], 0
    for p in points:
        size = p.rank ** 2 if p.implicit else 0
        out.append(flat[spot:spot + size].reshape(p.rank, p.rank) if size else np.zeros((p.rank, p.rank)))
        spot += size
    return out


def equations(y: np.ndarray, rating: np.ndarray, starts: np.ndarray, p: Point):
    """(matrices, right sides, counts): each id's normal equations, without
    gram matrix and regularisation.  ``y``: the factors met by each rating."""
    ends = np.append(starts[1:], len(rating))
    if p.implicit:
        weight, right, counted = p.alpha * np.abs(rating), (1 + p.alpha * np.abs(rating)) * (rating > 0), rating > 0
    else:
        weight, right, counted = np.ones(len(rating)), rating, np.ones(len(rating), bool)
    b = np.add.reduceat(y * right[:, None], starts)
    n = np.add.reduceat(counted, starts, dtype=np.int64)
    a = np.empty((len(starts), p.rank, p.rank))
    if p.rank <= OUTER:
        step = max(1, CHUNK_CELLS // p.rank ** 2)
        group = starts // step
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(starts)]]).tolist()
        for i, j in zip(cuts, cuts[1:]):
            lo, hi = starts[i], ends[j - 1]
            some = y[lo:hi]
            a[i:j] = np.add.reduceat((some * weight[lo:hi, None])[:, :, None] * some[:, None, :], starts[i:j] - lo)
    else:
        for i, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
            some = y[lo:hi]
            a[i] = some.T @ (some * weight[lo:hi, None]) if p.implicit else some.T @ some
    return a, b, n


def solve(a: np.ndarray, b: np.ndarray, n: np.ndarray, gram: np.ndarray, p: Point) -> np.ndarray:
    """Each id's factors from its equations."""
    a = a + gram
    a[:, np.arange(p.rank), np.arange(p.rank)] += (p.reg * n)[:, None]
    if p.nonnegative:
        return nonnegative(a, b)
    try:
        return np.linalg.solve(a, b[:, :, None])[:, :, 0]
    except np.linalg.LinAlgError:                     # no rating counts: the least of all solutions
        return np.stack([np.linalg.lstsq(m, v, rcond=None)[0] for m, v in zip(a, b)])


def nonnegative(a: np.ndarray, b: np.ndarray, sweeps: int = 400, tol: float = 1e-9) -> np.ndarray:
    """Least squares with factors of at least 0, by coordinate descent on all
    ids at once."""
    x = np.zeros_like(b)
    diagonal = np.maximum(np.einsum("ijj->ij", a), 1e-300)
    residual = -b.copy()                              # a x - b
    for _ in range(sweeps):
        moved = 0.0
        for j in range(b.shape[1]):
            step = np.maximum(x[:, j] - residual[:, j] / diagonal[:, j], 0) - x[:, j]
            x[:, j] += step
            residual += a[:, :, j] * step[:, None]
            moved = max(moved, float(np.abs(step).max(initial=0)))
        if moved < tol:
            break
    return x


def spectrum(gram: np.ndarray, p: Point) -> tuple[np.ndarray, np.ndarray] | None:
    """Eigenvalues and vectors of the gram matrix, for points that ``solve_few`` takes."""
    return np.linalg.eigh(gram) if p.implicit and not p.nonnegative else None


def few(n: np.ndarray, k: np.ndarray, values: np.ndarray, p: Point) -> np.ndarray:
    """Whether ``solve_few`` takes an id of ``k`` ratings, ``n`` of them positive:
    fewer ratings than factors, and a regularised gram matrix far from singular."""
    return (k < p.rank) & ((n == 0) | (values[0] + p.reg * n > STEADY * max(values[-1], 1e-300)))


def solve_few(y: np.ndarray, rating: np.ndarray, starts: np.ndarray, k: np.ndarray, n: np.ndarray,
              values: np.ndarray, vectors: np.ndarray, p: Point) -> np.ndarray:
    """The implicit solutions of ids of ``k`` ratings each, whose factors ``y`` start at ``starts``."""
    return solve_turned(y @ vectors, rating, starts, k, n, values, vectors, p)


def solve_turned(z: np.ndarray, rating: np.ndarray, starts: np.ndarray, k: np.ndarray, n: np.ndarray,
                 values: np.ndarray, vectors: np.ndarray, p: Point) -> np.ndarray:
    """As ``solve_few``, of factors ``z`` among the eigenvectors of the gram matrix.

    With M = gram + reg n I, (M + Y'WY)^-1 Y'c = M^-1 Y' (I + W Y M^-1 Y')^-1 c: a
    system as wide as the id's ratings instead of its factors, and M is diagonal
    among the eigenvectors of the gram matrix.
    """
    out = np.zeros((len(starts), p.rank))
    weight, right = p.alpha * np.abs(rating), (1 + p.alpha * np.abs(rating)) * (rating > 0)
    counted = n > 0                                            # the others' right sides are zero, so their factors
    for size in np.unique(k[counted]).tolist():
        alike, step = np.flatnonzero(counted & (k == size)), max(1, CHUNK_CELLS // (size * p.rank))
        for lo in range(0, len(alike), step):
            some = alike[lo:lo + step]
            spot = starts[some][:, None] + np.arange(size)
            own = z[spot]
            scaled = own / (values + p.reg * n[some][:, None])[:, None, :]
            a = weight[spot][:, :, None] * (own @ scaled.transpose(0, 2, 1))
            a[:, np.arange(size), np.arange(size)] += 1
            out[some] = (np.linalg.solve(a, right[spot][:, :, None]).transpose(0, 2, 1) @ scaled)[:, 0]
    return out @ vectors.T


def solve_ids(own: np.ndarray, met: np.ndarray, rating: np.ndarray, starts: np.ndarray, hot: np.ndarray, p: Point,
              gram: np.ndarray, known_as: tuple[np.ndarray, np.ndarray] | None, turned: np.ndarray | None = None) -> tuple[np.ndarray, list[tuple]]:
    """(factors of ids, equations of hot ones as (which, matrix, right side, count)): ratings of an id
    start at ``starts``, ``met`` tells the row of the other side's factors ``own`` that each meets;
    ``turned``: ``own`` among the eigenvectors, if known."""
    k, positive = np.diff(np.append(starts, len(rating))), np.add.reduceat(rating > 0, starts, dtype=np.int64)
    out, parts = np.zeros((len(starts), p.rank)), []
    short = ~hot & few(positive, k, known_as[0], p) if known_as else np.zeros(len(starts), bool)
    picked = np.repeat(short, k)
    if short.any():
        z = turned[met[picked]] if turned is not None else own[met[picked]] @ known_as[1]
        out[short] = solve_turned(z, rating[picked], np.cumsum(k[short]) - k[short], k[short], positive[short], *known_as, p)
    rest, near, rated = np.flatnonzero(~short), met[~picked], rating[~picked]
    first, most = np.cumsum(k[rest]) - k[rest], max(1, CHUNK_CELLS // p.rank ** 2)    # equations held at once
    for lo in range(0, len(rest), most):
        who, begin = rest[lo:lo + most], first[lo:lo + most]
        a, b = begin[0], begin[-1] + k[who[-1]]
        eq = equations(own[near[a:b]].astype(np.float64, copy=False), rated[a:b], begin - a, p)
        cool = ~hot[who]
        if cool.any():
            out[who[cool]] = solve(*(e[cool] for e in eq), gram, p)
        parts += [(who[i], eq[0][i], eq[1][i], eq[2][i]) for i in np.flatnonzero(~cool).tolist()]
    return out, parts


def half_step(layout: Layout, factors: DataFrame, points: list[Point]) -> DataFrame:
    """id, vec: the layout's side solved for, given the other side's factors."""
    at, width, gram = slices_of(points), sum(p.rank for p in points), grams(factors, points)
    spectra = [spectrum(g, p) for g, p in zip(gram, points)]

    def run(key, block, shipped):
        row = block.iloc[0]
        ids, starts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["starts"], np.int64)
        rating, hot = np.frombuffer(row["ratings"]), np.frombuffer(row["hot"], bool)
        known = unplaned(shipped["others"], np.int64)
        order = np.argsort(known)
        met = order[np.searchsorted(known[order], np.frombuffer(row["others"], np.int64))]
        x, solved, parts = unplaned(shipped["vecs"], np.float32).reshape(-1, width), [], []
        for p, s, g, known_as in zip(points, at, gram, spectra):
            out, some = solve_ids(np.ascontiguousarray(x[:, s], np.float64), met, rating, starts, hot, p, g, known_as)
            parts += some
            solved.append(out)
        vec = _bytes(np.hstack(solved))
        by_id: dict = {}
        for i, *eq in parts:                                   # the points' equations of a hot id, one after the other
            by_id.setdefault(i, []).append(np.concatenate([eq[0].ravel(), eq[1], [eq[2]]]))
        return pd.DataFrame({"id": ids, "block": key[0], "vec": [None if i in by_id else v for i, v in enumerate(vec)],
                             "part": [np.concatenate(by_id[i]).tobytes() if i in by_id else None for i in range(len(ids))]})

    shipped = shipments(layout.needs, factors, width)
    stepped = layout.blocks.groupBy("block").cogroup(shipped.groupBy("block")).applyInPandas(
        run, "id long, block int, vec binary, part binary")
    stepped = materialize(stepped, "als-factors")
    if not layout.hot_parts:
        return stepped.select("id", "vec")
    summed, left = stepped.filter("part is not null").select("id", "block", "part"), layout.hot_parts

    def add(key, f):
        return pd.DataFrame({"id": [key[0]], "block": [key[1]], "part": [sum(np.frombuffer(b) for b in f["part"]).tobytes()]})

    while left > 1:                                            # groups of about FAN partial equations each
        left = -(-left // FAN)
        summed = summed.withColumn("block", F.pmod(F.xxhash64("block"), F.lit(left)).cast("int")).groupBy("id", "block").applyInPandas(
            add, "id long, block int, part binary")

    def finish(frames):
        for f in frames:
            rows = []
            for part in f["part"]:
                flat, spot, vec = np.frombuffer(part), 0, []
                for p, g in zip(points, gram):
                    a = flat[spot:spot + p.rank ** 2].reshape(1, p.rank, p.rank)
                    b = flat[spot + p.rank ** 2:spot + p.rank ** 2 + p.rank][None]
                    spot += p.rank ** 2 + p.rank + 1
                    vec.append(solve(a, b, flat[spot - 1:spot], g, p)[0])
                rows.append(np.concatenate(vec).astype("<f4").tobytes())
            yield pd.DataFrame({"id": f["id"], "vec": rows})

    merged = materialize(summed.mapInPandas(finish, "id long, vec binary"), "als-factors")
    return stepped.filter("part is null").select("id", "vec").unionByName(merged)


class Fit(NamedTuple):
    """Factor tables (id, vec) of all points after some number of rounds."""

    points: list[Point]
    users: DataFrame
    items: DataFrame

    def factors(self, kind: str = "user", point: int = 0) -> DataFrame:
        """id, features (array of float) of one point."""
        table, s, width = self.users if kind == "user" else self.items, slices_of(self.points)[point], sum(p.rank for p in self.points)

        def run(frames):
            for f in frames:
                yield pd.DataFrame({"id": f["id"], "features": list(factor_matrix(f["vec"], width)[:, s])})

        return table.mapInPandas(run, "id long, features array<float>")


def fit(ratings: DataFrame, points: list[Point], rounds: tuple[int, ...], user: str = "user_id", item: str = "item_id",
        rating: str = "rating", seed: int = ALS_SEED, per_block: int | None = None, per_id: int | None = None) -> dict[int, Fit]:
    """rounds -> the fit after so many rounds, for each of ``rounds``.  A round
    solves the items, then the users; fits of fewer rounds are passed on the way."""
    per_block = per_block or block_size(points)
    by_user = lay_out(ratings, user, item, rating, per_block, per_id)
    by_item = lay_out(ratings, item, user, rating, per_block, per_id)
    users, out = first_factors(by_user.ids, points, seed), {}
    for n in range(1, max(rounds) + 1):
        items = half_step(by_item, users, points)
        users = half_step(by_user, items, points)
        if n in rounds:
            out[n] = Fit(points, users, items)
    return out


def squared_errors(model: Fit, rows: DataFrame, user: str = "user_id", item: str = "item_id", rating: str = "rating") -> DataFrame:
    """point, n_rows, squares: the sum of squared errors of every point over the
    rows whose user and item were trained."""
    points, at, width = model.points, slices_of(model.points), sum(p.rank for p in model.points)
    layout = lay_out(rows, user, item, rating, block_size(points))
    own = shipments(needed(layout.blocks, "ids"), model.users, width).withColumn("side", F.lit(0))
    met = shipments(layout.needs, model.items, width).withColumn("side", F.lit(1))

    def run(key, block, shipped):
        if not len(block) or not len(shipped):
            return pd.DataFrame({"point": [], "n_rows": [], "squares": []}).astype({"point": "int32", "n_rows": "int64"})
        row, sides = block.iloc[0], []
        starts, rating_ = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["ratings"])
        ids = np.repeat(np.frombuffer(row["ids"], np.int64), np.diff(np.append(starts, len(rating_))))
        for side, wanted in ((0, ids), (1, np.frombuffer(row["others"], np.int64))):
            some = shipped[shipped["side"] == side]
            known = unplaned(some["others"], np.int64)
            order = np.argsort(known)
            known = np.append(known[order], np.iinfo(np.int64).max)
            spot = np.searchsorted(known, wanted)
            sides.append((unplaned(some["vecs"], np.float32).reshape(-1, width)[order], spot, (known[spot] == wanted) & (spot < len(order))))
        (x, u, a), (y, v, b) = sides
        both = np.flatnonzero(a & b)
        out = []
        for s in at:
            guess = np.einsum("ij,ij->i", x[u[both], s].astype(np.float64), y[v[both], s].astype(np.float64))
            out.append(float(((rating_[both] - guess) ** 2).sum()))
        return pd.DataFrame({"point": np.arange(len(points), dtype=np.int32), "n_rows": len(both), "squares": out})

    told = layout.blocks.groupBy("block").cogroup(own.unionByName(met).groupBy("block")).applyInPandas(
        run, "point int, n_rows long, squares double")
    return told.groupBy("point").agg(F.sum("n_rows").alias("n_rows"), F.sum("squares").alias("squares"))
