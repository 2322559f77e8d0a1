"""Exact top-n lists by inner product, without forming users x items.

Items are sorted by the norm of their factors and cut into slices; users are
cut into tiles.  A score is at most the product of the two norms, so a user
whose n-th score is above norm x an item's norm needs neither that item nor, as
norms fall, any after it.  A first pass scores each tile against the items of
the greatest norms alone, which tells the norm below which the tile needs no
slice; then every tile is sent the slices that it needs, once, in one shuffle,
sorted by falling norm.  A task takes them strip by strip, holds the best of
each user and stops when no user can gain, so memory is bounded by a tile and
an epoch of items (``EPOCH_BYTES``), and no list is written before it is ready.
What is sent grows with tiles x items, so tiles are as large as a task can hold
(their users are dealt over a few pools, which are sorted one at a time), and many
tiles are searched in waves, each a job whose shuffle files go when it ends.

Pairs may be barred from the lists (``seen``); they are sent to the tiles too,
and left out as scores are formed, so lists need not be longer for them.

Strips are scored in single precision; what lies within its rounding error of a
user's n-th score stays in the pool, and what stays is scored again in double
precision, so the lists are those of double precision.  Ties go to smaller ids.

A factor row may hold the factors of several points one after the other (see
``block_als``); each point has lists of its own, and is a group of its own.

Edge cases: fewer than n items give shorter lists; an empty side gives no rows;
rows with a null id or vector are left out; scores that are not numbers are in
no list.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.operators.block_als import factor_matrix
from tastemap.session import scratch_path
from tastemap.sources.files import materialize, write_spent

SLICE_BYTES = 2 << 20       # of the factors of a slice of items, about
STRIP_ITEMS = 4096          # items scored at once, and
BLOCK_CELLS = 1 << 20       # scores computed at once, about
FEWEST_OFFERS = 1 << 18     # that make a pool sort itself
LIST_CELLS = 1 << 18        # places of a row of lists
FIRST_ITEMS = 4             # times n: items of the first pass
EPOCH_BYTES = 32 << 20      # of item factors held by a pool until scored exactly
POOL_ENTRIES = 3 << 20      # list places of a pool, at most about, and
TILE_ENTRIES = 9 << 20      # of a tile of users, and
TILE_BYTES = 32 << 20       # of all points' factors of a tile
BARRED_PAIRS = 1 << 20      # that a pool takes in before it drops repeated ones
ROUNDING = 1e-9             # relative slack of the bounds
SINGLE = 2.0 ** -23         # relative error of a product in single precision, with room
TRUTH_ROWS = 1_000_000      # truth rows that meet stored lists of a tile at once, about
MOST_TASKS = 10_000         # of a search
WAVE_BYTES = 2 << 30        # of slices sent to tiles by one job, about
TILE = "point int, tile int, of int, ids binary, items binary, scores binary, scored long"
USERS, SEEN, ITEMS, TRUTH = 0, 1, 2, 3     # kinds of a group's rows, in the order in which a task meets them


def packed_vectors(table: DataFrame) -> DataFrame:
    """id, vec (binary, 32-bit) from id, features."""
    def run(frames):
        for f in frames:
            yield pd.DataFrame({"id": f["id"], "vec": [np.asarray(v, "<f4").tobytes() for v in f["features"]]})

    return table.select(F.col("id").cast("long"), "features").dropna().mapInPandas(run, "id long, vec binary")


def norms_of(x: np.ndarray) -> np.ndarray:
    """The norm of each row; infinite if not a finite number, so that no bound rules it out."""
    x = x.astype(np.float64)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return np.where(np.isfinite(norm), norm, np.inf)


def point_slices(widths: list[int]) -> list[slice]:
    ends = np.cumsum(widths).tolist()
    return [slice(e - w, e) for e, w in zip(ends, widths)]


def cut_slices(items: DataFrame, widths: list[int], slice_items: int | None = None) -> DataFrame:
    """point, slice, ids, vecs, n, norm (the greatest): each point's items by falling norm."""
    at, total = point_slices(widths), sum(widths)
    per = [slice_items or max(64, SLICE_BYTES // (4 * w)) for w in widths]

    def split(frames):
        for f in frames:
            x = factor_matrix(f["vec"], total)
            for p, s in enumerate(at):
                own = np.ascontiguousarray(x[:, s])
                yield pd.DataFrame({"point": np.full(len(f), p, np.int32), "id": f["id"], "vec": [v.tobytes() for v in own],
                                    "fall": -norms_of(own)})

    def pack(frames):
        made = itertools.count(TaskContext.get().partitionId() << 32)

        def row(f):
            return pd.DataFrame({"point": [f["point"].iloc[0]], "slice": [next(made)], "ids": [f["id"].to_numpy(np.int64).tobytes()], "vecs": [b"".join(f["vec"])],
                                 "n": [len(f)], "norm": [-f["fall"].iloc[0]]})

        left = None
        for f in frames:
            left = f if left is None else pd.concat([left, f])
            parts = [g for _, g in left.groupby("point", sort=True)]
            for i, g in enumerate(parts):
                size = per[g["point"].iloc[0]]
                whole = len(g) if i + 1 < len(parts) else len(g) - len(g) % size     # the last point may go on
                for lo in range(0, whole, size):
                    yield row(g.iloc[lo:min(whole, lo + size)])
                left = g.iloc[whole:]
        if left is not None and len(left):
            yield row(left)

    rows = items.dropna().mapInPandas(split, "point int, id long, vec binary, fall double")
    ordered = rows.repartitionByRange("point", "fall", "id").sortWithinPartitions("point", "fall", "id")
    return materialize(ordered.mapInPandas(pack, "point int, slice long, ids binary, vecs binary, n long, norm double"), "topn-slices")


def cut_tiles(users: DataFrame, widths: list[int], n: int, tile_users: int | None = None) -> tuple[DataFrame, int]:
    """(point, tile, ids, vecs) rows, and the number of tiles of a point."""
    at, total = point_slices(widths), sum(widths)
    per = tile_users or max(16, min(TILE_ENTRIES // n, TILE_BYTES // (4 * total)))
    n_users = users.count()
    # Idle cores get a tile too, unless these would hold hardly any users; lists don't depend on it.
    cores = users.sparkSession.sparkContext.defaultParallelism
    spare = min(-(-cores // len(widths)), -(-n_users // 256))
    tiles = max(1, -(-n_users // per), spare if tile_users is None else 1)

    def pack(key, f):
        f = f.sort_values("id")
        x, ids = factor_matrix(f["vec"], total), f["id"].to_numpy(np.int64).tobytes()
        return pd.DataFrame({"point": np.arange(len(at), dtype=np.int32), "tile": key[0], "ids": ids,
                             "vecs": [np.ascontiguousarray(x[:, s]).tobytes() for s in at]})

    dealt = users.dropna().withColumn("tile", tile_of("id", tiles))
    return materialize(dealt.groupBy("tile").applyInPandas(pack, "point int, tile int, ids binary, vecs binary"), "topn-tiles"), tiles


def tile_of(user: str, tiles: int):
    return F.pmod(F.xxhash64(user), F.lit(tiles)).cast("int")


def pools_of(ids: bytes, vecs: bytes, width: int, n: int) -> list["Pool"]:
    """The pools of a tile's users."""
    per, size = max(1, POOL_ENTRIES // n), len(ids) // 8
    return [Pool(ids[8 * lo:8 * (lo + per)], vecs[4 * width * lo:4 * width * (lo + per)], width, n) for lo in range(0, size, per)]


class Pool:
    """The best items so far of some users of one tile, in the order of their ids, at one point."""

    def __init__(self, ids: bytes, vecs: bytes, width: int, n: int):
        self.ids, self.x, self.n, self.width = np.frombuffer(ids, np.int64), factor_matrix([vecs], width), n, width
        self.norms = norms_of(self.x)
        self.least = np.full(len(self.ids), -np.inf)               # every user has n scores of at least this
        self.strip, self.scored, self.done = max(64, 4 * n), 0, not len(self.ids)
        # Of each score: whose, of what, bounds, the score if known, where the item is held if not.
        self.pool = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.float32), np.empty(0, np.float32), np.empty(0),
                     np.empty(0, np.int32))
        self.offers: list[tuple] = []                              # likewise, not yet in the pool
        self.held: list[np.ndarray] = []                           # factors of items since the last exact scoring
        self.waiting: list[tuple] = []                             # (ids, factors) not yet scored
        self.n_offers = self.n_held = self.n_waiting = 0
        self.barred = (np.empty(0, np.int64), np.empty(0, np.int64))   # (items, whose), sorted, and
        self.to_bar: list[tuple] = []                              # those not yet among them
        self.n_to_bar = 0

    def bar(self, users: np.ndarray, items: np.ndarray) -> None:
        """Pairs that are to be in no list; before any item is met."""
        spot = np.minimum(np.searchsorted(self.ids, users), len(self.ids) - 1)
        own = self.ids[spot] == users
        self.to_bar.append((items[own], spot[own]))
        self.n_to_bar += int(own.sum())
        if self.n_to_bar > max(BARRED_PAIRS, len(self.barred[0])):
            self.merge_barred()

    def merge_barred(self) -> None:
        item, user = (np.concatenate(c) for c in zip(self.barred, *self.to_bar))
        self.to_bar, self.n_to_bar = [], 0
        order = np.lexsort((user, item))
        item, user = item[order], user[order]
        new = np.append(True, (np.diff(item) != 0) | (np.diff(user) != 0))[:len(item)]
        self.barred = (item[new], user[new])

    def barred_cells(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whose, of which of ``ids``), by user."""
        if self.to_bar:
            self.merge_barred()
        item, user = self.barred
        lo, hi = np.searchsorted(item, ids), np.searchsorted(item, ids, "right")
        many = hi - lo
        spot = np.repeat(lo - (np.cumsum(many) - many), many) + np.arange(many.sum())
        order = np.argsort(user[spot])
        return user[spot][order], np.repeat(np.arange(len(ids)), many)[order]

    def wants(self, norm: float) -> np.ndarray:
        """Users who could gain from an item of at most this norm."""
        with np.errstate(invalid="ignore"):
            return ~(norm * self.norms * (1 + ROUNDING) + ROUNDING < self.least)

    def cut(self) -> float:
        """A norm below which no user could gain."""
        with np.errstate(invalid="ignore", divide="ignore"):
            some = (self.least - ROUNDING) / (self.norms * (1 + ROUNDING))
        some = np.where(np.isfinite(some), some - 1e-6 * np.abs(some), -np.inf)
        return float(some.min(initial=np.inf))

    def meet(self, ids: np.ndarray, y: np.ndarray, last: bool = False) -> None:
        """Takes items, whose norms fall, and scores them by strips, shorter ones only when they are the ``last``."""
        self.waiting.append((ids, y))
        self.n_waiting += len(ids)
        if self.n_waiting < self.strip and not last:
            return
        ids, y = (np.concatenate(c) for c in zip(*self.waiting))
        at = 0
        while not self.done and at < len(ids) and (last or len(ids) - at >= self.strip):
            some, own = ids[at:at + self.strip], y[at:at + self.strip]
            norm = float(norms_of(own).max())
            active = np.flatnonzero(self.wants(norm))
            if len(active):
                self.score(some, own, norm, active)
            self.done = not len(active)
            at += self.strip
            self.strip = min(max(STRIP_ITEMS, 4 * self.n), 2 * self.strip)
        self.waiting = [(ids[at:], y[at:])]
        self.n_waiting = len(self.waiting[0][0])

    def score(self, ids: np.ndarray, y: np.ndarray, norm: float, active: np.ndarray) -> None:
        single = norm * float(self.norms[active].max()) < 1e30     # else a score may not fit
        kind, error = (np.float32, SINGLE) if single else (np.float64, 2.0 ** -50)
        yt, w = np.ascontiguousarray(y.T, kind), len(ids)
        step, place = max(16, BLOCK_CELLS // w), self.n_held + np.arange(w, dtype=np.int32)
        self.held.append(y)
        self.n_held += w
        self.scored += len(active) * w
        whose, which = self.barred_cells(ids)
        for lo in range(0, len(active), step):
            who = active[lo:lo + step]
            with np.errstate(invalid="ignore", over="ignore"):
                score = self.x[who].astype(kind) @ yt
                off = error * (self.width + 4) * norm * self.norms[who] + 1e-35
            if not single:
                off = np.where(np.isfinite(off), off, 0.0)
                score[np.isnan(score)] = -np.inf                   # goes when it is scored again
            a, b = np.searchsorted(whose, [who[0], who[-1] + 1])
            row, column = np.searchsorted(who, whose[a:b]), which[a:b]
            row, column = (c[who[row] == whose[a:b]] for c in (row, column))
            score[row, column] = -np.inf
            floor = self.least[who] - off
            if w > self.n and np.isneginf(floor).any():            # the n-th score of this strip alone
                floor = np.maximum(floor, np.partition(score, w - self.n, axis=1)[:, w - self.n] - 2 * off)
            score[row, column] = np.nan                            # not even where anything is kept
            flat = np.flatnonzero(score >= np.nextafter(floor.astype(kind), kind(-np.inf))[:, None])
            user, item = np.divmod(flat, w)
            got, off = score.ravel()[flat].astype(np.float64), off[user]
            with np.errstate(over="ignore"):
                self.offers.append((who[user].astype(np.int32), ids[item], np.nextafter((got - off).astype(np.float32), np.float32(-np.inf)),
                                    np.nextafter((got + off).astype(np.float32), np.float32(np.inf)), np.full(len(flat), np.nan), place[item]))
            self.n_offers += len(flat)
            if self.n_offers > max(FEWEST_OFFERS, len(self.ids) * self.n // 2):
                self.prune()
        if y.shape[1] * 4 * self.n_held > EPOCH_BYTES:
            self.settle()

    def prune(self) -> None:
        """Takes the offers into the pool; what can't be among a user's best n goes."""
        if self.offers:
            pool = [np.concatenate(c) for c in zip(self.pool, *self.offers)]
            self.offers, self.n_offers = [], 0
            bits = pool[2].view(np.int32)
            rising = (bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64)     # whole numbers in the order of the scores
            order = np.argsort((pool[0].astype(np.int64) << 32) + (2 ** 31 - 1 - rising))
            user, low, high = pool[0][order], pool[2][order], pool[3][order]
            first = np.searchsorted(user, np.arange(len(self.ids) + 1))
            full = np.flatnonzero(np.diff(first) >= self.n)
            self.least[full] = np.maximum(self.least[full], low[first[full] + self.n - 1])
            kept = high >= self.least[user]
            order = order[kept]
            self.pool = (user[kept], pool[1][order], low[kept], high[kept], pool[4][order], pool[5][order])
        if len(self.pool[0]) > 2 * max(FEWEST_OFFERS, len(self.ids) * self.n):     # many scores alike
            self.exactly()

    def settle(self) -> None:
        """The pool scored exactly; the factors held are let go."""
        self.prune()
        self.exactly()
        self.held, self.n_held = [], 0

    def exactly(self) -> None:
        """Scores the pool exactly and keeps n items of a user."""
        user, item, _, _, exact, spot = self.pool
        new = np.flatnonzero(spot >= 0)
        y = np.concatenate(self.held) if len(new) else None
        step = max(1, BLOCK_CELLS // self.width)
        for lo in range(0, len(new), step):
            some = new[lo:lo + step]
            with np.errstate(invalid="ignore", over="ignore"):
                exact[some] = np.vecdot(self.x[user[some]].astype(np.float64), y[spot[some]].astype(np.float64))
        order = np.lexsort((item, -exact, user))
        order = order[~np.isnan(exact[order])]
        user, item, exact = user[order], item[order], exact[order]
        rank = np.arange(len(user)) - np.searchsorted(user, user)
        last = rank == self.n - 1
        self.least[user[last]] = np.maximum(self.least[user[last]], exact[last])
        kept = rank < self.n
        user, item, exact = user[kept], item[kept], exact[kept]
        with np.errstate(over="ignore"):
            near = exact.astype(np.float32)
        self.pool = (user, item, np.nextafter(near, np.float32(-np.inf)), np.nextafter(near, np.float32(np.inf)), exact,
                     np.full(len(user), -1, np.int32))

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """(items, scores): for every user n places, item -1 where free."""
        if self.waiting:
            ids, y = self.waiting.pop()
            self.n_waiting -= len(ids)
            self.meet(ids, y, last=True)
        self.settle()
        user, item, _, _, exact, _ = self.pool
        items, scores = np.full((len(self.ids), self.n), -1, np.int64), np.full((len(self.ids), self.n), -np.inf)
        rank = np.arange(len(user)) - np.searchsorted(user, user)
        items[user, rank], scores[user, rank] = item, exact
        return items, scores


def top_slices(slices: DataFrame, n: int) -> DataFrame:
    """point, top_ids, top_vecs: the items of the greatest norms, ``FIRST_ITEMS`` times n of them or
    all, in a row for each point; a slice of narrow factors may hold far more than a first bound needs."""
    some, counted = [], {}
    for r in sorted(slices.select("point", "slice", "n", "norm").collect(), key=lambda r: (r["point"], -r["norm"], r["slice"])):   # a row per slice
        if counted.get(r["point"], 0) < FIRST_ITEMS * n:
            some.append(r["slice"])
        counted[r["point"]] = counted.get(r["point"], 0) + r["n"]

    def join(key, f):
        f = f.sort_values(["norm", "slice"], ascending=[False, True])
        ids, vecs = b"".join(f["ids"]), b"".join(f["vecs"])
        most = min(FIRST_ITEMS * n, len(ids) // 8)
        return pd.DataFrame({"point": [key[0]], "top_ids": [ids[:8 * most]], "top_vecs": [vecs[:len(vecs) // (len(ids) // 8) * most]]})

    return slices.filter(F.col("slice").isin(some)).groupBy("point").applyInPandas(join, "point int, top_ids binary, top_vecs binary")


def search(users: DataFrame, items: DataFrame, n: int, widths: list[int], told, ended, schema: str, truth: DataFrame | None = None,
           slice_items: int | None = None, tile_users: int | None = None, slices: DataFrame | None = None,
           seen: DataFrame | None = None) -> list[DataFrame]:
    """The frames of ``schema``, a table for each wave of tiles, that each tile gives at each point when its search of users and items
    (id, vec) is over: ``told(point, pool, users, items)`` for the rows of ``truth`` (user,
    item) that its users have, some at a time, and ``ended(point, tile, of, pool)``, for each pool of
    the tile.  No pair of ``seen`` (user, item) is listed."""
    slices = slices if slices is not None else cut_slices(items, widths, slice_items)
    tiles, of = cut_tiles(users, widths, n, tile_users)

    def measure(frames):
        for f in frames:
            for row in f.itertuples():
                w = widths[row.point]
                cut = np.inf
                for pool in pools_of(row.ids, row.vecs, w, n):
                    if row.top_ids is not None:
                        pool.meet(np.frombuffer(row.top_ids, np.int64), factor_matrix([row.top_vecs], w), last=True)
                        pool.prune()
                    cut = min(cut, pool.cut())
                yield pd.DataFrame({"point": [row.point], "tile": [row.tile], "cut": [cut]})

    # A few times n items a point, and a row per tile: small whatever the tables.
    cuts = tiles.join(F.broadcast(top_slices(slices, n)), "point", "left").mapInPandas(measure, "point int, tile int, cut double")
    if seen is not None:                                           # the first pass doesn't know which of its items are barred
        cuts = tiles.select("point", "tile", F.lit(float("-inf")).alias("cut"))
    # What a wave sends is on disk until it ends, so waves hold as many tiles as their share of the slices allows.
    sent = slices.agg(F.sum(F.length("ids") + F.length("vecs"))).first()[0] or 0
    together = max(1, WAVE_BYTES // max(1, sent))
    cores = slices.sparkSession.sparkContext.defaultParallelism
    together = max(cores, together - together % cores)             # no core idles between the waves
    if together < of:
        cuts = materialize(cuts, "topn-cuts")                      # each wave reads them
    def pack(frames):
        for f in frames:
            for tile, some in f.groupby("tile"):
                yield pd.DataFrame({"tile": [tile], "ids": [some["user"].to_numpy(np.int64).tobytes()],
                                    "vecs": [some["item"].to_numpy(np.int64).tobytes()]})

    def sent_to(chosen):
        wanted = slices.join(F.broadcast(cuts.filter(chosen)), "point").filter("norm >= cut")
        rows = tiles.filter(chosen).select("point", "tile", F.lit(USERS).alias("kind"), F.lit(0.0).alias("fall"), "ids", "vecs").unionByName(
            wanted.select("point", "tile", F.lit(ITEMS).alias("kind"), (-F.col("norm")).alias("fall"), "ids", "vecs"))
        for kind, pairs in ((SEEN, seen), (TRUTH, truth)):
            if pairs is not None:
                dealt = pairs.select(F.col("user").cast("long"), F.col("item").cast("long")).dropna().withColumn("tile", tile_of("user", of))
                packed = dealt.filter(chosen).mapInPandas(pack, "tile int, ids binary, vecs binary")
                every = F.explode(F.sequence(F.lit(0), F.lit(len(widths) - 1))).alias("point")
                rows = rows.unionByName(packed.select(every, "tile", F.lit(kind).alias("kind"), F.lit(0.0).alias("fall"), "ids", "vecs"))
        return rows

    def run(frames):
        at, pools = None, []
        for f in frames:
            for point, tile, kind, ids, vecs in zip(f["point"], f["tile"], f["kind"], f["ids"], f["vecs"]):
                if kind == USERS:
                    while pools:
                        yield from ended(*at, of, pools.pop(0))
                    at, pools = (point, tile), pools_of(ids, vecs, widths[point], n)
                elif at != (point, tile):                          # a tile without users
                    continue
                elif kind == ITEMS:
                    for pool in pools:
                        if not pool.done:
                            pool.meet(np.frombuffer(ids, np.int64), factor_matrix([vecs], widths[point]))
                else:
                    who, what = np.frombuffer(ids, np.int64), np.frombuffer(vecs, np.int64)
                    for pool in pools:
                        if kind == SEEN:
                            pool.bar(who, what)
                        else:
                            yield from told(point, pool, who, what)
        while pools:
            yield from ended(*at, of, pools.pop(0))

    out, together = [], min(together, of)
    for lo in range(0, of, together):
        task = (F.col("point") * together + F.col("tile") - lo).cast("int")
        dealt = sent_to(F.col("tile").between(lo, lo + together - 1)).repartitionById(min(len(widths) * together, MOST_TASKS), task)
        out.append(dealt.sortWithinPartitions("point", "tile", "kind", "fall").mapInPandas(run, schema))
    return out


def stored_waves(waves: list[DataFrame], name: str) -> DataFrame:
    """The rows of all waves, written by one after the other."""
    if len(waves) == 1:
        return materialize(waves[0], name)
    spark = waves[0].sparkSession
    path = scratch_path(spark, name)
    for wave in waves:
        write_spent(wave, path, "append")
    return spark.read.parquet(path)


def top_lists(users: DataFrame, items: DataFrame, n: int, widths: list[int], slice_items: int | None = None,
              tile_users: int | None = None, slices: DataFrame | None = None, seen: DataFrame | None = None) -> DataFrame:
    """Rows of lists (point, tile, of, ids, items, scores, scored) of users and items (id, vec), several of a
    tile, each of some of its users; ``scored``: user-item pairs scored in the search.  No pair of ``seen``
    (user, item) is listed."""
    def ended(point, tile, of, pool):
        items, scores = pool.lists()
        step = max(1, LIST_CELLS // n)
        for lo in range(0, len(items), step):
            yield pd.DataFrame({"point": [point], "tile": [tile], "of": [of], "ids": [pool.ids[lo:lo + step].tobytes()],
                                "items": [items[lo:lo + step].tobytes()], "scores": [scores[lo:lo + step].tobytes()],
                                "scored": [0 if lo else pool.scored]})

    return stored_waves(search(users, items, n, widths, lambda *_: (), ended, TILE, None, slice_items, tile_users, slices, seen), "topn-tiles")


def explode_lists(tiles: DataFrame, widths: list[int], n: int, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """(point, user, rank, item, score) rows of the lists of ``len(widths)`` points."""
    def run(frames):
        for f in frames:
            for row in f.itertuples():
                ids, items = np.frombuffer(row.ids, np.int64), np.frombuffer(row.items, np.int64).reshape(-1, n)
                u, r = np.nonzero(items >= 0)
                yield pd.DataFrame({"point": np.full(len(u), row.point, np.int32), user: ids[u], "rank": (r + 1).astype(np.int64),
                                    item: items[u, r], "score": np.frombuffer(row.scores).reshape(-1, n)[u, r]})

    return tiles.filter(F.col("point") < len(widths)).mapInPandas(run, f"point int, {user} long, rank long, {item} long, score double")


def exact_top_n(users: DataFrame, items: DataFrame, n: int, width: int, user: str = "user_id", item: str = "item_id",
                slice_items: int | None = None, tile_users: int | None = None) -> DataFrame:
    """(user, rank, item, score) of users and items given as (id, features)."""
    tiles = top_lists(packed_vectors(users), packed_vectors(items), n, [width], slice_items, tile_users)
    return explode_lists(tiles, [width], n, user, item).drop("point")


class Listed:
    """The items of some users' lists, to be asked for pairs."""

    def __init__(self, ids: np.ndarray, items: np.ndarray):
        self.ids, (user, self.rank) = ids, np.nonzero(items >= 0)
        self.codes, code = np.unique(items[user, self.rank], return_inverse=True)
        keys = user * max(1, len(self.codes)) + code
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], self.rank[order]

    def hits(self, users: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(user ids, ranks) of the pairs that are listed."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        u, c = (np.minimum(np.searchsorted(own, some), len(own) - 1) for own, some in ((self.ids, users), (self.codes, items)))
        key = (u * len(self.codes) + c)[(self.ids[u] == users) & (self.codes[c] == items)]
        spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        spot, key = spot[self.keys[spot] == key], key[self.keys[spot] == key]
        return self.ids[key // len(self.codes)], self.rank[spot] + 1


def top_hits(users: DataFrame, items: DataFrame, truth: DataFrame, n: int, widths: list[int], user: str = "user_id",
             item: str = "item_id") -> DataFrame:
    """(point, user, rank) of the items of the top-n lists that are in ``truth`` (distinct user, item);
    neither the lists nor the users x n rows are stored."""
    def told(point, pool, who, wanted):
        if not hasattr(pool, "listed"):
            pool.listed = Listed(pool.ids, pool.lists()[0])
        ids, rank = pool.listed.hits(who, wanted)
        yield pd.DataFrame({"point": np.full(len(ids), point, np.int32), user: ids, "rank": rank})

    pairs = truth.select(F.col(user).alias("user"), F.col(item).alias("item"))
    waves = search(users, items, n, widths, told, lambda *_: (), f"point int, {user} long, rank long", pairs)
    return waves[0] if len(waves) == 1 else stored_waves(waves, "topn-hits")


def list_hits(tiles: DataFrame, truth: DataFrame, widths: list[int], n: int, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """As ``top_hits``, of stored lists."""
    n_tiles = tiles.agg(F.max("of")).first()[0] or 1
    dealt = truth.select(F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item")).withColumn(
        "tile", tile_of("user", n_tiles))
    # A tile with a user of very many truth rows meets them in several parts.
    parts = materialize(dealt.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / TRUTH_ROWS).cast("int").alias("parts")), "topn-parts")
    dealt = dealt.join(parts, "tile").select("tile", F.pmod(F.xxhash64("item"), F.col("parts")).cast("int").alias("part"), "user", "item")
    again = parts.select(F.col("tile").alias("tile_"), F.col("parts").alias("parts_"))
    copies = tiles.filter(F.col("point") < len(widths)).select("point", "tile", "ids", "items").join(again, F.col("tile") == F.col("tile_")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts_") - 1))).drop("tile_", "parts_")

    def run(key, tile, rows):
        out = [pd.DataFrame({"point": np.empty(0, np.int32), user: np.empty(0, np.int64), "rank": np.empty(0, np.int64)})]
        for row in tile.itertuples():
            own = Listed(np.frombuffer(row.ids, np.int64), np.frombuffer(row.items, np.int64).reshape(-1, n))
            ids, rank = own.hits(rows["user"].to_numpy(np.int64), rows["item"].to_numpy(np.int64))
            out.append(pd.DataFrame({"point": np.full(len(ids), row.point, np.int32), user: ids, "rank": rank}))
        return pd.concat(out)

    return copies.groupBy("tile", "part").cogroup(dealt.groupBy("tile", "part")).applyInPandas(run, f"point int, {user} long, rank long")
