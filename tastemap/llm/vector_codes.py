"""Vector codes: product quantisation fitted by Lloyd's rounds over cover trees.

Vectors become integers and are cut into consecutive parts; every part position
has a codebook.  The points of a position never change while codebooks do, so
each task builds, once, a cover tree of every batch of points (equal points are
one, with a weight): children of a node lie within a fixed fraction of its
radius.  The trees are written to the shared folder.  A tree keeps its points in
an order in which every subtree is one stretch, so a subtree's count and sum are
differences of running sums.

A round reads the trees against the present codebooks, from the roots down.
Where the nearest entry of a node's centre is nearer than the second one by more
than twice the node's radius, the triangle inequality gives that entry to the
whole stretch at once.  Other nodes descend, and the points of ambiguous leaves
are compared one by one, in exact integer arithmetic with ties to the lower
index.  Tasks emit one sum for each entry that got points; these are added up by
entry, and only the codebooks (parts x entries rows) reach the driver.

Edge cases: vectors null or holding null or non-finite components are dropped;
vectors of each length have codebooks of their own; a length that the number of
parts does not divide gives its first parts one component more, an empty vector
has empty parts (index 0, error 0); with fewer rows than entries there is an
entry a row; first entries are rows in order of vec_id (null ids last, equal ids
by vector), repeated rows count as often as they occur; scaled components are
held within +-2^27, so that all sums fit 64 bits; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.text import map_arrow
from tastemap.sources.files import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
SHRINK = 1.3            # a child's radius is at most its parent's over this
LEAF = 8                # points of a node that is not split further
WIDEST = 2.0 ** 27
EXACT = 2.0 ** 53


def finite(vector):
    """Not null and without null or non-finite components; may be empty."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def scaled(vector, scale: int):
    """floor(scale * x) of every component x, taken as double."""
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(
        x.cast("double") * float(scale), F.lit(-WIDEST)), F.lit(WIDEST))).cast("long"))


def cuts(dim: int, parts: int) -> list[int]:
    """Bounds of consecutive parts as equal as can be, longer ones first."""
    return [p * (dim // parts) + min(p, dim % parts) for p in range(parts + 1)]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of y (integers)."""
    if not x.shape[1]:
        return np.zeros((len(x), len(y)))
    most = max(float(np.abs(x).max(initial=0)), float(np.abs(y).max(initial=0)))
    if 4 * most * most * x.shape[1] < EXACT:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
    out = np.empty((len(x), len(y)), np.int64)
    for i, row in enumerate(x):
        out[i] = ((y - row) ** 2).sum(axis=1)
    return out


class Tree(NamedTuple):
    """A cover tree over ``points``, kept in an order in which every node is
    the stretch lo..hi and its centre the point at lo."""

    points: np.ndarray      # distinct points (int64)
    where: np.ndarray       # position among them of every row of the batch
    nodes: np.ndarray       # lo, hi, first child, number of children (0: a leaf)
    radius: np.ndarray      # of each node, around its centre

    @classmethod
    def build(cls, rows: np.ndarray) -> Tree:
        points, where = np.unique(rows, axis=0, return_inverse=True)
        x, order = points.astype(np.float64), np.arange(len(points))
        nodes, radius, far = [[0, len(x), 0, 0]], [0.0], [np.sqrt(((x - x[0]) ** 2).sum(axis=1))]
        at = 0
        while at < len(nodes):
            lo, hi, _, _ = nodes[at]
            dist = far[at]
            far[at], radius[at] = None, float(dist.max()) * (1 + 1e-12)
            if hi - lo > LEAF:
                cover, todo, own, spot = radius[at] / SHRINK, order[lo:hi].copy(), dist, lo
                nodes[at][2] = len(nodes)
                while len(todo):
                    near = own <= cover
                    near[0] = True                            # the centre itself
                    group = todo[near]
                    order[spot:spot + len(group)] = group
                    nodes.append([spot, spot + len(group), 0, 0])
                    radius.append(0.0)
                    far.append(own[near])
                    spot += len(group)
                    todo = todo[~near]
                    if len(todo):
                        own = np.sqrt(((x[todo] - x[todo[0]]) ** 2).sum(axis=1))
                nodes[at][3] = len(nodes) - nodes[at][2]
            at += 1
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        return cls(points[order], place[where.ravel()], np.array(nodes, np.int64), np.array(radius))

    def pack(self) -> list[bytes]:
        return [self.where.astype("<i4").tobytes(), self.nodes.astype("<i4").tobytes(), self.radius.astype("<f8").tobytes()]

    @classmethod
    def unpack(cls, rows: np.ndarray, where: bytes, nodes: bytes, radius: bytes) -> Tree:
        where = np.frombuffer(where, "<i4")
        points = np.empty((where.max() + 1, rows.shape[1]), np.int64)
        points[where] = rows
        return cls(points, where, np.frombuffer(nodes, "<i4").reshape(-1, 4).astype(np.int64), np.frombuffer(radius, "<f8"))

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, int]:
        """(index of the nearest entry of every point, points compared one by one)."""
        label, looked = np.empty(len(self.points), np.int64), 0
        active = np.zeros(1, np.int64)
        while len(active):
            lo, hi, child, children = self.nodes[active].T
            dist = squared(self.points[lo], book)
            first = dist.argmin(axis=1)
            d1 = np.sqrt(dist[np.arange(len(dist)), first].astype(np.float64))
            if dist.shape[1] > 1:
                dist[np.arange(len(dist)), first] = dist.max()
                d2 = np.sqrt(dist.min(axis=1).astype(np.float64))
            else:
                d2 = np.full(len(dist), np.inf)
            # Strictly nearer for every point of the node, whatever the roundings.
            sure = d2 - d1 > 2 * self.radius[active] + 1e-9 * (1 + d1 + self.radius[active])
            alone = hi - lo == 1                                # its own centre: the first minimum is exact
            for a, b, c in zip(lo[sure | alone].tolist(), hi[sure | alone].tolist(), first[sure | alone].tolist()):
                label[a:b] = c
            leaf = ~sure & ~alone & (children == 0)
            if leaf.any():
                points = spread(lo[leaf], hi[leaf] - lo[leaf])
                looked += len(points)
                label[points] = squared(self.points[points], book).argmin(axis=1)
            inner = ~sure & (children > 0)
            active = spread(child[inner], children[inner])
        return label, looked

    def sums(self, label: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """(points, sums) of every entry: differences of the running sums at
        the ends of stretches of one label."""
        weight = np.bincount(self.where, minlength=len(self.points))
        upto = np.zeros((len(weight) + 1, self.points.shape[1] + 1), np.int64)
        np.cumsum(weight, out=upto[1:, 0])
        np.cumsum(self.points * weight[:, None], axis=0, out=upto[1:, 1:])
        end = np.append(np.flatnonzero(np.diff(label)) + 1, len(label))
        start = np.concatenate([[0], end[:-1]])
        total = np.zeros((entries, upto.shape[1]), np.int64)
        np.add.at(total, label[start], upto[end] - upto[start])
        return total[:, 0], total[:, 1:]


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of every stretch, one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def plant(rows: DataFrame, parts: int) -> DataFrame:
    """dim, ids, labels, data (the vectors) and a tree for each part position:
    one row for each length in each batch of vec_id, label, v."""
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def run(batches):
        for batch in batches:
            v = batch.column("v")
            v = v.cast(pa.list_(pa.int64())) if not pa.types.is_list(v.type) else v
            sizes = np.diff(v.offsets.to_numpy())
            flat = v.flatten().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                x = flat[spread((np.cumsum(sizes) - sizes)[at], sizes[at])].reshape(len(at), dim)
                edge = cuts(dim, parts)
                trees = [Tree.build(x[:, a:b]).pack() for a, b in zip(edge, edge[1:])]
                picked = [batch.column(c).take(pa.array(at)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim], pa.int32()), *[pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), p) for p in picked],
                     pa.array([x.astype("<i4").tobytes()], pa.binary()),
                     pa.array([[b for tree in trees for b in tree]], pa.list_(pa.binary()))],
                    ["dim", "ids", "labels", "data", "trees"])

    return materialize(map_arrow(rows, run, f"dim int, ids array<{id_type}>, labels array<{label_type}>, data binary, "
                                            "trees array<binary>"), "cover-trees")


def planted(batch: pa.RecordBatch, parts: int):
    """(row, dim, vectors, trees) of every planted row of an Arrow batch."""
    for i, dim in enumerate(batch.column("dim").to_pylist()):
        x = np.frombuffer(batch.column("data")[i].as_py(), "<i4").astype(np.int64)
        x = x.reshape(len(batch.column("ids")[i]), dim)
        packed, edge = batch.column("trees")[i].as_py(), cuts(dim, parts)
        yield i, dim, x, [Tree.unpack(x[:, a:b], *packed[3 * p:3 * p + 3]) for p, (a, b) in enumerate(zip(edge, edge[1:]))]


def fit(rows: DataFrame, trees: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict:
    """length -> codebooks (one array of entries x width for each part)."""
    books: dict = {}
    # A job for each length, of which a table has one or a few: its smallest ids.
    for dim in sorted(r["dim"] for r in trees.select("dim").distinct().collect()):
        some = (rows.filter(F.size("v") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries)
                .select("v").collect())
        x, edge = np.array([r["v"] for r in some], np.int64).reshape(len(some), dim), cuts(dim, parts)
        books[dim] = [x[:, a:b] for a, b in zip(edge, edge[1:])]
    for _ in range(rounds):
        def run(batches, books=books):
            total: dict = {}
            for batch in batches:
                for _, dim, _, own in planted(batch, parts):
                    for p, tree in enumerate(own):
                        book = books[dim][p]
                        count, added = tree.sums(tree.assign(book)[0], len(book))
                        if (dim, p) in total:
                            total[dim, p][0] += count
                            total[dim, p][1] += added
                        else:
                            total[dim, p] = [count, added]
            for (dim, p), (count, added) in total.items():
                used = np.flatnonzero(count)
                yield pa.RecordBatch.from_pydict({
                    "dim": pa.array([dim] * len(used), pa.int32()), "part": pa.array([p] * len(used), pa.int32()),
                    "entry": pa.array(used, pa.int32()), "n": pa.array(count[used]),
                    "sums": pa.array(added[used].tolist(), pa.list_(pa.int64()))})

        # A row for each entry and task.
        told = map_arrow(trees, run, "dim int, part int, entry int, n long, sums array<long>")
        zeros = F.transform(F.element_at(F.collect_list("sums"), 1), lambda x: F.lit(0).cast("long"))
        summed = told.groupBy("dim", "part", "entry").agg(
            F.sum("n").alias("n"),
            F.aggregate(F.collect_list("sums"), zeros, lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("sums"))
        books = {dim: [b.copy() for b in own] for dim, own in books.items()}
        for r in summed.collect():                               # at most parts x entries rows a length
            books[r["dim"]][r["part"]][r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
    return books


def encode(trees: DataFrame, books: dict, parts: int = PARTS) -> DataFrame:
    """vec_id, label, dim, code (two hex digits a part), error of every vector."""
    id_type, label_type = (trees.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))

    def run(batches):
        for batch in batches:
            for i, dim, x, own in planted(batch, parts):
                code = np.column_stack([tree.assign(book)[0][tree.where] for tree, book in zip(own, books[dim])])
                nearest = np.hstack([book[c] for book, c in zip(books[dim], code.T)])
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([dim] * len(x), pa.int32()),
                     pa.array(["".join("%02x" % c for c in row) for row in code.tolist()]),
                     pa.array(((x - nearest) ** 2).sum(axis=1).astype(np.int64))], ["vec_id", "label", "dim", "code", "error"])

    return map_arrow(trees, run, f"vec_id {id_type}, label {label_type}, dim int, code string, error long")


def digest(own: list[np.ndarray]) -> str:
    """sha256 of all entries' components in decimal, by part, entry, position."""
    return hashlib.sha256(",".join(str(c) for book in own for c in book.ravel().tolist()).encode()).hexdigest()


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 over vec_id,
    embedding, label."""
    rows = df.filter(finite(F.col("embedding"))).select("vec_id", "label", scaled(F.col("embedding"), scale).alias("v"))
    trees = plant(rows, parts)
    books = fit(rows, trees, parts, entries, rounds)
    coded = materialize(encode(trees, books, parts), "vector-codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    digests = reduce(lambda when, dim: when.when(F.col("dim") == dim, digest(books[dim])), books, F.when(F.lit(False), ""))
    return (coded.alias("c").join(by_label.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
            .select("vec_id", "code", "error", "label_error", digests.alias("codebooks_sha256")))


def _sql(rounds: int = ROUNDS) -> str:
    head = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT rid, vec_id, part, list_slice(e, part * (len(e) // {PARTS}) + 1, (part + 1) * (len(e) // {PARTS})) AS x
  FROM v, range({PARTS}) r(part)),
b0 AS MATERIALIZED (
  SELECT part, entry, x AS c FROM (
    SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id, x) - 1 AS entry FROM p)
  WHERE entry < {ENTRIES})"""
    for r in range(rounds + 1):
        head += f""",
a{r} AS MATERIALIZED (
  SELECT rid, part, best % {ENTRIES} AS entry, best // {ENTRIES} AS dist FROM (
    SELECT rid, part, min((list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT
                          * {ENTRIES} + entry) AS best
    FROM p JOIN b{r} USING (part) GROUP BY rid, part))"""
        if r < rounds:
            head += f""",
b{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.c, b.c) AS c FROM b{r} b LEFT JOIN (
    SELECT part, entry, list(m ORDER BY pos) AS c FROM (
      SELECT part, entry, pos, floor(sum(y) / count(*)) AS m FROM (
        SELECT part, entry, unnest(x) AS y, generate_subscripts(x, 1) AS pos FROM a{r} JOIN p USING (rid, part))
      GROUP BY part, entry, pos) GROUP BY part, entry) n USING (part, entry))"""
    return head + f""",
k AS (
  SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
  FROM a{rounds} GROUP BY rid),
s AS (
  SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT::VARCHAR), ','), ',' ORDER BY part, entry))
         AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN v USING (rid), s"""


SQL = _sql()
