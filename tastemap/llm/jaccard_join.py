"""Exact n-gram Jaccard join in size-banded tiles with bitmap signatures.

Documents become sets of distinct word shingles (64-bit hashes, sorted).  Equal
sets are one *node*.  Two sets of similarity t or more share an element among
the rarest (1 - t) of either set under any one global order; the order used is
rare first by a counting sketch over all shingles, so that passages, lines and
word runs common to many documents do not bring them together.

A *tile* is one such shared shingle and one size band (sizes within a factor
t; a node also visits the band below).  Within tiles, pairs are kept only if
the bit counts of their parity bitmaps allow enough overlap: each shingle
flips one bit, so the bits that differ are at most the elements not shared.
What remains is decided by exact intersection of the sorted arrays.

Only components are wanted, so pairs already connected are not compared:

1. every node of a tile against the tile's largest node,
2. in tiles whose other nodes belong to several components, every node outside
   the largest one against its nearest node (by bitmaps) of each other one,
3. if that left pairs out, all pairs of different components in such tiles.

A tile of many nodes is dealt into blocks of at most about ``BLOCK_ROWS`` rows
and probes, so no task holds a whole hot tile.  Each step's links are merged
by ``components``; nothing but counts and the sketch (of fixed size) reaches
the driver.  Texts are read again, not kept, where arrays are needed.

Edge cases: documents without words or text have an empty set and no links;
with fewer words than a shingle has, the whole sequence is the one shingle;
exact repeats share a node; a null doc_id takes part but names no component
unless it has only such rows; an empty table gives an empty result.  Two given
sets are mistaken for one another with probability 2^-64.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.llm.components import components
from tastemap.llm.lexicon import Words, by_bytes
from tastemap.llm.text import arrow_rows, by_weight, byte_texts, map_arrow, mix64, slices
from tastemap.sources.files import materialize

SKETCH_BITS = 17
BLOCK_ROWS = 4096
BROADCAST_IDS = 500_000       # ids sent to every task to pick texts; more are joined by shuffle
_SPREAD = np.random.default_rng(0xBEEF).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


class Rule(NamedTuple):
    """Shingles of ``words`` words; linked when den * intersection >= num * union."""

    words: int = 3
    num: int = 90
    den: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def band(self, n):
        return np.floor(np.log(n) / math.log(self.den / self.num)).astype(np.int32)

    def fits(self, small, large):
        return self.den * small >= self.num * large

    def differ(self, total):
        """The most elements not shared, for sets of ``total`` elements in all."""
        return total * (self.den - self.num) / (self.den + self.num)


def shingle_sets(texts: list[bytes], rule: Rule) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    k, words = rule.words, Words(texts, lower=True)
    h = words.word_hashes()
    runs = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for j in range(k):
        runs += h[j:len(h) - k + 1 + j] * _SPREAD[j] if len(runs) else runs
    runs = mix64(runs + np.uint64(k))
    out = []
    for a, n in zip(words.first.tolist(), words.counts.tolist()):
        if n >= k:
            out.append(np.unique(runs[a:a + n - k + 1]))
        else:
            whole = (h[a:a + n] * _SPREAD[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(mix64(np.array([whole], np.uint64)) if n else np.empty(0, np.uint64))
    return out


def node_of(shingles: np.ndarray) -> int:
    return int(np.array(xxhash.xxh3_64_intdigest(shingles.tobytes()), np.uint64).view(np.int64))


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity bits, as many as a power of two not below the set's size."""
    width = max(64, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    v = np.frombuffer(bits, np.uint64)
    while v.nbytes > size:
        v = v[:len(v) // 2] ^ v[len(v) // 2:]
    return v


def gaps(bits: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ between the bitmaps at positions ``a`` and ``b``; the
    wider of two is folded to the narrower, which keeps it a parity bitmap."""
    sizes = np.fromiter((len(x) if x else 0 for x in bits), np.int64, len(bits))
    least, out = np.minimum(sizes[a], sizes[b]), np.zeros(len(a), np.int64)
    for size in np.unique(least).tolist():
        of = np.flatnonzero(least == size)
        used, at = np.unique(np.concatenate([a[of], b[of]]), return_inverse=True)
        m = np.stack([_folded(bits[i], size) for i in used.tolist()])
        left, right = at[:len(of)], at[len(of):]
        for s in slices(len(of), max(1, (1 << 20) // size)):
            out[of[s]] = np.bitwise_count(m[left[s]] ^ m[right[s]]).sum(axis=1, dtype=np.int64)
    return out


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """A row per document (doc_id, n, node, bits), and, with a bucket, each
    task's shingle counts by sketch bucket."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n long, node long, bits binary, bucket int, times long"

    def run(batches):
        counts, out = np.zeros(1 << SKETCH_BITS, np.int64), None
        for batch in batches:
            out = pa.schema([("doc_id", batch.column("doc_id").type), ("n", pa.int64()), ("node", pa.int64()),
                             ("bits", pa.binary()), ("bucket", pa.int32()), ("times", pa.int64())])
            texts = byte_texts(batch.column("text"))
            for lo, hi in by_bytes(texts):
                sets = shingle_sets(texts[lo:hi], rule)
                counts += np.bincount(_buckets(np.concatenate(sets)), minlength=len(counts))
                none = pa.nulls(hi - lo, pa.int32())
                yield arrow_rows({"doc_id": batch.column("doc_id").slice(lo, hi - lo),
                                  "n": [len(s) for s in sets], "node": [node_of(s) for s in sets],
                                  "bits": [bitmap(s) if len(s) else None for s in sets],
                                  "bucket": none, "times": none.cast(pa.int64())}, out)
        if out is not None:
            at = np.flatnonzero(counts)
            yield arrow_rows({"doc_id": pa.nulls(len(at), out.field("doc_id").type), "n": pa.nulls(len(at), pa.int64()),
                              "node": pa.nulls(len(at), pa.int64()), "bits": pa.nulls(len(at), pa.binary()),
                              "bucket": at, "times": counts[at]}, out)

    return materialize(map_arrow(docs.select("doc_id", "text"), run, schema), "shingle-sets")


def _levels(sets: DataFrame) -> np.ndarray:
    """The order's first key by bucket: log2 of its count over all documents."""
    rows = (sets.filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.sum("times").alias("times"))
            .select("bucket", F.floor(F.log2("times")).cast("int").alias("level")).toArrow())
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    levels[rows["bucket"].to_numpy()] = rows["level"].to_numpy()
    return levels


def _shared_prefixes(docs: DataFrame, levels: np.ndarray, rule: Rule) -> DataFrame:
    """shingle, node, n: rarest shingles that nodes of fitting size share."""
    out = pa.schema([("shingle", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def prefixes(batches):
        done: set = set()                        # exact copies within the task count once
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for lo, hi in by_bytes(texts):
                rows: list = [[], [], []]
                for s in shingle_sets(texts[lo:hi], rule):
                    node = node_of(s)
                    if not len(s) or node in done:
                        continue
                    done.add(node)
                    p = rule.prefix(len(s))
                    key = (levels[_buckets(s)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                    rows[0].append(s[np.argpartition(key, p - 1)[:p]] if p < len(s) else s)
                    rows[1].append(np.full(len(rows[0][-1]), node))
                    rows[2].append(np.full(len(rows[0][-1]), len(s)))
                if rows[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows[0]).view(np.int64)),
                                                      pa.array(np.concatenate(rows[1])),
                                                      pa.array(np.concatenate(rows[2]))], schema=out)

    def shared(batches):
        """Of rows sorted by shingle, n, node: those next to one that fits."""
        held, live = None, False                 # the last row waits for its successor
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            if held is not None:
                rows = np.concatenate([held, rows], axis=1)
            keep = np.ones(rows.shape[1], bool)
            keep[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
            rows = rows[:, keep]
            near = (rows[0, 1:] == rows[0, :-1]) & rule.fits(rows[2, :-1], rows[2, 1:])
            ok = np.zeros(rows.shape[1], bool)
            ok[1:] |= near
            ok[:-1] |= near
            ok[0] |= live
            held, live = rows[:, -1:], bool(ok[-1])
            if ok[:-1].any():
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[:, :-1][:, ok[:-1]]], schema=out)
        if held is not None and live:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in held], schema=out)

    kind = "shingle long, node long, n long"
    rows = map_arrow(docs.select("doc_id", "text"), prefixes, kind)
    rows = rows.repartition("shingle").sortWithinPartitions("shingle", "n", "node")
    return materialize(map_arrow(rows, shared, kind), "shared-prefixes")


def _tiles(shared: DataFrame, rule: Rule) -> DataFrame:
    """Rows of each tile (shingle, band): own nodes and visitors of the band above."""
    band = F.floor(F.log("n") / F.lit(math.log(rule.den / rule.num))).cast("int")
    return (shared.withColumn("own", band)
            .withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1)))
            .withColumn("home", F.col("own") == F.col("band")).drop("own"))


def _passing(pairs: DataFrame, sigs: DataFrame, rule: Rule) -> DataFrame:
    """Distinct pairs a, b whose bitmaps allow the similarity."""
    def side(name):
        return sigs.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            total = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            at, bits = np.arange(batch.num_rows), batch.column("bits_a").to_pylist() + batch.column("bits_b").to_pylist()
            keep = gaps(bits, at, at + batch.num_rows) <= rule.differ(total)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    joined = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    return map_arrow(joined.select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), run, "a long, b long")


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs a, b that are links, by exact intersection of their arrays.

    ``a`` may be a hub of many pairs: it is joined last, on sorted sides that
    the engine can split.
    """
    wanted = (pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
              .join(nodes, "node"))
    wanted = materialize(wanted.select("doc_id", "node"), "wanted-sets")
    n = wanted.count()
    w = wanted.select(F.col("doc_id").alias("wanted_id"), F.col("node").alias("wanted_node"))
    some = (docs.select("doc_id", "text")
            .join(F.broadcast(w) if n <= BROADCAST_IDS else w, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
            .select("wanted_node", "text"))

    def arrays(batches):
        for batch in batches:
            texts, want = byte_texts(batch.column("text")), batch.column("wanted_node").to_pylist()
            for lo, hi in by_bytes(texts):
                rows = [(w, s.tobytes()) for w, s in zip(want[lo:hi], shingle_sets(texts[lo:hi], rule)) if node_of(s) == w]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.binary())], ["node", "shingles"])

    def exact(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                keep.append(rule.den * common >= rule.num * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"])

    sets = materialize(map_arrow(some, arrays, "node long, shingles binary"), "shingle-arrays")

    def side(name):
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"shingles_{name}"))

    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return map_arrow(joined.select("a", "b", "shingles_a", "shingles_b"), exact, "a long, b long").distinct()


def _contested(tiles: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of tiles that hold several components, with their component and
    whether it is another than the tile's largest one."""
    rows = tiles.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sizes = rows.groupBy("shingle", "band", "comp").agg(F.count(F.lit(1)).alias("size"))
    most = sizes.groupBy("shingle", "band").agg(
        F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("rows"),
        F.count(F.lit(1)).alias("parts")).filter("parts > 1").select(
        "shingle", "band", F.col("top.comp").alias("main"), "rows", (F.col("rows") - F.col("top.size")).alias("probes"))
    return rows.join(most, ["shingle", "band"]).withColumn("probe", F.col("comp") != F.col("main")).drop("main")


def _compare(tiles: list, rule: Rule, everything: bool) -> pa.RecordBatch:
    """Pairs of different components within tiles whose bitmaps allow the
    similarity.  ``tiles``: columns sorted by tile; see ``_foreign_pairs``."""
    key, asks, node, n, comp, home, bits = tiles
    edge = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
    begin = np.concatenate([[0], edge])
    tile = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(key))))
    r, p = np.flatnonzero(~asks), np.flatnonzero(asks)
    per_tile = np.bincount(tile[r], minlength=len(begin))
    first = np.searchsorted(tile[r], np.arange(len(begin)))
    found: list = []
    for s in by_weight(per_tile[tile[p]], 1 << 21):                  # bounded numbers of pairs at a time
        ask, of = p[s], tile[p[s]]
        at = np.repeat(ask, per_tile[of])
        start = np.repeat(first[of], per_tile[of])
        step = np.arange(len(at)) - np.repeat(np.cumsum(per_tile[of]) - per_tile[of], per_tile[of])
        to = r[start + step]
        ok = (comp[at] != comp[to]) & (home[at] | home[to]) & rule.fits(np.minimum(n[at], n[to]), np.maximum(n[at], n[to]))
        at, to = at[ok], to[ok]
        gap = gaps(bits, at, to)
        ok = gap <= rule.differ(n[at] + n[to])
        at, to, gap = at[ok], to[ok], gap[ok]
        more = np.zeros(len(at), bool)
        if not everything and len(at):                               # the nearest of each foreign component
            order = np.lexsort((gap, comp[to], at))
            at, to = at[order], to[order]
            new = np.ones(len(at), bool)
            new[1:] = (at[1:] != at[:-1]) | (comp[to][1:] != comp[to][:-1])
            more = np.diff(np.append(np.flatnonzero(new), len(at))) > 1
            at, to = at[new], to[new]
        found.append((np.maximum(node[at], node[to]), np.minimum(node[at], node[to]), more))
    a, b, more = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(more, pa.bool_())],
                                      ["a", "b", "more"])


def _foreign_pairs(contested: DataFrame, sigs: DataFrame, rule: Rule, everything: bool) -> DataFrame:
    """Pairs a, b of different components in a tile that pass the bitmaps: of
    every foreign component a probe's nearest node (``more``: it has others
    that pass), or everything.  Tiles are dealt into blocks of rows x probes."""
    r_blocks = F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")
    p_blocks = F.ceil(F.col("probes") / BLOCK_ROWS).cast("int")
    key = ["shingle", "band", "row_block", "probe_block"]

    def own(blocks):
        return F.pmod(F.xxhash64("node"), blocks).cast("int")

    def each(blocks):
        return F.explode(F.sequence(F.lit(0), blocks - 1))

    rows = contested.join(sigs.select("node", "bits"), "node")
    kept = ["node", "n", "comp", "home", "bits"]
    as_row = rows.select("shingle", "band", own(r_blocks).alias("row_block"), each(p_blocks).alias("probe_block"),
                         F.lit(False).alias("asks"), *kept)
    as_probe = rows.filter("probe").select("shingle", "band", each(r_blocks).alias("row_block"),
                                           own(p_blocks).alias("probe_block"), F.lit(True).alias("asks"), *kept)

    def run(batches):
        held = None                              # the last tile may go on in the next batch
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in key], axis=1)
            last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            held = batch.slice(last)
            if last:
                yield _compare(columns(batch.slice(0, last)), rule, everything)
        if held is not None:
            yield _compare(columns(held), rule, everything)

    def columns(batch):
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        return [np.stack([get(c) for c in key], axis=1), *(get(c) for c in ("asks", "node", "n", "comp", "home")),
                batch.column("bits").to_pylist()]

    dealt = as_row.unionAll(as_probe).repartition(*key).sortWithinPartitions(*key)
    return map_arrow(dealt, run, "a long, b long, more boolean").groupBy("a", "b").agg(F.max("more").alias("more"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links, by components of the components."""
    def side(name):
        return labels.select(F.col("node").alias(name), F.col("comp").alias(f"comp_{name}"))

    over = (links.join(side("a"), "a", "left").join(side("b"), "b", "left")
            .select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b")).filter("a <> b"))
    top = components(materialize(over.distinct(), "merges"))
    old = labels.join(top.select(F.col("node").alias("comp"), F.col("comp").alias("top")), "comp", "left")
    old = old.select("node", F.coalesce("top", "comp").alias("comp"))
    new = top.join(labels.select("node"), "node", "left_anti")
    return materialize(old.unionByName(new), "labels")


def join_components(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of doc_id, text."""
    sets = _sets(docs, rule)
    rows = sets.filter(F.col("bucket").isNull())
    nodes = materialize(rows.filter("n > 0").groupBy("node", "n").agg(
        F.min("doc_id").alias("doc_id"), F.first("bits").alias("bits")), "nodes")
    reps, sigs = nodes.select("node", "doc_id"), nodes.select("node", "n", "bits")
    shared = _shared_prefixes(docs, _levels(sets), rule)
    tiles = _tiles(shared, rule)
    # A tile without own nodes has no pair of its own.
    largest = tiles.filter("home").groupBy("shingle", "band").agg(F.max(F.struct("n", "node")).alias("top"))
    small, large = F.least("n", F.col("top.n")), F.greatest("n", F.col("top.n"))
    stars = tiles.join(largest, ["shingle", "band"]).filter(
        (F.col("node") != F.col("top.node")) & (small * rule.den >= large * rule.num)).select(
        F.col("top.node").alias("a"), F.col("node").alias("b"))
    links = materialize(_linked(materialize(_passing(stars, sigs, rule), "pairs"), docs, reps, rule), "links")
    labels = components(links)
    rest = tiles.join(largest, ["shingle", "band"]).filter(F.col("node") != F.col("top.node")).drop("top")
    for everything in (False, True):             # tiles without the node that the first step compared
        contested = materialize(_contested(rest, labels), "contested")
        pairs = materialize(_foreign_pairs(contested, sigs, rule, everything), "pairs")
        if pairs.isEmpty():
            break
        more = materialize(_linked(pairs, docs, reps, rule), "links")
        if not more.isEmpty():
            labels = _merged(labels, more)
        if pairs.filter("more").isEmpty():
            break
    ids = reps.join(labels, "node").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    known = labels.join(ids, "comp").select("node", "component_id")
    named = reps.join(known, "node", "left").select(
        "node", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
