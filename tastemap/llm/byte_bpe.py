"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

Texts are cut into independent chunks, each chunk new to the task into the
matches of the pre-token pattern, and the distinct matches are merged together:
rows of similar length share a padded matrix, and in every round each row
merges its leftmost pair of minimum rank.  Pair ranks come from an
open-addressing hash table held in two arrays; finished rows leave the matrix
(compaction) and its width shrinks by one each round.  A match above
``LONG_PIECE`` bytes is merged alone, all occurrences of the minimum-rank pair
at once whenever that provably equals merging them one by one.

Edge cases: null and empty texts give no ids and decode to empty bytes;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.llm.lexicon import SPACE, Ranges, Runs, by_bytes
from tastemap.llm.text import LETTERS, PUNCT, WHITE, BoundedCache, map_arrow, slices, text_of

LONG_PIECE = 1024          # bytes; longer matches are merged one by one
MATRIX_CELLS = 1 << 20     # cells of one padded matrix
BATCH_DOCS = 512
CACHE_CHUNKS = 600_000     # distinct chunks remembered by a task
NONE = np.int32(2**31 - 1)
# Cuts that every match of the pattern respects: a plain word before
# punctuation, white space or the end; else white space with what follows it.
PIECE = re.compile(f" ?[{LETTERS}]+(?=[{PUNCT}{WHITE}]|$)|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
PLAIN = re.compile(f" ?[{LETTERS}]+").fullmatch
OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


def exact_pattern(pattern: str):
    """The pattern with its white space spelled out as Unicode White_Space."""
    return regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]")
                         .replace(r"\s", f"[{WHITE}]"))


class PairTable:
    """(left id, right id) -> merged id, by linear probing in arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(merged) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.full(1 << bits, NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.vals[slot[won]] = keys[won], merged[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``NONE`` where the pair does not merge (or an id is -1)."""
        keys = np.ascontiguousarray((left.astype(np.int64) << 32) | right).ravel()
        keys[(left.ravel() < 0) | (right.ravel() < 0)] = -2
        out = np.full(len(keys), NONE, np.int32)
        todo = np.flatnonzero(keys != -2)
        slot = self._slot(keys[todo])
        while len(todo):
            found = self.keys[slot]
            hit = found == keys[todo]
            out[todo[hit]] = self.vals[slot[hit]]
            go = ~hit & (found >= 0)
            todo, slot = todo[go], (slot[go] + 1) & self.mask
        return out.reshape(left.shape)


class ByteBpe:
    """Encoder and decoder over one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = exact_pattern(pattern)
        by_id = sorted(rank.items(), key=lambda x: x[1])
        size = by_id[-1][1] + 1
        self.token_len, self.token_at = np.zeros(size, np.int64), np.zeros(size, np.int64)
        ids = np.array([i for _, i in by_id])
        self.token_len[ids] = [len(t) for t, _ in by_id]
        self.token_at[ids] = np.cumsum(self.token_len[ids]) - self.token_len[ids]
        self.token_flat = np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)
        self.byte_ids = np.array([rank[bytes([i])] for i in range(256)], np.int32)
        pairs = [(rank[t[:i]], rank[t[i:]], r) for t, r in rank.items() if len(t) > 1
                 for i in range(1, len(t)) if t[:i] in rank and t[i:] in rank]
        self.pairs = PairTable(*(np.array(c, np.int32) for c in zip(*pairs)))
        self.runs = Runs(CACHE_CHUNKS)                   # chunk -> ids
        self.pieces = BoundedCache(CACHE_CHUNKS // 4)    # part of a chunk -> ids

    # --- merging ---------------------------------------------------------
    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        n = len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, n)
        m = np.full((n, width), -1, "<i4")
        m[np.arange(width) < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.pairs.ranks(m[:, :-1], m[:, 1:])
        out: list = [None] * n
        rows = np.arange(n)
        while True:
            best = rank.min(axis=1) if rank.shape[1] else np.full(len(rows), NONE, np.int32)
            done = best == NONE
            if done.any():
                for r, row, k in zip(rows[done].tolist(), m[done], lens[done].tolist()):
                    out[r] = row[:k].tobytes()
                keep = ~done
                rows, m, rank, lens, best = rows[keep], m[keep], rank[keep], lens[keep], best[keep]
                if not len(rows):
                    return out
            at, i = rank.argmin(axis=1), np.arange(len(rows))
            m[i, at] = best
            behind = np.arange(m.shape[1] - 1) > at[:, None]
            m = np.where(behind, m[:, 1:], m[:, :-1])                # every row shrinks by one
            rank = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            lens = lens - 1
            last = rank.shape[1]
            left = np.flatnonzero(at > 0)
            rank[left, at[left] - 1] = self.pairs.ranks(m[left, at[left] - 1], m[left, at[left]])
            right = np.flatnonzero(at < last)
            rank[right, at[right]] = self.pairs.ranks(m[right, at[right]], m[right, at[right] + 1])

    def _long(self, piece: bytes) -> bytes:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        while len(ids) > 1:
            rank = self.pairs.ranks(ids[:-1], ids[1:])
            best = rank.min()
            if best == NONE:
                break
            pos = np.flatnonzero(rank == best)
            start = np.maximum.accumulate(np.where(np.diff(pos, prepend=-2) > 1, np.arange(len(pos)), 0))
            pos = pos[(np.arange(len(pos)) - start) % 2 == 0]      # leftmost first, never overlapping
            after = ids[np.minimum(pos + 2, len(ids) - 1)]
            after = np.where(pos + 2 < len(ids), after, -1)
            new = ids.copy()
            new[pos] = best
            kept = np.ones(len(ids), bool)
            kept[pos + 1] = False
            new = new[kept]
            where = np.flatnonzero(np.isin(new, [best]))
            before = np.where(where > 0, new[np.maximum(where - 1, 0)], -1)
            t = np.full(len(pos), best, np.int32)
            lower = (self.pairs.ranks(t, after) < best).any() or \
                (self.pairs.ranks(before, np.full(len(where), best, np.int32)) < best).any()
            if lower and len(pos) > 1:                             # a merge opens an earlier one: go singly
                new = np.delete(ids, pos[0] + 1)
                new[pos[0]] = best
            ids = new
        return ids.astype("<i4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each piece (a non-empty byte string)."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            n = len(p)
            if n > LONG_PIECE:
                out[i] = self._long(p)
            else:
                buckets.setdefault(n if n <= 8 else 1 << (n - 1).bit_length(), []).append(i)
        for width, at in buckets.items():
            for s in slices(len(at), max(1, MATRIX_CELLS // width)):
                for i, ids in zip(at[s], self._matrix([pieces[i] for i in at[s]], width)):
                    out[i] = ids
        return out

    # --- whole texts -----------------------------------------------------
    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks; distinct matches are merged once."""
        parts = [PIECE.findall(c) for c in chunks]
        new = list({p for ps in parts for p in ps if p not in self.pieces})
        cut = [[m.encode("utf-8", "surrogatepass") for m in ([p] if PLAIN(p) else self.pattern.findall(p))]
               for p in new]
        matches = list({m for ms in cut for m in ms})
        ids = dict(zip(matches, self.merge(matches)))
        for p, ms in zip(new, cut):
            self.pieces[p] = ids[ms[0]] if len(ms) == 1 else b"".join(map(ids.__getitem__, ms))
        get = self.pieces.__getitem__
        return [b"".join(map(get, ps)) for ps in parts]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        self.pieces.trim()
        out: list = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if not OTHER_SPACE(t)]
        for i in set(range(len(texts))).difference(plain):
            out[i] = b"".join(self._encode_chunks(PIECE.findall(texts[i])))
        data = [texts[i].encode("utf-8", "surrogatepass") for i in plain]
        for lo, hi in by_bytes(data):
            out_of = self._encode_batch(data[lo:hi])
            for i, ids in zip(plain[lo:hi], out_of):
                out[i] = ids
        return out

    def _encode_batch(self, data: list[bytes]) -> list[bytes]:
        """A chunk is a word with the white space before it, or a text's last white space."""
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        joined = np.frombuffer(b"".join(data), np.uint8)
        if not len(joined):
            return [b""] * len(data)
        doc_end = np.cumsum(sizes)
        gap = SPACE[joined]
        start = gap.copy()
        start[1:] &= ~gap[:-1]                               # where a run of white space begins
        start[(doc_end - sizes)[sizes > 0]] = True
        start = np.flatnonzero(start)
        end = np.append(start[1:], len(joined))

        def make(at):
            chunks = [joined[s:e].tobytes().decode("utf-8", "surrogatepass")
                      for s, e in zip(start[at].tolist(), end[at].tolist())]
            return self._encode_chunks(chunks)

        ids, counts = self.runs.lookup(Ranges(joined), start, end, make)
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(start, doc_end)]
        cut, whole = np.concatenate([[0], upto * 4]).tolist(), ids.tobytes()
        return [whole[a:b] for a, b in zip(cut, cut[1:])]

    def decode(self, ids: bytes) -> bytes:
        """Gathers the bytes of all ids at once from the flat vocabulary."""
        ids = np.frombuffer(ids, "<u4")
        lens = self.token_len[ids]
        ends = np.cumsum(lens)
        if not len(ids):
            return b""
        at = np.arange(ends[-1]) + np.repeat(self.token_at[ids] - ends + lens, lens)
        return self.token_flat[at].tobytes()


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), from doc_id, text;
    with ``decoded`` also the bytes that the ids decode to."""

    def run(batches):
        bpe = load(path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s in slices(len(texts), BATCH_DOCS):
                ids = bpe.encode_texts([text_of(t) for t in texts[s]])
                columns = {"doc_id": batch.column("doc_id")[s], "ids": pa.array(ids, pa.binary())}
                if decoded:
                    columns["decoded"] = pa.array(map(bpe.decode, ids), pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary" + ", decoded binary" * decoded
    return map_arrow(docs.select("doc_id", "text"), run, schema)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that an ``ids`` column of ``encode`` stands for."""

    @F.pandas_udf("binary")
    def run(batches: pd.Series) -> pd.Series:
        bpe = load(path, pattern)
        return batches.map(bpe.decode, na_action="ignore")

    return run(ids)
