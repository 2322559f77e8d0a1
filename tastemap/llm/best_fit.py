"""Best-fit packing of tokenised documents, mended by a swap-based local search.

Only documents longer than a window are cut, into full windows, each a sequence
of its own, and a rest.  A task gathers rests up to ``POOL_IDS`` ids, packs them
best fit, largest first, and then searches between the bins that are not full:
one document moves from the emptier bin to the fuller one, or is exchanged for a
smaller one, or two documents are exchanged for one smaller than both together.
Of all exchanges open to the emptiest bin the one that adds most to the sum of
squared fills is made, so the search ends, and emptier bins lose until they are
empty.  It stops early where the free room of the other bins could not take in
even the emptiest bin.  Bins that are nearly full are closed; the others' documents
go back into the pool with the next ones, and at the end every bin is closed.

State per task: one pool.  Sequence ids carry the partition number in their upper
bits, so no exchange of rows is needed.  A task leaves a bin or so unfilled,
so small input splits are read several by one task.

Edge cases: null and empty texts are documents of the end id alone; repeated
rows are packed once each; a document of exactly a window is one piece; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tastemap.llm.text import map_arrow, slices, text_of
from tastemap.llm.word_tokenizer import load_tokenizer

WINDOW, END_ID = 2048, 0
BATCH_DOCS = 512
POOL_IDS = 8 << 20          # ids of the pieces packed at once, about
CLOSED = 1 / 64             # bins with at most this share of free room are closed between pools
PATIENCE = 512               # bins in a row without an exchange after which the search ends
TASK_DOCS = 20_000          # documents of a task at least, unless cores would idle


class Bins:
    """Bins of pieces by number; ``sizes`` are the pieces' sizes."""

    def __init__(self, sizes: list[int], window: int):
        self.sizes, self.window = sizes, window
        self.bins: list[list[int]] = []
        self.fill: list[int] = []

    def best_fit(self) -> None:
        """Places every piece, largest first, into the fullest bin that takes it."""
        rooms: dict[int, list[int]] = defaultdict(list)     # free room -> bins
        mask = 0                                            # bit r: some bin has r free
        for i in sorted(range(len(self.sizes)), key=lambda i: (-self.sizes[i], i)):
            size = self.sizes[i]
            fits = mask >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = rooms[room].pop()
                if not rooms[room]:
                    mask ^= 1 << room
            else:
                room, b = self.window, len(self.bins)
                self.bins.append([])
                self.fill.append(0)
            self.bins[b].append(i)
            self.fill[b] += size
            room -= size
            if room:
                rooms[room].append(b)
                mask |= 1 << room

    def search(self, patience: int = PATIENCE) -> int:
        """Exchanges pieces between bins that are not full while that adds to
        the sum of squared fills; the number of exchanges made.  Ends when no
        bin can be emptied any more, or after ``patience`` bins in a row, the
        emptiest first, that no exchange helps."""
        made, failed, fill = 0, 0, np.array(self.fill, np.int64)
        where = np.empty(len(self.sizes), np.int64)
        for b, some in enumerate(self.bins):
            where[some] = b
        # What a bin may give back: one of its pieces, or nothing.
        piece, size = np.arange(len(where)), np.array(self.sizes, np.int64)
        stuck = np.zeros(len(fill), bool)
        while failed < patience:
            is_open = (fill > 0) & (fill < self.window)
            room = int((self.window - fill[is_open]).sum())
            # A bin can only be emptied into the room that the others have.
            todo = np.flatnonzero(is_open & ~stuck & (room - (self.window - fill) >= fill))
            if not len(todo):
                break
            if made % 64 == 0:
                piece = piece[is_open[where[piece]]]                  # pieces of full bins take no part
            source = int(todo[fill[todo].argmin()])
            exchange = self._best_exchange(source, fill, is_open, where, piece, size)
            if exchange is None:
                stuck[source] = True
                failed += 1
                continue
            target, give, take = exchange
            for a, b, some in ((source, target, give), (target, source, take)):
                for i in some:
                    where[i] = b
                    self.bins[a].remove(i)
                    self.bins[b].append(i)
                    fill[a] -= self.sizes[i]
                    fill[b] += self.sizes[i]
            made, failed, stuck[[source, target]] = made + 1, 0, False
            if not fill[source]:
                stuck[:] = False
        self.fill = fill.tolist()
        return made

    def _best_exchange(self, source: int, fill, is_open, where, piece, size):
        """(bin, pieces given, pieces taken) that adds most to the squared
        fills, of what ``source`` can give: one piece or two."""
        by_size: dict[int, list[int]] = defaultdict(list)
        for i in self.bins[source]:
            by_size[self.sizes[i]].append(i)
        give = {s: (some[0],) for s, some in by_size.items()}
        distinct = sorted(by_size)                                    # at most about 63 sizes fit a bin
        for n, a in enumerate(distinct):
            for b in distinct[n:]:
                if a + b not in give and (a != b or len(by_size[a]) > 1):
                    give[a + b] = (by_size[a][0], by_size[b][0] if a != b else by_size[a][1])
        offers = np.array(sorted(give), np.int64)
        bins = np.flatnonzero(is_open)
        at = np.concatenate([bins, where[piece]])
        back = np.concatenate([np.zeros(len(bins), np.int64), size[piece]])
        full = fill[at]
        k = np.searchsorted(offers, back + self.window - full, side="right") - 1       # the largest that fits
        gain = np.where(k >= 0, offers[k], 0) - back
        more = np.where((gain > 0) & is_open[at] & (at != source), 2 * gain * (full - fill[source] + gain), 0)
        best = int(more.argmax())
        if more[best] <= 0:
            return None
        taken = (int(piece[best - len(bins)]),) if best >= len(bins) else ()
        return int(at[best]), give[int(offers[k[best]])], taken


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, pool_ids: int = POOL_IDS,
         task_docs: int | None = TASK_DOCS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (binary),
    sequence_id, offset, from doc_id, text.  ``task_docs`` merges input splits
    without an exchange (one job counts the rows); None keeps the splits."""
    end = np.array([end_id], "<u4").tobytes()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tok, base, made, schema = load_tokenizer(path), TaskContext.get().partitionId() << 33, 0, None
        pool: list = []                                    # (doc_id, piece, start, ids)
        held = 0

        def rows(bins):
            nonlocal made
            out: list = [[] for _ in schema]
            for pieces in bins:
                at = 0
                for doc, piece, start, ids in pieces:
                    for column, value in zip(out, (doc, piece, start, len(ids) // 4, ids, base + made, at)):
                        column.append(value)
                    at += len(ids) // 4
                made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

        def close(last: bool):
            """Packs the pool; yields closed bins and keeps the others' pieces."""
            nonlocal pool, held
            packed = Bins([len(p[3]) // 4 for p in pool], window)
            packed.best_fit()
            packed.search()
            order = sorted((b for b, f in enumerate(packed.fill) if f), key=lambda b: (-packed.fill[b], b))
            # Half of the pool is closed at least, so the next one takes in new pieces.
            done = [b for n, b in enumerate(order) if last or packed.fill[b] >= window * (1 - CLOSED) or 2 * n < len(order)]
            kept = set(order).difference(done)
            for s in slices(len(done), BATCH_DOCS):
                yield rows([[pool[i] for i in packed.bins[b]] for b in done[s]])
            pool = [pool[i] for b in sorted(kept) for i in packed.bins[b]]
            held = sum(len(p[3]) // 4 for p in pool)

        for batch in batches:
            schema = pa.schema([("doc_id", batch.column("doc_id").type), ("piece", pa.int32()), ("start", pa.int64()),
                                ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for s in slices(len(texts), BATCH_DOCS):
                full = []
                for name, ids in zip(names[s], tok.encode_texts([text_of(t) for t in texts[s]])):
                    ids += end
                    for n, start in enumerate(range(0, len(ids), 4 * window)):
                        piece = (name, n, start // 4, ids[start: start + 4 * window])
                        if len(piece[3]) == 4 * window:
                            full.append([piece])
                        else:
                            pool.append(piece)
                            held += len(piece[3]) // 4
                yield rows(full)
                if held >= pool_ids:
                    yield from close(False)
        if schema is not None:
            yield from close(True)

    docs = docs.select("doc_id", "text")
    if task_docs:
        docs = docs.coalesce(max(docs.sparkSession.sparkContext.defaultParallelism, -(-docs.count() // task_docs)))
    return map_arrow(docs, run, f"doc_id {id_type}, piece int, start long, length long, ids binary, sequence_id long, offset long")
