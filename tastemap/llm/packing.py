"""Sum-of-squares online packing of tokenised documents into windows.

Each task packs its own documents in order.  A document longer than a window
gives full windows first; its rest goes to the fill level h that minimises the
sum over all levels of N(h) squared, where the level array N(h) counts the
partially filled windows of level h (level 0 opens a new one).  Ties go to the
fullest level.  When the input ends, the emptiest open windows are dissolved
into the gaps of the fullest (their pieces are cut there), and the one window
left over is cut into sequences of power-of-two length, which need no padding.

State per task: the level array and the ids of the open windows.  Sequence ids
carry the partition number in their upper bits, so no exchange is needed.

Edge cases: null and empty texts are documents of the end id alone; repeated
rows are packed once each; an empty table gives no rows.  A special
token's marker within a text gets its special id, as in a call of the library
with its defaults (``markers_are_text`` makes it ordinary text instead).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tastemap.llm.text import map_arrow, slices, text_of
from tastemap.llm.word_tokenizer import WordTokenizer, load_tokenizer  # noqa: F401

WINDOW = 2048
BATCH_DOCS = 512
END_ID = 1


class Packer:
    """Sum-of-squares packing; a piece is (doc index, start, ids as bytes)."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list] = [[] for _ in range(window)]   # windows by fill level

    def level_for(self, size: int) -> int:
        """The level whose choice adds least to the sum of squares."""
        w = self.window
        grow = np.where(np.arange(size, w + 1) < w, 2 * self.count[size:] + 1, 0)  # N(h+s) gains one
        cost = grow[: w - size + 1].copy()
        had = self.count[: w - size + 1]
        cost[1:] = np.where(had[1:] > 0, cost[1:] - 2 * had[1:] + 1, np.iinfo(np.int64).max)
        return int(len(cost) - 1 - np.argmin(cost[::-1]))

    def add(self, piece: tuple) -> list | None:
        """Places a piece; the window that it fills up, if any."""
        size = len(piece[2]) // 4
        if size == self.window:
            return [piece]
        h = self.level_for(size)
        win = self.open[h].pop() if h else []
        self.count[h] -= h > 0
        win.append(piece)
        if h + size == self.window:
            return win
        self.count[h + size] += 1
        self.open[h + size].append(win)
        return None

    def flush(self) -> list[list]:
        """Closes every open window without padding."""
        todo = [(h, win) for h in range(1, self.window) for win in self.open[h]]
        out, spare = [], []                       # spare: pieces of dissolved windows
        lo, hi = 0, len(todo) - 1
        while lo <= hi:
            gap, win = self.window - todo[hi][0], list(todo[hi][1])
            hi -= 1
            while gap:
                if not spare:
                    if lo > hi:
                        break
                    spare = list(todo[lo][1])
                    lo += 1
                doc, start, ids = spare.pop()
                take = min(gap, len(ids) // 4)
                win.append((doc, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    spare.append((doc, start + take, ids[4 * take:]))
                gap -= take
            if gap:
                out += self._powers(win)
            else:
                out.append(win)
        return out + self._powers(spare)

    @staticmethod
    def _powers(pieces: list) -> list[list]:
        """Sequences of power-of-two length that hold the pieces."""
        left = sum(len(p[2]) // 4 for p in pieces)
        pieces, out = pieces[::-1], []
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            seq: list = []
            while room:
                doc, start, ids = pieces.pop()
                take = min(room, len(ids) // 4)
                seq.append((doc, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    pieces.append((doc, start + take, ids[4 * take:]))
                room -= take
            out.append(seq)
        return out


def pack_documents(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
                   markers_are_text: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens,
    sequence_id, offset."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tok, packer = load_tokenizer(path, markers_are_text), Packer(window)
        base, made, schema = TaskContext.get().partitionId() << 33, 0, None

        def rows(windows):
            nonlocal made
            out: list = [[] for _ in schema]
            for win in windows:
                at = 0
                for (doc, tokens), start, ids in win:
                    size = len(ids) // 4
                    for column, value in zip(out, (doc, start, size, ids, tokens, base + made, at)):
                        column.append(value)
                    at += size
                made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

        for batch in batches:
            schema = pa.schema([("doc_id", batch.column("doc_id").type), ("start", pa.int64()), ("length", pa.int64()),
                                ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                                ("offset", pa.int64())])
            texts, names = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for s in slices(len(texts), BATCH_DOCS):
                full = []
                for name, ids in zip(names[s], tok.encode_texts([text_of(t) for t in texts[s]])):
                    ids += end
                    doc = (name, len(ids) // 4)
                    for start in range(0, len(ids), 4 * window):
                        win = packer.add((doc, start // 4, ids[start: start + 4 * window]))
                        if win:
                            full.append(win)
                yield rows(full)
        if schema is not None:
            yield rows(packer.flush())

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
             "sequence_id long, offset long")
