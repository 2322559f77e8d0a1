"""Whole-text ids of a word-level BPE vocabulary, equal to the library's.

A word (white space apart) is cut before its first punctuation into a plain
run of letters and the rest.  Neither the normaliser nor the splitter of the
vocabulary looks across that cut.  Letters go straight to the library's BPE
model, in the lower-case byte alphabet that its normaliser would hand over;
everything else goes through the library's whole call.  Each distinct part is
encoded once, and a memo that compares the bytes gives the ids of its repeats.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

from tastemap.llm.lexicon import Runs, Words, by_bytes
from tastemap.llm.text import LETTERS, PUNCT, WHITE

CACHE_PARTS = 460_000       # of the memo, about 80 bytes each
LONGEST = 64                # bytes of the letters that go straight to the model
# Cuts that the tokenizer's normaliser and splitter respect: a plain word
# before punctuation, white space or the end; else a run without white space.
PIECE = re.compile(f"[{LETTERS}]+(?=[{PUNCT}{WHITE}]|$)|[^{WHITE}]+")


def _byte_alphabet() -> dict:
    """Byte -> character: printable ones stand for themselves, the others get
    the characters from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: 256 + n for n, b in enumerate(others)}


ALPHABET = _byte_alphabet()
_ASCII_LETTER, _ASCII_PUNCT = np.zeros(256, bool), np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_ASCII_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ``LETTERS``: ASCII ones, and both bytes of U+00C0..U+00FF but the two signs."""
    out = _ASCII_LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    after = data[lead + 1]
    lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]
    out[lead] = out[lead + 1] = True
    return out


class WordTokenizer:
    """Ids of texts, asked of the library once per distinct part of a word."""

    def __init__(self, path: str, markers_are_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = markers_are_text
        self.model = self.tokenizer.model
        self.runs = Runs(CACHE_PARTS)

    def _letters(self, part: bytes) -> bytes:
        word = part.lower().decode() if part.isascii() else \
            part.decode().lower().encode().decode("latin-1").translate(ALPHABET)
        return np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()

    def _others(self, parts: list[bytes]) -> list[bytes]:
        cut = [PIECE.findall(p.decode("utf-8", "surrogatepass")) for p in parts]
        pieces = list({p for some in cut for p in some})
        ids = {p: np.array(e.ids, "<u4").tobytes()
               for p, e in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False))}
        return [b"".join(map(ids.__getitem__, some)) for some in cut]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        return [ids for lo, hi in by_bytes(data) for ids in self._encode_batch(data[lo:hi])]

    def _encode_batch(self, data: list[bytes]) -> list[bytes]:
        words = Words(data)
        if not len(words.start):
            return [b""] * len(data)
        raw, first, last = words.data, words.start, words.end
        other = np.append(np.flatnonzero(~letters(raw)), len(raw))
        stop = np.minimum(other[np.searchsorted(other, first)], last)     # end of the leading letters
        plain = (stop > first) & ((stop == last) | _ASCII_PUNCT[raw[np.minimum(stop, len(raw) - 1)]])
        cut = np.where(plain, stop, first)
        # The letters and the rest of every word, in order; empty ones go.
        start, end = np.column_stack([first, cut]).ravel(), np.column_stack([cut, last]).ravel()
        is_plain = np.tile([True, False], len(first)) & (end - start <= LONGEST)
        some = np.flatnonzero(end > start)
        start, end, is_plain = start[some], end[some], is_plain[some]
        per_text = np.bincount(words.doc[some // 2], minlength=len(data))

        def make(at):
            parts = [raw[a:b].tobytes() for a, b in zip(start[at].tolist(), end[at].tolist())]
            out = [self._letters(p) if easy else None for p, easy in zip(parts, is_plain[at].tolist())]
            hard = [i for i, ids in enumerate(out) if ids is None]
            for i, ids in zip(hard, self._others([parts[i] for i in hard])):
                out[i] = ids
            return out

        ids, counts = self.runs.lookup(words, start, end, make)
        upto = np.concatenate([[0], np.cumsum(counts)])[np.cumsum(per_text)]
        cut, whole = np.concatenate([[0], upto * 4]).tolist(), ids.tobytes()
        return [whole[a:b] for a, b in zip(cut, cut[1:])]


@lru_cache(maxsize=2)
def load_tokenizer(path: str, markers_are_text: bool = False) -> WordTokenizer:
    return WordTokenizer(path, markers_are_text)
