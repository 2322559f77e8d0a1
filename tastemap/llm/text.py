"""Text helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Unicode White_Space, as a character class body (fixed values).
WHITE = "\t-\r \x85\xa0  -     　"
# Latin letters that neither change class nor compose with what follows when
# lower-cased or normalised, and ASCII punctuation (fixed values).
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1500,
                "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}
PUNCT = "!-/:-@\\[-`{-~"


class BoundedCache(dict):
    """A per-task memo emptied between batches once it exceeds ``limit``."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


class WordHashes(BoundedCache):
    """word (bytes) -> 64-bit hash, computed on first sight."""

    def __missing__(self, word):
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over a uint64 array (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ascii_words(text: str | None) -> list[bytes]:
    """Lower-cases A-Z only and splits on space and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def is_text(value) -> bool:
    return isinstance(value, str) and value != ""


def text_of(value) -> str:
    """Arrow hands nulls over as None (or NaN); a null text counts as empty."""
    return value if isinstance(value, str) else ""


def slices(n: int, size: int):
    return (slice(i, min(n, i + size)) for i in range(0, n, size))


def by_weight(weights: np.ndarray, limit: int):
    """Consecutive slices whose weights add up to about ``limit`` at most."""
    group = (np.cumsum(weights) - weights) // max(1, limit)
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(weights)]):
        yield slice(a, b)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use."""
    name = f"_{stem}_{uuid.uuid4().hex[:8]}"
    return name if name not in df.columns else fresh(df, stem)


def sha_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % m, F.lit(0))


def drawn(salt: str) -> Column:
    """A number from 0 to 1 for each text, whatever row holds it."""
    return F.pmod(F.xxhash64("text", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def n_texts() -> Column:
    """About how many different texts a group of rows holds (aggregate)."""
    return F.approx_count_distinct(F.xxhash64("text"), 0.02)


def byte_texts(column) -> list[bytes]:
    """The UTF-8 bytes of an Arrow string column; null counts as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def _giving_back(run):
    """``run``, handing freed memory back to the system when a task ends: idle
    workers stay alive beside those of the stages that follow."""
    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # where the C library has it
        if trim:
            trim(0)

    return task


def map_arrow(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """mapInArrow in batches within ``ARROW_LIMITS`` (session settings, lowered
    where they are higher), which bounds the texts a task holds at once."""
    conf = df.sparkSession.conf
    for name, most in ARROW_LIMITS.items():
        try:
            now = int(conf.get(name))
        except ValueError:                       # with a unit, such as 64m
            now = 0
        if not 0 < now <= most:
            conf.set(name, str(most))
    return df.mapInArrow(_giving_back(run), schema)


def fields_and(docs: DataFrame, keep: list[str], more: str) -> StructType:
    """The schema of the ``keep`` columns followed by the columns of ``more`` (DDL)."""
    return StructType([*[docs.schema[c] for c in keep], *StructType.fromDDL(more)])


def arrow_rows(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns.values(), schema)],
        schema=schema)
