"""Language identification by hierarchical discrimination.

A text is the shares of its hashed byte trigrams over lower-cased letters.
Linear support vector machines, one for each pair of families, vote for the
language family; then machines for each pair of its languages vote within it.
The machines (squared hinge loss, dual coordinate descent) are fitted on a
sample of at most about ``SAMPLE_DOCS`` labelled texts, spread evenly over the
``MAX_LANGS`` languages of most texts; the sample is drawn by the text, so it
is the same whatever the ids and however often a row repeats.  Every text is
scored whole, as sums of weights.

Edge cases: null texts and texts without a letter are ``und`` with score 0; a
single learned language is predicted with score 1; with nothing to learn from
every text is ``und``; repeated rows get equal results.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.llm.lexicon import by_bytes
from tastemap.llm.text import byte_texts, crc_mod, drawn, fields_and, map_arrow, n_texts

SAMPLE_DOCS = 2000
MAX_LANGS = 64          # languages that are learned, those of most texts
BUCKETS = 4096
SCALE = 800.0           # shares times this are the machines' inputs
ROUNDS = 20
UNKNOWN = "und"
# Families of common languages (fixed values); others form a family each.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "semitic": ("am", "ar", "he", "mt"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

LETTER = regex.compile(r"\p{L}").search
_FOLD = np.full(256, 32, np.uint32)     # letters in lower case, all else as a space
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each position, start of each text); ``BUCKETS`` is no trigram."""
    joined = b" " + b"  ".join(texts) + b"   "
    x = _FOLD[np.frombuffer(joined, np.uint8)]
    code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    bucket[code == 0x202020] = BUCKETS
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    return bucket, np.cumsum(size) - size


def features(texts: list[bytes]) -> np.ndarray:
    """Rows of trigram shares."""
    bucket, start = trigrams(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.append(start, len(bucket))))
    counts = np.bincount(doc * (BUCKETS + 1) + bucket, minlength=len(texts) * (BUCKETS + 1))
    counts = counts.reshape(len(texts), -1)[:, :BUCKETS].astype(np.float32)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine for y in {-1, 1}."""
    x = np.hstack([x * SCALE, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    curve = (x * x).sum(axis=1) + 0.5 / cost
    rng = np.random.default_rng(3)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = max(0.0, alpha[i] - (y[i] * (w @ x[i]) - 1 + 0.5 / cost * alpha[i]) / curve[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class Model:
    """The family machines and, for every family, its languages' machines."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        family = np.array([FAMILY_OF.get(lang, lang) for lang in langs])
        self.families = sorted(set(family.tolist()))
        self.weights: list[np.ndarray] = []
        self.top = self._pairs(x, family, self.families)
        self.inner = {f: self._pairs(x, langs, sorted(set(langs[family == f].tolist()))) for f in self.families}
        w = np.array(self.weights).reshape(-1, BUCKETS + 1)
        # One row for each bucket and one of zeros for positions without a trigram.
        self.rows = np.vstack([w[:, :BUCKETS].T * SCALE, np.zeros((1, len(w)))])
        self.bias = w[:, BUCKETS]

    def _pairs(self, x, labels, names):
        out = []
        for a, b in combinations(range(len(names)), 2):
            of = (labels == names[a]) | (labels == names[b])
            self.weights.append(fit_svm(x[of], np.where(labels[of] == names[a], 1.0, -1.0)))
            out.append((a, b, len(self.weights) - 1))
        return names, out

    @staticmethod
    def _vote(pairs, margins):
        """(winner, its least margin against another) of each row."""
        names, machines = pairs
        votes = np.zeros((len(margins), len(names)))
        least = np.full((len(margins), len(names)), np.inf)
        for a, b, m in machines:
            v = margins[:, m]
            for name, side in ((a, v), (b, -v)):
                votes[:, name] += (side > 0) + 1e-6 * np.tanh(side)    # margins settle equal votes
                least[:, name] = np.minimum(least[:, name], side)
        win = votes.argmax(axis=1)
        return win, least[np.arange(len(win)), win]

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        bucket, start = trigrams(texts)
        seen = np.add.reduceat(bucket < BUCKETS, start, dtype=np.int64)
        margins = np.empty((len(texts), len(self.bias)))
        for m in range(len(self.bias)):
            margins[:, m] = np.add.reduceat(self.rows[:, m][bucket], start) / np.maximum(seen, 1) + self.bias[m]
        win, sure = self._vote(self.top, margins)
        out, score = [""] * len(texts), np.empty(len(texts))
        for f, name in enumerate(self.families):
            at = np.flatnonzero(win == f)
            lang, near = self._vote(self.inner[name], margins[at])
            score[at] = 1 / (1 + np.exp(-np.clip(2 * np.minimum(sure[at], near), -50, 50)))
            for i, x in zip(at.tolist(), lang.tolist()):
                out[i] = self.inner[name][0][x]
        return out, score


def fit(docs: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from the rows (doc_id, text, lang) for which ``learn`` holds."""
    rows = docs.filter(learn & F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(n_texts().alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MAX_LANGS).collect()}
    if not counts:
        return None
    each = -(-sample_docs // len(counts))
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, each / max(1, n)))])
    sample = (rows.filter(drawn("langid") < F.coalesce(F.element_at(share, F.col("lang")), F.lit(0.0)))
              .select("text", "lang").dropDuplicates(["text", "lang"]))

    def run(batches):
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for lo, hi in by_bytes(texts):
                yield pa.RecordBatch.from_pydict({"lang": batch.column("lang").slice(lo, hi - lo),
                                                  "x": [r.tobytes() for r in features(texts[lo:hi])]})

    table = map_arrow(sample, run, "lang string, x binary").toArrow()
    if not table.num_rows:
        return None
    order = np.argsort(np.array(table["lang"].to_pylist()), kind="stable")
    x = np.stack([np.frombuffer(v, np.float32) for v in table["x"].to_pylist()])
    return Model(x[order], np.array(table["lang"].to_pylist())[order])


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with lang_pred and score, for every row."""
    def run(batches):
        for batch in batches:
            texts = byte_texts(batch.column("_text"))
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            some = [i for i, t in enumerate(texts) if model and LETTER(t.decode("utf-8", "surrogatepass"))]
            for lo, hi in by_bytes([texts[i] for i in some]):
                at = some[lo:hi]
                names, score[at] = model.predict([texts[i] for i in at])
                for i, name in zip(at, names):
                    lang[i] = name
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lang), pa.array(score)], [*keep, "lang_pred", "score"])

    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text")),
                     run, fields_and(docs, keep, "lang_pred string, score double"))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows not held out."""
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = predict(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang"), ~held_out), ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
