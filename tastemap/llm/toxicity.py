"""Toxic spans by a linear-chain conditional random field.

Learning, on a sample of at most about ``SAMPLE_DOCS`` labelled documents of
either label:

1. A word's weight is the log ratio of how many distinct neighbourhoods (word
   before, word after) it has in toxic and in other documents; copies of a
   document repeat its neighbourhoods and so count once.
2. Tokens are labelled: words of clear weight, in toxic documents, are toxic.
   Clearness serves for these labels alone; the field never sees it.
3. The field sees a token's weight and its neighbours' weights; of a word without
   a weight it sees the spelling (first and last letters and length, as hashed
   marks).  In training one of 16 tokens hides its own weight, so that
   spelling and context learn to stand in for it.  Weights and transitions
   are fitted to the labelled tokens by gradient ascent on the conditional
   likelihood.
4. Documents' expected numbers of toxic tokens, from the forward-backward
   marginals of ``SOME`` or more (very many tiny ones would add up in a long
   text), are turned into a score by a logistic curve over their logarithm,
   fitted to the documents' labels, weighted back to their true shares.

Scoring runs over whole texts; runs of tokens above 0.5 are the offending spans,
told in code points.  The model keeps the ``VOCABULARY`` words of most
telling weight; spelling and context stand in for the others.

Edge cases: null and empty texts have no spans and the score of a text
without toxic tokens; labels that are null, or other than 0 and 1, teach
nothing; of repeated labels for an id the greatest counts; of an id with several
rows about one row's text is learned from; with nothing to learn from, every
score is 0; repeated rows get equal results.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.llm import crf
from tastemap.llm.lexicon import HashTable, Words, by_bytes
from tastemap.llm.text import byte_texts, crc_mod, drawn, fields_and, map_arrow, mix64
from tastemap.sources.files import materialize

SAMPLE_DOCS = 4000      # documents of either label that the words are weighed on
CRF_DOCS = 400          # documents of either label that the field is fitted on
VOCABULARY = 20_000     # words whose weights are kept
CLEAR_WEIGHT = 2.0      # log ratio from which a word is clear
CLEAR_TIMES = 4         # neighbourhoods in toxic documents that a clear word needs
CLEAR_EVIDENCE = 25.0   # and the least log-likelihood ratio, against chance among all words
AFFIXES = (2, 3, 4)     # letters (bytes) of the first and last letters that are marks
MARKS = 1 << 13         # numbers of marks, shared by hashing
CRF_L2 = 1e-2
SOME = 0.1              # least marginal that counts towards a document's score
N_MARKS = 1 + 2 * len(AFFIXES)      # of a token
_LETTERS = bytes(i if 97 <= i <= 122 or i >= 128 else i + 32 if 65 <= i <= 90 else 32 for i in range(256))


class Model(NamedTuple):
    keys: np.ndarray        # hashes of the weighed words
    values: np.ndarray      # their weights
    weights: np.ndarray     # of the field's features
    marks: np.ndarray       # of the field's marks
    trans: np.ndarray       # its transitions
    curve: np.ndarray       # logistic curve: bias, slope


def tokens(texts: list[bytes]) -> Words:
    """Lower-cased runs of letters; all else parts them, byte for byte."""
    return Words([t.translate(_LETTERS) for t in texts])


def spelling(words: Words, at: np.ndarray) -> np.ndarray:
    """Marks of the tokens ``at``: first and last letters, length.  The word as
    such is none, else it would be learned by heart instead of its spelling.
    The number ``MARKS`` is left for tokens that show none."""
    start, end = words.start[at], words.end[at]
    columns = [mix64((end - start).astype(np.uint64) + np.uint64(77))]
    for n in AFFIXES:
        columns.append(mix64(words.hashes(start, np.minimum(start + n, end)) + np.uint64(2 * n)))
        columns.append(mix64(words.hashes(np.maximum(end - n, start), end) + np.uint64(2 * n + 1)))
    return (np.stack(columns, axis=1) % np.uint64(MARKS)).astype(np.int64)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.table = HashTable()
        self.table.add(model.keys)
        self.values = np.append(model.values, 0.0)

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        return self.values[self.table.find(hashes)] if len(hashes) else np.empty(0)

    def marginals(self, words: Words) -> np.ndarray:
        """Each token's probability to be toxic."""
        if not len(words.start):
            return np.empty(0)
        # A word's spelling is scored once, however often it occurs in the batch.
        hashes = words.word_hashes()
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        features = token_features(self.lookup(hashes), words)
        spelled = np.where(features[:, 1] == 0, self.model.marks[spelling(words, first)].sum(axis=1)[which], self.model.marks[MARKS] * N_MARKS)
        return crf.marginals(features @ self.model.weights + spelled, words.counts, self.model.trans)

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """(scores, offending spans in code points) of the texts."""
        words = tokens(texts)
        p = self.marginals(words)
        scores = curve(self.model.curve, expected(p, words))
        spans: list = [[] for _ in texts]
        for i in np.flatnonzero(p > 0.5).tolist():
            doc = words.doc[i]
            a, b = int(words.start[i] - words.doc_start[doc]), int(words.end[i] - words.doc_start[doc])
            if i and p[i - 1] > 0.5 and words.doc[i - 1] == doc:
                spans[doc][-1] = (spans[doc][-1][0], b)
            else:
                spans[doc].append((a, b))
        return scores, [code_points(t, s) for t, s in zip(texts, spans)]


def code_points(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets as code points."""
    if not spans or text.isascii():
        return spans
    begins = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [(int(begins[a]), int(begins[b])) for a, b in spans]


def token_features(value: np.ndarray, words, hidden: np.ndarray | None = None) -> np.ndarray:
    """Bias, the token's own weight (0 where ``hidden``), whether it has none,
    and the greater and the lesser of its neighbours' weights."""
    n = len(value)
    before, after = np.zeros(n), np.zeros(n)
    if n > 1:
        joined = words.doc[1:] == words.doc[:-1]
        before[1:], after[:-1] = value[:-1] * joined, value[1:] * joined
    own = value if hidden is None else np.where(hidden, 0.0, value)
    return np.stack([np.ones(n), own, (own == 0).astype(float), np.maximum(before, after), np.minimum(before, after)], axis=1)


def expected(p: np.ndarray, words) -> np.ndarray:
    """Expected numbers of toxic tokens of each document."""
    return np.bincount(words.doc, weights=np.where(p >= SOME, p, 0.0), minlength=len(words.counts))


def curve(c: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(c[0] + c[1] * np.log1p(toxic), -50, 50)))


def fit_curve(toxic: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton's method for a weighted logistic curve; the slope never falls below 0."""
    x = np.stack([np.ones(len(toxic)), np.log1p(toxic)], axis=1)
    c = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -50, 50)))
        grad = x.T @ (weight * (label - p)) - 1e-3 * c
        c = c + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
    return np.array([c[0], max(0.0, c[1])])


def _word_weights(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def run(batches):
        for batch in batches:
            texts, toxic = byte_texts(batch.column("text")), np.array(batch.column("toxic").to_pylist(), np.int64)
            for lo, hi in by_bytes(texts):
                words = tokens(texts[lo:hi])
                h = words.word_hashes()
                pad = np.concatenate([[np.uint64(0)], h, [np.uint64(0)]])
                around = pad[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ pad[2:] * np.uint64(0xC2B2AE3D27D4EB4F)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(around.view(np.int64)),
                                                  pa.array(toxic[lo:hi][words.doc])], ["word", "around", "toxic"])

    seen = map_arrow(sample, run, "word long, around long, toxic long").distinct()
    counts = materialize(seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("times")),
                         "word-counts")
    total = counts.agg(F.sum("bad").alias("bad"), F.sum("times").alias("times")).first()
    bad, good = total["bad"] or 0, (total["times"] or 0) - (total["bad"] or 0)
    ratio = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("times") - F.col("bad") + 0.5) / (good + 1))
    share = bad / max(1, bad + good)
    fine = F.col("times") - F.col("bad")
    evidence = 2 * (F.col("bad") * F.log(F.greatest("bad", F.lit(1)) / (F.col("times") * share))
                    + fine * F.log(F.greatest(fine, F.lit(1)) / (F.col("times") * (1 - share))))
    rows = (counts.filter(F.col("times") >= CLEAR_TIMES)
            .select("word", "bad", evidence.alias("evidence"), F.greatest(F.least(ratio, F.lit(6.0)), F.lit(-6.0)).alias("weight"))
            .orderBy(F.desc(F.abs("weight") * F.sqrt("bad")), "word").limit(VOCABULARY).toArrow())
    weight = rows["weight"].to_numpy().astype(float)
    clear = ((weight >= CLEAR_WEIGHT) & (rows["bad"].to_numpy() >= CLEAR_TIMES)
             & (rows["evidence"].to_numpy() >= CLEAR_EVIDENCE))
    return rows["word"].to_numpy().astype(np.int64).view(np.uint64), weight, clear


def _row_sample(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """text, toxic, draw of the chosen ids: about one text for an id, and
    every text once, however many rows share an id or a text."""
    rows = materialize(docs.select("doc_id").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic", "draw")
                       .agg(F.count(F.lit(1)).alias("rows")), "toxicity-ids")          # a row for each chosen id
    return (docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(rows), "doc_id")
            .filter(drawn("toxicity-row") <= 1 / F.col("rows"))
            .groupBy("text", "toxic").agg(F.min("draw").alias("draw")))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS,
        crf_docs: int = CRF_DOCS) -> Model | None:
    """A model from docs (doc_id, text) and labels (doc_id, toxic) whose id
    satisfies ``learn``."""
    marked = (labels.select("doc_id", "toxic").filter(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if set(counts) != {0, 1}:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, sample_docs / counts[1])).otherwise(min(1.0, sample_docs / counts[0]))
    chosen = marked.withColumn("draw", draw).filter(F.col("draw") < share)          # a bounded number of ids
    sample = _row_sample(docs, chosen)
    keys, values, clear = _word_weights(sample)
    if not clear.any():                                        # too few rows to tell words apart
        return None
    scorer = Scorer(Model(keys, values, np.zeros(5), np.zeros(MARKS + 1), np.zeros((2, 2)), np.zeros(2)))
    clear_keys = np.sort(keys[clear])

    def features(batches):
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for lo, hi in by_bytes(texts):
                words = tokens(texts[lo:hi])
                hashes = words.word_hashes() if len(words.start) else np.empty(0, np.uint64)
                sure = np.isin(hashes, clear_keys)
                marks = spelling(words, np.arange(len(hashes))).astype("<u2")
                # One of 16 tokens, told by their word and the one before, hide their own weight.
                before = np.concatenate([np.zeros(1, np.uint64), hashes])[:-1]
                hidden = mix64(hashes ^ (before * np.uint64(0x9E3779B97F4A7C15))) & np.uint64(15) == 0
                cut = np.cumsum(words.counts)[:-1]
                parts = [[v.tobytes() for v in np.split(column, cut)] for column in
                         (scorer.lookup(hashes).astype("<f4"), sure, hidden, marks)]
                yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(lo, hi - lo), *map(pa.array, parts)],
                                                 ["toxic", "value", "clear", "hidden", "marks"])

    # At most about 2 * crf_docs documents reach the driver, as a few numbers for each token.
    size = np.array([counts[0], counts[1]])
    few = F.when(F.col("toxic") == 1, min(1.0, crf_docs / counts[1])).otherwise(min(1.0, crf_docs / counts[0]))
    table = map_arrow(sample.filter(F.col("draw") < few).select("text", "toxic"), features,
                      "toxic long, value binary, clear binary, hidden binary, marks binary").toArrow()
    label = table["toxic"].to_numpy()
    if len(set(label.tolist())) < 2:
        return None
    value, sure, hidden, marks = (np.concatenate([np.frombuffer(v, kind) for v in table[c].to_pylist()]) for c, kind in
                                  (("value", "<f4"), ("clear", bool), ("hidden", bool), ("marks", "<u2")))
    lengths = np.array([len(v) for v in table["clear"].to_pylist()])
    words, value, marks = _Lengths(lengths), value.astype(float), marks.reshape(len(value), -1).astype(np.int64)
    y = (sure & (label[words.doc] == 1)).astype(np.int64)
    if not y.any():
        return None
    shown, whole = token_features(value, words, hidden), token_features(value, words)

    def open_marks(x):
        return np.where((x[:, 1] == 0)[:, None], marks, MARKS)

    weights, spelled, trans = crf.fit(shown, y, lengths, l2=CRF_L2, marks=open_marks(shown), width=MARKS + 1)
    p = crf.marginals(whole @ weights + spelled[open_marks(whole)].sum(axis=1), lengths, trans)
    weight = (size / np.bincount(label, minlength=2))[label]
    c = fit_curve(expected(p, words), label, weight / weight.mean())
    return Model(keys, values, weights, spelled, trans, c)


class _Lengths:
    """What ``token_features`` and ``expected`` need of ``Words``."""

    def __init__(self, lengths: np.ndarray):
        self.counts, self.doc = lengths, np.repeat(np.arange(len(lengths)), lengths)


def score(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with score and spans (start and end in code points)."""
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        scorer = Scorer(model) if model else None
        for batch in batches:
            texts = byte_texts(batch.column("_text"))
            for lo, hi in by_bytes(texts):
                scores, spans = scorer.score(texts[lo:hi]) if scorer else (np.zeros(hi - lo), [[]] * (hi - lo))
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                found = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], spans_type)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), found], [*keep, "score", "spans"])

    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text")), run,
                     fields_and(docs, keep, "score double, spans array<struct<start: long, end: long>>"))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (start:end, comma-joined);
    learns from labels not held out."""
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    found = score(docs.select("doc_id", "text"), fit(docs, labels, ~held_out), ["doc_id"])
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                        listed.alias("spans"))
