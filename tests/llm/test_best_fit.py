"""Best-fit packing with its local search."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tastemap.llm import best_fit
from tastemap.llm.queries import op12_swap_best_fit

from llm_fixtures import MID, SMALL, documents, frame  # noqa: F401

WORDS = P.path("word_bpe_49k.json")


def check(pieces, texts, window=2048, end=0):
    """Every id once, in order, whole documents but for the long ones; gapless
    sequences; returns their number and the least possible one."""
    tok = Tokenizer.from_file(WORDS)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    total = 0
    for doc, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end]
        total += len(ids)
        own = sorted(by_doc.pop(doc), key=lambda p: p["piece"])
        assert [p["piece"] for p in own] == list(range(-(-len(ids) // window)))
        for p in own:
            assert p["start"] == p["piece"] * window and p["length"] == min(window, len(ids) - p["start"])
            assert p["ids"] == np.array(ids[p["start"]:p["start"] + p["length"]], "<u4").tobytes()
    assert not by_doc
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return len(by_seq), -(-total // window)


def packed(sizes, window=2048):
    b = best_fit.Bins(sizes, window)
    b.best_fit()
    before = sum(f > 0 for f in b.fill)
    squares = sum(f * f for f in b.fill)
    made = b.search()
    assert sorted(i for some in b.bins for i in some) == list(range(len(sizes)))
    assert [sum(sizes[i] for i in some) for some in b.bins] == b.fill and max(b.fill, default=0) <= window
    assert sum(f * f for f in b.fill) >= squares + made                     # every exchange adds to it
    return before, sum(f > 0 for f in b.fill), made


def test_search_empties_bins_that_best_fit_leaves():
    rng, sizes = random.Random(3), []
    for _ in range(300):                                                    # three by three, they fill 300 bins
        a = rng.randint(520, 900)
        b = rng.randint(520, max(520, 2048 - a - 520))
        sizes += [a, b, 2048 - a - b]
    before, after, made = packed(sizes)
    assert made and after <= before - 20 and after >= 300


@pytest.mark.parametrize("low,high,n", [(1, 2047, 400), (400, 1100, 500), (1025, 2047, 300), (1, 30, 2000), (2047, 2047, 5), (1, 1, 7)])
def test_search_never_makes_it_worse(low, high, n):
    rng = random.Random(n)
    before, after, _ = packed([rng.randint(low, high) for _ in range(n)])
    assert after <= before


def test_exchanges_of_each_kind():
    def search(bins, window=10):
        sizes = [s for some in bins for s in some]
        b, at = best_fit.Bins(sizes, window), 0
        for some in bins:
            b.bins.append(list(range(at, at + len(some))))
            b.fill.append(sum(some))
            at += len(some)
        return b.search(), sorted(f for f in b.fill if f)

    assert search([[4], [6], [3, 3]]) == (1, [6, 10])                       # a move
    assert search([[5], [3, 5], [7]])[1] == [10, 10]                        # one for one, then a move
    assert search([[2, 2], [3, 6], [7]])[1] == [10, 10]                     # two for one
    assert search([[6], [6]]) == (0, [6, 6])
    assert search([]) == (0, [])


def test_odd_texts(documents):
    texts = dict(enumerate([None, "", " ", "a", "one two three", "<|endoftext|>", "word " * 9000, "x" * 5000, "word " * 2047, "word " * 2048]))
    pieces = best_fit.pack(documents(list(texts.items())).coalesce(1), WORDS, task_docs=None).toArrow().to_pylist()
    sequences, least = check(pieces, texts)
    assert sequences == least
    assert best_fit.pack(documents([]), WORDS).count() == 0
    again = best_fit.pack(documents([(None, "a b"), (7, "same"), (7, "same")]), WORDS).toArrow().to_pylist()
    assert sorted((p["doc_id"] is None, p["length"]) for p in again) == [(False, 2), (False, 2), (True, 3)]


def test_given_table_nears_the_bound(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    sequences, least = check(best_fit.pack(docs.coalesce(1), WORDS, task_docs=None).toArrow().to_pylist(), texts)
    assert sequences <= least + 2
    sequences, _ = check(best_fit.pack(docs.coalesce(1), WORDS, pool_ids=100_000, task_docs=None).toArrow().to_pylist(), texts)   # many pools
    assert sequences <= 1.02 * least + 2


def test_query_columns(spark):
    rows = op12_swap_best_fit(spark, SMALL).collect()
    assert rows[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    tok = Tokenizer.from_file(WORDS)
    for r in rows:
        ids = tok.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids + [0]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
