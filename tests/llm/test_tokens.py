"""Byte-level BPE and packing against the libraries."""

import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tastemap.llm import byte_bpe, packing
from tastemap.llm.lexicon import HashTable, Ranges, Runs, Words

from llm_fixtures import SMALL, documents, frame  # noqa: F401

BYTES, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n", "a", "  lead", "trail  ", "tab\tand\r\nnew", "it's we'll 'tis 're", "x" * 5000, "no\xa0break  here",
       "\x1c\x1fodd", "😀 é é 你好 12345", "a,b;c  d e", "<|endoftext|>"]


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_equal_the_library(tik):
    bpe = byte_bpe.load(BYTES, P.PATTERN)
    random.seed(5)
    pool = list("ab cd'sll\n\t\xa0é你😀12٣tre.,!?\x1c\x85​İß") + ["'re", "  ", "the ", "\r\n", "aaaa"]
    texts = ["".join(random.choices(pool, k=random.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 1500 + "the" * 900, "é" * 2000, "".join(random.choices("abcdefgh", k=3000))]
    for text, ids in zip(texts, bpe.encode_texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_encode_table(documents, tik):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the end"), (3, ODD[3])]
    got = byte_bpe.encode(documents(rows), BYTES, P.PATTERN, decoded=True).toArrow().to_pylist()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded"]) for r in got) == sorted(
        (i is None, i or 0, (t or "").encode()) for i, t in rows)
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == tik.encode_ordinary(r["decoded"].decode())


def test_encode_empty_table(documents):
    assert byte_bpe.encode(documents([]), BYTES, P.PATTERN).count() == 0


def test_decode_column(documents):
    from pyspark.sql import functions as F
    ids = byte_bpe.encode(documents([(1, "some text"), (2, None)]), BYTES, P.PATTERN)
    got = ids.select("doc_id", byte_bpe.decode(F.col("ids"), BYTES, P.PATTERN).alias("b")).toArrow().to_pylist()
    assert {r["doc_id"]: r["b"] for r in got} == {1: b"some text", 2: b""}


def check_packing(pieces, texts, window=2048):
    tok = Tokenizer.from_file(WORDS)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    for doc, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(by_doc.pop(doc), key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert zlib.crc32(p["ids"]) == zlib.crc32(np.array(ids[at:at + p["length"]], "<u4").tobytes())
            at += p["length"]
        assert at == len(ids)
    assert not by_doc
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or (at < window and at & (at - 1) == 0)       # no padding at all


def test_packing_odd_texts(documents):
    texts = dict(enumerate(ODD)) | {99: "word " * 9000}
    pieces = packing.pack_documents(documents(list(texts.items())).coalesce(1), WORDS).toArrow().to_pylist()
    check_packing(pieces, texts)
    assert packing.pack_documents(documents([]), WORDS).count() == 0


MARKED = ["first part<|endoftext|>second part", "first part second part", "< |endoftext| >", "a<|endoftext|>b",
          "x<|startoftext|>, y", "don't<|endoftext|>stop"]


def test_ids_equal_an_untouched_tokenizer():
    plain, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    random.seed(6)
    pool = list("ab cd'sll\n\t\xa0é你😀12٣tre.,!?\x1c\x85İßÀ×÷ÿ̀-") + ["'re", "the ", "\r\n", "aaaa", "<|endoftext|>", "it's "]
    texts = [t or "" for t in ODD] + MARKED + ["é" * 3000, "x" * 70 + " y"]
    texts += ["".join(random.choices(pool, k=random.randint(0, 60))) for _ in range(3000)]
    for _ in range(2):                                       # from the library, then from the memo
        for text, ids in zip(texts, own.encode_texts(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_markers_may_be_text():
    plain, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS, markers_are_text=True)
    plain.encode_special_tokens = True
    for text, ids in zip(MARKED, own.encode_texts(MARKED)):
        got = np.frombuffer(ids, "<u4").tolist()
        assert 49407 not in got and got == plain.encode(text, add_special_tokens=False).ids


def test_memo_tells_strings_of_equal_hash_apart(monkeypatch):
    monkeypatch.setattr(Ranges, "hashes", lambda self, start, end: (end - start + 1).astype(np.uint64))   # by length alone
    plain, own = Tokenizer.from_file(WORDS), packing.WordTokenizer(WORDS)
    texts = ["one two six ten", "two, one six.", "ten ten cat", ""]
    for _ in range(2):
        for text, ids in zip(texts, own.encode_texts(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_memo_forgets_the_rare_and_keeps_the_frequent():
    runs, made = Runs(400), []
    for n in range(40):
        words = Words([b" ".join([b"often"] + [b"w%d" % (n * 100 + i) for i in range(100)])])

        def make(at):
            made.extend(words.bytes_of(i) for i in at)
            return [np.array([len(words.bytes_of(i)), n], "<u4").tobytes() for i in at]

        values, sizes = runs.lookup(words, words.start, words.end, make)
        assert sizes.tolist() == [2] * 101 and values[::2].tolist() == (words.end - words.start).tolist()
    assert made.count(b"often") == 1 and len(made) == 4001
    assert runs.old.table.size + runs.new.table.size <= 700


def test_packing_null_id_and_repeats(documents):
    pieces = packing.pack_documents(documents([(None, "a b"), (7, "same"), (7, "same")]), WORDS).toArrow().to_pylist()
    assert sorted((p["doc_id"] is None, p["doc_tokens"]) for p in pieces if p["start"] == 0) == [(False, 2), (False, 2), (True, 3)]


def test_packing_given_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    check_packing(packing.pack_documents(docs, WORDS).toArrow().to_pylist(), texts)


def test_level_minimises_the_sum_of_squares():
    random.seed(1)
    p = packing.Packer(64)
    for i in range(3000):
        size = random.randint(1, 63)
        before = p.count.copy()
        assert before[1:64].tolist() == [len(x) for x in p.open[1:]]

        def total(h):
            n = before.copy()
            n[h] -= h > 0
            n[h + size] += h + size < 64
            return int((n[1:64] ** 2).sum())

        options = [h for h in range(0, 64 - size + 1) if h == 0 or before[h]]
        assert total(p.level_for(size)) == min(map(total, options))
        p.add(((i, size), 0, b"\0" * 4 * size))


def test_word_ranges_and_hash_table():
    texts = [b"", b" a  bb\tc ", b"\n", b"bb a", "é\xa0x".encode()]
    words = Words(texts)
    got = [[words.bytes_of(i) for i in np.flatnonzero(words.doc == d)] for d in range(len(texts))]
    assert got == [t.split() for t in texts]
    h = dict(zip((words.bytes_of(i) for i in range(len(words.start))), words.word_hashes().tolist()))
    assert len(set(h.values())) == len(h)
    assert words.word_hashes()[1] == words.word_hashes()[3]                 # bb, wherever it stands
    table, keys = HashTable(4), np.random.default_rng(0).integers(1, 2**63, 5000, dtype=np.uint64)
    keys = np.unique(keys)
    for part in np.array_split(keys, 7):
        assert (table.find(part) < 0).all()
        table.add(part)
    assert np.array_equal(table.find(keys), np.arange(len(keys)))
    long = np.frombuffer(b"ab" * 600, np.uint8)
    assert Ranges(long).hashes(np.array([0, 2]), np.array([1000, 1002])).tolist()[0] == \
        Ranges(long).hashes(np.array([2]), np.array([1002])).tolist()[0]
