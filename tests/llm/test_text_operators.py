"""Jaccard join, PII, language ID, toxicity, licences, URL lists, components."""

import datetime as dt
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastemap.llm import components, crf, jaccard_join, langid, licenses, pii, queries, toxicity, url_lists

from llm_fixtures import MID, documents, frame  # noqa: F401


# --- n-gram Jaccard join ------------------------------------------------------

def brute_components(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else
                    frozenset([tuple(w)] if w else []))
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and den * common >= num * (len(a) + len(sets[j]) - common) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        low[group[i]].append(doc)
    ids = {g: min((d for d in docs if d is not None), default=None) for g, docs in low.items()}
    return sorted(((d, len(s), ids[group[i]] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def joined(documents, rows, rule):
    got = jaccard_join.join_components(documents(rows), rule).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


def near_copies(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = [(1000 - i, " ".join(rng.choices(words, k=rng.randint(1, 120)))) for i in range(n // 3)]
    while len(rows) < n:                       # chains of copies, each a little different from another
        w = rng.choice(rows)[1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w))
            w[at:at + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 2))
        rows.append((rng.randint(2000, 10**6), " ".join(w)))
    return rows


@pytest.mark.parametrize("seed, rule", [(1, (3, 90, 100)), (2, (5, 80, 100))])
def test_join_equals_brute_force(documents, monkeypatch, seed, rule):
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 7)               # many blocks to a tile
    rows = near_copies(seed)
    assert joined(documents, rows, jaccard_join.Rule(*rule)) == brute_components(rows, *rule)


def test_join_odd_rows(documents):
    rows = [(5, None), (6, ""), (7, " \n\t"), (8, "one"), (9, "ONE"), (10, "one two"), (11, "One  two"), (12, "É x y"),
            (13, "é x y"), (9, "ONE"), (None, "one two"), (None, "lonely words stand here"), (14, "a a a a a a"),
            (15, "a a a"), (16, "word " * 30000)]
    assert joined(documents, rows, jaccard_join.Rule()) == brute_components(rows, 3, 90, 100)
    assert joined(documents, [], jaccard_join.Rule()) == []


def test_join_common_passage_and_large_group(documents):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(rng.choices([f"x{j}" for j in range(5000)], k=40)) + " " + passage) for i in range(80)]
    text = [f"y{j}" for j in range(100)]
    for i in range(80):                        # one group of copies that each differ by a word
        w = list(text)
        w[rng.randrange(100)] = f"z{i}"
        rows.append((500 + i, " ".join(w)))
    assert joined(documents, rows, jaccard_join.Rule()) == brute_components(rows, 3, 90, 100)


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(3)
    for n in (1, 5, 64, 65, 400, 900):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) * 3 // 4], rng.integers(0, 2**63, 1 + n // 3, dtype=np.uint64)]))
        gap = jaccard_join.gaps([jaccard_join.bitmap(a), jaccard_join.bitmap(b)], np.array([0]), np.array([1]))[0]
        assert (len(a) + len(b) - gap) / 2 >= len(np.intersect1d(a, b))


def test_components_of_a_path_and_a_star(spark, frame):
    links = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201)]
    df = frame(a=(pa.int64(), [a for a, _ in links]), b=(pa.int64(), [b for _, b in links]))
    got = {r["node"]: r["comp"] for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


# --- personal data ------------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == 0 or kind == 1 and all(int(x) <= 255 for x in m.group().split(".")) or
                    kind == 2 and 12 <= len(d) <= 19 and luhn(d) or kind == 3 and 9 <= len(d) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    parts = ["a", "b.", "@", "1", "25", "0", ".", "-", " ", "+", "(", ")", "é", "@x.y", "4111 1111 1111 111", "300", "٣"]
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        assert pii.base_spans(text) == brute_spans(text), text
    for text in ("a" * 200000, "1" * 200000, "1." * 100000, "a@" * 100000, "a@b." * 50000):
        pii.base_spans(text)                    # linear, else this would never end


def test_pii_report(documents, spark):
    known = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{MID}/documents.parquet").collect()]
    rows = known + [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "call +1 (407) 555-7710 or, again, 555-7710 today"),
                    (10**6 + 3, "nothing 555-7710 here 555-7710"), (10**6 + 2, "call +1 (407) 555-7710 or, again, 555-7710 today")]
    got = [r.asDict() for r in pii.report(documents(rows)).collect()]
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = brute_spans(texts[r["doc_id"]] or "")
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want]
        assert [r[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for _, k, _ in want) for i in range(4)]
        import hashlib
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(filter(None, r["spans"].split(",")))
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert spans[10**6 + 2] == "phone:5:22,phone:34:42"                  # the second mention agrees with the first
    assert spans[10**6 + 3] == spans[10**6] == spans[10**6 + 1] == ""
    assert pii.report(documents([])).count() == 0


def test_pii_spellings_of_a_spaced_number(documents, spark):
    known = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{MID}/documents.parquet").collect()]
    told = ["call +1 (407) 555-7710 or, again, 407-555-7710 today", "call 407-555-7710 or, again, +1 (407) 555-7710 today",
            "call +1 407 555 7710 or (555-7710), again 407-555-7710 today", "call +1 (407) 555-7710 not 407-555-7711 today"]
    want = ["phone:5:22,phone:34:46", "phone:5:17,phone:29:46", "phone:5:20,phone:25:33,phone:42:54", "phone:5:22"]
    rows = known + [(10**6 + i, t) for i, t in enumerate(told)]
    got = {r["doc_id"]: ",".join(sorted(r["spans"].split(","), key=lambda x: int(x.split(":")[1])))
           for r in pii.report(documents(rows)).filter(F.col("doc_id") >= 10**6).collect()}
    assert [got[10**6 + i] for i in range(len(told))] == want


def test_mentions_that_agree():
    edges, agrees = pii._mentions(["14075557710", "4075557710", "a@b", "5557710", "", "9995557710", "a@b", "1000123", "00123", "1000123"],
                                  [4, 0, 1, 0, 0, 0, 0, 2, 0, 0])
    # 9995557710 ends in a mention of the base span's, not in the span's own digits; an IP address has no short form.
    assert agrees == [True, True, True, True, False, False, True, True, False, True]
    assert sorted(edges) == [(0, 1), (1, 3), (2, 6), (3, 5), (7, 9), (8, 9)]
    assert pii._endings({"12345", "912345", "8912345", "712345", "54321"}) == {
        "12345": "", "912345": "12345", "8912345": "912345", "712345": "12345", "54321": ""}


def test_pii_fit_counts_every_token_however_rows_are_dealt_out(documents):
    # 1,200 plain numbers and 60 short phones that no base span holds, beside 60 addresses.
    rows = [(i, "about 12 of 34 and 56 or 78 " * 5 + f"call 555-77{i:02} or a{i}@b.org") for i in range(60)]
    one, many = (pii.fit(documents(rows).repartition(n, "doc_id")) for n in (1, 8))
    assert all(np.array_equal(a, b) for a, b in zip(one, many))
    x = np.array([pii._shape(t) for t in ("12", "555-7710", "a1@b.org")], float)
    y, times = np.array([0, 0, 1]), np.array([1200, 60, 60])
    repeated = np.repeat(np.arange(3), times)
    none = np.zeros((0, 2), np.int64)
    nodes = np.array([1260, 60, 0, 0, 0])
    whole = pii.fit_potentials(x[repeated], y[repeated], np.ones(len(repeated)), nodes, none, none)
    assert np.allclose(pii.fit_potentials(x, y, times, nodes, none, none).weights, whole.weights)
    assert np.allclose(one.weights, whole.weights)


def test_pii_of_a_slice_without_tokens(documents, spark):
    # More texts in a row without a digit or an @ than a task handles at once, beside some with spans.
    rows = [(i, f"write to a{i}@b.org or 10.0.0.{i % 200}, a{i}@b.com") for i in range(40)]
    rows += [(100 + i, "plain words only") for i in range(3 * pii.BATCH_DOCS)]
    got = {r["doc_id"]: r for r in pii.report(documents(rows).coalesce(1)).collect()}
    assert len(got) == len(rows)
    assert got[3]["n_email"] == 2 and got[3]["n_ip"] == 1 and got[100]["spans"] == ""


def test_redaction():
    assert pii.redact("a 1.2.3.4 b", [(2, "ip", 9)]) == "a [IP] b"
    assert pii.redact("x12345y", [(1, "card", 4), (3, "phone", 6)]) == "x[CARD]y"


def test_loopy_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(0)
    unary, edges = rng.normal(size=(4, 3)), np.array([[0, 1], [1, 2], [1, 3]])
    pot = rng.normal(size=(3, 3, 3))
    p = np.zeros((4, 3))
    for y in np.ndindex(3, 3, 3, 3):
        w = np.exp(sum(unary[i, y[i]] for i in range(4)) + sum(pot[e, y[a], y[b]] for e, (a, b) in enumerate(edges)))
        for i in range(4):
            p[i, y[i]] += w
    assert np.allclose(pii._messages(unary, edges, pot, 60), p / p.sum(axis=1, keepdims=True), atol=1e-6)


# --- language and toxicity ----------------------------------------------------

def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out")
    assert held.count() > 100 and got.count() == docs.count()
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.filter("score < 0 or score > 1").count() == 0


def test_language_odd_rows(documents):
    n = 60
    rows = [(i, ["the cat and the dog were here", "le chat et le chien sont ici", "der Hund und die Katze"][i % 3]) for i in range(n)]
    rows += [(900, None), (901, ""), (902, "123 !?"), (None, "the dog and the cat"), (903, "und der Hund " * 20000)]
    langs = [["en", "fr", "de"][i % 3] for i in range(n)] + [None, "en", "en", None, None]
    got = [r.asDict() for r in langid.identify(documents(rows, lang=(pa.string(), langs))).collect()]
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert len(got) == len(rows) and by[None] == "en" and by[903] == "de"
    assert by[900] == by[901] == by[902] == langid.UNKNOWN
    assert langid.identify(documents([])).count() == 0
    nothing = langid.identify(documents([(1, "text")], lang=(pa.string(), [None]))).first()
    assert nothing["lang_pred"] == langid.UNKNOWN and nothing["score"] == 0


def test_language_of_signs_that_are_no_letters(documents):
    rows = [(i, ["the cat and the dog were here", "le chat et le chien sont ici"][i % 2] + f" x{'abcdefgh'[i % 8] * (1 + i // 8)}") for i in range(60)]
    odd = [(900, "\u00bd \u2460 \u00b2"), (901, "\u2167"), (902, "_ 12 \u0663"), (903, "\u2460 cat")]
    got = langid.identify(documents(rows + odd, lang=(pa.string(), [["en", "fr"][i % 2] for i in range(60)] + ["en"] * 4)))
    by = {r["doc_id"]: r["lang_pred"] for r in got.filter("doc_id >= 900").collect()}
    assert by[900] == by[901] == by[902] == langid.UNKNOWN and by[903] != langid.UNKNOWN


@pytest.mark.parametrize("same", [None, 7, 9])
def test_samples_do_not_depend_on_ids(documents, spark, same):
    known = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{MID}/documents.parquet").limit(300).collect()]
    lang = (pa.string(), [r[2] for r in known])
    own, one = documents([(i, t) for i, t, _ in known], lang=lang), documents([(same, t) for _, t, _ in known], lang=lang)
    a, b = (langid.fit(d, F.lit(True)) for d in (own, one))
    assert np.array_equal(a.rows, b.rows) and np.array_equal(a.bias, b.bias)
    a, b = (pii.fit(d) for d in (own, one))
    assert all(np.array_equal(x, y) for x, y in zip(a, b))


def test_samples_count_a_repeated_text_once(documents):
    rows = [(i, f"call me on 12.{i}.3.4 or at a{i}@b.org") for i in range(50)]
    one, many = pii.fit(documents(rows)), pii.fit(documents(rows + rows[:1] * 400))
    assert all(np.array_equal(x, y) for x, y in zip(one, many))


def test_marginals_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 1, 5, 64, 65, 0, 200])
    score, trans = rng.normal(size=lengths.sum()) * 2, rng.normal(size=(2, 2))
    want, at = [], 0
    for n in lengths:
        e = np.stack([np.zeros(n), score[at:at + n]], axis=1)
        at += n
        a, b = np.zeros((n, 2)), np.zeros((n, 2))
        for t in range(n):
            a[t] = e[t] + (np.logaddexp(a[t - 1][0] + trans[0], a[t - 1][1] + trans[1]) if t else 0)
        for t in range(n - 2, -1, -1):
            z = e[t + 1] + b[t + 1]
            b[t] = np.logaddexp(trans[:, 0] + z[0], trans[:, 1] + z[1])
        if n:
            want += np.exp((a + b)[:, 1] - np.logaddexp(*a[-1])).tolist()
    assert np.allclose(crf.marginals(score, lengths, trans), want)


def test_toxicity_on_held_out_labels(spark):
    root = MID.replace("sf0.01", "sf0.1")
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    got = toxicity.rate(docs, labels)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").filter("held_out").toPandas()
    bad, good = held[held.toxic == 1], held[held.toxic == 0]
    assert (bad.predicted == 1).mean() >= 0.7 and (good.predicted == 0).mean() >= 0.98


def test_toxicity_odd_rows(documents, frame):
    rng = random.Random(2)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ab", "ec", "ig", "on")]
    rows = []
    for i in range(300):
        w = rng.choices(words, k=40)
        if i % 3 == 0:
            for at in rng.sample(range(40), 3):
                w[at] = "vile"
        rows.append((i, " ".join(w)))
    labels = frame(doc_id=(pa.int64(), list(range(300)) + [None, 5, 7]), toxic=(pa.int32(), [int(i % 3 == 0) for i in range(300)] + [1, None, 0]))
    odd = [(1000, None), (1001, ""), (1002, "Vile vile " + " ".join(words)), (1003, " ".join(words)), (None, "so VILE, vile; vile!"),
           (1004, "bab " * 30000 + "vile vile vile")]
    got = [r.asDict() for r in toxicity.rate(documents(rows + odd), labels).collect()]
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert len(got) == 306 and by[1002] == by[None] == by[1004] == 1 and by[1000] == by[1001] == by[1003] == 0
    assert all(by[i] == (i % 3 == 0) for i in range(300))
    model = toxicity.fit(documents(rows), labels, F.lit(True))
    spans = toxicity.score(documents([(1, "é bab, VILE bon")]), model, ["doc_id"]).first()["spans"]
    assert [(s["start"], s["end"]) for s in spans] == [(7, 11)]           # code points
    assert toxicity.rate(documents([]), labels).count() == 0
    none = labels.filter("toxic = 0")
    assert toxicity.rate(documents(rows), none).filter("score <> 0").count() == 0


def toxic_rows(forms, n=400, seed=3):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in ("ab", "ec", "ig", "on") for c in ("", "ra", "lo")]
    rows = []
    for i in range(n):
        w = rng.choices(words, k=30)
        if i % 3 == 0:
            for at in rng.sample(range(30), 3):
                w[at] = rng.choice(forms)
        rows.append((i, " ".join(w)))
    return rows, words


def test_toxic_tokens_without_an_entry_of_their_own(documents, frame):
    rows, words = toxic_rows([f"vile{end}" for end in ("", "st", "ness", "t", "r", "ry", "dom", "ish", "less", "ful", "ing", "d")])
    labels = frame(doc_id=(pa.int64(), list(range(400))), toxic=(pa.int32(), [int(i % 3 == 0) for i in range(400)]))
    model = toxicity.fit(documents(rows), labels, F.lit(True))
    new = toxicity.tokens([b"vilely"]).word_hashes()
    assert toxicity.HashTable().find(new)[0] < 0 and new[0] not in model.keys                # never met in learning
    got = toxicity.score(documents([(1, f"{words[0]} vilely {words[1]}"), (2, f"{words[0]} zurano {words[1]}")]), model, ["doc_id"])
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in got.collect()}
    at = len(words[0]) + 1
    assert spans == {1: [(at, at + 6)], 2: []}                             # by its spelling; another new word is none


def test_toxicity_learns_about_one_text_for_an_id(documents, frame):
    rows, _ = toxic_rows(["vile", "vilest"])
    labels = frame(doc_id=(pa.int64(), list(range(400))), toxic=(pa.int32(), [int(i % 3 == 0) for i in range(400)]))
    hot = [(1, f"other text number {i}") for i in range(3000)] + [(3, rows[3][1])] * 500
    chosen = labels.withColumn("draw", F.lit(0.0))
    assert toxicity._row_sample(documents(rows + hot), chosen).count() <= 400 + 5
    got = {r["doc_id"]: r["predicted"] for r in toxicity.rate(documents(rows), labels).collect()}
    assert sum(got[i] == (i % 3 == 0) for i in range(400)) >= 396
    with_hot = toxicity.rate(documents(rows + hot), labels)
    assert with_hot.count() == len(rows) + len(hot)
    assert with_hot.filter("doc_id = 1 and predicted = 1").count() == 0


def test_marginals_do_not_depend_on_the_batch(documents, frame):
    rows, _ = toxic_rows(["vile", "vilest"], 200)
    labels = frame(doc_id=(pa.int64(), list(range(200))), toxic=(pa.int32(), [int(i % 3 == 0) for i in range(200)]))
    scorer = toxicity.Scorer(toxicity.fit(documents(rows), labels, F.lit(True)))
    texts = [t.encode() for _, t in rows[:40]] + [b"", "é vile né".encode()]
    whole, spans = scorer.score(texts)
    for i, t in enumerate(texts):
        own, one = scorer.score([t])
        assert abs(own[0] - whole[i]) < 1e-9 and one[0] == spans[i]
    assert spans[-1] == [(2, 6)] and spans[-2] == []


# --- licences and URL lists ---------------------------------------------------

@pytest.mark.parametrize("name", ["op1_threshold_topk", "op4_temporal_url_filter", "op6_licence_sentences"])
def test_oracles(spark, name):
    got = queries.QUERIES[name](spark, MID).toArrow()
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{MID}/{table}.parquet'")
    con.execute(f"CREATE VIEW want AS {queries.ORACLE_SQL[name]}")
    columns = ", ".join(got.schema.names)
    want = con.execute(f"SELECT {columns} FROM want").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r.values())) for r in got.to_pylist())


def test_licence_rules(documents):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software. "
           "The above copyright notice and this permission notice shall be included in all copies!\n"
           "The software is provided as-is, without warranty of any kind.")
    rows = [(1, mit), (2, mit + "\nReleased under the MIT license."), (3, "x\nLicensed under CC BY 4.0. Licensed under CC BY-NC 4.0."),
            (4, None), (5, ""), (6, "no licence at all"), (None, "Released under the MIT License."), (1, mit)]
    got = sorted(((r["doc_id"], r["n_sentences"], r["licenses"]) for r in licenses.scan(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 3, "MIT"), (1, 3, "MIT"), (2, 4, "MIT"), (3, 2, "CC-BY-NC-4.0,CC-BY-4.0"), (4, 0, ""),
                          (5, 0, ""), (6, 0, ""), (None, 1, "MIT")], key=str)
    assert licenses.scan(documents([])).count() == 0


MIT = """MIT License

Copyright (c) 2021 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
APACHE = """Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
BSD2 = """Copyright (c) 2020, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED."""
GPL = """This file is part of Foo.

Foo is free software: you can redistribute it and/or modify it under the
terms of the GNU General Public License as published by the Free Software
Foundation, either version 3 of the License, or (at your option) any later
version.

Foo is distributed in the hope that it will be useful, but WITHOUT ANY
WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR
A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
NOTICES = ((MIT, 3, "MIT"), (APACHE, 3, "Apache-2.0"), (BSD2 + BSD_END, 2, "BSD-2-Clause"), (BSD3 + BSD_END, 3, "BSD-3-Clause"),
           (GPL, 2, "GPL-3.0"), (GPL.replace("either version 3", "either version 2"), 2, "GPL-2.0"))


@pytest.mark.parametrize("dress", [
    lambda t: t, lambda t: " ".join(t.split()), lambda t: t.replace("\n", "\r\n"), lambda t: t.replace("\n", "\r"),
    lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */\nint x;", lambda t: "".join(f"# {x}\n" for x in t.split("\n")),
    lambda t: "".join(f"// {x}\n" for x in t.split("\n")) + "x", lambda t: "REM " + t.replace("\n", "\nREM "),
    lambda t: "".join(f"| {x} |\n" for x in t.split("\n"))])
def test_unabridged_licence_notices(documents, dress):
    rows = [(i, dress(text)) for i, (text, _, _) in enumerate(NOTICES)]
    got = {r["doc_id"]: (r["n_sentences"], r["licenses"]) for r in licenses.scan(documents(rows)).collect()}
    assert got == {i: (n, name) for i, (_, n, name) in enumerate(NOTICES)}


def test_licence_references_within_sentences(documents):
    told = {"This tool, like its docs, is released under the MIT license, see LICENSE.": "MIT",
            "The code is licensed under the\nApache License, Version 2.0 by its authors.": "Apache-2.0",
            "It is distributed under the terms of the GNU General Public License v3.0 or later.": "GPL-3.0",
            "Text released under CC-BY\n4.0, pictures not.": "CC-BY-4.0", "Released under CC BY-NC 4.0 only.": "CC-BY-NC-4.0",
            "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
            "It is licensed under CC BY-NC-SA 4.0.": "", "Prereleased under the MIT licenses of old.": "",
            "Licensed under CC.\nBy 4.0 o'clock.": "", "Licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
            # Begins like the MIT notice, but is another one.
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its data, to look at it.": ""}
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents(list(enumerate(told)))).collect()}
    assert got == dict(enumerate(told.values()))
    assert all(any(c in s for c in licenses.CUES) or re.search(licenses.CC_BY, s) for s in licenses.KNOWN)


MORE_LICENCES = [
    ("# SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */", "MIT OR Apache-2.0"), ("SPDX-License-Identifier: LGPL-3.0-only", "LGPL-3.0"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\n"
     "License as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\n"
     "This library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.", "LGPL-2.1"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or later.", "AGPL-3.0"),
    ("// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0. If a copy of the MPL was not distributed "
     "with this\n// file, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
     "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "ISC"),
    ("This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, "
     "sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or "
     "non-commercial, and by any\nmeans.", "Unlicense"),
    ("This work is licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
    ("Distributed under the Boost Software License, Version 1.0. (See accompanying file.)", "BSL-1.0"),
    ("Dual-licensed under the MIT or Apache-2.0 license.", "MIT OR Apache-2.0"), ("licensed under the MIT or Apache-2.0 license", "MIT OR Apache-2.0"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable.\n\n"
     "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
     "redistribute it freely, subject to the following restrictions:", "Zlib"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "EPL-2.0"),
    ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "CC0-1.0"),
    ("Released under the MIT license. Parts are licensed under the Mozilla Public License 2.0.", "MIT,MPL-2.0"),
    ("the isc of the mit and a boost of zlib, spdx or not", ""), ("SPDX-License-Identifier: Nothing-1.0", ""),
]


def test_more_licences(documents):
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(documents([(i, t) for i, (t, _) in enumerate(MORE_LICENCES)])).collect()}
    wrong = [(text, want, got[i]) for i, (text, want) in enumerate(MORE_LICENCES) if got[i] != want]
    assert not wrong


def test_url_lists(frame):
    d = dt.date
    entries = frame(key=(pa.string(), ["Bad.example", "bad.example", "bad.example", "a.bad.example", None, "late.example", "twice.example", "twice.example"]),
                    action=(pa.string(), ["add", "remove", "add", "add", "add", "add", "remove", "add"]),
                    at=(pa.date32(), [d(2024, 1, 10), d(2024, 2, 10), d(2024, 5, 1), d(2024, 1, 20), d(2024, 1, 1), d(2030, 1, 1),
                                      d(2024, 1, 5), d(2024, 1, 5)]))
    rows = [(1, "http://bad.example/x", d(2024, 1, 9), None), (2, "http://bad.example/x", d(2024, 1, 10), "bad.example"),
            (3, "https://u:p@A.Bad.example:80/", d(2024, 2, 9), "a.bad.example"), (4, "http://b.bad.example", d(2024, 2, 9), "bad.example"),
            (5, "http://bad.example", d(2024, 2, 10), None), (6, "http://bad.example.", d(2024, 12, 31), "bad.example"),
            (7, "http://notbad.example", d(2024, 6, 1), None), (8, None, d(2024, 6, 1), None), (9, "no url", d(2024, 6, 1), None),
            (10, "http://bad.example", None, None), (11, "http://late.example", d(2024, 6, 1), None),
            (12, "http://twice.example", d(2024, 1, 5), "twice.example"), (2, "http://bad.example/x", d(2024, 1, 10), "bad.example")]
    captures = frame(page_id=(pa.int64(), [r[0] for r in rows]), url=(pa.string(), [r[1] for r in rows]),
                     fetched_at=(pa.date32(), [r[2] for r in rows]), key=(pa.string(), ["k"] * len(rows)),
                     month=(pa.string(), ["m"] * len(rows)), host=(pa.string(), ["h"] * len(rows)))
    out = url_lists.filter_captures(captures, entries)
    assert out.columns == captures.columns + ["blocked", "blocked_by"]
    got = sorted((r["page_id"], r["blocked"], r["blocked_by"] or "") for r in out.collect())
    assert got == sorted((r[0], r[3] is not None, r[3] or "") for r in rows)
    assert url_lists.filter_captures(captures.limit(0), entries).count() == 0
    assert url_lists.filter_captures(captures, entries.limit(0)).filter("blocked").count() == 0


def test_url_lists_keep_the_time_of_day(frame):
    def at(*x):
        return dt.datetime(*x)

    entries = frame(key=(pa.string(), ["evil.example"] * 4 + ["month.example"]), action=(pa.string(), ["add", "remove", "add", "remove", "add"]),
                    at=(pa.timestamp("us"), [at(2024, 3, 1, 10), at(2024, 3, 1, 18), at(2024, 4, 1), at(2024, 4, 1, 0, 0, 1), at(2024, 1, 31, 23, 59)]))
    rows = [(1, "evil", at(2024, 3, 1, 8), False), (2, "evil", at(2024, 3, 1, 12), True), (3, "evil", at(2024, 3, 1, 20), False),
            (4, "evil", at(2024, 3, 1, 10), True), (5, "evil", at(2024, 3, 1, 18), False), (6, "evil", at(2024, 3, 31, 23, 59, 59), False),
            (7, "evil", at(2024, 4, 1), True), (8, "evil", at(2024, 4, 1, 0, 0, 1), False), (9, "month", at(2024, 1, 31, 23, 58), False),
            (10, "month", at(2024, 2, 1), True), (11, "month", at(2025, 2, 1), True)]
    captures = frame(page_id=(pa.int64(), [r[0] for r in rows]), url=(pa.string(), [f"http://{r[1]}.example/" for r in rows]),
                     fetched_at=(pa.timestamp("us"), [r[2] for r in rows]))
    got = {r["page_id"]: r["blocked"] for r in url_lists.filter_captures(captures, entries).collect()}
    assert got == {r[0]: r[3] for r in rows}


HOSTS = {
    "http://a@b@evil.example/": "evil.example", "http:\\\\evil.example\\x": "evil.example",
    "http://evil.example\\@good.example/": "evil.example", "//evil.example/x": "evil.example", "https://u:p@Evil.Example:80": "evil.example",
    " http://evil.example": "evil.example", "http:///evil.example": "evil.example", "http://good.example/@evil.example": "good.example",
    "http://good.example?@evil.example": "good.example", "http://good.example#@evil.example": "good.example",
    "http://[::1]:80/": "[::1]", "http://evil.example.": "evil.example", "evil.example": None, "mailto:a@evil.example": None, "": None, "http://": None,
}


def test_hosts_as_browsers_read_them(frame):
    table = frame(url=(pa.string(), list(HOSTS)))
    got = {r["url"]: r["host"] for r in table.select("url", url_lists.host_of(F.col("url")).alias("host")).collect()}
    assert got == HOSTS
