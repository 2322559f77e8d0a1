"""The corpus pipeline against brute-force versions of its stages."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tastemap.llm import pii

from llm_fixtures import MID, documents, frame  # noqa: F401
from test_text_operators import brute_components, brute_spans
from test_tokens import check_packing


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input, output) of every stage over sf0.01."""
    out, docs = {}, spark.read.parquet(f"{MID}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, MID).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_duplicates", "personal_data", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name][0].columns == stages[name][1].columns
        assert [f.dataType for f in stages[name][0].schema] == [f.dataType for f in stages[name][1].schema]


def test_language_stage_drops_texts_without_letters_only(stages):
    before, after = map(texts, stages["language_id"])
    assert set(before) - set(after) == {i for i, t in before.items() if not any(c.isalpha() for c in t or "")}


def test_toxicity_stage(spark, stages):
    before, after = map(texts, stages["toxicity"])
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MID}/labels.parquet").collect()}
    clean = [i for i in before if labels.get(i) == 0]
    assert len([i for i in clean if i in after]) >= 0.97 * len(clean)
    bad = [i for i in before if labels.get(i) == 1]
    assert len([i for i in bad if i not in after]) >= 0.5 * len(bad)


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after = map(texts, stages["near_duplicates"])
    want = {c for _, _, c in brute_components(list(before.items()), 5, 80, 100)}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_near_duplicate_stage_tells_rows_not_ids(spark, documents):
    def words(stem, n=60):
        return " ".join(f"{stem}{i}" for i in range(n))

    rows = [(1, words("a")), (2, words("a")), (2, words("b")),                  # only one text of id 2 is a copy
            (3, words("c")), (3, words("c") + " tail"),                         # two near copies under one id
            (None, words("d")), (None, words("d") + " tail"), (None, words("e")),
            (None, words("b") + " more"), (9, words("f")), (9, words("f")), (7, ""), (7, None), (None, "")]
    got = sorted(((r["doc_id"], (r["text"] or "").split(" ")[0]) for r in
                  corpus_pipeline.near_duplicates(spark, documents(rows), MID).collect()), key=str)
    assert got == sorted([(1, "a0"), (2, "b0"), (3, "c0"), (None, "d0"), (None, "e0"), (9, "f0"), (7, ""), (7, ""), (None, "")], key=str)


def test_personal_data_stage(stages):
    before, after = map(texts, stages["personal_data"])
    assert before.keys() == after.keys()
    for i, text in before.items():
        spans = [(a, pii.KINDS[k], b) for a, k, b in brute_spans(text or "")]
        if not spans:
            continue
        assert all(text[a:b] not in after[i] or text.count(text[a:b]) > 1 for a, _, b in spans)
        assert f"[{spans[0][1].upper()}]" in after[i]
    sizes = stages["personal_data"][1].filter(F.col("n_chars") != F.length("text"))
    assert sizes.count() == 0


def test_packing_stage(stages):
    before, pieces = stages["packing"]
    check_packing(pieces.toArrow().to_pylist(), texts(before))


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


CLASHING = ("lang_pred", "_text", "spans", "base", "added", "redacted", "row", "_key", "_keep", "comp", "bad col.name")


def test_pipeline_stages_on_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "123"), (4, "the house and the garden"), (4, "the house and the garden"), (None, "a null id"),
            (5, "mail me at a.b@c.example now " + "word " * 20000)]
    more = {c: (pa.string(), [f"{c} {i}" for i, _ in rows]) for c in CLASHING}
    docs = first = documents(rows, **more)
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, MID).toArrow())
        assert docs.columns == first.columns and docs.count()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in docs.collect())
    assert got == [(False, 4), (False, 5), (True, 0)]
    five = docs.filter("doc_id = 5").first()
    assert "[EMAIL]" in five["text"] and all(five[c] == f"{c} 5" for c in CLASHING) and five["score"] == "y"
    empty = documents([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, MID).count() == 0
