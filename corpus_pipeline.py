"""From raw documents to packed training sequences.

Language identification, toxicity, near-duplicate removal, redaction of
personal data, packing.  Each stage takes (spark, docs, sf_dir) and returns a
DataFrame; ``run`` writes every stage's result as Parquet below the checkpoint
folder and reads it back as the next one's ``docs``.  All but the last return
the columns of ``documents``: an operator is handed a whole row as one column
beside its text, so no column of ``docs`` can clash with one that it adds.

No stage can be told in SQL as a whole (fitted models, message passing, online
packing), so there is no oracle; the tests hold the pipeline against
brute-force versions of its stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.llm import jaccard_join, langid, packing, pii, toxicity
from tastemap.session import scratch_path
from tastemap.sources.tables import load_table

MIN_LANG_SCORE = 0.5            # the chosen language must win all its votes
MAX_TOXICITY = 0.5              # documents of this score or more go
NEAR = jaccard_join.Rule(words=5, num=80, den=100)


def as_rows(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns) and text."""
    return docs.select(F.struct("*").alias("row"), "text")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, without a letter, or of no learned language
    that wins all its votes."""
    model = langid.fit(docs.select("doc_id", "text", "lang"), F.lit(True))
    scored = langid.predict(as_rows(docs), model, ["row"])
    kept = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANG_SCORE)
    return scored.filter(kept).select("row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of a toxicity score of ``MAX_TOXICITY`` or more."""
    model = toxicity.fit(docs.select("doc_id", "text"), load_table(spark, sf_dir, "labels", ["doc_id", "toxic"]), F.lit(True))
    return toxicity.score(as_rows(docs), model, ["row"]).filter(F.col("score") < MAX_TOXICITY).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of every group one row: that of the least id, rows without an id
    last, then the least hash of its text; rows without words have no group and
    stay, but for exact repeats."""
    # An id may stand for several texts, so groups are told by id and text.
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text"))
    groups = jaccard_join.join_components(docs.select(key.alias("doc_id"), "text"), NEAR).select(
        F.col("doc_id").alias("_key"), F.col("component_id").alias("_keep"))
    gone = groups.filter("_key <> _keep").select("_key").distinct()
    first = docs.join(gone, key == gone["_key"], "left_anti")
    # Exact repeats of a row share its key, so the groups can't part them.
    return first.dropDuplicates(["doc_id", "text"])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by its kind, e.g. [EMAIL]."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_chars")]
    whole = docs.select(F.struct(F.lit(True), *rest).alias("row"), "text")
    found = pii.find(whole, pii.fit(docs.select("text")), ["row"])
    new = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}
    return found.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of at most 2048 ids."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("toxicity", toxic), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
