"""From raw documents to token ids, in five stages. Each works on all rows that the stage before has kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm import bpe_replay, language, minhash, pii, tiling
from ledgerloom.llm.bloom import bloom_blocks, impossible, possible
from ledgerloom.llm.queries import RANK_VOCABULARY, table
from ledgerloom.llm.staging import staged


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a determinable language: a null text, or one without a letter. Where no label is
    there to learn from, all other texts stay."""
    judged = language.predicted(docs, language.train(docs))
    known = (F.col("__judged.lang_pred") != language.UNDETERMINED) | language.has_letter(F.col("text"))
    return judged.where(known).drop("__judged")


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group. Of rows that repeat its doc_id, the first by hash
    and order of the text stays. Documents with a null doc_id all stay."""
    judged = minhash.near_duplicates(docs).where("doc_id is not null").groupBy(F.col("doc_id").alias("judged_id"))
    others = staged(judged.agg(F.count_if("kept").alias("n")).where("n <> 1"), "other-ids")
    # Most documents stay as they are: a filter of bounded size finds them without moving their texts.
    named, blocks = docs.where("doc_id is not null"), 1 << 15
    filter_ = staged(bloom_blocks(others, F.col("judged_id"), blocks), "other-ids-filter")
    sure, asked = (f(named, F.col("doc_id").cast("long"), filter_, blocks) for f in (impossible, possible))
    of = lambda ids, how: asked.join(ids.select("judged_id"), F.col("doc_id") == F.col("judged_id"), how)
    # Only rows that share their doc_id are held against each other.
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text") and not c.startswith("__")]
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text", *rest))
    first = of(others.where("n > 1"), "left_semi").withColumn("__place", place).where("__place = 1").drop("__place")
    return sure.unionByName(of(others, "left_anti")).unionByName(first).unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark. Documents with a null doc_id can't be named and stay."""
    pairs = tiling.contaminated_pairs(docs, table(spark, sf_dir, "benchmark"))
    # Written first, so that Spark knows how few they are before it moves any text.
    bad = staged(pairs.select(F.col("doc_id").alias("bad_id")).where("bad_id is not null").distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"] == bad["bad_id"], "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; every document stays."""
    return pii.masked_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document."""
    return bpe_replay.encode(docs, public_tokenizers.path(RANK_VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("language", keep_languages),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", encode_tokens),
]

# No stage can be expressed in SQL; tests/llm/test_pipeline.py holds the rows of run() against plain versions of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
