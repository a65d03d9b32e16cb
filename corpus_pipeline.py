"""Corpus pipeline: language, quality, near duplicates, benchmark leaks, token ids.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written
as Parquet and reread as the next one's ``docs``. All stages but the last return
the columns of their input, rows unchanged: rows that a stage rejects are gone.
Extra columns of ``documents`` pass through, whatever their names. Null texts
have no language and leave in the first stage; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.llm import bpe, decontaminate, jaccard, langid, quality
from valuescope.llm.common import keep_rows, shared_path, table
from valuescope.llm.queries import tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that the best learned language codes shorter than plain bytes."""
    sent = spark.sparkContext.broadcast(langid.train(docs.filter(~langid.held_out(F.col("doc_id")))))

    def make():
        def mask(texts):
            langs, _, rate = langid.judge(sent.value, texts)
            return [x != langid.UNDETERMINED and r < langid.PLAIN_BITS for x, r in zip(langs, rate)]

        return mask

    return keep_rows(docs, ["text"], make)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality machine scores at 0.5 or more."""
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out(F.col("doc_id")))
    sent = spark.sparkContext.broadcast(quality.train(docs, labels))

    def make():
        known = quality.Slots()
        return lambda texts, sizes: quality.judge(sent.value, texts, sizes, known) >= 0.5

    return keep_rows(docs, ["text", "n_chars"], make)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    return jaccard.keep_one(docs)


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    shards = [spark.sparkContext.broadcast(s) for s in decontaminate.load_shards(table(spark, sf_dir, "benchmark"))]
    return keep_rows(docs, ["text"], lambda: lambda texts: decontaminate.clean_mask(shards, texts))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text of each document."""
    return bpe.encode_decode(docs, tokenizer_path(), ["doc_id"])


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", one_of_each), ("decontamination", no_leaks), ("token_ids", token_ids)]

#: Learned models decide in the first two stages, which SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
