"""Registered queries of the training-data operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuescope.llm import bpe, conversation_trie, decontaminate, jaccard, langid, prefix_tokens, preference, quality, quality_rules, spelling_trie, training_order, url_rules, warc
from valuescope.llm.common import materialise, shared_path, table
from valuescope.llm.oracle import ORACLE

#: Explicit URL rules of the filter: host, path prefix, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

#: Tokens above which op12 calls a text too long.
TOKEN_LIMIT = 4096


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archive(warc.page_records(table(spark, sf_dir, "pages")), path)
    records = materialise(warc.read_archive(spark, path, with_payload=False), "records")
    return warc.page_captures(warc.assemble(records))


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.render_pairs(preference.echo_negatives(table(spark, sf_dir, "conversations")))


def op3_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.controlled_filter(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op6_quality_factorisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality.train(docs, labels.filter(~quality.held_out(F.col("doc_id"))))
    out = quality.score(docs, machine, ["doc_id"])
    return out.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    out = langid.predict(docs, model, ["doc_id"])
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "shards")
    training_order.write_shards(table(spark, sf_dir, "documents"), path)
    row_bytes = 2 * training_order.LENGTH
    rows = spark.read.schema(training_order.SHARD_SCHEMA).parquet(path)  # whole shards, where they stand
    return rows.select(
        "slot", "shard", (F.col("_metadata.row_index") * row_bytes).alias("shard_offset"), "doc_id", "chunk", F.col("n_tokens").cast("bigint").alias("n_tokens"), F.sha1("tokens").alias("tokens_sha1")
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    host, path = url_rules.split_url(F.col("url"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", host.alias("host"), path.alias("path"))
    pages = pages.select("page_id", "host", "path", url_rules.url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    # the number that ends a page's path names the document that was taken from it; its labels are the page's
    labels = table(spark, sf_dir, "labels").filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    named = pages.withColumn("doc_id", F.regexp_extract("path", r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).try_cast("bigint"))
    labelled = named.join(labels, "doc_id").select("tokens", F.when(F.col("bad") == 1, url_rules.BLOCK).otherwise(url_rules.ALLOW).alias("label"))
    rules = url_rules.mine_rules(materialise(labelled, "url-labels"))
    rule, verdict = url_rules.explicit_rule(F.col("host"), F.col("path"), URL_RULES)
    judged = url_rules.judge(pages.withColumn("rule", rule).withColumn("explicit", verdict), "tokens", rules)
    mined = F.when(F.col("rule_id").isNotNull(), F.lit(url_rules.BLOCK)).otherwise(F.lit(url_rules.ALLOW))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("explicit", mined).alias("verdict"), F.col("rule_id").alias("mined_rule"))


def op10_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path(), ["doc_id"])


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = conversation_trie.conversations(table(spark, sf_dir, "conversations"))
    return conversation_trie.trie(conversation_trie.share_openings(convs))


def op12_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), ["doc_id"], TOKEN_LIMIT)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_trie.count_words(table(spark, sf_dir, "documents"), damage=199, min_chars=6, min_n=5)
    return spelling_trie.variants(words, factor=5)


QUERIES = {f.__name__: f for f in (op1_warc_transactions, op2_preference_pairs, op3_risk_controlled_rules, op4_bm25_decontamination, op5_ngram_jaccard, op6_quality_factorisation, op7_ppm_language, op8_training_order, op9_url_rules, op10_bpe_segment_tree, op11_conversation_trie, op12_prefix_tokens, op13_spelling_variants)}
ORACLE_SQL = {k: v for k, v in ORACLE.items() if k in QUERIES}
