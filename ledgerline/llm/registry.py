"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, compact_windows, decontam, divergence, langid, nbsvm, prefix_trie, quality_rules, sharding, simhash, sql, suffix_dedup, toxicity, urls
from ledgerline.llm.common import fold, load, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def bpe_digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers
    args = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe.decode(bpe.encode(docs, *args), *args, keep_ids=True)
    return both.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


@query("op8_byte_bpe")
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to byte-level BPE ids and decoded again."""
    return bpe_digests(load(spark, sf_dir, "documents"))


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its SimHash fingerprint and near-duplicate component."""
    out = simhash.near_duplicates(load(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its predicted language; learned from the folds other than 1."""
    docs = load(spark, sf_dir, "documents")
    model = langid.fit_documents(docs, fold("doc_id", 3) != 1)
    out = langid.predict(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score; learned from the folds other than 2."""
    docs = load(spark, sf_dir, "documents")
    model = nbsvm.fit_documents(docs, load(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return _scored(nbsvm.predict(docs, model), 0.7)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score; learned from the folds other than 2."""
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit_documents(docs, load(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return _scored(toxicity.predict(docs, model), 0.3)


def _scored(out: DataFrame, threshold: float) -> DataFrame:
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op1_decontamination", sql.CONTAMINATION)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside 13-word windows of benchmark items."""
    out = decontam.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), width=13, one_in=20)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


@query("op7_quality_rules", sql.quality_rules(quality_rules.COMMON_WORDS, quality_rules.CHAR_CLASSES, quality_rules.MAX_CHAR_DISTANCE,
                                              quality_rules.MIN_CHARS, quality_rules.MAX_WORD_DISTANCE, quality_rules.MIN_WORDS))
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base counts and the verdict of the divergence rules."""
    return quality_rules.judge(load(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


#: host, path, action
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query("op9_url_filter", sql.URLS)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its host, path, rule and verdict."""
    return urls.judge(load(spark, sf_dir, "pages"), spark.createDataFrame(list(URL_RULES), "host string, path string, action string"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with passages that near-duplicate one of a document with a smaller id: how much, and of which."""
    out = compact_windows.repeated_passages(load(spark, sf_dir, "documents"))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return out.where(F.size("spans") > 0).select("doc_id", "n_words", words.alias("n_repeated"), F.size("spans").cast("long").alias("n_spans"),
                                                  F.col("sources").alias("source_ids"))


@query("op6_suffix_array_dedup")
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that also start in a document with a smaller id."""
    out = suffix_dedup.remove_repeated(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_prefix_trie", sql.PREFIX_TRIE)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations, with members, children and subtree totals."""
    own = stored(prefix_trie.turns_of(load(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.trie(prefix_trie.rebuilt(own))


@query("op12_sharding", sql.SHARDS)
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its place in 16 shards, which all have the mixture of sources of the whole table."""
    out = sharding.interleave(load(spark, sf_dir, "documents"), shards=16, by="source")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op13_source_divergence", sql.DIVERGENCES)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language lie apart in their words, and the terms that set each of them off."""
    return divergence.divergences(load(spark, sf_dir, "documents"), min_docs=10, top=10)
