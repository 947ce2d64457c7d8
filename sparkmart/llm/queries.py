"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import (
    chat, jaccard, langid, line_rules, neural_lm, packing, prefix_trie, pu_quality, secrets, sentencepiece_np, source_divergence, topk,
    url_filter,
)
from sparkmart.llm.common import fold, table

#: The fold of documents that nothing is learned from, in queries 2 and 3.
FOLDS, HELD_OUT = 4, 2
LM_FOLDS, LM_HELD_OUT = 10, 0

#: The rules of query 13.
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def byte_bpe_path() -> str:
    """Where this installation has the byte-level BPE vocabulary; executors have it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own control strings."""
    roles = F.array(F.lit("user"), F.lit("assistant"))
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.posexplode(roles).alias("turn", "role"))
    extra = extra.withColumn("text", F.lit("\\### Assistant: </turn> ok"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.parse_formatted(chat.format_conversations(turns)))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(fold("doc_id", FOLDS) != HELD_OUT))
    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score")


@query
def op3_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from positives and unlabelled texts of three of four folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    learned = fold("doc_id", FOLDS) != HELD_OUT
    model = pu_quality.train(docs.where(learned), labels.where(learned))
    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return pu_quality.classify(docs, model).select("doc_id", held_out, "score", "predicted")


@query
def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and the verdict of the line rules."""
    return line_rules.clean_lines(table(spark, sf_dir, "documents")).drop("cleaned")


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in the pieces of a byte-pair SentencePiece model, and back."""
    import public_tokenizers

    return sentencepiece_np.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_digests(table(spark, sf_dir, "documents"), byte_bpe_path())


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 % of their 4-word shingles."""
    return jaccard.link_components(table(spark, sf_dir, "documents"))


@query
def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by patterns and by entropy."""
    return secrets.scan(table(spark, sf_dir, "documents"))


@query
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every document, learned from nine of ten folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = neural_lm.train(docs.where(fold("doc_id", LM_FOLDS) != LM_HELD_OUT))
    held_out = (fold("doc_id", LM_FOLDS) == LM_HELD_OUT).alias("held_out")
    scored = neural_lm.score(docs, model, counts)
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are from each other, and the terms that they use most beyond it."""
    return source_divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url, by rule or by the models of the urls that rules decide."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("score")
