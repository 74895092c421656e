"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill.llm.common import documents
from feedmill.llm.exact_dedup import exact_dedup
from feedmill.llm.html_text import extract
from feedmill.llm.jaccard_join import jaccard_components
from feedmill.llm.lm_score import lm_score
from feedmill.llm.mixing import mix
from feedmill.llm.quality_classifier import classify, train
from feedmill.llm.quality_rules import quality_rules
from feedmill.llm.sentence_pieces import encode_pieces
from feedmill.llm.sharding import shard
from feedmill.llm.simhash_trie import simhash_components
from feedmill.llm.suffix_dedup import remove_repeats
from feedmill.llm.token_alignment import align_tokens, check_same_ids
from feedmill.llm.whitening import whiten


def _file(spark: SparkSession, setting: str, name: str) -> str:
    """The path of a vocabulary: a setting of the session, or the public files' own."""
    path = spark.conf.get(setting, None)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_model(spark: SparkSession) -> str:
    """The path of the SentencePiece model: the setting `feedmill.piece_model`, or the public files' own."""
    return _file(spark, "feedmill.piece_model", "piece_bpe_32k.model")


def op1_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(documents(spark, sf_dir), tokenizer_model(spark))


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(documents(spark, sf_dir), tokenizer_model(spark), digests=True)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return classify(docs, train(docs, documents(spark, sf_dir, "labels")))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir).select("doc_id", "source"))
    return mixed.select("doc_id", F.col("mix_class").alias("source"), "mix_epoch", "mix_block", "mix_slot", "mix_rank")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("text_key")


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(documents(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = _file(spark, "feedmill.byte_ranks", "byte_bpe_50k.tiktoken")
    check_same_ids(_file(spark, "feedmill.byte_vocabulary", "byte_bpe_50k.json"), ranks)
    return align_tokens(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, tokenizer_model(spark))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(documents(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_remove_repeats": op1_remove_repeats,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_mix_sources": op7_mix_sources,
    "op8_quality_rules": op8_quality_rules,
    "op9_shard": op9_shard,
    "op10_html_text": op10_html_text,
    "op11_token_alignment": op11_token_alignment,
    "op12_simhash": op12_simhash,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        with t as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as norm from documents
        ), g as (
            select norm, min(doc_id) as keep_id, count(*) as group_size from t group by norm
        )
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256,
               count(*) over (partition by doc_id, norm) as copies
        from t join g using (norm)
    """,
}
