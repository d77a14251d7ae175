"""One query per training-data operator over the supplied tables, and SQL for some."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    chat_format, conversation_repair, debruijn, digest_index, fingerprints, hidden_markov, jaccard_join,
    license_scan, mixing, piece_codec, quality_model, url_filter, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "piece_bpe_32k.model"
RULES = (
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
)
#: A conversation whose texts are themselves control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.piece_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_index.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), RULES)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats the conversations from a log of their events; all digests are read from the output."""
    own = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat_format.format_chats(chat_format.as_events(given.unionByName(own)))
    turns = chat_format.read_turns(F.col("formatted"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.filter("pieces", lambda p: p["loss"])
    loss = F.array_join(F.transform(learnt, lambda p: chat_format.unescape(p["text"])), "")
    return out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss")).select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), metadata=["n_chars"]
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_markov.score_texts(_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), percent=85, k=4)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_licenses",
        F.array_join(F.transform("licenses", lambda x: x["name"]), ",").alias("licenses"),
        F.round(F.array_max(F.transform("licenses", lambda x: x["containment"])), 6).alias("containment"),
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.remove_repeats(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_exact_dedup, op3_url_filter, op4_chat_format, op5_fingerprints, op6_mixing,
        op7_quality, op8_lm_scoring, op9_jaccard_join, op10_license_scan, op11_substring_dedup,
        op12_conversation_repair, op13_embedding_whitening,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
}
