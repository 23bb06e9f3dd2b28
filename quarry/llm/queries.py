"""Driver queries of the training-data operators: name -> builder, name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import oracles
from quarry.llm._shared import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.best_fit_packing import pack

    return pack(read(spark, sf_dir, "documents"))


@register("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.toxicity import score_toxicity

    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op9_kernel_langid")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.kernel_langid import identify

    return identify(read(spark, sf_dir, "documents"))


@register("op10_attention_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.attention_quality import score_quality

    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op6_bayes_jaccard", oracles.JACCARD)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.bayes_jaccard import jaccard_classes

    return jaccard_classes(read(spark, sf_dir, "documents"))


@register("op3_suffix_dedup", oracles.REPEATS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quarry.llm.suffix_dedup import remove_repeats

    out = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op7_projection_dedup", oracles.VECTOR_LINKS)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.projection_dedup import vector_components

    return vector_components(read(spark, sf_dir, "embeddings"))


@register("op5_permutation_index")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.permutation_index import search

    return search(read(spark, sf_dir, "embeddings"))


def _quote_sql() -> str:
    from quarry.llm.quote_linking import ORACLE_SQL

    return ORACLE_SQL


@register("op2_quote_linking", _quote_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.quote_linking import link_quotes

    return link_quotes(read(spark, sf_dir, "conversations"))


@register("op8_piece_viterbi")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids' checksum and the decoded text's digest of every document."""
    from pyspark.sql import functions as F

    from quarry.llm.piece_viterbi import decode_documents, encode_documents

    out = decode_documents(encode_documents(read(spark, sf_dir, "documents")))
    return out.select("doc_id", "n_ids", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def _phrase_sql() -> str:
    from quarry.llm.son_phrases import ORACLE_SQL

    return ORACLE_SQL


@register("op12_son_phrases", _phrase_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.son_phrases import collocations

    return collocations(read(spark, sf_dir, "documents"))


def _spelling_sql() -> str:
    from quarry.llm.variable_grams import ORACLE_SQL

    return ORACLE_SQL


@register("op11_variable_grams", _spelling_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.variable_grams import spelling_variants

    return spelling_variants(read(spark, sf_dir, "documents"))


@register("op13_secret_layers")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.secret_layers import secret_digests

    return secret_digests(read(spark, sf_dir, "documents"))
