"""One query per corpus operator, over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave.llm.bpe_codec import round_trip
from tierweave.llm.common import table, vocabulary
from tierweave.llm.filter_audit import filter_audit, filter_audit_sql
from tierweave.llm.language_id import language_predictions
from tierweave.llm.line_dedup import line_dedup_sql, without_widespread_lines
from tierweave.llm.near_dups import near_duplicates
from tierweave.llm.packing import pack
from tierweave.llm.quality_model import quality_scores
from tierweave.llm.quality_rules import quality_rules
from tierweave.llm.token_counts import token_counts
from tierweave.llm.token_files import written_and_read
from tierweave.llm.topk import exact_top_k, top_k_sql
from tierweave.llm.vector_codes import vector_codes, vector_codes_sql
from tierweave.llm.warc import archive_and_read, warc_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op3_exact_top_k(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return exact_top_k(vectors.filter(F.col("vec_id") % 50 == 0), vectors)


ORACLES["op3_exact_top_k"] = top_k_sql()


@query
def op4_bpe_codec(spark, sf_dir):
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_warc(spark, sf_dir):
    return archive_and_read(table(spark, sf_dir, "pages"))


ORACLES["op5_warc"] = warc_sql()


@query
def op6_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "anomaly_score",
    )


@query
def op8_language_id(spark, sf_dir):
    return language_predictions(table(spark, sf_dir, "documents"))


@query
def op9_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_line_dedup(spark, sf_dir):
    return without_widespread_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.md5("text").alias("cleaned_md5"),
    )


ORACLES["op10_line_dedup"] = line_dedup_sql()


@query
def op11_vector_codes(spark, sf_dir):
    return vector_codes(table(spark, sf_dir, "embeddings"))


ORACLES["op11_vector_codes"] = vector_codes_sql()


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = filter_audit_sql()


@query
def op13_token_files(spark, sf_dir):
    return written_and_read(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
