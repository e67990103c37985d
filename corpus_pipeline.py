"""Corpus pipeline: ``run(spark, sf_dir)`` cleans, deduplicates and packs the documents.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next one's ``docs``. All stages but the last return the columns of ``docs``. Ids are kept as
they are; NULL texts are treated as empty ones by every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave.llm.common import table, vocabulary
from tierweave.llm.language_id import UNKNOWN, fit_languages, with_language
from tierweave.llm.line_dedup import without_widespread_lines
from tierweave.llm.near_dups import near_duplicates
from tierweave.llm.packing import pack
from tierweave.llm.quality_model import fit_quality, score_quality
from tierweave.session import stored

#: Least score of a language decision; 0.5 is undecided, and no text with a letter scores less. Of 8,000
#: labelled texts of sf0.1 outside the sample learnt from, 17 score less than this.
LANGUAGE_SCORE = 0.75
#: A character of a word.
VISIBLE = "[^\\x20\\x09-\\x0D]"


def _wrapped(docs: DataFrame) -> DataFrame:
    """Id, text and all columns as they are, so that no name can clash with those of an operator."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_columns"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labelled ones among them."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(_wrapped(docs), model).filter("predicted = 1").select("_columns.*")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised.

    Between several languages a text of none of them is undecided and goes. Where only one language is
    learnt there is nothing to compare with: every text with a letter stays.
    """
    found = with_language(_wrapped(docs), fit_languages(docs))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LANGUAGE_SCORE)).select("_columns.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many sources share; documents of nothing else go."""
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    cleaned = without_widespread_lines(docs.select("doc_id", "source", "text", rest.alias("_columns")))
    left = (F.col("n_removed") == 0) | F.col("text").rlike(VISIBLE)
    return cleaned.filter(left).select(*[F.col(c if c == "text" else f"_columns.`{c}`") for c in docs.columns])


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies, linked from 80 percent on.

    Ids are taken to be unique: all rows of an id stay if one of them is kept, identical ones too, and
    all rows without an id stay if one of them is kept.
    """
    kept = near_duplicates(docs, percent=80, bands=60, band_rows=8).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place in it."""
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicate_groups),
    ("best_fit_packing", packing),
]

#: Models and packing have no SQL form; the pipeline is tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
