"""Enrichment run: weak products, requests for their gaps, answers merged as tier 3."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.operators.gaps import answers_to_records, compose_prompt, find_gaps
from tierweave.operators.merge import tiered_merge
from tierweave.operators.tags import low_quality
from tierweave.session import cut_lineage


def requests(catalog: DataFrame, max_score: float = 0.6, limit: int | None = None) -> DataFrame:
    """(slug, gaps, prompt) of the weak products with gaps; of the first ``limit`` by file name if given."""
    picked = cut_lineage(low_quality(catalog, max_score, limit).select("slug"))
    weak = catalog.join(picked, "slug", "left_semi").withColumn("gaps", find_gaps())
    return weak.filter(F.size("gaps") > 0).select("slug", "gaps", compose_prompt(F.col("gaps")).alias("prompt"))


def enrich(catalog: DataFrame, answers: DataFrame, as_of: Column) -> DataFrame:
    """Catalog after merging ``answers(slug, seq, response)``; only empty fields change."""
    return tiered_merge(catalog, answers_to_records(catalog, answers), as_of)
