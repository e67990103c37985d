"""Schema rules, reference checks and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.fixed.taxonomy import (
    CATEGORY_IDS, MAX_TAGS, PRICING_MODELS, PRODUCT_TYPES, STATUSES,
)
from tierweave.functions.base import compact
from tierweave.functions.text import SLUG_PATTERN

REQUIRED = ("slug", "name", "product_url", "description", "product_type", "category", "status")
REFERENCE_FIELDS = ("competitors", "based_on", "used_by")


def schema_errors(expected_slug: Column | None = None) -> Column:
    """Messages of every broken rule, in rule order."""
    def missing(c: str) -> Column:
        return F.when(F.col(c).isNull(), F.lit(f"(root): '{c}' is a required property"))

    def one_of(path: str, allowed) -> Column:
        v = F.col(path)
        return F.when(~v.isin(*allowed), F.concat(F.lit(f"{path}: '"), v, F.lit("' is not one of the allowed values")))

    def rule(bad: Column, text: str) -> Column:
        return F.when(bad, F.lit(text))

    size = F.length("description")
    score = F.col("meta.data_quality_score")
    mismatch = []
    if expected_slug is not None:
        mismatch = [F.when(~F.col("slug").eqNullSafe(expected_slug), F.concat(
            F.lit("Slug mismatch: expected '"), expected_slug, F.lit("' but got '"), F.coalesce("slug", F.lit("")), F.lit("'"),
        ))]
    return compact(
        *mismatch,
        *[missing(c) for c in REQUIRED],
        rule(~F.col("slug").rlike(SLUG_PATTERN), "slug: does not match the slug pattern"),
        rule(size < 10, "description: is too short"),
        rule(size > 5000, "description: is too long"),
        one_of("product_type", PRODUCT_TYPES),
        one_of("category", CATEGORY_IDS),
        one_of("status", STATUSES),
        one_of("pricing.model", PRICING_MODELS),
        rule(F.size("tags") > MAX_TAGS, "tags: is too long"),
        rule((score < 0) | (score > 1), "meta.data_quality_score: is out of range"),
        rule(F.col("company").isNotNull() & F.col("company.name").isNull(), "company: 'name' is a required property"),
        rule(F.col("company").isNotNull() & F.col("company.url").isNull(), "company: 'url' is a required property"),
    )


def validate_schema(catalog: DataFrame, expected_slug: Column | None = None) -> DataFrame:
    """(slug, valid, errors) per product."""
    return catalog.select("slug", schema_errors(expected_slug).alias("errors")).select(
        "slug", (F.size("errors") == 0).alias("valid"), "errors"
    )


def dangling_references(catalog: DataFrame, slugs: DataFrame | None = None) -> DataFrame:
    """References to products that do not exist.

    Distinct targets are checked against the slugs once, so a product that very many others
    name does not decide the size of one task.
    """
    known = (catalog if slugs is None else slugs).select(F.col("slug").alias("referenced_slug"))

    def links_of(field: str) -> Column:
        found = F.transform(field, lambda r: F.struct(F.lit(field).alias("field"), r.alias("referenced_slug")))
        return F.coalesce(found, F.array().cast("array<struct<field:string,referenced_slug:string>>"))

    links = F.flatten(F.array(*[links_of(f) for f in REFERENCE_FIELDS]))
    edges = catalog.select(F.col("slug").alias("product_slug"), F.explode(links).alias("l")).select("product_slug", "l.*")
    edges = edges.filter(F.col("referenced_slug").isNotNull())
    missing = edges.select("referenced_slug").distinct().join(known, "referenced_slug", "left_anti")
    bad = edges.join(missing, "referenced_slug", "left_semi")
    message = F.concat(
        F.lit("Product '"), F.col("product_slug"), F.lit("' references '"), F.col("referenced_slug"),
        F.lit("' in '"), F.col("field"), F.lit("', but no such product exists"),
    )
    return bad.select("product_slug", "field", "referenced_slug", message.alias("message"))


def validation_summary(checked: DataFrame, dangling: DataFrame) -> DataFrame:
    """(total, valid, invalid, integrity_errors) of one run."""
    counts = checked.agg(
        F.count("*").alias("total"), F.count_if("valid").alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )
    return counts.join(dangling.agg(F.count("*").alias("integrity_errors")))
