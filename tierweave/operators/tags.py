"""Tag inference, keyword extraction and quality scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierweave import schemas
from tierweave.fixed import geo, scoring, tag_rules, taxonomy
from tierweave.functions.base import (
    WHITESPACE, blank_to_null, col, compact, computed_once, lookup, strings, strip, truthy,
)
from tierweave.functions.patterns import folded, matches_folded
from tierweave.functions.text import han_runs, meaningful_words

RULE_GROUP = 30


def _none() -> Column:
    return F.array().cast("array<string>")


def _or_none(c: Column) -> Column:
    return F.coalesce(c, _none())


def keep_valid(tags: Column, valid=taxonomy.TAG_IDS) -> Column:
    """Tags of the vocabulary, order kept."""
    return F.filter(tags, lambda t: t.isin(*valid))


def search_text() -> Column:
    """Name, descriptions, Chinese name and keywords, joined by spaces."""
    parts = [blank_to_null(c) for c in ("name", "description", "description_zh", "name_zh")]
    words = F.filter(_or_none(F.col("keywords")), lambda k: truthy(k))
    return F.array_join(F.concat(compact(*parts), words), " ")


def text_tags(text: Column, rules=tag_rules.TEXT_RULES, low: Column | None = None) -> Column:
    """Tags of every text rule that matches, in rule order; ``low`` is the folded text if it is at hand."""
    low = folded(text) if low is None else low
    return computed_once(F.struct(text.alias("text"), low.alias("low")), lambda t: _rule_tags(t["text"], t["low"], rules))


def _rule_tags(text: Column, low: Column, rules) -> Column:
    hits = [F.when(matches_folded(text, low, p), strings(tags)) for p, tags in rules]
    groups = [F.flatten(compact(*hits[i:i + RULE_GROUP])) for i in range(0, len(hits), RULE_GROUP)]
    return F.concat(*groups)


def _table_tags(key: Column | str, table: dict[str, list[str]]) -> Column:
    k = col(key)
    return _or_none(F.coalesce(*[F.when(k == v, strings(tags)) for v, tags in table.items()]))


def structured_tags() -> Column:
    """Tags implied by structured fields, in rule order."""
    open_source, api = F.col("open_source"), F.col("api_available")
    arch = F.lower(F.coalesce("architecture", F.lit("")))
    country = F.col("company.headquarters.country")
    valuation = F.coalesce(F.col("company.funding.valuation_usd"), F.lit(0.0))
    backed = F.exists(F.col("sources"), lambda s: F.coalesce(s["url"].contains("ycombinator"), F.lit(False)))

    def tag(test: Column, name: str) -> Column:
        return F.when(test, F.lit(name))

    def any_in(parts) -> Column:
        out = arch.contains(parts[0])
        for p in parts[1:]:
            out = out | arch.contains(p)
        return out

    return compact(
        F.when(open_source, "open-source").when(~open_source, "closed-source"),
        tag(truthy("repository_url"), "open-source"),
        tag(api, "api-service"),
        lookup(F.col("pricing.model"), tag_rules.PRICING_TAGS),
        *[tag(any_in(parts), name) for parts, name in tag_rules.ARCHITECTURE_TAGS],
        tag(F.size("modalities") > 1, "multimodal"),
        lookup(country, geo.COUNTRY_TAGS),
        tag(country.isin(*geo.EUROPE), "europe"),
        F.when(valuation >= tag_rules.DECACORN_USD, "decacorn").when(valuation >= tag_rules.UNICORN_USD, "unicorn"),
        tag(backed, "yc-backed"),
    )


def platform_tags(platforms: Column) -> Column:
    """Tags of the platform names, by contained word."""
    def of_one(p: Column) -> Column:
        low = F.lower(p)
        return compact(*[F.when(low.contains(k), F.lit(t)) for k, t in tag_rules.PLATFORM_TAGS.items()])

    return F.flatten(F.transform(_or_none(platforms), of_one))


def inferred_tags(valid=taxonomy.TAG_IDS, text: Column | None = None, low: Column | None = None) -> Column:
    """Existing tags, then the inferred ones, first occurrence kept, at most 20."""
    found = F.concat(
        text_tags(search_text() if text is None else text, low=low),
        _table_tags("category", tag_rules.CATEGORY_TAGS),
        _table_tags("sub_category", tag_rules.SUB_CATEGORY_TAGS),
        _table_tags("product_type", tag_rules.PRODUCT_TYPE_TAGS),
        structured_tags(),
        platform_tags(F.col("platforms")),
    )
    every = F.array_distinct(F.concat(_or_none(F.col("tags")), keep_valid(found, valid)))
    # a product known to be closed does not keep the open tag
    closed = (~F.col("open_source")) & F.array_contains(every, "closed-source")
    kept = F.when(closed, F.array_remove(every, "open-source")).otherwise(every)
    return F.slice(kept, 1, taxonomy.MAX_TAGS)


def infer_tags(catalog: DataFrame, valid=taxonomy.TAG_IDS) -> DataFrame:
    """Catalog with ``tags`` completed. The search text is built once per row."""
    with_text = catalog.withColumn("_text", search_text()).withColumn("_low", folded(F.col("_text")))
    return with_text.withColumn("tags", inferred_tags(valid, F.col("_text"), F.col("_low"))).drop("_text", "_low")


def gathered_terms() -> Column:
    """All terms of a product of at least two characters, in order."""
    def spaced(c: Column) -> Column:
        return F.replace(c, F.lit("-"), F.lit(" "))

    terms = F.concat(
        compact(
            F.col("name"), F.col("name_zh"), F.col("company.name"), F.col("company.name_zh"),
            spaced(F.col("category")), spaced(F.col("sub_category")),
        ),
        F.transform(_or_none(F.col("tags")), spaced),
        _or_none(F.col("use_cases")),
        _or_none(meaningful_words("description")),
        _or_none(han_runs("description_zh")),
        _or_none(F.col("modalities")),
        compact(spaced(F.col("product_type"))),
    )
    return F.filter(F.transform(terms, lambda t: F.btrim(t, F.lit(WHITESPACE))), lambda t: F.length(t) >= 2)


def first_wins(terms: Column) -> Column:
    """Case-insensitive distinct, first spelling and order kept."""
    low = F.transform(terms, lambda t: F.lower(t))
    return F.transform(F.array_distinct(low), lambda t: F.element_at(terms, F.array_position(low, t).cast("int")))


def extract_keywords(catalog: DataFrame) -> DataFrame:
    """Catalog with ``keywords``. The terms are gathered once per row."""
    return catalog.withColumn("_terms", gathered_terms()).withColumn("keywords", first_wins(F.col("_terms"))).drop("_terms")


def field_has_value(path: str, schema: T.StructType = schemas.PRODUCT) -> Column:
    """True unless the value is missing, blank text or an empty list or object."""
    c, dtype = F.col(path), schemas.field_type(schema, path)
    if isinstance(dtype, T.StringType):
        return c.isNotNull() & (strip(c) != "")
    if isinstance(dtype, T.ArrayType):
        return c.isNotNull() & (F.size(c) > 0)
    if isinstance(dtype, T.StructType):
        return c.isNotNull() & F.coalesce(*[F.col(f"{path}.{f.name}").cast("string") for f in dtype.fields]).isNotNull()
    return c.isNotNull()


def quality_score() -> Column:
    """Weighted completeness of the product, 0..1, two decimals."""
    total = sum(scoring.QUALITY_WEIGHTS.values())
    earned = sum(
        F.when(field_has_value(p), F.lit(w)).otherwise(F.lit(0.0))
        for p, w in scoring.QUALITY_WEIGHTS.items()
    )
    return F.round(earned / F.lit(total), 2)


def rescore(catalog: DataFrame) -> DataFrame:
    """Catalog with the stored score replaced; the old one is kept as ``old_score``."""
    old = F.col("meta.data_quality_score")
    blank = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.META.fields])
    return catalog.withColumn("old_score", old).withColumn("new_score", quality_score()).withColumn(
        "meta", F.coalesce(F.col("meta"), blank).withField("data_quality_score", F.col("new_score"))
    )


def rescore_summary(scored: DataFrame) -> DataFrame:
    """(scored, updated) of a rescoring run."""
    return scored.agg(
        F.count("*").alias("scored"),
        F.count_if(~F.col("old_score").eqNullSafe(F.col("new_score"))).alias("updated"),
    )


def low_quality(catalog: DataFrame, max_score: float = 0.6, limit: int | None = None) -> DataFrame:
    """(slug, new_score) of products that score at most ``max_score``; the first ``limit`` by file name if given."""
    scored = catalog.select("slug", quality_score().alias("new_score")).filter(F.col("new_score") <= max_score)
    return scored if limit is None else scored.orderBy(F.concat("slug", F.lit(".json"))).limit(limit)
