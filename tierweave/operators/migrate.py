"""Company-to-product and category/tag migrations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.fixed import geo, migration, tag_rules, taxonomy
from tierweave.functions import money, text, url
from tierweave.functions.base import blank_to_null, compact, lookup, strip, truthy


def is_archived() -> Column:
    """Listed slugs, and placeholder descriptions without any website."""
    bare = text.is_placeholder_description("description", "name") & ~truthy(strip("website"))
    return F.col("slug").isin(*migration.ARCHIVED_SLUGS) | F.coalesce(bare, F.lit(False))


def migrate_companies(companies: DataFrame, as_of: Column) -> DataFrame:
    """Products from company documents; archived companies are left out.

    Columns: slug, name, name_zh, description, description_zh, website, category, status,
    tags, open_source, founded_year, headquarters, social, funding, team(employee_count_range,
    founders[name,title,linkedin]), products[name,url], meta(added_date, sources[]).
    """
    today = as_of.cast("date")
    site = blank_to_null(strip("website"))
    social = F.col("social")
    first = F.try_element_at("products", F.lit(1))
    own_url = truthy(first["url"])
    name = F.when(own_url, F.coalesce(first["name"], F.col("name"))).otherwise(F.col("name"))
    searched = url.migrated_company_url(F.lit(None).cast("string"), social["crunchbase"], social["linkedin"], social["github"], "name")
    city, country = text.clean_text("headquarters.city"), text.clean_text("headquarters.country")
    country_shown = F.when(country != "Unknown", country)
    hq_fields = {
        "city": city, "state": blank_to_null(F.col("headquarters.state")), "country": country_shown,
        "country_code": blank_to_null(F.col("headquarters.country_code")),
    }
    links = {k: blank_to_null(strip(social[k])) for k in ("linkedin", "crunchbase", "twitter", "github")}
    kept_tags = F.filter("tags", lambda t: ~t.isin(*migration.SOURCE_TAGS))

    def struct_of(fields: dict[str, Column], present: Column) -> Column:
        return F.when(present, F.struct(*[v.alias(k) for k, v in fields.items()]))

    people = F.transform("team.founders", lambda f: F.struct(
        f["name"].alias("name"), blank_to_null(f["title"]).alias("title"), F.lit(True).alias("is_founder"),
        blank_to_null(f["linkedin"]).alias("profile_url"),
    ))
    sources = F.transform(
        F.filter("meta.sources", lambda s: strip(s) != ""),
        lambda s: F.struct(strip(s).alias("url"), F.lit("migration").alias("source_name"), today.alias("scraped_at")),
    )
    out = companies.filter(~is_archived()).select(
        "slug",
        name.alias("name"),
        F.coalesce(F.when(own_url, first["url"]), site, searched).alias("product_url"),
        F.coalesce(blank_to_null("description"), F.concat(name, F.lit(" is an AI product."))).alias("description"),
        text.map_product_type(F.coalesce("category", F.lit("ai-other"))).alias("product_type"),
        text.map_old_category(F.coalesce("category", F.lit("ai-other"))).alias("category"),
        text.map_status(F.coalesce("status", F.lit("active"))).alias("status"),
        blank_to_null("name_zh").alias("name_zh"),
        blank_to_null("description_zh").alias("description_zh"),
        text.map_sub_category("category").alias("sub_category"),
        F.when(F.size(kept_tags) > 0, kept_tags).alias("tags"),
        "open_source",
        blank_to_null(social["github"]).alias("repository_url"),
        F.struct(
            F.col("name").alias("name"),
            blank_to_null("name_zh").alias("name_zh"),
            url.migrated_company_url(F.col("website"), social["crunchbase"], social["linkedin"], social["github"], "name").alias("url"),
            site.alias("website"),
            F.lit(None).cast("string").alias("wikipedia_url"), F.lit(None).cast("string").alias("logo_url"),
            F.lit(None).cast("string").alias("description"),
            money.clean_founded_year("founded_year", as_of).alias("founded_year"),
            struct_of(hq_fields, F.coalesce(city, country).isNotNull() & F.coalesce(*hq_fields.values()).isNotNull()).alias("headquarters"),
            F.col("funding").alias("funding"),
            blank_to_null("team.employee_count_range").alias("employee_count_range"),
            struct_of(links, F.coalesce(*links.values()).isNotNull()).alias("social"),
        ).alias("company"),
        F.when(F.size(people) > 0, people).alias("key_people"),
        F.when(F.size(sources) > 0, sources).alias("sources"),
        F.struct(
            F.coalesce(F.col("meta.added_date"), today).alias("added_date"), today.alias("last_updated"),
            F.lit(0.0).alias("data_quality_score"), F.lit(True).alias("needs_review"),
            F.lit(None).cast(schemas.META["provenance"].dataType).alias("provenance"),
        ).alias("meta"),
    )
    return schemas.conform(out, schemas.PRODUCT)


def route_archive(companies: DataFrame) -> DataFrame:
    """Companies with ``target``: archive or products. Write with ``partitionBy('target')``."""
    return companies.withColumn("target", F.when(is_archived(), "archive").otherwise("products"))


def stamp_seed(companies: DataFrame, as_of: Column) -> DataFrame:
    """Seed companies with their bookkeeping block."""
    today = as_of.cast("date")
    return companies.withColumn("meta", F.struct(
        today.alias("added_date"), today.alias("last_updated"), F.array("website").alias("sources"),
        F.lit(0.8).alias("data_quality_score"),
    ))


# ---------------------------------------------------------------- taxonomy


def new_category(category: Column, sub_category: Column, tags: Column) -> Column:
    """Current category of an earlier one; current ones pass."""
    media = sub_category.isin(*migration.MEDIA_SUB_CATEGORIES) | F.arrays_overlap(
        F.coalesce(tags, F.array().cast("array<string>")), F.array(*[F.lit(t) for t in migration.MEDIA_TAGS])
    )
    platform = sub_category.isin(*migration.AGENT_PLATFORM_SUB_CATEGORIES)
    vertical = sub_category.isin(*migration.VERTICAL_SUB_CATEGORIES)
    return (
        F.when(category.isin(*taxonomy.CATEGORY_IDS), category)
        .when(category.isin(*migration.CATEGORY_RENAMES), lookup(category, migration.CATEGORY_RENAMES))
        .when((category == "ai-model") & media, "ai-creative-media")
        .when(category == "ai-model", "ai-foundation-model")
        .when((category == "ai-app") & vertical, "ai-enterprise-vertical")
        .when((category == "ai-agent") & platform, "ai-dev-platform")
        .otherwise("ai-application")
    )


def mapped_tags(tags: Column) -> Column:
    """Renamed, valid tags in order; dropped and unknown ones fall out."""
    known = F.filter(
        F.transform(tags, lambda t: lookup(t, migration.TAG_RENAMES, t)),
        lambda t: t.isin(*taxonomy.TAG_IDS),
    )
    return F.array_distinct(known)


def added_tags(existing: Column) -> Column:
    """Tags implied by the product's fields that it does not carry yet."""
    def absent(tag: str) -> Column:
        return ~F.array_contains(existing, tag)

    arch = F.lower(F.coalesce("architecture", F.lit("")))
    country = F.col("company.headquarters.country")
    worth = F.coalesce(F.col("company.funding.valuation_usd"), F.lit(0.0))
    model = F.col("pricing.model")

    def tag(test: Column, name: str) -> Column:
        return F.when(test & absent(name), F.lit(name))

    return compact(
        tag(F.col("open_source"), "open-source"),
        F.when((model == "freemium") & absent("freemium"), "freemium").when((model == "open-source") & absent("open-source"), "open-source"),
        *[tag(country == c, t) for c, t in geo.COUNTRY_TAGS.items()],
        tag(country.isin(*geo.EUROPE), "europe"),
        F.when((worth >= tag_rules.DECACORN_USD) & absent("decacorn"), "decacorn").when(
            (worth >= tag_rules.UNICORN_USD) & absent("unicorn"), "unicorn"),
        F.when(F.col("api_available") & absent("api-platform") & absent("api-service"), "api-service"),
        tag(arch.contains("transformer"), "transformer"),
        tag(arch.contains("moe") | arch.contains("mixture"), "moe"),
        tag(arch.contains("diffusion"), "diffusion-model"),
        tag(F.size("modalities") > 1, "multimodal"),
    )


def migrate_taxonomy(catalog: DataFrame) -> DataFrame:
    """Catalog with current category and tags; ``old_category`` and ``old_tags`` kept."""
    none = F.array().cast("array<string>")
    out = catalog.withColumn("old_category", F.coalesce("category", F.lit(""))).withColumn("old_tags", F.coalesce("tags", none))
    out = out.withColumn("category", new_category(F.col("old_category"), F.coalesce("sub_category", F.lit("")), F.col("old_tags")))
    out = out.withColumn("_mapped", mapped_tags(F.col("old_tags")))
    return out.withColumn("tags", F.array_distinct(F.concat("_mapped", added_tags(F.col("_mapped"))))).drop("_mapped")


def taxonomy_changes(migrated: DataFrame) -> DataFrame:
    """Per category transition: products, changed ones, tags added and removed."""
    changed = (F.col("old_category") != F.col("category")) | (F.col("old_tags") != F.col("tags"))
    return migrated.groupBy("old_category", "category").agg(
        F.count("*").alias("products"),
        F.count_if(changed).alias("changed"),
        F.sum(F.size(F.array_except("tags", "old_tags"))).alias("tags_added"),
        F.sum(F.size(F.array_except("old_tags", "tags"))).alias("tags_removed"),
    )

