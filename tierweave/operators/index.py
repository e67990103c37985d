"""Flat index, facets, pages and the compare view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.fixed.scoring import INDEX_COLUMNS
from tierweave.functions.base import blank_to_null, truthy
from tierweave.functions.money import format_currency, format_round
from tierweave.functions.text import humanize_label, localized
from tierweave.operators.ranking import positions

PAGE_SIZE = 12
NO_DATA = "-"


def index_projection(catalog: DataFrame) -> DataFrame:
    """Index columns: 13 copied, 9 flattened out of the company."""
    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    def amount(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(0.0))

    return catalog.select(
        *INDEX_COLUMNS,
        text("company.name").alias("company_name"),
        text("company.url").alias("company_url"),
        text("company.headquarters.country").alias("country"),
        text("company.headquarters.country_code").alias("country_code"),
        text("company.headquarters.city").alias("city"),
        amount("company.funding.total_raised_usd").alias("total_raised_usd"),
        text("company.funding.last_round").alias("last_round"),
        amount("company.funding.valuation_usd").alias("valuation_usd"),
        text("company.employee_count_range").alias("employee_count_range"),
    )


def file_order() -> Column:
    """Order of product file names: ``a-b.json`` sorts before ``a.json``."""
    return F.concat("slug", F.lit(".json"))


def build_index(catalog: DataFrame) -> DataFrame:
    """Index rows by funding, largest first, then name."""
    return index_projection(catalog).orderBy(F.desc("total_raised_usd"), F.coalesce("name", F.lit("")), file_order())


def filter_index(index: DataFrame, category: str | None = None, country: str | None = None) -> DataFrame:
    out = index
    if category:
        out = out.filter(F.col("category") == category)
    if country:
        out = out.filter(F.col("country") == country)
    return out


def grid_order(by: str, locale_order: bool = False) -> list[Column]:
    """Sort keys of the product grid."""
    if by == "name":
        name = F.collate("name", "UNICODE") if locale_order else F.col("name")
        return [name.asc(), file_order()]
    return [F.desc(F.coalesce("total_raised_usd", F.lit(0.0))), file_order()]


def tab_counts(index: DataFrame) -> DataFrame:
    """Products per category, plus a NULL row for all."""
    return index.rollup("category").agg(F.count("*").alias("count"), F.grouping("category").alias("all")).filter(
        (F.col("all") == 1) | F.col("category").isNotNull()
    ).select(F.when(F.col("all") == 1, F.lit("All")).otherwise(F.col("category")).alias("category"), "count")


def country_facets(index: DataFrame) -> DataFrame:
    """Distinct non-empty countries, sorted."""
    return index.filter(truthy("country")).select("country").distinct().orderBy("country")


def page_of(index: DataFrame, page: int, by: str = "funding") -> DataFrame:
    """One page of the grid."""
    return index.orderBy(*grid_order(by)).offset((page - 1) * PAGE_SIZE).limit(PAGE_SIZE)


def with_pages(index: DataFrame, order: list[Column]) -> DataFrame:
    """Every row with its page number; slugs must be distinct."""
    return index.join(positions(index, order), "slug").withColumn("page", F.ceil(F.col("rn") / PAGE_SIZE)).drop("rn")


def page_strip(current: Column, total: Column) -> Column:
    """Page numbers shown around the current one."""
    return F.sequence(F.greatest(F.lit(1), current - 2), F.least(total, current + 2))


def select_for_compare(index: DataFrame, slugs: list[str]) -> DataFrame:
    """The chosen products, at most three."""
    return index.filter(F.col("slug").isin(*slugs[:3]))


COMPARE_FIELDS = (
    "category", "product_type", "country", "city", "total_raised", "valuation", "last_round",
    "employees", "open_source",
)


def compare_table(index: DataFrame, slugs: list[str]) -> DataFrame:
    """(field, one text column per product) of the compare view."""
    def money(c: str) -> Column:
        return F.when(F.coalesce(F.col(c), F.lit(0.0)) != 0, format_currency(c)).otherwise(NO_DATA)

    def shown(c: Column) -> Column:
        return F.coalesce(blank_to_null(c), F.lit(NO_DATA))

    values = {
        "category": F.replace("category", F.lit("-"), F.lit(" ")),
        "product_type": shown(F.col("product_type")),
        "country": F.col("country"),
        "city": F.col("city"),
        "total_raised": money("total_raised_usd"),
        "valuation": money("valuation_usd"),
        "last_round": F.when(truthy("last_round"), format_round("last_round")).otherwise(NO_DATA),
        "employees": shown(F.col("employee_count_range")),
        "open_source": F.when(F.col("open_source"), "Yes").otherwise("No"),
    }
    rows = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(f).alias("field"), values[f].alias("value"))
        for i, f in enumerate(COMPARE_FIELDS)
    ])
    long = select_for_compare(index, slugs).select("slug", F.explode(rows).alias("r")).select("slug", "r.*")
    return long.groupBy("ord", "field").pivot("slug", slugs[:3]).agg(F.first("value")).orderBy("ord").drop("ord")


def typeahead(index: DataFrame, term: str, selected: list[str], limit: int = 5) -> DataFrame:
    """First products whose name holds the term and that are not selected yet."""
    if not term.strip():
        return index.limit(0)
    low = F.lit(term.lower())
    hit = F.contains(F.lower("name"), low) | F.coalesce(F.contains("name_zh", low), F.lit(False))
    left = index.filter(~F.col("slug").isin(*selected)) if selected else index
    return left.filter(hit).orderBy(*grid_order("funding")).limit(limit)


def point_lookup(catalog: DataFrame, slug: str) -> DataFrame:
    """The product of one slug; nothing for a malformed slug."""
    import re

    from tierweave.functions.text import SLUG_PATTERN

    if not re.match(SLUG_PATTERN, slug or ""):
        return catalog.filter(F.lit(False))
    return catalog.filter(F.col("slug") == slug)


def list_slugs(catalog: DataFrame) -> DataFrame:
    return catalog.select("slug").distinct()


def card_tags(tags: Column) -> Column:
    return F.slice(tags, 1, 3)


def category_label(products: DataFrame, categories: DataFrame, locale: str = "en", category: str = "category") -> DataFrame:
    """Products with the ``label`` of their category in a language.

    ``categories``: id, name, name_zh, a list of fixed size. A category that is not listed shows its
    id with blanks for hyphens; a product without one shows nothing.
    """
    listed = F.broadcast(categories.select(F.col("id").alias("_id"), localized("name", "name_zh", locale).alias("_label")))
    shown = F.coalesce(blank_to_null("_label"), humanize_label(category), F.lit(""))
    return products.join(listed, F.col(category) == F.col("_id"), "left").withColumn("label", shown).drop("_id", "_label")
