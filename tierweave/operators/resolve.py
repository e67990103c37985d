"""Entity resolution: which catalog product a record describes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.functions.base import blank_to_null, compact, truthy
from tierweave.functions.text import slugify
from tierweave.functions.url import extract_domain
from tierweave.operators.similarity import fuzzy_name_match
from tierweave.session import cut_lineage, spread

# Rule names in order of precedence.
RULES = (
    "product_domain", "company_domain", "name", "name_zh", "cross_lingual", "fuzzy_name", "slug",
)


def _filled(df: DataFrame, owner: str, inputs: list[str], values: dict[str, Column], heads: list[dict[str, str | int]]) -> DataFrame:
    """(owner, heads, key) of every value that is not empty.

    Rows are spread first, and the values become columns before they are tested: written out in
    the tests, Spark computes each of them three times.
    """
    computed = spread(df.select(owner, *inputs)).select(owner, *[v.alias(k) for k, v in values.items()])
    keys = compact(*[
        F.when(truthy(c), F.struct(*[F.lit(v).alias(k) for k, v in head.items()], F.col(c).alias("key")))
        for c, head in zip(values, heads)
    ])
    return computed.select(owner, F.explode(keys).alias("x")).select(owner, "x.*")


def catalog_keys(catalog: DataFrame) -> DataFrame:
    """(kind, key) -> slug for every equality rule; the highest slug owns a shared key."""
    kinds = {
        "domain": extract_domain("product_url"), "site": extract_domain("website"), "named": F.lower("name"),
        "zh": F.col("name_zh"), "zh_lower": F.lower("name_zh"), "own": F.col("slug"),
    }
    heads = [{"kind": k} for k in ("domain", "domain", "name", "zh", "zh_lower", "slug")]
    flat = catalog.select("slug", "product_url", F.col("company.website").alias("website"), "name", "name_zh")
    keys = _filled(flat, "slug", ["product_url", "website", "name", "name_zh"], kinds, heads)
    return keys.groupBy("kind", "key").agg(F.max("slug").alias("match_slug"))


def _probes(records: DataFrame, shared_hosts) -> DataFrame:
    def domain(c: str) -> Column:
        d = extract_domain(c)
        return F.when(~d.isin(*shared_hosts), d) if shared_hosts else d

    values = {
        "product_domain": domain("product_url"), "company_domain": domain("company_website"), "same_name": F.lower("name"),
        "same_zh": F.col("name_zh"), "cross_lingual": F.lower("name"), "spelled": slugify("name"),
    }
    heads = [{"rule": RULES.index(r), "kind": k} for r, k in (
        ("product_domain", "domain"), ("company_domain", "domain"), ("name", "name"),
        ("name_zh", "zh"), ("cross_lingual", "zh_lower"), ("slug", "slug"),
    )]
    return _filled(records, "seq", ["product_url", "company_website", "name", "name_zh"], values, heads)


def resolve(records: DataFrame, catalog: DataFrame, fuzzy: bool = True, shared_hosts: tuple[str, ...] = ()) -> DataFrame:
    """Records with ``match_slug`` and ``match_rule``; NULL for new entities.

    The six equality rules are one join on (kind, key), so their number does not add
    shuffles. Only names that no earlier rule placed enter the similarity join.
    """
    hits = _probes(records, shared_hosts).join(catalog_keys(catalog), ["kind", "key"])
    fuzzy_rule = RULES.index("fuzzy_name")
    exact = hits.groupBy("seq").agg(F.min_by(F.struct("rule", "match_slug"), F.struct("rule")).alias("m")).select("seq", "m.*")
    if fuzzy:
        exact = cut_lineage(exact)
        named = records.select("seq", F.lower("name").alias("name"))
        placed = exact.filter(F.col("rule") < fuzzy_rule).select("seq")
        left = named.join(placed, "seq", "left_anti")
        # read again by every step of the name join
        left = cut_lineage(left)
        similar = fuzzy_name_match(left, catalog.select(F.lower("name").alias("name"), "slug"))
        found = left.join(similar, "name").select("seq", F.lit(fuzzy_rule).alias("rule"), F.col("slug").alias("match_slug"))
        exact = exact.unionByName(found).groupBy("seq").agg(
            F.min_by(F.struct("rule", "match_slug"), F.struct("rule")).alias("m")
        ).select("seq", "m.*")
    names = F.array(*[F.lit(r) for r in RULES])
    return records.join(exact, "seq", "left").withColumn("match_rule", F.get(names, F.col("rule"))).drop("rule")


def match_by(records: DataFrame, catalog: DataFrame, rule: str) -> DataFrame:
    """(seq, match_slug) of one equality rule alone."""
    hits = _probes(records, ()).filter(F.col("rule") == RULES.index(rule))
    return hits.join(catalog_keys(catalog), ["kind", "key"]).select("seq", "match_slug")


def split_new_and_updates(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new, updates); an update carries the slug it goes to."""
    new = resolved.filter(F.col("match_slug").isNull()).drop("match_slug", "match_rule")
    updates = resolved.filter(F.col("match_slug").isNotNull()).withColumnRenamed("match_slug", "slug").drop("match_rule")
    return new, updates


def collapse_key() -> Column:
    """Domain of the website or product URL, else the trimmed lower-case name."""
    url = F.coalesce(blank_to_null("company_website"), blank_to_null("product_url"))
    return F.coalesce(blank_to_null(extract_domain(url)), F.btrim(F.lower("name")))


def _is_set(c: str, dtype) -> Column:
    from pyspark.sql import types as T

    v = F.col(c)
    if isinstance(dtype, T.StringType):
        return truthy(v)
    if isinstance(dtype, T.BooleanType):
        return v
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(v) > 0
    if isinstance(dtype, T.NumericType):
        return v != 0
    return v.isNotNull()


def collapse_listings(records: DataFrame) -> DataFrame:
    """One record per entity: first filled value per field, tags united in order.

    Name, source and source link stay those of the first listing.
    """
    keyed = records.withColumn("entity_key", collapse_key())
    aggs = []
    for f in records.schema.fields:
        if f.name in ("seq", "tags"):
            continue
        first = F.min_by(F.col(f.name), "seq")
        if f.name not in ("name", "source", "source_url"):
            filled = F.coalesce(_is_set(f.name, f.dataType), F.lit(False))
            first = F.coalesce(F.min_by(F.when(filled, F.col(f.name)), F.when(filled, F.col("seq"))), first)
        aggs.append(first.alias(f.name))
    merged = keyed.groupBy("entity_key").agg(F.min("seq").alias("seq"), *aggs)
    if "tags" not in records.columns:
        return merged.drop("entity_key")
    # repeats collapse per (entity, tag) first, so only distinct tags are gathered
    tags = (
        keyed.select("entity_key", "seq", F.posexplode("tags").alias("pos", "tag"))
        .groupBy("entity_key", "tag").agg(F.min(F.struct("seq", "pos")).alias("at"))
        .groupBy("entity_key").agg(F.array_sort(F.collect_list(F.struct("at", "tag"))).alias("t"))
        .select("entity_key", F.col("t.tag").alias("tags"))
    )
    return merged.join(tags, "entity_key", "left").drop("entity_key")


def fold_leaderboard(entries: DataFrame) -> DataFrame:
    """(page, pos, model, benchmark, score, paper_url) -> one row per model.

    The last page's score of a benchmark counts; name and first paper link are the earliest.
    """
    key = F.btrim(F.lower("model")).alias("model_key")
    scores = entries.groupBy(key, "benchmark").agg(F.max_by("score", F.struct("page", "pos")).alias("score"))
    maps = scores.groupBy("model_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("benchmark", "score")))).alias("benchmarks"))
    linked = truthy("paper_url")
    order = F.struct("page", "pos")
    names = entries.groupBy(key).agg(
        F.min_by("model", order).alias("model"),
        F.min_by(F.when(linked, F.col("paper_url")), F.when(linked, order)).alias("paper_url"),
    )
    return names.join(maps, "model_key")
