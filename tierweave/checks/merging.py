"""Tiered merge, creation, set operations and provenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.bindings import CATALOG, INCOMING, PART_CATALOG, RECORDS
from tierweave.checks.functions import as_of
from tierweave.checks.registry import AS_OF, bound, in_list, query
from tierweave.fixed.scoring import HIRING_PATHS
from tierweave.operators import merge, resolve

W = "WITH " + bound(PART_CATALOG, "p") + ", " + bound(RECORDS, "r") + " "
PATHS = ("description", "category", "company.funding.total_raised_usd")

LONG_SQL = """(SELECT slug, 'description' AS path, description AS value, source_tier AS tier, seq, source FROM r WHERE description IS NOT NULL
 UNION ALL SELECT slug, 'category', category, source_tier, seq, source FROM r WHERE category IS NOT NULL
 UNION ALL SELECT slug, 'company.funding.total_raised_usd', CAST(company_total_raised_usd AS VARCHAR), source_tier, seq, source FROM r WHERE company_total_raised_usd IS NOT NULL)"""


@query("n5_to_long", W + f"SELECT slug, path, tier, seq, source, CASE WHEN path = 'company.funding.total_raised_usd' THEN 'n' ELSE value END AS value FROM {LONG_SQL}")
def _(t):
    long = merge.to_long(t.records.select("slug", "seq", "source", "source_tier", "description", "category", "company_total_raised_usd"))
    return long.withColumn("value", F.when(F.col("path") == PATHS[2], "n").otherwise(F.col("value")))


def _long(t):
    return merge.to_long(t.records.select("slug", "seq", "source", "source_tier", "description", "category", "company_total_raised_usd"))


@query("n5_to_long_values", W + f"SELECT slug, path, tier, seq, source, value FROM {LONG_SQL}")
def _(t):
    return _long(t)


@query("p5_field_allowed", W + f"SELECT slug, path, seq, tier <> 4 OR path IN {in_list(HIRING_PATHS)} AS allowed FROM (SELECT slug, seq, source_tier AS tier, unnest(['description', 'hiring.positions']) AS path FROM r)")
def _(t):
    long = t.records.select("slug", "seq", "source_tier", F.explode(F.array(F.lit("description"), F.lit("hiring.positions"))).alias("path"))
    return long.select("slug", "path", "seq", merge.field_allowed(F.col("path"), "source_tier").alias("allowed"))


WIN_SQL = f"(SELECT slug, path, arg_min(value, ord) AS value, arg_min(tier, ord) AS tier, arg_min(source, ord) AS source FROM (SELECT *, {{'t': tier, 's': seq}} AS ord FROM {LONG_SQL} WHERE tier <> 4) GROUP BY ALL)"


@query("w3_tier_winner", W + f"SELECT slug, path, tier, source, CASE WHEN path = 'company.funding.total_raised_usd' THEN 'n' ELSE value END AS value FROM {WIN_SQL}")
def _(t):
    long = merge.to_long(t.records.select("slug", "seq", "source", "source_tier", "description", "category", "company_total_raised_usd"))
    return merge.winners(long).withColumn("value", F.when(F.col("path") == PATHS[2], "n").otherwise(F.col("value")))


@query("w3_tier_winner_values", W + f"SELECT slug, path, tier, source, value FROM {WIN_SQL}")
def _(t):
    return merge.winners(_long(t))


@query("n6_pivot_winners_values", W + "SELECT slug, " + ", ".join(f"max(CASE WHEN path = '{p}' THEN value END) AS {p.replace('.', '_')}" for p in PATHS) + f" FROM {WIN_SQL} GROUP BY slug")
def _(t):
    return merge.pivot_winners(merge.winners(_long(t)), list(PATHS))


@query("n6_pivot_winners", W + f"SELECT slug, max(CASE WHEN path = 'description' THEN value END) AS description, max(CASE WHEN path = 'category' THEN value END) AS category FROM {WIN_SQL} WHERE path <> 'company.funding.total_raised_usd' GROUP BY slug")
def _(t):
    long = merge.to_long(t.records.select("slug", "seq", "source", "source_tier", "description", "category"))
    return merge.pivot_winners(merge.winners(long), ["description", "category"])


def _merged_sql(path: str, old: str, numeric: bool = False) -> str:
    """New value, owner tier and owner source of one path."""
    empty = f"{old} IS NULL" + ("" if numeric else f" OR {old} = ''")
    takes = f"w_{path}.tier IS NOT NULL AND (owner_tier IS NULL OR w_{path}.tier < owner_tier) AND (w_{path}.tier <> 3 OR {empty})"
    new = f"CAST(w_{path}.value AS DOUBLE)" if numeric else f"w_{path}.value"
    return f"CASE WHEN {takes} THEN {new} ELSE {old} END AS {path}, CASE WHEN {takes} THEN w_{path}.tier ELSE owner_tier END AS {path}_tier, CASE WHEN {takes} THEN w_{path}.source WHEN owner_tier IS NOT NULL THEN 'seed' END AS {path}_source"


ITEMS_SQL = """(SELECT slug, tag, min(o) AS first, max(o) AS last FROM (
  SELECT slug, string_split(tags_text, '|')[1] AS tag, {'s': seq, 'p': 0} AS o, source_tier FROM r UNION ALL
  SELECT slug, string_split(tags_text, '|')[2] AS tag, {'s': seq, 'p': 1} AS o, source_tier FROM r) WHERE source_tier <> 4 GROUP BY ALL)"""
OLD_TAGS = "CASE WHEN tags_text <> '' THEN string_split(tags_text, '|') ELSE []::VARCHAR[] END"
TAGS_SQL = f"SELECT p.slug, list_concat(any_value({OLD_TAGS}), coalesce(list(i.tag ORDER BY i.first) FILTER (WHERE i.tag IS NOT NULL AND NOT list_contains({OLD_TAGS}, i.tag)), []::VARCHAR[]))[1:20] AS tags FROM p LEFT JOIN {ITEMS_SQL} i USING (slug) GROUP BY p.slug"
_wj = "LEFT JOIN (SELECT * FROM {win} WHERE path = '{path}') w_{name} ON w_{name}.slug = p.slug"
MERGED_SQL = (
    "SELECT p.slug, " + _merged_sql("description", "p.description") + ", " + _merged_sql("category", "p.category") + ", " + _merged_sql("funding", "p.total_raised_usd", True)
    + ", array_to_string(g.tags, '|') AS tags, n.sources, n.company_url FROM p "
    + " ".join(_wj.format(win="won", path=path, name=name) for path, name in zip(PATHS, ("description", "category", "funding")))
    + f" LEFT JOIN ({TAGS_SQL}) g ON g.slug = p.slug LEFT JOIN (SELECT slug, count(DISTINCT source_url) AS sources, "
    + "'https://www.bing.com/search?q=' || replace(arg_min(name, seq), ' ', '+') || '+AI' AS company_url FROM r GROUP BY slug) n ON n.slug = p.slug"
)


@query("c1_tiered_merge", W + f", won AS {WIN_SQL} " + MERGED_SQL)
def _(t):
    m = merge.tiered_merge(t.part_catalog, t.records, as_of())

    def owner(path, what):
        return F.try_element_at(F.col("meta.provenance"), F.lit(path))[what]

    out = [F.col("slug"), F.col("description"), F.col("category"), F.col("company.funding.total_raised_usd").alias("funding")]
    for path, name in zip(PATHS, ("description", "category", "funding")):
        out += [owner(path, "tier").alias(f"{name}_tier"), owner(path, "source").alias(f"{name}_source")]
    sources = F.when(F.size("sources") > 0, F.size("sources").cast("bigint"))
    return m.select(*out, F.array_join(F.coalesce("tags", F.array().cast("array<string>")), "|").alias("tags"), sources.alias("sources"), F.col("company.url").alias("company_url"))


C2 = "WITH " + bound(INCOMING, "r") + " "


def _new_records(t):
    return t.incoming.withColumn("slug", F.concat(F.lit("new-"), "seq"))


@query("c2_create_products", C2 + f"""SELECT 'new-' || seq AS slug, name, coalesce(product_url, '') AS product_url, coalesce(nullif(description, ''), name || ' is an AI product.') AS description,
  'other' AS product_type, coalesce(nullif(category, ''), 'ai-application') AS category, 'active' AS status, name AS company_name,
  coalesce(nullif(company_website, ''), 'https://www.bing.com/search?q=' || replace(replace(replace(url_encode(name), '%20', '+'), '.', '.'), '%2A', '*') || '+AI') AS company_url,
  company_founded_year AS founded_year, nullif(company_headquarters_country, '') AS country, company_total_raised_usd AS raised, nullif(company_employee_count_range, '') AS employees,
  source_url, DATE '{AS_OF}' AS added_date, source_tier AS name_tier, company_total_raised_usd IS NOT NULL AS funding_owned FROM r""")
def _(t):
    p = merge.create_products(_new_records(t), as_of())
    own = F.col("meta.provenance")
    return p.select(
        "slug", "name", "product_url", "description", "product_type", "category", "status", F.col("company.name").alias("company_name"), F.col("company.url").alias("company_url"),
        F.col("company.founded_year").alias("founded_year"), F.col("company.headquarters.country").alias("country"), F.col("company.funding.total_raised_usd").alias("raised"),
        F.col("company.employee_count_range").alias("employees"), F.col("sources")[0]["url"].alias("source_url"), F.col("meta.added_date").alias("added_date"),
        F.try_element_at(own, F.lit("name"))["tier"].alias("name_tier"), F.map_contains_key(own, "company.funding").alias("funding_owned"))


@query("c3_merge_or_create", W + ", known AS (SELECT * FROM p WHERE owner_tier IS NOT NULL) SELECT slug FROM known UNION SELECT slug FROM r")
def _(t):
    known = t.part_catalog.filter(F.col("meta.provenance").isNotNull())
    return merge.merge_or_create(known, t.records, as_of()).select("slug")


@query("n1_ordered_union", "SELECT p_partkey, array_to_string(list_concat([p_type, 'x'], list_filter([p_name, p_type, 'y'], lambda v: v NOT IN (p_type, 'x')))[1:3], '|') AS tags FROM part")
def _(t):
    return t.part.select("p_partkey", F.array_join(merge.ordered_union(F.array("p_type", F.lit("x")), F.array("p_name", "p_type", F.lit("y")), 3), "|").alias("tags"))


@query("n2_provenance_upsert", W + "SELECT slug, CASE WHEN owner_tier IS NULL THEN 1 ELSE 3 END AS entries, 1 AS category_tier, owner_tier AS description_tier FROM p")
def _(t):
    entry = F.struct(F.lit("new").alias("source"), F.lit(1).alias("tier"), F.lit(0.95).alias("confidence"), as_of().alias("updated_at"))
    out = merge.upsert_provenance(F.col("meta.provenance"), F.create_map(F.lit("category"), entry))
    return t.part_catalog.select("slug", out.alias("m")).select(
        "slug", F.size("m").alias("entries"), F.try_element_at("m", F.lit("category"))["tier"].alias("category_tier"), F.try_element_at("m", F.lit("description"))["tier"].alias("description_tier"))


@query("n3_initial_provenance", "WITH " + bound(CATALOG, "c") + """ SELECT slug, array_to_string(list_sort(list_filter(['name', 'product_url', 'company.name', 'company.url', 'company.headquarters', 'status',
  CASE WHEN name_zh <> '' THEN 'name_zh' END, CASE WHEN description <> '' THEN 'description' END, CASE WHEN description_zh <> '' THEN 'description_zh' END, CASE WHEN category <> '' THEN 'category' END,
  CASE WHEN sub_category <> '' THEN 'sub_category' END, CASE WHEN product_type <> '' THEN 'product_type' END, CASE WHEN tags_text <> '' THEN 'tags' END, CASE WHEN modalities_text <> '' THEN 'modalities' END,
  CASE WHEN platforms_text <> '' THEN 'platforms' END, CASE WHEN architecture <> '' THEN 'architecture' END, CASE WHEN pricing_model IS NOT NULL THEN 'pricing' END, CASE WHEN open_source IS NOT NULL THEN 'open_source' END,
  CASE WHEN api_available IS NOT NULL THEN 'api_available' END, CASE WHEN repository_url <> '' THEN 'repository_url' END, CASE WHEN company_website <> '' THEN 'company.website' END,
  CASE WHEN founded_year IS NOT NULL THEN 'company.founded_year' END, CASE WHEN employee_count_range <> '' THEN 'company.employee_count_range' END,
  CASE WHEN coalesce(total_raised_usd, valuation_usd) IS NOT NULL OR last_round IS NOT NULL THEN 'company.funding' END], lambda x: x IS NOT NULL)), ',') AS paths FROM c""")
def _(t):
    row = F.struct(*[F.col(f.name) for f in schemas.PRODUCT.fields if f.name != "meta"])
    return t.catalog.select("slug", F.array_join(F.array_sort(F.map_keys(merge.initial_provenance(F.lit(1), row))), ",").alias("paths"))


@query("n4_append_source", "WITH " + bound(CATALOG, "c") + " SELECT slug, CASE WHEN source_link IS NULL THEN 1 WHEN source_link = 'https://src.example.org/' || c_custkey THEN 1 ELSE 2 END AS n FROM c")
def _(t):
    keys = t.flat_catalog.select("slug", "c_custkey")
    c = t.catalog.join(keys, "slug")
    url = F.concat(F.lit("https://src.example.org/"), "c_custkey")
    return c.select("slug", F.size(merge.append_source(F.col("sources"), url, F.lit("s"), as_of())).alias("n"))


@query("u1_union_sources", "SELECT 'orders' AS source, o_orderkey AS key FROM orders UNION ALL SELECT 'parts', p_partkey FROM part")
def _(t):
    from tierweave.sources.registry import union_records

    a = t.orders.select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("seq"), F.lit("a").alias("name"))
    b = t.part.select(F.lit("parts").alias("source"), F.col("p_partkey").alias("seq"), F.col("p_name").alias("name"))
    both = union_records([schemas.conform(a, schemas.RECORD), schemas.conform(b, schemas.RECORD)])
    return both.select("source", F.col("seq").alias("key"))


@query("u2_new_and_updates", "WITH " + bound(INCOMING, "r") + """ SELECT CASE WHEN s IS NULL THEN 'new' ELSE 'update' END AS kind, seq FROM (
  SELECT r.seq, max(c.c_custkey) AS s FROM r LEFT JOIN customer c ON lower(r.name) = lower(c.c_name) GROUP BY r.seq)""")
def _(t):
    hit = resolve.match_by(t.incoming, t.catalog, "name")
    new, updates = resolve.split_new_and_updates(t.incoming.join(hit, "seq", "left").withColumn("match_rule", F.lit("name")))
    return new.select(F.lit("new").alias("kind"), "seq").unionByName(updates.select(F.lit("update").alias("kind"), "seq"))


@query("u3_upsert", "SELECT concat('customer-', c_custkey) AS slug, CASE WHEN c_custkey % 3 = 0 THEN 'changed' ELSE c_name END AS name FROM customer UNION ALL SELECT concat('added-', c_custkey), 'changed' FROM customer WHERE c_custkey % 3 = 0")
def _(t):
    keys = t.flat_catalog.select("slug", "c_custkey")
    base = t.catalog
    some = base.join(keys.filter("c_custkey % 3 = 0").select("slug"), "slug", "left_semi").withColumn("name", F.lit("changed"))
    added = some.withColumn("slug", F.replace("slug", F.lit("customer"), F.lit("added")))
    return merge.upsert(base, some.unionByName(added)).select("slug", "name")

