"""Catalog-shaped operators: index, filters, sorts, pages, quality, gaps, migration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave.bindings import CATALOG, INCOMING
from tierweave.checks.functions import SLUG_SQL, as_of
from tierweave.checks.registry import AS_OF, bound, case_map, in_list, list_lit, lit, query
from tierweave.fixed import geo, migration, scoring, taxonomy
from tierweave.functions.base import blank_to_null
from tierweave.operators import gaps, index, migrate, normalize, ranking, tags, validate
from tierweave.session import spread
from tierweave.sources.catalog_io import load_categories

WITH = "WITH " + bound(CATALOG, "c") + " "
FILE = "slug || '.json'"


def flat_index(t):
    return index.index_projection(t.catalog)


# ---------------------------------------------------------------- scans

@query("s2_corrupt_records", "SELECT event_id, '{' || props AS body FROM events WHERE event_id % 17 = 0")
def _(t):
    from tierweave.sources.catalog_io import corrupt_bodies

    body = F.expr("CASE WHEN event_id % 17 = 0 THEN concat('{', props) ELSE props END")
    return corrupt_bodies(t.events.select("event_id", body.alias("body")), "k long")


@query("s3_show", "SELECT slug, name, product_url FROM (" + WITH + "SELECT * FROM c) WHERE slug = 'customer-42'")
def _(t):
    return index.point_lookup(t.catalog, "customer-42").select("slug", "name", "product_url")


@query("s4_list_slugs", "SELECT DISTINCT concat('customer-', c_custkey) AS slug FROM customer")
def _(t):
    return index.list_slugs(t.catalog)


ARCHIVE_SQL = f"s IN {in_list(migration.ARCHIVED_SLUGS)} OR (c_custkey % 4 = 0 AND c_custkey % 3 = 0)"


def _companies(t):
    """Customers as company documents of the earlier format."""
    slug_list = F.array(*[F.lit(s) for s in migration.ARCHIVED_SLUGS])
    k = F.col("c_custkey")
    null = F.lit(None).cast("string")
    return t.flat_catalog.select(
        F.when(k < 28, F.get(slug_list, k.cast("int"))).otherwise(F.col("slug")).alias("slug"),
        "c_custkey", "name", "name_zh",
        F.when(k % 4 == 0, F.concat("name", F.lit(" is an AI company."))).otherwise(F.col("description")).alias("description"),
        "description_zh",
        F.when(k % 3 != 0, F.concat(F.lit(" https://c"), k % 997, F.lit(".example.com "))).alias("website"),
        F.get(F.array(*[F.lit(c) for c in migration.OLD_CATEGORY]), (k % 20).cast("int")).alias("category"),
        F.get(F.array(*[F.lit(c) for c in migration.OLD_STATUS]), (k % 5).cast("int")).alias("status"),
        F.array(F.lit("linkedin"), F.concat(F.lit("t"), (k % 3).cast("string"))).alias("tags"),
        "open_source", F.col("founded_year"),
        F.struct(F.concat("city", F.lit(" 3 days ago")).alias("city"), null.alias("state"), F.col("country"), F.col("country_code")).alias("headquarters"),
        F.struct(F.when(k % 2 == 0, F.concat(F.lit("https://li.example/"), k)).alias("linkedin"), null.alias("crunchbase"), null.alias("twitter"),
                 F.when(k % 5 == 0, F.concat(F.lit("https://github.com/c"), k)).alias("github")).alias("social"),
        F.struct(F.col("total_raised_usd"), F.col("last_round"), null.alias("last_round_date"), F.col("valuation_usd"), F.lit(None).cast("array<string>").alias("investors")).alias("funding"),
        F.struct(F.col("employee_count_range"), F.when(k % 2 == 1, F.array(F.struct(F.concat(F.lit("P"), k).alias("name"), F.lit("CEO").alias("title"), null.alias("linkedin")))).alias("founders")).alias("team"),
        F.when(k % 8 == 0, F.array(F.struct(F.concat(F.lit("Prod "), k).alias("name"), F.concat(F.lit("https://prod.example/"), k).alias("url")))).alias("products"),
        F.struct(F.when(k % 2 == 0, F.col("added_date")).alias("added_date"), F.array(F.lit(" https://s.example "), F.lit(" ")).alias("sources")).alias("meta"),
    )


_arch = list_lit(migration.ARCHIVED_SLUGS)
SLUG_OF = f"CASE WHEN c_custkey < 28 THEN ({_arch})[CAST(c_custkey + 1 AS INTEGER)] ELSE slug END"


@query("s11_route_archive", WITH + f"SELECT target, count(*) AS n FROM (SELECT CASE WHEN {ARCHIVE_SQL} THEN 'archive' ELSE 'products' END AS target FROM (SELECT *, {SLUG_OF} AS s FROM c)) GROUP BY target")
def _(t):
    return migrate.route_archive(_companies(t)).groupBy("target").agg(F.count("*").alias("n"))


@query("p9_archive_rule", WITH + f"SELECT c_custkey, {ARCHIVE_SQL} AS archived FROM (SELECT *, {SLUG_OF} AS s FROM c)")
def _(t):
    return _companies(t).select("c_custkey", migrate.is_archived().alias("archived"))


# ---------------------------------------------------------------- normalisation

W_IN = "WITH " + bound(INCOMING, "r") + " "
NAME_SQL = r"regexp_replace(trim(name), '(?i)\s*(,?\s*(Inc\.?|LLC|Ltd\.?|Corp\.?|Co\.?))\s*$', '')"
C_IN = "company_headquarters_country"
C_SQL = f"CASE WHEN {C_IN} <> '' THEN coalesce({case_map(f'lower(trim({C_IN}))', geo.COUNTRY_NAMES)}, trim({C_IN})) END"
CAT_SLUG = SLUG_SQL.format("category")
CAT_ALIAS = case_map(CAT_SLUG, taxonomy.CATEGORY_ALIASES, CAT_SLUG)
NORMAL_SQL = (
    f"SELECT seq, source, {NAME_SQL} AS name, CASE WHEN length(trim(description)) >= 10 THEN description END AS description, "
    f"CASE WHEN company_website <> '' THEN rtrim(split_part(trim(company_website), '#', 1), '/') END AS company_website, "
    f"product_url, {C_SQL} AS company_headquarters_country, {case_map(C_SQL, geo.COUNTRY_CODES)} AS company_headquarters_country_code, "
    f"CASE WHEN {CAT_ALIAS} IN {in_list(taxonomy.CATEGORY_IDS)} THEN {CAT_ALIAS} END AS category, company_founded_year, "
    "company_total_raised_usd, company_employee_count_range FROM r"
)


@query("f12_normalize", W_IN + f"SELECT seq, name, description, company_website, company_headquarters_country, company_headquarters_country_code, category FROM ({NORMAL_SQL})")
def _(t):
    return normalize.normalize(t.incoming).select("seq", "name", "description", "company_website", "company_headquarters_country", "company_headquarters_country_code", "category")


FILLED = " + ".join(f"CASE WHEN {c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '' THEN 1 ELSE 0 END" for c in normalize.COMPLETENESS_COLUMNS)


@query("f13_simple_completeness", W_IN + f"SELECT seq, round_even(({FILLED}) / 8.0::DOUBLE, 2) AS score FROM r")
def _(t):
    return t.incoming.select("seq", normalize.simple_completeness().alias("score"))


YEAR = AS_OF[:4]
ISSUES_SQL = f"""list_filter([
  CASE WHEN name IS NULL OR length(trim(name)) < 2 THEN 'Name too short or empty' END,
  CASE WHEN description <> '' AND length(trim(description)) < 10 THEN 'Description too short (' || length(trim(description)) || ' chars)' END,
  CASE WHEN description <> '' AND length(trim(description)) > 5000 THEN 'Description too long (' || length(trim(description)) || ' chars)' END,
  CASE WHEN company_founded_year < 1900 OR company_founded_year > 2035 THEN 'Founded year ' || company_founded_year || ' outside valid range' END,
  CASE WHEN company_founded_year = {YEAR} THEN 'Founded year ' || company_founded_year || ' looks like default (current year)' END,
  CASE WHEN company_headquarters_country <> '' AND regexp_matches(company_headquarters_country, {lit(normalize.GARBAGE_COUNTRY)}) THEN 'Country ''' || company_headquarters_country || ''' looks like garbage data' END,
  CASE WHEN product_url <> '' AND NOT (starts_with(product_url, 'http://') OR starts_with(product_url, 'https://')) THEN 'Product URL ''' || product_url || ''' is not a valid URL' END,
  CASE WHEN company_website <> '' AND NOT (starts_with(company_website, 'http://') OR starts_with(company_website, 'https://')) THEN 'Company website ''' || company_website || ''' is not a valid URL' END
], lambda x: x IS NOT NULL)"""


@query("p1_plausibility", W_IN + f"SELECT seq, array_to_string({ISSUES_SQL}, '; ') AS issues FROM r")
def _(t):
    return normalize.with_issues(t.incoming, as_of()).select("seq", F.array_join("issues", "; ").alias("issues"))


@query("p1_plausibility_texts", f"SELECT doc_id, array_to_string({ISSUES_SQL}, '; ') AS issues FROM (SELECT d.doc_id, substr(source, 4) AS name, trim(text, ' ' || chr(10)) AS description, CAST(1890 + n_chars % 150 AS INTEGER) AS company_founded_year, lang AS company_headquarters_country, p.url AS product_url, replace(p.url, 'https', 'ftp') AS company_website FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id)")
def _(t):
    d = t.documents.join(t.pages, F.col("doc_id") == F.col("page_id"), "left").select(
        "doc_id", F.substring("source", 4, 100).alias("name"), F.btrim("text", F.lit(" \n")).alias("description"),
        (1890 + F.col("n_chars") % 150).cast("int").alias("company_founded_year"), F.col("lang").alias("company_headquarters_country"),
        F.col("url").alias("product_url"), F.replace("url", F.lit("https"), F.lit("ftp")).alias("company_website"))
    return normalize.with_issues(d, as_of()).select("doc_id", F.array_join("issues", "; ").alias("issues"))


# ---------------------------------------------------------------- index

INDEX_SQL = """SELECT slug, name, name_zh, description, description_zh, product_url, CAST(NULL AS VARCHAR) AS icon_url, product_type, category, tags_text, open_source, status,
 coalesce(company_name, '') AS company_name, coalesce(company_url, '') AS company_url, coalesce(country, '') AS country, coalesce(country_code, '') AS country_code,
 coalesce(city, '') AS city, coalesce(total_raised_usd, 0) AS total_raised_usd, coalesce(last_round, '') AS last_round, coalesce(valuation_usd, 0) AS valuation_usd,
 coalesce(employee_count_range, '') AS employee_count_range FROM c"""


def _tags_text(df):
    return df.withColumn("tags_text", F.coalesce(F.array_join("tags", "|"), F.lit(""))).drop("tags", "keywords")


@query("f47_index_projection", WITH + INDEX_SQL)
def _(t):
    return _tags_text(flat_index(t))


@query("c6_build_index", WITH + INDEX_SQL + " ORDER BY total_raised_usd DESC, name")
def _(t):
    return _tags_text(index.build_index(t.catalog))


@query("o1_index_order", WITH + f"SELECT slug, row_number() OVER (ORDER BY coalesce(total_raised_usd, 0) DESC, name, {FILE}) AS pos FROM c")
def _(t):
    from tierweave.session import global_row_number

    order = [F.desc("total_raised_usd"), F.col("name"), index.file_order()]
    return global_row_number(flat_index(t).select("slug", "name", "total_raised_usd"), order, "pos").select("slug", "pos")


@query("p2_filters", WITH + "SELECT slug, name FROM c WHERE category = 'ai-hardware' AND country = 'China'")
def _(t):
    return index.filter_index(flat_index(t), "ai-hardware", "China").select("slug", "name")


PICKED = ["customer-3", "customer-10", "customer-42"]


@query("p3_select_for_compare", WITH + f"SELECT slug, name FROM c WHERE slug IN {in_list(PICKED)}")
def _(t):
    return index.select_for_compare(flat_index(t), PICKED).select("slug", "name")


@query("o4_grid_by_name", WITH + f"SELECT slug, name FROM c ORDER BY name, {FILE} LIMIT 12")
def _(t):
    return index.page_of(flat_index(t), 1, "name").select("slug", "name")


@query("o4_grid_by_funding", WITH + f"SELECT slug, total_raised_usd FROM (SELECT slug, coalesce(total_raised_usd, 0) AS total_raised_usd FROM c) ORDER BY total_raised_usd DESC, {FILE} LIMIT 12 OFFSET 12")
def _(t):
    return index.page_of(flat_index(t), 2).select("slug", "total_raised_usd")


@query("o5_typeahead", WITH + f"SELECT slug, name FROM c WHERE slug NOT IN {in_list(PICKED)} AND (contains(lower(name), 'er#00000001') OR contains(name_zh, 'er#00000001')) ORDER BY coalesce(total_raised_usd, 0) DESC, {FILE} LIMIT 5")
def _(t):
    return index.typeahead(flat_index(t), "ER#00000001", PICKED).select("slug", "name")


@query("o6_card_tags", WITH + "SELECT slug, array_to_string(string_split(tags_text, '|')[1:3], ',') AS shown FROM c WHERE tags_text <> ''")
def _(t):
    return flat_index(t).filter(F.col("tags").isNotNull()).select("slug", F.array_join(index.card_tags(F.col("tags")), ",").alias("shown"))


@query("w5_pages", WITH + f"SELECT slug, CAST(ceil(rn / 12.0) AS BIGINT) AS page FROM (SELECT slug, row_number() OVER (ORDER BY coalesce(total_raised_usd, 0) DESC, {FILE}) AS rn FROM c)")
def _(t):
    return index.with_pages(flat_index(t).select("slug", "total_raised_usd"), index.grid_order("funding")).select("slug", F.col("page").cast("bigint").alias("page"))


@query("o1_stored_page", WITH + f"SELECT slug, name FROM c ORDER BY coalesce(total_raised_usd, 0) DESC, {FILE} LIMIT 12 OFFSET 36")
def _(t):
    # page 4 by a stored ranking; the scan reads the part of the ranking and the keys of the page
    rows = flat_index(t).select("slug", "name", "total_raised_usd")
    return ranking.stored_ranking(rows, index.grid_order("funding"), part_rows=20).page(rows, 4, index.PAGE_SIZE).select("slug", "name")


@query("w5_page_strip", "SELECT p_partkey, array_to_string(range(greatest(1, p_size - 2), least(50, p_size + 2) + 1), ',') AS strip FROM part")
def _(t):
    return t.part.select("p_partkey", F.array_join(index.page_strip(F.col("p_size"), F.lit(50)).cast("array<string>"), ",").alias("strip"))


def _cmp(field: str, arms: list[str]) -> str:
    return f"SELECT '{field}' AS field, " + ", ".join(f"max(CASE WHEN slug = '{s}' THEN {a} END) AS \"{s}\"" for s, a in zip(PICKED, arms)) + " FROM c"


_cur = "CASE WHEN coalesce({0}, 0) = 0 THEN '-' WHEN {0} >= 1e9 THEN '$' || CAST(CAST(round({0} / 1e9, 1) AS DECIMAL(20,1)) AS VARCHAR) || 'B' WHEN {0} >= 1e6 THEN '$' || CAST(CAST(round({0} / 1e6) AS BIGINT) AS VARCHAR) || 'M' WHEN {0} >= 1e3 THEN '$' || CAST(CAST(round({0} / 1e3) AS BIGINT) AS VARCHAR) || 'K' ELSE '$' || CAST(CAST({0} AS BIGINT) AS VARCHAR) END"
from tierweave.functions.money import ROUND_NAMES  # noqa: E402

_fields = {
    "category": "replace(category, '-', ' ')", "product_type": "coalesce(nullif(product_type, ''), '-')", "country": "coalesce(country, '')", "city": "city",
    "total_raised": _cur.format("total_raised_usd"), "valuation": _cur.format("valuation_usd"),
    "last_round": f"CASE WHEN coalesce(last_round, '') = '' THEN '-' ELSE {case_map('last_round', ROUND_NAMES, 'last_round')} END",
    "employees": "coalesce(nullif(employee_count_range, ''), '-')", "open_source": "CASE WHEN open_source THEN 'Yes' ELSE 'No' END",
}


@query("n12_compare_table", WITH + " UNION ALL ".join(_cmp(f, [a] * 3) for f, a in _fields.items()))
def _(t):
    return index.compare_table(flat_index(t), PICKED)


_names = {c[0]: c[1] for c in taxonomy.CATEGORIES}


@query("j10_category_label", WITH + f"SELECT slug, coalesce({case_map('category', _names)}, replace(category, '-', ' '), '') AS label FROM (SELECT slug, CASE WHEN c_custkey % 3 = 0 THEN 'made-up' ELSE category END AS category FROM c)")
def _(t):
    return index.category_label(_some_made_up(t), load_categories(t.spark)).select("slug", "label")


@query("j10_category_label_zh", WITH + f"SELECT slug, coalesce({case_map('category', {r[0]: r[2] or r[1] for r in taxonomy.CATEGORIES})}, regexp_replace(replace(category, '-', ' '), '\\bai\\b', 'AI'), '') AS label FROM (SELECT slug, CASE WHEN c_custkey % 3 = 0 THEN 'made-up' ELSE category END AS category FROM c)")
def _(t):
    return index.category_label(_some_made_up(t), load_categories(t.spark), "zh").select("slug", "label")


def _some_made_up(t):
    return t.flat_catalog.select("slug", F.when(F.col("c_custkey") % 3 == 0, "made-up").otherwise(F.col("category")).alias("category"))


# ---------------------------------------------------------------- quality and gaps

_has = {
    "name": "name <> ''", "product_url": "product_url <> ''", "description": "description <> ''", "product_type": "product_type <> ''",
    "category": "category <> ''", "sub_category": "sub_category <> ''", "company.name": "company_name <> ''", "company.url": "company_url <> ''",
    "company.website": "company_website <> ''", "company.founded_year": "founded_year IS NOT NULL", "company.headquarters": "true",
    "company.funding": "coalesce(total_raised_usd, valuation_usd) IS NOT NULL OR last_round IS NOT NULL", "architecture": "architecture <> ''",
    "modalities": "modalities_text <> ''", "platforms": "platforms_text <> ''", "api_available": "api_available IS NOT NULL",
    "open_source": "open_source IS NOT NULL", "repository_url": "repository_url <> ''", "pricing": "pricing_model IS NOT NULL",
    "tags": "tags_text <> ''", "sources": "source_link IS NOT NULL", "status": "status <> ''", "description_zh": "description_zh <> ''",
}
SCORE_SQL = "round((" + " + ".join(f"CASE WHEN {t} THEN {scoring.QUALITY_WEIGHTS[p]} ELSE 0 END" for p, t in _has.items()) + ")::DOUBLE / 34.5::DOUBLE, 2)"


@query("p10_field_has_value", WITH + "SELECT slug, " + ", ".join(f"coalesce({t}, false) AS {p.replace('.', '_')}" for p, t in _has.items()) + " FROM c")
def _(t):
    return t.catalog.select("slug", *[tags.field_has_value(p).alias(p.replace(".", "_")) for p in _has])


@query("x8_quality_score", WITH + f"SELECT slug, {SCORE_SQL} AS score FROM c")
def _(t):
    return t.catalog.select("slug", tags.quality_score().alias("score"))


@query("p4_low_quality", WITH + f"SELECT slug, {SCORE_SQL} AS new_score FROM c WHERE {SCORE_SQL} <= 0.6 ORDER BY {FILE} LIMIT 10")
def _(t):
    return tags.low_quality(t.catalog, limit=10).select("slug", "new_score")


@query("c11_rescore", WITH + f"SELECT slug, data_quality_score AS old_score, {SCORE_SQL} AS stored FROM c")
def _(t):
    return tags.rescore(t.catalog).select("slug", "old_score", F.col("meta.data_quality_score").alias("stored"))


@query("a14_rescore_summary", WITH + f"SELECT count(*) AS scored, count(*) FILTER (WHERE data_quality_score IS DISTINCT FROM {SCORE_SQL}) AS updated FROM c")
def _(t):
    return tags.rescore_summary(tags.rescore(t.catalog))


_gap = {
    "description": "coalesce(description, '') = ''", "description_zh": "coalesce(description_zh, '') = ''", "product_type": "coalesce(product_type, '') = ''",
    "category": "coalesce(category, '') = ''", "sub_category": "coalesce(sub_category, '') = ''", "tags": "tags_text = ''", "modalities": "modalities_text = ''",
    "platforms": "platforms_text = ''", "target_audience": "true", "use_cases": "true", "architecture": "coalesce(architecture, '') = ''",
    "pricing_model": "pricing_model IS NULL", "has_free_tier": "true", "open_source": "open_source IS NULL", "api_available": "api_available IS NULL",
    "competitors": "true", "status": "status = ''",
}
GAPS_SQL = "list_filter([" + ", ".join(f"CASE WHEN {t} THEN '{f}' END" for f, t in _gap.items()) + "], lambda x: x IS NOT NULL)"


@query("n9_gaps", WITH + f"SELECT slug, array_to_string({GAPS_SQL}, ',') AS gaps FROM c")
def _(t):
    return t.catalog.select("slug", F.array_join(gaps.find_gaps(), ",").alias("gaps"))


_ctx = """list_filter(['Product name: ' || name, CASE WHEN name_zh <> '' THEN 'Chinese name: ' || name_zh END, CASE WHEN description <> '' THEN 'Description: ' || description END,
 'URL: ' || product_url, 'Company: ' || company_name, CASE WHEN country <> '' THEN 'Country: ' || country END, CASE WHEN tags_text <> '' THEN 'Existing tags: ' || replace(tags_text, '|', ', ') END,
 CASE WHEN category <> '' THEN 'Category: ' || category END, CASE WHEN product_type <> '' THEN 'Product type: ' || product_type END], lambda x: x IS NOT NULL)"""


@query("n10_prompt", WITH + f"SELECT slug, {lit(gaps.PROMPT_HEAD)} || array_to_string({_ctx}, chr(10)) || {lit(gaps.PROMPT_MIDDLE)} || array_to_string(list_transform({GAPS_SQL}, lambda g: '  \"' || g || '\": ' || {case_map('g', gaps.INSTRUCTIONS)}), ',' || chr(10)) || {lit(gaps.PROMPT_TAIL)} AS prompt FROM c")
def _(t):
    return t.catalog.withColumn("gaps", gaps.find_gaps()).select("slug", gaps.compose_prompt(F.col("gaps")).alias("prompt"))


def _answers(t):
    body = F.expr("""CASE p_partkey % 4
      WHEN 0 THEN to_json(named_struct('category', 'ai-hardware', 'status', 'unknown', 'description', concat(' About ', p_name, ' '), 'open_source', true))
      WHEN 1 THEN concat('```json\n', to_json(named_struct('tags', array(p_type, ' ', p_name), 'has_free_tier', 'yes', 'category', 'nope')), '\n```')
      WHEN 2 THEN 'not json' ELSE '[1]' END""")
    return t.part.select(F.concat(F.lit("part-"), "p_partkey").alias("slug"), F.col("p_partkey").alias("seq"), body.alias("response"))


@query("n7_parse_answers", """SELECT concat('part-', p_partkey) AS slug, CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 <> 0 THEN 'ai-hardware' END AS category,
 CASE WHEN p_partkey % 4 = 0 THEN 'About ' || p_name END AS description, CASE WHEN p_partkey % 4 = 0 THEN true END AS open_source
 FROM part WHERE p_partkey % 4 = 0""")
def _(t):
    out = gaps.answers_to_records(t.part_catalog, _answers(t))
    return out.filter(F.col("open_source").isNotNull()).select("slug", "category", "description", "open_source")


@query("n8_checked_fields", """SELECT concat('part-', p_partkey) AS slug, CASE p_partkey % 4 WHEN 0 THEN 'ai-hardware' END AS category, CAST(NULL AS VARCHAR) AS status,
 CASE p_partkey % 4 WHEN 1 THEN p_type || '|' || p_name END AS tags, CAST(NULL AS BOOLEAN) AS has_free_tier FROM part""")
def _(t):
    every = F.array(*[F.lit(f) for f in scoring.FILLABLE_PATHS])
    v = gaps.parse_answer(F.col("response"), every)
    return _answers(t).select("slug", v["category"].alias("category"), v["status"].alias("status"), F.array_join(v["tags"], "|").alias("tags"), v["has_free_tier"].alias("has_free_tier"))


def _full_answers(t):
    """Answers to all 17 fields: right, of a wrong kind, empty, or outside the allowed values."""
    k = F.col("p_partkey") % 5
    texts = ("description", "description_zh", "sub_category", "architecture")
    lists = ("tags", "modalities", "platforms", "target_audience", "use_cases", "competitors")
    right = {f: F.concat(F.lit(f" {f} "), "p_name") for f in texts} | {f: F.array(F.col("p_name"), F.lit(" two "), F.lit(" ")) for f in lists} | {
        "product_type": F.lit("llm"), "category": F.lit("ai-hardware"), "status": F.lit("beta"), "pricing_model": F.lit("freemium"),
        "has_free_tier": F.lit(True), "open_source": F.lit(False), "api_available": F.lit(True),
    }
    odd = {f: F.lit("x") for f in texts} | {f: F.lit("no list") for f in lists} | {
        f: F.lit("nonsense") for f in ("product_type", "category", "status", "pricing_model", "has_free_tier", "open_source", "api_available")}

    def body(fields):
        return F.to_json(F.struct(*[fields[f].alias(f) for f in scoring.FILLABLE_PATHS]))

    answer = F.when(k == 0, body(right)).when(k == 1, F.concat(F.lit("```json\n"), body(right), F.lit("\n```"))).when(k == 2, body(odd)).when(k == 3, F.lit("[1]")).otherwise(F.lit("{}"))
    return spread(t.part).select(F.concat(F.lit("part-"), "p_partkey").alias("slug"), answer.alias("response"))


def _right_sql(field):
    if field in ("description", "description_zh", "sub_category", "architecture"):
        return f"'{field} ' || p_name"
    fixed = {"product_type": "llm", "category": "ai-hardware", "status": "beta", "pricing_model": "freemium", "has_free_tier": "true", "open_source": "false", "api_available": "true"}
    return lit(fixed[field]) if field in fixed else "p_name || '|two'"


@query("n8_checked_fields_all", "SELECT concat('part-', p_partkey) AS slug, " + ", ".join(f"CASE WHEN p_partkey % 5 < 2 THEN {_right_sql(f)} END AS {f}" for f in scoring.FILLABLE_PATHS) + " FROM part")
def _(t):
    lists = ("tags", "modalities", "platforms", "target_audience", "use_cases", "competitors")
    asked = F.array(*[F.lit(f) for f in scoring.FILLABLE_PATHS])
    v = _full_answers(t).withColumn("_answer", gaps.answer(F.col("response"), asked))
    return v.select("slug", *[(F.array_join(c, "|") if f in lists else c.cast("string")).alias(f) for f in scoring.FILLABLE_PATHS for c in [F.col("_answer")[f]]])


@query("n11_answer_records", "SELECT concat('part-', p_partkey) AS slug, p_name AS name, 'llm-enrichment' AS source, 3 AS source_tier, '' AS source_url FROM part WHERE p_partkey % 4 = 0 OR (p_partkey % 4 = 1 AND p_partkey % 2 = 0)")
def _(t):
    return gaps.answers_to_records(t.part_catalog, _answers(t)).select("slug", "name", "source", "source_tier", "source_url")


# ---------------------------------------------------------------- schema

ERRORS_SQL = """list_filter([
 CASE WHEN description IS NULL THEN '(root): ''description'' is a required property' END,
 CASE WHEN product_type IS NULL THEN '(root): ''product_type'' is a required property' END,
 CASE WHEN category IS NULL THEN '(root): ''category'' is a required property' END,
 CASE WHEN length(description) < 10 THEN 'description: is too short' END,
 CASE WHEN product_type NOT IN ('llm', 'app', 'dev-tool', 'hardware', 'dataset', 'framework', 'api-service', 'other') THEN 'product_type: ''' || product_type || ''' is not one of the allowed values' END
 ], lambda x: x IS NOT NULL)"""


@query("c5_validate_schema", WITH + f"SELECT slug, len(e) = 0 AS valid, array_to_string(e, '; ') AS errors FROM (SELECT slug, {ERRORS_SQL} AS e FROM c)")
def _(t):
    return validate.validate_schema(t.catalog, F.col("slug")).select("slug", "valid", F.array_join("errors", "; ").alias("errors"))


def _referring(t):
    """Orders whose references point at every customer key up to half again as many."""
    ref = F.concat(F.lit("customer-"), F.expr("o_custkey * 3 div 2"))
    return t.orders.select(
        F.concat(F.lit("order-"), "o_orderkey").alias("slug"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(ref)).alias("competitors"),
        F.when(F.col("o_orderkey") % 3 == 0, F.array(ref, F.lit("customer-1"))).alias("based_on"),
        F.lit(None).cast("array<string>").alias("used_by"),
    )


_refs = "(SELECT 'order-' || o_orderkey AS product_slug, 'competitors' AS field, 'customer-' || (o_custkey * 3 // 2) AS referenced_slug FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'order-' || o_orderkey, 'based_on', 'customer-' || (o_custkey * 3 // 2) FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'order-' || o_orderkey, 'based_on', 'customer-1' FROM orders WHERE o_orderkey % 3 = 0)"
DANGLING_SQL = f"SELECT product_slug, field, referenced_slug FROM {_refs} WHERE referenced_slug NOT IN (SELECT 'customer-' || c_custkey FROM customer)"


@query("j9_dangling_references", DANGLING_SQL)
def _(t):
    return validate.dangling_references(_referring(t), t.catalog.select("slug")).select("product_slug", "field", "referenced_slug")


@query("a11_validation_summary", WITH + f"SELECT count(*) AS total, count(*) FILTER (WHERE len(e) = 0) AS valid, count(*) FILTER (WHERE len(e) > 0) AS invalid, (SELECT count(*) FROM ({DANGLING_SQL})) AS integrity_errors FROM (SELECT {ERRORS_SQL} AS e FROM c)")
def _(t):
    checked = validate.validate_schema(t.catalog, F.col("slug"))
    return validate.validation_summary(checked, validate.dangling_references(_referring(t), t.catalog.select("slug")))


# ---------------------------------------------------------------- migration

_catmap = case_map("oc", migration.OLD_CATEGORY, lit("ai-app"))
_ocs = list_lit(migration.OLD_CATEGORY)
_sts = list_lit(migration.OLD_STATUS)


@query("c9_migrate_companies", WITH + f"""SELECT s AS slug, CASE WHEN c_custkey % 8 = 0 THEN 'Prod ' || c_custkey ELSE name END AS name,
  CASE WHEN c_custkey % 8 = 0 THEN 'https://prod.example/' || c_custkey WHEN c_custkey % 3 <> 0 THEN 'https://c' || (c_custkey % 997) || '.example.com'
    WHEN c_custkey % 2 = 0 THEN 'https://li.example/' || c_custkey WHEN c_custkey % 5 = 0 THEN 'https://github.com/c' || c_custkey
    ELSE 'https://www.bing.com/search?q=' || replace(name, '#', '%23') || '+AI' END AS product_url,
  {case_map("oc", migration.OLD_PRODUCT_TYPE, lit("other"))} AS product_type, {_catmap} AS category, {case_map("oc", migration.OLD_SUB_CATEGORY)} AS sub_category,
  {case_map("st", migration.OLD_STATUS, lit("active"))} AS status, 't' || (c_custkey % 3) AS tags,
  CASE WHEN founded_year >= 1900 AND founded_year < {YEAR} THEN founded_year END AS founded_year, city, nullif(country, '') AS country,
  CASE WHEN c_custkey % 2 = 1 THEN 'P' || c_custkey END AS person, CASE WHEN c_custkey % 2 = 0 THEN added_date ELSE DATE '{AS_OF}' END AS added_date
  FROM (SELECT *, {SLUG_OF} AS s, coalesce(({_ocs})[CAST(c_custkey % 20 + 1 AS INTEGER)], 'ai-other') AS oc, coalesce(({_sts})[CAST(c_custkey % 5 + 1 AS INTEGER)], 'active') AS st FROM c)
  WHERE NOT ({ARCHIVE_SQL})""")
def _(t):
    m = migrate.migrate_companies(_companies(t), as_of())
    return m.select("slug", "name", "product_url", "product_type", "category", "sub_category", "status", F.array_join("tags", "|").alias("tags"),
                    F.col("company.founded_year").alias("founded_year"), F.col("company.headquarters.city").alias("city"), F.col("company.headquarters.country").alias("country"),
                    F.col("key_people")[0]["name"].alias("person"), F.col("meta.added_date").alias("added_date"))


OLD_CATS = ["ai-model", "ai-app", "ai-agent", "ai-data", "ai-hardware", "ai-application", "mystery"]


def _old_catalog(t):
    k = F.col("c_custkey")
    old = F.get(F.array(*[F.lit(c) for c in OLD_CATS]), (k % 7).cast("int"))
    more = F.get(F.array(F.lit("text-to-image"), F.lit("open-weights"), F.lit("startup"), F.lit("nlp")), (k % 4).cast("int"))
    keys = t.flat_catalog.select("slug", "c_custkey")
    return t.catalog.join(keys, "slug").withColumn("category", old).withColumn(
        "tags", F.concat(F.coalesce("tags", F.array().cast("array<string>")), F.array(more))).drop("c_custkey")


_subs = f"CASE oc WHEN 'ai-model' THEN CASE WHEN sub_category IN {in_list(migration.MEDIA_SUB_CATEGORIES)} OR list_has_any(ot, {list_lit(migration.MEDIA_TAGS)}) THEN 'ai-creative-media' ELSE 'ai-foundation-model' END WHEN 'ai-app' THEN CASE WHEN sub_category IN {in_list(migration.VERTICAL_SUB_CATEGORIES)} THEN 'ai-enterprise-vertical' ELSE 'ai-application' END WHEN 'ai-data' THEN 'ai-data-platform' WHEN 'ai-hardware' THEN 'ai-hardware' ELSE 'ai-application' END"
_mapped = f"list_filter(list_transform(ot, lambda x: {case_map('x', migration.TAG_RENAMES, 'x')}), lambda x: x IN {in_list(taxonomy.TAG_IDS)})"


def _add(test: str, tag: str) -> str:
    return f"CASE WHEN ({test}) AND NOT list_contains(mt, '{tag}') THEN '{tag}' END"


_added = "list_filter([" + ", ".join([
    _add("open_source", "open-source"),
    _add("pricing_model = 'freemium'", "freemium"),
    *[_add(f"country = '{c}'", tg) for c, tg in geo.COUNTRY_TAGS.items()],
    _add("country = 'Germany'", "europe"),
    _add("valuation_usd >= 10000000000", "decacorn"),
    _add("valuation_usd >= 1000000000 AND NOT valuation_usd >= 10000000000", "unicorn"),
    _add("api_available AND NOT list_contains(mt, 'api-platform')", "api-service"),
    _add("contains(lower(architecture), 'transformer')", "transformer"),
    _add("contains(lower(architecture), 'moe')", "moe"),
    _add("contains(lower(architecture), 'diffusion')", "diffusion-model"),
    _add("modalities_text = 'text|image'", "multimodal"),
]) + "], lambda x: x IS NOT NULL)"
_keep_order = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
MIGRATED_SQL = (
    f"SELECT slug, oc AS old_category, {_subs} AS category, ot, {_keep_order.format('list_concat(mt, ' + _added + ')')} AS nt FROM ("
    f"SELECT *, {_keep_order.format(_mapped)} AS mt FROM (SELECT *, ({list_lit(OLD_CATS)})[CAST(c_custkey % 7 + 1 AS INTEGER)] AS oc, "
    f"list_concat(CASE WHEN tags_text = '' THEN []::VARCHAR[] ELSE string_split(tags_text, '|') END, [(['text-to-image', 'open-weights', 'startup', 'nlp']::VARCHAR[])[CAST(c_custkey % 4 + 1 AS INTEGER)]]) AS ot FROM c))"
)


@query("c10_migrate_taxonomy", WITH + f"SELECT slug, category, array_to_string(nt, '|') AS tags FROM ({MIGRATED_SQL})")
def _(t):
    return migrate.migrate_taxonomy(_old_catalog(t)).select("slug", "category", F.array_join("tags", "|").alias("tags"))


_diff = "len(list_filter(list_distinct({0}), lambda x: NOT list_contains({1}, x)))"


@query("u4_tag_changes", WITH + f"SELECT slug, array_to_string(list_sort(list_filter(list_distinct(nt), lambda x: NOT list_contains(ot, x))), '|') AS added, array_to_string(list_sort(list_filter(list_distinct(ot), lambda x: NOT list_contains(nt, x))), '|') AS removed FROM ({MIGRATED_SQL})")
def _(t):
    m = migrate.migrate_taxonomy(_old_catalog(t))
    return m.select("slug", F.array_join(F.array_sort(F.array_except("tags", "old_tags")), "|").alias("added"), F.array_join(F.array_sort(F.array_except("old_tags", "tags")), "|").alias("removed"))


@query("a12_taxonomy_changes", WITH + f"SELECT old_category, category, count(*) AS products, count(*) FILTER (WHERE old_category <> category OR ot <> nt) AS changed, CAST(sum({_diff.format('nt', 'ot')}) AS BIGINT) AS tags_added, CAST(sum({_diff.format('ot', 'nt')}) AS BIGINT) AS tags_removed FROM ({MIGRATED_SQL}) GROUP BY ALL")
def _(t):
    return migrate.taxonomy_changes(migrate.migrate_taxonomy(_old_catalog(t)))


@query("c12_stamp_seed", WITH + f"SELECT slug, DATE '{AS_OF}' AS added_date, DATE '{AS_OF}' AS last_updated, company_website AS source, CAST(0.8 AS DOUBLE) AS score FROM c")
def _(t):
    s = migrate.stamp_seed(t.flat_catalog.withColumn("website", F.col("company_website")), as_of())
    return s.select("slug", "meta.added_date", "meta.last_updated", F.col("meta.sources")[0].alias("source"), F.col("meta.data_quality_score").alias("score"))

