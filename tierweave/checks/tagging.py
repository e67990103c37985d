"""Tags, keywords, text terms and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.bindings import CATALOG, PART_TEXT
from tierweave.checks.registry import bound, case_map, in_list, list_lit, lit, query
from tierweave.fixed import geo, scoring, tag_rules, taxonomy, terms
from tierweave.functions import text as X
from tierweave.operators import index, search, tags
from tierweave.session import spread

C = "WITH " + bound(CATALOG, "c") + " "
P = "WITH " + bound(PART_TEXT, "p") + " "
KEEP_FIRST = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"


def _text_rules(text: str) -> str:
    arms = ", ".join(f"CASE WHEN regexp_matches({text}, {lit('(?i)' + p)}) THEN {list_lit(t)} ELSE []::VARCHAR[] END" for p, t in tag_rules.TEXT_RULES)
    return f"flatten([{arms}])"


@query("x5_text_tags", P + f"SELECT p_partkey, array_to_string({_text_rules('text')}, '|') AS tags FROM p")
def _(t):
    return spread(t.part_text).select("p_partkey", F.array_join(tags.text_tags(F.col("text")), "|").alias("tags"))


TEXT_SQL = "array_to_string(list_filter([nullif(name, ''), nullif(description, ''), nullif(description_zh, ''), nullif(name_zh, '')], lambda x: x IS NOT NULL), ' ')"


@query("x7_search_text", C + f"SELECT slug, {TEXT_SQL} AS text FROM c")
def _(t):
    return t.catalog.select("slug", tags.search_text().alias("text"))


def _table(expr: str, table) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {lit(k)} THEN {list_lit(v)}" for k, v in table.items()) + " ELSE []::VARCHAR[] END"


STRUCTURED = f"""list_filter([CASE WHEN open_source THEN 'open-source' WHEN NOT open_source THEN 'closed-source' END, CASE WHEN repository_url <> '' THEN 'open-source' END,
 CASE WHEN api_available THEN 'api-service' END, {case_map('pricing_model', tag_rules.PRICING_TAGS)},
 CASE WHEN contains(lower(architecture), 'transformer') THEN 'transformer' END, CASE WHEN contains(lower(architecture), 'moe') OR contains(lower(architecture), 'mixture') THEN 'moe' END,
 CASE WHEN contains(lower(architecture), 'diffusion') THEN 'diffusion-model' END, CASE WHEN modalities_text = 'text|image' THEN 'multimodal' END,
 {case_map('country', geo.COUNTRY_TAGS)}, CASE WHEN country IN {in_list(geo.EUROPE)} THEN 'europe' END,
 CASE WHEN valuation_usd >= 10000000000 THEN 'decacorn' WHEN valuation_usd >= 1000000000 THEN 'unicorn' END,
 CASE WHEN contains(source_link, 'ycombinator') THEN 'yc-backed' END], lambda x: x IS NOT NULL)"""


@query("x6_structured_tags", C + f"SELECT slug, array_to_string({STRUCTURED}, '|') AS tags FROM c")
def _(t):
    return t.catalog.select("slug", F.array_join(tags.structured_tags(), "|").alias("tags"))


PLATFORMS = "CASE platforms_text WHEN 'Web|iOS' THEN ['saas', 'mobile-app'] WHEN 'API' THEN ['api-platform'] ELSE []::VARCHAR[] END"
_found = f"list_filter(list_concat({_text_rules(TEXT_SQL)}, {_table('category', tag_rules.CATEGORY_TAGS)}, {_table('sub_category', tag_rules.SUB_CATEGORY_TAGS)}, {_table('product_type', tag_rules.PRODUCT_TYPE_TAGS)}, {STRUCTURED}, {PLATFORMS}), lambda x: x IN {in_list(taxonomy.TAG_IDS)})"
_every = f"list_concat(CASE WHEN tags_text = '' THEN []::VARCHAR[] ELSE string_split(tags_text, '|') END, {_found})"


@query("x5_infer_tags", C + f"SELECT slug, array_to_string(CASE WHEN NOT open_source AND list_contains(d, 'closed-source') THEN list_filter(d, lambda x: x <> 'open-source') ELSE d END[1:20], '|') AS tags FROM (SELECT slug, open_source, {KEEP_FIRST.format('e')} AS d FROM (SELECT slug, open_source, {_every} AS e FROM c))".replace("CASE WHEN NOT open_source AND", "(CASE WHEN NOT open_source AND").replace("ELSE d END[1:20]", "ELSE d END)[1:20]"))
def _(t):
    return tags.infer_tags(t.catalog).select("slug", F.array_join("tags", "|").alias("tags"))


@query("p11_vocabulary_guard", C + f"SELECT slug, array_to_string(list_filter(string_split(tags_text, '|'), lambda x: x IN {in_list(taxonomy.TAG_IDS)}), '|') AS tags FROM c")
def _(t):
    none = F.array().cast("array<string>")
    return t.catalog.select("slug", F.array_join(tags.keep_valid(F.coalesce("tags", none)), "|").alias("tags"))


KEYWORDS = list(dict.fromkeys(k.lower() for lang in terms.JOB_KEYWORDS.values() for k in lang["match"]))


def _any(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {lit(w.lower())})" for w in words) + ")"


@query("p6_matches_ai_job", P + f"SELECT p_partkey, {_any('lower(text)', KEYWORDS)} AS hit FROM p")
def _(t):
    return t.part_text.select("p_partkey", X.matches_ai_job(F.col("text"), F.lit("")).alias("hit"))


JOB_SQL = "CASE " + " ".join(f"WHEN {_any('lower(text)', w)} THEN {lit(c)}" for lang in terms.JOB_KEYWORDS.values() for c, w in lang["categories"].items()) + " END"


@query("j18_job_category", P + f"SELECT p_partkey, {JOB_SQL} AS category FROM p")
def _(t):
    return t.part_text.select("p_partkey", X.job_category(F.col("text"), F.lit("")).alias("category"))


WORDS_SQL = f"list_filter(regexp_extract_all({{0}}, '{terms.WORD_PATTERN}'), lambda w: lower(w) IN {in_list(terms.PRESERVED_TERMS)} OR (length(w) >= 4 AND lower(w) NOT IN {in_list(terms.STOP_WORDS)}))[1:20]"


@query("x2_meaningful_words", f"SELECT doc_id, array_to_string({WORDS_SQL.format('text')}, ' ') AS words FROM documents")
def _(t):
    return t.documents.select("doc_id", F.array_join(X.meaningful_words("text"), " ").alias("words"))


@query("x3_han_runs", C + "SELECT slug, array_to_string(regexp_extract_all(coalesce(description_zh, '') || ' x ' || coalesce(name_zh, ''), '[一-鿿]{2,}')[1:15], ' ') AS runs FROM c")
def _(t):
    text = F.concat(F.coalesce("description_zh", F.lit("")), F.lit(" x "), F.coalesce("name_zh", F.lit("")))
    return t.catalog.select("slug", F.array_join(X.han_runs(text), " ").alias("runs"))


@query("x1_extract_keywords", f"""SELECT doc_id, array_to_string(list_filter(k, lambda x, i: list_position(list_transform(k, lambda y: lower(y)), lower(x)) = i), '|') AS keywords FROM (
  SELECT doc_id, list_filter(list_concat(['Doc ' || doc_id, source, replace(lang || '-text', '-', ' '), 'open source', 'The'], {WORDS_SQL.format('text')}, ['app']), lambda x: length(x) >= 2) AS k FROM documents)""")
def _(t):
    d = t.documents.select(
        "doc_id", F.concat(F.lit("Doc "), "doc_id").alias("name"), F.struct(F.col("source").alias("name")).alias("company"),
        F.concat("lang", F.lit("-text")).alias("category"), F.array(F.lit("open-source"), F.lit("The")).alias("tags"),
        F.col("text").alias("description"), F.lit("app").alias("product_type"))
    p = d.withColumn("company", F.struct(*[(F.col("company.name") if f.name == "name" else F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.COMPANY.fields]))
    full = p.select("doc_id", *[(F.col(f.name) if f.name in p.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schemas.PRODUCT.fields])
    return tags.extract_keywords(full).select("doc_id", F.array_join("keywords", "|").alias("keywords"))


TERM = "machinery"
_dist = "(CASE WHEN lower({0}) = '{1}' THEN 0.0::DOUBLE WHEN contains(lower({0}), '{1}') THEN 0.1::DOUBLE ELSE list_min(list_transform(list_filter(string_split(lower({0}), ' '), lambda w: w <> '' AND abs(length(w) - {2}) <= greatest(length(w), {2}) * 0.4::DOUBLE), lambda w: levenshtein(w, '{1}')::DOUBLE / greatest(length(w), {2}))) END)"


def _gain(key: str, weight: float) -> str:
    value = {"tags": None, "country": "coalesce(country, '')"}.get(key, key)
    d = "NULL" if value is None else _dist.format(value, TERM, len(TERM))
    return f"CASE WHEN {d} <= 0.4::DOUBLE THEN {weight}::DOUBLE * (1 - {d}) END"


@query("x9_search", C + "SELECT slug, round(list_sum(g), 6) AS score FROM (SELECT slug, list_filter([" + ", ".join(_gain(k, w) for k, w in scoring.SEARCH_WEIGHTS.items()) + "], lambda x: x IS NOT NULL) AS g FROM c) WHERE len(g) > 0")
def _(t):
    return search.search(index.index_projection(t.catalog), "Machinery").select("slug", "score")
