"""Entity resolution, similarity joins and cross-record checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierweave.bindings import CATALOG, INCOMING
from tierweave.checks.functions import DOMAIN_SQL
from tierweave.checks.registry import bound, query
from tierweave.fixed.scoring import AGGREGATOR_HOSTS
from tierweave.operators import crossval, resolve, similarity

R = "WITH " + bound(INCOMING, "r") + ", " + bound(CATALOG, "c") + " "
DOMAINS = f"(SELECT d, max(slug) AS match_slug FROM (SELECT {DOMAIN_SQL.format('product_url')} AS d, slug FROM c UNION ALL SELECT {DOMAIN_SQL.format('company_website')}, slug FROM c WHERE company_website <> '') GROUP BY d)"


@query("j1_match_product_domain", R + f"SELECT r.seq, k.match_slug FROM r JOIN {DOMAINS} k ON {DOMAIN_SQL.format('r.product_url')} = k.d WHERE r.product_url <> ''")
def _(t):
    return resolve.match_by(t.incoming, t.catalog, "product_domain")


@query("j1_pages_by_domain", f"SELECT a.page_id, max(b.page_id) AS partner FROM pages a JOIN pages b ON {DOMAIN_SQL.format('a.url')} = {DOMAIN_SQL.format('b.url')} GROUP BY a.page_id")
def _(t):
    from tierweave.functions.url import extract_domain

    held = t.pages.groupBy(extract_domain("url").alias("domain")).agg(F.max("page_id").alias("partner"))
    return t.pages.withColumn("domain", extract_domain("url")).join(held, "domain").select("page_id", "partner")


@query("j2_match_company_domain", R + f"SELECT r.seq, k.match_slug FROM r JOIN {DOMAINS} k ON {DOMAIN_SQL.format('r.company_website')} = k.d WHERE r.company_website <> ''")
def _(t):
    return resolve.match_by(t.incoming, t.catalog, "company_domain")


@query("j3_match_name", R + "SELECT r.seq, max(c.slug) AS match_slug FROM r JOIN c ON lower(r.name) = lower(c.name) GROUP BY r.seq")
def _(t):
    return resolve.match_by(t.incoming, t.catalog, "name")


@query("j4_match_name_zh", R + "SELECT r.seq, max(c.slug) AS match_slug FROM r JOIN c ON r.name_zh = c.name_zh GROUP BY r.seq")
def _(t):
    return resolve.match_by(t.incoming, t.catalog, "name_zh")


@query("j4_match_name_zh_orders", R + "SELECT r.seq, max(c.slug) AS match_slug FROM (SELECT seq, '客户' || seq % 2000 AS name_zh FROM r WHERE seq % 2 = 0) r JOIN c ON r.name_zh = c.name_zh GROUP BY r.seq")
def _(t):
    named = t.incoming.withColumn("name_zh", F.when(F.col("seq") % 2 == 0, F.concat(F.lit("客户"), F.col("seq") % 2000)))
    return resolve.match_by(named, t.catalog, "name_zh")


@query("j5_match_cross_lingual", R + "SELECT r.seq, max(c.slug) AS match_slug FROM r JOIN c ON lower(r.name) = lower(c.name_zh) GROUP BY r.seq")
def _(t):
    return resolve.match_by(t.incoming, t.catalog, "cross_lingual")


@query("j7_match_slug", R + "SELECT seq, slug AS match_slug FROM r JOIN c ON replace(regexp_replace(lower(r.name), '[#.,]', '', 'g'), ' ', '-') = slug")
def _(t):
    return resolve.match_by(t.incoming, t.catalog, "slug").select("seq", "match_slug")


@query("j8_resolve_exact", R + f"""SELECT seq, coalesce(m1, m2, m3, m4, m5, m7) AS match_slug, CASE WHEN m1 IS NOT NULL THEN 'product_domain' WHEN m2 IS NOT NULL THEN 'company_domain' WHEN m3 IS NOT NULL THEN 'name'
   WHEN m4 IS NOT NULL THEN 'name_zh' WHEN m5 IS NOT NULL THEN 'cross_lingual' WHEN m7 IS NOT NULL THEN 'slug' END AS match_rule FROM (
  SELECT r.seq, (SELECT max(match_slug) FROM {DOMAINS} k WHERE k.d = {DOMAIN_SQL.format('r.product_url')} AND r.product_url <> '') AS m1,
   (SELECT max(match_slug) FROM {DOMAINS} k WHERE k.d = {DOMAIN_SQL.format('r.company_website')} AND r.company_website <> '') AS m2,
   (SELECT max(slug) FROM c WHERE lower(c.name) = lower(r.name)) AS m3, (SELECT max(slug) FROM c WHERE c.name_zh = r.name_zh) AS m4,
   (SELECT max(slug) FROM c WHERE lower(c.name_zh) = lower(r.name)) AS m5,
   (SELECT max(slug) FROM c WHERE c.slug = replace(regexp_replace(lower(r.name), '[#.,]', '', 'g'), ' ', '-') AND r.seq % 6 NOT IN (1)) AS m7 FROM r)""")
def _(t):
    return resolve.resolve(t.incoming, t.catalog, fuzzy=False).select("seq", "match_slug", "match_rule")


@query("j8_resolve")
def _(t):
    return resolve.resolve(t.incoming, t.catalog).select("seq", "match_slug", "match_rule")


def _edited_parts(t):
    """Distinct part names with one deterministic edit."""
    n = F.lower("p_name")
    return t.part.select("p_name", "p_partkey").groupBy("p_name").agg(F.min("p_partkey").alias("k")).select(
        F.when(F.col("k") % 3 == 0, F.concat(n, F.lit("s"))).when(F.col("k") % 3 == 1, F.concat(F.substr(n, F.lit(1), F.lit(3)), F.substr(n, F.lit(5))))
        .otherwise(F.concat(n, F.lit(" kit set"))).alias("name"), "k")


LCS = """list_last(list_reduce(list_transform(range(1, length({a}) + 1), lambda i: [i]), lambda acc, i: list_reduce(
 list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda row, j: list_append(row, CASE WHEN substr({a}, i[1], 1) = substr({b}, j[1], 1) THEN acc[j[1]] + 1 ELSE greatest(acc[j[1] + 1], list_last(row)) END), [0]::BIGINT[]), list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT)))"""
EDITED = "(SELECT CASE WHEN k % 3 = 0 THEN lower(p_name) || 's' WHEN k % 3 = 1 THEN substr(lower(p_name), 1, 3) || substr(lower(p_name), 5) ELSE lower(p_name) || ' kit set' END AS name, k FROM (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY p_name))"
PART_NAMES = "(SELECT lower(p_name) AS part, max('part-' || p_partkey) AS slug FROM part GROUP BY 1)"


@query("x10_similarity", f"SELECT e.name, n.p_partkey, 2.0::DOUBLE * {LCS.format(a='e.name', b='lower(n.p_name)')} / (length(e.name) + length(n.p_name)) AS ratio FROM {EDITED} e JOIN (SELECT *, unnest([0, 1, 7]) AS d FROM part) n ON n.p_partkey = e.k + n.d")
def _(t):
    # every edited name against its own part and two others
    n = t.part.select("p_partkey", F.lower("p_name").alias("part"), F.explode(F.array(F.lit(0), F.lit(1), F.lit(7))).alias("d"))
    both = _edited_parts(t).join(n, F.col("p_partkey") == F.col("k") + F.col("d"))
    return both.select("name", "p_partkey", similarity.similarity_ratio("name", "part").alias("ratio"))


@query("j6_fuzzy_name", f"""SELECT name, slug, ratio FROM (SELECT e.name, n.slug, {LCS.format(a='e.name', b='n.part')} AS l, 2.0::DOUBLE * l / (length(e.name) + length(n.part)) AS ratio,
  greatest(length(e.name), length(n.part)) - l AS cut FROM {EDITED} e, {PART_NAMES} n) WHERE ratio >= 0.85 QUALIFY row_number() OVER (PARTITION BY name ORDER BY cut, ratio DESC, slug) = 1""")
def _(t):
    return similarity.fuzzy_name_match(_edited_parts(t).select("name"), t.part.select(F.lower("p_name").alias("name"), F.concat(F.lit("part-"), "p_partkey").alias("slug")))


# names of all customers: a part and the digits of the key in syllables, so all differ
SYLLABLES = ("zu", "wan", "tri", "kor", "fim", "sex", "bol", "ney", "gha", "pud")
NAMED = f"""(SELECT c_custkey AS k, 'cust-' || c_custkey AS slug, lower(p_name) || ' ' || array_to_string([{list(SYLLABLES)}[CAST(d AS INT) + 1] FOR d IN string_split(CAST(c_custkey AS VARCHAR), '')], '') AS name
  FROM customer JOIN part ON p_partkey = c_custkey % (SELECT count(*) FROM part))"""
RENAMED = f"""(SELECT k, CASE k % 5 WHEN 0 THEN name WHEN 1 THEN substr(name, 1, 3) || substr(name, 5) WHEN 2 THEN substr(name, 1, 4) || 'x' || substr(name, 6, 3) || 'x' || substr(name, 10)
  WHEN 3 THEN 'q' || substr(name, 1, 6) || 'q' || substr(name, 7, 5) || 'q' || substr(name, 12) ELSE substr(name, 3, 5) || substr(name, 9) || 'v' END AS name FROM {NAMED})"""
LETTERS = "[length({0}) - length(replace({0}, c, '')) FOR c IN string_split('abcdefghijklmnopqrstuvwxyz ', '')]"


def _named(t):
    digits = F.transform(F.split(F.col("c_custkey").cast("string"), ""), lambda d: F.get(F.array(*map(F.lit, SYLLABLES)), d.cast("int")))
    parts = t.part.count()
    both = t.customer.join(t.part, F.col("p_partkey") == F.col("c_custkey") % parts)
    return both.select(
        F.col("c_custkey").alias("k"), F.concat(F.lit("cust-"), "c_custkey").alias("slug"),
        F.concat(F.lower("p_name"), F.lit(" "), F.array_join(digits, "")).alias("name"),
    )


def _renamed(t):
    name, k = F.col("name"), F.col("k") % 5

    def cut(a, n=None):
        return F.substr(name, F.lit(a), F.lit(n)) if n else F.substr(name, F.lit(a))

    return _named(t).select("k", F.when(k == 0, name).when(k == 1, F.concat(cut(1, 3), cut(5)))
        .when(k == 2, F.concat(cut(1, 4), F.lit("x"), cut(6, 3), F.lit("x"), cut(10)))
        .when(k == 3, F.concat(F.lit("q"), cut(1, 6), F.lit("q"), cut(7, 5), F.lit("q"), cut(12)))
        .otherwise(F.concat(cut(3, 5), cut(9), F.lit("v"))).alias("name"))


# letter counts differ by no more than the characters that may be deleted and inserted: it drops no pair that reaches the limit
@query("j6_fuzzy_name_customers", f"""WITH n AS (SELECT *, {LETTERS.format('name')} AS letters FROM {NAMED}), e AS (SELECT DISTINCT name, {LETTERS.format('name')} AS letters FROM {RENAMED}),
 near AS (SELECT e.name, n.name AS held, n.slug FROM e JOIN n ON abs(length(e.name) - length(n.name)) <= 0.15 * (length(e.name) + length(n.name)) + 1e-9
   WHERE list_sum([abs(e.letters[i] - n.letters[i]) FOR i IN range(1, 28)]) <= 0.15 * (length(e.name) + length(n.name)) + 1e-9)
SELECT name, slug, ratio FROM (SELECT name, slug, {LCS.format(a='name', b='held')} AS l, 2.0::DOUBLE * l / (length(name) + length(held)) AS ratio, greatest(length(name), length(held)) - l AS cut FROM near)
 WHERE ratio >= 0.85 QUALIFY row_number() OVER (PARTITION BY name ORDER BY cut, ratio DESC, slug) = 1""")
def _(t):
    return similarity.fuzzy_name_match(_renamed(t).select("name"), _named(t).select("name", "slug"))


@query("x10_similarity_customers", f"""SELECT e.k, e.name, n.name AS held, 2.0::DOUBLE * {LCS.format(a='e.name', b='n.name')} / (length(e.name) + length(n.name)) AS ratio
 FROM {RENAMED} e JOIN {NAMED} n ON n.k = e.k""")
def _(t):
    both = _renamed(t).join(_named(t).select("k", F.col("name").alias("held")), "k")
    return both.select("k", "name", "held", similarity.similarity_ratio("name", "held").alias("ratio"))


def _texts(t):
    return t.documents.select(F.concat(F.lit("doc-"), "doc_id").alias("slug"), "text")


@query("j14_near_duplicate_texts")
def _(t):
    return similarity.near_duplicate_texts(_texts(t), _texts(t)).select("slug", "other_slug", "ratio")


@query("j14_against_benchmark")
def _(t):
    held = t.benchmark.select(F.concat(F.lit("item-"), "item_id").alias("slug"), "text")
    return similarity.near_duplicate_texts(_texts(t), held).select("slug", "other_slug", "ratio")


@query("j15_near_duplicate_zh")
def _(t):
    zh = t.catalog.select("slug", F.concat(F.lit("面向企业的智能搜索平台，支持多模态检索与自动化流程"), F.coalesce("description_zh", F.lit(""))).alias("text"))
    return similarity.near_duplicate_texts(zh, zh).select("slug", "other_slug", "ratio")


# descriptions of all customers made of the names of three of them; every fourth is an edited copy of the next one
WORDS_ZH = ("智能", "搜索", "平台", "助手", "模型", "数据", "语音", "图像", "视频", "安全")
EDITED_TEXT = "substr({0}, 1, 9) || 'zz' || substr({0}, 11, 15) || substr({0}, 27)"


def _described_sql(words, mark, letters):
    spelled = f"array_to_string([{list(words)}[CAST(d AS INT) + 1] FOR d IN string_split(CAST(c_custkey AS VARCHAR), '')], '')"
    counts = "[length({0}) - length(replace({0}, c, '')) FOR c IN string_split('" + letters + "', '')]"
    return f"""WITH w AS (SELECT c_custkey AS k, lower(p_name) || {spelled} AS w FROM customer JOIN part ON p_partkey = c_custkey % (SELECT count(*) FROM part)),
 n AS (SELECT count(*) AS n FROM customer), b AS (SELECT a.k, a.w || '{mark}' || b.w || '{mark}' || c.w AS text FROM w a, n JOIN w b ON b.k = (a.k * 7 + 3) % n JOIN w c ON c.k = (a.k * 13 + 5) % n),
 t AS (SELECT a.k, CASE WHEN a.k % 4 = 0 AND o.text IS NOT NULL THEN {EDITED_TEXT.format('o.text')} ELSE a.text END AS text FROM b a LEFT JOIN b o ON o.k = a.k + 1),
 l AS (SELECT k, text, {counts.format('text')} AS letters FROM t),
 near AS (SELECT a.k, a.text AS a, b.text AS b FROM l a JOIN l b ON a.k <> b.k AND abs(length(a.text) - length(b.text)) <= 0.1 * (length(a.text) + length(b.text)) + 1e-9
  WHERE list_sum([abs(a.letters[i] - b.letters[i]) FOR i IN range(1, {len(letters) + 1})]) <= 0.1 * (length(a.text) + length(b.text)) + 1e-9)
SELECT DISTINCT concat('cust-', k) AS slug FROM (SELECT k, {LCS.format(a='a', b='b')} AS l, length(a) + length(b) AS n FROM near) WHERE 2 * l >= 0.9 * n - 1e-9"""


def _described(t, words, mark):
    digits = F.transform(F.split(F.col("c_custkey").cast("string"), ""), lambda d: F.get(F.array(*map(F.lit, words)), d.cast("int")))
    n, parts = t.customer.count(), t.part.count()
    w = t.customer.join(t.part, F.col("p_partkey") == F.col("c_custkey") % parts).select(
        F.col("c_custkey").alias("k"), F.concat(F.lower("p_name"), F.array_join(digits, "")).alias("w"))
    b = w.join(w.select(F.col("k").alias("k2"), F.col("w").alias("w2")), F.col("k2") == (F.col("k") * 7 + 3) % n).join(
        w.select(F.col("k").alias("k3"), F.col("w").alias("w3")), F.col("k3") == (F.col("k") * 13 + 5) % n,
    ).select("k", F.concat_ws(mark, "w", "w2", "w3").alias("text"))
    other = b.select((F.col("k") - 1).alias("k"), F.col("text").alias("other"))
    edited = F.expr(EDITED_TEXT.format("other"))
    return b.join(other, "k", "left").select(
        F.concat(F.lit("cust-"), "k").alias("slug"), F.when((F.col("k") % 4 == 0) & F.col("other").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


@query("j14_near_duplicate_descriptions", _described_sql(SYLLABLES, ", ", "abcdefghijklmnopqrstuvwxyz, "))
def _(t):
    texts = _described(t, SYLLABLES, ", ")
    return similarity.near_duplicate_texts(texts, texts).select("slug")


@query("j15_near_duplicate_descriptions_zh", _described_sql(WORDS_ZH, "、", "".join(sorted(set("".join(WORDS_ZH)))) + "、abcdefghijklmnopqrstuvwxyz "))
def _(t):
    texts = _described(t, WORDS_ZH, "、")
    return similarity.near_duplicate_texts(texts, texts).select("slug")


# ---------------------------------------------------------------- cross-validation


def _candidates(t):
    """Orders that bring names and URLs, some of them owned by customers."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select(
        F.concat(F.lit("order-"), k).alias("slug"), k.alias("seq"),
        F.when(k % 5 == 0, F.concat(F.lit("客户"), c)).otherwise(F.concat(F.lit("Order "), k)).alias("name"),
        F.when(k % 4 == 0, F.concat(F.lit("客户"), c)).when(k % 4 == 1, F.format_string("customer#%09d", c)).when(k % 4 == 2, F.concat(F.lit("订单"), k)).alias("name_zh"),
        F.when(k % 6 == 0, F.concat(F.lit("https://www.c"), c % 997, F.lit(".example.com/p/"), c)).when(k % 6 == 1, F.concat(F.lit("https://www.toolify.ai/"), k))
        .when(k % 6 == 2, F.concat(F.lit("https://o.example/"), (k / 12).cast("long"))).alias("product_url"),
        F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("description_zh"),
    )


CAND = """k AS (SELECT 'order-' || o_orderkey AS slug, o_orderkey AS seq, CASE WHEN o_orderkey % 5 = 0 THEN '客户' || o_custkey ELSE 'Order ' || o_orderkey END AS name,
  CASE o_orderkey % 4 WHEN 0 THEN '客户' || o_custkey WHEN 1 THEN 'customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') WHEN 2 THEN '订单' || o_orderkey END AS name_zh,
  CASE o_orderkey % 6 WHEN 0 THEN 'https://www.c' || (o_custkey % 997) || '.example.com/p/' || o_custkey WHEN 1 THEN 'https://www.toolify.ai/' || o_orderkey WHEN 2 THEN 'https://o.example/' || (o_orderkey // 12) END AS product_url FROM orders)"""
V = "WITH " + bound(CATALOG, "c") + ", " + CAND + " "


def _first_claim(c: str) -> str:
    return f"(SELECT {c} AS v, arg_min(slug, seq) AS owner, min(seq) AS s FROM k WHERE {c} <> '' GROUP BY {c})"


@query("j11_name_zh_owned", V + "SELECT DISTINCT k.slug, k.name_zh FROM k JOIN c ON (c.name_zh = k.name_zh OR lower(c.name) = lower(k.name_zh)) AND c.slug <> k.slug")
def _(t):
    k = crossval.equality_violations(_candidates(t).select("slug", "seq", F.lit(None).cast("string").alias("name"), "name_zh", F.lit(None).cast("string").alias("product_url")), t.catalog)
    owned = k.filter(F.col("conflicting_slug").startswith("customer"))
    return owned.select(F.col("target_slug").alias("slug"), F.col("rejected_value").alias("name_zh"))


@query("j12_name_owned", V + "SELECT DISTINCT k.slug, k.name FROM k JOIN c ON c.name_zh = k.name AND c.slug <> k.slug")
def _(t):
    none = F.lit(None).cast("string")
    k = crossval.equality_violations(_candidates(t).select("slug", "seq", "name", none.alias("name_zh"), none.alias("product_url")), t.catalog)
    return k.select(F.col("target_slug").alias("slug"), F.col("rejected_value").alias("name"))


@query("j13_url_owned", V + "SELECT DISTINCT k.slug, k.product_url, c.slug AS conflicting_slug FROM k JOIN c ON c.product_url = k.product_url AND c.slug <> k.slug")
def _(t):
    none = F.lit(None).cast("string")
    k = crossval.equality_violations(_candidates(t).select("slug", "seq", none.alias("name"), none.alias("name_zh"), "product_url"), t.catalog)
    return k.filter(F.col("conflicting_slug").startswith("customer")).select(F.col("target_slug").alias("slug"), F.col("rejected_value").alias("product_url"), "conflicting_slug")


@query("w4_batch_claims", V + f"SELECT k.slug, k.product_url, f.owner AS conflicting_slug FROM k JOIN {_first_claim('product_url')} f ON f.v = k.product_url WHERE f.owner <> k.slug AND NOT EXISTS (SELECT 1 FROM c WHERE c.product_url = k.product_url)")
def _(t):
    none = F.lit(None).cast("string")
    k = crossval.equality_violations(_candidates(t).select("slug", "seq", none.alias("name"), none.alias("name_zh"), "product_url"), t.catalog)
    return k.filter(F.col("conflicting_slug").startswith("order")).select(F.col("target_slug").alias("slug"), F.col("rejected_value").alias("product_url"), "conflicting_slug")


@query("c4_cross_validate", V + f"""SELECT slug, 'product_url' AS field, 'product_url points to aggregator site ''toolify.ai''' AS reason, 'error' AS severity FROM k WHERE split_part(split_part(product_url, '//', 2), '/', 1) IN ('www.{AGGREGATOR_HOSTS[3]}')
  UNION ALL SELECT k.slug, 'product_url', 'product_url already belongs to product ''' || coalesce(o.slug, f.owner) || '''', 'error' FROM k LEFT JOIN (SELECT product_url, max(slug) AS slug FROM c GROUP BY 1) o USING (product_url) LEFT JOIN {_first_claim('product_url')} f ON f.v = k.product_url
    WHERE (o.slug IS NOT NULL OR f.owner <> k.slug) AND NOT contains(k.product_url, 'toolify')
  UNION ALL SELECT k.slug, 'name', 'name ''' || k.name || ''' matches name_zh of ''' || c.slug || '''', 'error' FROM k JOIN c ON c.name_zh = k.name
  UNION ALL SELECT k.slug, 'name_zh', CASE WHEN z.slug IS NOT NULL THEN 'name_zh ''' || k.name_zh || ''' already belongs to product ''' || z.slug || '''' WHEN n.slug IS NOT NULL THEN 'name_zh ''' || k.name_zh || ''' matches English name of ''' || n.slug || '''' ELSE 'name_zh ''' || k.name_zh || ''' already belongs to product ''' || f.owner || '''' END, 'error'
    FROM k LEFT JOIN c z ON z.name_zh = k.name_zh LEFT JOIN c n ON lower(n.name) = lower(k.name_zh) LEFT JOIN {_first_claim('name_zh')} f ON f.v = k.name_zh WHERE z.slug IS NOT NULL OR n.slug IS NOT NULL OR f.owner <> k.slug""")
def _(t):
    v = crossval.cross_validate(_candidates(t), t.catalog)
    return v.select(F.col("target_slug").alias("slug"), "field", "reason", "severity")


def near_description(k):
    """Of seven rows two with a near copy of a customer's description, the others with a text of their own."""
    own = F.concat(F.lit("Purchase "), k * 7919 % 99991, F.lit(" was paid at counter "), k * 104729 % 9973, F.lit(" on a rainy day"))
    return F.when(k % 7 == 0, F.concat(F.format_string("Customer#%09d", k % 1000), F.lit(" builds an AI search engine for machinery, and robotics"))).when(
        k % 7 == 3, F.concat(F.lit("Open source SDKs by "), F.format_string("Customer#%09d", k % 1000), F.lit(" with real-time API access for enterprise teams"))).otherwise(own)


@query("c4_cross_validate_similar")
def _(t):
    v = crossval.cross_validate(_candidates(t).withColumn("description", near_description(F.col("seq"))), t.catalog)
    return v.select(F.col("target_slug").alias("slug"), "field", "reason", "severity")


@query("j16_company_consistency", "WITH " + bound(CATALOG, "c") + """, f AS (SELECT company_name, arg_min(slug, slug || '.json') AS ref, arg_min(coalesce(country, '?'), slug || '.json') AS ref_country, arg_min(coalesce(founded_year, 0), slug || '.json') AS ref_year FROM c GROUP BY 1)
  SELECT slug AS target_slug, 'company.headquarters.country' AS field, country AS rejected_value, ref AS conflicting_slug FROM c JOIN f USING (company_name) WHERE slug <> ref AND country <> '' AND ref_country NOT IN ('', '?') AND country <> ref_country
  UNION ALL SELECT slug, 'company.founded_year', CAST(founded_year AS VARCHAR), ref FROM c JOIN f USING (company_name) WHERE slug <> ref AND founded_year <> 0 AND ref_year <> 0 AND founded_year <> ref_year""")
def _(t):
    c = t.catalog.select("slug", F.col("company.name").alias("company"), F.col("company.headquarters.country").alias("country"), F.col("company.founded_year").alias("founded_year"))
    return crossval.company_mismatches(c, c).select("target_slug", "field", "rejected_value", "conflicting_slug")

