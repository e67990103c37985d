"""The driver tables seen as catalog, records and listings.

The SELECT texts below run unchanged on Spark and on the comparison engine; they only shape
the data. All operator logic is applied to the frames they give.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.fixed.taxonomy import TAGS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

#: Customers as catalog products, flat. Arrays are '|'-joined text.
CATALOG = """
SELECT concat('customer-', c_custkey) AS slug,
  c_custkey,
  c_name AS name,
  CASE WHEN c_custkey % 5 = 0 THEN concat('客户', c_custkey) END AS name_zh,
  concat('https://www.c', c_custkey % 997, '.example.com/p/', c_custkey) AS product_url,
  CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL
    WHEN 2 THEN concat(c_name, ' builds an AI search engine for ', lower(c_mktsegment), ' and robotics')
    ELSE concat('Open source SDK by ', c_name, ' with real-time API access for enterprise teams') END AS description,
  CASE WHEN c_custkey % 6 = 0 THEN concat('面向企业的智能搜索平台', c_custkey) END AS description_zh,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'ai-hardware' WHEN 'BUILDING' THEN 'ai-infrastructure'
    WHEN 'AUTOMOBILE' THEN 'ai-application' WHEN 'FURNITURE' THEN 'ai-creative-media' END AS category,
  CASE c_custkey % 5 WHEN 0 THEN 'text-generation' WHEN 1 THEN 'legal' WHEN 2 THEN '' END AS sub_category,
  CASE c_custkey % 4 WHEN 0 THEN 'llm' WHEN 1 THEN 'app' WHEN 2 THEN 'framework' END AS product_type,
  CASE WHEN c_acctbal < 0 THEN 'discontinued' WHEN c_acctbal > 9000 THEN 'beta' ELSE 'active' END AS status,
  CASE c_custkey % 3 WHEN 0 THEN 'nlp|rag|trending' WHEN 1 THEN concat('saas|tag', c_custkey % 9) ELSE '' END AS tags_text,
  CASE c_custkey % 4 WHEN 0 THEN 'text|image' WHEN 1 THEN 'text' ELSE '' END AS modalities_text,
  CASE c_custkey % 3 WHEN 0 THEN 'Web|iOS' WHEN 1 THEN 'API' ELSE '' END AS platforms_text,
  CASE c_custkey % 4 WHEN 0 THEN 'MoE Transformer' WHEN 1 THEN 'latent diffusion' END AS architecture,
  CASE c_custkey % 4 WHEN 0 THEN 'freemium' WHEN 1 THEN 'usage-based' WHEN 2 THEN 'paid' END AS pricing_model,
  CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS open_source,
  CASE WHEN c_custkey % 4 = 1 THEN true END AS api_available,
  CASE WHEN c_custkey % 7 = 1 THEN concat('https://github.com/c', c_custkey) ELSE '' END AS repository_url,
  concat('Company ', c_custkey % 400) AS company_name,
  concat('https://c', c_custkey % 997, '.example.com') AS company_url,
  CASE WHEN c_custkey % 3 <> 0 THEN concat('https://c', c_custkey % 997, '.example.com') END AS company_website,
  CASE WHEN c_custkey % 10 <> 0 THEN CAST(1895 + c_custkey % 130 AS INT) END AS founded_year,
  concat('City ', n_nationkey) AS city,
  CASE n_nationkey % 8 WHEN 0 THEN 'China' WHEN 1 THEN 'United States' WHEN 2 THEN 'Germany'
    WHEN 3 THEN 'Japan' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE n_name END AS country,
  CASE n_nationkey % 8 WHEN 0 THEN 'CN' WHEN 1 THEN 'US' WHEN 2 THEN 'DE' WHEN 3 THEN 'JP' END AS country_code,
  CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal * 1000000 END AS total_raised_usd,
  CASE WHEN c_custkey % 11 = 0 THEN c_acctbal * 2000000 END AS valuation_usd,
  CASE c_custkey % 6 WHEN 0 THEN 'seed' WHEN 1 THEN 'series-a' WHEN 2 THEN 'ipo' WHEN 3 THEN 'bridge' END AS last_round,
  CASE WHEN c_custkey % 2 = 0 THEN '11-50' ELSE '' END AS employee_count_range,
  DATE '2020-01-01' + CAST(c_custkey % 1500 AS INT) AS added_date,
  CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_custkey % 100 AS DOUBLE) / 100 END AS data_quality_score,
  CASE WHEN c_custkey % 13 = 0 THEN concat('https://www.ycombinator.com/companies/', c_custkey)
    WHEN c_custkey % 2 = 0 THEN concat('https://src.example.org/', c_custkey) END AS source_link
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

#: Parts as a catalog whose fields carry owners of different tiers.
PART_CATALOG = """
SELECT concat('part-', p_partkey) AS slug, p_name AS name,
  CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('Stock item ', p_name) END AS description,
  CASE WHEN p_partkey % 3 = 0 THEN 'ai-hardware' END AS category,
  CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END AS total_raised_usd,
  CASE p_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 END AS owner_tier,
  CASE WHEN p_partkey % 2 = 1 THEN concat('tag0|', lower(p_type)) ELSE '' END AS tags_text
FROM {part}
"""

#: Line items as records of sources of four tiers. ``seq`` orders them within a product.
RECORDS = """
SELECT concat('part-', l_partkey) AS slug,
  (CAST(year(l_shipdate) - 1990 AS BIGINT) * 384 + month(l_shipdate) * 32 + day(l_shipdate)) * 281474976710656
    + l_orderkey * 8 + l_linenumber AS seq,
  CAST(l_linenumber % 4 + 1 AS INT) AS source_tier,
  concat('src', l_suppkey % 5) AS source,
  concat('https://src', l_suppkey % 5, '.example.org/', l_partkey % 50) AS source_url,
  concat('Part ', l_partkey) AS name,
  CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 8 THEN ''
    ELSE concat('Shipment ', l_returnflag, l_linestatus, ' of order ', l_orderkey) END AS description,
  CASE l_returnflag WHEN 'A' THEN 'ai-application' WHEN 'N' THEN 'ai-data-platform' END AS category,
  CASE WHEN l_discount > 0.02 THEN l_extendedprice END AS company_total_raised_usd,
  concat('tag', l_suppkey % 7, '|tag', l_linenumber) AS tags_text
FROM {lineitem}
"""

#: Orders as job listings of one customer each.
LISTINGS = """
SELECT o_orderkey AS seq,
  concat(' Customer ', o_custkey, ' ') AS name,
  concat('board', o_orderkey % 3) AS source,
  concat('https://board.example.org/', o_orderkey) AS source_url,
  CASE WHEN o_custkey % 2 = 0 THEN concat('https://www.Cust', o_custkey, '.example.com/jobs/', o_orderkey) END AS company_website,
  CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN concat('Order ', o_orderkey) END AS description,
  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(1990 + o_orderkey % 30 AS INT) ELSE 0 END AS company_founded_year,
  CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS open_source,
  concat(lower(o_orderpriority), '|', o_orderstatus) AS tags_text
FROM {orders}
"""

#: Incoming records about customers: some known by URL, some by name, some new.
INCOMING = """
SELECT o_orderkey AS seq,
  CASE o_orderkey % 6
    WHEN 0 THEN concat('Customer#', lpad(CAST(o_custkey AS VARCHAR(20)), 9, '0'))
    WHEN 1 THEN concat('客户', o_custkey)
    WHEN 2 THEN concat('customer ', o_custkey)
    WHEN 3 THEN concat('Newcomer ', o_orderkey, ' Systems, Inc.')
    WHEN 4 THEN concat('X', o_orderkey)
    ELSE concat('Vendor Q', o_orderkey) END AS name,
  CASE WHEN o_orderkey % 6 = 3 AND o_orderkey % 4 = 0 THEN concat('客户', o_custkey) END AS name_zh,
  CASE WHEN o_orderkey % 6 = 4 THEN concat('https://www.c', o_custkey % 1200, '.example.com/x') 
    WHEN o_orderkey % 12 = 5 THEN concat('https://new', o_orderkey, '.example.net/') END AS product_url,
  CASE WHEN o_orderkey % 6 = 5 THEN concat('http://c', o_custkey % 1200, '.example.com') END AS company_website,
  concat('feed', o_orderkey % 4) AS source,
  CAST(o_orderkey % 3 + 1 AS INT) AS source_tier,
  concat('https://feed.example.org/', o_orderkey) AS source_url,
  CASE o_orderstatus WHEN 'F' THEN 'short' WHEN 'O' THEN concat('A longer description of order ', o_orderkey) END AS description,
  CASE o_orderkey % 4 WHEN 0 THEN 'AI App' WHEN 1 THEN 'ai-data' WHEN 2 THEN 'unknown thing' END AS category,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(1890 + o_orderkey % 150 AS INT) END AS company_founded_year,
  CASE o_orderkey % 7 WHEN 0 THEN ' usa ' WHEN 1 THEN 'UK' WHEN 2 THEN 'Remote' WHEN 3 THEN 'Atlantis ' WHEN 4 THEN '' WHEN 5 THEN 'de' END AS company_headquarters_country,
  CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS company_total_raised_usd,
  CASE WHEN o_orderkey % 3 = 0 THEN '11-50' ELSE '' END AS company_employee_count_range
FROM {orders}
"""

# Phrases that touch every family of text rules.
PHRASES = (
    "Transformer based retrieval-augmented chatbot", "diffusion text to image generator",
    "open source SDK and command line tool", "SaaS platform, free tier, REST API",
    "robotic drone for autonomous vehicles", "data analytics for finance and trading",
    "speech recognition and text-to-speech", "customer support and CRM sales tool",
    "medical imaging and drug discovery", "edge AI, real-time, low latency on device",
    "machine learning engineer for LLM research", "大模型 算法 工程师", "code generation copilot",
    "email assistant powered by AI", "game design with AI", "plain hardware without keywords",
)

#: Parts with a text that exercises the rules.
PART_TEXT = "SELECT p_partkey, concat('part-', p_partkey) AS slug, concat_ws(' ', p_name, p_type, CASE p_partkey % {n} {cases} END) AS text FROM {{part}}".format(
    n=len(PHRASES), cases=" ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES)),
)


def sql_text(binding: str) -> str:
    """The binding over the plain table names."""
    return binding.format(**{t: t for t in TABLES})


def _split(c: str):
    return F.when(F.col(c) != "", F.split(c, r"\|"))


class Tables:
    """Lazily opened driver tables and the frames bound to them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def bind(self, binding: str) -> DataFrame:
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in binding}
        return self.spark.sql(binding, **used)

    @cached_property
    def flat_catalog(self) -> DataFrame:
        return self.bind(CATALOG)

    @cached_property
    def catalog(self) -> DataFrame:
        """Customers as nested products."""
        f = self.flat_catalog
        today = F.col("added_date")
        empty = F.lit(None)
        shaped = f.withColumns({
            "tags": _split("tags_text"), "modalities": _split("modalities_text"),
            "platforms": _split("platforms_text"),
            "pricing": F.when(F.col("pricing_model").isNotNull(), F.struct(F.col("pricing_model").alias("model"), empty.cast("boolean").alias("has_free_tier"))),
            "company": F.struct(
                F.col("company_name").alias("name"), empty.cast("string").alias("name_zh"),
                F.col("company_url").alias("url"), F.col("company_website").alias("website"),
                empty.cast("string").alias("wikipedia_url"), empty.cast("string").alias("logo_url"),
                empty.cast("string").alias("description"), F.col("founded_year"),
                F.struct("city", empty.cast("string").alias("state"), "country", "country_code").alias("headquarters"),
                F.when(F.coalesce("total_raised_usd", "valuation_usd").isNotNull() | F.col("last_round").isNotNull(), F.struct(
                    "total_raised_usd", "last_round", empty.cast("string").alias("last_round_date"),
                    "valuation_usd", empty.cast("array<string>").alias("investors"))).alias("funding"),
                "employee_count_range", empty.cast(schemas.SOCIAL).alias("social"),
            ),
            "sources": F.when(F.col("source_link").isNotNull(), F.array(F.struct(
                F.col("source_link").alias("url"), F.lit("seed").alias("source_name"), today.alias("scraped_at")))),
            "meta": F.struct(
                today.alias("added_date"), today.alias("last_updated"), "data_quality_score",
                empty.cast("boolean").alias("needs_review"),
                empty.cast(schemas.META["provenance"].dataType).alias("provenance"),
            ),
        })
        return schemas.conform(shaped, schemas.PRODUCT)

    @cached_property
    def part_catalog(self) -> DataFrame:
        """Parts as nested products with provenance."""
        f = self.bind(PART_CATALOG)
        entry = F.struct(
            F.lit("seed").alias("source"), F.col("owner_tier").cast("int").alias("tier"),
            F.lit(0.5).alias("confidence"), F.lit("2024-01-01").cast("date").alias("updated_at"),
        )
        paths = ("description", "category", "company.funding.total_raised_usd")
        owned = F.when(F.col("owner_tier").isNotNull(), F.map_from_arrays(
            F.array(*[F.lit(p) for p in paths]), F.array(*[entry for _ in paths])))
        company = F.struct(*[
            (F.struct(F.col("total_raised_usd"), *[F.lit(None).cast(x.dataType).alias(x.name) for x in schemas.FUNDING.fields[1:]])
             if x.name == "funding" else F.lit(None).cast(x.dataType)).alias(x.name)
            for x in schemas.COMPANY.fields
        ])
        meta = F.struct(*[
            (owned if x.name == "provenance" else F.lit(None)).cast(x.dataType).alias(x.name) for x in schemas.META.fields
        ])
        return schemas.conform(f.withColumns({"tags": _split("tags_text"), "company": company, "meta": meta}), schemas.PRODUCT)

    def _records(self, binding: str, *extra: str) -> DataFrame:
        df = self.bind(binding)
        if "tags_text" in df.columns:
            df = df.withColumn("tags", _split("tags_text"))
        return df.select(*extra, *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.RECORD.fields
        ])

    @cached_property
    def records(self) -> DataFrame:
        return self._records(RECORDS, "slug")

    @cached_property
    def listings(self) -> DataFrame:
        return self._records(LISTINGS)

    @cached_property
    def incoming(self) -> DataFrame:
        return self._records(INCOMING)

    @cached_property
    def part_text(self) -> DataFrame:
        return self.bind(PART_TEXT)

    @cached_property
    def tags(self) -> DataFrame:
        """(dimension, tag_id) of the vocabulary: 114 fixed rows."""
        return self.spark.createDataFrame([(d, t) for d, t, *_ in TAGS], "dimension string, tag_id string")
