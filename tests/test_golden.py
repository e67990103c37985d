"""Cases with answers written down by hand, so that a wrong entry of a fixed table cannot pass on both sides."""

import json
import time

import pytest

from pyspark.sql import functions as F
from test_merge import product
from tierweave import schemas
from tierweave.operators.crossval import company_mismatches, cross_validate
from tierweave.operators.gaps import find_gaps, parse_answer
from tierweave.operators.resolve import resolve
from tierweave.operators.tags import infer_tags, quality_score
from tierweave.operators.validate import validate_schema
from tierweave.sources.catalog_io import corrupt_records
from tierweave.sources.extract import job_listings

PHRASES = {
    "built on a transformer-based language model": "transformer", "uses diffusion techniques to generate": "diffusion-model",
    "RAG-powered answers from your files": "rag", "a retrieval augmented generation stack": "rag", "multimodal AI helper": "multimodal",
    "NLP engine": "nlp", "natural language understanding kit": "nlp", "computer vision on factory lines": "computer-vision",
    "reinforcement learning in simulation": "reinforcement-learning", "fine-tuning LLMs with your data": "fine-tuning",
    "vector embeddings for retrieval": "embedding", "speech to text for calls": "speech-to-text", "automatic speech recognition (ASR)": "speech-to-text",
    "text to image studio": "text-to-image", "AI image generator": "text-to-image", "text to video studio": "text-to-video",
    "AI video generator": "text-to-video", "text to speech voices": "text-to-speech", "voice cloning": "text-to-speech",
    "code generation for teams": "code-generation", "a coding assistant": "copilot", "an AI copilot": "copilot", "AI chatbot for shops": "chatbot",
    "conversational AI suite": "chatbot", "healthcare AI for clinics": "healthcare", "medical imaging": "healthcare",
    "drug discovery at scale": "drug-discovery", "autonomous vehicles stack": "autonomous-vehicles", "self-driving car software": "autonomous-vehicles",
    "AI for gaming studios": "gaming", "defense and military AI": "defense", "climate change forecasts": "climate-energy", "robotics platform": "robotics",
    "humanoid robot hands": "humanoid-robot", "open source LLM kit": "open-source", "SaaS platform": "saas", "freemium AI app": "freemium",
    "self-hosted deployment": "self-hosted", "enterprise AI suite": "enterprises", "developer tool for AI apps": "developers",
}
CATEGORIES = {
    "ai-foundation-model": {"nlp", "researchers"}, "ai-application": {"consumers"}, "ai-creative-media": {"creators", "content-creation"},
    "ai-dev-platform": {"developers"}, "ai-infrastructure": {"developers", "enterprises"}, "ai-data-platform": {"data-analysis", "data-scientists"},
    "ai-search-retrieval": {"search-engine"}, "ai-hardware": {"robotics"}, "ai-enterprise-vertical": {"enterprises", "b2b"},
}
TYPES = {
    "model": {"researchers", "developers"}, "library": {"developers", "sdk"}, "api": {"developers", "api-service", "api-platform"},
    "dataset": {"researchers", "data-scientists"},
}
COUNTRIES = {"China": "china", "United States": "us", "Japan": "japan", "South Korea": "korea", "United Kingdom": "europe", "Germany": "europe", "France": "europe"}
#: extra fields, tags that must be there, tags that must not
FIELDS = [
    ({"open_source": True}, {"open-source"}, {"closed-source"}), ({"open_source": False}, {"closed-source"}, {"open-source"}),
    ({"repository_url": "https://github.com/a/b"}, {"open-source"}, set()), ({"api_available": True}, {"api-service"}, set()),
    ({"modalities": ["text", "image", "audio"]}, {"multimodal"}, set()), ({"modalities": ["text"]}, set(), {"multimodal"}),
    ({"architecture": "Transformer-based"}, {"transformer"}, set()), ({"architecture": "Mixture of Experts"}, {"moe"}, set()),
    ({"pricing": {"model": "freemium"}}, {"freemium"}, set()),
    ({"company": {"name": "C", "url": "https://c", "funding": {"valuation_usd": 2e9}}}, {"unicorn"}, {"decacorn"}),
    ({"company": {"name": "C", "url": "https://c", "funding": {"valuation_usd": 1.5e10}}}, {"decacorn"}, {"unicorn"}),
    ({"open_source": False, "description": "beats open source rivals"}, {"closed-source"}, {"open-source"}),
    ({"open_source": True, "description": "an open source AI kit"}, {"open-source"}, {"closed-source"}),
    ({"tags": ["transformer", "rag"]}, {"transformer", "rag"}, set()),
]


def some(i, **fields):
    return {
        "slug": f"g{i:03d}", "name": "Some Thing", "description": "Plain words", "category": "ai-application", "product_type": "app",
        "company": {"name": "C", "url": "https://c"}, "tags": [], **fields,
    }


def test_tags(spark):
    cases = [({"description": text}, {tag}, set()) for text, tag in PHRASES.items()]
    cases += [({"category": c}, tags, set()) for c, tags in CATEGORIES.items()]
    cases += [({"product_type": t}, tags, set()) for t, tags in TYPES.items()]
    cases += [({"company": {"name": "C", "url": "https://c", "headquarters": {"country": c}}}, {tag}, set()) for c, tag in COUNTRIES.items()]
    cases += FIELDS
    crowded = " ".join(PHRASES)
    cases.append(({"description": crowded, "open_source": True, "api_available": True, "modalities": ["text", "image", "audio", "video"]}, set(), set()))
    frame = product(spark, [some(i, **fields) for i, (fields, _, _) in enumerate(cases)])
    got = {r.slug: r.tags for r in infer_tags(frame).select("slug", "tags").collect()}
    for i, (fields, there, not_there) in enumerate(cases):
        tags = got[f"g{i:03d}"]
        assert there <= set(tags) and not not_there & set(tags) and len(tags) == len(set(tags)) <= 20, (fields, tags)
    empty = product(spark, [{"slug": "e", "name": "", "description": "", "category": "", "product_type": ""}])
    assert len(infer_tags(empty).first().tags or []) >= 0


def test_tags_of_a_hostile_text_within_two_seconds(spark):
    def run(text):
        frame = product(spark, [some(0, description=text)])
        start = time.monotonic()
        infer_tags(frame).select("tags").collect()
        return time.monotonic() - start

    run("warm up")
    plain = run("plain")
    # what the text itself costs, without the time that Spark takes to plan
    assert run("design " + "x " * 5000 + " end") - plain < 2.0


OWNERS = [
    {"slug": "alpha", "name": "Alphabot", "name_zh": "阿尔法", "product_url": "https://alpha.example", "company": {"name": "Alpha Co"},
     "description": "Assistant of Alpha Co for talking and for creative writing at home",
     "description_zh": "阿尔法公司推出的对话助手，支持多轮对话以及创意写作等功能"},
    {"slug": "beta", "name": "Beta", "product_url": "https://beta.example", "description": "A careful assistant that was built for safety first", "company": {"name": "Beta Co"}},
    {"slug": "gamma", "name": "Gamma", "name_zh": "伽马", "company": {"name": "Gamma Co", "headquarters": {"country": "China"}, "founded_year": 2019}},
]
#: slug, field, value, owner it collides with
CLAIMS = [
    ("beta", "name_zh", "阿尔法", "alpha"), ("alpha", "name_zh", "阿尔法", None), ("beta", "name_zh", "贝塔", None), ("other", "name_zh", "Beta", "beta"),
    ("other", "name", "阿尔法", "alpha"), ("other", "name", "Fresh", None), ("other", "product_url", "https://beta.example", "beta"),
    ("beta", "product_url", "https://beta.example", None), ("other", "product_url", "https://www.producthunt.com/x", ""),
    ("beta", "description_zh", "阿尔法公司推出的对话助手，支持多轮对话以及创意写作等功能呢", "alpha"), ("beta", "description_zh", "阿尔法助手", None),
    ("beta", "description_zh", "贝塔公司推出的安全助手，专注于有益而且诚实的人机交互体验", None),
    ("beta", "description", "Assistant of Alpha Co for talking and for creative writing at homes", "alpha"),
    ("beta", "description", "Something that reads nothing like what the other products say", None),
    ("beta", "name_zh", "", None), ("beta", "name_zh", None, None),
]


def test_cross_validation(spark, records):
    rows = [{"seq": i, "slug": slug, "source": "s", "source_tier": 1, field: value} for i, (slug, field, value, _) in enumerate(CLAIMS)]
    got = {r.seq: (r.field, r.conflicting_slug) for r in cross_validate(
        records(rows, slug=True), product(spark, OWNERS), new=F.lit(False)).collect()}
    # a value that is rejected claims nothing, and the others are claimed once each
    assert got == {i: (field, owner) for i, (_, field, _, owner) in enumerate(CLAIMS) if owner is not None}


def test_company_warnings(spark):
    held = spark.createDataFrame([("gamma", "Gamma Co", "China", 2019)], "slug string, company string, country string, founded_year int")
    asked = [("n1", "Gamma Co", "United States", 2019), ("n2", "Gamma Co", "China", 2015), ("n3", "Gamma Co", "China", 2019), ("gamma", "Gamma Co", "Japan", 1999)]
    got = company_mismatches(spark.createDataFrame(asked, held.schema), held).collect()
    assert {(r.target_slug, r.field, r.severity) for r in got} == {("n1", "company.headquarters.country", "warning"), ("n2", "company.founded_year", "warning")}


def test_resolution(spark, records):
    held = product(spark, [
        {"slug": "open", "name": "OpenThing", "product_url": "https://chat.open.example", "company": {"name": "Open", "website": "https://open.example"}},
        {"slug": "beta", "name": "Beta Chat", "product_url": "https://beta.example"},
    ])
    rows = [
        {"seq": 1, "name": "Open Inc", "company_website": "https://open.example/about"}, {"seq": 2, "name": "beta chat"},
        {"seq": 3, "name": "Brand New", "product_url": "https://new.example"}, {"seq": 4, "name": "Z", "product_url": "https://chat.open.example"},
        {"seq": 5, "name": "Beta Chatt"},
    ]
    got = {r.seq: r.match_slug for r in resolve(records([r | {"source": "s", "source_tier": 2} for r in rows]), held).collect()}
    assert got == {1: "open", 2: "beta", 3: None, 4: "open", 5: "beta"}


def test_quality(spark):
    full = {
        "name": "T", "product_url": "https://t", "description": "A whole product.", "product_type": "llm", "category": "ai-model", "sub_category": "s",
        "icon_url": "https://t/i", "architecture": "transformer", "modalities": ["text"], "platforms": ["web"], "api_available": True, "open_source": True,
        "repository_url": "https://g/t", "pricing": {"model": "freemium"}, "tags": ["ai"], "keywords": ["k"], "status": "active", "description_zh": "产品",
        "company": {"name": "C", "url": "https://c", "website": "https://c", "founded_year": 2020, "headquarters": {"city": "S", "country": "US"}, "description": "d",
                    "funding": {"total_raised_usd": 1e6}},
        "key_people": [("J", "CEO", False)], "sources": [("https://t", "t", None)],
    }
    few = {"name": "M", "product_url": "https://m", "description": "A product.", "product_type": "app", "category": "ai-app", "status": "active"}
    rows = {"full": full, "few": few, "none": {}, "name": {"name": "T"}, "blank": {"name": "T", "description": "", "product_url": "   "}, "lists": {"name": "T", "tags": [], "keywords": []}, "nested": {"company": {"name": "C", "url": "https://c"}}}
    frame = product(spark, [{"slug": s, **{k: v for k, v in r.items() if k not in ("key_people", "sources")}} for s, r in rows.items()])
    person = schemas.field_type(schemas.PRODUCT, "key_people").elementType
    frame = frame.withColumn("key_people", F.when(F.col("slug") == "full", F.array(F.struct(*[F.lit("x" if f.dataType.simpleString() == "string" else None).cast(f.dataType).alias(f.name) for f in person.fields]))))
    link = schemas.field_type(schemas.PRODUCT, "sources").elementType
    frame = frame.withColumn("sources", F.when(F.col("slug") == "full", F.array(F.struct(*[F.lit("x" if f.dataType.simpleString() == "string" else None).cast(f.dataType).alias(f.name) for f in link.fields]))))
    got = {r.slug: r.score for r in frame.select("slug", quality_score().alias("score")).collect()}
    assert got["full"] >= 0.9 and got["few"] < 0.5 and got["none"] == 0.0
    assert got["name"] == got["blank"] == got["lists"] and 0 < got["nested"] < 1


def test_schema(spark, tmp_path):
    right = {"slug": "t", "name": "T", "product_url": "https://t", "description": "Long enough text", "product_type": "app", "category": "ai-application", "status": "active"}
    rows = [right, {"slug": "u", "name": "T"}, {**right, "slug": "v", "category": "made-up"}, {**right, "slug": "w", "product_type": "made-up"}]
    got = {r.slug: r for r in validate_schema(product(spark, rows), F.col("slug")).collect()}
    assert got["t"].valid, got["t"].errors
    assert not got["u"].valid and any("required" in e for e in got["u"].errors)
    assert not got["v"].valid and not got["w"].valid
    other = validate_schema(product(spark, [right]), F.lit("another")).first()
    assert not other.valid and any("slug mismatch" in e.lower() for e in other.errors)
    (tmp_path / "broken.json").write_text("{not json")
    assert corrupt_records(spark, str(tmp_path)).count() == 1


#: field, answer, value that is taken
ANSWERS = [
    ("product_type", "llm", "llm"), ("product_type", "odd", None), ("category", "ai-foundation-model", "ai-foundation-model"), ("category", "bad", None),
    ("status", "beta", "beta"), ("status", "unknown", None), ("pricing_model", "freemium", "freemium"), ("pricing_model", "custom", None),
    ("open_source", True, True), ("open_source", False, False), ("open_source", "yes", None), ("description", "Fine text", "Fine text"),
    ("description", "x", None), ("description", "", None), ("description", None, None), ("architecture", "  transformer  ", "transformer"),
    ("tags", ["ai", "ml"], ["ai", "ml"]), ("tags", ["ai", 123, None, "ml"], ["ai", "ml"]), ("tags", [], None), ("tags", [123, None], None), ("tags", "ai", None),
]


def test_answers(spark):
    rows = [(i, field, json.dumps({field: answer, "extra": 1})) for i, (field, answer, _) in enumerate(ANSWERS)]
    rows += [(90, "tags", "not json"), (91, "tags", "[1, 2]"), (92, "tags", '```json\n{"tags": ["ai"]}\n```'), (93, "status", json.dumps({"tags": ["ai"]}))]
    frame = spark.createDataFrame(rows, "i int, field string, response string")
    values = parse_answer(F.col("response"), F.array("field"))
    got = {r.i: {f: r[f] for f in values if r[f] is not None} for r in frame.select("i", *[c.alias(f) for f, c in values.items()]).collect()}
    for i, (field, _, want) in enumerate(ANSWERS):
        assert got[i] == ({} if want is None else {field: want}), (field, got[i])
    assert got[90] == got[91] == got[93] == {} and got[92] == {"tags": ["ai"]}


def test_gaps(spark):
    sparse = {"slug": "s", "name": "S", "description": "Text", "product_type": "app", "category": "ai-application", "status": "active", "tags": []}
    blank = {**sparse, "slug": "b", "description": ""}
    got = {r.slug: set(r.gaps) for r in product(spark, [sparse, blank]).select("slug", find_gaps().alias("gaps")).collect()}
    assert {"description_zh", "sub_category", "tags", "modalities"} <= got["s"] and not {"description", "product_type", "category", "status"} & got["s"]
    assert "description" in got["b"]


PAGES = {
    "headings": ("\n## [大模型算法工程师](https://j.example/1)\n华章科技·北京·1000-9999人\n\n## [计算机视觉研究员](https://j.example/2)\n南方公司·深圳·10000人以上\n\n## [自然语言处理工程师](https://j.example/3)\n百川公司·北京·10000人以上\n", {"华章科技", "南方公司", "百川公司"}),
    "table": ("\n| 职位 | 公司 | 地点 |\n| --- | --- | --- |\n| ML Engineer | First Lab | Paris |\n| AI Researcher | Second Lab | London |\n| Data Scientist | Third Lab | London |\n", {"First Lab", "Second Lab", "Third Lab", "---"}),  # the rule under the header counts as a row
    "nothing": ("short", set()),
    "menu": ("\n## 首页\n登录\n\n## [大模型工程师](https://j.example/1)\n华章科技·北京\n" + "一些别的文字" * 20, {"华章科技"}),
}


@pytest.mark.parametrize("kind", PAGES)
def test_job_pages(spark, kind):
    body, want = PAGES[kind]
    frame = schemas.conform(spark.createDataFrame([(1, "u", "jobs", "html", body)], "seq long, url string, source string, format string, body string"), schemas.LANDED)
    got = {r.company_name for r in job_listings(frame).collect()}
    # the line under a heading is taken whole, with the place behind the company
    assert {name.split("·")[0] for name in got} == want
