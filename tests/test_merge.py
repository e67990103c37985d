import datetime
import random

from pyspark.sql import functions as F

from tierweave import schemas
from tierweave.operators import merge

TODAY = datetime.date(2026, 1, 15)


def as_of():
    return F.lit(TODAY)


def product(spark, rows):
    """Catalog frame from partial nested dicts."""
    def fill(dtype, value):
        if value is None or not hasattr(dtype, "fields"):
            return value
        return tuple(fill(f.dataType, value.get(f.name)) for f in dtype.fields)

    return spark.createDataFrame([fill(schemas.PRODUCT, r) for r in rows], schemas.PRODUCT)


def owner(tier):
    return {"source": "seed", "tier": tier, "confidence": 0.5, "updated_at": TODAY}


def entry(tier):
    return tuple(owner(tier).values())


def model(start, tier, history):
    """Records applied one by one."""
    value, owner_tier = start, tier
    for t, v in history:
        if v is None or t == 4:
            continue
        if t == 3 and value not in (None, ""):
            continue
        if owner_tier is not None and t >= owner_tier:
            continue
        value, owner_tier = v, t
    return value, owner_tier


def test_merge_equals_one_by_one_application(spark, records):
    rng = random.Random(5)
    catalog, rows, want, seq = [], [], {}, 0
    for i in range(150):
        slug = f"p{i}"
        start, tier = rng.choice([None, "", "old"]), rng.choice([None, 1, 2, 3, 4])
        prov = {"description": entry(tier)} if tier else {}
        catalog.append({"slug": slug, "name": slug, "description": start, "meta": {"provenance": prov}})
        history = [(rng.randint(1, 4), rng.choice([None, "", f"v{k}", f"w{k}"])) for k in range(rng.randint(0, 6))]
        for t, v in history:
            seq += 1
            rows.append({"seq": seq, "slug": slug, "name": "N", "source": f"s{t}", "source_tier": t, "description": v})
        want[slug] = model(start, tier, history)
    rng.shuffle(rows)
    out = merge.tiered_merge(product(spark, catalog), records(rows, slug=True), as_of()).select(
        "slug", "description", F.try_element_at("meta.provenance", F.lit("description"))["tier"].alias("tier")).collect()
    assert {r.slug: (r.description, r.tier) for r in out} == want


def test_arrays_sources_and_hiring(spark, records):
    cat = product(spark, [
        {"slug": "a", "name": "A", "tags": [f"t{i}" for i in range(19)], "sources": [("https://s/1", "x", TODAY)], "company": {"name": "A"}},
        {"slug": "untouched", "name": "U"},
    ])
    rows = [
        {"seq": 1, "slug": "a", "name": "A b", "source": "s1", "source_tier": 2, "source_url": "https://s/1", "tags": ["t1", "new"],
         "key_people": [("Ann", "CEO", True, None)], "company_total_raised_usd": 5.0},
        {"seq": 2, "slug": "a", "name": "A b", "source": "s2", "source_tier": 4, "source_url": "https://s/2", "tags": ["hidden"],
         "description": "from an advert", "hiring_positions": [("Dev", "Oslo", None, None)], "key_people": [("Ann", "CEO", True, None)]},
        {"seq": 3, "slug": "a", "name": "A b", "source": "s3", "source_tier": 2, "tags": ["late"], "company_total_raised_usd": 9.0},
    ]
    r = {x.slug: x for x in merge.tiered_merge(cat, records(rows, slug=True), as_of()).collect()}
    a, u = r["a"], r["untouched"]
    assert a.tags == [f"t{i}" for i in range(19)] + ["new"]
    assert a.meta.provenance["tags"].source == "s3"  # an addition beyond the limit still counts
    assert [s.url for s in a.sources] == ["https://s/1", "https://s/2"]
    assert a.description is None and a.hiring.is_hiring and a.hiring.last_checked == TODAY
    assert [p.title for p in a.hiring.positions] == ["Dev"]
    assert len(a.key_people) == 1 and a.name == "A"
    assert a.company.url == "https://www.bing.com/search?q=A+b+AI"
    assert a.company.funding.total_raised_usd == 5.0 and a.meta.last_updated == TODAY
    assert u.meta is None and u.sources is None


def test_create_defaults_and_parent_provenance(spark, records):
    rows = [
        {"seq": 1, "slug": "n", "name": "Newco", "source": "s1", "source_tier": 2, "source_url": "https://s/1", "company_total_raised_usd": 5.0,
         "extra": {"twitter": "@n"}, "hiring_positions": [("Dev", "Oslo", None, None)]},
        {"seq": 2, "slug": "n", "name": "Newco", "source": "s2", "source_tier": 2, "company_total_raised_usd": 7.0, "description": "later text"},
    ]
    p = merge.create_products(records(rows, slug=True), as_of()).collect()[0]
    assert p.description == "Newco is an AI product." and p.category == "ai-application" and p.product_url == ""
    assert p.company.social.twitter == "@n" and p.hiring.total_positions == 1
    assert "company.funding" in p.meta.provenance and "product_url" not in p.meta.provenance
    # children of a parent kept whole look unowned, so an equal tier replaces them
    assert p.company.funding.total_raised_usd == 7.0
    last = merge.create_products(records(rows, slug=True), as_of(), last_wins=True).collect()[0]
    assert last.description == "later text" and last.company.funding.total_raised_usd == 7.0
