from tierweave.operators import resolve


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_a_record_are_computed_once(records):
    rows = [
        {"seq": 1, "name": "Café Zoë", "product_url": "https://www.A.example/x"},
        {"seq": 2, "name": "Plain Name", "company_website": "http://b.example", "product_url": ""},
        {"seq": 3, "name": "客户", "name_zh": "客户"},
    ]
    probes = resolve._probes(records(rows), ())
    plan = plan_of(probes)
    # a slug reads its folded name twice; a domain is cut out of one address each
    assert plan.count("translate(") == 2
    assert plan.count("^www") == 2
    assert sorted((r.seq, r.kind, r.key) for r in probes.collect()) == [
        (1, "domain", "a.example"), (1, "name", "café zoë"), (1, "slug", "cafe-zoe"), (1, "zh_lower", "café zoë"),
        (2, "domain", "b.example"), (2, "name", "plain name"), (2, "slug", "plain-name"), (2, "zh_lower", "plain name"),
        (3, "name", "客户"), (3, "zh", "客户"), (3, "zh_lower", "客户"),
    ]
