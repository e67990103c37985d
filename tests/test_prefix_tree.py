import random
from math import ceil

from test_similarity import slow_lcs
from tierweave.operators import prefix_tree, similarity


def need(la, lb):
    return ceil(0.85 * (la + lb) / 2 - 1e-9)


def test_tree_search_equals_brute_force(monkeypatch):
    # steps of few rows, so that they are cut
    monkeypatch.setattr(prefix_tree, "STEP_ROWS", 50)
    rng = random.Random(5)
    held = {"".join(rng.choice("ab人") for _ in range(rng.randint(1, 14))): f"s{i:03d}" for i in range(120)}
    asked = {"".join(rng.choice("ab人x") for _ in range(rng.randint(1, 14))) for _ in range(80)}
    got = {t: (cut, slug, ratio) for t, slug, ratio, cut in prefix_tree.nearest(list(asked), held, need, 0)}
    for a in asked:
        scored = []
        for b, slug in held.items():
            m = slow_lcs(a, b)
            if m >= need(len(a), len(b)):
                scored.append((max(len(a), len(b)) - m, -2.0 * m / (len(a) + len(b)), slug))
        assert (a in got) == bool(scored), a
        if scored:
            cut, ratio, slug = min(scored)
            assert got[a] == (cut, slug, -ratio)


def test_forms_are_never_broadcast(spark):
    # a few names look small, but their forms are many times their size
    names = spark.createDataFrame([(f"customer {i}", f"c{i}") for i in range(50)], "name string, slug string")
    plan = similarity._by_forms(names.select("name"), names, 0.85)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_names_over_the_length_of_trees_still_meet(spark):
    rng = random.Random(23)
    held = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (90, 95, 97, 104, 120, 150)]
    asked = []
    for name in held:
        n = list(name)
        for i in sorted(rng.sample(range(len(n)), 5), reverse=True):
            n[i:i + 1] = rng.choice(["", "zq"])
        asked.append("".join(n))
    got = {r.name: r.slug for r in similarity.fuzzy_name_match(
        spark.createDataFrame([(a,) for a in asked], "name string"),
        spark.createDataFrame([(h, f"s{i}") for i, h in enumerate(held)], "name string, slug string"),
    ).collect()}
    assert got == {a: f"s{i}" for i, a in enumerate(asked)}
