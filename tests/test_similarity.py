import random

import pytest

from tierweave.operators.similarity import fuzzy_name_match, lcs_length, near_duplicate_texts, ratio_at_least


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def slow_ratio(a, b):
    return 2.0 * slow_lcs(a, b) / (len(a) + len(b))


def test_lcs_and_bound_agree_with_the_table_method():
    rng = random.Random(3)
    for _ in range(1500):
        a = "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 140)))
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            i = rng.randint(0, len(b))
            b[i:i + rng.randint(0, 2)] = rng.choice("abcd")
        b = "".join(b)
        assert lcs_length(a, b) == slow_lcs(a, b)
        if a or b:
            want = slow_ratio(a, b)
            got = ratio_at_least(a, b, 0.9)
            assert (got is not None) == (want >= 0.9 - 1e-12)


def test_similarity_is_not_edit_distance():
    assert lcs_length("kitten", "sitting") * 2 / 13 == pytest.approx(8 / 13)
    assert slow_ratio("cursor ide", "cursor") == 0.75


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "robot", "search", "model", "über", "人工智能"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 40))) for _ in range(25)]
    texts = list(base)
    for t in base:
        for rate in (0.02, 0.07, 0.09, 0.12):
            texts.append("".join(rng.choice("xyz") if rng.random() < rate else c for c in t))
    texts += [base[0]] * 8 + ["short", " " * 30]
    rows = [(f"d{i:03d}", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "slug string, text string")
    got = {r.slug: (r.other_slug, r.ratio) for r in near_duplicate_texts(df, df).collect()}
    by = dict(rows)
    for slug, t in rows:
        partners = {
            s for s, o in rows
            if s != slug and len(t.strip()) >= 20 and len(o) >= 20 and slow_ratio(t, o) >= 0.9
        }
        assert (slug in got) == bool(partners), (slug, t)
        if partners:
            other, ratio = got[slug]
            assert other in partners and ratio == pytest.approx(slow_ratio(t, by[other]))


def test_fuzzy_names_equal_brute_force(spark):
    rng = random.Random(11)
    owned = [("".join(rng.choice("abco nrt") for _ in range(rng.randint(1, 26))), f"s{i:03d}") for i in range(120)]
    probes = []
    for name, _ in owned:
        n = list(name)
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(n))
            n[i:i + rng.randint(0, 1)] = rng.choice("abco nrt")
        probes.append("".join(n))
    got = {r.name: (r.slug, r.ratio) for r in fuzzy_name_match(
        spark.createDataFrame([(p,) for p in probes], "name string"), spark.createDataFrame(owned, "name string, slug string"),
    ).collect()}
    best = {}
    for name, slug in owned:
        best[name] = max(best.get(name, ""), slug)
    for p in set(probes) - {""}:
        scored = []
        for name, slug in best.items():
            if not name:
                continue
            m = slow_lcs(p, name)
            if 2 * m / (len(p) + len(name)) >= 0.85:
                scored.append((max(len(p), len(name)) - m, -2 * m / (len(p) + len(name)), slug))
        assert (p in got) == bool(scored), p
        if scored:
            assert got[p][0] == min(scored)[2], (p, got[p], sorted(scored)[:3])


def test_deep_and_dense_names_equal_brute_force(spark):
    # many deletions a side, names over the length that is shortened twice, and a group where all are alike
    rng = random.Random(13)
    owned = [(f"customer#0000{i:05d}", f"c{i:03d}") for i in range(60)]
    owned += [("".join(rng.choice("abcdefgh ") for _ in range(rng.choice([18, 24, 33, 45, 60]))), f"x{i:03d}") for i in range(60)]
    probes = ["customer 00012", "customer#0000999991", "cstomer#00000001", "c" * 300]
    for name, _ in owned[::3]:
        for cuts in (2, 3, 5, 8):
            n = list(name)
            for _ in range(cuts):
                i = rng.randrange(len(n))
                n[i:i + rng.randint(0, 1)] = rng.choice(["", "z", "q"])
            probes.append("".join(n))
    got = {r.name: (r.slug, r.ratio) for r in fuzzy_name_match(
        spark.createDataFrame([(p,) for p in probes], "name string"), spark.createDataFrame(owned, "name string, slug string"),
    ).collect()}
    depths = set()
    for p in set(probes):
        scored = []
        for name, slug in owned:
            m = slow_lcs(p, name)
            if 2 * m / (len(p) + len(name)) >= 0.85:
                scored.append((max(len(p), len(name)) - m, -2 * m / (len(p) + len(name)), slug))
        assert (p in got) == bool(scored), p
        if scored:
            depths.add(min(scored)[0])
            assert got[p] == (min(scored)[2], pytest.approx(-min(scored)[1])), (p, got[p], sorted(scored)[:3])
    assert depths >= {1, 2, 3, 4}


def test_hot_keys_are_split(spark, monkeypatch):
    import tierweave.operators.similarity as similarity

    monkeypatch.setattr(similarity, "KEY_ROWS", 3)
    a = spark.createDataFrame([(f"a{i}", 5, 5, i % 2) for i in range(8)], "id string, la int, lb int, key long")
    b = spark.createDataFrame([(f"b{i}", 5, 5, 0) for i in range(20)] + [("b99", 5, 5, 1)], "id string, la int, lb int, key long")
    want = {(f"a{i}", f"b{j}") for i in range(0, 8, 2) for j in range(20)} | {(f"a{i}", "b99") for i in range(1, 8, 2)}
    assert {tuple(r) for r in similarity._key_pairs(a, b).collect()} == want


def test_plans_have_no_cartesian_product(spark):
    df = spark.createDataFrame([("a", "some text that is long enough")], "slug string, text string")
    plan = near_duplicate_texts(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan



def test_last_step_keeps_texts_not_pairs(spark):
    # a dense group without word breaks: a text stops at its first partner, so no pairs are unfolded
    from tierweave.operators import similarity

    rows = [(f"i{i:03d}", f"面向企业的智能搜索平台支持多模态检索与自动化流程{i:03d}", f"s{i:03d}", f"s{i:03d}") for i in range(200)]
    a, b = (spark.createDataFrame(rows, "id string, text string, low string, high string") for _ in range(2))
    found = similarity._block_matches(a, b, 0.9).collect()
    assert sorted(r.id for r in found) == [r[0] for r in rows]
    assert all(r.low != "s" + r.id[1:] and r.ratio >= 0.9 for r in found)


def test_block_partners_equal_brute_force():
    import pandas as pd

    from tierweave.operators.similarity import block_partners

    rng = random.Random(17)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(20, 60))) for _ in range(40)]
    texts += ["".join(rng.choice("xyz") if rng.random() < 0.08 else c for c in t) for t in texts]
    low = [f"s{rng.randrange(9)}" for _ in texts]
    high = [max(x, f"s{rng.randrange(9)}") for x in low]
    df = pd.DataFrame({"id": [f"{i:03d}" for i in range(80)], "text": texts, "low": low, "high": high})
    got = {}
    for key, lo, hi, ratio in block_partners(df, df, 0.9):
        got.setdefault(key, set()).update({lo, hi})
    for i, t in enumerate(texts):
        owners = {s for j, o in enumerate(texts) if j != i and slow_ratio(t, o) >= 0.9 for s in (low[j], high[j])}
        for slug in {low[i], high[i]}:
            assert bool(got.get(f"{i:03d}", set()) - {slug}) == bool(owners - {slug}), (i, slug)


def test_texts_of_no_fitting_length_meet_no_block(spark):
    from tierweave.operators import similarity

    def texts(*sizes):
        return spark.createDataFrame([(f"t{n}", "x" * n, "a", "a") for n in sizes], "id string, text string, low string, high string")

    sizes, held = range(20, 700), (71, 72, 84, 500)
    met = {r.n for r in similarity._bands_met(texts(*sizes), texts(*held), 0.9).collect()}
    assert {la for la in sizes if any(2 * min(la, lb) / (la + lb) >= 0.9 for lb in held)} <= met
    # the band of 54 meets that of 71, but no text of 54 can reach the limit there
    assert not met & {54, 200, 350}


def test_lengths_are_cut_to_what_a_step_can_meet(monkeypatch):
    import pandas as pd

    from tierweave.operators import similarity

    widths = []
    kept = similarity._letter_counts
    monkeypatch.setattr(similarity, "_letter_counts", lambda t: widths.append(len(t)) or kept(t))
    rng = random.Random(11)
    rows = [("".join(rng.choice("abcdefgh") for _ in range(n)), n) for n in (30, 31, 33, 36, 38, 60, 61, 90) for _ in range(3)]
    df = pd.DataFrame([(f"{i:03}", t, f"s{i}", f"s{i}") for i, (t, _) in enumerate(rows + [(t[:4] + "z" + t[4:], n) for t, n in rows])], columns=["id", "text", "low", "high"])
    monkeypatch.setattr(similarity, "BLOCK_STEP", 5)
    found = {k for k, *_ in similarity.block_partners(df, df, 0.9)}
    assert found == set(df["id"])
    apart = df[df["text"].str.len() > 80], df[df["text"].str.len() < 40]
    widths.clear()
    assert list(similarity.block_partners(*apart, 0.9)) == []
    assert widths == [len(apart[1])]  # nothing of the probes was counted
