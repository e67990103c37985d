import random

import numpy as np
import pandas as pd

from test_similarity import slow_ratio
from tierweave.operators import similarity, text_masks


def edited(rng, text, rate, letters):
    out = []
    for c in text:
        x = rng.random()
        if x >= rate / 2:
            out.append(c)
        if x > 1 - rate / 2:
            out.append(rng.choice(letters))
    return "".join(out) or "a"


def test_pairs_dropped_are_those_below_the_limit():
    rng = random.Random(4)
    for size, letters in ((20, "ab"), (90, "abcdefgh "), (150, "abcdefghijklmnopqrstuvwxyz ,."), (320, "abcdefgh")):
        base = ["".join(rng.choice(letters) for _ in range(rng.randint(size * 3 // 4, size))) for _ in range(3)]
        texts = sorted([t for b in base for t in (b, *(edited(rng, b, r, letters) for r in (0.04, 0.08, 0.1, 0.12)))], key=len)
        table = text_masks.bucket_table(texts)
        masks, n = text_masks.Masks(texts, table), np.array([len(t) for t in texts])
        want = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if slow_ratio(a, b) >= 0.9 - 1e-12}
        mine, theirs = (x.ravel() for x in np.meshgrid(range(len(texts)), range(len(texts)), indexing="ij"))
        kept = masks.pairs_reach(text_masks.bucket_rows(texts, table, n.max()), mine, theirs, n, 0.9)
        assert set(zip(mine[kept].tolist(), theirs[kept].tolist())) == want
        for i, text in enumerate(texts):
            assert {j for x, j in want if x == i} <= set(masks.may_reach(text, 0, len(texts), 0.9).tolist())


def test_characters_that_share_a_bucket_lose_no_pair():
    rng = random.Random(6)
    letters = [chr(0x4E00 + i) for i in range(400)]
    texts = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(20)]
    texts = sorted(texts + [edited(rng, t, 0.08, letters) for t in texts], key=len)
    df = pd.DataFrame({"id": [f"{i:02d}" for i in range(40)], "text": texts, "low": [f"s{i:02d}" for i in range(40)]}).assign(high=lambda d: d["low"])
    got = {key for key, *_ in similarity.block_partners(df, df, 0.9)}
    assert got == {f"{i:02d}" for i, a in enumerate(texts) if any(i != j and slow_ratio(a, b) >= 0.9 - 1e-12 for j, b in enumerate(texts))}


def test_texts_of_the_same_letters_and_grams_are_not_compared_one_by_one(monkeypatch):
    rng = random.Random(8)
    words = [f"{a}{b}{c}en" for a, b, c in zip("bdfgklmnprst", "aeiouaeiouae", "tsrpnmlkgfdb")]
    for times in (1, 5):  # short and long texts
        texts = [" ".join(rng.sample(words, len(words)) * times) for _ in range(60)]
        df = pd.DataFrame({"id": [f"{i:02d}" for i in range(60)], "text": texts, "low": [f"s{i}" for i in range(60)]}).assign(high=lambda d: d["low"])
        calls = []
        monkeypatch.setattr(similarity, "ratio_at_least", lambda a, b, limit: calls.append((a, b)))
        assert not list(similarity.block_partners(df, df, 0.9))
        assert len(calls) <= 60 * (text_masks.FEW if times > 1 else 0)


def test_texts_alike_at_one_end_meet_in_sorted_order(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SORTED_FROM", 1)
    asked = []
    blocks = similarity._block_matches
    monkeypatch.setattr(similarity, "_block_matches", lambda probes, build, limit: asked.extend(r.id for r in probes.collect()) or blocks(probes, build, limit))
    # no word is shared by two texts, so none of them meet on a sketch
    rows = [(f"i{i:03d}", f"面向企业的智能搜索平台支持多模态检索与自动化流程{i:03d}") for i in range(200)]
    df = spark.createDataFrame(rows, "slug string, text string")
    got = similarity.near_duplicate_texts(df, df).collect()
    assert sorted(r.slug for r in got) == [s for s, _ in rows]
    assert all(r.other_slug != r.slug and r.ratio >= 0.9 for r in got)
    assert not asked


def test_words_together_or_one_after_the_other_give_the_same(monkeypatch):
    rng = random.Random(12)
    texts = sorted(["".join(rng.choice("abcd ef") for _ in range(rng.randint(380, 420))) for _ in range(30)], key=len)
    texts += [edited(rng, texts[-1], r, "abc") for r in (0.02, 0.05, 0.07, 0.08, 0.09, 0.1) for _ in range(3)]
    texts.sort(key=len)
    masks = text_masks.Masks(texts, text_masks.bucket_table(texts))
    found = []
    for wide in (1, 1024):
        monkeypatch.setattr(text_masks, "WIDE", wide)
        found.append([masks.may_reach(t, 0, len(texts), 0.9).tolist() for t in texts])
    assert found[0] == found[1]
    assert all(i in row for i, row in enumerate(found[0]))
