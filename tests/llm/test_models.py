"""Quality rules, language identification and the quality classifier."""

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tierweave.llm import QUERIES
from tierweave.llm.common import in_sample
from tierweave.llm.language_id import Languages, fit_languages, svm, text_features, with_language
from tierweave.llm.quality_model import Attention, fit_quality, passages, quality_scores, score_quality, text_groups, train
from tierweave.llm.quality_rules import anomaly, average_path, grow_forest, quality_rules, repeated_words, rule_counts, threshold

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# ------------------------------------------------------------------ rules


def brute_counts(text):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\f\v"):
            dups += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)


def test_rule_counts_equal_brute_force():
    rng = random.Random(1)
    texts = ["", " ", "a b c d e " * 9, "x\ny\nx\n\n\n x", "é #*$%&|<> \x1c\x85"]
    texts += ["".join(rng.choice(["a", "b ", " c", "\n", "#", "é ", "\t"]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    for text in texts:
        assert rule_counts(text)[:5] == brute_counts(text), repr(text)
    assert repeated_words("a b c d".split()) == 0


def test_forest_finds_what_is_unlike_the_rest():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(9, 0.3, (10, 3))])
    score = anomaly(grow_forest(x, 50, 128), x, 128)
    assert score[500:].min() > np.quantile(score[:500], 0.95)
    assert float(average_path(1)) == 0 and float(average_path(2)) == 1
    assert threshold(np.array([0.1, 0.9]), np.array([True, True])) == 1.0


def test_rules_on_labelled_data(spark):
    got = QUERIES["op7_quality_rules"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert good[~good.base_failed].kept.mean() > 0.98
    assert (~bad.kept).mean() > 0.7
    assert not got[got.base_failed].kept.any()


def test_rules_limit_is_set_on_all_labelled_rows(spark):
    rng = random.Random(5)

    def text(symbols):
        return " ".join(rng.choice(["w", "W", "wo", "w!"]) + str(rng.randrange(500)) for _ in range(60)) + " #" * symbols

    # odd good rows are only outside the 4,096 that a sample by hash would take
    sampled = {r.id for r in spark.range(9000).filter(in_sample("id", 4096 / 9000)).collect()}
    odd = set([i for i in range(9000) if i not in sampled][:60])
    rows = [(i, text(rng.randint(4, 40) if i in odd else 0)) for i in range(9000)] + [(9000 + i, text(rng.randint(4, 40))) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = labels(spark, [(i, int(i < 9000), 0) for i, _ in rows])
    got = quality_rules(docs, marks).toPandas()
    got = got[~got.base_failed]
    good, bad = got[got.doc_id < 9000], got[got.doc_id >= 9000]
    allowed = int(0.002 * len(good))
    limit = good.anomaly_score.sort_values().to_numpy()[-1 - allowed]
    assert 0 < (~good.kept).sum() <= allowed
    # fewest bad rows that a loss of so many good ones leaves, but for one bin of scores
    assert abs(bad.kept.sum() - (bad.anomaly_score <= limit).sum()) <= (abs(bad.anomaly_score - limit) < 2**-15).sum()


def test_threshold_weighs_good_against_bad():
    good = np.arange(1000) < 900
    scores = np.where(good, np.arange(1000) / 1000, 0.0)
    assert threshold(scores, good) == 1.0  # no limit rejects a bad row
    scores[~good] = 0.8985
    assert threshold(scores, good) == 0.898  # one good row of 900 lies above
    assert threshold(scores, good, counts=np.where(scores == 0.899, 2, 1)) == 1.0  # two would


def test_rules_on_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", None), (3, "one two", "b"), (3, "one two", "b"), (None, "no id " * 3, "c"), (4, "w " * 20000, "d")],
        "doc_id long, text string, kept string",
    )
    got = quality_rules(docs, labels(spark, [(9, 1, 0), (1, None, 0)])).collect()
    assert len(got) == 6 and sum(r.kept for r in got) == 0
    assert {r.doc_id: r.n_words for r in got} == {1: 0, 2: 0, 3: 2, None: 6, 4: 20000}
    assert quality_rules(docs.limit(0), labels(spark, [])).count() == 0


# ------------------------------------------------------------------ language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op8_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert set(got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)) == {True}
    assert got.score.between(0, 1).all()


def test_letters_are_letters():
    from tierweave.llm.language_id import has_letter

    assert not has_letter("² ½ ① Ⅷ 12 _ !") and not has_letter("") and has_letter("½ ß") and has_letter("1中")


def test_language_of_odd_rows(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([
        ("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"), ("el gato y el perro", "es"),
    ] * 8)]
    docs = spark.createDataFrame(rows + [(90, None, "en"), (91, "", None), (92, "12 !?", "en"), (None, "the dog", None), (93, "hund " * 90000, None)], "doc_id long, text string, lang string")
    model = fit_languages(docs)
    got = with_language(docs.withColumn("score", F.lit("clash")), model).collect()
    found = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows) + 5 and [found[k] for k in (90, 91, 92)] == ["und"] * 3
    assert all(found[i] == lang for i, _, lang in rows) and found[None] == "en" and found[93] == "de"
    nothing = fit_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in with_language(docs, nothing).collect()} == {"und"}
    one = fit_languages(docs.filter("lang = 'en'"))
    assert with_language(docs, one).filter("doc_id = 1").first().lang_pred == "en"
    assert with_language(docs.limit(0), model).count() == 0


def test_machine_separates():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(-1, 0.5, (40, 5)), rng.normal(1, 0.5, (60, 5))]).astype(np.float32)
    w = svm(x, np.repeat([-1, 1], [40, 60]))
    assert ((x @ w[:-1] + w[-1] > 0) == np.repeat([False, True], [40, 60])).mean() > 0.97
    assert not text_features("").any() and isinstance(Languages([], {}, np.zeros((0, 1)), {}), Languages)


# ------------------------------------------------------------------ classifier


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    many = np.array([1, 3, 2, 4])
    x, label = rng.normal(size=(10, 257)).astype(np.float32), np.array([0, 1, 1, 0], np.float32)

    def loss(m):
        p = m.score(x.astype(float), many)
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    before = train(x, many, label, np.ones(4, np.float32), steps=1)
    after = train(x, many, label, np.ones(4, np.float32), steps=60)
    assert loss(after) < 0.1 * loss(before) and isinstance(after, Attention)


def test_first_steps_go_down_the_differences():
    # the first step of Adam moves every weight against the sign of its derivative
    from dataclasses import fields

    rng = np.random.default_rng(7)
    many = np.array([1, 3, 2, 4])
    x, label = rng.normal(size=(10, 257)).astype(np.float32), np.array([0, 1, 1, 0], np.float32)
    begin, after = (train(x, many, label, np.array([1, 2, 1, 3], np.float32), steps=n) for n in (0, 1))
    shares = np.array([1, 2, 1, 3]) / 7
    start = Attention(*[getattr(begin, f.name).astype(float) for f in fields(Attention)])

    def loss():
        p = start.score(x.astype(float), many)
        return -(shares * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() + 5e-6 * sum((getattr(start, f.name) ** 2).sum() for f in fields(Attention))

    checked = 0
    for f in fields(Attention):
        held, moved = getattr(start, f.name), getattr(after, f.name).astype(float) - getattr(begin, f.name)
        for i in rng.choice(held.size, min(held.size, 40), replace=False):
            was = held.flat[i]
            held.flat[i] = was + 1e-5
            up = loss()
            held.flat[i] = was - 1e-5
            slope = (up - loss()) / 2e-5
            held.flat[i] = was
            if abs(slope) > 1e-5:
                assert np.sign(moved.flat[i]) == -np.sign(slope), (f.name, i, slope)
                checked += 1
    assert checked > 150


def test_languages_equal_a_loop_over_machines():
    rng = np.random.default_rng(3)
    members = {"f": ["fa", "fb", "fc"], "g": ["ga"], "h": ["ha", "hb"]}
    pairs = {(a, b): rng.normal(size=6) for codes in members.values() for i, a in enumerate(codes) for b in codes[i + 1:]}
    model = Languages(sorted(members), members, rng.normal(size=(3, 6)), pairs)
    x = rng.normal(size=(200, 5))
    lang, score = model.predict(x)
    for row, got, sure in zip(np.c_[x, np.ones(200)], lang, score, strict=True):
        margin = {name: row @ w for name, w in zip(model.families, model.family, strict=True)}
        name = max(margin, key=margin.get)
        first, second = sorted(margin.values(), reverse=True)[:2]
        votes = dict.fromkeys(members[name], 0)
        total = dict.fromkeys(members[name], 0.0)
        for (a, b), w in pairs.items():
            if a in votes:
                m = row @ w
                votes[a if m > 0 else b] += 1
                total[a] += m
                total[b] -= m
        best = max(votes, key=lambda c: votes[c] + 1e-3 * np.tanh(total[c]))
        want = 1 / (1 + np.exp(-2 * (first - second)))
        if len(votes) > 1:
            want = min(want, 1 / (1 + np.exp(-2 * max(total[best], 0) / (len(votes) - 1))))
        assert got == best and abs(sure - want) < 1e-9


def test_passages_cover_whole_texts():
    texts = ["", "a" * 512, "é" * 600, "b" * 1300]
    blocks, lengths, many = passages(texts)
    assert many.tolist() == [1, 1, 3, 3] and lengths.sum() == sum(len(t.encode()) for t in texts)
    assert b"".join(blocks.tobytes().split(b"\x00")) == "".join(texts).encode()
    assert [t for g in text_groups(["x" * 10] * 5) for t in g] == ["x" * 10] * 5


def test_quality_held_out_accuracy(spark):
    got = QUERIES["op9_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert held[held.quality == 1].predicted.mean() > 0.97 and held[held.quality == 0].predicted.mean() < 0.15
    assert set(got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)) == {True}


def test_quality_of_odd_rows(spark):
    rows = [(i, "plain words here and there " * 8 if i % 2 else "### $$$ %%% " * 20) for i in range(60)]
    docs = spark.createDataFrame(rows + [(90, None), (91, ""), (None, "plain words"), (1, rows[1][1])], "doc_id long, text string").withColumn("score", F.lit("x"))
    marks = labels(spark, [(i, i % 2, 0) for i in range(60)] + [(1, None, 0), (500, 1, 0)])
    got = quality_scores(docs, marks).toPandas()
    assert len(got) == 64 and got.score.between(0, 1).all()
    assert all(r.predicted == r.doc_id % 2 for r in got.itertuples() if r.doc_id < 60)
    assert fit_quality(docs, labels(spark, [])) == 1.0 and fit_quality(docs, labels(spark, [(1, 0, 0)])) == 0.0
    constant = score_quality(docs, 1.0).filter("doc_id = 0").first()
    assert (constant.score, constant.predicted) == (1.0, 1)
    assert pd.Series(quality_scores(docs.limit(0), marks).columns).tolist() == ["doc_id", "held_out", "score", "predicted"]
