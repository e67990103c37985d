"""The literal test in front of a pattern never changes its answer."""

import random

from pyspark.sql import functions as F
from tierweave.fixed.tag_rules import TEXT_RULES
from tierweave.functions.patterns import folded, matches_folded, required_literals


def test_literals_of_patterns():
    assert required_literals(r"\bspeech.to.text\b") == ["speech"]
    assert required_literals(r"(?:image|picture) (?:generator|maker)") == ["image", "picture"] or set(required_literals(r"(?:image|picture) (?:generator|maker)")) == {"generator", "maker"}
    assert required_literals(r"colou?r.{0,5}") == ["colo"] and required_literals(r"a|bcd") is None and required_literals("x*") is None
    assert required_literals("(unclosed") is None and required_literals("视频生成") is None
    assert sum(required_literals(p) is not None for p, _ in TEXT_RULES) > 0.9 * len(TEXT_RULES)


def test_same_answers_as_the_patterns_alone(spark):
    rng = random.Random(2)
    words = sorted({x for p, _ in TEXT_RULES for x in required_literals(p) or []} | {"rag", "nlp", "moe", "to", "of", "ai", "人工智能", "视频"})
    odd = {"s": "sſS", "k": "kKK", "i": "iıİI", "a": "aA"}

    def spoil(word):
        return "".join(rng.choice(odd.get(c, c + c.upper())) for c in word) if rng.random() < 0.6 else word

    texts = [rng.choice(" -_").join(spoil(rng.choice(words)) for _ in range(rng.randint(1, 12))) for _ in range(800)] + ["", None, "ß straße İstanbul"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("low", folded(F.col("text"))).repartition(4)
    both = [F.count_if(F.coalesce(matches_folded(F.col("text"), F.col("low"), p), F.lit(False)) != F.coalesce(F.col("text").rlike(f"(?iU){p}"), F.lit(False))).alias(f"d{i}") for i, (p, _) in enumerate(TEXT_RULES)]
    hits = [F.count_if(F.col("text").rlike(f"(?iU){p}")).alias(f"h{i}") for i, (p, _) in enumerate(TEXT_RULES)]
    row = df.agg(*both, *hits).first().asDict()
    assert {TEXT_RULES[int(k[1:])][0]: v for k, v in row.items() if k.startswith("d") and v} == {}
    assert sum(row[f"h{i}"] > 0 for i in range(len(TEXT_RULES))) > 40
