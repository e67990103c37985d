"""Quality rules: hard limits on rule statistics, then an isolation forest over them.

The forest isolates rows by random splits; a row that few splits isolate is unlike the rest. It
is grown on a bounded sample; every row is scored, and the threshold is set on the scores of all
labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import WORD, clean, in_sample, sample_bound, ship
from tierweave.session import cut_lineage

ship(__name__)

#: Characters counted as symbols (fixed value).
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bangs")
WINDOW = 5
#: Counts that the forest sees, per word; repetition has its hard limit already.
RATIOS = ("word_chars", "n_symbols", "n_upper", "n_bangs")
#: Words of the average text that are added to each text, so that short texts don't look odd.
PRIOR_WORDS = 100

FIT_ROWS = 4096
TREES = 100
SUBSAMPLE = 256
#: Share of labelled good rows that the threshold may reject.
GOOD_LOST = 0.002
#: Bins of the score histograms that the threshold is read from.
BINS = 1 << 16


# ------------------------------------------------------------------ statistics


def repeated_words(words: list[str]) -> int:
    """Words inside windows of five that occur at least twice in the text."""
    if len(words) <= WINDOW:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    mark = b"\x01" * WINDOW
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            covered[i:i + WINDOW] = mark
            covered[j:j + WINDOW] = mark
    return sum(covered)


def rule_counts(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\f\v")]
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    return (
        len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), int(((raw >= 65) & (raw <= 90)).sum()), text.count("!"),
    )


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of ``COUNTS`` per row; NULL counts as the empty text."""
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.DataFrame([rule_counts(t) for t in clean(batch["text"])], columns=list(COUNTS), dtype="int64")
            found.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield found

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def features(rows: pd.DataFrame, means: np.ndarray) -> np.ndarray:
    words = rows["n_words"].to_numpy(float)[:, None]
    return (rows[list(RATIOS)].to_numpy(float) + PRIOR_WORDS * means) / (words + PRIOR_WORDS)


# ------------------------------------------------------------------ forest


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 2)
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(big - 1) + np.euler_gamma) - 2 * (big - 1) / big))


def grow_forest(x: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7) -> list[tuple[np.ndarray, ...]]:
    """Trees as arrays: feature (-1 at a leaf), split value, children, path length at a leaf."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        rows = x[rng.permutation(len(x))[:subsample]]
        limit = int(np.ceil(np.log2(max(len(rows), 2))))
        feature, value, left, right, depth_at = [], [], [], [], []

        def grow(part: np.ndarray, depth: int) -> int:
            at = len(feature)
            feature.append(-1), value.append(0.0), left.append(at), right.append(at)
            depth_at.append(depth + float(average_path(len(part))))
            spans = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(x.shape[1])
            open_to = np.flatnonzero(spans > 0)
            if depth < limit and len(part) > 1 and len(open_to):
                f = int(rng.choice(open_to))
                v = float(part[:, f].min() + rng.random() * spans[f])
                feature[at], value[at] = f, v
                below = part[:, f] <= v
                left[at], right[at] = grow(part[below], depth + 1), grow(part[~below], depth + 1)
            return at

        grow(rows, 0)
        out.append((np.array(feature), np.array(value), np.array(left), np.array(right), np.array(depth_at)))
    return out


def anomaly(forest: list[tuple[np.ndarray, ...]], x: np.ndarray, subsample: int = SUBSAMPLE) -> np.ndarray:
    """Score in (0, 1): near 1 where few splits isolate a row."""
    total = np.zeros(len(x))
    every = np.arange(len(x))
    for feature, value, left, right, depth_at in forest:
        at = np.zeros(len(x), dtype=int)
        while (inner := feature[at] >= 0).any():
            f = np.maximum(feature[at], 0)
            below = x[every, f] <= value[at]
            at = np.where(inner, np.where(below, left[at], right[at]), at)
        total += depth_at[at]
    return 2.0 ** (-total / len(forest) / max(float(average_path(subsample)), 1e-9))


def threshold(scores: np.ndarray, good: np.ndarray, good_lost: float = GOOD_LOST, counts: np.ndarray | None = None) -> float:
    """The limit above which at most ``good_lost`` of the good rows lie and as many bad rows as possible.

    Of the limits that keep equally few bad rows the highest; 1 where none rejects a bad row.
    ``counts``: rows that each score stands for.
    """
    counts = np.ones(len(scores)) if counts is None else counts
    if good.all() or not good.any():
        return 1.0
    levels, at = np.unique(scores, return_inverse=True)
    kept_good = np.bincount(at, counts * good).cumsum()
    kept_bad = np.bincount(at, counts * ~good).cumsum()
    allowed = kept_good[-1] - kept_good <= good_lost * kept_good[-1]
    fewest = kept_bad[allowed].min()
    return float(levels[allowed & (kept_bad == fewest)].max()) if fewest < kept_bad[-1] else 1.0


# ------------------------------------------------------------------ operator


def _sample(rows: DataFrame, total: int, wanted: int) -> pd.DataFrame:
    """About ``wanted`` rows by hash of the id, all if there are fewer."""
    share = min(1.0, wanted / max(total, 1))
    return rows.filter(in_sample("doc_id", share)).limit(sample_bound(wanted)).toPandas().sort_values("doc_id")


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    fit_rows: int = FIT_ROWS, trees: int = TREES, subsample: int = SUBSAMPLE,
) -> DataFrame:
    """Counts, ``base_failed``, ``anomaly_score`` and ``kept`` per row.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated windows. The forest
    grows on about ``fit_rows`` rows that pass, chosen by hash of the id; the per-word means are
    those of all rows that pass, the threshold is read from the scores of all labelled ones.
    Without labels of both kinds nothing but ``base_failed`` rejects. NULL texts count as empty and
    fail. Repeated rows are scored alike.
    """
    spark = docs.sparkSession
    stats = cut_lineage(rule_statistics(docs, id_col, text_col).withColumn(
        "base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    ))
    passing = stats.filter(~F.col("base_failed"))
    total = passing.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("n_words", *RATIOS)]).first()
    means = np.array([total[c] or 0 for c in RATIOS], dtype=float) / max(total["n_words"] or 0, 1)
    sample = _sample(passing, total["n"], fit_rows)
    forest = grow_forest(features(sample, means), trees, subsample) if len(sample) else []
    model = spark.sparkContext.broadcast((forest, means, min(subsample, max(len(sample), 1))))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest, means, used = model.value
        for batch in batches:
            yield batch.assign(anomaly_score=anomaly(forest, features(batch, means), used) if forest and len(batch) else np.zeros(len(batch)))

    scored = cut_lineage(stats.mapInPandas(score, f"{schema}, anomaly_score double"))
    known = scored.filter(~F.col("base_failed")).join(labels.select("doc_id", F.col("quality").alias("_quality")), "doc_id")
    bins = known.filter(F.col("_quality").isin(0, 1)).groupBy(
        "_quality", F.floor(F.col("anomaly_score") * BINS).alias("_bin"),
    ).agg(F.count("*").alias("_n")).toPandas()  # at most BINS rows a label
    limit = threshold(  # the largest score of a bin
        np.nextafter((bins["_bin"].to_numpy(float) + 1) / BINS, 0), bins["_quality"].to_numpy() == 1, counts=bins["_n"].to_numpy(),
    )
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly_score") <= limit))
