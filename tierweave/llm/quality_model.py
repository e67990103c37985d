"""Quality classifier: attention over the passages of a text.

A text is a bag of passages (blocks of 512 UTF-8 bytes). Each passage is encoded by its byte
frequencies and the variety of its byte triples, projected and squashed; gated attention weighs
the passages, and the weighted sum is scored. Only document labels are needed: the attention
learns which passages decide. The model is small and is trained on a bounded sample of labelled
documents; every passage of every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import clean, id_crc, in_sample, sample_bound, ship

ship(__name__)

PASSAGE_BYTES = 512
ENCODED = 24
GATE = 12
#: Labelled documents to learn from, per label; longer ones are not among them, the others are read whole.
FIT_DOCS = 1500
FIT_BYTES = 64 << 10
STEPS = 250
#: Texts are turned into passages in groups of about this many bytes.
GROUP_BYTES = 1 << 20
ACCEPT = 0.7


# ------------------------------------------------------------------ passages


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of all texts (padded with zero bytes), their lengths, and the passages per text (at least one)."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    many = np.array([max(1, -(-len(b) // PASSAGE_BYTES)) for b in raw])
    blocks = np.zeros((int(many.sum()), PASSAGE_BYTES), dtype=np.uint8)
    lengths = np.zeros(len(blocks), dtype=np.int64)
    flat, at = blocks.reshape(-1), 0
    for b, n in zip(raw, many, strict=True):
        flat[at * PASSAGE_BYTES:at * PASSAGE_BYTES + len(b)] = np.frombuffer(b, dtype=np.uint8)
        lengths[at:at + n] = PASSAGE_BYTES
        lengths[at + n - 1] = len(b) - (n - 1) * PASSAGE_BYTES
        at += n
    return blocks, lengths, many


def passage_features(blocks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Square roots of byte frequencies, and the share of distinct byte triples."""
    n = len(blocks)
    index = blocks.astype(np.int32) + (np.arange(n, dtype=np.int32) * 256)[:, None]
    counts = np.bincount(index.ravel(), minlength=256 * n).reshape(n, 256).astype(np.float32)
    counts[:, 0] -= PASSAGE_BYTES - lengths
    size = np.maximum(lengths, 1)[:, None]
    wide = blocks.astype(np.int32)
    triples = np.sort(wide[:, :-2] << 16 | wide[:, 1:-1] << 8 | wide[:, 2:], axis=1)
    distinct = (np.diff(triples, axis=1) != 0).sum(axis=1, keepdims=True) + 1
    return np.concatenate([np.sqrt(np.maximum(counts, 0) / size), distinct / size ** 0.8], axis=1, dtype=np.float32)


def text_groups(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``GROUP_BYTES``; a longer text is a group of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


# ------------------------------------------------------------------ model


@dataclass
class Attention:
    """Weights: encoder, the two halves of the gate, attention, output."""

    encode: np.ndarray
    shift: np.ndarray
    look: np.ndarray
    gate: np.ndarray
    weigh: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def forward(self, x: np.ndarray, many: np.ndarray):
        h = np.tanh(x @ self.encode + self.shift)
        t, g = np.tanh(h @ self.look), 1 / (1 + np.exp(-(h @ self.gate)))
        a = (t * g) @ self.weigh
        begin = np.concatenate([[0], np.cumsum(many)[:-1]])
        bag = np.repeat(np.arange(len(many)), many)
        e = np.exp(a - np.maximum.reduceat(a, begin)[bag])
        w = e / np.add.reduceat(e, begin)[bag]
        z = np.add.reduceat(w[:, None] * h, begin, axis=0)
        return h, t, g, w, begin, bag, z, z @ self.out + self.bias

    def score(self, x: np.ndarray, many: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x, many)[-1], -40, 40)))


def train(x: np.ndarray, many: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = STEPS, seed: int = 5) -> Attention:
    """Full-batch Adam on the weighted log loss."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    model = Attention(
        rng.normal(0, 1 / np.sqrt(d), (d, ENCODED)).astype(np.float32), np.zeros(ENCODED, np.float32),
        rng.normal(0, 0.3, (ENCODED, GATE)).astype(np.float32), rng.normal(0, 0.3, (ENCODED, GATE)).astype(np.float32),
        rng.normal(0, 0.3, GATE).astype(np.float32), rng.normal(0, 0.3, ENCODED).astype(np.float32), np.zeros(1, np.float32),
    )
    names = [f.name for f in fields(Attention)]
    first = {n: np.zeros_like(getattr(model, n)) for n in names}
    second = {n: np.zeros_like(getattr(model, n)) for n in names}
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        h, t, g, w, begin, bag, z, logit = model.forward(x, many)
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - label) * weight
        dz = error[:, None] * model.out
        grow = (h * dz[bag]).sum(axis=1)
        da = w * (grow - np.add.reduceat(w * grow, begin)[bag])
        dt, dg = da[:, None] * model.weigh * g * (1 - t * t), da[:, None] * model.weigh * t * g * (1 - g)
        dh = w[:, None] * dz[bag] + dt @ model.look.T + dg @ model.gate.T
        du = dh * (1 - h * h)
        grads = {
            "encode": x.T @ du, "shift": du.sum(axis=0), "look": h.T @ dt, "gate": h.T @ dg,
            "weigh": (t * g).T @ da, "out": z.T @ error, "bias": error.sum(keepdims=True),
        }
        for n in names:
            grad = grads[n] + 1e-5 * getattr(model, n)
            first[n] = 0.9 * first[n] + 0.1 * grad
            second[n] = 0.999 * second[n] + 0.001 * grad * grad
            move = 0.02 * first[n] / (1 - 0.9 ** step) / (np.sqrt(second[n] / (1 - 0.999 ** step)) + 1e-8)
            setattr(model, n, (getattr(model, n) - move).astype(np.float32))
    return model


# ------------------------------------------------------------------ operator


def _bags(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, longest: int) -> pd.DataFrame:
    """Feature bags, all passages of the chosen documents of at most ``longest`` bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for label, text in zip(batch["_label"], clean(batch["text"]), strict=True):
                blocks, lengths, _ = passages([text])
                rows.append((int(label), len(blocks), passage_features(blocks, lengths).astype(np.float16).tobytes()))
            yield pd.DataFrame(rows, columns=["label", "many", "x"])

    chosen = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text")).join(F.broadcast(ids), "_doc").filter(
        F.coalesce(F.octet_length("text"), F.lit(0)) <= longest)
    return chosen.select("_label", "text").mapInPandas(run, "label int, many int, x binary").toPandas()


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_docs: int = FIT_DOCS,
    held_out: tuple[int, int] | None = (4, 2),
) -> Attention | float:
    """Model learnt from about ``fit_docs`` documents of each label, chosen by hash of the id.

    ``held_out = (m, r)`` leaves out rows whose CRC-32 of the id is r modulo m. With labels of
    one kind only the result is that label as a constant, without any it is 1 (nothing rejected).
    """
    usable = labels.filter(F.col("quality").isin(0, 1))
    if held_out:
        usable = usable.filter(id_crc("doc_id") % held_out[0] != held_out[1])
    usable = usable.select(F.col("doc_id").alias("_doc"), F.col("quality").alias("_label"))
    total = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count("*").alias("n")).collect()}  # two rows
    if len(total) < 2:
        return float(next(iter(total), 1))
    parts = [
        usable.filter((F.col("_label") == q) & in_sample("_doc", min(1.0, fit_docs / total[q]))).limit(sample_bound(fit_docs))
        for q in (0, 1)
    ]
    bags = _bags(docs, parts[0].unionByName(parts[1]), id_col, text_col, FIT_BYTES)
    found = bags["label"].value_counts().to_dict()
    if len(found) < 2:
        return float(next(iter(found), 1))
    x = np.frombuffer(b"".join(bags["x"]), dtype=np.float16).reshape(-1, 257).astype(np.float32)
    label = bags["label"].to_numpy(np.float32)
    # samples are even; the weights bring back the shares of the labels
    weight = np.where(label == 1, total[1] / found[1], total[0] / found[0]).astype(np.float32)
    return train(x, bags["many"].to_numpy(), label, weight)


def score_quality(
    docs: DataFrame, model: Attention | float, id_col: str = "doc_id", text_col: str = "text",
    accept: float = ACCEPT,
) -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted`` (1 from ``accept`` on).

    NULL and empty texts are one empty passage. Columns of these two names are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fitted = known.value
        for texts in batches:
            if isinstance(fitted, float):
                yield pd.Series(np.full(len(texts), fitted))
                continue
            parts = [np.zeros(0)]
            for group in text_groups(clean(texts)):
                blocks, lengths, many = passages(group)
                parts.append(fitted.score(passage_features(blocks, lengths), many))
            yield pd.Series(np.concatenate(parts).astype(float))

    return docs.withColumn("score", scored(F.col(text_col))).withColumn(
        "predicted", (F.col("score") >= accept).cast("int"),
    )


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``; repeated rows are scored alike."""
    model = fit_quality(docs, labels)
    return score_quality(docs, model).select("doc_id", (id_crc("doc_id") % 4 == 2).alias("held_out"), "score", "predicted")
