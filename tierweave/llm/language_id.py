"""Language identification in two levels.

Linear support vector machines over hashed byte n-grams: one against the rest for the language
family, then one against one between the languages of the family that won. Everything is learnt
from the ``lang`` column of a bounded sample; whole texts are scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import clean, id_crc, in_sample, sample_bound, ship

ship(__name__)

#: Hashed features; n-grams of one to three bytes.
BUCKETS = 4096
#: Texts learnt from, per language.
FIT_TEXTS = 500
UNKNOWN = "und"
#: Texts scored at a time.
ROWS = 256
#: Bytes hashed at a time, so that memory does not depend on the length of a text.
SLICE = 1 << 18

#: Families of language codes (fixed values). A code not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sk": "slavic",
}

#: A character of a word that is no decimal digit: a letter, or a number of another kind.
_WORDLIKE = re.compile(r"[^\W\d_]")
#: Lower case; everything else in ASCII that is no letter becomes a blank.
_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def has_letter(text: str) -> bool:
    """Whether any character is a letter (categories L*)."""
    return any(m.group().isalpha() for m in _WORDLIKE.finditer(text))


# ------------------------------------------------------------------ features


def text_features(text: str) -> np.ndarray:
    """Square roots of n-gram shares, unit length; zeros for a text without letters."""
    total = np.zeros(BUCKETS)
    raw = text.encode("utf-8", "surrogatepass").translate(_FOLD)
    for begin in range(0, len(raw), SLICE):
        b = np.frombuffer(b" " + raw[begin:begin + SLICE + 2] + b" ", dtype=np.uint8).astype(np.uint32)
        solid = b != 32
        two = b[:-1] * 257 + b[1:]
        three = two[:-1] * 263 + b[2:]
        grams = (
            b[solid], 256 + (two[solid[:-1] | solid[1:]] * 40503 >> 3) % 1024,
            1280 + (three[solid[1:-1]] * np.uint32(2654435761) >> 7) % (BUCKETS - 1280),
        )
        for g in grams:
            total += np.bincount(g, minlength=BUCKETS)
    norm = np.sqrt(total.sum())
    return (np.sqrt(total) / norm if norm else total).astype(np.float32)


# ------------------------------------------------------------------ machines


def svm(x: np.ndarray, y: np.ndarray, steps: int = 3000, batch: int = 64, reg: float = 1e-4, seed: int = 3) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine, by averaged stochastic subgradients.

    Both classes are drawn equally often.
    """
    rng = np.random.default_rng(seed)
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    sides = np.flatnonzero(y > 0), np.flatnonzero(y <= 0)
    w, mean = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        rows = np.concatenate([rng.choice(s, batch // 2) for s in sides])
        sign = np.where(y[rows] > 0, 1.0, -1.0)
        wrong = sign * (x[rows] @ w) < 1
        rate = 1 / (reg * step + 1)
        w *= 1 - rate * reg
        w += rate / batch * (sign[wrong] @ x[rows[wrong]])
        mean += (w - mean) / step
    return mean


@dataclass
class Languages:
    """Family machines, and per family its languages and pair machines."""

    families: list[str]
    members: dict[str, list[str]]
    family: np.ndarray
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score (the less sure of the two decisions) per row."""
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
        n = len(x)
        lang, score = np.full(n, UNKNOWN, dtype=object), np.zeros(n)
        if not self.families:
            return lang, score
        won, sure = np.zeros(n, dtype=int), np.ones(n)
        if len(self.families) > 1:
            margin = x @ self.family.T
            won = margin.argmax(axis=1)
            top = np.sort(margin, axis=1)
            sure = 1 / (1 + np.exp(-2 * (top[:, -1] - top[:, -2])))
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(won == f)
            codes = self.members[name]
            votes, margins = np.zeros((len(rows), len(codes))), np.zeros((len(rows), len(codes)))
            for a, b in combinations(range(len(codes)), 2):
                m = x[rows] @ self.pairs[codes[a], codes[b]]
                votes[:, a] += m > 0
                votes[:, b] += m <= 0
                margins[:, a] += m
                margins[:, b] -= m
            best = (votes + 1e-3 * np.tanh(margins)).argmax(axis=1)
            lang[rows] = np.array(codes, dtype=object)[best]
            inner = 1 / (1 + np.exp(-2 * np.maximum(margins[np.arange(len(rows)), best], 0) / max(1, len(codes) - 1)))
            score[rows] = np.minimum(sure[rows], inner) if len(codes) > 1 else sure[rows]
        return lang, score


def train(x: np.ndarray, lang: np.ndarray, families: dict[str, str] = FAMILIES) -> Languages:
    codes = sorted(set(lang))
    groups: dict[str, list[str]] = {}
    for code in codes:
        groups.setdefault(families.get(code, code), []).append(code)
    names = sorted(groups)
    of_family = np.array([families.get(c, c) for c in lang])
    family = [svm(x, np.where(of_family == n, 1, -1)) for n in names] if len(names) > 1 else []
    pairs = {}
    for members in groups.values():
        for a, b in combinations(members, 2):
            rows = (lang == a) | (lang == b)
            pairs[a, b] = svm(x[rows], np.where(lang[rows] == a, 1, -1))
    return Languages(names, groups, np.array(family), pairs)


# ------------------------------------------------------------------ operator


def fit_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    fit_texts: int = FIT_TEXTS, held_out: tuple[int, int] | None = (5, 0), families: dict[str, str] = FAMILIES,
) -> Languages:
    """Learn from about ``fit_texts`` texts of each language, chosen by hash of the id.

    Rows with a NULL language, with no letter, or held out (CRC-32 of the id is r modulo m) are
    not used. Without any row left every text is predicted ``und``.
    """
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    if held_out:
        usable = usable.filter(id_crc(id_col) % held_out[0] != held_out[1])
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).agg(F.count("*")).collect()}  # one row a language
    if not counts:
        return Languages([], {}, np.zeros((0, BUCKETS + 1)), {})
    # share of the hash range that gives about ``fit_texts`` rows
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, fit_texts / n))])
    chosen = usable.filter(in_sample(id_col, F.element_at(share, F.col(lang_col))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "lang": batch["lang"],
                "x": [text_features(t).astype(np.float16).tobytes() for t in clean(batch["text"])],
            })

    rows = chosen.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(
        run, "lang string, x binary",
    ).limit(sample_bound(fit_texts * len(counts))).toPandas()
    if not len(rows):
        return Languages([], {}, np.zeros((0, BUCKETS + 1)), {})
    x = np.frombuffer(b"".join(rows["x"]), dtype=np.float16).reshape(-1, BUCKETS).astype(np.float32)
    return train(x, rows["lang"].to_numpy(), families)


def with_language(docs: DataFrame, model: Languages, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; columns of these names are replaced.

    NULL texts and texts without a letter get ``und`` and 0.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = clean(texts)
            parts = []
            for begin in range(0, len(texts), ROWS):
                some = texts[begin:begin + ROWS]
                lang, score = known.value.predict(np.stack([text_features(t) for t in some]))
                for i, t in enumerate(some):
                    if not has_letter(t):
                        lang[i], score[i] = UNKNOWN, 0.0
                parts.append(pd.DataFrame({"lang_pred": lang, "score": score}))
            yield pd.concat(parts) if parts else pd.DataFrame({"lang_pred": [], "score": []})

    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*rest, predicted(F.col(text_col)).alias("_language")).select(*rest, "_language.*")


def language_predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of ``docs``; repeated rows are treated alike."""
    return with_language(docs.select("doc_id", "text"), fit_languages(docs)).select(
        "doc_id", (id_crc("doc_id") % 5 == 0).alias("held_out"), "lang_pred", "score",
    )
