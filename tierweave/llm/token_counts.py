"""Token counts of every prefix, for a vocabulary with word ends.

The table of a word holds the exact count of each of its prefixes (``PairCoder.prefix_counts``:
the last token of a prefix and the count of what comes before it). Pre-tokens never share a
token, so counts of words add up: the table of a text is the tables of its words, each raised by
what precedes it. Whole-text counts, counts of any prefix and the longest prefix within a budget
are then lookups.

The vocabulary's text rules are fixed values of its file: NFC, white space to a blank, lower
case, the pre-token pattern below, and special strings that count as one token each.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.llm.bpe import PairCoder, merges_of_word_file
from tierweave.llm.common import Memo, chunks, clean, read_bytes, ship, worker_cache

ship(__name__)

#: White space of the Unicode property, as the tokenizer's patterns see it (fixed value).
BLANKS = "\t-\r \x85\xa0  -     　"


class PrefixCounter:
    """Counts of texts and of their prefixes; words met before are remembered."""

    def __init__(self, data: bytes):
        import regex

        self.coder = PairCoder(merges_of_word_file(data))
        self.specials = [t["content"] for t in json.loads(data)["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, self.specials)))
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{BLANKS}\p{{L}}\p{{N}}]+")
        self.of_word = Memo(self._word)
        self.of_chunk = Memo(self._chunk)

    def _word(self, word: str) -> int:
        return self.coder.prefix_counts(word.encode().decode("latin-1"))[-1]

    def _chunk(self, text: str) -> int:
        plain = unicodedata.normalize("NFC", text) if not text.isascii() else text
        # one code point at a time, as the library does: no final-sigma rule
        plain = plain.lower() if plain.isascii() else "".join(map(str.lower, plain))
        return sum(map(self.of_word.__getitem__, self.words.findall(plain)))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if any(s in text for s in self.specials):
            return len(self.special.findall(text)) + sum(map(self.count, self.special.split(text)))
        first, rest = chunks(text)
        return self.of_chunk[first] + sum(map(self.of_chunk.__getitem__, rest))

    def prefixes(self, text: str) -> np.ndarray:
        """Tokens of text[:1], text[:2], ..."""
        out = np.empty(len(text), dtype=np.int32)
        first, rest = chunks(text)
        base = at = 0
        for i, chunk in enumerate([first, *rest]):
            if i:
                out[at] = base
                at += 1
            inside = self._chunk_prefixes(chunk)
            out[at:at + len(chunk)] = inside
            out[at:at + len(chunk)] += base
            at += len(chunk)
            base += self.count(chunk)
        return out

    def _chunk_prefixes(self, chunk: str) -> list[int]:
        # Where a prefix reads the same as the beginning of the whole, its words are known;
        # otherwise (composed letters, contractions, special strings) each prefix is counted.
        if not chunk.isascii() or "'" in chunk or "<|" in chunk:
            return [self.count(chunk[:n]) for n in range(1, len(chunk) + 1)]
        out, base, at = [], 0, 0
        for found in self.words.finditer(chunk.lower()):
            out += [base] * (found.start() - at)
            inside = self.coder.prefix_counts(found.group())
            out += [base + n for n in inside]
            base, at = base + inside[-1], found.end()
        return out + [base] * (len(chunk) - at)


def _counter(key: str, data) -> PrefixCounter:
    return worker_cache(("prefix", key), lambda: PrefixCounter(data.value))


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row.

    NULL counts as empty: no bytes and no tokens. Texts of any length are counted whole, rows
    with equal ids separately; no other column is read, so other names cannot clash.
    """
    data = docs.sparkSession.sparkContext.broadcast(read_bytes(vocabulary))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(vocabulary, data)
        for texts in batches:
            yield pd.Series([counter.count(t) for t in clean(texts)], dtype="int64")

    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        counted(F.col(text_col)).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_table(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, tokens_before: the token count of every prefix, one entry per code point."""
    data = docs.sparkSession.sparkContext.broadcast(read_bytes(vocabulary))

    @F.pandas_udf("array<int>")
    def table(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(vocabulary, data)
        for texts in batches:
            yield pd.Series([counter.prefixes(t) for t in clean(texts)])

    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), table(F.col(text_col)).alias("tokens_before"),
    )


def tokens_of_prefix(n_chars: Column | str) -> Column:
    """Tokens of the first ``n_chars`` code points of a row of ``prefix_table``."""
    n = F.col(n_chars) if isinstance(n_chars, str) else n_chars
    inside = F.least(n, F.size("tokens_before"))
    return F.when(inside <= 0, 0).otherwise(F.element_at("tokens_before", F.greatest(inside, F.lit(1))))


def truncated(budget: int) -> Column:
    """The longest prefix of a row of ``prefix_table`` that has at most ``budget`` tokens."""
    fits = F.filter(
        F.sequence(F.size("tokens_before"), F.lit(0), F.lit(-1)),
        lambda n: (n == 0) | (F.get("tokens_before", n - 1) <= budget),
    )
    return F.substring("text", F.lit(1), F.element_at(fits, 1))
