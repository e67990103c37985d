"""Byte-level BPE encoding and decoding by backtracking over longest matches (see ``bpe``)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.bpe import PairCoder, merges_of_ranks
from tierweave.llm.common import Memo, chunk_parts, chunks, clean, read_bytes, ship, worker_cache
from tierweave.llm.token_counts import BLANKS

ship(__name__)

#: Splits a text before the merges (fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Codec:
    """Text to little-endian 32-bit ids and back."""

    def __init__(self, data: bytes, pattern: str):
        import regex

        # \s of the vocabulary's library is the Unicode property; regex adds four control characters
        exact = pattern.replace(r"[^\s", f"[^{BLANKS}").replace(r"\s", f"[{BLANKS}]").replace(r"\S", f"[^{BLANKS}]")
        self.merges = merges_of_ranks(data)
        self.coder = PairCoder(self.merges)
        self.words = regex.compile(exact)
        self.packed = [i.to_bytes(4, "little") for i in self.merges.ids]
        self.bytes_of = {i: s.encode("latin-1") for i, s in zip(self.merges.ids, self.merges.spelled, strict=True)}
        self.bytes_of |= {i: s.encode("latin-1") for s, i in self.merges.unreached.items()}
        self.of_word = Memo(self._word, limit=50_000)
        self.bare = Memo(lambda key: self._chunk(key, ""), limit=50_000)
        self.of_chunk = Memo(lambda key: self._chunk(key, " "), limit=300_000)

    def _word(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1")
        if spelled in self.merges.unreached:
            return self.merges.unreached[spelled].to_bytes(4, "little")
        packed = self.packed
        return b"".join([packed[t] for t in self.coder.encode(spelled)])

    def _chunk(self, key: str, lead: str) -> bytes:
        parts = chunk_parts(key)
        if parts:
            first = self.of_chunk[parts[0]] if lead else self.bare[parts[0]]
            return first + b"".join(map(self.bare.__getitem__, parts[1:]))
        return b"".join(map(self.of_word.__getitem__, self.words.findall(lead + key)))

    def encode(self, text: str) -> bytes:
        first, rest = chunks(text)
        return self.bare[first] + b"".join(map(self.of_chunk.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


def _codec(key, data, pattern) -> Codec:
    return worker_cache(("codec", key, pattern), lambda: Codec(data.value, pattern))


def encoded(
    docs: DataFrame, vocabulary: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) per row, special strings as plain text.

    NULL and empty texts have no ids. Rows with equal ids are separate; no other column is read.
    """
    data = docs.sparkSession.sparkContext.broadcast(read_bytes(vocabulary))

    @F.pandas_udf("binary")
    def to_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(vocabulary, data, pattern)
        for texts in batches:
            yield pd.Series([codec.encode(t) for t in clean(texts)], dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), to_ids(F.col(text_col)).alias("ids"))


def decoded(rows: DataFrame, vocabulary: str, pattern: str = PATTERN, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the bytes that the ids stand for; NULL ids give no bytes."""
    data = rows.sparkSession.sparkContext.broadcast(read_bytes(vocabulary))

    @F.pandas_udf("binary")
    def to_bytes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(vocabulary, data, pattern)
        for ids in batches:
            yield pd.Series([codec.decode(i or b"") for i in ids], dtype=object)

    return rows.withColumn("decoded", to_bytes(F.col(ids_col)))


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, ids and decoded in one pass over the texts: as ``decoded(encoded(...))``."""
    data = docs.sparkSession.sparkContext.broadcast(read_bytes(vocabulary))

    @F.pandas_udf("struct<ids: binary, decoded: binary>")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(vocabulary, data, pattern)
        for texts in batches:
            ids = [codec.encode(t) for t in clean(texts)]
            yield pd.DataFrame({"ids": ids, "decoded": [codec.decode(i) for i in ids]}, dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), both(F.col(text_col)).alias("_both")).select("doc_id", "_both.*")
