"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in the word contracts: space and 0x09-0x0D.
WORD = re.compile("[^\x20\x09-\x0d]+")


def ship(module_name: str) -> None:
    """Send the functions of a module with each task, so that workers need no installed copy."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship(__name__)


def worker_cache(key, build: Callable):
    """A value built once per Python worker and kept for its later tasks."""
    store = sys.modules.setdefault("_tierweave_worker", types.ModuleType("_tierweave_worker")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; callers may pass any other path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def id_crc(col: str) -> Column:
    """CRC-32 of the decimal form of an id; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def in_sample(col: str, share: float | Column) -> Column:
    """Whether the hash of an id falls into a share of its range: a sample that no task has to sort."""
    return F.abs(F.hash(F.col(col).cast("string"), F.lit("sample")).cast("long")) < share * float(1 << 31)


def sample_bound(rows: int) -> int:
    """A limit on collected sample rows, out of reach unless many rows share an id."""
    return 2 * rows + 1000


def clean(values) -> list[str]:
    """Texts of a pandas column, NULL as the empty text."""
    return [v if isinstance(v, str) else "" for v in values]


class Memo(dict):
    """Remembered results of ``make``, at most two generations of ``limit`` entries.

    Keys over ``longest`` characters are made anew each time, so memory is bounded.
    """

    def __init__(self, make: Callable, limit: int = 400_000, longest: int = 48):
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


#: A blank that no visible character follows.
_LOOSE_BLANK = re.compile(r" (?:\s|\Z)")
_TIGHT_BLANK = re.compile(r" (?=\S)")


def chunks(text: str) -> tuple[str, list[str]]:
    """First chunk, and the later ones without the blank that each of them begins with.

    Byte-level pre-tokenizers always begin a new pre-token at a blank that a visible character
    follows, so chunks can be encoded one by one and remembered.
    """
    parts = _TIGHT_BLANK.split(text) if _LOOSE_BLANK.search(text) else text.split(" ")
    return parts[0], parts[1:]


#: Latin letters with a printable ASCII character behind them.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+(?=[!-@[-`{-~])")


def chunk_parts(key: str) -> list[str] | None:
    """A chunk cut where every pre-tokenizer used here cuts too, or None.

    That is around a line break between visible characters and behind a first run of letters;
    the parts come up far more often than the chunk.
    """
    head, newline, tail = key.partition("\n")
    if newline and head and tail and not head[-1].isspace() and not tail[0].isspace():
        return [head, newline, tail]
    letters = _LETTERS.match(key)
    return [key[:letters.end()], key[letters.end():]] if letters else None
