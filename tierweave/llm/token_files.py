"""Token ids in files: one concatenated array, document boundaries as Elias-Fano sequences.

Documents are range-sorted by id; each task encodes its range in order and writes it to files of
bounded size in a folder that all executors share. A file holds

    ids of all its documents, 2 or 4 bytes each | boundaries | document ids | trailer

``boundaries`` (the end of each document, in ids) and ``document ids`` rise, so both are stored as
Elias-Fano sequences: ``l`` low bits of each value, and the rest in unary, which takes ``l + 2``
bits a value. ``select`` finds the value of a document from a position kept for every 256th, with
no table of 64-bit offsets. A file's name is new in every attempt, so a task that runs again never
touches files that the index of another attempt points to.

The index has one row a file; where the file begins in the whole array is a running sum over it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm.common import clean, read_bytes, ship, worker_cache
from tierweave.llm.packing import library_encoder
from tierweave.llm.warc import uri
from tierweave.session import shared_folder, stored

ship(__name__)

MAGIC = b"tokenid1"
#: places of the three parts, documents with an id, documents without one, ids, bytes of an id
TRAILER = "<QQQQQQB8s"
#: Every so many values the place of the bit is kept.
KEPT = 256
#: Size of a file, about.
FILE_BYTES = 256 << 20
#: Bytes read at once.
READ_BYTES = 8 << 20
INDEX = "part int, number int, file string, n_docs long, n_ids long, first_id long, last_id long"
ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"



def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, t in zip(columns, types, strict=True)], names=names)


# ------------------------------------------------------------------ rising sequences


class EliasFano:
    """A rising sequence of integers (repeats allowed), read in place from its bytes."""

    HEAD = "<QqBQ"  # values, first value, low bits, bytes of the unary part

    @classmethod
    def encode(cls, values) -> bytes:
        n = len(values)
        if not n:
            return struct.pack(cls.HEAD, 0, 0, 0, 0)
        first = int(values[0])
        rest = np.asarray(values, np.int64).view(np.uint64) - np.array([first], np.int64).view(np.uint64)
        low = max(0, ((int(rest[-1]) + 1) // n).bit_length() - 1)
        place = (rest >> np.uint64(low)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(place[-1]) + 1, np.uint8)
        unary[place] = 1
        unary = np.packbits(unary, bitorder="little").tobytes()
        bits = [((rest >> np.uint64(b)) & np.uint64(1)).astype(np.uint8) for b in range(low)]
        lows = np.packbits(np.stack(bits, 1).ravel(), bitorder="little").tobytes() if low else b""
        return struct.pack(cls.HEAD, n, first, low, len(unary)) + place[::KEPT].astype("<u4").tobytes() + unary + lows

    def __init__(self, data: bytes):
        self.n, self.first, self.low, unary = struct.unpack_from(self.HEAD, data)
        head = struct.calcsize(self.HEAD)
        at = head + 4 * -(-self.n // KEPT)
        self.kept = np.frombuffer(data[head:at], "<u4")
        self.unary, self.lows = data[at:at + unary], data[at + unary:]

    def select(self, i: int) -> int:
        """Value number ``i``, from the kept place before it and the ones behind that."""
        place, left = int(self.kept[i // KEPT]), i % KEPT
        if left:
            byte, bit = divmod(place + 1, 8)
            word = self.unary[byte] >> bit << bit
            while word.bit_count() < left:
                left -= word.bit_count()
                byte += 1
                word = self.unary[byte]
            for _ in range(left - 1):
                word &= word - 1
            place = 8 * byte + (word & -word).bit_length() - 1
        begin = i * self.low
        word = int.from_bytes(self.lows[begin // 8:(begin + self.low + 7) // 8], "little")
        return self.first + ((place - i) << self.low | word >> begin % 8 & ((1 << self.low) - 1))

    def rank(self, value: int) -> int:
        """How many values are smaller than ``value``."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self.select(middle) < value:
                low = middle + 1
            else:
                high = middle
        return low

    def values(self) -> np.ndarray:
        """The whole sequence."""
        place = np.flatnonzero(np.unpackbits(np.frombuffer(self.unary, np.uint8), bitorder="little"))[:self.n]
        out = (place - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bits = np.unpackbits(np.frombuffer(self.lows, np.uint8), bitorder="little")[:self.n * self.low]
            for b, column in enumerate(bits.reshape(self.n, self.low).T):
                out |= column.astype(np.uint64) << np.uint64(b)
        return (out + np.array([self.first], np.int64).view(np.uint64)).view(np.int64)


# ------------------------------------------------------------------ files


class _File:
    """A file under way: ids go out at once, boundaries and document ids follow on closing."""

    def __init__(self, system, folder: str, width: int):
        self.name, self.width = f"{uuid.uuid4().hex}.ids", width
        self.out = system.open_output_stream(f"{folder}/{self.name}", compression=None)
        self.ends, self.docs, self.unnamed, self.n_ids = [], [], 0, 0

    def add(self, doc: int | None, ids: bytes) -> None:
        self.n_ids += len(ids) // 4
        self.ends.append(self.n_ids)
        if doc is None:
            self.unnamed += 1
        else:
            self.docs.append(doc)
        self.out.write(ids if self.width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes())

    def close(self) -> tuple:
        ends, docs, size = EliasFano.encode(self.ends), EliasFano.encode(self.docs), self.n_ids * self.width
        self.out.write(ends + docs + struct.pack(
            TRAILER, size, size + len(ends), size + len(ends) + len(docs), len(self.docs), self.unnamed, self.n_ids, self.width, MAGIC,
        ))
        self.out.close()
        return self.name, len(self.ends), self.n_ids, *((self.docs[0], self.docs[-1]) if self.docs else (None, None))


class TokenFile:
    """A finished file: boundaries and document ids in memory, ids read on demand."""

    def __init__(self, file):
        self.file = file
        size = struct.calcsize(TRAILER)
        end = file.size() - size
        ends, docs, stop, named, unnamed, self.n_ids, self.width, magic = struct.unpack(TRAILER, file.read_at(size, end))
        if magic != MAGIC or stop != end:
            raise ValueError("no token file, or a file that is cut short")
        self.n_docs = named + unnamed
        self.ends, self.docs = EliasFano(file.read_at(docs - ends, ends)), EliasFano(file.read_at(stop - docs, docs))

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the array."""
        raw = self.file.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4", copy=False)

    def document(self, i: int) -> tuple[int, np.ndarray]:
        """Where document number ``i`` begins, and its ids."""
        begin = self.ends.select(i - 1) if i else 0
        return begin, self.ids(begin, self.ends.select(i))

    def find(self, doc: int) -> Iterator[int]:
        """Numbers of the documents with this id."""
        i = self.docs.rank(doc)
        while i < self.docs.n and self.docs.select(i) == doc:
            yield i
            i += 1

    def documents(self, keep_ids: bool) -> Iterator[tuple]:
        """All documents in order: id, begin, length, CRC-32 of the 32-bit ids, and the ids if wanted."""
        ends = self.ends.values()
        docs = [*self.docs.values().tolist(), *[None] * (self.n_docs - self.docs.n)]
        most = READ_BYTES // self.width
        held, at = np.zeros(0, "<u4"), 0
        begin = 0
        for doc, end in zip(docs, ends.tolist(), strict=True):
            crc, parts, place = 0, [], begin
            while place < end:
                if place >= at + len(held):
                    at = place
                    held = self.ids(at, min(at + most, self.n_ids))
                part = held[place - at:end - at].tobytes()
                crc = zlib.crc32(part, crc)
                if keep_ids:
                    parts.append(part)
                place += len(part) // 4
            yield doc, begin, end - begin, crc, b"".join(parts) if keep_ids else None
            begin = end


# ------------------------------------------------------------------ writing


def write_token_files(
    docs: DataFrame, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
    folder: str | None = None, file_bytes: int = FILE_BYTES,
) -> tuple[str, DataFrame]:
    """Write the ids of all documents in ascending order of document id; returns the folder and the index.

    A NULL or empty text is the closing id alone. Document ids are integers; documents of one id
    follow each other in the order of a hash of their texts, documents without an id come last.
    Index: part, number (order of the files), file, n_docs, n_ids, first_id, last_id, begin (ids of
    all files before it). No documents, no files. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    data = spark.sparkContext.broadcast(read_bytes(vocabulary))
    closing = np.array([end_id], dtype="<u4").tobytes()
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the hash lets a range boundary fall among many documents of one id, or among those without one
    keys = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranged = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).repartitionByRange(
        *keys).sortWithinPartitions(*keys, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encode = worker_cache(("library", vocabulary), lambda: library_encoder(data.value))
        width = worker_cache(("id width", vocabulary), lambda: id_width(data.value, end_id))
        system, place = fs.FileSystem.from_uri(uri(folder))
        system.create_dir(place, recursive=True)
        part, rows, out = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), clean(batch.column(1).to_pylist()), strict=True):
                out = out or _File(system, place, width)
                out.add(doc, encode(text) + closing)
                if out.n_ids * width >= file_bytes:
                    rows.append((part, len(rows), *out.close()))
                    out = None
        if out:
            rows.append((part, len(rows), *out.close()))
        if rows:
            yield _batch(rows, INDEX)

    index = stored(ranged.mapInArrow(write, INDEX))
    # one row a file
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return folder, index.withColumn("begin", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def id_width(data: bytes, end_id: int) -> int:
    """Bytes that hold every id of a vocabulary."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    ids = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
    return 2 if max(ids, end_id) < 1 << 16 else 4


# ------------------------------------------------------------------ reading


def read_documents(folder: str, index: DataFrame, keep_ids: bool = False) -> DataFrame:
    """All documents of the files: doc_id, start, n_tokens, ids_crc32, ids (32-bit, NULL unless ``keep_ids``)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(uri(folder))
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(f"{place}/{name}") as file:
                    held, size = [], 0
                    for doc, begin, n, crc, ids in TokenFile(file).documents(keep_ids):
                        held.append((doc, base + begin, n, crc, ids))
                        size += 64 + len(ids or b"")
                        if size > READ_BYTES:
                            yield _batch(held, DOCUMENT)
                            held, size = [], 0
                    if held:
                        yield _batch(held, DOCUMENT)

    files = index.count()
    # a number of its own keeps the few small rows of the index from being merged into one task
    return index.select("file", "begin").repartition(max(1, files)).mapInArrow(read, DOCUMENT)


def fetch_documents(folder: str, index: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The documents of some ids, by select and one range read each; columns as of ``read_documents``."""
    wanted = sorted(set(doc_ids))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(uri(folder))
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with system.open_input_file(f"{place}/{name}") as file:
                    opened = TokenFile(file)
                    for doc in wanted:
                        for i in opened.find(doc):
                            begin, ids = opened.document(i)
                            raw = ids.tobytes()
                            yield _batch([(doc, base + begin, len(ids), zlib.crc32(raw), raw)], DOCUMENT)

    inside = F.exists(F.lit(wanted) if wanted else F.array().cast("array<long>"), lambda d: (d >= F.col("first_id")) & (d <= F.col("last_id")))
    files = index.filter(inside).select("file", "begin")
    return files.repartition(max(1, files.count())).mapInArrow(read, DOCUMENT)


def written_and_read(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write the documents and read all of them back: doc_id, start, n_tokens, ids_crc32."""
    return read_documents(*write_token_files(docs, vocabulary, end_id)).drop("ids")
