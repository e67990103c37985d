"""Vector code compression: parts of vectors coded by codebooks of integer entries, by LAESA pivots.

A few entries of each first codebook, far from each other, are its pivots for good. The distances
of every part to them are computed once and stored with the vectors. A round only computes the
distances of the entries to the pivots; by the triangle inequality their differences bound the
distance of a part to an entry from below. Entries are tried in order of that bound, and those
whose bound exceeds the best distance found are never evaluated. Distances that decide are exact
integers, so pruning changes no result.

A round sends one row per entry and task; only the codebooks pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import ship
from tierweave.session import stored

ship(__name__)

PIVOTS = 8
#: Entries per part that are tried before the others are pruned.
FIRST_TRIED = 6
#: Rows handled at once.
ROWS = 2048
#: Components below this have exact squared distances in 64 bits, for up to 2 ** 5 a part.
NARROW = 1 << 28
#: Share of the distances by which rounding to floats may shift a bound.
SLACK = 1e-6


# ------------------------------------------------------------------ integers


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): 64-bit where that is safe, else Python integers."""
    top = float(np.abs(x).max(initial=0)) * scale
    if top < NARROW and x.shape[1] <= 128:
        return np.floor(x.astype(np.float64) * scale).astype(np.int64)

    def whole(value: float) -> int:
        n, d = float(value).as_integer_ratio()
        return n * scale // d

    out = np.empty(x.shape, object)
    out.ravel()[:] = [whole(v) for v in x.ravel()]
    return out


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (a, b) if a.dtype == b.dtype else (a.astype(object), b.astype(object))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact."""
    d = a - b
    return (d * d).sum(axis=1) if d.dtype == object else np.einsum("ij,ij->i", d, d)


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of each part to each pivot."""
    parts, pivots = _alike(parts, pivots)
    out = np.zeros((len(parts), len(pivots)))
    for p, pivot in enumerate(pivots):
        out[:, p] = _root(_squared(parts, pivot[None, :]))
    return out


def _root(squared: np.ndarray) -> np.ndarray:
    """Square roots as doubles; infinite where a double cannot hold them."""
    if squared.dtype != object:
        return np.sqrt(squared.astype(np.float64))
    return np.array([float(s) ** 0.5 if s < 1 << 1000 else np.inf for s in squared])


def choose_pivots(entries: np.ndarray, many: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: each next one has the largest distance to those taken."""
    taken = [0]
    while len(taken) < min(many, len(entries)):
        far = pivot_distances(entries, entries[taken]).min(axis=1)
        if not far.max() > 0:
            break
        taken.append(int(far.argmax()))
    return entries[taken]


def lower_bounds(part_pivots: np.ndarray, entry_pivots: np.ndarray) -> np.ndarray:
    """For each entry and part the largest difference of their distances to a pivot."""
    bound = np.zeros((len(entry_pivots), len(part_pivots)), np.float32)
    with np.errstate(invalid="ignore", over="ignore"):
        a, b = part_pivots.T.astype(np.float32), entry_pivots.T.astype(np.float32)
        for p in range(len(a)):
            np.maximum(bound, np.abs(a[p][None, :] - b[p][:, None]), out=bound)
    # where a distance is too large for a float nothing is known
    return np.nan_to_num(bound, copy=False, nan=0, posinf=0)


def nearest(
    parts: np.ndarray, entries: np.ndarray, part_pivots: np.ndarray, entry_pivots: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each part (ties to the lower index), its squared distance, evaluations made."""
    parts, entries = _alike(parts, entries)
    if parts.dtype == np.int64 and parts.shape[1] <= 1024 and max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)) < 1 << 20:
        # doubles hold these integers, and all sums below, exactly
        parts, entries = parts.astype(np.float64), entries.astype(np.float64)
    n, many = len(parts), len(entries)
    bound = lower_bounds(part_pivots, entry_pivots)
    # no distance exceeds the way over a pivot, so rounding errors are a share of that way
    slack = SLACK * (part_pivots.max(axis=1, initial=0) + entry_pivots.max(initial=0))
    tried = min(FIRST_TRIED, many)
    order = np.sort(np.argpartition(bound, tried - 1, axis=0)[:tried], axis=0)
    choice = order[0].copy()
    best = _squared(parts, entries[choice])
    for place in order[1:]:
        squared = _squared(parts, entries[place])
        nearer = squared < best
        best[nearer], choice[nearer] = squared[nearer], place[nearer]
    bound[order, np.arange(n)] = np.inf
    limit = _root(best) + slack
    evaluated = n * tried
    for j in range(many):
        left = np.flatnonzero(bound[j] <= limit)
        if len(left):
            squared = _squared(parts[left], entries[j][None, :])
            evaluated += len(left)
            held = best[left]
            better = (squared < held) | ((squared == held) & (j < choice[left]))
            moved = left[better]
            best[moved], choice[moved] = squared[better], j
            limit[moved] = _root(best[moved]) + slack[moved]
    return choice, best if best.dtype == object else best.astype(np.int64), evaluated


# ------------------------------------------------------------------ codebooks


class Codebooks:
    """The codebook of each part, with its pivots and their distances to the entries."""

    def __init__(self, books: list[np.ndarray], pivots: list[np.ndarray]):
        self.books, self.pivots = books, pivots
        self.distances = [pivot_distances(b, p) for b, p in zip(books, pivots, strict=True)]

    def digest(self) -> str:
        """SHA-256 of all components in order."""
        return hashlib.sha256(",".join(str(int(c)) for b in self.books for e in b for c in e).encode()).hexdigest()

    def assign(self, x: np.ndarray, pivoted: np.ndarray, scale: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Per part: its number, the integers, the nearest entries and the squared distances."""
        width, at = x.shape[1] // len(self.books), 0
        whole = integers(x, scale)
        for part, book in enumerate(self.books):
            own = whole[:, part * width:(part + 1) * width]
            many = len(self.pivots[part])
            choice, squared, _ = nearest(own, book, pivoted[:, at:at + many], self.distances[part])
            at += many
            yield part, own, choice, squared


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, zeros behind those that are shorter."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(lengths), width), flat.dtype)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _slices(batch: pa.RecordBatch, width: int, dtype: str, pivots: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        n = part.num_rows
        yield (
            part, np.frombuffer(b"".join(part.column(2).to_pylist()), dtype).reshape(n, width),
            np.frombuffer(b"".join(part.column(3).to_pylist()), np.float64).reshape(n, pivots),
        )


def kept_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, v; rows whose vector is null or holds null or non-finite components go."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.filter(F.col(vector_col).isNotNull() & ~odd).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"),
    )


def fit_codes(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, pivots: int = PIVOTS,
) -> tuple[Codebooks | None, DataFrame | None]:
    """Codebooks of ``kept_vectors``, and the stored frame (vec_id, label, x, pivoted) for ``assigned``.

    The first codebooks are the parts of the vectors of smallest id; equal ids go by their vectors,
    missing ids come last. Vectors are filled with zeros up to the length of the longest, rounded up
    to a multiple of ``parts``. Without vectors both results are None.
    """
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None, None
    width = -(-longest // parts) * parts
    dtype = "float32" if vectors.schema["v"].dataType.elementType.simpleString() == "float" else "float64"
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()  # the codebook's size
    start = np.zeros((len(first), width), np.float64)
    for row, held in zip(start, first, strict=True):
        row[:len(held[0])] = held[0]
    cut = np.split(integers(start, scale), parts, axis=1)
    books = Codebooks(cut, [choose_pivots(b, pivots) for b in cut])
    many = sum(map(len, books.pivots))
    if dtype == "float64":
        vectors = vectors.withColumn("v", F.col("v").cast("array<double>"))

    def measure(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), width)
            whole = np.split(integers(x, scale), parts, axis=1)
            far = np.concatenate([pivot_distances(w, p) for w, p in zip(whole, books.pivots, strict=True)], axis=1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()),
                pa.array([r.tobytes() for r in far], pa.binary()),
            ], names=["vec_id", "label", "x", "pivoted"])

    types = {f.name: f.dataType.simpleString() for f in vectors.schema}
    measured = stored(vectors.mapInArrow(measure, f"vec_id {types['vec_id']}, label {types['label']}, x binary, pivoted binary"))
    for _ in range(rounds):
        def sums(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            total = [np.zeros(b.shape, object) for b in books.books]
            number = [np.zeros(len(b), np.int64) for b in books.books]
            for batch in batches:
                for _, x, far in _slices(batch, width, dtype, many):
                    for part, own, choice, _ in books.assign(x, far, scale):
                        order = np.argsort(choice, kind="stable")
                        used, begins, counts = np.unique(choice[order], return_index=True, return_counts=True)
                        total[part][used] += np.add.reduceat(own[order], begins, axis=0).astype(object)
                        number[part][used] += counts
            rows = [
                (part, int(e), int(number[part][e]), [str(c) for c in total[part][e]])
                for part in range(parts) for e in np.flatnonzero(number[part])
            ]
            if rows:
                part, entry, n, total = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.string()))],
                    names=["part", "entry", "n", "total"],
                )

        def add(group: pd.DataFrame) -> pd.DataFrame:
            total = [str(sum(map(int, column))) for column in zip(*group["total"], strict=True)]
            return pd.DataFrame({"part": group["part"][:1], "entry": group["entry"][:1], "n": [group["n"].sum()], "total": [total]})

        schema = "part int, entry int, n long, total array<string>"
        # a row per entry and task; of numbers of any size, which no column type could add up
        found = measured.select("vec_id", "label", "x", "pivoted").mapInArrow(sums, schema).groupBy("part", "entry").applyInPandas(add, schema)
        moved = [b.astype(object) for b in books.books]
        for r in found.collect():  # the codebooks' size
            moved[r["part"]][r["entry"]] = [int(c) // r["n"] for c in r["total"]]
        books = Codebooks([_narrow(b) for b in moved], books.pivots)
    return books, measured


def _narrow(book: np.ndarray) -> np.ndarray:
    small = book.shape[1] <= 32 and all(abs(c) < NARROW for c in book.ravel())
    return book.astype(np.int64) if small else book


def assigned(measured: DataFrame, books: Codebooks, scale: int = 1024) -> DataFrame:
    """vec_id, label, code, error of the stored frame; an error over 63 bits is NULL."""
    many = sum(map(len, books.pivots))
    width = sum(b.shape[1] for b in books.books)
    types = {f.name: f.dataType.simpleString() for f in measured.schema}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dtype = "float32" if len((batch.column(2)[0].as_py() if batch.num_rows else b"")) == 4 * width else "float64"
            for part, x, far in _slices(batch, width, dtype, many):
                codes, error = [], 0
                for _, _, choice, squared in books.assign(x, far, scale):
                    codes.append(choice)
                    error = error + squared.astype(object)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(["".join(f"{c:02x}" for c in row) for row in zip(*codes, strict=True)], pa.string()),
                    pa.array([int(e) if e < 1 << 63 else None for e in error], pa.int64()),
                ], names=["vec_id", "label", "code", "error"])

    return measured.mapInArrow(code, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long")


def vector_codes(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part.

    Repeated rows each take part and get a row. ``label_error`` sums the errors of a label, those
    without one together; it is NULL where a sum or one of its errors exceeds 63 bits. Other columns
    are not read. No vectors, no rows.
    """
    kept = kept_vectors(vectors, id_col, vector_col, label_col)
    books, measured = fit_codes(kept, parts, entries, rounds, scale)
    if books is None:
        return kept.select(
            "vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"),
            F.lit("").alias("codebooks_sha256"),
        ).limit(0)
    coded = stored(assigned(measured, books, scale))
    totals = coded.groupBy(F.col("label").alias("_label")).agg(
        F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error"),
    )
    return coded.join(totals, coded["label"].eqNullSafe(totals["_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"),
    )


def vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The same rounds by evaluating every entry for every part."""
    def assign(n: int) -> str:
        return f"""
a{n} AS (
  SELECT vec_id, part, arg_min({{entry: entry, d: d}}, {{d: d, entry: entry}}) AS best FROM (
    SELECT vec_id, p.part, entry, list_sum([(p.v[i] - b.v[i]) * (p.v[i] - b.v[i]) FOR i IN range(1, len(p.v) + 1)])::BIGINT AS d
    FROM p JOIN b{n} b ON p.part = b.part) GROUP BY vec_id, part)"""

    def move(n: int) -> str:
        return f"""
s{n} AS (
  SELECT part, entry, i, sum(x)::BIGINT AS total, count(*) AS n
  FROM (SELECT p.part, best.entry AS entry, unnest(p.v) AS x, unnest(range(1, len(p.v) + 1)) AS i FROM p JOIN a{n} USING (vec_id, part))
  GROUP BY part, entry, i),
m{n} AS (SELECT part, entry, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM s{n} GROUP BY part, entry),
b{n + 1} AS (SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN m{n} m USING (part, entry))"""

    steps = ",".join(x for n in range(rounds) for x in (assign(n), move(n)))
    return f"""
WITH k AS (
  SELECT vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (
  SELECT vec_id, label, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS v
  FROM k, (SELECT unnest(range({parts})) AS part)),
b0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v
  FROM p WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries})),{steps},{assign(rounds)},
e AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM a{rounds} JOIN k USING (vec_id) GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM e"""
