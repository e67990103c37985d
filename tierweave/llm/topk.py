"""Exact top-k by integer inner product, by histogram selection.

Vectors are packed into blocks, and every block of queries meets every block of candidates once
a pass, on a grid of (query block, candidate slice) that spreads evenly. A pass does not move
scores: each pair of blocks adds to one histogram per query over the range where its k-th score
is known to lie. The histograms, summed over all blocks, tell the bin of the k-th score, which is
the range of the next pass; bins end up one score wide. A last pass lets through what lies above
the k-th score and, among equals, the smallest ids.

A block only adds its k highest scores within the range: bins below them cannot hold the k-th
score, and counts of the bins above it stay exact, so the outcome is that of the full histogram.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm.common import ship
from tierweave.session import cut_lineage

ship(__name__)

SCALE = 256
QUERY_ROWS = 1024
CANDIDATE_ROWS = 4096
#: log2 of the bins of a pass.
BIN_BITS = 12
#: Below this bound products are exact in double precision and use the fast matrix product.
EXACT = float(1 << 53)
#: Largest component after scaling, and end of the range of scores; what lies beyond counts as the end.
LARGEST = 1 << 52
LAST = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """_id and the integer vector; rows that are null or hold null or non-finite components go."""
    odd = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~odd).select(
        F.col(id_col).cast("long").alias("_id"),
        F.transform(vector_col, lambda x: F.floor(F.least(F.greatest(
            x.cast("double") * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST))))).alias("_v"),
    )


def _pack(batch: pd.DataFrame, rows: int) -> Iterator[tuple]:
    """(vectors, dimension, ids, matrix, largest component) of runs of at most ``rows`` vectors."""
    sizes = batch["_v"].map(len).to_numpy()
    for dim in np.unique(sizes):
        part = batch[sizes == dim]
        for at in range(0, len(part), rows):
            run = part.iloc[at:at + rows]
            m = np.stack(run["_v"].to_list()).astype(np.int64) if dim else np.zeros((len(run), 0), np.int64)
            yield len(run), int(dim), run["_id"].to_numpy(np.int64).tobytes(), m.tobytes(), int(np.abs(m).max(initial=0))


def _candidate_blocks(vectors: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= CANDIDATE_ROWS:
                yield pd.DataFrame(_pack(pd.concat(held), CANDIDATE_ROWS), columns=["n", "dim", "ids", "m", "top"])
                held, n = [], 0
        if n:
            yield pd.DataFrame(_pack(pd.concat(held), CANDIDATE_ROWS), columns=["n", "dim", "ids", "m", "top"])

    return vectors.mapInPandas(run, "n int, dim int, ids binary, m binary, top long")


def _query_blocks(queries: DataFrame, many: int) -> DataFrame:
    """Blocks of about ``QUERY_ROWS`` queries, dealt by hash."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(_pack(group, len(group)), columns=["qn", "dim", "qids", "q", "qtop"])
        out.insert(0, "qb", group["qb"].iloc[0])
        return out

    return queries.withColumn("qb", F.pmod(F.xxhash64("_id"), F.lit(many)).cast("int")).groupBy("qb").applyInPandas(
        run, "qb int, qn int, dim int, qids binary, q binary, qtop long",
    )


def inner_products(q: np.ndarray, m: np.ndarray, top: float) -> np.ndarray:
    """Inner products of all rows, cut to the range of a long; ``top`` bounds their size."""
    if top < EXACT:
        return (q.astype(float) @ m.T.astype(float)).astype(np.int64)
    s = q @ m.T  # right modulo 2 ** 64, whatever the size
    if top < 2.0 ** 62:
        return s
    about = q.astype(float) @ m.T.astype(float)
    # what rounding may have moved: a share of the sum of the products' sizes
    doubt = 1e-12 * (np.abs(q).astype(float) @ np.abs(m).T.astype(float))
    s[about - doubt > LAST], s[about + doubt < -LAST] = LAST, -LAST
    for i, j in zip(*np.nonzero(np.abs(np.abs(about) - LAST) <= doubt)):
        s[i, j] = max(-LAST, min(LAST, sum(a * b for a, b in zip(q[i].tolist(), m[j].tolist()))))
    return s


def _scores(row) -> np.ndarray:
    """Scores (queries x candidates) counted from the lowest long; the query's own row gets 0."""
    q = np.frombuffer(row.q, np.int64).reshape(row.qn, row.dim)
    m = np.frombuffer(row.m, np.int64).reshape(row.n, row.dim)
    s = unsigned(inner_products(q, m, float(row.qtop) * float(row.top) * max(row.dim, 1)))
    own = np.frombuffer(row.qids, np.int64)[:, None] == np.frombuffer(row.ids, np.int64)[None, :]
    s[own] = 0
    return s


def unsigned(s: np.ndarray) -> np.ndarray:
    """Longs as distances from the lowest one, in the same order."""
    return s.view(np.uint64) ^ np.uint64(1 << 63)


def signed(s: np.ndarray) -> np.ndarray:
    return (s ^ np.uint64(1 << 63)).view(np.int64)


def _highest(s: np.ndarray, k: int) -> np.ndarray:
    return -np.partition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]


def exact_top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best candidates of each query row.

    Scores are inner products of ``floor(256 * x)``; equal scores go to the smaller id. A query
    never meets rows of its own id, nor vectors of another dimension. Null vectors and vectors
    with null or non-finite components take no part. Components over 2 ** 52 after scaling count as
    2 ** 52, scores beyond the range of a long as its ends. With fewer than k candidates all are
    returned; repeated query rows each get their own result rows. No other column is read.
    """
    spark = queries.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    blocks = cut_lineage(_candidate_blocks(quantised(candidates, id_col, vector_col)))
    asked = quantised(queries, id_col, vector_col)
    many = asked.count()
    limits = blocks.agg(F.count("*"), F.max("top"), F.max("dim")).first()
    if not many or not limits[0]:
        return spark.createDataFrame([], schema)
    n_query_blocks = ceil(many / QUERY_ROWS)
    asked = cut_lineage(_query_blocks(asked, n_query_blocks))
    most = asked.agg(F.max("qtop")).first()[0]
    # scores lie in [-2**bits, 2**bits)
    bits = min(63, floor(log2(max(1, most * limits[1] * max(1, limits[2])))) + 1)
    slices = min(limits[0], int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = blocks.withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))),
    )

    def grid(state: DataFrame) -> DataFrame:
        ranged = asked.join(state, ["qb", "dim"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        return ranged.join(dealt, ["qb", "slice", "dim"])

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["lo"] = [np.full(n, (1 << 63) - (1 << bits), np.uint64).tobytes() for n in batch.pop("qn")]
            batch["need"] = [np.full(len(lo) // 8, k, np.int64).tobytes() for lo in batch["lo"]]
            yield batch

    range_type = "qb int, dim int, lo binary, need binary"
    state = asked.select("qb", "dim", "qn").mapInPandas(start, range_type)
    width = bits + 1
    while width > 0:
        step = min(BIN_BITS, width)
        width -= step

        def add(batches: Iterator[pd.DataFrame], width=width, step=step) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    s = _scores(row)
                    lo = np.frombuffer(row.lo, np.uint64)[:, None]
                    place = (s - lo) >> np.uint64(width)
                    outside = (s < lo) | (place >= np.uint64(1 << step)) | (s == 0)
                    place = place.astype(np.int64)
                    place[outside] = -1
                    top = _highest(place, k)
                    i, j = np.nonzero(top >= 0)
                    cell, n = np.unique(i.astype(np.int64) << step | top[i, j], return_counts=True)
                    yield pd.DataFrame({"qb": row.qb, "dim": row.dim, "cell": cell, "n": n})

        counted = grid(state).mapInPandas(add, "qb int, dim int, cell long, n long").groupBy("qb", "dim", "cell").agg(
            F.sum("n").alias("n"),
        ).groupBy("qb", "dim").agg(  # at most k bins per block and query of one query block
            F.collect_list(F.struct("cell", "n")).alias("cells"),
        )

        def refine(batches: Iterator[pd.DataFrame], width=width, step=step) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for row in batch.itertuples():
                    lo, need = np.frombuffer(row.lo, np.uint64).copy(), np.frombuffer(row.need, np.int64).copy()
                    cells = row.cells if row.cells is not None else []
                    cell = np.array([c["cell"] for c in cells], np.int64)
                    n = np.array([c["n"] for c in cells], np.int64)
                    order = np.argsort(cell)[::-1]
                    for i, place, count in zip(cell[order] >> step, cell[order] & ((1 << step) - 1), n[order], strict=True):
                        # bins from the top; the sign marks queries whose bin is found
                        if need[i] > 0:
                            if count >= need[i]:
                                lo[i] += np.uint64(int(place) << width)
                                need[i] = -need[i]
                            else:
                                need[i] -= count
                    out.append((row.qb, row.dim, lo.tobytes(), np.abs(need).tobytes()))
                yield pd.DataFrame(out, columns=["qb", "dim", "lo", "need"])

        state = cut_lineage(state.join(counted, ["qb", "dim"], "left").mapInPandas(refine, range_type))

    def let_through(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                s, lo = _scores(row), np.frombuffer(row.lo, np.uint64)[:, None]
                ids, qids = np.frombuffer(row.ids, np.int64), np.frombuffer(row.qids, np.int64)
                i, j = np.nonzero((s >= lo) & (s > 0))
                order = np.lexsort((ids[j], ~s[i, j], i))
                i, j = i[order], j[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[nth < k], j[nth < k]
                yield pd.DataFrame({
                    "qb": row.qb, "dim": row.dim, "i": i, "query_id": qids[i], "vec_id": ids[j], "score": signed(s[i, j]),
                })

    found = grid(state).mapInPandas(let_through, "qb int, dim int, i int, query_id long, vec_id long, score long")
    best = Window.partitionBy("qb", "dim", "i").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score",
    )


def top_k_sql(k: int = 5) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
e AS (SELECT vec_id, unnest(q) AS x, unnest(range(1, len(q) + 1)) AS i FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
