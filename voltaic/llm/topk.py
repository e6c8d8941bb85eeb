"""Exact top-k inner-product search by pivot-table elimination.

Vectors are quantised to whole numbers; every vector's distances to ``PIVOTS`` reference vectors are
computed once and stored with it. Since ``2 <q, x> = |q|^2 + |x|^2 - d(q, x)^2`` and ``d(q, x)`` is at
least the largest ``|d(q, p) - d(x, p)|`` over the pivots p, the table bounds every score from above
without touching the vectors. Candidates are evaluated in the order of that bound, best first, until the
next bound is below the k-th best score found, which is an exact stopping rule.

Every query has its own order and its own stop: a task takes its candidates in chunks, and of a chunk each
query evaluates the ``STEP`` best bounds, then the best ``GROWTH`` times as many of those that its k-th score so far
leaves, and so on; none that its bound excludes.

Queries come in blocks of ``BLOCK`` rows, one after another: a block is sent to the tasks as one small matrix, its
k rows for each query are written to the shared folder, and the matrix is taken back. Driver and tasks hold
one block, however many queries there are; a task keeps k rows for each query of the block, so neither side is
ever gathered whole and no pairs are emitted beyond k for a query and task.

Defined results: vectors that are null, empty or hold null, NaN or infinite components take no part;
rows with a null id take no part; of several rows with one query id the smallest vector asks; a row with the
query's id is the query's own; shorter vectors count as padded with zeros; an empty table gives an
empty result. Products are exact: in doubles while ``dimension * max^2`` is below 2^53, in 64-bit whole
numbers below 2^63, and beyond that, where a score is no long any more, an error says so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltaic.llm.common import scratch_dir, store

PIVOTS = 32
#: Queries that go to the tasks together.
BLOCK = 2048
#: Candidates that a task bounds together, and those of them that a query evaluates first, the best bounds; how many times
#: more it evaluates at each further step.
CHUNK, STEP, GROWTH = 4096, 16, 16
#: Queries whose bounds are at hand together: with a chunk's candidates about 1 MB.
TOGETHER = 64
#: Doubles hold all whole numbers below this.
WHOLE = 1 << 53


def quantised(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(scale * x) of each component, as doubles, of the rows that take part."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(~F.coalesce(bad, F.lit(True)))
    def whole(x):  # doubles beyond 2^53 are whole numbers, and too large for floor's long
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < WHOLE, F.floor(scaled).cast("double")).otherwise(scaled)

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, whole).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a column as rows, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    if len(flat):
        out[np.repeat(np.arange(len(ends)), ends), np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)] = flat
    return out


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * x @ p.T, 0.0))


class Best:
    """The k best (score, id) of each query: higher scores first, ties to the smaller id."""

    def __init__(self, queries: int, k: int, kind: type = float):
        self.k = k
        self.none = -np.inf if kind is float else np.iinfo(np.int64).min + 1
        self.score, self.id = np.full((queries, k), self.none, kind), np.full((queries, k), np.iinfo(np.int64).max)
        self.evaluated = 0

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """``score[i]`` and ``ids[i]`` belong to query ``rows[i]``; ``none``: not a candidate."""
        s = np.concatenate([self.score[rows], score], axis=1)
        i = np.concatenate([self.id[rows], ids], axis=1)
        i = np.where(s == self.none, np.iinfo(np.int64).max, i)
        order = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)

    def add_pairs(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores and candidates of single queries, ``row`` ascending."""
        order = np.lexsort((ids, -score, row))
        rows, starts, counts = np.unique(row, return_index=True, return_counts=True)
        place = np.arange(len(row)) - np.repeat(starts, counts)
        order, place = order[place < self.k], place[place < self.k]
        at = np.searchsorted(rows, row[order])
        s, i = np.full((len(rows), self.k), self.none, self.score.dtype), np.full((len(rows), self.k), np.iinfo(np.int64).max)
        s[at, place], i[at, place] = score[order], ids[order]
        self.add(rows, s, i)


def _bounds(q: np.ndarray, q_table: np.ndarray, x: np.ndarray, x_table: np.ndarray, far: float) -> np.ndarray:
    """What the score of each query (row) and candidate (column) can't exceed; ``x_table`` by pivot."""
    q2, x2 = (q * q).sum(1), (x * x).sum(1)
    gap, one = np.zeros((len(q), len(x)), np.float32), np.empty((len(q), len(x)), np.float32)
    for p in range(len(x_table)):
        np.subtract(q_table[:, p, None], x_table[p], out=one)
        np.maximum(gap, np.abs(one, out=one), out=gap)
    slack = 1e-5 * (1 + np.sqrt(q2)[:, None] + np.sqrt(x2)[None, :]) + 1e-6 * far  # the table is single precision
    both = q2[:, None] + x2[None, :]
    return (both - np.maximum(gap - slack, 0) ** 2) / 2 + 1e-12 * both


def _search(best: Best, q: np.ndarray, q_ids: np.ndarray, q_table: np.ndarray, x: np.ndarray, x_ids: np.ndarray, x_table: np.ndarray, far: float) -> None:
    """Evaluates one chunk of candidates for all queries of a block; ``far``: the largest pivot's length."""
    kind, by_pivot = best.score.dtype, np.ascontiguousarray(x_table.T)
    xs = x.astype(kind)
    for at in range(0, len(q), TOGETHER):
        some = slice(at, at + TOGETHER)
        bound, qs, size = _bounds(q[some], q_table[some], x, by_pivot, far), q[some].astype(kind), STEP
        bound[q_ids[some, None] == x_ids] = -np.inf  # a query's own rows, and later those that it has evaluated
        while True:
            kth = best.score[some, -1]
            open_ = (bound >= kth[:, None]) & (bound > -np.inf)
            many = np.flatnonzero(open_.sum(1) > size)
            if len(many):  # the best bounds first: the k-th score that they give may exclude the rest
                first = np.argpartition(bound[many], len(x) - size, axis=1)[:, len(x) - size :]
                open_[many] = False
                open_[many[:, None], first] = True
            count = np.count_nonzero(open_)
            if not count:
                break
            if count * 8 < open_.size:
                row, column = np.nonzero(open_)
                score = np.einsum("ij,ij->i", qs[row], xs[column])
                high = score >= kth[row]
                row, column, score = row[high], column[high], score[high]
            else:  # most of the pairs: the product of both as matrices costs less than picking their vectors
                product = qs @ xs.T
                row, column = np.nonzero(open_ & (product >= kth[:, None]))
                score = product[row, column]
            best.evaluated += count
            best.add_pairs(at + row, score, x_ids[column])
            bound[open_] = -np.inf
            size *= GROWTH


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's k highest inner products.

    ``vectors`` and ``queries`` are ``vec_id, v`` as ``quantised`` returns them.
    """
    spark = vectors.sparkSession
    size = vectors.agg(F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    width, most = size["width"] or 0, float(size["most"] or 0)
    if width * most * most >= 1 << 63:
        raise ValueError("inner products of these vectors are no longs")
    kind = float if width * most * most < WHOLE else np.int64
    pivots = vectors.orderBy(F.xxhash64("vec_id", F.lit(11)), "vec_id").limit(PIVOTS).toArrow()
    points = _matrix(pivots["v"], width)
    far = float(np.sqrt((points * points).sum(1)).max(initial=0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), width)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([row.astype("<f8").tobytes() for row in x], pa.binary()), pa.array([row.astype("<f4").tobytes() for row in _distances(x, points)], pa.binary())],
                names=["vec_id", "v", "distances"],
            )

    table = store(vectors.mapInArrow(measure, "vec_id long, v binary, distances binary"))
    asked = store(queries.groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(measure, "vec_id long, v binary, distances binary"))

    def rows_of(b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.asarray(b.column("vec_id"), np.int64)
        join = lambda name, kind, w: np.frombuffer(b"".join(b.column(name).to_pylist()), kind).reshape(len(ids), w)
        return join("v", "<f8", width), ids, join("distances", "<f4", len(points))

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    path, after, blocks = scratch_dir(spark), None, 0
    names = "query_id long, vec_id long, score long"
    while True:  # the queries by id, a bounded block at a time
        rows = (asked if after is None else asked.filter(F.col("vec_id") > after)).orderBy("vec_id").limit(BLOCK).toArrow()
        if rows.num_rows:
            after, blocks = rows["vec_id"][-1].as_py(), blocks + 1
            sent = spark.sparkContext.broadcast(rows_of(rows))

            def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                q, q_ids, q_table = sent.value
                best = Best(len(q), k, kind)
                for b in batches:
                    x, x_ids, x_table = rows_of(b)
                    for at in range(0, len(x), CHUNK):
                        s = slice(at, at + CHUNK)
                        _search(best, q, q_ids, q_table, x[s], x_ids[s], x_table[s], far)
                found = best.score != best.none
                row, _ = np.nonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[row]), pa.array(best.id[found]), pa.array(best.score[found].astype(np.int64))], names=["query_id", "vec_id", "score"])

            ranked = table.mapInArrow(run, names).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score").write.mode("append").parquet(path)
            sent.unpersist()
        if rows.num_rows < BLOCK:
            break
    schema = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(schema).parquet(path) if blocks else spark.createDataFrame([], schema)


def digest(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    vectors = quantised(embeddings)
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


#: The same search by brute force.
ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""
