"""Exact top-k by inner product with pivot-table elimination.

The inner product becomes a distance: with ``M`` the largest norm, a candidate
gets one more component ``sqrt(M^2 - |c|^2)`` and a query a zero there, so
``|q' - c'|^2 = |q|^2 + M^2 - 2 q.c``. Distances from every candidate to a set
of pivots are computed once and stored. By the triangle inequality the largest
``|d(q', p) - d(c', p)|`` over the pivots bounds ``d(q', c')`` from below, that
is, the score from above. Each task takes its candidates in the order of that
bound and stops when the next bound is below the k-th best score it knows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, table

SCALE = 1024
#: Rows (by hashed id) of which pivots are taken, and pivots: bounds on what the driver holds.
PIVOT_ROWS, PIVOTS = 1024, 64
#: Queries sent to the tasks at once; more are searched in further passes.
QUERY_BYTES = 32 << 20
#: Candidates bounded at once in a task, and those first evaluated in bound order.
CHUNK, FIRST = 2048, 64
#: Slack of a bound on squared distances, relative to them; far above float error.
SLACK = 1e-5
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1

_TABLE = "vec_id bigint, v binary, far binary"
_RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"
_FOUND = "q int, vec_id bigint, score bigint"


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): the rows that take part, components floored to integers as doubles.

    A row without id, vector or with a null or non-finite component takes no part.
    """
    x = F.transform(F.col(f"`{vec_col}`"), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), x.alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad)

    def whole(c):  # beyond 2^53 every double is an integer
        return F.when(F.abs(c * SCALE) < EXACT, F.floor(c * SCALE).cast("double")).otherwise(c * SCALE)
    return rows.select("vec_id", F.transform("x", whole).alias("v"))


def _padded(rows, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _column(col: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix; shorter rows end in zeros."""
    offs = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)
    if len(col) and (np.diff(offs) == dims).all():
        return flat[offs[0]:offs[-1]].reshape(len(col), dims)
    return _padded([flat[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)], dims)


def farthest(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Rows of ``sample`` far from each other: each the farthest from those before it."""
    if not len(sample):
        return sample
    chosen, near = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def lifted(v: np.ndarray, most2: float) -> np.ndarray:
    """Candidates with the component that makes all norms equal."""
    rest = np.sqrt(np.maximum(most2 - (v * v).sum(1), 0))
    return np.concatenate([v, rest[:, None]], axis=1)


def pivot_table(rows: DataFrame, dims: int, most2: float, pivots: np.ndarray) -> DataFrame:
    """Every candidate with its distances to the pivots, computed once and stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _column(batch.column("v"), dims)
            far = distances(lifted(v, most2), pivots).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in v], pa.binary()),
                 pa.array([r.tobytes() for r in far], pa.binary())], ["vec_id", "v", "far"])
    return cut(rows.mapInArrow(run, _TABLE), "topk-table")


def _scores(v: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (v @ q).astype(np.int64)
    whole = [int(x) for x in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, whole, strict=True)), -LONG - 1),
                         LONG) for row in v], np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    return np.lexsort((ids, ~score))[:k]


class Search:
    """The best candidates of one task for a block of queries."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, pivots: np.ndarray, most2: float,
                 k: int, exact: bool):
        self.ids, self.q, self.k, self.exact, self.most2 = ids, q, k, exact, most2
        self.q2 = (q * q).sum(1)
        flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        self.far = distances(flat, pivots).astype(np.float32)
        self.score = [np.empty(0, np.int64)] * len(q)
        self.of = [np.empty(0, np.int64)] * len(q)

    def _take(self, j: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[j], score]), np.concatenate([self.of[j], ids])
        best = _best(score, ids, self.k)
        self.score[j], self.of[j] = score[best], ids[best]

    def see(self, ids: np.ndarray, v: np.ndarray, far: np.ndarray) -> int:
        """Take a chunk of candidates; how many scores were computed."""
        done = 0
        for j in range(len(self.q)):
            if not self.exact:
                own = ids != self.ids[j]
                self._take(j, _scores(v[own], self.q[j], False), ids[own])
                done += int(own.sum())
                continue
            # squared distance from below; the score from above
            low = np.abs(far - self.far[j]).max(axis=1).astype(np.float64) if far.shape[1] else \
                np.zeros(len(ids))
            size = self.q2[j] + self.most2
            bound = (size - low * low + SLACK * size) / 2
            bound[ids == self.ids[j]] = -np.inf
            at, step = 0, FIRST
            order = None
            while at < len(ids):
                least = self.score[j][-1] if len(self.score[j]) == self.k else -np.inf
                if order is None:
                    left = np.flatnonzero((bound >= least) & (bound > -np.inf))
                    order = left[np.argsort(-bound[left], kind="stable")]
                part = order[at:at + step]
                if not len(part) or bound[part[0]] < least:
                    break
                self._take(j, _scores(v[part], self.q[j], True), ids[part])
                done += len(part)
                at, step = at + step, step * 4
        return done

    def found(self) -> pa.RecordBatch:
        n = [len(s) for s in self.score]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(n)), n).astype(np.int32)),
             pa.array(np.concatenate([*self.of, np.empty(0, np.int64)])),
             pa.array(np.concatenate([*self.score, np.empty(0, np.int64)]))],
            ["q", "vec_id", "score"])


def _pass(tab: DataFrame, ids: np.ndarray, q: np.ndarray, pivots: np.ndarray, most2: float,
          k: int, exact: bool) -> DataFrame:
    """The k best candidates for each of a block of queries: per task, then over all tasks."""
    spark = tab.sparkSession
    sent = spark.sparkContext.broadcast((ids, q, pivots))
    dims = q.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*sent.value, most2, k, exact)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                v = np.frombuffer(b"".join(part.column("v").to_pylist())).reshape(-1, dims)
                far = np.frombuffer(b"".join(part.column("far").to_pylist()), np.float32)
                search.see(part.column("vec_id").to_numpy(), v, far.reshape(part.num_rows, len(pivots)))
        yield search.found()

    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    best = tab.mapInArrow(run, _FOUND).withColumn("rank", rank).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(zip(range(len(ids)), ids.tolist(), strict=True)),
                                  "q int, query_id bigint")
    out = cut(best.join(F.broadcast(names), "q").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk-found")
    sent.unpersist()
    return out


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id",
          vec_col: str = "embedding", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Each query's ``k`` highest integer inner products: query_id, rank, vec_id, score.

    ``is_query`` is a condition on ``vec_id``. Candidates are all rows but those
    of the query's own id; ties go to the smaller vec_id. Rows without id, without
    vector or with a null or non-finite component take no part. A shorter vector
    counts as ending in zeros (an empty one scores 0 everywhere). A repeated row
    is a candidate, and a query, as often as it stands there. Scores beyond 64
    bits end at the largest or smallest long. Fewer candidates than ``k``
    give fewer rows; no queries or no rows give none. Other columns are ignored.

    The queries pass through the driver and to the tasks in blocks of at most
    ``query_bytes``; each block reads the stored pivot table once.
    """
    rows = usable(vectors, id_col, vec_col)
    zero = F.lit(0.0)
    sums = rows.agg(
        F.max(F.size("v")).alias("dims"),
        F.max(F.aggregate("v", zero, lambda a, c: a + c * c)).alias("most2"),
        F.max(F.aggregate("v", zero, lambda a, c: F.greatest(a, F.abs(c)))).alias("most")).first()
    if sums["dims"] is None:
        return vectors.sparkSession.createDataFrame([], _RESULT)
    dims, most2 = max(sums["dims"], 1), sums["most2"]
    exact = dims * sums["most"] ** 2 < EXACT
    per_pass = max(1, query_bytes // (8 * (dims + 1)))
    pivots = np.zeros((0, dims + 1))
    if exact:
        sample = (rows.orderBy(F.xxhash64("vec_id"), "vec_id")
                  .limit(min(PIVOT_ROWS, per_pass)).select("v").collect())
        pivots = farthest(lifted(_padded([r["v"] for r in sample], dims), most2), PIVOTS)
    tab = pivot_table(rows, dims, most2 if exact else 0.0, pivots)

    queries = tab.where(is_query).select("vec_id", "v")
    passes = max(1, -(-queries.count() // per_pass))
    # dealt out evenly, whatever their ids: each block has about per_pass queries
    queries = cut(queries.repartition(passes).withColumn("block", F.spark_partition_id()),
                  "topk-queries")
    out = vectors.sparkSession.createDataFrame([], _RESULT)
    for p in range(passes):
        block = queries.where(F.col("block") == p).toArrow().combine_chunks()
        if block.num_rows:
            ids = block.column("vec_id").to_numpy()
            q = np.frombuffer(b"".join(block.column("v").to_pylist())).reshape(-1, dims)
            out = out.unionByName(_pass(tab, ids, q, pivots, most2, k, exact))
    return out


def op13_exact_topk(spark, sf_dir: str) -> DataFrame:
    """The 10 best scores of every embedding whose id is divisible by 100; odd input as in :func:`top_k`."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

QUERIES = {"op13_exact_topk": op13_exact_topk}
ORACLES = {"op13_exact_topk": ORACLE}
