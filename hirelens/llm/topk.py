"""Exact top-k inner products with block-at-a-time pruning.

Vectors are documents, their dimensions are terms, with integer weights. The
vectors are ordered so that similar ones lie together (nearest of a few
centroids) and cut into ranges: shards, and in them blocks. A block keeps the
largest and smallest weight of each term and its vectors (the forward index).
For each query, a block's summed term maxima bound its scores; the blocks are
scored in order of their bounds until a bound falls below the k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import table, written

SCALE = 64
EVERY = 20          # queries: rows whose id is divisible by this
K = 20
SHARD = 2048        # vectors of a shard
BLOCK = 32          # vectors of a block
WAVE = 4            # blocks of a query scored before its k-th score is renewed
CENTROIDS = 64      # only order the vectors; results don't depend on them
SAMPLE = 4096       # rows that the centroids are fitted on
_SHARDS = "shard long, dims int, ids binary, weights binary"
_SHARDS_ARROW = pa.schema([("shard", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("weights", pa.binary())])
_QUERIES = _SHARDS + ", places binary, floors binary"
_QUERIES_ARROW = pa.schema([*_SHARDS_ARROW, ("places", pa.binary()), ("floors", pa.binary())])
_FOUND = "query_shard long, place long, query_id long, vec_id long, score long"


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, weights``: floor(scale * x) of every usable vector."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & ~bad)
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.transform(x, lambda v: F.floor(scale * v.cast("double"))).alias("weights")))


def _matrix(rows: list, dims: int) -> np.ndarray:
    """Weights as a matrix; shorter vectors are filled with zeros."""
    out = np.zeros((len(rows), dims), np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def fit_centroids(rows: DataFrame) -> np.ndarray:
    """A few rounds of k-means on a bounded sample (lowest hashes of the id)."""
    sample = [r["weights"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    points = _matrix(sample, max(map(len, sample), default=0)).astype(np.float64)
    points = np.unique(points, axis=0) if len(points) else points
    centres = points[np.linspace(0, len(points) - 1, min(CENTROIDS, len(points))).astype(int)] if len(points) else points
    for _ in range(8):
        if not len(centres):
            break
        near = _nearest(points, centres)
        centres = np.stack([points[near == c].mean(axis=0) if (near == c).any() else centres[c]
                            for c in range(len(centres))])
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)


def _narrow(weights: np.ndarray) -> np.ndarray:
    return weights.astype(np.int32) if abs(weights).max(initial=0) < 1 << 31 else weights


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted partition's rows as shards."""
    part, held, ids, n = TaskContext.get().partitionId(), [], [], 0

    def shard():
        dims = max(1, max(map(len, held)))
        return pa.RecordBatch.from_pylist([{"shard": part << 32 | n, "dims": dims, "ids": np.array(ids, "<i8").tobytes(),
                                            "weights": _narrow(_matrix(held, dims)).tobytes()}], _SHARDS_ARROW)

    for batch in batches:
        for vec_id, weights in zip(batch["vec_id"].to_pylist(), batch["weights"]):
            held.append(weights.values.to_numpy())
            ids.append(vec_id)
            if len(held) == SHARD:
                yield shard()
                held, ids, n = [], [], n + 1
    if held:
        yield shard()


def _weights(data: bytes, n: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, np.dtype(f"<i{len(data) // max(1, n * dims)}")).reshape(n, dims)


class Shard:
    """A shard's blocks, ready to be searched."""

    def __init__(self, number: int, dims: int, ids: bytes, weights: bytes):
        self.number, self.ids = number, np.frombuffer(ids, "<i8")
        n = len(self.ids)
        flat = _weights(weights, n, dims)
        self.blocks = -(-n // BLOCK)
        full = np.zeros((self.blocks * BLOCK, dims), flat.dtype)
        full[:n] = flat
        full[n:] = flat[-1]                              # padding never widens a bound
        self.forward = full.reshape(self.blocks, BLOCK, dims)
        self.largest, self.smallest = self.forward.max(axis=1), self.forward.min(axis=1)
        self.names = np.r_[self.ids, np.full(len(full) - n, -1)].reshape(self.blocks, BLOCK)
        self.real = (np.arange(len(full)) < n).reshape(self.blocks, BLOCK)
        self.peak = int(abs(flat.astype(np.int64)).max(initial=0))

    def search(self, queries: np.ndarray, floors: np.ndarray, places: np.ndarray | None, k: int):
        """(scores, ids), each ``queries x k``, best first; unused places hold
        the lowest integer. ``floors``: known lower bounds of the k-th scores.
        ``places``: where the queries themselves lie in this shard, if here."""
        lowest = np.iinfo(np.int64).min
        dims = min(queries.shape[1], self.forward.shape[2])
        q = queries[:, :dims]
        reach = dims * self.peak * int(abs(q.astype(np.int64)).max(initial=0))
        kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
        q, forward = q.astype(kind), self.forward[:, :, :dims].astype(kind)
        bounds = (np.maximum(q, 0) @ self.largest[:, :dims].astype(kind).T
                  + np.minimum(q, 0) @ self.smallest[:, :dims].astype(kind).T)
        order = np.argsort(-bounds, axis=1, kind="stable")
        scores = np.full((len(q), k), lowest)
        ids = np.full((len(q), k), np.iinfo(np.int64).max)
        least, alive = floors.copy(), np.arange(len(q))
        for at in range(0, self.blocks, WAVE):
            alive = alive[bounds[alive, order[alive, at]] >= least[alive]]
            if not len(alive):
                break
            picked = order[alive, at:at + WAVE]
            new = np.matmul(forward[picked], q[alive][:, None, :, None])[..., 0].astype(np.int64)
            use = self.real[picked]
            if places is not None:
                use &= (picked[:, :, None] * BLOCK + np.arange(BLOCK)) != places[alive][:, None, None]
            new = np.where(use, new, lowest).reshape(len(alive), -1)
            both = np.concatenate([scores[alive], new], axis=1)
            names = np.concatenate([ids[alive], self.names[picked].reshape(len(alive), -1)], axis=1)
            best = np.lexsort((names, -np.maximum(both, lowest + 1)), axis=1)[:, :k]
            scores[alive], ids[alive] = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
            least[alive] = np.maximum(floors[alive], scores[alive, k - 1])
        return scores, ids


def _queries(batches: Iterator[pa.RecordBatch], every: int, k: int) -> Iterator[pa.RecordBatch]:
    """A shard's queries, with the k-th score that the shard itself gives."""
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["shard"], row["dims"], row["ids"], row["weights"])
            places = np.flatnonzero(shard.ids % every == 0)
            if len(places):
                q = _weights(row["weights"], len(shard.ids), row["dims"])[places]
                floors = np.full(len(places), np.iinfo(np.int64).min)
                scores, _ = shard.search(q, floors, places, k)
                yield pa.RecordBatch.from_pylist([{
                    **row, "ids": shard.ids[places].tobytes(), "weights": q.tobytes(),
                    "places": places.astype("<i8").tobytes(), "floors": scores[:, k - 1].tobytes()}], _QUERIES_ARROW)


def _score(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, each shard followed by the query blocks for it."""
    shard = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["places"] is None:
                shard = Shard(row["shard"], row["dims"], row["ids"], row["weights"])
                continue
            names, places, floors = (np.frombuffer(row[c], "<i8") for c in ("ids", "places", "floors"))
            q = _weights(row["weights"], len(names), row["dims"])
            scores, ids = shard.search(q, floors, places if row["shard"] == shard.number else None, k)
            i, j = np.nonzero((scores >= floors[:, None]) & (scores > np.iinfo(np.int64).min))
            yield pa.record_batch({"query_shard": np.full(len(i), row["shard"]), "place": places[i],
                                   "query_id": names[i], "vec_id": ids[i, j], "score": scores[i, j]})


def top_k(vectors: DataFrame, every: int = EVERY, k: int = K, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose vec_id is
    divisible by ``every``, the ``k`` other rows of largest integer inner
    product (all, if fewer; ties to the smaller vec_id).

    Rows with a null vec_id, a null vector, or null, NaN or infinite
    components take no part; a shorter vector counts as filled with zeros.
    Rows that repeat a vec_id are rows of their own: each is a candidate for
    the others and, if a query, gets its own ``k`` results. Products must fit
    64 bits. Other columns are ignored; an empty table gives no row.

    Query blocks meet every shard in turn (a stated query set against all
    rows): a shard is read once, its query blocks stream past it, so memory is
    one shard and one block. Each query brings the k-th score of its own
    shard, so other shards return little beyond the final results.
    """
    rows = usable(vectors, scale)
    centres = fit_centroids(rows)

    @F.arrow_udf(T.IntegerType())
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            points = _matrix([w.values.to_numpy()[:centres.shape[1]] for w in batch], centres.shape[1])
            yield pa.array(_nearest(points.astype(np.float64), centres).astype(np.int32))

    group = nearest(F.col("weights")) if len(centres) else F.lit(0)
    shards = written(rows.withColumn("near", group).repartitionByRange("near", "vec_id")
                     .sortWithinPartitions("near", "vec_id").select("vec_id", "weights")
                     .mapInArrow(_build, _SHARDS), "vector-shards")
    asked = shards.mapInArrow(lambda it: _queries(it, every, k), _QUERIES)
    # Shard numbers from 0 on (a row per shard), so that queries can name them all.
    numbers = shards.select("shard", (F.row_number().over(Window.orderBy("shard")) - 1).cast("long").alias("goes"))
    many = shards.count()
    here = (shards.join(numbers, "shard").withColumn("places", F.lit(None).cast("binary"))
            .withColumn("floors", F.lit(None).cast("binary")).withColumn("turn", F.lit(0)))
    there = (asked.withColumn("goes", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))))
             .withColumn("turn", F.lit(1))) if many else here.limit(0)
    columns = ["goes", "turn", "shard", "dims", "ids", "weights", "places", "floors"]
    found = (here.select(columns).union(there.select(columns)).repartition("goes")
             .sortWithinPartitions("goes", "turn").mapInArrow(lambda it: _score(it, k), _FOUND))
    best = Window.partitionBy("query_shard", "place", "query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
