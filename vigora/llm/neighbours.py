"""Nearest neighbours by collision-counting hashing.

Each vector is projected on ``PROJECTIONS`` random lines; a block of vectors
keeps one sorted array for each line, built once and kept. A query looks at a
window around its own projection on every line; virtual rehashing widens all
windows with the radius that is searched. A vector within the radius is in a
window with a known chance, so those that are in so many windows as a vector at
the very radius would miss with a chance of ``MISS`` are verified by exact inner
products in double precision. The radius grows until ``k`` verified vectors lie
within it.

Largest inner products are brought to smallest distances by one more component
that gives all vectors of the table the same length.

Vectors are dealt to blocks by a hash, queries go to the blocks in broadcasts of
at most ``QUERY_BYTES``. The first blocks, a share of ``FIRST``, are searched as
said; the k-th best product there then bounds the radius in all others, which is
the smaller the more vectors there are, and the others return only what is
better. So the share of vectors that is verified falls as the table grows.

Defined results: null ids take no part, nor do vectors that are null, empty,
zero or have null or non-finite components; the rows of a repeated id are one
vector to find (that with the larger product), and as a query the least of its
vectors in order; vectors of another length than the query's are no candidates;
ties go to the smaller id; fewer candidates than asked for are all returned; an
empty table gives no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigora.llm.common import checkpointed, table

K, PROJECTIONS, SEED = 20, 96, 9
#: Half a window's width in radii, the growth of the radius, and the chance that a vector at the very radius is not verified.
WIDTH, GROWTH, MISS = 2.0, 1.08, 0.3
#: Vectors in a block; the share of blocks that is searched first; bytes of query vectors in one broadcast.
BLOCK, FIRST, QUERY_BYTES = 16_384, 8, 32_000_000
#: Lines on which a vector may lie outside the window and still be verified.
_INSIDE = 2 * NormalDist().cdf(WIDTH) - 1
ALLOWED = PROJECTIONS - math.floor(PROJECTIONS * _INSIDE + NormalDist().inv_cdf(MISS) * math.sqrt(PROJECTIONS * _INSIDE * (1 - _INSIDE)))


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """id, v: the distinct rows that take part."""
    v = F.col(vector).cast("array<double>")
    ok = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()


class Block:
    """Sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, order: np.ndarray | None = None):
        """longest: the largest square length of all vectors; order: the places on each line, if they are known."""
        self.ids, self.vectors, self.longest = ids, vectors, max(longest, 1e-300)
        n, d = vectors.shape
        self.lines = np.random.default_rng(SEED).standard_normal((d + 1, PROJECTIONS))
        rest = np.sqrt(np.maximum(0.0, longest - np.einsum("ij,ij->i", vectors, vectors)))
        shadows = (np.column_stack([vectors, rest]) @ self.lines).T
        self.order = np.argsort(shadows, axis=1, kind="stable") if order is None else order.astype(np.intp)
        self.sorted = np.take_along_axis(shadows, self.order, axis=1)
        self.verified = 0

    def windows(self, at: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the queries' windows on all lines (queries x lines); at: the queries' projections."""
        half = WIDTH * radius
        return tuple(np.stack([np.searchsorted(s, x + sign * half, side) for s, x in zip(self.sorted, at.T)], axis=1) for sign, side in ((-1, "left"), (1, "right")))

    def misses(self, low, high) -> np.ndarray:
        """For each vector, the lines on which it lies outside one query's windows."""
        outside = [o[:a] for o, a in zip(self.order, low)] + [o[b:] for o, b in zip(self.order, high)]
        return np.bincount(np.concatenate(outside), minlength=len(self.ids))

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray | None = None):
        """For each query, ids and exact products of the k best that were found, best first, ties to the smaller id.

        bounds: products that are reached elsewhere by k vectors, -inf if not known; only what is as good is returned.
        """
        length = np.linalg.norm(queries, axis=1)
        scale = math.sqrt(self.longest) / length
        at = (queries * scale[:, None]) @ self.lines[:-1]
        bounds = np.full(len(queries), -np.inf) if bounds is None else bounds
        distance = lambda s, q: np.sqrt(np.maximum(0.0, 2 * self.longest - 2 * scale[q] * s))
        # The radius to begin with: the k-th best elsewhere, else the nearest of the vectors next to the query on the lines.
        radius = np.array([distance(b, q) if b > -np.inf else 0.0 for q, b in enumerate(bounds)])
        open_ = np.flatnonzero(bounds == -np.inf)
        if len(open_):
            beside = np.stack([o[np.clip(np.searchsorted(s, x), 0, len(o) - 1)] for o, s, x in zip(self.order, self.sorted, at[open_].T)], axis=1)
            for q, places in zip(open_, beside):
                places = places[self.ids[places] != query_ids[q]]
                near = distance((self.vectors[places] @ queries[q]).max(), q) if len(places) else 0.0
                radius[q] = max(near, 1e-3 * math.sqrt(self.longest))
        low, high = self.windows(at, radius)
        for q, query in enumerate(queries):
            lo, hi, r = low[q].tolist(), high[q].tolist(), radius[q]
            while True:
                places = np.flatnonzero(self.misses(lo, hi) <= ALLOWED)
                self.verified += len(places)
                places = places[self.ids[places] != query_ids[q]]
                score = self.vectors[places] @ query
                if bounds[q] > -np.inf:
                    places, score = places[score >= bounds[q]], score[score >= bounds[q]]
                    break
                if not any(lo) and min(hi) == len(self.ids) or np.count_nonzero(distance(score, q) <= r) >= k and len(np.unique(self.ids[places[distance(score, q) <= r]])) >= k:
                    break
                # Virtual rehashing: all windows wider, the more so if little was found.
                r *= GROWTH if len(places) >= k // 2 else GROWTH**3
                a, b = self.windows(at[q : q + 1], np.array([r]))
                lo, hi = a[0].tolist(), b[0].tolist()
            best = np.lexsort((self.ids[places], -score))
            found, first = np.unique(self.ids[places[best]], return_index=True)
            best = best[np.sort(first)][:k]
            yield self.ids[places[best]], score[best]


INDEX = "d int, block int, ids binary, vectors binary, places binary"
OUT = "query_id long, vec_id long, score double"


def _matrix(column) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def index(base: DataFrame, n: int, longest: float) -> DataFrame:
    """The blocks with their sorted arrays, a row each, written to the shared folder; base: id, v."""
    blocks = max(1, math.ceil(n / BLOCK))
    dealt = base.select("id", "v", F.size("v").alias("d"), F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"))

    def build(key, t):
        ids = t.column("id").to_numpy().astype(np.int64)
        keep = np.argsort(ids, kind="stable")
        made = Block(ids[keep], _matrix(t.column("v"))[keep], longest)
        kind = np.uint16 if len(ids) <= 1 << 16 else np.int64
        return pa.table({"d": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "ids": pa.array([made.ids.tobytes()], pa.binary()), "vectors": pa.array([made.vectors.tobytes()], pa.binary()), "places": pa.array([made.order.astype(kind).tobytes()], pa.binary())})

    return checkpointed(dealt.repartition(blocks, "block").groupBy("d", "block").applyInArrow(build, INDEX))


def _meet(blocks: DataFrame, queries, longest: float, k: int) -> DataFrame:
    """What one broadcast of queries, (ids, vectors, bounds) by length, finds in the blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(queries)

    def run(batches):
        for batch in batches:
            for d, ids, vectors, places in zip(*(batch.column(batch.schema.get_field_index(x)) for x in ("d", "ids", "vectors", "places"))):
                if (asked := shared.value.get(d.as_py())) is None:
                    continue
                ids = np.frombuffer(ids.as_py(), np.int64)
                kind = np.uint16 if len(ids) <= 1 << 16 else np.int64
                block = Block(ids, np.frombuffer(vectors.as_py(), np.float64).reshape(len(ids), -1), longest, np.frombuffer(places.as_py(), kind).reshape(PROJECTIONS, -1))
                for at in range(0, len(asked[0]), 1024):
                    part = [x[at : at + 1024] for x in asked]
                    found = list(block.nearest(part[0], part[1], k, part[2]))
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(np.repeat(part[0], [len(x) for x, _ in found])),
                        "vec_id": pa.array(np.concatenate([x for x, _ in found])), "score": pa.array(np.concatenate([s for _, s in found])),
                    })

    return blocks.select("d", "ids", "vectors", "places").mapInArrow(run, OUT)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(base: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """base, queries: id, v (array<double>) -> query_id, rank, vec_id, score."""
    n, longest, dims = base.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), F.max(F.size("v"))).first()
    spark, longest = base.sparkSession, float(longest or 0.0)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = index(base, n, longest)
    asked = checkpointed(queries.groupBy("id").agg(F.min("v").alias("v")))
    groups = max(1, math.ceil(asked.count() * 8 * dims / QUERY_BYTES))
    first = F.pmod("block", F.lit(FIRST)) == 0
    out = None
    for g in range(groups):
        rows = asked.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == g).withColumn("d", F.size("v")).toArrow()
        by_length = {}
        for d in set(rows.column("d").to_pylist()):
            own = rows.filter(pa.compute.equal(rows.column("d"), d))
            by_length[d] = own.column("id").to_numpy().astype(np.int64), _matrix(own.column("v")), np.full(own.num_rows, -np.inf)
        found = checkpointed(_ranked(_meet(blocks.where(first), by_length, longest, k), k))
        # The k-th best of each query so far: a number a query.
        known = found.where(F.col("rank") == k).select("query_id", "score").toArrow()
        bound = dict(zip(known.column("query_id").to_pylist(), known.column("score").to_pylist()))
        later = {d: (ids, v, np.array([bound.get(i, -np.inf) for i in ids.tolist()])) for d, (ids, v, _) in by_length.items()}
        both = found.drop("rank").unionByName(_meet(blocks.where(~first), later, longest, k))
        made = _ranked(both, k) if groups == 1 else checkpointed(_ranked(both, k))
        out = made if out is None else out.unionByName(made)
    return out


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return search(base, base.where(F.col("id") % 20 == 0))
