"""Exact k nearest by inner product, with a pivot table that eliminates candidates.

Vectors are turned into whole numbers, so scores are exact. For every vector its distances to many
pivots are computed once. By the triangle inequality the largest difference of two vectors' distances
to a pivot is a lower bound of their distance, and with the lengths an upper bound of their inner
product: q.x = (|q|^2 + |x|^2 - d^2) / 2. A query evaluates candidates in the order of that bound and
stops as soon as the next bound lies below its k-th score, so the result is exact.

The stated queries meet all rows in blocks: a task gets one block of candidates and one of queries, both
of bounded size, and gives k rows for each query; the blocks' results are ranked together.

Defined results: vectors that are null, or hold a null or a non-finite component, and rows without a
key take no part; shorter vectors are filled with zeros; a row repeated with one key is a candidate once
for each row, except for the query with that key; a repeated query is answered once, for the
first of its vectors; scores beyond a long are held at its limits; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import to_arrow
from matchloom.session import store

SCALE = 1024
PIVOTS = 48
#: Vectors from which pivots are chosen.
SAMPLE = 1024
CANDIDATES_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 1024
EVALUATED_AT_ONCE = 256
FOUND = "query_id long, vec_id long, score long"


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, part, number): usable vectors as doubles that hold whole numbers, in bytes."""
    schema = "vec_id long, v binary, part int, number long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, out = [], []
            for key, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key is None or v is None or None in v:
                    continue
                x = np.floor(np.asarray(v, dtype="f8") * scale)
                if np.isfinite(x).all():
                    ids.append(key)
                    out.append(x.tobytes())
            numbers = np.arange(number, number + len(ids))
            number += len(ids)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(np.full(len(ids), part, "int32")), pa.array(numbers)], schema=to_arrow(schema))

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).mapInArrow(run, schema)


def matrix(rows: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        x = np.frombuffer(row, "f8")
        out[i, : len(x)] = x
    return out


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Vectors of the sample far from each other, each the farthest from those before it."""
    if not len(sample):
        return sample
    scaled = sample / max(1.0, np.abs(sample).max())
    chosen, far = [0], None
    while len(chosen) < min(n, len(sample)):
        d = ((scaled - scaled[chosen[-1]]) ** 2).sum(axis=1)
        far = d if far is None else np.minimum(far, d)
        if far.max() == 0:
            break
        chosen.append(int(far.argmax()))
    return sample[chosen]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots], axis=1) if len(pivots) else np.zeros((len(x), 0))


def exact_products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, held at the limits of a long."""
    if rows.size and np.abs(rows).max() * max(1.0, np.abs(q).max()) * len(q) < 2**53:
        return (rows @ q).astype("int64")
    low, high = np.iinfo("int64").min, np.iinfo("int64").max
    query = [int(v) for v in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(r, query, strict=True)), low), high) for r in rows.tolist()], dtype="int64")


def search_block(q_id: np.ndarray, q: np.ndarray, q_dist: np.ndarray, ids: np.ndarray, x: np.ndarray, x_dist: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """For each query its id, the best ids and scores of the block, and how many were evaluated."""
    with np.errstate(over="ignore"):
        x_len, q_len = (x**2).sum(axis=1), (q**2).sum(axis=1)
    for i in range(len(q)):
        with np.errstate(over="ignore", invalid="ignore"):
            lower = np.abs(x_dist - q_dist[i]).max(axis=1) if x_dist.shape[1] else np.zeros(len(x))
            # The margin covers the rounding of distances and lengths.
            bound = (x_len + q_len[i] - lower**2) / 2 + 1e-9 * (x_len + q_len[i]) + 1
        bound[~np.isfinite(bound)] = np.inf  # too large for doubles: no candidate is spared
        bound[ids == q_id[i]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > -np.inf]
        best_id, best = np.zeros(0, "int64"), np.zeros(0, "int64")
        seen = 0
        while seen < len(order) and (len(best) < k or bound[order[seen]] >= best[-1]):
            some = order[seen : seen + EVALUATED_AT_ONCE]
            best_id, best = np.append(best_id, ids[some]), np.append(best, exact_products(x[some], q[i]))
            top = np.lexsort((best_id, -best))[:k]
            best_id, best = best_id[top], best[top]
            seen += len(some)
        yield int(q_id[i]), best_id, best, seen


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query, ties to the smaller key.

    `is_query` is a condition on vec_id.
    """
    known = store(whole(vectors, scale), "vectors")
    n, width = known.agg(F.count("*"), F.max(F.length("v"))).first()
    width = (width or 0) // 8
    sample = known.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()
    chosen = choose_pivots(matrix([bytes(r["v"]) for r in sample], width), pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pivot_distances(matrix(batch["v"].to_pylist(), width), chosen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in found], pa.binary())], names=[*batch.schema.names, "d"])

    table = store(known.mapInArrow(measure, "vec_id long, v binary, part int, number long, d binary"), "pivot-table")
    asked = table.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("v", "d")).alias("s")).select("vec_id", "s.v", "s.d")
    groups = -(-n // CANDIDATES_PER_BLOCK) or 1
    blocks = -(-asked.count() // QUERIES_PER_BLOCK) or 1
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = asked.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("g", each(groups))
    right = table.withColumn("g", F.pmod(F.xxhash64("part", "number"), F.lit(groups)).cast("int")).select("vec_id", "v", "d", "g").withColumn("b", each(blocks))
    schema = to_arrow(FOUND)

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        read = lambda t: (t["vec_id"].to_numpy(), matrix(t["v"].to_pylist(), width), matrix(t["d"].to_pylist(), len(chosen)))
        out = ([], [], [])
        if queries.num_rows and rows.num_rows:
            for q_id, ids, scores, _ in search_block(*read(queries), *read(rows), k):
                out[0].append(np.full(len(ids), q_id))
                out[1].append(ids)
                out[2].append(scores)
        return pa.table([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], schema=schema)

    found = left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(search, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
