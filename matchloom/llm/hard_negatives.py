"""Hard negatives: rows of another label that score close below an anchor's positives.

Vectors are turned into whole numbers, so that scores are exact. The anchors of a block form a spanning
tree of least edges. For a candidate x the scores at an anchor c and at its parent p differ by at most
|c - p| |x|, so what is known at the parent, a score or two bounds, bounds the score at the child; so does
|c| |x|. Walking the tree, an anchor scores only candidates whose bounds overlap what it still asks for:
its best positives so far, or the windows below them, in the order of their upper bounds.

All anchors meet all candidates in blocks: a task gets one block of each, both of bounded size, and gives
the best rows of each anchor; the blocks' results are ranked together. Anchors near the same one of a
few sampled anchors share a block, which keeps edges short; the sample decides the cost, never the result.

Defined results: vectors that are null or hold a null or a non-finite component, rows without a label and
rows without a key take no part; shorter vectors are filled with zeros; components that are too large for
a double when scaled are held at its limits, scores at those of a long; a row repeated with one key is a
candidate, and a positive, once for each row, except for the anchor with that key; a repeated anchor is
answered once, for the first of its vectors; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import to_arrow
from matchloom.llm.topk import exact_products, matrix
from matchloom.session import store

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score between which a negative's lies, both included.
WINDOW = (30, 90)
ANCHORS_PER_BLOCK = 1024
CANDIDATES_PER_BLOCK, BLOCK_BYTES = 8192, 1 << 25
#: Sampled anchors by which anchors are dealt to blocks, at most.
CENTRES = 1024
SCORED_AT_ONCE = 512


class Block(NamedTuple):
    """Rows of the table: keys, labels and vectors."""

    key: np.ndarray
    label: np.ndarray
    x: np.ndarray


def whole(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, v, part, number): usable rows, the vectors as doubles that hold whole numbers."""
    schema = "vec_id long, label long, v binary, part int, number long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, most = TaskContext.get().partitionId(), 0, np.finfo("f8").max
        for batch in batches:
            rows = []
            for key, label, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if None in (key, label) or v is None or None in v:
                    continue
                x = np.asarray(v, dtype="f8")
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        rows.append((key, label, np.clip(np.floor(x * scale), -most, most).tobytes(), part, number))
                    number += 1
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, to_arrow(schema), strict=True)], schema=to_arrow(schema))

    plain = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    return plain.mapInArrow(run, schema)


def length(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, infinite where a double can't hold them."""
    with np.errstate(over="ignore"):
        return np.sqrt((x**2).sum(axis=-1))


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge) of the rows in a tree of least edges; the first row is its root."""
    n = len(x)
    parent, edge = np.zeros(n, "i8"), np.full(n, np.inf)
    left = np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        left[at] = False
        with np.errstate(over="ignore", invalid="ignore"):
            d = np.nan_to_num(length(x - x[at]), nan=np.inf)
        nearer = left & (d < edge)
        parent[nearer], edge[nearer] = at, d[nearer]
        open_ = np.flatnonzero(left)
        at = int(open_[edge[open_].argmin()])
    return parent, edge


class Bounds:
    """What is known of the scores of a block's rows at one anchor."""

    def __init__(self, rows: Block, c: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.rows, self.c, self.low, self.high = rows, c, low, high
        self.score = np.zeros(len(low), "i8")
        self.known = np.zeros(len(low), bool)

    def rescore(self, some: np.ndarray) -> None:
        """Score these rows exactly, unless that has been done."""
        some = some[~self.known[some]]
        if len(some):
            self.score[some] = exact_products(self.rows.x[some], self.c)
            self.known[some] = True
            self.low[some] = self.high[some] = self.score[some]

    def best(self, asked: np.ndarray, k: int, fits: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The k best of the asked rows whose score fits, by score, then key."""
        asked = asked[np.argsort(-self.high[asked], kind="stable")]
        bound = self.high[asked]
        found = np.zeros(0, "i8")
        at = 0
        while at < len(asked) and (len(found) < k or bound[at] >= self.score[found[-1]]):
            some = asked[at : at + SCORED_AT_ONCE]
            self.rescore(some)
            found = np.append(found, some[fits(self.score[some])])
            found = found[np.lexsort((self.rows.key[found], -self.score[found]))][:k]
            at += len(some)
        return found


def walk(anchors: np.ndarray, rows: Block, visit: Callable[[int, Bounds], None]) -> int:
    """Visit the anchors from the root of their tree; returns how many scores were computed."""
    parent, edge = spanning_tree(anchors)
    below: list[list[int]] = [[] for _ in anchors]
    for i in range(1, len(anchors)):
        below[parent[i]].append(i)
    size, own = length(rows.x), length(anchors)
    scored = 0
    open_: list[tuple[int, np.ndarray, np.ndarray]] = [(0, np.full(len(size), -np.inf), np.full(len(size), np.inf))]
    while open_:
        i, low, high = open_.pop()
        with np.errstate(over="ignore", invalid="ignore"):
            far = np.nan_to_num(edge[i] * size, nan=np.inf) if i else np.inf
            at_most = np.nan_to_num(own[i] * size, nan=np.inf)
            # The margin covers the rounding of lengths.
            at_most = at_most * (1 + 1e-9) + 1
            low = np.nan_to_num(low - far, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            high = np.nan_to_num(high + far, nan=np.inf, posinf=np.inf, neginf=-np.inf)
            slack = 1e-9 * (np.abs(low) + np.abs(high)) + 1
            slack[~np.isfinite(slack)] = 0
            here = Bounds(rows, anchors[i], np.maximum(low - slack, -at_most), np.minimum(high + slack, at_most))
        visit(i, here)
        scored += int(here.known.sum())
        open_.extend((j, here.low, here.high) for j in below[i])
    return scored


def inside(score: np.ndarray, positive: int, window: tuple[int, int]) -> np.ndarray:
    """Which scores lie in the window of a positive's score."""
    if len(score) and max(abs(int(score.max())), abs(int(score.min())), abs(positive)) > 2**56:
        score = score.astype(object)
    return ((100 * score >= window[0] * positive) & (100 * score <= window[1] * positive)).astype(bool)


def positives_in(anchors: Block, rows: Block, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor_id, positive_id, score) of the best rows of each anchor's label in a block."""
    found = []

    def visit(i: int, here: Bounds) -> None:
        best = here.best(np.flatnonzero((rows.label == anchors.label[i]) & (rows.key != anchors.key[i])), k, lambda s: np.ones(len(s), bool))
        found.append((np.full(len(best), anchors.key[i]), rows.key[best], here.score[best]))

    walk(anchors.x, rows, visit)
    return iter(found)


def negatives_in(anchors: Block, asked: list[list[tuple[int, int, int]]], rows: Block, k: int, window: tuple[int, int]) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor_id, place, positive_id, positive_score, negative_id, score) of the best rows in the windows
    below the anchors' positives (place, key, score)."""
    found = []

    def visit(i: int, here: Bounds) -> None:
        other = rows.label != anchors.label[i]
        for place, key, score in asked[i]:
            # A margin for windows beyond the whole numbers of a double.
            slack = 1 + 1e-9 * abs(score)
            overlap = other & (here.high >= window[0] * score / 100 - slack) & (here.low <= window[1] * score / 100 + slack)
            best = here.best(np.flatnonzero(overlap), k, lambda s, p=score: inside(s, p, window))
            n = len(best)
            found.append((np.full(n, anchors.key[i]), np.full(n, place), np.full(n, key), np.full(n, score), rows.key[best], here.score[best]))

    walk(anchors.x, rows, visit)
    return iter(found)


def with_block(anchors: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The anchors with the block of each, and the number of blocks."""
    n = anchors.count()
    wanted = min(CENTRES, -(-n // ANCHORS_PER_BLOCK)) or 1
    sample = anchors.orderBy(F.xxhash64("v"), "vec_id").limit(wanted).select("v").collect()
    centres = matrix([bytes(r["v"]) for r in sample], width)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch["v"].to_pylist(), width)
            best, least = np.zeros(len(x), "i4"), np.full(len(x), np.inf)
            for i, c in enumerate(centres):
                with np.errstate(over="ignore", invalid="ignore"):
                    d = length(x - c)
                best[d < least], least = i, np.fmin(d, least)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.int32())], names=[*batch.schema.names, "centre"])

    placed = store(anchors.select("vec_id", "label", "v").mapInArrow(nearest, "vec_id long, label long, v binary, centre int"), "anchors")
    counts = placed.groupBy("centre").count().orderBy("centre").collect()  # at most CENTRES rows
    first, plan = 0, []
    for r in counts:
        parts = -(-r["count"] // ANCHORS_PER_BLOCK)
        plan.append((r["centre"], first, parts))
        first += parts
    if not plan:
        return placed.withColumn("b", F.lit(0)), 1
    spark = anchors.sparkSession
    known = spark.createDataFrame(plan, "centre int, first int, parts int")
    block = F.col("first") + F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("parts")).cast("int")
    return placed.join(F.broadcast(known), "centre").withColumn("b", block), first


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `vectors` has vec_id, label and embedding; `is_anchor` is a condition on vec_id. An anchor's positives
    are the best rows of its label; for each of them the best rows of other labels in its window follow.
    """
    table = store(whole(vectors, scale), "labelled")
    n, widest = table.agg(F.count("*"), F.max(F.length("v"))).first()
    width = (widest or 0) // 8
    asked = table.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("s")).select("vec_id", "s.label", "s.v")
    anchors, blocks = with_block(asked, width)
    groups = -(-n // max(1, min(CANDIDATES_PER_BLOCK, BLOCK_BYTES // (8 * max(1, width))))) or 1
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    group = F.pmod(F.xxhash64("part", "number"), F.lit(groups)).cast("int")
    right = table.withColumn("g", group).select("vec_id", "label", "v", "g").withColumn("b", each(blocks)).groupBy("g", "b")

    def meet(left: DataFrame, schema: str, work: Callable[[pa.Table, Block, Block], Iterator[tuple[np.ndarray, ...]]]) -> DataFrame:
        read = lambda t: Block(t["vec_id"].to_numpy(), t["label"].to_numpy(), matrix(t["v"].to_pylist(), width))
        target = to_arrow(schema)

        def run(some: pa.Table, rows: pa.Table) -> pa.Table:
            parts = list(work(some, read(some), read(rows))) if some.num_rows and rows.num_rows else []
            columns = list(zip(*parts, strict=True)) or [()] * len(target)
            return pa.table([pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(columns, target, strict=True)], schema=target)

        return left.withColumn("g", each(groups)).groupBy("g", "b").cogroup(right).applyInArrow(run, schema)

    found = meet(anchors, "anchor_id long, positive_id long, score long", lambda t, a, rows: positives_in(a, rows, positives))
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id"))
    chosen = store(found.withColumn("place", place).filter(F.col("place") <= positives), "positives")
    listed = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("asked"))

    def search(t: pa.Table, a: Block, rows: Block) -> Iterator[tuple[np.ndarray, ...]]:
        wanted = [[(p["place"], p["positive_id"], p["score"]) for p in list_] for list_ in t["asked"].to_pylist()]
        return negatives_in(a, wanted, rows, negatives, window)

    schema = "anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    near = meet(anchors.join(listed, "vec_id"), schema, search)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = near.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
