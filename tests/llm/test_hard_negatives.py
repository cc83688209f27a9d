"""Hard negatives beside plain scoring of all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.llm import hard_negatives

MOST = np.finfo("f8").max
VECTORS = "vec_id long, embedding array<double>, label int, score long, v string, b int, g int, part int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, label, 1, "x", 2, 3, 4) for k, v, label in rows], VECTORS)


def plain(rows, every, positives=5, negatives=10, scale=256):
    low, high = -(2**63), 2**63 - 1
    usable = [(k, [int(np.clip(np.floor(x * scale), -MOST, MOST)) for x in v], label) for k, v, label in rows if k is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)]
    seen, out = set(), []
    for key, vec, label in sorted(usable, key=lambda r: r[0]):
        if key % every or key in seen:
            continue
        seen.add(key)
        scored = sorted((-min(max(sum(a * b for a, b in zip(vec, w, strict=False)), low), high), k, m) for k, w, m in usable if k != key)
        for s, k, _ in [x for x in scored if x[2] == label][:positives]:
            fits = [(n, j) for n, j, m in scored if m != label and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            out += [(key, k, i + 1, j, -s, -n) for i, (n, j) in enumerate(fits)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_equals_plain_scoring(spark, monkeypatch, spread):
    monkeypatch.setattr(hard_negatives, "CANDIDATES_PER_BLOCK", 150)
    monkeypatch.setattr(hard_negatives, "ANCHORS_PER_BLOCK", 12)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + spread * rng.gauss(0, 1) for c in rng.choice(centres)], rng.randrange(3)) for i in range(400)]
    rows += [(400 + i, rows[0][1], i % 2) for i in range(60)]  # one very common vector
    result = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert found(result) == plain(rows, 10)


def test_unusable_rows_ties_and_limits(spark):
    rows = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [0.6, 0.3], 1), (3, [0.6, 0.3], 1), (4, None, 1), (5, [None, 1.0], 1), (6, [float("nan"), 1.0], 1)]
    rows += [(7, [0.5, 0.2], None), (None, [0.5, 0.2], 1), (8, [], 1), (9, [-1.0, 0.0], 0), (10, [1e300, 1e306], 0), (11, [3.0], 1), (20, [0.0, 0.0], 0)]
    result = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert found(result) == plain(rows, 10)
    assert hard_negatives.mine(frame(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(frame(spark, rows), F.lit(False)).count() == 0


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0], 0), (0, [1.0, 0.0], 0), (1, [0.9, 0.1], 0), (1, [0.9, 0.1], 0), (2, [0.5, 0.0], 1), (2, [0.5, 0.0], 1)]
    result = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0)
    assert [r[1:4] for r in found(result)] == [(1, 1, 2), (1, 1, 2), (1, 2, 2), (1, 2, 2)]


def test_bounds_spare_candidates_of_close_anchors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 16)) * 40_000
    x = np.floor(centres[rng.integers(8, size=4000)] + rng.normal(size=(4000, 16)) * 200)
    rows = hard_negatives.Block(np.arange(4000), rng.integers(2, size=4000), x)
    anchors = hard_negatives.Block(np.arange(60), rows.label[:60], x[:60])
    out = []

    def visit(i, here):
        out.append(here.best(np.flatnonzero((rows.label == anchors.label[i]) & (rows.key != i)), 5, lambda s: np.ones(len(s), bool)))

    scored = hard_negatives.walk(anchors.x, rows, visit)
    assert scored < 0.75 * 60 * 4000 / 2
    parent, edge = hard_negatives.spanning_tree(anchors.x)
    assert np.allclose(edge[1:], np.linalg.norm(anchors.x[1:] - anchors.x[parent[1:]], axis=1))
