"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples carry a label; everything else is a sample of unlabelled text, of which
an unknown part is toxic. With the class prior p, the risk of a classifier is
p * R(positive as toxic) + max(0, R(unlabelled as clean) - p * R(positive as clean)); the second part
is an estimate of the risk on clean text and is kept from going below zero, which is what over-fitting
would do to it. Several linear classifiers in numpy are trained on different parts of the unlabelled
sample and averaged.

Bounds, all parameters: POSITIVES and UNLABELLED documents for training, FEATURES features. The
sample is taken by a hash of the key over the whole table. Every text is scored whole.

Defined results: a null or empty text scores by the bias alone; without confirmed examples all scores are
0; repeated rows are scored once each; a null key is not held out; an empty table gives an empty
result; other columns are ignored, or kept by `keep_clean`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import keeps_columns, keyed_text, map_rows, with_column
from matchloom.session import store

POSITIVES = 3000
UNLABELLED = 9000
FEATURES = 600
FOLDS = 5
MEMBERS = 3
LEAST_STEPS = 400
#: Words whose weight a task remembers.
REMEMBERED = 300_000
WORD = re.compile(r"[^\W\d_]+")


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(word: str) -> tuple[str, ...]:
    """The word, marked, and its beginnings: endings vary in inflected languages."""
    return (f"{word}$", word[:4], word[:5])


def text_features(text: str) -> set[str]:
    return {f for w in set(WORD.findall(text.lower())) for f in features(w)}


@dataclass
class Classifier:
    """score = mean over members of sigmoid(bias + sum of the weights of the features present)."""

    weights: dict[str, tuple[float, ...]] = field(default_factory=dict)
    bias: tuple[float, ...] = ()

    def scorer(self):
        """A function from texts to scores; sums over words only matter where a feature is known."""
        known: dict[str, tuple[str, ...]] = {}
        weights, bias = self.weights, np.array(self.bias)

        def score(texts: list[str]) -> list[float]:
            if not self.bias:
                return [0.0] * len(texts)
            out = []
            for text in texts:
                if len(known) > REMEMBERED:
                    known.clear()
                present: set[str] = set()
                for w in set(WORD.findall(text.lower())):
                    hits = known.get(w)
                    if hits is None:
                        hits = known[w] = tuple(f for f in features(w) if f in weights)
                    if hits:
                        present.update(hits)
                z = bias + np.sum([weights[f] for f in sorted(present)], axis=0) if present else bias
                out.append(float(np.mean(1 / (1 + np.exp(-np.clip(z, -30, 30))))))
            return out

        return score


def nonnegative_pu(x: np.ndarray, positive: np.ndarray, prior: float, seed: int, epochs: int = 40, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights and bias of a linear classifier under the non-negative risk, by Adam.

    The loss of a decision value z for label y is sigmoid(-y z). Where the estimated risk on clean text
    is negative, the step goes up that part of the risk instead of down the whole.
    """
    rng = np.random.default_rng(seed)
    w = np.zeros(x.shape[1] + 1)
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    pos, unl = np.flatnonzero(positive), np.flatnonzero(~positive)
    parts = max(1, len(unl) // 1000)
    for _ in range(max(epochs, -(-LEAST_STEPS // parts))):
        for p_part, u_part in zip(np.array_split(rng.permutation(pos), parts), np.array_split(rng.permutation(unl), parts), strict=True):
            if not len(p_part) or not len(u_part):
                continue
            xp, xu = x[p_part], x[u_part]
            sp = 1 / (1 + np.exp(-np.clip(xp @ w[:-1] + w[-1], -30, 30)))
            su = 1 / (1 + np.exp(-np.clip(xu @ w[:-1] + w[-1], -30, 30)))
            clean = su.mean() - prior * sp.mean()
            gp, gu = prior * sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
            # Down the whole risk, or up its negative part.
            fp, fu = (-2 * gp, gu) if clean >= 0 else (gp, -gu)
            grad = np.append(xp.T @ fp + xu.T @ fu, fp.sum() + fu.sum())
            grad[:-1] += decay * w[:-1]
            t += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad**2
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def training_sample(docs: DataFrame, labels: DataFrame, positives: int, unlabelled: int) -> tuple[DataFrame, float, int]:
    """Stored (role, text) rows, the class prior, and the number of confirmed examples used.

    Role 1 is confirmed toxic, role 0 unlabelled. Held-out documents are in neither.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior, toxic = known.agg(F.avg("toxic"), F.sum("toxic")).first()
    texts = keyed_text(docs)

    def least(ids: DataFrame, n: int, role: int) -> DataFrame:
        return ids.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).withColumn("role", F.lit(role))

    free = texts.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = least(known.filter("toxic = 1").select("doc_id"), positives, 1).union(least(free, unlabelled, 0))
    # At most positives + unlabelled rows, so the broadcast is bounded.
    sample = store(texts.join(F.broadcast(store(chosen, "training-ids")), "doc_id").select("role", "text"), "training")
    return sample, float(prior or 0.0), int(toxic or 0)


def select_features(sample: DataFrame, limit: int) -> list[str]:
    """The features most tied to confirmed examples, each in at least three of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[role].update(text_features(text))
        for role, counts in enumerate(found):
            yield pa.record_batch([pa.array([role] * len(counts), pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["role", "feature", "n"])

    sizes = {r["role"]: r["count"] for r in sample.groupBy("role").count().collect()}
    np_, nu = max(1, sizes.get(1, 0)), max(1, sizes.get(0, 0))
    counts = sample.mapInArrow(count, "role int, feature string, n long").groupBy("feature")
    counts = counts.agg(*(F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)).alias(c) for r, c in ((1, "p"), (0, "u"))))
    share_p, share_u = F.col("p") / np_, F.col("u") / nu
    tie = (share_p - share_u) / F.sqrt(share_p / np_ + (share_u + 1 / nu) / nu)
    return [r["feature"] for r in counts.filter("p >= 3").orderBy(tie.desc(), "feature").limit(limit).select("feature").collect()]


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, limit: int = FEATURES, members: int = MEMBERS) -> Classifier:
    """A classifier from confirmed toxic examples and unlabelled text."""
    sample, prior, toxic = training_sample(docs, labels, positives, unlabelled)
    if not toxic:
        return Classifier()
    names = select_features(sample, limit)
    number = {f: i for i, f in enumerate(names)}

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(number[f] for f in text_features(t) if f in number) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["role", "at"])

    rows = sorted(((r["role"], r["at"]) for r in sample.mapInArrow(present, "role int, at array<int>").toLocalIterator()), key=lambda r: (-r[0], r[1]))
    if not rows or rows[0][0] == 0 or not names:
        return Classifier()
    positive = np.array([role == 1 for role, _ in rows])
    weights = []
    for member in range(members):
        # All confirmed examples, and every other part of the unlabelled ones.
        used = np.flatnonzero(positive | (np.arange(len(rows)) % members != member) | (members == 1))
        x = np.zeros((len(used), len(names)), dtype="float32")
        for i, at in enumerate(used):
            x[i, rows[at][1]] = 1
        weights.append(nonnegative_pu(x, positive[used], min(max(prior, 1e-3), 0.99), seed=member))
    table = np.array(weights)
    return Classifier({f: tuple(table[:, i]) for f, i in number.items()}, tuple(table[:, -1]))


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""

    def make():
        scorer = classifier.scorer()
        return lambda keys, texts: zip(keys, scorer(texts), strict=True)

    scored = map_rows(keyed_text(docs), "doc_id long, score double", make)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@keeps_columns
def keep_clean(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """The documents that aren't predicted to be toxic, with their columns."""
    return with_column(docs, "text", "__toxicity", "double", classifier.scorer).filter("__toxicity < 0.5").drop("__toxicity")
