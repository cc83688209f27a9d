"""Near-duplicate documents: SimHash fingerprints, linked by the generalised pigeonhole principle.

The bits are put into m groups, correlated bits together. If two fingerprints differ in at most t bits
and the groups get thresholds that add up to t - m + 1 (-1 leaves a group out), then some group differs
within its own threshold. The thresholds are chosen by dynamic programming on the candidates that each
one is expected to bring, estimated on a bounded sample; the sample decides the cost, never the result.
Every fingerprint is indexed under its bits of each group and probes the values within the threshold;
candidates are verified on all bits.

Skew: equal fingerprints are one. A bucket above `BUCKET` fingerprints is taken apart by a second
pigeonhole over its other bits, and what is still larger is compared in tiles, whole. Inside a bucket
only a spanning forest of its links leaves the task, so a group of near copies costs its size in rows.

Defined results: a null or empty text has fingerprint zero and links like any other; repeated rows are
kept; the component is the smallest key that is not null (null if all are); an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import keyed_text, map_rows, to_arrow
from matchloom.llm.components import components
from matchloom.session import store

BITS = 64
#: Fingerprints of a bucket that one task compares.
BUCKET = 2048
#: Fingerprints from which costs are estimated.
SAMPLE = 2048
#: Cost of a shuffled row, in compared pairs.
ROW_COST = 50.0


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the hashes of all word shingles, repeats included."""
    import xxhash

    parts = text.lower().split()  # of bytes: A-Z only, and exactly the ASCII white space
    if not parts:
        return 0
    joined, ends = b" ".join(parts), []
    at = -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[min(words, len(ends)) - 1 :], strict=False)], dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have."""
    counts = np.zeros(BITS, dtype="int64")
    for i in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[i : i + 65536].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of each whole text, as a signed 64-bit number."""

    def make():
        def work(keys, texts):
            for key, text in zip(keys, texts, strict=True):
                fp = fingerprint(text, words, seed)
                yield key, fp - (fp >> 63 << 64)

        return work

    plain = keyed_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_rows(plain, "doc_id long, fp long", make)


# ---------------------------------------------------------------- planning


def group_bits(sample: np.ndarray, m: int) -> list[int]:
    """m masks of almost equal width; each takes the bits most correlated with those it has."""
    bits = np.unpackbits(sample.astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits.std(axis=0)
    z = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    close = np.abs(z.T @ z) / max(1, len(z))
    np.fill_diagonal(close, 0)
    free, masks = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        first = max(sorted(free), key=lambda b: close[b, sorted(free)].sum())
        chosen = [first]
        free.remove(first)
        while len(chosen) < width:
            nearest = max(sorted(free), key=lambda b: close[b, chosen].sum())
            chosen.append(nearest)
            free.remove(nearest)
        masks.append(sum(1 << b for b in chosen))
    return masks


def allot(cost: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one for each group, that add up to `total` at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for choices in cost:
        after: dict[int, tuple[float, list[int]]] = {}
        for so_far, (c, picked) in best.items():
            for t, extra in choices.items():
                if so_far + t not in after or c + extra < after[so_far + t][0]:
                    after[so_far + t] = (c + extra, [*picked, t])
        best = after
    return best[total]


def plan_probes(sample: np.ndarray, rows: int, distance: int) -> list[tuple[int, int]]:
    """(mask, threshold) of the groups to probe, for so many fingerprints."""
    n = len(sample)
    left, right = np.triu_indices(min(n, 1024), 1)
    differ = sample[left] ^ sample[right]
    pairs = max(1, len(differ))
    best: tuple[float, list[tuple[int, int]]] | None = None
    for m in range(2, distance + 2):
        masks, costs = group_bits(sample, m), []
        for mask in masks:
            apart = np.bitwise_count(differ & np.uint64(mask))
            width, cost = mask.bit_count(), {-1: 0.0}
            for t in range(min(2, distance) + 1):
                probes = 1 + sum(math.comb(width, k) for k in range(1, t + 1)) / 2
                close = (np.count_nonzero(apart <= t) + 0.5) / pairs
                cost[t] = rows * probes * ROW_COST + rows * rows / 2 * close
            costs.append(cost)
        price, thresholds = allot(costs, distance - m + 1)
        if best is None or price < best[0]:
            best = (price, [(k, t) for k, t in zip(masks, thresholds, strict=True) if t >= 0])
    return best[1]


def probe_rows(reps: DataFrame, plan: list[tuple[int, int]]) -> DataFrame:
    """(grp, key, fp, probe): each fingerprint under its own value, and as a probe of near ones.

    Two values that differ are found from the one whose lowest differing bit is 0.
    """
    flips = []
    for g, (mask, most) in enumerate(plan):
        bits = [b for b in range(BITS) if mask >> b & 1]
        flips += [(g, mask, 0, 0)] + [(g, mask, sum(1 << b for b in c), 1 << c[0]) for k in range(1, most + 1) for c in combinations(bits, k)]
    schema = "grp int, key long, fp long, probe boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view("u8")
            for g, mask, flip, lowest in flips:
                some = fp[(fp & np.uint64(lowest)) == 0] if flip else fp
                key = (some & np.uint64(mask)) ^ np.uint64(flip)
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, g, "int32")), pa.array(key.view("i8")), pa.array(some.view("i8")), pa.array(np.full(n, bool(flip)))], schema=to_arrow(schema))

    return reps.select("fp").mapInArrow(run, schema)


# ---------------------------------------------------------------- verifying


def join_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index reachable from each of n nodes over the links a - b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (jump := new[new])[...].tolist() != new.tolist():
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    return label


def bucket_links(fp: np.ndarray, probe: np.ndarray, distance: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one bucket; two probes aren't compared."""
    label = np.arange(len(fp))
    for i in range(0, len(fp), rows):
        near = np.bitwise_count(fp[i : i + rows, None] ^ fp[None, i:]) <= distance
        near &= ~(probe[i : i + rows, None] & probe[None, i:])
        a, b = np.nonzero(near)
        a, b = label[a + i], label[b + i]
        keep = a != b
        if keep.any():
            label = join_labels(len(fp), a[keep], b[keep])[label]
    own = np.arange(len(fp))
    moved = label != own
    return fp[own[moved]], fp[label[moved]]


def sorted_links(rows: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links (u, v) within the buckets named by `keys`, a task seeing its buckets one after the other.

    Small buckets are compared together, each row with the k-th after it; k ends at their size.
    """
    small = 48

    def links(start: np.ndarray, fp: np.ndarray, probe: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = np.diff(np.append(start, len(fp)))
        us, vs = [], []
        for s, n in zip(start[size > small], size[size > small], strict=True):
            u, v = bucket_links(fp[s : s + n], probe[s : s + n], distance)
            us.append(u)
            vs.append(v)
        row_size = np.repeat(size, size)
        left = np.repeat(start + size, size) - np.arange(len(fp)) - 1  # rows after this one in its bucket
        left[row_size > small] = 0
        for k in range(1, small):
            at = np.flatnonzero(left >= k)
            if not len(at):
                break
            ok = (np.bitwise_count(fp[at] ^ fp[at + k]) <= distance) & ~(probe[at] & probe[at + k])
            us.append(fp[at[ok]])
            vs.append(fp[at[ok] + k])
        u, v = np.concatenate(us or [fp[:0]]), np.concatenate(vs or [fp[:0]])
        keep = u != v
        yield pa.RecordBatch.from_arrays([pa.array(u[keep].view("i8")), pa.array(v[keep].view("i8"))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # keys as one two-dimensional array: a bucket begins where any of them changes
            now = np.stack([batch[k].to_numpy(zero_copy_only=False).astype("i8") for k in keys] + [batch["fp"].to_numpy(), batch["probe"].to_numpy(zero_copy_only=False).astype("i8")])
            now = now if held is None else np.concatenate([held, now], axis=1)
            start = np.concatenate([[0], np.flatnonzero((now[: len(keys), 1:] != now[: len(keys), :-1]).any(axis=0)) + 1])
            last = start[-1]
            held = now[:, last:]
            if last:
                yield from links(start[:-1], now[-2, :last].view("u8"), now[-1, :last].astype(bool))
        if held is not None:
            yield from links(np.array([0]), np.ascontiguousarray(held[-2]).view("u8"), held[-1].astype(bool))

    dealt = rows.select(*keys, "fp", "probe").repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "u long, v long")


def second_key(rows: DataFrame, plan: list[tuple[int, int]], distance: int) -> DataFrame:
    """Rows of large buckets under `distance` + 1 parts of the bits outside their group.

    The fingerprints of a bucket differ by at most `distance` outside it, so one part is equal.
    """
    parts = []
    for g, (mask, _) in enumerate(plan):
        rest = [b for b in range(BITS) if not mask >> b & 1]
        for k in range(distance + 1):
            sub = sum(1 << b for b in rest[k :: distance + 1])
            parts.append((g, k, sub - (sub >> 63 << 64)))
    choices = [F.when(F.col("grp") == g, F.struct(F.lit(k).alias("part"), F.col("fp").bitwiseAND(F.lit(sub)).alias("key2"))) for g, k, sub in parts]
    found = rows.withColumn("_p", F.explode(F.filter(F.array(*choices), lambda x: x.isNotNull())))
    return found.select("grp", "key", "_p.part", "_p.key2", "fp", "probe")


def split_by_size(rows: DataFrame, keys: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows of buckets up to the limit, and of those above with the size `n`."""
    large = store(rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > limit), "large")
    return rows.join(large, keys, "left_anti"), rows.join(large, keys)


def near_links(reps: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Links that connect all fingerprints within the distance, each component spanned by them."""
    n = reps.count()
    sample = np.array([r["fp"] for r in reps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype="i8").view("u8")
    if n < 2:
        return reps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    plan = plan_probes(sample, n, distance)
    rows = probe_rows(reps, plan)
    first = ["grp", "key"]
    cold, hot = split_by_size(rows, first, bucket)
    second = [*first, "part", "key2"]
    cold2, hot2 = split_by_size(second_key(hot, plan, distance), second, bucket)
    # What is left is compared whole: dealt over blocks, every pair of blocks being a tile.
    blocks = F.ceil(F.col("n") / F.lit(bucket)).cast("int")
    tiles = hot2.withColumn("_b", F.pmod(F.xxhash64("fp", F.lit(7)), blocks).cast("int")).withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    tiles = tiles.withColumn("low", F.least("_b", "_o")).withColumn("high", F.greatest("_b", "_o"))
    found = sorted_links(cold, first, distance)
    found = found.union(sorted_links(cold2, second, distance))
    return found.union(sorted_links(tiles, [*second, "low", "high"], distance))


# ---------------------------------------------------------------- results


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document."""
    fps = store(fingerprints(docs, words, seed), "fingerprints")
    return _with_component(fps, distance).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _with_component(fps: DataFrame, distance: int) -> DataFrame:
    reps = store(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "representatives")
    linked = components(near_links(reps, distance))
    member = reps.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    # One row per fingerprint on the right; adaptive execution splits a fingerprint of very many copies.
    return fps.join(member.join(least, "component").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, words: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """The documents without all but one of each component, with their columns."""
    fps = store(fingerprints(docs, words, seed), "fingerprints")
    return keep_least(docs, _with_component(fps, distance))


def keep_least(docs: DataFrame, member: DataFrame) -> DataFrame:
    """One document of each component, given (doc_id, component_id) of all.

    The one with the smallest key stays; of rows that share this key, one. Rows without a key can't be
    told apart and stay.
    """
    found = member.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_n"))
    chosen = store(found, "chosen")
    repeated = chosen.filter("_n > 1").select("doc_id")
    # The chosen keys grow with the documents, so both sides are shuffled at every size. One row per
    # key remains on either side, but for repeated rows.
    if repeated.isEmpty():
        kept = docs.join(chosen.select("doc_id").hint("merge"), "doc_id", "left_semi")
    else:
        once = docs.join(chosen.filter("_n = 1").select("doc_id").hint("merge"), "doc_id", "left_semi")
        often = docs.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = once.select(docs.columns).unionByName(often.select(docs.columns))
    return kept.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))
