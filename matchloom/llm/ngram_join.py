"""N-gram Jaccard join: documents whose sets of word shingles are alike, found in prefix trees.

The shingles of all documents have one global order: that of their 63-bit hashes, those last that are
common in a bounded sample (the sample decides the cost, never the result). A set is its shingles in that
order. With a = ceil(share * n), two alike sets share l of their first n - a + l shingles, for every l.

1. Each text is read once. Equal sets become one. Of the first n - a + l shingles, l a tenth of n, a set
   must have about l that other sets have there too; the others are alike to nothing and leave. Common
   shingles count without being shuffled, so no frequent shingle meets in one task.
2. Each set left joins the least set of those buckets, by its first n - a + 1 shingles, that it shares most
   often. The sets of such a group are compared in a prefix tree, and what is alike gets one label.
3. In buckets with several labels and groups, of sets that are in as many of these as step 1 asks for and whose
   sizes and places there leave a partner possible, the first n - a + 1 shingles are compared in a prefix tree. Sets that may have a partner of another label and group, for which the bucket is that of the
   first shingle of both, go on whole, and are compared in a second tree. This finds what groups have parted.

A prefix tree keeps sets with the same beginning on one path. It is walked once for all sets of its tile:
the overlaps with the path so far are shared by everything below, and a set leaves a subtree when its
overlap and what remains of both can't reach the share. Tiles hold at most `BLOCK` sets and `ELEMENTS`
shingles of each of two blocks, whatever the size of a bucket; within a label or a group nothing is compared
again, so a large group of near copies costs its size. Only links that join trees of a tile leave it.

Defined results: words are split at the six ASCII white space characters; A-Z count as a-z; a null text is
empty; sets without words are linked with nothing unless `empty_alike`; repeated rows and keys count once
for each row, and the component is the smallest key that is not null (null if all are); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import ROWS_AT_ONCE, keyed_text, map_rows, to_arrow
from matchloom.llm.components import components, stars
from matchloom.session import in_few_files, store

WORDS = 3
#: Least similarity, as a fraction.
SHARE = (9, 10)
#: One of so many shingles of a set must be shared beside the first of its prefix.
EXTRA = 10
#: Texts of the sample, sets of them that make a shingle common, and the most common ones that are kept.
SAMPLE, COMMON, MOST_COMMON = 2048, 4, 100_000
#: Sets and shingles of a block; a tile is two blocks.
BLOCK, ELEMENTS = 256, 2_000_000
#: Classes of sizes between a set and the largest one alike to it.
CLASSES = 4
#: Set names that a task remembers, to pass on equal sets once.
REMEMBERED = 100_000
#: Most bits of the table that tells which texts are read again, and bits for each; a false hit costs work only.
SLOTS, SLOTS_EACH = 1 << 24, 16
LAST = np.uint64(1 << 63)
LINKS = "u long, v long"


# ---------------------------------------------------------------- sets


def shingles(text: bytes, words: int, seed: int = 42) -> np.ndarray:
    """The 63-bit hashes of all word shingles, ascending, each once."""
    import xxhash

    parts = text.lower().split()  # of bytes: A-Z only, and exactly the ASCII white space
    if not parts:
        return np.empty(0, "u8")
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    size = min(words, len(parts))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(parts) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[s:e], seed) for s, e in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    return np.unique(np.array(found, dtype="u8") >> np.uint64(1))


def in_order(found: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A set in the global order, ascending: common shingles carry the highest bit."""
    if not len(common) or not len(found):
        return found
    at = np.minimum(np.searchsorted(common, found), len(common) - 1)
    return np.sort(np.where(common[at] == found, found | LAST, found))


def name_of(found: np.ndarray) -> int:
    """One signed number for a whole set, whatever its order."""
    import xxhash

    number = xxhash.xxh64_intdigest(np.sort(found & ~LAST).astype("<u8").tobytes(), 7)
    return number - (number >> 63 << 64)


def least_shared(n: int, share: tuple[int, int]) -> int:
    """Shingles that a set of n shares at least with any set alike to it."""
    return -(-n * share[0] // share[1])


def extra(n: int) -> int:
    return max(1, n // EXTRA)


def prefix_size(n: int, share: tuple[int, int]) -> int:
    return n - least_shared(n, share) + 1 if n else 0


def plain_text(docs: DataFrame) -> DataFrame:
    return keyed_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))


def common_shingles(docs: DataFrame, words: int, rows: int) -> np.ndarray:
    """Shingles of several sets of the sample, ascending; at most `MOST_COMMON`. The table has so many rows."""
    some = plain_text(docs).filter(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(max(1, rows // SAMPLE))) == 0)

    def make():
        def work(keys, texts):
            for text in texts:
                found = shingles(text, words)
                fp = name_of(found)
                yield from ((int(k), fp) for k in found)

        return work

    counts = map_rows(some, "key long, fp long", make).distinct().groupBy("key").count().filter(F.col("count") >= COMMON)
    found = counts.orderBy(F.desc("count"), "key").limit(MOST_COMMON).collect()
    return np.sort(np.array([r["key"] for r in found], dtype="u8"))


def summaries(docs: DataFrame, words: int, share: tuple[int, int], common: np.ndarray) -> DataFrame:
    """(doc_id, fp, n, sure, rare): name and size of each set; of its longer prefix the number of common
    shingles and the others, null where the task has passed that set on before."""

    def make():
        seen: set[int] = set()

        def work(keys, texts):
            for key, text in zip(keys, texts, strict=True):
                found = in_order(shingles(text, words), common)
                fp, n = name_of(found), len(found)
                start = found[: n - least_shared(n, share) + extra(n)]
                rare = start[start < LAST]
                yield key, fp, n, len(start) - len(rare), None if fp in seen or not n else rare.astype("<u8").tobytes()
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(fp)

        return work

    return map_rows(plain_text(docs), "doc_id long, fp long, n long, sure long, rare binary", make)


def shared_counts(rows: DataFrame) -> DataFrame:
    """(fp, shared): how many of the rare shingles of a set's longer prefix another set has there too."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = [np.frombuffer(x, "<i8") for x in part["rare"].to_pylist()]
                fp = np.repeat(part["fp"].to_numpy(), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, "i8")])), pa.array(fp)], names=["key", "fp"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named(fp: np.ndarray) -> pa.RecordBatch:
            names, times = np.unique(fp, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(times.astype("i8"))], names=["fp", "shared"])

        # The last row waits for its successor; `met` tells if the row before it has the same key.
        key, fp, met = np.empty(0, "i8"), np.empty(0, "i8"), False
        for batch in batches:
            key, fp = np.append(key, batch["key"].to_numpy()), np.append(fp, batch["fp"].to_numpy())
            if not len(key):
                continue
            once = np.append(True, (key[1:] != key[:-1]) | (fp[1:] != fp[:-1]))
            key, fp = key[once], fp[once]
            same = key[1:] == key[:-1]
            before = np.append(met, same)
            yield named(fp[:-1][before[:-1] | same])
            key, fp, met = key[-1:], fp[-1:], before[-1]
        yield named(fp[[met] * len(fp)])

    index = rows.filter("rare IS NOT NULL").select("fp", "rare").mapInArrow(spread, "key long, fp long")
    found = index.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(count, "fp long, shared long")
    return found.groupBy("fp").agg(F.sum("shared").alias("shared"))


def least_shared_early(share: tuple[int, int]) -> Column:
    """Shingles of its longer prefix that a set of n shares at least with the longer prefix of any set alike to it."""
    a = F.expr(f"(n * {share[0]} + {share[1] - 1}) div {share[1]}")
    return F.greatest(F.lit(1), F.floor(a / EXTRA))


def may_be_alike(sets: DataFrame, counts: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The sets (fp, n, least) that share enough of their longer prefix to be alike to another."""
    joined = sets.filter("n > 0").join(counts, "fp", "left")
    return joined.filter(F.coalesce("shared", F.lit(0)) + F.col("sure") >= least_shared_early(share)).select("fp", "n", "least")


def slots_for(keys: int) -> int:
    """Bits of the table for so many keys: a power of two, at most SLOTS."""
    return min(SLOTS, 1 << max(10, (SLOTS_EACH * keys - 1).bit_length()))


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int, common: np.ndarray) -> DataFrame:
    """(fp, n, path): the sets named in `wanted` (fp, n, least), in the global order."""

    # A set is read from one of its documents; those without a key are read in any case.
    keys = wanted.filter("least IS NOT NULL").select("least")
    slots = slots_for(keys.count())

    def row(bits: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(slots, bool)
        for batch in batches:
            table[batch.column(0).to_numpy().view("u8") % slots] = True
        yield row(np.packbits(table))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(slots // 8, "u1")
        for batch in batches:
            for part in batch["bits"]:
                bits |= np.frombuffer(part.as_buffer(), "u1")
        yield row(bits)

    # The tables, eight at most, become one before the driver gets it.
    marked = keys.coalesce(8).mapInArrow(mark, "bits binary").repartition(1).mapInArrow(merge, "bits binary")
    found = marked.first()
    bits = np.frombuffer(found["bits"], "u1") if found else np.zeros(slots // 8, "u1")

    def make():
        def work(keys, texts):
            for key, text in zip(keys, texts, strict=True):
                slot = 0 if key is None else key % 2**64 % slots
                if key is None or bits[slot >> 3] >> (7 - (slot & 7)) & 1:
                    found = in_order(shingles(text, words), common)
                    yield name_of(found), found.astype("<u8").tobytes()

        return work

    made = map_rows(plain_text(docs), "fp long, path binary", make)
    return made.join(wanted.select("fp", "n").hint("merge"), "fp").groupBy("fp").agg(F.first("n").alias("n"), F.first("path").alias("path"))


# ---------------------------------------------------------------- prefix trees


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers start[i]..end[i]-1 of all i, one after the other."""
    size = end - start
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(size) else size


def tree_pairs(paths: list[np.ndarray], n: np.ndarray, label: np.ndarray, group: np.ndarray, share: tuple[int, int], key: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): sets of another label and group that may be alike to set i, each pair once.

    `paths` are beginnings of the sets, in the global order; `n` the sizes of the whole sets. Whole
    paths give exactly the alike pairs. With `key`, only pairs whose first common shingle is that one.
    """
    g, (num, den) = len(paths), share
    size = np.array([len(p) for p in paths])
    known, code = np.unique(np.concatenate(paths), return_inverse=True)
    total, end = len(known), np.cumsum(size)
    begin = end - size
    each = np.arange(g) * total
    flat = code + np.repeat(each, size)
    codes = [code[b:e] for b, e in zip(begin, end, strict=True)]
    by_code = np.argsort(code, kind="stable")
    holder = np.repeat(np.arange(g), size)[by_code]
    first_holder = np.searchsorted(code[by_code], np.arange(total + 1))
    last = flat[end - 1] - each
    key_code = None if key is None else int(np.searchsorted(known, np.uint64(key)))
    held_by = lambda some: np.bincount(holder[ranges(first_holder[some], first_holder[some + 1])], minlength=g)

    in_bytes = [c.astype(">u4").tobytes() for c in codes]
    rank = sorted(range(g), key=in_bytes.__getitem__)
    place = np.empty(g, "i8")
    place[rank] = np.arange(g)
    joint = np.zeros(g, "i8")  # shingles at the beginning that a path has in common with the one before it
    for k in range(1, g):
        x, y = codes[rank[k - 1]], codes[rank[k]]
        m = min(len(x), len(y))
        differ = x[:m] != y[:m]
        joint[k] = differ.argmax() if differ.any() else m

    walk = [(0, g, 0, np.zeros(g, "i8"), np.ones(g, bool))]
    while walk:
        lo, hi, depth, overlap, active = walk.pop()
        own = codes[rank[lo]]
        m = len(own) if hi - lo == 1 else int(joint[lo + 1 : hi].min())
        edge = own[depth:m]
        if len(edge):
            if key_code is not None and edge[0] < key_code:
                active = active & (held_by(edge[edge < key_code]) == 0)
            overlap = overlap + held_by(edge)
        if m:
            reached = own[m - 1]
            passed = np.searchsorted(flat, each + reached, "right") - begin
            depth_there = np.where(last < reached, np.searchsorted(own[:m], last, "right"), m)
            sizes = n[rank[lo:hi]]
            bound = overlap + np.minimum(sizes.max() - depth_there, n - passed)
            active = active & (place > lo) & (bound * (num + den) >= (sizes.min() + n) * num)
        if not active.any():
            continue
        if hi - lo == 1:
            found = np.flatnonzero(active & (label != label[rank[lo]]) & (group != group[rank[lo]]))
            if len(found):
                yield rank[lo], found
            continue
        cuts = [lo, *(np.flatnonzero(joint[lo + 1 : hi] == m) + lo + 1).tolist(), hi]
        walk.extend((s, e, m, overlap, active) for s, e in zip(cuts, cuts[1:], strict=False))


def by_tile(rows: DataFrame, keys: list[str], schema: str, work: Callable[[pa.Table], list[np.ndarray]]) -> DataFrame:
    """`work` applied to the rows of each tile, which a task reads one after the other."""
    names = to_arrow(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        before = None

        def done() -> Iterator[pa.RecordBatch]:
            columns = work(pa.Table.from_batches(held))
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            now = np.stack([batch[k].to_numpy() for k in keys])
            start = [0, *(np.flatnonzero((now[:, 1:] != now[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for s, e in zip(start, start[1:], strict=False):
                if held and tuple(now[:, s]) != before:
                    yield from done()
                    held = []
                held.append(batch.slice(s, e - s))
                before = tuple(now[:, s])
        if held:
            yield from done()

    return rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys).mapInArrow(run, schema)


def read_tile(tile: pa.Table) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(fp, paths, n, label, group), each set once."""
    fp, at = np.unique(tile["fp"].to_numpy(), return_index=True)
    paths = tile["path"]
    return fp, [np.frombuffer(paths[int(i)].as_buffer(), "<u8") for i in at], *(tile[c].to_numpy()[at] for c in ("n", "label", "grp"))


def tile_links(tiles: DataFrame, keys: list[str], sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Links (u, v) that connect the alike sets of each tile (keys, fp, label, grp) beyond labels and groups."""

    def work(tile: pa.Table) -> list[np.ndarray]:
        fp, paths, n, label, group = read_tile(tile)
        root = list(range(len(fp)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        us, vs = [], []
        for i, others in tree_pairs(paths, n, label, group, share) if len(fp) > 1 else ():
            for j in others.tolist():
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    us.append(fp[i])
                    vs.append(fp[j])
        return [np.array(us, "i8"), np.array(vs, "i8")]

    return by_tile(tiles.select(*keys, "fp", "label", "grp").join(sets, "fp"), keys, LINKS, work)


# ---------------------------------------------------------------- groups and buckets


def prefix_rows(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(key, fp, at, sure): each set under the shingles of its prefix, with their places there, and under the rare ones
    of its longer prefix beyond, without a place; `sure` is the number of common ones of its longer prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                found, at, sure = [np.empty(0, "i8")], [np.empty(0, "i4")], []
                for path, n in zip(part["path"].to_pylist(), part["n"].to_pylist(), strict=True):
                    longer = np.frombuffer(path, "<i8")[: n - least_shared(n, share) + extra(n)]
                    short, beyond = np.split(longer, [prefix_size(n, share)])
                    rare = beyond[beyond >= 0]  # common shingles carry the highest bit
                    found += [short, rare]
                    at += [np.arange(len(short), dtype="i4"), np.full(len(rare), -1, "i4")]
                    sure.append((len(short) + len(rare), np.count_nonzero(longer < 0)))
                times, common = np.array(sure, "i4").reshape(-1, 2).T
                place = np.concatenate(at)
                columns = [np.concatenate(found), np.repeat(part["fp"].to_numpy(), times), pa.array(place, mask=place < 0), np.repeat(common, times)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "fp", "at", "sure"])

    return sets.select("fp", "n", "path").mapInArrow(run, "key long, fp long, at int, sure int")


def prefixes(sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(fp, n, path) with the paths cut to their prefix."""
    size = F.expr(f"n - (n * {share[0]} + {share[1] - 1}) div {share[1]} + 1")
    return sets.select("fp", "n", F.substring("path", F.lit(1), (size * 8).cast("int")).alias("path"))


def blocks(count: Column, elements: Column) -> Column:
    """Into how many blocks so many sets with so many shingles are dealt; 0 for none."""
    return F.greatest(F.ceil(count / F.lit(BLOCK)), F.ceil(elements / F.lit(ELEMENTS))).cast("int")


def dealt(count: Column) -> Column:
    return F.pmod(F.xxhash64("fp", F.lit(7)), F.greatest(count, F.lit(1))).cast("int")


def group_tiles(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(leader, part, fp): each set with the least set of the buckets that it shares most often."""
    rows = rows.filter("at IS NOT NULL")
    least = rows.groupBy("key").agg(F.min("fp").alias("leader"), F.max("fp").alias("high")).filter("leader != high")
    often = rows.join(least, "key").filter("fp != leader").groupBy("fp", "leader").count()
    chosen = often.groupBy("fp").agg(F.max_by("leader", F.struct("count", "leader")).alias("leader")).join(sizes, "fp")
    group = chosen.groupBy("leader").agg(blocks(F.count("*"), F.sum("n")).alias("parts"))
    members = chosen.join(group, "leader").select("leader", dealt(F.col("parts")).alias("part"), "fp")
    heads = group.select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("leader").alias("fp"))
    return members.unionByName(heads)


def settled_groups(tiles: DataFrame) -> DataFrame:
    """(fp, grp): a tile in which each set was compared; for a leader the first of its own."""
    name = F.xxhash64("leader", "part")
    own = F.max(F.when((F.col("fp") == F.col("leader")) & (F.col("part") == 0), name))
    return tiles.groupBy("fp").agg(F.coalesce(own, F.max(name)).alias("grp"))


def of_several(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose rows have several labels and groups."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("label", "grp") for f in (F.min, F.max)]
    return rows.groupBy(*keys).agg(*ends).filter("min_label != max_label AND min_grp != max_grp").select(*keys)


def in_enough(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The rows (key, fp, n, at, sure, label, grp) of sets that are in enough of these buckets to be alike to another there, without `sure`.

    What two alike sets of different labels and groups share makes buckets with several of both. So a set that meets
    unlike ones here and there, as more do in larger tables, leaves before anything is made of its rows. Common shingles
    count in any case: beyond the prefix they have no rows.
    """
    enough = rows.groupBy("fp", "n").agg((F.count_if(F.col("key") >= 0) + F.max("sure")).alias("shared")).filter(F.col("shared") >= least_shared_early(share))
    return rows.filter("at IS NOT NULL").drop("sure").join(enough.select("fp"), "fp", "left_semi")


def within_reach(rows: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The rows (key, fp, n, at, label, grp) whose size and place leave a partner possible in their bucket, without `at`.

    Of two sets whose first common shingle lies at place `at` of the smaller, of size n, the larger has at most
    (n - at) * (num + den) / num - n shingles. Each set takes the class of its size and those up to that bound, so that
    such a pair meets in the class of the larger; without another label and group in any class, a set leaves the bucket.
    """
    num, den = share
    width = max(math.log(den / num) / CLASSES, 1e-6)
    size = lambda n: F.floor(F.log(n) / F.lit(width))
    most = F.greatest(F.col("n"), F.expr(f"(n - at) * {num + den} div {num} - n"))
    low, high = size(F.col("n")), size(most)
    spread = rows.select("key", "label", "grp", F.explode(F.sequence(low, high)).alias("class"))
    # A bucket has few classes, whatever its sets: their number grows with the logarithm of the largest size.
    met = of_several(spread, ["key", "class"]).groupBy("key").agg(F.collect_set("class").alias("classes"))
    return rows.join(met, "key").filter(F.exists("classes", lambda c: c.between(low, high))).select("key", "fp", "n", "label", "grp")


def mixed_tiles(rows: DataFrame, sizes: DataFrame, label: DataFrame, settled: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(key, low, high, fp, label, grp) of the buckets with several labels and groups, in tiles.

    The sets of a bucket's largest label or group meet the others only.
    """
    about = sizes.join(label.select(F.col("node").alias("fp"), "component"), "fp", "left").join(settled, "fp", "left")
    about = about.select("fp", "n", F.coalesce("component", "fp").alias("label"), F.coalesce("grp", F.xxhash64("fp")).alias("grp"))
    named = rows.join(about, "fp")
    mixed = store(in_few_files(named.join(of_several(named, ["key"]), "key", "left_semi").select("key", "fp", "n", "at", "sure", "label", "grp"), rows.count()), "mixed")
    left = store(in_few_files(within_reach(in_enough(mixed, share), share), mixed.count()), "within-reach")
    both = left.select("key", "n", F.posexplode(F.array("label", "grp")).alias("kind", "value"))
    sums = both.groupBy("key", "kind", "value").agg(F.count("*").alias("c"), F.sum("n").alias("e"))
    most = sums.groupBy("key").agg(F.max(F.struct("c", "kind", "value", "e")).alias("m"), F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("c"), F.sum(F.when(F.col("kind") == 0, F.col("e"))).alias("e"))
    plan = most.select("key", "m.kind", "m.value", blocks(F.col("m.c"), F.col("m.e")).alias("major"), blocks(F.col("c") - F.col("m.c"), F.col("e") - F.col("m.e")).alias("minor"))
    placed = left.join(plan, "key").withColumn("_major", F.col("value") == F.when(F.col("kind") == 0, F.col("label")).otherwise(F.col("grp")))
    placed = placed.withColumn("_block", F.when(F.col("_major"), F.col("minor") + dealt(F.col("major"))).otherwise(dealt(F.col("minor"))))
    partner = F.explode(F.sequence(F.lit(0), F.when(F.col("_major"), F.col("minor")).otherwise(F.col("minor") + F.col("major")) - 1))
    met = placed.withColumn("_other", partner)
    return met.select("key", F.least("_block", "_other").alias("low"), F.greatest("_block", "_other").alias("high"), "fp", "label", "grp")


def with_partner(tiles: DataFrame, short: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The rows of the tiles whose prefix leaves a partner of another label and group possible there."""

    def work(tile: pa.Table) -> list[np.ndarray]:
        fp, paths, n, label, group = read_tile(tile)
        key, low, high = (tile[c][0].as_py() for c in ("key", "low", "high"))
        keep = np.zeros(len(fp), bool)
        for i, others in tree_pairs(paths, n, label, group, share, key % 2**64):
            keep[i] = True
            keep[others] = True
        k = int(keep.sum())
        return [np.full(k, key), np.full(k, low, "i4"), np.full(k, high, "i4"), fp[keep], label[keep], group[keep]]

    return by_tile(tiles.join(short, "fp"), ["key", "low", "high"], "key long, low int, high int, fp long, label long, grp long", work)


# ---------------------------------------------------------------- results


def found_links(
    sets: DataFrame, share: tuple[int, int], first_links: Callable[[DataFrame], DataFrame] | None = None, most: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, label, more): links of first_links and groups, the components they make, and links beyond these.

    What is connected goes on as stars around the least sets, so each search for components takes few rounds
    beyond those that its new links need. There are at most `most` sets.
    """
    rows = store(prefix_rows(sets, share), "prefixes")
    sizes = sets.select("fp", "n")
    groups = store(in_few_files(group_tiles(rows, sizes), most), "groups")
    alone = groups.withColumn("label", F.col("fp")).withColumn("grp", F.col("fp"))
    if first_links:
        known = store(first_links(sets), "first-links")
        before = store(in_few_files(components(known), most), "first-labels")
        alone = groups.join(before.withColumnRenamed("node", "fp"), "fp", "left").withColumns({"label": F.coalesce("component", "fp"), "grp": F.col("fp")})
    near = store(tile_links(alone, ["leader", "part"], sets, share), "group-links")
    label = store(in_few_files(components(near.unionByName(stars(before)) if first_links else near), most), "labels")
    mixed = mixed_tiles(rows, sizes, label, settled_groups(groups), share)
    tiles = store(with_partner(mixed, prefixes(sets, share), share), "tiles")
    return near.unionByName(known) if first_links else near, label, tile_links(tiles, ["key", "low", "high"], sets, share)


def alike_links(sets: DataFrame, share: tuple[int, int], first_links: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links (u, v) that connect all alike sets of (fp, n, path).

    `first_links` gives links of alike sets that are known before; what they connect is not compared again.
    """
    links, _, more = found_links(sets, share, first_links)
    return links.unionByName(more)


def join_documents(
    docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE, empty_alike: bool = False,
    first_links: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    The component is the smallest key reachable by links between documents whose sets have
    |a and b| / |a or b| >= share; `first_links` as in `alike_links`.
    """
    count = docs.count()
    common = common_shingles(docs, words, count)
    named = store(summaries(docs, words, share, common), "summaries")
    sets = store(in_few_files(named.groupBy("fp").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sure").alias("sure")), count), "sets")
    wanted = store(in_few_files(may_be_alike(sets, shared_counts(named), share), count), "wanted")
    whole = store(whole_sets(docs, wanted, words, common), "paths")
    _, label, more = found_links(whole, share, first_links, count)
    linked = components(store(stars(label).unionByName(more), "links"))
    member = sets.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    # One row per set on the right; adaptive execution splits a set of very many copies.
    found = named.select("doc_id", "fp", "n").join(member.join(least, "component").select("fp", "component_id"), "fp")
    own = F.col("component_id") if empty_alike else F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
