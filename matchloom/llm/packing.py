"""Packing of tokenised documents into windows of a fixed capacity by minimum bin slack.

A document is cut into full windows and one remainder. Which remainders share a window depends on
their lengths alone, and there are at most `capacity` different ones, so the plan is made from the
counts of lengths: a table of bounded size whatever the corpus. For each window the longest
remaining length is fixed, and a bitset subset-sum over the remaining multiset finds the lengths that
come closest to the capacity; backtracking gives how often each is used. The window is repeated until
one of its lengths runs out, so every pattern uses up a length and the plan stays small too. Pieces
then take their place by their rank among the pieces of their length.

Defined results: a null or empty text is the end token alone; repeated rows are packed once each; a
null key is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import keyed_text, to_arrow
from matchloom.session import store

CAPACITY = 2048
END_ID = 1
#: Pieces ranked by one task of the ranking step.
ROWS_PER_BUCKET = 100_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, number long"


def byte_bpe(json_path: str, ranks_path: str | None = None) -> Callable[[str], np.ndarray]:
    """An encoder for the byte-level BPE vocabulary in `json_path`.

    `ranks_path` holds the same vocabulary as merge ranks; the faster library that reads it gives the
    same ids (tested) where a text holds none of the added tokens of the first file. A text with one, or
    one that the library refuses, is encoded from the first file, with the defaults of its library.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held: list = []

    def plain(text: str) -> np.ndarray:
        if not held:
            from tokenizers import Tokenizer

            held.append(Tokenizer.from_file(json_path))
        return np.asarray(held[0].encode(text, add_special_tokens=False).ids, dtype="<u4")

    if ranks_path is None:
        return plain

    import base64
    import json
    import re

    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    with open(json_path, encoding="utf-8") as file:
        added = [t["content"] for t in json.load(file)["added_tokens"]]
    holds_added = re.compile("|".join(map(re.escape, added)) if added else r"(?!)").search

    def encode(text: str) -> np.ndarray:
        if holds_added(text):
            return plain(text)
        try:
            return fast.encode_to_numpy(text)
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # the library's panics are no Exceptions
            return plain(text)

    return encode


def default_encoder() -> Callable[[str], np.ndarray]:
    import public_tokenizers

    return byte_bpe(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cut_documents(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, encoder: Callable = default_encoder, with_ids: bool = False
) -> DataFrame:
    """One row per piece: full windows and a remainder of each document, with their ids if asked for.

    (part, number) names a piece within one run of this job; store the result before using it twice.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    target = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part, number = encoder(), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.concatenate([np.asarray(encode(text.as_py()), dtype="<u4"), end])
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    row = (doc_id.as_py(), start, len(piece), zlib.crc32(piece.tobytes()), len(ids), part, number)
                    rows.append((*row, piece.astype("int32")) if with_ids else row)
                    number += 1
            columns = list(zip(*rows, strict=True)) or [()] * len(target)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return keyed_text(docs).mapInArrow(run, schema)


def fill_window(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths whose sum comes closest to `room` without passing it.

    Bit s of a set says that the sum s can be reached. A length that is available c times enters as
    1, 2, 4, ... copies. The sets before each step are kept, so the way back gives the counts.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            used = min(copies, left)
            steps.append((reach, length, used))
            reach |= (reach << (length * used)) & mask
            left, copies = left - used, copies * 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    found: dict[int, int] = {}
    for before, length, used in reversed(steps):
        if not before >> best & 1:
            best -= length * used
            found[length] = found.get(length, 0) + used
    return found


@dataclass
class Plan:
    """Where pieces go: one entry per pattern and length, ordered by (length, first rank)."""

    length: np.ndarray
    first_rank: np.ndarray
    first_window: np.ndarray
    repeats: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window and offset of the piece with this rank among the pieces of its length."""
        bits = 44
        keys = (self.length << bits) | self.first_rank
        at = np.searchsorted(keys, (length << bits) | rank, side="right") - 1
        within = rank - self.first_rank[at]
        copy, window = within // self.repeats[at], within % self.repeats[at]
        return self.first_window[at] + window, self.offset[at] + copy * length


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Minimum-bin-slack patterns for a table of lengths and how often each occurs."""
    left = {k: v for k, v in counts.items() if v}
    ranks = dict.fromkeys(left, 0)
    window, rows = 0, []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = fill_window(left, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        repeats = min(left[k] // n for k, n in pattern.items())
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append((length, ranks[length], window, repeats, offset))
            offset += length * n
            ranks[length] += n * repeats
            left[length] -= n * repeats
            if not left[length]:
                del left[length]
        window += repeats
    columns = np.array(sorted(rows), dtype="int64").reshape(-1, 5).T
    return Plan(*columns)


def rank_by_length(pieces: DataFrame, counts: dict[int, int], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Adds `rank`, 0 to n - 1 among the pieces of the same length.

    Pieces of a common length are dealt over buckets; a bucket starts where the ones before it end.
    """
    buckets = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(rows_per_bucket))).cast("long")
    sizes = pieces.sparkSession.createDataFrame(sorted(counts.items()) or [(0, 0)], "length long, _n long")
    dealt = pieces.join(F.broadcast(sizes), "length")  # at most one row per length up to the capacity
    dealt = dealt.withColumn("_bucket", F.pmod(F.xxhash64("part", "number"), buckets))
    ahead = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("part", "number")) - 1
    return dealt.withColumn("_within", within).join(starts, ["length", "_bucket"]).withColumn("rank", F.col("_first") + F.col("_within")).drop("_n", "_bucket", "_first", "_within")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, encoder: Callable = default_encoder, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with `sequence_id` and `offset`; the ids of each piece if asked for."""
    pieces = store(cut_documents(docs, capacity, end_id, encoder, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = plan_windows(counts, capacity)
    ranked = rank_by_length(pieces, counts)
    schema = ", ".join(f"{n} {t}" for n, t in ranked.dtypes if n not in ("part", "number", "rank")) + ", sequence_id long, offset long"
    kept = [n for n in ranked.columns if n not in ("part", "number", "rank")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            window, offset = plan.place(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in kept), pa.array(window), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id and ids, from pieces packed with their ids.

    A window holds at most `capacity` ids, so a group is small.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: windows, ids and padding, where a window whose length is a power of two is not padded."""
    lengths = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    padded = F.when(F.expr("(n & (n - 1)) = 0"), 0).otherwise(F.lit(capacity) - F.col("n"))
    return lengths.agg(F.count("*").alias("windows"), F.sum("n").alias("ids"), F.sum(padded).alias("padding"))
