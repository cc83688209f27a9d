"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of `SHARE` or more.

Sets with close SimHash fingerprints are found by the generalised pigeonhole principle, as in `simhash`, and each
such pair is checked on the whole sets. Fingerprints miss most pairs near the least similarity, so what they leave
apart goes through `ngram_join`, which misses none and compares nothing again that they have linked.

Defined results: words are as in `simhash`; fewer words than a shingle are one shingle; texts without words
have the empty set and are alike; of repeated rows and keys, see `simhash.keep_least`; an empty table
gives an empty one; other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import ROWS_AT_ONCE
from matchloom.llm.ngram_join import LAST, LINKS, join_documents
from matchloom.llm.simhash import keep_least, majority, near_links
from matchloom.session import store

WORDS = 5
#: Least similarity, as a fraction.
SHARE = (4, 5)
#: Bits in which the fingerprints of a pair may differ.
DISTANCE = 3


def set_fingerprints(sets: DataFrame) -> DataFrame:
    """(name, print): the SimHash fingerprint of each set of (fp, n, path), over the 63 bits of its hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([majority((np.frombuffer(x.as_buffer(), "<u8") & ~LAST) << np.uint64(1)) for x in batch["path"]], "u8")
            yield pa.RecordBatch.from_arrays([batch["fp"], pa.array(found.view("i8"))], names=["name", "print"])

    return sets.select("fp", "path").mapInArrow(run, "name long, print long")


def alike_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of sets whose similarity is `SHARE` or more."""
    num, den = SHARE

    def alike(a: pa.Scalar, b: pa.Scalar) -> bool:
        x, y = (np.frombuffer(p.as_buffer(), "<u8") for p in (a, b))
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both * den >= (len(x) + len(y) - both) * num

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield part.select(["u", "v"]).filter(pa.array([alike(a, b) for a, b in zip(part["a"], part["b"], strict=True)], pa.bool_()))

    named = pairs.join(sets.select(F.col("fp").alias("u"), F.col("path").alias("a")), "u")
    return named.join(sets.select(F.col("fp").alias("v"), F.col("path").alias("b")), "v").select("u", "v", "a", "b").mapInArrow(run, LINKS)


def fingerprint_links(sets: DataFrame) -> DataFrame:
    """Links (u, v) between sets of (fp, n, path) that are alike and whose fingerprints are equal or close."""
    prints = store(set_fingerprints(sets), "set-fingerprints")
    first = store(prints.groupBy("print").agg(F.min("name").alias("least")), "prints")
    equal = prints.join(first, "print").filter("name != least").select(F.col("name").alias("u"), F.col("least").alias("v"))
    close = near_links(first.select(F.col("print").alias("fp")), DISTANCE)
    for end in ("u", "v"):
        close = close.join(first.select(F.col("print").alias(end), F.col("least").alias(f"_{end}")), end)
    close = close.select(F.col("_u").alias("u"), F.col("_v").alias("v"))
    return alike_pairs(equal.unionByName(close).distinct(), sets)


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every document; the component is its smallest key that is not null."""
    return join_documents(docs, WORDS, SHARE, empty_alike=True, first_links=fingerprint_links).select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but one of each component, with their columns."""
    return keep_least(docs, near_copies(docs))
