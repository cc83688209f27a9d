"""Fill-in-middle documents as piece tables.

A document is never edited. It is a list of descriptors (buffer, start, end) over two buffers that don't
change: its text, and the sentinels. Cutting splits a descriptor; an arrangement is a permutation of the
parts with a sentinel before each; the inverse permutation of the parts of an output restores the text.
Hashes are fed descriptor by descriptor.

Defined results: a null text is empty, and an empty one plain, as are texts that hold a sentinel; a null
key is drawn as the empty key; repeated rows are all kept, each with the same result; an empty table gives
an empty result; other columns are ignored. Each text is handled whole, in one pass without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import keyed_text, map_rows

#: A token is a word with the white space before it, or white space at the end of the text.
TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: The sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
PREFIX, SUFFIX, MIDDLE = range(3)
#: In which order a form has the parts. Their places in the text are prefix, middle, suffix.
ARRANGEMENTS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
IN_TEXT = (PREFIX, MIDDLE, SUFFIX)
#: Percent of documents transformed, and of these in the form spm.
RATE, SPM_RATE = 50, 80


class Piece(NamedTuple):
    """Characters start to end of a buffer."""

    buffer: int
    start: int
    end: int


def cut(piece: Piece, at: Iterable[int]) -> list[Piece]:
    """A piece split at ascending places of its buffer."""
    places = [piece.start, *at, piece.end]
    return [Piece(piece.buffer, s, e) for s, e in zip(places, places[1:], strict=False)]


def spans(buffers: tuple[str, ...], pieces: Iterable[Piece]) -> Iterable[str]:
    return (buffers[p.buffer][p.start : p.end] for p in pieces)


def stream_sha256(buffers: tuple[str, ...], pieces: Iterable[Piece]) -> str:
    digest = hashlib.sha256()
    for part in spans(buffers, pieces):
        digest.update(part.encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


class Draw(NamedTuple):
    """The numbers that decide about a document."""

    first: int
    second: int
    transformed: bool
    form: str


def draw(key: int | None, seed: int, rate: int, spm_rate: int) -> Draw:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    return Draw(h[0], h[1], h[2] % 100 < rate, "spm" if h[3] % 100 < spm_rate else "psm")


def sentinel_pieces(sentinels: tuple[str, str, str]) -> list[Piece]:
    places = [0, len(sentinels[0]), len(sentinels[0]) + len(sentinels[1]), sum(map(len, sentinels))]
    return [Piece(1, s, e) for s, e in zip(places, places[1:], strict=False)]


def arrange(parts: dict[int, Piece], form: str, sentinels: tuple[str, str, str]) -> list[Piece]:
    """The parts in the order of a form, each after its sentinel."""
    marks = sentinel_pieces(sentinels)
    return [p for part in ARRANGEMENTS[form] for p in (marks[part], parts[part])]


def restored_pieces(output: str, form: str, sentinels: tuple[str, str, str] = SENTINELS) -> list[Piece]:
    """Pieces of an output, in the order of the text it was made of."""
    if form == "plain":
        return [Piece(0, 0, len(output))]
    parts, at = {}, 0
    order = ARRANGEMENTS[form]
    for part, after in zip(order, [*order[1:], None], strict=True):
        start = at + len(sentinels[part])
        at = len(output) if after is None else output.index(sentinels[after], start)
        parts[part] = Piece(0, start, at)
    return [parts[p] for p in IN_TEXT]


class Made(NamedTuple):
    n: int
    form: str
    prefix: int | None
    middle: int | None
    pieces: list[Piece]


def transformed(key: int | None, text: str, seed: int, rate: int, spm_rate: int, sentinels: tuple[str, str, str]) -> Made:
    """The piece table of a document's output over (text, all sentinels)."""
    ends = [0, *(m.end() for m in TOKEN.finditer(text))]
    n = len(ends) - 1
    chance = draw(key, seed, rate, spm_rate)
    whole = Piece(0, 0, len(text))
    if not text or not chance.transformed or any(s in text for s in sentinels):
        return Made(n, "plain", None, None, [whole])
    cuts = sorted((chance.first % (n + 1), chance.second % (n + 1)))
    parts = dict(zip(IN_TEXT, cut(whole, [ends[c] for c in cuts]), strict=True))
    size = lambda p: parts[p].end - parts[p].start
    return Made(n, chance.form, size(PREFIX), size(MIDDLE), arrange(parts, chance.form, sentinels))


def transform(docs: DataFrame, seed: int = 42, rate: int = RATE, spm_rate: int = SPM_RATE, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the documents to train on."""

    def make():
        def work(keys, texts):
            for key, text in zip(keys, texts, strict=True):
                made = transformed(key, text, seed, rate, spm_rate, sentinels)
                yield key, made.n, made.form, made.prefix, made.middle, "".join(spans((text, "".join(sentinels)), made.pieces))

        return work

    return map_rows(keyed_text(docs), "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string", make)


def restore(outputs: DataFrame, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, text) from (doc_id, form, output)."""

    def make():
        def work(keys, rows):
            for key, row in zip(keys, rows, strict=True):
                yield key, "".join(spans((row["output"],), restored_pieces(row["output"], row["form"], sentinels)))

        return work

    return map_rows(outputs.select("doc_id", F.struct("form", "output").alias("row")), "doc_id long, text string", make)


def digests(docs: DataFrame, seed: int = 42, rate: int = RATE, spm_rate: int = SPM_RATE, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every document.

    The second hash is that of the text as rebuilt from nothing but output and form.
    """

    def make():
        marks = "".join(sentinels)

        def work(keys, texts):
            for key, text in zip(keys, texts, strict=True):
                made = transformed(key, text, seed, rate, spm_rate, sentinels)
                buffers = (text, marks)
                output = "".join(spans(buffers, made.pieces))
                back = stream_sha256((output,), restored_pieces(output, made.form, sentinels))
                yield key, made.n, made.form, made.prefix, made.middle, stream_sha256(buffers, made.pieces), back

        return work

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return map_rows(keyed_text(docs), schema, make)
