"""Encoding and decoding with a merge-type (BPE) SentencePiece vocabulary.

A text is a row of symbols. An agenda holds its adjacent pairs that form a piece, the best score
first and the leftmost of equal ones; the top is merged and its new neighbours are entered, until the
agenda is empty. Pieces hold the word mark only at their start, so a text falls into chunks that no
merge can cross. Short chunks of a batch are merged side by side, each row of a matrix being the agenda
of one chunk; long ones use a heap. Every new chunk of an Arrow batch is also given to the
sentencepiece library; texts for which it disagrees get the library's ids.

Defined results: a null or empty text has no pieces but begin and end; repeated rows are encoded once
each; a null key is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from matchloom.llm.common import keyed_text, map_rows, sha256

MARK = "▁"
#: Symbols up to which chunks are merged side by side.
SHORT = 40
#: Chunks whose ids a task remembers.
REMEMBERED = 600_000
MASK = (1 << 20) - 1
ABSENT = np.iinfo("int64").max


def read_fields(data: bytes) -> Iterable[tuple[int, int | bytes]]:
    """Field numbers and values of a serialised protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        size = {0: 0, 1: 8, 5: 4}.get(tag & 7)
        if size == 0:
            yield tag >> 3, number()
        else:
            size = number() if size is None else size
            yield tag >> 3, data[at : at + size]
            at += size


class Vocabulary:
    """Pieces of a model file, and for each pair of pieces what it merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = file.read()
        pieces, scores, kinds = [], [], []
        for field, value in read_fields(model):
            if field == 1:
                part = dict(read_fields(value))
                pieces.append(part[1].decode())
                scores.append(struct.unpack("<f", part[2])[0] if 2 in part else 0.0)
                kinds.append(part.get(3, 1))
        plain = {p: i for i, (p, kind) in enumerate(zip(pieces, kinds, strict=True)) if kind == 1}
        if any(kind in (4, 5) for kind in kinds):
            raise ValueError("user-defined and unused pieces are not supported")
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("a piece spans a word boundary")
        self.ids = plain
        self.bytes = [next(i for i, p in enumerate(pieces) if kinds[i] == 6 and p == f"<0x{b:02X}>") for b in range(256)]
        #: Characters that are in no longer piece: chunks end at them.
        inner = set("".join(p for p in plain if len(p) > 1))
        self.breaks_at_newline = "\n" not in inner
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in plain.values()}, reverse=True))}
        self.rank = np.zeros(len(pieces), dtype="int64")
        for i in plain.values():
            self.rank[i] = order[scores[i]]
        pairs = {}
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                a, b = plain.get(piece[:cut]), plain.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = i
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype="int64")
        self.entries = np.array([int(self.rank[pairs[int(k)]]) << 20 | pairs[int(k)] for k in self.keys], dtype="int64")
        self.of_code = np.full(0x110000, -1, dtype="int64")
        for piece, i in plain.items():
            if len(piece) == 1:
                self.of_code[ord(piece)] = i
        self.known = re.compile("[" + "".join(re.escape(p) for p in plain if len(p) == 1) + "]*")

    def entry(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank and piece of each pair as one number, `ABSENT` where it is no piece."""
        keys = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.entries[at], ABSENT)

    def merge_long(self, text: str) -> list[int]:
        """Ids of one chunk by a heap of its pairs; stale entries are skipped."""
        ids = [self.ids.get(c, -1) for c in text]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive, stamp = [True] * n, [0] * n
        agenda: list[tuple] = []

        def enter(left: int, right: int) -> None:
            if left < 0 or right >= n or ids[left] < 0 or ids[right] < 0:
                return
            piece = self.pairs.get(ids[left] << 20 | ids[right])
            if piece is not None:
                heapq.heappush(agenda, (int(self.rank[piece]), left, right, stamp[left], stamp[right], piece))

        for i in range(n - 1):
            enter(i, i + 1)
        while agenda:
            _, left, right, sl, sr, piece = heapq.heappop(agenda)
            if not (alive[left] and alive[right]) or (stamp[left], stamp[right]) != (sl, sr):
                continue
            ids[left], alive[right] = piece, False
            stamp[left] += 1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            enter(before[left], left)
            enter(left, after[left])
        out: list[int] = []
        for i in range(n):
            if alive[i]:
                out += [ids[i]] if ids[i] >= 0 else [self.bytes[b] for b in text[i].encode()]
        return out

    def merge_short(self, texts: list[str]) -> list[bytes]:
        """Ids of chunks of one length: in every round each row merges the top of its agenda.

        An agenda entry is rank and piece in one number, so the least is the best. All rows that are
        left have merged equally often and are equally long. The chunks must hold known characters
        and no two marks in a row (whose pieces share a score).
        """
        out: list[bytes] = [b""] * len(texts)
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").reshape(len(texts), -1)
        ids = self.of_code[codes]
        which = np.arange(len(texts))
        top = self.entry(ids[:, :-1], ids[:, 1:])

        def give(rows: np.ndarray) -> None:
            packed, size = ids[rows].astype("<u4").tobytes(), 4 * ids.shape[1]
            for i, at in enumerate(which[rows].tolist()):
                out[at] = packed[i * size : (i + 1) * size]

        while ids.shape[1] > 1 and len(ids):
            best = top.argmin(axis=1)
            value = top[np.arange(len(top)), best]
            live = value < ABSENT
            if not live.all():
                give(~live)
                ids, top, which, best, value = ids[live], top[live], which[live], best[live], value[live]
            rows, width = np.arange(len(ids)), ids.shape[1]
            ids[rows, best] = value & MASK
            upto = np.arange(width - 1) <= best[:, None]
            ids = np.where(upto, ids[:, :-1], ids[:, 1:])
            top = np.where(upto[:, :-1], top[:, :-1], top[:, 1:])
            if width > 2:
                for at in (best - 1, best):
                    some = rows[(at >= 0) & (at < width - 2)]
                    top[some, at[some]] = self.entry(ids[some, at[some]], ids[some, at[some] + 1])
        give(np.ones(len(ids), bool))
        return out


class Encoder:
    """Encodes texts with a vocabulary, remembering chunks; `library` checks every new chunk."""

    def __init__(self, path: str, check: bool = True):
        import sentencepiece

        self.vocabulary = Vocabulary(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.check = check
        newline = r"\n|" if self.vocabulary.breaks_at_newline else ""
        self.chunk = re.compile(rf"{newline}{MARK}*[^{MARK}{chr(10) if newline else ''}]+|{MARK}+")
        self.known: dict[str, bytes] = {}
        self.doubtful: set[str] = set()

    def learn(self, chunks: list[str]) -> None:
        by_size: dict[int, list[str]] = {}
        found: dict[str, bytes] = {}
        for c in chunks:
            if len(c) <= SHORT and not c.startswith(MARK + MARK) and self.vocabulary.known.fullmatch(c):
                by_size.setdefault(len(c), []).append(c)
            else:
                ids = self.vocabulary.merge_long(c)
                found[c] = struct.pack(f"<{len(ids)}I", *ids)
        for same in by_size.values():
            found.update(zip(same, self.vocabulary.merge_short(same), strict=True))
        if self.check:
            self.compare(found)
        self.known.update(found)

    def compare(self, found: dict[str, bytes]) -> None:
        """Enters chunks as doubtful that the library encodes otherwise.

        A chunk without a word mark follows a newline here, whose two ids are cut off again.
        """
        for marked in (True, False):
            same = [c for c in found if c.startswith(MARK) is marked and c != MARK]
            want = self.library.encode([c[1:] for c in same] if marked else ["\n" + c for c in same], num_threads=1)
            want = want if marked else [w[2:] for w in want]
            flat = np.fromiter(chain.from_iterable(want), "<u4").tobytes()
            sizes = [4 * len(w) for w in want]
            if flat == b"".join(map(found.__getitem__, same)) and sizes == [len(found[c]) for c in same]:
                continue
            self.doubtful.update(c for c, w in zip(same, want, strict=True) if found[c] != struct.pack(f"<{len(w)}I", *w))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, without begin and end."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
            self.doubtful.clear()
        split = [self.chunk.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        fresh = set().union(*split).difference(self.known)
        if fresh:
            self.learn(list(fresh))
        get = self.known.__getitem__
        out = [b"".join(map(get, chunks)) for chunks in split]
        if self.doubtful:
            for i, chunks in enumerate(split):
                if not self.doubtful.isdisjoint(chunks):
                    out[i] = np.array(self.library.encode(texts[i]), dtype="<u4").tobytes()
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: Callable[[], str] = default_model, check: bool = True) -> DataFrame:
    """(doc_id, ids) with begin and end ids for each whole text."""

    def make():
        encoder = Encoder(model(), check)
        begin, end = encoder.library.bos_id(), encoder.library.eos_id()

        def work(keys, texts):
            for key, ids in zip(keys, encoder.encode(texts), strict=True):
                yield key, [begin, *np.frombuffer(ids, "<u4").tolist(), end]

        return work

    return map_rows(keyed_text(docs), "doc_id long, ids array<int>", make)


def digests(docs: DataFrame, model: Callable[[], str] = default_model, check: bool = True) -> DataFrame:
    """Per document: how many ids, a digest of them, and one of the text they decode to."""

    def make():
        encoder = Encoder(model(), check)
        begin, end = encoder.library.bos_id(), encoder.library.eos_id()
        first, last = struct.pack("<I", begin), struct.pack("<I", end)

        def work(keys, texts):
            for key, inner in zip(keys, encoder.encode(texts), strict=True):
                ids = first + inner + last
                text = encoder.library.decode(np.frombuffer(ids, "<u4").tolist())
                yield key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), sha256(text)

        return work

    return map_rows(keyed_text(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
