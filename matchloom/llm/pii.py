"""Personal data in texts: fixed patterns, and spans found by a BiLSTM-CRF over characters.

The tagger is trained in numpy from labelled spans: those of the fixed patterns in a bounded sample of
the documents, and copies of them in other spellings (phone numbers without their country code, cards
with other separators). Texts are decoded in windows that overlap by half. A span that a window cuts off is
left to its neighbour, and all candidates of a text are then reconciled together: the set of spans that do
not overlap with the greatest total of log odds wins. Added spans must still satisfy the plain checks of
their kind and keep clear of the fixed ones.

All kinds hold a digit or an at sign, so windows without either cannot hold a span and need no
decoding; every such window of every text is decoded.

Defined results: a null or empty text has no spans; repeated rows are scanned once each; a null key is
kept; without labelled spans nothing is added; an empty table gives an empty result; other columns are
ignored, or kept by `redact_documents`.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import Spans, keeps_columns, keyed_text, map_rows, sha256, span_text, with_column
from matchloom.llm.tagger import Tagger
from matchloom.session import store

#: Kinds and patterns of the contract. A pattern of digits starts at a run's start,
#: since it fails from within a run if it fails from there.
KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]+")

WIDTH, STRIDE, MARGIN = 64, 32, 24
#: Documents and windows that the tagger is trained on, at most.
SAMPLE_DOCUMENTS = 6000
SAMPLE_WINDOWS = 1600
WINDOWS_AT_ONCE = 256
OUTSIDE = 0
TAGS = 1 + 2 * len(KINDS)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SYMBOLS = 8 + len(PUNCTUATION)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def email_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost matches, found from each at sign: back over the name, then on over the domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield "email", start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = list(email_spans(text))
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    spans += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(d := digits(m)) <= 19 and luhn(d)]
    return spans + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def plausible(kind: str, found: str) -> bool:
    """The plain check of an added span."""
    digits = re.sub("[^0-9]", "", found)
    if kind == "email":
        return bool(re.fullmatch(r"[^\s@]+@[^\s@]+\.[^\s@]+", found))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", found)) and all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return bool(re.fullmatch(r"[0-9][0-9 ./-]*[0-9]", found)) and 12 <= len(digits) <= 19 and luhn(digits)
    return bool(re.fullmatch(r"[+(]?[0-9][0-9 ()./-]*[0-9]", found)) and 9 <= len(digits) <= 15 and bool(re.search(r"[ ()-]", found))


def taught_spans(text: str) -> list[tuple[str, int, int]]:
    """What the tagger is shown: the fixed spans, and numbers as long as cards whose check digit is
    wrong. It cannot compute a check digit; `plausible` does."""
    cards = [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(re.sub("[^0-9]", "", m.group())) <= 19]
    return [s for s in base_spans(text) if s[0] != "card"] + cards


# ---------------------------------------------------------------- windows and tags

CODES = {c: 8 + i for i, c in enumerate(PUNCTUATION)}


def symbol(ch: str) -> int:
    """A small alphabet: digits, letters by case, spaces, and each sign."""
    if "0" <= ch <= "9":
        return 1
    if "a" <= ch <= "z":
        return 2
    if "A" <= ch <= "Z":
        return 3
    if ch == "\n":
        return 4
    if ch.isspace():
        return 5
    return CODES.get(ch) or (6 if ch.isalpha() else 7)


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Overlapping windows over all stretches around triggers, as (start, end)."""
    stretch: list[int] | None = None
    for m in TRIGGER.finditer(text):
        start, end = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if stretch and start <= stretch[1]:
            stretch[1] = end
            continue
        if stretch:
            yield from _cover(*stretch)
        stretch = [start, end]
    if stretch:
        yield from _cover(*stretch)


def _cover(start: int, end: int) -> Iterator[tuple[int, int]]:
    at = start
    while True:
        yield at, min(at + WIDTH, end)
        if at + WIDTH >= end:
            return
        at += STRIDE


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    ids, mask = np.zeros((len(texts), WIDTH), "i4"), np.zeros((len(texts), WIDTH), bool)
    for i, t in enumerate(texts):
        ids[i, : len(t)] = [symbol(c) for c in t]
        mask[i, : len(t)] = True
    return ids, mask


def tag(text: str, spans: list[tuple[str, int, int]]) -> list[int]:
    tags = [OUTSIDE] * len(text)
    for kind, start, end in spans:
        first = 1 + 2 * KINDS.index(kind)
        if not any(tags[start:end]):
            tags[start:end] = [first] + [first + 1] * (end - start - 1)
    return tags


def untag(tags: list[int]) -> Iterator[tuple[str, int, int]]:
    start, kind = 0, None
    for i, t in enumerate([*tags, OUTSIDE]):
        goes_on = kind is not None and t == 2 + 2 * kind
        if kind is not None and not goes_on:
            yield KINDS[kind], start, i
            kind = None
        if t % 2:
            start, kind = i, t // 2


def respell(kind: str, found: str, rng: random.Random) -> str | None:
    """Another spelling of a labelled span, which the fixed patterns do not cover."""
    if kind == "phone":
        short = re.sub(r"^\+[0-9]{1,3}[\x20.-]*", "", found)
        return short if len(re.sub("[^0-9]", "", short)) >= 9 else None
    if kind == "card" and found.isdigit() and len(found) == 16:
        return rng.choice("./").join(found[i : i + 4] for i in range(0, 16, 4))
    return None


def labelled_windows(text: str, seed: int) -> Iterator[tuple[str, list[int]]]:
    """Windows of a text with their tags, and of the same text in other spellings."""
    rng, spans = random.Random(seed), sorted(taught_spans(text), key=lambda s: (s[1], s[0]))
    versions = [(text, spans)]
    other, moved, at, changed = [], [], 0, False
    for kind, start, end in spans:
        if start < at:
            continue
        other.append(text[at:start])
        new = respell(kind, text[start:end], rng)
        changed |= new is not None
        new = text[start:end] if new is None else new
        begin = sum(map(len, other))
        moved.append((kind, begin, begin + len(new)))
        other.append(new)
        at = end
    if changed:
        versions.append(("".join([*other, text[at:]]), moved))
    for body, found in versions:
        tags = tag(body, found)
        for start, end in windows(body):
            yield body[start:end], tags[start:end]


def reconcile(candidates: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int]]:
    """The spans without overlaps whose scores add up to the most, over a whole text."""
    best: dict[tuple[str, int, int], float] = {}
    for kind, start, end, score in candidates:
        best[kind, start, end] = max(score, best.get((kind, start, end), 0.0))
    spans = sorted(best, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    total, take = [0.0], []
    for i, s in enumerate(spans):
        free = bisect_right(ends, s[1], 0, i)
        take.append((total[free] + best[s] > total[i], free))
        total.append(max(total[i], total[free] + best[s]))
    chosen, i = [], len(spans)
    while i:
        taken, free = take[i - 1]
        if taken:
            chosen.append(spans[i - 1])
        i = free if taken else i - 1
    return chosen[::-1]


# ---------------------------------------------------------------- model


@dataclass
class Finder:
    """Fixed patterns and, if there is one, a trained tagger."""

    tagger: Tagger | None = None

    def candidates(self, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        """Spans of all windows of each text with their scores; cut ones are left to a neighbour."""
        found: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
        held: list[tuple[int, int, int]] = []

        def decode() -> None:
            tags, odds = self.tagger.decode(*encode([texts[i][s:e] for i, s, e in held]))
            for (i, start, end), row, sure in zip(held, tags.tolist(), odds, strict=True):
                for kind, s, e in untag(row[: end - start]):
                    cut = (s == 0 and start > 0) or (e == end - start and end < len(texts[i]))
                    if not cut:
                        found[i].append((kind, start + s, start + e, float(max(0.0, sure[s:e].sum()))))
            held.clear()

        for i, text in enumerate(texts):
            for start, end in windows(text):
                held.append((i, start, end))
                if len(held) == WINDOWS_AT_ONCE:
                    decode()
        if held:
            decode()
        return found

    def spans(self, texts: list[str]) -> list[tuple[list, list]]:
        """For each text the spans of the fixed patterns, and all spans."""
        hints = pc.match_substring_regex(pa.array(texts, pa.large_string()), "[0-9@]").to_pylist()
        near = [t if h else "" for t, h in zip(texts, hints, strict=True)]
        added = self.candidates(near) if self.tagger else [[] for _ in texts]
        out = []
        for text, more in zip(near, added, strict=True):
            base = base_spans(text) if text else []
            extra, taken = [], Spans(base)
            for kind, s, e in reconcile(more):
                alone = not (text[s - 1 : s].isalnum() or text[e : e + 1].isalnum())
                if alone and plausible(kind, text[s:e]) and not taken.meet(s, e):
                    extra.append((kind, s, e))
            out.append((base, base + extra))
        return out


def train(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, most: int = SAMPLE_WINDOWS, epochs: int = 6) -> Finder:
    """A finder whose tagger is trained on windows of a sample of the documents, chosen by hash."""
    texts = keyed_text(docs)
    chosen = store(texts.filter("doc_id IS NOT NULL").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents), "sample")
    near = texts.join(F.broadcast(chosen.distinct()), "doc_id").filter(F.col("text").rlike("[0-9@]"))

    def make():
        def work(keys, bodies):
            for key, body in zip(keys, bodies, strict=True):
                for n, (part, tags) in enumerate(labelled_windows(body, key)):
                    yield key, n, part, tags, any(tags)

        return work

    rows = map_rows(near, "doc_id long, n long, part string, tags array<int>, filled boolean", make)
    rows = store(rows, "labelled-windows")
    half = lambda filled, n: rows.filter(F.col("filled") == filled).orderBy(F.xxhash64("doc_id", "n"), "doc_id", "n").limit(n).collect()
    some = half(True, most * 3 // 4) + half(False, most // 4)
    if not any(r["filled"] for r in some):
        return Finder()
    ids, mask = encode([r["part"] for r in some])
    tags = np.zeros_like(ids)
    for i, r in enumerate(some):
        tags[i, : len(r["tags"])] = r["tags"]
    tagger = Tagger(SYMBOLS, TAGS)
    tagger.fit(ids, mask, tags, epochs=epochs * max(1, min(6, 1200 // len(some))))
    return Finder(tagger)


def find(docs: DataFrame, finder: Finder) -> DataFrame:
    """For each document counts of the fixed patterns, a digest of their spans, and all spans."""

    def make():
        nothing = (0, 0, 0, 0, sha256(""), "")

        def work(keys, texts):
            for key, (base, spans) in zip(keys, finder.spans(texts), strict=True):
                if not spans:
                    yield (key, *nothing)
                    continue
                n = [sum(s[0] == kind for s in base) for kind in KINDS]
                yield (key, *n, sha256(span_text(base, KINDS)), span_text(spans, KINDS))

        return work

    return map_rows(keyed_text(docs), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", make)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; where spans overlap, the first one's."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


@keeps_columns
def redact_documents(docs: DataFrame, finder: Finder) -> DataFrame:
    """All documents with their columns, personal data in their texts replaced; null texts stay null."""

    def make():
        return lambda texts: [redact(t, spans) if spans else t for t, (_, spans) in zip(texts, finder.spans(texts), strict=True)]

    found = with_column(docs, "text", "__text", "string", make)
    new = F.when(F.col("text").isNotNull(), F.col("__text"))
    columns = {"text": new} | ({"n_chars": F.length(new).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return found.select(*((columns[c].alias(c) if c in columns else F.col(f"`{c}`")) for c in docs.columns))
