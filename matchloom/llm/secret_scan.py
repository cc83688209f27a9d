"""Secrets in texts: fixed patterns, and Shannon entropy in windows sliding over candidate strings.

A candidate is a run of token characters. Its longest stretches of each character class (hexadecimal in
either case, letters and digits, all of base64) are looked at on their own: a window of fixed width slides
along each; counts of characters are updated by the one that enters and the one that leaves, so a step costs
the same for any width. Windows above the entropy limit of their class are joined to spans. An allow list
suppresses candidates, and stretches, that are known to be harmless.

Defined results: a null or empty text has no spans; repeated rows are scanned once each; a null key is
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from matchloom.llm.common import Spans, keyed_text, map_rows, sha256, span_text

#: The kinds and their patterns.
KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
STRETCHES = {"hex": re.compile("[0-9a-fA-F]+"), "alnum": re.compile("[A-Za-z0-9]+"), "base64": re.compile("[A-Za-z0-9+/_=-]+")}
#: Which texts need a closer look; found by a linear-time scan of a whole batch.
HINT = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}|[A-Za-z0-9+/_=-]{20}"


@dataclass(frozen=True)
class Scanner:
    """width: characters in a window; limits: least entropy in bits, by class.

    `allowed`: patterns of whole candidates that are no secrets.
    """

    width: int = 20
    limits: dict[str, float] = field(default_factory=lambda: {"hex": 3.0, "alnum": 3.6, "base64": 3.6})
    allowed: tuple[str, ...] = (
        r"[A-Za-z_/=+-]+",  # words, paths and rules
        r"[0-9_/=+-]+",  # numbers and dates
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # identifiers made to be public
        r"(?P<one>.)(?P=one)*",  # filling
        r"[a-z0-9]+([-_/][a-z0-9]+){3,}",  # slugs
    )


def entropies(text: str, width: int) -> list[float]:
    """Shannon entropy in bits of each window, from counts that change by two characters a step."""
    if len(text) < width:
        return []
    part = [0.0] + [c / width * math.log2(c / width) for c in range(1, width + 1)]
    counts: dict[str, int] = {}
    for ch in text[:width]:
        counts[ch] = counts.get(ch, 0) + 1
    total = sum(part[c] for c in counts.values())
    found = [-total]
    for old, new in zip(text, text[width:], strict=False):
        if old != new:
            c = counts[old]
            total += part[c - 1] - part[c]
            counts[old] = c - 1
            c = counts.get(new, 0)
            total += part[c + 1] - part[c]
            counts[new] = c + 1
        found.append(-total)
    return found


def entropy_spans(text: str, scanner: Scanner, allow: re.Pattern) -> list[tuple[str, int, int]]:
    def harmless(part: str) -> bool:
        return bool(allow.fullmatch(part)) or not (any(c.isdigit() for c in part) and any(c.isalpha() for c in part))

    windows = []
    for m in CANDIDATE.finditer(text):
        if harmless(m.group()):
            continue
        for kind, stretch in STRETCHES.items():
            for part in stretch.finditer(m.group()):
                if len(part.group()) < scanner.width or harmless(part.group()):
                    continue
                at = m.start() + part.start()
                windows += [at + i for i, bits in enumerate(entropies(part.group(), scanner.width)) if bits >= scanner.limits[kind]]
    spans: list[tuple[str, int, int]] = []
    for start in sorted(windows):
        if spans and start <= spans[-1][2]:
            spans[-1] = ("entropy", spans[-1][1], start + scanner.width)
        else:
            spans.append(("entropy", start, start + scanner.width))
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def scan_text(text: str, scanner: Scanner, allow: re.Pattern) -> tuple[list, list]:
    """Spans of the fixed patterns, and all spans; added ones that touch a fixed one are left out."""
    base = base_spans(text)
    taken = Spans(base)
    added = [s for s in entropy_spans(text, scanner, allow) if not taken.meet(s[1], s[2])]
    return base, base + added


def scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """For each document: counts of the fixed patterns, a digest of their spans, and all spans."""
    scanner = scanner or Scanner()

    def make():
        allow = re.compile("|".join(f"(?:{p})" for p in scanner.allowed) if scanner.allowed else r"(?!)")
        nothing = (0, 0, 0, sha256(""), "")

        def work(keys, texts):
            hints = pc.match_substring_regex(pa.array(texts, pa.large_string()), HINT).to_pylist()
            for key, text, hint in zip(keys, texts, hints, strict=True):
                if not hint:
                    yield (key, *nothing)
                    continue
                base, spans = scan_text(text, scanner, allow)
                n = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
                yield (key, *n, sha256(span_text(base, KINDS)), span_text(spans, KINDS))

        return work

    return map_rows(keyed_text(docs), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", make)


def redact(text: str, spans: str, mark: str = "<secret>") -> str:
    """The text with every listed span replaced; overlapping spans count as one."""
    found = sorted((int(s), int(e)) for s, e in (x.split(":")[1:] for x in spans.split(",") if x))
    out, at = [], 0
    for start, end in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
