"""Text cleaning: names, numbers written as text, column names."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Sequence
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.binding import once
from matchloom.functions.fixed_values import (
    NOISE_WORDS,
    SCORE_PATTERN,
    SPECIAL_PREFIXES,
    STAT_PAIR_PATTERN,
    WHITESPACE,
)

_HYPHENS = "".join(map(chr, range(0x2010, 0x2016)))
# Code points looked up together.
_CODES = 64
_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


@lru_cache(maxsize=1)
def _ascii_letters() -> tuple[str, str, dict[str, str]]:
    """Non-ASCII characters with an ASCII form: those of one letter with it, and the longer forms."""
    plain = {
        char: unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode("ascii")
        for char in map(chr, range(0x80, 0x20000))
    }
    single = {char: text for char, text in plain.items() if len(text) == 1}
    return "".join(single), "".join(single.values()), {char: text for char, text in plain.items() if len(text) > 1}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: Column | str, hyphens: bool = False) -> Column:
    """Letters without their accents; what has no ASCII form is dropped.

    Characters of one letter are translated in one pass. What is left of other alphabets, ligatures,
    fractions and the like is looked up by code point, at the same cost for each of them.
    With `hyphens`, typographic hyphens become "-" instead of vanishing.
    """
    source, target, longer = _ascii_letters()
    rows: list[dict[str, str] | None] = [None] * (0x20000 // _CODES)
    for char, form in longer.items():
        row = ord(char) // _CODES
        rows[row] = (rows[row] or {}) | {char: form}
    # Folded into a constant when the query is planned. Its maps are small, since a map is searched from its start.
    forms = F.from_json(F.lit(json.dumps(rows)), "array<map<string,string>>")
    if hyphens:
        kept = [(s, t) for s, t in zip(source, target) if s not in _HYPHENS]
        source = "".join(s for s, _ in kept) + _HYPHENS
        target = "".join(t for _, t in kept) + "-" * len(_HYPHENS)
    is_ascii = lambda text: F.octet_length(text) == F.length(text)

    def form(part: Column) -> Column:
        known = F.element_at(F.get(forms, (F.ascii(part) / _CODES).cast("int")), part)
        return F.when(is_ascii(part), part).otherwise(F.coalesce(known, F.lit("")))

    def spelled_out(text: Column) -> Column:
        parts = F.regexp_extract_all(text, F.lit(r"[\x00-\x7F]++|[^\x00-\x7F]"), F.lit(0))
        return F.when(is_ascii(text), text).otherwise(F.array_join(F.transform(parts, form), ""))

    return once(c, lambda text: F.when(is_ascii(text), text).otherwise(once(F.translate(text, source, target), spelled_out)))


@F.arrow_udf(T.StringType())
def strip_accents_exact(texts: pa.Array) -> pa.Array:
    """The yardstick of `strip_accents`, on Arrow batches.

    Only one text of a batch is a Python string at a time; the plain bytes of all become the result.
    """
    plain, ends, missing = bytearray(), array("q", [0]), []
    for text in texts:
        value = text.as_py()
        missing.append(value is None)
        if value is not None:
            plain += value.encode() if value.isascii() else unicodedata.normalize("NFKD", value).encode("ascii", "ignore")
        ends.append(len(plain))
    valid = pa.array(missing, pa.bool_())
    known = pc.invert(valid).buffers()[1]
    return pa.LargeStringArray.from_buffers(len(missing), pa.py_buffer(ends), pa.py_buffer(plain), known, sum(missing)).cast(pa.string())


def normalize_text(c: Column | str, hyphens: bool = False) -> Column:
    """Comparison form of a name: no accents, lower case, "-" as space, single spaces; null gives ""."""
    plain = F.replace(F.lower(strip_accents(c, hyphens)), F.lit("-"), F.lit(" "))
    single = F.regexp_replace(plain, r"[\s\x1c-\x1f]+", " ")
    return F.coalesce(F.trim(single), F.lit(""))


def strip_space(c: Column | str) -> Column:
    """Text without white space at either end."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def safe_text(c: Column | str) -> Column:
    """Trimmed text; null gives ""."""
    return F.coalesce(strip_space(c), F.lit(""))


def clean_match_id(c: Column | str) -> Column:
    """Id text without the fraction a float column leaves behind ("123.0" gives "123")."""
    return F.substring_index(safe_text(c), ".", 1)


def to_int(c: Column | str) -> Column:
    """Whole number in a text, cut towards zero; anything else gives null."""
    number = lambda text: F.when(text.rlike(_NUMBER), text.try_cast("double").try_cast("bigint"))
    return once(strip_space(c), number)


def percent_int(c: Column | str) -> Column:
    """Whole number of a percentage such as "44%"."""
    return F.replace(_col(c), F.lit("%"), F.lit("")).try_cast("int")


def is_percent(c: Column | str) -> Column:
    """Whether a text ends in a percent sign; null gives false."""
    return F.coalesce(_col(c).endswith("%"), F.lit(False))


def _numbers(text: Column, pattern: str, first: str, second: str) -> Column:
    """The two whole numbers that a pattern captures, as a struct."""
    number = lambda group: F.regexp_extract(text, pattern, group).try_cast("int")
    return F.struct(number(1).alias(first), number(2).alias(second))


def stat_pair(c: Column | str) -> Column:
    """The numbers of "x of y" as struct(part, total); both null when the text has no such pair."""
    return once(c, lambda text: _numbers(text, STAT_PAIR_PATTERN, "part", "total"))


def score_pair(c: Column | str) -> Column:
    """Goals of a score such as "2–1" as struct(home, away); both null when it is no plain score."""

    def both_or_none(pair: Column) -> Column:
        both = pair["home"].isNotNull() & pair["away"].isNotNull()
        return F.struct(*[F.when(both, pair[side]).alias(side) for side in ("home", "away")])

    return once(once(c, lambda text: _numbers(text, SCORE_PATTERN, "home", "away")), both_or_none)


def strip_prefix(c: Column | str, prefixes: Sequence[str] = SPECIAL_PREFIXES) -> Column:
    """Text without the first of `prefixes` it starts with."""
    alternatives = "|".join(re.escape(p) for p in prefixes)
    return F.regexp_replace(_col(c), f"^(?:{alternatives})", "")


def strip_words(c: Column | str, words: Sequence[str] = NOISE_WORDS, separator: str = "-") -> Column:
    """Text without the run of noise words it starts with; accents and case do not count."""
    sep = re.escape(separator)
    pattern = f"^((?:(?:{'|'.join(re.escape(w) for w in words)})(?:{sep}|$))*+)"

    def stripped(text: Column) -> Column:
        run = F.regexp_extract(F.lower(strip_accents(text)), pattern, 1)
        # The run is counted in words, since dropped characters may change its length.
        n_words = F.size(F.regexp_extract_all(run, F.lit(f"([a-z]+)(?:{sep}|$)"), F.lit(1)))
        rest = once(
            F.split(text, sep),
            lambda parts: F.array_join(F.slice(parts, n_words + 1, F.greatest(F.size(parts), F.lit(1))), separator),
        )
        return F.when(run == "", text).otherwise(rest)

    return once(c, stripped)


def null_if_token(c: Column | str, tokens: Sequence[str]) -> Column:
    """Null where a text is one of the tokens that stand for a missing value."""
    text = _col(c)
    return F.when(~text.isin(*tokens), text)


def snake_case(name: str) -> str:
    """Column name in lower case with "_" between words."""
    spaced = re.sub(r"[\s\-]+", "_", name.strip())
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", spaced).lower()
