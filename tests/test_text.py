import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchloom.functions import text as X


def ascii_of(text):
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def test_strip_accents(values):
    texts = ["Atlético Madrid", "Alavés", "Nürnberg", "Saint‑Étienne", "ø ß plain", "é", "a b", None, ""]
    expected = [None if t is None else ascii_of(t) for t in texts]
    assert values(X.strip_accents, texts) == expected
    assert values(X.strip_accents_exact, texts) == expected


def test_exact_mode_covers_ligatures(values):
    texts = ["ﬁnal ½ ™", "Ǆ…"]
    assert values(X.strip_accents_exact, texts) == [ascii_of(t) for t in texts]
    assert values(X.strip_accents, texts) == [ascii_of(t) for t in texts]
    assert values(X.normalize_text, ["Ǆeko ﬁnal"]) == ["dzeko final"]


def test_every_character_with_an_ascii_form(values):
    texts = ["".join(map(chr, range(at, at + 512))) for at in range(0, 0x20000, 512) if not 0xD800 <= at < 0xE000]
    assert values(X.strip_accents, texts) == [ascii_of(t) for t in texts]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=30), min_size=1, max_size=50))
def test_strip_accents_agrees_with_exact_mode(values, texts):
    assert values(X.strip_accents, texts) == [ascii_of(t) for t in texts]


def test_typographic_hyphens_on_request(values):
    assert values(lambda c: X.strip_accents(c, hyphens=True), ["Saint‑Étienne"]) == ["Saint-Etienne"]
    assert values(X.normalize_text, ["Saint‑Étienne"]) == ["saintetienne"]
    assert values(lambda c: X.normalize_text(c, hyphens=True), ["Saint‑Étienne"]) == ["saint etienne"]


def test_normalize_text(values):
    texts = ["  Rayo-Vallecano ", "ATLÉTICO \t\n Madrid", None, "", "a--b"]
    assert values(X.normalize_text, texts) == ["rayo vallecano", "atletico madrid", "", "", "a b"]


def test_safe_text_and_match_id(values):
    assert values(X.safe_text, [" a b\t", " x ", None]) == ["a b", "x", ""]
    assert values(X.clean_match_id, ["123.0", " 12 ", None, "1.2.3"]) == ["123", "12", "", "1"]


def test_to_int(values):
    texts = ["2.9", "-2.9", " 7 ", "1e3", ".5", "x", "", None, "inf", "nan", "1d", "9" * 30]
    assert values(X.to_int, texts) == [2, -2, 7, 1000, 0, None, None, None, None, None, None, None]


def test_percent(values):
    assert values(X.percent_int, ["44%", "44", "x%", None]) == [44, 44, None, None]
    assert values(X.is_percent, ["44%", "44", None]) == [True, False, False]


def test_stat_pair(values):
    texts = ["2 of 7 — 29%", "31% — 5 OF 16", "3of4", "29%", None]
    assert values(X.stat_pair, texts) == [(2, 7), (5, 16), (3, 4), (None, None), (None, None)]


def test_score_pair(values):
    texts = ["2–1", " 3 – 0 ", "(4) 1–1 (5)", "2-1", "1–2–3", "x–1", "", None]
    assert values(X.score_pair, texts) == [(2, 1), (3, 0)] + [(None, None)] * 6


def test_strip_prefix_takes_the_first_in_list_order(values):
    texts = ["El-Clasico-Real-Madrid-Barcelona", "El-Derbi-Madrileno-Atletico-Madrid", "El-Gran-Derbi-Sevilla", "El-Derbi-X", "Elche-Y"]
    assert values(X.strip_prefix, texts) == ["Real-Madrid-Barcelona", "Atletico-Madrid", "Sevilla", "X", "Elche-Y"]


def test_strip_words(values):
    texts = ["El-Clásico-Real-Madrid", "el-el-derbi-A-B", "Elche-El", "el", None, "x"]
    assert values(X.strip_words, texts) == ["Real-Madrid", "A-B", "Elche-El", "", None, "x"]


def test_strip_words_survives_long_runs(values):
    assert values(X.strip_words, ["el-" * 50_000 + "x"]) == ["x"]


def test_null_tokens(values):
    assert values(lambda c: X.null_if_token(c, ["NA", ""]), ["NA", "", "x", None]) == [None, None, "x", None]


@pytest.mark.parametrize(
    "name, expected",
    [("First Test", "first_test"), ("SecondTest", "second_test"), ("thirdTest", "third_test"), ("Fourthtest", "fourthtest"), ("Fifth-test", "fifth_test")],
)
def test_snake_case(name, expected):
    assert X.snake_case(name) == expected


def test_exact_accents_hold_one_text_at_a_time():
    texts = ["é" * 20_000 if n % 2 else None for n in range(400)]
    batch = pa.array(texts, pa.string())
    tracemalloc.start()
    plain = X.strip_accents_exact.func(batch)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000  # the result has 4 million bytes; all texts decomposed would have 16 million
    assert plain.to_pylist() == [t and "e" * 20_000 for t in texts]
    assert X.strip_accents_exact.func(pa.array(["x", None, "ﬁ½"]).slice(1)).to_pylist() == [None, "fi12"]
    assert len(X.strip_accents_exact.func(pa.array([], pa.string()))) == 0
