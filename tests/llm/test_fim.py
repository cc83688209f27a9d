"""Fill-in-middle documents."""

import hashlib
import re

import pytest

from matchloom.llm import fim

DOCS = "doc_id long, text string, form string, output string, n long"


def plain(key, text):
    """The contract, on strings."""
    text = text or ""
    tokens = re.findall(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+", text)
    n, h = len(tokens), hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(tokens[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["one two  three\tfour\n five ", "  lead", " ", "<", "<P", "a <P> b", "ä ö 𝄞 x", "", None, "w " * 60_000, "<<S <S" * 3, "same text here", "same text here"]
    return spark.createDataFrame([(k, t, "x", "y", 0) for k in range(40) for t in texts], DOCS)


def test_outputs_and_restored_texts(docs):
    expected = sorted((r.doc_id, *map(str, plain(r.doc_id, r.text))) for r in docs.collect())
    made = fim.transform(docs)
    rows = made.collect()
    assert sorted((r.doc_id, str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in rows) == expected
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    back = sorted((r.doc_id, r.text) for r in fim.restore(made).collect())
    assert back == sorted((r.doc_id, r.text or "") for r in docs.collect())


def test_digests_are_those_of_the_outputs(docs):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = sorted((r.doc_id, sha(plain(r.doc_id, r.text)[4]), sha(r.text or "")) for r in docs.collect())
    assert sorted((r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.digests(docs).collect()) == expected


def test_null_keys_and_empty_tables(spark, docs):
    some = spark.createDataFrame([(None, "a b c", None, None, None), (None, None, None, None, None)], DOCS)
    found = fim.digests(some).collect()
    assert len(found) == 2 and {r.form for r in found} <= {"plain", "psm", "spm"}
    assert fim.digests(docs.limit(0)).count() == 0


def test_cutting_and_arranging_keep_the_buffer():
    whole = fim.Piece(0, 0, 10)
    assert fim.cut(whole, [3, 3]) == [(0, 0, 3), (0, 3, 3), (0, 3, 10)]
    parts = dict(zip(fim.IN_TEXT, fim.cut(whole, [2, 6]), strict=True))
    buffers = ("0123456789", "".join(fim.SENTINELS))
    for form in fim.ARRANGEMENTS:
        output = "".join(fim.spans(buffers, fim.arrange(parts, form, fim.SENTINELS)))
        assert "".join(fim.spans((output,), fim.restored_pieces(output, form))) == buffers[0]
