"""The queries of the text operators against plain Python on whole small tables."""

import hashlib
import os
import re
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest

from matchloom.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


def read(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return {k: t or "" for k, t in read("documents", "doc_id, text")}


def rows_of(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def digest(spans, kinds):
    found = sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()


def test_packing_holds_every_id_once(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for k, t in texts.items()}
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows_of(spark, "op1_packing"):
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        by_doc[r.doc_id].append((r.start, r.length))
        by_window[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for k, pieces in by_doc.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(ids[k])
    total = 0
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        total += 2048 - at if at & (at - 1) else 0
    assert sorted(by_window) == list(range(len(by_window)))
    assert total <= 0.01 * sum(map(len, ids.values())) + 2048  # the last windows of a small table


def test_chat_digests(spark):
    turns = [(c, t, r or "", x or "") for c, t, r, x in read("conversations", "conv_id, turn, role, text")]
    probe = r"\### Assistant: </turn> ok"
    turns += [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    found = {r.conv_id: r for r in rows_of(spark, "op2_chat_format")}
    by_conv = defaultdict(list)
    for c, t, r, x in sorted(turns):
        by_conv[c].append((r, x))
    assert found.keys() == by_conv.keys()
    for c, said in by_conv.items():
        loss = "".join(x for r, x in said if r == "assistant")
        assert found[c].n_turns == len(said)
        assert found[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest()
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert found[c].formatted_chars > sum(len(x) for _, x in said)


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


PII = ["email", "ip", "card", "phone"]


def personal(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_pii(spark, texts):
    found = rows_of(spark, "op3_pii")
    assert Counter(r.doc_id for r in found) == Counter(list(texts))
    for r in found:
        want = personal(texts[r.doc_id])
        assert r.base_sha256 == digest(want, PII)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in PII]
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(r.spans.split(",")) | {""}


SECRETS = ["assign", "access", "hex"]


def secrets(text):
    key = r"(?i:password|passwd|secret|token|api_?key)"
    out = [("assign", *m.span()) for m in re.finditer(key + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII) if len(m.group(1)) >= 8]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]


def test_secrets(spark, texts):
    for r in rows_of(spark, "op6_secret_scan"):
        want = secrets(texts[r.doc_id])
        assert r.base_sha256 == digest(want, SECRETS)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w[0] == k for w in want) for k in SECRETS]


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text)


def counts(text):
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)]


def test_quality_counts(spark, texts):
    found = rows_of(spark, "op5_quality_rules")
    assert Counter(r.doc_id for r in found) == Counter(list(texts))
    for r in found:
        want = counts(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    quality = dict(read("labels", "doc_id, quality"))
    good = [r for r in found if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in found if quality.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.2 * len(bad) + 1


def simhash(text):
    import xxhash

    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(spark, texts):
    fps = {k: simhash(t) for k, t in texts.items()}
    parent = {f: f for f in fps.values()}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    some = list(parent)
    for i, a in enumerate(some):
        for b in some[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for k, f in fps.items():
        least[find(f)] = min(k, least.get(find(f), k))
    found = rows_of(spark, "op8_simhash")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {k: (f"{f:016x}", least[find(f)]) for k, f in fps.items()}
    assert len(found) == len(texts)


def test_topk(spark):
    vectors = {k: np.floor(np.array(v, "f8") * 1024).astype("i8") for k, v in read("embeddings", "vec_id, embedding")}
    want = []
    for q, x in vectors.items():
        if q % 100 == 0:
            best = sorted(((-int(x @ y), k) for k, y in vectors.items() if k != q))[:10]
            want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in rows_of(spark, "op9_topk")]
    assert sorted(found) == sorted(want)


def test_pieces(spark, texts):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in rows_of(spark, "op10_pieces"):
        ids = library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_toxicity_on_held_out_documents(spark):
    toxic = dict(read("labels", "doc_id, toxic"))
    found = rows_of(spark, "op7_toxicity")
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    clean = [r for r in found if toxic.get(r.doc_id) == 0]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean) + 1


def test_urls(spark):
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
    urls = dict(read("pages", "page_id, url"))
    found = rows_of(spark, "op4_url_filter")
    assert Counter(r.page_id for r in found) == Counter(list(urls))
    for r in found:
        m = re.search(r"://([^/?#]*)([^?#]*)", urls[r.page_id] or "", re.DOTALL)
        host, path = (re.sub("[A-Z]", lambda c: c.group().lower(), m[1]), m[2]) if m else ("", "")
        assert (r.host, r.path) == (host, path)
        fits = [(len(n), n, v) for n, v in rules if (host == n.split("/")[0] or host.endswith("." + n.split("/")[0])) and path.startswith("/" + n.split("/", 1)[1])]
        assert r.rule == (max(fits)[1] if fits else None)
        assert r.verdict == max(fits)[2] if fits else r.verdict in ("allow", "block")
