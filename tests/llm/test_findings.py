"""One test for each finding of the second review."""

import re

import numpy as np

import pytest

import corpus_pipeline
from matchloom.llm import packing, quality_rules, secret_scan, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], DOCS)


def jaccard(a, b, words=5):
    sets = []
    for text in (a, b):
        w = re.findall(r"[^\x20\x09-\x0d]+", text.lower())
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_down_to_four_fifths_are_found(spark):
    rng, texts = np.random.default_rng(4), {}
    passage = [f"common{i}" for i in range(30)]
    for g in range(30):
        own = [f"w{rng.integers(5000)}" for _ in range(60 + 20 * (g % 6))]
        for k in range(6):
            w = list(own)
            for at in rng.choice(len(w), rng.integers(0, 4), replace=False):
                w[at] = f"x{rng.integers(5000)}"
            texts[10 * g + k] = " ".join(w + (passage if g % 3 == 0 else []))
    parent = {k: k for k in texts}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if a // 10 == b // 10 and jaccard(texts[a], texts[b]) >= 0.8:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    found = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents(spark, texts), "").collect())
    assert found == sorted({root(k) for k in keys})
    assert len(found) < 0.8 * len(texts)


def test_each_quality_statistic_alone_rejects(spark):
    rng = np.random.default_rng(6)
    plain = lambda n: [f"word{''.join(rng.choice(list('abcdef'), 4))}" for _ in range(n)]
    texts = {i: " ".join(plain(150)) for i in range(200)}
    menu = [f"word{a * 3}{k}" for k in range(10) for a in "ab"]
    texts[1000] = " ".join(w + "longer" * 6 for w in plain(150))
    texts[1001] = " ".join(plain(100) + ["#$%&"] * 3 + plain(100) + ["||||||"] * 2)
    order = rng.integers(0, 20, 200)
    texts[1002] = "\n".join(menu[k] for k in order)
    again = plain(22)
    texts[1003] = " ".join(again + plain(54) + again + plain(54))
    texts[1004] = " ".join(w.upper() for w in plain(150))
    found = {r.doc_id: r for r in quality_rules.assess(documents(spark, texts)).collect()}
    assert [k for k in texts if k >= 1000 and (found[k].kept or found[k].base_failed)] == []
    assert found[1002].n_repeat_words == 0 and found[1003].n_dup_lines == 0
    assert all(found[k].kept for k in range(200))


@pytest.mark.parametrize("text", ["see <|endoftext|> here", "<|endoftext|><|endoftext|> ñ", "<|endoftext|", "none"])
def test_added_tokens_are_read_as_the_library_does(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.default_encoder()(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("prefix", ["", "x/", "v1/", "id_"])
def test_hex_secrets_joined_to_other_characters_are_found_whole(prefix):
    allow = re.compile("|".join(f"(?:{p})" for p in secret_scan.Scanner().allowed))
    for secret in ("3f0a9c41d7e25b8860f3", "3F0A9C41D7E25B8860F3A1C9", "3f0A9c41D7e25B8860f3a1C9"):
        text = f"key {prefix}{secret} end"
        (span,) = secret_scan.entropy_spans(text, secret_scan.Scanner(), allow)
        assert span[1] <= 4 + len(prefix) and span[2] == 4 + len(prefix) + len(secret)
    assert secret_scan.entropy_spans("see x/20240131123456789012345 or path/to/some/file2", secret_scan.Scanner(), allow) == []


def test_a_blocked_host_keeps_its_verdict_beside_large_ones(spark):
    urls = [f"http://bad.com/de/{i}" for i in range(3)] + [f"http://bad.com/fr/{i}" for i in range(1)] + [f"http://bad.com/x/{i}" for i in range(40)]
    urls += [f"http://large.com/de/{i}" for i in range(400)] + [f"http://good.com/fr/{i}" for i in range(400)] + ["http://good.com/x", "http://none.net/x"]
    pages = spark.createDataFrame([(i, u, '<a href="http://bad.com/">' if "good" in u else "") for i, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r.host + r.path: r.verdict for r in url_filter.judge(pages).collect()}
    assert {found[f"bad.com/x/{i}"] for i in range(40)} == {"block"}
    assert found["good.com/x"] == found["none.net/x"] == "allow"
