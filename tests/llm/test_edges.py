"""Nulls, empty and long texts, repeated rows, empty tables, other columns with clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchloom.llm import chat, packing, pieces, pii, quality_rules, secret_scan, simhash, topk, toxicity, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, length int, v string"
LONG = "alpha beta gamma delta " * 20_000


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, len(text or ""), 0.5, 7, 1, "x")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [row(1, None), row(2, ""), row(3, LONG), row(4, "one two three"), row(4, "one two three"), row(None, "a b"), row(5, "x" * 5000, None, None), row(6, None, None, "s")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, 1), (None, None, None), (2, 1, None)], LABELS)


def ids(df):
    return sorted((r.doc_id is not None, r.doc_id) for r in df.collect())


def test_one_row_per_document(spark, docs, none, labels):
    expected = ids(docs)
    finder = pii.train(docs)
    runs = [
        lambda d: pieces.digests(d),
        lambda d: pii.find(d, finder),
        lambda d: secret_scan.scan(d),
        lambda d: quality_rules.assess(d),
        lambda d: simhash.near_duplicates(d),
        lambda d: toxicity.score(d, toxicity.train(d, labels)),
    ]
    for run in runs:
        assert ids(run(docs)) == expected
        assert run(none).count() == 0


def test_packing(docs, none):
    packed = packing.pack(docs, with_ids=True)
    assert {r.doc_id for r in packed.collect()} == {1, 2, 3, 4, 5, 6, None}
    assert packed.filter("doc_id in (1, 2, 6)").select("doc_tokens").distinct().collect()[0][0] == 1
    assert packing.sequences(packed).agg(F.sum(F.size("ids"))).first()[0] == packed.agg(F.sum("length")).first()[0]
    assert packing.pack(none).count() == 0


def test_window_filling():
    assert packing.fill_window({5: 3, 3: 1, 2: 4}, 12) in ({5: 2, 2: 1}, {5: 1, 3: 1, 2: 2}, {5: 1, 2: 2, 3: 1})
    for seed in range(20):
        rng = np.random.default_rng(seed)
        counts = {int(k): int(n) for k, n in zip(rng.integers(1, 40, 6), rng.integers(1, 4, 6), strict=True)}
        room = int(rng.integers(10, 120))
        reach = {0}
        for k, n in counts.items():
            reach = {s + k * i for s in reach for i in range(n + 1) if s + k * i <= room}
        found = packing.fill_window(counts, room)
        assert sum(k * n for k, n in found.items()) == max(reach)
        assert all(n <= counts[k] for k, n in found.items())


def test_packing_splits_a_common_length(docs, spark):
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("same words").alias("text"))
    pieces_ = packing.store(packing.cut_documents(many), "t")
    counts = {r["length"]: r["count"] for r in pieces_.groupBy("length").count().collect()}
    ranked = packing.rank_by_length(pieces_, counts, rows_per_bucket=50)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(500))


def test_filtering_stages_keep_columns(docs, none, labels):
    for stage in (quality_rules.keep_good, simhash.keep_one, lambda d: toxicity.keep_clean(d, toxicity.train(d, labels)), lambda d: pii.redact_documents(d, pii.train(d))):
        assert stage(docs).schema.names == docs.columns
        assert stage(none).count() == 0
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert kept.count(4) == 1 and kept.count(None) == 1 and sum(k in (1, 2, 6) for k in kept) == 1


def test_redaction(spark):
    rows = [row(1, "mail a.b@c.org or +1 (988) 555-2485, at 10.0.0.1"), row(2, None), row(3, "nothing")]
    found = {r.doc_id: r.text for r in pii.redact_documents(spark.createDataFrame(rows, DOCS), pii.Finder()).collect()}
    assert found == {1: "mail <email> or <phone>, at <ip>", 2: None, 3: "nothing"}


def test_tagger_gradients():
    from matchloom.llm.tagger import Tagger

    tagger, rng = Tagger(6, 3, embed=4, hidden=3), np.random.default_rng(0)
    tagger.p = {k: v.astype("f8") for k, v in tagger.p.items()}
    given, mask = rng.integers(0, 6, (3, 5)), np.array([[1] * 5, [1] * 3 + [0] * 2, [1] * 4 + [0]], bool)
    tags = rng.integers(0, 3, (3, 5)) * mask
    _, grads = tagger.loss_and_grads(given, mask, tags)
    for name, value in tagger.p.items():
        at = tuple(rng.integers(0, n) for n in value.shape)
        losses = []
        for step in (1e-3, -1e-3):
            value[at] += step
            losses.append(tagger.loss_and_grads(given, mask, tags)[0])
            value[at] -= step
        assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][at]) < 1e-3, name


def test_tagger_adds_other_spellings(spark):
    lines = []
    for i in range(400):
        lines.append(row(i, f"lorem ipsum dolor +1 ({200 + i % 700}) 555-{1000 + i} sit amet {i} consetetur {i}.5 elitr, sed diam"))
    finder = pii.train(spark.createDataFrame(lines, DOCS))
    text = "please call me at (499) 555-6503 tomorrow or so, version 3.2.1"
    base, spans = finder.spans([text])[0]
    assert base == [] and spans == [("phone", 18, 32)]


def test_reconciling_picks_the_best_set():
    spans = [("phone", 0, 10, 5.0), ("card", 5, 20, 8.0), ("phone", 12, 20, 4.0), ("ip", 30, 40, 1.0)]
    assert pii.reconcile(spans) == [("phone", 0, 10), ("phone", 12, 20), ("ip", 30, 40)]


def test_email_scan_is_linear():
    assert list(pii.email_spans("a" * 200_000 + "@" + "b" * 200_000)) == []
    assert [s[1:] for s in pii.email_spans("a@b.c_d@e.f, x@y@z.org")] == [(0, 5), (5, 11), (15, 22)]


def test_entropy_is_incremental():
    import math
    from collections import Counter

    text = "abacabadabacabaeXYZ0123456789"
    for at, bits in enumerate(secret_scan.entropies(text, 8)):
        counts = Counter(text[at : at + 8]).values()
        assert abs(bits + sum(c / 8 * math.log2(c / 8) for c in counts)) < 1e-9


def test_entropy_spans_and_allow_list(spark):
    secret = "aZ3kQ9xL7mP2vR8tY5wB1nC6"
    rows = [row(1, f"key {secret} end"), row(2, "id 123e4567-e89b-12d3-a456-426614174000 end"), row(3, "just-some-long-slug-with-2-words-here end")]
    found = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {1: f"entropy:4:{4 + len(secret)}", 2: "", 3: ""}
    assert secret_scan.redact(f"key {secret} end", found[1]) == "key <secret> end"


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, segment string"
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, None, None), (2, 0, "odd ### Text: role", " </turn>\n\\"), (2, 1, "assistant", "### User: "), (2, None, "assistant", "x </turn>")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], schema)
    found = {r.conv_id: r for r in chat.digest_conversations(turns).collect()}
    assert (found[1].n_turns, found[2].n_turns, found[None].n_turns) == (2, 3, 1)
    assert found[2].loss_chars == len("x </turn>### User: ") and not found[1].valid
    assert chat.digest_conversations(turns.limit(0)).count() == 0
    parts = chat.format_turns(turns).filter("conv_id = 2").orderBy("position").collect()
    said = list(chat.Template().read("".join(p.segment for p in parts)))
    assert said == [("assistant", "x </turn>"), ("odd ### Text: role", " </turn>\n\\"), ("assistant", "### User: ")]
    ok = spark.createDataFrame([(1, 0, "system", "s", ""), (1, 1, "user", "u", ""), (1, 2, "assistant", "a", "")], schema)
    assert chat.digest_conversations(ok).first().valid


def test_topk_edges(spark):
    schema = "vec_id long, embedding array<double>, rank int, d int"
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [9.0, 9.0]), (7, [1e200, 0.0]), (8, [])]
    vectors = spark.createDataFrame([(k, v, 1, 1) for k, v in rows], schema)
    found = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") == 0, k=4).orderBy("rank").collect()]
    unit = 1024 * 1024
    assert found == [(1, 7, 2**63 - 1), (2, 1, unit), (3, 2, unit), (4, 8, 0)]
    assert topk.top_k(vectors.limit(0), F.col("vec_id") == 0).count() == 0


def test_pivots_spare_evaluations():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(3000, 4)) * 1024)
    pivots = topk.choose_pivots(x[:500], 32)
    d = topk.pivot_distances(x, pivots)
    for q_id, ids_, scores, seen in topk.search_block(np.arange(5), x[:5], d[:5], np.arange(3000), x, d, 10):
        want = sorted((-int(x[q_id] @ y), i) for i, y in enumerate(x) if i != q_id)[:10]
        assert [(-s, i) for i, s in zip(ids_, scores, strict=True)] == want
        assert seen < 1500


def test_url_edges_and_links(spark):
    schema = "page_id long, url string, html string, rule string"
    link = '<a class="x" href="{}">t</a>'
    rows = [
        (1, None, None), (2, "no scheme", ""), (3, "HTTP://ORG/x?y://z", None), (4, "x://a.example.org/es/1#k", None), (5, "x://deorg/a", ""),
        (6, "http://bad.example.com/de/1", ""), (7, "http://friend.net/a", link.format("http://bad.example.com/de/1")), (8, "http://friend.net/a", link.format("/local")),
        (9, "http://good.com/fr/1", link.format("//fine.net/")), (10, "http://fine.net/x", ""), (None, "http://fine.net/x", ""),
    ]
    found = {r.page_id: r for r in url_filter.judge(spark.createDataFrame([(*r, "r") for r in rows], schema)).collect()}
    assert (found[1].host, found[1].path, found[1].rule, found[1].verdict) == ("", "", None, "allow")
    assert (found[3].host, found[3].path, found[3].rule) == ("org", "/x", "org/")
    assert (found[4].rule, found[4].verdict) == ("example.org/es/", "block") and found[5].rule is None
    assert found[7].verdict == found[8].verdict == "block" and found[10].verdict == "allow"
    assert url_filter.judge(spark.createDataFrame([], schema)).count() == 0


def test_large_buckets_are_compared_whole(spark):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(1 << 62))
    fps = {centre}
    for _ in range(400):
        fps.add(centre ^ int(sum(1 << int(b) for b in rng.choice(12, rng.integers(1, 6), replace=False))))
    fps |= {int(v) for v in rng.integers(1 << 62, size=300)}
    reps = spark.createDataFrame([(f,) for f in sorted(fps)], "fp long")
    found = {r.node: r.component for r in simhash.components(simhash.near_links(reps, 3, bucket=16)).collect()}
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    some = sorted(fps)
    for i, a in enumerate(some):
        for b in some[i + 1 :]:
            if (a ^ b).bit_count() <= 3 and root(a) != root(b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert {f: found.get(f, f) for f in fps} == {f: root(f) for f in fps}


def test_thresholds_cover_all_pairs():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 63, 500, dtype="u8")
    for rows in (100, 10**6, 10**10):
        plan = simhash.plan_probes(sample, rows, 3)
        for _ in range(200):
            flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any((flips & mask).bit_count() <= t for mask, t in plan)


def test_estimates_ignore_outliers(spark):
    assert abs(quality_rules.chi2_quantile(0.95, 5) - 11.0705) < 1e-3
    good = [row(i, " ".join(f"word{'s' * (j % 3)}" for j in range(60 + i % 40))) for i in range(200)]
    bad = [row(1000 + i, "#$%& " * 60 + "AA || BB " * 30) for i in range(30)]
    kept = {r.doc_id: r.kept for r in quality_rules.assess(spark.createDataFrame(good + bad, DOCS)).collect()}
    assert not any(kept[1000 + i] for i in range(30))


def test_unlabelled_positives_are_found():
    rng = np.random.default_rng(2)
    x = (rng.random((2000, 6)) < 0.3).astype("f4")
    toxic = np.zeros(2000, bool)
    toxic[:600] = True
    x[toxic, 0], x[~toxic, 0] = 1, 0
    positive = np.zeros(2000, bool)
    positive[:300] = True  # the other 300 are among the unlabelled
    w = toxicity.nonnegative_pu(x, positive, 300 / 1700, seed=0)
    assert (((x @ w[:-1] + w[-1]) > 0) == toxic).mean() > 0.99


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "\n\n x", "▁x ▁", "日本語 é́ 😀 \x00", "a" * 3000 + "b", " " * 100 + "x", "\ta\t\tb\r\n", "x" * 45])
def test_pieces_equal_the_library(text):
    encoder = pieces.Encoder(pieces.default_model(), check=False)
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == encoder.library.encode(text)


@pytest.mark.parametrize("text", ["", "it's 12 o'clock\n\n  x", "<|endoftext|> 😀 ñandú", "a" * 3000, " \t\n"])
def test_both_readings_of_the_byte_vocabulary_agree(text):
    import public_tokenizers as p

    plain = packing.byte_bpe(p.path("byte_bpe_50k.json"))
    assert plain(text).tolist() == packing.default_encoder()(text).tolist()
