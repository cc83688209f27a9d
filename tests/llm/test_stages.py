"""Stages of the pipeline beside plain Python: columns, groups and pieces."""

import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchloom.llm import near_copies, packing, pii, quality_rules, toxicity
from matchloom.llm.common import Spans
from tests.llm.test_ngram_join import family, plain

CLASHING = ["_l", "g_lang", "mean0", "l00", "__quality", "__x0", "__distance", "__toxicity", "__text", "Text", "component_id", "fp", "user_3"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    texts = [t for _ in range(12) for t in family(rng, 4, 80, 6, 3000)] + [f"write to a{i}@example.org or +49 30 1234 56{i:02d} " + " ".join(f"p{rng.randrange(900)}" for _ in range(40)) for i in range(20)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("stage", ["quality", "toxicity", "near_duplicates", "personal_data"])
def test_other_columns_stay_whatever_their_names(spark, docs, stage):
    wide = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING if c != "Text"], F.lit("T").alias("again"), F.lit(1).alias("text "))
    run = {
        "quality": quality_rules.keep_good,
        "toxicity": lambda d: toxicity.keep_clean(d, toxicity.Classifier()),
        "near_duplicates": near_copies.keep_one,
        "personal_data": lambda d: pii.redact_documents(d, pii.Finder()),
    }[stage]
    kept = run(wide)
    assert kept.columns == wide.columns and kept.dtypes == wide.dtypes
    rows = kept.collect()
    assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHING if c != "Text")
    assert run(wide.limit(0)).count() == 0


def test_pipeline_equals_its_stages_in_plain_python(spark, docs, tmp_path, monkeypatch):
    """The last three stages beside plain Python; the first two decide by fitted models, so what they keep is taken."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen = {}
    stages = []
    for name, stage in corpus_pipeline.STAGES:

        def spy(spark, frame, folder, name=name, stage=stage):
            seen[name] = sorted(tuple(r) for r in frame.collect())
            return stage(spark, frame, folder)

        stages.append((name, spy))
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(seen["toxicity"]) <= len(seen["quality"]) == docs.count()
    entered = seen["near_duplicates"]
    chosen = {c for _, _, c in plain([(r[0], r[1]) for r in entered], *((5, (4, 5))), empty_alike=True)}
    assert seen["personal_data"] == sorted(r for r in entered if r[0] in chosen)
    before = {r[0]: r for r in seen["personal_data"]}
    for key, text, lang, source, size in seen["packing"]:
        old = before[key]
        assert (lang, source, size) == (*old[2:4], len(text))
        assert pii.base_spans(text) == [] and ("<email>" in text) == ("@" in old[1])
    ids = {key: len(packing_ids(text)) for key, text, *_ in seen["packing"]}
    total = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
        assert p.doc_tokens == ids[p.doc_id]
    assert total == ids


def packing_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids + [1]


def test_reconciling_a_long_list_takes_time_in_proportion():
    found = [("phone", 20 * i, 20 * i + 25, 1.0 + i % 3) for i in range(100_000)]
    start = time.perf_counter()
    assert len(pii.reconcile(found)) >= 33_334
    assert time.perf_counter() - start < 5


def test_spans_meet():
    rng = random.Random(4)
    for _ in range(200):
        spans = [("k", s, s + rng.randint(1, 9)) for s in (rng.randrange(60) for _ in range(rng.randint(0, 6)))]
        taken = Spans(spans)
        for _ in range(20):
            s = rng.randrange(60)
            e = s + rng.randint(1, 6)
            assert taken.meet(s, e) == any(a < e and s < b for _, a, b in spans)
