"""What the driver keeps of the pipeline: few rounds for what is connected already, one plan for all levels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.llm import components, ngram_join, quality_rules
from matchloom.session import store


def test_known_links_are_connected_once(spark, monkeypatch):
    """A chain of near copies is brought together by the first search; those after it begin from stars."""
    rounds = []

    def counted(df, purpose):
        if rounds and purpose == "edges":
            rounds[-1] += 1
        return store(df, purpose)

    def search(edges):
        rounds.append(0)
        return components.components(edges)

    monkeypatch.setattr(components, "store", counted)
    monkeypatch.setattr(ngram_join, "components", search)

    def chain(sets):
        before = F.lag("fp").over(Window.orderBy("fp"))
        return sets.select(F.col("fp").alias("u"), before.alias("v")).filter("v IS NOT NULL")

    common = " ".join(f"w{i}" for i in range(120))
    docs = spark.createDataFrame([(i, f"{common} own{i}") for i in range(40)] + [(99, "apart from all of them")], "doc_id long, text string")
    found = ngram_join.join_documents(docs, 5, (4, 5), first_links=chain).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == [(i, 0) for i in range(40)] + [(99, 99)]
    assert len(rounds) == 3 and rounds[0] > 2
    assert rounds[1:] == [1, 1]  # the links as they are; no round is run to see that nothing changes


def test_levels_are_mixed_in_one_plan(spark):
    """The same values as by hand; the steps after the mixing aren't repeated for each level."""
    values = [*quality_rules.MEANS, *quality_rules.COVARIANCES]
    rows = [("+", "+", 0, 100), ("=a", "+", 0, 60), ("-", "+", 0, 40), ("=a", "=x", 0, 59), ("=a", "-", 0, 1), ("-", "=x", 0, 40)]
    number = {row[:2]: [row[3] / 7 + k for k in range(len(values))] for row in rows}
    schema = "g_lang string, g_source string, start int, `all` long, " + ", ".join(f"{v} double" for v in values)
    raw = spark.createDataFrame([(*row, *number[row[:2]]) for row in rows], schema)

    def mix(n, inner, outer):
        own = n / (n + quality_rules.PRIOR)
        return [own * x + (1 - own) * y for x, y in zip(inner, outer, strict=True)]

    expected = {}
    for lang, source, _, n in sorted(rows, key=lambda r: (r[0] != "+", r[1] != "+")):
        key = (lang, source)
        wider = ("+", "+") if source == "+" else (lang, "+")
        expected[key] = number[key] if lang == "+" else mix(n, number[key], expected[wider])
    mixed = quality_rules.mixed(raw)
    assert {(r["g_lang"], r["g_source"]): [r[v] for v in values] for r in mixed.collect()} == expected
    plan = quality_rules.factor(mixed)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_table_of_wanted_texts_follows_their_number(spark):
    """The driver gets one small table for few texts, and never more than SLOTS bits; the sets are all read."""
    assert [ngram_join.slots_for(n) for n in (0, 1, 1000, 10**6, 10**12)] == [1 << 10, 1 << 10, 1 << 14, 1 << 24, ngram_join.SLOTS]
    texts = [(i if i else None, " ".join(f"{i}w{k}" for k in range(9))) for i in range(-30, 30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    none = ngram_join.np.empty(0, "u8")
    named = ngram_join.summaries(docs, 3, (9, 10), none)
    for wanted in (named.filter("doc_id IS NULL OR doc_id % 3 = 0"), named.limit(0)):
        wanted = wanted.select("fp", "n", F.col("doc_id").alias("least")).localCheckpoint()
        found = ngram_join.whole_sets(docs, wanted, 3, none)
        assert sorted(r["fp"] for r in found.collect()) == sorted(r["fp"] for r in wanted.collect())
        assert all(len(r["path"]) == 8 * r["n"] for r in found.collect())


def test_small_frames_are_stored_in_few_files(spark, monkeypatch):
    """Adaptive execution that merges no partitions leaves a file of each, with processes to set its permissions."""
    files = {}

    def counted(df, purpose):
        out = store(df, purpose)
        files.setdefault(purpose, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(components, "store", counted)
    monkeypatch.setattr(ngram_join, "store", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        chain = spark.range(1, 300).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
        assert {(r.node, r.component) for r in components.components(chain).collect()} == {(i, 0) for i in range(300)}
        assert len(files["edges"]) > 2 and max(files["edges"][1:]) <= 8
        rows = [(i, " ".join(f"w{i % 60}_{j}" for j in range(30)) + f" own{i}") for i in range(300)]
        assert ngram_join.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).count() == 300
        assert all(max(files[x]) <= 8 for x in ("sets", "wanted", "groups", "labels", "mixed", "within-reach"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
