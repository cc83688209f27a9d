"""Bucketed series against plain Python, with one key that holds most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators import ratings as V
from matchloom.operators import series as W

START = dt.datetime(2024, 1, 1)
KINDS = ["start", "a", "b"]


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    seconds = rng.sample(range(10 * 86_400), 400)
    out = []
    for i, s in enumerate(seconds):
        key = "hot" if rng.random() < 0.6 else rng.choice(["p", "q", "r"])
        value = None if rng.random() < 0.2 else float(rng.randint(0, 50))
        out.append((i, key, START + dt.timedelta(seconds=s), rng.choice(KINDS), value))
    out.append((len(out), None, START, "a", 1.0))
    return out


@pytest.fixture(scope="module", params=[1, 8])
def df(spark, data, request):
    schema = "i int, k string, ts timestamp, kind string, v double"
    return spark.createDataFrame(data, schema).repartition(request.param)


@pytest.fixture(params=[1, 60, 10_000], ids=["all keys cut", "one key cut", "no key cut"])
def limit(request):
    return request.param


def hourly(limit):
    return W.Series(["k"], ["ts"], [W.time_bucket("ts", "hour")], limit)


def by_key(data):
    groups = {}
    for row in sorted((r for r in data if r[1] is not None), key=lambda r: r[2]):
        groups.setdefault(row[1], []).append(row)
    return groups


def got(df, name):
    return {r.i: r[name] for r in df.collect()}


def test_totals_of_doubles_do_not_depend_on_the_cut(spark, limit):
    values = [1e16, 1.0, -1e16, 1.0, 0.1, 0.2]
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate(values)], "i int, k string, v double")
    line = W.Series(["k"], ["i"], [W.number_bucket("i", 2)], limit)
    with pytest.raises(TypeError, match="decimal"):
        W.running_total(df, line, F.col("v"), "t")
    total = W.running_total(df, line, F.col("v").cast("decimal(28,6)"), "t")
    assert [float(got(total, "t")[i]) for i in range(6)] == [1e16, 1e16 + 1, 1.0, 2.0, 2.1, 2.3]


@pytest.mark.parametrize("keys", [0, 1, 2])
def test_only_the_largest_keys_are_cut(spark, monkeypatch, keys):
    monkeypatch.setattr(W, "LARGE_KEYS", keys)
    df = spark.createDataFrame([(i, "abbccc"[i % 6]) for i in range(60)], "i int, k string")
    line = W.Series(["k"], ["i"], [W.number_bucket("i", 5)], 1)
    cut = {r.k for r in line.cut(df).filter("_bucket is not null").collect()}
    assert cut == set("cba"[:keys])
    numbers = got(W.row_numbers(df, line, "n"), "n")
    assert [numbers[i] for i in (0, 6, 5, 59)] == [1, 2, 3, 30]


def test_running_total_and_numbers(df, data, limit):
    totals, numbers = {}, {}
    for rows in by_key(data).values():
        total = 0
        for n, r in enumerate(rows, 1):
            total += r[0]
            totals[r[0]], numbers[r[0]] = total, n
    assert got(W.running_total(df, hourly(limit), F.col("i"), "t"), "t") == totals
    assert got(W.row_numbers(df, hourly(limit), "n"), "n") == numbers


def test_next_row(df, data, limit):
    expected = {}
    for rows in by_key(data).values():
        for r, following in zip(rows, [*rows[1:], None]):
            expected[r[0]] = following and following[4]
    assert got(W.next_row(df, hourly(limit), {"n": F.col("v")}), "n") == expected


def test_fill_forward(df, data, limit):
    expected = {}
    for rows in by_key(data).values():
        last = None
        for r in rows:
            last = r[4] if r[4] is not None else last
            expected[r[0]] = last
    assert got(W.fill_forward(df, hourly(limit), {"f": F.col("v")}), "f") == expected


@pytest.mark.parametrize("n", [2, 7, 90])
def test_rolling_mean(df, data, n, limit):
    expected = {}
    for rows in by_key(data).values():
        for at, r in enumerate(rows):
            window = [x[4] for x in rows[max(0, at - n + 1) : at + 1]]
            full = len(window) == n and None not in window
            expected[r[0]] = round(sum(window) / n, 9) if full else None
    found = got(W.rolling_mean(df, hourly(limit), "v", n, "m"), "m")
    again = got(W.rolling_mean(df, hourly(limit), "v", n, "m", source=df), "m")
    assert again == found
    assert {i: m and round(m, 9) for i, m in found.items()} == {i: m and round(m, 9) for i, m in expected.items()}


def test_records(df, data, limit):
    expected, folded = {}, {}
    for key, rows in by_key(data).items():
        record = 0
        for r in rows:
            record += r[3] == "start"
            if record:
                expected[r[0]] = record
                fold = folded.setdefault((key, record), {})
                fold[r[3]] = r[0]
    records = W.segment_records(df, hourly(limit), F.col("kind") == "start", "record")
    assert got(records, "record") == expected
    wide = W.fold_records(records, ["k", "record"], "kind", "ts", {"a": ("a", F.col("i")), "s": ("start", F.col("i"))})
    assert {(r.k, r.record): (r.a, r.s) for r in wide.collect()} == {
        at: (fold.get("a"), fold.get("start")) for at, fold in folded.items()
    }


def test_order_over_two_columns(spark):
    rows = [(i, i // 7, i % 7) for i in range(100)]
    df = spark.createDataFrame(rows, "i int, a int, b int").withColumn("k", F.lit("k"))
    line = W.Series(["k"], ["a", "b"], [F.col("a"), W.number_bucket("b", 3)], 10)
    assert got(W.row_numbers(df, line, "n"), "n") == {i: i + 1 for i in range(100)}


def test_ranks(spark):
    rng = random.Random(3)
    data = [(i, rng.choice("ab"), rng.choice([None, 1.0, 2.5, 7.0, 30.0])) for i in range(200)]
    df = spark.createDataFrame(data, "i int, k string, v double")
    found = got(W.ranks(df, ["k"], "v", W.number_bucket("v", 5), "r"), "r")
    height = lambda v: float("-inf") if v is None else v
    for i, k, v in data:
        assert found[i] == 1 + sum(1 for _, k2, v2 in data if k2 == k and height(v2) > height(v))


# -- ratings --------------------------------------------------------------------------------


def intervals(df, limit):
    starts = df.filter("kind = 'start'").select("k", "ts", "i")
    return V.validity_intervals(starts, hourly(limit), "ts").select("k", "from", "to", F.col("i").alias("rating"))


def spans(data):
    out = []
    for key, rows in by_key(data).items():
        starts = [r for r in rows if r[3] == "start"]
        for r, following in zip(starts, [*starts[1:], None]):
            out.append((key, r[2], following and following[2], r[0]))
    return out


def test_ratings_at(df, data, limit):
    day = dt.datetime(2024, 1, 6)
    found = {tuple(r) for r in V.ratings_at(intervals(df, limit), "2024-01-06").collect()}
    assert found == {s for s in spans(data) if s[1] <= day and (s[2] is None or s[2] > day)}
    assert {tuple(r) for r in V.ratings_at(intervals(df, limit), day.replace(tzinfo=dt.timezone.utc)).collect()} == found
    assert V.ratings_at(intervals(df, limit)).filter("`to` is not null").count() == 0


def test_interval_join(df, data, limit):
    facts = df.filter("kind = 'a' or k is null").select("i", "k", "ts")
    found = V.interval_join(facts, intervals(df, limit), "k", "ts", [W.time_bucket("_time", "hour")], ["rating"], limit)
    expected = {}
    for i, k, ts, kind, _ in data:
        if kind == "a" or k is None:
            hits = [s[3] for s in spans(data) if s[0] == k and s[1] <= ts and (s[2] is None or ts < s[2])]
            expected[i] = hits[0] if hits else None
    assert got(found, "rating") == expected


def test_interval_join_ends_and_gaps(spark):
    t = lambda h: START + dt.timedelta(hours=h)
    spans = spark.createDataFrame([("x", t(0), t(2), 1), ("x", t(5), t(6), 2)], "k string, `from` timestamp, `to` timestamp, r int")
    facts = spark.createDataFrame([(i, "x", t(h)) for i, h in enumerate([0, 1, 2, 5, 6, -1])], "i int, k string, ts timestamp")
    found = V.interval_join(facts, spans, "k", "ts", [W.time_bucket("_time", "hour")], ["r"], 1)
    assert got(found, "r") == {0: 1, 1: 1, 2: None, 3: 2, 4: None, 5: None}
    line = W.Series(["k"], ["from"], [W.time_bucket("from", "day")])
    assert V.overlapping_intervals(spans, line).count() == 0
    longer = spans.withColumn("to", F.lit(None).cast("timestamp"))
    assert V.overlapping_intervals(longer, line).count() == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlap_join(spark, how):
    rng = random.Random(8)
    t = lambda s: START + dt.timedelta(seconds=s)
    span = 40 * 86400
    facts = [(i, rng.choice(["hot", "hot", "a", "b", None]), t(rng.randrange(-span, span))) for i in range(400)]
    facts += [(400, "hot", None), (401, "none", t(0)), (402, "edge", t(0)), (403, "edge", t(10))]
    intervals = []
    for i in range(300):
        start, size = rng.randrange(-span, span), 8 ** rng.randrange(8) + rng.randrange(3) - 1
        intervals.append((rng.choice(["hot", "a", "b", None]), t(start), None if i % 30 == 0 else t(start + size), i))
    intervals += [("edge", t(0), t(10), 900), ("edge", t(10), t(10), 901), ("edge", t(9), t(3), 902), ("edge", t(0), t(10), 900)]
    intervals += [("edge", None, t(10), 903)]
    want = []
    for i, k, ts in facts:
        met = [r for key, a, b, r in intervals if k is not None and key == k and ts and a and a <= ts and (b is None or ts < b)]
        want += [(i, r) for r in met] or ([(i, None)] if how == "left" else [])
    left = spark.createDataFrame(facts, "i int, k string, ts timestamp")
    right = spark.createDataFrame(intervals, "k string, `from` timestamp, `to` timestamp, r int")
    found = V.overlap_join(left, right, "k", "ts", ["r"], how)
    assert sorted((r.i, r.r if r.r is not None else -1) for r in found.collect()) == sorted((i, r if r is not None else -1) for i, r in want)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    for some, other, n in ((left.limit(0), right, 0), (left, right.limit(0), len(facts) if how == "left" else 0)):
        assert V.overlap_join(some, other, "k", "ts", ["r"], how).count() == n


def test_history(spark):
    df = spark.createDataFrame([("Man City", 1), ("Team & City", 2)], "team string, elo int")
    aliases = spark.createDataFrame([("Manchester City", "Man City")], "canonical string, alias string")
    one = V.entity_history(df, "team", "Man City", aliases).collect()
    assert one == V.entity_history(df, "team", "Manchester City", aliases).collect() and len(one) == 1
    assert V.entity_history(df, "team", "Team & City", required=True).count() == 1
    with pytest.raises(ValueError, match="No data found for team FC Knudde"):
        V.entity_history(df, "team", "FC Knudde", aliases, required=True)


def test_snapshots(spark, rows):
    df = spark.createDataFrame([("a", START, 1), ("a", START + dt.timedelta(days=5), 2), ("b", START, 3)], "k string, at timestamp, v int")
    as_of = F.lit("2024-01-08")
    found = V.latest_snapshot(df, ["k"], ["at"], as_of, 3)
    assert rows(found, "k", "v", "is_fresh") == [("a", 2, True), ("b", 3, False)]
    assert rows(V.latest_snapshot(df, ["k"], ["at"], as_of, None), "is_fresh") == [(True,), (True,)]
    assert rows(V.latest_snapshot(df, ["k"], ["at"], as_of, dt.timedelta(days=7)), "is_fresh") == [(True,), (True,)]
    with pytest.raises(TypeError, match="'max_age' must be of type int or datetime.timedelta"):
        V.latest_snapshot(df, ["k"], ["at"], as_of, START)


def test_gathered_rows_are_the_same_and_dealt_by_key(spark, rows):
    data = [(k, i, None if i % 3 else f"v{i}", (k, i // 4) if i % 5 else None) for k in ("a", None, "b", "a") for i in range(10)]
    df = spark.createDataFrame(data, "k string, i int, v string, s struct<x: string, y: int>").coalesce(1)
    for keys in (["k"], ["k", "s"], ["v"], ["i", "s"]):
        found = W.gather(df, keys)
        assert found.columns == df.columns and rows(found.select("k", "i", "v", "s.*")) == rows(df.select("k", "i", "v", "s.*"))
        placed = found.withColumn("place", F.spark_partition_id())
        places = placed.groupBy(*keys).agg(F.count_distinct("place").alias("n"))
        assert [r.n for r in places.select("n").distinct().collect()] == [1]
    plan = W.gather(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange hashpartitioning(k") < plan.index("MapInArrow")


@pytest.mark.parametrize("limit", [3, 30, 1000])
def test_whole_and_large_keys_apart(spark, rows, limit):
    data = [(k, i, i % 4) for k, n in (("a", 40), ("b", 9), ("c", 1), (None, 5)) for i in range(n)]
    df = spark.createDataFrame(data, "k string, i int, v int").repartition(3)
    line = W.Series(["k"], ["i"], [W.number_bucket("i", 5)], limit)
    whole, large = line.parted(df)
    assert {r.k for r in large.collect()} == {k for k, n in (("a", 40), ("b", 9), ("c", 1)) if n > limit}
    what = ({"next": F.col("v")}, {"total": F.col("v").cast("bigint")})
    apart = W.scan_whole(whole, line, *what).union(W.scan(large, line, *what))
    assert rows(apart) == rows(W.scan(df, line, *what)) and apart.count() == 50
