import json

import pytest
from pyspark.sql import functions as F

from matchloom.operators.aliases import alias_collisions, available_leagues
from matchloom.operators.filters import drop_all_null
from matchloom.operators.joins import frame_difference
from matchloom.sources import config_files as G
from matchloom.sources import csv_files as C
from matchloom.sources import tables as K
from matchloom.streaming import incremental as N


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_typed_csv(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", "equipo,capacidad\nA,10\nB,x\n", "utf-8-sig")
    assert rows(C.read_typed(spark, path, "equipo string, capacidad int")) == [("A", 10), ("B", None)]


def test_text_csv(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", 'Player,Pos,n\nAnn,"MF,FW",1\nBob,NA,\n"Al ""X""",GK,2\n', "utf-8-sig")
    df = C.read_text_columns(spark, path)
    assert df.columns == ["Player", "Pos", "n"]
    assert rows(df) == [('Al "X"', "GK", "2"), ("Ann", "MF,FW", "1"), ("Bob", "NA", None)]
    assert rows(C.read_text_columns(spark, path, missing_tokens=True).filter("Pos is null"), "Player") == [("Bob",)]


def test_headerless_csv(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", "44%,56%,u\nShots on Target,Shots on Target,u\n")
    assert C.read_headerless(spark, path, ["home", "away", "url"]).columns == ["home", "away", "url"]
    assert C.read_headerless(spark, path, ["home", "away", "url"]).count() == 2


def test_two_header_lines(spark, tmp_path, rows):
    text = ",Performance,Expected,match_url\nPlayer,Gls,Gls, \nAnn,1,0.4,u1\nBob,,,u2\n"
    df = C.read_two_headers(spark, write(tmp_path / "a.csv", text, "utf-8-sig"))
    assert df.columns == ["Player", "Gls", "Gls_2", "match_url"]
    assert rows(df) == [("Ann", "1", "0.4", "u1"), ("Bob", None, None, "u2")]


def test_season_files(spark, tmp_path, rows):
    write(tmp_path / "E0-1819.csv", "Div,HomeTeam,FTR\nE0,A,H\n")
    write(tmp_path / "E0-1920.csv", "Div,HomeTeam,FTR\nE0,A,D\nE0,B,A\n")
    write(tmp_path / "E0-2021.csv", "Div,FTR,HomeTeam,B365H\nE0,H,C,1.5\n")
    df = C.read_seasons(spark, [str(tmp_path / f"E0-{s}.csv") for s in ("1819", "1920", "2021")])
    assert rows(df, "season", "HomeTeam", "FTR", "B365H") == [
        ("1819", "A", "H", None), ("1920", "A", "D", None), ("1920", "B", "A", None), ("2021", "C", "H", "1.5"),
    ]


def test_season_headers_take_one_job(spark, tmp_path, rows):
    team = ['"Team, home"', "HomeTeam"]
    paths = [
        write(tmp_path / f"E {i % 2}-{1950 + i}.csv", f'"Div",{team[i % 2]}\nE0,{i}\n', "utf-8-sig" if i % 3 else "utf-8")
        for i in range(50)
    ]
    spark.sparkContext.setJobGroup("headers", "")
    lines = C._header_lines(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setJobGroup("other", "")
    assert len(lines) == 50 and len(jobs) <= 4  # of one query, listing of the files included
    df = C.read_seasons(spark, paths)
    assert sorted(df.columns) == ["Div", "HomeTeam", "Team, home", "season"]
    assert sorted(int(r["HomeTeam"] or r["Team, home"]) for r in df.collect()) == list(range(50))


def test_line_breaks_and_malformed_rows(spark, tmp_path, rows):
    path = write(tmp_path / "b.csv", 'a,n\n"x\ny",2\n"z ""q""",3\n')
    assert rows(C.read_typed(spark, path, "a string, n int", line_breaks=True), "a", "n") == [("x\ny", 2), ('z "q"', 3)]
    assert rows(C.read_text_columns(spark, path, line_breaks=True), "a", "n") == [("x\ny", "2"), ('z "q"', "3")]
    bad = write(tmp_path / "c.csv", "a,n\nx,2\ny,many\nz\n")
    found = C.read_typed(spark, bad, "a string, n int", malformed="bad").cache()
    assert sorted((r.a, r.n, r.bad) for r in found.collect()) == [("x", 2, None), ("y", None, "y,many"), ("z", None, "z")]


def test_config_files(spark, tmp_path, rows):
    aliases = write(tmp_path / "names.json", json.dumps({"Celta de Vigo": ["Celta Vigo", "Celta"], "Arsenal": [], "Lazio": ["Lazio"], "SS Lazio": ["Lazio"]}, indent=1))
    found = G.read_aliases(spark, aliases)
    assert ("Celta de Vigo", "Celta") in rows(found) and found.count() == 4
    assert rows(alias_collisions(found)) == [("Lazio", 2)]
    leagues = write(tmp_path / "leagues.json", json.dumps({"ABC-Fake": {"events": "Fake", "season_end": "May"}, "X": {}}))
    table = G.read_leagues(spark, leagues)
    assert rows(table, "league", "season_start", "season_end") == [("ABC-Fake", None, "May"), ("X", None, None)]
    assert rows(available_leagues(table, "events")) == [("ABC-Fake",)]
    assert G.read_aliases(spark, write(tmp_path / "empty.json", "{}")).count() == 0


def test_team_catalogue(spark):
    teams = G.team_catalogue(spark)
    assert teams.count() == teams.select("team_id").distinct().count() == 20
    assert teams.filter("equipo = 'Girona'").first().team_id == "TEAM-51EA86E0"


def test_write_and_read_again(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (None, "é")], "n int, t string")
    K.write_csv(df, str(tmp_path / "c"))
    assert frame_difference(C.read_typed(spark, str(tmp_path / "c"), df.schema), df).count() == 0
    K.write_table(df, str(tmp_path / "t"), ["n"])
    cleaned = drop_all_null(spark.read.parquet(str(tmp_path / "t")), ["n"])
    K.write_table(cleaned, str(tmp_path / "t_clean"))
    assert spark.read.parquet(str(tmp_path / "t_clean")).count() == 1


def test_aligned_append(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", "1", "u1")], "Player string, Gls string, match_url string")
    K.append_aligned(first, path, first.schema)
    K.append_aligned(spark.createDataFrame([("u2", "b", "9")], "match_url string, Player string, Ast string"), path, first.schema)
    assert rows(spark.read.parquet(path)) == [("a", "1", "u1"), ("b", None, "u2")]


def test_incremental_append(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([("u1", 0, "x"), ("u2", 1, "y"), ("u1", 2, "z")], "url string, pos int, v string")
    for _ in range(2):
        N.incremental_append(batch, path, "url", ["pos"])
    assert rows(spark.read.parquet(path)) == [("u1", 0, "x"), ("u2", 1, "y")]
    N.incremental_append(spark.createDataFrame([("u3", 5, "w"), ("u2", 0, "late")], batch.schema), path, "url", ["pos"])
    assert rows(spark.read.parquet(path), "url", "v") == [("u1", "x"), ("u2", "y"), ("u3", "w")]


def test_incremental_append_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    day = lambda d, ids: spark.createDataFrame([(i, d) for i in ids], "url string, day string")
    N.incremental_append(day("d1", ["a", "b"]).union(day("d2", ["c"])), path, "url", ["day"], partition_by="day")
    N.incremental_append(day("d2", ["c", "d"]), path, "url", ["day"], partition_by="day")
    assert spark.read.parquet(path).count() == 4
    known = spark.read.schema("url string, day string").parquet(path)
    fresh = N.new_rows(day("d2", ["d", "e"]), known, "url", "day")
    assert [r.url for r in fresh.collect()] == ["e"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(day" in plan and ">= d2" in plan


def test_large_table_is_not_shuffled_for_a_few_candidates(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    spark.range(995, 1005).write.parquet(str(tmp_path / "c"))
    fresh = N.new_rows(spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "t")), "id")
    assert fresh.count() == 5
    assert "hashpartitioning" not in fresh._jdf.queryExecution().executedPlan().toString()


def test_stream(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(i % 90, i) for i in range(100)]
    df = spark.createDataFrame(rows, "url int, pos int")
    df.repartition(3).write.parquet(source)

    def run(progress):
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        N.start_incremental(stream, sink, str(tmp_path / progress), "url", ["pos"]).awaitTermination()
        return spark.read.parquet(sink).count()

    assert run("p") == 90
    spark.createDataFrame([(i, 0) for i in range(80, 100)], df.schema).write.mode("append").parquet(source)
    assert run("p") == 100
    assert run("p") == 100
    assert run("other") == 100


def test_two_runs_at_once_leave_each_key_once(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "url string, day string"
    batch = lambda ids: spark.createDataFrame([(i, f"d{i[-1]}") for i in ids], schema)
    take, inner = N.Batches.take, []

    def overtaken(self, stage, number):
        """Lets two other runs over partly the same candidates finish first."""
        if not inner:
            inner.append(stage)
            N.incremental_append(batch(["a1", "b2"]), path, "url", ["day"], partition_by="day")
            N.incremental_append(batch(["b2", "c1"]), path, "url", ["day"], partition_by="day")
        return take(self, stage, number)

    monkeypatch.setattr(N.Batches, "take", overtaken)
    N.incremental_append(batch(["a1", "b2", "c1", "d2"]), path, "url", ["day"], partition_by="day")
    found = spark.read.schema(schema).parquet(path).collect()
    assert sorted((r.url, r.day) for r in found) == [("a1", "d1"), ("b2", "d2"), ("c1", "d1"), ("d2", "d2")]
    assert N.Batches(spark, path).last() == 3


def test_broken_runs_add_all_or_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    batch = lambda *ids: spark.createDataFrame([(i, 0) for i in ids], "url string, pos int").repartition(2)
    append = lambda df: N.incremental_append(df, path, "url", ["pos"])
    urls = lambda: sorted(r.url for r in spark.read.parquet(path).collect())
    append(batch("a"))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # before the batch has its number
        patch.setattr(N.Batches, "take", broken)
        with pytest.raises(RuntimeError):
            append(batch("b", "c"))
    assert urls() == ["a"]
    with monkeypatch.context() as patch:  # with its number, before its files are in place
        finish = N.Batches.finish
        patch.setattr(N.Batches, "finish", lambda self, n: broken() if n == 2 else finish(self, n))
        with pytest.raises(RuntimeError):
            append(batch("b", "c"))
    append(batch("c", "d"))
    assert urls() == ["a", "b", "c", "d"]


def test_rows_without_a_key_are_not_appended_again_and_again(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), (None, 4)], "url string, pos int")
    for _ in range(3):
        N.incremental_append(rows, str(tmp_path / "t"), "url", ["pos"])
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [("a", 2)]


@pytest.mark.parametrize("rows_per_task", [10, 1_000_000])
def test_files_with_line_breaks_are_divided(spark, tmp_path, rows, rows_per_task):
    texts = ['a\nb', '"', 'say ""', "\n\n", "x,y\r\nz", "", "end\r", "plain", "long\n" * 40]
    lines = ["id,text,n"]
    for i in range(200):
        quoted = texts[i % len(texts)].replace('"', '""')
        lines += [f'{i},"{quoted}",{i if i % 7 else "bad"}'] + ([""] if i % 50 == 0 else [])
    path = tmp_path / "one.csv"
    path.write_bytes(("\ufeff" + "\r\n".join(lines) + "\r\n").encode())
    (tmp_path / "two.csv").write_bytes(b'id,text,n\n1000,"p\n""q",5')
    schema = "id int, text string, n int"
    both = [str(path), str(tmp_path / "two.csv")]
    # As in Spark's own reader, an empty field is null, quoted or not.
    expected = sorted([(i, texts[i % len(texts)] or None, i if i % 7 else None) for i in range(200)] + [(1000, 'p\n"q', 5)])
    by_one_task = C.read_typed(spark, both, schema, line_breaks=True).filter("id % 9 not in (4, 6)")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        divided = C.read_divided(spark, both, schema, rows_per_task=rows_per_task)
        assert spark.read.text(both).rdd.getNumPartitions() > 10
        assert sorted(tuple(r) for r in divided.collect()) == expected
        # The reader of one task gives carriage returns inside quotes as line feeds; else both agree.
        assert divided.filter("id % 9 not in (4, 6)").exceptAll(by_one_task).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
