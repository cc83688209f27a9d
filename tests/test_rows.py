import pytest
from pyspark.sql import functions as F

from matchloom.operators import filters as R
from matchloom.operators import quality as Q
from matchloom.operators.views import dataset_view


def test_null_filters(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, None), (None, None)], "a int, b int")
    assert rows(R.drop_any_null(df, ["a", "b"])) == [(1, 1)]
    assert df.count() - R.drop_all_null(df).count() == 1
    assert R.keep_keyed(df, "a").count() == 2


def test_sentinels_and_summary_rows(spark, rows):
    df = spark.createDataFrame([("",), ("Player",), ("Bench",), ("Starting XI",), (None,), ("16 Players",), ("Ann",)], "p string")
    assert rows(R.drop_sentinels(df, "p")) == [("16 Players",), ("Ann",)]
    kept = {r.p for r in R.drop_summary_rows(df, "p").collect()}
    assert kept == {"", "Player", "Bench", "Starting XI", None, "Ann"}


def test_blank_rows(spark, rows):
    df = spark.createDataFrame([(1, " ", ""), (2, " ", None), (3, None, None), (4, " x", None)], "k int, a string, b string")
    assert rows(R.drop_blank_rows(df, ["a", "b"]), "k") == [(2,), (3,), (4,)]
    assert rows(R.drop_blank_rows(df, ["a", "b"], null_is_blank=True), "k") == [(4,)]


def test_filled_tables(spark, rows):
    df = spark.createDataFrame([("t", 1, None), ("t", 1, 2), ("u", None, 1), ("u", 1, None)], "t string, a int, b int")
    assert {r.t for r in R.keep_filled_tables(df, ["t"], ["a", "b"]).collect()} == {"t"}


def test_ids(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "match_id int, x string")
    ids = spark.createDataFrame([(2,), (2,), (9,)], "match_id int")
    assert rows(R.keep_ids(df, ids, "match_id", required=True)) == [(2, "b")]
    with pytest.raises(ValueError, match="no rows found"):
        R.keep_ids(df, ids.filter("match_id = 9"), "match_id", required=True)


def test_first_and_latest(spark, rows):
    df = spark.createDataFrame([(0, "b", 1), (1, "a", 2), (2, "b", 3)], "pos int, url string, v int")
    assert rows(R.first_seen(df, ["url"], ["pos"]).orderBy("pos")) == [(0, "b", 1), (1, "a", 2)]
    assert rows(R.latest(df, ["url"], ["pos"])) == [(1, "a", 2), (2, "b", 3)]
    assert R.latest(df, ["url"], ["pos"]).columns == df.columns


def test_quarantine_loses_nothing(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "a int")
    good, bad = R.quarantine(df, F.col("a") > 0)
    assert (good.count(), bad.count()) == (1, 2)


def test_samples(spark):
    df = spark.range(100)
    assert R.stable_sample(df, 7, "id").collect() == R.stable_sample(df.repartition(3), 7, "id").collect()
    assert R.random_sample(df, 7, seed=1).count() == 7


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert rows(Q.null_profile(df)) == [("a", 2, 0, False), ("b", 2, 2, True)]
    assert rows(Q.quality_counts(df, {"big": F.col("a") > 1})) == [(2, 1)]
    assert rows(Q.distinct_count(df, [], "a", "n")) == rows(Q.distinct_count(df, [], "a", "n", approximate=True)) == [(2,)]


def test_name_dictionary(spark, rows):
    df = spark.createDataFrame([("Alavés",), ("alaves",), ("Celta Vigo",), (None,)], "n string")
    assert rows(Q.name_dictionary(df, "n")) == [("alaves", "alaves", 2), ("celta vigo", "Celta Vigo", 1)]


@pytest.fixture
def games(spark):
    data = [("ENG", "1718", 1, "A"), ("ENG", "1819", 2, "B"), ("ESP", "1718", 3, "A2")]
    return spark.createDataFrame(data, "league string, season string, match_id int, team string")


def test_views(spark, games, rows):
    ids = lambda **choice: [r[0] for r in rows(dataset_view(games, **choice), "match_id")]
    assert ids() == [1, 2, 3]
    assert ids(leagues="ENG", seasons=["17-18", 2018]) == [1, 2]
    assert ids(seasons=range(2017, 2018)) == [1, 3]
    assert ids(match_id=[2, 3]) == [2, 3]
    assert ids(match_id=2, required=True) == [2]
    aliases = spark.createDataFrame([("A", "A2")], "canonical string, alias string")
    assert ids(team="A2", aliases=aliases) == ids(team="A", aliases=aliases) == [1, 3]
    assert ids(team="A") == [1]


def test_views_without_data_and_with_errors(games):
    empty = dataset_view(games, seasons="90-91")
    assert empty.count() == 0 and empty.columns == games.columns
    with pytest.raises(ValueError, match="No matches found"):
        dataset_view(games, match_id=99, required=True)
    with pytest.raises(ValueError, match="Invalid season"):
        dataset_view(games, seasons="next")


def test_seasons_prune_partitions(spark, games, tmp_path):
    games.write.partitionBy("league", "season").parquet(str(tmp_path / "g"))
    view = dataset_view(spark.read.parquet(str(tmp_path / "g")), leagues=["ENG"], seasons=["17-18"])
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "1718" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len(view.inputFiles()) >= 1 and view.count() == 1
