import statistics

import pytest
from pyspark.sql import functions as F

from skyloom.functions.flight import key_hash
from skyloom.operators import sampling


def table(spark, n=1000):
    return spark.range(n).selectExpr("id", "if(id % 10 = 0, 1, 0) as y")


@pytest.mark.parametrize("rows", [0, 1, 37, 1000, 5000])
def test_sample_size_is_exact(spark, rows):
    assert sampling.hash_sample(table(spark), ["id"], rows).count() == min(rows, 1000)


def test_sample_is_stable_under_partitioning_and_moves_with_the_seed(spark):
    ids = lambda df, seed=42: {r.id for r in sampling.hash_sample(df, ["id"], 100, seed).collect()}
    assert ids(table(spark).repartition(9)) == ids(table(spark).coalesce(1))
    assert ids(table(spark)) != ids(table(spark), 43)


def test_sample_grows_by_inclusion(spark):
    small = {r.id for r in sampling.hash_sample(table(spark), ["id"], 50).collect()}
    large = {r.id for r in sampling.hash_sample(table(spark), ["id"], 80).collect()}
    assert small < large


def test_strata_with_nulls(spark):
    df = spark.range(90).selectExpr("id", "case id % 3 when 0 then 'a' when 1 then 'b' end as s")
    out = sampling.hash_sample(df, ["id"], 7, strata="s").groupBy("s").count().collect()
    assert {(r.s, r["count"]) for r in out} == {("a", 7), ("b", 7), (None, 7)}


def test_stratified_split_is_exact_per_class(spark):
    out = sampling.split(table(spark), ["id"], stratify="y").groupBy("y", "is_test").count().collect()
    assert {(r.y, r.is_test): r["count"] for r in out} == {(0, True): 135, (0, False): 765, (1, True): 15, (1, False): 85}


def test_many_strata_need_no_broadcast(spark, monkeypatch):
    df = table(spark).withColumn("s", F.col("id") % 3)
    few = sampling.hash_sample(df, ["id"], 5, strata="s").collect()
    monkeypatch.setattr(sampling, "MAX_STRATA", 2)
    assert sorted(sampling.hash_sample(df, ["id"], 5, strata="s").collect()) == sorted(few)


def test_folds(spark):
    out = sampling.folds(table(spark), ["id"], 3).groupBy("fold").count().collect()
    assert {r.fold for r in out} == {0, 1, 2} and all(250 < r["count"] < 420 for r in out)
    assert [sampling.fold_count(n) for n in (0, 1, 2, 3, 99)] == [2, 2, 2, 3, 3]


def test_stratified_folds_differ_by_a_row_at_most(spark):
    df = table(spark).withColumn("s", F.when(F.col("id") % 7 > 0, F.col("id") % 3))
    out = sampling.folds(df, ["id"], 4, stratify="s")
    sizes = {}
    for r in out.groupBy("s", "fold").count().collect():
        sizes.setdefault(r.s, []).append(r["count"])
    assert out.count() == df.count() and out.columns == [*df.columns, "fold"]
    assert all(len(n) == 4 and max(n) - min(n) <= 1 for n in sizes.values()) and len(sizes) == 4


def test_different_keys_hash_differently(spark):
    keys = [("a", None), (None, "a"), ("a|b", "c"), ("a", "b|c"), (None, None), ("", ""), ("~", None), (None, "~"), ("1:a", "")]
    df = spark.createDataFrame(keys, "a string, b string").withColumn("h", key_hash(["a", "b"], 1))
    assert df.select("h").distinct().count() == len(keys)
    assert sampling.hash_sample(df.drop("h"), ["a", "b"], 4).count() == 4


def test_null_labels_keep_their_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "a")], "id int, y string")
    assert [r.weight for r in sampling.balanced_weights(df, "y").collect()] == [1.0] * 4


def test_standardise(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 6.0, 5.0)], "i int, x double, c double")
    out = sampling.standardise(df, ["x", "c"]).orderBy("i").collect()
    spread = statistics.pstdev([1.0, 2.0, 6.0])
    assert [r.x for r in out] == pytest.approx([(v - 3) / spread for v in (1, 2, 6)])
    assert [r.c for r in out] == [0.0, 0.0, 0.0]


def test_new_rows_scale_like_old_ones(spark):
    stats = sampling.scaling_stats(spark.createDataFrame([(0.0,), (10.0,)], "x double"), ["x"])
    assert sampling.standardise(spark.createDataFrame([(20.0,)], "x double"), ["x"], stats).first().x == 3.0


def test_balanced_weights(spark):
    out = sampling.balanced_weights(table(spark), "y").select("y", "weight").distinct().collect()
    assert {r.y: r.weight for r in out} == pytest.approx({0: 1000 / 1800, 1: 5.0})
