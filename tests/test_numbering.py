import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators.numbering import dense_number, prefix_sum, rank_within


def test_dense_number_equals_row_number(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("abcde"), rnd.randint(0, 10_000), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, v int, u int")
    got = dense_number(df, ["g", "v", "u"], "id").select("u", "id")
    want = df.select("u", F.row_number().over(Window.orderBy("g", "v", "u")).alias("id"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dense_number_start_and_empty(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r["id"] for r in dense_number(df, ["k"], "id", start=101).orderBy("k").collect()] == [101, 102, 103]
    assert dense_number(df.where("k > 5"), ["k"], "id").count() == 0


def test_rank_within_equals_windowed_row_number(spark):
    rnd = random.Random(9)
    # one hot group holding most rows
    rows = [("hot" if rnd.random() < 0.7 else f"g{rnd.randint(0, 20)}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, o int")
    got = rank_within(df, ["g"], ["o"], "r").select("o", "r")
    want = df.select("o", (F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1).alias("r"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_prefix_sum(spark):
    rows = [(i % 3, i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, o int, v int")
    got = prefix_sum(df, ["g", "o"], "v", "before").select("g", "o", "before")
    w = Window.orderBy("g", "o").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("g", "o", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("before"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_repeated_keys_stay_dense(spark):
    rows = [("a", 1, "z"), ("a", 1, "y"), ("a", 2, "x"), ("b", 0, "w")]
    df = spark.createDataFrame(rows, "g string, k int, payload string")
    got = dense_number(df, ["g", "k", "payload"], "id")
    assert sorted((r["payload"], r["id"]) for r in got.collect()) == [("w", 4), ("x", 3), ("y", 1), ("z", 2)]
    uniq = dense_number(df.where("payload <> 'z'"), ["g", "k"], "id")
    assert sorted((r["payload"], r["id"]) for r in uniq.collect()) == [("w", 3), ("x", 2), ("y", 1)]
