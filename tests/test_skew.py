import pytest
from pyspark.sql import functions as F

from clipwright.operators.ranking import ranked
from clipwright.operators.skew import heavy_keys, salted_aggregate, salted_join
from clipwright.operators.speakers import speaker_counts

SCHEMA = "k string, v long, x double, _salt string"


def rows(spark):
    data = [("hot", i % 40, float(i), "s") for i in range(300)] + [(f"c{i}", i, 1.0, None) for i in range(30)] + [(None, 1, 2.0, "n"), (None, None, None, "n"), ("hot", None, float("nan"), "s")]
    return spark.createDataFrame(data, SCHEMA)


def test_null_keys_of_left_joins_are_spread(spark):
    big = spark.createDataFrame([(None, i) for i in range(40)] + [("a", 1), ("b", 2)], "k string, i int")
    small = spark.createDataFrame([("a", 9), (None, 8)], "k string, v int")
    for heavy in ([], ["a"]):
        got = salted_join(big, small, "k", heavy=heavy, how="left").collect()
        assert len(got) == 42 and [(r["k"], r["i"]) for r in got if r["v"]] == [("a", 1)]
        assert salted_join(big, small, "k", heavy=heavy, how="left_anti").count() == 41


def test_heavy_keys_are_those_above_the_share(spark):
    assert heavy_keys(rows(spark), "k", 0.1) == ["hot"]
    assert heavy_keys(rows(spark).limit(0), "k") == []
    with pytest.raises(ValueError):
        heavy_keys(rows(spark), "k", 0)


@pytest.mark.parametrize("share", [1.0, 0.1, 0.001])
def test_salted_aggregate_equals_group_by(spark, share):
    df = rows(spark)
    spec = {"n": ("rows", None), "vs": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "x"), "hi": ("max", "x"), "m": ("avg", "v"), "d": ("count_distinct", "v")}
    got = salted_aggregate(df, "k", spec, share=share, salts=7)
    want = df.groupBy("k").agg(F.count("*").alias("n"), F.count("v").alias("vs"), F.sum("v").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("v").alias("m"), F.countDistinct("v").alias("d"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_salted_aggregate_edges(spark):
    assert salted_aggregate(rows(spark).limit(0), "k", {"n": ("rows", None)}).collect() == []
    with pytest.raises(ValueError):
        salted_aggregate(rows(spark), "k", {"a": ("count_distinct", "v"), "b": ("count_distinct", "x")})
    with pytest.raises(ValueError):
        salted_aggregate(rows(spark), "k", {"a": ("median", "v")})


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    df = rows(spark).drop("_salt")
    small = spark.createDataFrame([("hot", 1), ("c1", 2), ("c2", 3)], "k string, w int")
    got, want = salted_join(df, small, "k", heavy=["hot"], how=how, salts=5), df.join(small, "k", how)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("share", [1.0, 0.05])
def test_ranked_equals_row_number(spark, share):
    df = spark.createDataFrame([("hot", (i * 7919) % 5, i) for i in range(500)] + [("a", 1, 1), ("a", 0, 2), (None, 3, 3)], "g string, o int, i int")
    got = {(r["g"], r["i"]): r["r"] for r in ranked(df, "g", [F.col("o"), F.col("i")], "r", share=share, pieces=6).collect()}
    want = {}
    for g in ("hot", "a", None):
        for n, r in enumerate(sorted((r for r in df.collect() if r["g"] == g), key=lambda r: (r["o"], r["i"])), 1):
            want[g, r["i"]] = n
    assert got == want


def test_speaker_counts(spark):
    df = spark.createDataFrame([("a", "1", 2), ("a", "1", None), ("a", "2", 2), ("b", "3", 2), ("c", None, None), (None, "9", 9)], "source_speaker_id string, source_id string, speaker_clip_count int")
    got = {r["source_speaker_id"]: (r["rows"], r["clips"], r["stale"]) for r in speaker_counts(df).collect()}
    assert got == {"a": (3, 2, False), "b": (1, 1, True), "c": (1, 0, False)}
    assert speaker_counts(df.limit(0)).count() == 0
