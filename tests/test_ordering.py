import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from headway.operators import ordering

SIZES = [0, 1, 2, 3, 9, 10, 11, 90]


def _timed(spark, n, step=60):
    return spark.range(n).select(
        F.col("id"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * step * 1_000_000).alias("t")
    )


@pytest.mark.parametrize("partitions", [1, 4, 200])
def test_row_number_equals_the_plain_window(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(3000).select("id", F.pmod(F.xxhash64("id"), F.lit(17)).alias("k")).repartition(6)
        got = ordering.global_row_number(df, ["k", "id"])
        want = df.withColumn("want", F.row_number().over(Window.orderBy("k", "id")))
        both = got.join(want, "id")
        assert both.count() == 3000
        assert both.filter(F.col("rn") != F.col("want")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_row_number_of_nothing(spark):
    assert ordering.global_row_number(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("n", SIZES)
def test_split_sizes(spark, n):
    split = ordering.fit_chrono_split(_timed(spark, n), "t", ["id"])
    assert (split.n_train, split.n_test) == (int(0.7 * n), int(0.2 * n))
    counts = {r["split"]: r["n"] for r in ordering.split_counts(split.apply(_timed(spark, n))).collect()}
    want = {"train": split.n_train, "test": split.n_test, "val": split.n_val}
    assert counts == {k: v for k, v in want.items() if v}


def test_parts_are_in_time_order_and_disjoint(spark):
    df = _timed(spark, 500, step=7000).repartition(7)
    split = ordering.fit_chrono_split(df, "t", ["id"])
    parts = {p: [r["id"] for r in split.rows(df, p).collect()] for p in ("train", "test", "val")}
    assert sorted(sum(parts.values(), [])) == list(range(500))
    assert max(parts["train"]) < min(parts["test"]) <= max(parts["test"]) < min(parts["val"])
    marked = split.apply(df)
    for name, ids in parts.items():
        assert sorted(r["id"] for r in marked.filter(F.col("split") == name).collect()) == sorted(ids)
    with pytest.raises(ValueError):
        split.rows(df, "other")


def test_a_date_column_is_split(spark):
    df = spark.range(200).select("id", F.date_add(F.lit("2024-01-01"), (F.col("id") / 15).cast("int")).alias("t"))
    got = {r["id"]: r["split"] for r in ordering.chrono_split(df, "t", ["id"]).collect()}
    assert got == {i: ("train" if i < 140 else "test" if i < 180 else "val") for i in range(200)}


def test_ties_are_broken_by_the_key_even_in_one_hot_second(spark):
    """A third and more of the rows share one time."""
    moment = dt.datetime(2024, 5, 1, 12, 0, 0)
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 3 > 0, F.lit(moment)).otherwise(F.lit(moment) + F.make_dt_interval(F.col("id") - 150)).alias("t"),
        F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(100_000)).cast("string"), 5, "0")).alias("name"),
    )
    rows = sorted(df.collect(), key=lambda r: (r["t"], r["name"], r["id"]))
    want = {r["id"]: ("train" if i < 210 else "test" if i < 270 else "val") for i, r in enumerate(rows)}
    got = {r["id"]: r["split"] for r in ordering.chrono_split(df, "t", ["name", "id"]).collect()}
    assert got == want


def test_rows_alike_at_a_boundary_are_refused(spark):
    same = spark.range(10).select(F.lit(dt.datetime(2024, 1, 1)).alias("t"), F.lit(1).alias("k"))
    with pytest.raises(ValueError):
        ordering.fit_chrono_split(same, "t", ["k"])


def test_rows_without_time_are_left_out_and_null_keys_come_first(spark):
    rows = [(None, 1), (dt.datetime(2024, 1, 1), None), *[(dt.datetime(2024, 1, 1), k) for k in range(9)]]
    df = spark.createDataFrame(rows, "t timestamp, k int")
    got = {r["k"]: r["split"] for r in ordering.chrono_split(df, "t", ["k"]).collect()}
    assert len(got) == 10 and got[None] == "train" and got[8] == "val"
    assert sum(v == "train" for v in got.values()) == 7


def test_time_without_zone(spark):
    df = _timed(spark, 40).withColumn("t", F.col("t").cast("timestamp_ntz"))
    counts = {r["split"]: r["n"] for r in ordering.split_counts(ordering.chrono_split(df, "t", ["id"])).collect()}
    assert counts == {"train": 28, "test": 8, "val": 4}


def test_hash_split_does_not_depend_on_partitions(spark):
    df = spark.range(20_000)
    a = {r["id"]: r["split"] for r in ordering.hash_split(df.repartition(3), "id").collect()}
    b = {r["id"]: r["split"] for r in ordering.hash_split(df.repartition(11), "id").collect()}
    assert a == b
    share = {s: sum(v == s for v in a.values()) / len(a) for s in ("train", "test", "val")}
    assert share["train"] == pytest.approx(0.7, abs=0.02)
    assert share["test"] == pytest.approx(0.201, abs=0.02)
    other = {r["id"]: r["split"] for r in ordering.hash_split(df, "id", seed=7).collect()}
    assert other != a
