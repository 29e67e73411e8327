import pytest
from pyspark.sql import functions as F

from headway.operators import cleaning
from headway.sources.reading import read_trips_csv
from tests.trips import CSV_COLUMNS


def test_names_lose_their_dots(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a.b", "a.c", "d"])
    assert cleaning.normalize_names(df).columns == ["ab", "ac", "d"]
    with pytest.raises(ValueError):
        cleaning.normalize_names(spark.createDataFrame([(1, 2)], ["a.b", "ab"]))


def test_available_keeps_the_order_asked_for(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["c", "a", "b"])
    assert cleaning.available(df, ["a", "x", "c"]) == ["a", "c"]


def test_cast_parse_and_drop(spark):
    df = spark.createDataFrame(
        [("1.5", "2024-01-01 00:00:00", "x"), ("abc", "never", "y"), (None, "2024-01-02", None), ("NaN", None, "z")],
        "v string, t string, n string",
    )
    typed = cleaning.parse_time(cleaning.cast_numeric(df, ["v", "gone"]), "t")
    assert [r["v"] for r in typed.collect()][:3] == [1.5, None, None]
    assert [r["t"] is None for r in typed.collect()] == [False, True, False, True]
    assert [r["n"] for r in cleaning.drop_incomplete(typed, ["v", "n"]).collect()] == ["x"]


def test_profile_counts_every_column_at_once(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a int, `b.c` string")
    assert [tuple(r) for r in cleaning.null_profile(df).collect()] == [("a", 1, 3), ("b.c", 2, 3)]
    assert [tuple(r) for r in cleaning.source_report(df).collect()] == [("a", "int", 3), ("b.c", "string", 3)]
    empty = df.limit(0)
    assert [tuple(r) for r in cleaning.null_profile(empty).collect()] == [("a", 0, 0), ("b.c", 0, 0)]


def test_malformed_lines_are_skipped_and_not_counted(spark, tmp_path):
    good = ["2024-01-01 00:00:00", "0", "M1", "O", "1", "2", "D", "3", "4", "40.7", "-74", "S", "12.5"]
    bad_number = [*good[:-1], "abc"]
    empty_name = [*good[:3], "", *good[4:]]
    lines = [CSV_COLUMNS, good, bad_number, empty_name, good[:5], [*good, "extra"]]
    path = tmp_path / "trips.csv"
    path.write_text("\n".join(",".join(line) for line in lines) + "\n")
    df = read_trips_csv(spark, str(path))
    assert df.columns == CSV_COLUMNS
    assert df.count() == 3  # also when no column is needed
    assert {r["n_rows"] for r in cleaning.source_report(df).collect()} == {3}
    named = cleaning.normalize_names(df)
    assert [r["OriginName"] for r in named.collect()] == ["O", "O", None]
    typed = cleaning.cast_numeric(named, ["DistanceFromStop"])
    assert [r[0] for r in typed.select("DistanceFromStop").collect()] == [12.5, None, 12.5]
    fixed = read_trips_csv(spark, str(path), CSV_COLUMNS)
    assert fixed.filter(F.col("OriginName").isNull()).count() == 1
