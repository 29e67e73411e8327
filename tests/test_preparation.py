import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from headway.operators import categories, preparation


def _rows(spark):
    return spark.createDataFrame(
        [(1.0, None, 5.0, "a"), (2.0, 4.0, 5.0, "b"), (None, 8.0, 5.0, "a"), (6.0, 6.0, 5.0, "a")],
        "x double, y double, c double, g string",
    )


def test_means_and_fill(spark):
    means = preparation.fit_means(_rows(spark), ["x", "y"])
    assert means == {"x": 3.0, "y": 6.0}
    filled = preparation.mean_fill(_rows(spark), means).collect()
    assert [r["x"] for r in filled] == [1.0, 2.0, 3.0, 6.0]
    assert [r["y"] for r in filled] == [6.0, 4.0, 8.0, 6.0]


def test_scaling_and_back(spark):
    scaling = preparation.fit_scaling(_rows(spark), ["x", "c"])
    scaled = preparation.standardize(_rows(spark), scaling)
    assert scaled.agg(F.avg("x")).first()[0] == pytest.approx(0)
    assert scaled.agg(F.stddev_samp("x")).first()[0] == pytest.approx(1)
    assert {r["c"] for r in scaled.collect()} == {0.0}
    back = preparation.unstandardize(scaled, scaling).collect()
    assert [r["x"] for r in back] == pytest.approx([1.0, 2.0, None, 6.0]) or back[2]["x"] is None
    assert [r["c"] for r in back] == [5.0] * 4


def test_feature_pipeline(spark):
    model = preparation.fit_features(_rows(spark), ["x", "y", "c"])
    values = [r[0] for r in model.transform(_rows(spark)).select(vector_to_array("scaledFeatures")).collect()]
    for i in (0, 1):
        column = [v[i] for v in values]
        assert sum(column) == pytest.approx(0)
        assert sum(v * v for v in column) / 3 == pytest.approx(1)
    assert [v[2] for v in values] == [0.0] * 4


def test_a_feature_without_values_is_refused(spark):
    rows = _rows(spark).withColumn("none", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="surrogate"):
        preparation.fit_features(rows, ["x", "none"])


def _codes(df, column="g"):
    return {r[column]: r[f"{column}_code"] for r in df.select(column, f"{column}_code").distinct().collect()}


def _words(spark, n=300):
    """Values with unlike counts, ties among them, and nulls."""
    rows = [(f"v{i:03d}",) for i in range(n) for _ in range(1 + i % 7)] + [(None,)] * 5
    return spark.createDataFrame(rows, "g string")


def _want(spark, n=300):
    return {v: float(i) for i, v in enumerate(sorted((f"v{i:03d}" for i in range(n)), key=lambda v: (-(int(v[1:]) % 7), v)))}


@pytest.mark.parametrize("sent, size", [(100_000, 1 << 24), (10, 1 << 24), (300, 0)])
def test_codes_by_count_and_name(spark, monkeypatch, sent, size):
    """Also with a tail that is joined by shuffle, and with values too long to be sent."""
    monkeypatch.setattr(categories, "SENT_VALUES", sent)
    monkeypatch.setattr(categories, "SENT_BYTES", size)
    rows = _words(spark)
    dictionary = categories.fit_dictionaries(rows, ["g"])["g"]
    assert dictionary.size == 300
    coded = categories.encode(rows, {"g": dictionary})
    assert coded.count() == rows.count()
    assert _codes(coded) == {**_want(spark), None: 300.0}
    unseen = spark.createDataFrame([("new",), (None,)], "g string")
    assert set(_codes(categories.encode(unseen, {"g": dictionary})).values()) == {300.0}


def test_dictionaries_of_several_columns_and_of_none(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", None)], "g string, h string")
    found = categories.fit_dictionaries(rows, ["h", "g"])
    assert {c: [(r["value"], r["code"]) for r in d.table.orderBy("code").collect()] for c, d in found.items()} == {
        "h": [("x", 0)], "g": [("a", 0), ("b", 1)],
    }
    empty = categories.fit_dictionaries(rows.filter("g = 'z'"), ["g"])
    assert empty["g"].size == 0 and _codes(categories.encode(rows, empty)) == {"a": 0.0, "b": 0.0}
    assert categories.fit_dictionaries(rows, []) == {} and categories.encode(rows, {}) is rows


def test_categories_are_encoded_on_request(spark):
    rows = _rows(spark)
    dictionaries = categories.fit_dictionaries(rows, ["g"])
    coded = categories.encode(rows, dictionaries)
    model = preparation.fit_features(coded, ["x"], ["g_code"])
    found = {(r["x"], r["g"]): list(r["scaledFeatures"].toArray()[1:]) for r in model.transform(coded).collect()}
    assert found[1.0, "a"] == [1.0, 0.0] and found[2.0, "b"] == [0.0, 1.0]
    unseen = categories.encode(spark.createDataFrame([(3.0, "new")], "x double, g string"), dictionaries)
    vector = model.transform(unseen).first()["scaledFeatures"]
    assert list(vector.toArray()) == [0.0, 0.0, 0.0] and len(vector.indices) == 0  # sparse, and without a slot
    assert preparation.slot_names(["x"], {"g": 2}) == ["x", "g", "g"]
