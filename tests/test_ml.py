import pytest
from pyspark.sql import functions as F

from tagweave.operators.ml import TagClassifier, accuracy, confusion, encode_categories, precision_recall


@pytest.fixture(scope="module")
def students(spark):
    rows = []
    for i in range(300):
        hair = ["long", "short", "crew"][i % 3]
        skirt = "yes" if hair == "long" else "no"
        rows.append((i, hair, 150.0 + i % 40, skirt, ["80s", "90s", "00s"][i % 3], "F" if hair == "long" else "M"))
    df = spark.createDataFrame(rows, "uid long, hair string, height double, skirt string, age string, gender string")
    return encode_categories(df, {"hair": {"long": 101, "short": 102, "crew": 103},
                                  "skirt": {"yes": 11, "no": 12},
                                  "age": {"80s": 80, "90s": 90, "00s": 100}})


def test_encode_categories_null_without_code(spark):
    df = spark.createDataFrame([("a",), ("zz",)], "c string")
    assert [r.c for r in encode_categories(df, {"c": {"a": 1}}).collect()] == [1, None]


def test_train_predict_report(spark, students):
    clf = TagClassifier("gender", ["hair", "height", "skirt", "age"], max_categories=5, max_depth=6, max_bins=3)
    with pytest.raises(RuntimeError):
        clf.predict(students)
    clf.fit(students)
    pred = clf.predict(students)
    assert accuracy(pred).first().accuracy == 1.0
    pr = {r.label: (r.precision, r.recall) for r in precision_recall(pred).collect()}
    assert pr == {0.0: (1.0, 1.0), 1.0: (1.0, 1.0)}
    assert confusion(pred).agg(F.sum("n")).first()[0] == 300
    back = clf.label_back(pred)
    assert back.filter(F.col("prediction_origin") != F.col("gender")).count() == 0
    assert clf.labels() == ["M", "F"]  # most frequent label first
    assert "If (feature" in clf.tree_text()
    assert dict(clf.feature_importances())["height"] == 0.0


def test_unseen_category_row_skipped(spark, students):
    clf = TagClassifier("gender", ["hair", "skirt"], max_bins=5).fit(students)
    odd = spark.createDataFrame([(999, 104, 11, "F")], "uid long, hair int, skirt int, gender string")
    assert clf.predict(odd).count() == 0


def test_max_bins_below_categories_fails(spark, students):
    with pytest.raises(Exception):
        TagClassifier("gender", ["hair", "age"], max_categories=5, max_bins=2).fit(students)


def test_model_roundtrip(spark, students, tmp_root):
    clf = TagClassifier("gender", ["hair", "skirt", "age"]).fit(students)
    clf.save(tmp_root + "/m")
    again = TagClassifier("gender", ["hair", "skirt", "age"]).load(tmp_root + "/m")
    a = clf.predict(students).select("uid", "prediction")
    b = again.predict(students).select("uid", "prediction")
    assert a.exceptAll(b).count() == 0


def test_null_feature_and_unseen_label_fail(spark, students):
    clf = TagClassifier("gender", ["hair", "height"], max_bins=5).fit(students)
    with_null = spark.createDataFrame([(1, 101, None, "F")], "uid long, hair int, height double, gender string")
    with pytest.raises(Exception):
        clf.predict(with_null).collect()
    unseen = spark.createDataFrame([(1, 101, 160.0, "X")], "uid long, hair int, height double, gender string")
    with pytest.raises(Exception):
        clf.predict(unseen).collect()
