"""The split follows the key, not the file layout; fit leaves the caller's cache alone; train and predict jobs."""

import re

import pytest
from pyspark.sql import functions as F

from tagweave.operators import ml
from tagweave.plans import cli, registry

from conftest import SF_CHECK


def _rows(spark, n=400):
    return spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                 F.when(F.col("id") % 7 < 3, "yes").otherwise("no").alias("label"))


def test_split_is_stable_and_whole(spark):
    df = _rows(spark)
    one = {r["id"]: r["part"] for r in ml.split(df.repartition(5), "id").collect()}
    two = {r["id"]: r["part"] for r in ml.split(df.repartition(2, "a"), "id").collect()}
    assert one == two and len(one) == 400
    assert 0.6 < sum(p == "train" for p in one.values()) / 400 < 0.8
    other = {r["id"]: r["part"] for r in ml.split(df, "id", seed=7).collect()}
    assert other != one


def test_fit_keeps_the_callers_cache(spark):
    df = _rows(spark).cache()
    ml.TagClassifier("label", ["a", "b"], max_bins=32).fit(df)
    assert df.storageLevel.useMemory
    df.unpersist()
    fresh = _rows(spark, 401)
    clf = ml.TagClassifier("label", ["a", "b"], max_bins=32).fit(fresh)
    assert not fresh.storageLevel.useMemory
    assert sum(v for _, v in clf.feature_importances()) == pytest.approx(1.0)
    assert "a" == max(clf.feature_importances(), key=lambda x: x[1])[0] and "If" in clf.tree_text()


def test_tree_text_has_the_reference_depth(spark):
    text = registry.QUERIES["tree_text"](spark, SF_CHECK).first()["tree"]
    assert "depth=5," in text
    assert len(set(re.findall(r"feature (\d+)", text))) > 1


def test_train_and_predict_jobs(spark, tmp_root, capsys):
    _rows(spark).write.parquet(f"{tmp_root}/data")
    common = ["--data", f"{tmp_root}/data", "--label", "label", "--features", "a,b"]
    cli.main(["train", f"{tmp_root}/model", *common, "--key", "id"], spark=spark)
    assert "held-out accuracy" in capsys.readouterr().out
    cli.main(["predict", f"{tmp_root}/model", *common, "--output", f"{tmp_root}/out"], spark=spark)
    out = spark.read.parquet(f"{tmp_root}/out")
    assert out.count() == 400 and out.columns == ["id", "a", "b", "label", ml.PREDICTION_ORIGIN]
    with pytest.raises(SystemExit):
        cli.main(["predict", f"{tmp_root}/model", *common], spark=spark)


def test_input_database(spark, tmp_root):
    """Unqualified names of the tag SQL resolve in the named database."""
    from tagweave.sources.catalog import catalog_from_rows
    from tagweave.sources.tables import TagStore
    spark.sql(f"create database if not exists src_db location '{tmp_root}/db'")
    spark.sql("create table if not exists src_db.people using parquet as select 1L uid, 5L query_value")
    c = catalog_from_rows(spark, [{"id": 1, "task_status": "1", "task_sql": "select * from people"}],
                          [{"id": 1, "tag_code": "T", "tag_name": "t", "tag_value_type": "1", "tag_task_id": 1}], [])
    for name in ("task_info", "tag_info", "task_tag_rule"):
        getattr(c, name).write.parquet(f"{tmp_root}/catalog/{name}")
    try:
        cli.main(["tag", "1", "2000-01-01", "--catalog-dir", f"{tmp_root}/catalog", "--store", f"{tmp_root}/store",
                  "--input-database", "src_db"], spark=spark)
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("drop database src_db cascade")
    assert TagStore(spark, f"{tmp_root}/store").read_tag_day("T", "1", "2000-01-01").count() == 1
