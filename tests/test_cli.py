"""The spark-submit entry point, with the catalog read from Parquet folders."""

import pytest

from tagweave.plans import cli
from tagweave.plans.profile import demo_catalog
from tagweave.sources.tables import TagStore

from conftest import SF_SMALL


def test_cli_daily_flow(spark, tmp_root):
    cat = demo_catalog(spark)
    for name, df in (("task_info", cat.task_info), ("tag_info", cat.tag_info), ("task_tag_rule", cat.task_tag_rule)):
        df.write.parquet(f"{tmp_root}/catalog/{name}")
    common = ["--catalog-dir", f"{tmp_root}/catalog", "--store", f"{tmp_root}/store",
              "--input", f"customer={SF_SMALL}/customer.parquet", "--input", f"orders={SF_SMALL}/orders.parquet",
              "--input", f"events={SF_SMALL}/events.parquet"]
    for task in (1, 2, 3, 4, 5, 6, 8, 9):
        cli.main(["tag", str(task), "2000-01-01", *common], spark=spark)
    cli.main(["merge", "2000-01-01", *common], spark=spark)
    cli.main(["bitmap", "2000-01-01", *common], spark=spark)
    store = TagStore(spark, f"{tmp_root}/store")
    wide = store.read_wide("2000-01-01")
    assert wide.columns[0] == "uid" and len(wide.columns) == 9 and wide.count() > 0
    assert store.read_bitmap_day("3", "2000-01-01").count() > 0
    with pytest.raises(SystemExit):
        cli.main(["tag", "2000-01-01", *common], spark=spark)
    with pytest.raises(SystemExit):
        cli.main(["export", "2000-01-01", *common], spark=spark)


def test_tags_backfill_and_merge_jobs(spark, tmp_root, monkeypatch):
    from tagweave.plans import cli, profile, registry
    from tagweave.sources.tables import TagStore

    catalog = registry._setup(spark, "/root/testdata/sf0.001")
    for name in ("task_info", "tag_info", "task_tag_rule"):
        getattr(catalog, name).write.parquet(f"{tmp_root}/catalog/{name}")
    common = ["--catalog-dir", f"{tmp_root}/catalog", "--store", f"{tmp_root}/store"]
    cli.main(["tags", profile.BUSINESS_DATE, *common], spark=spark)
    cli.main(["backfill", "2", "1996-03-01", "1996-03-03", *common], spark=spark)
    cli.main(["merge", profile.BUSINESS_DATE, *common], spark=spark)
    store = TagStore(spark, f"{tmp_root}/store")
    days = {r["dt"] for r in store.read_tag_table("TAG_ORDER_COUNT", "1").select("dt").distinct().collect()}
    assert days == {"1996-03-01", "1996-03-02", "1996-03-03", profile.BUSINESS_DATE}
    want = registry.wide_pivot(spark, "/root/testdata/sf0.001")
    assert sorted(map(str, store.read_wide(profile.BUSINESS_DATE).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(SystemExit):
        cli.main(["backfill", "2", "1996-03-01", *common], spark=spark)


def test_train_takes_the_trees_parameters(spark, tmp_root, capsys):
    from tagweave.operators import ml
    from tagweave.plans import cli

    rows = spark.range(500).selectExpr("id", "cast(id % 11 as double) a", "cast(id % 3 as double) b",
                                       "case when id % 11 < 4 then 'x' when id % 3 = 1 then 'y' else 'z' end label")
    rows.write.parquet(f"{tmp_root}/data")
    common = ["--data", f"{tmp_root}/data", "--label", "label", "--features", "a,b"]
    texts = {}
    for depth in (1, 6):
        cli.main(["train", f"{tmp_root}/m{depth}", *common, "--key", "id", "--max-depth", str(depth), "--max-bins", "12"], spark=spark)
        texts[depth] = ml.TagClassifier("label", ["a", "b"]).load(f"{tmp_root}/m{depth}").tree_text()
    assert "depth=1," in texts[1] and "depth=1," not in texts[6]
    capsys.readouterr()
    cli.main(["predict", f"{tmp_root}/m6", *common, "--output", f"{tmp_root}/out"], spark=spark)
    assert "rows_in: 500, rows_scored: 500, rows_skipped: 0" in capsys.readouterr().out
