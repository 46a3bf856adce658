"""Run the daily jobs from ``spark-submit``.

    spark-submit --py-files tagweave.zip tagweave/plans/cli.py tag    <task_id> <yyyy-MM-dd> --catalog-dir DIR | --catalog-jdbc URL
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py tags   <yyyy-MM-dd> ...      (all active tags, one pass a source)
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py backfill <task_id> <first day> <last day> ...
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py merge  <yyyy-MM-dd> ...
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py bitmap <yyyy-MM-dd> ...
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py export <yyyy-MM-dd> --serving-jdbc URL ...
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py train   <model_dir> --data DIR --key COL --label COL --features A,B
    spark-submit --py-files tagweave.zip tagweave/plans/cli.py predict <model_dir> --data DIR --label COL --features A,B --output DIR

The catalog comes from a JDBC database (``--catalog-jdbc``, credentials via
``--catalog-user`` / ``--catalog-password-file``) or from Parquet folders
``task_info``, ``tag_info`` and ``task_tag_rule`` under ``--catalog-dir``.
Tables go under ``--store`` (default: ``<spark.checkpoint.dir>/profile``).
Tag SQL sees the tables of the session's catalog (unqualified names resolve in
``--input-database``), plus any Parquet tables named with ``--input name=path``.
``train`` fits on the hash-split training part with the tree's parameters
(``--max-depth``, ``--max-bins`` ...), prints the held-out accuracy and saves the
model; ``predict`` writes the rows of ``--data`` with their predicted label,
published when complete, and prints how many rows were scored and skipped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tagweave.operators import ml
from tagweave.operators.export import EXPORT_TEXT_TYPE, export_wide_jdbc
from tagweave.plans import jobs
from tagweave.session import storage_root
from tagweave.sources.catalog import Catalog, active_tag_list, read_catalog_jdbc
from tagweave.sources.jdbc import EXPORT_BATCH_SIZE, EXPORT_ISOLATION, EXPORT_PARTITIONS
from tagweave.sources.tables import TagStore
from tagweave.functions.values import wide_table_name


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagweave")
    p.add_argument("job", choices=["tag", "tags", "backfill", "merge", "bitmap", "export", "train", "predict"])
    p.add_argument("args", nargs="+", help="tag: <task_id> <date>; backfill: <task_id> <first> <last>; tags, merge, bitmap, export: <date>; train, predict: <model_dir>")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--catalog-dir")
    src.add_argument("--catalog-jdbc")
    p.add_argument("--catalog-user")
    p.add_argument("--catalog-password-file")
    p.add_argument("--store")
    p.add_argument("--catalog-tables", action="store_true",
                   help="also keep tag tables as catalog tables (metastore), readable by name")
    p.add_argument("--database")
    p.add_argument("--input", action="append", default=[], metavar="NAME=PATH")
    p.add_argument("--input-database", help="database in which the tag SQL's unqualified names resolve")
    p.add_argument("--serving-jdbc")
    p.add_argument("--serving-table-options")
    p.add_argument("--serving-user")
    p.add_argument("--serving-password-file")
    p.add_argument("--serving-driver", help="JDBC driver class")
    p.add_argument("--serving-batch-size", type=int, default=EXPORT_BATCH_SIZE)
    p.add_argument("--serving-isolation", default=EXPORT_ISOLATION)
    p.add_argument("--serving-partitions", type=int, default=EXPORT_PARTITIONS)
    p.add_argument("--serving-text-type", default=EXPORT_TEXT_TYPE, help="column type of the tag columns")
    p.add_argument("--data", help="Parquet folder of the rows to train on or to predict")
    p.add_argument("--key", help="column whose hash splits training and held-out rows")
    p.add_argument("--label")
    p.add_argument("--features", help="comma-separated numeric columns")
    p.add_argument("--output")
    defaults = ml.TagClassifier("label", ["feature"])
    for name in ("max_categories", "max_bins", "max_depth", "min_instances_per_node"):
        p.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(defaults, name))
    p.add_argument("--min-info-gain", type=float, default=defaults.min_info_gain)
    p.add_argument("--impurity", choices=["gini", "entropy"], default=defaults.impurity)
    p.add_argument("--seed", type=int)
    return p


def _catalog(spark: SparkSession, ns) -> Catalog:
    if ns.catalog_dir:
        root = ns.catalog_dir.rstrip("/")
        return Catalog(*(spark.read.parquet(f"{root}/{name}")
                         for name in ("task_info", "tag_info", "task_tag_rule")))
    return read_catalog_jdbc(spark, ns.catalog_jdbc, _credentials(ns.catalog_user, ns.catalog_password_file))


def _credentials(user: str | None, password_file: str | None, driver: str | None = None) -> dict[str, str]:
    props = {}
    if user:
        props["user"] = user
    if password_file:
        with open(password_file, encoding="utf-8") as fh:
            props["password"] = fh.read().strip()
    if driver:
        props["driver"] = driver
    return props


def _need(ns, *names: str) -> None:
    missing = [f"--{n}" for n in names if not getattr(ns, n)]
    if missing:
        raise SystemExit(f"{ns.job} needs {', '.join(missing)}")


def _model_job(spark: SparkSession, ns) -> None:
    _need(ns, "data", "label", "features")
    data = spark.read.parquet(ns.data)
    clf = ml.TagClassifier(ns.label, ns.features.split(","), ns.max_categories, ns.max_bins, ns.max_depth,
                           ns.min_instances_per_node, ns.min_info_gain, ns.impurity, ns.seed)
    if ns.job == "train":
        _need(ns, "key")
        rows = ml.split(data, ns.key)
        clf.fit(ml.part(rows, "train")).save(ns.args[0])
        held_out = ml.accuracy(clf.predict(ml.part(rows, "test"))).first()["accuracy"]
        print(f"held-out accuracy: {held_out}")
    else:
        _need(ns, "output")
        _, counts = ml.score(clf.load(ns.args[0]), data, ns.output, [*data.columns, ml.PREDICTION_ORIGIN])
        print(", ".join(f"{k}: {n}" for k, n in counts.items()))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ns = _parser().parse_args(argv)
    names = {"tag": "<task_id> <date>", "backfill": "<task_id> <first> <last>"}.get(ns.job, "<argument>")
    if len(ns.args) != len(names.split()):
        raise SystemExit(f"{ns.job} takes {names}")
    spark = spark or SparkSession.builder.appName(f"tagweave-{ns.job}").getOrCreate()
    if ns.job in ("train", "predict"):
        _model_job(spark, ns)
        return
    for item in ns.input:
        name, _, path = item.partition("=")
        spark.read.parquet(path).createOrReplaceTempView(name)
    if not (ns.catalog_dir or ns.catalog_jdbc):
        raise SystemExit(f"{ns.job} needs --catalog-dir or --catalog-jdbc")
    catalog = _catalog(spark, ns)
    if ns.input_database:
        spark.catalog.setCurrentDatabase(ns.input_database)
    store = TagStore(spark, ns.store or f"{storage_root(spark)}/profile",
                     catalog_tables=ns.catalog_tables, database=ns.database)
    dt = ns.args[-1]
    if ns.job == "tag":
        jobs.tag_job(spark, catalog, int(ns.args[0]), dt, store)
    elif ns.job == "backfill":
        jobs.backfill_job(spark, catalog, int(ns.args[0]), jobs.days_between(*ns.args[1:]), store)
    elif ns.job == "tags":
        jobs.tags_job(spark, catalog, dt, store)
    elif ns.job == "merge":
        jobs.merge_job(spark, catalog, dt, store)
    elif ns.job == "bitmap":
        jobs.bitmap_job(spark, catalog, dt, store)
    else:
        if not ns.serving_jdbc:
            raise SystemExit("export needs --serving-jdbc")
        active_tag_list(catalog)  # no active tags: nothing to export, an error
        export_wide_jdbc(store.read_wide(dt), ns.serving_jdbc, wide_table_name(dt),
                         table_options=ns.serving_table_options,
                         properties=_credentials(ns.serving_user, ns.serving_password_file, ns.serving_driver),
                         batch_size=ns.serving_batch_size, isolation=ns.serving_isolation,
                         num_partitions=ns.serving_partitions, text_type=ns.serving_text_type)


if __name__ == "__main__":
    main()
