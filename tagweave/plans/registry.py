"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the input tables of ``sf_dir`` whole (or data Spark derives
from them); catalog-level operators are applied to data so their work grows
with it.  Queries that write (tag / wide / bitmap tables, exports, models)
write below the session's shared storage folder and return the read-back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import StringIndexer, VectorAssembler, VectorIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.operators import bitmap as bitmap_ops
from tagweave.operators import ml
from tagweave.operators.export import read_sorted, write_sorted
from tagweave.operators.merge import collect_values, split_wide, union_long
from tagweave.operators.tag import build_tag, plan_tasks, run_task_sql
from tagweave.functions import bitmap as bm
from tagweave.functions.values import date_token_col, epoch_millis
from tagweave.plans import jobs
from tagweave.plans.oracles import AUDIENCE
from tagweave.plans.profile import (BUSINESS_DATE, FEATURES, LABEL, LABELS, PRIORITY_CODES, STATUS_CODES,
                                    demo_catalog)
from tagweave.session import work_dir
from tagweave.sources import catalog as cat
from tagweave.sources.tables import TagStore, read_table, register_tables, tag_table_schema
from tagweave.sources.text import read_tsv, write_tsv

DT = BUSINESS_DATE
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_SETUP: dict[str, tuple[str, cat.Catalog]] = {}  # by application id


def _setup(spark: SparkSession, sf: str) -> cat.Catalog:
    """Input views of ``sf`` and the demo catalog, made once per session and dir."""
    app = spark.sparkContext.applicationId
    known = _SETUP.get(app)
    if known is None or known[0] != sf or not spark.catalog.tableExists("orders"):
        register_tables(spark, sf)
        known = (sf, demo_catalog(spark))
        _SETUP[app] = known
    return known[1]


def _tag(spark: SparkSession, sf: str, task_id: int, rules_method: str = "auto"):
    catalog = _setup(spark, sf)
    plan = plan_tasks(catalog, [task_id])[task_id]
    return build_tag(spark, catalog, plan, DT, rules_method)


def _task_sql(catalog: cat.Catalog, task_id: int) -> str:
    return cat.lookup_one(catalog.task_info, "id", task_id, what="task").task_sql


def _wide(spark: SparkSession, sf: str, preaggregate: bool = False, method: str = "auto"):
    catalog = _setup(spark, sf)
    tags, wide = jobs.wide_frame(spark, catalog, DT, preaggregate=preaggregate, method=method)
    return catalog, tags, wide


# --- catalog operators (applied to data) ----------------------------------------
@query
def catalog_lookup_one(spark, sf):
    return cat.lookup_one_df(read_table(spark, sf, "customer"), "c_custkey", 42, order_col="c_custkey")


@query
def active_tags(spark, sf):
    catalog = _setup(spark, sf)
    _, frames = jobs.active_tag_frames(spark, catalog, DT)
    rows = (union_long(frames).groupBy(F.col("tag_name").alias("tag_code"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
    return (cat.active_tags(catalog).select("tag_code", "tag_value_type")
            .join(rows, "tag_code").select("tag_code", "tag_value_type", "n_rows"))


@query
def rules_join(spark, sf):
    catalog = _setup(spark, sf)
    source = run_task_sql(spark, _task_sql(catalog, 1), DT)
    # pre-aggregate the raw values, then attach the matched counts to every rule
    per_value = source.groupBy("query_value").agg(F.count(F.lit(1)).alias("n_rows"))
    rules = cat.task_rules(catalog, 1)
    matched = per_value.join(rules, "query_value").select("id", "n_rows")
    return (rules.join(matched, "id", "left")
            .select("id", "query_value", "sub_tag_value",
                    F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows")))


@query
def tags_by_type(spark, sf):
    catalog, tags, wide = _wide(spark, sf)
    cells = (bitmap_ops.unpivot_wide(wide, [t.column for t in tags])
             .groupBy("tag_code").agg(F.count(F.lit(1)).alias("n")))
    active = cat.active_tags(catalog).select(F.lower("tag_code").alias("tag_code"), "tag_value_type")
    per_type = (active.join(cells, "tag_code", "left").groupBy("tag_value_type")
                .agg(F.sum(F.coalesce(F.col("n"), F.lit(0))).cast("long").alias("n_values")))
    grouped = cat.tags_by_type(cat.active_tags(catalog))
    return (grouped.join(per_type, "tag_value_type")
            .select("tag_value_type", "table_name", F.concat_ws(",", "tag_codes").alias("tag_codes"),
                    "n_values"))


@query
def camel_columns(spark, sf):
    return cat.camel_columns(read_table(spark, sf, "customer"))


@query
def rows_as_json(spark, sf):
    return cat.rows_as_json(read_table(spark, sf, "customer"))


# --- scans and sources ------------------------------------------------------------
@query
def scan_table(spark, sf):
    return read_table(spark, sf, "customer").select("*")


@query
def scan_tag_partition(spark, sf):
    catalog = _setup(spark, sf)
    store = TagStore(spark, work_dir(spark, "tags"))
    for day in ("1999-01-01", DT, "2001-01-01"):
        jobs.tag_job(spark, catalog, 2, day, store)
    return store.read_tag_day("TAG_ORDER_COUNT", "1", DT)


@query
def tag_table_catalog(spark, sf):
    """A tag's days read by name through the session catalog."""
    catalog = _setup(spark, sf)
    plan = plan_tasks(catalog, [2])[2]
    store = TagStore(spark, work_dir(spark, "tags"), catalog_tables=True)
    spark.sql(f"DROP TABLE IF EXISTS {store.tag_table_name(plan.tag.tag_code)}")  # an earlier run's folder
    for day in ("1999-01-01", DT):
        jobs.tag_job(spark, catalog, 2, day, store)
    return spark.table(store.tag_table_name(plan.tag.tag_code)).where(F.col("dt") == DT)


@query
def tag_sql_source(spark, sf):
    return run_task_sql(spark, _task_sql(_setup(spark, sf), 5), DT)


@query
def tag_sql_params(spark, sf):
    return run_task_sql(spark, _task_sql(_setup(spark, sf), 3), DT)  # uses ${dt}


@query
def text_tsv_roundtrip(spark, sf):
    result = _tag(spark, sf, 1)
    path = work_dir(spark, "tsv")
    write_tsv(result.values, path, compression="gzip")
    schema = tag_table_schema(result.tag.tag_value_type)
    return read_tsv(spark, path, schema.__class__(schema.fields[:2]))


# --- tag computation ------------------------------------------------------------------
@query
def tag_passthrough(spark, sf):
    return _tag(spark, sf, 2).values


@query
def tag_rule_case(spark, sf):
    return _tag(spark, sf, 1, "case").values


@query
def tag_rule_join(spark, sf):
    return _tag(spark, sf, 1, "join").values


@query
def tag_typed_values(spark, sf):
    return _tag(spark, sf, 3).values


@query
def tag_multi_value(spark, sf):
    values = _tag(spark, sf, 5).values
    long = values.select("uid", "tag_value", F.lit("TAG_PRIORITY").alias("tag_name"))
    return collect_values(long, ["uid"])


@query
def tag_compute(spark, sf):
    catalog = _setup(spark, sf)
    return jobs.compute_tag(spark, catalog, 6, DT).values


@query
def tag_write_partition(spark, sf):
    catalog = _setup(spark, sf)
    store = TagStore(spark, work_dir(spark, "tags"))
    jobs.tag_job(spark, catalog, 2, "1999-01-01", store)
    jobs.tag_job(spark, catalog, 2, DT, store)
    jobs.tag_job(spark, catalog, 2, DT, store)  # rerun of a day replaces it
    jobs.tag_job(spark, catalog, 2, "2001-01-01", store)
    empty = spark.createDataFrame([], "uid string, tag_value bigint")
    store.write_tag_day("TAG_ORDER_COUNT", "1", empty, "2001-01-01")  # empty result clears its day
    return store.read_tag_table("TAG_ORDER_COUNT", "1")


BACKFILL_DAYS = ("1990-01-01", "1996-03-01", "1996-03-02", "1996-03-03", "1997-07-01")


@query
def tag_backfill(spark, sf):
    """Five days of a tag replaced by one job; one of them has no orders, a sixth day stays as it was."""
    catalog = _setup(spark, sf)
    store = TagStore(spark, work_dir(spark, "backfill"))
    old = spark.createDataFrame([("0", 0)], "uid string, tag_value bigint")
    for day in ("1990-01-01", "1996-03-02"):
        store.write_tag_day("TAG_ORDER_COUNT", "1", old, day)
    jobs.tag_job(spark, catalog, 2, DT, store)
    jobs.backfill_job(spark, catalog, 2, list(BACKFILL_DAYS), store)
    return store.read_tag_table("TAG_ORDER_COUNT", "1")


@query
def date_token(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey",
                         date_token_col(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dt_token"))


@query
def date_to_epoch_ms(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey", epoch_millis("o_orderdate").alias("epoch_ms"))


# --- merge ------------------------------------------------------------------------------
@query
def tag_union_long(spark, sf):
    catalog = _setup(spark, sf)
    tags, frames = jobs.active_tag_frames(spark, catalog, DT)
    return union_long(frames, {t.tag_code: t.tag_value_type for t in tags})


@query
def wide_pivot(spark, sf):
    return _wide(spark, sf)[2]


@query
def wide_pivot_preagg(spark, sf):
    return _wide(spark, sf, preaggregate=True)[2]


@query
def wide_map(spark, sf):
    return _wide(spark, sf, method="map")[2]


@query
def wide_write(spark, sf):
    catalog = _setup(spark, sf)
    store = TagStore(spark, work_dir(spark, "profile"))
    jobs.tags_job(spark, catalog, DT, store)
    return jobs.merge_job(spark, catalog, DT, store)


@query
def wide_heavy_users(spark, sf):
    """The stored day merged with its busiest users (by event count) dealt in pieces, all others on one exchange."""
    catalog = _setup(spark, sf)
    store = TagStore(spark, work_dir(spark, "profile"))
    tags = jobs.tags_job(spark, catalog, DT, store)
    _, frames = jobs.active_tag_frames(spark, catalog, DT, store)
    long = union_long(frames, {t.tag_code: t.tag_value_type for t in tags})
    busiest = [r.uid for r in read_table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("uid"))
               .count().orderBy(F.desc("count"), "uid").limit(20).collect()]
    return split_wide(long, [t.tag_code for t in tags], busiest)


# --- bitmaps ------------------------------------------------------------------------------
def _cells(spark, sf, use_explode=False):
    _, tags, wide = _wide(spark, sf)
    cols = [t.column for t in tags]
    return (bitmap_ops.explode_wide(wide, cols) if use_explode else bitmap_ops.unpivot_wide(wide, cols)), tags, wide


@query
def bitmap_unpivot(spark, sf):
    return _cells(spark, sf)[0]


@query
def bitmap_explode(spark, sf):
    return _cells(spark, sf, use_explode=True)[0]


def _bitmaps(spark, sf, only=None):
    cells = _cells(spark, sf)[0]
    return bitmap_ops.build_bitmaps(cells, DT, only)


@query
def bitmap_build(spark, sf):
    # users recounted from the bitmap itself (the stored column is checked in tests)
    return _bitmaps(spark, sf).select("tag_code", "tag_value", "bucket",
                                      bm.users_in("us").alias("users"), "dt")


@query
def bitmap_decode(spark, sf):
    return bm.decode(_bitmaps(spark, sf), keys=["tag_code", "tag_value"])


@query
def bitmap_by_type(spark, sf):
    _, tags, wide = _wide(spark, sf)
    string_tags = bitmap_ops.bitmaps_by_type(wide, tags, DT)["3"]
    return string_tags.select("tag_code", "tag_value", "bucket", bm.users_in("us").alias("users"), "dt")


@query
def bitmap_write_partition(spark, sf):
    catalog, tags, wide = _wide(spark, sf)
    store = TagStore(spark, work_dir(spark, "bitmaps"))
    store.write_wide(wide, DT)  # the merge job's output; bitmaps read it per value type
    jobs.bitmap_job(spark, catalog, DT, store, tags=tags)
    tables = jobs.bitmap_job(spark, catalog, DT, store, tags=tags)  # rerun replaces the day
    return bitmap_ops.cardinality(jobs.all_bitmaps(tables), keys=("value_type", "tag_code", "tag_value"))


@query
def bitmap_cardinality(spark, sf):
    return bitmap_ops.cardinality(_bitmaps(spark, sf))


WINDOW_DAYS = ("1996-01-01", "1998-01-01", DT)


@query
def audience_window(spark, sf):
    """Users that held an event count, order count or priority list on any of three stored days."""
    catalog = _setup(spark, sf)
    store = TagStore(spark, work_dir(spark, "window"))
    for day in ("1994-01-01", *WINDOW_DAYS):  # the first day lies outside the range
        tags, wide = jobs.wide_frame(spark, catalog, day)
        store.write_wide(wide, day)
        jobs.bitmap_job(spark, catalog, day, store, tags=tags)
    days = [store.read_bitmap_days(code, WINDOW_DAYS[0], WINDOW_DAYS[-1]) for code in ("1", "3")]
    merged = bitmap_ops.merge_days(days[0].unionByName(days[1]))
    return bitmap_ops.cardinality(merged)


@query
def audience_and(spark, sf):
    return bitmap_ops.audience_uids(_bitmaps(spark, sf, AUDIENCE), AUDIENCE, "and")


@query
def audience_or(spark, sf):
    return bitmap_ops.audience_uids(_bitmaps(spark, sf, AUDIENCE), AUDIENCE, "or")


# --- export -------------------------------------------------------------------------------
@query
def export_sorted(spark, sf):
    wide = _wide(spark, sf)[2]
    store = TagStore(spark, work_dir(spark, "export"))
    store.write_wide(wide, DT)  # the merge job's output is what gets exported
    path = f"{store.root}/serving"
    write_sorted(store.read_wide(DT), path)
    return read_sorted(spark, path)


# --- ML -----------------------------------------------------------------------------------
def ml_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with coded features and a noisy label that follows from the status, the month and the priority.

    Orders of status F are closed up to April, and later if of low priority; the
    others of status F are late; all else is open.  A sixteenth of the labels is
    turned to the next one.
    """
    orders = read_table(spark, sf, "orders")
    base = orders.select("o_orderkey", "o_totalprice", F.month("o_orderdate").alias("order_month"),
                         F.col("o_orderpriority").alias("priority_code"),
                         F.col("o_orderstatus").alias("status_code"))
    coded = ml.encode_categories(base, {"priority_code": PRIORITY_CODES, "status_code": STATUS_CODES})
    noisy = F.md5(F.concat(F.lit("noise:"), F.col("o_orderkey").cast("string")).cast("binary")).substr(1, 1) == "0"
    early, low = F.col("order_month") <= 4, F.col("priority_code") == PRIORITY_CODES["5-LOW"]
    state = F.when(F.col("status_code") != STATUS_CODES["F"], 0).when(early | low, 1).otherwise(2)
    state = F.when(noisy, (state + 1) % 3).otherwise(state)
    return ml.split(coded.withColumn(LABEL, F.get(F.array(*map(F.lit, LABELS)), state)), "o_orderkey")


# The splits that the label is made of gain over 0.09, splits on its noise under 0.02.
MIN_GAIN = 0.05


def _classifier(spark, sf, features=FEATURES, **params) -> ml.TagClassifier:
    """Fitted on the training part, by default to the reference depth."""
    clf = ml.TagClassifier(LABEL, features, **{"max_bins": 32, "min_info_gain": MIN_GAIN, **params})
    return clf.fit(ml.part(ml_frame(spark, sf), "train"))


def _predicted(spark, sf, **params):
    """The held-out part with its predictions."""
    clf = _classifier(spark, sf, **params)
    return clf, clf.predict(ml.part(ml_frame(spark, sf), "test"))


VECTOR_NAMES = ["f_price", "f_month", "f_priority", "f_status"]


@query
def encode_categories(spark, sf):
    return ml_frame(spark, sf).select("o_orderkey", "priority_code", "status_code")


@query
def ml_split(spark, sf):
    return ml_frame(spark, sf).select("o_orderkey", LABEL, ml.PART)


@query
def string_index(spark, sf):
    frame = ml_frame(spark, sf)
    model = StringIndexer(inputCol=LABEL, outputCol=ml.LABEL_INDEX).fit(frame)
    return model.transform(frame).select("o_orderkey", LABEL, ml.LABEL_INDEX)


@query
def assemble_features(spark, sf):
    frame = ml_frame(spark, sf)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol=ml.FEATURES_ASSEMBLED).transform(frame)
    return ml.features_as_columns(assembled.select("o_orderkey", ml.FEATURES_ASSEMBLED),
                                  ml.FEATURES_ASSEMBLED, VECTOR_NAMES)


@query
def vector_index(spark, sf):
    frame = ml_frame(spark, sf)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol=ml.FEATURES_ASSEMBLED).transform(frame)
    indexer = VectorIndexer(inputCol=ml.FEATURES_ASSEMBLED, outputCol=ml.FEATURES_INDEXED,
                            maxCategories=5, handleInvalid="skip").fit(assembled)
    return ml.features_as_columns(indexer.transform(assembled).select("o_orderkey", ml.FEATURES_INDEXED),
                                  ml.FEATURES_INDEXED, VECTOR_NAMES)


@query
def dt_train_predict(spark, sf):
    return _predicted(spark, sf)[1].select("o_orderkey", ml.PREDICTION)


@query
def label_back(spark, sf):
    clf, predicted = _predicted(spark, sf)
    return clf.label_back(predicted).select("o_orderkey", ml.PREDICTION_ORIGIN)


@query
def feature_importance(spark, sf):
    return ml.importances_frame(spark, _classifier(spark, sf)).select("feature", F.round("importance", 6).alias("importance"))


@query
def tree_text(spark, sf):
    """The text of a tree that fills the reference depth: the priority guessed from the other features."""
    clf = ml.TagClassifier("priority_code", [f for f in FEATURES if f != "priority_code"], max_bins=32)
    return ml.tree_frame(spark, clf.fit(ml.part(ml_frame(spark, sf), "train")))


@query
def tree_nodes(spark, sf):
    """The fitted tree, read back from the saved model."""
    clf = _classifier(spark, sf)
    path = work_dir(spark, "model")
    clf.save(path)
    return ml.tree_nodes(spark, clf, path)


@query
def eval_accuracy(spark, sf):
    return ml.accuracy(_predicted(spark, sf)[1])


@query
def eval_precision_recall(spark, sf):
    return ml.precision_recall(_predicted(spark, sf)[1])


@query
def eval_confusion(spark, sf):
    return ml.confusion(_predicted(spark, sf)[1])


@query
def model_roundtrip(spark, sf):
    clf = _classifier(spark, sf)
    path = work_dir(spark, "model")
    clf.save(path)
    loaded = ml.TagClassifier(LABEL, FEATURES).load(path)
    return loaded.predict(ml.part(ml_frame(spark, sf), "test")).select("o_orderkey", ml.PREDICTION)


@query
def ml_hyper_parameters(spark, sf):
    """The held-out part predicted under settings that each give another tree."""
    n_train = ml.part(ml_frame(spark, sf), "train").count()
    settings = {
        "depth 1": dict(max_depth=1),
        "depth 2": dict(max_depth=2),
        # The split on the priority would cut off under a tenth of the rows, as would any that gains enough.
        "min instances": dict(min_instances_per_node=n_train // 10),
        "min gain": dict(min_info_gain=0.9, impurity="entropy", seed=7),  # nothing gains so much: one leaf
        # Four bins leave no threshold between April and May; the nearest is one month lower.
        "bins 4": dict(max_bins=4, max_depth=2, features=["order_month", "status_code"]),
    }
    parts = []
    for name, params in settings.items():
        clf, predicted = _predicted(spark, sf, **params)
        parts.append(clf.label_back(predicted).select(F.lit(name).alias("setting"), "o_orderkey", ml.PREDICTION_ORIGIN))
    return reduce(DataFrame.unionByName, parts)


@query
def ml_skipped_rows(spark, sf):
    """Rows in, scored and skipped where training saw no low priority."""
    frame = ml_frame(spark, sf)
    clf = ml.TagClassifier(LABEL, FEATURES, max_bins=32, min_info_gain=MIN_GAIN)
    clf.fit(ml.part(frame, "train").filter(F.col("priority_code") != PRIORITY_CODES["5-LOW"]))
    _, counts = ml.score(clf, ml.part(frame, "test"), work_dir(spark, "scored"))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))


@query
def ml_end_to_end(spark, sf):
    """Train on the training part, label the held-out part back, keep the true label beside it."""
    clf, predicted = _predicted(spark, sf, max_categories=5, max_depth=6)
    return clf.label_back(predicted).select("o_orderkey", LABEL, ml.PREDICTION_ORIGIN)


def queries() -> dict[str, Query]:
    return dict(QUERIES)
