"""Predicting a tag with a decision tree (Spark ML, fully distributed).

:class:`TagClassifier` wraps the four-stage pipeline
``StringIndexer(label) -> VectorAssembler -> VectorIndexer -> DecisionTreeClassifier``
with the reference defaults (maxCategories 5, maxBins 5, maxDepth 5,
minInstancesPerNode 1, minInfoGain 0.0, gini).  Evaluation (confusion
counts, accuracy, per-label precision / recall) is plain DataFrame
aggregation over the predictions, never a driver-side loop over rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.sources.tables import replace_folder

# Column names of predictions.
LABEL_INDEX = "label_index"
FEATURES_ASSEMBLED = "features_assemble"
FEATURES_INDEXED = "features_index"
PREDICTION = "prediction"
PREDICTION_ORIGIN = "prediction_origin"


def encode_categories(df: DataFrame, mapping: dict[str, dict[str, int]]) -> DataFrame:
    """Replace text categories by integer codes (``CASE col WHEN v THEN code END``).

    Values without a code become NULL, as in a CASE without ELSE.
    """
    out = df
    for col, codes in mapping.items():
        expr = None
        for value, code in codes.items():
            cond = F.col(col) == F.lit(value)
            expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
        out = out.withColumn(col, expr.cast("int"))
    return out


PART = "part"


def split(df: DataFrame, key: str, train: float = 0.7, seed: int = 42) -> DataFrame:
    """All rows of ``df`` with ``part``: ``train`` or ``test``.

    The part follows from a hash of the key and the seed, so a row keeps it
    whatever the file layout, and no sort or second pass is needed.  A NULL
    key hashes as the empty text.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return df.withColumn(PART, F.when(share < train, F.lit("train")).otherwise(F.lit("test")))


def part(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(PART) == name)


class TagClassifier:
    def __init__(self, label_col: str, feature_cols: list[str], max_categories: int = 5,
                 max_bins: int = 5, max_depth: int = 5, min_instances_per_node: int = 1,
                 min_info_gain: float = 0.0, impurity: str = "gini", seed: int | None = None):
        if not label_col:
            raise ValueError("label_col is required")
        if not feature_cols:
            raise ValueError("feature_cols are required")
        self.label_col = label_col
        self.feature_cols = list(feature_cols)
        self.max_categories = max_categories
        self.max_bins = max_bins
        self.max_depth = max_depth
        self.min_instances_per_node = min_instances_per_node
        self.min_info_gain = min_info_gain
        self.impurity = impurity
        self.seed = seed
        self.model: PipelineModel | None = None

    # construction ---------------------------------------------------------
    def pipeline(self) -> Pipeline:
        indexer = StringIndexer(inputCol=self.label_col, outputCol=LABEL_INDEX)
        assembler = VectorAssembler(inputCols=self.feature_cols, outputCol=FEATURES_ASSEMBLED)
        vindexer = VectorIndexer(inputCol=FEATURES_ASSEMBLED, outputCol=FEATURES_INDEXED,
                                 maxCategories=self.max_categories, handleInvalid="skip")
        tree = DecisionTreeClassifier(featuresCol=FEATURES_INDEXED, labelCol=LABEL_INDEX,
                                      predictionCol=PREDICTION, impurity=self.impurity,
                                      maxBins=self.max_bins, maxDepth=self.max_depth,
                                      minInstancesPerNode=self.min_instances_per_node,
                                      minInfoGain=self.min_info_gain)
        if self.seed is not None:
            tree = tree.setSeed(self.seed)
        return Pipeline(stages=[indexer, assembler, vindexer, tree])

    def fit(self, df: DataFrame) -> "TagClassifier":
        """Fit the pipeline.  Unless the caller has cached it already, the
        input is persisted (executor memory, spilling to executor disk) for
        the duration of the fit: the label indexer, the vector indexer and
        the tree each pass over it.  A lost part is recomputed."""
        mine = not (df.storageLevel.useMemory or df.storageLevel.useDisk)
        data = df.persist(StorageLevel.MEMORY_AND_DISK) if mine else df
        try:
            self.model = self.pipeline().fit(data)
        finally:
            if mine:
                data.unpersist()
        return self

    def _fitted(self) -> PipelineModel:
        if self.model is None:
            raise RuntimeError("the classifier must be trained first")
        return self.model

    # use ------------------------------------------------------------------
    def predict(self, df: DataFrame) -> DataFrame:
        return self._fitted().transform(df)

    def stage(self, i: int):
        """A fitted stage of the pipeline: label index, assembly, vector index, tree."""
        return self._fitted().stages[i]

    def labels(self) -> list[str]:
        return list(self._fitted().stages[0].labels)

    def label_back(self, predicted: DataFrame) -> DataFrame:
        """Predicted index -> original label text in ``prediction_origin``."""
        converter = IndexToString(inputCol=PREDICTION, outputCol=PREDICTION_ORIGIN, labels=self.labels())
        return converter.transform(predicted)

    def tree_text(self) -> str:
        return self._fitted().stages[3].toDebugString

    def feature_importances(self) -> list[tuple[str, float]]:
        vec = self._fitted().stages[3].featureImportances.toArray()
        return [(name, float(vec[i])) for i, name in enumerate(self.feature_cols)]

    def save(self, path: str) -> None:
        self._fitted().write().overwrite().save(path)

    def load(self, path: str) -> "TagClassifier":
        self.model = PipelineModel.load(path)
        return self


def score(clf: TagClassifier, df: DataFrame, path: str, columns: list[str] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Predictions of ``df`` (its ``columns``; default all and the predicted label) put in place at ``path``, and how many rows came in, were scored and were skipped.

    Rows with a category that training never saw are skipped; the counts are
    observed by the same job that writes the predictions.
    """
    came, scored = Observation(), Observation()
    rows = df.observe(came, F.count(F.lit(1)).alias("n"))
    predicted = clf.label_back(clf.predict(rows)).observe(scored, F.count(F.lit(1)).alias("n"))
    replace_folder(predicted.select(columns or [*df.columns, PREDICTION_ORIGIN]), path)
    # A plan whose rows are all pruned observes nothing.
    n_in, n_out = (o.get.get("n", 0) for o in (came, scored))
    return df.sparkSession.read.parquet(path), {"rows_in": n_in, "rows_scored": n_out, "rows_skipped": n_in - n_out}


# evaluation ------------------------------------------------------------------
def confusion(predicted: DataFrame) -> DataFrame:
    """``(label_index, prediction, n)`` pair counts."""
    return (predicted.groupBy(F.col(LABEL_INDEX).cast("double").alias(LABEL_INDEX),
                              F.col(PREDICTION).cast("double").alias(PREDICTION))
            .agg(F.count(F.lit(1)).alias("n")))


def accuracy(predicted: DataFrame) -> DataFrame:
    hit = (F.col(LABEL_INDEX) == F.col(PREDICTION)).cast("double")
    return predicted.agg(F.avg(hit).alias("accuracy"))


def precision_recall(predicted: DataFrame) -> DataFrame:
    """Per true label: precision and recall (0.0 when the label is never predicted)."""
    pairs = confusion(predicted)
    truth = pairs.groupBy(F.col(LABEL_INDEX).alias("label")).agg(F.sum("n").alias("actual"))
    guessed = pairs.groupBy(F.col(PREDICTION).alias("label")).agg(F.sum("n").alias("predicted"))
    hits = (pairs.filter(F.col(LABEL_INDEX) == F.col(PREDICTION))
            .select(F.col(LABEL_INDEX).alias("label"), F.col("n").alias("tp")))
    joined = (truth.join(guessed, "label", "left").join(hits, "label", "left")
              .fillna(0, subset=["predicted", "tp"]))
    return joined.select(
        "label",
        F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0)).alias("precision"),
        (F.col("tp") / F.col("actual")).alias("recall"))


def features_as_columns(df: DataFrame, vector_col: str, names: list[str]) -> DataFrame:
    """Vector column -> one double column per element."""
    arr = vector_to_array(F.col(vector_col))
    return df.select(*[c for c in df.columns if c != vector_col],
                     *[arr[i].alias(n) for i, n in enumerate(names)])


def importances_frame(spark: SparkSession, clf: TagClassifier) -> DataFrame:
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(clf.feature_importances(), schema)


def tree_frame(spark: SparkSession, clf: TagClassifier) -> DataFrame:
    schema = T.StructType([T.StructField("tree", T.StringType())])
    return spark.createDataFrame([(clf.tree_text(),)], schema)


def tree_nodes(spark: SparkSession, clf: TagClassifier, model_path: str) -> DataFrame:
    """The nodes of a saved tree: feature and threshold of the split (leaf: no feature), rows, impurity, gain, label.

    ``threshold`` is NULL for a categorical feature.  Impurity and gain are rounded to six places.
    """
    split = F.col("split.featureIndex")
    names = F.array(*[F.lit(c) for c in clf.feature_cols])
    labels = F.array(*[F.lit(x) for x in clf.labels()])
    continuous = F.col("split.numCategories") == -1
    # A leaf's own impurity is not kept, but its label counts are.
    shares = F.transform("impurityStats", lambda n: n / F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b))
    if clf.impurity == "gini":
        impurity = 1 - F.aggregate(shares, F.lit(0.0), lambda a, p: a + p * p)
    else:
        impurity = F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    tree = clf.stage(3)  # stages are saved under their number and name
    return spark.read.parquet(f"{model_path}/stages/3_{tree.uid}/data").select(
        F.when(split >= 0, F.get(names, split)).otherwise("leaf").alias("feature"),
        F.when((split >= 0) & continuous, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("rawCount").alias("n_rows"), F.round(impurity, 6).alias("impurity"),
        F.round(F.when(split >= 0, F.col("gain")).otherwise(0.0), 6).alias("gain"),
        F.get(labels, F.col("prediction").cast("int")).alias("prediction_origin"))
