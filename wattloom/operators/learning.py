"""Regression with tree ensembles: preparation, training, validation, scoring."""

from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window, functions as F

from wattloom.operators.boosting import HistogramBoosting
from wattloom.operators.order_stats import exact_medians
from wattloom.operators.scoring import evaluate, mae_interval, metric_columns, scored_table
from wattloom.operators.splits import cv_folds
from wattloom.schemas import (APPLIANCE_RATIO, BOOSTED, BOOSTED_CV, CV_SPLITS, DEFAULT_MAE, FOREST,
                              FOREST_CV, INTERVAL_Z, MODEL_VERSION, NON_FEATURES, SEED, TARGET,
                              VALIDATION_FRACTION)
from wattloom.session import fresh_path, written

#: Parts of the training rows: a few for a daily table, then one for so many rows.
FEW_PARTS, ROWS_PER_PART = 8, 50_000
#: Forests of a validation that are trained at the same time.
FITS_AT_ONCE = 5
#: Trees without gain after which boosting stops.
PATIENCE = 20
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
# Node ids are kept with the rows, so trees are not sent out for every level.
TREE_DEFAULTS = dict(featuresCol="features", labelCol=TARGET, seed=SEED, cacheNodeIds=True,
                     maxMemoryInMB=512)


def feature_columns(df: DataFrame, exclude=tuple(NON_FEATURES), strict=False) -> list[str]:
    """Numeric columns with at least one value, minus the excluded ones.

    ``strict`` also leaves out the same-day appliance ratios, which know part of the target.
    """
    banned = {*exclude, *(APPLIANCE_RATIO if strict else ())}
    numeric = [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in banned]
    filled = df.agg(*[F.count(c).alias(c) for c in numeric]).first()  # one row, one pass
    return [c for c in numeric if filled[c] > 0]


def column_medians(df: DataFrame, columns) -> dict[str, float]:
    """Exact medians as a plain dict: one number per column."""
    return {r["feature"]: r["median"] for r in exact_medians(df, columns).collect()}


class MedianFill(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """The features as columns of their own (``_`` in front), NULLs filled with fixed medians.

    A stage like any other: its columns and medians are saved with a pipeline. A feature whose
    median is missing (it has no value in the rows it was taken from) counts as 0. A table that
    lacks a feature is an error that names it.
    """

    medians = Param(Params._dummy(), "medians", "median of each input column",
                    TypeConverters.toListFloat)

    @classmethod
    def of(cls, features, medians):
        return cls()._set(inputCols=list(features),
                          medians=[float(medians.get(c) or 0.0) for c in features])

    def by_feature(self) -> dict[str, float]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.medians)))

    def outputs(self):
        return [f"_{c}" for c in self.getInputCols()]

    def _transform(self, df):
        missing = [c for c in self.getInputCols() if c not in df.columns]
        if missing:
            raise ValueError(f"the table lacks features of the model: {', '.join(missing)}")
        return df.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(m))
                               for c, m in self.by_feature().items()})


def preparation(features, medians) -> list:
    """The stages that add the ``features`` vector to a table and leave its columns as they are."""
    fill = MedianFill.of(features, medians)
    listed = ", ".join(f"`{c}`" for c in fill.outputs())
    return [fill, VectorAssembler(inputCols=fill.outputs(), outputCol="features"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({listed}) FROM __THIS__")]


@dataclass
class Fitted:
    """A trained model with all that scoring needs."""
    model: object
    features: list[str]
    medians: dict[str, float]
    name: str
    metrics: dict = field(default_factory=dict)

    @property
    def pipeline(self) -> PipelineModel:
        """Preparation and model as one, from a feature table to predictions."""
        return PipelineModel([*preparation(self.features, self.medians), self.model])

    def prepare(self, df: DataFrame) -> DataFrame:
        return assemble(df, self.features, self.medians)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(df)


def assemble(df: DataFrame, features, medians) -> DataFrame:
    """Add the ``features`` vector, NULLs filled with the given medians.

    A feature without a median (it has no value in the rows it was taken from) counts as 0.
    """
    return PipelineModel(preparation(features, medians)).transform(df)


def is_validation(fraction=VALIDATION_FRACTION, seed=SEED, key="Date"):
    """A repeatable random share of the rows, held out for early stopping."""
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(10_000))
    return draw < int(fraction * 10_000)


def forest(**params):
    return RandomForestRegressor(**TREE_DEFAULTS, leafCol="leaf", **{**FOREST, **params})


def boosted(**params):
    return HistogramBoosting(labelCol=TARGET, **{**BOOSTED, **params})


def fit(estimator, train: DataFrame, features, medians, name) -> Fitted:
    data = spread(assemble(train, features, medians).select("Date", TARGET, "features"))
    return Fitted(estimator.fit(data), list(features), medians, name)


def fit_boosted(estimator: HistogramBoosting, train: DataFrame, features, medians, name,
                patience: int | None = PATIENCE) -> Fitted:
    """Boosted trees with early stopping on a held-out tenth of the training rows.

    Training goes on until ``patience`` trees brought nothing, or to ``maxIter`` trees; with
    None no rows are held out and all trees are grown.
    """
    data = assemble(train, features, medians).select(
        "Date", TARGET, "features", is_validation().alias("held_out"))
    if patience is not None:
        estimator = estimator.copy({estimator.patience: patience,
                                    estimator.validationIndicatorCol: "held_out"})
    return Fitted(estimator.fit(data), list(features), medians, name)


def spread(data: DataFrame, key="Date") -> DataFrame:
    """The rows in parts by key, as many as their number asks for: the same on every machine, so
    that the rows drawn for a tree, and with them the model, are the same too."""
    return data.repartition(max(FEW_PARTS, -(-data.count() // ROWS_PER_PART)), key)


def metrics_of(fitted: Fitted, test: DataFrame) -> DataFrame:
    return evaluate(fitted.predict(test), fitted.name)


def train_and_test(estimator, table: DataFrame, name: str, strict=False, features=None,
                   medians=None, **fit_options) -> Fitted:
    """Fit on the 'train' rows of a split table and measure on the 'test' rows.

    Features and medians come from the whole table; with ``strict`` from the training rows only,
    and without the same-day ratios, so that nothing of the test side leaks in.
    """
    train, test = table.where(F.col("split") == "train"), table.where(F.col("split") == "test")
    known = train if strict else table
    features = feature_columns(known, strict=strict) if features is None else features
    medians = column_medians(known, features) if medians is None else medians
    train_model = fit_boosted if isinstance(estimator, HistogramBoosting) else fit
    fitted = train_model(estimator, train, features, medians, name, **fit_options)
    row = metrics_of(fitted, test).first()  # four numbers
    fitted.metrics = {k: row[k] for k in ("MAE", "RMSE", "R2", "MAPE")}
    return fitted


def at_once(spark, work, items) -> list:
    """What ``work`` returns for each item, by ``FITS_AT_ONCE`` threads.

    Every item gets its own copy of the caller's job group and pool: jobs of threads that share one
    copy would end each other's.
    """
    items = list(items)
    own = [inheritable_thread_target(spark)(work) for _ in items]
    with ThreadPool(FITS_AT_ONCE) as pool:
        return pool.starmap(lambda run, x: run(x), zip(own, items))


def cross_validate(estimator, table: DataFrame, features, n_splits=CV_SPLITS, date="Date"):
    """Per-fold metrics of expanding-window validation: (fold, MAE, R2).

    Fold k is tested on its rows and trained on all rows of the folds before it; medians (and
    bins) come from these only. All folds are trained at once: boosted trees are grown side by
    side on one stacked table, and forests by concurrent jobs of ``FITS_AT_ONCE`` threads, each
    of which carries the caller's job group and pool (a FAIR pool shares the cluster evenly). The
    test rows of all folds are scored and measured in one job.
    """
    folded = written(cv_folds(table, n_splits, date), "folds")
    folds = range(1, n_splits + 1)

    def parts(k):
        train, test = folded.where(F.col("fold") < k), folded.where(F.col("fold") == k)
        medians = column_medians(train, features)
        return [assemble(x, features, medians).select(date, "fold", TARGET, "features")
                for x in (train, test)]

    halves = dict(zip(folds, at_once(table.sparkSession, parts, folds)))
    if isinstance(estimator, HistogramBoosting):
        models = estimator.fit_series(reduce(DataFrame.unionByName, [
            estimator.rows_of(halves[k][0], k) for k in folds]))
    else:
        models = dict(zip(folds, at_once(
            table.sparkSession, lambda k: estimator.copy().fit(spread(halves[k][0], date)), folds)))
    scored = reduce(DataFrame.unionByName, [
        models[k].transform(halves[k][1]).select("fold", TARGET, "prediction") for k in folds])
    return scored.groupBy("fold").agg(*metric_columns(TARGET)).select("fold", "MAE", "R2")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population standard deviation over the folds."""
    return scores.agg(F.count(F.lit(1)).alias("folds"),
                      F.avg("MAE").alias("mae_mean"), F.stddev_pop("MAE").alias("mae_std"),
                      F.avg("R2").alias("r2_mean"), F.stddev_pop("R2").alias("r2_std"))


def forest_cv():
    return RandomForestRegressor(**TREE_DEFAULTS, **FOREST_CV)


def boosted_cv():
    return HistogramBoosting(labelCol=TARGET, **BOOSTED_CV)


def choose_best(first: Fitted, second: Fitted) -> Fitted:
    """The model with the higher R2; the first one if they tie."""
    return first if first.metrics["R2"] >= second.metrics["R2"] else second


def leaf_values(spark, model_path: str) -> DataFrame:
    """(tree, leaf, value): the prediction of each leaf of a saved forest, leaves numbered as the
    forest's leaf column numbers them, in the order of their nodes."""
    node = F.col("nodeData")
    of_tree = Window.partitionBy("tree").orderBy("id")
    leaves = (spark.read.parquet(f"{model_path}/data").where(node["leftChild"] < 0)
              .select(F.col("treeID").alias("tree"), node["id"].alias("id"),
                      node["prediction"].alias("value")))
    return leaves.select("tree", (F.row_number().over(of_tree) - 1).alias("leaf"), "value")


def forest_interval(scored: DataFrame, leaves: DataFrame, z=INTERVAL_Z) -> DataFrame:
    """Add ``lower`` and ``upper``: prediction -/+ z population deviations over the trees.

    ``scored`` carries the forest's leaf column; every row casts one vote per tree, which finds
    its value in the leaf table by a join. The table is stored first, so Spark knows its size: it
    is sent to the tasks while it is small, and joined by sorting otherwise. The votes of a row
    lie together and are summed before they are shuffled.
    """
    leaves = written(leaves, "leaves")
    rows = written(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    votes = rows.select("_row", F.posexplode(vector_to_array("leaf")).alias("tree", "_at")).select(
        "_row", "tree", F.col("_at").cast("int").alias("leaf"))
    spread_ = votes.join(leaves, ["tree", "leaf"]).groupBy("_row").agg(
        (F.stddev_pop("value") * z).alias("_margin"))
    return rows.join(spread_, "_row").withColumns(
        {"lower": F.col("prediction") - F.col("_margin"),
         "upper": F.col("prediction") + F.col("_margin")}).drop("_row", "_margin")


def batch_score(fitted: Fitted, table: DataFrame, version=MODEL_VERSION, model_path=None,
                keys=()) -> DataFrame:
    """Score a feature table into the predictions table.

    A forest gets intervals from the spread of its trees, other models from their test MAE. NULL
    features are filled with the medians of the scored table, as in training of the table's own.
    """
    spark = table.sparkSession
    medians = {**fitted.medians, **column_medians(table, fitted.features)}
    scored = fitted.model.transform(assemble(table, fitted.features, medians))
    if isinstance_forest(fitted.model):
        if model_path is None:
            model_path = fresh_path(spark, "model")
            fitted.model.write().overwrite().save(model_path)
        scored = forest_interval(scored, leaf_values(spark, model_path))
        lower, upper = F.col("lower"), F.col("upper")
    else:
        lower, upper = mae_interval(F.col("prediction"), fitted.metrics.get("MAE", DEFAULT_MAE))
    return scored_table(scored, lower, upper, version=version, keys=keys)


def isinstance_forest(model) -> bool:
    return type(model).__name__ == "RandomForestRegressionModel"
