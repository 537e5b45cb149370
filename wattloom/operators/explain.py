"""Which features a model relies on: built-in importance and permutation effects."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.functions.numbers import pearson
from wattloom.operators.learning import Fitted
from wattloom.operators.series import with_position
from wattloom.schemas import SEED, TARGET


def importance(fitted: Fitted, top=15) -> DataFrame:
    """(feature, importance), the ``top`` strongest; one entry per feature of the model."""
    rows = list(zip(fitted.features, map(float, fitted.model.featureImportances.toArray())))
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.col("importance").desc(), "feature").limit(top)


def permutation_effects(fitted: Fitted, test: DataFrame, key="Date", seed=SEED,
                        top: int | None = 15) -> DataFrame:
    """(feature, mean_effect, direction): growth of the MAE when a feature is shuffled.

    Each row gets the values of a donor row, the one whose rank in a random order equals its own
    rank by key, from one join over all rows, and is then scored once per feature with only that value replaced. All
    features are scored in a single job. ``key`` identifies a row. The direction is the sign of
    the correlation between the feature and the prediction.
    """
    n_features = len(fitted.features)
    base = fitted.prepare(test).select(key, TARGET, vector_to_array("features").alias("x"),
                                       F.xxhash64(F.col(key), F.lit(seed)).alias("draw"))
    own = with_position(base, [key])
    donor = with_position(base, ["draw", key]).select("_pos", F.col("x").alias("donor"))
    pairs = own.join(donor, "_pos")
    # Position -1 is the unchanged row.
    mixed = pairs.select(TARGET, "x", "donor", F.explode(
        F.sequence(F.lit(-1), F.lit(n_features - 1))).alias("f"))
    swapped = F.transform("x", lambda v, i: F.when(i == F.col("f"), F.element_at(
        F.col("donor"), i + 1)).otherwise(v))
    scored = fitted.model.transform(mixed.select(
        TARGET, "f", array_to_vector(swapped).alias("features")))
    error = scored.groupBy("f").agg(
        F.avg(F.abs(F.col(TARGET) - F.col("prediction"))).alias("mae"))
    names = F.array(*[F.lit(n) for n in fitted.features])
    plain = error.where(F.col("f") < 0).select("mae").scalar()
    # Direction: how the prediction moves with the feature on the unchanged rows.
    moves = (fitted.predict(test).select("prediction", F.posexplode(vector_to_array("features")))
             .groupBy(F.col("pos").alias("f")).agg(pearson("col", "prediction").alias("r")))
    effects = error.where(F.col("f") >= 0).withColumn("mean_effect", F.col("mae") - plain).join(
        moves, "f").select(
        names[F.col("f")].alias("feature"), "mean_effect",
        F.when(F.col("r") > 0, "increases").otherwise("decreases").alias("direction"))
    ranked = effects.orderBy(F.col("mean_effect").desc(), "feature")
    return ranked if top is None else ranked.limit(top)
