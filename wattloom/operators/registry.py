"""Model registry: saved pipelines, their metadata and feature schema, the latest version."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattloom.operators.learning import Fitted
from wattloom.schemas import TARGET


def register(spark: SparkSession, base: str, fitted: Fitted, version: str,
             train_dates: tuple, test_dates: tuple, status="production", now=None) -> str:
    """Save the pipeline of preparation and model under its version and append a metadata record.

    Returns the path of the model itself, the pipeline's last stage.
    """
    path, pipeline = _path(base, version), fitted.pipeline
    pipeline.write().overwrite().save(path)
    record = spark.range(1).select(
        F.lit(version).alias("version"), F.lit(type(fitted.model).__name__).alias("model_type"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("registered_at")
        if now is None else F.lit(now).alias("registered_at"),
        F.struct(*[F.lit(float(v)).alias(k) for k, v in fitted.metrics.items()]).alias("metrics"),
        F.lit(len(fitted.features)).alias("n_features"),
        F.array(*[F.lit(c) for c in fitted.features]).alias("feature_cols"),
        F.array(*[F.lit(float(fitted.medians.get(c) or 0.0)) for c in fitted.features]).alias("medians"),
        F.lit(TARGET).alias("target"),
        F.lit(" to ".join(map(str, train_dates))).alias("training_data"),
        F.lit(" to ".join(map(str, test_dates))).alias("test_data"),
        F.lit(status).alias("status"))
    record.write.mode("append").json(f"{base}/metadata")
    last = len(pipeline.stages) - 1
    return f"{path}/stages/{last:0{len(str(last + 1))}d}_{fitted.model.uid}"


def _path(base: str, version: str) -> str:
    return f"{base}/versions/{version}/pipeline"


def versions(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.json(f"{base}/metadata")


def feature_schema(spark: SparkSession, base: str) -> DataFrame:
    return versions(spark, base).select("version", "feature_cols", "n_features")


def latest(spark: SparkSession, base: str) -> DataFrame:
    """(latest_version, updated_at): the version registered last, the greater name if two were
    registered in one second."""
    return versions(spark, base).agg(
        F.max_by("version", F.struct("registered_at", "version")).alias("latest_version"),
        F.max("registered_at").alias("updated_at"))


def load_pipeline(base: str, version: str) -> PipelineModel:
    """The stored pipeline, from a feature table to predictions; needs nothing beside it."""
    return PipelineModel.load(_path(base, version))


def load(spark: SparkSession, base: str, version: str) -> Fitted:
    """The model with its features, medians and metrics."""
    pipeline = load_pipeline(base, version)
    record = (versions(spark, base).where(F.col("version") == version)
              .orderBy(F.col("registered_at").desc()).limit(1).first())
    fill = pipeline.stages[0]
    return Fitted(pipeline.stages[-1], list(fill.getInputCols()), fill.by_feature(),
                  record["model_type"], record["metrics"].asDict())
