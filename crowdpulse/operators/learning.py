"""Logistic model on training rows, with MLlib."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.operators.serving import Predictor
from crowdpulse.params import CATEGORICAL_INPUTS, LABEL, NUMERIC_INPUTS
from crowdpulse.session import run_dir


def model_inputs(rows: DataFrame) -> DataFrame:
    """Numeric inputs as double with null = 0, categorical ones as text with null = 'Unknown'."""
    keep = [c for c in rows.columns if c not in (*NUMERIC_INPUTS, *CATEGORICAL_INPUTS)]
    return rows.select(
        *keep,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in NUMERIC_INPUTS],
        *[F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias(c) for c in CATEGORICAL_INPUTS],
    )


def scaler_statistics(inputs: DataFrame) -> DataFrame:
    """Mean and population deviation of every numeric input, one pass over all rows."""
    stats = inputs.agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("deviation")).alias(c) for c in NUMERIC_INPUTS]
    )
    return stats.unpivot([], list(NUMERIC_INPUTS), "feature", "s").select("feature", "s.mean", "s.deviation")


def category_values(inputs: DataFrame) -> DataFrame:
    """Distinct values of each categorical input with their counts: what the encoder learns."""
    return (
        inputs.select(*CATEGORICAL_INPUTS)
        .unpivot([], list(CATEGORICAL_INPUTS), "feature", "value")
        .groupBy("feature", "value")
        .agg(F.count("*").alias("samples"))
    )


def training_stages(regularisation: float = 1e-4) -> Pipeline:
    """Scaling and encoding fitted on all rows; a value not seen in training encodes as zeros."""
    indexed = [f"{c}_index" for c in CATEGORICAL_INPUTS]
    encoded = [f"{c}_hot" for c in CATEGORICAL_INPUTS]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(CATEGORICAL_INPUTS), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
            VectorAssembler(inputCols=list(NUMERIC_INPUTS), outputCol="numeric"),
            StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
            VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
            LogisticRegression(featuresCol="features", labelCol=LABEL, regParam=regularisation),
        ]
    )


def fit(rows: DataFrame) -> PipelineModel:
    """A model fitted on all rows, as it reads back from storage.

    A model fresh from training carries its training summary and with it the
    session, which cannot be sent to executors once the session has observations.
    """
    spark = rows.sparkSession
    model = training_stages().fit(model_inputs(rows).withColumn(LABEL, F.col(LABEL).cast("double")))
    path = run_dir(spark, "fitted-model")
    model.write().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame, keys: list[str]) -> DataFrame:
    return model.transform(model_inputs(rows)).select(
        *keys, vector_to_array("probability")[1].alias("moderation_probability")
    )


def model_predictor(model: PipelineModel, version: str) -> Predictor:
    """Predictor with a trained model, in place of the rules."""

    def predict(rows: DataFrame) -> DataFrame:
        scored = model.transform(model_inputs(rows))
        return scored.select(
            *rows.columns,
            vector_to_array("probability")[1].alias("moderation_probability"),
            F.lit("model").alias("inference_mode"),
            F.lit(version).alias("model_version"),
        )

    return predict


def training_metadata(rows: DataFrame, snapshot_id: int, algorithm: str = "LogisticRegression") -> DataFrame:
    """One row that ties a model to its data; a batch is an input partition."""
    counted = rows.select(F.spark_partition_id().alias("__batch")).agg(
        F.count("*").alias("rows_seen"), F.countDistinct("__batch").alias("batches_seen")
    )
    return counted.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("trained_at"),
        F.lit(str(snapshot_id)).alias("snapshot_id"),
        "rows_seen",
        "batches_seen",
        F.lit(algorithm).alias("algorithm"),
    )


def save(model: PipelineModel, metadata: DataFrame, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def area_under_roc(scored: DataFrame, probability: str = "moderation_probability") -> float:
    """Ours: the area under the ROC curve of scored, labelled rows."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(rawPredictionCol=probability, labelCol=LABEL).evaluate(
        scored.withColumn(LABEL, F.col(LABEL).cast("double"))
    )
