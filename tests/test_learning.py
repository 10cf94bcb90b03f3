"""Model inputs, fit, score, artefacts."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from crowdpulse.operators import learning
from crowdpulse.params import CATEGORICAL_INPUTS, LABEL, NUMERIC_INPUTS
from crowdpulse.schemas import TRAINING


def rows(spark, n=200, category="Soup"):
    rng = random.Random(1)
    out = []
    for i in range(n):
        flags = rng.randrange(4)
        row = {f.name: 0 for f in TRAINING}
        row |= {"image_id": str(i), "total_flags": flags, "category": category if i % 2 else None}
        row |= {f.name: 0.0 for f in TRAINING if f.dataType.typeName() == "double"}
        row[LABEL] = int(flags > 1)
        out.append(tuple(row[f.name] for f in TRAINING))
    return spark.createDataFrame(out, TRAINING)


def test_inputs(spark):
    inputs = learning.model_inputs(rows(spark, 2).withColumn("views_1hr", F.lit(None).cast("bigint")))
    got = inputs.orderBy("image_id").collect()
    assert (got[0].views_1hr, got[0].category, got[0].is_weekend) == (0.0, "Unknown", "0")


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double").select(*[F.col("x").alias(c) for c in NUMERIC_INPUTS])
    stats = learning.scaler_statistics(df).collect()
    assert {(r.mean, r.deviation) for r in stats} == {(2.0, 1.0)} and len(stats) == len(NUMERIC_INPUTS)


def test_fit_score_save_load(spark, tmp_path):
    data = rows(spark)
    model = learning.fit(data)
    scored = learning.score(model, data, ["image_id", LABEL])
    assert learning.area_under_roc(scored) > 0.99
    learning.save(model, learning.training_metadata(data, 42), str(tmp_path))
    meta = spark.read.json(f"{tmp_path}/metadata").first()
    assert (meta.rows_seen, meta.snapshot_id, meta.algorithm) == (200, "42", "LogisticRegression")
    assert meta.batches_seen >= 1
    loaded = PipelineModel.load(f"{tmp_path}/model")
    again = learning.score(loaded, data, ["image_id", LABEL])
    assert sorted(scored.collect()) == sorted(again.collect())


def test_model_scores_in_a_session_with_observations(spark):
    data = rows(spark, 50)
    seen = Observation()
    data.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 50}
    assert learning.score(learning.fit(data), data, ["image_id"]).count() == 50
    assert len(learning.score(learning.fit(data), data, ["image_id"]).collect()) == 50


def test_unseen_category_scores_as_no_category(spark):
    model = learning.fit(rows(spark))
    other = model.transform(learning.model_inputs(rows(spark, 4, category="Martian"))).filter("category = 'Martian'")
    encoder_output = [r.category_hot for r in other.collect()]
    assert encoder_output and all(v.numNonzeros() == 0 for v in encoder_output)


def test_model_as_predictor(spark):
    data = rows(spark)
    predict = learning.model_predictor(learning.fit(data), "v7")
    got = predict(data).first()
    assert got.inference_mode == "model" and got.model_version == "v7" and 0 <= got.moderation_probability <= 1


def test_category_values(spark):
    got = {(r.feature, r.value): r.samples for r in learning.category_values(learning.model_inputs(rows(spark))).collect()}
    assert got["category", "Unknown"] == 100 and got["category", "Soup"] == 100
    assert {f for f, _ in got} == set(CATEGORICAL_INPUTS)
