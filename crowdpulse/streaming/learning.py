"""A logistic model learned in one pass over batches, with weights carried from batch to batch."""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators.learning import model_inputs
from crowdpulse.operators.serving import Predictor
from crowdpulse.params import CATEGORICAL_INPUTS, LABEL, NUMERIC_INPUTS
from crowdpulse.streaming.batches import read_batches

STATE = "batch_id long, state string"


@dataclass(frozen=True)
class State:
    """What a batch leaves for the next one; its size is that of the inputs' values."""

    mean: tuple[float, ...]
    deviation: tuple[float, ...]
    values: tuple[tuple[str, str], ...]  # (input, value) of the encoder
    weights: tuple[float, ...]  # numeric inputs, values, intercept
    squares: tuple[float, ...]  # of the gradients so far
    rows_seen: int = 0
    batches_seen: int = 0


def fit_first(inputs: DataFrame, most_values: int = 1000) -> State:
    """Scaler and encoder from the first batch; weights are zero."""
    stats = inputs.agg(
        *[F.avg(c).alias(f"m_{c}") for c in NUMERIC_INPUTS], *[F.stddev_pop(c).alias(f"d_{c}") for c in NUMERIC_INPUTS]
    ).first()
    found = (
        inputs.select(*CATEGORICAL_INPUTS)
        .unpivot([], list(CATEGORICAL_INPUTS), "input", "value")
        .distinct()
        .orderBy("input", "value")
        .limit(most_values + 1)
        .collect()
    )
    if len(found) > most_values:
        raise ValueError(f"the first batch has more than {most_values} categorical values")
    values = tuple((r.input, r.value) for r in found)
    size = len(NUMERIC_INPUTS) + len(values) + 1
    return State(
        tuple(stats[f"m_{c}"] for c in NUMERIC_INPUTS),
        # An input that never varies is not scaled.
        tuple(stats[f"d_{c}"] or 1.0 for c in NUMERIC_INPUTS),
        values,
        (0.0,) * size,
        (0.0,) * size,
    )


def features(state: State) -> list[Column]:
    """Scaled numeric inputs, one indicator per value (an unknown value has none), and 1."""
    scaled = [(F.col(c) - F.lit(m)) / F.lit(d) for c, m, d in zip(NUMERIC_INPUTS, state.mean, state.deviation)]
    hot = [F.when(F.col(c) == v, 1.0).otherwise(0.0) for c, v in state.values]
    return [*scaled, *hot, F.lit(1.0)]


def probability(state: State) -> Column:
    score = sum((F.lit(w) * x for w, x in zip(state.weights, features(state))), F.lit(0.0))
    return 1.0 / (1.0 + F.exp(-score))


def step(state: State, gradient: list[float], rows: int, rate: float, penalty: float) -> State:
    """One step down the mean gradient of a batch, each weight by its own rate (the last is the intercept)."""
    own = [g / rows + penalty * w * (k < len(gradient) - 1) for k, (g, w) in enumerate(zip(gradient, state.weights))]
    squares = tuple(s + g * g for s, g in zip(state.squares, own))
    weights = tuple(w - rate * g / (math.sqrt(s) + 1e-12) for w, g, s in zip(state.weights, own, squares))
    return replace(
        state, weights=weights, squares=squares, rows_seen=state.rows_seen + rows, batches_seen=state.batches_seen + 1
    )


class IncrementalLearner:
    """``handle`` is a foreachBatch function over training rows.

    Each batch takes the weights the batch before left, adds up its gradient in one aggregation over
    its rows, and writes the new weights under its own number. A batch that is run again starts from
    the same weights and writes the same ones; a run that was stopped goes on after the last batch.
    """

    def __init__(self, spark: SparkSession, path: str, rate: float = 0.5, penalty: float = 1e-4):
        self.spark, self.path, self.rate, self.penalty = spark, path, rate, penalty

    def states(self) -> DataFrame:
        return read_batches(self.spark, self.path, STATE)

    def before(self, batch_id: int) -> State | None:
        found = self.states().filter(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
        if found is None:
            return None
        raw = json.loads(found.state)
        pairs = tuple((a, b) for a, b in raw.pop("values"))
        return State(values=pairs, **{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items()})

    def current(self) -> State | None:
        return self.before(1 << 62)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        inputs = model_inputs(batch).filter(F.col(LABEL).isNotNull())
        state = self.before(batch_id)
        if state is None:
            if inputs.isEmpty():
                return
            state = fit_first(inputs)
        error = probability(state) - F.col(LABEL).cast("double")
        rows = inputs.select(error.alias("__e"), *[x.alias(f"__x{k}") for k, x in enumerate(features(state))])
        sums = [F.sum(F.col("__e") * F.col(f"__x{k}")).alias(f"g{k}") for k in range(len(state.weights))]
        total = rows.agg(F.count("*").alias("n"), *sums).first()
        if not total.n:
            return
        after = step(state, [total[f"g{k}"] for k in range(len(state.weights))], total.n, self.rate, self.penalty)
        stored = self.spark.createDataFrame([(json.dumps(asdict(after)),)], "state string")
        stored.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def predictor(self) -> Predictor:
        """Predictor with the weights learned so far."""
        state = self.current()
        if state is None:
            raise ValueError("nothing has been learned yet")

        def predict(rows: DataFrame) -> DataFrame:
            # The inputs replace columns of the same names; rows keep their own.
            known = model_inputs(rows.withColumn("__row", F.struct(*rows.columns)))
            return known.select(
                *[F.col("__row").getField(c).alias(c) for c in rows.columns],
                probability(state).alias("moderation_probability"),
                F.lit("incremental").alias("inference_mode"),
                F.lit(str(state.batches_seen)).alias("model_version"),
            )

        return predict
