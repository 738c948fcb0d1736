"""Scoring with linear softmax models whose coefficients live in a table."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import argmax, clean_double
from tidemark.operators.prep import check_schema
from tidemark.operators.scaling import scaler_values

# tasks receive the batch scoring functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COEFFICIENTS = "model_name string, version int, class_id int, intercept double, weights array<double>, features array<string>"
UNROLL_LIMIT = 256  # products written out as generated code; larger models use one matrix product per batch


@dataclass(frozen=True)
class LinearModel:
    """One model version: a class per row of ``weights``. A single array column may hold all features."""

    name: str
    version: int
    features: tuple[str, ...]
    class_ids: tuple[int, ...]
    intercepts: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]

    @property
    def reads_array(self) -> bool:
        return len(self.features) == 1 and len(self.weights[0]) > 1

    @classmethod
    def from_table(cls, coefficients: DataFrame, name: str, version: int) -> LinearModel:
        """Reads one version: one row per class, so only a handful of rows reach the driver."""
        rows = (
            coefficients.filter((F.col("model_name") == name) & (F.col("version") == version)).orderBy("class_id").collect()
        )
        if not rows:
            raise ValueError(f"model {name} has no version {version}")
        if len({r["class_id"] for r in rows}) < len(rows):
            raise ValueError(f"model {name} version {version} has several rows for a class")
        return cls(
            name,
            version,
            tuple(rows[0]["features"]),
            tuple(r["class_id"] for r in rows),
            tuple(r["intercept"] for r in rows),
            tuple(tuple(r["weights"]) for r in rows),
        )

    def to_table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.name, self.version, c, b, list(w), list(self.features))
            for c, b, w in zip(self.class_ids, self.intercepts, self.weights)
        ]
        return spark.createDataFrame(rows, COEFFICIENTS)


def _finite(value: Column) -> Column:
    """NULL for a value that is missing or infinite: neither can be scored."""
    return F.when(F.abs(value) < float("inf"), value)


def _inputs(model: LinearModel) -> list[Column]:
    if model.reads_array:
        width = len(model.weights[0])
        fits = F.size(model.features[0]) == width
        return [_finite(F.when(fits, clean_double(F.get(model.features[0], F.lit(i))))) for i in range(width)]
    return [_finite(clean_double(f)) for f in model.features]


def _softmax(logits: np.ndarray) -> np.ndarray:
    top = logits - logits.max(axis=1, keepdims=True)
    exps = np.exp(top)
    return exps / exps.sum(axis=1, keepdims=True)


def probability_udf(model: LinearModel) -> Callable[..., Column]:
    """Arrow-batched scoring function over ``struct(*features)`` (or the array column).

    Returns the probabilities in class order; NULL when an input is missing or infinite, or an array has another length.
    """
    weights, intercepts = np.array(model.weights).T, np.array(model.intercepts)
    width = weights.shape[0]

    def matrix(batch: pd.DataFrame | pd.Series) -> np.ndarray:
        if isinstance(batch, pd.DataFrame):
            return batch.to_numpy(dtype="float64", na_value=np.nan)
        blank = np.full(width, np.nan)
        return np.array([blank if v is None or len(v) != width else np.asarray(v, dtype="float64") for v in batch]).reshape(-1, width)

    def probabilities(batches: Iterator) -> Iterator[pd.Series]:
        for batch in batches:
            x = matrix(batch)
            with np.errstate(all="ignore"):
                scored = _softmax(x @ weights + intercepts)
            ok = np.isfinite(x).all(axis=1) & ~np.isnan(scored).any(axis=1)
            yield pd.Series([row if good else None for row, good in zip(scored, ok)], dtype="object")

    if model.reads_array:

        def score_array(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return probabilities(batches)

        return F.pandas_udf(score_array, T.ArrayType(T.DoubleType()))

    def score_struct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        return probabilities(batches)

    return F.pandas_udf(score_struct, T.ArrayType(T.DoubleType()))


def with_probabilities(
    df: DataFrame,
    model: LinearModel,
    scaler: DataFrame | dict | None = None,
    prefix: str = "probability_class_",
    prediction: str = "predicted_class",
    unroll: int = UNROLL_LIMIT,
) -> DataFrame:
    """Adds one probability column per class and the predicted class.

    Small models become plain arithmetic that fuses with the scan; wide ones use one matrix product
    per Arrow batch (more than ``unroll`` products). The row maximum is subtracted before ``exp``. Rows with a missing or
    infinite feature, or an array of another length than the model's, get NULLs either way. A scaler names features, so
    one for the elements of an array is an error. Input columns are left as they are: ``scaler`` applies to the model's view only.
    """
    check_schema(df, model.features)
    size = len(model.class_ids) * len(model.weights[0])
    outputs = [f"{prefix}{c}" for c in model.class_ids]
    scales = {} if scaler is None else scaler if isinstance(scaler, dict) else scaler_values(scaler)
    if scales and model.reads_array:
        raise ValueError(f"a scaler cannot be applied to the elements of {model.features[0]}")
    inputs = _inputs(model) if not model.reads_array or size <= unroll else []
    if scales:
        inputs = [(x - F.lit(scales[f][0])) / F.lit(scales[f][1]) for f, x in zip(model.features, inputs)]
    if size > unroll:
        udf = probability_udf(model)
        source = F.col(model.features[0]) if model.reads_array else F.struct(*[x.alias(f) for f, x in zip(model.features, inputs)])
        scored = df.withColumn("_p", udf(source))
        ids = F.array(*[F.lit(c) for c in model.class_ids])
        return scored.withColumns(
            {
                prediction: F.get(ids, (F.array_position("_p", F.array_max("_p")) - 1).cast("int")).cast("int"),
                **{o: F.get("_p", F.lit(i)) for i, o in enumerate(outputs)},
            }
        ).drop("_p")
    xs = [f"_x{i}" for i in range(len(inputs))]
    zs = [f"_z{i}" for i in range(len(outputs))]
    es = [f"_e{i}" for i in range(len(outputs))]
    staged = df.withColumns(dict(zip(xs, inputs)))
    logits = {}
    for z, b, w in zip(zs, model.intercepts, model.weights):
        total = F.lit(float(b))
        for x, factor in zip(xs, w):
            total = total + F.lit(float(factor)) * F.col(x)
        logits[z] = total
    staged = staged.withColumns(logits).drop(*xs)
    scores = [F.col(z) for z in zs]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    staged = staged.withColumns({e: F.exp(z - best) for e, z in zip(es, scores)})
    # a row of one struct: a filter on what follows stays above it, and does not repeat the arithmetic for every mention
    staged = staged.select("*", F.inline(F.array(F.struct(*[F.col(c).alias(f"_{c}") for c in [*zs, *es]])))).drop(*zs, *es)
    zs, es = [f"_{z}" for z in zs], [f"_{e}" for e in es]
    scores = [F.col(z) for z in zs]
    total = sum((F.col(e) for e in es[1:]), F.col(es[0]))
    return staged.withColumns(
        {prediction: argmax(scores, model.class_ids), **{o: F.col(e) / total for o, e in zip(outputs, es)}}
    ).drop(*zs, *es)


def score(df: DataFrame, model: LinearModel, scaler: DataFrame | dict | None = None) -> DataFrame:
    """Adds ``predicted_class, prediction_probability, probability_class_*, model_version``."""
    names = [f"probability_class_{c}" for c in model.class_ids]
    scored = with_probabilities(df, model, scaler)
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    return scored.withColumns(
        {"prediction_probability": best, "model_version": F.lit(model.version).cast("int")}
    )


def score_pair(
    df: DataFrame,
    production: LinearModel,
    challenger: LinearModel,
    scaler: DataFrame | dict | None = None,
    challenger_scaler: DataFrame | dict | None = None,
) -> DataFrame:
    """Adds ``production_class`` and ``challenger_class`` in one scan; the challenger may have its own scaler."""
    challenger_scaler = scaler if challenger_scaler is None else challenger_scaler
    both = with_probabilities(df, production, scaler, "_pp_", "production_class")
    both = with_probabilities(both, challenger, challenger_scaler, "_pc_", "challenger_class")
    return both.drop(*[f"_pp_{c}" for c in production.class_ids], *[f"_pc_{c}" for c in challenger.class_ids])


def score_by_row_model(
    df: DataFrame, coefficients: DataFrame, model_key: Sequence[str], features: Sequence[str]
) -> DataFrame:
    """Scores rows that each name their own model: ``model_key`` joins rows with coefficient rows.

    Coefficients are gathered to one row per model first; Spark picks the join from their size.
    Adds ``probabilities`` (in class order), ``predicted_class`` and ``prediction_probability``; all are
    NULL for rows whose model is unknown.
    """
    models = coefficients.groupBy(*model_key).agg(
        F.sort_array(F.collect_list(F.struct("class_id", "intercept", "weights"))).alias("_model")
    )
    x = F.array(*[clean_double(f) for f in features])
    logits = F.transform(
        "_model",
        lambda m: m["intercept"]
        + F.aggregate(F.zip_with(m["weights"], "_x", lambda w, v: w * v), F.lit(0.0), lambda a, b: a + b),
    )
    scored = df.join(models, list(model_key), "left").withColumn("_x", x).withColumn("_z", logits)
    scored = scored.withColumn("_top", F.array_max("_z"))
    scored = scored.withColumn("_e", F.transform("_z", lambda z: F.exp(z - F.col("_top"))))
    scored = scored.withColumn("_s", F.aggregate("_e", F.lit(0.0), lambda a, b: a + b))
    scored = scored.withColumn("probabilities", F.transform("_e", lambda e: e / F.col("_s")))
    at = (F.array_position("_z", F.col("_top")) - 1).cast("int")
    return scored.withColumns(
        {
            "predicted_class": F.get("_model", at)["class_id"],
            "prediction_probability": F.array_max("probabilities"),
        }
    ).drop("_model", "_x", "_z", "_top", "_e", "_s")


def align_predictions(original: DataFrame, predictions: DataFrame, key: Sequence[str]) -> DataFrame:
    """All original rows next to their predictions, matched on the row key (never by position).

    A row without prediction gets NULLs. Columns of both tables besides the key are an error: which
    one is meant is the caller's choice.
    """
    check_schema(original, key)
    check_schema(predictions, key)
    if clash := [c for c in predictions.columns if c in original.columns and c not in key]:
        raise ValueError(f"both tables have {clash}: drop or rename them on one side")
    return original.join(predictions, list(key), "left")


def alignment_report(original: DataFrame, predictions: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row of counts: matched keys, keys on one side only, keys that occur more than once."""
    both = original.select(*key, F.lit(1).alias("_left")).unionByName(predictions.select(*key, F.lit(0).alias("_left")))
    per_key = both.groupBy(*key).agg(F.sum("_left").alias("l"), F.sum(1 - F.col("_left")).alias("r"))
    return per_key.agg(
        F.count_if((F.col("l") > 0) & (F.col("r") > 0)).alias("matched_keys"),
        F.count_if(F.col("r") == 0).alias("only_original"),
        F.count_if(F.col("l") == 0).alias("only_predictions"),
        F.count_if((F.col("l") > 1) | (F.col("r") > 1)).alias("duplicate_keys"),
    )


def require_aligned(original: DataFrame, predictions: DataFrame, key: Sequence[str]) -> None:
    """ValueError unless every key occurs exactly once on both sides."""
    facts = alignment_report(original, predictions, key).first()
    if facts["only_original"] or facts["only_predictions"] or facts["duplicate_keys"]:
        raise ValueError(f"tables do not align on {list(key)}: {facts.asDict()}")


def join_labels(features: DataFrame, labels: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their labels, and the keys found on one side only (``side`` says which)."""
    key = list(key)
    joined = features.join(labels, key, "inner")
    lost = (
        features.join(labels, key, "left_anti").select(*key, F.lit("features").alias("side"))
    ).unionByName(labels.join(features, key, "left_anti").select(*key, F.lit("labels").alias("side")))
    return joined, lost
