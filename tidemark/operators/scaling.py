"""Standard scaling with persisted parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import clean_double
from tidemark.operators.prep import check_schema


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows ``(feature, mean, scale)`` from one pass over the training rows.

    Population deviation; a constant column gets scale 1; NULL and NaN values are ignored.
    """
    check_schema(df, features)
    stats = df.agg(
        *[F.avg(clean_double(f)).alias(f"_m{i}") for i, f in enumerate(features)],
        *[F.stddev_pop(clean_double(f)).alias(f"_s{i}") for i, f in enumerate(features)],
    )
    rows = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f"_m{i}").alias("mean"),
            F.when(F.col(f"_s{i}") == 0.0, F.lit(1.0)).otherwise(F.col(f"_s{i}")).alias("scale"),
        )
        for i, f in enumerate(features)
    ]
    return stats.select(F.inline(F.array(*rows)))


def scaler_values(params: DataFrame) -> dict[str, tuple[float, float]]:
    """``feature -> (mean, scale)`` on the driver: one row per feature."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in params.select("feature", "mean", "scale").collect()}


def apply_scaler(df: DataFrame, params: DataFrame | dict, features: Sequence[str], suffix: str = "") -> DataFrame:
    """``(x - mean) / scale`` per feature as plain arithmetic, so it fuses with the scan.

    Features are replaced in place, or added as ``feature + suffix``.
    """
    check_schema(df, features)
    values = params if isinstance(params, dict) else scaler_values(params)
    unknown = [f for f in features if f not in values]
    if unknown:
        raise ValueError(f"scaler has no parameters for {unknown}")
    return df.withColumns(
        {f + suffix: (clean_double(f) - F.lit(values[f][0])) / F.lit(values[f][1]) for f in features}
    )
