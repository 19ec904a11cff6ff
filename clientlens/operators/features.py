"""Feature engineering: flag encoding, vector assembly, standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def encode_flag(df: DataFrame, col: str, value, out: str) -> DataFrame:
    """``out`` = 1 where ``col == value`` else 0 (null goes to 0)."""
    return df.withColumn(out, F.when(F.col(col) == F.lit(value), F.lit(1)).otherwise(F.lit(0)))


def assemble_scale(df: DataFrame, inputs: Sequence[str], features: str = "features",
                   scaled: str = "scaled_features") -> tuple[DataFrame, PipelineModel]:
    """Assemble ``inputs`` into a vector (a null raises, as the reference) and
    standardise to mean 0 and sample std 1; a constant input becomes 0.

    The scaler fit is one distributed summary (tree aggregation of k means and
    variances), the transform is a projection.
    """
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(inputs), outputCol=features, handleInvalid="error"),
        StandardScaler(inputCol=features, outputCol=scaled, withMean=True, withStd=True),
    ])
    model = pipe.fit(df)
    return model.transform(df), model


def standardize(df: DataFrame, inputs: Sequence[str], prefix: str = "z_") -> DataFrame:
    """DataFrame form of the scaler: ``(x - mean) / std_samp`` per input, 0 when
    the std is 0 or there is one row only, as the ML scaler gives. Means and stds
    are one aggregated row (collected: 2 numbers per input), so the scaling is a
    projection with literals."""
    stats = df.agg(*[e for c in inputs for e in (F.avg(c), F.stddev(c))]).first()
    cols = []
    for i, c in enumerate(inputs):
        m, sd = stats[2 * i], stats[2 * i + 1]
        if sd is None or sd == 0:
            z = F.when(F.col(c).isNotNull(), F.lit(0.0))
        else:
            z = (F.col(c) - F.lit(m)) / F.lit(sd)
        cols.append(z.alias(f"{prefix}{c}"))
    return df.select("*", *cols)


def vector_columns(df: DataFrame, vec: str, names: Sequence[str]) -> DataFrame:
    """Split an ML vector column into named double columns."""
    arr = vector_to_array(F.col(vec))
    return df.select("*", *[arr[i].alias(n) for i, n in enumerate(names)])
