"""Numeric expressions: rounding, nearest centre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_doubles(df: DataFrame, scale: int = 4) -> DataFrame:
    """Round every floating column to ``scale`` decimals, half up, through
    ``decimal(38,10)``: the double is first fixed to 10 decimals, then rounded,
    so an exact decimal tie (e.g. a mean of 58.47375) rounds the same way in
    any engine that does the same casts. Values outside decimal(38,10) fall
    back to a plain double round."""
    def r(c):
        return F.coalesce(F.round(F.col(c).try_cast("decimal(38,10)"), scale).cast("double"),
                          F.round(F.col(c), scale))
    return df.select([
        r(f.name).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def nearest_centre(features: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """Id of the nearest centre by squared euclidean distance; lowest id on ties.

    Centres are literals (k x d numbers, bounded by the caller's k), so the
    assignment is a projection inside one codegen stage.
    """
    cands = []
    for j, c in enumerate(centres):
        d = None
        for x, v in zip(features, c):
            t = (x - F.lit(float(v))) * (x - F.lit(float(v)))
            d = t if d is None else d + t
        cands.append(F.struct(d.alias("d"), F.lit(j).alias("id")))
    return F.least(*cands)["id"] if len(cands) > 1 else cands[0]["id"]
