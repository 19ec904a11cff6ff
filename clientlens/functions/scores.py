"""Threshold ladders: a value mapped onto a score n..1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def score_ladder(col: Column | str, thresholds: Sequence[float], direction: str) -> Column:
    """Score ``len(thresholds)+1`` for the first threshold met, down to 1.

    ``direction="le"``: first ``col <= t`` wins (recency: smaller is better);
    ``direction="ge"``: first ``col >= t`` wins (frequency, amount).
    A null input meets no threshold and falls to score 1, as a CASE ladder does.
    """
    c = F.col(col) if isinstance(col, str) else col
    if direction not in ("le", "ge"):
        raise ValueError("direction must be 'le' or 'ge'")
    top = len(thresholds) + 1
    expr = None
    for i, t in enumerate(thresholds):
        cond = c <= F.lit(t) if direction == "le" else c >= F.lit(t)
        expr = F.when(cond, F.lit(top - i)) if expr is None else expr.when(cond, F.lit(top - i))
    return F.lit(1) if expr is None else expr.otherwise(F.lit(1))
