"""Recency / frequency / monetary scoring per client."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from clientlens.functions.calendar import days_between
from clientlens.functions.scores import score_ladder
from clientlens.roles import Roles

# The default score thresholds (days; purchases; amount).
RECENCY_DAYS = (30, 60, 90, 180)
FREQUENCY_COUNTS = (10, 7, 5, 3)
MONETARY_AMOUNTS = (1000, 750, 500, 250)


def _as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of).cast("date")
    return F.to_date(F.lit(str(as_of)))


def client_rfm_base(df: DataFrame, r: Roles) -> DataFrame:
    """One row per client: last purchase, purchase count, total amount.

    A single hash aggregation; the partial step runs in every map task, so a
    client holding a third of the rows ships one partial row per task.
    """
    return df.groupBy(r.client).agg(
        F.max(r.ts).alias("dernier_achat"),
        F.count(F.lit(1)).alias("frequence"),
        F.sum(r.amount).alias("montant_total"),
    )


def rfm(df: DataFrame, r: Roles, as_of=None,
        recency: Sequence[float] = RECENCY_DAYS,
        frequency: Sequence[float] = FREQUENCY_COUNTS,
        monetary: Sequence[float] = MONETARY_AMOUNTS) -> DataFrame:
    """RFM table: ``client, dernier_achat, frequence, montant_total, recence,
    r_score, f_score, m_score, rfm_score``.

    ``as_of`` is the reference day for recency (default: today); fixing it
    makes the result reproducible.
    """
    return score_rfm(client_rfm_base(df, r), as_of, recency, frequency, monetary)


def score_rfm(base: DataFrame, as_of=None,
              recency: Sequence[float] = RECENCY_DAYS,
              frequency: Sequence[float] = FREQUENCY_COUNTS,
              monetary: Sequence[float] = MONETARY_AMOUNTS) -> DataFrame:
    """Scores on a per-client table with ``dernier_achat, frequence,
    montant_total`` (from ``client_rfm_base`` or renamed from the loyalty
    table, so both analyses share one shuffle)."""
    rec = days_between(_as_of_col(as_of), F.col("dernier_achat"))
    r_s = score_ladder(rec, recency, "le")
    f_s = score_ladder("frequence", frequency, "ge")
    m_s = score_ladder("montant_total", monetary, "ge")
    # one projection; Catalyst evaluates the shared sub-expressions once per row
    return base.select("*", rec.alias("recence"), r_s.alias("r_score"), f_s.alias("f_score"),
                       m_s.alias("m_score"), ((r_s + f_s + m_s) / F.lit(3.0)).alias("rfm_score"))
