"""Purchase patterns by calendar part."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clientlens.functions.calendar import hour_of_day, weekday
from clientlens.roles import Roles


def weekday_patterns(df: DataFrame, r: Roles) -> DataFrame:
    """Per day of week (Sunday = 1): purchases, mean and total amount.
    Seven groups: partial aggregation leaves at most 7 rows per task to shuffle."""
    return (df.groupBy(weekday(r.ts).alias("jour_semaine"))
              .agg(F.count(F.lit(1)).alias("nombre_achats"),
                   F.avg(r.amount).alias("montant_moyen"),
                   F.sum(r.amount).alias("montant_total")))


def hourly_patterns(df: DataFrame, r: Roles) -> DataFrame:
    """Per hour of day: purchases and mean amount."""
    return (df.groupBy(hour_of_day(r.ts).alias("heure"))
              .agg(F.count(F.lit(1)).alias("nombre_achats"),
                   F.avg(r.amount).alias("montant_moyen")))


def purchase_profile(df: DataFrame, r: Roles) -> DataFrame:
    """Count and sum of the amount by (category, weekday, hour): one scan that
    serves the weekday, hour and category tables. At most categories x 7 x 24
    rows per task cross the shuffle."""
    return (df.groupBy(F.col(r.category).alias("category"), weekday(r.ts).alias("jour_semaine"), hour_of_day(r.ts).alias("heure"))
              .agg(F.count(F.lit(1)).alias("n"), F.count(r.amount).alias("amounts"), F.sum(r.amount).alias("total")))


def from_profile(profile: DataFrame, key: str, name: str, *columns: str) -> DataFrame:
    """A pattern table from ``purchase_profile``: ``key`` as ``name``, then the
    asked ones of purchases, revenue and mean amount."""
    made = {"nombre_achats": F.sum("n"), "montant_total": F.sum("total"), "revenu_total": F.sum("total"),
            "montant_moyen": F.try_divide(F.sum("total"), F.sum("amounts"))}
    return profile.groupBy(F.col(key).alias(name)).agg(*[made[c].alias(c) for c in columns])
